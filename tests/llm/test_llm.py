import hashlib
import html
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapework.llm import chat, decontaminate, graph, htmltext, language, licenses, ngramjoin, packing, queries, secrets, spotsigs, substrings
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, "   "), (4, "word"), (4, "word"), (None, "the word and another word stands here"), (7, "x " * 5000), (8, "İ K   é ẞ 1,2")]


def docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({"n": F.lit(1), "key": F.lit("k"), "component_id": F.lit(0), "score": F.lit(2), "findings": F.lit(3)}) if extra else df


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)


@pytest.mark.parametrize("op", [spotsigs.edited_fingerprints, ngramjoin.linked, substrings.substring_report, licenses.license_report, secrets.scanned, packing.packed_documents, language.language_report])
def test_odd_and_empty_tables(spark, op):
    lang = lambda df: df.withColumn("lang", F.lit("xx"))
    assert op(lang(docs(spark, []))).count() == 0
    got = op(lang(docs(spark, ODD, extra=True)))
    n = got.count()
    assert n == len(ODD) if op is not packing.packed_documents else n >= len(ODD)


def test_decontamination_odd(spark):
    items = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "a b"), (5, "one two three four")], "item_id long, text string")
    rows = docs(spark, [*ODD, (20, "A, B!"), (21, "x One two\nthree four y"), (22, "one two three")])
    got = {r.doc_id: r for r in decontaminate.contamination_report(rows, items).collect()}
    assert (got[20].n_words, got[20].n_hit, got[20].n_items, got[20].contaminated) == (2, 2, 2, True)
    assert got[20].items_sha256 == hashlib.sha256(b"1,4").hexdigest()
    assert (got[21].n_hit, got[22].n_hit, got[1].n_words) == (4, 0, 0)
    assert decontaminate.contamination_report(rows, items.limit(0)).count() == len(ODD) + 3
    assert decontaminate.contamination_report(docs(spark, []), items).count() == 0


# Fingerprints


def plain_signatures(text):
    anchors = set(spotsigs.ANCHORS.split())
    out, words = set(), re.findall(r"[^\W_]+", text.lower())
    content = [(w, i) for i, w in enumerate(words) if w not in anchors]
    places = [i for i, w in enumerate(words) if w in anchors and not (i + 1 < len(words) and words[i + 1] in anchors)]
    for i in places:
        chain = [w for w, j in content if j > i][:2]
        if len(chain) == 2:
            out.add((words[i], *chain))
    return out, words


def test_signatures_count_and_likeness(spark):
    texts = ["the cat sat on the mat and the dog ran to a big house", "alpha beta gamma delta", "of the cat sat down", "the the the", "Zoo!"]
    got = spotsigs.fingerprints(docs(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    for r in got:
        chains, words = plain_signatures(r.text)
        assert abs(len(r.signatures) - len(chains)) <= 1 and (len(r.signatures) > 0) == bool(words)
    same = spotsigs.edited_fingerprints(docs(spark, [(1, texts[0]), (2, texts[0]), (3, texts[1])])).orderBy("doc_id").collect()
    assert same[0].fingerprint == same[1].fingerprint and same[0].near_next == 1.0 and same[1].near_next == 0.0
    n = len(texts[0])
    assert same[0].edited_sha256 == hashlib.sha256((texts[0][: n - n // 4] + texts[0][: n // 4]).encode()).hexdigest()
    assert same[2].edited_sha256 == hashlib.sha256((texts[1][: 22 - 5] + texts[0][:5]).encode()).hexdigest()


def test_next_document_over_many_ranges(spark):
    rows = [(i * 3, f"document number {i} " * 3) for i in range(200)]
    random.Random(1).shuffle(rows)
    got = {r.doc_id: r.edited_sha256 for r in spotsigs.edited_fingerprints(docs(spark, rows)).collect()}
    text = dict(rows)
    for i in text:
        t, nxt = text[i], text[i + 3 if i + 3 in text else 0]
        assert got[i] == hashlib.sha256((t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]).encode()).hexdigest()


def test_spotsigs_near_duplicates(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)] + spotsigs.ANCHORS.split()
    base = [" ".join(r.choices(words, k=400)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)] + [(10 + i, t + " extra") for i, t in enumerate(base)] + [(20, base[0])]
    members, pairs = spotsigs.near_duplicates(docs(spark, rows))
    assert {m.doc_id: m.class_id for m in members.collect()}[20] == 0
    sets = {r.doc_id: set(r.signatures) for r in spotsigs.fingerprints(docs(spark, rows)).collect()}
    reps = {m.class_id for m in members.collect()}
    want = {(max(a, b), min(a, b)) for a in reps for b in reps if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(max(p.class_id, p.other_id), min(p.class_id, p.other_id)) for p in pairs.collect()} == want


# Joins


def plain_components(rows, k=4, percent=85):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").encode().lower().decode())
        sets[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("block", [4000, 5])
def test_join_matches_brute_force(spark, block):
    r = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for family in range(8):
        base = r.choices(words + [f"f{family}_{i}" for i in range(30)], k=r.choice([3, 8, 60, 200]))
        for _ in range(7):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 40))):
                t[r.randrange(len(t))] = r.choice(words)
            rows.append((len(rows), " ".join(t)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngramjoin.linked(docs(spark, rows), block=block).collect()}
    assert got == plain_components(rows)


def test_tree_loses_no_pair():
    r = np.random.default_rng(2)
    x = r.poisson(3, (300, 16)).astype(np.int32)
    x[150:] = np.maximum(x[:150] + r.integers(-1, 2, (150, 16)) * (r.random((150, 16)) < 0.1), 0)
    n = x.sum(1)
    found = {tuple(sorted(p)) for i, j in ngramjoin.Tree(x, n, np.arange(300)).pairs(85) for p in zip(i.tolist(), j.tolist(), strict=True)}
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if 185 * int(np.minimum(x[a], x[b]).sum()) >= 85 * int(n[a] + n[b])}
    assert found == want


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100
    assert graph.components(links.limit(0)).count() == 0


@pytest.mark.parametrize("n_batches", [1, 3])
def test_substrings_match_brute_force(spark, n_batches):
    r = random.Random(4)
    words = [f"w{i}" for i in range(6)]
    passages = [r.choices(words, k=k) for k in (19, 20, 25, 60)]
    rows = []
    for i in range(30):
        t = r.choices(words + [f"d{i}_{j}" for j in range(40)], k=r.randint(5, 60))
        for _ in range(r.randint(0, 3)):
            t[r.randint(0, len(t)) : 0] = r.choice(passages)
        rows.append((i, " ".join(t)))
    rows += [(30, rows[2][1]), (31, "a b " * 40)]
    seen, want = set(), {}
    for i, t in rows:
        w, gone = t.split(), set()
        for j in range(len(w) - 19):
            window = tuple(w[j : j + 20])
            gone.update(range(j, j + 20)) if window in seen else seen.add(window)
        want[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept) for x in substrings.deduplicated(docs(spark, rows).repartition(5), n_batches=n_batches).collect()}
    assert got == want


# Chat


def test_rotation_odd(spark):
    schema = "conv_id long, turn long, role string, text string"
    odd = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, None, None), (1, 2, "ann", "x"), (1, 600, "ann", "late"), (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (3, None, "bob", "é")]
    got = {(r.conv_id, r.participant, r.block): r for r in chat.rotations(spark.createDataFrame(odd, schema)).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "unknown", 0), (1, "unknown", 1), (3, "bob", 0)}
    r = got[(1, "ann", 0)]
    assert [r.text[s.start : s.end] for s in r.spans] == ["hi<|im_end|>\n", "x<|im_end|>\n"]
    assert chat.rotations(spark.createDataFrame([], schema)).count() == 0


# Language


def test_gradients():
    net = language.Network.new(["a", "b", "c"], units=4)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data = np.random.default_rng(0).integers(0, 256, (6, 3)).astype(np.uint8)
    y, w = np.array([0, 1, 2]), np.ones((6, 3))
    _, g = net.gradients(data, y, w)
    for k, v in net.weights.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        kept, e = v[at], 1e-3
        v[at] = kept + e
        up, _ = net.gradients(data, y, w)
        v[at] = kept - e
        down, _ = net.gradients(data, y, w)
        v[at] = kept
        assert (up - down) / (2 * e) == pytest.approx(g[k][at], rel=1e-2, abs=1e-4)


def test_language_held_out(spark):
    got = queries.op4_byte_network(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95


def test_whole_texts_are_pooled():
    net = language.Network.new(["a", "b"])
    long = b"abc" * 100_000
    assert net.pooled([long, b"abc"]).sum(1) == pytest.approx([1, 1], abs=1e-4)


# Pages


def test_main_text():
    page = "<html><head><title>t</title></head><body><nav><a href=1>Home</a></nav><div class=cookie-notice>Take our cookies</div><div id=main><h1>Head</h1><p>First  &amp; <b>best</b>\n line of the article, long enough to count.</p><p>Second line of it, as long as the first one is.</p></div><div id=comments><p>Reader says hi</p></div><aside>side</aside><form><label>name</label></form><footer>&copy; x</footer></body></html>"
    assert htmltext.main_text(page) == "Head\n\nFirst & best line of the article, long enough to count.\n\nSecond line of it, as long as the first one is."
    assert [htmltext.main_text(x) for x in (None, "", "<p>", "<!-- x", "<script>x", "a &lt; b")] == ["", "", "", "", "", "a < b"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/ab p=\"'!-&;lt", max_size=120))
def test_main_text_never_fails(text):
    htmltext.main_text(text)


def test_pages_keep_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    texts = {r.page_id: r.text for r in htmltext.extracted(pages).collect()}
    squeeze = lambda x: re.sub(r"\s+", "", x)
    for p in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        assert squeeze(texts[p.page_id]) == squeeze(html.unescape(re.sub("<[^>]*>", "", article)))


# Secrets


def test_forest_and_masks(spark):
    test = secrets.written_findings(600, seed=99)
    x = np.array([secrets.features(*t[:3]) for t in test])
    right = (secrets.trained().predict(x) >= 0.5) == np.array([t[3] for t in test])
    assert right.mean() > 0.97
    key = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"
    text = f'réé token = "{key}" and commit {key} end'
    r = secrets.scanned(docs(spark, [(1, text)])).first()
    assert r.masked_text == text.replace(f'"{key}"', '"<secret>"') and [text[f.start : f.end] for f in r.findings] == [key]
    labelled = spark.createDataFrame(test, "value string, before string, after string, secret int")
    assert len(secrets.trained(labelled, most=300).trees) == secrets.TREES


# Licenses


def test_base_places_and_templates():
    scanner = licenses.Scanner()
    r = random.Random(8)
    pool = "mit license apache general public gnu the a under lesser of".split()
    for _ in range(200):
        w = r.choices(pool, k=60)
        want = sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(60) if w[i : i + len(phrase.split())] == phrase.split())
        assert scanner.scan(" ".join(w))["places"] == want
    x = scanner.scan("intro " + licenses.TEMPLATES["bsd"].upper() + " outro")
    assert [s[0] for s in x["spans"] if s[3] > 0.95] == ["bsd"]


# Packing


def test_tokens_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(packing.VOCABULARY))
    plain, fast = Tokenizer.from_file(path), packing.encoder(path, remembered=50)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    for t in [*texts, "", "it's we'LL 'tis x'''s", "a\x1cb", "<|endoftext|> A", "ÀÉ ß µ 1234 ***...", "日本 é", "don't.'s!! 'S", "a\xa0b\x85c"]:
        assert fast(t) == np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_and_bound(lengths):
    n = np.array(lengths, dtype=np.int64)
    bins, offsets, room = packing.best_fit_decreasing(n, 64)
    for b in range(len(room)):
        spans = sorted((o, o + k) for o, k, x in zip(offsets, n, bins, strict=True) if x == b)
        assert spans[0][0] == 0 and all(p[1] == q[0] for p, q in zip(spans, spans[1:])) and spans[-1][1] == 64 - room[b]
    bound = packing.bins_needed(np.bincount(n, minlength=65), 64)
    assert bound <= len(room) <= 2 * bound + 1


def test_packing_round_trip(spark):
    rows = [(i, "word " * (i * 37 % 3000)) for i in range(120)] + [(5, "word " * 185)]
    got = packing.packed(packing.pieces(docs(spark, rows)).persist(), per_partition=10).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 2048
    assert len(by) <= packing.bins_needed(np.bincount([r.length for r in got], minlength=2049)) + 3
    assert sum(r.length for r in got) == sum(i * 37 % 3000 + 1 for i in range(120)) + 186
