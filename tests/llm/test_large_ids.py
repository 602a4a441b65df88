"""Ids and other columns that a float cannot hold come back as they were, also beside nulls."""

import datetime as dt
import time

import numpy as np
from pyspark.sql import functions as F

from tapework.llm import htmltext, language, licenses, ngramjoin, packing, secrets, substrings

BIG = 2**60 + 1
SCHEMA = "doc_id long, text string, lang string, n_chars int, seen timestamp, more struct<a:int,b:string>, score string"
WHEN = dt.datetime(2026, 1, 2, 3, 4, 5, 678901)


def rows(spark):
    text = "der schnelle braune Fuchs springt über den faulen Hund " * 4
    data = [(BIG, text, "de", None, WHEN, (None, "x"), "s"), (None, text, "de", 7, None, None, None), (3, None, None, 2**31 - 1, WHEN, (1, None), None)]
    return spark.createDataFrame(data, SCHEMA)


def ids(df, column="doc_id"):
    return {r[0] for r in df.select(column).collect()}


def test_ids(spark):
    docs, wanted = rows(spark), {BIG, None, 3}
    assert ids(ngramjoin.linked(docs)) == wanted
    assert {r.doc_id: r.component_id for r in ngramjoin.linked(docs).collect()} == {BIG: BIG, None: None, 3: 3}
    assert ids(language.language_report(docs)) == wanted
    assert ids(licenses.license_report(docs)) == wanted
    assert ids(substrings.substring_report(docs)) == wanted
    assert ids(packing.packed_documents(docs)) == wanted
    assert ids(htmltext.extracted(docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))), "page_id") == wanted


def test_other_columns_of_pipeline_stages(spark):
    docs = rows(spark)
    before = {repr(r[:1] + r[2:-1]) for r in docs.collect()}
    seen = language.identified(docs, None)
    assert {repr(r[:1] + r[2:6]) for r in seen.collect()} == before and seen.columns[-2:] == ["lang_pred", "score"]
    scanned = secrets.scanned(docs)
    assert {repr(r[:1] + r[2:6]) for r in scanned.collect()} == before


def test_letters_are_letters():
    assert not any(language.LETTER.search(x) for x in ("½", "²", "Ⅷ", "12_3")) and language.LETTER.search("é")


def test_pages_of_a_megabyte_take_linear_time():
    for page in ("<a " * 350_000, "<a \"" * 250_000, "<b>" * 300_000, "<p><b>" * 150_000, "</i>" * 200_000 + "<b>" * 100_000 + "</i>" * 100_000):
        began = time.time()
        htmltext.parse(page)
        assert time.time() - began < 20


def test_trees_prune_most_pairs():
    r = np.random.default_rng(1)
    base = r.integers(0, 4, (20, ngramjoin.GROUPS))
    x = np.repeat(base, 40, axis=0)
    x[np.arange(len(x)), r.integers(0, ngramjoin.GROUPS, len(x))] += 1
    n = x.sum(1)
    tree = ngramjoin.Tree(x.astype(np.int32), n, np.arange(len(x)))
    got = {(int(min(a, b)), int(max(a, b))) for i, j in tree.pairs(85) for a, b in zip(i, j, strict=True)}
    bound = np.minimum(x[:, None], x[None]).sum(2)
    i, j = np.nonzero(np.triu(185 * bound >= 85 * (n[:, None] + n[None]), 1) & (100 * np.minimum(n[:, None], n[None]) >= 85 * np.maximum(n[:, None], n[None])))
    assert set(zip(i.tolist(), j.tolist(), strict=True)) <= got
    assert tree.compared < 0.2 * len(x) * (len(x) - 1) / 2


def brute(texts, window):
    seen, out = set(), []
    for t in texts:
        words, gone = t.split(), set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        out.append(len(gone))
    return out


def test_index_compacts_and_is_opened_again(spark, tmp_path):
    r = np.random.default_rng(5)
    passages = [" ".join(map(str, r.integers(0, 50, 30))) for _ in range(6)]
    texts = [" ".join([" ".join(map(str, r.integers(0, 10**6, 15))), *(passages[k] for k in r.integers(0, 6, 2))]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in (1, 3, 6):
        got = {x.doc_id: x.n_removed for x in substrings.deduplicated(docs, n_batches=n).collect()}
        assert [got[i] for i in range(60)] == brute(texts, substrings.WINDOW)
    place, found, compactions = str(tmp_path / "index"), set(), 0
    for k in range(5):
        index = substrings.SubstringIndex(spark, place)  # opened anew for each batch
        batch = docs.filter(f"doc_id >= {12 * k} AND doc_id < {12 * k + 12}").select(F.col("doc_id").alias("d"), F.lit(0).cast("long").alias("r"), "text")
        found |= {x.d for x in index.add(batch).collect()}
        compactions += index.compactions
        assert len(index.runs) <= 2
    assert compactions == 3 and found == {i for i, n in enumerate(brute(texts, substrings.WINDOW)) if n}
