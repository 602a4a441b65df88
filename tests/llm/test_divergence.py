"""The source divergence audit against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapework.llm import divergence

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=divergence.TOP):
    docs = [(lang or "", source or "", LETTERS.findall((text or "").translate(LOWER))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= least}
        v, sources = len(kept), {d[1] for d in mine}
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in sources}
        whole = sum(count.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (c.total() + 5 * v)
        for s in sources:
            pairs = [(o, sum(abs(share(count[s], t) - share(count[o], t)) for t in kept)) for o in sources - {s}]
            terms = [(t, share(count[s], t) - share(whole, t)) for t in count[s]]
            for part, items in (("pair", pairs), ("term", [x for x in terms if x[1] > 0])):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[: top if part == "term" else None], 1)]
    return sorted(out)


def made(spark, rows):
    # Columns that clash with those made on the way.
    df = spark.createDataFrame([(i, t, lang, s, 0) for i, (lang, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars int")
    return df.withColumns({c: F.lit("x") for c in ("n", "v", "term", "counts", "part", "item", "value", "rank", "slice", "start", "a", "b", "p", "x", "y")})


def got(df, **more):
    return sorted(tuple(r) for r in divergence.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Éa", "éa", "ÜBER", "über", "中文", "a b", "İ"]
    weights = 1 / np.arange(1, len(words) + 1)
    text = lambda: " ".join(r.choice(words, r.integers(0, 40), p=weights / weights.sum()))
    out = [(r.choice(["en", "de"]), f"s{r.integers(0, 7)}", text()) for _ in range(300)]
    # Nulls beside empties, a group without a kept term, a language that keeps none, a source alone, repeated rows, a long text.
    out += [(None, None, "waa wba"), ("", "", "waa"), (None, "s1", None), ("en", "bare", "zzzz 12 ..."), ("en", "bare2", None), ("fr", "s1", "un deux"), ("fr", "s2", "un"), ("fr", "s3", None), ("nl", "only", "een")]
    return out + [("de", "s1", "waa X9x9 wab")] * 40 + [("en", "s0", "waa wba-wca " * 30_000)]


def test_brute(spark, rows):
    df = made(spark, rows)
    for least in (1, 5, divergence.LEAST_DOCS):
        assert got(df, least=least) == brute(rows, least)
    assert got(df, least=5, top=3) == brute(rows, 5, 3)
    # Few sources to a task: their lots meet in pairs.
    assert got(df, least=5, room=2) == brute(rows, 5)


def test_flushed_counts(spark, rows, monkeypatch):
    few = rows[:60]

    class Dict(dict):
        pass

    frames = made(spark, few).select("lang", "source", F.coalesce("text", F.lit("")).cast("binary")).toArrow().to_batches()
    monkeypatch.setattr(divergence, "HELD", 10)
    batches = list(divergence._counted(iter(frames)))
    assert len(batches) > 5
    total = Counter()
    for b in batches:
        for lang, source, term, n, _ in zip(*[c.to_pylist() for c in b.columns], strict=True):
            total[lang, source, term.decode()] += n
    assert total == Counter((lang, source, t) for lang, source, text in few for t in LETTERS.findall(text.translate(LOWER)))


def test_empty_table(spark):
    assert got(made(spark, [("en", "s", "a")]).limit(0)) == []


def test_shares_are_exact(spark):
    big = [(10**17, 10**17, 3), (10**17 + 1, 3 * 10**17 + 7, 10**9), (0, 0, 1), (7, 13, 2)]
    df = spark.createDataFrame(big, "c long, n long, v long")
    assert [r[0] for r in df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()] == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in big]


def test_columns_are_run_length(spark, rows):
    terms = divergence.vocabulary(made(spark, rows), 1)
    kept = {r.lang: r.v for r in terms.groupBy("lang").agg(F.count("*").alias("v")).collect()}
    length, dense = Counter(), {}
    for r in divergence.columns(terms).collect():
        assert r.start[0] == 0 and r.start == sorted(set(r.start)) and r.start[-1] < r.length
        assert all(x != y for x, y in zip(r["count"], r["count"][1:], strict=False))
        if r.source is None:
            length[r.lang] += r.length
        else:
            runs = zip(r["count"], np.diff([*r.start, r.length]), strict=True)
            for c, n in runs:
                dense.setdefault((r.lang, r.source), Counter())[c] += int(n) if c else 0
    assert length == kept
    for (lang, source), counts in dense.items():
        want = Counter(t for lang2, s, text in rows if (lang2 or "", s or "") == (lang, source) for t in LETTERS.findall((text or "").translate(LOWER)))
        assert +counts == Counter(want.values())


def test_runs_meet():
    r = np.random.default_rng(1)
    for _ in range(50):
        size = int(r.integers(1, 40))
        x, y = r.integers(0, 3, size), r.integers(0, 3, size)
        a, b = (divergence.runs(np.flatnonzero(z), z[z > 0], size) for z in (x, y))
        assert divergence.met(*a, *b, size) == np.abs(x - y).sum()
