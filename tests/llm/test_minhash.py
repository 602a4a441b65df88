"""Near duplicates by MinHash against all pairs, and components by alternating stars."""

import numpy as np
from pyspark.sql import functions as F

from tapework.llm import minhash
from tapework.llm.graph import star_components


def sets_of(text, k):
    words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\t", " ").replace("\n", " ").split(" ") if text else []
    words = [w for w in words if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def roots(edges, nodes):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, k=3, percent=85):
    sets = [(i, sets_of(t, k)) for i, t in rows]
    some = [(i, s) for i, s in sets if s and i is not None]
    edges = [(a, b) for x, (a, p) in enumerate(some) for b, q in some[x + 1 :] if p & q and 100 * len(p & q) >= percent * len(p | q)]
    label = roots(edges, {i for i, _ in sets if i is not None})
    return sorted(((i, len(s), label.get(i), i is None or label[i] == i) for i, s in sets), key=repr)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit("z") for c in ("n", "rep", "key", "a", "b", "sig1", "component", "kept", "component_id")})
    return sorted((tuple(r) for r in minhash.near_duplicates(df, **more).collect()), key=repr)


def family(r, size, words, edits):
    base = [f"w{x}" for x in r.integers(0, 10**6, words)]
    for _ in range(size):
        own = list(base)
        for at in r.integers(0, words, r.integers(0, edits + 1)):
            own[at] = f"e{r.integers(0, 10**6)}"
        yield " ".join(own)


def test_all_pairs(spark):
    r = np.random.default_rng(11)
    texts = [t for words, edits in ((40, 2), (120, 5), (300, 14), (60, 6)) for t in family(r, 40, words, edits)]
    texts += [None, None, "", " \t\n", "One", "one", "one two", "ONE  two", "one two three", "one two three four", "a b c " * 40_000]
    ids = r.permutation(len(texts)).tolist()
    rows = list(zip(ids, texts, strict=True))
    want = brute(rows)
    assert got(spark, rows) == want
    # Blocks that no task may hold whole are cut; nothing is lost.
    assert got(spark, rows, block=6) == want
    assert len({c for _, _, c, _ in want}) < len(rows) - 50


def test_odd_ids(spark):
    base = " ".join(map(str, range(50)))
    rows = [(None, base), (None, base), (7, base), (7, base), (5, base + " 50"), (2**60 + 1, base), (9, "x y z"), (9, base), (4, "x y z"), (3, None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(7, base)])[0][2] == 7
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).isEmpty()


def test_signature_bounds():
    assert 70 < minhash.least_matches() < 90
    r = np.random.default_rng(2)
    x = r.integers(0, 2**63, 2000).astype(np.uint64)
    rows = minhash.minima([x[:1850], x[150:]])
    assert abs((rows[0] == rows[1]).mean() - 1700 / 2000) < 0.12
    keys = minhash.bands(rows)
    same = (rows[0] == rows[1]).reshape(minhash.BANDS, minhash.ROWS).all(1)
    assert ((keys[0] == keys[1]) == same).all() and same.any()
    assert len(set(keys.ravel().tolist())) == 2 * minhash.BANDS - int(same.sum())


def test_a_pair_is_listed_in_its_first_band():
    r = np.random.default_rng(8)
    x = r.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(np.delete(x, r.integers(0, 400, 8))) for _ in range(12)]
    rows = minhash.minima(sets)
    keys = minhash.bands(rows).view(np.int64)
    head = np.hstack([(rows & 255).astype(np.uint8), minhash.short(keys).view(np.uint8).reshape(-1, 4 * minhash.BANDS)])
    points = [h.tobytes() + minhash.fine_point(s) for h, s in zip(head, sets, strict=True)]
    seen = []
    for key in np.unique(keys):
        at = np.flatnonzero((keys == key).any(1))
        for i, j in minhash.signature_pairs([points[k] for k in at], np.array([len(sets[k]) for k in at]), at, None, int(key)):
            seen += [tuple(sorted(p)) for p in zip(at[i].tolist(), at[j].tolist(), strict=True)]
    assert sorted(seen) == [(a, b) for a in range(12) for b in range(a + 1, 12) if (keys[a] == keys[b]).any()]


def test_stars(spark):
    r = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(a, b) for a, b in r.integers(200, 320, (70, 2)).tolist()] + [(400, 400), (500, 501), (501, 500)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = roots(edges, {x for a, b in edges if a != b for x in (a, b)} | {400})
    del want[400]
    assert {r.node: r.component for r in star_components(df).collect()} == want
    assert star_components(df.limit(0)).isEmpty()
