"""The Merkle manifest against a plain tree, and its parts."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tapework.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def brute(rows):
    def leaf(r, text):
        return H(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars")], field(text))

    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0), leaf(r, r["text"]), r))
    by = {s: sorted(v, key=lambda x: x[:2]) for s, v in by.items()}
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in by[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, digest, r) in enumerate(by[s]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            now, proof = leaf(r, text), []
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    first = at // 16 * 16
                    run, own = level[first : first + 16], at - first
                    proof += run[:own] + run[own + 1 :]
                    now, at = H(*run[:own], now, *run[own + 1 :]), at // 16
            out.append((r["doc_id"], digest, trees[s][-1][0], top[-1][0], H(*proof), now, now == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made(n_by_source):
    rows, k = [], 0
    for source, n in n_by_source:
        for _ in range(n):
            rows.append({"doc_id": k * 7 % 5000, "text": (None, "", "Abc ÄÖ", f"t{k} UP", "low")[k % 5], "lang": ("en", None)[k % 2], "source": source, "n_chars": (None, k)[k % 3 > 0]})
            k += 1
    return rows


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.withColumns({c: F.lit("z") for c in ("tree", "idx", "n", "leaf", "root", "block", "place", "digest", "other", "verified")})
    return sorted((tuple(r) for r in merkle.manifest(df, **more).collect()), key=repr)


def test_plain_tree(spark):
    rows = made([(None, 3), ("", 1), ("b", 17), ("hot", 600), ("ä", 16), ("z", 256), *((f"s{i}", 1 + i % 4) for i in range(20))])
    # Null ids, repeated ids and repeated rows, a very long text.
    rows += [dict(rows[5], doc_id=None), dict(rows[5], doc_id=None, text="X"), dict(rows[30]), dict(rows[30]), dict(rows[40], text="Long Text " * 50_000)]
    want = brute(rows)
    assert 0 < sum(not w[-1] for w in want) < len(want) / 4
    assert got(spark, rows) == want


@pytest.mark.parametrize("block", [1, 16, 37])
def test_blocks_that_end_anywhere(spark, block):
    rows = made([("a", 290), (None, 40), *((f"s{i}", 2) for i in range(18))])
    assert got(spark, rows, block=block) == brute(rows)


def test_few_rows(spark):
    one = made([("a", 1)])
    assert got(spark, one) == brute(one) and got(spark, one)[0][4] == H("")
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_asked_nodes_are_the_least(spark):
    """A block of 37 of 290 leaves asks for what stands beside it in the runs of its ends, and no node that it can derive."""
    df = spark.createDataFrame([("a", 290, i, f"{i:064x}") for i in range(290)], "tree string, n long, idx long, digest string")
    levels = merkle.grown(df)
    blocks = {r.block: {(x.level, x.idx) for x in r.fetched} for r in merkle.blocks_of(df, levels, 37).collect()}
    for b, asked in blocks.items():
        want, own = set(), set(range(37 * b, min(290, 37 * b + 37)))
        for level, count in enumerate((290, 19, 2)):
            runs = {i // 16 for i in own}
            want |= {(level, i) for r in runs for i in range(16 * r, min(count, 16 * r + 16)) if i not in own}
            own = runs
        assert asked == want and len(asked) <= 60
