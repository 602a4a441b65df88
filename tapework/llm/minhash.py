"""Near duplicates by MinHash: minima of universal hashes, banding, verified signatures, full sets, and components by alternating stars.

Documents with equal sets are one class. Classes that share a band meet. First each is compared with the pivots of its bands only, so that a family of copies becomes
one component by as many pairs as it has members; then, where a band still holds several components, all pairs across them. A pair is compared by signature
first, then by counts that bound the overlap; what neither can rule out is confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import FEW_TEXTS, forget, made_from, setting, stored
from tapework.llm.fullsets import confirmed, shingle_sets
from tapework.llm.graph import star_components
from tapework.llm.ngramjoin import BLOCK, block_pairs, blocks, fine_point, join_sql, overlap_bound, repeated_ids, stars
from tapework.llm.wordhash import batches, mix

#: Words of a shingle; linked: 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 3, 85
#: Minima of a signature in bands of ROWS. Two sets at the least linked similarity share no band once in about 10**10 such pairs.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Bytes of a point before its counts: minima and keys.
HEAD = HASHES + 4 * BANDS
#: The share of pairs at the least linked similarity that the signature may rule out.
MISS = 1e-10

_R = np.random.Generator(np.random.PCG64(7_031_997))
#: Universal hashes h(x) = ((a * x + b) mod 2**64) >> 32, with odd a, of shingle hashes x.
A, B = _R.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1), _R.integers(0, 2**64, HASHES, dtype=np.uint64)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> int:
    """So many of a signature's minima at least agree for two linked sets, but for a share of `miss` of them."""
    p, total = percent / 100, 0.0
    for k in range(HASHES + 1):
        total += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if total > miss:
            return k
    return HASHES


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima for each set; sets are not empty."""
    flat, out = np.concatenate(sets), np.empty((len(sets), HASHES), np.uint32)
    start = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat((flat * A[i] + B[i]) >> np.uint64(32), start)
    return out


def bands(rows: np.ndarray) -> np.ndarray:
    """The key of each band of each row of minima."""
    key = np.arange(BANDS, dtype=np.uint64) + np.zeros((len(rows), 1), np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k::ROWS])
    return key


def short(keys: np.ndarray) -> np.ndarray:
    """Half of a band's key, by which rows of one task tell which bands they share."""
    return (keys.view(np.uint64) >> np.uint64(32)).astype(np.uint32)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), sig1 and sig2 (hashes of the whole set), prefix (keys of its bands) and point.

    A point is the last byte of each minimum, half of each band's key, and the set's counts by group, whose summed minima bound an overlap from above.
    """

    def make(texts: list[str | None]) -> dict[str, pa.Array]:
        n, sigs, keys, points = [], [[], []], [], []
        for _, group in batches(texts, 200_000):
            sets = list(shingle_sets(group, SHINGLE))
            some = [s for s in sets if len(s)]
            rows = minima(some) if some else np.empty((0, HASHES), np.uint32)
            key, at = bands(rows).view(np.int64), 0
            head = np.hstack([(rows & 255).astype(np.uint8), short(key).view(np.uint8).reshape(-1, 4 * BANDS)])
            for s in sets:
                n.append(len(s))
                for sig, salt in zip(sigs, (0, 0x5851F42D4C957F2D), strict=True):
                    sig.append(np.bitwise_xor.reduce(mix(s ^ np.uint64(salt))) if len(s) else np.uint64(0))
                keys.append(key[at] if len(s) else key[:0].reshape(-1))
                points.append(head[at].tobytes() + fine_point(s) if len(s) else b"")
                at += len(s) > 0
        offsets = np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)
        values = np.concatenate(keys) if keys else np.empty(0, np.int64)
        whole = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return {"n": pa.array(n, pa.int64()), "sig1": whole(sigs[0]), "sig2": whole(sigs[1]), "prefix": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), "point": pa.array(points, pa.binary())}

    return made_from(docs.select(F.col("doc_id").cast("long"), "text"), "text", make, "n long, sig1 long, sig2 long, prefix array<long>, point binary", keep=["doc_id"])


def heads(points: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of points, the bytes of their minima and the halves of their bands' keys."""
    head = np.frombuffer(b"".join([p[:HEAD] for p in points]), np.uint8).reshape(-1, HEAD)
    return head[:, :HASHES], np.ascontiguousarray(head[:, HASHES:]).view(np.uint32)


def may_link(x: bytes, y: bytes, n: int, percent: int) -> bool:
    """Whether the counts of two points allow a link; n: the sum of their sets' sizes."""
    return (100 + percent) * overlap_bound(x[HEAD:], y[HEAD:]) >= percent * n


def alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes, signatures and counts allow a link."""
    least = least_matches(percent)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                f = f[(heads(list(f["x"]))[0] == heads(list(f["y"]))[0]).sum(1) >= least]
                f = f[[may_link(x, y, n, percent) for x, y, n in zip(f["x"], f["y"], f["n"], strict=True)]]
            yield f[["a", "b"]]

    of = lambda k, x: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("point").alias(x))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").filter(f"100 * na >= {percent} * nb AND 100 * nb >= {percent} * na")
    return both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "x", "y").mapInPandas(run, "a long, b long")


def signature_pairs(points: list[bytes], n: np.ndarray, component: np.ndarray, side: np.ndarray | None, key: int, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one block, of different components and like sizes, whose signatures and counts allow a link; with side, only those across the two sides.

    A pair that shares several bands is listed in the block of the first of them.
    """
    least, own = least_matches(percent), short(np.array([key], np.int64))[0]
    by = np.argsort(n, kind="stable")
    points, n, component = [points[i] for i in by], n[by], component[by]
    side = None if side is None else side[by]
    x, keys = heads(points)
    # Sizes ascend: a row meets those behind it up to the largest size that it can be linked with.
    end = np.searchsorted(n, 100 * n // percent, "right")
    for i in range(len(n) - 1):
        if end[i] <= i + 1:
            continue
        later = np.arange(i + 1, end[i])
        later = later[component[later] != component[i]]
        if side is not None:
            later = later[side[later] != side[i]]
        later = later[keys[i][(keys[later] == keys[i]).argmax(1)] == own]
        later = later[(x[later] == x[i]).sum(1) >= least]
        later = np.array([j for j in later if may_link(points[i], points[j], int(n[i] + n[j]), percent)], np.int64)
        if len(later):
            yield by[np.full(len(later), i)], by[later]


def near_duplicates(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) and kept of every row of docs (doc_id, text).

    Null, empty and wordless texts have an empty set, link with nothing and are kept. A null doc_id has a null component and is kept. Rows with the same set collapse before anything is
    paired; rows that repeat a doc_id are one node, whose sets all count. Other columns are ignored and an empty table gives none.
    """
    with setting(docs.sparkSession, FEW_TEXTS):
        marks = stored(signed(docs))
    sig = ["sig1", "sig2", "n"]
    classes = stored(marks.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*sig).agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("point").alias("point")))
    members = stored(blocks(classes, percent))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    tried = stored(alike(stars(members, classes), classes, percent))
    links = confirmed(tried, texts, percent, SHINGLE)
    found = star_components(links)
    labelled = members.join(found, F.col("rep") == found["node"], "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    dealt = stored(labelled.join(mixed, "key"))
    sides = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = block_pairs(dealt, classes.select("rep", "n", "point"), block, lambda *x: signature_pairs(*x, percent=percent))
    more = stored(across.join(sides, ["a", "b"], "left_anti"))
    forget(members, tried, found, dealt)
    rest = confirmed(more, texts, percent, SHINGLE)
    final = star_components(links.unionByName(rest).unionByName(repeated_ids(marks, classes)))
    forget(more, links, rest)
    named = classes.select(*sig, "rep").join(final, F.col("rep") == final["node"], "left").select(*sig, F.coalesce("component", "rep").alias("c"))
    result = marks.select("doc_id", *sig).join(named, sig, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    result = stored(result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")))
    forget(marks, classes, final)
    return result


NEAR_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({join_sql(SHINGLE, PERCENT)})"
