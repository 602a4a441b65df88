"""N-gram Jaccard join with count vectors in R-trees.

A document is the set of its word shingles. Shingles are hashed into groups; the counts by group make the document a point.
The sum of two points' smaller coordinates bounds the sets' overlap from above. Points are dealt over machines by necessary
shingles: any linked pair shares one of the first shingles of either, in order of rarity, so frequent passages deal next to nothing.
The points of a block stand in an R-tree that is joined with itself: pairs of subtrees whose bound is too small, or which are one
component already, are passed over; the pairs that survive are verified on the sets.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import FEW_TEXTS, forget, made_from, partitions, setting, stored
from tapework.llm.fullsets import confirmed, shingle_sets
from tapework.llm.graph import components
from tapework.llm.wordhash import Words, batches, mix

SHINGLE = 4
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Groups of the points that are indexed: a fixed number, as a point travels with each of its keys.
GROUPS = 128
#: Counters of shingles in the corpus: a shingle is as frequent as all that share its counter, and rare ones come first. A counter serves about so many
#: shingles, until there are as many counters as the table, a byte each, may have; a larger corpus then tells rare from frequent less finely.
PER_COUNTER, MOST_COUNTERS, SLICE = 64, 1 << 22, 1 << 12
#: Points of a leaf; points of a block that one task joins, beyond which blocks are cut.
LEAF, BLOCK = 8, 4_000
#: Of a block's points, sizes, components, sides (or None) and key, the pairs of rows that may be linked.
PairFinder = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray | None, int], Iterator[tuple[np.ndarray, np.ndarray]]]
#: Heads of blocks that a set is compared with before blocks are searched; what they leave unlinked, the search finds.
HEADS = 2


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many of a set's first shingles that any set linked with it holds one of them, in whatever order all sets share."""
    return n - -(-percent * n // 100) + 1


def _group(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) >> np.uint64(24)).astype(np.int64)


def point(shingles: np.ndarray) -> bytes:
    """Counts of a set's shingles by group, of one byte each, or of more where a count needs them."""
    counts = np.bincount(_group(shingles) % GROUPS, minlength=GROUPS)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint16 if counts.max() < 65536 else np.uint32).tobytes()


def fine_point(shingles: np.ndarray) -> bytes:
    """Counts by at least as many groups as there are shingles, four bits each. The number of groups is a power of two; halves add up to fewer groups."""
    group, groups = _group(shingles), 16
    while groups < len(shingles):
        groups *= 2
    while (counts := np.bincount(group % groups, minlength=groups)).max() > 15:
        groups *= 2
    counts = counts.astype(np.uint8)
    return (counts[: groups // 2] | counts[groups // 2 :] << 4).tobytes()


def unpacked(points: list[bytes]) -> np.ndarray:
    """Points as rows of a matrix."""
    if all(len(p) == GROUPS for p in points):
        return np.frombuffer(b"".join(points), np.uint8).reshape(-1, GROUPS).astype(np.int32)
    kinds = {GROUPS: np.uint8, 2 * GROUPS: np.uint16, 4 * GROUPS: np.uint32}
    return np.array([np.frombuffer(p, kinds[len(p)]).astype(np.int32) for p in points])


def overlap_bound(x: bytes, y: bytes) -> int:
    """The summed minima of two fine points; the finer one is folded to the other's groups."""
    p, q = (np.frombuffer(z, np.uint8) for z in (x, y))
    p, q = (np.concatenate([z & 15, z >> 4]) for z in (p, q))
    if len(p) > len(q):
        p, q = q, p
    return int(np.minimum(p, q.reshape(-1, len(p)).sum(0, dtype=np.int32)).sum())


def _counter(shingles: np.ndarray, counters: int) -> np.ndarray:
    return (shingles >> np.uint64(65 - counters.bit_length())).astype(np.int64)  # the first bits, of a power of two of counters


def rarity(docs: DataFrame, k: int = SHINGLE) -> np.ndarray:
    """For each counter, how often its shingles occur in all texts, as a power of two of the mean; 0 up to twice the mean. All texts are counted."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counters = SLICE
    while counters < MOST_COUNTERS and counters * PER_COUNTER * 6 < size:
        counters *= 2

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(counters, np.int64)
        for frame in frames:
            for _, group in batches(frame.column(0).to_pylist()):
                words = Words(group, lower=True)
                runs = words.runs(k)
                seen += np.bincount(_counter(runs[words.whole(k)], counters), minlength=counters)
        parts = seen.reshape(-1, SLICE)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([zlib.compress(parts[i].astype(np.uint32).tobytes(), 1) for i in some], pa.binary())], names=["slice", "counts"])

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for i, part in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                sums.setdefault(i, np.zeros(SLICE, np.int64))
                sums[i] += np.frombuffer(zlib.decompress(part), np.uint32)
        # An eighth of a power of two is fine enough, and a byte each is all that reaches the driver.
        logs = [np.round(8 * np.log2(np.maximum(x, 1))).clip(0, 255).astype(np.uint8).tobytes() for x in sums.values()]
        total = [int(x.sum()) for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(logs, pa.binary()), pa.array(total, pa.int64())], names=["slice", "logs", "total"])

    rows = docs.select("text").mapInArrow(count, "slice long, counts binary").repartition(partitions(docs.sparkSession), "slice").mapInArrow(add, "slice long, logs binary, total long").collect()  # MOST_COUNTERS bytes
    logs = np.zeros(counters, np.float64)
    for row in rows:
        logs[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["logs"], np.uint8) / 8
    mean = max(sum(r["total"] for r in rows) / counters, 1.0)
    return np.floor((logs - np.log2(mean)).clip(0)).astype(np.uint8)


def prints(docs: DataFrame, often: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, sig1, sig2 (hashes of the whole set), prefix (its rarest shingles), point and fine (its counts by group)."""

    def make(texts: list[str | None]) -> dict[str, pa.Array]:
        n, sig1, sig2, prefix, points, fine = [], [], [], [], [], []
        for _, group in batches(texts):
            for s in shingle_sets(group, SHINGLE):
                n.append(len(s))
                sig1.append(np.bitwise_xor.reduce(mix(s)) if len(s) else 0)
                sig2.append(np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) if len(s) else 0)
                rank = often[_counter(s, len(often))]
                first = s[np.argsort(rank, kind="stable")] if rank.any() else s
                prefix.append(first[: prefix_length(len(s), percent)] if len(s) else first)
                points.append(point(s))
                fine.append(fine_point(s))
        offsets = np.zeros(len(prefix) + 1, np.int32)
        np.cumsum([len(p) for p in prefix], out=offsets[1:])
        values = np.concatenate(prefix).view(np.int64) if prefix else np.zeros(0, np.int64)
        whole = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return {"n": pa.array(n, pa.int64()), "sig1": whole(sig1), "sig2": whole(sig2), "prefix": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), "point": pa.array(points, pa.binary()), "fine": pa.array(fine, pa.binary())}

    return made_from(docs.select(F.col("doc_id").cast("long"), "text"), "text", make, "n long, sig1 long, sig2 long, prefix array<long>, point binary, fine binary", keep=["doc_id"])


class Tree:
    """An R-tree over points, packed by median splits: boxes by node, and the component if all points below share one.

    compared counts the pairs of points that its joins have looked at one by one.
    """

    def __init__(self, x: np.ndarray, n: np.ndarray, component: np.ndarray, leaf: int = LEAF):
        self.x, self.n, self.component, self.leaf, self.compared = x, n, component, leaf, 0
        self.nodes: list[tuple] = []  # (rows, children, top corner, least n, most n, component or None)
        self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray) -> int:
        one = self.component[rows[0]] if (self.component[rows] == self.component[rows[0]]).all() else None
        at, n, top = len(self.nodes), self.n[rows], self.x[rows].max(0)
        self.nodes.append((rows, (), top, int(n.min()), int(n.max()), one))
        if len(rows) > self.leaf:
            spread = top - self.x[rows].min(0)
            # The set's size is a coordinate too: it is the one that varies most between unlike documents.
            key = n if np.ptp(n) > 4 * spread.max() else self.x[rows, int(spread.argmax())]
            order = rows[np.argsort(key, kind="stable")]
            half = len(order) // 2
            children = (self._build(order[:half]), self._build(order[half:]))
            self.nodes[at] = (rows, children, *self.nodes[at][2:])
        return at

    def pairs(self, percent: int, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (i, j) of different components whose bound allows a link; with side, only pairs across the two sides."""
        todo = [(0, 0)]
        while todo:
            a, b = todo.pop()
            rows_a, below_a, top_a, least_a, most_a, one_a = self.nodes[a]
            rows_b, below_b, top_b, least_b, most_b, one_b = self.nodes[b]
            if one_a is not None and one_a == one_b:
                continue
            if 100 * min(most_a, most_b) < percent * max(least_a, least_b):
                continue
            if (100 + percent) * int(np.minimum(top_a, top_b).sum()) < percent * (least_a + least_b):
                continue
            if below_a and (not below_b or len(rows_a) >= len(rows_b)):
                todo += [(below_a[0], below_a[0]), (below_a[0], below_a[1]), (below_a[1], below_a[1])] if a == b else [(c, b) for c in below_a]
            elif below_b:
                todo += [(a, c) for c in below_b]
            else:
                self.compared += len(rows_a) * len(rows_b) if a != b else len(rows_a) * (len(rows_a) - 1) // 2
                bound = np.minimum(self.x[rows_a][:, None, :], self.x[rows_b][None, :, :]).sum(2, dtype=np.int64)
                ok = (100 + percent) * bound >= percent * (self.n[rows_a][:, None] + self.n[rows_b][None, :])
                ok &= self.component[rows_a][:, None] != self.component[rows_b][None, :]
                if a == b:
                    ok &= rows_a[:, None] < rows_b[None, :]
                if side is not None:
                    ok &= side[rows_a][:, None] != side[rows_b][None, :]
                i, j = np.nonzero(ok)
                if len(i):
                    yield rows_a[i], rows_b[j]


def blocks(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """key, rep of the sets (rep, n, prefix) that share a key with another of a like size. Blocks are read as they come and never held."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: key, n, rep, and whether the row before it is near
        for frame in itertools.chain(frames, [None]):
            if frame is None:
                if held is not None and held[3]:
                    yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[2]])], names=["key", "rep"])
                return
            key, n, rep = (frame.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            if held is not None:
                key, n, rep = (np.r_[h, x] for h, x in zip(held[:3], (key, n, rep), strict=True))
            near = (key[1:] == key[:-1]) & (100 * n[:-1] >= percent * n[1:])
            before = np.r_[held[3] if held is not None else False, near]
            keep = np.flatnonzero(before[:-1] | near)
            held = (key[-1], n[-1], rep[-1], bool(before[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(rep[keep])], names=["key", "rep"])

    keys = classes.select(F.explode("prefix").alias("key"), "n", "rep")
    dealt = keys.repartition(partitions(keys.sparkSession), "key").sortWithinPartitions("key", "n", "rep")
    return dealt.mapInArrow(run, "key long, rep long")


def stars(members: DataFrame, classes: DataFrame, heads: int = HEADS) -> DataFrame:
    """a, b: each set b against the few pivots that it shares most keys with. A block's pivot is the set that shares the largest part of its keys with others.

    The text that a family was copied from shares nearly all its keys; a copy has keys of its own where it was changed.
    """
    share = members.groupBy("rep").agg(F.count(F.lit(1)).alias("k")).join(classes.select("rep", F.size("prefix").alias("of")), "rep")
    share = share.groupBy("rep").agg(F.max(F.col("k") / F.col("of")).alias("share"))
    order = F.struct("share", (-F.col("rep")).alias("low"))
    pivots = members.join(share, "rep").groupBy("key").agg(F.max(order).alias("p")).select("key", (-F.col("p.low")).alias("pivot"))
    shared = members.join(pivots, "key").filter("rep <> pivot").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("k"))
    best = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("k", (-F.col("pivot")).alias("low"))), asc=False).alias("pivots"))
    return best.select(F.explode(F.transform(F.slice("pivots", 1, heads), lambda h: -h["low"])).alias("a"), F.col("rep").alias("b"))


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose fine points allow a link."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [(100 + percent) * overlap_bound(x, y) >= percent * n for x, y, n in zip(frame["x"], frame["y"], frame["n"], strict=True)]
            yield frame.loc[keep, ["a", "b"]]

    sizes = lambda k: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"))
    fine = lambda k, x: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("fine").alias(x))
    like = f"100 * na >= {percent} * nb AND 100 * nb >= {percent} * na"
    # Sizes first: points travel only with pairs of a like size.
    sized = pairs.join(sizes("a"), "a").join(sizes("b"), "b").filter(like).select("a", "b").distinct()
    both = sized.join(fine("a", "x"), "a").join(fine("b", "y"), "b").filter(like)
    return both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "x", "y").mapInPandas(run, "a long, b long").distinct()


def gathered(lots: Iterator[tuple[np.ndarray, ...]], most: int = 500_000) -> Iterator[tuple[np.ndarray, ...]]:
    """The same rows in larger lots, of `most` at least but for the last."""
    held, size = [], 0
    for lot in lots:
        held.append(lot)
        size += len(lot[0])
        if size >= most:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def tree_pairs(percent: int) -> PairFinder:
    return lambda points, n, component, side, _: gathered(Tree(unpacked(points), n, component).pairs(percent, side))


def block_pairs(members: DataFrame, points: DataFrame, block: int, finder: PairFinder) -> DataFrame:
    """a, b: distinct pairs of different components that finder lets through, of members (key, rep, component). finder gets a block's points, sizes, components,
    sides where only pairs across two sides count, and its key; it yields pairs of rows.

    A block that is too large for a task is cut. Its largest component needs no comparison with itself: its parts each meet the parts of the rest, and only the
    rest's parts meet one another.
    """
    by = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = by.groupBy("key").agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main"))
    parts = lambda n: F.ceil(n / block).cast("int")
    small = F.col("n") <= block
    sizes = sizes.filter("components > 1").select("key", F.when(~small, F.col("main")).alias("main"), F.when(small, 1).otherwise(parts(F.col("most"))).alias("mains"), F.when(small, 1).otherwise(parts(F.col("n") - F.col("most"))).alias("others"), small.alias("small"))
    placed = members.join(sizes, "key").withColumn("is_main", F.col("component").eqNullSafe(F.col("main")))
    h = F.xxhash64("rep")
    own = F.when(F.col("is_main"), F.pmod(h, F.col("mains"))).otherwise(F.pmod(h, F.col("others"))).cast("int")
    room = lambda kind, p, q, side, cross: F.struct(F.lit(kind).alias("kind"), p.cast("int").alias("p"), q.cast("int").alias("q"), side.cast("int").alias("side"), cross.alias("cross"))
    zero, each = F.lit(0), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    main_rooms = F.transform(each("others"), lambda p: room(1, p, own, zero, F.lit(True)))
    rest_rooms = F.concat(
        F.transform(each("mains"), lambda q: room(1, own, q, F.lit(1), F.lit(True))),
        F.transform(each("others"), lambda q: room(2, F.least(own, q), F.greatest(own, q), own, own != q)),
    )
    rooms = F.when(F.col("small"), F.array(room(0, zero, zero, zero, F.lit(False)))).when(F.col("is_main"), main_rooms).otherwise(rest_rooms)
    cut = placed.select("key", "rep", "component", F.explode(rooms).alias("r")).select("key", "r.*", "rep", "component")
    names = ["key", "kind", "p", "q"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by block; the last block of a frame may go on in the next.
        rest = None
        for frame in itertools.chain(frames, [None]):
            last = frame is None
            frame = pd.concat([x for x in (rest, frame) if x is not None], ignore_index=True) if rest is not None or not last else None
            if frame is None or not len(frame):
                continue
            key = frame[names].to_numpy()
            starts = [*np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]), len(key)]
            columns = [frame[c].to_numpy() for c in ("rep", "n", "component", "side", "cross", "point")]
            found = []
            for a, b in itertools.pairwise(starts if last else starts[:-1]):
                if b - a > 1:
                    rep, n, component, side, cross, x = (c[a:b] for c in columns)
                    for i, j in finder(list(x), n, component, side if cross.any() else None, int(key[a][0])):
                        found.append((np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])))
            if found:
                yield pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])}).drop_duplicates()
            rest = None if last else frame.iloc[starts[-2] :]

    dealt = cut.join(points.select("rep", "n", "point"), "rep").repartition(partitions(cut.sparkSession), *names).sortWithinPartitions(*names)
    # A room in which every pair counts may hold rows of both kinds: side tells them apart only where cross is set.
    return dealt.select(*names, "rep", "n", "component", "side", "cross", "point").mapInPandas(run, "a long, b long").filter("a <> b").distinct()


def repeated_ids(marks: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: links that make one node of the sets of a doc_id that stands in several rows: to the classes' heads."""
    sig = F.struct("sig1", "sig2", "n")
    some = marks.filter("n > 0 AND doc_id IS NOT NULL")
    many = some.groupBy("doc_id").agg(F.min(sig).alias("low"), F.max(sig).alias("high")).filter("low <> high").select(F.col("doc_id").alias("a"))
    return some.join(many, F.col("doc_id") == F.col("a")).join(classes.select("sig1", "sig2", "n", "rep"), ["sig1", "sig2", "n"]).select("a", F.col("rep").alias("b")).filter("a <> b").distinct()


def linked(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) of every row of docs (doc_id, text).

    Null, empty and wordless texts have an empty set and link with nothing; a null doc_id has a null component. Rows with the same set collapse before
    anything is paired. Rows that repeat a doc_id are one node, whose sets all count. Other columns are ignored and an empty table gives none.
    """
    with setting(docs.sparkSession, FEW_TEXTS):
        marks = stored(prints(docs, rarity(docs), percent))
    sig = ["sig1", "sig2", "n"]
    some = marks.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(some.groupBy(*sig).agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("point").alias("point"), F.first("fine").alias("fine")))
    points = classes.select("rep", "n", "point")
    members = stored(blocks(classes, percent))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    # First every set against a few pivots: families of near copies become components in linear time.
    tried = stored(_bounded(stars(members, classes), classes, percent))
    links = confirmed(tried, texts, percent, SHINGLE)
    # Then, in blocks that still hold several components, the trees' pairs across them.
    found = components(links)
    known = points.select("rep").distinct().join(found, F.col("rep") == found["node"], "left").select("rep", F.coalesce("component", "rep").alias("component"))
    labelled = members.join(known, "rep")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    dealt = stored(labelled.join(mixed, "key"))
    sides = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(_bounded(block_pairs(dealt, points, block, tree_pairs(percent)).join(sides, ["a", "b"], "left_anti"), classes, percent))
    forget(members, tried, found, dealt)
    links = links.unionByName(confirmed(more, texts, percent, SHINGLE)).unionByName(repeated_ids(marks, classes))
    final = components(links)
    named = classes.select(*sig, "rep").join(final, F.col("rep") == final["node"], "left").select(*sig, F.coalesce("component", "rep").alias("component_id"))
    result = marks.select("doc_id", *sig).join(named, sig, "left")
    result = stored(result.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
    forget(marks, classes, final)
    return result


def join_sql(k: int, percent: int) -> str:
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
meets AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, min(a.n) AS na, min(b.n) AS nb
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM meets WHERE 100 * k >= {percent} * (na + nb - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT reach.node, edges.b FROM reach JOIN edges ON edges.a = reach.other)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(sets.doc_id, coalesce(m, sets.doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT node, min(other) AS m FROM reach GROUP BY node) AS r ON r.node = sets.doc_id
"""


JOIN_SQL = join_sql(SHINGLE, PERCENT)
