"""A Merkle manifest of a dataset, and a proof for every row by octopus multiproofs.

Rows are leaves of one tree for each source, whose roots are the leaves of a tree over sources. A block of neighbouring leaves asks for the
least set of nodes that it cannot derive: at each level the siblings of its leaves' ancestors, but for those ancestors themselves. They are fetched once
for the block; interiors that its leaves share are derived from them, and each leaf's own proof is then read off locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.llm.common import ascii_lower, forget, partitions, stored

#: Children of a node; leaves of a block, which one task holds at a time.
FANOUT, BLOCK = 16, 4096
HEX = 64
STEP = "array<struct<before:string,after:string>>"
NODE = "array<struct<level:int,idx:bigint,digest:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """A row's digest: of doc_id, source, lang, n_chars and text, each behind its length."""
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)).cast("binary"), 256)


def placed(df: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """df with idx, each row's place in its tree from 0 on, and n, the tree's rows; and the stored table that this reads.

    Rows are dealt in ranges, so a tree may span many tasks; a place is that in the task and the number of rows before the task, of which there is one for each tree and task.
    """
    keys = [F.col(k).asc_nulls_first() for k in ("tree", *order)]
    laid = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()))
    part, own = F.shiftright("place", 33), W.partitionBy("tree")
    runs = laid.groupBy("tree", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(own.orderBy("part")) - F.col("rows")
    runs = runs.select(F.col("tree").alias("t"), F.col("part").alias("p"), "first", before.alias("before"), F.sum("rows").over(own).alias("n"))
    both = laid.join(runs, laid["tree"].eqNullSafe(F.col("t")) & (part == F.col("p")))
    return both.select(*df.columns, (F.col("place") - F.col("first") + F.col("before")).alias("idx"), "n"), laid


def grown(leaves: DataFrame) -> list[DataFrame]:
    """Stored levels above the leaves (tree, n, idx, digest), from the lowest on: tree, n, level, idx, digest. A tree ends at its root."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, below = [], leaves
    while most > FANOUT ** len(levels):
        kids = F.sort_array(F.collect_list(F.struct("idx", "digest")))  # of one run: FANOUT at most
        up = below.filter(F.col("n") > FANOUT ** len(levels)).groupBy("tree", "n", F.expr(f"idx div {FANOUT}").alias("up")).agg(kids.alias("kids"))
        digest = F.sha2(F.concat_ws("", F.col("kids.digest")).cast("binary"), 256)
        below = stored(up.select("tree", "n", F.lit(len(levels) + 1).alias("level"), F.col("up").alias("idx"), digest.alias("digest")))
        levels.append(below)
    return levels


def _missing(height: int) -> Column:
    """Of a block (lo to hi of a tree of n leaves): level and idx of the nodes that its leaves' proofs need and that cannot be derived from its leaves and from others of these."""
    lots = [F.array().cast("array<struct<level:int,idx:bigint>>")]
    for level in range(height):
        w = FANOUT**level
        a, z, count = f"(lo div {w})", f"((hi - 1) div {w})", f"((n + {w - 1}) div {w})"
        s, e = f"({a} - {a} % {FANOUT})", f"least({count}, {z} - {z} % {FANOUT} + {FANOUT})"
        span = lambda x, y: f"if({x} < {y}, sequence({x}, {y} - 1), cast(array() as array<bigint>))"
        lots.append(F.expr(f"transform(if(n > {w}, concat({span(s, a)}, {span(f'{z} + 1', e)}), cast(array() as array<bigint>)), i -> struct({level} as level, i as idx))"))
    return F.concat(*lots)


def blocks_of(leaves: DataFrame, levels: list[DataFrame], block: int = BLOCK) -> DataFrame:
    """tree, n, block and fetched (level, idx, digest of its missing nodes, a few for each level), a row for each block of neighbouring leaves."""
    found = leaves.groupBy("tree", "n", F.expr(f"idx div {block}").alias("block")).agg(F.min("idx").alias("lo"), (F.max("idx") + 1).alias("hi"))
    asked = found.select("tree", "block", F.explode(_missing(len(levels))).alias("m")).select(F.col("tree").alias("t"), "block", F.col("m.level").alias("l"), F.col("m.idx").alias("i"))
    low = 0
    while block % FANOUT ** (low + 1) == 0:
        low += 1  # no block begins or ends inside a node of this level
    nodes = [leaves.select("tree", F.lit(0).alias("level"), "idx", "digest")] if low == 0 else []
    nodes += [x.select("tree", "level", "idx", "digest") for x in levels[max(low - 1, 0) :]]
    if not nodes:
        return found.select("tree", "n", "block", F.array().cast(NODE).alias("fetched"))
    every = nodes[0]
    for x in nodes[1:]:
        every = every.unionByName(x)
    got = every.join(asked, every["tree"].eqNullSafe(F.col("t")) & (every["level"] == F.col("l")) & (every["idx"] == F.col("i")))
    got = got.groupBy("t", F.col("block").alias("b")).agg(F.collect_list(F.struct("level", "idx", "digest")).alias("got"))
    return found.join(got, found["tree"].eqNullSafe(got["t"]) & (found["block"] == got["b"]), "left").select("tree", "n", "block", F.coalesce("got", F.array().cast(NODE)).alias("fetched"))


def derived(n: int, lo: int, digests: list[bytes], fetched: list[dict]) -> tuple[list[dict[int, bytes]], bytes]:
    """For each level the runs that hold ancestors of the leaves from lo on, as joined digests by the run's number; and the root."""
    levels, here, width, hi = [], dict(enumerate(digests, lo)), 1, lo + len(digests)
    given: dict[int, list] = {}
    for x in fetched:
        given.setdefault(x["level"], []).append((x["idx"], x["digest"].encode()))
    while n > width:
        here.update(given.get(len(levels), ()))
        count, first, last = -(-n // width), lo // width // FANOUT, (hi - 1) // width // FANOUT
        runs = {r: b"".join(here[i] for i in range(FANOUT * r, min(count, FANOUT * (r + 1)))) for r in range(first, last + 1)}
        levels.append(runs)
        here = {r: hashlib.sha256(text).hexdigest().encode() for r, text in runs.items()}
        width *= FANOUT
    return levels, here[0]


def steps(levels: list[dict[int, bytes]], idx: int) -> list[tuple[bytes, bytes]]:
    """The siblings before and behind a leaf and each of its ancestors."""
    out = []
    for runs in levels:
        run, at = divmod(idx, FANOUT)
        out.append((runs[run][: HEX * at], runs[run][HEX * (at + 1) :]))
        idx = run
    return out


def folded(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for before, after in path:
        digest = hashlib.sha256(before + digest + after).hexdigest().encode()
    return digest


def _in_blocks(frames: Iterator[pa.RecordBatch], done) -> Iterator[pa.RecordBatch]:
    """done(header, rows) of every block, as rows come: a block's header (idx -1), then its leaves in order. One block is held at a time."""
    header, rows = None, []
    for frame in frames:
        out = []
        for row in frame.to_pylist():
            if row["idx"] >= 0:
                rows.append(row)
                continue
            if header is not None:
                out.append(done(header, rows))
            header, rows = row, []
        yield from out
    if header is not None:
        yield done(header, rows)


def _dealt(leaves: DataFrame, headers: DataFrame, block: int) -> DataFrame:
    """Leaves behind the header of their block, blocks dealt over the tasks."""
    numbered = leaves.withColumn("block", F.expr(f"idx div {block}"))
    heads = headers.withColumn("idx", F.lit(-1).cast("bigint"))
    return numbered.unionByName(heads, allowMissingColumns=True).repartition(partitions(leaves.sparkSession), "tree", "block").sortWithinPartitions("tree", "block", "idx")


def _top_paths(tops: DataFrame, levels: list[DataFrame], block: int) -> DataFrame:
    """source and steps of each subroot (tree, source, n, idx, digest) in the tree over sources."""

    def done(header: dict, rows: list[dict]) -> pa.RecordBatch:
        known, _ = derived(header["n"], rows[0]["idx"], [r["digest"].encode() for r in rows], header["fetched"])
        paths = [[{"before": a.decode(), "after": b.decode()} for a, b in steps(known, r["idx"])] for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([r["source"] for r in rows], pa.string()), pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))], names=["source", "steps"])

    dealt = _dealt(tops, blocks_of(tops, levels, block), block)
    return dealt.mapInArrow(lambda frames: _in_blocks(frames, done), f"source string, steps {STEP}")


def _proofs(leaves: DataFrame, headers: DataFrame, block: int) -> DataFrame:
    def done(header: dict, rows: list[dict]) -> pa.RecordBatch:
        known, top = derived(header["n"], rows[0]["idx"], [r["digest"].encode() for r in rows], header["fetched"])
        upper = [(s["before"].encode(), s["after"].encode()) for s in header["steps"]]
        tail, root = b"".join(a + b for a, b in upper), folded(top, upper)
        proofs, roots = [], []
        for r in rows:
            path = steps(known, r["idx"])
            proofs.append(hashlib.sha256(b"".join(a + b for a, b in path) + tail).hexdigest())
            # What untampered leaves fold to has been derived for the whole block.
            roots.append((root if r["other"] is None else folded(folded(r["other"].encode(), path), upper)).decode())
        text = lambda x: pa.array(x, pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r["doc_id"] for r in rows], pa.int64()), text([r["digest"] for r in rows]), text([header["subroot"]] * len(rows)), text(proofs), text(roots)],
            names=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"],
        )

    return _dealt(leaves, headers, block).mapInArrow(lambda frames: _in_blocks(frames, done), "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")


def manifest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs (doc_id, source, lang, n_chars, text).

    Null values are part of a leaf as `-`; rows without a source have a tree of their own, before all others; an empty source is one as any other. Rows that share
    source and doc_id (or have no doc_id: they come first) follow one another by digest, so equal rows have the same leaf but proofs of their own places. Other columns
    are ignored. An empty table gives an empty one. Rows that tampering does not change are verified.
    """
    spark = docs.sparkSession
    ids = F.col("doc_id").cast("long")
    lower = F.when(F.crc32(ids.cast("string").cast("binary")) % 5 == 0, leaf(ascii_lower(F.col("text"))))
    rows = stored(docs.select(F.col("source").alias("tree"), ids.alias("doc_id"), leaf(F.col("text")).alias("digest"), lower.alias("other")))
    rows_at = rows.select("tree", "doc_id", "digest", F.when(F.col("other") != F.col("digest"), F.col("other")).alias("other"))
    leaves, laid = placed(rows_at, ["doc_id", "digest"])
    forget(rows)
    levels = grown(leaves)
    # A tree's root is its only node of the level where it ends.
    tops = leaves.filter("n = 1").select("tree", "digest")
    for k, level in enumerate(levels):
        tops = tops.unionByName(level.filter(f"n > {FANOUT**k} AND n <= {FANOUT ** (k + 1)}").select("tree", "digest"))
    roots, roots_laid = placed(tops.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "digest"), ["source"])
    over = grown(roots)
    top = over[-1] if over else roots
    root = top.select("digest").first()  # one digest
    paths = stored(_top_paths(roots, over, block))
    of_tree = roots.select(F.col("source").alias("s"), F.col("digest").alias("subroot")).join(paths.select(F.col("source").alias("p"), "steps"), F.col("s").eqNullSafe(F.col("p"))).select("s", "subroot", "steps")
    headers = blocks_of(leaves, levels, block)
    headers = headers.join(of_tree, headers["tree"].eqNullSafe(F.col("s"))).drop("s")
    found = _proofs(leaves, headers, block)
    whole = F.lit(root[0] if root else None).cast("string")
    result = stored(found.select("doc_id", "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == whole).alias("verified")))
    forget(laid, roots_laid, paths, *levels, *over)
    return result


def _field_sql(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: The checksum of an id's digits, bit by bit: 3988292384 is its reversed polynomial.
_CRC_SQL = """xor(list_reduce([4294967295] || flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: [ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""

MANIFEST_SQL = f"""
WITH RECURSIVE rows AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE WHEN {_CRC_SQL} % 5 = 0
    THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf_sql("text")} END AS other FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM rows),
nodes AS (SELECT source, n, 0 AS level, idx, leaf AS digest FROM leaves
  UNION ALL SELECT source, (n + 15) // 16, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY source, n, level, idx // 16),
subroots AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
over AS (SELECT n, 0 AS level, idx, digest FROM subroots
  UNION ALL SELECT (n + 15) // 16, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM over WHERE n > 1 GROUP BY n, level, idx // 16),
paths AS (SELECT l.source, l.idx AS own, x.level, string_agg(x.digest, '' ORDER BY x.idx) FILTER (x.idx < l.idx // (16 ** x.level)::BIGINT) AS b, string_agg(x.digest, '' ORDER BY x.idx) FILTER (x.idx > l.idx // (16 ** x.level)::BIGINT) AS a
  FROM leaves AS l JOIN nodes AS x ON x.source IS NOT DISTINCT FROM l.source AND x.n > 1 AND x.idx // 16 = l.idx // (16 ** (x.level + 1))::BIGINT GROUP BY ALL),
tops AS (SELECT l.source, x.level, string_agg(x.digest, '' ORDER BY x.idx) FILTER (x.idx < l.idx // (16 ** x.level)::BIGINT) AS b, string_agg(x.digest, '' ORDER BY x.idx) FILTER (x.idx > l.idx // (16 ** x.level)::BIGINT) AS a
  FROM subroots AS l JOIN over AS x ON x.n > 1 AND x.idx // 16 = l.idx // (16 ** (x.level + 1))::BIGINT GROUP BY ALL),
lower AS (SELECT source, own, list(coalesce(b, '') || '|' || coalesce(a, '') ORDER BY level) AS steps FROM paths GROUP BY ALL),
upper AS (SELECT source, list(coalesce(b, '') || '|' || coalesce(a, '') ORDER BY level) AS steps FROM tops GROUP BY ALL),
found AS (SELECT l.doc_id, l.leaf, l.other, s.digest AS subroot, (SELECT digest FROM over WHERE n = 1) AS root, coalesce(p.steps, []) || coalesce(u.steps, []) AS steps
  FROM leaves AS l JOIN subroots AS s ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN lower AS p ON p.source IS NOT DISTINCT FROM l.source AND p.own = l.idx LEFT JOIN upper AS u ON u.source IS NOT DISTINCT FROM l.source),
folded AS (SELECT *, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, list_reduce([other] || steps, lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) AS folded_root FROM found)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
