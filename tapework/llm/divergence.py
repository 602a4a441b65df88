"""How sources differ in their words from one another and from their language, over run-length columns.

A language's terms are put in order of their counts in all its sources, so that equal counts stand together. Each source's counts are then a column
of runs. Two columns meet run by run: where neither changes, the difference of the two shares is computed once and multiplied by the run's length.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.llm.common import forget, partitions, stored

#: A term is kept from so many documents of its language on; listed terms of a group.
LEAST_DOCS, TOP = 30, 50
#: Added to each count; what shares are multiplied by.
SMOOTHING, UNIT = 5, 1_000_000_000
#: Counts that a task holds before it passes them on; sources of one language that meet in a task.
HELD, ROOM = 300_000, 128
#: Bytes to words: A-Z become lower-case, other letters and all bytes beyond ASCII stay, the rest is space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text to lang, source, term, n, docs, summed over as many rows as HELD allows."""
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def passed() -> pa.RecordBatch:
        groups = [(lang, source, n, docs) for (lang, source), (n, docs) in seen.items() if n]
        repeat = lambda k: pa.array(list(itertools.chain.from_iterable(itertools.repeat(g[k], len(g[2])) for g in groups)), pa.string())
        terms = pa.array([t for g in groups for t in g[2]], pa.binary())
        counts = [pa.array([v for g in groups for v in g[2].values()], pa.int64()), pa.array([g[3][t] for g in groups for t in g[2]], pa.int64())]
        return pa.RecordBatch.from_arrays([repeat(0), repeat(1), terms, *counts], names=["lang", "source", "term", "n", "docs"])

    for frame in frames:
        for lang, source, text in zip(*[c.to_pylist() for c in frame.columns], strict=True):
            words = text.translate(WORDS).split(b" ")
            n, docs = seen.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            own = Counter(words)
            own.pop(b"", None)
            n.update(own)
            docs.update(own.keys())
            held += len(n)
            if held >= HELD:
                yield passed()
                seen, held = {}, 0
    yield passed()


def vocabulary(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, term, n (its occurrences) and counts (source, n of the sources that have it, in order), of every kept term."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = read.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    # Dealt by term once: both sums find their rows there. A term has one entry for each source of its language, of which each pair is a row of the result.
    each = counts.repartition(partitions(docs.sparkSession), "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return terms.filter(F.col("docs") >= least).select("lang", F.col("term").cast("string").alias("term"), "n", "counts")


def groups_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source of every group that occurs, n (occurrences of kept terms in it), v (kept terms of its language) and whole (their occurrences)."""
    found = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("n"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("whole"))
    filled = found.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    return filled.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n", "v", "whole")])


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (n + SMOOTHING * v)), exact whatever the counts."""
    wide = lambda c: c.cast("decimal(19,0)")  # noqa: E731  a product has 29 digits at most
    return (F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide(count + SMOOTHING), wide(n + SMOOTHING * v)) + 1).cast("bigint")


def _ranked(df: DataFrame) -> DataFrame:
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return df.withColumn("rank", place)


def leading_terms(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that a group has more of than its language, by the difference of their shares; only the first ranks. Spark cuts each task's rows to those ranks before it shuffles them."""
    each = terms.select("lang", "term", F.col("n").alias("all"), F.explode("counts").alias("c")).select("lang", "term", "all", "c.source", F.col("c.n").alias("count"))
    df = each.join(groups, ["lang", "source"])
    df = df.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (share(F.col("count"), F.col("n"), F.col("v")) - share(F.col("all"), F.col("whole"), F.col("v"))).alias("value"))
    return _ranked(df.filter("value > 0")).filter(F.col("rank") <= top)


def runs(index: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of a column begins, and its count; the column has count at index (ascending) and 0 elsewhere below size."""
    dense = np.zeros(size, np.int64)
    dense[index] = count
    start = np.flatnonzero(np.r_[True, dense[1:] != dense[:-1]])
    return start, dense[start]


def columns(terms: DataFrame) -> DataFrame:
    """Run-length columns: lang, slice, length (terms of the slice), source, start (of each run, in terms) and count, for the sources that occur in the slice; and a row without source for each slice.

    Terms with the same counts everywhere are one class with its number of terms. Classes stand in order of their counts and are cut into slices, an Arrow batch each.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = itertools.count(TaskContext.get().partitionId() << 32)
        for frame in frames:
            lang = frame.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(lang[1:] != lang[:-1]) + 1), len(lang)]
            out: list[tuple] = []
            for a, b in itertools.pairwise(cuts):
                if a == b:
                    continue
                lists, length = frame.column(1).slice(a, b - a), frame.column(2).to_numpy()[a:b]
                at = np.r_[0, np.cumsum(length)]
                offsets, number = lists.offsets.to_numpy(), next(made)
                entry = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
                codes = entry.field(0).dictionary_encode()
                row, code, count = np.repeat(np.arange(b - a), np.diff(offsets)), codes.indices.to_numpy(), entry.field(1).to_numpy()
                order = np.lexsort((row, code))
                parts = np.searchsorted(code[order], np.arange(len(codes.dictionary) + 1))
                out.append((lang[a], number, int(at[-1]), None, [0], [0]))
                for source, x, y in zip(codes.dictionary.to_pylist(), parts[:-1], parts[1:], strict=True):
                    start, counts = runs(row[order[x:y]], count[order[x:y]], b - a)
                    out.append((lang[a], number, int(at[-1]), source, at[start], counts))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=["lang", "slice", "length", "source", "start", "count"])

    classes = terms.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("length")).select("lang", "counts", "length")
    # Ranges are drawn from the first few counts, as the driver holds a sample of what they are drawn from.
    laid = classes.repartitionByRange("lang", F.slice("counts", 1, 3)).sortWithinPartitions("lang", "counts")
    return laid.mapInArrow(run, "lang string, slice long, length long, source string, start array<long>, count array<long>")


def met(start_a: np.ndarray, p_a: np.ndarray, start_b: np.ndarray, p_b: np.ndarray, length: int) -> int:
    """The sum of abs(p_a - p_b) over two columns: once for each stretch where neither changes, times its length."""
    bounds = np.union1d(start_a, start_b)
    f = np.abs(p_a[np.searchsorted(start_a, bounds, "right") - 1] - p_b[np.searchsorted(start_b, bounds, "right") - 1])
    return int((f * np.diff(np.r_[bounds, length])).sum())


def differences(cols: DataFrame, groups: DataFrame, room: int = ROOM) -> DataFrame:
    """lang, a, b, value of the pairs of sources of a language with kept terms, each once: f summed over all kept terms.

    A slice's columns meet in one task; where a language has more than `room` sources, those of each two lots of sources do.
    """
    slices = cols.filter("source IS NULL").select("lang", "slice", "length")
    size = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / room).cast("int").alias("lots"))
    # Sources that a slice has nothing of are one run of no count.
    every = slices.join(groups.join(size, "lang"), "lang").join(cols.filter("source IS NOT NULL").select("slice", "source", "start", "count"), ["slice", "source"], "left")
    zero = F.array(F.lit(0).cast("bigint"))
    p = F.transform(F.coalesce("count", zero), lambda c: share(c, F.col("n"), F.col("v")))
    own = F.pmod(F.xxhash64("source"), F.col("lots")).cast("int")
    rooms = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda q: F.struct(F.least(own, q).alias("x"), F.greatest(own, q).alias("y")))
    dealt = every.select("lang", "slice", "length", "source", F.coalesce("start", zero).alias("start"), p.alias("p"), own.alias("lot"), F.explode(rooms).alias("r"))
    dealt = dealt.select("lang", "slice", "r.x", "r.y", "length", "source", "lot", "start", "p")

    def run(table: pa.Table) -> pa.Table:
        length, x, y, lang = (table.column(c)[0].as_py() for c in ("length", "x", "y", "lang"))
        rows = sorted(zip(*[table.column(c).to_pylist() for c in ("source", "lot")], range(len(table)), strict=True))
        start, share_ = ([np.array(v.values) for v in table.column(c)] for c in ("start", "p"))
        out: list[tuple[str, str, int]] = []
        for k, (a, lot_a, i) in enumerate(rows):
            for b, lot_b, j in rows[k + 1 :]:
                if x == y or lot_a != lot_b:
                    out.append((a, b, met(start[i], share_[i], start[j], share_[j], length)))
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "a": pa.array([o[0] for o in out], pa.string()), "b": pa.array([o[1] for o in out], pa.string()), "value": pa.array([o[2] for o in out], pa.int64())})

    found = dealt.groupBy("lang", "slice", "x", "y").applyInArrow(run, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, room: int = ROOM) -> DataFrame:
    """lang, source, part, item, value, rank: of every group the other sources of its language (part pair) and the terms that it has more of than the language (part term).

    Null and empty lang and source are the same group, null text is empty. Every row counts as a document, also one that repeats another. Groups without
    kept terms have pairs too, of value 0 where the language keeps none; a source alone in its language has none. Equal values rank by item in UTF-8 order.
    Other columns are ignored; an empty table gives no rows.
    """
    terms = stored(vocabulary(docs, least))
    groups = stored(groups_of(docs, terms))
    cols = stored(columns(terms))
    once = differences(cols, groups, room)
    none = groups.filter("v = 0").select("lang", "source")
    none = none.join(none.select("lang", F.col("source").alias("item")), "lang").filter("source <> item").select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    both = once.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value").select("lang", "p.source", "p.item", "value")
    pairs = _ranked(both.unionByName(none).select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    result = stored(leading_terms(terms, groups, top).unionByName(pairs).select("lang", "source", "part", "item", "value", "rank"))
    forget(terms, groups, cols)
    return result


AUDIT_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT row, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
own AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS whole FROM kept GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(o.n, 0) AS n, coalesce(v, 0) AS v, coalesce(whole, 0) AS whole FROM (SELECT DISTINCT lang, source FROM docs) AS g
  LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n FROM own GROUP BY ALL) AS o ON o.lang = g.lang AND o.source = g.source LEFT JOIN langs ON langs.lang = g.lang),
shares AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + CAST(1000000000::HUGEINT * (coalesce(o.n, 0) + 5) // (g.n + 5 * g.v) AS BIGINT) AS p,
  1 + CAST(1000000000::HUGEINT * (k.n + 5) // (g.whole + 5 * g.v) AS BIGINT) AS q
  FROM groups AS g JOIN kept AS k ON k.lang = g.lang LEFT JOIN own AS o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs)
UNION ALL
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q)) WHERE rank <= 50
"""
