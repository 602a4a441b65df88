"""Incremental substring deduplication with a log-structured fingerprint index.

Documents come in batches, in order of their ids. Of each batch, selected window fingerprints (the smallest of the hashes inside a
window, so that equal windows select alike) become a run: an immutable table, dealt into buckets by fingerprint and sorted, that also holds
the hashes of the windows around each place. A new run is merge-joined with the historical runs, bucket by bucket: history is read, never
shuffled again. Where fingerprints meet (64 bits of ten words), the windows around them are compared by 32 bits of independent word hashes. When
there are several runs, the two smallest are compacted into one. The index lives in a folder and can be opened again.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.llm.common import CLEANUP, delete, made_from, partitions, setting, shared_dir, stored
from tapework.llm.wordhash import SECOND, Words, batches

#: Words of a window, words of a fingerprint inside it, batches, and runs that may stand side by side; of more, the smallest two become one.
WINDOW, GRAM, BATCHES, FAN_IN = 20, 10, 4, 2
#: Bytes of text whose repeats are found before anything is dealt.
BATCH = 3_000_000
LEAST = -(2**63)
#: Spark may take a union of tables that are dealt alike for dealt so too, and then reads them in another way: what meets in it is shuffled.
UNIONS = "spark.sql.unionOutputPartitioning"
#: Lets Spark take a bucketed table's order as it was written, where each bucket is one file: runs are merged without being sorted anew.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
RUN = "key long, d long, r long, first int, windows array<int>, sure array<int>"
MANIFEST = "version int, path string, buckets int, upto long, window int, gram int"


def _selected(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of windows, place of the fingerprint each selects, all fingerprints) of a batch of texts."""
    grams = words.runs(gram)
    starts = np.flatnonzero(words.whole(window))
    if not len(starts):
        return starts, starts, grams
    span = window - gram + 1
    # The first of the smallest hashes in each window, by running minima over doubling steps.
    low, at, width = grams.copy(), np.arange(len(grams)), 1
    while width < span:
        step = min(width, span - width)
        n = len(low) - step
        right = low[step:] < low[:n]
        low, at = np.where(right, low[step:], low[:n]), np.where(right, at[step:], at[:n])
        width += step
    return starts, at[starts], grams


def fingerprints(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of a run for documents (d, r, text): a fingerprint (key), its document, and the hashes of the windows that select it, from the start `first` on.

    Of equal windows in the rows that a task sees together, only the earliest is listed, so that no passage is listed for each of its
    copies; the others' starts are in one row for their document, in `sure`.
    """
    ints = pa.list_(pa.int32())

    def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
        offsets = np.zeros(len(lengths) + 1, np.int32)
        np.cumsum(lengths, out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind.value_type))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "d", "r", "first", "windows", "sure"]
        for frame in frames:
            d, r, texts = frame.column(0).to_numpy(), frame.column(1).to_numpy(), frame.column(2).to_pylist()
            order = np.lexsort((r, d))
            d, r, texts = d[order], r[order], [texts[i] for i in order]
            for first, group in batches(texts, BATCH):
                words = Words(group)
                starts, at, grams = _selected(words, window, gram)
                if not len(starts):
                    continue
                w, key = words.runs(window, SECOND, other=True)[starts], grams[at]
                by = np.lexsort((starts, key, w))
                new = np.r_[True, (w[by][1:] != w[by][:-1]) | (key[by][1:] != key[by][:-1])]
                is_new = np.zeros(len(starts), bool)
                is_new[by[new]] = True
                # The windows that select one place stand side by side; a row runs from its first to its last new one.
                edge = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                index = np.arange(len(starts))
                low = np.minimum.reduceat(np.where(is_new, index, len(starts)), edge)
                high = np.maximum.reduceat(np.where(is_new, index, -1), edge)
                low, high = low[high >= 0], high[high >= 0]
                n = high - low + 1
                inside = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                doc = words.doc[starts[low]]
                place = (starts[low] - words.first[doc]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(key[low].view(np.int64)), pa.array(d[first + doc]), pa.array(r[first + doc]), pa.array(place), lists((w[inside] >> np.uint64(32)).astype(np.uint32).view(np.int32), n, ints), pa.nulls(len(low), ints)], names=names)
                others = np.flatnonzero(~is_new)
                if len(others):
                    owner = words.doc[starts[others]]
                    cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    doc = owner[cut]
                    place = (starts[others] - words.first[owner]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(d[first + doc]), pa.array(d[first + doc]), pa.array(r[first + doc]), pa.array(np.zeros(len(doc), np.int32)), pa.nulls(len(doc), ints), lists(place, np.diff(np.r_[cut, len(others)]), ints)], names=names)

    return docs.select("d", "r", "text").mapInArrow(run, RUN)


class SubstringIndex:
    """An index in a folder: its runs, and a manifest that names those in force. A folder with a manifest is opened, another one is begun."""

    def __init__(self, spark: SparkSession, folder: str, window: int = WINDOW, gram: int = GRAM, fan_in: int = FAN_IN):
        self.spark, self.folder, self.window, self.gram, self.fan_in = spark, folder, window, gram, fan_in
        self.buckets, self.version, self.compactions = partitions(spark), 0, 0
        self.upto: int | None = None
        self.runs: list[tuple[str, str]] = []  # (table, path)
        for row in self._manifest():
            if (row["window"], row["gram"]) != (window, gram):
                raise ValueError(f"{folder} holds windows of {row['window']} words with fingerprints of {row['gram']}")
            self.version, self.buckets, self.upto = row["version"], row["buckets"], row["upto"]
            self.runs.append((self._named(row["path"]), row["path"]))

    def _manifest(self) -> list:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return []
        rows = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").json(f"{self.folder}/manifest")
        return rows.filter(F.col("version") == rows.agg(F.max("version")).first()[0]).orderBy("path").collect()  # a row for each run

    def _named(self, path: str) -> str:
        name = f"run_{uuid.uuid4().hex}"
        columns = ", ".join(RUN.split(", "))
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        """A new run of rows, which are dealt by key into as many partitions as there are buckets."""
        name, path = f"run_{uuid.uuid4().hex}", f"{self.folder}/{uuid.uuid4().hex}"
        with setting(self.spark, {CLEANUP: "true", UNIONS: "false"}):
            rows.sortWithinPartitions("key", "d", "r", "first").write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        return name, path

    def _record(self) -> None:
        self.version += 1
        rows = [(self.version, path, self.buckets, self.upto, self.window, self.gram) for _, path in self.runs]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{self.folder}/manifest/{self.version}")

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, path)

    def _rows(self, runs: list[tuple[str, str]]) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, [self.spark.table(name) for name, _ in runs])

    def add(self, batch: DataFrame) -> DataFrame:
        """Indexes a batch (d, r, text), with larger d than all before, and says which of its windows also start earlier.

        d, r, codes (a start times 2**16 and bits for the windows from it on), starts (lists of starts).
        """
        low, high = batch.agg(F.min("d"), F.max("d")).first()
        if high is None:
            return self.spark.createDataFrame([], "d long, r long, codes array<long>, starts array<int>")
        if self.upto is not None and low <= self.upto:
            raise ValueError(f"a batch begins at {low}, the index holds documents up to {self.upto}")
        new = self._write(fingerprints(batch, self.window, self.gram).repartition(self.buckets, "key"))
        old, self.upto = self.runs, high
        fresh = self.spark.table(new[0])
        # Merge joins of tables that are dealt and sorted alike: neither the new run nor history is shuffled, only rows whose fingerprints meet.
        rows = fresh.select("key", "d", "r", "first", "windows").withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key")))
        keys = fresh.select("key").distinct()
        meets, before = F.col("n") > 1, []
        for i, (name, _) in enumerate(old):
            rows = rows.join(self.spark.table(name).select("key").distinct().select(F.col("key").alias(f"key_{i}")).hint("merge"), F.col("key") == F.col(f"key_{i}"), "left")
            meets |= F.col(f"key_{i}").isNotNull()
            before.append(self.spark.table(name).filter("sure IS NULL").join(keys.hint("merge"), "key", "left_semi").select("key", "d", "r", "first", "windows", F.lit(False).alias("new")))
        met = functools.reduce(DataFrame.unionByName, [rows.filter(meets).select("key", "d", "r", "first", "windows", F.lit(True).alias("new")), *before]).repartition(self.buckets, "key")
        each = met.select("key", "d", "r", "first", "new", F.posexplode("windows").alias("o", "w"))
        place = W.partitionBy("key", "w").orderBy("d", "r", F.col("first") + F.col("o"))
        later = each.withColumn("k", F.row_number().over(place)).filter("new AND k > 1")
        codes = later.groupBy("key", "d", "r", "first").agg(F.sum(F.expr("shiftleft(1L, o)")).alias("bits"))
        none = F.lit(None)
        found = codes.select("d", "r", (F.col("first") * F.lit(65536).cast("bigint") + F.col("bits")).alias("code"), none.cast("array<int>").alias("sure"))
        found = found.unionByName(fresh.filter("sure IS NOT NULL").select("d", "r", none.cast("bigint").alias("code"), "sure"))
        with setting(self.spark, {UNIONS: "false", ORDERED: "true"}):
            found = stored(found.groupBy("d", "r").agg(F.collect_list("code").alias("codes"), F.flatten(F.collect_list("sure")).alias("starts")))
        self.runs = [*old, new]
        if len(self.runs) > self.fan_in:
            by_size = sorted(self.runs, key=lambda run: self.spark.table(run[0]).count())
            stale, rest = by_size[:2], by_size[2:]
            merged = self._write(self._rows(stale).filter("sure IS NULL").repartition(self.buckets, "key"))
            self.runs, self.compactions = [*rest, merged], self.compactions + 1
            self._record()
            self._drop(stale)
        else:
            self._record()
        return found

    def drop(self) -> None:
        self._drop(self.runs)
        delete(self.spark, self.folder)
        self.runs = []


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, n_batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by a space) of every row of docs (doc_id, text).

    A word goes if a window of `window` words over it also starts earlier: in a document with a smaller doc_id, or earlier in its own. Null texts have no
    words. Null doc_ids come first; rows that repeat a doc_id are ordered by the hash of their texts, and equal rows are one document. Other columns are ignored.
    """
    if window - gram > 15:
        raise ValueError("at most 16 windows may select one fingerprint")
    spark = docs.sparkSession
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    repeated = docs.groupBy(d.alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() > 0
    # Where ids are unique they are the order; else the text's hash tells rows of one id apart.
    rows = docs.select(F.col("doc_id").cast("long"), d.alias("d"), (F.xxhash64("text") if repeated else F.lit(0).cast("bigint")).alias("r"), "text")
    single = rows.select("d", "r", "text").dropDuplicates(["d", "r"]) if repeated else rows.select("d", "r", "text")
    cuts = rows.select(F.percentile_approx("d", [k / n_batches for k in range(1, n_batches)] or [1.0], 1000).alias("c")).first().c or []
    edges = [None, *sorted(set(cuts))[: n_batches - 1], None]
    index, found = SubstringIndex(spark, f"{shared_dir(spark)}/substrings-{uuid.uuid4().hex}", window, gram, fan_in), []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        batch = single if low is None else single.filter(F.col("d") > low)
        found.append(index.add(batch if high is None else batch.filter(F.col("d") <= high)))
    index.drop()
    width = window - gram + 1

    def make(texts: list, codes: list, starts: list) -> dict[str, pa.Array]:
        n_words, n_removed, kept = [], [], []
        for text, code, start in zip(texts, codes, starts, strict=True):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            stay = words
            if code or start:
                code = np.asarray(code or [], np.int64)
                first, bits = code >> 16, code & 65535
                every = np.concatenate([np.asarray(start or [], np.int64), *[first[bits >> o & 1 == 1] + o for o in range(width)]])
                edge = np.zeros(len(words) + window + 1, np.int64)
                np.add.at(edge, every, 1)
                np.add.at(edge, every + window, -1)
                gone = np.cumsum(edge)[: len(words)]
                stay = [words[i] for i in np.flatnonzero(gone == 0)]
            n_words.append(len(words))
            n_removed.append(len(words) - len(stay))
            kept.append(b" ".join(stay).decode("utf-8", "surrogatepass"))
        return {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())}

    joined = rows.join(functools.reduce(DataFrame.unionByName, found), ["d", "r"], "left")
    return made_from(joined, ["text", "codes", "starts"], make, "n_words long, n_removed long, kept string", keep=["doc_id"])


def substring_report(docs: DataFrame) -> DataFrame:
    """The digest columns of op9 for documents (doc_id, text); nulls, empty tables and repeated rows as in deduplicated."""
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SUBSTRING_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM d, unnest(range(1, len(w) - 18)) AS t(i)),
marked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win),
gone AS (SELECT DISTINCT doc_id, p FROM marked, unnest(range(i, i + 20)) AS t(p) WHERE k > 1),
word AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY word.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""
