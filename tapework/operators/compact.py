"""Compaction of small files: planning over an inventory, merge, re-sort, verification and records."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapework.functions.schemas import SCHEMAS
from tapework.sources.files import absolute, copied, deleted, exists, footers, refuse_errors, renamed
from tapework.sources.scans import inventory, is_source, partition_hour, partition_prefix, place_of, plain_path, scan_table, table_of

MINIMUM_FILES, SMALL_FILES, SMALL_MIB, SETTLE_MINUTES, LOOKBACK_HOURS = 20, 10, 8, 10, 48
SORT_KEYS = ("symbol", "event_time", "observed_at", "received_at")
LAYOUT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": "1048576"}


def candidates(inventory: DataFrame, now: object, minimum_files: int = MINIMUM_FILES, small_files: int = SMALL_FILES, small_mib: int = SMALL_MIB, settle_minutes: int = SETTLE_MINUTES, lookback_hours: int = LOOKBACK_HOURS) -> DataFrame:
    """prefix, hour, files, small, bytes, source_keys of settled recent partitions with many files or many small ones."""
    t = F.lit(now).cast("timestamp")
    path = F.col("path")
    files = inventory.filter(is_source(path)).select(partition_prefix(path).alias("prefix"), partition_hour(path).alias("hour"), "path", "length").filter("prefix IS NOT NULL")
    files = files.filter(F.to_date("hour") >= F.to_date(t - F.make_interval(hours=F.lit(lookback_hours))))
    files = files.filter(F.col("hour") + F.make_interval(hours=F.lit(1)) <= t - F.make_interval(mins=F.lit(settle_minutes)))
    groups = files.groupBy("prefix", "hour").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") < small_mib * 1024 * 1024).alias("small"), F.sum("length").alias("bytes"), F.sort_array(F.collect_list("path")).alias("source_keys")
    )
    return groups.filter((F.col("files") >= minimum_files) | (F.col("small") >= small_files))


def not_done(plan: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """The plan without partitions whose hour, sources and bytes are those of their checkpoint entry."""
    done = checkpoint.select("prefix", F.col("hour").alias("h"), F.col("source_keys").alias("k"), F.col("source_bytes").alias("b"))
    same = (plan["prefix"] == done["prefix"]) & plan["hour"].eqNullSafe(done["h"]) & plan["source_keys"].eqNullSafe(done["k"]) & plan["bytes"].eqNullSafe(done["b"])
    return plan.join(done, same, "left_anti")


def ordered(plan: DataFrame, first: int = 0) -> DataFrame:
    """By hour and prefix; the first so many, or all for 0."""
    plan = plan.orderBy("hour", "prefix")
    return plan.limit(first) if first else plan


def totals(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def resorted(df: DataFrame, partition: list[str], ranges: int | None = None) -> DataFrame:
    """Each partition's rows by symbol and the times that the table has; unchanged without a symbol. A large partition is dealt in ranges of that order, so many in all, or as the session has it."""
    keys = [k for k in SORT_KEYS if k in df.columns]
    if "symbol" not in keys:
        return df
    number = [] if ranges is None else [ranges]
    return (df.repartitionByRange(*number, *partition, *keys) if partition else df.coalesce(1)).sortWithinPartitions(*partition, *keys)


def mixed(read: DataFrame, names: list[str] | None = None) -> DataFrame:
    """read (prefix, path, columns) and differs: whether a file's columns are others than those of its partition's first file or, with names, than those."""
    first = read.groupBy(F.col("prefix").alias("p")).agg(F.min_by("columns", "path").alias("wanted"))
    bad = ~F.col("columns").eqNullSafe(F.col("wanted"))
    if names is not None:
        own = F.array_sort(F.transform(F.split("columns", "\n"), lambda c: F.substring_index(c, " ", 1)))
        bad = bad | (own != F.array(*[F.lit(n) for n in sorted(names)]))
    return read.join(first, read["prefix"].eqNullSafe(F.col("p"))).withColumn("differs", bad).drop("p", "wanted")


def refuse_mixed(read: DataFrame, names: list[str] | None = None) -> None:
    """An error that names a file that differs."""
    found = mixed(read, names).filter("differs").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).first()
    if found.n:
        raise ValueError(f"the schema of {found.path} differs from that of its table or of its partition's first file ({found.n} such files)")


def merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of all files or folders, which must have one schema; an error names a file that differs. Tasks read the footers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths).select(F.lit("").alias("prefix"), "path")
    refuse_mixed(footers(files))
    return spark.read.parquet(*paths)


def with_previous(new: DataFrame, previous: DataFrame | None, sources: list[str], consumed: list[str]) -> tuple[DataFrame | None, list[str]]:
    """Rows of earlier output first, then of sources that it has not consumed; a rerun after a crash adds nothing twice."""
    left = [s for s in sources if s not in set(consumed)]
    rows = new if left else None
    if previous is not None:
        rows = previous if rows is None else previous.unionByName(rows)
    return rows, left


# Compacted files of a store stand in <root>/_compacted/data/table=T/version=V/partition=P/market=M/date=D/hour=HH, which listings of the store leave out. They count once
# <root>/_compacted/records/V names them, which appears by one rename: a row for each partition, with its output's files and all sources that they stand for.
RECORD = "version string, table string, prefix string, hour timestamp, completed_at timestamp, partition string, output_keys array<string>, input_files bigint, input_bytes bigint, rows bigint, source_keys array<string>, source_bytes bigint, consumed array<string>, replaced array<string>"
BY = ["partition", "market", "date", "hour"]


def _home(root: str, *more: str) -> str:
    return "/".join((root, "_compacted", *more))


def records(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """All published records of a store, or of one of its tables."""
    place = _home(root, "records")
    found = spark.read.schema(RECORD).json(f"{place}/*") if exists(spark, place) else spark.createDataFrame([], RECORD)
    return found if table is None else found.filter(F.col("table") == table)


def newest(recorded: DataFrame) -> DataFrame:
    """The record in force of each partition of a table: each stands for all sources of those before it and some more, whatever clocks say."""
    return recorded.groupBy("table", "prefix").agg(F.max_by(F.struct(*[c for c in recorded.columns if c not in ("table", "prefix")]), F.struct(F.size("consumed"), F.col("version"))).alias("r")).select("table", "prefix", "r.*")


def retired(spark: SparkSession, root: str) -> DataFrame:
    """version of the records whose sources are gone."""
    place = _home(root, "retired")
    return spark.read.schema("version string").json(f"{place}/*") if exists(spark, place) else spark.createDataFrame([], "version string")


def fresh(plan: DataFrame, recorded: DataFrame) -> DataFrame:
    """The plan with only those sources that no record has consumed; partitions without any are done."""
    each = plan.select("prefix", F.explode("source_keys").alias("path"))
    left = each.join(recorded.select(F.explode("consumed").alias("path")), "path", "left_anti")
    kept = left.groupBy("prefix").agg(F.sort_array(F.collect_list("path")).alias("source_keys"))
    return plan.drop("source_keys").join(kept, "prefix")


def partition_id(prefix: Column) -> Column:
    return F.md5(plain_path(prefix))


def outputs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All compacted rows of a table, those of replaced versions too, with version, partition, market, date and hour."""
    place, kinds = _home(root, "data", f"table={table}"), T.StructType([T.StructField(c, T.StringType()) for c in ("version", *BY)])
    schema = T.StructType([*SCHEMAS[table].fields, *kinds.fields])
    return spark.read.schema(schema).parquet(place) if exists(spark, place) else spark.createDataFrame([], schema)


def _sources(spark: SparkSession, table: str, files: DataFrame) -> DataFrame:
    """The rows of source files (path, partition and others, of one run) with what files has beside path, and market, date and hour. These are found once for each file and joined to its rows."""
    rows = spark.read.schema(SCHEMAS[table]).parquet(*[r.path for r in files.select("path").collect()])
    places = files.select(plain_path(F.col("path")).alias("__path"), *[c for c in files.columns if c != "path"], *place_of(F.col("path")))
    return rows.withColumn("__path", plain_path(F.col("_metadata.file_path"))).join(F.broadcast(places), "__path").drop("__path")


def write_version(spark: SparkSession, root: str, table: str, version: str, read: DataFrame, most_bytes: int) -> None:
    """Writes a version of the partitions in read (prefix, partition, path, file_bytes, earlier): each sorted and one file; one of more than most_bytes is cut into ranges of about that size."""
    sized = read.groupBy("partition").agg(F.sum("file_bytes").alias("bytes"), F.max("earlier").alias("earlier"))
    for large in (False, True):
        # Each partition has a place of its own: dealt by hash, some would share a task while others stood empty.
        mine = sized.filter((F.col("bytes") > most_bytes) == F.lit(large)).withColumn("place", F.row_number().over(W.orderBy("partition")) - 1)
        n = mine.agg(F.sum(F.ceil(F.col("bytes") / most_bytes))).first()[0]
        if not n:
            continue
        rows = _sources(spark, table, read.filter("earlier IS NULL").join(mine.select("partition", "place"), "partition").select("path", "partition", "place"))
        again = mine.filter("earlier IS NOT NULL").select("partition", F.col("earlier").alias("version"), "place")
        rows = outputs(spark, root, table).join(F.broadcast(again), ["version", "partition"]).drop("version").unionByName(rows)
        keys = [k for k in SORT_KEYS if k in rows.columns] if "symbol" in rows.columns else []
        out = resorted(rows.drop("place"), BY, int(n)) if large else rows.repartitionById(int(n), "place").sortWithinPartitions(*BY, *keys).drop("place")
        out.write.options(**LAYOUT).mode("append").partitionBy(*BY).parquet(_home(root, "data", f"table={table}", f"version={version}"))


def compared(spark: SparkSession, root: str, table: str, version: str, read: DataFrame) -> DataFrame:
    """partition, output_keys, rows of a written version; an error names a partition whose rows are not as many as those of its inputs. Both sides are counted from footers."""
    n_in = read.groupBy("partition").agg(F.sum("file_rows").alias("n_in"), F.min("prefix").alias("prefix"))
    place = _home(root, "data", f"table={table}", f"version={version}")
    # Without a row in any input there is no output either.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(place).select("path") if exists(spark, place) else spark.createDataFrame([], "path string")
    out = footers(files).withColumn("partition", F.regexp_extract("path", "/partition=([0-9a-f]{32})/", 1))
    n_out = out.groupBy("partition").agg(F.sum("file_rows").alias("rows"), F.sort_array(F.collect_list("path")).alias("output_keys"))
    both = n_in.join(n_out, "partition", "full").select("partition", "prefix", F.coalesce("n_in", F.lit(0)).alias("n_in"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("output_keys", F.array().cast("array<string>")).alias("output_keys"))
    wrong = both.filter("n_in <> rows").first()
    if wrong:
        raise ValueError(f"version {version} of {table} has {wrong.rows} rows of {wrong.prefix}, its sources have {wrong.n_in}")
    return both.select("partition", "rows", "output_keys")


def publish(spark: SparkSession, root: str, version: str, found: DataFrame) -> None:
    """Makes the records of a version count, all at once."""
    draft = _home(root, "drafts", version, "records")
    found.coalesce(1).write.mode("overwrite").json(draft)
    renamed(spark, draft, _home(root, "records", version))


def _fixed(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact_table(spark: SparkSession, plan: DataFrame, table: str, root: str, now: object = None, first: int = 500, most_bytes: int = 1 << 30) -> DataFrame:
    """Compacts the oldest planned partitions of a table, so many at most, and returns their records; none where nothing is left to do.

    Footers are compared first: a source whose columns differ is an error that names it, before anything is written. Earlier output of a partition is an input again, sources that
    a record has consumed are not. Rows are counted on both sides. Then the records are published: a run that ends before that has changed nothing that `live` reads, and one
    that is repeated adds nothing twice. Sources stay until `retire`. One run of a table goes at a time.
    """
    recorded, version = records(spark, root, table), f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    draft = lambda name: _home(root, "drafts", version, name)
    mine = ordered(fresh(plan.filter(table_of(F.col("source_keys")[0]) == table), recorded), first)
    earlier = newest(recorded).select(F.col("prefix").alias("p"), F.col("version").alias("earlier"), "output_keys", F.col("consumed").alias("before"))
    work = mine.withColumn("partition", partition_id(F.col("prefix"))).join(earlier, F.col("prefix") == F.col("p"), "left").drop("p")
    # Written once: what is listed, read and recorded below are the same files.
    work = _fixed(work, draft("plan"))
    if work.isEmpty():
        return spark.createDataFrame([], RECORD)
    no_keys = F.array().cast("array<string>")
    inputs = work.select("prefix", "partition", F.explode("source_keys").alias("path"), F.lit(None).cast("string").alias("earlier"))
    inputs = inputs.unionByName(work.select("prefix", "partition", F.explode("output_keys").alias("path"), "earlier"))
    read = _fixed(footers(inputs), draft("inputs"))
    refuse_mixed(read.filter("earlier IS NULL"), SCHEMAS[table].names)
    write_version(spark, root, table, version, read, most_bytes)
    counted = compared(spark, root, table, version, read)
    size = read.filter("earlier IS NULL").groupBy("partition").agg(F.count(F.lit(1)).alias("input_files"), F.sum("file_bytes").alias("input_bytes"))
    at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    found = work.withColumnRenamed("output_keys", "replaced").join(counted, "partition").join(size, "partition")
    found = found.select(
        F.lit(version).alias("version"), F.lit(table).alias("table"), "prefix", "hour", at.alias("completed_at"), "partition", "output_keys", "input_files", "input_bytes", "rows", "source_keys",
        F.col("bytes").alias("source_bytes"), F.concat(F.coalesce("before", no_keys), "source_keys").alias("consumed"), F.coalesce("replaced", no_keys).alias("replaced"),
    )
    publish(spark, root, version, found)
    return records(spark, root, table).filter(F.col("version") == version)


def retire(spark: SparkSession, root: str, retention: str | None = None) -> DataFrame:
    """Deletes what published records have replaced: consumed sources and the output of earlier versions. With retention, sources are copied there first and sizes compared.

    Nothing is deleted before the output of every record concerned is found whole. It can be repeated after a crash at any point. Returns the files with errors, none as they would be raised.
    """
    open_records = records(spark, root).join(retired(spark, root), "version", "left_anti")
    version = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    draft = lambda name: _home(root, "drafts", version, name)
    todo = _fixed(open_records, draft("records"))
    # Output that a later record has replaced may be gone.
    force = newest(records(spark, root)).join(todo.select("table", "prefix").distinct(), ["table", "prefix"], "left_semi")
    found = footers(force.select("table", "prefix", "rows", F.explode("output_keys").alias("path"))).groupBy("table", "prefix", "rows").agg(F.sum("file_rows").alias("n"))
    wrong = found.filter("n <> rows").first()
    if wrong:
        raise ValueError(f"the output of {wrong.prefix} has {wrong.n} rows, its record says {wrong.rows}")
    sources = todo.select(F.explode("source_keys").alias("path")).distinct()
    if retention is not None:
        there = sources.join(inventory(spark, root).select("path"), "path", "left_semi")  # those that an earlier try has deleted are kept already
        target = F.concat(F.lit(retention), F.lit("/"), F.substring(plain_path(F.col("path")), F.length(plain_path(F.lit(absolute(spark, root)))) + 2, 1 << 20))
        refuse_errors(copied(there.withColumn("target", target), draft("copied")))
    gone = refuse_errors(deleted(sources.unionByName(todo.select(F.explode("replaced").alias("path")).distinct()), draft("deleted")))
    done = draft("done")
    todo.select("version").distinct().coalesce(1).write.json(done)
    renamed(spark, done, _home(root, "retired", version))
    return gone


def live(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table's rows as they count: the output of the records in force and the sources that no record has consumed, at any moment of a compaction. market, date and hour come from the path."""
    recorded = records(spark, root, table)
    force = newest(recorded).select("version", "partition")
    compacted = outputs(spark, root, table).join(F.broadcast(force), ["version", "partition"], "left_semi").drop("version", "partition")
    try:
        sources = scan_table(spark, root, table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return compacted
    pending = recorded.join(retired(spark, root), "version", "left_anti").select(F.explode("source_keys").alias("p")).distinct()
    path = plain_path(F.col("_metadata.file_path"))
    return compacted.unionByName(sources.withColumn("__path", path).join(pending, F.col("__path") == F.col("p"), "left_anti").drop("__path"))


def job(spark: SparkSession, root: str, now: dt.datetime, retention: str | None = None, tables: tuple[str, ...] = tuple(SCHEMAS), first: int = 500, lookback_hours: int = LOOKBACK_HOURS, **rules: int) -> DataFrame:
    """One run over a store: lists the hours in question only, plans, compacts table by table, and retires what is replaced. Returns the new records.

    It can be run again at any time: what an earlier run has left undone is done, and where nothing is left to do it ends without a record.
    """
    # The first day counts whole.
    plan = candidates(inventory(spark, root, now, lookback_hours + 24), now, lookback_hours=lookback_hours, **rules)
    found = spark.createDataFrame([], RECORD)
    for table in tables:
        found = found.unionByName(compact_table(spark, plan, table, root, first=first))
    retire(spark, root, retention)
    return found


def updated_checkpoint(checkpoint: DataFrame, done: DataFrame, now: object, lookback_hours: int = LOOKBACK_HOURS) -> DataFrame:
    """The newest entry of each prefix, without those older than the look-back and a day."""
    every = checkpoint.unionByName(done)
    newest = every.withColumn("__k", F.row_number().over(W.partitionBy("prefix").orderBy(F.desc("completed_at")))).filter("__k = 1").drop("__k")
    return newest.filter(F.col("hour") >= F.lit(now).cast("timestamp") - F.make_interval(hours=F.lit(lookback_hours + 24)))


def rewrite_layout(spark: SparkSession, source: str, path: str, level: int = 1, rows: int = 131_072, by_symbol: bool = False) -> DataFrame:
    """Writes the Parquet files of a folder anew with another compression level, row groups and order, into a new one; and a row that tells of it.

    files, rows, input_bytes, output_bytes, elapsed_seconds, rows_per_second, output_mib_per_second and the settings. Rows are counted as they are written. No files are an error.
    """
    sized = lambda folder: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    before, began, seen = sized(source), time.monotonic(), Observation()
    if not before.files:
        raise FileNotFoundError(f"no Parquet files below {source}")
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(source)
    out = df.sortWithinPartitions(*[k for k in SORT_KEYS if k in df.columns]) if by_symbol and "symbol" in df.columns else df
    out.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(compression="zstd").option("parquet.compression.codec.zstd.level", str(level)).option("parquet.block.row.count.limit", str(rows)).parquet(path)
    took, n, after = max(time.monotonic() - began, 1e-9), seen.get["rows"], sized(path)
    schema = "files bigint, rows bigint, input_bytes bigint, output_bytes bigint, elapsed_seconds double, rows_per_second double, output_mib_per_second double, zstd_level int, row_group_rows int, sort_by_symbol boolean"
    return spark.createDataFrame([(before.files, n, before.bytes, after.bytes, took, n / took, after.bytes / 1_048_576 / took, level, rows, by_symbol)], schema)
