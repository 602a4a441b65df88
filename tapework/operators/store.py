"""The table store: partitioned sinks, hour export, upload backlog and retention."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapework.functions.coerce import floor_hour
from tapework.functions.schemas import SCHEMAS, TABLES
from tapework.operators.normalise import QUARANTINE, dealt, decoded, enforced, has_table, table_rows
from tapework.sources.files import absolute, copied, deleted, refuse_errors, removed
from tapework.sources.scans import inventory, partition_hour

#: Markets that a batch's counters are kept for; all others are counted together.
MARKETS, OTHER = ("spot", "usdm", "coinm"), "other"


def write_table(rows: DataFrame, path: str, mode: str = "append", name: str | None = None) -> int:
    """One table's rows by market and the hour in which they arrived, ZSTD level 1; how many were written. With a name, rows must have that table's columns."""
    hour = floor_hour(F.col("received_at"))
    if name is not None:
        enforced(rows.drop("target_market"), name)  # an error for other columns
        rows = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SCHEMAS[name]], "target_market")
    seen = Observation()
    out = rows.withColumns({"market": F.col("target_market"), "date": F.date_format(hour, "yyyy-MM-dd"), "hour": F.date_format(hour, "HH")}).drop("target_market")
    # Rows of an hour come together first, and a large hour is cut: else each task would leave a small file in each hour.
    out = out.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", "market", "date", "hour")
    out.write.mode(mode).partitionBy("market", "date", "hour").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").parquet(path)
    return seen.get["rows"]


def _counters(markets: tuple[str, ...]) -> list[Column]:
    """What a batch's decoded rows are counted by while they pass: of each market and of the others."""
    records = F.when(F.col("status") == "ok", F.size(F.filter("types", has_table))).otherwise(0)
    found = []
    for m in (*markets, OTHER):
        mine = ~F.coalesce(F.col("market").isin(*markets), F.lit(False)) if m == OTHER else F.col("market") == m
        found += [F.count_if(mine).alias(f"messages {m}"), F.sum(F.when(mine, records.cast("bigint"))).alias(f"records {m}"), F.count_if(mine & (F.col("status") == "parse_error")).alias(f"parse_errors {m}"), F.max(F.when(mine, F.col("received_at"))).alias(f"latest {m}")]
    return found


def write_tables(raw: DataFrame, root: str, mode: str = "append", markets: tuple[str, ...] = MARKETS) -> tuple[DataFrame, DataFrame]:
    """All event tables of raw payloads and the quarantine below root. A table without events is not written.

    Payloads are read and parsed once: events go to a stage below root, a folder for each table, from which each table reads its own. Returns the counters of the batch
    (market, messages, records, parse_errors, latest) and the rows written (table, rows); both were counted as rows passed. A table that gets other than
    its staged rows is an error.
    """
    spark, stage = raw.sparkSession, f"{root}/_stage/{uuid.uuid4().hex}"
    passed, staged = Observation(), Observation()
    names = [*TABLES, QUARANTINE]
    rows = dealt(decoded(raw).observe(passed, *_counters(markets)))
    rows = rows.observe(staged, *[F.count_if(F.col("table") == n).alias(n) for n in names])
    rows.write.partitionBy("table").parquet(stage)
    schema, seen, written = T.StructType([f for f in rows.schema if f.name != "table"]), staged.get, []
    for name in names:
        if not seen[name]:
            continue
        part = spark.read.schema(schema).parquet(f"{stage}/table={name}")
        if name == QUARANTINE:
            part.select("payload", "received_at", "market", "shard_id").write.mode(mode).parquet(f"{root}/{QUARANTINE}")
            written.append((name, seen[name]))
            continue
        written.append((name, write_table(table_rows(part, name), f"{root}/{name}", mode, name)))
        if written[-1][1] != seen[name]:
            raise ValueError(f"{name} got {written[-1][1]} rows of {seen[name]}")
    removed(spark, stage)
    got = passed.get
    counters = [(m, got[f"messages {m}"], got[f"records {m}"] or 0, got[f"parse_errors {m}"], got[f"latest {m}"]) for m in (*markets, OTHER) if got[f"messages {m}"]]
    return spark.createDataFrame(counters, "market string, messages bigint, records bigint, parse_errors bigint, latest timestamp"), spark.createDataFrame(written, "table string, rows bigint")


def export_hour(spark: SparkSession, root: str, hour: object, destination: str, log: str, force: bool = False) -> DataFrame:
    """Copies an hour's files to destination, under their path below root, and marks each with `<path>.uploaded`, which names the copy. Files that have a marker are passed over unless forced.

    path, target, bytes and status (copied or skipped) of each file of the hour, also kept at log. An hour without files is an error, and so is a copy of another size.
    """
    there = inventory(spark, root)
    mine = hour_files(there, hour)
    marked = _marked(there).withColumn("marked", F.lit(True))
    target = F.concat(F.lit(f"{destination}/"), F.substring("path", len(absolute(spark, root)) + 2, 1 << 20))
    every = mine.select("path", target.alias("target"), "length").join(marked, "path", "left").select("path", "target", "length", (F.lit(force) | F.col("marked").isNull()).alias("due"))
    if every.isEmpty():
        raise FileNotFoundError(f"no files of {hour} below {root}")
    # The list is fixed first: markers appear while files are copied.
    every.write.mode("overwrite").parquet(f"{log}/files")
    every = spark.read.schema(every.schema).parquet(f"{log}/files")
    done = refuse_errors(copied(every.filter("due").select("path", "target"), f"{log}/copied", marker=True))
    passed = every.filter("NOT due").select("path", "target", F.col("length").alias("bytes"), F.lit("skipped").alias("status"))
    return done.select("path", "target", "bytes", F.lit("copied").alias("status")).unionByName(passed)


def expire(spark: SparkSession, root: str, now: object, free_percent: float, least_free: float, least_hours: int, most_hours: int, log: str) -> DataFrame:
    """Deletes the segments that `expirable` selects, and their markers; path of each, also kept at log."""
    due = expirable(inventory(spark, root), now, free_percent, least_free, least_hours, most_hours).select("path")
    return refuse_errors(deleted(due, log, markers=True)).select("path")


def hour_files(inventory: DataFrame, hour: object, exported: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Parquet files of one hour to export, without markers and without those already exported unless forced. No files is for the caller to refuse."""
    files = inventory.filter(F.col("path").endswith(".parquet") & (partition_hour(F.col("path")) == floor_hour(F.lit(hour).cast("timestamp"))))
    return files if force or exported is None else files.join(exported.select("path"), "path", "left_anti")


def _marked(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("path").endswith(".uploaded")).select(F.regexp_replace("path", r"\.uploaded$", "").alias("path"))


def upload_backlog(inventory: DataFrame) -> DataFrame:
    """Segments without a marker beside them."""
    return inventory.filter(F.col("path").endswith(".parquet")).join(_marked(inventory), "path", "left_anti")


def expirable(inventory: DataFrame, now: object, free_percent: float, least_free: float, least_hours: int, most_hours: int) -> DataFrame:
    """Marked segments older than the retention, which is the shorter one while space is scarce."""
    hours = least_hours if free_percent < least_free else most_hours
    edge = floor_hour(F.lit(now).cast("timestamp")) - F.make_interval(hours=F.lit(hours))
    return inventory.filter(F.col("path").endswith(".parquet") & (partition_hour(F.col("path")) <= edge)).join(_marked(inventory), "path", "left_semi")
