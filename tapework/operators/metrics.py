"""Feed metrics: counters, their increases, the hourly archive report and store statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.functions.coerce import floor_hour, human_bytes
from tapework.operators.normalise import has_table
from tapework.sources.scans import market_of, partition_hour, table_of


def feed_counters(decoded_rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Messages, records and parse errors, and the latest message time, by market (or other columns, such as a window of received_at)."""
    records = F.when(F.col("status") == "ok", F.size(F.filter("types", has_table))).otherwise(0)
    return decoded_rows.groupBy(*(by or ["market"])).agg(F.count(F.lit(1)).alias("messages"), F.sum(records.cast("bigint")).alias("records"), F.count_if(F.col("status") == "parse_error").alias("parse_errors"), F.max("received_at").alias("latest"))


def stored_counters(spark: SparkSession, root: str) -> DataFrame:
    """The counters of all stored batches of a stream by market, as feed_counters has them of the payloads themselves. Markets of no counter of their own are one."""
    rows = spark.read.schema("market string, messages bigint, records bigint, parse_errors bigint, latest timestamp").json(f"{root}/batch=*/_counters")
    return rows.groupBy("market").agg(*[F.sum(c).alias(c) for c in ("messages", "records", "parse_errors")], F.max("latest").alias("latest"))


def written_records(spark: SparkSession, root: str) -> DataFrame:
    """table, rows: what all stored batches of a stream have written, the quarantine too, as counted while it was written."""
    return spark.read.schema("table string, rows bigint").json(f"{root}/batch=*/_written").groupBy("table").agg(F.sum("rows").alias("rows"))


def counter_increase(samples: DataFrame) -> DataFrame:
    """samples (sampled_at, counter, value) and increase: 0 at first, the difference, or after a restart the value itself; a value that is no number counts as the next one."""
    before = F.lag(F.struct(F.lit(1).alias("one"), F.col("value"))).over(W.partitionBy("counter").orderBy("sampled_at"))
    old = before["value"]
    return samples.withColumn("increase", F.when(before.isNull() | old.isNull(), 0).when(F.col("value") >= old, F.col("value") - old).otherwise(F.col("value")))


def archive_report(inventory: DataFrame, hours: DataFrame) -> DataFrame:
    """For each wanted hour: files, bytes as number and text, and whether there were any."""
    files = inventory.filter(F.col("path").endswith(".parquet")).select(partition_hour(F.col("path")).alias("hour"), "length")
    found = files.groupBy("hour").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    df = hours.select(floor_hour(F.col("hour")).alias("hour")).distinct().join(found, "hour", "left").select("hour", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))
    return df.select("*", human_bytes(F.col("bytes")).alias("size"), F.when(F.col("files") > 0, "ok").otherwise("failed").alias("status"))


def store_stats(inventory: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Segments and bytes of each market and table, and rows where counts (market, table, rows) are given."""
    path = F.col("path")
    files = inventory.filter(path.endswith(".parquet") & partition_hour(path).isNotNull()).select(market_of(path).alias("market"), table_of(path).alias("table"), "length").filter("market <> '' AND table <> ''")
    stats = files.groupBy("market", "table").agg(F.count(F.lit(1)).alias("segments"), F.sum("length").alias("bytes"))
    return stats if rows is None else stats.join(rows, ["market", "table"], "left")
