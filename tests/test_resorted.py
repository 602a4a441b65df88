from pyspark.sql import functions as F

from tapework.operators import compact


def test_one_large_partition_is_dealt_in_order(spark):
    rows = spark.range(4000).select(F.lit("a").alias("part"), F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"), F.timestamp_seconds(F.col("id") * 37 % 4001).alias("event_time"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task
    try:
        got = compact.resorted(rows, ["part"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.task for r in got}) > 1
    order = [(r.symbol, r.event_time) for r in got]
    assert len(order) == 4000 and order == sorted(order)
