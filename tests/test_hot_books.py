"""A book that holds all rows is dealt over many tasks and gives the rows that one window gives."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.operators import book


@pytest.fixture
def updates(spark):
    e = spark.range(6000).filter("id % 37 > 0 OR id < 100")
    one = e.select(F.lit("usdm").alias("market"), F.when(F.col("id") % 500 == 7, "small").otherwise("hot").alias("symbol"), (F.col("id") * 3).alias("first_update_id"), (F.col("id") * 3 + 2).alias("final_update_id"), (F.col("id") * 3 - 1).alias("previous_final_update_id"), F.lit(11).alias("last_update_id"))
    return one.unionByName(one.filter("first_update_id % 41 = 0"))  # repeated rows


@pytest.mark.parametrize("futures", [False, True])
def test_continuity(spark, updates, futures):
    before = F.lag("final_update_id").over(W.partitionBy("market", "symbol").orderBy("final_update_id", "first_update_id"))
    first, next_ = (F.col("previous_final_update_id") <= F.col("last_update_id"), F.col("previous_final_update_id") == before) if futures else (F.col("first_update_id") <= F.col("last_update_id") + 1, F.col("first_update_id") == before + 1)
    want = updates.withColumn("chained", F.when(before.isNull(), first).otherwise(next_))
    got = book.continuity(updates, futures)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_as_of(spark, updates):
    at = updates.select("market", "symbol", F.timestamp_seconds(F.col("first_update_id") % 5000).alias("at"))
    snapshots = updates.filter("first_update_id % 7 = 0").select("market", "symbol", F.timestamp_seconds(F.col("first_update_id") % 4000 + 300).alias("captured_at"), "last_update_id", "final_update_id").drop("last_update_id").withColumnRenamed("final_update_id", "last_update_id")
    found = book.snapshots_as_of(snapshots, at)
    plain = at.join(snapshots, (at.symbol == snapshots.symbol) & (snapshots.captured_at <= at["at"]), "left").groupBy(at.market, at.symbol, "at").agg(F.max(F.struct("captured_at", "last_update_id")).alias("s"))
    want = {(r.symbol, r["at"]): tuple(r.s) if r.s.captured_at else (None, None) for r in plain.collect()}
    rows = found.collect()
    assert len(rows) == at.count() and all(want[r.symbol, r["at"]] == (r.captured_at, r.last_update_id) for r in rows)


def test_one_book_is_many_tasks(spark, updates):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in book.continuity(updates.filter("symbol = 'hot'")).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    cut = updates.filter("symbol = 'hot'")
    edges = book._edges(cut, F.col("final_update_id"))
    slices = [r["count"] for r in cut.groupBy(book._slice(F.col("final_update_id"), edges)).count().collect()]
    assert len(slices) == 4 and max(slices) < 2 * min(slices) and len(sizes) > 1


def test_empty(spark, updates):
    assert book.continuity(updates.limit(0)).isEmpty()
