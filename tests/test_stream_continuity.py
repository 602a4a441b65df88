"""Continuity of a stream whose updates come late and in any order, against that of the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from tapework.operators import book
from tapework.streaming.ingest import continuity_stream

SCHEMA = "market string, symbol string, event_time timestamp, first_update_id long, final_update_id long, previous_final_update_id long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def updates(futures):
    rows = []
    for symbol, gap in (("A", 17), ("B", 5), ("C", 1000)):
        for k in range(60):
            if k % gap or not k:
                rows.append(("usdm" if futures else "spot", symbol, 1_000_000 + k, 3 * k + 1, 3 * k + 3, 3 * k if k % 7 else 3 * k - (k > 0)))
    return rows


def streamed(spark, batches, tmp_path, name, **more):
    """Each batch is a file and a micro-batch; a last one moves the watermark beyond all."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "market string, symbol string, s long, first_update_id long, final_update_id long, previous_final_update_id long").select("market", "symbol", F.timestamp_seconds("s").alias("event_time"), "first_update_id", "final_update_id", "previous_final_update_id").coalesce(1).write.mode("append").json(str(tmp_path / "in" / f"{k:03}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("latestFirst", "false").json(str(tmp_path / "in"))
    query = continuity_stream(stream, **more).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    return query, {(r.symbol, r.final_update_id): r.chained for r in spark.table(name).collect() if r.symbol != "end"}


@pytest.mark.parametrize("futures", [False, True])
def test_shuffled_batches(rocks, tmp_path, futures):
    rows, r = updates(futures), random.Random(3)
    # Within a minute of one another, in any order over five micro-batches.
    mixed = sorted(rows, key=lambda x: x[2] + r.uniform(0, 20))
    batches = [mixed[k::1][: len(mixed) // 5 + 1] for k in range(0, len(mixed), len(mixed) // 5 + 1)]
    for b in batches:
        r.shuffle(b)
    end = ("spot", "end", 1_001_000, 1, 1, 0)
    query, got = streamed(rocks, [*batches, [end]], tmp_path, f"chain_{futures}", futures=futures)
    table = rocks.createDataFrame([(m, s, f, u, p, 0) for m, s, _, f, u, p in rows], "market string, symbol string, first_update_id long, final_update_id long, previous_final_update_id long, last_update_id long")
    first = {(s, min(x[4] for x in rows if x[1] == s)) for s in "ABC"}
    want = {(x.symbol, x.final_update_id): x.chained for x in book.continuity(table, futures).collect()}
    assert got == want | dict.fromkeys(first, True) and not all(got.values())


def test_a_silent_book_begins_anew(rocks, tmp_path):
    a, gap = ("spot", "A", 1_000_000, 1, 3, 0), ("spot", "A", 1_010_000, 9, 12, 0)
    end = lambda s: [("spot", "end", s, 1, 1, 0)]
    _, got = streamed(rocks, [[a], end(1_000_200), end(1_009_000), end(1_009_500), [gap], end(1_020_000)], tmp_path, "silent", forget="1 hour")
    assert got == {("A", 3): True, ("A", 12): True}


def test_a_gap_stays_one(rocks, tmp_path):
    a, gap = ("spot", "A", 1_000_000, 1, 3, 0), ("spot", "A", 1_010_000, 9, 12, 0)
    end = lambda s: [("spot", "end", s, 1, 1, 0)]
    _, got = streamed(rocks, [[a], end(1_000_200), end(1_009_000), [gap], end(1_020_000)], tmp_path, "gap")
    assert got == {("A", 3): True, ("A", 12): False}
