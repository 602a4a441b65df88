"""What the store's cost grows with: files, tasks, patterns and what is done for each row."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapework.functions.schemas import SCHEMAS
from tapework.operators import compact, normalise, store
from tapework.sources import scans


def trades(spark, hours, n=300):
    at = F.timestamp_seconds(F.lit(1785801600) + F.col("id") % hours * 3600)
    made = {f.name: F.lit(None).cast(f.dataType) for f in SCHEMAS["trades"]} | {"received_at": at, "event_time": at, "symbol": F.concat(F.lit("S"), F.col("id") % 7), "trade_id": F.col("id")}
    return normalise.enforced(spark.range(n).select(*[v.alias(k) for k, v in made.items()]), "trades").withColumn("target_market", F.lit("spot"))


def test_files_do_not_multiply_with_tasks(spark, tmp_path):
    place = tmp_path / "trades"
    assert store.write_table(trades(spark, 5).repartition(16), str(place), name="trades") == 300
    there = [str(p.parent) for p in place.glob("**/part-*.parquet")]
    assert len(there) == len(set(there)) == 5


def test_hours_are_compacted_by_a_task_each(spark, tmp_path):
    # A name that looks like a partition.
    root = str(tmp_path / "k=v")
    rows = trades(spark, 12)
    for k in range(2):
        store.write_table(rows.filter(F.col("trade_id") % 24 < 12 if k else F.col("trade_id") % 24 >= 12), f"{root}/batch={k}/trades", name="trades")
    done = compact.compact_table(spark, compact.candidates(scans.inventory(spark, root), "2026-08-06 00:00:00", minimum_files=1), "trades", root).collect()
    tasks = [re.search(r"/part-([0-9]+)-", k)[1] for r in done for k in r.output_keys]
    assert len(done) == len(tasks) == len(set(tasks)) == 12 and sum(r.rows for r in done) == 300
    compact.retire(spark, root)
    live = compact.live(spark, root, "trades").select("trade_id", "market", "date", F.col("hour").cast("int").alias("hour"))
    want = rows.select("trade_id", F.lit("spot").alias("market"), F.date_format("received_at", "yyyy-MM-dd").alias("date"), F.hour("received_at").alias("hour"))
    assert live.exceptAll(want).isEmpty() and live.count() == 300


def test_no_pattern_searches_a_whole_path_for_a_row(spark, tmp_path):
    root = str(tmp_path / "root")
    store.write_table(trades(spark, 2), f"{root}/trades", name="trades")
    plan = scans.scan_table(spark, root, "trades")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == plan.count("regexp_extract(substring_index(") > 0


PATHS = {
    "x/spot/trades/2026-08-04/01/segment-1.parquet": ("spot", "trades", "2026-08-04", "01"), "/2026-08-04/01/f": ("", "", "2026-08-04", "01"), "2026-08-04/01/f": ("", "", "", ""), "a=b/trades/2026-08-04/01/f": ("b", "trades", "2026-08-04", "01"),
    "file:/r/k=v/trades/market=usdm/date=2026-08-04/hour=23/part-0.parquet": ("usdm", "trades", "2026-08-04", "23"), "trades/market=m/date=2026-08-04/hour=23/p": ("m", "trades", "2026-08-04", "23"), "r/batch=3/t/market=m/date=odd/hour=2/p": ("m", "t", "", ""),
    "r/t/market=m/date=2026-08-04/23/p": ("", "", "", ""), "r/m/t/2026-08-04/hour=01/p": ("", "", "2026-08-04", "01"), "r/2026-08-04/01/deep/f": ("", "", "", ""), "f": ("", "", "", ""), "": ("", "", "", ""),
}


def test_places_of_odd_paths(spark):
    path = F.col("path")
    rows = spark.createDataFrame([(p,) for p in PATHS], "path string").select("path", scans.market_of(path), scans.table_of(path), *scans.place_of(path)[1:], scans.partition_hour(path).isNotNull())
    assert {r[0]: tuple(r[1:5]) for r in rows.collect()} == PATHS
    assert all(r[5] == (r[3] != "") for r in rows.collect())


@pytest.mark.parametrize("hours", [24 * 400 + 5, 30, 1])
def test_patterns_do_not_multiply_with_days(hours):
    now = dt.datetime(2026, 8, 4, 5)
    wanted = [f"{now - dt.timedelta(hours=k):%Y-%m-%d/%H}" for k in range(hours)]
    places = scans.hour_places(wanted)
    assert len(places) <= 9
    named = {f"{d}/{h}" for p in places if p.startswith("*/*/*/") for days, own in [p.removeprefix("*/*/*/").split("/")] for d in days.strip("{}").split(",") for h in own.strip("{}").split(",")}
    assert named == set(wanted)


def test_days_of_both_layouts_are_listed_together(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    for k in range(0, 60 * 24, 12):
        at = start + dt.timedelta(hours=k)
        for place in (f"x/spot/trades/{at:%Y-%m-%d}/{at:%H}/segment-1.parquet", f"trades/market=spot/date={at:%Y-%m-%d}/hour={at:%H}/part-1.parquet", f"batch=3/trades/market=spot/date={at:%Y-%m-%d}/hour={at:%H}/part-1.parquet"):
            (Path(tmp_path) / place).parent.mkdir(parents=True)
            (Path(tmp_path) / place).write_bytes(b"x")
    now = dt.datetime(2026, 2, 20, 12)
    found = scans.inventory(spark, str(tmp_path), now, 24 * 30 + 6)
    assert len(found.inputFiles()) == 3 * 61
    assert {r.h for r in found.select(scans.partition_hour(F.col("path")).alias("h")).collect()} == {now - dt.timedelta(hours=12 * k) for k in range(61)}
