"""What the stored hours cost: listing goes by day, places are found for files, payloads are parsed by all tasks."""

import datetime as dt
from pathlib import Path

from tapework.plans import queries as q
from tapework.sources import scans

SF = "/root/testdata/sf0.001"


def test_a_table_is_listed_by_day(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    for k in range(3 * 24):
        at = start + dt.timedelta(hours=k)
        for place in (f"x/spot/trades/{at:%Y-%m-%d}/{at:%H}/segment-1.parquet", f"trades/market=spot/date={at:%Y-%m-%d}/hour={at:%H}/part-1.parquet", f"batch=3/trades/market=usdm/date={at:%Y-%m-%d}/hour={at:%H}/part-1.parquet"):
            (Path(tmp_path) / place).parent.mkdir(parents=True)
            (Path(tmp_path) / place).write_bytes(b"x")
    every = scans.table_files(spark, str(tmp_path), "trades")
    assert len(every.inputFiles()) == 3 * 72
    listed = every._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location().rootPaths().size()
    assert listed == 3 * 3
    assert len(scans.table_files(spark, str(tmp_path), "trades", "usdm").inputFiles()) == 72
    assert len(scans.scan_table(spark, str(tmp_path), "trades", hours=["2026-01-02/05"]).inputFiles()) == 3


def test_places_are_found_once_for_each_file(spark):
    plan = q.s2_stored_hours(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # Rows pass from each scan to the count by file: no pattern stands there, neither among the keys nor below.
    below = [part.partition("Relation")[0] for part in plan.split("count(1)")[1:]]
    keys = [part.rpartition("Aggregate [")[2].partition("]")[0] for part in plan.split("count(1)")[:-1]]
    assert len(keys) == 3 and not any("regexp" in text.partition("\n")[2] for text in below) and all(k.count(",") == 1 and "regexp" not in k for k in keys) and "regexp_extract(" in plan


def test_events_are_dealt_over_all_tasks(spark):
    assert q._mixed(spark, SF).rdd.getNumPartitions() == 4
