import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapework.functions.schemas import RAW, SCHEMAS
from tapework.operators import compact, metrics, normalise, store
from tapework.sources import scans

NOW = "2026-08-04 05:00:00"


def landed(spark, first):
    """Two hours of trades out of order, in spot and in a futures market, and one broken payload."""
    at = [dt.datetime(2026, 8, 4, 1 + k % 2, 10) for k in range(8)]
    rows = [(f'{{"e":"trade","s":"{"BA"[k % 4 // 2]}","t":{first + k},"p":"1","q":"1","E":{1000 * (90 - k)}}}', t, "spot", 0) for k, t in enumerate(at)]
    futures = ('{"e":"aggTrade","s":"A","a":7,"p":"1","q":"2","st":2}', at[0], "usdm", 0)
    return spark.createDataFrame([*rows, futures, ("{", at[0], "spot", 0)], RAW)


def test_written_hours_are_scanned_planned_compacted_and_recorded(spark, tmp_path):
    root = str(tmp_path / "root")
    for number in range(2):
        store.write_tables(landed(spark, 100 * number), f"{root}/batch={number}", "overwrite")
    trades = scans.scan_table(spark, root, "trades")
    assert trades.count() == 16 and {(r.market, r.date, r.hour) for r in trades.collect()} == {("spot", "2026-08-04", "01"), ("spot", "2026-08-04", "02")}
    assert scans.scan_table(spark, root, "trades", "spot", ["2026-08-04/02"]).count() == 8
    assert scans.scan_table(spark, root, "futures_aggregate_trades", "coinm").count() == 2

    files = scans.inventory(spark, root)
    stats = {(r.market, r.table) for r in metrics.store_stats(files).collect()}
    assert stats == {("spot", "trades"), ("coinm", "futures_aggregate_trades")}
    plan = compact.candidates(files, NOW, minimum_files=2)
    assert sorted(r.prefix.rpartition("root/")[2] for r in plan.collect()) == [
        "futures_aggregate_trades/market=coinm/date=2026-08-04/hour=01", "trades/market=spot/date=2026-08-04/hour=01", "trades/market=spot/date=2026-08-04/hour=02",
    ]
    done = compact.compact_table(spark, plan, "trades", root, NOW)
    assert [(r.hour, r.rows) for r in done.orderBy("hour").collect()] == [(dt.datetime(2026, 8, 4, 1), 8), (dt.datetime(2026, 8, 4, 2), 8)]
    merged = compact.live(spark, root, "trades")
    names = SCHEMAS["trades"].names
    assert merged.select(*names).exceptAll(trades.select(*names)).isEmpty() and merged.count() == 16

    left = compact.not_done(plan, done.select("prefix", "hour", "source_keys", "source_bytes"))
    assert [scans_table for (scans_table,) in left.select(scans.table_of(F.col("source_keys")[0])).collect()] == ["futures_aggregate_trades"]
    assert compact.compact_table(spark, plan, "klines", root).isEmpty()
    record = done.select("prefix", "hour", "source_keys", "source_bytes", "completed_at")
    assert compact.updated_checkpoint(record.limit(0), record, NOW).count() == 2
    assert compact.updated_checkpoint(record.limit(0), record, "2026-09-04 05:00:00").isEmpty()

    exported = store.hour_files(files, "2026-08-04 02:30:00")
    assert exported.count() == store.upload_backlog(files).filter(scans.partition_hour(F.col("path")) == dt.datetime(2026, 8, 4, 2)).count() > 0
    marked = files.unionByName(files.filter(F.col("path").endswith(".parquet")).withColumns({"path": F.concat("path", F.lit(".uploaded")), "length": F.lit(0).cast("bigint")}))
    assert store.expirable(marked, "2026-08-04 05:00:00", 5.0, 10.0, 3, 200).count() == files.filter(scans.partition_hour(F.col("path")) <= dt.datetime(2026, 8, 4, 2)).count()


def test_segments_of_both_layouts(spark, tmp_path):
    rows = normalise.table_rows(normalise.exploded(normalise.decoded(landed(spark, 0))), "trades").drop("target_market")
    rows.coalesce(1).write.parquet(str(tmp_path / "x" / "spot" / "trades" / "2026-08-04" / "03"))
    assert {(r.market, r.hour) for r in scans.scan_table(spark, str(tmp_path), "trades").collect()} == {("spot", "03")}
    store.write_tables(landed(spark, 0), str(tmp_path))
    assert scans.scan_table(spark, str(tmp_path), "trades").count() == 16
    keys = ["r/t/market=m/date=2026-08-04/hour=02/part-0.parquet", "r/batch=3/t/market=m/date=2026-08-04/hour=02/part-0.parquet", "r/t/market=m/date=2026-08-04/hour=02/x/part-0.parquet"]
    path = F.col("path")
    got = spark.createDataFrame([(k,) for k in keys], "path string").select(scans.is_source(path), scans.partition_prefix(path)).collect()
    assert [tuple(r) for r in got] == [(True, "r/t/market=m/date=2026-08-04/hour=02")] * 2 + [(False, None)]


def test_filters_on_raw_columns_reach_the_scan(spark, tmp_path):
    landed(spark, 0).write.parquet(str(tmp_path / "raw"))
    raw = scans.raw_payloads(spark, str(tmp_path / "raw"), format="parquet")
    d = normalise.decoded(raw).filter("market = 'usdm' AND received_at > '2026-08-01'")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(market), IsNotNull(received_at), EqualTo(market,usdm), GreaterThan(received_at" in plan
    assert plan.count("parseJson") == 1 and d.count() == 1
