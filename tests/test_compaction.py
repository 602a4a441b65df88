"""Compaction against crashes, changed schemas and its own output."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapework.functions.schemas import SCHEMAS
from tapework.operators import compact
from tapework.sources import files, scans

NOW, NAMES = "2026-08-04 05:00:00", SCHEMAS["trades"].names


def segments(spark, root, hours, first, n=3, per=5):
    """n segments of a few trades in each hour, as a store has them."""
    k = first
    for hour in hours:
        folder = Path(root) / "x" / "spot" / "trades" / "2026-08-04" / f"{hour:02}"
        folder.mkdir(parents=True, exist_ok=True)
        for _ in range(n):
            at = dt.datetime(2026, 8, 4, hour)
            rows = [{"event_time": at, "received_at": at + dt.timedelta(seconds=i * 7 % per), "symbol": "BAC"[i % 3], "trade_id": Decimal(100 * k + i), "buyer_is_maker": False, "is_best_match": True, "source": "s"} for i in range(per)]
            table = spark.createDataFrame(rows, SCHEMAS["trades"]).toArrow()
            pq.write_table(table, folder / f"segment-{k}.parquet")
            k += 1
    return k


def ids(df):
    return sorted(int(r.trade_id) for r in df.select("trade_id").collect())


def planned(spark, root):
    return compact.candidates(scans.inventory(spark, root), NOW, minimum_files=2)


def store_files(root):
    return sorted(p.name for p in Path(root).glob("x/**/*.parquet"))


class Stop(Exception):
    pass


def stop(*_, **__):
    raise Stop


def test_committed_retired_and_ended(spark, tmp_path):
    root = str(tmp_path / "root")
    k = segments(spark, root, (1, 2), 0)
    want = ids(scans.scan_table(spark, root, "trades"))
    done = compact.compact_table(spark, planned(spark, root), "trades", root, NOW).collect()
    assert [(r.input_files, r.rows, len(r.output_keys), len(r.consumed)) for r in done] == [(3, 15, 1, 3)] * 2
    assert ids(compact.live(spark, root, "trades")) == want and len(store_files(root)) == 6
    assert compact.compact_table(spark, planned(spark, root), "trades", root, NOW).isEmpty()
    assert compact.retire(spark, root, str(tmp_path / "kept")).count() == 6 and store_files(root) == []
    assert len(list((tmp_path / "kept").glob("x/spot/trades/2026-08-04/0[12]/segment-*.parquet"))) == 6
    assert planned(spark, root).isEmpty() and ids(compact.live(spark, root, "trades")) == want
    # Output is in order and written as a compacted file is.
    for r in done:
        found = pq.ParquetFile(files.opened(r.output_keys[0])[1])
        assert {found.metadata.row_group(0).column(0).compression} == {"ZSTD"} and found.metadata.num_row_groups == 1
        order = found.read(["symbol", "event_time", "received_at"]).to_pylist()
        assert order == sorted(order, key=lambda x: tuple(x.values()))
    # New sources of an hour that was compacted before: earlier output is an input again.
    segments(spark, root, (2,), k)
    want = sorted(want + ids(scans.scan_table(spark, root, "trades")))
    assert ids(compact.live(spark, root, "trades")) == want
    again = compact.compact_table(spark, planned(spark, root), "trades", root, "2026-08-04 06:00:00").collect()
    assert [(r.input_files, r.rows, len(r.consumed), len(r.replaced)) for r in again] == [(3, 30, 6, 1)]
    assert ids(compact.live(spark, root, "trades")) == want
    compact.retire(spark, root)
    assert ids(compact.live(spark, root, "trades")) == want and store_files(root) == []
    assert len(list(Path(root).glob("_compacted/data/table=trades/**/part-*.parquet"))) == 2
    assert compact.retire(spark, root).isEmpty()


@pytest.mark.parametrize("step", ["refuse_mixed", "write_version", "compared", "publish"])
def test_stopped_before_publishing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    segments(spark, root, (1, 2), 0)
    want = ids(compact.live(spark, root, "trades"))
    with monkeypatch.context() as m:
        real = getattr(compact, step)
        m.setattr(compact, step, lambda *a: (real(*a) if step == "write_version" else None, stop()))
        with pytest.raises(Stop):
            compact.compact_table(spark, planned(spark, root), "trades", root, NOW)
    assert ids(compact.live(spark, root, "trades")) == want and compact.records(spark, root).isEmpty()
    assert compact.compact_table(spark, planned(spark, root), "trades", root, NOW).count() == 2
    assert ids(compact.live(spark, root, "trades")) == want


@pytest.mark.parametrize("step", ["copied", "deleted", "renamed"])
def test_stopped_while_retiring(spark, tmp_path, monkeypatch, step):
    root, kept = str(tmp_path / "root"), str(tmp_path / "kept")
    segments(spark, root, (1, 2), 0)
    want = ids(compact.live(spark, root, "trades"))
    compact.compact_table(spark, planned(spark, root), "trades", root, NOW)
    with monkeypatch.context() as m:
        real = getattr(compact, step)
        m.setattr(compact, step, (lambda *a, **b: stop()) if step == "renamed" else (lambda df, *a, **b: (real(df.limit(2), *a, **b), stop())))
        with pytest.raises(Stop):
            compact.retire(spark, root, kept)
    assert ids(compact.live(spark, root, "trades")) == want
    assert compact.compact_table(spark, planned(spark, root), "trades", root, NOW).isEmpty()
    compact.retire(spark, root, kept)
    assert ids(compact.live(spark, root, "trades")) == want and store_files(root) == [] and len(list(Path(kept).glob("**/segment-*"))) == 6


@pytest.mark.parametrize("change", ["extra", "missing", "type"])
def test_changed_schema_is_refused_by_name(spark, tmp_path, change):
    root = str(tmp_path)
    segments(spark, root, (1,), 0)
    odd = next(tmp_path.glob("x/**/segment-2.parquet"))
    table = pq.read_table(odd)
    made = {"extra": lambda: table.append_column("more", table.column("symbol")), "missing": lambda: table.drop_columns(["price"]), "type": lambda: table.set_column(3, "trade_id", table.column("trade_id").cast("int64"))}[change]()
    pq.write_table(made, odd)
    before = store_files(root)
    with pytest.raises(ValueError, match="segment-2.parquet"):
        compact.compact_table(spark, planned(spark, root), "trades", root, NOW)
    assert not (tmp_path / "_compacted" / "data").exists() and store_files(root) == before
    with pytest.raises(ValueError, match="segment-2.parquet"):
        compact.merged(spark, [str(odd.parent)])


def test_missing_rows_are_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    segments(spark, root, (1,), 0)
    real = compact._sources
    monkeypatch.setattr(compact, "_sources", lambda *a: real(*a).filter("trade_id <> 103"))
    with pytest.raises(ValueError, match="has 14 rows of .*01, its sources have 15"):
        compact.compact_table(spark, planned(spark, root), "trades", root, NOW)
    assert compact.records(spark, root).isEmpty()


def test_a_large_hour_is_several_files_in_order(spark, tmp_path):
    root = str(tmp_path)
    segments(spark, root, (1,), 0, n=2, per=400)
    want = ids(compact.live(spark, root, "trades"))
    size = sum(p.stat().st_size for p in tmp_path.glob("x/**/*.parquet"))
    found = compact.compact_table(spark, planned(spark, root), "trades", root, NOW, most_bytes=size // 3).first()
    assert len(found.output_keys) > 1 and ids(compact.live(spark, root, "trades")) == want
    parts = [[tuple(x.values()) for x in pq.read_table(files.opened(k)[1], columns=["symbol", "received_at"]).to_pylist()] for k in found.output_keys]
    assert all(p == sorted(p) for p in parts)
    parts.sort()
    assert all(a[-1] <= b[0] for a, b in zip(parts, parts[1:], strict=False))


def test_first_partitions(spark, tmp_path):
    root = str(tmp_path)
    segments(spark, root, (1, 2, 3), 0)
    assert [r.hour.hour for r in compact.compact_table(spark, planned(spark, root), "trades", root, NOW, first=2).orderBy("hour").collect()] == [1, 2]
    assert [r.hour.hour for r in compact.compact_table(spark, planned(spark, root), "trades", root, NOW, first=2).collect()] == [3]


def test_partitions_that_share_market_and_hour(spark, tmp_path):
    """Two exchanges with a market of the same name are two partitions."""
    root = str(tmp_path)
    segments(spark, root, (1,), 0)
    segments(spark, str(tmp_path / "other"), (1,), 50)
    (tmp_path / "other" / "x").rename(tmp_path / "y")
    want = ids(compact.live(spark, root, "trades"))
    done = compact.compact_table(spark, planned(spark, root), "trades", root, NOW)
    assert sorted((r.rows, len(r.output_keys)) for r in done.collect()) == [(15, 1), (15, 1)] and ids(compact.live(spark, root, "trades")) == want


def test_own_output_is_no_source(spark):
    paths = ["r/_compacted/data/trades/version=1/partition=0/market=m/date=2026-08-04/hour=02/part-0.parquet", "r/trades/market=m/date=2026-08-04/hour=02/part-0.parquet", "x/spot/trades/2026-08-04/02/segment-1.parquet", "x/spot/trades/2026-08-04/02/data.parquet"]
    assert [r[0] for r in spark.createDataFrame([(p,) for p in paths], "path string").select(scans.is_source(F.col("path"))).collect()] == [False, True, True, False]


def test_inventory_lists_only_the_hours_asked_for(spark, tmp_path):
    start = dt.datetime(2025, 1, 1)
    for k in range(0, 365 * 24, 12):
        at = start + dt.timedelta(hours=k)
        for place in (f"x/spot/trades/{at:%Y-%m-%d}/{at:%H}/segment-1.parquet", f"batch=3/trades/market=spot/date={at:%Y-%m-%d}/hour={at:%H}/part-1.parquet"):
            (tmp_path / place).parent.mkdir(parents=True)
            (tmp_path / place).write_bytes(b"x")
    now = dt.datetime(2025, 7, 1, 12)
    found = scans.inventory(spark, str(tmp_path), now, 48)
    hours = {r.h for r in found.select(scans.partition_hour(F.col("path")).alias("h")).collect()}
    assert hours == {now - dt.timedelta(hours=k) for k in (0, 12, 24, 36, 48)} and found.count() == 10
    # The scan's own list of files, from before any filter.
    assert len(found.inputFiles()) == 10
    assert scans.inventory(spark, str(tmp_path), dt.datetime(2030, 1, 1), 48).isEmpty()
    assert scans.inventory(spark, str(tmp_path)).count() == 1460


def test_a_job_ends(spark, tmp_path):
    root, now = str(tmp_path / "root"), dt.datetime(2026, 8, 4, 5)
    segments(spark, root, (1, 2), 0)
    want = ids(compact.live(spark, root, "trades"))
    run = lambda: compact.job(spark, root, now, tables=("klines", "trades"), minimum_files=2)
    assert sorted(r.hour.hour for r in run().collect()) == [1, 2] and store_files(root) == []
    assert run().isEmpty() and ids(compact.live(spark, root, "trades")) == want
    # Of a run that ended before it retired anything, the next one does that.
    segments(spark, root, (2,), 50)
    want = ids(compact.live(spark, root, "trades"))
    compact.compact_table(spark, planned(spark, root), "trades", root, NOW)
    assert len(store_files(root)) == 3 and run().isEmpty() and store_files(root) == [] and ids(compact.live(spark, root, "trades")) == want
