"""Sinks in one pass, their counters, export and retention, and rewriting."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapework.functions.schemas import RAW, SCHEMAS, TABLES
from tapework.operators import compact, metrics, normalise, store
from tapework.sources import files, scans
from tapework.streaming.ingest import start_ingest

RX = dt.datetime(2026, 8, 4, 1, 30)


def payloads(spark, n=40):
    each = [
        ('{"e":"trade","s":"A","t":%d,"p":"1","q":"2"}', "spot"), ('{"stream":"a@bookTicker","data":{"s":"A","u":%d}}', "spot"), ('[{"e":"aggTrade","s":"A","a":%d,"st":2},{"e":"trade","s":"B"}]', "usdm"),
        ('{"e":"kline","s":"A","k":{"s":"A","t":%d}}', "usdm"), ('{"e":"trade","t":%d} x', "spot"), ('{"result":%d}', "coinm"), ('{"e":"depthUpdate","U":%d,"b":[["1","2"]],"a":[]}', "elsewhere"),
    ]
    rows = [(p % k, RX + dt.timedelta(minutes=k), m, k % 3) for k, (p, m) in ((k, each[k % len(each)]) for k in range(n))]
    return spark.createDataFrame(rows, RAW)


def by_tables(spark, raw):
    """Every table by itself, as the projections give it."""
    events = normalise.exploded(normalise.decoded(raw))
    return {name: df for name in TABLES if (df := normalise.table_rows(events, name)).count()}


def test_one_pass_gives_all_tables(spark, tmp_path):
    raw, root = payloads(spark), str(tmp_path / "root")
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.schema(RAW).parquet(str(tmp_path / "raw"))
    counters, written = store.write_tables(raw, root)
    want = by_tables(spark, raw)
    assert {r.table: r.rows for r in written.collect()} == {n: df.count() for n, df in want.items()} | {"quarantine": 6}
    assert sorted(p.name for p in Path(root).iterdir() if p.name != "_stage") == sorted([*want, "quarantine"]) and not list((Path(root) / "_stage").iterdir())
    for name, df in want.items():
        columns = [*SCHEMAS[name].names]
        got = scans.scan_table(spark, root, name).select(*columns, F.col("market").alias("target_market"))
        df = df.select(*columns, "target_market")
        assert got.exceptAll(df).isEmpty() and df.exceptAll(got).isEmpty()
    plain = {r.market: tuple(r) for r in metrics.feed_counters(normalise.decoded(raw)).collect()}
    plain["other"] = ("other", *plain.pop("elsewhere")[1:])
    assert {r.market: tuple(r) for r in counters.collect()} == plain


def test_payloads_are_read_once(spark, tmp_path):
    raw = payloads(spark)
    seen = spark.sparkContext.accumulator(0)

    def touch(frames):
        for frame in frames:
            seen.add(frame.num_rows)
            yield frame

    store.write_tables(raw.mapInArrow(touch, raw.schema), str(tmp_path))
    assert seen.value == 40


def test_a_table_with_other_columns_is_refused(spark, tmp_path):
    rows = by_tables(spark, payloads(spark))["trades"]
    with pytest.raises(ValueError, match="trades has 10 columns"):
        store.write_table(rows.withColumn("more", F.lit(1)), str(tmp_path / "t"), name="trades")
    assert not (tmp_path / "t").exists()


def test_streamed_counters_are_those_of_the_batch(spark, tmp_path):
    raw, root = payloads(spark), str(tmp_path / "root")
    for k in range(2):
        raw.filter(F.minute("received_at") % 2 == k).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    start_ingest(stream, root, str(tmp_path / "c"), available_now=True).awaitTermination()
    assert len(list(Path(root).glob("batch=*"))) == 2
    plain = {r.market: tuple(r)[1:] for r in metrics.feed_counters(normalise.decoded(raw)).collect()}
    plain["other"] = plain.pop("elsewhere")
    assert {r.market: tuple(r)[1:] for r in metrics.stored_counters(spark, root).collect()} == plain
    assert {r.table: r.rows for r in metrics.written_records(spark, root).collect()} == {n: df.count() for n, df in by_tables(spark, raw).items()} | {"quarantine": 6}


def test_hours_are_exported_and_expire(spark, tmp_path):
    root, away, log = str(tmp_path / "root"), str(tmp_path / "away"), str(tmp_path / "log")
    store.write_tables(payloads(spark), root)
    hour = [p.relative_to(root) for p in Path(root).glob("*/market=*/date=*/hour=01/*.parquet")]
    first = {r.target: r.status for r in store.export_hour(spark, root, "2026-08-04 01:59:00", away, log).collect()}
    assert set(first.values()) == {"copied"} and len(first) == len(hour) > 3
    assert all((Path(away) / p).read_bytes() == (Path(root) / p).read_bytes() and (Path(root) / f"{p}.uploaded").read_text().strip() == f"{away}/{p}" for p in hour)
    assert not list(Path(away).glob("**/hour=02")) and not list(Path(away).glob("**/*.part"))
    assert {r.status for r in store.export_hour(spark, root, "2026-08-04 01:00:00", away, log).collect()} == {"skipped"}
    (Path(away) / hour[0]).write_bytes(b"broken")
    assert {r.status for r in store.export_hour(spark, root, "2026-08-04 01:00:00", away, log, force=True).collect()} == {"copied"}
    assert (Path(away) / hour[0]).read_bytes() == (Path(root) / hour[0]).read_bytes()
    with pytest.raises(FileNotFoundError):
        store.export_hour(spark, root, "2026-08-04 07:00:00", away, log)
    assert store.expire(spark, root, "2026-08-04 09:00:00", 50.0, 10.0, 2, 48, log).isEmpty()
    assert store.expire(spark, root, "2026-08-04 09:00:00", 5.0, 10.0, 2, 48, log).count() == len(hour)
    left = list(Path(root).glob("*/market=*/date=*/hour=*/*.parquet*"))
    assert left and all("hour=02" in str(p) for p in left)


def test_failed_copies_are_errors(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"x")
    (tmp_path / "there").write_bytes(b"a file where a folder is wanted")
    rows = spark.createDataFrame([(str(tmp_path / "a.parquet"), str(tmp_path / "there" / "a.parquet")), (str(tmp_path / "none.parquet"), str(tmp_path / "b"))], "path string, target string")
    done = files.copied(rows, str(tmp_path / "log"))
    assert done.filter("error IS NULL").isEmpty()
    with pytest.raises(OSError, match="2 files failed"):
        files.refuse_errors(done)
    assert files.deleted(rows.select("path"), str(tmp_path / "log2")).filter("error IS NOT NULL").isEmpty() and not (tmp_path / "a.parquet").exists()


def test_rewriting_tells_what_it_did(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("S"), (F.col("id") * 7919 % 10).cast("string")).alias("symbol"), F.timestamp_seconds(F.col("id") * 37 % 5000).alias("event_time"), "id")
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    r = compact.rewrite_layout(spark, str(tmp_path / "in"), str(tmp_path / "out"), level=5, rows=1000, by_symbol=True).first()
    there = list((tmp_path / "out").glob("*.parquet"))
    assert (r.files, r.rows, r.zstd_level, r.row_group_rows, r.sort_by_symbol) == (2, 5000, 5, 1000, True)
    assert r.output_bytes == sum(p.stat().st_size for p in there) and r.input_bytes == sum(p.stat().st_size for p in (tmp_path / "in").glob("*.parquet"))
    assert abs(r.rows_per_second * r.elapsed_seconds - 5000) < 1 and r.output_mib_per_second > 0
    for p in there:
        meta, got = pq.ParquetFile(p).metadata, [(x["symbol"], x["event_time"]) for x in pq.read_table(p).to_pylist()]
        assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 1000 and meta.row_group(0).column(0).compression == "ZSTD" and got == sorted(got)
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        compact.rewrite_layout(spark, str(tmp_path / "empty"), str(tmp_path / "out2"))


def test_trailing_text_is_quarantined(spark):
    broken = ['{"e":"trade"} junk', '{"e":"trade"}{"e":"trade"}', '{"e":"trade"},{"e":"trade"}', '{"e":"trade"}] junk', '{"e":"trade"},"~end of payload~"] x', '[{"e":"trade"}] ]', "", " "]
    good = ['{"e":"trade"}', ' [{"e":"trade"}]\n', '{"stream":"x","data":[{"e":"trade"}]} ']
    df = normalise.decoded(spark.createDataFrame([(p, RX, "spot", k) for k, p in enumerate(broken + good)], RAW))
    assert [r.status for r in df.orderBy("shard_id").collect()] == ["parse_error"] * len(broken) + ["ok"] * len(good)
    assert df._jdf.queryExecution().executedPlan().toString().count("parseJson") <= 1
