import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapework.functions.coerce import decimal_trunc18, human_bytes, u64_or_zero
from tapework.functions.schemas import RAW, SCHEMAS, TABLES
from tapework.operators import book, compact, metrics, normalise, store
from tapework.sources import scans
from tapework.streaming.ingest import start_ingest

RX = dt.datetime(2026, 8, 4, 1)


def raw(spark, *payloads):
    return spark.createDataFrame([(p, RX, m, 0) for p, m in payloads], RAW)


def rows(spark, table, *payloads):
    return normalise.table_rows(normalise.exploded(normalise.decoded(raw(spark, *payloads))), table).collect()


def test_registry():
    assert len(SCHEMAS) == 20 and len(TABLES) == 17


@pytest.mark.parametrize(
    "text,expected",
    [("-12.34", "-12.34"), ("12x", None), ("1.0000000000000000019", "1.000000000000000001"), ("5.", "5"), (".5", "0.5"), ("-.5", "-0.5"), ("1.000000000000000000junk", "1")]
    + [(x, None) for x in ("-", ".", "", "+5", "1e3", " 5", "1.2.3", "1.00x", "-.")],
)
def test_decimal(spark, text, expected):
    got = spark.createDataFrame([(text,)], "x string").select(decimal_trunc18(F.col("x"))).first()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_unsigned_and_bytes(spark):
    df = spark.createDataFrame([("18446744073709551615",), ("18446744073709551616",), ("-1",), ("+7",), (None,)], "x string")
    assert [int(r[0]) for r in df.select(u64_or_zero(F.col("x"))).collect()] == [2**64 - 1, 0, 0, 7, 0]
    sizes = spark.createDataFrame([(0,), (1536,), (5 * 1024**4 * 1024,)], "n long")
    assert [r[0] for r in sizes.select(human_bytes(F.col("n"))).collect()] == ["0.0 B", "1.5 KiB", "5120.0 TiB"]


def test_envelopes(spark):
    d = normalise.decoded(
        raw(
            spark,
            ('{"stream":"s","data":{"e":"trade","s":"A"}}', "spot"),
            ('{ "data": {"e":"trade","s":"A"}, "stream": "s"}', "spot"),
            ('{"e":"trade","s":"A"}', "spot"),
            ('{"stream":"s","data":[{"e":"trade","s":"A"},{"e":"trade","s":"B"}]}', "spot"),
            ('{"result":null}', "spot"),
            ('{"e":"tr', "spot"),
            ('[{"e":"trade"},1]', "spot"),
            ('{"e":"kline","k":5}', "spot"),
            ('{"e":"nothing"}', "spot"),
        )
    ).collect()
    assert [r.status for r in d] == ["ok", "ok", "ok", "ok", "control", "parse_error", "parse_error", "parse_error", "ignored"]
    assert [r.stream for r in d[:4]] == ["s", "s", "", "s"] and len(d[3].events) == 2


def test_spot_and_futures_rules(spark):
    t = rows(spark, "trades", ('{"e":"trade","s":"A","p":5,"q":"x","m":true,"T":0}', "spot"))[0]
    assert (t.price, t.quantity, t.buyer_is_maker, t.is_best_match, t.event_time, t.trade_time) == (0, 0, True, True, RX, RX)
    f = rows(spark, "futures_aggregate_trades", ('{"e":"aggTrade","s":"A","p":5,"q":"1.5","st":2}', "usdm"))[0]
    assert (f.price, f.quantity, f.symbol_type, f.target_market, f.source) == (None, Decimal("1.5"), 2, "coinm", "binance_usdm_websocket")
    assert f.event_time == dt.datetime(1970, 1, 1)


def test_routing_and_fallback(spark):
    k = rows(spark, "futures_klines", ('{"e":"kline","st":3,"k":{"st":1,"o":"2"}}', "coinm"))[0]
    assert (k.symbol_type, k.target_market) == (3, "coinm")
    liquidation = rows(spark, "futures_liquidations", ('{"e":"forceOrder","o":{"s":"L","st":2}}', "usdm"))[0]
    assert (liquidation.symbol_type, liquidation.target_market) == (2, "coinm")
    assert len(rows(spark, "average_prices", ('{"e":"avgPrice","s":"A"}', "usdm"))) == 1
    mixed = ('[{"e":"aggTrade","s":"A"},{"e":"trade","s":"B"}]', "usdm")
    assert rows(spark, "trades", mixed) == [] and len(rows(spark, "futures_aggregate_trades", mixed)) == 1
    assert rows(spark, "book_tickers", ('{"stream":"!bookTicker","data":{"s":"A"}}', "spot")) == []
    assert len(rows(spark, "book_tickers", ('{"stream":"a@bookTicker","data":{"s":"A"}}', "spot"))) == 1


def test_schema_enforcement(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        normalise.enforced(df, "nothing")
    with pytest.raises(ValueError):
        normalise.enforced(df, "trades")
    good = spark.createDataFrame([], SCHEMAS["trades"])
    assert normalise.enforced(good, "trades").schema == good.schema


def test_paths(spark):
    keys = ["x/usdm/t/2026-08-04/02/segment-1.parquet", "x/compacted.parquet", "x/t/date=2026-08-04/02/segment-1.parquet", "segment-2.parquet"]
    df = spark.createDataFrame([(k,) for k in keys], "path string")
    got = df.select(scans.is_source(F.col("path")), scans.partition_hour(F.col("path")), scans.partition_prefix(F.col("path"))).collect()
    assert [r[0] for r in got] == [True, False, True, True]
    assert got[0][1] == dt.datetime(2026, 8, 4, 2) and got[0][2] == "x/usdm/t/2026-08-04/02" and got[2][1] is None


def test_resort(spark):
    """Null symbols first, equal keys stay beside each other, a table without event_time goes by the times that it has, and each partition is in order."""
    data = [(p, s, o, k) for k, (p, s, o) in enumerate((p, s, o) for p in ("x", "y") for s in ("eth", None, "btc", "eth") for o in (9, 4, 4))]
    df = spark.createDataFrame(data, "part string, symbol string, observed_at long, k long").repartition(3)
    got = compact.resorted(df, ["part"]).collect()
    want = sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    assert [tuple(r[:3]) for r in got] == [r[:3] for r in want] and sorted(r.k for r in got) == [r[3] for r in sorted(data, key=lambda r: r[3])]
    bare = df.drop("symbol")
    assert compact.resorted(bare, ["part"]) is bare


def test_store_round_trip_and_stream(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    payloads = raw(spark, ('{"e":"trade","s":"A","t":42,"p":"100","q":"1"}', "spot"), ('{"e":"tr', "spot"))
    payloads.write.json(str(landing))
    start_ingest(scans.raw_payloads(spark, str(landing), streaming=True), root, str(tmp_path / "c"), available_now=True).awaitTermination()
    back = spark.read.parquet(f"{root}/batch=0/trades")
    assert [(r.trade_id, r.price, str(r.hour)) for r in back.collect()] == [(42, Decimal(100), "1")]
    assert spark.read.parquet(f"{root}/batch=0/quarantine").count() == 1
    counters = metrics.feed_counters(normalise.decoded(payloads)).first()
    assert (counters.messages, counters.records, counters.parse_errors) == (2, 1, 1)


def test_counter_restart(spark):
    df = spark.createDataFrame([(RX, "c", 5), (RX + dt.timedelta(1), "c", 8), (RX + dt.timedelta(2), "c", 2)], "sampled_at timestamp, counter string, value long")
    assert [r.increase for r in metrics.counter_increase(df).orderBy("sampled_at").collect()] == [0, 3, 2]


def test_retention(spark):
    df = spark.createDataFrame([(f"x/t/2026-08-0{d}/00/segment-1.parquet{m}", 1) for d in (1, 3) for m in ("", ".uploaded")], "path string, length long")
    assert store.expirable(df, "2026-08-04 00:00:00", 5.0, 10.0, 48, 200).count() == 1
    assert store.expirable(df, "2026-08-04 00:00:00", 50.0, 10.0, 48, 200).count() == 0


def test_futures_continuity(spark):
    df = spark.createDataFrame([("usdm", "A", 5, 8, 4, 6), ("usdm", "A", 9, 12, 8, 6), ("usdm", "A", 20, 22, 19, 6)], "market string, symbol string, first_update_id long, final_update_id long, previous_final_update_id long, last_update_id long")
    assert [r.chained for r in book.continuity(df, futures=True).orderBy("final_update_id").collect()] == [True, True, False]


def test_hour_export_leaves_markers_out(spark):
    df = spark.createDataFrame([(f"x/t/2026-08-01/00/segment-1.parquet{m}", 1) for m in ("", ".uploaded")], "path string, length long")
    assert [r.path for r in store.hour_files(df, "2026-08-01 00:30:00").collect()] == ["x/t/2026-08-01/00/segment-1.parquet"]


def test_malformed_level_is_no_price(spark):
    chosen = spark.createDataFrame([("spot", "A", '{"bids":[["x","1"],["2","3"]],"asks":[]}')], "market string, symbol string, payload string")
    none = spark.createDataFrame([], "market string, symbol string, final_update_id decimal(20,0), bids string, asks string")
    assert [(r.price, r.quantity) for r in book.book_at(chosen, none).collect()] == [(2, 3)]
