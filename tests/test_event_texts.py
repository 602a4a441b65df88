"""Values are read from the texts of events: quoted and bare ones are told apart wherever they stand, and books keep their numbers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapework.functions.coerce import MARK, marked
from tapework.functions.schemas import RAW
from tapework.operators import normalise

RX = dt.datetime(2026, 8, 4, 1)


def rows(spark, name, *payloads, market="spot"):
    raw = spark.createDataFrame([(p, RX, market, 0) for p in payloads], RAW)
    return normalise.table_rows(normalise.exploded(normalise.decoded(raw)), name).collect()


@pytest.mark.parametrize(
    "text,want",
    [
        ('{"a":"x","b":1}', '{"a":"~x","b":1}'), ('{"a":"","b":"~"}', '{"a":"~","b":"~~"}'), ('{"a:":"x:","b":1}', '{"a:":"~x:","b":1}'), ('{"a" : "x" , "b" :1}', '{"a" : "~x" , "b" :1}'),
        ('{"a":"q\\":\\"z","b":["c:","d"]}', '{"a":"~q\\":\\"z","b":["~c:","~d"]}'), ('{"a":"\\\\","b":"y:"}', '{"a":"~\\\\","b":"~y:"}'), ('{"a":"\\"~k\\": 1","b":2}', '{"a":"~\\"~k\\": 1","b":2}'),
    ],
)
def test_quoted_values_are_marked(spark, text, want):
    assert MARK == "~" and spark.createDataFrame([(text,)], "t string").select(marked(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("form", ["%s", '{"stream":"s","data":%s}', "[%s]", '{"stream":"s:","data":[%s]}', '{ "stream" : "s" , "data" : %s }'])
def test_every_envelope_gives_the_same_rows(spark, form):
    event = '{"e":"trade","s":"a\\"b: ~é\\n:","t":"7","p":"-1.50","q":2,"m":true,"M":"true","T":5,"E":"6"}'
    r = rows(spark, "trades", form % event)[0]
    assert (r.symbol, r.trade_id, r.price, r.quantity, r.buyer_is_maker, r.is_best_match) == ('a"b: ~é\n:', 7, Decimal("-1.5"), 0, True, True)
    assert (r.trade_time, r.event_time) == (dt.datetime(1970, 1, 1, 0, 0, 0, 5000), dt.datetime(1970, 1, 1, 0, 0, 0, 6000))


def test_books_keep_bare_numbers(spark):
    for form in ("%s", '{"stream":"s","data":%s}', "[%s]"):
        r = rows(spark, "depth_updates", form % '{"e":"depthUpdate","s":"A","b":[["1:","~2"],[0.00000001,123456789012345678901.5]],"a":"x:"}')[0]
        assert (r.bids, r.asks) == ('[["1:","~2"],[0.00000001,123456789012345678901.5]]', '"x:"')


def test_text_that_looks_like_an_event_is_none(spark):
    raw = spark.createDataFrame([(p, RX, "spot", 0) for p in ('{"stream":"s","data":"{\\"e\\":\\"trade\\"}"}', '{"data":5}', '"x"', '{"e":"kline","k":"o"}', '{"e":"kline","k":[1]}', '{"data":[{"e":"kline","k":1}]}', '{"data":null,"e":"trade"}', '{"e":"kline"}')], RAW)
    assert [r.status for r in normalise.decoded(raw).collect()] == ["parse_error"] * 6 + ["ok", "ok"]


def test_values_are_parsed_once(spark):
    raw = spark.createDataFrame([('{"e":"24hrTicker"}', RX, "spot", 0)], RAW)
    plans = [normalise.table_rows(normalise.exploded(normalise.decoded(raw)), t)._jdf.queryExecution().optimizedPlan().toString() for t in ("tickers", "average_prices")]
    # Payloads as they came and those under data; no variant for a value, so that a wide table has no more of them than a narrow one.
    assert [p.count("from_json") for p in plans] == [2, 2] and len({p.count("try_variant_get") for p in plans}) == 1


def test_open_interest_bodies(spark):
    bodies = ['{"openInterest":"1.5","time":7}', '{"openInterest":1.5,"time":"8","symbol":"B:"}', "{", "[1]", '[{"openInterest":"1"}]', "5", "{}", ' {"openInterest" : "2" , "pair" : 3}', None]
    raw = spark.createDataFrame([(b, RX, None, "A") for b in bodies], "payload string, received_at timestamp, market string, request_symbol string")
    got = [(r.symbol, r.open_interest, r.pair, r.observed_at) for r in normalise.open_interest(raw).collect()]
    assert got == [("A", Decimal("1.5"), "", dt.datetime(1970, 1, 1, 0, 0, 0, 7000)), ("B:", None, "", dt.datetime(1970, 1, 1, 0, 0, 0, 8000)), ("A", None, "", RX), ("A", 2, "", RX)]
