"""Market-event inputs derived from the test tables, and the SQL of the same values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapework.functions.schemas import TABLES, Table


#: The JVM never compiles a method of more bytes than this. Wide projections made into one larger method would be interpreted for every row; beyond this limit Spark splits them.
COMPILED_METHOD = "8000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Times as milliseconds, unsigned integers as bigint, prices as double: types that every engine prints alike."""
    kinds = {T.DecimalType(38, 18): lambda c: c.cast("double"), T.DecimalType(20, 0): lambda c: c.cast("bigint"), T.TimestampType(): F.unix_millis}
    return df.select(*[kinds.get(f.dataType, lambda c: c)(F.col(f.name)).alias(f.name) for f in df.schema.fields])


def text_of_cents(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as n (a number for each row), c (cents), ms, sym, st. The rows are dealt over all tasks: a table of one row group would be read by one."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_partkey", "l_suppkey")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"), F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ms"), F.concat(F.lit("P"), F.col("l_partkey") % 20).alias("sym"), (F.col("l_suppkey") % 3).alias("st")
    )


LINES_SQL = "SELECT l_orderkey * 10 + l_linenumber AS n, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, epoch_ms(l_shipdate) AS ms, 'P' || (l_partkey % 20) AS sym, l_suppkey % 3 AS st FROM lineitem"


#: Of eleven lines each gives other odd values: quoted and bare ones where the other is wanted, words for numbers, signs, zeros, times out of range, nulls and missing keys.
ODD = 11


def _token(rule: str, key: str, i: int) -> Column:
    n, k = F.col("n") + i, F.col("n") % ODD
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    if rule == "s":
        return F.when(k == 1, "7").when(k == 2, "null").otherwise(quote(F.col("sym") if key.rpartition(".")[2] == "s" else F.lit(f"v{i}")))
    if rule == "d":
        cents = text_of_cents(F.col("c") + i)
        return F.when(k == 3, cents).when(k == 4, quote(F.concat(cents, F.lit("x")))).when(k == 5, "null").when(k == 6, quote(F.concat(F.lit("-"), cents))).otherwise(quote(cents))
    if rule in ("u", "i"):
        text = n.cast("string")
        return F.when(k == 5, F.concat(F.lit("-"), text)).when(k == 6, quote(text)).when(k == 7, quote(F.concat(text, F.lit("x")))).when(k == 8, "null").otherwise(text)
    if rule == "t":
        return F.when(k == 7, "0").when(k == 8, '"abc"').when(k == 9, "9000000000000000").when(k == 10, "null").otherwise((F.col("ms") + i * 1000).cast("string"))
    if rule == "j":
        return F.when(k == 2, "null").otherwise(F.concat(F.lit('[["'), text_of_cents(F.col("c") + i), F.lit('","'), n.cast("string"), F.lit('"]]')))
    truth = F.when(n % 2 == 0, "true").otherwise("false")
    return F.when(k == 10, quote(truth)).when(k == 0, "1").otherwise(truth)


def _sql(rule: str, key: str, i: int, table: Table) -> str:
    spot = table.rules == "spot"
    if rule == "s":
        return f"CASE WHEN n % {ODD} IN (1, 2) THEN '' ELSE {'sym' if key.rpartition('.')[2] == 's' else f"'v{i}'"} END"
    none, zero = ("0" if spot else "NULL"), ("ms + 1000" if spot else "0")
    window = " ".join(f"WHEN {k} THEN '{e.removesuffix('Ticker')}'" for k, e in enumerate(table.events))
    return {
        "d": f"CASE WHEN n % {ODD} IN (3, 4, 5) THEN {none} WHEN n % {ODD} = 6 THEN -(c + {i}) / 100.0::DOUBLE ELSE (c + {i}) / 100.0::DOUBLE END",
        "u": f"CASE WHEN n % {ODD} IN (5, 7, 8) THEN 0 ELSE n + {i} END", "i": f"CASE WHEN n % {ODD} IN (7, 8) THEN 0 WHEN n % {ODD} = 5 THEN -(n + {i}) ELSE n + {i} END",
        "t": f"CASE WHEN n % {ODD} IN (7, 8, 10) THEN {zero} WHEN n % {ODD} = 9 THEN ms + 1000 ELSE ms + {i * 1000} END", "rx": "ms + 1000", "st": "CAST(st AS INTEGER)",
        "w": f"CASE n % {len(table.events)} {window} END", "src": f"'binance_{'spot' if spot else 'usdm'}_websocket'",
        "j": f"CASE WHEN n % {ODD} = 2 THEN '[]' ELSE '[[\"' || ((c + {i}) // 100) || '.' || lpad(CAST((c + {i}) % 100 AS VARCHAR), 2, '0') || '\",\"' || (n + {i}) || '\"]]' END",
        "b0": f"(n + {i}) % 2 = 0 AND n % {ODD} NOT IN (0, 10)", "b1": f"(n + {i}) % 2 = 0 OR n % {ODD} IN (0, 10)",
    }[rule]


def payloads(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw payload for each line, whose event has a value for every column of the table."""
    spec = TABLES[name]
    kind = F.element_at(F.array(*[F.lit(f'"e":"{e}"') for e in spec.events]), (F.col("n") % len(spec.events) + 1).cast("int"))
    pieces: dict[str, list[Column]] = {"": [kind] if spec.events[0] else []}
    for i, c in enumerate(spec.columns):
        if c.key:
            outer, _, key = c.key.rpartition(".")
            pieces.setdefault(outer, []).append(F.concat(F.lit(f'"{key}":'), _token(c.rule, c.key, i)))
    if spec.rules == "futures":
        st = F.concat(F.lit('"st":'), F.col("st").cast("string"))
        # Some nested events have it inside only; what stands outside counts before that.
        inside = F.col("n") % ODD == 1
        pieces[""].append(F.when(inside, '"st":null').otherwise(st) if spec.nested else st)
        if spec.nested:
            pieces[spec.nested].append(F.when(inside, st).otherwise('"st":2'))
    top = list(pieces[""])
    top += [F.concat(F.lit(f'"{k}":{{'), F.concat_ws(",", *v), F.lit("}")) for k, v in pieces.items() if k]
    body = F.concat(F.lit('{"stream":"x@bookTicker","data":{'), F.concat_ws(",", *top), F.lit("}}"))
    return lines(spark, sf_dir).select(body.alias("payload"), F.timestamp_millis(F.col("ms") + 1000).alias("received_at"), F.lit("spot" if spec.rules == "spot" else "usdm").alias("market"), (F.col("n") % 4).cast("int").alias("shard_id"))


def table_sql(name: str) -> str:
    spec = TABLES[name]
    columns = [f"{_sql(c.rule, c.key, i, spec)} AS {c.name}" for i, c in enumerate(spec.columns)]
    market = "'spot'" if spec.rules == "spot" else "CASE st WHEN 1 THEN 'usdm' WHEN 2 THEN 'coinm' ELSE 'usdm' END"
    return f"SELECT {', '.join(columns)}, {market} AS target_market FROM ({LINES_SQL})"


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a file inventory: the month's first day and o_custkey % 4 are the partition; a third of the files have markers."""
    o = table(spark, sf_dir, "orders")
    path = F.format_string("a/usdm/t%d/%s/%02d/segment-%d.parquet", F.col("o_custkey") % 2, F.date_format(F.date_trunc("month", F.col("o_orderdate").cast("timestamp")), "yyyy-MM-dd"), F.col("o_custkey") % 4, F.col("o_orderkey"))
    files = o.select(path.alias("path"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("length"), F.col("o_orderkey").alias("key"))
    return files.unionByName(files.filter("key % 3 = 0").select(F.concat("path", F.lit(".uploaded")).alias("path"), F.lit(0).cast("bigint").alias("length"), "key"))


INVENTORY_SQL = """SELECT 'a/usdm/t' || (o_custkey % 2) || '/' || strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '/0' || (o_custkey % 4) AS prefix,
  epoch_ms(date_trunc('month', o_orderdate)::TIMESTAMP) + (o_custkey % 4) * 3600000 AS hour, 'segment-' || o_orderkey || '.parquet' AS name, CAST(round(o_totalprice * 100) AS BIGINT) AS length, o_orderkey AS key, 't' || (o_custkey % 2) AS tab FROM orders"""


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as spot depth updates of a book for each user; ids run on, with a gap where event_id % 97 is 0."""
    from pyspark.sql import Window as W

    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("U"), F.col("user_id")).alias("symbol"))
    seq = F.row_number().over(W.partitionBy("symbol").orderBy("event_id"))
    e = e.withColumn("seq", seq)
    side = lambda k: F.concat(F.lit('[["'), text_of_cents((F.col("event_id") * k) % 50 + 100 * k), F.lit('","'), (F.col("event_id") % 4).cast("string"), F.lit('"]]'))
    return e.select(
        F.timestamp_seconds("event_id").alias("event_time"), F.timestamp_seconds(F.col("event_id") + 1).alias("received_at"), F.lit("spot").alias("market"), "symbol",
        (F.col("seq") * 2 - F.when(F.col("event_id") % 97 == 0, 0).otherwise(1)).cast("decimal(20,0)").alias("first_update_id"), (F.col("seq") * 2).cast("decimal(20,0)").alias("final_update_id"), F.lit("x").alias("source"), side(1).alias("bids"), side(2).alias("asks"), "event_id",
    )


def book_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = depth(spark, sf_dir).filter("event_id % 20 = 0")
    return d.select(F.lit("x").alias("exchange"), "market", "symbol", F.col("event_time").alias("captured_at"), F.col("event_time").alias("requested_at"), F.col("final_update_id").alias("last_update_id"), F.lit(500).alias("limit"), F.lit('{"bids":[["9.00","7"]],"asks":[["99.00","7"]]}').alias("payload"))


DEPTH_SQL = """SELECT event_id, 'U' || user_id AS symbol, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq,
  ((event_id) % 50 + 100) / 100.0::DOUBLE AS bid, ((event_id * 2) % 50 + 200) / 100.0::DOUBLE AS ask, CAST(event_id % 4 AS DOUBLE) AS quantity FROM events"""
