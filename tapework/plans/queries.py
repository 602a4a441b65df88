"""Queries over the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.functions.coerce import decimal_trunc18, floor_hour, human_bytes, i64_or_zero, u64_or_zero
from tapework.functions.schemas import TABLES
from tapework.operators import book, compact, metrics, normalise, store
from tapework.sources import scans
from tapework.sources.files import footers, scratch
from tapework.streaming import ingest
from tapework.plans.inputs import DEPTH_SQL, INVENTORY_SQL, LINES_SQL, book_snapshots, depth, inventory, lines, payloads, plain, table, table_sql, text_of_cents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
NOW, LOOKBACK = "1997-01-01 00:00:00", 24 * 800


def query(sql: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


def _typed(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(normalise.table_rows(normalise.exploded(normalise.decoded(payloads(spark, sf_dir, name))), name))

    return run


for _k, _name in enumerate(TABLES, 1):
    QUERIES[f"t{_k}_{_name}"], ORACLES[f"t{_k}_{_name}"] = _typed(_name), table_sql(_name)


@query(f"SELECT ms AS observed_at, ms + 1000 AS received_at, sym AS symbol, sym || '_PAIR' AS pair, 'PERPETUAL' AS contract_type, c / 100.0::DOUBLE AS open_interest, 'binance_coinm_rest_poll' AS source, 'coinm' AS target_market FROM ({LINES_SQL})")
def t18_futures_open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = lines(spark, sf_dir)
    body = F.format_string('{"openInterest":"%s","pair":"%s_PAIR","contractType":"PERPETUAL","time":%d}', text_of_cents(F.col("c")), F.col("sym"), F.col("ms"))
    return plain(normalise.open_interest(df.select(body.alias("payload"), F.timestamp_millis(F.col("ms") + 1000).alias("received_at"), F.lit("coinm").alias("market"), F.col("sym").alias("request_symbol"))))


@query(f"SELECT n, CASE n % 4 WHEN 0 THEN c / 100.0::DOUBLE WHEN 1 THEN CAST(c // 100 AS DOUBLE) WHEN 2 THEN (c % 100) / 100.0::DOUBLE END AS value, CASE WHEN n % 3 = 0 THEN 0 ELSE n END AS unsigned, CASE WHEN n % 3 = 0 THEN -n ELSE 0 END AS signed FROM ({LINES_SQL})")
def n5_coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("n") % 4 == 0, text_of_cents(F.col("c"))).when(F.col("n") % 4 == 1, F.concat(F.floor(F.col("c") / 100).cast("bigint").cast("string"), F.lit("."))).when(F.col("n") % 4 == 2, F.concat(F.lit("."), F.lpad((F.col("c") % 100).cast("string"), 2, "0"))).otherwise("x1")
    whole = F.when(F.col("n") % 3 == 0, F.concat(F.lit("-"), F.col("n").cast("string"))).otherwise(F.col("n").cast("string"))
    broken = F.when(F.col("n") % 3 == 0, whole).otherwise(F.concat(whole, F.lit("x")))
    return plain(lines(spark, sf_dir).select("n", decimal_trunc18(text).alias("value"), u64_or_zero(whole).alias("unsigned"), i64_or_zero(broken).alias("signed")))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dealt over all tasks, as lines are: a table of a few row groups would be read, and its payloads parsed, by as many tasks.
    e = table(spark, sf_dir, "events").select("event_id").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = F.col("event_id") % 7
    # Broken in four ways: cut off, with text behind, two in a row, two with a comma.
    broken = F.element_at(F.array(*[F.lit(x) for x in ('{"e":"tra', '{"e":"trade"} junk', '{"e":"trade"}{"e":"trade"}', '{"e":"trade"},{"e":"trade"}')]), (F.col("event_id") % 4 + 1).cast("int"))
    body = (
        F.when(k == 0, '{"e":"trade","s":"A","p":"1"}')
        .when(k == 1, broken)
        .when(k == 2, '{"result":null,"id":1}')
        .when(k == 3, '{"e":"unheard"}')
        .when(k == 4, '{"stream":"x","data":[{"e":"avgPrice","s":"A"},{"e":"trade","s":"B"}]}')
        .when(k == 5, '[{"e":"aggTrade","s":"A"},{"e":"trade","s":"B"}]')
        .otherwise('[{"e":"trade","s":"A"},5]')
    )
    return e.select(body.alias("payload"), F.timestamp_seconds("event_id").alias("received_at"), F.when(k >= 4, "usdm").otherwise("spot").alias("market"), F.lit(0).alias("shard_id"))


STATUS = "CASE event_id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'parse_error' WHEN 2 THEN 'control' WHEN 3 THEN 'ignored' WHEN 6 THEN 'parse_error' ELSE 'ok' END"


@query(f"SELECT {STATUS} AS status, CASE WHEN event_id % 7 >= 4 THEN 'usdm' ELSE 'spot' END AS market, count(*) AS payloads FROM events GROUP BY ALL")
def n16_payload_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.decoded(_mixed(spark, sf_dir)).groupBy("status", "market").agg(F.count(F.lit(1)).alias("payloads"))


@query("SELECT 'usdm' AS target_market, 'B' AS symbol, count(*) AS n_rows FROM events WHERE event_id % 7 = 4 UNION ALL SELECT 'spot', 'A', count(*) FROM events WHERE event_id % 7 = 0")
def n15_futures_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalise.table_rows(normalise.exploded(normalise.decoded(_mixed(spark, sf_dir))), "trades")
    return rows.groupBy("target_market", "symbol").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN 'okx' WHEN 1 THEN 'bybit' ELSE 'binance' END AS exchange, CASE WHEN p_partkey % 2 = 0 THEN 'spot' ELSE 'usdm' END AS market, p_brand AS symbol FROM part
WHERE p_size % 3 = 0 AND (p_partkey % 5 < 2 OR p_partkey % 2 = 1 OR p_size % 2 = 0) AND p_size % 7 > 0""")
def n20_tradable_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey") % 5
    on = F.col("p_size") % 3 == 0
    okx = F.format_string('{"instId":"%s","state":"%s","symbol":"other"}', F.col("p_brand"), F.when(on, "live").otherwise("suspend"))
    bybit = F.format_string('{"symbol":"%s","status":"%s"}', F.col("p_brand"), F.when(on, "Trading").otherwise("TRADING"))
    status = F.when(F.col("p_partkey") % 4 == 3, "contractStatus").otherwise("status")
    own = F.format_string('{"symbol":"%s","%s":"%s","isSpotTradingAllowed":%s}', F.col("p_brand"), status, F.when(on, "TRADING").otherwise("BREAK"), F.when(F.col("p_size") % 2 == 0, "true").otherwise("false"))
    # Some bodies are no JSON, which is no symbol.
    body = F.when(F.col("p_size") % 7 == 0, "{").when(k == 0, okx).when(k == 1, bybit).otherwise(own)
    exchange = F.when(k == 0, "okx").when(k == 1, "bybit").otherwise("binance")
    return normalise.tradable_symbols(p.select(exchange.alias("exchange"), F.when(F.col("p_partkey") % 2 == 0, "spot").otherwise("usdm").alias("market"), body.alias("body")))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact.candidates(inventory(spark, sf_dir), NOW, lookback_hours=LOOKBACK, minimum_files=20, small_files=10, small_mib=8)


PLAN_SQL = f"""SELECT prefix, hour, count(*) AS files, count(*) FILTER (WHERE length < 8388608) AS small, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS n_keys FROM ({INVENTORY_SQL})
WHERE hour + 3600000 <= epoch_ms(TIMESTAMP '{NOW}') - 600000 AND hour >= epoch_ms(date_trunc('day', TIMESTAMP '{NOW}' - INTERVAL {LOOKBACK} HOUR)::TIMESTAMP)
GROUP BY prefix, hour HAVING count(*) >= 20 OR count(*) FILTER (WHERE length < 8388608) >= 10"""


@query(PLAN_SQL)
def c4_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_plan(spark, sf_dir).select("prefix", "hour", "files", "small", "bytes", F.size("source_keys").cast("bigint").alias("n_keys")))


@query(f"SELECT prefix, hour, files FROM ({PLAN_SQL}) WHERE NOT (bytes % 2 = 0)")
def c5_not_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    done = plan.filter("bytes % 2 = 0").select("prefix", "hour", "source_keys", F.col("bytes").alias("source_bytes"))
    return plain(compact.not_done(plan, done).select("prefix", "hour", "files"))


@query(f"SELECT prefix, hour FROM ({PLAN_SQL}) ORDER BY hour, prefix LIMIT 12")
def c6_first_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(compact.ordered(_plan(spark, sf_dir), 12).select("prefix", "hour"))


@query(f"SELECT count(*) AS partitions, CAST(coalesce(sum(files), 0) AS BIGINT) AS files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM ({PLAN_SQL})")
def c12_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact.totals(_plan(spark, sf_dir))


@query(f"SELECT prefix, hour, files AS source_files FROM ({PLAN_SQL}) WHERE hour >= epoch_ms(TIMESTAMP '{NOW}') - {(LOOKBACK // 2 + 24) * 3600000}")
def c15_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = _plan(spark, sf_dir).select("prefix", "hour", F.size("source_keys").cast("bigint").alias("source_files"))
    old, new = (entry.withColumn("completed_at", F.to_timestamp(F.lit(t))) for t in ("1996-12-01 00:00:00", NOW))
    return plain(compact.updated_checkpoint(old, new, NOW, LOOKBACK // 2).drop("completed_at"))


@query(f"SELECT st AS part, n, place FROM (SELECT st, n, row_number() OVER (PARTITION BY st ORDER BY sym, ms, n, c) AS place FROM ({LINES_SQL}))")
def c7_resorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are written as they come out and read back: a row's place is that in its file and the rows of the part's files before."""
    rows = lines(spark, sf_dir).select("st", F.col("sym").alias("symbol"), F.col("ms").alias("event_time"), F.col("n").alias("received_at"))
    place = scratch(spark)
    compact.resorted(rows, ["st"]).write.partitionBy("st").parquet(place)
    found = spark.read.parquet(place).select("st", "received_at", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = found.groupBy("st", "file").agg(F.count(F.lit(1)).alias("rows"))
    before = files.select("st", "file", (F.sum("rows").over(W.partitionBy("st").orderBy("file")) - F.col("rows")).alias("before"))
    return found.join(before, ["st", "file"]).select(F.col("st").cast("bigint").alias("part"), F.col("received_at").alias("n"), (F.col("row") + 1 + F.col("before")).alias("place"))


@query(f"SELECT st AS part, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total FROM ({LINES_SQL}) GROUP BY st")
def c10_with_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).select("st", "n")
    merged, _ = compact.with_previous(rows.filter("n % 2 = 0"), rows.filter("n % 2 = 1"), ["a", "b"], ["a"])
    return merged.groupBy(F.col("st").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("total"))


@query("SELECT CASE WHEN event_id % 7 >= 4 THEN 'usdm' ELSE 'spot' END AS market, count(*) AS messages, CAST(sum(CASE event_id % 7 WHEN 0 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 1 ELSE 0 END) AS BIGINT) AS records, count(*) FILTER (WHERE event_id % 7 IN (1, 6)) AS parse_errors, max(event_id) * 1000 AS latest FROM events GROUP BY ALL")
def m1_feed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metrics.feed_counters(normalise.decoded(_mixed(spark, sf_dir))))


@query("SELECT event_id, CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END AS increase FROM (SELECT event_id, event_id * 7 % 100 AS v, lag(event_id * 7 % 100) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)")
def m3_counter_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").select("event_id", F.timestamp_seconds("event_id").alias("sampled_at"), F.col("user_id").cast("string").alias("counter"), (F.col("event_id") * 7 % 100).alias("value"))
    return metrics.counter_increase(s).select("event_id", F.col("increase").cast("bigint").alias("increase"))


@query(f"SELECT hour, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes, 'ok' AS status FROM ({INVENTORY_SQL}) GROUP BY hour UNION ALL SELECT DISTINCT hour + 43200000, 0, 0, 'failed' FROM ({INVENTORY_SQL})")
def m4_archive_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inventory(spark, sf_dir)
    hour = F.to_timestamp(F.concat_ws(" ", F.split("path", "/")[3], F.split("path", "/")[4]), "yyyy-MM-dd HH")
    # Twelve hours on there are no files.
    hours = files.select(F.explode(F.array(hour, hour + F.make_interval(hours=F.lit(12)))).alias("hour"))
    return plain(metrics.archive_report(files, hours).drop("size"))


@query(f"SELECT 'usdm' AS market, tab AS \"table\", count(*) AS segments, CAST(sum(length) AS BIGINT) AS bytes FROM ({INVENTORY_SQL}) GROUP BY tab")
def m5_store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.store_stats(inventory(spark, sf_dir))


@query("SELECT o_orderkey AS key, CASE WHEN b < 1024 THEN CAST(b AS VARCHAR) || '.0 B' WHEN b < 1048576 THEN CAST(b // 1024 AS VARCHAR) || '.0 KiB' ELSE CAST(b // 1048576 AS VARCHAR) || '.0 MiB' END AS size FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_custkey % 1024 WHEN 1 THEN (o_custkey % 1023 + 1) * 1024 ELSE (o_custkey % 1023 + 1) * 1048576 END AS b FROM orders)")
def m6_human_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey") % 3, F.col("o_custkey")
    n = F.when(k == 0, c % 1024).when(k == 1, (c % 1023 + 1) * 1024).otherwise((c % 1023 + 1) * 1048576)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), human_bytes(n).alias("size"))


@query(f"SELECT prefix || '/' || name AS path FROM ({INVENTORY_SQL}) WHERE hour = epoch_ms(TIMESTAMP '1996-03-01 02:00:00') AND key % 5 <> 0")
def s5_hour_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inventory(spark, sf_dir)
    return store.hour_files(files, "1996-03-01 02:34:56", files.filter("key % 5 = 0")).select("path")


@query(f"SELECT prefix || '/' || name AS path, length FROM ({INVENTORY_SQL}) WHERE key % 3 <> 0")
def s6_upload_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.upload_backlog(inventory(spark, sf_dir)).select("path", "length")


@query(f"SELECT prefix || '/' || name AS path FROM ({INVENTORY_SQL}) WHERE key % 3 = 0 AND hour <= epoch_ms(TIMESTAMP '{NOW}') - {24 * 400 * 3600000}")
def s7_expirable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.expirable(inventory(spark, sf_dir), NOW, 5.0, 10.0, 24 * 400, 24 * 900).select("path")


@query("SELECT event_id, epoch_ms(date_trunc('hour', TIMESTAMP '1970-01-01' + INTERVAL (event_id) SECOND)::TIMESTAMP) AS hour FROM events")
def n12_floor_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(table(spark, sf_dir, "events").select("event_id", floor_hour(F.timestamp_seconds("event_id")).alias("hour")))


@query(f"SELECT event_id, symbol, 'bid' AS side, 0 AS level, bid AS price, quantity FROM ({DEPTH_SQL}) UNION ALL SELECT event_id, symbol, 'ask', 0, ask, quantity FROM ({DEPTH_SQL})")
def b1_depth_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(book.levels(depth(spark, sf_dir)).select("event_id", "symbol", "side", "level", "price", "quantity"))


@query(f"SELECT event_id * 1000 AS event_time, event_id * 1000 AS transaction_time, event_id * 1000 + 1000 AS received_at, symbol, symbol || '_P' AS pair, seq * 2 - CASE WHEN event_id % 97 = 0 THEN 0 ELSE 1 END AS first_update_id, seq * 2 AS final_update_id, seq * 2 - 2 AS previous_final_update_id, side, 0 AS level, price, quantity, 'x' AS source FROM (SELECT *, 'bid' AS side, bid AS price FROM ({DEPTH_SQL}) UNION ALL SELECT *, 'ask', ask FROM ({DEPTH_SQL}))")
def b1_futures_depth_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = {"transaction_time": F.col("event_time"), "pair": F.concat("symbol", F.lit("_P")), "previous_final_update_id": F.col("final_update_id") - 2}
    return plain(book.level_table(depth(spark, sf_dir).withColumns(more), "futures_depth_levels"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """_mixed, landed as JSON lines and read by the source of payloads."""
    place = scratch(spark)
    _mixed(spark, sf_dir).write.json(place)
    return scans.raw_payloads(spark, place)


@query(f"SELECT {STATUS} AS status, event_id * 1000 AS received_at, CASE WHEN event_id % 7 >= 4 THEN 'usdm' ELSE 'spot' END AS market, 0 AS shard_id FROM events")
def n1_landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(normalise.decoded(_landed(spark, sf_dir)).select("status", "received_at", "market", "shard_id"))


@query(f"SELECT ms AS observed_at, ms + 1000 AS received_at, sym AS symbol, c / 100.0::DOUBLE AS open_interest, 'coinm' AS target_market FROM ({LINES_SQL}) WHERE n % 13 > 0")
def n2_landed_open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.format_string('{"openInterest":"%s","time":%d}', text_of_cents(F.col("c")), F.col("ms"))
    rows = lines(spark, sf_dir).select(F.when(F.col("n") % 13 == 0, "{").otherwise(body).alias("payload"), F.timestamp_millis(F.col("ms") + 1000).alias("received_at"), F.lit("coinm").alias("market"), F.col("sym").alias("request_symbol"))
    place = scratch(spark)
    rows.write.json(place)
    return plain(normalise.open_interest(scans.open_interest_raw(spark, place)).select("observed_at", "received_at", "symbol", "open_interest", "target_market"))


@query(f"SELECT 'x' AS exchange, 'spot' AS market, symbol, event_id * 1000 AS captured_at, event_id * 1000 AS requested_at, seq * 2 AS last_update_id, 500 AS \"limit\", '{{\"bids\":[[\"9.00\",\"7\"]],\"asks\":[[\"99.00\",\"7\"]]}}' AS payload FROM ({DEPTH_SQL}) WHERE event_id % 20 = 0")
def b0_landed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch(spark)
    book_snapshots(spark, sf_dir).write.option("compression", "gzip").json(place)
    return plain(scans.snapshots(spark, place))


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """_mixed, by the sinks below a new folder."""
    root = scratch(spark)
    store.write_tables(_mixed(spark, sf_dir), root)
    return root


STORED_SQL = "SELECT event_id, event_id // 3600 AS hour, CASE event_id % 7 WHEN 0 THEN 'spot' ELSE 'usdm' END AS market, unnest(CASE event_id % 7 WHEN 0 THEN ['trades A'] WHEN 4 THEN ['average_prices A', 'trades B'] ELSE ['futures_aggregate_trades A'] END) AS what FROM events WHERE event_id % 7 IN (0, 4, 5)"


@query(f"SELECT split_part(what, ' ', 1) AS \"table\", split_part(what, ' ', 2) AS symbol, market, strftime(TIMESTAMP '1970-01-01' + INTERVAL (hour) HOUR, '%Y-%m-%d') AS date, strftime(TIMESTAMP '1970-01-01' + INTERVAL (hour) HOUR, '%H') AS hour, count(*) AS n_rows FROM ({STORED_SQL}) GROUP BY ALL")
def s2_stored_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, found = _stored(spark, sf_dir), None
    for name in ("trades", "average_prices", "futures_aggregate_trades"):
        # Counted by file first, so that a place is found once for each file and not for each row.
        files = scans.table_files(spark, root, name).groupBy(F.col("_metadata.file_path").alias("file"), "symbol").agg(F.count(F.lit(1)).alias("n"))
        rows = files.select("symbol", "n", *scans.place_of(F.col("file"))).groupBy(F.lit(name).alias("table"), "symbol", "market", "date", "hour").agg(F.sum("n").alias("n_rows"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query(f"SELECT split_part(what, ' ', 1) AS \"table\", market, hour * 3600000 AS hour, count(*) > 0 AS listed FROM ({STORED_SQL}) GROUP BY ALL")
def c1_listed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a store, by hours that are named beforehand: all from the last event on back to the first."""
    last = _at(spark, sf_dir)
    files = scans.inventory(spark, _stored(spark, sf_dir), last, int(last.timestamp() // 3600) + 1)
    path = F.col("path")
    hours = files.groupBy(scans.table_of(path).alias("table"), scans.market_of(path).alias("market"), scans.partition_hour(path).alias("hour")).agg((F.sum("length") > 0).alias("listed"))
    return plain(hours)


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as rows of the trades table, an hour for each st of each year."""
    at = F.timestamp_millis("ms")
    hour = F.date_trunc("year", at) + F.make_interval(hours=F.col("st"))
    made = {"event_time": at, "received_at": hour, "symbol": F.col("sym"), "trade_id": F.col("n"), "price": F.col("c") / 100, "quantity": F.lit(1), "trade_time": at, "buyer_is_maker": F.lit(True), "is_best_match": F.lit(True), "source": F.lit("x")}
    return normalise.enforced(lines(spark, sf_dir).select(*[v.alias(k) for k, v in made.items()]), "trades").withColumn("target_market", F.lit("spot"))


@query(f"SELECT year(make_timestamp(ms * 1000)) AS year, lpad(CAST(st AS VARCHAR), 2, '0') AS hour, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total, 1 AS files, 2 AS runs FROM ({LINES_SQL}) GROUP BY ALL")
def c10_compacted_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that is compacted, gets more files before its sources are retired, and is compacted and retired again: live rows of each hour, its files and the times it was compacted."""
    root, rows, now = scratch(spark), _trades(spark, sf_dir), dt.datetime(2030, 1, 1)
    number = F.col("trade_id").cast("bigint")
    for k in (0, 1):
        for j in (0, 1):
            store.write_table(rows.filter(number % 4 == 2 * j + k), f"{root}/batch={2 * k + j}/trades", name="trades")
        plan = compact.candidates(scans.inventory(spark, root), now, minimum_files=1, lookback_hours=24 * 365 * 60)
        compact.compact_table(spark, plan, "trades", root)
    compact.retire(spark, root)
    by = [F.substring("date", 1, 4).cast("int").alias("year"), "hour"]
    found = compact.live(spark, root, "trades").groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("trade_id").cast("bigint").alias("total"))
    runs = compact.records(spark, root).groupBy("prefix", F.year("hour").alias("year"), F.date_format("hour", "HH").alias("hour")).agg(F.count(F.lit(1)).cast("int").alias("runs"), F.max_by(F.size("output_keys"), "version").alias("files"))
    return found.join(runs.drop("prefix"), ["year", "hour"])


@query(f"SELECT year(make_timestamp(ms * 1000)) AS year, 2 AS files, CASE WHEN year(make_timestamp(ms * 1000)) % 2 = 0 THEN 1 ELSE 0 END AS refused FROM ({LINES_SQL}) GROUP BY ALL")
def c9_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by year, one of each even year with a column more: how many each year's merge refuses."""
    root, rows = scratch(spark), lines(spark, sf_dir).withColumn("year", F.year(F.timestamp_millis("ms")))
    half = lambda k: rows.filter(F.col("n") % 2 == k)
    half(0).select("n", "year").repartition("year").write.partitionBy("year").parquet(f"{root}/a")
    half(1).filter("year % 2 = 1").select("n", "year").repartition("year").write.partitionBy("year").parquet(f"{root}/b")
    half(1).filter("year % 2 = 0").select("n", "sym", "year").repartition("year").write.partitionBy("year").parquet(f"{root}/c")
    listed = scans.inventory(spark, root).filter("path LIKE '%.parquet'").select("path", F.regexp_extract("path", "/year=([0-9]+)/", 1).cast("int").alias("year"))
    return compact.mixed(footers(listed.withColumn("prefix", F.col("year").cast("string")))).groupBy("year").agg(F.count(F.lit(1)).cast("int").alias("files"), F.count_if("differs").cast("int").alias("refused"))


@query(f"SELECT count(*) AS rows, true AS told FROM ({LINES_SQL})")
def m7_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch(spark), scratch(spark)
    lines(spark, sf_dir).withColumnRenamed("sym", "symbol").write.parquet(source)
    told = (F.col("files") > 0) & (F.col("input_bytes") > 0) & (F.col("output_bytes") > 0) & (F.col("rows_per_second") > 0) & (F.col("output_mib_per_second") > 0)
    return compact.rewrite_layout(spark, source, f"{target}/out", by_symbol=True).select("rows", told.alias("told"))


@query("SELECT 'trades' AS \"table\", count(*) FILTER (event_id % 7 IN (0, 4)) AS \"rows\" FROM events UNION ALL SELECT 'average_prices', count(*) FILTER (event_id % 7 = 4) FROM events UNION ALL SELECT 'futures_aggregate_trades', count(*) FILTER (event_id % 7 = 5) FROM events UNION ALL SELECT 'quarantine', count(*) FILTER (event_id % 7 IN (1, 6)) FROM events")
def m1_written_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads streamed into a store; what was counted while it was written."""
    landed, root, place = scratch(spark), scratch(spark), scratch(spark)
    _mixed(spark, sf_dir).write.json(landed)
    stream = scans.raw_payloads(spark, landed, streaming=True)
    ingest.start_ingest(stream, root, place, available_now=True).awaitTermination()
    return metrics.written_records(spark, root)


CHOSEN_SQL = f"SELECT symbol, max(event_id) AS event_id, arg_max(seq, event_id) * 2 AS last_update_id FROM ({DEPTH_SQL}) WHERE event_id % 20 = 0 AND event_id <= (SELECT max(event_id) FROM events) GROUP BY symbol"


def _at(spark: SparkSession, sf_dir: str) -> object:
    """The time of the table's last event."""
    return table(spark, sf_dir, "events").agg(F.timestamp_seconds(F.max("event_id"))).first()[0]


@query(f"SELECT 'spot' AS market, symbol, event_id * 1000 AS captured_at, last_update_id FROM ({CHOSEN_SQL})")
def b2_snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(book.snapshot_as_of(book_snapshots(spark, sf_dir), _at(spark, sf_dir)).select("market", "symbol", "captured_at", "last_update_id"))


@query(f"SELECT 'spot' AS market, e.symbol, e.event_id * 1000 AS \"at\", s.event_id * 1000 AS captured_at, s.seq * 2 AS last_update_id FROM ({DEPTH_SQL}) AS e ASOF LEFT JOIN (SELECT * FROM ({DEPTH_SQL}) WHERE event_id % 20 = 0) AS s ON e.symbol = s.symbol AND e.event_id >= s.event_id")
def b2_snapshots_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = depth(spark, sf_dir).select("market", "symbol", F.col("event_time").alias("at"))
    return plain(book.snapshots_as_of(book_snapshots(spark, sf_dir), times))


APPLIED_SQL = f"SELECT d.*, c.last_update_id FROM ({DEPTH_SQL}) AS d JOIN ({CHOSEN_SQL}) AS c ON c.symbol = d.symbol WHERE d.event_id <= (SELECT max(event_id) FROM events) AND d.seq * 2 > c.last_update_id"


def _applied(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    chosen = book.snapshot_as_of(book_snapshots(spark, sf_dir), _at(spark, sf_dir))
    return chosen, book.applicable(depth(spark, sf_dir), chosen, _at(spark, sf_dir))


@query(f"SELECT symbol, event_id, seq * 2 AS final_update_id FROM ({APPLIED_SQL})")
def b3_applicable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_applied(spark, sf_dir)[1].select("symbol", "event_id", "final_update_id"))


CHAIN_SQL = f"""SELECT symbol, event_id, u, CASE WHEN p IS NULL THEN f <= last_update_id + 1 ELSE f = p + 1 END AS chained FROM (
SELECT *, seq * 2 AS u, seq * 2 - CASE WHEN event_id % 97 = 0 THEN 0 ELSE 1 END AS f, lag(seq * 2) OVER (PARTITION BY symbol ORDER BY seq) AS p FROM ({APPLIED_SQL}))"""


@query(f"SELECT symbol, event_id, chained FROM ({CHAIN_SQL})")
def b4_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.continuity(_applied(spark, sf_dir)[1]).select("symbol", "event_id", "chained")


@query(f"""SELECT 'spot' AS market, b.symbol, c.symbol IS NOT NULL AND coalesce(ok, true) AS valid, broken_id, coalesce(n, 0) AS updates,
CASE WHEN c.symbol IS NULL THEN 'no_snapshot' WHEN NOT coalesce(bridged, true) THEN 'requires a newer snapshot' WHEN NOT coalesce(ok, true) THEN 'gap' ELSE '' END AS reason
FROM (SELECT DISTINCT symbol FROM ({DEPTH_SQL})) AS b LEFT JOIN ({CHOSEN_SQL}) AS c USING (symbol)
LEFT JOIN (SELECT symbol, bool_and(chained) AS ok, min(u) FILTER (WHERE NOT chained) AS broken_id, arg_min(chained, u) AS bridged, count(*) AS n FROM ({CHAIN_SQL}) GROUP BY symbol) AS k USING (symbol)""")
def b6_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, updates = _applied(spark, sf_dir)
    return plain(book.verdict(depth(spark, sf_dir), chosen, book.continuity(updates)))


BOOK_SQL = f"""SELECT 'spot' AS market, symbol, side, price, quantity FROM (SELECT symbol, side, price, arg_max(quantity, id) AS quantity FROM (
SELECT symbol, 'bid' AS side, bid AS price, quantity, seq * 2 AS id FROM ({APPLIED_SQL}) UNION ALL SELECT symbol, 'ask', ask, quantity, seq * 2 FROM ({APPLIED_SQL})
UNION ALL SELECT symbol, 'bid', 9.0, 7.0, -1 FROM ({CHOSEN_SQL}) UNION ALL SELECT symbol, 'ask', 99.0, 7.0, -1 FROM ({CHOSEN_SQL})) GROUP BY symbol, side, price) WHERE quantity > 0"""


@query(BOOK_SQL)
def b5_book_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(book.book_at(*_applied(spark, sf_dir)))


@query(f"SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS r FROM ({BOOK_SQL})) WHERE r <= 3")
def b7_top_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(book.top_levels(book.book_at(*_applied(spark, sf_dir)), 3).drop("rank"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b5_book_at(spark, sf_dir)
