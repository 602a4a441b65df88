"""From raw payloads to typed event tables. Stateless projections, for batch and streaming DataFrames alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapework.functions.coerce import decimal_trunc18, i64_or_zero, marked, millis_or, quoted, read, text_of, unmarked, unquoted
from tapework.functions.schemas import SCHEMAS, TABLES, Table

#: An event: its JSON text, and whether that is a payload which holds it under `data`.
EVENT = "struct<text:string,wrapped:boolean>"
#: What a variant is read as to tell an object, which it is if this is not null, and its type.
OBJECT = "struct<e:variant>"
#: Stands behind a payload while it is parsed; a payload that holds it is refused.
END = "~end of payload~"
FUTURES = ("usdm", "coinm")
TYPES = {rules: sorted({e for t in TABLES.values() if t.rules == rules for e in t.events if e}) for rules in ("spot", "futures")}


def _known(rules: str) -> Column:
    return F.array(*[F.lit(e) for e in TYPES[rules]])


def _type(e: Column) -> Column:
    return F.when(quoted(e), text_of(e)).otherwise("")


def _nested_ok(kind: Column, get: Callable[[str, str], Column]) -> Column:
    """Whether the nested object of an event that uses one is an object or missing. Of other events the same key is a price."""
    ok = lambda key: get(key, OBJECT).isNotNull() | get(key, "string").isNull()
    return F.when(kind == "kline", ok("k")).when(kind == "forceOrder", ok("o")).otherwise(True)


def decoded(raw: DataFrame) -> DataFrame:
    """raw (payload, received_at, market, shard_id) and stream, events and their types (in order), status: ok, control, ignored or parse_error.

    A payload is an event, an array of events, or either under `data` beside its `stream`. One bad element spoils its whole payload. A payload without rows is control
    if it has a result or code, else ignored.
    """
    # Parsed as an array of the payload and END: a value is followed by END only if it is the whole payload. A parser by itself leaves trailing text unnoticed.
    both = F.try_parse_json(F.when(~F.contains("payload", F.lit(END)), F.concat(F.lit("["), F.col("payload"), F.lit(f',"{END}"]'))))
    df = raw.withColumn("__both", both)
    # Only what tells kinds apart is taken out of the parsed payload. Values are read from its text, by the tables.
    at = lambda path, kind: F.try_variant_get("__both", f"$[0]{path}", kind)
    df = df.select("*", (F.try_variant_get("__both", "$[1]", "string") == END).alias("__whole"), at(".data", OBJECT).alias("__data"), F.when(at(".data", OBJECT).isNull(), at(".data", "array<variant>")).alias("__list"))
    wrapped = F.col("__data").isNotNull() | F.col("__list").isNotNull() | at(".data", "string").isNotNull()
    df = df.withColumn("__wrapped", wrapped)
    df = df.select(
        "*", F.when(F.col("__wrapped"), F.coalesce(at(".stream", "string"), F.lit(""))).otherwise("").alias("stream"),
        F.when(F.col("__wrapped"), F.col("__data")).otherwise(at("", OBJECT)).alias("__one"), F.when(F.col("__wrapped"), F.col("__list")).otherwise(at("", "array<variant>")).alias("__many"),
    )
    several = F.col("__many").isNotNull()
    get = lambda e: lambda key, kind: F.try_variant_get(e, f"$.{key}", kind)
    own = lambda key, kind: F.when(F.col("__wrapped"), at(f".data.{key}", kind)).otherwise(at(f".{key}", kind))
    df = df.withColumn("__type", _type(F.col("__one")["e"]))
    df = df.withColumn("types", F.when(several, F.transform("__many", lambda e: _type(get(e)("e", "variant")))).otherwise(F.array("__type")))
    each = F.forall("__many", lambda e: F.try_variant_get(e, "$", OBJECT).isNotNull() & _nested_ok(_type(get(e)("e", "variant")), get(e)))
    whole = F.when(several, each).otherwise(F.col("__one").isNotNull() & _nested_ok(F.col("__type"), own))
    df = df.withColumn("valid", F.coalesce(F.col("__whole") & whole, F.lit(False)))
    text = F.when(several, F.transform("__many", lambda e: F.struct(F.to_json(e).alias("text"), F.lit(False).alias("wrapped")))).otherwise(F.array(F.struct(F.col("payload").alias("text"), F.col("__wrapped").alias("wrapped"))))
    df = df.withColumn("events", F.when(F.col("valid"), text))
    futures = F.col("market").isin(*FUTURES) & F.arrays_overlap("types", _known("futures"))
    df = df.withColumn("rules", F.when(F.col("valid") & futures, "futures").otherwise("spot"))
    # As has_table says of one type. Without a function over the array, which Spark would interpret for every row.
    ticker = F.array_contains("types", "") & F.contains("stream", F.lit("@bookTicker"))
    rows = F.when(F.col("rules") == "spot", F.arrays_overlap("types", _known("spot")) | ticker).otherwise(F.arrays_overlap("types", _known("futures")))
    says = lambda get: get("result", "variant").isNotNull() | get("code", "variant").isNotNull()
    control = F.when(several, F.exists("__many", lambda e: says(get(e)))).otherwise(says(own))
    status = F.when(~F.col("valid"), "parse_error").when(rows, "ok").when(control, "control").otherwise("ignored")
    made = df.withColumn("status", status).select(*raw.columns, F.array(F.struct("stream", "events", "types", "rules", "status")).alias("__made"))
    # Filters on what is computed here would be moved in front of it and parse the payload again for each mention; they stop at a generator.
    # The raw columns pass beside it, so that filters on them reach the scan.
    return made.select(*raw.columns, F.inline_outer("__made"))


def has_table(kind: Column) -> Column:
    """Whether events of this type make a row, under the payload's rules and stream."""
    ticker = (kind == "") & F.contains("stream", F.lit("@bookTicker"))
    # No isin: where a function over an array has it, Spark walks its whole list of expressions for every element.
    return F.when(F.col("rules") == "spot", F.array_contains(_known("spot"), kind) | ticker).otherwise(F.array_contains(_known("futures"), kind))


def quarantined(decoded_rows: DataFrame) -> DataFrame:
    return decoded_rows.filter("status = 'parse_error'").select("payload", "received_at", "market", "shard_id")


def exploded(decoded_rows: DataFrame) -> DataFrame:
    """A row for each event of the payloads that gave rows."""
    return decoded_rows.filter("status = 'ok'").select("received_at", "market", "shard_id", "stream", "rules", F.posexplode(F.arrays_zip("events", "types")).alias("position", "e")).select("received_at", "market", "shard_id", "stream", "rules", "position", F.col("e.events").alias("event"), F.col("e.types").alias("type"))


QUARANTINE = "quarantine"


def dealt(decoded_rows: DataFrame) -> DataFrame:
    """The rows of exploded and quarantined together, with the table that each belongs to; events of no table and payloads without rows are left out."""
    kind, known = F.col("type"), F.lit(None).cast("string")
    for name, table in TABLES.items():
        mine = (F.col("rules") == table.rules) & (F.contains("stream", F.lit("@bookTicker")) & (kind == "") if name == "book_tickers" else kind.isin(*table.events))
        known = F.when(mine, name).otherwise(known)
    bad = F.col("status") == "parse_error"
    entries = F.when(F.col("status") == "ok", F.arrays_zip("events", "types"))
    # A payload in quarantine is one entry without an event.
    entries = F.when(bad, F.array(F.struct(F.lit(None).cast(EVENT).alias("events"), F.lit("").alias("types")))).otherwise(entries)
    each = decoded_rows.select("received_at", "market", "shard_id", "stream", "rules", F.when(bad, F.col("payload")).alias("payload"), bad.alias("bad"), F.posexplode(entries).alias("position", "e"))
    each = each.select("received_at", "market", "shard_id", "stream", "rules", "position", F.col("e.events").alias("event"), F.col("e.types").alias("type"), "payload", "bad")
    return each.withColumn("table", F.when(F.col("bad"), QUARANTINE).otherwise(known)).filter(F.col("table").isNotNull()).drop("bad")


def source_label(market: Column, transport: str = "websocket") -> Column:
    return F.concat(F.lit("binance_"), market, F.lit(f"_{transport}"))


def routed_market(symbol_type: Column, market: Column) -> Column:
    return F.when(symbol_type == 1, "usdm").when(symbol_type == 2, "coinm").otherwise(market)


def table_rows(events: DataFrame, name: str) -> DataFrame:
    """The rows of one table, with its columns in order and target_market behind them."""
    table = TABLES[name]
    event, rx, spot = F.col("event"), F.col("received_at"), table.rules == "spot"
    df = events.filter((F.col("rules") == table.rules) & F.col("type").isin(*table.events))
    if name == "book_tickers":
        df = df.filter(F.contains("stream", F.lit("@bookTicker")))
    # Values are taken out of the event's text as texts, at once; what follows reads plain columns and stays small enough for code generation. JSON values are read beside them.
    keys = list(dict.fromkeys([*(c.key for c in table.columns if c.key and c.rule != "j"), *(["st"] if not spot else []), *([f"{table.nested}.st"] if table.nested and not spot else [])]))
    lists = [c.key for c in table.columns if c.rule == "j"]
    name_of = {k: f"v_{i}" for i, k in enumerate([*keys, *lists])}
    value = _values(event, marked(event["text"]), keys, "string", name_of)
    parts = [value.alias("__texts")] + ([_values(event, event["text"], lists, "variant", name_of).alias("__lists")] if lists else [])
    df = df.select("received_at", "market", "type", F.inline_outer(F.array(F.struct(*parts))))
    inside = lambda k: F.col("__lists" if k in lists else "__texts")[name_of[k]] if "." not in k else F.col("__texts")["inner"][name_of[k]]
    quoted_only = {c.key for c in table.columns if c.rule in ("s", "d")}
    texts = {k: (unquoted if k in quoted_only else unmarked)(inside(k)).alias(f"t_{name_of[k]}") for k in keys}
    values = df.select("received_at", "market", "type", *[inside(k).alias(n) for k, n in name_of.items()], *texts.values())
    text = lambda k: F.col(f"t_{name_of[k]}") if k in texts else None
    timed = list(dict.fromkeys(c.key for c in table.columns if c.rule == "t"))
    values = values.select("*", *[i64_or_zero(text(k)).alias(f"n_{name_of[k]}") for k in timed])
    number = lambda k: F.col(f"n_{name_of[k]}") if k in timed else None
    made = {"rx": rx, "src": source_label(F.col("market")), "w": F.regexp_replace("type", "Ticker$", "")}
    if not spot:
        # What stands outside counts before what stands in the nested object.
        places = [k for k in ("st", f"{table.nested}.st") if k in keys]
        first = F.coalesce(*[text(k) for k in places])
        made["st"] = read(first, "st", spot, rx, first)
    target = F.col("market") if spot else routed_market(i64_or_zero(first), F.col("market"))
    columns = [(read(F.col(name_of[c.key]), c.rule, spot, rx, text(c.key), number(c.key)) if c.key else made[c.rule]).alias(c.name) for c in table.columns]
    return values.select(*columns, target.alias("target_market"))


def _values(event: Column, json: Column, keys: list[str], kind: str, name_of: dict[str, str]) -> Column:
    """The values of an event's keys, read from json, with the fields name_of; those of nested objects in the field inner."""
    flat, nested = [k for k in keys if "." not in k], [k for k in keys if "." in k]
    fields, names = [f"`{k}`:{kind}" for k in flat], [f"{name_of[k]}:{kind}" for k in flat]
    if nested:
        fields.append(f"`{nested[0].partition('.')[0]}`:struct<{','.join(f'`{k.partition(".")[2]}`:{kind}' for k in nested)}>")
        names.append(f"inner:struct<{','.join(f'{name_of[k]}:{kind}' for k in nested)}>")
    bare = f"struct<{','.join(fields)}>"
    found = F.when(event["wrapped"], F.from_json(json, f"struct<data:{bare}>")["data"]).otherwise(F.from_json(json, bare))
    # Keys that differ in case only are told apart by place.
    return found.cast(f"struct<{','.join(names)}>")


def open_interest(raw: DataFrame, market_default: str = "usdm") -> DataFrame:
    """futures_open_interest from REST bodies: raw (payload, received_at, market, request_symbol)."""
    keys = ("symbol", "pair", "contractType", "openInterest", "time")
    body = F.from_json(marked(F.col("payload")), f"struct<{','.join(f'{k}:string' for k in keys)},broken:string>", {"columnNameOfCorruptRecord": "broken"})
    # A generator, so that filters and columns do not parse the payload again for each mention.
    df = raw.select("received_at", "market", "request_symbol", F.rlike("payload", F.lit(r"^\s*[{]")).alias("object"), F.inline_outer(F.array(body))).filter("object AND broken IS NULL")
    df = df.withColumns({"time": unmarked(F.col("time")), "openInterest": unquoted(F.col("openInterest"))})
    rx = F.col("received_at")
    time = F.when(F.rlike("time", F.lit(r"^[+-]?[0-9]+\z")), F.regexp_replace("time", "^[+]", "").try_cast("bigint"))
    df = df.withColumn("time", time)
    observed = F.when(F.col("time").isNull(), rx).otherwise(millis_or(F.col("time"), rx, F.timestamp_millis(F.lit(0).cast("bigint"))))
    market = F.coalesce("market", F.lit(market_default))
    return df.select(
        observed.alias("observed_at"), rx.alias("received_at"), F.coalesce(unquoted(F.col("symbol")), F.col("request_symbol")).alias("symbol"), F.coalesce(unquoted(F.col("pair")), F.lit("")).alias("pair"),
        F.coalesce(unquoted(F.col("contractType")), F.lit("")).alias("contract_type"), decimal_trunc18(F.col("openInterest")).alias("open_interest"), source_label(market, "rest_poll").alias("source"), market.alias("target_market"),
    )


def tradable_symbols(instruments: DataFrame) -> DataFrame:
    """Distinct symbols that trade, from instrument rows: exchange, market, body (JSON). An empty result is for the caller to refuse."""
    m = F.from_json("body", "map<string,variant>")
    s = lambda key: F.when(quoted(F.col("m")[key]), text_of(F.col("m")[key]))
    flag = F.coalesce(F.try_variant_get(F.col("m")["isSpotTradingAllowed"], "$", "boolean"), F.lit(False))
    rule = (
        F.when(F.col("exchange") == "okx", s("state") == "live")
        .when(F.col("exchange") == "bybit", s("status") == "Trading")
        .when(F.col("market") == "spot", (s("status") == "TRADING") & flag)
        .otherwise(F.coalesce(s("status"), s("contractStatus")) == "TRADING")
    )
    name = F.when(F.col("exchange") == "okx", s("instId")).otherwise(s("symbol"))
    return instruments.withColumn("m", m).filter(rule).select("exchange", "market", name.alias("symbol")).filter("symbol IS NOT NULL").distinct().orderBy("exchange", "market", "symbol")


def enforced(df: DataFrame, name: str) -> DataFrame:
    """df with exactly the columns of a registered table, cast to its types; an error for an unknown table or other columns."""
    if name not in SCHEMAS:
        raise ValueError(f"unknown table {name}")
    wanted = SCHEMAS[name]
    if sorted(df.columns) != sorted(wanted.names):
        raise ValueError(f"{name} has {len(wanted)} columns {wanted.names}, not {df.columns}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])
