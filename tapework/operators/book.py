"""Order books: levels, the snapshot as of a time, the updates behind it, their continuity, and the book at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapework.functions.coerce import decimal_trunc18
from tapework.functions.schemas import SCHEMAS
from tapework.operators.normalise import enforced

KEY = ["market", "symbol"]
#: Slices that the books' rows are cut into at most.
MOST_SLICES = 1000


def levels(updates: DataFrame) -> DataFrame:
    """A row for each side and level of depth updates; columns of no level table (a market) stay in front."""
    def side(name: str, column: str) -> DataFrame:
        each = F.posexplode(F.from_json(column, "array<array<string>>"))
        return updates.select(*[c for c in updates.columns if c not in ("bids", "asks", "source", "symbol_type", "target_market")], "source", each.alias("level", "pair_")).select(
            *[c for c in updates.columns if c not in ("bids", "asks", "source", "symbol_type", "target_market")], F.lit(name).alias("side"), "level", decimal_trunc18(F.get("pair_", F.lit(0))).alias("price"), decimal_trunc18(F.get("pair_", F.lit(1))).alias("quantity"), "source",
        )

    return side("bid", "bids").unionByName(side("ask", "asks"))


def level_table(updates: DataFrame, name: str) -> DataFrame:
    """The rows of depth_levels or futures_depth_levels, with that table's columns, of depth updates of the same kind."""
    return enforced(levels(updates).select(*[F.col(c) for c in SCHEMAS[name].names]), name)


def snapshot_as_of(snapshots: DataFrame, at: object) -> DataFrame:
    """The newest snapshot of each book until `at`; of equally new ones, that with the larger id."""
    old = snapshots.filter(F.col("captured_at") <= F.lit(at).cast("timestamp"))
    columns = [c for c in snapshots.columns if c not in KEY]
    return old.groupBy(*KEY).agg(F.max_by(F.struct(*columns), F.struct("captured_at", "last_update_id")).alias("s")).select(*KEY, "s.*")


def _edges(df: DataFrame, by: Column) -> list[float]:
    """Values of `by` that cut all rows into about as many equal slices as there are shuffle partitions."""
    n = min(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2), MOST_SLICES)
    found = df.agg(F.percentile_approx(by.cast("double"), [k / n for k in range(1, n)], 10 * n).alias("e")).first().e
    return sorted(set(found or []))


def _slice(by: Column, edges: list[float]) -> Column:
    """The slice of a value: how many edges are below it. Larger values are in no earlier slice."""
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < by.cast("double"))) if edges else F.lit(0)


def _carried(df: DataFrame, value: Column) -> DataFrame:
    """Of each book and slice of df: what the slices before it hold last, `value` being the last of a slice. One row a slice passes through a book's window, whatever its rows."""
    last = df.groupBy(*KEY, "__slice").agg(value.alias("__last"))
    before = F.last("__last", ignorenulls=True).over(W.partitionBy(*KEY).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1))
    return last.select(*[F.col(c).alias(f"__{c}") for c in KEY], F.col("__slice").alias("__s"), before.alias("__before"))


def _with_before(df: DataFrame, value: Column) -> DataFrame:
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in KEY] + [F.col("__slice") == F.col("__s")]
    return df.join(_carried(df, value), same, "left").drop(*[f"__{c}" for c in KEY], "__s")


def snapshots_as_of(snapshots: DataFrame, times: DataFrame) -> DataFrame:
    """times (market, symbol, at) and the newest snapshot's last_update_id and captured_at, by one pass over both; no join by range.

    Books are cut into slices of time, each a window of its own; what a slice does not see itself is carried from those before it. So a book with a very large history is many tasks.
    """
    s = snapshots.select(*KEY, F.col("captured_at").alias("t"), F.struct("captured_at", "last_update_id").alias("s"), F.lit(0).alias("asks"))
    q = times.select(*KEY, F.col("at").alias("t"), F.lit(None).cast(s.schema["s"].dataType).alias("s"), F.lit(1).alias("asks"))
    both = s.unionByName(q)
    both = both.withColumn("__slice", _slice(F.unix_micros("t"), _edges(both, F.unix_micros("t"))))
    w = W.partitionBy(*KEY, "__slice").orderBy("t", "asks", F.col("s.last_update_id")).rowsBetween(W.unboundedPreceding, 0)
    found = _with_before(both, F.max("s")).withColumn("s", F.coalesce(F.last("s", ignorenulls=True).over(w), F.col("__before")))
    return found.filter("asks = 1").select(*KEY, F.col("t").alias("at"), "s.captured_at", "s.last_update_id")


def applicable(updates: DataFrame, chosen: DataFrame, at: object) -> DataFrame:
    """Updates after each book's snapshot, until `at`; snapshots are one row a book."""
    ids = chosen.select(*KEY, "last_update_id")
    return updates.filter(F.col("event_time") <= F.lit(at).cast("timestamp")).join(ids, KEY).filter(F.col("final_update_id") > F.col("last_update_id"))


def continuity(updates: DataFrame, futures: bool = False) -> DataFrame:
    """updates (with last_update_id of their snapshot) and `chained`: whether each follows the one before, and the first bridges the snapshot.

    Books are cut into slices of ids, each a window of its own; its first row follows the last id of the slices before. So a book with very many updates is many tasks.
    """
    id_ = F.col("final_update_id")
    cut = updates.withColumn("__slice", _slice(id_, _edges(updates, id_)))
    own = F.lag(id_).over(W.partitionBy(*KEY, "__slice").orderBy("final_update_id", "first_update_id"))
    cut = _with_before(cut, F.max(id_)).withColumn("__before", F.coalesce(own, F.col("__before")))
    before = F.col("__before")
    if futures:
        good = F.when(before.isNull(), F.col("previous_final_update_id") <= F.col("last_update_id")).otherwise(F.col("previous_final_update_id") == before)
    else:
        good = F.when(before.isNull(), F.col("first_update_id") <= F.col("last_update_id") + 1).otherwise(F.col("first_update_id") == before + 1)
    return cut.withColumn("chained", good).drop("__slice", "__before")


def verdict(books: DataFrame, chosen: DataFrame, chain: DataFrame) -> DataFrame:
    """For each book: valid, broken_id, updates and reason. It never says that a book is complete."""
    found = chain.groupBy(*KEY).agg(F.bool_and("chained").alias("ok"), F.min(F.when(~F.col("chained"), F.col("final_update_id"))).alias("broken_id"), F.min_by("chained", "final_update_id").alias("bridged"), F.count(F.lit(1)).alias("n"))
    has = chosen.select(*KEY, F.lit(True).alias("has"))
    df = books.select(*KEY).distinct().join(has, KEY, "left").join(found, KEY, "left")
    reason = F.when(F.col("has").isNull(), "no_snapshot").when(~F.coalesce("bridged", F.lit(True)), "requires a newer snapshot").when(~F.coalesce("ok", F.lit(True)), "gap")
    return df.select(*KEY, (F.col("has").isNotNull() & F.coalesce("ok", F.lit(True))).alias("valid"), "broken_id", F.coalesce("n", F.lit(0)).alias("updates"), F.coalesce(reason, F.lit("")).alias("reason"))


def book_at(chosen: DataFrame, updates: DataFrame, bids: str = "$.bids", asks: str = "$.asks") -> DataFrame:
    """market, symbol, side, price, quantity: of each price the last write, snapshot levels being the oldest; empty prices are gone, and levels whose price is no number."""
    def side(df: DataFrame, name: str, text: Column, id_: Column) -> DataFrame:
        rows = df.select(*KEY, F.lit(name).alias("side"), id_.alias("id"), F.posexplode(F.from_json(text, "array<array<string>>")).alias("level", "x"))
        return rows.select(*KEY, "side", "id", "level", decimal_trunc18(F.get("x", F.lit(0))).alias("price"), decimal_trunc18(F.get("x", F.lit(1))).alias("quantity"))

    old, new = F.lit(-1).cast("decimal(20,0)"), F.col("final_update_id").cast("decimal(20,0)")
    rows = side(chosen, "bid", F.get_json_object("payload", bids), old).unionByName(side(chosen, "ask", F.get_json_object("payload", asks), old))
    rows = rows.unionByName(side(updates, "bid", F.col("bids"), new)).unionByName(side(updates, "ask", F.col("asks"), new))
    return rows.filter("price IS NOT NULL").groupBy(*KEY, "side", "price").agg(F.max_by("quantity", F.struct("id", "level")).alias("quantity")).filter("quantity > 0")


def top_levels(book: DataFrame, n: int = 1) -> DataFrame:
    """The n best levels of each side: highest bids, lowest asks."""
    best = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    return book.withColumn("rank", F.row_number().over(W.partitionBy(*KEY, "side").orderBy(best))).filter(F.col("rank") <= n)
