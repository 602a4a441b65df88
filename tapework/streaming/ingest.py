"""Streams: continuous ingest into the table store, and a stateful continuity check."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tapework.operators.store import write_tables


def start_ingest(raw: DataFrame, root: str, checkpoint: str, seconds: int = 300, available_now: bool = False) -> StreamingQuery:
    """Writes all tables of each micro-batch; the batch's number is in the path, so a batch that is run again replaces what it wrote, its counters too (`metrics.stored_counters`)."""

    def write(batch: DataFrame, number: int) -> None:
        place = f"{root}/batch={number}"
        for name, rows in zip(("counters", "written"), write_tables(batch, place, mode="overwrite"), strict=True):
            rows.coalesce(1).write.mode("overwrite").json(f"{place}/_{name}")

    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def minute_counters(decoded_rows: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Messages by minute and market of a stream."""
    return decoded_rows.withWatermark("received_at", late).groupBy(F.window("received_at", "1 minute"), "market").agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("status") == "parse_error").alias("parse_errors"))


class Chain(StatefulProcessor):
    """The chain of one book: its last id, and the updates that wait until the watermark has passed them, so that they come out in order of their ids."""

    def __init__(self, futures: bool, forget_ms: int):
        self.futures, self.forget_ms = futures, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "id long, at long")
        self.held = handle.getListState("held", "first_update_id long, final_update_id long, previous_final_update_id long, at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came = [tuple(None if pd.isna(x) else int(x) for x in row) for frame in rows for row in frame[["first_update_id", "final_update_id", "previous_final_update_id", "at"]].itertuples(index=False)]
        self.held.appendList(came)
        yield from self._released(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._released(key, timerValues.getCurrentWatermarkInMs())

    def _released(self, key: tuple, watermark: int) -> Iterator[pd.DataFrame]:
        last, at = self.last.get() if self.last.exists() else (None, None)
        held = sorted(self.held.get() if self.held.exists() else (), key=lambda r: (r[1], r[0]))
        ready, wait = [r for r in held if r[3] <= watermark], [r for r in held if r[3] > watermark]
        chained = []
        for first, final, previous, when in ready:
            chained.append(last is None or (previous == last if self.futures else first == last + 1))
            last, at = final, max(at or when, when)
        self.held.put(wait) if wait else self.held.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if last is not None and not wait and at + self.forget_ms <= watermark:
            self.last.clear()  # a book that nothing has been heard of for so long begins anew
        else:
            if last is not None:
                self.last.update((last, at))
            self.handle.registerTimer(min([r[3] for r in wait] + ([at + self.forget_ms] if last is not None else [])))
        if ready:
            columns = {c: [r[k] for r in ready] for k, c in enumerate(("first_update_id", "final_update_id"))}
            yield pd.DataFrame({"market": key[0], "symbol": key[1], **columns, "chained": chained})

    def close(self) -> None:
        pass


def continuity_stream(updates: DataFrame, futures: bool = False, late: str = "1 minute", forget: str = "1 day") -> DataFrame:
    """market, symbol, first_update_id, final_update_id, chained of a stream of depth updates, by the rule of spot or futures. A book's first update is chained.

    Updates may come in any order until `late` behind the newest event_time; they are held until then and chained in order of their ids. So what has come out is what `book.continuity` says
    of the same updates. A book's state is what it holds and one id; it is dropped `forget` after its last update. Needs RocksDB for state (spark.sql.streaming.stateStore.providerClass).
    """
    previous = F.col("previous_final_update_id").cast("long") if "previous_final_update_id" in updates.columns else F.lit(None).cast("long")
    plain = updates.select("market", "symbol", "event_time", F.col("first_update_id").cast("long"), F.col("final_update_id").cast("long"), previous.alias("previous_final_update_id"), F.unix_millis("event_time").alias("at"))
    forget_ms = int(pd.Timedelta(forget).total_seconds() * 1000)
    schema = "market string, symbol string, first_update_id long, final_update_id long, chained boolean"
    return plain.withWatermark("event_time", late).groupBy("market", "symbol").transformWithStateInPandas(Chain(futures, forget_ms), schema, "Append", "EventTime")
