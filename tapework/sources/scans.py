"""Sources: landed payloads, open-interest replies, order-book snapshots, table segments and the file inventory."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapework.functions.schemas import RAW, SCHEMAS, SNAPSHOT

#: Two layouts: segments in <root>/<exchange>/<market>/<table>/YYYY-MM-DD/HH, and what the sinks write: <root>[/batch=N]/<table>/market=M/date=YYYY-MM-DD/hour=HH.
#: The patterns are for the last names of a path, four for the hour and five for the others, and hold from their start: a search through a whole path takes far longer than a row to be read.
HOUR = r"^[^/]*/(?:date=(?=[^/]+/hour=))?([0-9]{4}-[0-9]{2}-[0-9]{2})/(?:hour=)?([0-9]{2})/[^/]+$"
SEGMENT_PLACE, SINK_PLACE = r"^(?:[^/]*=)?([^/=]+)/([^/=]+)/[0-9-]{10}/[0-9]{2}/[^/]+$", r"^(?:[^/]*=)?([^/=]+)/market=([^/]+)/date=[^/]+/hour=[^/]+/[^/]+$"


def _last(path: Column, names: int) -> Column:
    return F.substring_index(path, "/", -names)


def _place(path: Column, segment: int, sink: int) -> Column:
    path = _last(path, 5)
    return F.coalesce(F.nullif(F.regexp_extract(path, SEGMENT_PLACE, segment), F.lit("")), F.regexp_extract(path, SINK_PLACE, sink))


def market_of(path: Column) -> Column:
    """The market in a file's path; an empty text without one."""
    return _place(path, 1, 2)


def table_of(path: Column) -> Column:
    """The table in a file's path; an empty text without one."""
    return _place(path, 2, 1)


def raw_payloads(spark: SparkSession, path: str, streaming: bool = False, format: str = "json") -> DataFrame:
    """Payloads as they were landed, with receive time, market and shard; as a stream, new files as they come."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(RAW).format(format).load(path)


def open_interest_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("payload string, received_at timestamp, market string, request_symbol string").json(path)


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot envelopes below root, compressed or not."""
    return spark.read.schema(SNAPSHOT).option("recursiveFileLookup", "true").json(root)


def placed(df: DataFrame) -> DataFrame:
    """Rows of segment files with market, date and hour from each one's path."""
    path = F.col("_metadata.file_path")
    return df.select("*", *place_of(path))


def place_of(path: Column) -> list[Column]:
    """market, date and hour in a file's path."""
    return [market_of(path).alias("market"), F.regexp_extract(_last(path, 4), HOUR, 1).alias("date"), F.regexp_extract(_last(path, 4), HOUR, 2).alias("hour")]


def hour_places(hours: list[str], table: str = "*", market: str = "*", exchange: str = "*") -> list[str]:
    """The folders below a root that hold these hours (YYYY-MM-DD/HH), in both layouts: a few patterns for all days with the same hours, so that what stands above them is listed a few times only, however many days there are."""
    days: dict[str, set[str]] = {}
    for day, hour in (h.split("/") for h in hours):
        days.setdefault(day, set()).add(hour)
    alike: dict[tuple[str, ...], list[str]] = {}
    for day, own in days.items():
        alike.setdefault(tuple(sorted(own)), []).append(day)
    either = lambda names: names[0] if len(names) == 1 else f"{{{','.join(names)}}}"
    places = []
    for own, some in alike.items():
        hour, day = either(own), either(some)
        places.append(f"{exchange}/{market}/{table}/{day}/{hour}")
        places += [f"{batch}{table}/market={market}/date={day}/hour={hour}" for batch in ("", "batch=*/")]
    return places


def table_places(table: str, market: str = "*", exchange: str = "*") -> list[str]:
    """The folders of a table's days below a root, in both layouts."""
    return [f"{exchange}/{market}/{table}/*", *[f"{batch}{table}/market={market}/date=*" for batch in ("", "batch=*/")]]


def table_files(spark: SparkSession, root: str, table: str, market: str = "*", hours: list[str] | None = None, exchange: str = "*") -> DataFrame:
    """A table's segments and what the sinks wrote of it, with its registered columns; `_metadata.file_path` names each row's file.

    Hours as YYYY-MM-DD/HH are turned into paths, so that others are never listed. Without them days are, and what is below each is listed by one task: named hour by hour, every folder would be a task.
    """
    places = hour_places(hours, table, market, exchange) if hours else table_places(table, market, exchange)
    # Braces make one path of all: only one of the places needs to exist.
    reader = spark.read.schema(SCHEMAS[table]).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(f"{root}/{{{','.join(places)}}}")


def scan_table(spark: SparkSession, root: str, table: str, market: str = "*", hours: list[str] | None = None, exchange: str = "*") -> DataFrame:
    """The rows of table_files with market, date and hour from each one's path. What counts many rows does so by file first and finds the places behind that."""
    return placed(table_files(spark, root, table, market, hours, exchange))


def inventory(spark: SparkSession, root: str, now: dt.datetime | None = None, lookback_hours: int | None = None) -> DataFrame:
    """path, length, modified of the files below root; contents are not read. With now, only the hours from so many before it on, whose folders are named beforehand: others are not listed."""
    places, lookup = root, spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if now is not None:
        hours = [now - dt.timedelta(hours=k) for k in range((lookback_hours or 0) + 1)]
        places = f"{root}/{{{','.join(hour_places([f'{h:%Y-%m-%d/%H}' for h in hours]))}}}"
    try:
        files = lookup.load(places)
    except AnalysisException as e:
        if now is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def is_source(path: Column) -> Column:
    """Whether a file is one that compaction may merge: a segment or a sink's file, but no output of compaction, which stands below a version."""
    return path.rlike(r"(^|/)segment-[^/]*\.parquet$|/hour=[0-9]{2}/part-[^/]*\.parquet$") & ~path.rlike("/version=[^/]*/")


def plain_path(path: Column) -> Column:
    """A local path as listings write it, with one slash."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def partition_prefix(path: Column) -> Column:
    """The hour's folder of a file, without the batch of a stream, so that an hour's batches are one partition; null if the last two folders are not a day and an hour."""
    folder = F.regexp_extract(path, r"^(.*)/[^/]+$", 1)
    return F.when(partition_hour(path).isNotNull(), F.regexp_replace(folder, r"/batch=[0-9]+(?=/[^/]+/market=)", ""))


def partition_hour(path: Column) -> Column:
    path = _last(path, 4)
    text = F.concat_ws(" ", F.regexp_extract(path, HOUR, 1), F.regexp_extract(path, HOUR, 2))
    return F.when(path.rlike(HOUR), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH")))
