"""What the operators of this subpackage share: reading tables, cutting lineage, columns made from texts, small column helpers."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lets Spark delete the shuffle files of a write once it is done; what was written is read from then on.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that reach Python at a time where they carry whole texts: a batch is held several times over, in the JVM and in Python.
FEW_TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
#: Bits of a sieve, in rows of 32768: 4 MB in all, whatever the number of ids.
SIEVE = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. Where it is unset, a new local one, but on a local master only."""
    sc = spark.sparkContext
    chosen = sc.getCheckpointDir()
    if not chosen:
        chosen = spark.conf.get("spark.checkpoint.dir", None)
        if not chosen:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            chosen = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(chosen)
        chosen = sc.getCheckpointDir()
    return chosen


@contextmanager
def setting(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session, as they were before once done."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy(spark: SparkSession):
    """Inside, a finished write leaves no shuffle files behind."""
    return setting(spark, {CLEANUP: "true"})


def stored(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage is cut and a lost executor costs no more than a re-read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    with tidy(spark):
        df.write.options(**(options or {})).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def forget(*frames: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "stored_at", None):
            delete(df.sparkSession, path)


def made_from(df: DataFrame, source: str | list[str], make: Callable[..., dict[str, pa.Array]], added: str, keep: list[str] | None = None) -> DataFrame:
    """df's columns (those in keep, or all) and the added ones (a schema string), which make returns for lists of the source columns' values.

    Kept columns stay Arrow arrays from end to end: no integer beside a null becomes a float, no time changes its zone. Kept columns named like added
    ones give way to them.
    """
    sources = [source] if isinstance(source, str) else source
    new = T.StructType.fromDDL(added)
    names = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    sent = df.select(*[F.col(f"`{c}`") for c in [*names, *[c for c in sources if c not in names]]])
    at = [sent.columns.index(c) for c in sources]
    wanted = T.StructType([*sent.schema.fields[: len(names)], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = make(*[batch.column(i).to_pylist() for i in at])
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], *[columns[n] for n in new.names]], names=[*names, *new.names])

    return sent.mapInArrow(run, wanted)


def sifted(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose `column` (a long) may be among those of ids: every one that is, and some that are not.

    The sieve is a bitmap over hashes of the ids, so what is broadcast has a fixed bound; the more ids, the more other rows pass. It stands before a join that
    would shuffle all of df for a few ids and takes nothing from that join's result. Null is among no ids.
    """
    spot = F.pmod(F.xxhash64(column), F.lit(SIEVE))
    marks = ids.filter(F.col(column).isNotNull()).select(F.bitmap_bucket_number(spot).alias("__bucket"), F.bitmap_bit_position(spot).alias("__bit"))
    # Dealt by row of the bitmap first: partial bitmaps of every task would be larger than the ids.
    bitmap = marks.repartition(partitions(df.sparkSession), "__bucket").groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    near = df.filter(F.col(column).isNotNull()).join(F.broadcast(bitmap), F.bitmap_bucket_number(spot) == F.col("__bucket"))
    return near.filter(F.getbit(byte, (at % 8).cast("int")) == 1).select(*df.columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column, gap: str) -> Column:
    """The words of a text that stand between gaps (a character class, as a pattern); none for null."""
    body = F.regexp_replace(text, f"^{gap}+|{gap}+$", "")
    return F.when(body.isNull() | (body == ""), F.array().cast("array<string>")).otherwise(F.split(body, f"{gap}+"))


def worker_memo() -> dict:
    """A dict that lives as long as the Python worker process, so that its next tasks find what earlier ones have loaded."""
    return sys.modules.setdefault("tapework_worker_memo", types.ModuleType("tapework_worker_memo")).__dict__
