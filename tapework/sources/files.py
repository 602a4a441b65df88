"""Work on files as such: footers, copies, deletions. Tasks do it, a row for each file; the driver sees no list."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if re.match(r"[a-z0-9]+:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", path)))
    return pafs.LocalFileSystem(), path


def each_file(files: DataFrame, act: Callable[[dict], dict], added: str) -> DataFrame:
    """files (path and others) with the added columns (a schema string), which act returns for each row. Files are dealt over all tasks.

    A task that is lost is run again, so act must do no harm the second time; and so must not be left unwritten, as every reading of the result acts anew.
    """
    new = T.StructType.fromDDL(added)
    names = files.columns

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            made = [act(row) for row in frame.to_pylist()]
            columns = [pa.array([m[f.name] for m in made], pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in new.fields]
            yield pa.RecordBatch.from_arrays([*frame.columns, *columns], names=[*names, *new.names])

    dealt = files.repartition(max(files.sparkSession.sparkContext.defaultParallelism, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return dealt.mapInArrow(run, T.StructType([*files.schema.fields, *new.fields]))


def footers(files: DataFrame) -> DataFrame:
    """files with file_rows, file_bytes and columns (names and types in order, as text) from each Parquet file's footer; nothing else of it is read."""

    def act(row: dict) -> dict:
        fs, path = opened(row["path"])
        with fs.open_input_file(path) as f:
            found = pq.ParquetFile(f)
            return {"file_rows": found.metadata.num_rows, "file_bytes": f.size(), "columns": "\n".join(f"{c.name} {c.type}" for c in found.schema_arrow)}

    return each_file(files, act, "file_rows bigint, file_bytes bigint, columns string")


def _written(df: DataFrame, log: str) -> DataFrame:
    """Acts now, once, and keeps the result."""
    df.write.mode("overwrite").parquet(log)
    return df.sparkSession.read.schema(df.schema).parquet(log)


def _delete(fs: pafs.FileSystem, path: str) -> None:
    folder, _, name = path.rpartition("/")
    for p in (path, f"{folder}/.{name}.crc"):
        if fs.get_file_info(p).type == pafs.FileType.File:
            fs.delete_file(p)


def copied(files: DataFrame, log: str, marker: bool = False) -> DataFrame:
    """Copies files (path, target) and compares sizes; with marker, `<path>.uploaded` then names the target. Adds bytes, and error where it failed. Result rows are kept at log."""

    def act(row: dict) -> dict:
        try:
            (fs, path), (to, target) = opened(row["path"]), opened(row["target"])
            to.create_dir(target.rpartition("/")[0], recursive=True)
            # Under another name first: what bears the name is whole.
            pafs.copy_files(path, f"{target}.part", source_filesystem=fs, destination_filesystem=to)
            to.move(f"{target}.part", target)
            size, there = (x.get_file_info(p).size for x, p in ((fs, path), (to, target)))
            if size != there:
                return {"bytes": there, "error": f"{row['target']} has {there} bytes, {row['path']} has {size}"}
            if marker:
                with fs.open_output_stream(f"{path}.uploaded") as f:
                    f.write(f"{row['target']}\n".encode())
            return {"bytes": size, "error": None}
        except (OSError, pa.ArrowException) as e:
            return {"bytes": None, "error": f"{row['path']}: {e}"[:500]}

    return _written(each_file(files, act, "bytes bigint, error string"), log)


def deleted(files: DataFrame, log: str, markers: bool = False) -> DataFrame:
    """Deletes files (path), which may be gone already, with markers also `<path>.uploaded`. Adds error where it failed. Result rows are kept at log."""

    def act(row: dict) -> dict:
        try:
            fs, path = opened(row["path"])
            _delete(fs, path)
            if markers:
                _delete(fs, f"{path}.uploaded")
            return {"error": None}
        except (OSError, pa.ArrowException) as e:
            return {"error": f"{row['path']}: {e}"[:500]}

    return _written(each_file(files, act, "error string"), log)


def refuse_errors(done: DataFrame) -> DataFrame:
    """done, if nothing failed; else an error that tells how many files did, and of one why."""
    bad = done.filter("error IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).first()
    if bad.n:
        raise OSError(f"{bad.n} files failed; {bad.error}")
    return done


def renamed(spark: SparkSession, old: str, new: str) -> None:
    """Renames a folder: it is there whole or not at all."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(new).getParent())
    if not fs.rename(path(old), path(new)):
        raise OSError(f"{old} could not be renamed to {new}")


def exists(spark: SparkSession, folder: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def absolute(spark: SparkSession, folder: str) -> str:
    """A folder's path with its scheme, as listings write it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def removed(spark: SparkSession, folder: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below the session's spark.checkpoint.dir. Where that is unset, a local one, but on a local master only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{shared}/{uuid.uuid4().hex}"
