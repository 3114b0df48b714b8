"""Paths on the cluster's shared storage, through Spark's own file systems."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}
_opened: ContextVar[tuple[list[str], ...]] = ContextVar("staged tables of the blocks", default=())


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Where it is unset, a local session (tests) gets a temporary folder of its own; a cluster session is refused,
    because executors on other machines could not read a machine-local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="refsync-")
    return _local_folders[application]


def new_path(spark: SparkSession, label: str) -> str:
    """Unused path in the work folder."""
    return f"{work_folder(spark)}/refsync/{label}-{uuid.uuid4().hex}"


#: Settings of writes. Shuffle files are deleted when the write has ended; else they stay until the driver collects its
#: garbage. The JVM does not compile a method of more than 8,000 bytes, as wide rows give, but would interpret it for each row:
#: such a step is run without whole-stage code, in smaller methods.
WRITE_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """`WRITE_SETTINGS` for the writes inside the block. Only for writes: a DataFrame that is run again finds its shuffle files
    gone and computes them anew.
    """
    before = {key: spark.conf.get(key, None) for key in WRITE_SETTINGS}
    for key, value in WRITE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a table; its shuffle files go with it, its own files are compressed more than by default."""
    with releasing(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def stage(df: DataFrame, label: str, keep: bool = False, outer: bool = False) -> DataFrame:
    """Write a table to the work folder and read it back. With `keep`, `discard_staged` leaves it; with `outer`, the block
    around the innermost one deletes it, if there is one.

    Cuts the lineage like a checkpoint, survives the loss of executors, and (unlike a checkpoint) stays columnar,
    so later steps read only the columns they need.
    """
    path = new_path(df.sparkSession, label)
    write_parquet(df, path)
    if not keep:
        for opened in _opened.get()[: -1 if outer else None][-1:]:
            opened.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def discard_staged(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that `stage` writes inside the block when it ends well. After a failure they stay for the
    clean-up of the work folder: a table that is still read must not vanish.
    """
    staged: list[str] = []
    token = _opened.set((*_opened.get(), staged))
    try:
        yield
        for path in staged:
            delete(spark, path)
    finally:
        _opened.reset(token)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.delete(hadoop_path, True)


def list_files(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    exclude_glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Files of a folder (or several) as (path, name, modified, length); the contents are not read.

    `exclude_glob` removes the files of a second pattern, for patterns that overlap.
    """

    def listing(pattern: str | None) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        return reader.load(path).select(
            "path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), "length"
        )

    files = listing(glob)
    if exclude_glob:
        files = files.join(listing(exclude_glob).select("path"), "path", "left_anti")
    return files


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; FileExistsError if the path is taken, so of two writers one wins."""
    file_system, target = _file_system(spark, path)
    file_system.mkdirs(target.getParent())
    if file_system.exists(target):
        raise FileExistsError(path)
    try:
        out = file_system.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or "already exists" in str(error.java_exception):
            raise FileExistsError(path) from error
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    file_system, target = _file_system(spark, path)
    stream = file_system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder; empty if there is no such folder."""
    file_system, target = _file_system(spark, folder)
    if not file_system.exists(target):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(target)]


def archive_files(spark: SparkSession, paths: Sequence[str], folder: str) -> list[str]:
    """Move processed files to a folder; a name that is taken gets a time stamp."""
    moved = []
    for path in paths:
        file_system, source = _file_system(spark, path)
        file_system.mkdirs(_file_system(spark, folder)[1])
        target = f"{folder.rstrip('/')}/{source.getName()}"
        if exists(spark, target):
            stem, dot, suffix = target.rpartition(".")
            stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
            target = f"{stem}_{stamp}{dot}{suffix}" if dot else f"{target}_{stamp}"
        if not file_system.rename(source, _file_system(spark, target)[1]):
            raise OSError(f"could not move {path} to {target}")
        moved.append(target)
    return moved


def expire_files(spark: SparkSession, folder: str, days: int, glob: str | None = None) -> list[str]:
    """Delete files of a folder that are older than `days`."""
    if not exists(spark, folder):
        return []
    limit = datetime.now(timezone.utc) - timedelta(days=days)
    old = list_files(spark, folder, glob).filter(F.col("modified") < F.lit(limit)).select("path")
    removed = [row["path"] for row in old.toLocalIterator()]
    for path in removed:
        delete(spark, path)
    return removed


def file_name_date(name, pattern: str, date_format: str):
    """Date written in a file name: `pattern` has one group around it; null when it does not parse."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), date_format)
