"""Dropped files to DataFrames: every column arrives as text, with file name and row number."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refsync.operators import clean
from refsync.sources.storage import list_files

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Files:
    """Rows of a set of files, the paths they come from, and the paths that could not be read."""

    rows: DataFrame | None
    paths: list[str]
    unreadable: list[str] = field(default_factory=list)
    chosen: list[Row] = field(default_factory=list)  # path, name, modified, length of the files to apply
    superseded: list[Row] = field(default_factory=list)  # older files that a newer one replaces
    waiting: int = 0  # files left for the next run


def file_name() -> Column:
    """Name of the file a row comes from. Spark's metadata column has it percent-encoded ('a%20b'), '+' as it is."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def with_source_file(df: DataFrame, name: str = "source_file", stem: bool = False) -> DataFrame:
    """Add the name of the file a row comes from (without its extension when `stem`)."""
    return df.withColumn(name, F.regexp_replace(file_name(), r"\.[^.]+$", "") if stem else file_name())


# The row counts of the blocks are broadcast when there cannot be more blocks than this (about 100 MB).
MAX_BROADCAST_BLOCKS = 1_000_000


def block_bound(spark: SparkSession, paths: Sequence[str]) -> int | None:
    """Most blocks that a scan of these files can have; None when the session's sizes are not plain numbers."""
    try:
        smallest = min(
            int(spark.conf.get(f"spark.sql.files.{key}").rstrip("bB")) for key in ("openCostInBytes", "maxPartitionBytes")
        )
    except ValueError:
        return None
    lengths = spark.read.format("binaryFile").load(list(paths)).select("length")
    blocks = F.ceil(F.col("length") / F.lit(max(smallest, 1))) + 1
    return lengths.agg(F.sum(blocks)).first()[0]


def with_row_index(
    df: DataFrame, file_format: str, name: str = "row_index", few_blocks: bool = False
) -> DataFrame:
    """Add the 1-based row number inside the file.

    Parquet knows it. In text files rows are numbered inside each block the file is split into (the running id
    of a scan has no gaps there), and the block gets the number of rows before it in its file. That needs only
    the row counts of the blocks, so a very large file is never numbered by one task. `few_blocks` says that the
    number of blocks was checked: their counts are broadcast and the rows are not shuffled.
    """
    if file_format == "parquet":
        return df.withColumn(name, F.col("_metadata.row_index") + 1)
    located = df.withColumns(
        {
            "__file": F.col("_metadata.file_path"),
            "__block": F.col("_metadata.file_block_start"),
            "__id": F.monotonically_increasing_id(),
        }
    )
    blocks = located.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__rows"), F.min("__id").alias("__first"))
    # One row per block of a file (128 MB by default): the window sees block counts, never rows.
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("__rows").over(earlier)
    offsets = blocks.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__rows")
    # A block is one split of one file, so no (file, block) group can be large.
    numbered = located.join(F.broadcast(offsets) if few_blocks else offsets, ["__file", "__block"])
    return numbered.withColumn(name, F.col("__id") - F.col("__first") + F.col("__before") + 1).drop(
        "__file", "__block", "__id", "__first", "__before"
    )


BAD_ROW = "__bad_row"


def _reader(spark: SparkSession, file_format: str, multi_line: bool = False):
    reader = spark.read.format(file_format)
    if file_format == "csv":
        return reader.option("header", "true").option("multiLine", str(multi_line).lower()).option("columnNameOfCorruptRecord", BAD_ROW)
    if file_format == "json":
        return reader.option("primitivesAsString", "true")
    return reader


def _parsed(spark: SparkSession, file_format: str, schema: T.StructType, paths: Sequence[str], multi_line: bool) -> DataFrame:
    """Rows of files with one header; in CSV, `__bad_row` holds the text of rows that do not fit it."""
    if file_format == "csv":
        schema = T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])
    return _reader(spark, file_format, multi_line).schema(schema).load(list(paths))


def _is_bad(schema: T.StructType) -> Column:
    """Whether a CSV row does not fit its header. It reads all columns: with some of them pruned away, Spark's parser
    would not see that a row has too many.
    """
    every = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]) < F.lit(-(1 << 63))  # never
    return F.col(BAD_ROW).isNotNull() | every


def _read_group(
    spark: SparkSession,
    file_format: str,
    schema: T.StructType,
    paths: Sequence[str],
    source: str,
    stem: bool,
    index: str,
    on_bad_rows: str,
    multi_line: bool,
) -> DataFrame:
    rows = _parsed(spark, file_format, schema, paths, multi_line)
    bound = None if file_format == "parquet" else block_bound(spark, paths)
    few_blocks = bound is not None and bound <= MAX_BROADCAST_BLOCKS
    rows = with_row_index(with_source_file(rows, source, stem), file_format, index, few_blocks)
    if file_format == "csv":
        bad = _is_bad(schema)
        if on_bad_rows == "fail":
            message = F.concat(F.lit("row that does not fit its header in "), source, F.lit(": "), F.substring(BAD_ROW, 1, 200))
            rows = rows.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        else:
            rows = rows.filter(~bad)
    text = [
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        else F.to_json(f"`{f.name}`").alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*text, source, index)


def quarantined_rows(spark: SparkSession, paths: Sequence[str], source: str = "source_file", multi_line: bool = False) -> DataFrame:
    """(file name, text) of the CSV rows that do not fit the header of their file."""
    found = None
    for schema, members in _by_header(spark, paths, "csv", "fail", multi_line)[0]:
        if not schema.fields:
            continue
        rows = with_source_file(_parsed(spark, "csv", schema, members, multi_line), source)
        own = rows.filter(_is_bad(schema)).select(source, F.col(BAD_ROW).alias("text"))
        found = own if found is None else found.union(own)
    return found if found is not None else spark.createDataFrame([], f"`{source}` string, text string")


def choose_files(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    exclude_glob: str | None = None,
    recursive: bool = False,
    max_files: int | None = None,
    newest_only: bool = False,
    applied: DataFrame | None = None,
) -> Files:
    """The files to read in this run (without rows), those that wait, and those that a newer one supersedes.

    A file is the same as before only if path, time of modification and length are: `applied` has these columns. Names
    may be used again. With `newest_only`, the file modified last counts, whether it was applied before or not; the
    others are superseded. Otherwise at most `max_files` are taken, in name order.
    """
    same = ["path", "modified", "length"]
    files = list_files(spark, path, glob, exclude_glob, recursive)
    fresh = files.join(applied.select(*same).distinct(), same, "left_anti") if applied is not None else files
    fresh = fresh.orderBy("name", "path").collect() if newest_only or not max_files else fresh.orderBy("name", "path").limit(max_files + 1).collect()
    if newest_only:
        newest = files.orderBy(F.desc("modified"), F.desc("name"), "path").first()
        chosen = [f for f in fresh if newest is not None and f["path"] == newest["path"]]
        return Files(None, [f["path"] for f in chosen], chosen=chosen, superseded=[f for f in fresh if f not in chosen])
    if not max_files or len(fresh) <= max_files:
        return Files(None, [f["path"] for f in fresh], chosen=fresh)
    left = files.join(applied.select(*same).distinct(), same, "left_anti") if applied is not None else files
    chosen = fresh[:max_files]
    return Files(None, [f["path"] for f in chosen], chosen=chosen, waiting=left.count() - max_files)


def select_files(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    exclude_glob: str | None = None,
    recursive: bool = False,
    max_files: int | None = None,
    newest_only: bool = False,
    applied: DataFrame | None = None,
) -> list[str]:
    """Paths of `choose_files`."""
    return choose_files(spark, path, glob, exclude_glob, recursive, max_files, newest_only, applied).paths


def _has_condition(error: Exception, *names: str) -> bool:
    """Whether an error, or one behind it, has a condition whose name begins so."""
    found = {error.getCondition() or ""} if isinstance(error, PySparkException) else set()
    cause = error.java_exception if isinstance(error, Py4JJavaError) else None
    text = f"{error}"
    while cause is not None:
        text, cause = f"{text}\n{cause.getMessage()}", cause.getCause()
    found |= set(re.findall(r"\[([A-Z_]+(?:\.[A-Z_]+)*)\]", text))
    return any(f.startswith(names) for f in found)


def _unreadable(error: Exception) -> bool:
    """Whether an error is about a file's content. (A lost executor or a missing permission is not.)"""
    return isinstance(error, AnalysisException) or _has_condition(error, "FAILED_READ_FILE", "MALFORMED")


def _one_by_one(
    spark: SparkSession, paths: Sequence[str], file_format: str, on_error: str
) -> tuple[list[tuple[T.StructType, list[str]]], list[str]]:
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    unreadable = []
    for path in paths:
        try:
            schema = _reader(spark, file_format).load(path).schema
        except Exception as error:
            if on_error != "skip" or not _unreadable(error):
                raise
            log.warning("left out %s: %s", path, error)
            unreadable.append(path)
            continue
        key = tuple((f.name, f.dataType.simpleString()) for f in schema.fields)
        groups.setdefault(key, (schema, []))[1].append(path)
    return list(groups.values()), unreadable


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line with content of each text file, in one job over the files' first blocks."""
    lines = spark.read.text(list(paths)).filter((F.trim("value") != "") & (F.col("_metadata.file_block_start") == 0))
    located = lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("id"))
    return located.groupBy("path").agg(F.min_by("value", "id").alias("header"))


def _by_header(
    spark: SparkSession, paths: Sequence[str], file_format: str, on_error: str, multi_line: bool = False
) -> tuple[list[tuple[T.StructType, list[str]]], list[str]]:
    """(files with the same header together, unreadable files).

    The headers of CSV files are read by one job; the driver gets a line per file and asks Spark for the schema of one file
    per distinct header. Files without a line, and headers that may go over several lines, are looked at one by one.
    """
    if file_format != "csv" or multi_line or len(paths) < 2:
        return _one_by_one(spark, paths, file_format, on_error)
    try:
        found = {r["path"]: r["header"] for r in header_lines(spark, paths).collect()}
    except Exception as error:
        if on_error != "skip" or not _unreadable(error):
            raise
        return _one_by_one(spark, paths, file_format, on_error)
    # Spark writes paths in its own form: with a scheme, blanks encoded
    named = {_plain(path): header for path, header in found.items()}
    by_line: dict[str | None, list[str]] = {}
    for path in paths:
        by_line.setdefault(named.get(_plain(path)), []).append(path)
    rest = by_line.pop(None, [])
    groups: dict[tuple, tuple[T.StructType, list[str]]] = {}
    for members in by_line.values():
        schema = _reader(spark, file_format).load(members[0]).schema
        groups.setdefault(tuple((f.name, f.dataType.simpleString()) for f in schema.fields), (schema, []))[1].extend(members)
    others, unreadable = _one_by_one(spark, rest, file_format, on_error)
    for schema, members in others:
        groups.setdefault(tuple((f.name, f.dataType.simpleString()) for f in schema.fields), (schema, []))[1].extend(members)
    return list(groups.values()), unreadable


def _plain(path: str) -> str:
    """A path without scheme and encoding, to compare the forms Spark and file systems give it."""
    return unquote(re.sub(r"^\w+:(//[^/]*)?", "", path))


def _united_parquet(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]] | None:
    """Parquet files with compatible columns as one group: executors read the footers. None if types contradict."""
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*paths).schema, list(paths))]
    except Exception as error:
        if _unreadable(error) or _has_condition(error, "CANNOT_MERGE_SCHEMAS"):
            return None
        raise


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str = "csv",
    source: str = "source_file",
    index: str = "row_index",
    stem: bool = False,
    same_columns: bool = False,
    on_error: str = "fail",
    on_bad_rows: str = "fail",
    multi_line: bool = False,
) -> Files:
    """Read files as text and unite them by column name; a column a file lacks is null.

    Files with the same header are read together. (One read over files with different headers would take the
    columns by position.) `same_columns=True` demands one header. `on_error='skip'` leaves out files whose header
    cannot be read and lists them. Empty files have no rows. CSV rows that do not fit their header stop the run, or with
    `on_bad_rows='quarantine'` are left out (`quarantined_rows` shows them). `multi_line` allows quoted line breaks.
    """
    if file_format == "json" and not same_columns and on_error != "skip" and paths:
        groups, unreadable = [(_reader(spark, file_format).load(list(paths)).schema, list(paths))], []  # read by name
    else:
        united = _united_parquet(spark, paths) if file_format == "parquet" and not same_columns and len(paths) > 1 else None
        groups, unreadable = (united, []) if united else _by_header(spark, paths, file_format, on_error, multi_line)
    rows = None
    for schema, members in groups:
        if not schema.fields:
            continue  # empty files
        group = _read_group(spark, file_format, schema, members, source, stem, index, on_bad_rows, multi_line)
        part = clean.clean_headers(group)
        if rows is None:
            rows = part
        elif same_columns:
            if set(part.columns) != set(rows.columns):
                raise ValueError(f"files have different columns: {sorted(set(part.columns) ^ set(rows.columns))}")
            rows = rows.unionByName(part)
        else:
            rows = rows.unionByName(part, allowMissingColumns=True)
    return Files(rows, [p for p in paths if p not in unreadable], unreadable)


def read_increments(
    spark: SparkSession,
    path: str,
    file_format: str = "csv",
    glob: str | None = None,
    exclude_glob: str | None = None,
    recursive: bool = False,
    max_files: int | None = None,
    newest_only: bool = False,
    applied: DataFrame | None = None,
    on_error: str = "fail",
    on_bad_rows: str = "fail",
    multi_line: bool = False,
) -> Files:
    """Select the increment (or full) files of a folder and read them, text trimmed and blanks null."""
    chosen = choose_files(spark, path, glob, exclude_glob, recursive, max_files, newest_only, applied)
    read = read_files(spark, chosen.paths, file_format, on_error=on_error, on_bad_rows=on_bad_rows, multi_line=multi_line)
    rows = None if read.rows is None else clean.clean_strings(read.rows)
    taken = [f for f in chosen.chosen if f["path"] not in read.unreadable]
    return Files(rows, read.paths, read.unreadable, taken, chosen.superseded, chosen.waiting)


def read_daily(
    spark: SparkSession,
    path: str,
    date_columns: Sequence[str],
    file_format: str = "csv",
    glob: str | None = None,
    source: str = "Source_File",
    index: str = "Index",
    on_error: str = "fail",
    on_bad_rows: str = "fail",
) -> DataFrame:
    """Daily feed: all files must have the same columns; dates parsed, file name first. No (readable) file is an error."""
    paths = select_files(spark, path, glob)
    if not paths:
        raise ValueError(f"no daily files in {path}")
    rows = read_files(
        spark, paths, file_format, source, index, stem=True, same_columns=True, on_error=on_error, on_bad_rows=on_bad_rows
    ).rows
    if rows is None:
        raise ValueError(f"no readable daily files in {path}")
    return clean.reorder(clean.parse_dates(rows, date_columns), [source])


def read_reference(spark: SparkSession, path: str, columns: Sequence[str], file_format: str = "csv", optional: bool = False):
    """Small reference table as text with the given columns.

    An optional one that is missing, unreadable or lacks a column is None; the caller goes on without it.
    """
    try:
        table = _reader(spark, file_format).load(path)
        clean.require_columns(table, columns)
    except (AnalysisException, ValueError) as error:  # missing, no rows to take a schema from, or without a column
        if optional:
            log.warning("went on without %s: %s", path, error)
            return None
        raise
    return table.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
