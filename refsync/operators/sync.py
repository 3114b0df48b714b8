"""Gate, compare, deduplicate and upsert increments against the reference table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refsync.functions.keys import KEY_PREFIX, distinct_keys, key_columns, key_names, with_keys
from refsync.functions.text import as_change_text
from refsync.operators.skew import ROWS_PER_SLICE, skewed_join

LINEAGE = ("source_file", "row_index")


def _version_order(df: DataFrame, version: str, tie_breakers: Sequence[str] | None) -> list[Column]:
    """Total order, newest first: version, then lineage, then a hash of the whole row."""
    if tie_breakers is None:
        tie_breakers = [c for c in LINEAGE if c in df.columns]
        last = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(KEY_PREFIX)]).desc()]
    else:
        last = []
    return [F.col(f"`{version}`").desc_nulls_last(), *[F.col(f"`{c}`").desc_nulls_last() for c in tie_breakers], *last]


def latest_wins(
    df: DataFrame, keys: Sequence[str], version: str, tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the newest version, ties broken by `tie_breakers` (default: file, row, row content).

    `row_number() = 1` lets Spark keep one row per key in every map task before the shuffle, so a key that holds
    a third of the rows sends one row per task.
    """
    return _newest(df, key_columns(df, keys), version, tie_breakers)


def _newest(df: DataFrame, key: Sequence[Column], version: str, tie_breakers: Sequence[str] | None) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*_version_order(df, version, tie_breakers))
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def latest_version(current: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Normalised key and the newest version the table holds for it (nulls ignored)."""
    grouped = with_keys(current.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, version])]), keys)
    return grouped.groupBy(*key_names(keys)).agg(F.max(F.col(f"`{version}`")).alias("__current_version"))


def _gated(
    current: DataFrame, increments: DataFrame, keys: Sequence[str], version: str, rows_per_slice: int
) -> DataFrame:
    return skewed_join(
        with_keys(increments, keys),
        latest_version(current, keys, version),
        key_names(keys),
        "left",
        right_unique=True,
        null_safe=True,
        rows_per_slice=rows_per_slice,
    )


def is_newer(version: Column, current_version: Column) -> Column:
    """Gate rule: the table has no dated version, or the row is strictly newer. Never null."""
    return current_version.isNull() | F.coalesce(version > current_version, F.lit(False))


def gate_stale(
    current: DataFrame,
    increments: DataFrame,
    keys: Sequence[str],
    version: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Increment rows that are newer than what the table holds for their key."""
    gated = _gated(current, increments, keys, version, rows_per_slice)
    kept = gated.filter(is_newer(F.col(f"`{version}`"), F.col("__current_version")))
    return kept.select(*[F.col(f"`{c}`") for c in increments.columns])


def stale_rows(
    current: DataFrame,
    increments: DataFrame,
    keys: Sequence[str],
    version: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The complement of `gate_stale`, with the version the table holds."""
    gated = _gated(current, increments, keys, version, rows_per_slice)
    dropped = gated.filter(~is_newer(F.col(f"`{version}`"), F.col("__current_version")))
    return dropped.select(
        *[F.col(f"`{c}`") for c in increments.columns], F.col("__current_version").alias("current_version")
    )


def _by_presence(
    current: DataFrame, increments: DataFrame, keys: Sequence[str], how: str, rows_per_slice: int
) -> DataFrame:
    found = skewed_join(
        with_keys(increments, keys),
        distinct_keys(current, keys),
        key_names(keys),
        how,
        right_unique=True,
        null_safe=True,
        rows_per_slice=rows_per_slice,
    )
    return found.select(*[F.col(f"`{c}`") for c in increments.columns])


def new_rows(
    current: DataFrame, increments: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Increment rows whose key the table does not hold."""
    return _by_presence(current, increments, keys, "left_anti", rows_per_slice)


def matched_rows(
    current: DataFrame, increments: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Increment rows whose key the table holds."""
    return _by_presence(current, increments, keys, "left_semi", rows_per_slice)


def split_new_updated(current: DataFrame, increments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increment keys, each with `status` 'new' or 'updated'. One row per key."""
    names = key_names(keys)
    held = distinct_keys(current, keys).withColumn("__held", F.lit(True))
    tagged = skewed_join(
        distinct_keys(increments, keys), held, names, "left", left_unique=True, right_unique=True, null_safe=True
    )
    return tagged.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)],
        F.when(F.col("__held"), "updated").otherwise("new").alias("status"),
    )


def upsert(
    current: DataFrame, increments: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Replace the table rows of every key in the increments, add the rest. Columns are united by name.

    All table rows of an updated key go, also when the table holds the key more than once. The increments should
    be one row per key (`latest_wins`).
    """
    kept = skewed_join(
        with_keys(current, keys),
        distinct_keys(increments, keys),
        key_names(keys),
        "left_anti",
        right_unique=True,
        null_safe=True,
        rows_per_slice=rows_per_slice,
    ).select(*[F.col(f"`{c}`") for c in current.columns])
    return kept.unionByName(increments, allowMissingColumns=True)


def compare_columns(
    increments: DataFrame, keys: Sequence[str], version: str, ignore: Sequence[str] = LINEAGE
) -> list[str]:
    """Columns whose changes are logged: all but the key, the version and the lineage."""
    skipped = {*keys, version, *ignore}
    return [c for c in increments.columns if c not in skipped]


def previous_values(
    current: DataFrame,
    keys: Sequence[str],
    version: str,
    columns: Sequence[str],
    types: dict[str, str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Normalised key and a struct `__previous` with the values of the table's newest row of the key.

    A column the table lacks reads as null. The search for the newest row is by the columns of the normalised key, so a
    join on them takes over its partitioning and order.
    """
    names = key_names(keys)
    values = [(F.col(f"`{c}`") if c in current.columns else F.lit(None).cast(types[c])).alias(c) for c in columns]
    latest = _newest(with_keys(current, keys), [F.col(n) for n in names], version, tie_breakers)
    return latest.select(*names, F.struct(*values).alias("__previous"))


def values_differ(new: Column, old: Column, new_type: str, old_type: str) -> Column:
    """Whether a field changed: typed values are compared as such, text with null and '' as the same value."""
    if new_type == old_type and new_type != "string":
        return ~new.eqNullSafe(old)
    return F.coalesce(new.cast("string"), F.lit("")) != F.coalesce(old.cast("string"), F.lit(""))


def change_entries(columns: Sequence[str], new_types: dict[str, str], old_types: dict[str, str]) -> Column:
    """Array of (column, current, previous, differs) for a row that carries `__previous`."""
    return F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                as_change_text(F.col(f"`{c}`"), new_types[c]).alias("current"),
                as_change_text(F.col(f"__previous.`{c}`"), old_types[c]).alias("previous"),
                values_differ(F.col(f"`{c}`"), F.col(f"__previous.`{c}`"), new_types[c], old_types[c]).alias("differs"),
            )
            for c in columns
        ]
    )


def _struct_types(df: DataFrame, name: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema[name].dataType.fields}


def explode_changes(
    paired: DataFrame, keys: Sequence[str], version: str, columns: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Rows that carry `__previous` to one row per field that differs (null and '' are the same value)."""
    entries = change_entries(columns, dict(paired.dtypes), _struct_types(paired, "__previous"))
    long = paired.select(
        *[F.col(f"`{c}`") for c in dict.fromkeys([*keys, version, *carry])], F.inline(entries)
    )
    return long.filter("differs").select(
        *[F.col(f"`{c}`") for c in dict.fromkeys([*keys, version, *carry])],
        F.col("column").alias("Column"),
        F.col("current").alias("Current Value"),
        F.col("previous").alias("Previous Value"),
        F.lit("Updated").alias("Change Type"),
    )


def field_changes(
    current: DataFrame,
    increments: DataFrame,
    keys: Sequence[str],
    version: str,
    tie_breakers: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Field-level change log: every increment row against the table's latest row of its key.

    The wide rows meet once per key and are turned long afterwards, so one shuffle of wide rows replaces two
    shuffles of (rows x columns) long ones.
    """
    columns = list(columns or compare_columns(increments, keys, version))
    types = dict(increments.dtypes)
    previous = previous_values(current, keys, version, columns, types, tie_breakers)
    paired = skewed_join(
        with_keys(increments, keys),
        previous,
        key_names(keys),
        "inner",
        right_unique=True,
        null_safe=True,
        rows_per_slice=rows_per_slice,
    )
    carry = [c for c in LINEAGE if c in increments.columns]
    return explode_changes(paired, keys, version, columns, carry)


def changes_by_column(changes: DataFrame) -> DataFrame:
    """Number of logged changes per column."""
    return changes.groupBy("Column").agg(F.count(F.lit(1)).alias("count"))


def duplicate_history(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    price: str | None = None,
) -> DataFrame:
    """Every version (and price) of the keys that occur more than once, with the number of rows that share it.

    Long form: one row per key, version and price, so a key with very many versions never sits in one cell.
    """
    keyed = with_keys(df, keys)
    names = key_names(keys)
    parts = [F.col(f"`{version}`").alias("version")]
    if price and price in df.columns:
        parts.append(F.col(f"`{price}`").alias("price"))
    history = keyed.groupBy(*names, *parts).agg(F.count(F.lit(1)).alias("rows"))
    repeated = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").select(*names)
    found = skewed_join(history, repeated, names, "left_semi", right_unique=True, null_safe=True)
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], *found.columns[len(names):])


def duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    price: str | None = None,
    source: str | None = None,
    lists: bool = False,
) -> DataFrame:
    """Keys that occur more than once, most frequent first.

    Counts rows and (with `source`) distinct files, and gives the first and last version. `lists=True` adds
    `versions`, an array of (version, price, rows) built from pre-aggregated history rows; for keys with very
    many versions read `duplicate_history` instead.
    """
    names = key_names(keys)
    parts = [F.col(f"`{version}`").alias("version")]
    has_price = bool(price) and price in df.columns
    if has_price:
        parts.append(F.col(f"`{price}`").alias("price"))
    if source and source in df.columns:
        parts.append(F.col(f"`{source}`").alias("file"))
    # Copies of one version collapse before the shuffle; the second step then sees each distinct version once.
    versions = with_keys(df, keys).groupBy(*names, *parts).agg(F.count(F.lit(1)).alias("rows"))
    if source and source in df.columns:
        files = versions.groupBy(*names, "file").agg(F.lit(1).alias("one"))
        files = files.groupBy(*names).agg(F.sum("one").alias("file_count"))
        versions = versions.groupBy(*names, *[p for p in ("version", "price") if p in versions.columns]).agg(
            F.sum("rows").alias("rows")
        )
    measures = [
        F.sum("rows").alias("occurrence_count"),
        F.min("version").alias("first_version"),
        F.max("version").alias("last_version"),
    ]
    if lists:
        entry = [F.col("version"), *([F.col("price")] if has_price else []), F.col("rows")]
        measures.append(F.array_sort(F.collect_list(F.struct(*entry))).alias("versions"))
    result = versions.groupBy(*names).agg(*measures).filter("occurrence_count > 1")
    if source and source in df.columns:
        result = skewed_join(result, files, names, "left", left_unique=True, right_unique=True, null_safe=True)
    return result.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], *result.columns[len(names):]).orderBy(
        F.col("occurrence_count").desc(), *[F.col(f"`{k}`") for k in keys]
    )


def with_key_count(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    rows: int | None = None,
) -> DataFrame:
    """Add the number of rows that share the row's key.

    A window would put all rows of a key into one task; here the keys are counted with a combine before the
    shuffle and the counts of repeated keys are joined back, heavy keys spread over slices. `rows`: number of rows, if known.
    """
    names = key_names(keys)
    keyed = with_keys(df, keys)
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    joined = skewed_join(
        keyed,
        counts,
        names,
        "left",
        right_unique=True,
        null_safe=True,
        rows_per_slice=rows_per_slice,
        left_rows=rows,
    )
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__rows", F.lit(1)).alias(name))


def duplicate_versions(
    df: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE, rows: int | None = None
) -> DataFrame:
    """All rows of the keys that occur more than once. Sort at the sink (`io` writers take `sort_by`)."""
    return with_key_count(df, keys, "__count", rows_per_slice, rows).filter("__count > 1").drop("__count")
