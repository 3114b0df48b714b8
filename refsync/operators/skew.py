"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits skewed join partitions only when both join inputs are plain shuffles; as soon as one side is an
aggregate on the join key (here: nearly always, because lookups are reduced to one row per key first) it does
not. So the join first looks for heavy keys, by the row counts of bins of their hashes. If there are none, it
is an ordinary equi join. If there are, only their rows are spread over several slices, with the matching rows of
the other side repeated once per slice. The result is the same as that of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from refsync.sources.storage import stage

# A key with more rows than this is spread over ceil(rows / ROWS_PER_SLICE) slices.
ROWS_PER_SLICE = 1_000_000

# Keys are first counted in so many bins of their hash; at most MAX_BINS of them are named in a filter.
BINS, MAX_BINS = 65_536, 1_000

# Up to so many heavy keys go through the driver and are broadcast; a longer list is written and joined like any table.
MAX_HOT_KEYS = 1_000


@dataclass(frozen=True)
class HotKeys:
    """Heavy keys: the columns they are values of, and a small table of keys and slice counts (None: no heavy key)."""

    on: tuple[str, ...]
    table: DataFrame | None
    few: bool = True  # the table may be broadcast


# Keys a summary tells, and keys it keeps track of: no key with more than about 3.5 / SUMMARY_TRACKED of all rows is missed.
SUMMARY_KEYS, SUMMARY_TRACKED = 1_000, 20_000


@dataclass(frozen=True)
class KeySummary:
    """Number of rows of a table and its most frequent keys, for one or several sets of key columns."""

    rows: int
    frequent: dict[tuple[str, ...], list[tuple[str, int]]] = field(default_factory=dict)  # key columns -> (key as JSON, rows)
    schemas: dict[tuple[str, ...], str] = field(default_factory=dict)

    def hot(self, df: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> HotKeys:
        """The heavy keys, without a job. Counts are upper bounds, so a key may get a slice too many."""
        keys = tuple(keys)
        found = [(key, -(-n // rows_per_slice)) for key, n in self.frequent[keys] if n > rows_per_slice]
        if self.rows <= rows_per_slice or not found:
            return HotKeys(keys, None)
        table = df.sparkSession.createDataFrame(found, "key string, slices int")
        table = table.select(F.from_json("key", self.schemas[keys]).alias("key"), "slices")
        return HotKeys(keys, table.select(*[F.col(f"key.`c{i}`").alias(k) for i, k in enumerate(keys)], "slices"))


def stage_summarised(df: DataFrame, label: str, *key_sets: Sequence[str], summary_keys: int = SUMMARY_KEYS, outer: bool = False) -> tuple[DataFrame, KeySummary]:
    """`stage` a table and sum up its keys on the way: a sketch of frequent items per set of key columns that the writing
    tasks fill and Spark merges, so no further job reads the table.
    """
    sets = [tuple(keys) for keys in key_sets]
    types = dict(df.dtypes)
    metrics = []
    for i, keys in enumerate(sets):
        parts = F.struct(*[F.col(f"`{k}`").alias(f"c{j}") for j, k in enumerate(keys)])
        key = F.to_json(parts, {"ignoreNullFields": "false"})
        metrics.append(F.call_function("approx_top_k", key, F.lit(summary_keys), F.lit(SUMMARY_TRACKED)).alias(f"top{i}"))
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), label, outer=outer)
    found = seen.get
    frequent = {keys: [(r["item"], r["count"]) for r in found[f"top{i}"] or []] for i, keys in enumerate(sets)}
    schemas = {keys: ", ".join(f"c{j} {types[k]}" for j, k in enumerate(keys)) for keys in sets}
    return staged, KeySummary(found["rows"], frequent, schemas)


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE, max_keys: int = MAX_HOT_KEYS
) -> HotKeys:
    """Find the heavy keys of a DataFrame.

    A job counts the rows per bin of the keys' hash, so a task sends at most `BINS` small rows and no keys. Only keys of bins
    that hold more rows than a slice are then counted themselves; mostly there are none.
    """
    columns = [F.col(f"`{k}`") for k in keys]
    place = F.pmod(F.xxhash64(*columns), F.lit(BINS))
    bins = df.groupBy(place.alias("__bin")).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > rows_per_slice)
    full = [row["__bin"] for row in bins.select("__bin").limit(MAX_BINS + 1).collect()]
    if not full:
        return HotKeys(tuple(keys), None)
    some = df.filter(place.isin(full)) if len(full) <= MAX_BINS else df
    counts = some.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows"))
    return heaviest(counts, keys, "__rows", rows_per_slice, max_keys)


def heaviest(
    counts: DataFrame,
    keys: Sequence[str],
    rows: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    max_keys: int = MAX_HOT_KEYS,
) -> HotKeys:
    """`hot_keys` for keys that are already counted."""
    slices = F.ceil(F.col(rows) / F.lit(rows_per_slice)).cast("int").alias("slices")
    heavy = counts.filter(F.col(rows) > rows_per_slice).select(*[F.col(f"`{k}`") for k in keys], slices)
    found = heavy.limit(max_keys + 1).collect()
    if len(found) > max_keys:
        return HotKeys(tuple(keys), stage(heavy, "heavy-keys"), few=False)
    return HotKeys(tuple(keys), counts.sparkSession.createDataFrame(found, heavy.schema) if found else None)


def keys_equal(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], null_safe: bool
) -> Column:
    """Condition for key columns with distinct names. Null-safe only where both sides may be null: `<=>` makes
    two sort and hash keys out of one column.
    """
    condition = None
    for a, b in zip(left_keys, right_keys):
        x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
        both_nullable = left.schema[a].nullable and right.schema[b].nullable
        pair = x.eqNullSafe(y) if null_safe and both_nullable else x == y
        condition = pair if condition is None else condition & pair
    return condition


def _slice_number(columns: Sequence[str], slices: Column) -> Column:
    """Slice of a row: a hash of its content and of the partition it was read in.

    Both are the same when a lost task is run again, unlike a random number; the partition spreads rows that are
    exact copies of each other.
    """
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns])
    return F.when(slices > 1, F.pmod(row_hash, slices).cast("int")).otherwise(F.lit(0))


def _every_slice(slices: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), slices - 1))


def _mark(df: DataFrame, keys: Sequence[str], hot: HotKeys, name: str) -> DataFrame:
    """Add the slice count of the row's key (1 for most keys); `keys` are the columns that play `hot.on`."""
    names = [f"__hot_key{i}" for i in range(len(keys))]
    small = hot.table.toDF(*names, name)
    small = F.broadcast(small) if hot.few else small  # one row per heavy key
    marked = df.join(small, keys_equal(df, small, keys, names, null_safe=True), "left").drop(*names)
    return marked.withColumn(name, F.coalesce(F.col(name), F.lit(1)))


def skewed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    right_keys: Sequence[str] | None = None,
    left_unique: bool = False,
    right_unique: bool = False,
    null_safe: bool = False,
    hot_left: HotKeys | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    max_keys: int = MAX_HOT_KEYS,
    left_rows: int | None = None,
    right_rows: int | None = None,
) -> DataFrame:
    """Equi join on `keys`; returns the left columns and the non-key right columns.

    how: 'inner', 'left', 'left_semi' or 'left_anti'. `left_unique` / `right_unique` say that a side has one row
    per key, which saves the count of that side; so does a bound on a side's rows that is too small for a heavy key.
    `hot_left` gives the heavy left keys when the caller has looked for them already; they may be keyed on some of the join
    keys only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    right_keys = list(right_keys or keys)
    existence = how in ("left_semi", "left_anti")
    if existence:
        right = right.select(*[F.col(f"`{k}`") for k in right_keys])
        if not right_unique:
            right = right.distinct()
        right_unique = True
    payload = [c for c in right.columns if c not in right_keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides of the join: {sorted(clash)}")

    left_columns = left.columns
    names = [f"__right_key{i}" for i in range(len(keys))]
    right = right.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(right_keys, names)], *[F.col(f"`{c}`") for c in payload]
    )
    if not null_safe:
        # A null never matches; removed here so that a pile of nulls is not taken for a heavy key.
        right = right.dropna(subset=names)

    no_left, no_right = HotKeys(tuple(keys), None), HotKeys(tuple(names), None)
    few = lambda rows: rows is not None and rows <= rows_per_slice
    if left_unique or (hot_left is None and few(left_rows)):
        hot_left = no_left
    elif hot_left is None:
        hot_left = hot_keys(left, keys, rows_per_slice, max_keys)
    hot_right = no_right if right_unique or few(right_rows) else hot_keys(right, names, rows_per_slice, max_keys)
    if hot_left.table is None and hot_right.table is None:
        joined = left.join(right, keys_equal(left, right, keys, names, null_safe), how)
        return joined if existence else joined.drop(*names)

    # One slice column per side that has heavy keys: its own rows are numbered, the other side's repeated.
    condition = keys_equal(left, right, keys, names, null_safe)
    if hot_left.table is not None:
        left = _mark(left, hot_left.on, hot_left, "__left_n")
        right = _mark(right, [names[keys.index(k)] for k in hot_left.on], hot_left, "__left_m")
        left = left.withColumn("__left_slice", _slice_number(left_columns, F.col("__left_n")))
        right = right.withColumn("__left_copy", _every_slice(F.col("__left_m")))
        condition = condition & (F.col("__left_slice") == F.col("__left_copy"))
    if hot_right.table is not None:
        left = _mark(left, keys, hot_right, "__right_m")
        right = _mark(right, names, hot_right, "__right_n")
        right = right.withColumn("__right_slice", _slice_number([*names, *payload], F.col("__right_n")))
        left = left.withColumn("__right_copy", _every_slice(F.col("__right_m")))
        condition = condition & (F.col("__right_copy") == F.col("__right_slice"))
    joined = left.join(right, condition, how)
    if how == "left" and hot_right.table is not None:
        # A left row meets every slice of a heavy right key; slices without a row for it pad with nulls. Such a
        # key has rows on the right by definition, so all padded rows are surplus.
        joined = joined.filter((F.col("__right_m") == 1) | F.col("__right_slice").isNotNull())
    kept = left_columns if existence else [*left_columns, *payload]
    return joined.select(*[F.col(f"`{c}`") for c in kept])
