"""One pass that decides what happens to every increment row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.keys import CleanKeys, distinct_keys, key_names, with_keys
from refsync.operators import sync
from refsync.operators.skew import ROWS_PER_SLICE, HotKeys, hot_keys, keys_equal, skewed_join

# Increment keys are broadcast only up to this many rows (five short text parts: about 150 MB) and only when the
# table is this many times larger; otherwise a shuffle of both sides is cheaper than building the broadcast.
BROADCAST_KEYS = 1_000_000
BROADCAST_SHARE = 20


def few_keys(increment_rows: int, table_rows: int) -> bool:
    """Is it worth to broadcast the increment keys instead of shuffling the table?"""
    return increment_rows <= min(BROADCAST_KEYS, table_rows // BROADCAST_SHARE)


def touched_rows(
    current: DataFrame,
    increments: DataFrame,
    keys: Sequence[str],
    broadcast_keys: bool = False,
    clean_increments: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    rows: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Table rows whose key is in the increments.

    `broadcast_keys` when the caller has counted the rows and `few_keys` says so: then the table is scanned without
    a shuffle. Otherwise both sides are shuffled. `rows`: number of table rows, if known. `hot`: `heavy_table_keys`, if
    they were looked for.
    """
    return _existence(current, increments, keys, "left_semi", broadcast_keys, clean_increments, rows_per_slice, rows, hot)


def untouched_rows(
    current: DataFrame,
    increments: DataFrame,
    keys: Sequence[str],
    broadcast_keys: bool = False,
    clean_increments: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    rows: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The complement of `touched_rows`: the part of the table an upsert keeps."""
    return _existence(current, increments, keys, "left_anti", broadcast_keys, clean_increments, rows_per_slice, rows, hot)


def heavy_table_keys(current: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> HotKeys:
    """The heavy keys of the table, for several calls of `touched_rows` and `untouched_rows`."""
    return hot_keys(with_keys(current, keys), key_names(keys), rows_per_slice)


def _existence(current, increments, keys, how, broadcast_keys, clean_increments, rows_per_slice, rows, hot) -> DataFrame:
    names = key_names(keys)
    left, right = with_keys(current, keys), distinct_keys(increments, CleanKeys(keys) if clean_increments else keys)
    if broadcast_keys:
        right_names = [f"{n}_right" for n in names]
        right = right.toDF(*right_names)
        found = left.join(F.broadcast(right), keys_equal(left, right, names, right_names, null_safe=True), how)
    else:
        found = skewed_join(
            left, right, names, how, right_unique=True, null_safe=True, hot_left=hot, rows_per_slice=rows_per_slice, left_rows=rows
        )
    return found.select(*[F.col(f"`{c}`") for c in current.columns])


def tag_increments(
    touched: DataFrame,
    increments: DataFrame,
    keys: Sequence[str],
    version: str,
    excluded: Column | None = None,
    clean_increments: bool = False,
    tie_breakers: Sequence[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    gate: bool = True,
    rows: int | None = None,
) -> DataFrame:
    """Increment rows with `status` and `__previous`, the values of the table's latest row of the key.

    status: 'excluded' (by `excluded`), 'stale', 'new', 'updated' or 'unchanged'. The newest version of a key and
    its latest row come from the same row, so one join serves the gate, the split into new and matched rows and
    the change log. `touched` is the table, or the part of it that shares keys with the increments.
    `clean_increments` says that the increments went through `clean_strings`. Without `gate` no row is stale. `rows`: number
    of increment rows, if known.
    """
    columns = sync.compare_columns(increments, keys, version)
    types = dict(increments.dtypes)
    previous = sync.previous_values(touched, keys, version, [*columns, version], types, tie_breakers)
    paired = skewed_join(
        with_keys(increments, CleanKeys(keys) if clean_increments else keys),
        previous,
        key_names(keys),
        "left",
        right_unique=True,
        null_safe=True,
        rows_per_slice=rows_per_slice,
        left_rows=rows,
    )
    old_types = {f.name: f.dataType.simpleString() for f in paired.schema["__previous"].dataType.fields}
    changed = F.lit(False)
    for c in columns:
        changed = changed | sync.values_differ(F.col(f"`{c}`"), F.col(f"__previous.`{c}`"), types[c], old_types[c])
    newer = sync.is_newer(F.col(f"`{version}`"), F.col(f"__previous.`{version}`")) if gate else F.lit(True)
    status = F.when(F.coalesce(excluded, F.lit(True)), "excluded") if excluded is not None else F.when(F.lit(False), "")
    status = (
        status.when(~newer, "stale").when(F.col("__previous").isNull(), "new").when(changed, "updated").otherwise("unchanged")
    )
    return paired.select(*[F.col(f"`{c}`") for c in increments.columns], "__previous", status.alias("status"))


def accepted_rows(tagged: DataFrame) -> DataFrame:
    """Rows that pass the exclusion list and the gate, without the helper columns."""
    return tagged.filter(~F.col("status").isin("excluded", "stale")).drop("__previous", "status")


def tagged_changes(tagged: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Field-level change log of the updated rows."""
    lineage = [c for c in sync.LINEAGE if c in tagged.columns]
    increments = tagged.drop("__previous", "status")
    columns = sync.compare_columns(increments, keys, version)
    return sync.explode_changes(tagged.filter(F.col("status") == "updated"), keys, version, columns, lineage)
