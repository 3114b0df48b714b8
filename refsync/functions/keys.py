"""Normalised keys: null, empty and padded key parts are the same value.

Joins run on one column per key part, so parts that contain a separator cannot collide. The joined text form is
only for display.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.text import trimmed

KEY_PREFIX = "__key"


class CleanKeys(tuple):
    """Key columns of rows that went through `clean_strings`: their text is not trimmed again."""


def key_names(keys: Sequence[str]) -> list[str]:
    """Names of the helper columns that hold the normalised key parts."""
    return [f"{KEY_PREFIX}{i}" for i in range(len(keys))]


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """One expression per key part.

    Text parts are trimmed and null becomes ''. Parts of other types stay as they are (casting numbers to text
    would only widen the shuffle); the joins compare them null-safely, which gives the same equality.
    """
    types = dict(df.dtypes)

    def part(k: str) -> Column:
        column = F.col(f"`{k}`")
        if types[k] != "string":
            return column
        return F.coalesce(column if isinstance(keys, CleanKeys) else trimmed(column), F.lit(""))

    return [part(k) for k in keys]


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the normalised key parts as helper columns."""
    return df.withColumns(dict(zip(key_names(keys), key_columns(df, keys))))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The set of normalised keys, helper columns only."""
    return df.select(*[c.alias(n) for n, c in zip(key_names(keys), key_columns(df, keys))]).distinct()


def key_text(keys: Sequence[str], separator: str = "|") -> Column:
    """Key parts joined to one text, for display."""
    return F.concat_ws(
        separator, *[F.coalesce(trimmed(F.col(f"`{k}`").cast("string")), F.lit("")) for k in keys]
    )


def split_key(text: Column, names: Sequence[str], separator: str = "|") -> list[Column]:
    """Columns for the parts of a key text; a missing part is null."""
    parts = F.split(text, f"\\Q{separator}\\E")
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]
