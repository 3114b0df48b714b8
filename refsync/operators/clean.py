"""Cleaning, typing and row/column filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.functions import text


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every text column; blank becomes null. One projection for all columns."""
    return df.select(
        *[text.blank_to_null(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def clean_headers(df: DataFrame) -> DataFrame:
    """Trim column names; names that become equal are an error."""
    names = [c.strip(text.WHITESPACE) for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names are equal after trimming: {repeated}")
    return df.toDF(*names)


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to dates (first matching layout, else null); absent columns are ignored."""
    types = dict(df.dtypes)
    return df.withColumns({c: text.parse_date(F.col(f"`{c}`")) for c in columns if types.get(c) == "string"})


def enforce_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to the declared types; values that do not convert become null, absent columns are ignored."""

    def convert(name: str, current: str):
        column, target = F.col(f"`{name}`"), types.get(name, current)
        if target == current:
            return column
        if current == "string" and target == "date":
            return text.parse_date(column).alias(name)
        if current == "string" and target in ("float", "double", "int", "bigint") or target.startswith("decimal"):
            return text.parse_number(column.cast("string"), target).alias(name)
        return column.try_cast(target).alias(name)

    return df.select(*[convert(c, t) for c, t in df.dtypes])


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop rows whose value is on the list. A null value is dropped too (the test is unknown)."""
    if not values or column not in df.columns:
        return df
    return df.filter(~F.col(f"`{column}`").cast("string").isin(*values))


def exclude_prefix(df: DataFrame, column: str, prefixes: Sequence[str] | str) -> DataFrame:
    """Drop rows whose text starts with one of the prefixes. A null value is dropped too."""
    prefixes = [prefixes] if isinstance(prefixes, str) else list(prefixes)
    for prefix in prefixes:
        df = df.filter(~F.col(f"`{column}`").startswith(prefix))
    return df


def require_columns(df: DataFrame, columns: Sequence[str], mode: str = "error") -> bool:
    """Are all columns there? In mode 'error' a missing one raises, in mode 'skip' the answer is False."""
    missing = [c for c in columns if c not in df.columns]
    if missing and mode == "error":
        raise ValueError(f"missing required columns: {missing}")
    return not missing


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must be there (Spark's own drop ignores unknown names)."""
    require_columns(df, columns)
    return df.drop(*columns)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Put a prefix before every column name."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Move columns to the front, keep the order of the rest."""
    require_columns(df, first)
    return df.select(*[F.col(f"`{c}`") for c in [*first, *[c for c in df.columns if c not in first]]])
