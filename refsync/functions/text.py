"""Text, date and number expressions that never fail on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property (Spark's trim strips only U+0020).
WHITESPACE_RANGES = (
    (0x0009, 0x000D),
    (0x0020, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(chr(p) for first, last in WHITESPACE_RANGES for p in range(first, last + 1))

# The accepted date layouts and the shape of text each one fits; first match wins.
DATE_FORMATS = (
    ("yyyy-M-d", r"^\d+-\d+-\d+$"),
    ("M/d/yyyy", r"^\d+/\d+/\d+$"),
    ("yyyy-MMM-d", r"^\d+-\p{L}+-\d+$"),
)


def trimmed(c: Column) -> Column:
    """Strip all Unicode white space from both ends.

    Most text begins and ends with a visible ASCII character (comparison is by bytes): that is cheaper to see than to trim.
    """
    visible = lambda x: (x >= F.lit("!")) & (x < F.lit("\x7f"))
    return F.when(visible(c) & visible(F.substring(c, -1, 1)), c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def blank_to_null(c: Column) -> Column:
    """Trim, and turn an empty result into null."""
    return F.nullif(trimmed(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for null and for text that is only white space; never null itself."""
    return c.isNull() | (trimmed(c.cast("string")) == "")


def parse_date(c: Column, formats: tuple[tuple[str, str], ...] = DATE_FORMATS) -> Column:
    """Text to date: the first format that fits, else null.

    The shape is tested first: a parser that fails raises and catches an exception for every row.
    """
    return F.coalesce(*[F.when(c.rlike(shape), F.try_to_date(c, f)) for f, shape in formats])


def parse_number(c: Column, data_type: str = "float", strip_commas: bool = False) -> Column:
    """Text to number, null when it is not one. A Java type suffix ('1.0f', '2d') is not a number."""
    text = F.replace(c, F.lit(","), F.lit("")) if strip_commas else c
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast(data_type))


def as_change_text(c: Column, data_type: str) -> Column:
    """Value as it is written to the change log.

    Floating point goes through a decimal so that 1e8 reads 100000000 instead of 1.0E8. Values that the decimal does
    not hold exactly (and NaN or infinity) keep Spark's own text, so different values have different texts.
    """
    if data_type in ("float", "double"):
        as_decimal = c.cast("double").try_cast("decimal(38,6)")
        plain = F.regexp_replace(as_decimal.cast("string"), r"\.?0+$", "")
        return F.when(as_decimal.cast(data_type) == c, plain).otherwise(c.cast("string"))
    return c.cast("string")
