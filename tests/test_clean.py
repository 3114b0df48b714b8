import datetime

import pytest
from pyspark.sql import functions as F

from refsync.functions import keys, text
from refsync.operators import clean


def test_strings_are_trimmed_of_any_white_space(spark):
    df = spark.createDataFrame([(" a b\t", 1), ("  ", 2), ("", 3), (None, 4)], "s string, n int")
    assert [tuple(r) for r in clean.clean_strings(df).orderBy("n").collect()] == [("a b", 1), (None, 2), (None, 3), (None, 4)]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, b int")
    assert clean.clean_headers(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="equal after trimming"):
        clean.clean_headers(spark.createDataFrame([(1, 2)], "` a` int, a int"))


def test_dates_first_layout_that_fits(spark):
    values = ["2025-11-06", "2025-1-6", "11/6/2025", "2025-Nov-06", "2025-nov-6", "soon", "2025-13-40", None, ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d string")
    got = [r["d"] for r in clean.parse_dates(df, ["d", "absent"]).orderBy("i").collect()]
    day, early = datetime.date(2025, 11, 6), datetime.date(2025, 1, 6)
    assert got == [day, early, day, day, day, None, None, None, None]


def test_schema_bad_values_become_null(spark):
    df = spark.createDataFrame(
        [("1.5", "7", "2025-11-06", "x"), ("1,200", "z", "bad", None), ("2.0f", "", None, "y")], "f string, i string, d string, s string"
    )
    typed = clean.enforce_schema(df, {"f": "float", "i": "int", "d": "date", "absent": "float"})
    assert typed.dtypes == [("f", "float"), ("i", "int"), ("d", "date"), ("s", "string")]
    assert [tuple(r) for r in typed.collect()] == [
        (1.5, 7, datetime.date(2025, 11, 6), "x"),
        (None, None, None, None),
        (None, None, None, "y"),
    ]


def test_excluding_drops_nulls_too(spark):
    df = spark.createDataFrame([("0201",), ("0202",), (None,), ("PM1",)], "a string")
    assert [r["a"] for r in clean.exclude_values(df, "a", ["0202"]).collect()] == ["0201", "PM1"]
    assert clean.exclude_values(df, "a", []).count() == 4
    assert clean.exclude_values(df, "absent", ["x"]).count() == 4
    assert [r["a"] for r in clean.exclude_prefix(df, "a", "PM").collect()] == ["0201", "0202"]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.reorder(df, ["c"]).columns == ["c", "a", "b"]
    assert clean.prefix_columns(df, "x_").columns == ["x_a", "x_b", "x_c"]
    assert clean.drop_columns(df, ["a"]).columns == ["b", "c"]
    with pytest.raises(ValueError, match="missing"):
        clean.drop_columns(df, ["z"])
    assert clean.require_columns(df, ["z"], mode="skip") is False


def test_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (" a ", None), ("a", "")], "x string, y string")
    assert df.select(keys.key_text(["x", "y"]).alias("t")).distinct().count() == 2  # 'a|b|c' twice, 'a|' twice
    assert keys.distinct_keys(df, ["x", "y"]).count() == 3
    parts = df.select(*keys.split_key(keys.key_text(["x", "y"]), ["p", "q", "r"])).collect()
    assert tuple(parts[0]) == ("a", "b", "c") and tuple(parts[3]) == ("a", "", None)


def test_change_text_of_numbers(spark):
    df = spark.createDataFrame([(1e8, 0.1), (100.0, None), (1200.5, 0.0)], "a double, b float")
    got = df.select(text.as_change_text(F.col("a"), "double"), text.as_change_text(F.col("b"), "float")).collect()
    assert [tuple(r) for r in got] == [("100000000", "0.1"), ("100", None), ("1200.5", "0")]
