"""Steps that must not grow faster than their input: what the plans and the jobs behind them do not do any more."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from refsync.functions import text
from refsync.operators import checks, feed, skew, sync
from refsync.plans import queries
from refsync.sources import outputs

ROLES = ("contract", "vendor", "cat", "item", "acct", "seq")


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_issues_read_staged_facts_and_sort_none(spark):
    rows = [("K1", "v1", "c1", "i1", "0101", "1"), ("K1", "v2", "c2", "i1", "0101", "2"), ("K2", "v1", None, "i2", "0101", "1")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ROLES))
    for found in (checks.issue_rows(checks.check_facts(df, *ROLES)), checks.marked_facts(checks.check_facts(df, *ROLES))):
        plan = plan_of(found)
        assert "SortAggregate" not in plan
        assert "Generate" not in plan  # the facts are not counted from the table again
    issues = checks.issue_rows(checks.check_facts(df, *ROLES)).select("check", "part1", "value", "rows").collect()
    assert sorted(map(str, map(tuple, issues))) == ["('blank_value', 'i2', None, 1)", "('one_to_one', 'K1', 'v1', 1)", "('one_to_one', 'K1', 'v2', 1)"]


def test_keys_are_not_counted_when_no_bin_is_full(spark, monkeypatch):
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"))
    with monkeypatch.context() as m:
        m.setattr(skew, "heaviest", lambda *_: pytest.fail("all keys were counted"))
        assert skew.hot_keys(df, ["k"], 1000).table is None
    heavy = df.union(spark.range(30).select(F.lit("k7")))
    assert [tuple(r) for r in skew.hot_keys(heavy, ["k"], 10).table.collect()] == [("k7", 4)]
    monkeypatch.setattr(skew, "MAX_BINS", 0)  # too many full bins to name
    assert [tuple(r) for r in skew.hot_keys(heavy, ["k"], 10).table.collect()] == [("k7", 4)]


def test_the_join_takes_over_the_order_of_the_newest_rows(spark):
    current = spark.createDataFrame([("a", "2020-01-01", "x"), ("a", "2021-01-01", "y")], "k string, d string, v string").repartition(3)
    previous = sync.previous_values(current, ["k"], "d", ["v"], {"v": "string"})
    other = spark.range(5).select(F.col("id").cast("string").alias("n"))
    with_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(previous.join(other, F.col("__key0") == F.col("n")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)
    assert plan.count("Exchange hashpartitioning") == 2  # one per side
    assert [r["__previous"]["v"] for r in previous.collect()] == ["y"]


def test_trimmed_text_of_any_edge(spark):
    edges = ["a", "", " ", " a", "a\t", " a", "a　", "é", " é\u0085", "~", "\x7fa", "a b", "\n", "!", "🙂 "]
    df = spark.createDataFrame([(x,) for x in [*edges, None]], "s string")
    got = [r[0] for r in df.select(text.trimmed(F.col("s"))).collect()]
    assert got == [None if x is None else x.strip(text.WHITESPACE) for x in [*edges, None]]


def test_dates_of_text_that_no_format_fits(spark):
    stamps = ["2024-01-05", "2024-1-5", "+2024-1-5", "+12024-1-5", "2024-Jan-05 03:04:05 PM", " 2024-1-5", "2024-13-1", "", None, "x"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    plain = F.try_to_timestamp(F.col("s"), F.lit("yyyy-M-d")).cast("date")
    stamped = F.try_to_timestamp(F.col("s"), F.lit("yyyy-MMM-dd hh:mm:ss a")).cast("date")
    days = outputs.date_of(df, "s", ["yyyy-M-d"]), outputs.date_of(df, "s", ["yyyy-MMM-dd hh:mm:ss a"])
    got = df.select(*[c.cast("string") for c in (plain, days[0], stamped, days[1])]).collect()
    assert all(a == b and c == d for a, b, c, d in got)
    assert "RLIKE" in plan_of(df.select(days[0].alias("day")))  # a parser that fails costs an exception per row


def test_lists_are_neither_dealt_nor_sorted_with_the_rows(spark):
    empty = spark.createDataFrame([], "part string, item string")
    details = spark.createDataFrame([("i", "A", "v", 1), ("i", "A", "v", 2)], "item string, prefix string, vendor string, d int")
    lists = spark.createDataFrame([("i", "A", "1-v, 2-v")], "item string, prefix string, names string")
    names = spark.createDataFrame([("i", "Item")], "item string, description string")
    lookups = feed.Lookups("item", "prefix", "vendor", empty, empty, names, details, lists, details)
    rows = spark.createDataFrame([(1, "i", "A1", "v"), (2, "", "A1", "v")], "id int, c string, plant string, dist string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = feed.enrich(rows, lookups, "c", "plant", "dist", 1)
        above = plan_of(found).split("LeftOuter")[0]  # what comes after the last join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.columns == ["id", "c", "plant", "dist", "description", "names", "vendor", "d"]
    assert "Sort [" not in above and "Exchange" not in above and plan_of(found).index("names#") < plan_of(found).index("LeftOuter")
    assert sorted(((r["id"], r["names"], r["d"]) for r in found.collect()), key=str) == [(1, "1-v, 2-v", 1), (1, "1-v, 2-v", 2), (2, None, None)]


def test_more_rows_are_more_files(spark):
    assert [queries._files_of(spark.range(n), b) for n, b in ((0, 3), (1_500_000, 3), (1_500_001, 3), (4_000_000, 2))] == [3, 3, 6, 8]
