from datetime import date

import pytest
from pyspark.sql import functions as F

from refsync.operators import checks, classify, feed


def test_one_to_one(spark):
    df = spark.createDataFrame(
        [("K1", "V2"), ("K1", "V1"), ("K1", "V1"), ("K2", "V1"), (" N/A ", "V1"), (" N/A ", "V2"), ("K3", None), ("K3", "V1")],
        "contract string, vendor string",
    )
    assert [tuple(r) for r in checks.one_to_one(df, "contract", "vendor").collect()] == [("K1", 2, ["V1", "V2"])]


def test_blank_values_and_the_permitted_list(spark):
    df = spark.createDataFrame([("1", None), ("2", " "), ("3", "c"), (None, "")], "item string, cat string")
    some, none = spark.createDataFrame([("1",)], "item string"), spark.createDataFrame([], "item string")
    assert [r["item"] for r in checks.blank_values(df, "cat", "item", some).collect()] == ["2"]
    for permitted in (none, None):
        assert {r["item"] for r in checks.blank_values(df, "cat", "item", permitted).collect()} == {"1", "2", None}
    assert [r["item"] for r in checks.permitted_blanks(df, "cat", "item", some).collect()] == ["1"]


def test_consistent_value_and_counts(spark):
    df = spark.createDataFrame(
        [
            ("I", "V", "0201", "c1", "2", "K"),
            ("I", "V", "0205", "c2", "1", "K"),
            ("I", "V", "0501", "c3", "1", "K"),
            ("I", "V", "0201", "c9", None, "K"),
            ("J", "V", "0201", " ", "1", "K"),
        ],
        "item string, vendor string, acct string, cat string, seq string, contract string",
    )
    found = checks.consistent_value(df, "item", "vendor", "acct", "cat", "seq").collect()
    assert [(r["item"], r["account_prefix"], r["values"], r["sequences"]) for r in found] == [("I", "02", ["c1", "c2"], ["1", "2"])]
    issues = checks.run_checks(df, "contract", "vendor", "cat", "item", "acct", "seq")
    assert tuple(checks.check_counts(issues).first()) == (0, 1, 1, True)
    assert checks.run_checks(df, "absent", "vendor", "absent", "item", "acct", "seq").count() == 0


def test_mirrors(spark):
    rows = [
        (1, "I", "C", "0201"),
        (2, "I", "C", "0204"),
        (3, "I", "D", "0204"),
        (4, "I", None, "0201"),
        (5, "I", None, "0204"),
        (6, "J", "C", "0501"),
        (7, "J", "C", "0504"),
        (8, "J", "C", "0204"),
        (9, "I", "C", None),
    ]
    df = spark.createDataFrame(rows, "n int, item string, cat string, acct string")
    pairs = {"0201": "0204", "0204": "0201", "0501": "0504", "0504": "0501"}
    for slices in (1, 1_000_000):
        kept = feed.suppress_mirrors(df, ["item", "cat"], "acct", pairs, ["0204", "0504"], slices)
        assert sorted(r["n"] for r in kept.collect()) == [1, 3, 4, 5, 6, 8, 9]


@pytest.mark.parametrize("slices", [1, 1_000_000])
@pytest.mark.parametrize("legacy", [False, True])
def test_collapse(spark, slices, legacy):
    rows = [
        ("f", 1, "d1", "m1", "x"),  # both routes, same item
        ("f", 2, "d1", "m2", "x"),  # two items
        ("f", 3, "d1", "none", "x"),  # one route
        ("f", 4, "none", "none", "x"),  # none
        ("f", 5, "d1", None, "x"),  # one route, a null part number
    ]
    daily = spark.createDataFrame(rows, "src string, idx int, dpn string, mpn string, other string")
    by_dpn = spark.createDataFrame([("d1", "I1")], "part string, item string")
    by_mpn = spark.createDataFrame([("m1", "I1"), ("m2", "I2"), ("m2", ""), (None, "I9")], "part string, item string")
    found = feed.match_candidates(daily, {"DPN": ("dpn", by_dpn), "MPN": ("mpn", by_mpn)}, ["src", "idx"], slices)
    got = feed.collapse_candidates(daily, found, ["src", "idx"], "pmm", "pmm_source", legacy, slices)
    want = [(1, "I1", "DPN,MPN"), (2, "I1", "DPN"), (2, "I2", "MPN"), (3, "I1", "DPN"), (4, "", ""), (5, "I1", "DPN")]
    if legacy:
        want.append((5, "", ""))
    assert sorted((r["idx"], r["pmm"], r["pmm_source"]) for r in got.collect()) == sorted(want)


def test_vendor_list(spark):
    df = spark.createDataFrame(
        [("I", "02", "2", "B"), ("I", "02", "10", "A"), ("I", "02", "2", "B"), ("I", "05", None, "A"), ("J", "02", "1", None)],
        "item string, prefix string, seq string, vendor string",
    )
    got = feed.vendor_list(df, "item", "prefix", "seq", "vendor", "list")
    assert {(r["item"], r["prefix"]): r["list"] for r in got.collect()} == {
        ("I", "02"): "10-A, 2-B, 2-B",
        ("I", "05"): "",
        ("J", "02"): "",
    }
    once = feed.vendor_list(df, "item", "prefix", "seq", "vendor", "list", repeats=False)
    assert once.filter("item = 'I' AND prefix = '02'").first()["list"] == "10-A, 2-B"


def test_date_status(spark):
    a, b, c = date(2024, 1, 1), date(2024, 12, 31), date(2025, 6, 1)
    rows = [
        (1, a, b, a, b),
        (2, a, b, None, b),
        (3, a, b, c, c),
        (4, a, b, c, b),
        (5, a, b, a, c),
        (6, a, b, a, None),
        (7, a, None, c, b),
        (8, None, b, a, b),
    ]
    df = spark.createDataFrame(rows, "n int, s date, e date, ts date, te date")
    got = df.select("n", feed.date_match_status(*[F.col(c) for c in ("s", "e", "ts", "te")]).alias("r")).orderBy("n")
    assert [r["r"] for r in got.collect()] == [
        "Date Matched",
        "New Contract",
        "Start & End Date not Match",
        "Start Date not Match",
        "End Date not Match",
        "Exception",
        "Start Date not Match",
        "Exception",
    ]


def test_highest_price(spark):
    rows = [
        (1, "1,200", "B", "A", "12", "48", None),
        (2, "10", "??", "A", "12", None, None),
        (3, "10", "B", "A", None, "3", None),
        (4, "10", "B", "A", "0", "3", None),
        (5, "10", "A", "A", "2", "3", "1,000"),
        (6, "free", "A", "A", "2", "3", None),
        (7, "10", None, "A", "2", "3", None),
    ]
    df = spark.createDataFrame(rows, "n int, price string, unit string, base string, q1 string, q2 string, q3 string")
    units = [(F.lit("B"), F.col("q1")), (F.lit("C"), F.col("q2")), (F.lit("D"), F.col("q3"))]
    price = feed.highest_unit_price(F.col("price"), F.col("unit"), F.col("base"), units)
    got = df.select("n", price.alias("p")).orderBy("n")
    assert got.dtypes[1] == ("p", "float")
    assert [r["p"] for r in got.collect()] == [4800.0, 120.0, 30.0, None, 10000.0, None, 30.0]


def test_codes_flags_and_buckets(spark):
    df = spark.createDataFrame([("f", 1, "a"), ("f", 1, "b"), ("f", 2, "a"), ("g", 1, None)], "src string, idx int, code string")
    mapping = spark.createDataFrame([("a", "X"), ("a", "Y"), ("c", "Z"), (None, "N")], "code string, value string")
    mapped = feed.map_codes(df, mapping, "code", "code", "value", "mapped")
    assert sorted((r["src"], r["idx"], r["mapped"] or "") for r in mapped.collect()) == [
        ("f", 1, ""),
        ("f", 1, "X"),
        ("f", 1, "Y"),
        ("f", 2, "X"),
        ("f", 2, "Y"),
        ("g", 1, ""),
    ]
    flagged = feed.flag_duplicates(df, ["src", "idx"], rows_per_slice=1)
    assert sorted((r["src"], r["idx"], r["Duplicates"]) for r in flagged.collect()) == [
        ("f", 1, "Y"),
        ("f", 1, "Y"),
        ("f", 2, ""),
        ("g", 1, ""),
    ]
    items = spark.createDataFrame([("I",), ("",), (None,)], "item string")
    default = classify.assign_bucket(items, classify.item_rules(items, "item"))
    assert {r["Bucket"]: r["rows"] for r in classify.bucket_counts(default).collect()} == {"update": 1, "create": 2}
    legacy = classify.assign_bucket(items, classify.item_rules(items, "item", legacy=True))
    assert {r["Bucket"]: r["rows"] for r in classify.bucket_counts(legacy).collect()} == {"update": 2, "create": 1}
    absent = classify.assign_bucket(items, classify.item_rules(items, "other"))
    assert classify.bucket_number(absent).first()[0] == 1
    ordered = classify.assign_bucket(items, [(F.lit(True), "vendor_link"), (F.lit(True), "update")])
    assert {r["Bucket"] for r in ordered.collect()} == {"vendor_link"}
