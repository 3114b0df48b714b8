"""Check facts against full runs, key summaries, header discovery, runs of all steps."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from refsync.operators import checks, skew
from refsync.sources import audit_store, check_store, files, snapshots

ROLES = ("contract", "vendor", "cat", "item", "acct", "seq")
ROW = ", ".join(f"{c} string" for c in ROLES)


def random_rows(rng, n):
    pick = lambda *values: rng.choice(values)
    return [(pick("K1", "K2", "K3", " N/A ", None), pick("v1", "v2", None), pick("c1", "c2", " ", None), pick("i1", "i2", "i3", None), pick("0101", "0102", "0201"), pick("1", "2", None)) for _ in range(n)]


def as_set(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*checks.FACT, "rows").collect())


def test_facts_follow_random_batches(spark, root):
    rng = random.Random(8)
    table = random_rows(rng, 60)
    part = check_store.prepare_all(checks.check_facts(spark.createDataFrame(table, ROW), *ROLES), root, 8)
    snapshots.commit(spark, root, part, note="0")
    for step in range(1, 5):
        gone = rng.sample(range(len(table)), 5)
        came = random_rows(rng, 4)
        change = checks.check_facts(spark.createDataFrame(came, ROW), *ROLES).unionByName(
            checks.check_facts(spark.createDataFrame([table[i] for i in gone], ROW), *ROLES, weight=-1)
        )
        table = [r for i, r in enumerate(table) if i not in gone] + came
        base = snapshots.sequence(spark, root)
        part = check_store.prepare(spark, root, change)
        whole = checks.issue_rows(checks.check_facts(spark.createDataFrame(table, ROW), *ROLES))
        counts = checks.issue_counts(whole).first().asDict()
        assert check_store.counts(spark, root, part) == counts
        assert check_store.commit(spark, root, part, step, base)
        assert check_store.is_current(spark, root, step) and not check_store.is_current(spark, root, step - 1)
        assert as_set(check_store.issues(spark, root)) == as_set(whole)
        allowed = spark.createDataFrame([("i1",), (None,)], "item string")
        some = checks.issue_counts(checks.issue_rows(checks.check_facts(spark.createDataFrame(table, ROW), *ROLES), allowed)).first().asDict()
        assert check_store.counts(spark, root, part, allowed) == some
    late = check_store.prepare(spark, root, checks.check_facts(spark.createDataFrame(random_rows(rng, 3), ROW), *ROLES))
    assert not check_store.commit(spark, root, late, 9, base)  # another writer was first
    wrong = checks.check_facts(spark.createDataFrame([("new", "v", "c", "i", "01", "1")], ROW), *ROLES, weight=-1)
    with pytest.raises(Exception, match="do not fit"):
        check_store.prepare(spark, root, wrong)


def test_facts_say_what_the_checks_say(spark):
    rows = random_rows(random.Random(9), 80)
    df = spark.createDataFrame(rows, ROW)
    issues = checks.run_checks(df, *ROLES)
    assert checks.issue_counts(checks.issue_rows(checks.check_facts(df, *ROLES))).first() == checks.check_counts(issues).first()
    assert checks.check_facts(df.select("item"), *ROLES).count() == 0
    assert checks.issue_counts(checks.issue_rows(checks.check_facts(df.limit(0), *ROLES))).first()["has_issues"] is False


def test_summary_of_keys(spark, monkeypatch):
    rows = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("a"),
        (F.col("id") % 2).alias("b"),
    )
    staged, summary = skew.stage_summarised(rows, "t", ["a"], ["b", "a"], [])
    assert summary.rows == staged.count() == 5_000
    hot = summary.hot(staged, ["a"], 1_000)
    assert sorted(map(tuple, hot.table.collect()), key=str) == [("hot", 2), (None, 2)]
    assert {(r["b"], r["a"]) for r in summary.hot(staged, ["b", "a"], 800).table.collect()} == {(b, a) for b in (0, 1) for a in ("hot", None)}
    assert summary.hot(staged, ["a"], 5_000).table is None
    # the join with a summary counts nothing and gives the same rows
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "a string, v int")
    want = sorted(map(tuple, staged.join(right, "a", "left").select("a", "b", "v").collect()), key=str)
    monkeypatch.setattr(skew, "hot_keys", lambda *a, **k: pytest.fail("counted"))
    joined = skew.skewed_join(staged, right, ["a"], "left", right_unique=True, hot_left=hot, rows_per_slice=1_000)
    assert sorted(map(tuple, joined.select("a", "b", "v").collect()), key=str) == want
    few = skew.skewed_join(staged, right, ["a"], "left", rows_per_slice=10_000, left_rows=5_000, right_rows=2)
    assert few.count() == 5_000
    empty, nothing = skew.stage_summarised(rows.limit(0), "t", ["a"])
    assert nothing.rows == empty.count() == 0 and nothing.hot(empty, ["a"]).table is None


def test_headers_are_read_by_one_job(spark, tmp_path):
    for i in range(30):
        head = ("a,b\n1,2\n", "\n \nb,a\n3,4\n", '"a","c, d"\n5,6\n')[i % 3]
        (tmp_path / f"file {i:02d}+x.csv").write_text(head)
    (tmp_path / "empty.csv").write_text("")
    paths = sorted(f"{tmp_path}/{n}" for n in os.listdir(tmp_path))
    lines = files.header_lines(spark, paths).groupBy("header").count().collect()
    assert sorted(map(tuple, lines)) == [('"a","c, d"', 10), ("a,b", 10), ("b,a", 10)]
    read = files.read_files(spark, paths).rows
    assert set(read.columns) == {"a", "b", "c, d", "source_file", "row_index"}
    got = {(r["a"], r["b"], r["c, d"]): n for r, n in ((r, r["count"]) for r in read.groupBy("a", "b", "c, d").count().collect())}
    assert got == {("1", "2", None): 10, ("4", "3", None): 10, ("5", None, "6"): 10}
    single = files.read_files(spark, paths[:1] + paths[3:4], on_error="skip").rows
    assert single.count() == 2 - (paths[0].endswith("empty.csv"))


def test_parquet_headers_in_one_read_and_types_that_contradict(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.parquet(f"{root}/1")
    spark.createDataFrame([("y", "z")], "b string, c string").coalesce(1).write.parquet(f"{root}/2")
    paths = files.select_files(spark, root, "*.parquet", recursive=True)
    assert sorted(map(str, files.read_files(spark, paths, "parquet").rows.select("a", "b", "c").collect())) == ["Row(a='1', b='x', c=None)", "Row(a=None, b='y', c='z')"]
    spark.createDataFrame([("text",)], "a string").coalesce(1).write.parquet(f"{root}/3")
    paths = files.select_files(spark, root, "*.parquet", recursive=True)
    assert sorted(str(r["a"]) for r in files.read_files(spark, paths, "parquet").rows.collect()) == ["1", "None", "text"]


def test_a_run_is_one_row_however_often_it_is_recorded(spark, root):
    audit_store.record_run(spark, root, run_id="r1", kind="increment", row_count=1)
    audit_store.record_run(spark, root, run_id="r1", kind="increment", row_count=2)
    audit_store.record_run(spark, root, run_id="r2", kind="export", state="failed")
    assert sorted((r["run_id"], r["row_count"], r["state"]) for r in audit_store.runs(spark, root).collect()) == [("r1", 2, None), ("r2", None, "failed")]
