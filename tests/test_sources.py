import os
import time
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from refsync.operators import sync
from refsync.sources import audit_store, files, outputs, snapshots, storage


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf8") as out:
        out.write(text)
    return path


def test_headers_differ_between_files(spark, root):
    write(root, "x 2025_01_01.csv", "item,price\n A ,1\nB,\n")
    write(root, "x 2025_01_02.csv", "price, item,extra\n2,C,e\n")
    got = files.read_increments(spark, root, glob="*.csv")
    assert [os.path.basename(p) for p in got.paths] == ["x 2025_01_01.csv", "x 2025_01_02.csv"]
    rows = {(r["item"], r["price"], r["extra"], r["source_file"], r["row_index"]) for r in got.rows.collect()}
    assert rows == {
        ("A", "1", None, "x 2025_01_01.csv", 1),
        ("B", None, None, "x 2025_01_01.csv", 2),
        ("C", "2", "e", "x 2025_01_02.csv", 1),
    }


def test_which_files(spark, root):
    for name in ("a_2025_01_03.csv", "a_2025_01_01.csv", "a_2025_01_02.csv", "a_0201.csv", "other.txt"):
        write(root, name, "item\nx\n")
    write(os.path.join(root, "deep"), "a_2025_01_04.csv", "item\nx\n")
    for name, second in (("a_2025_01_03.csv", 3), ("a_2025_01_01.csv", 1), ("a_2025_01_02.csv", 2)):
        os.utime(os.path.join(root, name), (1_700_000_000 + second, 1_700_000_000 + second))

    def names(**options):
        return [os.path.basename(p) for p in files.select_files(spark, root, **options)]

    assert names(glob="a_*.csv", exclude_glob="a_[0-9][0-9][0-9][0-9].csv") == [
        "a_2025_01_01.csv",
        "a_2025_01_02.csv",
        "a_2025_01_03.csv",
    ]
    assert names(glob="a_2*.csv", max_files=2) == ["a_2025_01_01.csv", "a_2025_01_02.csv"]
    assert names(glob="a_2*.csv", newest_only=True) == ["a_2025_01_03.csv"]
    assert len(names(glob="*.csv", recursive=True)) == 5
    applied = spark.createDataFrame(storage.list_files(spark, root, "a_2025_01_01.csv").collect())
    assert names(glob="a_2*.csv", max_files=1, applied=applied) == ["a_2025_01_02.csv"]
    assert files.choose_files(spark, root, "a_2*.csv", max_files=1, applied=applied).waiting == 1
    write(root, "a_2025_01_01.csv", "item\nx\ncorrected\n")  # the name is known, the file is not
    assert names(glob="a_2*.csv", max_files=1, applied=applied) == ["a_2025_01_01.csv"]
    assert names(glob="a_2*.csv", newest_only=True) == ["a_2025_01_01.csv"]
    chosen = files.choose_files(spark, root, "a_2*.csv", newest_only=True, applied=storage.list_files(spark, root, "a_2025_01_01.csv"))
    assert chosen.paths == [] and [f["name"] for f in chosen.superseded] == ["a_2025_01_02.csv", "a_2025_01_03.csv"]
    assert files.read_increments(spark, root, glob="none*").rows is None


def test_rows_that_do_not_fit_their_header(spark, root):
    write(root, "a.csv", 'k,v,w\n1,"line one\nline two",x\n2,b,c\n3,x,y,EXTRA\n')
    write(root, "b.csv", "w,k\nz,9\n")
    paths = files.select_files(spark, root, "*.csv")
    with pytest.raises(Exception, match="does not fit its header"):
        files.read_files(spark, paths).rows.collect()
    kept = files.read_files(spark, paths, on_bad_rows="quarantine").rows.collect()
    assert {(r["k"], r["v"], r["w"]) for r in kept} == {("2", "b", "c"), ("9", None, "z")}
    bad = files.quarantined_rows(spark, paths).collect()
    assert {r["source_file"] for r in bad} == {"a.csv"} and "3,x,y,EXTRA" in {r["text"] for r in bad}
    whole = files.read_files(spark, paths, on_bad_rows="quarantine", multi_line=True).rows.collect()
    assert {(r["k"], r["v"]) for r in whole} == {("1", "line one\nline two"), ("2", "b"), ("9", None)}
    assert [r["text"] for r in files.quarantined_rows(spark, paths, multi_line=True).collect()] == ["3,x,y,EXTRA"]
    assert files.quarantined_rows(spark, []).count() == 0


def test_row_numbers_of_a_file_read_in_many_blocks(spark, root):
    lines = [f"{i},{'x' * (i % 50)}" for i in range(1, 3001)]
    write(root, "a.csv", "n,text\n" + "\n".join(lines) + "\n")
    write(root, "b.csv", "n,text\n" + "\n".join(lines[:10]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        paths = files.select_files(spark, root, "*.csv")
        rows = files.read_files(spark, paths).rows
        got = rows.select("source_file", "n", "row_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3010
    assert all(int(r["n"]) == r["row_index"] for r in got)


def test_parquet_and_json_rows(spark, root):
    spark.range(5).select(F.col("id").cast("int").alias("n"), F.lit(" x ").alias("s")).coalesce(1).write.parquet(f"{root}/p")
    got = files.read_increments(spark, f"{root}/p", "parquet", "*.parquet").rows
    assert dict(got.dtypes)["n"] == "string"
    assert sorted((r["n"], r["s"], r["row_index"]) for r in got.collect()) == [(str(i), "x", i + 1) for i in range(5)]
    write(f"{root}/j", "a.json", '{"n": 1, "o": {"k": 2}}\n{"n": 2.5}\n')
    got = files.read_increments(spark, f"{root}/j", "json", "*.json").rows.orderBy("row_index")
    assert [(r["n"], r["o"]) for r in got.collect()] == [("1", '{"k":"2"}'), ("2.5", None)]


def test_unreadable_files(spark, root):
    write(root, "bad.parquet", "this is not parquet")
    spark.range(1).write.parquet(f"{root}/good")
    good = files.select_files(spark, f"{root}/good", "*.parquet")
    with pytest.raises(Exception):
        files.read_files(spark, [f"{root}/bad.parquet", *good], "parquet")
    got = files.read_files(spark, [f"{root}/bad.parquet", *good], "parquet", on_error="skip")
    assert got.unreadable == [f"{root}/bad.parquet"] and got.rows.count() == 1


def test_daily_feed(spark, root):
    write(root, "feed+%41 1.csv", "Part,Contract Start Date\np1,1/2/2025\np2,bad\n")
    write(root, "feed_2.csv", "Contract Start Date,Part\n2025-Jan-03,p3\n")
    daily = files.read_daily(spark, root, ["Contract Start Date"], glob="feed*")
    assert daily.columns[0] == "Source_File"
    assert sorted((r["Source_File"], r["Index"], r["Part"], r["Contract Start Date"]) for r in daily.collect()) == [
        ("feed+%41 1", 1, "p1", date(2025, 1, 2)),
        ("feed+%41 1", 2, "p2", None),
        ("feed_2", 1, "p3", date(2025, 1, 3)),
    ]
    write(root, "feed_3.csv", "Part,Other\np1,x\n")
    with pytest.raises(ValueError, match="different columns"):
        files.read_daily(spark, root, [], glob="feed*")
    with pytest.raises(ValueError, match="no daily files"):
        files.read_daily(spark, root, [], glob="nothing*")


def test_reference_tables(spark, root):
    path = write(root, "map.csv", "code,value,more\na,1,x\n")
    assert files.read_reference(spark, path, ["value", "code"]).collect()[0].asDict() == {"value": "1", "code": "a"}
    assert files.read_reference(spark, path, ["absent"], optional=True) is None
    assert files.read_reference(spark, f"{root}/nothing.csv", ["code"], optional=True) is None
    with pytest.raises(ValueError):
        files.read_reference(spark, path, ["absent"])


def test_dates_in_file_names(spark):
    df = spark.createDataFrame([("Extract 2025_11_06.csv",), ("Extract 0201.csv",), ("x",)], "name string")
    day = storage.file_name_date(F.col("name"), r"(\d{4}_\d{2}_\d{2})", "yyyy_MM_dd")
    assert [r[0] for r in df.select(day).collect()] == [date(2025, 11, 6), None, None]


def test_archive(spark, root):
    first = write(root, "a.csv", "1")
    assert storage.archive_files(spark, [first], f"{root}/archive") == [f"{root}/archive/a.csv"]
    moved = storage.archive_files(spark, [write(root, "a.csv", "2")], f"{root}/archive")
    assert moved != [f"{root}/archive/a.csv"] and moved[0].endswith(".csv")
    assert storage.expire_files(spark, f"{root}/archive", 1) == []
    os.utime(f"{root}/archive/a.csv", (0, 0))
    assert len(storage.expire_files(spark, f"{root}/archive", 90)) == 1
    assert not os.path.exists(f"{root}/archive/a.csv") and os.path.exists(moved[0])
    assert storage.expire_files(spark, f"{root}/none", 1) == []


def test_snapshots(spark, root):
    one, two, three = (spark.range(n).toDF("n") for n in (1, 2, 3))
    assert snapshots.latest_snapshot(spark, root) is None
    with pytest.raises(ValueError, match="no snapshot"):
        snapshots.read_snapshot(spark, root)
    assert snapshots.write_snapshot(one, root, "s#0") == 1
    assert snapshots.write_snapshot(two, root, "s#0") == 1  # the same batch again
    assert snapshots.read_snapshot(spark, root).count() == 1
    assert snapshots.write_data(three, root) == 2  # written, never committed
    assert snapshots.read_snapshot(spark, root).count() == 1
    # reading the table while its next version is written
    assert snapshots.write_snapshot(snapshots.read_snapshot(spark, root).union(two), root, "t#0") == 3
    assert snapshots.read_snapshot(spark, root).count() == 3
    snapshots.restore_snapshot(spark, root, 1)
    assert snapshots.read_snapshot(spark, root).count() == 1
    assert snapshots.write_snapshot(three, root) == 4
    with pytest.raises(ValueError, match="does not exist"):
        snapshots.restore_snapshot(spark, root, 9)
    assert snapshots.expire_snapshots(spark, root, 1) == []
    assert snapshots.expire_snapshots(spark, root, -1) == [1, 3]
    assert snapshots.latest_snapshot(spark, root) == 4 and not os.path.exists(f"{root}/data/snapshot=1")
    with pytest.raises(ValueError, match="does not exist"):
        snapshots.restore_snapshot(spark, root, 1)


def test_two_writers_at_once(spark, root):
    """Both start from the same table: each has its own folder, one commits, the other fails, no rows are lost."""
    snapshots.write_snapshot(spark.range(1), root)
    base = snapshots.sequence(spark, root)
    first, second = snapshots.write_data(spark.range(5), root), snapshots.write_data(spark.range(7), root)
    assert first != second
    assert snapshots.commit(spark, root, second, base=base) == 7
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.commit(spark, root, first, base=base)
    assert snapshots.read_snapshot(spark, root).count() == 7 and snapshots.manifest(spark, root).count() == 2
    assert snapshots.read_snapshot(spark, root, first).count() == 5
    with pytest.raises(FileExistsError):
        storage.create_file(spark, f"{root}/manifest/000000000002.json", "{}")


def test_staged_tables_are_removed(spark):
    with storage.discard_staged(spark):
        kept = storage.stage(spark.range(3), "t").inputFiles()[0]
        assert os.path.exists(kept.removeprefix("file://"))
    assert not os.path.exists(kept.removeprefix("file://"))


def test_runs_and_status(spark, root):
    assert audit_store.status(spark, f"{root}/t", f"{root}/a") == {
        "exists": False,
        "snapshot": None,
        "size_bytes": None,
        "applied_increments": 0,
        "last_run": None,
    }
    snapshots.write_snapshot(spark.range(3), f"{root}/t")
    for run, kind, names in (("1", "increment", ["a"]), ("2", "full", ["f"]), ("3", "increment", ["b", "c"])):
        audit_store.record_run(spark, f"{root}/a", run_id=run, kind=kind, files=names, finished_at=datetime(2025, 1, int(run)))
    status = audit_store.status(spark, f"{root}/t", f"{root}/a")
    assert status["exists"] and status["size_bytes"] > 0 and status["last_run"]["run_id"] == "3"
    with pytest.raises(ValueError, match="unknown run values"):
        audit_store.record_run(spark, f"{root}/a", nonsense=1)


RANGES = [
    (["2019-07-30", "2019-07-30", None], "2019-07-30"),
    (["2020-02-29", "2018-12-31", "2019-06-15"], "2018-12-31~2020-02-29"),
    ([], "no_data"),
    ([None, "n/a", "2021-02-30"], "no_data"),
    (["soon", "2024-11-09", ""], "2024-11-09"),
]


@pytest.mark.parametrize("values,want", RANGES)
def test_date_ranges(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "d string")
    assert outputs.date_range(df, "d", ["yyyy-MM-dd"]) == want


def test_names_and_outputs(spark, root):
    df = spark.createDataFrame(
        [("2025-Nov-06 03:04:05 PM", date(2025, 1, 1), "b", "update"), ("2025-Nov-07 03:04:05 AM", date(2025, 1, 2), "a", "create")],
        "`Date and Time Stamp` string, d date, s string, Bucket string",
    )
    assert outputs.date_range(df, "absent", ["yyyy"]) == "no_data"
    assert outputs.date_range(df, "Date and Time Stamp", ["yyyy-MMM-dd hh:mm:ss a"]) == "2025-11-06~2025-11-07"
    assert outputs.export_name(df, ["absent", "d"]) == "ExportFile_2025-01-01~2025-01-02"
    assert outputs.export_name(df, ["Date and Time Stamp"]) == "ExportFile_no_data"
    assert outputs.export_name(df, ["absent"]).startswith("ExportFile_20")
    path = outputs.write_named(df, root, "out_x", "csv", sort_by=["s"])
    assert [r["s"] for r in spark.read.option("header", "true").csv(path).collect()] == ["a", "b"]
    assert spark.read.parquet(outputs.write_named(df, root, "out_y", "xlsx")).count() == 2
    path = outputs.write_buckets(df, root, "export")
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["Bucket=create", "Bucket=update"]
    assert Counter(r["Bucket"] for r in spark.read.parquet(path).collect()) == {"update": 1, "create": 1}


def test_stage_keeps_rows_and_prunes_columns(spark):
    df = storage.stage(spark.range(10).select("id", F.lit("x").alias("wide")), "t")
    assert df.count() == 10 and df.columns == ["id", "wide"]
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan
    assert sync.latest_wins(df, ["wide"], "id").first()["id"] == 9


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {os.path.join(at, name) for folder in dirs for at, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark, root):
    before, held = _shuffle_files(spark), {k: spark.conf.get(k) for k in storage.WRITE_SETTINGS}
    rows = spark.range(50_000).withColumn("part", F.col("id") % 3).repartition(4, "id")
    staged = storage.stage(rows, "test")
    snapshots.write_data(rows, f"{root}/table")
    audit_store.write_audit({"one": rows.groupBy("part").count(), "two": rows.distinct()}, f"{root}/audit", "run")
    outputs.write_buckets(rows, f"{root}/out", "all", "part")
    for _ in range(50):  # they are deleted by a thread of their own
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert {k: spark.conf.get(k) for k in storage.WRITE_SETTINGS} == held != storage.WRITE_SETTINGS
    assert staged.count() == rows.count() == 50_000


def test_blocks_of_staged_tables(spark):
    rows = spark.range(3)
    with storage.discard_staged(spark):
        with storage.discard_staged(spark):
            inner, outer = storage.stage(rows, "inner"), storage.stage(rows, "outer", outer=True)
        assert not storage.exists(spark, inner.inputFiles()[0].rsplit("/", 1)[0])
        assert outer.count() == 3
    assert not storage.exists(spark, outer.inputFiles()[0].rsplit("/", 1)[0])
    with storage.discard_staged(spark):
        alone = storage.stage(rows, "alone", outer=True)
    assert alone.count() == 3
