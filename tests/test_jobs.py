"""The jobs end to end on small dropped files."""

import os
import random
from datetime import date

from pyspark.sql import functions as F

from refsync.config import SyncSettings, TableSpec
from refsync.operators import clean
from refsync.plans import jobs, sample_tables
from refsync.sources import audit_store, files, snapshots, storage
from refsync.streaming import sync_stream

SPEC = TableSpec()
COLUMNS = [
    "PMM Item Number",
    "Corp Acct",
    "Vendor Code",
    "Additional Cost Centre",
    "Additional GL Account",
    "Item Update Date",
    "Vendor Name",
    "Vendor Seq",
    "Contract No",
    "Contract Item",
    "Vendor Catalogue",
    "Manufacturer Catalogue",
    "Item Description",
    "Contract EFF Date",
    "Contract EXP Date",
    "Default UOM Price",
]


def line(item, day, acct="0201", vendor="V1", seq="1", cat="C1", man="M1", price="10", name="Vendor", contract="K1", desc="thing"):
    return [item, acct, vendor, "", "", day, name, seq, contract, "Y", cat, man, desc, "2025-01-01", "2025-12-31", price]


def drop(folder, name, *lines, columns=COLUMNS):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf8") as out:
        out.write(",".join(columns) + "\n")
        out.writelines(",".join(values) + "\n" for values in lines)


def test_sync_full_then_increments(spark, root):
    folder, table, audit = f"{root}/drop", f"{root}/table", f"{root}/audit"
    settings = SyncSettings(max_files=1)
    assert jobs.sync(spark, f"{root}", table, audit, settings=settings) is None
    drop(folder, "Extract 0201.csv", line("A", "2025-01-01"), line("B", "2025-01-01", cat=""), line("X", "2025-01-01", acct="0202"), line("D", "bad date"))
    full = jobs.sync(spark, folder, table, audit, settings=settings)
    assert (full.kind, full.snapshot, full.files) == ("full", 1, ["Extract 0201.csv"])
    assert full.checks["blank_value"] == 1
    assert snapshots.read_snapshot(spark, table).count() == 3

    drop(folder, "Extract 2025_02_01.csv", line(" A ", "2/1/2025", price="11"), line("B", "2024-12-31"), line("N", "2025-Feb-01"), line("X", "2025-02-01", acct="0202"))
    drop(folder, "Extract 2025_02_02.csv", line("A", "2025-02-01", price="12"), line("N", "2025-02-03", vendor="V2"), line("D", "2025-02-01"))
    first = jobs.sync(spark, folder, table, audit, settings=settings)
    assert first.files == ["Extract 2025_02_01.csv"]
    assert first.counts == {"updated": 1, "stale": 1, "new": 1, "excluded": 1}
    changes = spark.read.parquet(first.tables["field_changes"]).collect()
    assert [(r["Column"], r["Previous Value"], r["Current Value"], r["source_file"]) for r in changes] == [
        ("Default UOM Price", "10", "11", "Extract 2025_02_01.csv")
    ]
    per_file = spark.read.parquet(first.tables["per_file_summary"]).first()
    assert (per_file["original_rows"], per_file["dropped_total"], per_file["skipped_stale"]) == (4, 2, 1)

    second = jobs.sync(spark, folder, table, audit, settings=settings)
    assert second.files == ["Extract 2025_02_02.csv"]
    assert second.counts == {"stale": 1, "new": 1, "unchanged": 1}
    assert jobs.sync(spark, folder, table, audit, settings=settings) is None
    rows = {(r["PMM Item Number"], r["Vendor Code"]): r for r in snapshots.read_snapshot(spark, table).collect()}
    assert sorted(rows) == [("A", "V1"), ("B", "V1"), ("D", "V1"), ("N", "V1"), ("N", "V2")]
    assert rows["A", "V1"]["Default UOM Price"] == 11.0 and rows["D", "V1"]["Item Update Date"] == date(2025, 2, 1)

    text = jobs.report(spark, audit, second)
    assert "Skipped Rows (Outdated) | 1" in text and "Extract 2025_02_02.csv" in text
    status = audit_store.status(spark, table, audit)
    assert status["snapshot"] == 3 and status["applied_increments"] == 2
    assert {r["kind"] for r in audit_store.runs(spark, audit).collect()} == {"full", "increment"}
    assert audit_store.read_audit(spark, audit, "run_summary").select("run_id").distinct().count() == 2

    snapshots.restore_snapshot(spark, table, 1)
    assert snapshots.read_snapshot(spark, table).count() == 3
    drop(folder, "Extract 0301.csv", line("Z", "2025-03-01"))
    assert jobs.sync(spark, folder, table, audit, settings=settings).kind == "full"
    # the increments are older than the new table: keys it lacks stay deleted
    assert jobs.sync(spark, folder, table, audit, settings=settings) is None
    assert [r["PMM Item Number"] for r in snapshots.read_snapshot(spark, table).collect()] == ["Z"]
    assert audit_store.applied_files(spark, table, audit, "increment").count() == 2
    # a name may be used again, and a corrected file is another file
    drop(folder, "Extract 0301.csv", line("Z", "2025-03-02"), line("Y", "2025-03-02"))
    again = jobs.sync(spark, folder, table, audit, settings=settings)
    assert again.kind == "full" and snapshots.read_snapshot(spark, table).count() == 2


def items(spark, table):
    return sorted(r["PMM Item Number"] for r in snapshots.read_snapshot(spark, table).collect())


def test_only_the_newest_full_file_counts(spark, root):
    folder, table, audit = f"{root}/drop", f"{root}/table", f"{root}/audit"
    settings = SyncSettings(keep_only_latest_full=True, archive_folder=f"{root}/done")
    drop(folder, "Extract 0301.csv", line("OLD", "2024-03-01"))
    os.utime(f"{folder}/Extract 0301.csv", (1_700_000_000, 1_700_000_000))
    drop(folder, "Extract 0201.csv", line("NEW", "2025-02-01"))
    plain = SyncSettings(keep_only_latest_full=True)
    assert jobs.sync(spark, folder, table, audit, settings=plain).files == ["Extract 0201.csv"]
    assert items(spark, table) == ["NEW"]
    assert jobs.sync(spark, folder, table, audit, settings=plain) is None  # the older one is superseded, not new
    assert {(r["name"], r["state"]) for r in audit_store.applied_files(spark, table, audit).collect()} == {
        ("Extract 0201.csv", "applied"),
        ("Extract 0301.csv", "superseded"),
    }
    drop(folder, "Extract 2025_02_03.csv", line("N", "2025-02-03"))
    assert jobs.sync(spark, folder, table, audit, settings=settings).counts == {"new": 1}
    assert os.listdir(f"{root}/done") == ["Extract 2025_02_03.csv"]


def test_waiting_and_unreadable_files(spark, root):
    folder, table, audit = f"{root}/drop", f"{root}/table", f"{root}/audit"
    start(spark, table)
    for day in (1, 2, 3):
        drop(folder, f"Extract 2025_06_0{day}.csv", line(f"W{day}", "2025-06-01"))
    first = jobs.sync(spark, folder, table, audit, settings=SyncSettings(max_files=2))
    assert (first.files, first.waiting) == (["Extract 2025_06_01.csv", "Extract 2025_06_02.csv"], 1)
    assert jobs.sync(spark, folder, table, audit).waiting == 0
    drop(folder, "Extract 2025_06_04.csv", line("OK", "2025-06-01"), [*line("BAD", "2025-06-01"), "more"])
    try:
        jobs.sync(spark, folder, table, audit)
        raise AssertionError("a damaged row must stop the run")
    except Exception as error:
        assert "does not fit its header" in str(error)
    jobs.sync(spark, folder, table, audit, settings=SyncSettings(on_bad_rows="quarantine"))
    assert "OK" in items(spark, table) and "BAD" not in items(spark, table)


def test_sync_without_the_version_column(spark, root):
    folder, table, audit = f"{root}/drop", f"{root}/table", f"{root}/audit"
    start(spark, table)
    kept = [i for i, c in enumerate(COLUMNS) if c != SPEC.version]
    rows = [[values[i] for i in kept] for values in (line("I2", "x", price="1"), line("I2", "x", price="77"), line("N", "x"))]
    drop(folder, "Extract 2025_06_01.csv", *rows, columns=[COLUMNS[i] for i in kept])
    result = jobs.sync(spark, folder, table, audit)
    assert "stale" not in result.counts and result.counts["new"] == 1
    got = {r["PMM Item Number"]: r for r in snapshots.read_snapshot(spark, table).collect()}
    assert got["I2"]["Default UOM Price"] == 77.0 and got["I2"][SPEC.version] is None and "N" in got


def test_stream_of_files_with_other_headers(spark, root):
    """Columns in another order and missing columns: the stream gives what the batch job gives."""
    for name in ("s", "b"):
        start(spark, f"{root}/{name}")
    swapped = [2, 1, 0, *range(3, len(COLUMNS))]
    short = list(range(len(COLUMNS) - 1))
    drop(f"{root}/drop", "Extract 2025_06_01.csv", line("I2", "2025-06-01", price="5"))
    drop(f"{root}/drop", "Extract 2025_06_02.csv", [line("I4", "2025-06-02", price="6")[i] for i in swapped], columns=[COLUMNS[i] for i in swapped])
    drop(f"{root}/drop", "Extract 2025_06_03.csv", [line("N", "2025-06-03")[i] for i in short], columns=[COLUMNS[i] for i in short])

    def run():
        sync_stream.sync_folder_stream(spark, f"{root}/drop", f"{root}/s", f"{root}/sa", f"{root}/checkpoint", settings=SyncSettings(max_files=1)).awaitTermination()

    run()
    for _ in range(3):
        jobs.sync(spark, f"{root}/drop", f"{root}/b", f"{root}/ba", settings=SyncSettings(max_files=1))
    assert table_state(snapshots.read_snapshot(spark, f"{root}/s")) == table_state(snapshots.read_snapshot(spark, f"{root}/b"))
    assert audit_store.applied_files(spark, f"{root}/s", f"{root}/sa").count() == 3
    committed = snapshots.latest_snapshot(spark, f"{root}/s")
    run()
    assert snapshots.latest_snapshot(spark, f"{root}/s") == committed


def random_files(seed, count=4, rows=40):
    r = random.Random(seed)
    result = []
    for f in range(count):
        lines = []
        for _ in range(rows):
            day = f"2025-0{r.randint(1, 9)}-{r.randint(10, 28)}" if r.random() < 0.9 else ""
            item = "HOT" if r.random() < 0.33 else f"I{r.randint(0, 15)}"
            lines.append(line(item, day, acct=r.choice(["0201", "0201", "0202"]), price=str(r.randint(1, 5))))
        result.append((f"Extract 2025_01_0{f + 1}.csv", lines))
    return result


def table_state(df):
    return sorted(map(str, df.select(*sorted(f"`{c}`" for c in df.columns)).collect()))


def start(spark, root):
    base = [line(f"I{i}", "2025-05-15") for i in range(0, 12, 2)] + [line("HOT", "2025-01-15")] * 3
    df = spark.createDataFrame(base, ", ".join(f"`{c}` string" for c in COLUMNS))
    snapshots.write_snapshot(clean.enforce_schema(clean.clean_strings(df), SPEC.types), root)


def test_properties_of_one_batch(spark, root):
    """Counts add up, heavy keys change nothing, applying the same files again changes nothing."""
    for name, lines in random_files(7):
        drop(f"{root}/drop", name, *lines)
    start(spark, f"{root}/t1")
    start(spark, f"{root}/t2")
    rows = files.read_increments(spark, f"{root}/drop", glob="*.csv").rows
    plain = jobs.sync_increment(spark, f"{root}/t1", f"{root}/a1", rows)
    sliced = jobs.sync_increment(spark, f"{root}/t2", f"{root}/a2", rows, rows_per_slice=3)
    assert sum(plain.counts.values()) == 160 and plain.counts == sliced.counts
    after = snapshots.read_snapshot(spark, f"{root}/t1")
    assert table_state(after) == table_state(snapshots.read_snapshot(spark, f"{root}/t2"))
    for name in plain.tables:
        a, b = spark.read.parquet(plain.tables[name]), spark.read.parquet(sliced.tables[name])
        assert table_state(a) == table_state(b), name
    assert after.groupBy(*[f"`{k}`" for k in SPEC.keys]).count().filter("count > 1").isEmpty()
    # against brute force: the newest dated version of every key, from the table or the files
    best = {}
    for item, day in [(f"I{i}", "2025-05-15") for i in range(0, 12, 2)] + [("HOT", "2025-01-15")]:
        best[item] = day
    for _, lines in random_files(7):
        for v in lines:
            if v[1] != "0202" and (v[0] not in best or v[5] > best[v[0]]):
                best[v[0]] = v[5]
    got = {r["PMM Item Number"]: str(r["Item Update Date"] or "") for r in after.collect()}
    assert got == best
    again = jobs.sync_increment(spark, f"{root}/t1", f"{root}/a1", rows)
    assert set(again.counts) <= {"stale", "excluded", "unchanged", "updated"}
    dated = again.counts.get("unchanged", 0) + again.counts.get("updated", 0)
    undated = sum(1 for r in after.collect() if r["Item Update Date"] is None)
    assert dated == 0 or undated > 0


def test_stream_equals_batches_and_replay_is_skipped(spark, root):
    start(spark, f"{root}/s")
    start(spark, f"{root}/b")
    for name, lines in random_files(11, count=3):
        drop(f"{root}/drop", name, *lines)
    schema = ", ".join(f"`{c}` string" for c in COLUMNS)

    def run():
        stream = sync_stream.increment_stream(spark, f"{root}/drop", schema, "csv", "*.csv", max_files=1)
        sync_stream.sync_stream(spark, stream, f"{root}/s", f"{root}/sa", f"{root}/checkpoint").awaitTermination()

    run()
    names = [
        (r["batch_id"] or "").rsplit("#", 1)[-1] for r in snapshots.manifest(spark, f"{root}/s").orderBy("sequence").collect()
    ]
    assert names == ["", "0", "1", "2"]
    for name in sorted(os.listdir(f"{root}/drop")):
        part = files.read_increments(spark, f"{root}/drop", glob=name).rows
        jobs.sync_increment(spark, f"{root}/b", f"{root}/ba", part)
    key = [f"`{k}`" for k in SPEC.keys]
    dates = [
        sorted(map(str, snapshots.read_snapshot(spark, f"{root}/{t}").select(*key, "`Item Update Date`").collect())) for t in "sb"
    ]
    assert dates[0] == dates[1]
    run()  # nothing new
    assert snapshots.latest_snapshot(spark, f"{root}/s") == 4
    assert snapshots.applied_batch(spark, f"{root}/s", sync_stream.batch_name(f"{root}/checkpoint", 2))


def test_all_phases(spark, root):
    drop(
        f"{root}/drop",
        "Extract 0201.csv",
        line("I1", "2025-01-01", cat="C1", man="M1"),
        line("I2", "2025-01-01", cat="C2", man="M1", vendor="V2", seq="2", contract="K2"),
        line("I3", "2025-01-01", cat="C3", acct="0204", man="M3"),
        line("I3", "2025-01-01", cat="C3", acct="0201", man="M4"),
        line("PM9", "2025-01-01", cat="C9", man="M9"),
        line("I9", "2025-01-01", cat="C9", man="M9", name="ZZZ gone"),
    )
    feed_columns = [
        "Distributor Part Number",
        "Manufacturer Part Number",
        "Plant ID",
        "Distributor",
        "Contract Start Date",
        "Contract End Date",
        "Date and Time Stamp",
        "Base Unit of Measure",
        "Purchase Order Price Unit of Measure",
        "AUOM1",
        "AUOM2",
        "AUOM3",
        "AUOM1 QTY",
        "AUOM2 QTY",
        "AUOM3 QTY",
        "Purchase UOM Price",
        "ERP Manufacturer No.",
        "MMC Distributor No.",
    ]

    def feed(dpn, mpn, day):
        return [dpn, mpn, "0299", "V1", "1/1/2025", "2025-12-31", day, "EA", "BX", "BX", "CS", "PL", "12", "48", "", "1200", "m1", "v1"]

    drop(
        f"{root}/daily",
        "daily_1.csv",
        feed("C1", "M1", "2025-Nov-06 03:04:05 PM"),
        feed("C9", "M9", "2025-Nov-07 03:04:05 PM"),
        feed("C3", "M3", "2025-Nov-05 03:04:05 PM"),
        columns=feed_columns,
    )
    mfn = spark.createDataFrame([("A1", "m1")], "`All_Manufacturer Number` string, `BC_Manufacturer No_` string")
    vn = spark.createDataFrame([("B1", "v1")], "`All_Vendor Code` string, `BC_Vendor No_` string")
    result = jobs.run_all(spark, f"{root}/drop", f"{root}/daily", f"{root}/out", mfn, vn, daily_glob="daily*")
    assert result["integrated"].endswith("integrated_2025-11-05~2025-11-07")
    rows = spark.read.parquet(result["integrated"]).collect()
    got = sorted((r["Index"], r["0031_PMM Item Number"], r["PMM_source"], r["Contract Header Check"], r["Duplicates"]) for r in rows)
    assert got == [
        (1, "I1", "DPN,MPN", "Date Matched", "Y"),
        (1, "I2", "MPN", "New Contract", "Y"),
        (2, "", "", "New Contract", ""),
        (3, "I3", "DPN", "Date Matched", ""),
    ]
    first = next(r for r in rows if r["0031_PMM Item Number"] == "I1")
    assert first["Highest_UOM_Price"] == 4800.0 and first["0031_Vendors List"] == "1-V1"
    assert (first["Suggested AllScripts MFN"], first["Suggested AllScripts VN"]) == ("A1", "B1")
    assert first["Suggested Contract No."] is None and first["0031_Contract No"] == "K1"
    exported = spark.read.parquet(result["exported"])
    assert {r["Bucket"]: r["count"] for r in exported.groupBy("Bucket").count().collect()} == {"update": 3, "create": 1}
    assert spark.read.parquet(f"{result['exported']}/Bucket=create").count() == 1
    assert jobs.export(spark, f"{root}/nothing", f"{root}/x") is None


def test_full_files_are_parsed_once(spark, root):
    """All tables of a full refresh come from one staging of the typed rows, which is gone afterwards."""
    parsed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    rows = sample_tables.contract_rows(spark, "/root/testdata/sf0.001").limit(500).coalesce(1)
    counted_rows = rows.mapInArrow(counted, rows.schema)
    result = jobs.full_refresh(spark, f"{root}/table", f"{root}/audit", counted_rows, buckets=4)
    assert parsed.value == 500
    assert {"rows_by_date", "duplicate_keys", "issues"} <= set(result.tables)
    assert not [n for n in storage.file_names(spark, f"{storage.work_folder(spark)}/refsync") if n.startswith("full-rows")]
