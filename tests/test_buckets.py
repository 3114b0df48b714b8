"""Tables in buckets: what a batch writes, who conflicts, what a restore undoes."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from refsync.config import TableSpec
from refsync.functions.keys import key_columns
from refsync.operators import clean, sync
from refsync.plans import jobs, sample_tables
from refsync.sources import audit_store, snapshots

LAYOUT = snapshots.Layout(("k",), 50)


def files_of(folder):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def keys_in(spark, buckets, n):
    rows = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(1).alias("v"))
    return rows.filter(snapshots.bucket_column(rows, LAYOUT).isin(buckets))


def upserted(spark, root, rows, base=None):
    touched = snapshots.buckets_of(rows, LAYOUT)
    merged = sync.upsert(snapshots.read_snapshot(spark, root, buckets=touched), rows, ["k"])
    return snapshots.write_buckets(merged, root, LAYOUT, touched)


def test_a_batch_writes_the_buckets_it_touches(spark, root):
    table = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(0).alias("v"))
    snapshots.write_snapshot(table, root, layout=LAYOUT)
    before = files_of(f"{root}/data")
    part = upserted(spark, root, keys_in(spark, [7], 2_000))
    assert part.touched == [7]
    assert snapshots.read_snapshot(spark, root).agg(F.sum("v")).first()[0] == 0  # not committed yet
    assert snapshots.commit(spark, root, part) == 20_000
    new = {p: n for p, n in files_of(f"{root}/data").items() if p not in before}
    assert sum(new.values()) < 0.04 * sum(before.values())
    changed = keys_in(spark, [7], 2_000).count()
    after = snapshots.read_snapshot(spark, root)
    assert (after.count(), after.agg(F.sum("v")).first()[0]) == (20_000, changed)
    assert snapshots.read_snapshot(spark, root, buckets=[7]).filter("v = 1").count() == changed
    assert snapshots.read_snapshot(spark, root, buckets=[8]).filter("v = 1").count() == 0
    assert snapshots.read_snapshot(spark, root, 1).agg(F.sum("v")).first()[0] == 0  # the older snapshot is whole


def test_writers_conflict_only_on_a_common_bucket(spark, root):
    snapshots.write_snapshot(keys_in(spark, list(range(50)), 500).withColumn("v", F.lit(0)), root, layout=LAYOUT)
    base = snapshots.sequence(spark, root)
    one, two, three = (upserted(spark, root, keys_in(spark, own, 500)) for own in ([1, 2], [3], [2]))
    snapshots.commit(spark, root, one, base=base)
    snapshots.commit(spark, root, two, base=base)
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.commit(spark, root, three, base=base)
    assert snapshots.read_snapshot(spark, root).agg(F.sum("v")).first()[0] == keys_in(spark, [1, 2, 3], 500).count()
    # a whole rewrite is a conflict for everybody
    base, four = snapshots.sequence(spark, root), upserted(spark, root, keys_in(spark, [9], 500))
    snapshots.write_snapshot(snapshots.read_snapshot(spark, root), root, layout=LAYOUT)
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.commit(spark, root, four, base=base)


def test_new_columns_hot_keys_empty_buckets_and_strangers(spark, root):
    hot = spark.range(3_000).select(F.when(F.col("id") < 1_000, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.lit(0).alias("v"))
    snapshots.write_snapshot(hot, root, layout=LAYOUT)
    rows = spark.createDataFrame([(" hot ", 5, "new")], "k string, v int, more string")
    part = upserted(spark, root, rows)  # padded and plain keys are the same key
    assert snapshots.commit(spark, root, part) == 2_001
    after = snapshots.read_snapshot(spark, root)
    assert after.columns == ["k", "v", "more"] and after.filter("more IS NOT NULL").count() == 1
    emptied = snapshots.write_buckets(after.limit(0), root, LAYOUT, part.touched)
    left = snapshots.commit(spark, root, emptied)
    assert left == snapshots.read_snapshot(spark, root).count() == 2_001 - snapshots.read_snapshot(spark, root, 2, part.touched).count()
    with pytest.raises(ValueError, match="not replaced"):
        snapshots.write_buckets(rows, root, LAYOUT, [b for b in range(50) if b not in part.touched])
    with pytest.raises(ValueError, match="layout"):
        snapshots.commit(spark, root, snapshots.write_buckets(rows.limit(0), root, snapshots.Layout(("k",), 3), [0]))
    with pytest.raises(ValueError, match="column v"):
        snapshots.commit(spark, root, snapshots.write_buckets(rows.withColumn("v", F.lit("x")), root, LAYOUT, part.touched))
    assert snapshots.commit(spark, root, snapshots.write_buckets(rows, root, LAYOUT, [])) == left  # nothing touched


def test_random_batches_against_a_plain_table(spark, root):
    rng = random.Random(4)
    table = {f"k{i}": 0 for i in range(300)}
    snapshots.write_snapshot(spark.createDataFrame(list(table.items()), "k string, v int"), root, layout=LAYOUT)
    for step in range(1, 5):
        batch = {f"k{rng.randrange(400)}": step for _ in range(rng.randrange(1, 12))}
        table |= batch
        snapshots.commit(spark, root, upserted(spark, root, spark.createDataFrame(list(batch.items()), "k string, v int")))
        assert dict(map(tuple, snapshots.read_snapshot(spark, root).collect())) == table
    # old folders go bucket by bucket: what the current snapshot needs stays
    assert snapshots.expire_snapshots(spark, root, -1) == [1, 2, 3, 4]
    assert dict(map(tuple, snapshots.read_snapshot(spark, root).collect())) == table
    held = {p.split("/data/snapshot=")[1].rsplit("/", 1)[0] for p in files_of(f"{root}/data")}
    assert held == {f"{own[0]}/{snapshots.BUCKET}={b}" for b, own in snapshots.state(spark, root).folders.items()}


SPEC = TableSpec()


def raw(spark, rows):
    names = [*SPEC.keys, SPEC.version, SPEC.price, SPEC.contract, SPEC.catalogue, SPEC.sequence, SPEC.vendor_name]
    full = [(i, a, v, "c", "g", day, price, f"C{i}", "cat", "1", "name") for i, a, v, day, price in rows]
    return spark.createDataFrame(full, ", ".join(f"`{n}` string" for n in names))


def state_of(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("buckets", [None, 20])
def test_sync_job_with_and_without_buckets(spark, tmp_path, buckets):
    root = str(tmp_path)
    rng = random.Random(11)
    table, audit = f"{root}/t", f"{root}/a"
    start = [(f"i{k}", "0101", f"v{k % 3}", "2024-01-05", "1.5") for k in range(60)] + [("gone", "0202", "v", "2024-01-05", "1")]
    result = jobs.full_refresh(spark, table, audit, raw(spark, start), SPEC, buckets=buckets)
    assert snapshots.read_snapshot(spark, table).count() == 60 and result.counts == {}
    want = {(i, v): ("2024-01-05", 1.5) for i, a, v, _, _ in start[:60]}
    for step in range(3):
        day = f"2024-0{rng.randrange(1, 4)}-0{rng.randrange(1, 9)}"
        batch = [(f"i{k}", "0101", f"v{k % 3}", day, f"{step + 2}.0") for k in rng.sample(range(80), 5)]
        done = jobs.sync_increment(spark, table, audit, raw(spark, batch), SPEC)
        for i, _, v, d, p in batch:
            if (i, v) not in want or want[i, v][0] < d:
                want[i, v] = d, float(p)
        rows = snapshots.read_snapshot(spark, table)
        assert {(r[SPEC.item], r[SPEC.vendor]): (str(r[SPEC.version]), r[SPEC.price]) for r in rows.collect()} == want
        assert done.snapshot == snapshots.latest_snapshot(spark, table)
    if buckets:
        assert 0 < len({own[0] for own in snapshots.state(spark, table).folders.values()}) <= 4
        # other exclusion rules: all buckets are written, and the rule reaches rows of untouched buckets
        other = TableSpec(excluded_vendor_prefixes=("na",))
        jobs.sync_increment(spark, table, audit, raw(spark, [("z", "0101", "v", "2024-09-01", "9")]), other)
        assert snapshots.read_snapshot(spark, table).count() == 0


def test_restore_undoes_the_files_of_later_batches(spark, tmp_path):
    table, audit = f"{tmp_path}/t", f"{tmp_path}/a"
    jobs.full_refresh(spark, table, audit, raw(spark, [("a", "0101", "v", "2024-01-01", "1")]), SPEC, buckets=8)

    def applied():
        return sorted(r["name"] for r in audit_store.applied_files(spark, table, audit).collect())

    def batch(name, item):
        found = {"applied": [{"path": f"/x/{name}", "name": name, "modified": None, "length": 1}]}
        return jobs.sync_increment(spark, table, audit, raw(spark, [(item, "0101", "v", "2024-02-01", "1")]), SPEC, [name], file_states=found)

    first = batch("one", "b")
    batch("two", "c")
    assert applied() == ["one", "two"]
    snapshots.restore_snapshot(spark, table, first.snapshot)
    assert applied() == ["one"]
    batch("two", "c")
    assert applied() == ["one", "two"]
    assert sorted(r[SPEC.item] for r in snapshots.read_snapshot(spark, table).collect()) == ["a", "b", "c"]
    snapshots.restore_snapshot(spark, table, 1)
    assert applied() == []


def test_buckets_are_those_of_the_normalised_key_and_their_code_is_compiled(spark):
    """A method of generated code with more than 8,000 bytes is never compiled by the JVM."""
    spec = TableSpec()
    rows = clean.enforce_schema(sample_tables.contract_rows(spark, "/root/testdata/sf0.001"), spec.types)
    padded = rows.withColumn(spec.keys[0], F.concat(F.lit("\t "), f"`{spec.keys[0]}`", F.lit("　")))
    padded = padded.withColumn(spec.keys[1], F.when(F.rand(3) < 0.5, F.col(f"`{spec.keys[1]}`"))).withColumn(spec.keys[2], F.lit(7))
    layout = snapshots.Layout(spec.keys, 32)
    parts = [c.cast("string") for c in key_columns(padded, spec.keys)]
    was = F.pmod(F.xxhash64(*parts), F.lit(32)).cast("int")
    assert padded.select(snapshots.bucket_column(padded, layout).alias("now"), was.alias("was")).filter("now <> was").count() == 0
    dealt = jobs._exclude(rows, spec).withColumn("bucket", snapshots.bucket_column(rows, layout))
    code = spark._jvm.PythonSQLUtils.explainString(dealt._jdf.queryExecution(), "codegen")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", code)) < 8000
