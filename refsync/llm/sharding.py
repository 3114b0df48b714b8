"""Sharding by sampled splitters, under the law `bytes`: the shards' sizes are near equal.

Records are ordered by a key (the hash of the text, so equal texts are neighbours). A sample of keys, drawn with a
chance in proportion to the records' sizes, gives quantile boundaries: ranges of about equal bytes. A key that spans
several quantiles has a range of its own. Then the bytes of every range are summed exactly, and a range that is overfull
is subdivided by a second hash of the key, or by rows if it has a single key. Inside a range, a running sum gives each record its exact position in the whole order of
bytes; with n shards, the record whose middle lies in the i-th of n equal parts goes to shard i. Equal texts stay
together unless they are larger than a sixteenth of a shard or than two ranges. Slots number the records of a shard without gaps, from the
number of records in earlier ranges.

The work per task is a range, whatever the distribution of keys; what the driver sees are the sampled keys and one row
per range, whose numbers are set by `RANGE_BYTES` and bounded. Everything is DataFrame expressions.

Nulls: a null text has no bytes and the key of the empty text; null ids are records like others. Repeated rows are each
placed. An empty table gives an empty result. Columns of the input with an output column's name are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refsync.sources.storage import stage

SHARDS = 24
RECORD_BYTES = 8
LEAST_RANGES = 1024
RANGE_BYTES = 256 << 20
SAMPLES_PER_RANGE = 16
LEAST_CELL_BITS = 10
WHOLE_SHARE = 16
BROADCAST_ROWS = 1_000_000
OUTPUTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from the driver."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the values only."""
    return (F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def splitters(records: DataFrame, ranges: int, total: int) -> list[int]:
    """Sorted first keys of the ranges after the first, from a size-weighted sample of (h, r, size)."""
    wanted = ranges * SAMPLES_PER_RANGE
    # a record larger than the sampling step counts once per step, so that its whole weight is seen
    times = F.floor(F.col("size") * (wanted / total) + _uniform(F.lit(7), "h", "r"))
    drawn = records.select("h", times.cast("int").alias("times")).filter("times > 0").groupBy("h").agg(F.sum("times").alias("times"))
    sample = sorted((row[0], row[1]) for row in drawn.collect())
    step = max(1.0, sum(t for _, t in sample) / ranges)
    found: list[int] = []
    reached, due = 0, step
    for key, times in sample:
        if times >= step:  # a range of its own
            found += [key, key + 1]
        elif reached + times >= due:
            found.append(key)
        reached += times
        while due <= reached:
            due += step
    return sorted({k for k in found if k < 1 << 63})


def _range_of(records: DataFrame, found: list[int]) -> DataFrame:
    """Column `range`: how many splitters are at or below h, looked up by the key's leading bits."""
    bits = max(LEAST_CELL_BITS, len(found).bit_length())
    by_cell: dict[int, list[int]] = {}
    for key in found:
        by_cell.setdefault(key >> (64 - bits), []).append(key)
    rows, before = [], 0
    for cell in range(-(1 << (bits - 1)), 1 << (bits - 1)):
        own = by_cell.get(cell, [])
        rows.append({"cell": cell, "before": before, "keys": own})
        before += len(own)
    cells = _table(records.sparkSession, rows, "cell: bigint, before: bigint, keys: array<bigint>")
    celled = records.withColumn("cell", F.shiftright("h", 64 - bits))
    joined = celled.join(F.broadcast(cells), "cell")
    number = F.col("before") + F.size(F.filter("keys", lambda k: k <= F.col("h")))
    return joined.withColumn("range", number).drop("cell", "before", "keys")


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`docs`, or its columns `keep`, with size, text_crc32, law, shard, slot, grown_shard (null under this law).

    If the texts themselves are kept, places are worked out without them: a row is known by a hash of its id and text,
    and joins its place at the end. Rows that are equal in both are told apart by carrying their columns along.
    """
    own = [c for c in (docs.columns if keep is None else keep) if c not in OUTPUTS]
    payload = docs.select(F.struct(*own).alias("row"), F.coalesce(docs[text], F.lit("")).alias("t"), docs[doc_id].alias("i"))
    records = payload.select(
        "row",
        (F.octet_length("t") + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(F.col("t").cast("binary")).alias("text_crc32"),
        F.xxhash64("t").alias("h"),
        F.xxhash64(F.lit(1), "i", "t").alias("r"),
        "i",
    )
    if text not in own:
        return _result(_places(records, shards, range_bytes), "row.*")
    repeated = stage(records.groupBy("r").count().filter("count > 1").select("r"), "shard-repeated")
    n = repeated.count()
    few = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    flagged = records.join(few.withColumn("again", F.lit(True)), "r", "left") if n else records.withColumn("again", F.lit(None).cast("boolean"))
    placed = _places(flagged.withColumn("row", F.when(F.col("again"), F.col("row"))).drop("again"), shards, range_bytes)
    single = records.join(few, "r", "left_anti") if n else records
    joined = single.select("r", "row").join(placed.filter("row IS NULL").drop("row"), "r")
    return _result(joined, "row.*").unionByName(_result(placed.filter("row IS NOT NULL"), "row.*")) if n else _result(joined, "row.*")


def _result(placed: DataFrame, *columns: str) -> DataFrame:
    return placed.select(*columns, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _places(records: DataFrame, shards: int, range_bytes: int) -> DataFrame:
    """(r, row, size, text_crc32, shard, slot) of records (row, size, text_crc32, h, r, i)."""
    spark = records.sparkSession
    narrow = records.select("size", "h", "r")
    total, count = narrow.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return records.select("r", "row", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    ranges = max(LEAST_RANGES, -(-total // range_bytes))
    ranged = _range_of(records, splitters(narrow, ranges, total))
    sizes = sorted(tuple(row) for row in ranged.groupBy("range").agg(F.sum("size"), F.min("h") == F.max("h")).collect())
    limit = 2 * total / ranges
    parts = _table(spark, [{"range": k, "parts": max(1, int(b / limit)), "one": one} for k, b, one in sizes], "range: bigint, parts: bigint, one: boolean")
    # by key; only a range of a single key is divided by rows (the place in the partition tells equal rows apart)
    by_row = F.xxhash64("r", F.monotonically_increasing_id())
    part = F.floor(_uniform(F.lit(3), F.when(F.col("one"), by_row).otherwise(F.col("h"))) * F.col("parts")).cast("bigint")
    placed = ranged.join(F.broadcast(parts), "range").withColumn("part", part).drop("parts", "one")

    within = ["range", "part"]
    order = Window.partitionBy(*within).orderBy("h", "r", "i")
    group = Window.partitionBy(*within, "h")
    running = placed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    running = running.withColumns({"group_size": F.sum("size").over(group), "group_end": F.max("end").over(group)})
    running = stage(running, "shard-positions")
    starts, before = [], 0
    for row in sorted(running.groupBy(*within).agg(F.sum("size").alias("bytes")).collect()):
        starts.append({"range": row[0], "part": row[1], "start": before})
        before += row[2]
    located = running.join(F.broadcast(_table(spark, starts, "range: bigint, part: bigint, start: bigint")), within)
    middle = F.when(F.col("group_size") * WHOLE_SHARE * shards <= total, F.col("group_end") - F.col("group_size") / 2).otherwise(F.col("end") - F.col("size") / 2)
    number = F.least(F.floor((F.col("start") + middle) * shards / float(total)), F.lit(shards - 1)).cast("int")
    located = located.withColumn("shard", number)
    counts, offset, filled = located.groupBy("shard", *within).count(), [], {}
    for row in sorted(counts.collect()):
        offset.append({"shard": row[0], "range": row[1], "part": row[2], "first": filled.get(row[0], 0)})
        filled[row[0]] = filled.get(row[0], 0) + row[3]
    firsts = F.broadcast(_table(spark, offset, "shard: int, range: bigint, part: bigint, first: bigint"))
    place = F.row_number().over(Window.partitionBy(*within, "shard").orderBy("end"))
    slotted = located.withColumn("place", place).join(firsts, ["shard", *within])
    slot = (F.col("first") + F.col("place") - 1).cast("bigint").alias("slot")
    return slotted.select("r", "row", "size", "text_crc32", "shard", slot)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])


QUERIES = {"op9_sharding": op9_sharding}
SQL: dict[str, str] = {}
