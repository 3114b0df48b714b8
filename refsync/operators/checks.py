"""Data checks on the reference table. They report; they never stop a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.keys import distinct_keys, key_names, with_keys
from refsync.functions.text import is_blank, trimmed
from refsync.operators.skew import ROWS_PER_SLICE, skewed_join
from refsync.sources.storage import stage

# Names of the checks.
ONE_TO_ONE, BLANK_VALUE, CONSISTENT_VALUE = "one_to_one", "blank_value", "consistent_value"

#: What a fact is about. A subject has up to three parts.
SUBJECT = ("check", "part1", "part2", "part3")
FACT = (*SUBJECT, "value", "detail")


def table_duplicate_keys(current: DataFrame, increments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the table holds more than once: rows, surplus rows, and is the key being updated now.

    The surplus rows of the keys being updated vanish in the upsert.
    """
    names = key_names(keys)
    counts = with_keys(current, keys).groupBy(*names).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    updating = distinct_keys(increments, keys).withColumn("__updating", F.lit(True))
    joined = skewed_join(counts, updating, names, "left", left_unique=True, right_unique=True, null_safe=True)
    return joined.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)],
        "rows",
        (F.col("rows") - 1).alias("surplus"),
        F.coalesce("__updating", F.lit(False)).alias("being_updated"),
    )


def table_duplicate_summary(duplicates: DataFrame) -> DataFrame:
    """Number of duplicate keys, how many are being updated, and the rows that will vanish."""
    surplus = F.sum(F.when(F.col("being_updated"), F.col("surplus")))
    return duplicates.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.count_if("being_updated").alias("keys_being_updated"),
        F.coalesce(surplus, F.lit(0)).alias("rows_removed"),
    )


def one_to_one(df: DataFrame, column: str, value: str, ignore: str = "N/A") -> DataFrame:
    """Values of `column` that go with more than one `value`: the count and the sorted values.

    Pairs are made distinct first (combined before the shuffle, spread by pair), so copies of a pair never
    travel and the list holds distinct values only.
    """
    pairs = (
        df.filter(F.col(f"`{column}`").isNotNull() & F.col(f"`{value}`").isNotNull())
        .filter(trimmed(F.col(f"`{column}`").cast("string")) != ignore)
        .select(F.col(f"`{column}`"), F.col(f"`{value}`").alias("__value"))
        .distinct()
    )
    grouped = pairs.groupBy(F.col(f"`{column}`")).agg(
        F.count(F.lit(1)).alias("value_count"), F.array_sort(F.collect_list("__value")).alias("values")
    )
    return grouped.filter("value_count > 1")


def blank_values(
    df: DataFrame,
    column: str,
    item: str,
    permitted: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows with a blank `column` whose item is not permitted to have one.

    With a permitted list a row without item is left out (whether it is permitted is unknown); without one
    (None or no rows) it is reported.
    """
    blank = df.filter(is_blank(F.col(f"`{column}`")))
    if permitted is None:
        return blank
    listed = permitted.select(F.col(f"`{item}`").alias("__item")).dropna().distinct()
    any_listed = listed.agg((F.count(F.lit(1)) > 0).alias("any_listed")).scalar()
    remaining = skewed_join(
        blank, listed, [item], "left_anti", right_keys=["__item"], right_unique=True, rows_per_slice=rows_per_slice
    )
    return remaining.filter(F.col(f"`{item}`").isNotNull() | ~any_listed)


def permitted_blanks(df: DataFrame, column: str, item: str, permitted: DataFrame) -> DataFrame:
    """Rows with a blank `column` that the permitted list allows."""
    listed = permitted.select(F.col(f"`{item}`").alias("__item"))
    return skewed_join(df.filter(is_blank(F.col(f"`{column}`"))), listed, [item], "left_semi", right_keys=["__item"])


def consistent_value(
    df: DataFrame,
    item: str,
    vendor: str,
    account: str,
    value: str,
    sequence: str,
    prefix_length: int = 2,
) -> DataFrame:
    """Item, vendor and account prefix with more than one `value`: the count, the values and the sequences."""
    complete = df
    for column in (item, vendor, value, account, sequence):
        complete = complete.filter(F.col(f"`{column}`").isNotNull())
    combinations = (
        complete.filter(trimmed(F.col(f"`{value}`").cast("string")) != "")
        .select(
            F.col(f"`{item}`"),
            F.col(f"`{vendor}`"),
            F.substring(F.col(f"`{account}`").cast("string"), 1, prefix_length).alias("account_prefix"),
            F.col(f"`{value}`").alias("__value"),
            F.col(f"`{sequence}`").alias("__sequence"),
        )
        .distinct()
    )
    grouped = combinations.groupBy(F.col(f"`{item}`"), F.col(f"`{vendor}`"), "account_prefix").agg(
        F.array_sort(F.collect_set("__value")).alias("values"),
        F.array_sort(F.collect_set("__sequence")).alias("sequences"),
    )
    return grouped.withColumn("value_count", F.size("values")).filter("value_count > 1")


def joined_text(array: str) -> Column:
    """Array as 'a, b, c'."""
    return F.array_join(F.transform(F.col(array), lambda v: v.cast("string")), ", ")


def run_checks(
    df: DataFrame,
    contract: str,
    vendor: str,
    catalogue: str,
    item: str,
    account: str,
    sequence: str,
    permitted: DataFrame | None = None,
    ignore_contract: str = "N/A",
    prefix_length: int = 2,
) -> DataFrame:
    """All issues in one table: `check`, `subject`, `details`. A check whose columns are absent is left out."""
    spark = df.sparkSession
    have = set(df.columns)
    issues = []
    if {contract, vendor} <= have:
        issues.append(
            one_to_one(df, contract, vendor, ignore_contract).select(
                F.lit("one_to_one").alias("check"),
                F.col(f"`{contract}`").cast("string").alias("subject"),
                joined_text("values").alias("details"),
            )
        )
    if {catalogue, item} <= have:
        issues.append(
            blank_values(df, catalogue, item, permitted).select(
                F.lit("blank_value").alias("check"),
                F.col(f"`{item}`").cast("string").alias("subject"),
                F.lit("").alias("details"),
            )
        )
    if {item, vendor, catalogue, account, sequence} <= have:
        issues.append(
            consistent_value(df, item, vendor, account, catalogue, sequence, prefix_length).select(
                F.lit("consistent_value").alias("check"),
                F.concat_ws("|", F.col(f"`{item}`"), F.col(f"`{vendor}`"), "account_prefix").alias("subject"),
                F.concat(joined_text("values"), F.lit(" / "), joined_text("sequences")).alias("details"),
            )
        )
    result = spark.createDataFrame([], "`check` string, subject string, details string")
    for part in issues:
        result = result.unionByName(part)
    return result


def check_counts(issues: DataFrame) -> DataFrame:
    """Number of issues per check, also for checks without any, and `has_issues` over all."""
    counts = issues.agg(
        *[
            F.count_if(F.col("check") == name).alias(name)
            for name in ("one_to_one", "blank_value", "consistent_value")
        ]
    )
    return counts.withColumn("has_issues", F.col("one_to_one") + F.col("blank_value") + F.col("consistent_value") > 0)


def check_facts(
    df: DataFrame,
    contract: str,
    vendor: str,
    catalogue: str,
    item: str,
    account: str,
    sequence: str,
    ignore_contract: str = "N/A",
    prefix_length: int = 2,
    weight: int = 1,
) -> DataFrame:
    """What the three checks have to know about the rows, counted: (check, part1, part2, part3, value, detail, rows).

    One scan and one aggregation serve all checks: a row becomes at most three facts, copies are combined before the
    shuffle, and a subject with very many values is many rows, never one cell. Facts add up: those of a changed table are
    those of the old one plus those of the rows that came, minus (`weight=-1`) those of the rows that went. A check whose
    columns are absent has no facts.
    """
    have = set(df.columns)
    text = lambda c: F.col(f"`{c}`").cast("string")
    filled = lambda *columns: F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))

    def fact(condition: Column, name: str, *values: Column) -> Column:
        return F.when(condition, F.struct(*[v.alias(n) for v, n in zip([F.lit(name), *values], FACT, strict=True)]))

    nothing, none = F.lit(""), F.lit(None).cast("string")
    entries = []
    if {contract, vendor} <= have:
        real = filled(contract, vendor) & (trimmed(text(contract)) != ignore_contract)
        entries.append(fact(real, ONE_TO_ONE, text(contract), nothing, nothing, text(vendor), none))
    if {catalogue, item} <= have:
        entries.append(fact(is_blank(F.col(f"`{catalogue}`")), BLANK_VALUE, text(item), nothing, nothing, none, none))
    if {item, vendor, catalogue, account, sequence} <= have:
        real = filled(item, vendor, catalogue, account, sequence) & (trimmed(text(catalogue)) != "")
        prefix = F.substring(text(account), 1, prefix_length)
        entries.append(fact(real, CONSISTENT_VALUE, text(item), text(vendor), prefix, text(catalogue), text(sequence)))
    if not entries:
        return df.sparkSession.createDataFrame([], ", ".join(f"`{c}` string" for c in FACT) + ", rows bigint")
    facts = df.select(F.inline(F.array(*entries))).filter(F.col("check").isNotNull())
    return facts.groupBy(*FACT).agg((F.count(F.lit(1)) * weight).alias("rows"))


def add_facts(facts: DataFrame, *changes: DataFrame) -> DataFrame:
    """Facts after changes. A fact that was taken away more often than it was there is an error."""
    total = facts
    for change in changes:
        total = total.unionByName(change)
    summed = total.groupBy(*FACT).agg(F.sum("rows").alias("rows")).filter("rows <> 0")
    wrong = F.raise_error(F.concat(F.lit("facts do not fit the table: "), F.to_json(F.struct(*FACT, "rows"))))
    return summed.filter(F.when(F.col("rows") < 0, wrong.cast("boolean")).otherwise(F.lit(True)))


def _several(facts: DataFrame) -> DataFrame:
    """Subjects with more than one value: the least and the largest of two 64-bit hashes of the values tell that in one
    aggregation. Nothing is collected per subject, and no text is a running value, for which Spark would sort."""
    values = facts.filter((F.col("check") != BLANK_VALUE) & F.col("value").isNotNull())
    ends = []
    for i in range(2):
        place = F.xxhash64(F.lit(i), "value")
        ends += [F.min(place).alias(f"__low{i}"), F.max(place).alias(f"__high{i}")]
    return values.groupBy(*SUBJECT).agg(*ends).filter("__low0 <> __high0 OR __low1 <> __high1").select(*SUBJECT)


def marked_facts(facts: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Facts with `issue`: blank values, and all values of subjects that have several. The facts are staged: read by each step,
    they would be counted anew from the table."""
    facts = stage(facts, "facts")
    valued, blank = facts.filter(F.col("check") != BLANK_VALUE), facts.filter(F.col("check") == BLANK_VALUE)
    several = _several(facts).withColumn("issue", F.lit(True))
    marked = skewed_join(valued, several, SUBJECT, "left", right_unique=True, rows_per_slice=rows_per_slice)
    return marked.withColumn("issue", F.coalesce("issue", F.lit(False))).unionByName(blank.withColumn("issue", F.lit(True)))


def issue_rows(facts: DataFrame, permitted: DataFrame | None = None, item: str = "item", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The facts that are issues, one row per value: of subjects with more than one value, and blank values of items that
    are not permitted to have one (as in `blank_values`). The facts are staged, as in `marked_facts`.
    """
    facts = stage(facts, "facts")
    valued = facts.filter(F.col("check") != BLANK_VALUE)
    found = skewed_join(valued, _several(facts), SUBJECT, "left_semi", right_unique=True, rows_per_slice=rows_per_slice)
    blank = facts.filter(F.col("check") == BLANK_VALUE)
    blank = blank_values(blank.withColumnRenamed("part1", item), "value", item, permitted).withColumnRenamed(item, "part1")
    return found.unionByName(blank)


def issue_counts(issues: DataFrame) -> DataFrame:
    """Like `check_counts`, from `issue_rows`: subjects with several values, and rows with a blank one."""
    subjects = issues.groupBy(*SUBJECT).agg(F.sum("rows").alias("rows"))
    count = lambda name: F.count_if(F.col("check") == name).alias(name)
    blanks = F.coalesce(F.sum(F.when(F.col("check") == BLANK_VALUE, F.col("rows"))), F.lit(0)).alias(BLANK_VALUE)
    counts = subjects.agg(count(ONE_TO_ONE), blanks, count(CONSISTENT_VALUE))
    return counts.withColumn("has_issues", F.col(ONE_TO_ONE) + F.col(BLANK_VALUE) + F.col(CONSISTENT_VALUE) > 0)
