"""Match the daily feed against the reference table and enrich it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.text import parse_number
from refsync.operators.skew import ROWS_PER_SLICE, HotKeys, KeySummary, hot_keys, skewed_join
from refsync.operators.sync import with_key_count

# Names of the two match routes.
ROUTES = ("DPN", "MPN")

# Results of the contract date check.
DATES_MATCH = "Date Matched"
NEW_CONTRACT = "New Contract"
BOTH_DIFFER = "Start & End Date not Match"
START_DIFFERS = "Start Date not Match"
END_DIFFERS = "End Date not Match"
EXCEPTION = "Exception"


def mirror_of(account: Column, pairs: Mapping[str, str]) -> Column:
    """Twin of an account, null when it has none."""
    entries = [F.lit(v) for pair in sorted(pairs.items()) for v in pair]
    return F.try_element_at(F.create_map(*entries), account)


def suppress_mirrors(
    df: DataFrame,
    match: Sequence[str],
    account: str,
    pairs: Mapping[str, str],
    secondary: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Drop rows of a secondary account whose twin account holds the same `match` values.

    Null match values never pair up. Only rows of secondary accounts take part in the join; the others pass.
    """
    account_text = F.col(f"`{account}`").cast("string")
    is_secondary = F.coalesce(account_text.isin(*secondary), F.lit(False))
    primaries = (
        df.select(*[F.col(f"`{c}`") for c in match], account_text.alias("__twin"))
        .filter(F.col("__twin").isin(*[pairs[s] for s in secondary]))
        .distinct()
    )
    candidates = df.filter(is_secondary).withColumn("__twin", mirror_of(account_text, pairs))
    alone = skewed_join(
        candidates,
        primaries,
        [*match, "__twin"],
        "left_anti",
        right_unique=True,
        rows_per_slice=rows_per_slice,
    ).drop("__twin")
    return df.filter(~is_secondary).unionByName(alone)


def account_prefix(account: str, length: int = 2) -> Column:
    return F.substring(F.col(f"`{account}`").cast("string"), 1, length)


def vendor_pairs(df: DataFrame, item: str, prefix: str, sequence: str, vendor: str) -> DataFrame:
    """Distinct sequence-vendor pairs per item and account prefix, with the number of rows behind each."""
    return df.groupBy(
        F.col(f"`{item}`"), F.col(f"`{prefix}`"), F.col(f"`{sequence}`").alias("sequence"), F.col(f"`{vendor}`").alias("vendor")
    ).agg(F.count(F.lit(1)).alias("rows"))


def vendor_list(
    df: DataFrame, item: str, prefix: str, sequence: str, vendor: str, name: str, repeats: bool = True
) -> DataFrame:
    """`seq-vendor` pairs per item and prefix as one text, sorted by sequence (as text), then vendor.

    Pairs are counted first, so copies collapse before the shuffle and the array holds distinct pairs only; a
    pair that stands in several rows is repeated while the text is written. `repeats=False` writes it once.
    """
    pairs = vendor_pairs(df, item, prefix, sequence, vendor)
    seq, code = F.col("sequence").cast("string"), F.col("vendor").cast("string")
    sorted_pairs = F.array_sort(
        F.collect_list(
            F.when(
                seq.isNotNull() & code.isNotNull(),
                F.struct(seq.alias("sequence"), code.alias("vendor"), F.col("rows").cast("int").alias("rows")),
            )
        )
    )

    def write(pair: Column) -> Column:
        text = F.concat(pair["sequence"], F.lit("-"), pair["vendor"])
        if not repeats:
            return text
        # 'a-b, a-b, a-b' for a pair with three rows
        return F.concat(F.repeat(F.concat(text, F.lit(", ")), pair["rows"] - 1), text)

    return (
        pairs.groupBy(F.col(f"`{item}`"), F.col(f"`{prefix}`"))
        .agg(sorted_pairs.alias("__pairs"))
        .select(F.col(f"`{item}`"), F.col(f"`{prefix}`"), F.array_join(F.transform("__pairs", write), ", ").alias(name))
    )


@dataclass(frozen=True)
class Lookups:
    """Tables derived from the prepared baseline, and the names of the columns they are joined on."""

    item: str
    prefix: str
    vendor: str
    by_distributor_part: DataFrame
    by_manufacturer_part: DataFrame
    descriptions: DataFrame
    contracts: DataFrame
    vendor_lists: DataFrame
    vendor_details: DataFrame


def build_lookups(
    base: DataFrame,
    item: str,
    catalogue: str,
    manufacturer_catalogue: str,
    description: str,
    prefix: str,
    sequence: str,
    vendor: str,
    contract_columns: Sequence[str],
    contract_flag: str,
    list_name: str,
) -> Lookups:
    """Six lookup tables over one input; Spark reads from it only the columns each of them needs."""

    def distinct(*columns: str) -> DataFrame:
        return base.select(*[F.col(f"`{c}`") for c in columns]).distinct()

    return Lookups(
        item=item,
        prefix=prefix,
        vendor=vendor,
        by_distributor_part=distinct(catalogue, item),
        by_manufacturer_part=distinct(manufacturer_catalogue, item),
        descriptions=distinct(item, description),
        contracts=base.filter(F.col(f"`{contract_flag}`") == "Y")
        .select(*[F.col(f"`{c}`") for c in contract_columns])
        .distinct(),
        vendor_lists=vendor_list(base, item, prefix, sequence, vendor, list_name),
        vendor_details=base.drop(description).distinct(),
    )


def match_candidates(
    feed: DataFrame,
    routes: Mapping[str, tuple[str, DataFrame]],
    row_keys: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    summary: KeySummary | None = None,
    part_rows: int | None = None,
) -> DataFrame:
    """Candidates per feed row and route: `row_keys`, `route`, `candidate`.

    `routes` maps a route name to the feed column and its (part number, item) map. The routes are kept in long
    form: the matches of the two routes of one feed row are never multiplied with each other. Only the row keys
    and the part numbers travel. `summary` knows the feed's frequent part numbers, `part_rows` bounds the rows of a part
    map; without them the heavy part numbers are counted.
    """
    found = None
    for route, (part, part_map) in routes.items():
        part_column, item_column = part_map.columns
        narrow = feed.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*row_keys, part])])
        pairs = part_map.select(F.col(f"`{part_column}`").alias("__part"), F.col(f"`{item_column}`").cast("string").alias("candidate"))
        joined = skewed_join(
            narrow,
            pairs,
            [part],
            "inner",
            right_keys=["__part"],
            hot_left=summary and summary.hot(feed, [part], rows_per_slice),
            rows_per_slice=rows_per_slice,
            right_rows=part_rows,
        ).select(*[F.col(f"`{c}`") for c in row_keys], F.lit(route).alias("route"), "candidate")
        found = joined if found is None else found.unionByName(joined)
    return found.filter(F.coalesce("candidate", F.lit("")) != "")


def collapse_candidates(
    feed: DataFrame,
    candidates: DataFrame,
    row_keys: Sequence[str],
    name: str,
    source_name: str,
    legacy_null_join: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    candidate_rows: int | None = None,
) -> DataFrame:
    """Feed rows with one row per distinct candidate and the routes that found it (`DPN`, `MPN` or `DPN,MPN`).

    A feed row without candidate stays once with blank candidate and source. `legacy_null_join=True` also keeps
    the blank row next to real candidates when one route found nothing and another feed column is null.
    """
    per_candidate = candidates.groupBy(*row_keys, "candidate").agg(
        *[F.max(F.col("route") == r).alias(f"__{r}") for r in ROUTES]
    )
    sources = F.concat_ws(",", *[F.when(F.col(f"__{r}"), F.lit(r)) for r in ROUTES])
    named = per_candidate.select(*[F.col(f"`{c}`") for c in row_keys], F.col("candidate").alias(name), sources.alias(source_name))
    blank = {name: F.coalesce(F.col(f"`{name}`"), F.lit("")), source_name: F.coalesce(F.col(f"`{source_name}`"), F.lit(""))}
    # A feed row is one row per key; the candidates of one feed row may be many.
    result = skewed_join(
        feed, named, row_keys, "left", left_unique=True, rows_per_slice=rows_per_slice, right_rows=candidate_rows
    ).withColumns(blank)
    if not legacy_null_join:
        return result
    has_null = F.lit(False)
    for column in feed.columns:
        has_null = has_null | F.col(f"`{column}`").isNull()
    per_row = per_candidate.groupBy(*row_keys).agg(*[F.max(f"__{r}").alias(f"__{r}") for r in ROUTES])
    both = F.lit(True)
    for route in ROUTES:
        both = both & F.col(f"__{route}")
    extra = skewed_join(feed.filter(has_null), per_row, row_keys, "inner", left_unique=True, right_unique=True)
    extra = extra.filter(~both).select(
        *[F.col(f"`{c}`") for c in feed.columns], F.lit("").alias(name), F.lit("").alias(source_name)
    )
    return result.unionByName(extra)


def enrich(
    rows: DataFrame,
    lookups: Lookups,
    candidate: str,
    plant: str,
    distributor: str,
    prefix_length: int = 2,
    rows_per_slice: int = ROWS_PER_SLICE,
    heavy: HotKeys | None = None,
    lookup_rows: int | None = None,
) -> DataFrame:
    """Add description, vendor list and vendor details of the matched item.

    Descriptions and details fan out when the item has several. The heavy items are found once and used for all
    three joins, which all start with the item. The details keep their vendor code column. `heavy` are the heavy candidates
    and `lookup_rows` bounds the rows of a lookup, if the caller knows them.
    """
    heavy = heavy or hot_keys(rows.select(F.col(f"`{candidate}`")), [candidate], rows_per_slice)
    spread = {"hot_left": heavy, "rows_per_slice": rows_per_slice, "right_rows": lookup_rows}

    described = skewed_join(
        rows, lookups.descriptions, [candidate], "left", right_keys=[lookups.item], **spread
    ).withColumn("__plant_prefix", account_prefix(plant, prefix_length))
    detailed = skewed_join(
        described,
        lookups.vendor_details.withColumn("__vendor", F.col(f"`{lookups.vendor}`")),
        [candidate, "__plant_prefix", distributor],
        "left",
        right_keys=[lookups.item, lookups.prefix, "__vendor"],
        **spread,
    )
    # the lists are long texts that many rows share: they come last, so no task deals or sorts their copies
    listed = skewed_join(
        detailed,
        lookups.vendor_lists,
        [candidate, "__plant_prefix"],
        "left",
        right_keys=[lookups.item, lookups.prefix],
        right_unique=True,
        **spread,
    )
    lists = [c for c in listed.columns if c not in detailed.columns]
    details = [c for c in detailed.columns if c not in described.columns]
    kept = [c for c in described.columns if c != "__plant_prefix"]
    return listed.select(*[F.col(f"`{c}`") for c in [*kept, *lists, *details]])


def date_match_status(start: Column, end: Column, table_start: Column, table_end: Column) -> Column:
    """Compare the feed's contract dates with the table's; the first rule that holds decides."""
    start_differs, end_differs = start != table_start, end != table_end
    return (
        F.when((start == table_start) & (end == table_end), DATES_MATCH)
        .when(table_start.isNull(), NEW_CONTRACT)
        .when(start_differs & end_differs, BOTH_DIFFER)
        .when(start_differs, START_DIFFERS)
        .when(end_differs, END_DIFFERS)
        .otherwise(EXCEPTION)
    )


def map_codes(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    map_key: str,
    map_value: str,
    name: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    heavy: HotKeys | None = None,
) -> DataFrame:
    """Left lookup of `column` in a mapping table; several entries for one code give several rows. `heavy` are the heavy
    codes, if the caller knows them.

    No broadcast hint: Spark broadcasts the mapping by itself when its size is below the session's threshold.
    """
    pairs = mapping.select(F.col(f"`{map_key}`").alias("__code"), F.col(f"`{map_value}`").alias(name))
    return skewed_join(df, pairs, [column], "left", right_keys=["__code"], hot_left=heavy, rows_per_slice=rows_per_slice)


def highest_unit_price(
    price: Column,
    priced_unit: Column,
    base_unit: Column,
    units: Sequence[tuple[Column, Column]],
    data_type: str = "float",
) -> Column:
    """Highest price over the units of measure.

    price / quantity of the priced unit gives the base price; each unit's price is base price x its quantity
    (null counts as 0). Commas in the text numbers are removed. An unknown unit or a missing quantity divides by
    one; a zero quantity gives null.
    """
    amount = parse_number(price.cast("string"), data_type, strip_commas=True)
    quantities = [(unit, parse_number(quantity.cast("string"), data_type, strip_commas=True)) for unit, quantity in units]
    one = F.lit(1.0).cast(data_type)
    divisor = F.when(priced_unit == base_unit, one)
    for unit, quantity in quantities:
        divisor = divisor.when(priced_unit == unit, quantity)
    per_base = F.try_divide(amount, F.coalesce(divisor.otherwise(one), one)).cast(data_type)
    zero = F.lit(0.0).cast(data_type)
    return F.greatest(per_base, *[(per_base * F.coalesce(quantity, zero)).cast(data_type) for _, quantity in quantities])


def flag_duplicates(
    df: DataFrame, row_keys: Sequence[str], name: str = "Duplicates", rows_per_slice: int = ROWS_PER_SLICE, rows: int | None = None
) -> DataFrame:
    """'Y' on every row whose (file, index) occurs more than once, else ''."""
    counted = with_key_count(df, row_keys, "__count", rows_per_slice, rows)
    return counted.withColumn(name, F.when(F.col("__count") > 1, "Y").otherwise("")).drop("__count")
