"""One query per operator over whole test tables, each with the same result as SQL.

A query is `f(spark, sf_dir) -> DataFrame`; SQL is absent where it cannot say the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.config import SyncSettings, TableSpec
from refsync.functions import keys as key_functions
from refsync.functions import text
from refsync.operators import audit, checks, classify, clean, feed, sync, tagging
from refsync.plans import jobs
from refsync.plans import sample_tables as t
from refsync.sources import audit_store, check_store, files, outputs, snapshots, storage
from refsync.streaming import sync_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            SQL[name] = sql.strip()
        return function

    return register


# --- cleaning -------------------------------------------------------------------------------------------------


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(
            """CASE WHEN o_orderstatus = 'F' THEN concat('  ', o_orderpriority, chr(9))
                    WHEN o_orderstatus = 'O' THEN concat(chr(10), '   ') ELSE o_orderpriority END"""
        ).alias("priority"),
        F.expr(
            """CASE WHEN o_orderpriority = '5-LOW' THEN 'soon'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'yyyy-MM-dd')
                    WHEN o_orderstatus = 'O' THEN date_format(o_orderdate, 'M/d/yyyy')
                    ELSE date_format(o_orderdate, 'yyyy-MMM-dd') END"""
        ).alias("day"),
        F.expr(
            """CASE WHEN o_orderstatus = 'F' THEN format_number(CAST(o_totalprice AS BIGINT), 0)
                    WHEN o_orderstatus = 'O' THEN CAST(CAST(o_totalprice AS BIGINT) AS STRING) ELSE 'n/a' END"""
        ).alias("amount"),
    )


@query(
    "clean_strings",
    r"""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS priority
FROM orders""",
)
def clean_strings(spark, sf_dir):
    return clean.clean_strings(_raw_orders(spark, sf_dir).select("o_orderkey", "priority"))


@query(
    "parse_dates",
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN CAST(o_orderdate AS DATE) END AS day
FROM orders""",
)
def parse_dates(spark, sf_dir):
    return clean.parse_dates(_raw_orders(spark, sf_dir).select("o_orderkey", "day"), ["day"])


@query(
    "enforce_schema",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN CAST(o_orderdate AS DATE) END AS day,
       CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_totalprice < 1000)
            THEN CAST(trunc(o_totalprice) AS DOUBLE) END AS amount
FROM orders""",
)
def enforce_schema(spark, sf_dir):
    raw = _raw_orders(spark, sf_dir).select("o_orderkey", "day", "amount")
    return clean.enforce_schema(raw, {"o_orderkey": "string", "day": "date", "amount": "double", "absent": "float"})


@query(
    "exclude_values",
    """
SELECT * FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_brand END AS p_brand FROM part)
WHERE p_brand NOT IN ('Brand#2', 'Brand#4', 'Brand#17')""",
)
def exclude_values(spark, sf_dir):
    part = t.load(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") != 1, F.col("p_brand")).alias("p_brand")
    )
    return clean.exclude_values(part, "p_brand", ["Brand#2", "Brand#4", "Brand#17"])


@query(
    "exclude_prefix",
    """
SELECT * FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_name END AS p_name FROM part)
WHERE NOT starts_with(p_name, 'red') AND NOT starts_with(p_name, 'small')""",
)
def exclude_prefix(spark, sf_dir):
    part = t.load(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") != 1, F.col("p_name")).alias("p_name")
    )
    return clean.exclude_prefix(part, "p_name", ["red", "small"])


@query(
    "prefix_columns",
    "SELECT s_suppkey AS base_s_suppkey, s_name AS base_s_name, s_acctbal AS base_s_acctbal FROM supplier",
)
def prefix_columns(spark, sf_dir):
    supplier = clean.drop_columns(t.load(spark, sf_dir, "supplier"), ["s_nationkey"])
    return clean.prefix_columns(clean.reorder(supplier, ["s_name"]), "base_")


@query(
    "key_text",
    """
SELECT event_id, CAST(user_id AS VARCHAR) || '|' || coalesce(trim(nullif(event_type, 'error')), '') AS key_text,
       coalesce(trim(nullif(event_type, 'error')), '') AS type_part
FROM events""",
)
def key_text(spark, sf_dir):
    events = t.load(spark, sf_dir, "events").select(
        "event_id", "user_id", F.concat(F.lit(" "), F.expr("nullif(event_type, 'error')"), F.lit("\t")).alias("event_type")
    )
    joined = events.select("event_id", key_functions.key_text(["user_id", "event_type"]).alias("key_text"))
    return joined.select("*", key_functions.split_key(F.col("key_text"), ["user_part", "type_part"])[1])


# --- sync -----------------------------------------------------------------------------------------------------


@query(
    "latest_wins",
    """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_wins(spark, sf_dir):
    return sync.latest_wins(t.load(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "gate_stale",
    f"WITH {t.INCREMENT_SQL} SELECT * EXCLUDE (held, h_order, h_line, matched, newer) FROM "
    "(SELECT *, NULL AS h_order, NULL AS h_line FROM gated) WHERE newer",
)
def gate_stale(spark, sf_dir):
    return sync.gate_stale(t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir), t.KEYS, t.VERSION)


@query(
    "stale_rows",
    f"WITH {t.INCREMENT_SQL} SELECT * EXCLUDE (held, matched, newer), held AS current_version FROM gated WHERE NOT newer",
)
def stale_rows(spark, sf_dir):
    return sync.stale_rows(t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir), t.KEYS, t.VERSION)


@query(
    "split_new_updated",
    f"""WITH {t.INCREMENT_SQL}
SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN matched THEN 'updated' ELSE 'new' END AS status FROM gated""",
)
def split_new_updated(spark, sf_dir):
    return sync.split_new_updated(t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir), t.KEYS)


@query(
    "new_rows", f"WITH {t.INCREMENT_SQL} SELECT * EXCLUDE (held, matched, newer) FROM gated WHERE NOT matched"
)
def new_rows(spark, sf_dir):
    return sync.new_rows(t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir), t.KEYS)


@query("matched_rows", f"WITH {t.INCREMENT_SQL} SELECT * EXCLUDE (held, matched, newer) FROM gated WHERE matched")
def matched_rows(spark, sf_dir):
    return sync.matched_rows(t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir), t.KEYS)


UPSERT_SQL = (
    t.INCREMENT_SQL
    + f""",
winners AS (
  SELECT * EXCLUDE (held, matched, newer, source_file) FROM gated WHERE newer
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {t.ORDER_SQL}) = 1
)"""
)


@query(
    "upsert",
    f"""WITH {UPSERT_SQL}
SELECT r.* FROM table_rows r
WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.l_orderkey = r.l_orderkey AND w.l_linenumber = r.l_linenumber)
UNION ALL BY NAME SELECT * FROM winners""",
)
def upsert(spark, sf_dir):
    current, increments = t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir)
    newer = sync.gate_stale(current, increments, t.KEYS, t.VERSION)
    winners = sync.latest_wins(newer, t.KEYS, t.VERSION, t.TIES).drop("source_file")
    return sync.upsert(current, winners, t.KEYS)


_TEXT_COLUMNS = {
    "l_partkey": "CAST({c} AS VARCHAR)",
    "l_suppkey": "CAST({c} AS VARCHAR)",
    "l_quantity": "CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)",
    "l_extendedprice": "CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)",
    "l_discount": "CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)",
    "l_tax": "CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)",
    "l_returnflag": "{c}",
    "l_linestatus": "{c}",
}


def _changes_sql() -> str:
    pairs = ", ".join(
        f"{{'Column': '{c}', 'cur': {e.format(c='i.' + c)}, 'prev': {e.format(c='b.' + c)}}}"
        for c, e in _TEXT_COLUMNS.items()
    )
    return f"""{t.INCREMENT_SQL},
base AS (
  SELECT * FROM table_rows
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {t.ORDER_SQL}) = 1
),
long AS (
  SELECT i.l_orderkey, i.l_linenumber, i.l_shipdate, i.source_file, unnest([{pairs}]) AS entry
  FROM increment_rows i JOIN base b ON i.l_orderkey = b.l_orderkey AND i.l_linenumber = b.l_linenumber
),
changes AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, source_file, entry['Column'] AS "Column",
         entry['cur'] AS "Current Value", entry['prev'] AS "Previous Value", 'Updated' AS "Change Type"
  FROM long WHERE coalesce(entry['cur'], '') <> coalesce(entry['prev'], '')
)"""


def _in_cents(df: DataFrame) -> DataFrame:
    """Amounts as whole cents, so that their text form does not depend on how an engine prints doubles."""
    amounts = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return df.withColumns({c: F.round(F.col(c) * 100).cast("bigint") for c in amounts})


def _field_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.field_changes(
        _in_cents(t.table_rows(spark, sf_dir)),
        _in_cents(t.increment_rows(spark, sf_dir)),
        t.KEYS,
        t.VERSION,
        tie_breakers=t.TIES,
    )


@query("field_changes", f"WITH {_changes_sql()} SELECT * FROM changes")
def field_changes(spark, sf_dir):
    return _field_changes(spark, sf_dir)


@query("changes_by_column", f'WITH {_changes_sql()} SELECT "Column", count(*) AS count FROM changes GROUP BY 1')
def changes_by_column(spark, sf_dir):
    return sync.changes_by_column(_field_changes(spark, sf_dir))


@query(
    "duplicate_keys",
    f"""WITH {t.INCREMENT_SQL},
versions AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, count(*) AS n FROM increment_rows GROUP BY ALL
)
SELECT l_orderkey, l_linenumber, CAST(sum(n) AS BIGINT) AS occurrence_count, min(l_shipdate) AS first_version,
       max(l_shipdate) AS last_version,
       string_agg(coalesce(CAST(l_shipdate AS VARCHAR), '') || ' x' || n, ', '
                  ORDER BY l_shipdate NULLS FIRST, l_extendedprice) AS dates,
       any_value(file_count) AS file_count
FROM versions JOIN (SELECT l_orderkey, l_linenumber, count(DISTINCT source_file) AS file_count
                    FROM increment_rows GROUP BY ALL) USING (l_orderkey, l_linenumber)
GROUP BY 1, 2 HAVING sum(n) > 1""",
)
def duplicate_keys(spark, sf_dir):
    found = sync.duplicate_keys(
        t.increment_rows(spark, sf_dir), t.KEYS, t.VERSION, "l_extendedprice", "source_file", lists=True
    )
    entry = F.transform(
        "versions",
        lambda v: F.concat(F.coalesce(v["version"].cast("string"), F.lit("")), F.lit(" x"), v["rows"].cast("string")),
    )
    return found.withColumn("dates", F.array_join(entry, ", ")).drop("versions")


@query(
    "duplicate_history",
    f"""WITH {t.INCREMENT_SQL}
SELECT l_orderkey, l_linenumber, l_shipdate AS version, l_extendedprice AS price, count(*) AS rows
FROM increment_rows
WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM increment_rows
                                     GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
GROUP BY ALL""",
)
def duplicate_history(spark, sf_dir):
    return sync.duplicate_history(t.increment_rows(spark, sf_dir), t.KEYS, t.VERSION, "l_extendedprice")


@query(
    "duplicate_versions",
    f"""WITH {t.INCREMENT_SQL}
SELECT * FROM increment_rows QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
)
def duplicate_versions(spark, sf_dir):
    return sync.duplicate_versions(t.increment_rows(spark, sf_dir), t.KEYS)


# --- checks ---------------------------------------------------------------------------------------------------

_TABLE_DUPLICATES_SQL = f"""{t.INCREMENT_SQL},
duplicates AS (
  SELECT l_orderkey, l_linenumber, count(*) AS rows, count(*) - 1 AS surplus,
         (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM increment_rows) AS being_updated
  FROM table_rows GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
)"""


@query("table_duplicate_keys", f"WITH {_TABLE_DUPLICATES_SQL} SELECT * FROM duplicates")
def table_duplicate_keys(spark, sf_dir):
    return checks.table_duplicate_keys(t.table_rows(spark, sf_dir), t.increment_rows(spark, sf_dir), t.KEYS)


@query(
    "table_duplicate_summary",
    f"""WITH {_TABLE_DUPLICATES_SQL}
SELECT count(*) AS duplicate_keys, count(*) FILTER (being_updated) AS keys_being_updated,
       CAST(coalesce(sum(surplus) FILTER (being_updated), 0) AS BIGINT) AS rows_removed FROM duplicates""",
)
def table_duplicate_summary(spark, sf_dir):
    return checks.table_duplicate_summary(table_duplicate_keys(spark, sf_dir))


@query(
    "one_to_one",
    """
SELECT l_orderkey, count(DISTINCT l_returnflag) AS value_count,
       string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS "values"
FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1""",
)
def one_to_one(spark, sf_dir):
    found = checks.one_to_one(t.table_rows(spark, sf_dir), "l_orderkey", "l_returnflag")
    return found.withColumn("values", checks.joined_text("values"))


_BLANK_PART_SQL = """
blank_part AS (
  SELECT p_partkey, CASE WHEN p_size <= 5 THEN NULL WHEN p_size <= 10 THEN '  ' ELSE p_brand END AS p_brand FROM part
)"""


def _blank_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.when(F.col("p_size") <= 5, F.lit(None)).when(F.col("p_size") <= 10, "  ").otherwise(F.col("p_brand"))
    return t.load(spark, sf_dir, "part").select("p_partkey", brand.alias("p_brand"))


def _permitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey"))


@query(
    "blank_values",
    f"""WITH {_BLANK_PART_SQL}
SELECT * FROM blank_part WHERE trim(coalesce(p_brand, '')) = ''
AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def blank_values(spark, sf_dir):
    return checks.blank_values(_blank_part(spark, sf_dir), "p_brand", "p_partkey", _permitted(spark, sf_dir))


@query(
    "permitted_blanks",
    f"""WITH {_BLANK_PART_SQL}
SELECT * FROM blank_part WHERE trim(coalesce(p_brand, '')) = '' AND p_partkey IN (SELECT s_suppkey FROM supplier)""",
)
def permitted_blanks(spark, sf_dir):
    return checks.permitted_blanks(_blank_part(spark, sf_dir), "p_brand", "p_partkey", _permitted(spark, sf_dir))


@query(
    "consistent_value",
    """
SELECT l_orderkey, l_returnflag, CAST(l_linestatus AS VARCHAR) AS account_prefix,
       count(DISTINCT l_suppkey) AS value_count,
       string_agg(DISTINCT l_suppkey, ', ' ORDER BY l_suppkey) AS "values",
       string_agg(DISTINCT l_linenumber, ', ' ORDER BY l_linenumber) AS sequences
FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1""",
)
def consistent_value(spark, sf_dir):
    found = checks.consistent_value(
        t.table_rows(spark, sf_dir), "l_orderkey", "l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber"
    )
    return found.withColumns(
        {
            "values": checks.joined_text("values"),
            "sequences": checks.joined_text("sequences"),
            "value_count": F.col("value_count").cast("bigint"),
        }
    )


_ISSUES_SQL = f"""{t.CONTRACT_SQL},
issues AS (
  SELECT 'one_to_one' AS "check", contract_no AS subject,
         string_agg(DISTINCT vendor, ', ' ORDER BY vendor) AS details
  FROM contract GROUP BY contract_no HAVING count(DISTINCT vendor) > 1
  UNION ALL
  SELECT 'blank_value', item, '' FROM contract WHERE catalogue IS NULL
  UNION ALL
  SELECT 'consistent_value', item || '|' || vendor || '|' || left(account, 2),
         string_agg(DISTINCT catalogue, ', ' ORDER BY catalogue) || ' / ' || string_agg(DISTINCT seq, ', ' ORDER BY seq)
  FROM contract WHERE catalogue IS NOT NULL GROUP BY item, vendor, left(account, 2)
  HAVING count(DISTINCT catalogue) > 1
)"""


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(
        t.contract_rows(spark, sf_dir),
        "Contract No",
        "Vendor Code",
        "Vendor Catalogue",
        "PMM Item Number",
        "Corp Acct",
        "Vendor Seq",
    )


@query("run_checks", f"WITH {_ISSUES_SQL} SELECT * FROM issues")
def run_checks(spark, sf_dir):
    return _issues(spark, sf_dir)


@query(
    "check_counts",
    f"""WITH {_ISSUES_SQL}
SELECT count(*) FILTER ("check" = 'one_to_one') AS one_to_one, count(*) FILTER ("check" = 'blank_value') AS blank_value,
       count(*) FILTER ("check" = 'consistent_value') AS consistent_value, count(*) > 0 AS has_issues FROM issues""",
)
def check_counts(spark, sf_dir):
    return checks.check_counts(_issues(spark, sf_dir))


# --- audit ----------------------------------------------------------------------------------------------------

# Exclusion rule of these queries: the highest tax rate. The rest of the status follows the sync rules.
_DIFFERS_SQL = " OR ".join(
    f"coalesce(CAST(g.{c} AS VARCHAR), '') <> coalesce(CAST(b.{c} AS VARCHAR), '')"
    for c in (
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    )
)
_TAGGED_SQL = f"""{t.INCREMENT_SQL},
base AS (
  SELECT * FROM table_rows
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {t.ORDER_SQL}) = 1
),
tagged AS (
  SELECT g.* EXCLUDE (held, matched, newer),
         CASE WHEN g.l_tax >= 0.08 THEN 'excluded' WHEN NOT newer THEN 'stale' WHEN NOT matched THEN 'new'
              WHEN {_DIFFERS_SQL} THEN 'updated' ELSE 'unchanged' END AS status
  FROM gated g LEFT JOIN base b ON g.l_orderkey = b.l_orderkey AND g.l_linenumber = b.l_linenumber
)"""


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    increments = t.increment_rows(spark, sf_dir)
    touched = tagging.touched_rows(t.table_rows(spark, sf_dir), increments, t.KEYS)
    return tagging.tag_increments(
        touched, increments, t.KEYS, t.VERSION, F.col("l_tax") >= 0.08, tie_breakers=t.TIES
    )


@query("tag_increments", f"WITH {_TAGGED_SQL} SELECT * FROM tagged")
def tag_increments(spark, sf_dir):
    return _tagged(spark, sf_dir).drop("__previous")


@query(
    "per_file_summary",
    f"""WITH {_TAGGED_SQL}
SELECT source_file, count(*) AS original_rows, count(*) FILTER (status IN ('excluded', 'stale')) AS dropped_total,
       count(*) FILTER (status = 'stale') AS skipped_stale, count(*) FILTER (status = 'new') AS new_rows,
       count(*) FILTER (status IN ('updated', 'unchanged')) AS matched_rows,
       count(*) FILTER (status = 'updated') AS updated_rows, count(*) FILTER (status = 'unchanged') AS unchanged_rows,
       max(l_shipdate) FILTER (status NOT IN ('excluded', 'stale')) AS latest_update_date
FROM tagged GROUP BY source_file""",
)
def per_file_summary(spark, sf_dir):
    return audit.per_file_summary(_tagged(spark, sf_dir), "source_file", t.VERSION)


@query(
    "run_summary",
    f"""WITH {_TAGGED_SQL},
totals AS (
  SELECT count(DISTINCT source_file) AS f, count(*) AS o, count(*) FILTER (status = 'excluded') AS e,
         count(*) FILTER (status = 'stale') AS s, count(*) FILTER (status = 'new') AS n,
         count(*) FILTER (status IN ('updated', 'unchanged')) AS m, count(*) FILTER (status = 'updated') AS u,
         count(*) FILTER (status = 'unchanged') AS same
  FROM tagged
)
SELECT 'Changes' AS "Category", unnest(['Files Processed', 'Original Rows', 'Excluded Rows', 'Skipped Rows (Outdated)',
       'New Rows', 'Matched Rows', 'Updated Rows', 'Unchanged Rows']) AS "Metric",
       unnest([f, o, e, s, n, m, u, same]) AS "Value"
FROM totals""",
)
def run_summary(spark, sf_dir):
    return audit.run_summary(_tagged(spark, sf_dir), "source_file")


@query(
    "rows_by_date",
    f"""WITH {t.INCREMENT_SQL}
SELECT source_file, l_shipdate, count(*) AS row_count FROM increment_rows GROUP BY ALL""",
)
def rows_by_date(spark, sf_dir):
    return audit.rows_by_date(t.increment_rows(spark, sf_dir), t.VERSION, "source_file")


@query(
    "stale_sample",
    f"""WITH {t.INCREMENT_SQL}
SELECT DISTINCT l_orderkey, l_linenumber FROM gated WHERE NOT newer ORDER BY 1, 2 LIMIT 5""",
)
def stale_sample(spark, sf_dir):
    return audit.sample(stale_rows(spark, sf_dir).select(*t.KEYS).distinct(), t.KEYS, 5)


# --- feed -----------------------------------------------------------------------------------------------------

_MIRROR_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem r
WHERE NOT (l_returnflag = 'R' AND EXISTS (
  SELECT 1 FROM lineitem a
  WHERE a.l_returnflag = 'A' AND a.l_partkey = r.l_partkey AND a.l_linenumber = r.l_linenumber))"""


@query("suppress_mirrors", _MIRROR_SQL)
def suppress_mirrors(spark, sf_dir):
    rows = t.table_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return feed.suppress_mirrors(rows, ["l_partkey", "l_linenumber"], "l_returnflag", {"A": "R", "R": "A"}, ["R"])


_CANDIDATE_SQL = """
feed AS (
  SELECT o_orderstatus AS source, o_orderkey AS idx, o_orderpriority AS priority, o_orderkey AS part1,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS part2
  FROM orders
),
candidates AS (
  SELECT DISTINCT source, idx, 'DPN' AS route, CAST(l_suppkey AS VARCHAR) AS candidate
  FROM feed JOIN lineitem ON l_orderkey = part1 WHERE l_linestatus = 'F'
  UNION ALL
  SELECT DISTINCT source, idx, 'MPN', CAST(l_suppkey AS VARCHAR)
  FROM feed JOIN lineitem ON l_orderkey = part2 WHERE l_linestatus = 'O'
),
collapsed AS (
  SELECT feed.*, coalesce(candidate, '') AS item, coalesce(string_agg(route, ',' ORDER BY route), '') AS item_source
  FROM feed LEFT JOIN candidates USING (source, idx) GROUP BY ALL
)"""


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.load(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source"),
        F.col("o_orderkey").alias("idx"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey").alias("part1"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("part2"),
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = t.table_rows(spark, sf_dir).select("l_orderkey", "l_suppkey", "l_linestatus")
    closed = items.filter("l_linestatus = 'F'").select("l_orderkey", "l_suppkey").distinct()
    open_ = items.filter("l_linestatus = 'O'").select("l_orderkey", "l_suppkey").distinct()
    routes = {"DPN": ("part1", closed), "MPN": ("part2", open_)}
    return feed.match_candidates(_feed(spark, sf_dir), routes, ["source", "idx"])


def _collapsed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return feed.collapse_candidates(
        _feed(spark, sf_dir), _candidates(spark, sf_dir), ["source", "idx"], "item", "item_source", **options
    )


@query("match_candidates", f"WITH {_CANDIDATE_SQL} SELECT * FROM candidates")
def match_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query("collapse_candidates", f"WITH {_CANDIDATE_SQL} SELECT * FROM collapsed")
def collapse_candidates(spark, sf_dir):
    return _collapsed(spark, sf_dir)


@query(
    "collapse_candidates_legacy",
    f"""WITH {_CANDIDATE_SQL}
SELECT * FROM collapsed
UNION ALL
SELECT feed.*, '', '' FROM feed
WHERE part2 IS NULL AND (source, idx) IN (SELECT (source, idx) FROM candidates)""",
)
def collapse_candidates_legacy(spark, sf_dir):
    return _collapsed(spark, sf_dir, legacy_null_join=True)


@query(
    "vendor_pairs",
    """
SELECT l_partkey, l_returnflag, l_linenumber AS sequence, l_suppkey AS vendor, count(*) AS rows
FROM lineitem GROUP BY ALL""",
)
def vendor_pairs(spark, sf_dir):
    return feed.vendor_pairs(t.table_rows(spark, sf_dir), "l_partkey", "l_returnflag", "l_linenumber", "l_suppkey")


@query(
    "vendor_list",
    """
SELECT l_partkey, l_returnflag,
       string_agg(l_linenumber || '-' || l_suppkey, ', '
                  ORDER BY CAST(l_linenumber AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS vendors
FROM lineitem GROUP BY ALL""",
)
def vendor_list(spark, sf_dir):
    rows = t.table_rows(spark, sf_dir)
    return feed.vendor_list(rows, "l_partkey", "l_returnflag", "l_linenumber", "l_suppkey", "vendors")


@query(
    "enrich",
    f"""WITH {_CANDIDATE_SQL},
lists AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS item, l_returnflag AS flag,
         string_agg(l_linenumber || '-' || l_linestatus, ', ' ORDER BY CAST(l_linenumber AS VARCHAR), l_linestatus)
           AS vendors
  FROM lineitem GROUP BY ALL
),
details AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS item, l_returnflag AS flag, l_linestatus AS vendor, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY ALL
)
SELECT c.source, c.idx, c.item, c.item_source, s_name AS description, l.vendors, d.vendor,
       CAST(d.last_ship AS DATE) AS last_ship
FROM (SELECT *, CASE WHEN source = 'P' THEN 'A' ELSE 'R' END AS flag FROM collapsed) c
LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = c.item
LEFT JOIN lists l ON l.item = c.item AND l.flag = c.flag
LEFT JOIN details d ON d.item = c.item AND d.flag = c.flag AND d.vendor = c.source""",
)
def enrich(spark, sf_dir):
    rows = t.table_rows(spark, sf_dir).withColumn("item", F.col("l_suppkey").cast("string"))
    details = rows.groupBy("item", "l_returnflag", F.col("l_linestatus").alias("vendor")).agg(
        F.max("l_shipdate").alias("last_ship")
    )
    supplier = t.load(spark, sf_dir, "supplier")
    part_maps = spark.createDataFrame([], "part string, item string")
    lookups = feed.Lookups(
        item="item",
        prefix="l_returnflag",
        vendor="vendor",
        by_distributor_part=part_maps,
        by_manufacturer_part=part_maps,
        descriptions=supplier.select(F.col("s_suppkey").cast("string").alias("item"), F.col("s_name").alias("description")),
        contracts=details,
        vendor_lists=feed.vendor_list(rows, "item", "l_returnflag", "l_linenumber", "l_linestatus", "vendors"),
        vendor_details=details,
    )
    found = _collapsed(spark, sf_dir).withColumn("plant", F.when(F.col("source") == "P", "A").otherwise("R"))
    enriched = feed.enrich(found, lookups, "item", "plant", "source")
    return enriched.drop("priority", "part1", "part2", "plant")


@query(
    "map_codes",
    """
SELECT o_orderkey, o_custkey, c_mktsegment AS segment, n_name AS nation
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def map_codes(spark, sf_dir):
    orders = t.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer, nation = t.load(spark, sf_dir, "customer"), t.load(spark, sf_dir, "nation")
    codes = feed.map_codes(customer, nation, "c_nationkey", "n_nationkey", "n_name", "nation")
    with_segment = feed.map_codes(orders, customer, "o_custkey", "c_custkey", "c_mktsegment", "segment")
    return feed.map_codes(with_segment, codes, "o_custkey", "c_custkey", "nation", "nation")


@query(
    "date_match_status",
    """
WITH dated AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS d_start, CAST(l_shipdate AS DATE) + 365 AS d_end,
         CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber IN (2, 4) THEN CAST(l_shipdate AS DATE) + 7
              ELSE CAST(l_shipdate AS DATE) END AS t_start,
         CASE WHEN l_linenumber IN (2, 5) THEN CAST(l_shipdate AS DATE) WHEN l_linenumber = 6 THEN NULL
              ELSE CAST(l_shipdate AS DATE) + 365 END AS t_end
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN d_start = t_start AND d_end = t_end THEN 'Date Matched'
            WHEN t_start IS NULL THEN 'New Contract'
            WHEN d_start <> t_start AND d_end <> t_end THEN 'Start & End Date not Match'
            WHEN d_start <> t_start THEN 'Start Date not Match'
            WHEN d_end <> t_end THEN 'End Date not Match'
            ELSE 'Exception' END AS status
FROM dated""",
)
def date_match_status(spark, sf_dir):
    line, day = F.col("l_linenumber"), F.col("l_shipdate")
    table_start = F.when(line == 1, F.lit(None)).when(line.isin(2, 4), F.date_add(day, 7)).otherwise(day)
    table_end = F.when(line.isin(2, 5), day).when(line == 6, F.lit(None)).otherwise(F.date_add(day, 365))
    status = feed.date_match_status(day, F.date_add(day, 365), table_start, table_end)
    return t.table_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", status.alias("status"))


@query(
    "highest_unit_price",
    """
WITH raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, trunc(l_extendedprice) AS price,
         CASE WHEN l_returnflag = 'A' THEN 1.0
              WHEN l_returnflag = 'N' THEN CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_quantity END
              WHEN l_linestatus = 'F' THEN 1.0 ELSE 1200.0 END AS divisor,
         CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_quantity END AS q1, 1200.0 AS q2
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN divisor <> 0 THEN round(greatest(price / divisor, price / divisor * q1, price / divisor * q2, 0.0), 4) END
         AS highest_price
FROM raw""",
)
def highest_unit_price(spark, sf_dir):
    price = F.format_number(F.col("l_extendedprice").cast("bigint"), 0)
    unit = (
        F.when(F.col("l_returnflag") == "A", "EA")
        .when(F.col("l_returnflag") == "N", "BX")
        .when(F.col("l_linestatus") == "F", "??")
        .otherwise("CS")
    )
    units = [
        (F.lit("BX"), F.when(F.col("l_linenumber") == 7, "0").otherwise(F.col("l_quantity").cast("int").cast("string"))),
        (F.lit("CS"), F.lit("1,200")),
        (F.lit("PL"), F.lit(None).cast("string")),
    ]
    highest = feed.highest_unit_price(price, unit, F.lit("EA"), units, "double")
    return t.table_rows(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(highest, 4).alias("highest_price")
    )


@query(
    "flag_duplicates",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'Y' ELSE '' END AS "Duplicates"
FROM lineitem""",
)
def flag_duplicates(spark, sf_dir):
    rows = t.table_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return feed.flag_duplicates(rows, t.KEYS)


_LOOKUP_SQL = """
base AS (
  SELECT * EXCLUDE (centre, gl, updated)
  FROM (SELECT DISTINCT * EXCLUDE (centre, gl, updated), 0 AS centre, 0 AS gl, 0 AS updated FROM contract
        WHERE NOT starts_with(item, 'PM') AND NOT starts_with(vendor_name, 'ZZZ'))
),
baseline AS (
  SELECT *, left(account, 2) AS prefix FROM base b
  WHERE NOT (account IN ('0204', '0504') AND EXISTS (
    SELECT 1 FROM base p WHERE p.item = b.item AND p.catalogue = b.catalogue
    AND p.account = CASE b.account WHEN '0204' THEN '0201' ELSE '0501' END))
)"""


@query(
    "prepare_baseline",
    f"""WITH {t.CONTRACT_SQL}, {_LOOKUP_SQL}
SELECT item, account, vendor, vendor_name, seq, contract_no, contract_item, catalogue, manufacturer_catalogue,
       description, eff, exp, CAST(price AS DOUBLE) AS price, prefix FROM baseline""",
)
def prepare_baseline(spark, sf_dir):
    spec = TableSpec()
    base = jobs.prepare_baseline(clean.enforce_schema(t.contract_rows(spark, sf_dir), spec.types), spec)
    names = {
        "PMM Item Number": "item",
        "Corp Acct": "account",
        "Vendor Code": "vendor",
        "Vendor Name": "vendor_name",
        "Vendor Seq": "seq",
        "Contract No": "contract_no",
        "Contract Item": "contract_item",
        "Vendor Catalogue": "catalogue",
        "Manufacturer Catalogue": "manufacturer_catalogue",
        "Item Description": "description",
        "Contract EFF Date": "eff",
        "Contract EXP Date": "exp",
        "Default UOM Price": "price",
        "Corp_Acct_Prefix": "prefix",
    }
    renamed = base.withColumnsRenamed({f"0031_{old}": new for old, new in names.items()})
    return renamed.withColumn("price", F.col("price").cast("double"))


@query(
    "build_lookups",
    f"""WITH {t.CONTRACT_SQL}, {_LOOKUP_SQL}
SELECT 'by_distributor_part' AS lookup, count(*) AS rows FROM (SELECT DISTINCT catalogue, item FROM baseline)
UNION ALL SELECT 'by_manufacturer_part', count(*) FROM (SELECT DISTINCT manufacturer_catalogue, item FROM baseline)
UNION ALL SELECT 'descriptions', count(*) FROM (SELECT DISTINCT item, description FROM baseline)
UNION ALL SELECT 'contracts', count(*) FROM (SELECT DISTINCT contract_no, eff, exp, contract_item, vendor, vendor_name
                                             FROM baseline WHERE contract_item = 'Y')
UNION ALL SELECT 'vendor_lists', count(*) FROM (SELECT DISTINCT item, prefix FROM baseline)
UNION ALL SELECT 'vendor_details', count(*) FROM (SELECT DISTINCT * EXCLUDE (description) FROM baseline)""",
)
def build_lookups(spark, sf_dir):
    spec = TableSpec()
    base = storage.stage(
        jobs.prepare_baseline(clean.enforce_schema(t.contract_rows(spark, sf_dir), spec.types), spec), "baseline"
    )
    lookups = jobs.baseline_lookups(base, spec)
    result = None
    for name in (
        "by_distributor_part",
        "by_manufacturer_part",
        "descriptions",
        "contracts",
        "vendor_lists",
        "vendor_details",
    ):
        counted = getattr(lookups, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("lookup"), "rows")
        result = counted if result is None else result.unionByName(counted)
    return result


# --- classify and export --------------------------------------------------------------------------------------


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _collapsed(spark, sf_dir).select("source", "idx", "item")
    return classify.assign_bucket(found, classify.item_rules(found, "item"))


_BUCKET_SQL = f"""{_CANDIDATE_SQL},
classified AS (
  SELECT source, idx, item, CASE WHEN trim(item) <> '' THEN 'update' ELSE 'create' END AS "Bucket" FROM collapsed
)"""
_BUCKET_COUNT_SQL = f'WITH {_BUCKET_SQL} SELECT "Bucket", count(*) AS rows FROM classified GROUP BY 1'


@query("assign_bucket", f"WITH {_BUCKET_SQL} SELECT * FROM classified")
def assign_bucket(spark, sf_dir):
    return _classified(spark, sf_dir)


@query("bucket_counts", _BUCKET_COUNT_SQL)
def bucket_counts(spark, sf_dir):
    return classify.bucket_counts(_classified(spark, sf_dir))


@query("export_buckets", _BUCKET_COUNT_SQL)
def export_buckets(spark, sf_dir):
    folder = storage.new_path(spark, "exports")
    path = outputs.write_buckets(_classified(spark, sf_dir), folder, "ExportFile")
    return classify.bucket_counts(spark.read.parquet(path))


@query(
    "date_range",
    """
SELECT CASE WHEN min(o_orderdate) IS NULL THEN 'no_data' ELSE strftime(min(o_orderdate), '%Y-%m-%d') || '~' ||
       strftime(max(o_orderdate), '%Y-%m-%d') END AS date_range FROM orders""",
)
def date_range(spark, sf_dir):
    stamps = t.load(spark, sf_dir, "orders").select(
        F.expr(
            """CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'X' THEN 'bad'
                    ELSE date_format(o_orderdate, "yyyy-MMM-dd '03:04:05 PM'") END"""
        ).alias("stamp")
    )
    return outputs.date_range_frame(stamps, "stamp", ["yyyy-MMM-dd hh:mm:ss a"])


ROWS_PER_FILE = 500_000


def _files_of(rows: DataFrame, batches: int) -> int:
    """Number of files to drop rows in: a multiple of the number of batches, and more files, not larger ones, for more rows."""
    return batches * max(1, -(-rows.count() // (batches * ROWS_PER_FILE)))


# --- sources and table life cycle -----------------------------------------------------------------------------


def _drop_orders(spark: SparkSession, sf_dir: str, file_format: str) -> str:
    """`orders` as dropped files with two different headers (one of them lacks a column)."""
    folder = storage.new_path(spark, "drop")
    orders = _raw_orders(spark, sf_dir)
    writer = {"header": "true", "quoteAll": "true"} if file_format == "csv" else {}
    orders.filter("priority IS NOT NULL AND priority LIKE '%-%'").write.options(**writer).format(file_format).save(
        f"{folder}/with_priority"
    )
    orders.filter("priority IS NULL OR priority NOT LIKE '%-%'").select("amount", "o_orderkey", "day").write.options(
        **writer
    ).format(file_format).save(f"{folder}/without_priority")
    return folder


_DROPPED_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderstatus = 'F' THEN regexp_replace(reverse(regexp_replace(reverse(CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR)),
                 '(\\d{3})', '\\1,', 'g')), '^,', '')
            WHEN o_orderstatus = 'O' THEN CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) ELSE 'n/a' END AS amount,
       true AS numbered
FROM orders""".replace("\\\\", "\\")


def _read_dropped(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    folder = _drop_orders(spark, sf_dir, file_format)
    rows = files.read_increments(spark, folder, file_format, f"*.{file_format}", recursive=True).rows
    return rows.select("o_orderkey", "priority", "amount", (F.col("row_index") >= 1).alias("numbered"))


@query("read_increments_csv", _DROPPED_SQL)
def read_increments_csv(spark, sf_dir):
    return _read_dropped(spark, sf_dir, "csv")


@query("read_increments_parquet", _DROPPED_SQL)
def read_increments_parquet(spark, sf_dir):
    return _read_dropped(spark, sf_dir, "parquet")


@query("read_increments_json", _DROPPED_SQL)
def read_increments_json(spark, sf_dir):
    return _read_dropped(spark, sf_dir, "json")


@query(
    "read_daily",
    """
SELECT o_orderstatus AS status,
       CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN CAST(o_orderdate AS DATE) END AS day,
       count(*) AS rows
FROM orders GROUP BY ALL""",
)
def read_daily(spark, sf_dir):
    """`orders` as daily CSV files, read back as a feed; rows per parsed day."""
    folder = storage.new_path(spark, "daily")
    raw = _raw_orders(spark, sf_dir).join(t.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    raw.select("o_orderkey", "day", F.col("o_orderstatus").alias("status")).write.option("header", "true").csv(folder)
    daily = files.read_daily(spark, folder, ["day"], glob="*.csv")
    return daily.groupBy("status", "day").agg(F.count(F.lit(1)).alias("rows"))


@query("row_index", "SELECT count(*) AS rows, true AS without_gaps FROM orders")
def row_index(spark, sf_dir):
    """Row numbers inside text files: per file they must run from 1 to the number of rows."""
    folder = storage.new_path(spark, "numbered")
    t.load(spark, sf_dir, "orders").select("o_orderkey").write.option("header", "true").csv(folder)
    paths = files.select_files(spark, folder, "*.csv")
    per_file = (
        files.read_files(spark, paths)
        .rows.groupBy("source_file", "row_index")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("source_file")
        .agg(F.sum("n").alias("rows"), F.max("row_index").alias("last"), F.min("row_index").alias("first"), F.max("n").alias("n"))
    )
    return per_file.agg(
        F.sum("rows").alias("rows"),
        F.bool_and((F.col("first") == 1) & (F.col("last") == F.col("rows")) & (F.col("n") == 1)).alias("without_gaps"),
    )


@query(
    "snapshot_restore",
    "SELECT user_id, event_type, count(*) AS rows FROM events GROUP BY ALL",
)
def snapshot_restore(spark, sf_dir):
    """Two snapshots, then back to the first."""
    root = storage.new_path(spark, "snapshots")
    events = t.load(spark, sf_dir, "events")
    first = snapshots.write_snapshot(events, root)
    snapshots.write_snapshot(sync.latest_wins(events, ["user_id"], "ts", ["event_id"]), root)
    snapshots.restore_snapshot(spark, root, first)
    return snapshots.read_snapshot(spark, root).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("rows"))


# --- streaming ------------------------------------------------------------------------------------------------


def _run_stream(spark: SparkSession, rows: DataFrame, keys: list[str], version: str, ties: list[str]) -> DataFrame:
    folder, root = storage.new_path(spark, "stream"), storage.new_path(spark, "stream-table")
    dropped = _files_of(rows, 6)
    with storage.releasing(spark):
        rows.repartition(dropped).write.parquet(folder)
    stream = sync_stream.increment_stream(spark, folder, rows.schema, "parquet", "*.parquet", max_files=dropped // 3)
    run = sync_stream.upsert_stream(stream, root, storage.new_path(spark, "stream-checkpoint"), keys, version, ties)
    run.awaitTermination()
    return snapshots.read_snapshot(spark, root)


@query("stream_latest_wins", SQL["latest_wins"])
def stream_latest_wins(spark, sf_dir):
    """Events in several files, a third of them per micro-batch, into one row per key."""
    return _run_stream(spark, t.load(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "stream_upsert",
    f"""WITH {UPSERT_SQL}
SELECT l_orderkey, l_linenumber, max(l_shipdate) AS updated, count(*) AS rows
FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate FROM table_rows r
  WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.l_orderkey = r.l_orderkey AND w.l_linenumber = r.l_linenumber)
  UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate FROM winners
) GROUP BY ALL""",
)
def stream_upsert(spark, sf_dir):
    """Increments in several files, micro-batch by micro-batch into an existing table; newest date and rows per key."""
    folder, root = storage.new_path(spark, "stream"), storage.new_path(spark, "stream-table")
    snapshots.write_snapshot(t.table_rows(spark, sf_dir), root)
    rows = t.increment_rows(spark, sf_dir).drop("source_file")
    dropped = _files_of(rows, 4)
    with storage.releasing(spark):
        rows.repartition(dropped).write.parquet(folder)
    stream = sync_stream.increment_stream(spark, folder, rows.schema, "parquet", "*.parquet", max_files=dropped // 2)
    checkpoint = storage.new_path(spark, "stream-checkpoint")
    sync_stream.upsert_stream(stream, root, checkpoint, t.KEYS, t.VERSION, t.TIES).awaitTermination()
    table = snapshots.read_snapshot(spark, root)
    return table.groupBy(*t.KEYS).agg(F.max(t.VERSION).alias("updated"), F.count(F.lit(1)).alias("rows"))


# --- jobs -----------------------------------------------------------------------------------------------------

_SYNC_SQL = f"""{t.CONTRACT_SQL},
increments AS (
  SELECT * REPLACE (
           CASE WHEN contract_item = 'N' AND seq = '3' THEN 'NEW' || centre ELSE centre END AS centre,
           CASE WHEN contract_item = 'Y' THEN upper(vendor_name) ELSE vendor_name END AS vendor_name,
           CASE WHEN seq <= '3' THEN updated + 45 WHEN seq <= '5' THEN updated WHEN seq = '6' THEN updated - 30 END AS updated)
  FROM contract WHERE account NOT IN ('0202', '0205', '0502', '0405')
),
start_rows AS (SELECT * FROM contract WHERE account NOT IN ('0202', '0205', '0502', '0405')),
held AS (SELECT item, account, vendor, centre, gl, max(updated) AS held FROM start_rows GROUP BY ALL),
accepted AS (
  SELECT i.* FROM increments i LEFT JOIN held h
    ON i.item = h.item AND i.account = h.account AND i.vendor = h.vendor AND i.centre = h.centre
    AND i.gl IS NOT DISTINCT FROM h.gl
  WHERE h.held IS NULL OR i.updated > h.held
)"""


def _start_table(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    rows = clean.enforce_schema(t.contract_rows(spark, sf_dir), spec.types)
    return clean.exclude_values(rows, spec.account, spec.excluded_accounts)


@query(
    "sync_job",
    f"""WITH {_SYNC_SQL}
SELECT item, account, vendor, centre, coalesce(gl, '') AS gl, max(updated) AS updated, count(*) AS rows
FROM (
  SELECT * FROM start_rows s WHERE NOT EXISTS (
    SELECT 1 FROM accepted a WHERE a.item = s.item AND a.account = s.account AND a.vendor = s.vendor
    AND a.centre = s.centre AND a.gl IS NOT DISTINCT FROM s.gl)
  UNION ALL
  SELECT DISTINCT ON (item, account, vendor, centre, gl) * FROM accepted
  ORDER BY item, account, vendor, centre, gl, updated DESC
)
GROUP BY ALL""",
)
def sync_job(spark, sf_dir):
    """Snapshot, raw text increments, the whole sync job; then the rows and newest date per key of the new table."""
    spec = TableSpec()
    root, audit_root = storage.new_path(spark, "table"), storage.new_path(spark, "audit")
    snapshots.write_snapshot(_start_table(spark, sf_dir, spec), root)
    increments = clean.clean_strings(t.contract_increments(spark, sf_dir))
    jobs.sync_increment(spark, root, audit_root, increments, spec)
    names = ["item", "account", "vendor", "centre", "gl"]
    table = snapshots.read_snapshot(spark, root).select(
        *[F.coalesce(F.col(f"`{k}`"), F.lit("")).alias(n) for k, n in zip(spec.keys, names)],
        F.col(f"`{spec.version}`").alias("updated"),
    )
    return table.groupBy(*names).agg(F.max("updated").alias("updated"), F.count(F.lit(1)).alias("rows"))


_DAILY_SQL = """
daily AS (
  SELECT 'daily_' || o_orderstatus AS source, o_orderkey AS idx,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'C' || (o_custkey // 2) END AS dpn, 'M' || o_orderkey AS mpn,
         CASE WHEN o_orderstatus = 'F' THEN '02' ELSE '05' END AS plant, 'V' || left(o_orderpriority, 1) AS distributor,
         make_date(year(o_orderdate), 1, 1) AS d_start,
         make_date(year(o_orderdate) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, 12, 31) AS d_end,
         CAST(trunc(o_totalprice) AS DOUBLE) AS price,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE 8.0 END AS q1, 1024.0 AS q2,
         CASE WHEN o_orderstatus = 'O' THEN (CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE 8.0 END) ELSE 1024.0 END
           AS divisor,
         o_custkey, o_orderpriority
  FROM orders
),
found AS (
  SELECT DISTINCT source, idx, 'DPN' AS route, item AS pmm FROM daily JOIN baseline ON dpn = catalogue
  UNION ALL
  SELECT DISTINCT source, idx, 'MPN', item FROM daily JOIN baseline ON mpn = manufacturer_catalogue
),
collapsed AS (
  SELECT source, idx, pmm, string_agg(route, ',' ORDER BY route) AS pmm_source FROM found GROUP BY ALL
),
lists AS (
  SELECT item, prefix, string_agg(seq || '-' || vendor, ', ' ORDER BY seq, vendor) AS vendors FROM baseline GROUP BY ALL
),
integrated AS (
  SELECT d.source, d.idx, coalesce(c.pmm, '') AS pmm, coalesce(c.pmm_source, '') AS pmm_source, e.description, l.vendors,
         v.vendor, v.contract_no,
         CASE WHEN d_start = v.eff AND d_end = v.exp THEN 'Date Matched'
              WHEN v.eff IS NULL THEN 'New Contract'
              WHEN d_start <> v.eff AND d_end <> v.exp THEN 'Start & End Date not Match'
              WHEN d_start <> v.eff THEN 'Start Date not Match'
              WHEN d_end <> v.exp THEN 'End Date not Match' ELSE 'Exception' END AS status,
         CASE WHEN divisor <> 0 THEN round(greatest(d.price / divisor, d.price / divisor * q1, d.price / divisor * q2, 0.0), 0)
           END AS highest,
         'N' || c_nationkey AS manufacturer,
         CASE WHEN o_orderpriority <> '5-LOW' THEN upper(o_orderpriority) END AS vendor_code
  FROM daily d LEFT JOIN collapsed c USING (source, idx)
  LEFT JOIN (SELECT DISTINCT item, description FROM baseline) e ON e.item = c.pmm
  LEFT JOIN lists l ON l.item = c.pmm AND l.prefix = d.plant
  LEFT JOIN (SELECT DISTINCT * EXCLUDE (description) FROM baseline) v
    ON v.item = c.pmm AND v.prefix = d.plant AND v.vendor = d.distributor
  LEFT JOIN customer ON c_custkey = o_custkey
)"""


def _integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = clean.enforce_schema(t.contract_rows(spark, sf_dir), TableSpec().types)
    return jobs.integrate(
        t.daily_rows(spark, sf_dir), table, t.manufacturer_map(spark, sf_dir), t.vendor_map(spark, sf_dir)
    )


@query(
    "integrate_job",
    f"""WITH {t.CONTRACT_SQL}, {_LOOKUP_SQL}, {_DAILY_SQL}
SELECT *, CASE WHEN count(*) OVER (PARTITION BY source, idx) > 1 THEN 'Y' ELSE '' END AS duplicates FROM integrated""",
)
def integrate_job(spark, sf_dir):
    return _integrated(spark, sf_dir).select(
        F.col("Source_File").alias("source"),
        F.col("Index").alias("idx"),
        F.col("0031_PMM Item Number").alias("pmm"),
        F.col("PMM_source").alias("pmm_source"),
        F.col("0031_Item Description").alias("description"),
        F.col("0031_Vendors List").alias("vendors"),
        F.col("0031_Vendor Code").alias("vendor"),
        F.col("0031_Contract No").alias("contract_no"),
        F.col("Contract Header Check").alias("status"),
        F.round(F.col("Highest_UOM_Price").cast("double"), 0).alias("highest"),
        F.col("Suggested AllScripts MFN").alias("manufacturer"),
        F.col("Suggested AllScripts VN").alias("vendor_code"),
        F.col("Duplicates").alias("duplicates"),
    )


@query(
    "classify_export_job",
    f"""WITH {t.CONTRACT_SQL}, {_LOOKUP_SQL}, {_DAILY_SQL}
SELECT CASE WHEN pmm <> '' THEN 'update' ELSE 'create' END AS "Bucket", count(*) AS rows FROM integrated GROUP BY 1""",
)
def classify_export_job(spark, sf_dir):
    """Integrate, classify to a snapshot, export by bucket, and count what was exported."""
    classified = storage.new_path(spark, "classified")
    with storage.discard_staged(spark):
        jobs.classify_to_snapshot(_integrated(spark, sf_dir), classified)
    path = jobs.export(spark, classified, storage.new_path(spark, "exports"))
    return classify.bucket_counts(spark.read.parquet(path))


@query("sync_folder_job", SQL["sync_job"])
def sync_folder_job(spark, sf_dir):
    """The increments of `sync_job` dropped as CSV files and synced from their folder, a second run finds nothing new."""
    spec, settings = TableSpec(), SyncSettings(increment_glob="*.csv", full_glob="none*", max_files=None)
    folder, root, audit_root = (storage.new_path(spark, label) for label in ("drop", "table", "audit"))
    snapshots.write_snapshot(_start_table(spark, sf_dir, spec), root)
    increments = t.contract_increments(spark, sf_dir).drop(*sync.LINEAGE)
    with storage.releasing(spark):
        increments.repartition(_files_of(increments, 3)).write.option("header", "true").option("escape", '"').csv(folder)
    jobs.sync(spark, folder, root, audit_root, spec, settings)
    if jobs.sync(spark, folder, root, audit_root, spec, settings) is not None:
        raise ValueError("files were applied twice")
    names = ["item", "account", "vendor", "centre", "gl"]
    table = snapshots.read_snapshot(spark, root).select(
        *[F.coalesce(F.col(f"`{k}`"), F.lit("")).alias(n) for k, n in zip(spec.keys, names)],
        F.col(f"`{spec.version}`").alias("updated"),
    )
    return table.groupBy(*names).agg(F.max("updated").alias("updated"), F.count(F.lit(1)).alias("rows"))


@query(
    "small_changes",
    """SELECT 'price' AS "Column", count(*) AS count FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'share', count(*) FROM orders WHERE o_orderkey % 2 = 0""",
)
def small_changes(spark, sf_dir):
    """Changes far below a cent are logged like any other, equal values are not."""
    keyed = t.load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("double").alias("price"))
    old = keyed.withColumn("share", F.lit(1e-7))
    new = keyed.select(
        "o_orderkey",
        F.date_add("day", 1).alias("day"),
        (F.col("price") + F.when(F.col("o_orderkey") % 3 != 0, 3e-8).otherwise(0.0)).alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, 4e-7).otherwise(1e-7).alias("share"),
    )
    return sync.changes_by_column(sync.field_changes(old, new, ["o_orderkey"], "day"))


# --- tables in buckets, checks as facts, runs -----------------------------------------------------------------

_TABLE_COLUMNS = {
    "item": "PMM Item Number",
    "account": "Corp Acct",
    "vendor": "Vendor Code",
    "centre": "Additional Cost Centre",
    "gl": "Additional GL Account",
    "updated": "Item Update Date",
    "vendor_name": "Vendor Name",
    "seq": "Vendor Seq",
    "contract_no": "Contract No",
    "contract_item": "Contract Item",
    "catalogue": "Vendor Catalogue",
    "manufacturer_catalogue": "Manufacturer Catalogue",
    "description": "Item Description",
    "eff": "Contract EFF Date",
    "exp": "Contract EXP Date",
    "price": "Default UOM Price",
}

#: `final`: the table after all increments of `_SYNC_SQL`, every column.
_FINAL_SQL = f"""{_SYNC_SQL},
final AS (
  SELECT {", ".join(_TABLE_COLUMNS)} FROM start_rows s WHERE NOT EXISTS (
    SELECT 1 FROM accepted a WHERE a.item = s.item AND a.account = s.account AND a.vendor = s.vendor
    AND a.centre = s.centre AND a.gl IS NOT DISTINCT FROM s.gl)
  UNION ALL
  SELECT DISTINCT ON (item, account, vendor, centre, gl) {", ".join(_TABLE_COLUMNS)} FROM accepted
  ORDER BY item, account, vendor, centre, gl, updated DESC
)"""


def _issue_rows_sql(table: str) -> str:
    several = "GROUP BY {0} HAVING count(DISTINCT {1}) > 1"
    subject = "item, vendor, left(account, 2)"
    return f"""
SELECT 'one_to_one' AS "check", contract_no AS part1, '' AS part2, '' AS part3, vendor AS value, NULL AS detail, count(*) AS rows
FROM {table} WHERE contract_no IN (SELECT contract_no FROM {table} {several.format("contract_no", "vendor")}) GROUP BY ALL
UNION ALL
SELECT 'blank_value', item, '', '', NULL, NULL, count(*) FROM {table} WHERE catalogue IS NULL GROUP BY item
UNION ALL
SELECT 'consistent_value', item, vendor, left(account, 2), catalogue, seq, count(*) FROM {table}
WHERE catalogue IS NOT NULL AND ({subject}) IN (
  SELECT ({subject}) FROM {table} WHERE catalogue IS NOT NULL {several.format(subject, "catalogue")})
GROUP BY ALL"""


def _table_columns(table: DataFrame) -> DataFrame:
    names = {name: F.col(f"`{column}`") for name, column in _TABLE_COLUMNS.items()}
    return table.select(*[c.cast("bigint").alias(n) if n == "price" else c.alias(n) for n, c in names.items()])


@query("issue_rows", f"WITH {t.CONTRACT_SQL} {_issue_rows_sql('contract')}")
def issue_rows(spark, sf_dir):
    """The checks in long form: one scan, one row per value."""
    spec = TableSpec()
    roles = (spec.contract, spec.vendor, spec.catalogue, spec.item, spec.account, spec.sequence)
    return checks.issue_rows(checks.check_facts(t.contract_rows(spark, sf_dir), *roles))


def _synced_in_batches(spark: SparkSession, sf_dir: str, batches: int = 3) -> tuple[str, str]:
    """A table in buckets and the increments of `sync_job` in several batches: (table root, audit root)."""
    spec = TableSpec()
    root, audit_root = storage.new_path(spark, "table"), storage.new_path(spark, "audit")
    jobs.full_refresh(spark, root, audit_root, t.contract_rows(spark, sf_dir), spec, buckets=32)
    increments = storage.stage(clean.clean_strings(t.contract_increments(spark, sf_dir)), "increments")
    batch = F.pmod(F.xxhash64(f"`{spec.keys[3]}`"), F.lit(batches))
    for i in range(batches):
        jobs.sync_increment(spark, root, audit_root, increments.filter(batch == i), spec)
    return root, audit_root


@query("sync_job_buckets", f"WITH {_FINAL_SQL} SELECT * FROM final")
def sync_job_buckets(spark, sf_dir):
    """A full refresh into buckets, then the whole sync job per batch; every column of the table."""
    root, _ = _synced_in_batches(spark, sf_dir)
    return _table_columns(snapshots.read_snapshot(spark, root))


@query("issues_by_batch", f"WITH {_FINAL_SQL} {_issue_rows_sql('final')}")
def issues_by_batch(spark, sf_dir):
    """The issues that were kept up batch by batch are those of the final table."""
    _, audit_root = _synced_in_batches(spark, sf_dir)
    return check_store.issues(spark, f"{audit_root}/check_facts")


@query("full_refresh_job", f"WITH {_SYNC_SQL} SELECT {', '.join(_TABLE_COLUMNS)} FROM start_rows")
def full_refresh_job(spark, sf_dir):
    """A dropped full file replaces the table; every column."""
    spec, settings = TableSpec(), SyncSettings(full_glob="*.csv", buckets=16)
    folder, root, audit_root = (storage.new_path(spark, label) for label in ("drop", "table", "audit"))
    snapshots.write_snapshot(_start_table(spark, sf_dir, spec).limit(0), root)
    rows = t.contract_rows(spark, sf_dir)
    with storage.releasing(spark):
        rows.repartition(_files_of(rows, 3)).write.option("header", "true").option("escape", '"').csv(folder)
    if jobs.sync(spark, folder, root, audit_root, spec, settings).kind != "full":
        raise ValueError("the full files were not taken")
    return _table_columns(snapshots.read_snapshot(spark, root))


@query("stream_sync_csv", f"WITH {_FINAL_SQL} SELECT * FROM final")
def stream_sync_csv(spark, sf_dir):
    """The increments dropped as CSV files and synced as a stream, half of them per micro-batch; every column of the table."""
    increments = t.contract_increments(spark, sf_dir).drop(*sync.LINEAGE)
    dropped = _files_of(increments, 2)
    spec, settings = TableSpec(), SyncSettings(increment_glob="*.csv", full_glob="none*", max_files=dropped // 2)
    folder, root, audit_root, checkpoint = (storage.new_path(spark, label) for label in ("drop", "table", "audit", "checkpoint"))
    snapshots.write_snapshot(_start_table(spark, sf_dir, spec), root, layout=jobs.table_layout(spec, 16))
    with storage.releasing(spark):
        increments.repartition(dropped).write.option("header", "true").option("escape", '"').csv(folder)
    sync_stream.sync_folder_stream(spark, folder, root, audit_root, checkpoint, spec, settings).awaitTermination()
    return _table_columns(snapshots.read_snapshot(spark, root))


@query(
    "run_status",
    f"""WITH {_FINAL_SQL}, issues AS ({_issue_rows_sql("final")})
SELECT 'increment' AS kind, (SELECT count(*) FROM final) AS row_count,
       count(*) FILTER (held IS NULL) AS new_rows,
       count(*) FILTER (held IS NOT NULL AND updated > held AND contract_item = 'Y') AS updated_rows,
       count(*) FILTER (held IS NOT NULL AND coalesce(updated <= held, true)) AS skipped_rows,
       (SELECT count(DISTINCT part1) FROM issues WHERE "check" = 'one_to_one') AS one_to_one,
       (SELECT sum(rows)::BIGINT FROM issues WHERE "check" = 'blank_value') AS blank_value,
       (SELECT count(DISTINCT (part1, part2, part3)) FROM issues WHERE "check" = 'consistent_value') AS consistent_value
FROM increments i LEFT JOIN held h ON i.item = h.item AND i.account = h.account AND i.vendor = h.vendor
  AND i.centre = h.centre AND i.gl IS NOT DISTINCT FROM h.gl""",
)
def run_status(spark, sf_dir):
    """What the run history says about the sync job."""
    spec = TableSpec()
    root, audit_root = storage.new_path(spark, "table"), storage.new_path(spark, "audit")
    snapshots.write_snapshot(_start_table(spark, sf_dir, spec), root)
    jobs.sync_increment(spark, root, audit_root, clean.clean_strings(t.contract_increments(spark, sf_dir)), spec)
    counts = ("row_count", "new_rows", "updated_rows", "skipped_rows", "one_to_one", "blank_value", "consistent_value")
    return audit_store.runs(spark, audit_root).select("kind", *counts)


@query(
    "quarantined_rows",
    """SELECT CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey || ',' || o_custkey || ',surplus,value' ELSE o_orderkey || '' END AS text
FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0""",
)
def quarantined_rows(spark, sf_dir):
    """Rows of dropped CSV files with too many or too few fields, as they stand in the files."""
    folder = storage.new_path(spark, "drop")
    orders = t.load(spark, sf_dir, "orders")
    damaged = """CASE WHEN o_orderkey % 10 = 0 THEN concat(o_orderkey, ',', o_custkey, ',surplus,value')
                      WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey AS STRING)
                      ELSE concat(o_orderkey, ',', o_custkey) END"""
    lines = orders.select(F.explode(F.split(F.expr(damaged), "\n")).alias("value"))
    header = spark.range(0, 4, 1, 4).select(F.lit("key,customer").alias("value"))
    dealt = lines.withColumn("place", F.pmod(F.xxhash64("value"), F.lit(4))).withColumn("first", F.lit(1))
    heads = header.select("value", F.monotonically_increasing_id().alias("id")).select("value", F.shiftright("id", 33).alias("place"), F.lit(0).alias("first"))
    dealt.unionByName(heads).repartitionByRange(4, "place").sortWithinPartitions("place", "first").select("value").write.text(folder)
    paths = files.select_files(spark, folder, "*.txt")
    return files.quarantined_rows(spark, paths).select("text")
