"""The roles of the reference table, the increments and the feed, played by the test tables.

`lineitem` is the reference table: key (order, line), version ship date; the key is dirty on purpose. The
increments are all of `lineitem` again with later, equal, earlier or missing dates, changed values and some new
keys. For the jobs the same rows appear under the names of the contract table, and `orders` is the daily feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["l_orderkey", "l_linenumber"]
VERSION = "l_shipdate"
TIES = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference table."""
    return load(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))


def increment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The increments, with the file they came in."""
    return table_rows(spark, sf_dir).select(
        F.expr("CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN -l_orderkey - 1 ELSE l_orderkey END").alias(
            "l_orderkey"
        ),
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.expr("CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END").alias("l_quantity"),
        F.expr("CASE WHEN l_discount >= 0.05 THEN l_extendedprice + 10 ELSE l_extendedprice END").alias(
            "l_extendedprice"
        ),
        "l_discount",
        "l_tax",
        F.expr("CASE WHEN l_linestatus = 'F' THEN lower(l_returnflag) ELSE l_returnflag END").alias("l_returnflag"),
        "l_linestatus",
        F.expr(
            """CASE WHEN l_linenumber <= 3 THEN date_add(l_shipdate, 45)
                    WHEN l_linenumber <= 5 THEN l_shipdate
                    WHEN l_linenumber = 6 THEN date_add(l_shipdate, -30) END"""
        ).alias("l_shipdate"),
        F.expr("concat('increment_', l_returnflag)").alias("source_file"),
    )


TABLE_SQL = """
table_rows AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
  FROM lineitem
)"""

INCREMENT_SQL = (
    TABLE_SQL
    + """,
increment_rows AS (
  SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN -l_orderkey - 1 ELSE l_orderkey END AS l_orderkey,
         l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         CASE WHEN l_discount >= 0.05 THEN l_extendedprice + 10 ELSE l_extendedprice END AS l_extendedprice,
         l_discount, l_tax,
         CASE WHEN l_linestatus = 'F' THEN lower(l_returnflag) ELSE l_returnflag END AS l_returnflag,
         l_linestatus,
         CASE WHEN l_linenumber <= 3 THEN l_shipdate + 45
              WHEN l_linenumber <= 5 THEN l_shipdate
              WHEN l_linenumber = 6 THEN l_shipdate - 30 END AS l_shipdate,
         'increment_' || l_returnflag AS source_file
  FROM table_rows
),
held AS (SELECT l_orderkey AS h_order, l_linenumber AS h_line, max(l_shipdate) AS held FROM table_rows GROUP BY ALL),
gated AS (
  SELECT i.*, h.held, h.h_order IS NOT NULL AS matched,
         h.held IS NULL OR coalesce(i.l_shipdate > h.held, false) AS newer
  FROM increment_rows i LEFT JOIN held h ON l_orderkey = h_order AND l_linenumber = h_line
)"""
)

ORDER_SQL = (
    "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, "
    "l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, "
    "l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST"
)


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` under the names of the contract table, every column as text."""
    return table_rows(spark, sf_dir).select(
        F.expr("concat(CASE WHEN l_tax >= 0.08 THEN 'PM' ELSE 'I' END, l_partkey)").alias("PMM Item Number"),
        F.expr(
            """CASE WHEN l_returnflag = 'A' THEN '0201' WHEN l_returnflag = 'N' THEN '0204'
                    WHEN l_discount >= 0.09 THEN '0202' WHEN l_linestatus = 'F' THEN '0501' ELSE '0504' END"""
        ).alias("Corp Acct"),
        F.expr("concat('V', l_linenumber)").alias("Vendor Code"),
        F.expr("concat('CC', l_orderkey)").alias("Additional Cost Centre"),
        F.expr("CASE WHEN l_linestatus = 'O' THEN concat('GL', l_suppkey) END").alias("Additional GL Account"),
        F.expr("date_format(l_shipdate, 'yyyy-MM-dd')").alias("Item Update Date"),
        F.expr("concat(CASE WHEN l_linenumber = 7 THEN 'ZZZ ' ELSE 'Vendor ' END, l_linenumber)").alias("Vendor Name"),
        F.expr("CAST(l_linenumber AS STRING)").alias("Vendor Seq"),
        F.expr("concat('K', l_suppkey)").alias("Contract No"),
        F.expr("CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END").alias("Contract Item"),
        F.expr("CASE WHEN l_discount > 0 THEN concat('C', l_partkey div 2) END").alias("Vendor Catalogue"),
        F.expr("concat('M', l_orderkey)").alias("Manufacturer Catalogue"),
        F.expr("concat('Item ', l_partkey, ' ', l_linestatus)").alias("Item Description"),
        F.expr("date_format(l_shipdate, 'yyyy-01-01')").alias("Contract EFF Date"),
        F.expr("date_format(l_shipdate, 'yyyy-12-31')").alias("Contract EXP Date"),
        F.expr("CAST(CAST(l_extendedprice AS BIGINT) AS STRING)").alias("Default UOM Price"),
    )


CONTRACT_SQL = (
    TABLE_SQL
    + """,
contract AS (
  SELECT (CASE WHEN l_tax >= 0.08 THEN 'PM' ELSE 'I' END) || l_partkey AS item,
         CASE WHEN l_returnflag = 'A' THEN '0201' WHEN l_returnflag = 'N' THEN '0204'
              WHEN l_discount >= 0.09 THEN '0202' WHEN l_linestatus = 'F' THEN '0501' ELSE '0504' END AS account,
         'V' || l_linenumber AS vendor,
         'CC' || l_orderkey AS centre,
         CASE WHEN l_linestatus = 'O' THEN 'GL' || l_suppkey END AS gl,
         l_shipdate AS updated,
         (CASE WHEN l_linenumber = 7 THEN 'ZZZ ' ELSE 'Vendor ' END) || l_linenumber AS vendor_name,
         CAST(l_linenumber AS VARCHAR) AS seq,
         'K' || l_suppkey AS contract_no,
         CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS contract_item,
         CASE WHEN l_discount > 0 THEN 'C' || (l_partkey // 2) END AS catalogue,
         'M' || l_orderkey AS manufacturer_catalogue,
         'Item ' || l_partkey || ' ' || l_linestatus AS description,
         make_date(year(l_shipdate), 1, 1) AS eff,
         make_date(year(l_shipdate), 12, 31) AS exp,
         CAST(trunc(l_extendedprice) AS BIGINT) AS price
  FROM table_rows
)"""
)


def contract_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text increments for the contract table: padded text, three date layouts, commas never."""
    rows = contract_rows(spark, sf_dir)
    day = F.to_date("Item Update Date")
    line = F.col("Vendor Seq").cast("int")
    shifted = F.when(line <= 3, F.date_add(day, 45)).when(line <= 5, day).when(line == 6, F.date_add(day, -30))
    text = (
        F.when(line == 1, F.date_format(shifted, "M/d/yyyy"))
        .when(line == 2, F.date_format(shifted, "yyyy-MMM-dd"))
        .otherwise(F.date_format(shifted, "yyyy-MM-dd"))
    )
    is_new = F.col("Contract Item") == "N"
    return rows.withColumns(
        {
            "PMM Item Number": F.concat(F.lit("  "), F.col("PMM Item Number"), F.lit("\t")),
            "Additional Cost Centre": F.when(
                is_new & (line == 3), F.concat(F.lit("NEW"), F.col("Additional Cost Centre"))
            ).otherwise(F.col("Additional Cost Centre")),
            "Item Update Date": F.coalesce(text, F.lit("unknown")),
            "Vendor Name": F.when(F.col("Contract Item") == "Y", F.upper("Vendor Name")).otherwise(
                F.concat(F.col("Vendor Name"), F.lit(" "))
            ),
            "source_file": F.concat(F.lit("extract_"), F.col("Corp Acct")),
        }
    )


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` under the names of the daily feed."""
    return load(spark, sf_dir, "orders").select(
        F.expr("concat('daily_', o_orderstatus)").alias("Source_File"),
        F.col("o_orderkey").alias("Index"),
        F.expr("CASE WHEN o_orderpriority <> '5-LOW' THEN concat('C', o_custkey div 2) END").alias(
            "Distributor Part Number"
        ),
        F.expr("concat('M', o_orderkey)").alias("Manufacturer Part Number"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN '0201' ELSE '0504' END").alias("Plant ID"),
        F.expr("concat('V', substring(o_orderpriority, 1, 1))").alias("Distributor"),
        F.expr("make_date(year(o_orderdate), 1, 1)").alias("Contract Start Date"),
        F.expr("make_date(year(o_orderdate) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, 12, 31)").alias(
            "Contract End Date"
        ),
        F.expr("date_format(o_orderdate, \"yyyy-MMM-dd '03:04:05 PM'\")").alias("Date and Time Stamp"),
        F.lit("EA").alias("Base Unit of Measure"),
        F.expr("CASE WHEN o_orderstatus = 'O' THEN 'BX' ELSE 'CS' END").alias("Purchase Order Price Unit of Measure"),
        F.lit("BX").alias("AUOM1"),
        F.lit("CS").alias("AUOM2"),
        F.lit("PL").alias("AUOM3"),
        F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN '0' ELSE '8' END").alias("AUOM1 QTY"),
        F.lit("1,024").alias("AUOM2 QTY"),
        F.lit(None).cast("string").alias("AUOM3 QTY"),
        F.expr("format_number(CAST(o_totalprice AS BIGINT), 0)").alias("Purchase UOM Price"),
        F.expr("CAST(o_custkey AS STRING)").alias("ERP Manufacturer No."),
        F.expr("o_orderpriority").alias("MMC Distributor No."),
    )


def manufacturer_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manufacturer codes: customers as codes of their nation."""
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("N"), "c_nationkey").alias("All_Manufacturer Number"),
        F.col("c_custkey").cast("string").alias("BC_Manufacturer No_"),
    )


def vendor_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor codes: one entry per order priority in use but the lowest."""
    orders = load(spark, sf_dir, "orders")
    return (
        orders.filter("o_orderpriority <> '5-LOW'")
        .select(F.upper("o_orderpriority").alias("All_Vendor Code"), F.col("o_orderpriority").alias("BC_Vendor No_"))
        .distinct()
    )
