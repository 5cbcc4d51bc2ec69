"""Planning inputs derived from the TPC-H-shaped driver tables.

The six inputs of the marts (revenue, opportunity snapshots, targets,
calendar, account and seller lookups) are built lazily from ``lineitem``,
``orders``, ``part``, ``customer``, ``nation`` and ``region``; nothing is
collected and every input grows with the tables it is derived from.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planmart.functions.rules import MONEY, MONTH_NAMES, NULL_TEXT, lookup, parse_amount, scale_money
from planmart.operators.fiscal import Calendar
from planmart.session import shared_dir

# --- fixed values of the adapter definitions --------------------------------
CALENDAR_START = dt.date(1995, 1, 1)
CALENDAR_END = dt.date(2002, 6, 30)
REVENUE_ZERO_FROM = "2001-02-01"
TARGET_FROM, TARGET_UNTIL = "2000-07-01", "2001-07-01"  # [from, until)
RETURNFLAG_TO_TYPE = {"A": "Actuals", "N": "Partner Fee", "R": "Registration Fee"}
PART_TYPE_TO_CATEGORY = {
    "STANDARD": "Standard Services",
    "MEDIUM": "Medium Service Desk",
    "LARGE": "Large Support",
    "SMALL": "Small Products",
    "ECONOMY": "Economy Product",
    "PROMO": "Promo Bundle",
}
PRIORITY_TO_PRODUCT = {
    "1-URGENT": "Services: Urgent",
    "2-HIGH": "Support: High",
    "3-MEDIUM": "Products: Medium",
    "4-NOT SPECIFIED": "Product: Unspecified",
}
LOW_PRIORITY = "5-LOW"
TARGET_CATEGORY_BY_MOD3 = {0: "Services", 1: "Support", 2: "Products"}
COPY_ID_OFFSET = 100_000_000
WRONG_ACCOUNT = "99999999"
# --- end of fixed values ----------------------------------------------------


@dataclass
class Inputs:
    """The planning inputs; any source (tables, CSV, adapters) fills these."""
    revenue: DataFrame
    opportunities: DataFrame
    targets: DataFrame
    calendar: Calendar
    accounts: DataFrame
    sellers: DataFrame
    opportunities_prev: DataFrame | None = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def account_code(c: str | Column) -> Column:
    """Customer key → eight-digit account code with leading zeros."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(c.cast("string"), 8, "0")


def _ts(s: str) -> Column:
    # timestamp_ntz literal: comparisons against the NTZ columns push down.
    return F.lit(s).cast("timestamp_ntz")


def calendar(spark: SparkSession, start: dt.date = CALENDAR_START,
             end: dt.date = CALENDAR_END) -> Calendar:
    """One row per day; July–June fiscal year; month names as text."""
    n_days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    month, year = F.month("Date_Value"), F.year("Date_Value")
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    df = (spark.range(0, n_days, numPartitions=1)
          .select(d.alias("Date_Value"))
          .select(
              "Date_Value",
              F.concat(F.element_at(names, month), F.lit(", "), year.cast("string"))
               .alias("Fiscal_Month"),
              F.concat(F.lit("Q"), (F.pmod(month + 5, F.lit(12)) / 3).cast("int") + 1)
               .alias("Fiscal_Quarter"),
              F.concat(F.lit("FY"), (year + F.when(month >= 7, 1).otherwise(0)).cast("string"))
               .alias("Fiscal_Year"),
              (year * 12 + month).cast("int").alias("Month_ID")))
    return Calendar(df, unique_days=True)


def _revenue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week-25 feed plus the numeric key ``_key`` used by the week-24 rules.

    Order- and part-level attributes are derived on their own (smaller)
    tables before the join, so the per-line work is two probes and a few
    column expressions.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.trunc(F.to_date("l_shipdate"), "month").alias("Month"),
        lookup("l_returnflag", RETURNFLAG_TO_TYPE).alias("Revenue_Type"),
        F.col("l_linestatus").alias("Revenue_Motion"),
        F.when(F.col("l_shipdate") < _ts(REVENUE_ZERO_FROM), F.col("l_extendedprice").cast(MONEY))
         .otherwise(F.lit(0).cast(MONEY)).alias("Revenue"))
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", account_code("o_custkey").alias("StoreNo"),
        F.col("o_orderpriority").alias("Motion"))
    part = _table(spark, sf_dir, "part").select(
        "p_partkey",
        lookup(F.substring_index("p_type", " ", 1), PART_TYPE_TO_CATEGORY).alias("Product_Category"))
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))
    return joined.select("StoreNo", "Month", "Revenue_Type", "Revenue_Motion",
                         "Product_Category", "Motion", "Revenue", F.col("l_orderkey").alias("_key"))


def _stored(df: DataFrame) -> DataFrame:
    """`df` written once to shared storage and read back, so that several feeds take one join."""
    path = shared_dir(df.sparkSession, "feeds") + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form revenue: one row per line item, typed like the weekly feed."""
    return _revenue_rows(spark, sf_dir).drop("_key")


def revenue_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week-24 feed: rows that came late are missing, some amounts were corrected since, and
    some rows were booked on a wrong account and withdrawn since."""
    return _week_before(_revenue_rows(spark, sf_dir))


def revenue_weeks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The feeds of weeks 24 and 25 (`revenue_prev`, `revenue`) from one stored join."""
    rows = _stored(_revenue_rows(spark, sf_dir))
    return _week_before(rows), rows.drop("_key")


def _week_before(rows: DataFrame) -> DataFrame:
    key, amount = F.col("_key"), F.col("Revenue")
    before = F.when(key % 17 == 0, scale_money(amount, "0.9").cast(MONEY)).otherwise(amount)
    kept = rows.where(key % 13 != 0).withColumn("Revenue", before)
    wrong = rows.where(key % 23 == 0).withColumn("StoreNo", F.lit(WRONG_ACCOUNT))
    return kept.unionByName(wrong).drop("_key")


def _usage_text(amount: Column) -> Column:
    return F.format_number(amount, 2)


def _opportunity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week-25 snapshot plus the numeric key ``_key`` used by the week-24 rules."""
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority")
    key = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    product = (F.when(prio == LOW_PRIORITY,
                      F.when(key % 2 == 0, F.lit(NULL_TEXT)))
                .otherwise(lookup(prio, PRIORITY_TO_PRODUCT)))
    amount = _usage_text(F.col("o_totalprice").cast(MONEY))
    usage = (F.when(key % 17 == 0, F.lit(NULL_TEXT))
              .when(key % 10 == 0, F.concat(F.lit("-"), amount))
              .otherwise(amount))
    status = (F.when(key % 19 == 0, F.lit(None).cast("string"))
               .when(F.col("o_orderstatus") == "F", F.lit("Inactive"))
               .otherwise(F.lit("Active")))
    return o.select(
        key.alias("_key"),
        account_code("o_custkey").alias("Store_No"),
        F.to_date("o_orderdate").alias("Opportunity_Est_Date"),
        product.alias("Product"),
        key.cast("string").alias("Opportunity_ID"),
        F.concat(F.lit("Opportunity "), key.cast("string")).alias("Opportunity_Name"),
        status.alias("Project_Status"),
        F.col("o_orderstatus").alias("Opportunity_Status"),
        prio.alias("Opportunity_Stage"),
        usage.alias("Opportunity_Usage"))


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunity snapshot of week 25 (one row per order)."""
    return _opportunity_rows(spark, sf_dir).drop("_key")


def opportunities_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week-24 snapshot: older amounts/dates, minus new ids, plus dropped ids."""
    rows = _opportunity_rows(spark, sf_dir)
    key = F.col("_key")
    usage = F.col("Opportunity_Usage")
    scaled = scale_money(parse_amount(usage, MONEY), "0.9")
    kept = (rows.filter(key % 13 != 0)
            .withColumns({
                "Opportunity_Usage": F.when((key % 7 == 0) & (usage != NULL_TEXT),
                                            _usage_text(scaled)).otherwise(usage),
                "Opportunity_Est_Date": F.when(key % 11 == 0,
                                               F.date_sub("Opportunity_Est_Date", 30))
                                         .otherwise(F.col("Opportunity_Est_Date")),
            }))
    copies = (rows.filter(key % 23 == 0)
              .withColumn("Opportunity_ID", (key + COPY_ID_OFFSET).cast("string")))
    return kept.unionByName(copies).drop("_key")


def opportunities_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week 25 as a feed that nobody has looked through: some amounts are no numbers, too large or too fine."""
    key, usage = F.col("_key"), F.col("Opportunity_Usage")
    bad = (F.when(key % 97 == 0, F.lit("n/a")).when(key % 89 == 0, F.lit("1e60"))
            .when(key % 83 == 0, F.lit("1,234.5600001")).otherwise(usage))
    return _opportunity_rows(spark, sf_dir).withColumn("Opportunity_Usage", bad).drop("_key")


def revenue_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The week-25 revenue feed as text, with amounts and months that aren't ones."""
    key = F.col("_key")
    amount = (F.when(key % 97 == 0, F.lit("n/a")).when(key % 89 == 0, F.lit("12.345"))
               .when(key % 83 == 0, F.lit("1e30")).otherwise(F.col("Revenue").cast("string")))
    month = F.when(key % 79 == 0, F.lit("2001-13-01")).otherwise(F.col("Month").cast("string"))
    return _revenue_rows(spark, sf_dir).withColumns({"Revenue": amount, "Month": month}).drop("_key")


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly targets per account and category for one fiscal year."""
    o = (_table(spark, sf_dir, "orders")
         .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
         .filter((F.col("o_orderdate") >= _ts(TARGET_FROM))
                 & (F.col("o_orderdate") < _ts(TARGET_UNTIL))))
    return (o.groupBy(
                account_code("o_custkey").alias("Store_Number"),
                lookup(F.col("o_orderkey") % 3, TARGET_CATEGORY_BY_MOD3).alias("Product_Category"),
                F.trunc(F.to_date("o_orderdate"), "month").alias("Fiscal_Month"))
             .agg(F.sum(F.col("o_totalprice").cast(MONEY)).cast(MONEY).alias("Target")))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region have a fixed size (25 and 5 rows) at every scale factor.
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return j.select(
        account_code("c_custkey").alias("AccountNo"),
        F.col("c_name").alias("Store"),
        F.col("c_mktsegment").alias("Industry"),
        F.col("r_name").alias("Vertical"),
        F.col("n_name").alias("Segment"),
        F.concat(F.lit("m"), (F.col("c_custkey") % 8).cast("string")).alias("Store_Manager_Alias"),
        F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No").alias("Potential_Account"),
        F.concat(F.lit("v"), F.col("n_regionkey").cast("string")).alias("Vertical_Manager_Alias"))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seller lookup; every fifth customer is missing on purpose."""
    c = (_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
         .filter(F.col("c_custkey") % 5 != 0))
    k = F.col("c_custkey")

    def code(prefix: str, mod: int) -> Column:
        return F.concat(F.lit(prefix), (k % mod).cast("string"))

    return c.select(
        account_code(k).alias("Store_ID"),
        F.col("c_name").alias("Company"),
        code("g", 8).alias("General_Seller"),
        code("s", 68).alias("Services_Seller"),
        code("u", 30).alias("Support_Seller"),
        code("p", 10).alias("Product_Seller"))


def load(spark: SparkSession, sf_dir: str, with_prev: bool = False) -> Inputs:
    return Inputs(
        revenue=revenue(spark, sf_dir),
        opportunities=opportunities(spark, sf_dir),
        targets=targets(spark, sf_dir),
        calendar=calendar(spark),
        accounts=accounts(spark, sf_dir),
        sellers=sellers(spark, sf_dir),
        opportunities_prev=opportunities_prev(spark, sf_dir) if with_prev else None,
    )
