"""Registered queries: one per operator / pipeline of the blueprint.

Each entry takes ``(spark, sf_dir)``, derives the planning inputs from the
driver tables in ``sf_dir`` and returns a lazy DataFrame whose money columns
are published as double.  Column names match ``planmart.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators import joins
from planmart.operators.fiscal import to_fiscal_month
from planmart.options import PlanOptions
from planmart.plans import clean, insights, marts, quality, refresh
from planmart.plans.clean import KEYS
from planmart.plans.planning import Plan
from planmart.session import shared_dir
from planmart.sources import adapters, readers, rejects, schemas
from planmart.sources.store import MartStore

Query = Callable[[SparkSession, str], DataFrame]

# The manual month list of the worksheet's "option 1" (its five future months).
FUTURE_MONTHS_LIST = ("February, 2001", "March, 2001", "April, 2001", "May, 2001", "June, 2001")


def plan_for(spark: SparkSession, sf_dir: str, with_prev: bool = False, **opts) -> Plan:
    return Plan(adapters.load(spark, sf_dir, with_prev), PlanOptions(**opts))


def _published(fn: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return readers.money_as_double(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = _published(fn)
        return fn
    return deco


# -- sources and sinks (A1-A6) -------------------------------------------------
@query("scan_preview")
def scan_preview(spark, sf_dir):
    """A2-A4: USE the database that holds the lookup tables, scan one, TOP 10 ordered by key.

    The account lookup is a table of two databases: week 24's has no account ending in 0.  The
    name has no database in it, so USE decides which of them is read.
    """
    accounts = adapters.accounts(spark, sf_dir)
    readers.save_table(accounts, "planmart_wk25", "Account_Lookup")
    readers.save_table(accounts.where(~F.col("AccountNo").endswith("0")), "planmart_wk24", "Account_Lookup")
    before = spark.catalog.currentDatabase()
    readers.use_database(spark, "planmart_wk25")
    try:
        return readers.preview(readers.scan(spark, "Account_Lookup"), 10, "AccountNo")
    finally:
        readers.use_database(spark, before)


@query("csv_ingest")
def csv_ingest(spark, sf_dir):
    """A1: seller lookup written as CSV (spaced headers, CRLF) and read back typed."""
    path = shared_dir(spark, "csv_ingest")
    readers.write_csv_table(adapters.sellers(spark, sf_dir), path, schemas.SELLERS_FILE_COLUMNS)
    return readers.read_sellers_csv(spark, path)


def _ingested(spark, sf_dir) -> rejects.Ingest:
    path = shared_dir(spark, "csv_rejects")
    readers.write_csv_table(adapters.revenue_dirty(spark, sf_dir), path)
    return rejects.ingest_csv(spark, path, schemas.REVENUE, max_share=0.2)


@query("csv_accepted")
def csv_accepted(spark, sf_dir):
    """A1: the typed rows of a revenue file with bad lines."""
    return _ingested(spark, sf_dir).rows


@query("csv_rejects")
def csv_rejects(spark, sf_dir):
    """Q2: its rejected lines, with column and reason."""
    return _ingested(spark, sf_dir).rejects.drop("file")


@query("publish_view")
def publish_view(spark, sf_dir):
    """Publish the revenue summary as a lasting view over a new version, then one
    year of it from the catalog.

    The mart's rows are the widest of the plan, so they aren't shuffled: tasks write what they made.
    """
    store = MartStore(spark, shared_dir(spark, "marts"), "planmart_publish_view")
    with plan_for(spark, sf_dir).stored() as plan:
        store.publish(marts.revenue_summary(plan), "revenue_summary", ("Fiscal_Year",), rebalance=False)
    return spark.table("planmart_publish_view.revenue_summary").filter(F.col("Fiscal_Year") == "FY2001")


# -- projections, rules, filters (B1-B20) --------------------------------------
@query("rename_project")
def rename_project(spark, sf_dir):
    r = adapters.revenue(spark, sf_dir)
    return r.select(F.col("StoreNo").alias("Account_No"), F.col("Month").alias("Fiscal_Month"),
                    "Revenue_Type", "Revenue_Motion", "Product_Category",
                    F.col("Motion").alias("Account_Motion"), "Revenue")


@query("measure_split")
def measure_split(spark, sf_dir):
    rows = clean.split_measures(adapters.revenue(spark, sf_dir))
    return rows.select("Account_No", "Fiscal_Month", "Revenue_Type", "Revenue_Motion",
                       "Product_Category", "Account_Motion",
                       F.col("Revenue_Actuals").alias("Revenue"), "Partner_Fee", "Registration_Fee")


@query("category_map_revenue")
def category_map_revenue(spark, sf_dir):
    rows = clean.split_measures(adapters.revenue(spark, sf_dir))
    return rows.select("Account_No", "Fiscal_Month", "Revenue_Type", "Product_Category",
                       "Product_Category_2", F.col("Revenue_Actuals").alias("Revenue"),
                       "Partner_Fee", "Registration_Fee")


def _opportunity_text_rows(spark, sf_dir, rules=R.OPPORTUNITY_CATEGORY_RULES) -> DataFrame:
    o = adapters.opportunities(spark, sf_dir).filter(R.is_present("Product"))
    return o.select(F.col("Store_No").alias("Account_No"), "Opportunity_Est_Date", "Product",
                    R.categorise("Product", rules).alias("Product_Category"),
                    "Opportunity_ID", "Opportunity_Name", "Project_Status",
                    "Opportunity_Status", "Opportunity_Stage", "Opportunity_Usage")


@query("category_map_opportunity")
def category_map_opportunity(spark, sf_dir):
    return _opportunity_text_rows(spark, sf_dir)


@query("sentinel_filter")
def sentinel_filter(spark, sf_dir):
    o = adapters.opportunities(spark, sf_dir)
    return o.filter(R.is_present("Product") & (F.col("Opportunity_Usage") != R.NULL_TEXT))


@query("status_filter")
def status_filter(spark, sf_dir):
    o = adapters.opportunities(spark, sf_dir)
    return o.filter(F.col("Project_Status") != R.INACTIVE)


def _opportunity_months(spark, sf_dir) -> DataFrame:
    p = plan_for(spark, sf_dir)
    dated = to_fiscal_month(p.inputs.opportunities.select("Opportunity_Est_Date"),
                            p.cal, "Opportunity_Est_Date")
    return dated.select("Fiscal_Month").distinct()


@query("months_left")
def months_left(spark, sf_dir):
    return _opportunity_months(spark, sf_dir).select(
        "Fiscal_Month", R.months_left("Fiscal_Month").alias("Extrap_Month_Left_For_FY"))


@query("months_left_incl")
def months_left_incl(spark, sf_dir):
    return _opportunity_months(spark, sf_dir).select(
        "Fiscal_Month", R.months_left("Fiscal_Month", True).alias("Extrap_Month_Left_For_FY"))


def _dated_rows(spark, sf_dir) -> DataFrame:
    p = plan_for(spark, sf_dir)
    rows = clean.opportunity_rows(p.inputs.opportunities, False)
    return to_fiscal_month(rows, p.cal, "Opportunity_Est_Date", keep_date=True)


@query("extrapolation_clamp")
def extrapolation_clamp(spark, sf_dir):
    rows = _dated_rows(spark, sf_dir).select("Opportunity_ID", "Fiscal_Month", "Opportunity_Usage")
    return clean.with_extrapolation(rows)


@query("negative_clamp")
def negative_clamp(spark, sf_dir):
    rows = _dated_rows(spark, sf_dir)
    return rows.select("Opportunity_ID", "Opportunity_Usage",
                       R.clamp_negative("Opportunity_Usage").alias("Opportunities_Into_RR"))


@query("value_bands")
def value_bands(spark, sf_dir):
    d = marts.opportunity_detail(plan_for(spark, sf_dir))
    return d.select("Opportunity_ID", "Fiscal_Month", "Opportunity_Usage",
                    R.value_band("Opportunity_Usage").alias("Opportunity_Usage_Range"),
                    "Opportunity_Extrapolation",
                    R.value_band("Opportunity_Extrapolation").alias("Opportunity_Extrapolation_Range"))


@query("month_in_list")
def month_in_list(spark, sf_dir):
    p12 = plan_for(spark, sf_dir).all_transactional()
    return p12.filter(F.col("Fiscal_Month").isin(*FUTURE_MONTHS_LIST))


@query("parse_amount_sum")
def parse_amount_sum(spark, sf_dir):
    """G2 with Inactive kept: SUM of parsed text amounts by three keys."""
    p = plan_for(spark, sf_dir)
    rows = clean.opportunity_rows(p.inputs.opportunities, drop_inactive=False)
    dated = to_fiscal_month(rows, p.cal, "Opportunity_Est_Date")
    return (dated.groupBy("Account_No", "Product_Category", "Fiscal_Month")
            .agg(F.sum("Opportunity_Usage").alias("Opportunity_Usage")))


# -- joins (J1-J9) ---------------------------------------------------------------
@query("left_date_lookup")
def left_date_lookup(spark, sf_dir):
    return _dated_rows(spark, sf_dir).select("Opportunity_ID", "Opportunity_Est_Date", "Fiscal_Month")


@query("left_wide_calendar")
def left_wide_calendar(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    rows = clean.opportunity_rows(p.inputs.opportunities, True).select(
        "Opportunity_ID", "Opportunity_Est_Date")
    return to_fiscal_month(rows, p.cal, "Opportunity_Est_Date", keep_date=True, wide=True)


@query("cross_future_months")
def cross_future_months(spark, sf_dir):
    return plan_for(spark, sf_dir).spread_origins(all_months=True)


@query("theta_month_join")
def theta_month_join(spark, sf_dir):
    return plan_for(spark, sf_dir).spread_origins()


@query("left_next_month")
def left_next_month(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    spread = p.spread_origins().withColumn("Est_Month_Id", F.col("Future_Month_ID") + 1)
    months = p.cal.months().select(F.col("Month_ID").alias("_id"),
                                   F.col("Fiscal_Month").alias("Est_Fiscal_Month"))
    return (spread.join(months, spread["Est_Month_Id"] == months["_id"], "left")
            .select("Account_No", "Product_Category", "Fiscal_Month", "Est_Month_Id",
                    "Est_Fiscal_Month", "Opportunity_Usage"))


@query("lookup_calendar")
def lookup_calendar(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    return joins.left_lookup(p.p2, p.cal.month_dim(), "Fiscal_Month", "Fiscal_Month",
                       marts.MONTH_ATTRS)


@query("lookup_account")
def lookup_account(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    acc = p.inputs.accounts.withColumnRenamed("Store", "Account_Name")
    return joins.left_lookup(p.p2, acc, "Account_No", "AccountNo", marts.ACCOUNT_ATTRS)


@query("lookup_seller")
def lookup_seller(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    return joins.left_lookup(p.p2, p.inputs.sellers, "Account_No", "Store_ID",
                       marts.SELLER_ATTRS)


@query("full_outer_coalesce")
def full_outer_coalesce(spark, sf_dir):
    """J7 on revenue ⟗ targets: coalesced keys, zero-filled measures."""
    p = plan_for(spark, sf_dir)
    return joins.full_outer_repeating(p.p2, p.p8, KEYS, clean.REVENUE_MEASURES, ("Target",))


# -- aggregation, distinct, subqueries (G, U) --------------------------------------
@query("sum_three_keys")
def sum_three_keys(spark, sf_dir):
    """G1 at the fiscal-month grain (re-aggregates dates of one month)."""
    p2 = plan_for(spark, sf_dir).p2
    return p2.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in clean.REVENUE_MEASURES])


@query("sum_four_keys")
def sum_four_keys(spark, sf_dir):
    return plan_for(spark, sf_dir).run_rate_origins()


@query("sum_nine_keys")
def sum_nine_keys(spark, sf_dir):
    d = marts.opportunity_detail(plan_for(spark, sf_dir))
    return d.select(*marts.OPPORTUNITY_DETAIL, "Opportunity_Usage")


@query("distinct_months")
def distinct_months(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    rows = p.inputs.opportunities.select("Opportunity_Est_Date")
    dated = to_fiscal_month(rows, p.cal, "Opportunity_Est_Date", wide=True)
    return dated.select("Fiscal_Month", "Month_ID").distinct()


@query("distinct_categories")
def distinct_categories(spark, sf_dir):
    return adapters.revenue(spark, sf_dir).select("Product_Category").distinct()


@query("scalar_cutoff")
def scalar_cutoff(spark, sf_dir):
    p = plan_for(spark, sf_dir)
    return p.ctx.as_frame().select("Cutoff_Date")


@query("fiscal_context")
def fiscal_context(spark, sf_dir):
    return plan_for(spark, sf_dir).ctx.as_frame()


# -- pipelines (P1-P14) --------------------------------------------------------------
@query("clean_revenue")
def clean_revenue(spark, sf_dir):
    return plan_for(spark, sf_dir).p1


@query("revenue_by_fiscal_month")
def revenue_by_fiscal_month(spark, sf_dir):
    return plan_for(spark, sf_dir).p2


@query("clean_opportunity")
def clean_opportunity(spark, sf_dir):
    return plan_for(spark, sf_dir).p3


@query("future_months")
def future_months(spark, sf_dir):
    return plan_for(spark, sf_dir).future_months()


@query("revenue_opportunity")
def revenue_opportunity(spark, sf_dir):
    return plan_for(spark, sf_dir).revenue_opportunity()


@query("baseline")
def baseline(spark, sf_dir):
    return plan_for(spark, sf_dir).baseline()


@query("targets_by_fiscal_month")
def targets_by_fiscal_month(spark, sf_dir):
    return plan_for(spark, sf_dir).p8


@query("baseline_target")
def baseline_target(spark, sf_dir):
    return plan_for(spark, sf_dir).baseline_target()


@query("run_rate_origin")
def run_rate_origin(spark, sf_dir):
    return plan_for(spark, sf_dir).run_rate("origin")


@query("run_rate_summed")
def run_rate_summed(spark, sf_dir):
    return plan_for(spark, sf_dir).run_rate("summed")


@query("run_rate_clipped")
def run_rate_clipped(spark, sf_dir):
    return plan_for(spark, sf_dir, clip_to_fy=True).run_rate("origin")


@query("baseline_target_run_rate")
def baseline_target_run_rate(spark, sf_dir):
    return plan_for(spark, sf_dir).baseline_target_run_rate()


@query("all_transactional")
def all_transactional(spark, sf_dir):
    return plan_for(spark, sf_dir).all_transactional()


@query("all_transactional_union")
def all_transactional_union(spark, sf_dir):
    return plan_for(spark, sf_dir).all_transactional("summed", "union")


@query("revenue_summary")
def revenue_summary(spark, sf_dir):
    return marts.revenue_summary(plan_for(spark, sf_dir))


@query("revenue_summary_summed")
def revenue_summary_summed(spark, sf_dir):
    return marts.revenue_summary(plan_for(spark, sf_dir), "summed", "union")


@query("opportunity_summary")
def opportunity_summary(spark, sf_dir):
    return marts.opportunity_summary(plan_for(spark, sf_dir))


@query("opportunity_summary_compat")
def opportunity_summary_compat(spark, sf_dir):
    return marts.opportunity_summary(plan_for(spark, sf_dir), compat_aliases=True)


# -- insights (O1-O11) -----------------------------------------------------------------
@query("revenue_trend")
def revenue_trend(spark, sf_dir):
    return insights.revenue_trend(plan_for(spark, sf_dir))


@query("fee_trend")
def fee_trend(spark, sf_dir):
    return insights.fee_trend(plan_for(spark, sf_dir))


@query("revenue_vs_target")
def revenue_vs_target(spark, sf_dir):
    return insights.revenue_vs_target(plan_for(spark, sf_dir))


@query("forecast_year_end")
def forecast_year_end(spark, sf_dir):
    return insights.forecast_year_end(plan_for(spark, sf_dir))


@query("baseline_avg3")
def baseline_avg3(spark, sf_dir):
    return plan_for(spark, sf_dir).baseline_avg(3)


@query("baseline_avg6")
def baseline_avg6(spark, sf_dir):
    return plan_for(spark, sf_dir).baseline_avg(6)


@query("slice_rollup")
def slice_rollup(spark, sf_dir):
    return insights.slice_facts(plan_for(spark, sf_dir),
                                ["Fiscal_Year", "Product_Category", "Vertical"],
                                ["Revenue", "Baseline", "Target", "Opportunities_Into_RR"], "rollup")


@query("slice_cube")
def slice_cube(spark, sf_dir):
    return insights.slice_facts(plan_for(spark, sf_dir), ["Product_Category", "Industry"],
                                ["Revenue", "Opportunity_Usage"], "cube")


@query("wow_tracking")
def wow_tracking(spark, sf_dir):
    return insights.wow_tracking(adapters.opportunities_prev(spark, sf_dir),
                                 adapters.opportunities(spark, sf_dir))


@query("wow_fields")
def wow_fields(spark, sf_dir):
    return insights.wow_fields([(24, adapters.opportunities_prev(spark, sf_dir)),
                                (25, adapters.opportunities(spark, sf_dir))])


# -- weekly refresh ------------------------------------------------------------------------
def _refreshed(spark, sf_dir, database: str) -> refresh.RevenueRefresh:
    """The revenue aggregate of week 24, brought to week 25 by the rows that differ."""
    kept = refresh.RevenueRefresh(MartStore(spark, shared_dir(spark, database), database))
    before, now = adapters.revenue_weeks(spark, sf_dir)
    kept.start(before, 24)
    kept.apply(refresh.row_changes(before, now), 25)
    return kept


@query("clean_revenue_refresh")
def clean_revenue_refresh(spark, sf_dir):
    """P1 of week 25 from week 24's aggregate and the signed changes between the two feeds."""
    return _refreshed(spark, sf_dir, "planmart_refresh").p1().drop("_nonzero")


@query("baseline_target_refresh")
def baseline_target_refresh(spark, sf_dir):
    """P9 on the maintained aggregate: cutoff and baseline without the revenue feed."""
    p1 = _refreshed(spark, sf_dir, "planmart_refresh_baseline").p1()
    return Plan(adapters.load(spark, sf_dir), p1=p1).baseline_target()


# -- data quality (Q1-Q5) ------------------------------------------------------------------
@query("audit_unmapped")
def audit_unmapped(spark, sf_dir):
    return quality.audit_unmapped(plan_for(spark, sf_dir))


@query("audit_unmapped_v1")
def audit_unmapped_v1(spark, sf_dir):
    return quality.unmapped_rows(plan_for(spark, sf_dir))


@query("audit_parse")
def audit_parse(spark, sf_dir):
    dirty = replace(adapters.load(spark, sf_dir), opportunities=adapters.opportunities_dirty(spark, sf_dir))
    return quality.audit_parse(Plan(dirty))


@query("audit_category_coverage")
def audit_category_coverage(spark, sf_dir):
    return quality.audit_category_coverage(plan_for(spark, sf_dir))


@query("audit_key_uniqueness")
def audit_key_uniqueness(spark, sf_dir):
    return quality.audit_key_uniqueness(plan_for(spark, sf_dir))


@query("row_ledger")
def row_ledger(spark, sf_dir):
    return quality.row_ledger(plan_for(spark, sf_dir))


# -- streaming ---------------------------------------------------------------------------
@query("wow_stream")
def wow_stream(spark, sf_dir):
    """O10 as a stream: weeks 24 and 25 land as files, a Structured Streaming
    query tracks the changes; returns the tracked changes of week 25."""
    from planmart.streaming import snapshots
    landing, out = shared_dir(spark, "wow_landing"), shared_dir(spark, "wow_out")
    snapshots.write_snapshot(adapters.opportunities_prev(spark, sf_dir), landing, 24)
    snapshots.write_snapshot(adapters.opportunities(spark, sf_dir), landing, 25)
    snapshots.start_wow_stream(spark, landing, out, buckets=16).awaitTermination()
    return snapshots.read_changes(spark, out).filter(F.col("Week") == 25)
