"""Cleaning pipelines: revenue (P1, P2), opportunities (P3), targets.

Each transactional feed is aggregated to its planning grain *before* any
join: the partial (map-side) aggregation absorbs hot accounts, and every
later join sees at most one row per key and input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators.fiscal import Calendar, to_fiscal_month
from planmart.options import DEFAULT, PlanOptions

KEYS = ("Account_No", "Fiscal_Month", "Product_Category")
REVENUE_MEASURES = ("Revenue", "Partner_Fee", "Registration_Fee")


def split_measures(revenue: DataFrame, opts: PlanOptions = DEFAULT,
                   with_activity: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Rename, map the category and split the measure by revenue type (row level); `keep` columns stay."""
    activity = [(F.col("Revenue") != 0).alias("_nz")] if with_activity else []
    return revenue.select(
        F.col("StoreNo").alias("Account_No"),
        F.col("Month").alias("Fiscal_Month"),
        "Revenue_Type", "Revenue_Motion",
        "Product_Category",
        F.col("Motion").alias("Account_Motion"),
        R.categorise("Product_Category", R.REVENUE_CATEGORY_RULES, opts.collation)
         .alias("Product_Category_2"),
        R.measure_split("Revenue_Type", "Revenue", R.ACTUALS, opts.collation).alias("Revenue_Actuals"),
        R.measure_split("Revenue_Type", "Revenue", R.PARTNER_FEE, opts.collation).alias("Partner_Fee"),
        R.measure_split("Revenue_Type", "Revenue", R.REGISTRATION_FEE, opts.collation)
         .alias("Registration_Fee"),
        *activity, *keep)


def clean_revenue(revenue: DataFrame, opts: PlanOptions = DEFAULT,
                  with_activity: bool = False) -> DataFrame:
    """SUM of the three measures by account, month date and mapped category.

    ``with_activity`` adds ``_nonzero`` (some raw row has Revenue <> 0), from
    which the cutoff month can be read without another pass over the feed.
    """
    rows = split_measures(revenue, opts, with_activity)
    aggs = [F.sum("Revenue_Actuals").alias("Revenue"),
            F.sum("Partner_Fee").alias("Partner_Fee"),
            F.sum("Registration_Fee").alias("Registration_Fee")]
    if with_activity:
        aggs.append(F.max("_nz").alias("_nonzero"))
    return (rows.groupBy("Account_No", "Fiscal_Month",
                         F.col("Product_Category_2").alias("Product_Category"))
            .agg(*aggs))


def revenue_by_fiscal_month(p1: DataFrame, cal: Calendar) -> DataFrame:
    """Month date → fiscal month name (LEFT JOIN on the calendar)."""
    dated = p1.withColumnRenamed("Fiscal_Month", "_month_date")
    out = to_fiscal_month(dated, cal, "_month_date")
    return out.select(*KEYS, *REVENUE_MEASURES)


def _status_ok(opts: PlanOptions) -> Column:
    return R.collated("Project_Status", opts.collation) != R.INACTIVE


def _parsed_usage(opts: PlanOptions) -> Column:
    raw = F.col("Opportunity_Usage")
    parsed = R.parse_amount(raw)
    if opts.on_bad == "fail":
        issue = R.amount_issue(raw)
        parsed = F.when(issue.isNotNull(),
                        F.raise_error(F.concat(issue, F.lit(" Opportunity_Usage: "), raw))
                        .cast(R.AMOUNT)).otherwise(parsed)
    return parsed


def opportunity_rows(opps: DataFrame, drop_inactive: bool = True,
                     opts: PlanOptions = DEFAULT, rules=R.OPPORTUNITY_CATEGORY_RULES) -> DataFrame:
    """Filtered, categorised opportunity rows with the amount parsed (row level)."""
    cond = (R.is_present("Product", opts.collation)
            & (R.collated("Opportunity_Usage", opts.collation) != R.NULL_TEXT))
    if drop_inactive:
        cond = cond & _status_ok(opts)
    return (opps.filter(cond)
            .select(F.col("Store_No").alias("Account_No"),
                    "Opportunity_Est_Date", "Product",
                    R.categorise("Product", rules, opts.collation).alias("Product_Category"),
                    "Opportunity_ID", "Opportunity_Name", "Project_Status",
                    "Opportunity_Status", "Opportunity_Stage",
                    _parsed_usage(opts).alias("Opportunity_Usage")))


def with_extrapolation(df: DataFrame, include_current: bool = False,
                       opts: PlanOptions = DEFAULT) -> DataFrame:
    months = R.months_left("Fiscal_Month", include_current, opts.collation)
    return (df.withColumn("Extrap_Month_Left_For_FY", months)
              .withColumn("Opportunity_Extrapolation",
                          R.extrapolate("Opportunity_Usage", "Extrap_Month_Left_For_FY")))


def clean_opportunity(opps: DataFrame, cal: Calendar, opts: PlanOptions = DEFAULT,
                      drop_inactive: bool = True) -> DataFrame:
    """Usage by account, category and fiscal month, with extrapolation to FY end."""
    rows = opportunity_rows(opps, drop_inactive, opts)
    dated = to_fiscal_month(rows.select("Account_No", "Product_Category",
                                        "Opportunity_Est_Date", "Opportunity_Usage"),
                            cal, "Opportunity_Est_Date")
    summed = (dated.groupBy("Account_No", "Product_Category", "Fiscal_Month")
              .agg(F.sum("Opportunity_Usage").alias("Opportunity_Usage")))
    return with_extrapolation(summed, include_current=False, opts=opts)


def targets_by_fiscal_month(targets: DataFrame, cal: Calendar) -> DataFrame:
    """Targets with their month date mapped to the fiscal month name."""
    t = targets.select(F.col("Store_Number").alias("Account_No"), "Product_Category",
                       F.col("Fiscal_Month").alias("_month_date"), "Target")
    return to_fiscal_month(t, cal, "_month_date").select(
        "Account_No", "Product_Category", "Fiscal_Month", "Target")
