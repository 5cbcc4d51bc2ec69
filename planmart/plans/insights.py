"""Dashboard data: trends, revenue vs target, forecast, slicing, week-on-week.

These answer the worksheet's stated objectives that had no query of their
own (they lived in the dashboards).  All of them run on the summed grain so
nothing is double counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators.joins import WIDE_MONEY, left_lookup, union_combine
from planmart.plans import marts
from planmart.plans.clean import KEYS
from planmart.plans.planning import Plan

MONTH_KEYS = ("Fiscal_Year", "Month_ID", "Fiscal_Month")


def _monthly(plan: Plan, df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Sum ``measures`` by fiscal month, with year and Month_ID attached."""
    by_month = df.groupBy("Fiscal_Month").agg(*[F.sum(m).alias(m) for m in measures])
    months = plan.cal.month_dim().select("Fiscal_Month", "Fiscal_Year", "Month_ID")
    return by_month.join(months, "Fiscal_Month", "left").select(*MONTH_KEYS, *measures)


def _with_previous(monthly: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Attach the calendar-previous month's values and the month-on-month change.

    One pass: each month also goes to the month after it as a previous value,
    and the two meet in a grouping by month.  Months that only got a previous
    value have no row of their own and go; rows outside the calendar have no
    month after them.
    """
    shifted = F.array(F.lit(0), F.when(F.col("Month_ID").isNotNull(), F.lit(1)))
    both = monthly.withColumn("_all", F.array_compact(shifted)).withColumn("_step", F.explode("_all"))
    own = F.col("_step") == 0
    rows = both.select((F.col("Month_ID") + F.col("_step")).alias("_month"), own.alias("_own"),
                       *[F.when(own, F.col(k)).alias(k) for k in MONTH_KEYS],
                       *[F.when(own, F.col(m)).alias(m) for m in measures],
                       *[F.when(~own, F.col(m)).alias(f"{m}_Prev") for m in measures])
    out = (rows.groupBy("_month").agg(
        F.max("_own").alias("_own"), *[F.max(k).alias(k) for k in MONTH_KEYS],
        *[F.max(c).alias(c) for m in measures for c in (m, f"{m}_Prev")]).where("_own"))
    return out.select(*MONTH_KEYS, *[c for m in measures for c in (
        F.col(m), F.col(f"{m}_Prev"), (F.col(m) - F.col(f"{m}_Prev")).alias(f"{m}_Change"))])


def revenue_trend(plan: Plan) -> DataFrame:
    """O1: revenue per fiscal month and its month-on-month change."""
    return _with_previous(_monthly(plan, plan.p2, ["Revenue"]), ["Revenue"])


def fee_trend(plan: Plan) -> DataFrame:
    """O2: partner and registration fees per fiscal month, with changes."""
    ms = ["Partner_Fee", "Registration_Fee"]
    return _with_previous(_monthly(plan, plan.p2, ms), ms)


def _ratio(num: str, den: str) -> Column:
    d = F.col(den).cast("double")
    return F.when(d != 0, F.col(num).cast("double") / d)


def revenue_vs_target(plan: Plan) -> DataFrame:
    """O3: actual (Revenue + Partner_Fee) vs target by month and category."""
    keys = ("Fiscal_Month", "Product_Category")
    actual = plan.p2.select(*keys, (F.col("Revenue") + F.col("Partner_Fee")).alias("Actual"))
    merged = union_combine([(actual, ("Actual",)), (plan.p8, ("Target",))], keys)
    return merged.select(*keys, "Actual", "Target",
                         (F.col("Actual") - F.col("Target")).alias("Gap"),
                         _ratio("Actual", "Target").alias("Attainment"))


def forecast_year_end(plan: Plan) -> DataFrame:
    """Actuals up to the cutoff month, then baseline + opportunities + run rate.

    Only the cutoff's fiscal year is read, and the facts are added up by month
    at once; the running total is a window per fiscal year (at most twelve
    rows each).
    """
    year = (plan.cal.month_dim().filter(F.col("Fiscal_Year") == plan.ctx.fiscal_year)
            .select(*MONTH_KEYS))
    by_month = plan.facts_by_month()
    zero = F.lit(0).cast("decimal(38,6)")
    joined = year.join(by_month, "Fiscal_Month", "left").select(
        *MONTH_KEYS,
        F.coalesce("Actual", zero).alias("Actual"),
        F.coalesce("Projected", zero).alias("Projected"))
    forecast = F.when(F.col("Month_ID") <= plan.ctx.month_id, F.col("Actual")) \
                .otherwise(F.col("Projected"))
    w = (Window.partitionBy("Fiscal_Year").orderBy("Month_ID")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (joined.withColumn("Forecast", forecast)
            .withColumn("Cumulative_Forecast", F.sum("Forecast").over(w)))


def slice_facts(plan: Plan, dims: Sequence[str], measures: Sequence[str],
                mode: str = "rollup") -> DataFrame:
    """Slice the summed revenue summary by any of its dimensions.

    ``mode`` is ``groupby``, ``rollup`` or ``cube``; ``Grouping_Level`` is the
    SQL grouping id of each subtotal row.

    Only inputs that hold one of ``measures`` are read.  They are added up below the
    lookups, by account, category and the month attributes that are asked for (the
    month lookup has a row per fiscal month), so account and seller attributes are
    looked up once for each of those sums, and only the columns in ``dims``.
    """
    known = (*KEYS, *marts.MONTH_ATTRS, *marts.ACCOUNT_ATTRS, *marts.SELLER_ATTRS)
    unknown = [d for d in dims if d not in known]
    if unknown:
        raise ValueError(f"no dimensions of the marts: {unknown}")
    by_account = [d for d in dims if d in (*marts.ACCOUNT_ATTRS, *marts.SELLER_ATTRS)]
    by_month = [d for d in dims if d in marts.MONTH_ATTRS]
    keys = [k for k in KEYS if k in dims or (k == "Account_No" and by_account) or (k == "Fiscal_Month" and by_month)]
    zero = F.lit(0).cast(WIDE_MONEY)
    rows = reduce(DataFrame.unionByName, [
        df.select(*keys, *[(F.col(m).cast(WIDE_MONEY) if m in held else zero).alias(m) for m in measures])
        for df, held in plan.facts_with(measures)])
    if by_month:
        rows = left_lookup(rows, plan.cal.month_dim(), "Fiscal_Month", "Fiscal_Month", by_month)
    below = [*[k for k in keys if k != "Fiscal_Month" or k in dims], *by_month]
    summed = rows.groupBy(*below).agg(*[F.coalesce(F.sum(m), zero).alias(m) for m in measures])
    if by_account:
        summed = marts.account_lookup(summed, plan, by_account)
    grouped = {"groupby": summed.groupBy, "rollup": summed.rollup, "cube": summed.cube}[mode](*dims)
    aggs = [F.sum(m).alias(m) for m in measures]
    if mode != "groupby":
        aggs.append(F.grouping_id(*dims).cast("int").alias("Grouping_Level"))
    return grouped.agg(*aggs)


# -- week-on-week opportunity tracking (O10, O11) -----------------------------

WOW_FIELDS = ("Opportunity_Usage", "Opportunity_Est_Date", "Opportunity_Stage",
              "Opportunity_Status", "Project_Status")


WOW_KEYS = ("Opportunity_ID", "Product")


def snapshot_by_id(snapshot: DataFrame, *also: str) -> DataFrame:
    """One row per Opportunity_ID and Product (and `also`): amounts added up, the other fields of the latest row.

    Rows without an amount stay (their amount is NULL).  Aggregating first makes
    the week-to-week join one-to-one, whatever the distribution of rows over ids.
    """
    fields = ("Opportunity_Est_Date", "Opportunity_Stage", "Opportunity_Status", "Project_Status")
    keys = (*WOW_KEYS, *also)
    return (snapshot.groupBy(*keys)
            .agg(F.sum(R.parse_amount("Opportunity_Usage")).alias("Opportunity_Usage"),
                 F.max(F.struct(*fields)).alias("_latest"))
            .select(*keys, "Opportunity_Usage", *[F.col(f"_latest.{f}").alias(f) for f in fields]))


def wow_tracking(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """New / Dropped / Changed / Unchanged per opportunity and product between two weeks.

    A NULL id or product is a value of its own; which week has a row is marked
    per side, not read from the key.
    """
    p = snapshot_by_id(prev).withColumn("_in", F.lit(True)).alias("p")
    c = snapshot_by_id(cur).withColumn("_in", F.lit(True)).alias("c")
    j = p.join(c, reduce(lambda a, b: a & b, [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in WOW_KEYS]), "full")
    changed = reduce(lambda a, b: a | b,
                     [~F.col(f"p.{f}").eqNullSafe(F.col(f"c.{f}")) for f in WOW_FIELDS])
    kind = (F.when(F.col("p._in").isNull(), F.lit("New"))
             .when(F.col("c._in").isNull(), F.lit("Dropped"))
             .when(changed, F.lit("Changed"))
             .otherwise(F.lit("Unchanged")))
    zero = F.lit(0)
    return j.select(
        *[F.coalesce(F.col(f"p.{k}"), F.col(f"c.{k}")).alias(k) for k in WOW_KEYS],
        kind.alias("Change_Type"),
        F.col("p.Opportunity_Usage").alias("Usage_Prev"),
        F.col("c.Opportunity_Usage").alias("Usage_Cur"),
        (F.coalesce(F.col("c.Opportunity_Usage"), zero)
         - F.coalesce(F.col("p.Opportunity_Usage"), zero)).alias("Usage_Change"))


def wow_fields(snapshots: Sequence[tuple[int, DataFrame]]) -> DataFrame:
    """Week-on-week calculated fields over any number of weekly snapshots.

    Rows: each opportunity and product in each week whose previous week also had it.
    ``lag`` runs in a window per opportunity and product (one row per week).  Rows move once, to
    their opportunity's partition, and are sorted there for the grouping and the window alike:
    no task sorts a whole split of a feed.
    """
    columns = (*WOW_KEYS, *WOW_FIELDS)
    rows = reduce(DataFrame.unionByName,
                  [df.select(*columns, F.lit(week).alias("Week")) for week, df in snapshots])
    stacked = snapshot_by_id(rows.repartition(*WOW_KEYS), "Week")
    w = Window.partitionBy(*WOW_KEYS).orderBy("Week")
    lagged = stacked.select(
        *WOW_KEYS, "Week", "Opportunity_Usage", "Opportunity_Est_Date",
        "Opportunity_Stage", "Opportunity_Status",
        *[F.lag(c).over(w).alias(f"_prev_{c}") for c in (
            "Week", "Opportunity_Usage", "Opportunity_Est_Date",
            "Opportunity_Stage", "Opportunity_Status")])
    delta = F.col("Opportunity_Usage") - F.col("_prev_Opportunity_Usage")
    prev_usage = F.col("_prev_Opportunity_Usage").cast("double")
    return (lagged.filter(F.col("_prev_Week") == F.col("Week") - 1)
            .select(*WOW_KEYS, "Week",
                    F.col("_prev_Opportunity_Usage").alias("Usage_Prev"),
                    F.col("Opportunity_Usage").alias("Usage_Cur"),
                    delta.alias("Usage_Delta"),
                    F.when(prev_usage != 0, delta.cast("double") / prev_usage)
                     .alias("Usage_Delta_Pct"),
                    F.datediff("Opportunity_Est_Date", "_prev_Opportunity_Est_Date")
                     .alias("Est_Date_Shift_Days"),
                    (~F.col("Opportunity_Stage").eqNullSafe(F.col("_prev_Opportunity_Stage")))
                     .alias("Stage_Changed"),
                    (~F.col("Opportunity_Status").eqNullSafe(F.col("_prev_Opportunity_Status")))
                     .alias("Status_Changed")))
