"""Data-quality audits (Q1–Q5): mapping gaps, parse rejects, coverage, keys, row counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators.fiscal import to_fiscal_month
from planmart.plans import clean
from planmart.plans.clean import KEYS
from planmart.plans.planning import Plan
from planmart.sources.store import MartStore


def audit_unmapped(plan: Plan) -> DataFrame:
    """Q1: raw category/product values that map to 'Need Mapping', per source."""
    opts = plan.opts
    rev = (plan.inputs.revenue
           .select(F.lit("revenue").alias("Source"), F.col("Product_Category").alias("Raw_Value"),
                   R.categorise("Product_Category", R.REVENUE_CATEGORY_RULES, opts.collation)
                    .alias("_mapped")))
    opp = (plan.inputs.opportunities.filter(R.is_present("Product"))
           .select(F.lit("opportunities").alias("Source"), F.col("Product").alias("Raw_Value"),
                   R.categorise("Product", R.OPPORTUNITY_CATEGORY_RULES, opts.collation)
                    .alias("_mapped")))
    return (rev.unionByName(opp).filter(F.col("_mapped") == R.UNMAPPED)
            .groupBy("Source", "Raw_Value").agg(F.count(F.lit(1)).alias("Row_Count")))


def unmapped_rows(plan: Plan, rules=R.OPPORTUNITY_CATEGORY_RULES_V1) -> DataFrame:
    """Q1 at row level: opportunities still needing mapping under ``rules``."""
    rows = clean.opportunity_rows(plan.inputs.opportunities, False, plan.opts, rules)
    return rows.filter(F.col("Product_Category") == R.UNMAPPED)


def audit_parse(plan: Plan) -> DataFrame:
    """Q2: amounts present as text that aren't a number, don't fit, or have more decimals than are kept."""
    return (plan.inputs.opportunities.filter(R.is_present("Opportunity_Usage"))
            .select("Opportunity_ID", "Opportunity_Usage", R.amount_issue("Opportunity_Usage").alias("Issue"))
            .where("Issue IS NOT NULL"))


def audit_category_coverage(plan: Plan) -> DataFrame:
    """Q3: mapped revenue categories vs target categories."""
    rev = (clean.split_measures(plan.inputs.revenue, plan.opts)
           .select(F.col("Product_Category_2").alias("Product_Category")).distinct()
           .withColumn("In_Revenue", F.lit(True)))
    tgt = (plan.inputs.targets.select("Product_Category").distinct()
           .withColumn("In_Targets", F.lit(True)))
    j = rev.join(tgt, "Product_Category", "full")
    return j.select("Product_Category",
                    F.coalesce("In_Revenue", F.lit(False)).alias("In_Revenue"),
                    F.coalesce("In_Targets", F.lit(False)).alias("In_Targets"))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """`df` by `keys` in so many partitions that a task holds few of them.

    Partitions that Spark makes for a grouping are put together again up to a size in compressed
    bytes, in which millions of short keys fit; a number that is asked for stays.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys)


def duplicate_keys(df: DataFrame, step: str, keys: Sequence[str] = KEYS, few: bool = False) -> DataFrame:
    """Keys that occur more than once in ``df`` (fan-out risk in a FULL JOIN).

    ``few``: no key has many rows, as in a step that was grouped before.  Then its rows are dealt
    out as they are, because counts before the shuffle would hold every key and save nothing.
    """
    rows = dealt(df, *keys) if few else df
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("Row_Count"))
            .filter(F.col("Row_Count") > 1)
            .select(F.lit(step).alias("Step"), *keys, "Row_Count"))


def audit_key_uniqueness(plan: Plan) -> DataFrame:
    """Q4: duplicate planning keys in every input of the FULL JOIN chain, and duplicate
    keys of the three lookups (the key that a lookup doesn't have is NULL)."""
    steps = [("revenue", plan.p2), ("opportunity", plan.p3), ("baseline", plan.baseline()),
             ("target", plan.p8), ("run_rate", plan.run_rate("origin"))]
    none = F.lit(None).cast("string")
    i = plan.inputs
    lookups = [("accounts", i.accounts.select(F.col("AccountNo").alias("Account_No"), none.alias("Fiscal_Month"))),
               ("sellers", i.sellers.select(F.col("Store_ID").alias("Account_No"), none.alias("Fiscal_Month"))),
               ("months", plan.cal.month_dim().select(none.alias("Account_No"), "Fiscal_Month"))]
    steps += [(name, df.withColumn("Product_Category", none)) for name, df in lookups]
    # targets and lookups may repeat a key without bound; the other steps have a row per date or month of a key
    any_number = {"target", "accounts", "sellers", "months"}
    return reduce(DataFrame.unionByName,
                  [duplicate_keys(df.select(*KEYS), name, few=name not in any_number) for name, df in steps])


# -- Q5: the row ledger ------------------------------------------------------------------
#
# The rows of every step follow from one grouped table: how many rows each input of the merge has
# per planning key.  A full join has a * b rows of a key that both sides hold, else the rows of the
# one that does; keys with a NULL part never match.

_PER_KEY = ("p2", "p3", "p7", "p8", "rr")           # rows of the inputs of the merge, by key
_PLAIN = ("revenue_raw", "opportunities_raw", "p10_origins", "p14")


def _tallied(df: DataFrame, **counts) -> DataFrame:
    """`df`'s keys with a count (a Column) for some of the tallies, 0 for the others."""
    return df.select(*KEYS, *[(counts[c] if c in counts else F.lit(0)).cast("long").alias(c) for c in (*_PER_KEY, *_PLAIN)])


def _summed(tallies: DataFrame) -> DataFrame:
    return tallies.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in (*_PER_KEY, *_PLAIN)])


def _revenue_tally(plan: Plan) -> DataFrame:
    rows = (clean.split_measures(plan.inputs.revenue, plan.opts)
            .groupBy("Account_No", F.col("Fiscal_Month").alias("_date"), F.col("Product_Category_2").alias("Product_Category"))
            .agg(F.count(F.lit(1)).alias("_n")))
    spread = plan.with_remaining_months(to_fiscal_month(rows, plan.cal, "_date"))
    own = F.col("_own")
    return _tallied(spread, p2=own.cast("int"), p7=(~own).cast("int"), revenue_raw=F.when(own, F.col("_n")).otherwise(0))


def _opportunity_tally(plan: Plan) -> DataFrame:
    """One pass: each row goes to the steps whose groups it belongs to, and groups are counted."""
    opts, ctx = plan.opts, plan.ctx
    used = (R.is_present("Product", opts.collation)
            & (R.collated("Opportunity_Usage", opts.collation) != R.NULL_TEXT))
    active = R.collated("Project_Status", opts.collation) != R.INACTIVE
    ahead = (F.col("Opportunity_Est_Date") > ctx.cutoff) & (F.col("Fiscal_Year") == ctx.fiscal_year)
    if not opts.include_current_month:
        ahead = ahead & (F.col("Fiscal_Month") != ctx.fiscal_month)
    detail = F.struct("Product", "Opportunity_ID", "Opportunity_Name", "Project_Status", "Opportunity_Status", "Opportunity_Stage")
    # raw rows are one group, the others groups by the step's own keys
    blank = {"Account_No": "string", "Product_Category": "string", "Fiscal_Month": "string", "Month_ID": "int"}

    def tag(step: str, *cols: str, more=None):
        keys = [(F.col(c) if c in cols else F.lit(None)).cast(t).alias(c) for c, t in blank.items()]
        return F.struct(F.lit(step).alias("step"), *keys, (detail if more is not None else F.lit(None).cast(kind)).alias("detail"))

    rows = to_fiscal_month(plan.inputs.opportunities, plan.cal, "Opportunity_Est_Date", keep_date=True, wide=True).withColumns({
        "Account_No": F.col("Store_No"), "Product_Category": R.categorise("Product", R.OPPORTUNITY_CATEGORY_RULES, opts.collation)})
    kind = rows.select(detail.alias("d")).schema["d"].dataType
    rows = dealt(rows, "Opportunity_ID", "Account_No", "Opportunity_Est_Date")      # a row has up to four groups, most of them its own
    keys = ("Account_No", "Product_Category", "Fiscal_Month")
    summed = used & active if opts.drop_inactive_in_summary else used
    tags = F.array_compact(F.array(
        tag("raw"), F.when(used & active, tag("p3", *keys)), F.when(used & active & ahead, tag("origin", *keys, "Month_ID")),
        F.when(summed, tag("p14", *keys, more=detail))))
    groups = (rows.select(F.explode(tags).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("_n")).select("t.*", "_n")
              .withColumns({"_later": ctx.future_array(), "_last": ctx.last_future_id}))
    step = F.col("step")
    # an origin month is one row of the run rate for each remaining month from its own on
    later = F.filter("_later", lambda m: m["Month_ID"] >= F.col("Month_ID"))
    ids = F.when(step == "origin", F.transform(later, lambda m: m["Month_ID"] + 1))
    if opts.clip_to_fy:
        ids = F.filter(ids, lambda i: i <= F.col("_last"))
    spread = groups.withColumn("_ids", F.concat(F.array(F.lit(-1)), F.coalesce(ids, F.array().cast("array<int>"))))
    spread = spread.withColumn("_est", F.explode("_ids"))
    months = plan.cal.months().select(F.col("Month_ID").alias("_id"), F.col("Fiscal_Month").alias("_month"))
    spread = spread.join(months, F.col("_est") == F.col("_id"), "left")
    own = F.col("_est") == -1
    spread = spread.withColumn("Fiscal_Month", F.when(own, F.col("Fiscal_Month")).otherwise(F.col("_month")))
    return _summed(_tallied(spread, p3=(own & (step == "p3")).cast("int"), rr=(~own).cast("int"),
                            opportunities_raw=F.when(own & (step == "raw"), F.col("_n")).otherwise(0),
                            p10_origins=(own & (step == "origin")).cast("int"), p14=(own & (step == "p14")).cast("int")))


def row_ledger(plan: Plan) -> DataFrame:
    """Q5: row count of every pipeline step, as one DataFrame (Step, Row_Count).

    One plan: each feed is read once (and the cutoff once), no step is built for its
    count, and what is shuffled has been added up by planning key.  The calendar
    has one row per day and month, as everywhere.
    """
    # a key has few rows by now: those of its dates from the revenue, one from each of the others
    parts = [_revenue_tally(plan), _opportunity_tally(plan), _summed(_tallied(plan.p8, p8=F.lit(1)))]
    by_key = _summed(dealt(reduce(DataFrame.unionByName, parts), *KEYS))
    lost = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in KEYS])

    def full(a: str, b: str):
        alone = lost | (F.col(a) == 0) | (F.col(b) == 0)
        return F.when(alone, F.col(a) + F.col(b)).otherwise(F.col(a) * F.col(b))

    joined = (by_key.withColumns({"p9": full("p7", "p8"), "p6": full("p2", "p3")})
              .withColumn("p11", full("p9", "rr")).withColumn("p12", full("p6", "p11")))
    steps = {"revenue_raw": "revenue_raw", "p1_clean_revenue": "p2", "opportunities_raw": "opportunities_raw",
             "p3_clean_opportunity": "p3", "p7_baseline": "p7", "p8_targets": "p8", "p9_baseline_target": "p9",
             "p10_run_rate_origins": "p10_origins", "p10_run_rate": "rr", "p11_baseline_target_run_rate": "p11",
             "p6_revenue_opportunity": "p6", "p12_all_transactional": "p12", "p14_opportunity_summary": "p14"}
    total = joined.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for name, c in steps.items()])
    months = F.coalesce(F.size(plan.ctx.future_array()), F.lit(0)).cast("long")
    rows = [F.struct(F.lit(name).alias("Step"), F.col(name).alias("Row_Count")) for name in steps]
    rows.append(F.struct(F.lit("p5_future_months").alias("Step"), months.alias("Row_Count")))
    return total.select(F.explode(F.array(*rows)).alias("r")).select("r.Step", "r.Row_Count")


def keep_ledger(plan: Plan, store: MartStore, run: str, name: str = "row_ledger") -> DataFrame:
    """The ledger of a run, next to those of the runs before, in a new version of `name`."""
    now = row_ledger(plan).select(F.lit(run).alias("Run"), "Step", "Row_Count")
    before = store.read(name).where(F.col("Run") != run) if store.current(name) else now.limit(0)
    return store.publish(before.unionByName(now), name)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count metric that is filled while ``df`` is written.

    For production runs: the count costs nothing extra, it rides along the
    job that writes the mart (``observation.get`` after the action).
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
