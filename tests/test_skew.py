"""A hot account holding a third of all revenue rows: same results, no hot partition."""

import pytest
from pyspark.sql import functions as F

from planmart.operators.joins import full_outer_coalesce
from planmart.plans import insights, marts
from planmart.plans.clean import KEYS, REVENUE_MEASURES
from planmart.plans.planning import OPPORTUNITY_MEASURES, Plan
from planmart.sources import adapters
from planmart.sources.adapters import Inputs
from util import make_inputs, opp_row

HOT = "00000001"


def skewed_inputs(spark, small_dir):
    base = adapters.load(spark, small_dir)
    # A third of the line items (by a hash of their key columns) move to one account.
    hot_rows = F.pmod(F.xxhash64("StoreNo", "Month", "Revenue", "Product_Category"), F.lit(3)) == 0
    revenue = base.revenue.withColumn("StoreNo", F.when(hot_rows, F.lit(HOT)).otherwise(F.col("StoreNo")))
    return Inputs(revenue, base.opportunities, base.targets, base.calendar, base.accounts,
                  base.sellers)


def test_hot_account_results_agree_across_merges(spark, small_dir):
    plan = Plan(skewed_inputs(spark, small_dir))
    raw_share = (plan.inputs.revenue.filter(F.col("StoreNo") == HOT).count()
                 / plan.inputs.revenue.count())
    assert 0.25 < raw_share < 0.42
    cog = plan.all_transactional("origin", "cogroup")
    join = plan.all_transactional("origin", "join").select(*cog.columns)
    assert cog.exceptAll(join).count() == 0 and join.exceptAll(cog).count() == 0
    # Totals are kept whole: nothing dropped or capped.
    total = plan.p2.agg(F.sum("Revenue")).first()[0]
    assert plan.all_transactional("summed", "union").agg(F.sum("Revenue")).first()[0] == total


def test_merge_shuffle_has_no_hot_partition(spark, small_dir):
    plan = Plan(skewed_inputs(spark, small_dir))
    merged = plan.all_transactional("origin", "cogroup")
    # Hash partition of each row for a 16-way shuffle on Account_No (Spark's
    # HashPartitioning uses the same Murmur3 hash), independent of AQE coalescing.
    part = F.pmod(F.hash("Account_No"), F.lit(16))
    sizes = [r["n"] for r in merged.groupBy(part.alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    hot = merged.filter(F.col("Account_No") == HOT).count()
    # After pre-aggregation the hot account is a few hundred rows (months x categories),
    # a small share of the merge, however many raw rows it had.
    assert hot / sum(sizes) < 0.1
    assert max(sizes) / sum(sizes) < 0.2


def test_hot_account_of_the_opportunity_view_is_split(spark, small_dir):
    """80 % of the opportunities on one account: the one lookup of the facts is split at run time."""
    base = adapters.load(spark, small_dir)
    hot = F.pmod(F.xxhash64("Opportunity_ID"), F.lit(5)) != 0
    opps = base.opportunities.withColumn("Store_No", F.when(hot, F.lit(HOT)).otherwise(F.col("Store_No")))
    plan = Plan(Inputs(base.revenue, opps, base.targets, base.calendar, base.accounts, base.sellers))
    expected = marts.opportunity_summary(plan).count()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = marts.opportunity_summary(Plan(plan.inputs))
        assert len(df.collect()) == expected
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true) [Account_No" in text


SPLITTING = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}


@pytest.fixture
def splitting(spark):
    old = {k: spark.conf.get(k, None) for k in SPLITTING}
    for k, v in SPLITTING.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_targets(spark, base, rows=100_000):
    """`rows` targets of one account, category and month, next to the others and some without a key."""
    hot = spark.range(rows, numPartitions=16).select(
        F.lit(HOT).alias("Store_Number"), F.lit("Services").alias("Product_Category"),
        F.to_date(F.lit("2001-03-01")).alias("Fiscal_Month"), F.col("id").cast("decimal(18,2)").alias("Target"))
    lost = hot.where("Target < 300").withColumn("Store_Number", F.lit(None).cast("string"))
    return Inputs(base.revenue, base.opportunities, base.targets.unionByName(hot).unionByName(lost), base.calendar,
                  base.accounts, base.sellers)


@pytest.mark.parametrize("step", ["all_transactional", "baseline_target", "baseline_target_run_rate"])
def test_a_key_with_very_many_targets_is_split(spark, small_dir, splitting, step):
    plan = Plan(hot_targets(spark, adapters.load(spark, small_dir)))
    merged = getattr(plan, step)()
    parts = merged.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("Target"))
    sizes = [r["n"] for r in parts.collect()]
    assert sum(sizes) > 100_000 and max(sizes) < 30_000
    out = getattr(plan, step)()
    out.collect()
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_split_targets_equal_nested_joins(spark, small_dir):
    plan = Plan(hot_targets(spark, adapters.load(spark, small_dir), 2_000))
    got = plan.all_transactional("origin", "cogroup")
    want = full_joins(plan).select(*got.columns)
    assert got.count() == want.count() > 8_000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def full_joins(plan):
    """The worksheet's nested FULL OUTER JOINs."""
    bt = full_outer_coalesce(plan.baseline(), plan.p8, KEYS, ("Baseline",), ("Target",))
    btr = full_outer_coalesce(bt, plan.run_rate("origin"), KEYS, ("Baseline", "Target"), ("Opportunities_Into_RR",))
    return full_outer_coalesce(plan.revenue_opportunity(), btr, KEYS, (*REVENUE_MEASURES, *OPPORTUNITY_MEASURES),
                               ("Baseline", "Target", "Opportunities_Into_RR"))


def test_wow_fields_moves_rows_before_it_sorts_them(spark):
    """One shuffle, of rows as they come: no task sorts or groups a split of a feed."""
    week = [opp_row("1", "2001-02-01", "Services: A", str(i), "Active", "10.00") for i in range(50)]
    df = make_inputs(spark, opportunities=week).opportunities
    out = insights.wow_fields([(1, df), (2, df)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1
    below = plan[plan.index("Exchange hashpartitioning("):]
    assert "Aggregate" not in below and "Sort" not in below
    assert out.count() == 50
