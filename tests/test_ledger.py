"""The ledger's counts against counting each step."""

import pytest
from pyspark.sql import functions as F

from planmart.options import PlanOptions
from planmart.plans import marts, quality
from planmart.plans.planning import Plan
from planmart.session import shared_dir
from planmart.sources import adapters
from planmart.sources.adapters import Inputs
from planmart.sources.store import MartStore


def counted(plan):
    """Each step built and counted on its own."""
    steps = {"revenue_raw": plan.inputs.revenue, "p1_clean_revenue": plan.p1, "opportunities_raw": plan.inputs.opportunities,
             "p3_clean_opportunity": plan.p3, "p5_future_months": plan.future_months(), "p7_baseline": plan.baseline(),
             "p8_targets": plan.p8, "p9_baseline_target": plan.baseline_target(),
             "p10_run_rate_origins": plan.run_rate_origins(), "p10_run_rate": plan.run_rate("origin"),
             "p11_baseline_target_run_rate": plan.baseline_target_run_rate("origin"),
             "p6_revenue_opportunity": plan.revenue_opportunity(),
             "p12_all_transactional": plan.all_transactional("origin", "join"), "p14_opportunity_summary": marts.opportunity_summary(plan)}
    return {name: df.count() for name, df in steps.items()}


def ledger(plan):
    return {r["Step"]: r["Row_Count"] for r in quality.row_ledger(plan).collect()}


@pytest.fixture(scope="module")
def odd(spark, small_dir):
    """Rows without keys, dates outside the calendar, repeated targets."""
    base = adapters.load(spark, small_dir)
    lost = lambda df, key, day: df.unionByName(df.where(f"pmod(hash({day}, {key}), 7) = 0").withColumn(key, F.lit(None).cast("string"))
                                               ).unionByName(df.limit(3).withColumn(day, F.to_date(F.lit("1980-01-01"))))
    return Inputs(lost(base.revenue, "StoreNo", "Month"), lost(base.opportunities, "Store_No", "Opportunity_Est_Date"),
                  lost(base.targets, "Store_Number", "Fiscal_Month").unionByName(base.targets), base.calendar, base.accounts, base.sellers)


@pytest.mark.parametrize("opts", [{}, {"include_current_month": False, "clip_to_fy": True, "drop_inactive_in_summary": True}])
def test_counts_are_those_of_the_steps(spark, odd, opts):
    plan = Plan(odd, PlanOptions(**opts))
    assert ledger(plan) == counted(plan)


def test_each_feed_is_read_once(spark, small_dir):
    df = quality.row_ledger(Plan(adapters.load(spark, small_dir)))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    scans = [leaves.apply(i).toString() for i in range(leaves.size())]              # the cutoff is a subquery
    assert sum("l_shipdate" in x for x in scans) == 1
    assert sum("o_orderkey" in x for x in scans) == 3              # the feeds made of orders: revenue, opportunities, targets


def test_empty_feeds(spark, small_dir):
    base = adapters.load(spark, small_dir)
    none = Inputs(base.revenue.limit(0), base.opportunities.limit(0), base.targets.limit(0), base.calendar, base.accounts, base.sellers)
    assert set(ledger(Plan(none)).values()) == {0}


def test_ledgers_are_kept_by_run(spark, small_dir):
    plan, store = Plan(adapters.load(spark, small_dir)), MartStore(spark, shared_dir(spark, "t_ledger"), "t_ledger")
    try:
        quality.keep_ledger(plan, store, "week 24")
        quality.keep_ledger(plan, store, "week 25")
        kept = quality.keep_ledger(plan, store, "week 25")          # repeated after a failure
        assert {r["Run"]: r["count"] for r in kept.groupBy("Run").count().collect()} == {"week 24": 14, "week 25": 14}
    finally:
        spark.sql("DROP DATABASE t_ledger CASCADE")


def test_the_keys_of_the_ledger_are_dealt_to_many_tasks(spark, small_dir):
    """Not put together again up to a size in compressed bytes: opportunities before their groups, tallies by key."""
    df = quality.row_ledger(Plan(adapters.load(spark, small_dir)))
    assert df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2
