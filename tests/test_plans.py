"""Plan shape checks, invariants and the FIXTURES row counts at sf0.001."""

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from planmart.operators.fiscal import Calendar
from planmart.plans import clean, insights, marts
from planmart.plans.planning import Plan
from planmart.sources import adapters, files

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonUDF")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plan(spark, small_dir):
    return Plan(adapters.load(spark, small_dir, with_prev=True))


@pytest.mark.parametrize("name", ["revenue_summary", "revenue_summary_summed", "opportunity_summary",
                                  "theta_month_join", "forecast_year_end", "wow_fields"])
def test_no_python_no_cartesian(spark, small_dir, name):
    text = physical(E.queries()[name](spark, small_dir))
    assert not any(n in text for n in PY_NODES)
    assert "CartesianProduct" not in text


def test_calendar_is_broadcast(plan):
    text = physical(plan.p2)
    assert "BroadcastHashJoin" in text and "BroadcastExchange" in text


def test_future_months_expand_without_joins(plan):
    for df in (plan.run_rate(), plan.baseline(), plan.baseline_avg(3)):
        text = physical(df)
        assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
        assert "Generate explode" in text


def test_filters_reach_the_scan(spark, small_dir):
    text = physical(adapters.targets(spark, small_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_union_form_has_one_merge_shuffle(plan):
    text = physical(plan.all_transactional("summed", "union"))
    assert "SortMergeJoin" not in text and "FullOuter" not in text


def test_fixture_counts(plan):
    assert plan.p2.count() == 5600
    assert plan.p3.count() == 720
    assert plan.future_months().count() == 5
    assert plan.baseline().count() == 365
    assert plan.p8.count() == 199
    assert plan.baseline_target().count() == 556
    assert plan.run_rate_origins().count() == 47
    rr = plan.run_rate("origin")
    assert rr.count() == 157
    assert rr.select("Account_No", "Product_Category", "Fiscal_Month").distinct().count() == 149
    assert plan.baseline_target_run_rate().count() == 700
    assert plan.revenue_opportunity().count() == 6241
    assert plan.all_transactional().count() == 6812
    assert plan.all_transactional("summed", "union").count() == 6804
    p13 = marts.revenue_summary(plan)
    assert p13.count() == 6812 and p13.filter(F.col("General_Seller").isNotNull()).count() == 5354
    p14 = marts.opportunity_summary(plan)
    assert p14.count() == 1135 and p14.filter(F.col("General_Seller").isNotNull()).count() == 893
    assert len(p13.columns) == 25 and len(p14.columns) == 28
    assert len(marts.opportunity_summary(plan, compat_aliases=True).columns) == 26


def test_wow_counts(plan):
    wow = insights.wow_tracking(plan.inputs.opportunities_prev, plan.inputs.opportunities)
    got = {r["Change_Type"]: r["count"] for r in wow.groupBy("Change_Type").count().collect()}
    assert got == {"Changed": 295, "Dropped": 66, "New": 116, "Unchanged": 1089}


def _sums(df, cols):
    return df.agg(*[F.sum(c).alias(c) for c in cols]).first().asDict()


def test_summed_forms_keep_source_totals(plan):
    cols = ["Revenue", "Opportunity_Usage", "Baseline", "Target", "Opportunities_Into_RR"]
    union = _sums(plan.all_transactional("summed", "union"), cols)
    join = _sums(plan.all_transactional("summed", "join"), cols)
    assert union == join
    assert union["Revenue"] == _sums(plan.p2, ["Revenue"])["Revenue"]
    assert union["Target"] == _sums(plan.p8, ["Target"])["Target"]
    assert union["Opportunities_Into_RR"] == _sums(plan.run_rate(), ["Opportunities_Into_RR"])["Opportunities_Into_RR"]


def test_summed_forms_agree_row_by_row(plan):
    keys = ["Account_No", "Fiscal_Month", "Product_Category"]
    a = plan.all_transactional("summed", "union")
    b = plan.all_transactional("summed", "join")
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    assert b.select(*a.columns).exceptAll(a).count() == 0
    assert a.select(*keys).distinct().count() == a.count()


def test_lookups_keep_row_count(plan):
    assert marts.revenue_summary(plan).count() == plan.all_transactional().count()
    assert marts.opportunity_summary(plan).count() == marts.opportunity_detail(plan).count()


def test_run_rate_rows_are_origins_times_remaining_months(plan):
    origins = plan.run_rate_origins()
    fut = plan.future_months().select(F.col("Month_ID").alias("_f"))
    expected = origins.join(fut, origins["Month_ID"] <= fut["_f"]).count()
    assert plan.run_rate("origin").count() == expected


def test_cogroup_equals_nested_full_joins(plan):
    a = plan.all_transactional("origin", "cogroup")
    b = plan.all_transactional("origin", "join").select(*a.columns)
    assert a.count() == b.count() == 6812
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lookups_reuse_account_partitioning(spark, plan):
    """With broadcasts off (large dimensions), only the dimensions are shuffled for the account/seller
    lookups of the summed form: the facts keep their Account_No partitioning."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        # the calendar stays a broadcast: it is small however large the other dimensions are
        calendar = Calendar(F.broadcast(plan.inputs.calendar.df), unique_days=True)
        df = marts.revenue_summary(Plan(replace(plan.inputs, calendar=calendar)), "summed", "union")
        assert df.count() == 6804
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # accounts and sellers meet first, so the facts have one lookup on Account_No
    assert text.count("SortMergeJoin [Account_No") == 1
    # one shuffle on Account_No alone (the merge); the lookup shuffles the dimensions only
    assert len(re.findall(r"Exchange hashpartitioning\(Account_No#\d+, \d+\)", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(_key_\w+#\d+, \d+\)", text)) == 1


def test_persisted_plan_gives_the_same_marts(spark, small_dir):
    lazy = Plan(adapters.load(spark, small_dir))
    shared = Plan(adapters.load(spark, small_dir))
    a = marts.revenue_summary(lazy)
    with shared.persisted():
        assert shared.ctx.as_frame().collect() == lazy.ctx.as_frame().collect()
        b = marts.revenue_summary(shared).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_revenue_is_read_once_for_the_merge_and_once_for_the_cutoff(plan):
    """Revenue and baseline share one pass; the cutoff is a narrow subquery of the same plan."""
    df = marts.revenue_summary(Plan(plan.inputs), "summed", "union")
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    scans = [leaves.apply(i).toString() for i in range(leaves.size())]       # without those of subqueries
    assert sum("l_extendedprice" in x for x in scans) == 1


def test_facts_without_targets_are_made_once(plan):
    """Both parts of the join with the targets read one shuffle of the other facts."""
    df = marts.revenue_summary(plan)
    df.collect()
    text = physical(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_orderkey#\d+L,l_partkey#\d+L,l_extendedprice#\d+,l_retu", text)) == 1
    assert "collect_list(_s3" not in text and "ReusedExchange" in text


@pytest.mark.parametrize("name", ["scalar_cutoff", "fiscal_context", "future_months"])
def test_the_context_reads_revenue_in_its_own_plan(spark, small_dir, name):
    assert "lineitem.parquet" in physical(E.queries()[name](spark, small_dir))


def feed_scans(df, column="l_extendedprice"):
    df.collect()
    return len(re.findall(rf"FileScan parquet \[[^\]]*{column}", physical(df).split("== Initial Plan ==")[0]))


def test_forecast_and_slices_read_revenue_once_besides_the_cutoff(spark, small_dir, plan):
    leaves = E.queries()["forecast_year_end"](spark, small_dir)._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert sum("l_extendedprice" in leaves.apply(i).toString() for i in range(leaves.size())) == 1     # the cutoff is a subquery
    assert feed_scans(E.queries()["slice_rollup"](spark, small_dir)) == 2
    # no measure that needs the cutoff: one pass
    assert feed_scans(E.queries()["slice_cube"](spark, small_dir)) == 1
    # targets only: the feed isn't read
    assert feed_scans(insights.slice_facts(plan, ["Vertical"], ["Target"], "groupby")) == 0


@pytest.mark.parametrize("dims, mode", [(["General_Seller", "Fiscal_Month"], "cube"), (["Account_No", "Month_ID"], "groupby"),
                                        (["Product_Category"], "rollup"), (["Fiscal_Quarter", "Segment", "Support_Seller"], "rollup")])
def test_slices_equal_grouping_the_mart(plan, dims, mode):
    measures = ["Revenue", "Baseline", "Target", "Opportunities_Into_RR", "Opportunity_Extrapolation"]
    mart = marts.revenue_summary(plan, "summed", "union")
    want = getattr(mart, "groupBy" if mode == "groupby" else mode)(*dims).agg(
        *[F.sum(m).alias(m) for m in measures], *([F.grouping_id(*dims).cast("int").alias("Grouping_Level")] if mode != "groupby" else []))
    got = insights.slice_facts(plan, dims, measures, mode)
    same = lambda df: Counter(map(tuple, df.select(*[F.col(c).cast("double") if t.startswith("decimal") else c
                                                      for c, t in want.dtypes]).collect()))
    assert same(got) == same(want)
    with pytest.raises(ValueError):
        insights.slice_facts(plan, ["Nothing"], measures)


@pytest.mark.parametrize("name", ["revenue_trend", "fee_trend"])
def test_trends_read_revenue_once(spark, small_dir, name):
    assert physical(E.queries()[name](spark, small_dir)).count("lineitem.parquet") == 1


def test_facts_of_a_key_are_gathered_by_one_sort(plan):
    """A grouped collect_list falls back to sorting, before and after it writes the lists out."""
    text = physical(plan.all_transactional())
    assert "collect_list" in text and not re.search(r"ObjectHashAggregate[^\n]*collect_list|SortAggregate[^\n]*collect_list", text)


def test_facts_without_targets_meet_the_lookups_where_they_are(spark, plan):
    """With broadcasts off, the merged facts aren't shuffled again, neither for the targets nor for the
    account lookups: only those whose key has targets are."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        calendar = Calendar(F.broadcast(plan.inputs.calendar.df), unique_days=True)
        df = marts.revenue_summary(Plan(replace(plan.inputs, calendar=calendar)))
        assert df.count() == 6812
        lines = physical(df).split("== Initial Plan ==")[0].splitlines()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lookup = next(i for i, x in enumerate(lines) if "SortMergeJoin [Account_No" in x)
    facts = lines[lookup:next(i for i, x in enumerate(lines) if i > lookup and "Window [" in x)]
    assert not [x for x in facts if "Exchange" in x or "Union" in x]


def test_a_stored_plan_gives_the_same_mart_and_leaves_no_files(spark, small_dir):
    inputs = adapters.load(spark, small_dir)
    a = marts.revenue_summary(Plan(inputs))
    with Plan(inputs).stored() as stored:
        path = stored.p1.inputFiles()[0].rpartition("/")[0]
        b = marts.revenue_summary(stored).select(*a.columns)
        assert files.exists(spark, path)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert not files.exists(spark, path)
    assert stored.all_transactional().count() == 6812        # from the feed again
    given = clean.clean_revenue(inputs.revenue, with_activity=True)
    with Plan(inputs, p1=given).stored() as kept:
        assert kept._p1_shared is given
