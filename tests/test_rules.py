"""Unit tables for the business rules and the worksheet's quirks (FIXTURES §5)."""

import pytest
from pyspark.sql import functions as F

from planmart.functions import rules as R
from planmart.operators.joins import cogroup_full_outer, full_outer_coalesce, full_outer_marked, marks
from planmart.options import PlanOptions
from planmart.plans import clean, quality
from planmart.plans.planning import Plan

from util import D, M, make_inputs, opp_row, rev_row


def one_col(df, c):
    return [r[c] for r in df.collect()]


def test_sentinel_filter(spark):
    inp = make_inputs(spark, opportunities=[
        opp_row("1", "2001-02-01", None, "a", "Active", "1.00"),
        opp_row("1", "2001-02-01", "NULL", "b", "Active", "1.00"),
        opp_row("1", "2001-02-01", "Services: x", "c", "Active", "1.00"),
    ])
    rows = clean.opportunity_rows(inp.opportunities, drop_inactive=False)
    assert one_col(rows, "Opportunity_ID") == ["c"]


def test_status_filter_three_valued(spark):
    inp = make_inputs(spark, opportunities=[
        opp_row("1", "2001-02-01", "Services: x", "inactive", "Inactive", "1.00"),
        opp_row("1", "2001-02-01", "Services: x", "null", None, "1.00"),
        opp_row("1", "2001-02-01", "Services: x", "text", "NULL", "1.00"),
        opp_row("1", "2001-02-01", "Services: x", "active", "Active", "1.00"),
    ])
    rows = clean.opportunity_rows(inp.opportunities, drop_inactive=True)
    assert sorted(one_col(rows, "Opportunity_ID")) == ["active", "text"]


def test_category_order_and_collation(spark):
    df = spark.createDataFrame([("Service Support Product",), ("Product",), ("x",), ("services",),
                                (None,)], "c string")
    got = one_col(df.select(R.categorise("c").alias("m")), "m")
    assert got == ["Services", "Products", "Need Mapping", "Need Mapping", "Need Mapping"]
    ci = one_col(df.select(R.categorise("c", collation="UTF8_LCASE").alias("m")), "m")
    assert ci[3] == "Services"


def test_opportunity_rules_v1_vs_v2(spark):
    df = spark.createDataFrame([("Product: a",), ("Products: b",)], "p string")
    v1 = one_col(df.select(R.categorise("p", R.OPPORTUNITY_CATEGORY_RULES_V1).alias("m")), "m")
    v2 = one_col(df.select(R.categorise("p", R.OPPORTUNITY_CATEGORY_RULES).alias("m")), "m")
    assert v1 == ["Need Mapping", "Products"] and v2 == ["Products", "Products"]


def test_amount_text_and_rejects(spark):
    inp = make_inputs(spark, opportunities=[
        opp_row("1", "2001-02-01", "Services: x", "a", "Active", "1,234,567.89"),
        opp_row("1", "2001-02-01", "Services: x", "b", "Active", "-1,000.00"),
        opp_row("1", "2001-02-01", "Services: x", "c", "Active", ""),
        opp_row("1", "2001-02-01", "Services: x", "d", "Active", "n/a"),
    ])
    rows = {r["Opportunity_ID"]: r["Opportunity_Usage"]
            for r in clean.opportunity_rows(inp.opportunities, False).collect()}
    assert rows == {"a": M("1234567.89"), "b": M("-1000.00"), "c": None, "d": None}
    rejects = quality.audit_parse(Plan(inp))
    assert sorted(one_col(rejects, "Opportunity_ID")) == ["c", "d"]
    strict = PlanOptions(on_bad="fail")
    with pytest.raises(Exception):
        clean.opportunity_rows(inp.opportunities, False, strict).collect()


def test_months_left_both_scales(spark):
    names = [f"{m}, 2001" for m in R.MONTH_NAMES] + [None]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = df.select(R.months_left("m").alias("a"), R.months_left("m", True).alias("b")).collect()
    expected = [5, 4, 3, 2, 1, 0, 11, 10, 9, 8, 7, 6, None]
    assert [r["a"] for r in got] == expected
    assert [r["b"] for r in got] == [None if e is None else e + 1 for e in expected]


def test_clamps(spark):
    df = spark.createDataFrame([(M(-5),), (M(0),), (M(5),), (None,)], "u decimal(18,2)")
    got = df.select(R.clamp_negative("u").alias("c"), R.extrapolate("u", F.lit(3)).alias("e")).collect()
    assert [r["c"] for r in got] == [0, 0, 5, None]
    assert [r["e"] for r in got] == [0, 0, 15, None]


def test_value_bands_boundaries(spark):
    vals = [M(-1), M(0), M(10000), M("10000.01"), M(200000), M("200000.01"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v decimal(18,2)")
    got = one_col(df.select(R.value_band("v").alias("b")), "b")
    assert got == ["Below $0", "$0 to $10,000", "$0 to $10,000", "$10000 to $50,000",
                   "$100,000 to $200,000", "$200,000 +", "$200,000 +"]
    flagged = one_col(df.select(R.value_band("v", "Unknown").alias("b")), "b")
    assert flagged[:-1] == got[:-1] and flagged[-1] == "Unknown"


def _rr_inputs(spark, origins):
    revenue = [rev_row("A", "2001-01-01", "Actuals", "Services X", 10),
               rev_row("A", "2001-02-01", "Actuals", "Services X", 0)]
    opps = [opp_row("A", d, "Services: x", f"o{i}", "Active", "100.00")
            for i, d in enumerate(origins)]
    return make_inputs(spark, revenue=revenue, opportunities=opps)


def test_run_rate_months(spark):
    p = Plan(_rr_inputs(spark, ["2001-01-15", "2001-02-10", "2001-06-05"]))
    ctx = p.ctx.as_frame().first()
    assert ctx["Cutoff_Date"] == D("2001-01-01") and ctx["Fiscal_Month"] == "January, 2001"
    rr = sorted(r["Fiscal_Month"] for r in p.run_rate("origin").collect())
    jan_feb = ["March, 2001", "April, 2001", "May, 2001", "June, 2001", "July, 2001"]
    assert sorted(rr) == sorted(jan_feb * 2 + ["July, 2001"])
    # summed grain: one row per target month, both origins added
    summed = {r["Fiscal_Month"]: r["Opportunities_Into_RR"] for r in p.run_rate("summed").collect()}
    assert summed["March, 2001"] == 200 and summed["July, 2001"] == 300
    clipped = Plan(p.inputs, PlanOptions(clip_to_fy=True)).run_rate("origin")
    assert "July, 2001" not in one_col(clipped, "Fiscal_Month")


def test_run_rate_excluding_current_month(spark):
    inp = _rr_inputs(spark, ["2001-01-15", "2001-02-10"])
    p = Plan(inp, PlanOptions(include_current_month=False))
    assert one_col(p.run_rate_origins(), "Fiscal_Month") == ["February, 2001"]


def test_full_join_null_keys_stay_apart(spark):
    from planmart.operators.joins import full_outer_coalesce
    a = spark.createDataFrame([("1", None, "S", M(1))],
                              "Account_No string, Fiscal_Month string, Product_Category string, x decimal(18,2)")
    b = spark.createDataFrame([("1", None, "S", M(2))],
                              "Account_No string, Fiscal_Month string, Product_Category string, y decimal(18,2)")
    out = full_outer_coalesce(a, b, ["Account_No", "Fiscal_Month", "Product_Category"], ["x"], ["y"])
    assert sorted((r["x"], r["y"]) for r in out.collect()) == [(0, 2), (1, 0)]


def test_fan_out_origin_vs_summed(spark):
    revenue = [rev_row("A", "2001-01-01", "Actuals", "Services X", 10)]
    opps = [opp_row("A", "2001-01-15", "Services: x", "o1", "Active", "100.00"),
            opp_row("A", "2001-02-10", "Services: x", "o2", "Active", "50.00")]
    inp = make_inputs(spark, revenue=revenue, opportunities=opps)
    march = F.col("Fiscal_Month") == "March, 2001"
    origin = Plan(inp).all_transactional("origin", "join").filter(march).collect()
    summed = Plan(inp).all_transactional("summed", "join").filter(march).collect()
    union = Plan(inp).all_transactional("summed", "union").filter(march).collect()
    assert [r["Baseline"] for r in origin] == [10, 10]          # repeated per origin
    assert [r["Baseline"] for r in summed] == [10]
    assert [(r["Baseline"], r["Opportunities_Into_RR"]) for r in union] == [(10, 150)]


def test_date_outside_calendar_kept(spark):
    inp = make_inputs(spark, revenue=[rev_row("A", "1990-01-01", "Actuals", "Services", 5),
                                      rev_row("A", "2001-01-01", "Actuals", "Services", 7)])
    p2 = Plan(inp).p2.collect()
    assert sorted((r["Fiscal_Month"] or "", r["Revenue"]) for r in p2) == [("", 5), ("January, 2001", 7)]


def test_cutoff_when_all_revenue_zero(spark):
    inp = make_inputs(spark, revenue=[rev_row("A", "2001-01-01", "Actuals", "Services", 0)])
    p = Plan(inp)
    assert p.baseline().count() == 0 and p.future_months().count() == 0
    assert [tuple(r) for r in p.ctx.as_frame().collect()] == [(None, None, None, None)]


def test_cutoff_outside_the_calendar_keeps_its_date(spark):
    p = Plan(make_inputs(spark, revenue=[rev_row("A", "1990-01-01", "Actuals", "Services", 5)]))
    assert [tuple(r) for r in p.ctx.as_frame().collect()] == [(D("1990-01-01"), None, None, None)]
    assert p.baseline().count() == 0 and p.future_months().count() == 0


def test_months_are_tested_from_july_on(spark):
    df = spark.createDataFrame([("June (FY from July)",)], "m string")
    assert df.select(R.months_left("m")).first()[0] == 11


def test_collation_reaches_types_and_sentinels(spark):
    lower = PlanOptions(collation="UTF8_LCASE_RTRIM")
    inp = make_inputs(spark, revenue=[rev_row("A", "2001-01-01", "ACTUALS ", "services", 5)], opportunities=[
        opp_row("1", "2001-02-01", "null", "a", "Active", "1.00"),
        opp_row("1", "2001-02-01", "services: x", "b", "inactive", "1.00"),
        opp_row("1", "2001-02-01", "services: x", "c", "Active", "1.00")])
    assert [(r["Revenue"], r["Product_Category"]) for r in clean.clean_revenue(inp.revenue, lower).collect()] \
        == [(5, "Services")]
    assert one_col(clean.opportunity_rows(inp.opportunities, True, lower), "Opportunity_ID") == ["c"]


def test_amounts_keep_their_digits(spark):
    inp = make_inputs(spark, opportunities=[
        opp_row("1", "2001-02-01", "Services: x", i, "Active", amount)
        for i, amount in (("a", "12.3456"), ("b", "99999999999999999.00"), ("c", "1.00000001"), ("d", "x"),
                          ("e", "9" * 33), ("f", "1e3"))])
    rows = {r["Opportunity_ID"]: r["Opportunity_Usage"] for r in clean.opportunity_rows(inp.opportunities, False).collect()}
    assert rows["a"] == M("12.3456") and rows["b"] == M("99999999999999999.00") and rows["f"] == 1000
    issues = {r["Opportunity_ID"]: r["Issue"] for r in quality.audit_parse(Plan(inp)).collect()}
    assert issues == {"c": "rounded", "d": "unparsable", "e": "overflow"}


def test_merge_forms_agree_on_missing_amounts_and_dates(spark):
    """An unparsable amount and a date outside the calendar: 0 in every form."""
    inp = make_inputs(spark, revenue=[rev_row("A", "2001-01-01", "Actuals", "Services X", 10)], opportunities=[
        opp_row("A", "2001-02-10", "Support: x", "o1", "Active", "n/a"),
        opp_row("A", "1990-03-01", "Products: x", "o2", "Active", "7.00")])
    cols = ["Opportunity_Usage", "Opportunity_Extrapolation"]
    got = {}
    for combine in ("join", "cogroup", "union"):
        rows = Plan(inp).all_transactional("summed", combine).collect()
        got[combine] = sorted((str(r["Fiscal_Month"]), r["Product_Category"], *(float(r[c]) for c in cols)) for r in rows)
    assert got["join"] == got["cogroup"] == got["union"]
    assert ("None", "Products", 7.0, 0.0) in got["union"]
    with pytest.raises(ValueError):
        Plan(inp).all_transactional("origin", "union")


def test_wow_keeps_rows_without_amount_and_null_ids(spark):
    from planmart.plans import insights
    prev = [opp_row("1", "2001-02-01", "P", "a", "Active", "10"), opp_row("1", "2001-02-01", "P", "b", "Active", "NULL"),
            opp_row("1", "2001-02-01", "P", None, "Active", "5"), opp_row("1", "2001-02-01", "Q", "d", "Active", "1")]
    cur = [opp_row("1", "2001-02-01", "P", "a", "Active", "NULL"), opp_row("1", "2001-03-01", "P", "b", "Active", "NULL"),
           opp_row("1", "2001-02-01", "P", "c", "Active", "2"), opp_row("1", "2001-02-01", "R", "d", "Active", "1")]
    inp = make_inputs(spark, opportunities=cur, prev=prev)
    got = {(r["Opportunity_ID"], r["Product"]): r["Change_Type"]
           for r in insights.wow_tracking(inp.opportunities_prev, inp.opportunities).collect()}
    assert got == {("a", "P"): "Changed", ("b", "P"): "Changed", (None, "P"): "Dropped", ("c", "P"): "New",
                   ("d", "Q"): "Dropped", ("d", "R"): "New"}


def test_a_lazy_plan_follows_new_revenue(spark, tmp_path):
    path = str(tmp_path / "revenue")
    inp = make_inputs(spark, revenue=[rev_row("A", "2001-01-01", "Actuals", "Services X", 10)])
    inp.revenue.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW t_rev USING parquet OPTIONS (path '{path}')")
    inp.revenue = spark.table("t_rev")
    Plan(inp).baseline().createOrReplaceTempView("t_baseline")
    assert spark.table("t_baseline").count() == 5
    more = make_inputs(spark, revenue=[rev_row("A", "2001-03-01", "Actuals", "Services X", 7)])
    more.revenue.write.mode("append").parquet(path)
    spark.catalog.refreshTable("t_rev")
    assert sorted(one_col(spark.table("t_baseline"), "Fiscal_Month")) == ["April, 2001", "June, 2001", "May, 2001"]


def _tgt(acct, cat, month, amount):
    return (acct, cat, D(month), M(amount))


def test_targets_meet_marked_facts_as_in_the_full_join(spark):
    """Keys that repeat on both sides, that one side lacks, and NULL parts, which never match."""
    facts = spark.createDataFrame([("A", "m", 1), ("A", "m", 2), ("B", "m", 3), ("B", None, 4), (None, "m", 5)],
                                  "k string, month string, v int")
    rows = spark.createDataFrame([("A", "m", 10), ("A", "m", 20), ("A", "m", None), ("C", "m", 30), ("B", None, 40),
                                  (None, "m", 50), (None, None, 60)], "k string, month string, t int")
    keys = ("k", "month")
    base = cogroup_full_outer([(facts, {0: ("v",)}), (marks(rows, keys), {1: ("_marked",)})], keys, partition_by="k")
    parts = full_outer_marked(base, rows, keys, ("v",), ("t",))
    want = full_outer_coalesce(facts, rows, keys, ("v",), ("t",))
    same = lambda *dfs: sorted(map(str, (tuple(r) for df in dfs for r in df.select(*keys, "v", "t").collect())))
    assert same(*parts) == same(want) and len(same(want)) == 6 + 1 + 1 + 2 + 3
    assert same(parts[0]) == sorted(map(str, [("B", "m", 3, 0), ("B", None, 4, 0), (None, "m", 5, 0)]))


def test_cogroup_cross_product_and_null_keys_match_nested_joins(spark):
    """K9: several dates of one fiscal month on two inputs fan out as a cross
    product; K10: NULL-month rows of different inputs never merge."""
    revenue = [rev_row("A", "2001-01-01", "Actuals", "Services X", 10),
               rev_row("A", "2001-01-15", "Actuals", "Services X", 20),   # same fiscal month
               rev_row("A", "1990-01-01", "Actuals", "Services X", 5),    # outside the calendar
               rev_row("A", "1990-02-01", "Actuals", "Services X", 6)]    # outside, second date
    opps = [opp_row("A", "1990-03-01", "Services: x", "o1", "Active", "7.00"),   # NULL month
            opp_row("A", "2001-02-10", "Services: x", "o2", "Active", "50.00")]
    targets = [_tgt("A", "Services", "2001-01-01", 100), _tgt("A", "Services", "2001-01-20", 200)]
    inp = make_inputs(spark, revenue=revenue, opportunities=opps, targets=targets)
    plan = Plan(inp)
    cog = plan.all_transactional("origin", "cogroup")
    join = plan.all_transactional("origin", "join").select(*cog.columns)
    assert cog.exceptAll(join).count() == 0 and join.exceptAll(cog).count() == 0
    jan = cog.filter(F.col("Fiscal_Month") == "January, 2001").collect()
    assert sorted((r["Revenue"], r["Target"]) for r in jan) == [(10, 100), (10, 200), (20, 100), (20, 200)]
    nulls = cog.filter(F.col("Fiscal_Month").isNull()).collect()
    assert sorted((r["Revenue"], r["Opportunity_Usage"]) for r in nulls) == [(0, 7), (5, 0), (6, 0)]
