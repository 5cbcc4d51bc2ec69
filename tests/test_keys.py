"""Keys under a collation meet in joins and group-bys; binary by default."""

import itertools

import pytest
from pyspark.sql import functions as F

from planmart.options import PlanOptions
from planmart.plans import insights, keys, marts
from planmart.plans.planning import Plan
from util import D, M, make_inputs, opp_row, rev_row

TEXTS = ["a1", "A1", "a1 ", "A1  ", " a1", "a1\t", "", " ", "É", "é", "ß", "SS", "a1x"]


@pytest.mark.parametrize("collation", sorted(keys.COLLATIONS))
def test_normal_forms_are_equal_where_the_collation_says_so(spark, collation):
    df = spark.createDataFrame(list(itertools.product(TEXTS, TEXTS)), "a string, b string")
    rows = df.select("a", "b", (keys.normal("a", collation) == keys.normal("b", collation)).alias("got"),
                     (F.collate("a", collation) == F.collate("b", collation)).alias("want")).collect()
    assert [(r.a, r.b) for r in rows if r.got != r.want] == []


def test_other_collations_are_refused(spark):
    with pytest.raises(ValueError, match="UNICODE_CI"):
        keys.normal("a", "UNICODE_CI")


@pytest.fixture
def inputs(spark):
    return make_inputs(
        spark,
        revenue=[rev_row("A1", "2001-01-01", "Actuals", "Support", 10), rev_row("a1 ", "2001-01-01", "Actuals", "Support", 5),
                 rev_row("zz", "2001-01-01", "Actuals", "Support", 1)],
        opportunities=[opp_row("a1", "2001-03-05", "Support: x", "o1", "Active", "7.00")],
        targets=[("A1 ", "support", D("2001-01-01"), M(100))],
        accounts=[("A1", "Alpha", "I", "V", "S", "m", "Yes", "v")],
        sellers=[("a1", "Co", "g", "s", "u", "p")])


def test_spellings_of_a_key_are_one_account(inputs):
    rows = marts.revenue_summary(Plan(inputs, PlanOptions(key_collation="UTF8_LCASE_RTRIM"))).collect()
    january = [r for r in rows if r["Account_No"] == "A1" and r["Fiscal_Month"] == "January, 2001"]
    assert [(r["Revenue"], r["Target"], r["Account_Name"], r["General_Seller"]) for r in january] == [(15, 100, "Alpha", "g")]
    assert {r["Account_No"] for r in rows} == {"A1", "zz"}
    opps = marts.opportunity_summary(Plan(inputs, PlanOptions(key_collation="UTF8_LCASE_RTRIM"))).collect()
    assert [(r["Account_No"], r["Account_Name"]) for r in opps] == [("A1", "Alpha")]


def test_binary_by_default(inputs):
    rows = marts.revenue_summary(Plan(inputs)).where("Fiscal_Month = 'January, 2001'").collect()
    assert {(r["Account_No"], float(r["Revenue"]), float(r["Target"])) for r in rows} == {
        ("A1", 10, 0), ("a1 ", 5, 0), ("zz", 1, 0), ("A1 ", 0, 100)}


@pytest.mark.parametrize("form", [("origin", "cogroup"), ("origin", "join"), ("summed", "union")])
def test_every_merge_and_slice_has_them(inputs, form):
    plan = Plan(inputs, PlanOptions(key_collation="UTF8_LCASE_RTRIM"))
    got = plan.all_transactional(*form).where("Fiscal_Month = 'January, 2001' AND Account_No = 'a1'").collect()
    assert [(r["Revenue"], r["Target"], r["Product_Category"]) for r in got] == [(15, 100, "Support")]
    sliced = insights.slice_facts(plan, ["Vertical"], ["Revenue", "Target"], "groupby").collect()
    assert {(r["Vertical"], float(r["Revenue"]), float(r["Target"])) for r in sliced} == {("V", 15, 100), (None, 1, 0)}
