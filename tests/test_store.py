"""Versioned views: readers, failed builds, checks inside the writing plan."""

import glob
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from planmart.options import PlanOptions
from planmart.plans import marts
from planmart.plans.planning import Plan
from planmart.plans.publish import VIEW_NAMES, RowsChanged, publish_marts
from planmart.session import shared_dir
from planmart.sources import adapters, files
from planmart.sources.adapters import Inputs
from planmart.sources.store import MartStore


@pytest.fixture
def store(spark):
    made = MartStore(spark, shared_dir(spark, "t_store"), "t_marts")
    yield made
    spark.sql("DROP DATABASE t_marts CASCADE")


def rows(df):
    return sorted(map(tuple, df.collect()))


def weeks(spark, *values):
    return spark.createDataFrame([(f"0{v}", v * 10, v) for v in values], "Fiscal_Year string, v int, w long")


def test_second_build_replaces_the_first_and_open_readers_keep_theirs(spark, store):
    first = store.publish(weeks(spark, 1, 2), "m", ("Fiscal_Year",))
    opened = spark.table("t_marts.m")
    store.publish(weeks(spark, 2, 3), "m", ("Fiscal_Year",))
    assert rows(opened) == rows(first) == [("01", 10, 1), ("02", 20, 2)]
    assert rows(spark.table("t_marts.m")) == [("02", 20, 2), ("03", 30, 3)]
    assert [v.number for v in store.versions("m")] == [1, 2] and store.current("m").number == 2
    assert rows(store.read("m", 1)) == rows(first)


def test_types_order_and_partitions(spark, store):
    df = weeks(spark, 1, 2)
    got = store.publish(df, "m", ("Fiscal_Year",))
    assert got.dtypes == df.dtypes
    year = got.where("Fiscal_Year = '01'")
    assert rows(year) == [("01", 10, 1)]
    assert "PartitionFilters: [isnotnull(Fiscal_Year" in year._jdf.queryExecution().executedPlan().toString()


def test_another_session_queries_the_view(spark, store):
    store.publish(weeks(spark, 5), "m")
    other = spark.newSession()
    assert rows(other.table("t_marts.m")) == [("05", 50, 5)]


def test_a_failed_build_leaves_the_first(spark, store):
    store.publish(weeks(spark, 1), "m", ("Fiscal_Year",))
    bad = weeks(spark, 1, 2).withColumn("v", F.when(F.col("w") == 2, F.raise_error("broken")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        store.publish(bad, "m", ("Fiscal_Year",))

    def refuse(written):
        assert written.count() == 2
        raise ValueError("too few")
    with pytest.raises(ValueError, match="too few"):
        store.publish(weeks(spark, 1, 2), "m", ("Fiscal_Year",), refuse)
    assert rows(spark.table("t_marts.m")) == [("01", 10, 1)]
    assert [v.number for v in store.versions("m")] == [1]
    assert len(files.folders(spark, f"{store.base}/m")) == 1
    assert [t.name for t in spark.catalog.listTables("t_marts") if not t.name.startswith("m__")] == ["m"]


def test_a_build_is_not_shown_until_it_is(spark, store):
    store.publish(weeks(spark, 1), "m")
    staged = store.stage(weeks(spark, 2), "m", check=lambda df: {"rows": str(df.count())})
    assert rows(spark.table("t_marts.m")) == [("01", 10, 1)]
    assert store.version("m").properties == {"rows": "1"}
    store.show(staged)
    assert rows(spark.table("t_marts.m")) == [("02", 20, 2)]
    store.show(store.version("m", 1))                      # and back
    assert rows(spark.table("t_marts.m")) == [("01", 10, 1)]


def test_vacuum_keeps_the_newest_and_the_shown(spark, store):
    for w in range(1, 6):
        store.publish(weeks(spark, w), "m", ("Fiscal_Year",))
    store.show(store.version("m", 2))
    files.write_text(spark, f"{store.base}/m/v000001-lost/part", "x")          # a writer that was lost
    assert store.vacuum("m", keep=2) == [1, 3]
    assert [v.number for v in store.versions("m")] == [2, 4, 5]
    assert len(files.folders(spark, f"{store.base}/m")) == 3
    assert rows(spark.table("t_marts.m")) == [("02", 20, 2)]


def test_a_new_catalog_attaches_the_newest_build(spark, store):
    store.publish(weeks(spark, 1), "m", ("Fiscal_Year",))
    store.publish(weeks(spark, 2, 3), "m", ("Fiscal_Year",))
    spark.sql("DROP DATABASE t_marts CASCADE")
    again = MartStore(spark, store.base, "t_marts")
    with pytest.raises(LookupError):
        again.attach("other")
    got = again.attach("m")
    assert got.dtypes == weeks(spark, 1).dtypes
    assert rows(got) == rows(spark.table("t_marts.m")) == [("02", 20, 2), ("03", 30, 3)]
    assert again.publish(weeks(spark, 4), "m").count() == 1 and again.current("m").number == 3


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {x for folder in folders for x in glob.glob(f"{folder}/**/shuffle_*", recursive=True)}


def test_publish_view_frees_the_shuffles_behind_it(spark, small_dir, monkeypatch):
    """Those of the revenue aggregate are gone before the merge is written, the others before the view is
    read; the mart's rows, the widest, are in none."""
    def gone(before):
        until = time.time() + 20                                 # Spark frees them in the background
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        return not left

    start, staged = shuffle_files(spark), []
    whole = MartStore.stage
    monkeypatch.setattr(MartStore, "stage", lambda self, df, *a, **k: (staged.append((gone(start), df)), whole(self, df, *a, **k))[1])
    rows = E.queries()["publish_view"](spark, small_dir)
    assert gone(start)
    assert len(staged) == 1 and staged[0][0]
    assert rows.count() == marts.revenue_summary(Plan(adapters.load(spark, small_dir))).where("Fiscal_Year = 'FY2001'").count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_build_without_rebalance_has_the_files_of_its_tasks(spark, store):
    rows_ = weeks(spark, *range(1, 7)).withColumn("Fiscal_Year", F.lit("07")).repartition(3, "w")
    tasks = rows_.select(F.spark_partition_id()).distinct().count()
    got = store.publish(rows_, "m", ("Fiscal_Year",), rebalance=False)
    assert tasks > 1 and len(got.inputFiles()) == tasks
    assert rows(got) == rows(rows_) and got.dtypes == rows_.dtypes


# -- both marts, with the checks of their plans ------------------------------------------


def with_(inputs, **changes):
    fields = {f: getattr(inputs, f) for f in ("revenue", "opportunities", "targets", "calendar", "accounts", "sellers")}
    return Inputs(**(fields | changes))


def test_publish_marts_with_observed_counts(spark, small_dir, store):
    counts = publish_marts(Plan(adapters.load(spark, small_dir)), store=store)
    assert {k: counts[k] for k in ("revenue", "opportunity", "p1_clean_revenue", "p3_clean_opportunity", "p8_targets",
                                   "p10_run_rate_origins", "p10_run_rate", "p12_all_transactional", "p14_opportunity_detail")} == {
        "revenue": 6812, "opportunity": 1135, "p1_clean_revenue": 5600, "p3_clean_opportunity": 720, "p8_targets": 199,
        "p10_run_rate_origins": 47, "p10_run_rate": 157, "p12_all_transactional": 6812, "p14_opportunity_detail": 1135}
    assert spark.table("t_marts.revenue_summary").count() == 6812
    assert store.current("opportunity_summary").properties == {"rows": "1135"}


@pytest.mark.parametrize("lookup", ["accounts", "sellers", "calendar"])
def test_a_repeated_lookup_key_fails_the_build_of_both(spark, small_dir, store, lookup):
    inputs = adapters.load(spark, small_dir)
    publish_marts(Plan(inputs), store=store)
    if lookup == "calendar":
        cal = inputs.calendar
        odd = cal.df.where("Date_Value = '2000-03-05'").withColumn("Fiscal_Quarter", F.lit("Q9"))
        bad = with_(inputs, calendar=type(cal)(cal.df.unionByName(odd)))
    else:
        key = {"accounts": "AccountNo", "sellers": "Store_ID"}[lookup]
        dim = getattr(inputs, lookup)
        bad = with_(inputs, **{lookup: dim.unionByName(dim.orderBy(key).limit(1))})
    with pytest.raises(Exception, match=f"{lookup}: several rows of"):
        publish_marts(Plan(bad), store=store)
    for name in VIEW_NAMES.values():
        assert store.current(name).number == 1 and len(store.versions(name)) == 1
    # without the check the rows multiply, as in the worksheet
    assert marts.revenue_summary(Plan(bad)).count() > 6812


def test_checked_lookups_give_the_same_rows(spark, small_dir):
    inputs = adapters.load(spark, small_dir)
    plain = marts.revenue_summary(Plan(inputs))
    checked = marts.revenue_summary(Plan(inputs, PlanOptions(unique_lookups=True)))
    assert plain.exceptAll(checked).count() == 0 and checked.count() == 6812


def test_other_rows_than_the_step_before_are_refused(spark, small_dir, store, monkeypatch):
    whole = marts.with_lookups
    monkeypatch.setattr(marts, "with_lookups", lambda *a: whole(*a).where("Month_ID % 2 = 0"))
    with pytest.raises(RowsChanged, match=r"revenue: \d+ rows from 6812"):
        publish_marts(Plan(adapters.load(spark, small_dir)), store=store)
    assert store.current("revenue_summary") is None
