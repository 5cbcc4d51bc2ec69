"""Duplicate keys of steps with few rows a key, dealt out as they are."""

from pyspark.sql import functions as F

from planmart.plans import quality
from planmart.plans.clean import KEYS
from planmart.plans.planning import Plan
from planmart.sources import adapters


def rows(spark):
    """40,000 keys, a tenth of them twice; some parts NULL."""
    once = spark.range(40_000, numPartitions=4).select(
        F.when(F.col("id") % 1000 != 1, F.col("id").cast("string")).alias("Account_No"),
        F.concat(F.lit("Month "), F.col("id") % 12).alias("Fiscal_Month"),
        F.when(F.col("id") % 1000 > 2, F.lit("Services")).alias("Product_Category"))
    return once.unionByName(once.where("Account_No % 10 = 7"))


def test_dealt_rows_have_the_same_duplicates(spark):
    dealt, grouped = (quality.duplicate_keys(rows(spark), "step", few=few) for few in (True, False))
    assert dealt.count() > 4_000
    assert dealt.exceptAll(grouped).count() == 0 == grouped.exceptAll(dealt).count()


def test_a_task_holds_few_keys(spark):
    parts = quality.dealt(rows(spark), *KEYS).groupBy(*KEYS).count().groupBy(F.spark_partition_id()).count().collect()
    assert max(p["count"] for p in parts) < 3 * 40_000 / (4 * spark.sparkContext.defaultParallelism)


def test_steps_of_few_rows_a_key_are_dealt(spark, small_dir):
    """Revenue, opportunity, baseline and run rate; targets and lookups are counted before the shuffle."""
    text = quality.audit_key_uniqueness(Plan(adapters.load(spark, small_dir)))._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") == 4
