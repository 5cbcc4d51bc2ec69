"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words: everything between the six ASCII white-space characters.
ASCII_SPACE = " \t\n\v\f\r"


def importable(query):
    """`query(spark, ...)`, with this package's folder on the path of Python workers started for it.

    Clusters that don't have the package in that folder install it or get it by addPyFile.
    """
    @wraps(query)
    def run(spark: SparkSession, *args):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        env = spark.sparkContext.environment
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
        return query(spark, *args)

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new path under the folder that all executors share (`spark.checkpoint.dir`).

    Only a purely local session (tests) may fall back to a temporary folder; on
    a cluster without the setting this raises, because files in a machine's own
    folder are lost with that machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark.sparkContext, "_llm_scratch", None)
        if base is None:
            base = spark.sparkContext._llm_scratch = tempfile.mkdtemp(prefix="planmart-llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage, so
    later stages and lost executors read the table instead of computing it again.
    The files stay until the folder's own clean-up, because the result is lazy."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Rows go to Python in Arrow batches of about `size` bytes while jobs run inside: by rows alone, a
    batch of long texts takes tens of MB, and an executor holds several while it makes and sends one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns whose names an operator is about to add (any letter case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def hash_share(*cols) -> F.Column:
    """A number in [0, 1) from the XXH64 of `cols`: the same for the same values in every run."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_sample(df: DataFrame, by: str, bound: int, key: F.Column) -> DataFrame:
    """About `bound` rows of each value of `by` at most, with `weight` = rows that each stands for.

    Rows whose hash of `key` falls below bound / count are taken, so the choice
    needs one count per class and no sort, and equal texts go together.
    """
    # written, so that its size is known and the texts needn't move to meet a few classes
    counts = written(df.groupBy(F.col(by).alias("_class")).agg(F.count(F.lit(1)).alias("_n")))
    share = F.least(F.lit(1.0), F.lit(float(bound)) / F.col("_n"))
    return (df.join(counts, F.col(by).eqNullSafe(F.col("_class")))
              .where(hash_share(F.lit(17), key) < share)
              .withColumn("weight", F.lit(1.0) / share)
              .drop("_class", "_n"))


def all_of(conditions) -> F.Column:
    return reduce(lambda a, b: a & b, conditions)

