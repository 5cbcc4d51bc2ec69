"""Weekly opportunity snapshots as a stream, with week-on-week tracking.

Snapshots land as Parquet folders ``<landing>/Week=<n>/``, in any number of
files and in any order.  A Structured Streaming query stores the rows of each
micro-batch under (Week, Bucket, Batch): the bucket is a hash of the opportunity
and product, so a row of one week and its row of the week before always lie in
the same bucket.  Then changes are tracked again, with the DataFrame operator of
the batch mart (``insights.wow_tracking``), for what the batch can have changed:
its weeks and the week after each, in the buckets it has rows of (all buckets
for a week that is new or gets a new predecessor).  Other weeks and
buckets aren't read, so a batch's cost doesn't grow with the weeks stored.

All outputs are written with dynamic partition overwrite, so replaying a batch
after a failure rewrites the same partitions, and the checkpoint in the shared
folder makes the stream restartable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmart.plans import insights
from planmart.session import shared_dir
from planmart.sources import files, schemas

SNAPSHOT_SCHEMA = T.StructType(list(schemas.OPPORTUNITIES.fields)
                               + [T.StructField("Week", T.IntegerType())])
#: Folders that a week is dealt into; a stream keeps the number it was started with.
BUCKETS = 64
_STORED = T.StructType([*SNAPSHOT_SCHEMA.fields, T.StructField("Bucket", T.IntegerType()), T.StructField("Batch", T.LongType())])


def write_snapshot(df: DataFrame, landing: str, week: int) -> None:
    """Land one weekly snapshot (append; one folder per week)."""
    (df.withColumn("Week", F.lit(week)).write.mode("append")
       .partitionBy("Week").parquet(landing))


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    # a few files per partition, large ones split
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def bucket(buckets: int) -> F.Column:
    """The bucket of an opportunity and product; a NULL is a value of its own."""
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k), F.lit("\0")) for k in insights.WOW_KEYS]), F.lit(buckets)).cast("int")


def neighbours(weeks: list[int], week: int) -> tuple[int | None, int | None]:
    """The stored weeks right before and after `week`."""
    return max((w for w in weeks if w < week), default=None), min((w for w in weeks if w > week), default=None)


class SnapshotState:
    """The stored weeks and their changes below `out_dir`."""

    def __init__(self, spark: SparkSession, out_dir: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.snapshots, self.changes = f"{out_dir}/snapshots", f"{out_dir}/changes"

    def weeks(self) -> list[int]:
        """Stored weeks, from the names of their folders (one listing; no file is opened)."""
        return sorted(int(f.partition("=")[2]) for f in files.folders(self.spark, self.snapshots) if f.startswith("Week="))

    def rows(self, week: int | None, buckets: list[int] | None) -> DataFrame:
        """Rows of a stored week in some buckets (all: None): only their folders are listed and read."""
        wanted = None if buckets is None else {f"Bucket={b}" for b in buckets}
        folder = f"{self.snapshots}/Week={week}"
        paths = [f"{folder}/{b}" for b in files.folders(self.spark, folder) if wanted is None or b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schemas.OPPORTUNITIES)
        stored = self.spark.read.schema(_STORED).option("basePath", self.snapshots).parquet(*paths)
        return stored.drop("Week", "Bucket", "Batch")

    def track(self, week: int, buckets: list[int] | None, weeks: list[int]) -> None:
        """Changes of `week` against the stored week before it, in some buckets (all: None)."""
        before = neighbours(weeks, week)[0]
        tracked = insights.wow_tracking(self.rows(before, buckets), self.rows(week, buckets))
        _overwrite(tracked.withColumns({"Week": F.lit(week), "Bucket": bucket(self.buckets)}), self.changes, "Week", "Bucket")
        if buckets is None:
            # a bucket that only the former predecessor had rows in has no changes any more
            has = {b for w in (week, before) for b in files.folders(self.spark, f"{self.snapshots}/Week={w}")}
            for b in files.folders(self.spark, f"{self.changes}/Week={week}"):
                if b.startswith("Bucket=") and b not in has:
                    files.delete(self.spark, f"{self.changes}/Week={week}/{b}")

    def add(self, batch: DataFrame, batch_id: int) -> list[tuple[int, list[int] | None]]:
        """Store a micro-batch and bring the changes up to date; returns what was tracked again.

        A batch that is replayed finds its weeks stored already; that its first run got as far
        as tracking them isn't known, so its own marker decides whether a week counts as new.
        """
        held = batch.withColumns({"Bucket": bucket(self.buckets), "Batch": F.lit(batch_id).cast("long")}).persist()
        try:
            # a handful of weeks, and at most `buckets` numbers for each
            touched = {r["Week"]: sorted(r["b"]) for r in held.groupBy("Week").agg(F.collect_set("Bucket").alias("b")).collect()}
            marker = f"{self.snapshots}/_weeks/{batch_id}"
            if files.exists(self.spark, marker):
                known = [int(w) for w in files.read_text(self.spark, marker).split()]
            else:
                known = self.weeks()
                files.write_text(self.spark, marker, " ".join(map(str, known)))
            _overwrite(held, self.snapshots, "Week", "Bucket", "Batch")
        finally:
            held.unpersist()
        weeks = sorted({*self.weeks(), *touched})
        work: dict[int, list[int] | None] = {}
        for week, buckets in touched.items():
            again = None if week not in known else buckets       # a new week: also what it lacks
            for w in (week, neighbours(weeks, week)[1]):
                if w is None:
                    continue
                if again is None or work.get(w, []) is None:
                    work[w] = None
                else:
                    work[w] = sorted({*work.get(w, []), *again})
        for week, buckets in sorted(work.items()):
            self.track(week, buckets, weeks)
        return sorted(work.items())


def start_wow_stream(spark: SparkSession, landing: str, out_dir: str,
                     checkpoint: str | None = None, available_now: bool = True, buckets: int = BUCKETS):
    """Start the week-on-week stream; returns the StreamingQuery."""
    checkpoint = checkpoint or shared_dir(spark, "wow_checkpoint")
    state = SnapshotState(spark, out_dir, buckets)
    stream = (spark.readStream.schema(SNAPSHOT_SCHEMA)
              .option("basePath", landing).parquet(landing))
    writer = (stream.writeStream.foreachBatch(lambda batch, batch_id: state.add(batch, batch_id) and None)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def read_changes(spark: SparkSession, out_dir: str) -> DataFrame:
    """The tracked changes with their Week."""
    return spark.read.parquet(f"{out_dir}/changes").drop("Bucket")
