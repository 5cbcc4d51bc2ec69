"""Week-on-week tracking as a restartable Structured Streaming query."""

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from planmart.plans import insights
from planmart.session import shared_dir
from planmart.sources import adapters, schemas
from planmart.streaming import snapshots


def counts(df):
    return {r["Change_Type"]: r["count"] for r in df.groupBy("Change_Type").count().collect()}


def test_stream_tracks_weeks_and_restarts(spark, small_dir):
    landing, out = shared_dir(spark, "t_landing"), shared_dir(spark, "t_out")
    ckpt = shared_dir(spark, "t_ckpt")
    cur = adapters.opportunities(spark, small_dir)
    snapshots.write_snapshot(adapters.opportunities_prev(spark, small_dir), landing, 24)
    snapshots.write_snapshot(cur, landing, 25)
    snapshots.start_wow_stream(spark, landing, out, ckpt).awaitTermination()
    changes = snapshots.read_changes(spark, out)
    assert counts(changes.filter(F.col("Week") == 25)) == {
        "Changed": 295, "Dropped": 66, "New": 116, "Unchanged": 1089}
    assert set(counts(changes.filter(F.col("Week") == 24))) == {"New"}

    # A new week lands; the restarted query only processes the new files.
    snapshots.write_snapshot(cur, landing, 26)
    snapshots.start_wow_stream(spark, landing, out, ckpt).awaitTermination()
    changes = snapshots.read_changes(spark, out)
    week26 = counts(changes.filter(F.col("Week") == 26))
    assert set(week26) == {"Unchanged"}
    assert counts(changes.filter(F.col("Week") == 25))["Changed"] == 295


def test_split_and_late_weeks(spark, small_dir):
    """A week that lands in two runs is whole, and a late earlier week is compared again."""
    landing, out, ckpt = (shared_dir(spark, f"t_late_{x}") for x in ("landing", "out", "ckpt"))
    cur, prev = adapters.opportunities(spark, small_dir), adapters.opportunities_prev(spark, small_dir)
    half = F.pmod(F.xxhash64("Opportunity_ID"), F.lit(2)) == 0
    for df, week in ((cur.where(half), 25), (prev, 23), (cur.where(~half), 25)):
        snapshots.write_snapshot(df, landing, week)
        snapshots.start_wow_stream(spark, landing, out, ckpt).awaitTermination()
    expected = counts(insights.wow_tracking(prev, cur))
    assert counts(snapshots.read_changes(spark, out).filter(F.col("Week") == 25)) == expected


def snapshot(spark, ids, usage=None):
    rows = [("a", date(2001, 1, 1), None if i % 5 == 0 else "Product: x", None if i == 3 else str(i), "n", "Active", "O", "s",
             (usage or {}).get(i, "1.00")) for i in ids]
    return spark.createDataFrame(rows, schemas.OPPORTUNITIES)


def weekly(spark, weeks):
    """Rows of (week, batch frame) pairs."""
    return [df.withColumn("Week", F.lit(w).cast("int")) for w, df in weeks]


def expected(spark, stored):
    """Each week against the stored week before it, by the batch operator."""
    out = Counter()
    weeks = sorted(stored)
    for i, w in enumerate(weeks):
        cur = snapshot(spark, *stored[w])
        prev = snapshot(spark, *stored[weeks[i - 1]]) if i else cur.limit(0)
        out.update((w, *tuple(r)) for r in insights.wow_tracking(prev, cur).collect())
    return out


def got(spark, out):
    df = snapshots.read_changes(spark, out)
    return Counter((r["Week"], *(r[c] for c in df.columns if c != "Week")) for r in df.collect())


def test_a_correction_touches_its_buckets_and_neighbours_only(spark):
    out = shared_dir(spark, "t_buckets")
    state = snapshots.SnapshotState(spark, out, 16)
    ids = range(1, 40)
    for n, w in enumerate((20, 21, 22, 23)):
        assert state.add(weekly(spark, [(w, snapshot(spark, ids))])[0], n) == [(w, None)]
    late = weekly(spark, [(21, snapshot(spark, [100, 101]))])[0]
    buckets = sorted({r["b"] for r in late.select(snapshots.bucket(16).alias("b")).collect()})
    assert state.add(late, 4) == [(21, buckets), (22, buckets)]
    assert got(spark, out) == expected(spark, {20: (ids,), 21: ([*ids, 100, 101],), 22: (ids,), 23: (ids,)})
    read = state.rows(21, buckets).inputFiles()
    assert read and all("Week=21/" in f and any(f"Bucket={b}/" in f for b in buckets) for f in read)


def test_replayed_batches_change_nothing(spark):
    out = shared_dir(spark, "t_replay")
    state = snapshots.SnapshotState(spark, out, 4)
    batches = weekly(spark, [(1, snapshot(spark, range(1, 12))), (3, snapshot(spark, range(5, 15), {6: "2.00"})), (2, snapshot(spark, [6, 90]))])
    done = [state.add(b, n) for n, b in enumerate(batches)]
    assert done[2] == [(2, None), (3, None)]                     # week 3 has another predecessor now
    want = expected(spark, {1: (range(1, 12),), 2: ([6, 90],), 3: (range(5, 15), {6: "2.00"})})
    assert got(spark, out) == want
    assert state.add(batches[2], 2) == done[2]                   # its weeks count as new again
    for n, b in enumerate(batches):
        state.add(b, n)
    assert got(spark, out) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_parts_ends_in_the_batch_result(spark, seed):
    rng = random.Random(seed)
    stored = {w: rng.sample(range(1, 60), 25) for w in (7, 8, 9)}
    parts = [(w, ids[i::2]) for w, ids in stored.items() for i in range(2)]
    rng.shuffle(parts)
    out = shared_dir(spark, "t_parts")
    state = snapshots.SnapshotState(spark, out, 4)
    for n, (w, ids) in enumerate(parts):
        state.add(weekly(spark, [(w, snapshot(spark, ids))])[0], n)
    assert got(spark, out) == expected(spark, {w: (ids,) for w, ids in stored.items()})
