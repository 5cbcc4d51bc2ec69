"""Join operators of the marts: keyed FULL OUTER merge, its union form, lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

WIDE_MONEY = "decimal(38,6)"


def full_outer_coalesce(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        left_measures: Sequence[str], right_measures: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN on ``keys``; keys are coalesced, missing measures become 0.

    Plain equality: a NULL key part never matches, so such rows stay separate.
    Both inputs are expected at (or near) one row per key, which bounds the
    fan-out and keeps hot accounts from concentrating in one task.
    """
    lhs, rhs = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda a, b: a & b, [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in keys])
    joined = lhs.join(rhs, cond, "full")
    return joined.select(
        *[F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(f"_l.{m}"), F.lit(0)).alias(m) for m in left_measures],
        *[F.coalesce(F.col(f"_r.{m}"), F.lit(0)).alias(m) for m in right_measures])


def full_outer_repeating(base: DataFrame, rows: DataFrame, keys: Sequence[str],
                         base_measures: Sequence[str], row_measures: Sequence[str]) -> DataFrame:
    """The same FULL OUTER JOIN where `rows` may repeat a key without bound (`base` has few rows a key).

    A full join can't be split at run time, and gathering a key's rows puts all of them
    into one task.  So the join is taken apart: `rows` LEFT JOIN `base`, where
    adaptive execution splits a partition that a hot key fills and each part
    meets the key's few base rows, and the `base` rows whose key `rows` lacks.
    Both parts read the same shuffle of `base`: keys are compared null-safely (a filter on
    NULLs would make the two differ) and a mark per input keeps NULL parts from matching.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    lhs = rows.select(*keys, *row_measures, F.when(any_null, 1).otherwise(-1).alias("_part"))
    rhs = base.select(*keys, *base_measures, F.when(any_null, 0).otherwise(-1).alias("_part"))

    def on(a: str, b: str):
        same = [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
        return reduce(lambda x, y: x & y, [*same, F.col(f"{a}._part") == F.col(f"{b}._part")])

    met = lhs.alias("_r").join(rhs.alias("_b").hint("merge"), on("_r", "_b"), "left")
    known = lhs.select(*keys, "_part").distinct()
    alone = rhs.alias("_b").join(known.alias("_k").hint("merge"), on("_b", "_k"), "left_anti")
    return met.select(
        *[F.col(f"_r.{k}").alias(k) for k in keys],
        *[F.coalesce(F.col(f"_b.{m}"), F.lit(0)).alias(m) for m in base_measures],
        *[F.coalesce(F.col(f"_r.{m}"), F.lit(0)).alias(m) for m in row_measures]).unionByName(alone.select(
            *keys, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in base_measures],
            *[F.lit(0).cast(rows.schema[m].dataType).alias(m) for m in row_measures]))


def marks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of `rows` without a NULL part, each once, with `_marked` 1: an input of
    ``cogroup_full_outer`` that says which keys `rows` holds."""
    held = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return rows.where(held).select(*keys).distinct().withColumn("_marked", F.lit(1))


def full_outer_marked(base: DataFrame, rows: DataFrame, keys: Sequence[str],
                      base_measures: Sequence[str], row_measures: Sequence[str]) -> list[DataFrame]:
    """``full_outer_repeating`` in its two parts, for a `base` whose `_marked` is 1 where `rows` has the key (``marks``).

    The `base` rows that stay alone are told by their mark and not moved again, so they keep
    the partitioning of `base`; only the others are shuffled to meet `rows`.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    lhs = rows.select(*keys, *row_measures, F.when(any_null, 1).otherwise(-1).alias("_part"))
    rhs = base.where("_marked = 1").select(*keys, *base_measures, F.lit(-1).alias("_part"))
    same = [F.col(f"_r.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in (*keys, "_part")]
    met = lhs.alias("_r").join(rhs.alias("_b").hint("merge"), reduce(lambda x, y: x & y, same), "left")
    alone = base.where("_marked = 0").select(
        *keys, *base_measures, *[F.lit(0).cast(rows.schema[m].dataType).alias(m) for m in row_measures])
    return [alone, met.select(
        *[F.col(f"_r.{k}").alias(k) for k in keys],
        *[F.coalesce(F.col(f"_b.{m}"), F.lit(0)).alias(m) for m in base_measures],
        *[F.coalesce(F.col(f"_r.{m}"), F.lit(0)).alias(m) for m in row_measures])]


def union_combine(parts: Sequence[tuple[DataFrame, Sequence[str]]],
                  keys: Sequence[str], partition_by: str | None = None) -> DataFrame:
    """Union-form merge: align the measure columns, UNION ALL, one grouped SUM.

    One shuffle for any number of inputs instead of one per FULL OUTER JOIN
    level.  Rows with the same key from the same input are added up, NULL
    key parts group together, and a sum of NULLs only is 0 as in the join form.  With ``partition_by`` the shuffle is on that
    key column alone, so later joins on it (the account lookups) reuse it.
    """
    measures: list[str] = []
    for _, ms in parts:
        measures += [m for m in ms if m not in measures]
    zero = F.lit(0).cast(WIDE_MONEY)
    aligned = [df.select(*keys, *[(F.col(m).cast(WIDE_MONEY) if m in ms else zero).alias(m)
                                  for m in measures])
               for df, ms in parts]
    unioned = reduce(DataFrame.unionByName, aligned)
    if partition_by:
        unioned = unioned.repartition(partition_by)
    return unioned.groupBy(*keys).agg(*[F.coalesce(F.sum(m), zero).alias(m) for m in measures])


def cogroup_full_outer(sources: Sequence[tuple[DataFrame, dict[int, Sequence[str]]]],
                       keys: Sequence[str], partition_by: str | None = None) -> DataFrame:
    """Nested FULL OUTER JOINs on ``keys`` computed with a single shuffle.

    For a key present in some inputs, chained full joins return the cross
    product of each input's rows for that key (an absent input counts as one
    row of NULLs); rows whose key has a NULL part never match anything.  Here
    every input is tagged, unioned and sorted by key once: ``collect_list`` over a
    key's rows gathers each input's and ``explode_outer`` rebuilds the cross
    product.  So inputs must be aggregated to a bounded number of rows per key; one that
    may repeat a key joins by ``full_outer_repeating``.  NULL-key rows are grouped
    per input only, which keeps them unmatched exactly like the joins do.

    A source is a DataFrame and the inputs it holds: {number: measures}.  With
    several inputs its column ``_side`` says which one a row belongs to, so one
    pass over a feed can serve more than one input.
    """
    sides = dict(sorted((n, ms) for _, held in sources for n, ms in held.items()))
    types = {n: T.StructType([T.StructField(m, df.schema[m].dataType) for m in ms])
             for df, held in sources for n, ms in held.items()}
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    tagged = []
    for df, held in sources:
        side = F.col("_side") if len(held) > 1 else F.lit(next(iter(held)))
        tagged.append(df.select(
            *keys, F.when(any_null, side).otherwise(F.lit(-1)).alias("_null_side"),
            *[(F.when(side == n, F.struct(*ms)) if n in held else F.lit(None)).cast(types[n]).alias(f"_s{n}")
              for n, ms in sides.items()]))
    unioned = reduce(DataFrame.unionByName, tagged)
    if partition_by:
        unioned = unioned.repartition(partition_by)
    # One sort brings a key's rows together and its first row takes the lists. A grouped
    # collect_list sorts the rows, then once more the lists, written out between the two.
    per_key = Window.partitionBy(*keys, "_null_side").orderBy("_null_side")
    whole = per_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (unioned.select(*keys, *[F.collect_list(f"_s{n}").over(whole).alias(f"_l{n}") for n in sides],
                          F.row_number().over(per_key).alias("_row"))
           .where("_row = 1").drop("_row"))
    for n in sides:
        rest = [c for c in out.columns if c != f"_l{n}"]
        out = out.select(*rest, F.explode_outer(f"_l{n}").alias(f"_e{n}"))
    return out.select(*keys, *[F.coalesce(F.col(f"_e{n}.{m}"), F.lit(0)).alias(m)
                               for n, ms in sides.items() for m in ms])


def unique_by(dim: DataFrame, key: str, name: str) -> DataFrame:
    """``dim`` with an assertion inside the plan: a key that it holds twice fails the job that
    reads it.  A lookup by such a key can't add rows.  NULL keys, which never match, go.

    Rows are counted before the shuffle on the key, which a large join then reuses.
    """
    rest = [c for c in dim.columns if c != key]
    one = (dim.where(F.col(key).isNotNull()).groupBy(key)
           .agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_row")))
    message = F.concat(F.lit(f"{name}: several rows of {key} "), F.col(key).cast("string"))
    sure = F.when(F.col("_n") > 1, F.raise_error(message).cast(dim.schema[key].dataType)).otherwise(F.col(key))
    return one.select(sure.alias(key), *[F.col(f"_row.{c}").alias(c) for c in rest])


def left_lookup(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
                columns: Sequence[str], keep_key: bool = False) -> DataFrame:
    """LEFT JOIN a dimension by key and append its ``columns``.

    No broadcast hint: the planner broadcasts by its size statistics, and
    adaptive execution re-plans from the real shuffle size (or splits skewed
    partitions of ``df``) when the dimension is large.
    """
    key = f"_key_{dim_key}"
    d = dim.select(F.col(dim_key).alias(key), *columns)
    out = df.join(d, df[left_key] == d[key], "left")
    # ``keep_key`` leaves the helper column to the caller's final projection.
    return out if keep_key else out.drop(key)
