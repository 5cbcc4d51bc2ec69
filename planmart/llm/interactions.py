"""Filter interaction audit: what each filter removes, and what others had removed before, in every order.

A document is reduced to its mask of failed filters where it is read, so the
orders never meet documents: per part at most 2^filters masks with their
document counts.  With M[mask, filter] = 0 where the mask fails the filter and
infinity elsewhere, and P[order, filter] the filter's position in the order
(the inverse permutation), the min-plus product of M and the transpose of P is
the step at which an order removes a mask.  Counts are scattered by that step.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.llm.common import written

FILTERS = "ABCDE"
WORD_GAP = r"[\x20\x09-\x0D]+"
_OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long")


def positions(filters: str) -> tuple[list[str], np.ndarray]:
    """All orders of `filters`, and for each the position of every filter in it (inverse permutations)."""
    orders = ["".join(p) for p in itertools.permutations(filters)]
    return orders, np.array([[order.index(f) for f in filters] for order in orders], np.int64).reshape(len(orders), -1)


def removal_steps(fails: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: for each mask (row of `fails`) and order the step that removes it, from 0;
    the number of filters where none does."""
    never = places.shape[1]
    cost = np.where(fails, 0, never)                              # masks x filters
    return np.minimum((cost[:, None, :] + places[None, :, :]).min(axis=2, initial=never), never)


def tally(part: str, masks: np.ndarray, weights: np.ndarray, filters: str) -> pd.DataFrame:
    """The rows of one part from its masks; `weights` has documents, good and toxic ones by mask."""
    k, (orders, places) = len(filters), positions(filters)
    fails = (masks[:, None] >> np.arange(k)) & 1 > 0
    steps = removal_steps(fails, places)                          # masks x orders
    lost = np.zeros((3, len(orders), k + 1), np.int64)            # documents, good, toxic by order and step
    at = np.broadcast_to(np.arange(len(orders)), steps.shape)
    for into, weight in zip(lost, weights, strict=True):
        np.add.at(into, (at, steps), weight[:, None])
    removed = lost[0, :, :k]
    kept = weights[0].sum() - np.cumsum(removed, axis=1)
    # a filter at position p is redundant on the masks that fail it and went before p
    earlier = fails[:, None, :] & (steps[:, :, None] < places[None, :, :])
    redundant = np.einsum("mof,m->of", earlier, weights[0])       # orders x filters
    alone = np.array([weights[0][masks == 1 << f].sum() for f in range(k)], np.int64)
    mine = np.take_along_axis(removed, places, axis=1)            # removed by filter, not by step
    shapley = mine.sum(axis=0)
    rows = []
    for o, order in enumerate(orders):
        for step, name in enumerate(order):
            f = filters.index(name)
            rows.append((part, order, step + 1, kept[o, step], removed[o, step], redundant[o, f], alone[f],
                         lost[1, o, step], lost[2, o, step], shapley[f]))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For every part and order of `filters` a row per step, from `masks` (part, mask, good, toxic: booleans).

    Bit i of `mask` says that the row fails the i-th filter; NULL parts are
    the part '', NULL flags count as false and a NULL mask fails nothing.  Rows are added up by
    (part, mask) before the shuffle, so a part that holds a third of all rows
    is 2^filters rows like any other.  No rows give no parts.
    """
    one = lambda c: F.sum(F.coalesce(F.col(c), F.lit(False)).cast("long"))
    counts = (masks.groupBy(F.coalesce("part", F.lit("")).alias("part"), F.coalesce("mask", F.lit(0)).cast("int").alias("mask"))
              .agg(F.count(F.lit(1)).alias("docs"), one("good").alias("good"), one("toxic").alias("toxic")))

    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        weights = group[["docs", "good", "toxic"]].to_numpy(np.int64).T
        return tally(key[0], group["mask"].to_numpy(np.int64), weights, filters)

    return counts.groupBy("part").applyInPandas(of, _OUT)


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides (it isn't NULL), by filter."""
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(text) - F.octet_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < 200, "B": 100 * different < 50 * n, "C": 100 * capitals > 3 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def _mask(failures: Mapping[str, Column], filters: str) -> Column:
    out = F.lit(0)
    for i, f in enumerate(filters):
        if f in failures:
            out = out + F.when(failures[f], 1 << i).otherwise(0)
    return out


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good and toxic of every row of `docs` (doc_id, text, lang).

    NULL texts are empty.  E compares whole texts by SHA-256 with the smallest doc_id of
    each repeated text: a row with that id or a NULL one doesn't fail.  Texts
    are read once and don't move; the repeated ones are counted before the
    shuffle.  A document with several labels is good or toxic if one says so;
    NULL ids have no label.  Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("part"),
                       text.alias("text"))
    rows = written(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"),
                               _mask(text_failures(F.col("text")), FILTERS).alias("mask")))
    same = written(rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 AND first IS NOT NULL").drop("n"))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("of"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("good OR toxic"))
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return (rows.join(same, "key", "left").join(written(marks), F.col("doc_id") == F.col("of"), "left")
            .select("part", (F.col("mask") + copy).alias("mask"), "good", "toxic"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
m AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT f1.f || f2.f || f3.f || f4.f || f5.f AS filter_order FROM f f1, f f2, f f3, f f4, f f5
    WHERE len(list_distinct([f1.f, f2.f, f3.f, f4.f, f5.f])) = 5),
x AS (SELECT g.*, filter_order, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
      || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS bad
    FROM g, o),
s AS (SELECT part, n, good, toxic, bad, filter_order, step, filter_order[step] AS f,
      length(regexp_replace(filter_order[1:step - 1], '[^' || CASE WHEN bad = '' THEN '-' ELSE bad END || ']', '', 'g')) > 0 AS gone
    FROM x, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT contains(bad, f)), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND contains(bad, f)), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND contains(bad, f)), 0) AS redundant,
    coalesce(sum(n) FILTER (bad = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND contains(bad, f)), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND contains(bad, f)), 0) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
