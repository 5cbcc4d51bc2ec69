"""Exact top-k inner products over a bit-sliced index.

Rows are cut into blocks.  A block's index holds, for each vector component
and each bit of its quantised value, a bitmap over the block's rows.  A query's
scores are added up for all rows at once with bitmap arithmetic (full adders
over whole bitmaps), which gives the score's own slices; the best rows are then
selected from the most significant slice downward.  Rows left undecided after
the last slice have equal scores; they are resolved exactly by vec_id.

Queries meet row blocks in an equi-join of (block, query block) pairs; every
block gives its best k, and the best of those are the answer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planmart.llm.common import written

SCALE = 256.0
LONG = float(1 << 63)      # a quantised component must be a long
ROWS_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 1024
_INDEX = "dims int, block int, n int, bits int, low long, ids binary, slices binary"
_QUERIES = "dims int, part int, ids binary, marks binary, vectors binary"


def quantised(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, dims, q): floor(256 * x) of each component.  Vectors that are NULL, have a
    NULL or non-finite component, or no vec_id, take no part; rows repeated in full
    count once.  A component that isn't a long once quantised is an error."""
    x = F.col("e")
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    wide = F.raise_error(F.lit("a quantised component doesn't fit 64 bits")).cast("long")
    return (vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                           F.col(f"`{embedding}`").cast("array<double>").alias("e"))
            .where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
            .select("vec_id", F.size(x).alias("dims"),
                    F.transform(x, lambda v: F.when((v * SCALE >= LONG) | (v * SCALE < -LONG), wide)
                                .otherwise(F.floor(v * SCALE))).alias("q")).distinct())


def build_slices(values: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(low, bits, slices): slices[d, b] is the bitmap of bit b of component d less `low`,
    64 rows to a word."""
    n, dims = values.shape
    low = int(values.min()) if values.size else 0
    up = values.astype(np.uint64) - np.uint64(low % (1 << 64))         # below 2^64, also where values - low isn't a long
    bits = max(1, int(up.max()).bit_length()) if values.size else 1
    words = -(-max(n, 1) // 64)
    slices = np.zeros((dims, bits, words * 8), np.uint8)
    for b in range(bits):
        bit = ((up >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        slices[:, b, :-(-n // 8)] = np.packbits(bit, axis=0, bitorder="little").T
    return low, bits, slices.view(np.uint64)


def add_up(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Slices (least significant first) of sum |q_d| * v_d over the rows, where v_d is component d, or
    its complement where q_d < 0; addends of one weight meet in full adders three at a time."""
    dims, bits, words = slices.shape
    size = np.where(query < 0, -query, query).astype(np.uint64)         # also of the least long
    signed = slices ^ np.where(query < 0, ~np.uint64(0), np.uint64(0))[:, None, None]
    chosen = [np.flatnonzero((size >> np.uint64(j)) & np.uint64(1)) for j in range(int(size.max()).bit_length() if dims else 0)]
    carried: list[np.ndarray] = []
    total: list[np.ndarray] = []
    weight = 0
    while weight < len(chosen) + bits - 1 or carried:
        stack = [signed[at, weight - j] for j, at in enumerate(chosen) if 0 <= weight - j < bits and len(at)]
        rows = np.concatenate([*stack, *carried]) if stack or carried else np.zeros((1, words), np.uint64)
        carried = []
        while len(rows) > 1:
            if len(rows) == 2:
                carried.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
                break
            k = len(rows) // 3
            a, b, c = rows[:k], rows[k:2 * k], rows[2 * k:3 * k]
            half = a ^ b
            carried.append((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rows[3 * k:]])
        total.append(rows[0])
        weight += 1
    return total, signed


def select_top(slices: list[np.ndarray], rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (sure, tied) over `rows`: the rows surely among the k highest, and those of
    equal score of which the rest is to be taken."""
    sure, open_ = np.zeros_like(rows), rows
    for s in reversed(slices):
        high = open_ & s
        n = int(np.bitwise_count(sure | high).sum())
        if n > k:
            open_ = high
        else:
            sure = sure | high
            if n == k:
                return sure, np.zeros_like(rows)
            open_ = open_ & ~s
    return sure, open_


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def block_top(ids: np.ndarray, low: int, slices: np.ndarray, query_id: int, query: np.ndarray,
              k: int) -> list[tuple[int, int]]:
    """The k best (vec_id, score) of one block, whose rows are in order of vec_id."""
    bits = slices.shape[1]
    words = slices.shape[2]
    total, _ = add_up(slices, query)
    rows = np.zeros(words * 64, np.uint8)
    rows[:len(ids)] = ids != query_id
    sure, tied = select_top(total, np.packbits(rows, bitorder="little").view(np.uint64), k)
    at = positions(sure)
    at = np.concatenate([at, positions(tied)[:max(0, k - len(at))]])
    exact = query.tolist()                       # Python's integers have no bound
    back = low * sum(exact) - ((1 << bits) - 1) * sum(-x for x in exact if x < 0)
    score = np.zeros(len(at), object if len(total) > 62 else np.int64)
    for w, s in enumerate(total):
        score += ((s[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(score.dtype) << w
    found = [(int(ids[i]), int(x) + back) for i, x in zip(at, score, strict=True)]
    if any(not -(1 << 63) <= x < 1 << 63 for _, x in found):
        raise OverflowError(f"a score of query {query_id} doesn't fit 64 bits")
    return found


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block of `quantised` rows: its vec_ids in order and its slices."""
    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(group["vec_id"].to_numpy(), kind="stable")
        values = np.array(group["q"].tolist(), np.int64).reshape(len(group), -1)[order]
        low, bits, slices = build_slices(values)
        return pd.DataFrame([(int(key[0]), int(key[1]), len(group), bits, low,
                              group["vec_id"].to_numpy(np.int64)[order].tobytes(), slices.tobytes())],
                            columns=[x.split()[0] for x in _INDEX.split(", ")])

    block = F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)).cast("int")
    return rows.withColumn("block", block).groupBy("dims", "block").applyInPandas(of, _INDEX)


def pack_queries(rows: DataFrame, parts: int) -> DataFrame:
    """One row per block of queries: ids, a mark that tells vectors of one id apart, vectors."""
    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(int(key[0]), int(key[1]), group["vec_id"].to_numpy(np.int64).tobytes(),
                              group["mark"].to_numpy(np.int64).tobytes(),
                              np.array(group["q"].tolist(), np.int64).tobytes())],
                            columns=[x.split()[0] for x in _QUERIES.split(", ")])

    marked = rows.withColumn("mark", F.xxhash64("q"))
    part = F.pmod(F.xxhash64("vec_id", "q"), F.lit(parts)).cast("int")
    return marked.withColumn("part", part).groupBy("dims", "part").applyInPandas(of, _QUERIES)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
          rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` where `is_query` (over vec_id), the k
    rows of other vec_ids with the highest integer inner product; ties to the smaller vec_id.

    Only vectors of equal length are compared.  Of a vec_id with several
    vectors each is a candidate, and each is a query with ranks of its own.
    Fewer candidates than k give as many rows as there are; none gives none.
    Components may have any size; a result whose score doesn't fit a long is an error.
    """
    rows = written(quantised(vectors, vec_id, embedding))
    queries = rows.where(is_query)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks = max(1, -(-size["n"] // rows_per_block))
    parts = max(1, -(-size["q"] // queries_per_block))
    index = written(build_index(rows, blocks))
    pairs = (index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
             .join(pack_queries(queries, parts).toDF("dims", "part", "query_ids", "marks", "vectors")
                   .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))),
                   ["dims", "block", "part"]))

    def of(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                slices = np.frombuffer(r["slices"], np.uint64).reshape(r["dims"], r["bits"], -1) if r["dims"] \
                    else np.zeros((0, r["bits"], -(-len(ids) // 64)), np.uint64)
                query_ids = np.frombuffer(r["query_ids"], np.int64)
                marks = np.frombuffer(r["marks"], np.int64)
                queries = np.frombuffer(r["vectors"], np.int64).reshape(len(query_ids), -1)
                out = [(int(q), int(m), v, s) for q, m, x in zip(query_ids, marks, queries, strict=True)
                       for v, s in block_top(ids, r["low"], slices, int(q), x, k)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                     ["query_id", "mark", "vec_id", "score"])

    best = pairs.mapInArrow(of, "query_id long, mark long, vec_id long, score long")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM c a JOIN c b ON a.d = b.d AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
