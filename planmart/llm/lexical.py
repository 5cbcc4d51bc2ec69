"""Ranked lexical search over posting lists that are blocked by document similarity.

Documents become sparse vectors over the terms that the items hold; other terms
can't change a score.  Within a shard of documents each term has a posting
list.  A list is cut into geometric blocks: its documents are clustered around
documents of its own by the similarity of their vectors, and each block stores the
coordinatewise maximum of its vectors.  An item meets the lists of its terms,
the most valuable first; a block is skipped when the item's product with its summary,
an exact upper bound of every score in it, is below the k-th best score so
far, and the remaining lists when the sum of their maxima is.  Nothing else is
left out, so results are those of scoring all documents.

Shards are runs of documents of one task, so a frequent term's list never
gathers in one place, and tasks return k documents per item at most.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planmart.llm.common import written
from planmart.llm.pieces import forget, runs, slices_of, trim

ITEM_BYTES = 256 << 10   # text of different items that one pass over the documents serves, about
RUN_BYTES = 4 << 20      # text that is cut into terms together, about
SHARD_CELLS = 4 << 20    # cells of a shard's matrix (documents x terms), at most; at least LEAST_DOCS documents
LEAST_DOCS = 64
BLOCK_DOCS = 32          # documents of a block, about
SKETCH = 64              # dimensions in which documents are compared for clustering
SALTS = 64

#: Separators become blanks and A-Z lower case; what is left between blanks are the terms.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BLANK = re.compile(rb" ")


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLDED).split()


def counted(texts: list[str | None], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each text, then for each text and vocabulary term found in it: text, term, count; by text and term)."""
    size, n = len(vocabulary), np.zeros(len(texts), np.int64)
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    folded = [t.encode().translate(FOLDED) if t else b"" for t in texts]
    for owners, parts in runs(folded, _BLANK, RUN_BYTES):
        lists = pc.ascii_split_whitespace(pa.array(parts, pa.large_binary()).view(pa.large_string()))
        words = lists.flatten()
        owner = np.repeat(np.array(owners, np.int64), np.diff(lists.offsets.to_numpy()))
        real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        n += np.bincount(owner[real], minlength=len(texts))
        at = pc.fill_null(pc.index_in(words, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        found, often = np.unique((owner * size + at)[at >= 0], return_counts=True)
        keys.append(found)
        times.append(often)
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    often = np.zeros(len(found), np.int64)
    np.add.at(often, where, np.concatenate(times))
    return n, found // max(1, size), found % max(1, size), often


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats), terms and counts (of the vocabulary) of every row of `docs` with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = pa.array(sent.value, pa.large_binary()).view(pa.large_string())
        for batch in batches:
            for part in slices_of(batch, "text", RUN_BYTES):
                n, text, term, often = counted(part.column("text").to_pylist(), known)
                offsets = pa.array(np.searchsorted(text, np.arange(len(n) + 1)).astype(np.int32))
                out = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n),
                     pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(often))], ["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))
            trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, n long, terms array<int>, counts array<long>")


@dataclass
class Items:
    """A block of items over one vocabulary: which terms each holds and how often."""
    keys: list[str]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    weights: np.ndarray        # of the vocabulary
    n_docs: int
    n_terms: int
    k: int

    def __post_init__(self) -> None:
        # the columns that a list's summaries need: terms of the items that hold the list's term
        held: list[set[int]] = [set() for _ in self.weights]
        for mine in self.terms:
            for t in mine.tolist():
                held[t].update(mine.tolist())
        self.columns = [np.array(sorted(x), np.int64) for x in held]
        # products stay exact in doubles (vectorised) while no score can reach 2^53
        most = max((int(t.sum()) for t in self.times), default=0) * int(self.weights.max(initial=0)) * 10**6
        self.kind = np.float64 if most < 1 << 53 else np.int64

    def values(self, n: np.ndarray, term: np.ndarray, often: np.ndarray) -> np.ndarray:
        """weight * ((10^9 tf) div (1000 tf + 8 m)) of occurrences in documents of `n` terms."""
        wide = object if 75 * self.n_docs * int(n.max(initial=0)) >= 1 << 63 else np.int64
        m = (25 + 75 * n.astype(wide) * self.n_docs // max(1, self.n_terms)).astype(np.int64)
        return self.weights[term] * (10**9 * often // (1000 * often + 8 * m))


class Shard:
    """The vectors of some documents, and the blocked posting lists of the terms that are asked for."""

    def __init__(self, items: Items, doc: np.ndarray, term: np.ndarray, value: np.ndarray, size: int):
        self.items, self.size = items, size
        self.matrix = np.zeros((size, len(items.weights)), items.kind)
        self.matrix[doc, term] = value
        order = np.argsort(term, kind="stable")
        self.docs = doc[order]
        self.starts = np.searchsorted(term[order], np.arange(len(items.weights) + 1))
        self.most = self.matrix.max(axis=0, initial=0)
        sketch = np.zeros((size, SKETCH))
        np.add.at(sketch, (doc, term % SKETCH), value.astype(np.float64))
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1.0)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents in block order, where blocks begin and the last ends, summaries: blocks x columns of the term)."""
        if term not in self.lists:
            docs = self.docs[self.starts[term]:self.starts[term + 1]]
            about = -(-len(docs) // BLOCK_DOCS)
            if about > 1:
                near = self.sketch[docs] @ self.sketch[docs[::BLOCK_DOCS]].T
                cluster = near.argmax(axis=1)
                docs = docs[np.argsort(cluster, kind="stable")]
                sizes = np.bincount(cluster, minlength=about)
                begins = np.concatenate([np.arange(b, b + n, BLOCK_DOCS) for b, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True)])
            else:
                begins = np.zeros(1, np.int64)
            summary = np.maximum.reduceat(self.matrix[np.ix_(docs, self.items.columns[term])], begins, axis=0)
            self.lists[term] = docs, np.append(begins, len(docs)), summary
        return self.lists[term]


class Best:
    """The k best documents of an item so far: highest score, then smallest doc_id (NULL last)."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        good = scores >= max(1, self.least)
        scores, ids, nulls = (np.concatenate([a, b[good]]) for a, b in
                              ((self.scores, scores.astype(np.int64)), (self.ids, ids), (self.nulls, nulls)))
        first = np.lexsort((ids, nulls, -scores))[:self.k]
        self.scores, self.ids, self.nulls = scores[first], ids[first], nulls[first]
        if len(first) == self.k:
            self.least = int(self.scores[-1])


def search(shard: Shard, number: int, best: Best, ids: np.ndarray, nulls: np.ndarray) -> int:
    """Brings `best` of an item up to date with the documents of `shard`; returns how many were scored."""
    items = shard.items
    terms, times = items.terms[number], items.times[number].astype(items.kind)
    upto = times * shard.most[terms]
    order = np.argsort(-upto, kind="stable")
    rest = np.cumsum(upto[order][::-1])[::-1]                  # of this list and those after it
    seen = np.zeros(shard.size, bool)

    def score(docs: np.ndarray) -> None:
        docs = docs[~seen[docs]]
        if len(docs):
            seen[docs] = True
            best.add(shard.matrix[np.ix_(docs, terms)] @ times, ids[docs], nulls[docs])

    for place, o in enumerate(order):
        if upto[o] == 0 or rest[place] < best.least:
            break
        term = int(terms[o])
        docs, ends, summary = shard.blocks(term)
        bound = summary[:, np.searchsorted(items.columns[term], terms)] @ times
        top = int(bound.argmax())
        score(docs[ends[top]:ends[top + 1]])
        open_ = bound >= best.least                            # skipped only when the exact bound is below
        if open_.all():
            score(docs)
        elif open_.any():
            score(docs[np.repeat(open_, np.diff(ends))])
    return int(seen.sum())


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, int]]:
    """The rows of `batches` in tables of `size` rows, the last one smaller."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        start = 0
        while start < len(batch):
            part = batch.slice(start, size - rows)
            held.append(part)
            rows, start = rows + len(part), start + len(part)
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks(), rows
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks(), rows


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _best(rows: DataFrame, items: Items) -> DataFrame:
    """key, rank, doc_id, score: the k best rows of `rows` (as of `vectors`) for each of `items`."""
    sent = rows.sparkSession.sparkContext.broadcast(items)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        size = max(LEAST_DOCS, SHARD_CELLS // max(1, len(items.weights)))
        best = [Best(items.k) for _ in items.keys]
        for table, rows in _shards(batches, size):
            lists = table.column("terms").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(rows), sizes)
            term = lists.flatten().to_numpy().astype(np.int64)
            often = table.column("counts").combine_chunks().flatten().to_numpy()
            value = items.values(table.column("n").to_numpy()[doc], term, often)
            shard = Shard(items, doc, term, value, rows)
            ids = table.column("doc_id").fill_null(0).to_numpy()
            nulls = table.column("doc_id").is_null().to_numpy()
            for number, b in enumerate(best):
                search(shard, number, b, ids, nulls)
        for key, b in zip(items.keys, best, strict=True):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(b.scores)), pa.array(b.ids, mask=b.nulls), pa.array(b.scores)],
                                                 ["key", "doc_id", "score"])

    found = rows.select("doc_id", "n", "terms", "counts").mapInArrow(of, "key string, doc_id long, score long")
    # the results of very many tasks are cut down in groups before they meet by item
    some = _ranked(found.withColumn("salt", F.spark_partition_id() % SALTS), items.k, "key", "salt")
    return _ranked(some.select("key", "doc_id", "score"), items.k, "key").select("key", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` highest-scoring rows of `docs` (doc_id, text) for every row of `items` (item_id, text).

    Scores are integers as the contract of the query says and above 0; equal scores
    go by ascending doc_id, a NULL doc_id last.  Repeated rows of `docs` are
    documents of their own, and repeated rows of `items` have the same result
    each; NULL and empty texts hold no term, so such items have no rows.
    Items are served ITEM_BYTES of different texts at a time, with one pass over the
    documents for each such part, so what tasks are sent is bounded.  Other
    columns are ignored; an empty table gives no rows.
    """
    keyed = items.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").withColumn("key", F.sha2("text", 256))
    different = written(keyed.select("key", "text").distinct())
    parts = max(1, math.ceil((different.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / ITEM_BYTES))
    found = None
    for part in range(parts):
        rows = different.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect()
        mine = {r["key"]: terms_of(r["text"]) for r in rows}
        vocabulary = sorted({t for ts in mine.values() for t in ts})
        number = {t: i for i, t in enumerate(vocabulary)}
        made = written(vectors(docs, vocabulary))
        n_docs, n_terms = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = made.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        df = np.zeros(len(vocabulary), np.int64)
        for r in holding.collect():                            # a row for each of the part's terms at most
            df[r["term"]] = r["n"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        pairs = {key: np.unique([number[t] for t in ts], return_counts=True) for key, ts in mine.items() if ts}
        block = Items(list(pairs), [t for t, _ in pairs.values()], [c for _, c in pairs.values()], weights, n_docs, n_terms, k)
        best = _best(made, block)
        found = best if found is None else found.unionByName(best)
    return keyed.join(found, "key").select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
i AS (SELECT item_id, row_number() OVER () AS iid,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT iid, item_id, t, count(*) AS times FROM i GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
p AS (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
f AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM p GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY t, n_docs),
s AS (SELECT iid, item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN w USING (t), c GROUP BY ALL),
r AS (SELECT iid, item_id, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
