"""Sparse text features for the classifiers: words, word beginnings and binned style marks.

A feature is a word (run of letters, lower case), the beginning of a longer word
(so that inflected forms share one), or a style mark such as "<symbols 2>".  The vocabulary is chosen by how far a
feature's document frequency differs between classes in the fit sample; its
size is a parameter, so a model can be sent to every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmart.llm.langid import piece_words, words_of
from planmart.llm.pieces import forget, of_worker, runs, slices_of, split, strings, trim

SYMBOLS = "#*$%&|<>!"
CAPITALS = bytes(range(65, 91))
VOCABULARY = 1000
BEGIN = 4
REMEMBERED = 200_000
RUN_CHARS = 1 << 20     # characters of text that are looked at together, about
LEAST_DOCS = 5          # documents of the sample that hold a feature
LEAST_CHI = 25.0        # weaker differences between classes are taken for chance


def style(text: str) -> list[str]:
    """Marks of a text's make-up, each a bin of a share."""
    n = max(1, len(text))
    symbols = sum(text.count(c) for c in SYMBOLS) / n
    coded = text.encode("utf-8", "replace")
    capitals = (len(coded) - len(coded.translate(None, CAPITALS))) / n
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 1 - len(set(lines)) / max(1, len(lines))
    words = text.split()
    variety = len(set(words)) / max(1, len(words))
    bins = (("<symbols", symbols, (0.002, 0.01, 0.03, 0.1)), ("<upper", capitals, (0.05, 0.1, 0.3, 0.6)),
            ("<repeated", repeated, (0.05, 0.2, 0.5)), ("<variety", variety, (0.1, 0.3, 0.5)),
            ("<words", len(words), (5, 20, 50)))
    return [f"{name} {sum(x > edge for edge in edges)}>" for name, x, edges in bins]


def feature_set(text: str | None, marks: bool = True) -> set[str]:
    """The features that a text holds."""
    words = set(words_of(text))
    words |= {w[:BEGIN] + "-" for w in words if len(w) > BEGIN}
    return words.union(style(text)) if marks and text else words


def vocabulary(sample: DataFrame, classes: list[int], limit: int = VOCABULARY, marks: bool = True) -> list[str]:
    """The `limit` features of `sample` (text, y, weight) that tell the classes apart best.

    Document counts by class are combined per feature; the measure is the
    chi-square of presence against class.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        trim()
        for batch in batches:
            found: dict[int, Counter] = {}
            for part in slices_of(batch, "text", RUN_CHARS):
                for text, y in zip(strings(part.column("text")), part.column("y").to_pylist(), strict=True):
                    found.setdefault(y, Counter()).update(feature_set(text, marks))
            for y, counted in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counted), pa.string()), pa.array([y] * len(counted), pa.int32()),
                     pa.array(list(counted.values()), pa.int64())], ["feature", "y", "n"])
        trim()

    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = float(sum(totals.values()) or 1)
    counts = (sample.select("text", F.col("y").cast("int").alias("y")).mapInArrow(count, "feature string, y int, n long")
              .groupBy("feature").agg(*[F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(f"n{y}")
                                        for y in classes]))
    have = sum((F.col(f"n{y}") for y in classes), F.lit(0))
    chi = F.lit(0.0)
    for y in classes:
        expected = have * F.lit(totals.get(y, 0) / whole)
        chi = chi + F.when(expected > 0, (F.col(f"n{y}") - expected) ** 2 / expected).otherwise(0.0)
    best = (counts.where((have >= LEAST_DOCS) & (chi >= LEAST_CHI)).orderBy(F.desc(chi), "feature").limit(limit).select("feature"))
    return [r["feature"] for r in best.collect()]


class Vectors:
    """Texts as sparse rows over a vocabulary: log(1 + count).

    A text is split at white space; which features a piece holds is looked up
    once and remembered (at most REMEMBERED pieces).
    """

    def __init__(self, names: list[str], marks: bool = True):
        self.index, self.marks = {n: i for i, n in enumerate(names)}, marks

    def matrix(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, feature, value) of every feature that a text holds, in that order."""
        width = max(1, len(self.index))
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for owners, parts in runs(texts, size=RUN_CHARS) if self.index else ():
            pieces, codes, offsets = split([p.lower() for p in parts])
            known = remembered(self.index)
            if len(known) > REMEMBERED:
                known.clear()
            features = list(map(known.__getitem__, pieces))
            sizes = np.fromiter(map(len, features), np.int64, len(features))
            flat = np.fromiter(chain.from_iterable(features), np.int64, int(sizes.sum()))
            hits = np.flatnonzero(sizes[codes])
            code = codes[hits]
            n = sizes[code]
            at = np.repeat((np.cumsum(sizes) - sizes)[code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            owner = np.array(owners, np.int64)[np.searchsorted(offsets, hits, side="right") - 1]
            key, count = np.unique(np.repeat(owner, n) * width + flat[at], return_counts=True)
            keys.append(key)
            counts.append(count)
        if self.marks and self.index:
            marked = [i * width + k for i, text in enumerate(texts) if text
                      for m in style(text) if (k := self.index.get(m)) is not None]
            keys.append(np.array(marked, np.int64))
            counts.append(np.ones(len(marked), np.int64))
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts), len(key))
        return key // width, key % width, np.log1p(total)

    def scores(self, texts: list[str | None], weights: np.ndarray) -> np.ndarray:
        """Sum of value times weight of each text, for each column of `weights`."""
        row, col, x = self.matrix(texts)
        return np.stack([np.bincount(row, x * w[col], len(texts)) if len(row) else np.zeros(len(texts))
                         for w in weights.T], axis=1) if weights.shape[1] else np.zeros((len(texts), 0))


class Pieces(dict):
    """The features of a piece of lower-case text, as a tuple of indices (usually empty)."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.words = index.get
        self.begins = {n[:-1]: i for n, i in index.items() if n.endswith("-")}.get

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found: tuple[int, ...] = ()
        for word in piece_words(piece):
            if (i := self.words(word)) is not None:
                found += (i,)
            if len(word) > BEGIN and (i := self.begins(word[:BEGIN])) is not None:
                found += (i,)
        self[piece] = found
        return found


def remembered(index: dict[str, int]) -> Pieces:
    """What this Python worker knows about pieces, for the vocabulary at hand."""
    return of_worker(("features", *index), lambda: Pieces(index))


def sample_rows(sample: DataFrame, vectors: Vectors) -> list[tuple[int, float, np.ndarray, np.ndarray]]:
    """The bounded fit sample (text, y, weight) as (y, weight, indices, values), in a fixed order."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            row, col, x = vectors.matrix(list(rows["text"]))
            ends = np.searchsorted(row, np.arange(1, len(rows)))
            yield pd.DataFrame({"y": rows["y"], "weight": rows["weight"],
                                "at": [v.tolist() for v in np.split(col, ends)], "x": [v.tolist() for v in np.split(x, ends)]})

    table = (sample.select("text", F.col("y").cast("int").alias("y"), "weight")
             .mapInPandas(of, "y int, weight double, at array<long>, x array<double>"))
    rows = [(r["y"], r["weight"], np.array(r["at"], np.int64), np.array(r["x"], float)) for r in table.collect()]
    return sorted(rows, key=lambda r: (r[0], r[1], r[2].tolist(), r[3].tolist()))


def stacked(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(y, weight with mean 1, row, column, value) of `sample_rows`."""
    y = np.array([r[0] for r in rows], np.int64)
    w = np.array([r[1] for r in rows], float)
    at = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, np.int64)
    x = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0)
    row = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    return y, w / max(w.mean(), 1e-300) if len(w) else w, row, at, x


def adam(start: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    """Plain Adam with a falling rate; `gradient` of the mean loss."""
    p, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(p)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return p


