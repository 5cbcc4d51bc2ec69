"""Quality rules: base rules, then robust multivariate outliers per language and source.

The centre and covariance of each group are minimum-covariance-determinant
estimates: concentration steps over all documents of the group, each keeping
the SHARE with the smallest Mahalanobis distances.  A step is one aggregate: sums
per (group, bin of the distance), combined before the shuffle; the group's
subset is whole bins up to the wanted count, so a hot group is never gathered.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planmart.llm.common import ASCII_SPACE, written
from planmart.llm.pieces import forget, texts_of

SHARE = 0.75                    # of a group's documents in the subset
STEPS = 6                       # concentration steps
LEAST = 50                      # documents; smaller groups are measured against their language, then all documents
CUT = 18.47                     # 0.999 quantile of chi-square with DIMS dimensions
EVENTS = 4                      # counted events that a document of its group's median size may have by chance
WORD_SPREAD = 0.5               # standard deviation of a word's length over its mean
BINS_PER_DOUBLING, LEAST_BIN, MOST_BIN = 16, -320, 800
DIMS = 4
SYMBOLS = "#*$%&|<>"


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, ASCII_SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    repeated = 0
    if len(set(lines)) < len(lines):
        seen: set[str] = set()
        for line in lines:
            if line in seen:
                repeated += bool(line.strip(ASCII_SPACE))
            seen.add(line)
    inside = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        reach = 0                # words before this are counted
        for i, window in enumerate(windows):
            if often[window] > 1:
                inside += i + 3 - max(i, reach)
                reach = i + 3
    return n, chars, symbols, repeated, inside


STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
STAT_NAMES = [x.split()[0] for x in STATS.split(", ")]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of every row of `docs`."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            made = [text_stats(t) for texts in texts_of(batch.column("text")) for t in texts]
            cols = zip(*made, strict=True) if made else [[]] * len(STAT_NAMES)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("doc_id", "lang", "source")), *[pa.array(c, pa.int64()) for c in cols]],
                ["doc_id", "lang", "source", *STAT_NAMES])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, lang string, source string, " + STATS)


def transformed() -> list[Column]:
    """The statistic vector: log mean word length, root of symbol density, log of repeated
    lines, root of the share of words in repeated windows."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
            F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
            F.log1p(F.col("n_dup_lines").cast("double")),
            F.sqrt(F.col("n_repeat_words") / words)]


def _chi2(dims: int, x: float) -> float:
    """Distribution of chi-square for an even number of dimensions."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))


def consistency(share: float) -> float:
    """Factor by which the covariance of the central `share` of a normal sample is too small."""
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(DIMS, mid) < share else (low, mid)
    return share / max(_chi2(DIMS + 2, low), 1e-12)


def noise(n_words: float, word_chars: float) -> list[float]:
    """Variance that counting alone gives the statistics of a document of that size: EVENTS times the mean length's
    own, EVENTS symbols, one repeated line, EVENTS windows of three words.

    It is added to every covariance: most documents of a group may have no symbol or repeated
    line at all, and a few of them don't make an outlier.
    """
    n, chars = max(1.0, n_words), max(1.0, word_chars)
    return [WORD_SPREAD ** 2 * EVENTS / n, EVENTS / chars, math.log(2) ** 2, 3 * EVENTS / n]


PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]


def _distance(mu: str, inverse: str) -> Column:
    gap = [F.col(f"x{i}") - F.col(mu)[i] for i in range(DIMS)]
    return F.greatest(F.lit(0.0), sum((gap[i] * gap[j] * F.col(inverse)[k] * (1 if i == j else 2)
                                       for k, (i, j) in enumerate(PAIRS)), F.lit(0.0)))


def _params(mean: np.ndarray, cov: np.ndarray, ridge: list[float]) -> tuple[list[float], list[float]]:
    inverse = np.linalg.inv(cov + np.diag(ridge))
    return mean.tolist(), [float(inverse[i, j]) for i, j in PAIRS]


_MODEL = "g string, n long, ridge array<double>, mu array<double>, inverse array<double>"


def _concentrate(bins: DataFrame) -> DataFrame:
    """The next estimate of each group from its (at most MOST_BIN - LEAST_BIN + 1) bins."""
    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        n = int(group["c"].sum())
        upto = int(np.searchsorted(group["c"].cumsum().to_numpy(), math.ceil(SHARE * n))) + 1
        inner = group.iloc[:upto]
        h = float(inner["c"].sum())
        mean = np.array([inner[f"s{i}"].sum() for i in range(DIMS)]) / h
        cov = np.zeros((DIMS, DIMS))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = inner[f"p{i}{j}"].sum() / h - mean[i] * mean[j]
        cov *= consistency(min(h / n, 0.999))
        ridge = [float(x) for x in group["ridge"].iloc[0]]
        return pd.DataFrame([(key[0], n, ridge, *_params(mean, cov, ridge))], columns=["g", "n", "ridge", "mu", "inverse"])

    return bins.groupBy("g").applyInPandas(of, _MODEL)


def _start(table: DataFrame) -> DataFrame:
    """Coordinate-wise medians, the spread of their quartiles, and the noise of the median size, per group."""
    quarters = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(DIMS)]
    size = [F.greatest(F.percentile_approx(c, 0.5, 1000).cast("double"), F.lit(1.0)) for c in ("n_words", "word_chars")]
    ridge = F.array(WORD_SPREAD ** 2 * EVENTS / size[0], EVENTS / size[1], F.lit(math.log(2) ** 2), 3 * EVENTS / size[0])
    rows = table.groupBy("g").agg(F.count(F.lit(1)).alias("n"), ridge.alias("ridge"), *quarters)
    mu = F.array(*[F.col(f"q{i}")[1] for i in range(DIMS)])
    spread = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2)) + F.col("ridge")[i] for i in range(DIMS)]
    inverse = F.array(*[1 / spread[i] if i == j else F.lit(0.0) for i, j in PAIRS])
    return rows.select("g", "n", "ridge", mu.alias("mu"), inverse.alias("inverse"))


def estimates(table: DataFrame, steps: int = STEPS) -> DataFrame:
    """g, n, ridge, mu, inverse for each group g of `table` (g, n_words, word_chars, x0, x1, ...)."""
    model = written(_start(table))
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(DIMS)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS]
    for _ in range(steps):
        d2 = _distance("mu", "inverse")
        number = F.floor(BINS_PER_DOUBLING * F.log2(d2 + 1e-6)).cast("int")
        bins = (table.join(model, "g")
                .withColumn("bin", F.least(F.greatest(number, F.lit(LEAST_BIN)), F.lit(MOST_BIN)))
                .groupBy("g", "bin").agg(F.count(F.lit(1)).alias("c"), F.any_value("ridge").alias("ridge"), *sums, *products))
        model = written(_concentrate(bins))
    return model


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and distance of every row of `docs`
    (doc_id, text, lang, source).

    base_failed: fewer than 50 words, or over half of the words in repeated
    windows.  The others are measured against their (lang, source) group, NULL
    being a value of its own; where that has fewer than LEAST such documents,
    against their language over all sources, and where that has fewer too,
    against all documents, however few.  NULL and empty texts fail the base; repeated rows count each; an
    empty table gives no rows; other columns are ignored.
    """
    table = written(statistics(docs)
                    .withColumn("base_failed", (F.col("n_words") < 50)
                                | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
                    .withColumns({"g0": F.concat(F.lit("0"), F.to_json(F.struct("lang", "source"))),
                                  "g1": F.concat(F.lit("1"), F.to_json(F.struct("lang"))), "g2": F.lit("2")})
                    .withColumns({f"x{i}": x for i, x in enumerate(transformed())}))
    levels = [f"g{k}" for k in range(3)]
    model = estimates(table.where("NOT base_failed")
                      .select(F.explode(F.array(*levels)).alias("g"), "n_words", "word_chars", *[f"x{i}" for i in range(DIMS)]))
    rows = table
    for g in levels[:2]:
        rows = rows.join(model.select(F.col("g").alias(g), F.struct("n", "mu", "inverse").alias(f"m_{g}")), g, "left")
    # one row for all documents: a scalar subquery, not a join of every row on one key
    rows = rows.withColumn("m_g2", model.where("g = '2'").select(F.struct("n", "mu", "inverse")).scalar())
    near = F.when(F.col("m_g0.n") >= LEAST, F.col("m_g0")).when(F.col("m_g1.n") >= LEAST, F.col("m_g1")).otherwise(F.col("m_g2"))
    rows = rows.withColumn("m", near).withColumn("distance", _distance("m.mu", "m.inverse"))
    return rows.select("doc_id", *STAT_NAMES, "base_failed",
                       (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUT, F.lit(True))).alias("kept"), "distance")
