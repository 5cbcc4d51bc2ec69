"""Mixing towards target weights with soft domain membership.

A classifier fitted on labelled documents gives each document a posterior over
domains.  Document rates r >= 0 are then found by projected gradient descent on
the weighted least squares between expected domain token totals,
sum_i r_i * tokens_i * p_ik, and the targets.  The residuals are weighted by the
inverse of G = sum_i tokens_i * p_i p_i', so in the variables r_i * sqrt(tokens_i)
the gradient's Lipschitz constant is 1 and full steps are safe; few are needed.
A step needs only the K residuals, so the driver holds K numbers a step; the
rates are an expression over the table (1, then one clipped step after the
other) and never a stored state.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmart.llm.common import arrow_batches, bounded_sample, hash_share, written
from planmart.llm.features import RUN_CHARS, Vectors, adam, sample_rows, stacked, vocabulary
from planmart.llm.pieces import texts_of

FIT_DOCS = 1500          # sampled documents per domain, at most (about)
VOCABULARY = 600
STEPS, RATE, RIDGE = 150, 0.15, 1e-3
MOST_STEPS, CLOSE = 25, 2e-3      # gradient steps at most; relative residual to stop at

#: Domains of the labelled table, and the share of all tokens that each should have.
TARGETS = {"clean": 0.93, "junk": 0.04, "toxic": 0.03}


def domain(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 0, "junk").when(quality == 1, "clean")


@dataclass
class Softmax:
    names: list[str]
    domains: list[str]
    weights: np.ndarray          # (features + 1, domains); the last row is the intercept

    def posterior(self, vectors: Vectors, texts: list[str | None]) -> np.ndarray:
        z = vectors.scores(texts, self.weights[:-1]) + self.weights[-1]
        e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return e / e.sum(axis=1, keepdims=True) if len(z) else z


def fit(labelled: DataFrame, domains: list[str], docs: int = FIT_DOCS, limit: int = VOCABULARY) -> Softmax:
    """Multinomial logistic regression on `labelled` (text, domain, and weight if it is a sample
    already; else about `docs` documents per domain are sampled).  Domains without a
    labelled document stay near zero."""
    number = F.create_map(*[x for i, d in enumerate(domains) for x in (F.lit(d), F.lit(i))])
    rows = labelled.withColumn("y", number[F.col("domain")]).where("text IS NOT NULL AND y IS NOT NULL")
    if "weight" not in labelled.columns:
        rows = bounded_sample(rows, "y", docs, F.col("text"))
    sample = written(rows.select(F.col("text").cast("string").alias("text"), "y", "weight"))
    names = vocabulary(sample, list(range(len(domains))), limit)
    y, w, row, col, x = stacked(sample_rows(sample, Vectors(names)))
    n, m, k = len(y), len(names), len(domains)
    if not n:
        return Softmax([], domains, np.zeros((1, k)))
    share = np.array([(w * (y == j)).sum() / w.sum() for j in range(k)])
    start = np.zeros((m + 1, k))
    start[-1] = np.log(np.maximum(share, 1e-6))
    hot = np.zeros((n, k))
    hot[np.arange(n), y] = 1

    def gradient(flat: np.ndarray) -> np.ndarray:
        p = flat.reshape(m + 1, k)
        z = np.stack([np.bincount(row, x * p[col, j], n) if len(row) else np.zeros(n) for j in range(k)], axis=1) + p[-1]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        r = w[:, None] * (e / e.sum(axis=1, keepdims=True) - hot) / n
        g = np.zeros_like(p)
        for j in range(k):
            if len(row):
                g[:m, j] = np.bincount(col, x * r[row, j], m)
        g[:m] += RIDGE * p[:m]
        g[-1] = r.sum(axis=0)
        return g.ravel()

    return Softmax(names, domains, adam(start.ravel(), gradient, STEPS, RATE).reshape(m + 1, k))


def posteriors(text: Column, model: Softmax) -> Column:
    vectors, k = Vectors(model.names), len(model.domains)

    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            p = np.concatenate([np.zeros((0, k)), *(model.posterior(vectors, texts) for texts in texts_of(column, RUN_CHARS))])
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * k), pa.array(p.ravel()))

    return F.arrow_udf(of, T.ArrayType(T.DoubleType()))(text)


def token_size(text: Column) -> Column:
    """Tokens for the totals: words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("double")


def rates(table: DataFrame, targets: list[float], tokens: str, p: str, floor: float = 0.0) -> Column:
    """The rate of each row of `table` (tokens, posterior array) as a column expression.

    Targets are shares of all tokens.  Rows without tokens get the rate their
    posterior leads to as well.  A domain that no token has expected mass in
    can't be met and is left out.  If the steps run out before the targets are met, a warning
    says by how much.
    """
    k = len(targets)
    part = [F.col(p)[j] for j in range(k)]
    t = F.col(tokens)
    first = table.agg(F.sum(t).alias("t"), *[F.sum(t * part[i] * part[j]).alias(f"m{i}_{j}")
                                             for i in range(k) for j in range(i, k)]).first()
    whole = float(first["t"] or 0.0)
    rate = F.lit(1.0)
    if whole <= 0:
        return rate
    gram = np.array([[first[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)
    goal = np.array(targets, float) / sum(targets) * whole
    weight = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    for _ in range(MOST_STEPS):
        got = table.agg(*[F.sum(rate * t * part[j]).alias(f"g{j}") for j in range(k)]).first()
        miss = np.array([got[f"g{j}"] for j in range(k)], float) - goal
        move = weight @ miss
        if np.abs(gram @ move).max() <= CLOSE * whole * 0.01:       # the part of the residual that can be met
            break
        rate = F.greatest(F.lit(floor), rate - sum((part[j] * float(move[j]) for j in range(k)), F.lit(0.0)))
    else:
        left = np.abs(gram @ move).max() / whole
        warnings.warn(f"domain totals missed their targets by {left:.2%} of all tokens at the last of {MOST_STEPS} steps", stacklevel=2)
    return rate


def labelled_domains(docs: DataFrame, labels: DataFrame, each: int = FIT_DOCS) -> DataFrame:
    """(text, domain, weight) of about `each` labelled documents per domain at most, chosen by
    doc_id; of repeated labels the worst counts."""
    known = (labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
             .select("doc_id", domain(F.col("quality"), F.col("toxic")).alias("domain")).where("domain IS NOT NULL"))
    chosen = written(bounded_sample(known, "domain", each, F.col("doc_id")))
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "domain", "weight")


def copies(rate: Column, *key: Column) -> Column:
    """How often a document is taken: the rate rounded down or up, by its hash, so that totals hold."""
    return F.floor(rate + hash_share(F.lit(29), *key)).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """A row for each document: doc_id, tokens, p_<domain> for each, rate, copies.

    NULL and empty texts have no tokens and the posterior of the intercept.
    Repeated rows count each; an empty table gives no rows.
    """
    domains = list(targets)
    model = fit(labelled_domains(docs, labels), domains)
    text = F.col("text").cast("string")
    with arrow_batches(docs.sparkSession, RUN_CHARS):
        table = written(docs.select("doc_id", token_size(text).alias("tokens"), F.xxhash64(text).alias("h"),
                                    posteriors(text, model).alias("p")))
    rate = rates(table, list(targets.values()), "tokens", "p")
    return (table.withColumn("rate", rate)
            .select("doc_id", F.col("tokens").cast("long").alias("tokens"),
                    *[F.col("p")[j].alias(f"p_{d}") for j, d in enumerate(domains)], "rate",
                    copies(F.col("rate"), F.col("doc_id"), F.col("h")).alias("copies")))


def take(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """`docs` with each row as often as its copies say (not at all for zero); all columns, no new ones."""
    model = fit(labelled_domains(docs, labels), list(targets))
    text = F.col("text").cast("string")
    names = docs.columns
    with arrow_batches(docs.sparkSession, RUN_CHARS):
        table = written(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                                    F.col("doc_id").alias("id"), F.xxhash64(text).alias("h"), token_size(text).alias("tokens"),
                                    posteriors(text, model).alias("p")))
    rate = rates(table, list(targets.values()), "tokens", "p")
    return (table.withColumn("_n", copies(rate, F.col("id"), F.col("h"))).where("_n > 0")
            .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]))


