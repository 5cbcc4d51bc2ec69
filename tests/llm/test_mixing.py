import itertools
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from planmart.llm import mixing
from planmart.llm.features import Pieces, Vectors
from planmart.llm.pieces import split


def table(session, n=400, seed=0):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([2.0, 0.5, 0.3], n)
    t = rng.integers(1, 2000, n).astype(float)
    t[0] = 400_000.0                                     # one document with a third of all tokens
    rows = [(i, float(a), [float(x) for x in q]) for i, (a, q) in enumerate(zip(t, p))]
    return t, p, session.createDataFrame(rows, "doc_id long, tokens double, p array<double>")


def descend(t, p, targets, steps):
    """The same projected gradient with plain numpy."""
    gram = (p * t[:, None]).T @ p
    goal = np.array(targets) / sum(targets) * t.sum()
    weight = np.linalg.inv(gram)
    r = np.ones(len(t))
    for _ in range(steps):
        miss = (r * t) @ p - goal
        if np.abs(miss).max() <= mixing.CLOSE * t.sum() * 0.01:
            break
        r = np.maximum(0, r - p @ (weight @ miss))
    return r, goal


@pytest.mark.parametrize("targets", [[0.6, 0.3, 0.1], [0.95, 0.04, 0.01]])
def test_rates_meet_targets_and_match_numpy(session, targets):
    t, p, df = table(session)
    rate = mixing.rates(df, targets, "tokens", "p")
    got = np.array([r.rate for r in df.select("doc_id", rate.alias("rate")).orderBy("doc_id").collect()])
    expected, goal = descend(t, p, targets, mixing.MOST_STEPS)
    assert np.all(got >= 0)
    np.testing.assert_allclose(got, expected, rtol=1e-6, atol=1e-8)
    total = (got * t) @ p
    assert np.abs(total - goal).max() < 0.02 * t.sum()


def test_targets_that_were_not_met_are_told(session, monkeypatch):
    _, _, df = table(session)
    monkeypatch.setattr(mixing, "MOST_STEPS", 1)
    with pytest.warns(UserWarning, match="missed their targets by"):
        mixing.rates(df, [0.95, 0.04, 0.01], "tokens", "p")


def test_without_tokens_or_mass(session):
    empty = session.createDataFrame([], "tokens double, p array<double>")
    assert empty.select(mixing.rates(empty, [1.0], "tokens", "p")).count() == 0
    df = session.createDataFrame([(10.0, [1.0, 0.0]), (0.0, [1.0, 0.0])], "tokens double, p array<double>")
    got = [r[0] for r in df.select(mixing.rates(df, [0.5, 0.5], "tokens", "p")).collect()]
    assert got == pytest.approx([0.5, 0.5], abs=5e-3)


def test_documents_follow_their_rates(session):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = session.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "a b", "en", "s", 3),
                                     (-2, "a b", "en", "s", 3)], docs.schema)
    docs = docs.unionByName(extra).withColumn("rate", F.lit("x"))
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == docs.count()
    whole = sum(r.tokens for r in rows)
    for d, share in mixing.TARGETS.items():
        assert sum(r.rate * r.tokens * r[f"p_{d}"] for r in rows) / whole == pytest.approx(share, abs=0.02)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) and r.rate >= 0 for r in rows)
    clean = [r for r in rows if r.p_clean > 0.9]
    assert min(r.copies for r in clean) >= 1
    taken = mixing.take(docs, labels)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs.limit(0), labels).count() == 0


def test_many_texts_are_scored_in_little_memory():
    """Texts of 6 MB, given at once: what is held beside them and the piece table is for RUN_CHARS of them."""
    rng = np.random.default_rng(1)
    words = ["".join(x) for x in itertools.product("abcdefghijklm", repeat=3)][:2000]
    texts = [" ".join(words[i] for i in rng.integers(0, 2000, 4000)) for _ in range(360)]
    vectors = Vectors(words[:600], marks=False)
    whole = vectors.matrix(texts[:40])
    tracemalloc.start()
    try:
        found = vectors.matrix(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    n = int(np.searchsorted(found[0], 40))
    assert all(np.array_equal(a, b[:n]) for a, b in zip(whole, found, strict=True))
    assert peak < 20 << 20


def test_different_pieces_are_split_quickly():
    """Taking texts apart costs less than making an Arrow scalar of each different piece."""
    pieces = ["".join(x) for x in itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4)][:200_000]
    column, text = pa.array(pieces), " ".join(pieces)

    def seconds(of, *args):
        spent = []
        for _ in range(3):
            start = time.process_time()
            of(*args)
            spent.append(time.process_time() - start)
        return min(spent)

    assert split([text])[0] == pieces
    assert seconds(split, [text]) < seconds(column.to_pylist)


def test_features_of_a_piece():
    names = ["anna", "anna-", "bett-", "ß", "<words 1>"]
    known = Pieces({n: i for i, n in enumerate(names)})
    found = {p: sorted(known[p]) for p in ("anna", "annas,", "bettina-anna", "(ß)", "bett", "anna-", "<words", "")}
    assert found == {"anna": [0], "annas,": [1], "bettina-anna": [0, 2], "(ß)": [3], "bett": [], "anna-": [0], "<words": [], "": []}
