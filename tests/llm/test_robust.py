import math
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from planmart.llm import robust


def plain_stats(text):
    text = text or ""
    words = text.encode().split()
    lines = text.split("\n")
    runs = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i, r in enumerate(zip(words, words[1:], words[2:])) if runs[r] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
            sum(bool(x.strip(" \t\n\v\f\r")) and x in lines[:i] for i, x in enumerate(lines)), len(inside))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.text(max_size=80), st.lists(st.sampled_from(["a", "b", " ", "\n", "é", "#", "\x85", "\v", " "]),
                                                         max_size=60).map("".join)))
def test_statistics_of_a_text(text):
    assert robust.text_stats(text) == plain_stats(text)


def plain_mcd(x, ridge):
    """The same estimate with numpy: start from medians and quartiles, then concentration steps on binned distances."""
    x = np.asarray(x, float)
    n = len(x)
    lower, mid, upper = (np.array([np.sort(c)[max(0, math.ceil(q * n) - 1)] for c in x.T]) for q in (0.25, 0.5, 0.75))
    mean, inverse = mid, np.diag(1 / (((upper - lower) / 1.349) ** 2 + ridge))
    for _ in range(robust.STEPS):
        gap = x - mean
        d = np.einsum("ij,jk,ik->i", gap, inverse, gap)
        bins = np.clip(np.floor(robust.BINS_PER_DOUBLING * np.log2(np.maximum(d, 0) + 1e-6)), robust.LEAST_BIN, robust.MOST_BIN)
        edge = np.sort(bins)[math.ceil(robust.SHARE * n) - 1]
        inner = x[bins <= edge]
        mean = inner.mean(axis=0)
        cov = np.cov(inner.T, bias=True) * robust.consistency(min(len(inner) / n, 0.999))
        inverse = np.linalg.inv(cov + np.diag(ridge))
    gap = x - mean
    return np.einsum("ij,jk,ik->i", gap, inverse, gap)


def test_estimates_match_numpy_and_resist_outliers(session):
    rng = np.random.default_rng(1)
    good = rng.multivariate_normal([1, 2, 0, 0.5], np.diag([0.04, 0.01, 0.5, 0.02]), 900)
    bad = rng.multivariate_normal([3, 4, 6, 2], np.eye(4) * 0.01, 200)
    x = np.vstack([good, bad])
    size = [[390, 400, 410][i % 3] for i in range(len(x))]
    df = session.createDataFrame([("g", n, 5 * n, *map(float, r)) for n, r in zip(size, x)] + [("h", 1, 1, 1.0, 1.0, 1.0, 1.0)] * 60,
                                 "g string, n_words long, word_chars long, x0 double, x1 double, x2 double, x3 double")
    model = robust.estimates(df)
    got = (df.join(model, "g").where("g = 'g'").withColumn("d", robust._distance("mu", "inverse")).collect())
    by = {(r.x0, r.x1): r.d for r in got}
    expected = plain_mcd(x, robust.noise(400, 2000))
    for row, d in zip(x, expected, strict=True):
        assert math.isclose(by[float(row[0]), float(row[1])], d, rel_tol=0.02, abs_tol=0.02)
    assert np.mean(expected[:900] < robust.CUT) > 0.995 and robust.CUT < min(expected[900:])


def test_documents(session):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    extra = session.createDataFrame([(None, None, None, None, None), (-1, "", None, "s", 0), (-2, "a b c " * 60, "en", "s", 3),
                                     (-3, "word " * 30, "en", "src1", 3), (-4, " ".join(f"w{i}" for i in range(40000)), "zz", "t", 9)],
                                    docs.schema)
    got = robust.quality(docs.unionByName(extra).withColumn("g", F.lit(1)).withColumn("x0", F.lit("y")))
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count() + 5
    text = {r.doc_id: r.text for r in docs.unionByName(extra).collect()}
    for d, r in rows.items():
        assert tuple(r[n] for n in robust.STAT_NAMES) == plain_stats(text[d])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert rows[-4].kept and rows[-2].base_failed
    whole = {r.doc_id: r.quality for r in labels.collect()}
    clean = [r for d, r in rows.items() if whole.get(d) == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert robust.quality(docs.limit(0)).count() == 0


def test_labelled_documents(session):
    """Junk that passes the base rules goes and clean documents stay, in each language."""
    docs = session.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = (robust.quality(docs).where("NOT base_failed").join(docs.select("doc_id", "lang"), "doc_id").join(labels, "doc_id")
            .groupBy("lang", "quality").agg(F.avg(F.col("kept").cast("double")).alias("kept"), F.count(F.lit(1)).alias("n")).collect())
    share = {(r.lang, r.quality): r.kept for r in rows if r.n >= 20}
    assert len(share) >= 6
    assert all(kept <= 0.02 if quality == 0 else kept >= 0.995 for (_, quality), kept in share.items())


def test_a_few_symbols_are_no_outlier(session):
    """Groups whose documents have no symbol and no repeated line at all: deviations of zero don't decide."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(words, n, replace=False))
    rows = [(i, text(250), "en", "s") for i in range(300)]
    rows += [(1000, text(250) + " # one", "en", "s"), (1001, text(120) + "\nline\n" + text(120) + "\nline", "en", "s")]
    rows += [(2000, text(200) + " #$%&" * 40, "en", "s"), (2001, text(200) + "\nthe same line" * 20, "en", "s")]
    got = {r.doc_id: r.kept for r in robust.quality(session.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[d] == (d < 2000) for d in got)


def test_large_groups_reject_junk(session):
    rng = np.random.default_rng(0)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "eta", "theta", "iota", "kappa", "lambda"]
    def text(n):
        return " ".join(rng.choice(words, n).tolist()).replace("kappa eta", "kappa\neta")
    rows = [(i, " ".join(f"{w}{rng.integers(1000)}" for w in rng.choice(words, 80)), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{w}{rng.integers(1000)}%%% ***" for w in rng.choice(words, 80)), "en", "s") for i in range(40)]
    got = {r.doc_id: r.kept for r in robust.quality(session.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(300)) and not any(got[1000 + i] for i in range(40))


def test_small_groups_are_measured_too(session):
    rng = np.random.default_rng(2)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "eta", "theta", "iota", "kappa", "lambda"]
    def text(end):
        return " ".join(f"{w}{rng.integers(1000)}{end}" for w in rng.choice(words, 80))
    rows = [(i, text(""), "en", "s") for i in range(200)]
    rows += [(1000 + i, text(""), lang, f"t{i % 3}") for i, lang in enumerate(["en", "fr", None] * 4)]
    rows += [(2000 + i, text("%%% ***"), lang, f"t{i % 3}") for i, lang in enumerate(["en", "fr", None] * 4)]
    got = {r.doc_id: r.kept for r in robust.quality(session.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows)
    assert all(kept == (d < 2000) for d, kept in got.items())
