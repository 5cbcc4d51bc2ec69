"""Blocked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(ts), len(ts)) for i, t in docs if (ts := terms(t))]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scores = []
        for i, bag, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            scores.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                               * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if t in bag), i))
        scores = sorted((x for x in scores if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, rank, i, score) for rank, (score, i) in enumerate(scores, 1)]
    return sorted(out, key=str)


def frames(session, docs, items, parts=3):
    return (session.createDataFrame(docs, "doc_id long, text string").withColumn("terms", F.lit("x")).withColumn("n", F.lit(1)).repartition(parts),
            session.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(0)).withColumn("doc_id", F.lit(5)))


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ODD = [(1, "The CAT sat"), (2, "the cat, the cat_sat"), (2, "the cat, the cat_sat"), (3, None), (4, ""), (5, "...\x00\x7f"), (None, "cat sat on É"),
       (6, "É é ÉCOLE x2 2x"), (7, "a b c\xa0d"), (8, "cat " * 5000), (9, "zebra"), (None, "zebra")]
ITEMS = [(1, "the cat CAT"), (2, None), (3, ""), (4, "É zebra école"), (4, "É zebra école"), (5, "!!!"), (6, "nothing like it"), (None, "x2 c\xa0d sat")]


def test_odd_texts(session):
    assert got(L.rank(*frames(session, ODD, ITEMS))) == brute(ODD, ITEMS, 10)
    assert got(L.rank(*frames(session, ODD, ITEMS), k=2)) == brute(ODD, ITEMS, 2)


def test_empty_tables(session):
    docs, items = frames(session, ODD, ITEMS)
    assert L.rank(docs.limit(0), items).count() == 0
    assert L.rank(docs, items.limit(0)).count() == 0


def words(rng, n):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(n))


def test_many_parts_and_shards(session, monkeypatch):
    rng = random.Random(5)
    docs = [(i, words(rng, rng.randrange(1, 60))) for i in range(400)] + [(1000 + i, "w1 w2 w3") for i in range(200)]
    items = [(i, words(rng, 12)) for i in range(20)]
    monkeypatch.setattr(L, "ITEM_BYTES", 300)
    monkeypatch.setattr(L, "RUN_BYTES", 500)
    assert got(L.rank(*frames(session, docs, items), k=4)) == brute(docs, items, 4)


def shard_of(docs, items, k):
    pairs = [np.unique([hash_ for hash_ in ts], return_counts=True) for ts in items]
    made = L.Items([str(i) for i in range(len(items))], [t for t, _ in pairs], [c for _, c in pairs],
                   np.arange(1, 401), len(docs), sum(map(len, docs)), k)
    rows = [(i, t, n) for i, d in enumerate(docs) for t, n in Counter(d).items()]
    doc, term, often = map(np.array, zip(*rows))
    value = made.values(np.array([len(docs[i]) for i in doc]), term, often)
    return made, L.Shard(made, doc, term, value, len(docs)), value, doc, term


@pytest.mark.parametrize("seed", range(6))
def test_blocks_are_skipped_and_nothing_is_lost(seed):
    rng = random.Random(seed)
    topics = [[rng.randrange(400) for _ in range(25)] for _ in range(12)]
    docs = [[rng.choice(topics[i % 12]) if rng.random() < 0.8 else rng.randrange(400) for _ in range(rng.randrange(5, 40))] for i in range(900)]
    items = [[rng.choice(topics[i % 12]) for _ in range(10)] for i in range(30)]
    made, shard, value, doc, term = shard_of(docs, items, 5)
    ids, scored = np.arange(900)[::-1].copy(), 0
    for q in range(30):
        best = L.Best(5)
        scored += L.search(shard, q, best, ids, np.zeros(900, bool))
        every = shard.matrix[:, made.terms[q]] @ made.times[q]
        first = [x for x in np.lexsort((ids, -every)) if every[x] > 0][:5]
        assert best.scores.tolist() == every[first].astype(int).tolist()
        assert best.ids.tolist() == ids[first].tolist()
    holding = sum(int((shard.matrix[:, made.terms[q]].sum(axis=1) > 0).sum()) for q in range(30))
    assert scored < 0.7 * holding


def test_summaries_are_maxima_of_their_blocks():
    rng = random.Random(1)
    made, shard, *_ = shard_of([[rng.randrange(20) for _ in range(6)] for _ in range(300)], [[0, 1, 2], [2, 3, 5, 5]], 3)
    for t in (0, 2, 5):
        docs, ends, summary = shard.blocks(t)
        assert sorted(docs) == np.flatnonzero(shard.matrix[:, t]).tolist()
        assert np.diff(ends).max() <= L.BLOCK_DOCS and np.diff(ends).min() > 0
        for b in range(len(summary)):
            assert (summary[b] == shard.matrix[docs[ends[b]:ends[b + 1]]][:, made.columns[t]].max(axis=0)).all()


def test_wide_scores_use_integers():
    made = L.Items(["a"], [np.array([0])], [np.array([10**6])], np.array([20_000]), 3, 9, 2)
    assert made.kind is np.int64
    huge = L.Items(["a"], [np.array([0])], [np.array([1])], np.array([5]), 10**12, 10**14, 2)
    n, often = np.array([10**9, 40]), np.array([3, 2])
    assert huge.values(n, np.array([0, 0]), often).tolist() == [
        5 * (10**9 * o // (1000 * o + 8 * (25 + 75 * int(m) * 10**12 // 10**14))) for m, o in zip(n, often.tolist())]
