"""The filter audit against a plain walk through every order."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import interactions as I

WORDS = " ".join(f"w{i}" for i in range(250))
TEXTS = [(1, WORDS, "en"), (2, WORDS, "en"), (2, WORDS, "en"), (9, WORDS, None), (None, WORDS, "en"), (3, "", "en"),
         (4, None, None), (5, "ABC " * 300, "de"), (6, "a # b", ""), (7, "x " * 400, "de"), (8, "\x0b \t\n", "fr"),
         (10, "é" * 3000 + " " + WORDS, "fr"), (11, "a b " + "Z" * 40_000, "fr")]
LABELS = [(1, 1, 0), (2, 1, None), (2, None, 1), (5, 0, 1), (None, 1, 1), (9, 1, 1), (77, 1, 1)]


def failures(docs):
    out = []
    for doc_id, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": earlier}
        out.append((doc_id, part or "", {f for f, bad in fails.items() if bad}))
    return out


def walk(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows, found = {}, failures(docs)
    for part in {p for _, p, _ in found}:
        mine = [(i, bad) for i, p, bad in found if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                fail = sum(f in bad for _, bad in mine)
                rows[part, order, step] = [len(left), len(gone), fail - len(gone), sum(bad == {f} for _, bad in mine),
                                           sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    return {k: (*v, sum(w[1] for (p, o, s), w in rows.items() if p == k[0] and o[s - 1] == k[1][k[2] - 1]))
            for k, v in rows.items()}


def frames(session, docs=TEXTS, labels=LABELS):
    return (session.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("part", F.lit("x"))
            .withColumn("mask", F.lit(3)).withColumn("good", F.lit(True)).repartition(3),
            session.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("zz")))


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_every_order_as_walked(session):
    got = I.audit(I.document_masks(*frames(session)))
    assert got.count() == 4 * 120 * 5
    assert result(got) == walk(TEXTS, LABELS)


def test_empty_tables(session):
    docs, labels = frames(session)
    assert I.audit(I.document_masks(docs.limit(0), labels)).count() == 0
    got = result(I.audit(I.document_masks(docs, labels.limit(0))))
    assert got == walk(TEXTS, [])


def test_step_of_no_failure_and_null_flags(session):
    rows = session.createDataFrame([(None, None, None, None), ("p", 0, True, False), ("p", 1, None, True)],
                                   "part string, mask int, good boolean, toxic boolean")
    got = result(I.audit(rows, "AB"))
    assert got["", "AB", 2] == (1, 0, 0, 0, 0, 0, 0)
    assert got["p", "BA", 1] == (2, 0, 0, 0, 0, 0, 0)
    assert got["p", "BA", 2] == (1, 1, 0, 1, 0, 1, 2)


@pytest.mark.parametrize("filters", ["A", "ABC"])
def test_min_plus_product(filters):
    orders, places = I.positions(filters)
    fails = np.array(list(itertools.product([False, True], repeat=len(filters))))
    steps = I.removal_steps(fails, places)
    for m, o in itertools.product(range(len(fails)), range(len(orders))):
        first = [s for s, f in enumerate(orders[o]) if fails[m][filters.index(f)]]
        assert steps[m, o] == (first[0] if first else len(filters))
