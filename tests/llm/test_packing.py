import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from planmart.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(WORDS)


def check(rows, docs, size):
    """Every id of every document lies in exactly one piece; sequences are gapless and fit."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    copies = defaultdict(list)
    for doc, text in docs:
        copies[doc].append(np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    assert pieces.keys() == copies.keys()
    for doc, made in copies.items():
        expected = sorted((at, len(ids[at:at + size]), zlib.crc32(ids[at:at + size].tobytes()), len(ids))
                          for ids in made for at in range(0, len(ids), size))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc]) == expected
    for of in sequences.values():
        at = 0
        for r in sorted(of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return sequences


def test_documents_table(session, small_dir):
    docs = session.read.parquet(f"{small_dir}/documents.parquet")
    rows = packing.pack(docs, WORDS).collect()
    made = check(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 4096)
    assert sum(r.length for r in rows) > 0.9 * 4096 * len(made)


def test_edge_cases_over_many_partitions(session, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 3)       # several levels of merging
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.choice([0, 1, 3, 9, 40, 70])))) for i in range(200)]
    docs += [(7, "alpha beta"), (7, "alpha beta"), (None, "gamma"), (-5, None), (900, "")]
    df = session.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, window int").repartition(23)
    rows = packing.pack(df, WORDS, size=32, open_windows=2).collect()
    made = check(rows, docs, 32)
    assert sum(r.length for r in rows) > 0.85 * 32 * len(made)
    assert packing.pack(df.limit(0), WORDS).count() == 0


def test_windows_best_fit_and_fullest_out():
    out = []
    w = packing.Windows(10, 2, 0, out.append)
    assert w.place(6) == (0, 0)
    assert w.place(7) == (1, 0)
    assert w.place(3) == (1, 7)                   # the window with the least room that is enough
    assert out == [1]
    assert w.place(5) == (2, 0)
    assert w.place(8) == (3, 0)                   # none fits, two are open: the fullest goes
    assert out == [1, 0]
    assert w.place(5) == (2, 5)
    assert out == [1, 0, 2]


def test_texts_reach_the_workers_in_batches_of_a_run(session, monkeypatch):
    """One batch of all rows would hold whole splits of long texts, in the worker and in the executor."""
    held = session.sparkContext.accumulator(0)
    monkeypatch.setattr(packing, "RUN_CHARS", 100_000)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = session.conf.get(name, None)

    def batches(column, size):
        held.add(1)
        return iter([column.to_pylist()])

    monkeypatch.setattr(packing, "texts_of", batches)
    df = session.range(0, 200, numPartitions=1).selectExpr("id doc_id", "repeat('alpha beta ', 1000) text")
    docs = [(i, "alpha beta " * 1000) for i in range(200)]
    check(packing.pack(df, WORDS).collect(), docs, 4096)
    assert held.value >= 15
    assert session.conf.get(name, None) == before
