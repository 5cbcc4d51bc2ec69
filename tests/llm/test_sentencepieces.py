"""Marked words against the library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from planmart.llm import sentencepieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  ", "a", " a", "a ", "a  b ", "▁", "a▁b", " ▁ ▁x", "x\ny\n\n z", "a\x00b", "<s> a</s> <unk>", "ﬁ \xa0y",
       "한　글 é", "① \U0001f600\U0001f600 x", "the " * 50, "word", "\t\ttabs and \r\n", "a" * 300, "  lead", "﻿x", "é" * 40,
       "͸ \U0010ffff", "... ,,, !!", "   " * 30 + "x"]


@pytest.fixture
def made():
    return S.MarkedWords(PATH)


def plain(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


def test_the_file_is_encoded_by_word(made):
    assert made.by_word


def test_ids_of_odd_texts(made):
    for _ in range(2):                                    # the second time from the table
        got = [np.frombuffer(x, "<u4").tolist() for x in made.encode([*ODD, None, *ODD])]
        assert got == [LIBRARY.encode(t or "") for t in [*ODD, None, *ODD]]


def test_texts_cut_into_runs(made, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["  ", " ", "▁", "ab", "the", "\n", "é", "\U0001f600"]) for _ in range(rng.randrange(400)))
             for _ in range(60)] + [None, ""]
    monkeypatch.setattr(S, "RUN_CHARS", 37)
    monkeypatch.setattr(S, "TABLE_WORDS", 20)
    assert [np.frombuffer(x, "<u4").tolist() for x in made.encode(texts)] == [LIBRARY.encode(t or "") for t in texts]
    assert len(made.new) + len(made.old) <= 20


def test_many_ids_are_decoded_in_parts(made, monkeypatch):
    monkeypatch.setattr(S, "DECODE_IDS", 5)
    for text in [*ODD, " ".join(ODD)]:
        ids = plain(text)
        assert made.decode(np.array(ids)) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(" ▁abé\n<s>\U0001f600　") | st.characters(exclude_categories=["Cs"])), max_size=6))
def test_any_texts(texts):
    made = test_any_texts.made = getattr(test_any_texts, "made", None) or S.MarkedWords(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in made.encode(texts)] == [LIBRARY.encode(t) for t in texts]


def test_a_file_with_other_pieces_encodes_whole_texts(made):
    made.by_word = False
    assert [np.frombuffer(x, "<u4").tolist() for x in made.encode([*ODD, None])] == [LIBRARY.encode(t) for t in [*ODD, ""]]


def test_every_row_as_the_library(session):
    long = "  ".join(["The and of", "x" * 500, "é\n"] * 9000)
    rows = [*enumerate(ODD), (None, "null id"), (3, "again"), (3, "again"), (99, None), (100, long)]
    docs = (session.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x"))
            .withColumn("decoded", F.lit(1)).withColumn("n_tokens", F.lit(1)).repartition(3))
    got = S.digests(S.encode(docs, PATH))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids := plain(t)), sha(np.array(ids, "<u4").tobytes()), sha(LIBRARY.decode(ids).encode())) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert S.encode(docs.limit(0), PATH).count() == 0
    bare = S.encode(docs.where("doc_id = 99"), PATH, bos=False, eos=False).first()
    assert (bare.n_tokens, bytes(bare.ids), bare.decoded) == (0, b"", "")


def test_whole_table_as_the_library(session, small_dir):
    docs = session.read.parquet(f"{small_dir}/documents.parquet")
    got = {r.doc_id: r for r in S.encode(docs, PATH).collect()}
    for r in docs.collect():
        ids = plain(r.text)
        assert np.frombuffer(got[r.doc_id].ids, "<u4").tolist() == ids and got[r.doc_id].decoded == LIBRARY.decode(ids)
