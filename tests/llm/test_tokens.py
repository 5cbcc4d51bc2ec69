import weakref

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from planmart.llm import pieces, tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = Tokenizer.from_file(WORDS)

TEXTS = st.one_of(
    st.text(max_size=60),
    st.lists(st.sampled_from(["Hello", "it's", "a.b", "x.,", "!.", "...", "İ.", "ŉ", "é", "é", "क़.", "3.5,",
                              "<|endoftext|>", "<|EndOfText|>.", "\x1c", " ", "　", "\x85", "\n", " ", "  ", "ß,",
                              "don't", "ΑΣ", "日本語", "́", "<b>"]), max_size=20).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_counts_and_ids_are_the_library_s(texts):
    expected = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(tokens.counts(texts, WORDS)) == [len(x) for x in expected]
    assert list(tokens.text_ids(texts, WORDS)) == [tokens.id_bytes(x) for x in expected]


def test_long_texts_are_cut_without_changing_counts(monkeypatch):
    monkeypatch.setattr(pieces, "RUN_CHARS", 50)
    text = "Some words, and then more: it's 1.5 or so... \n" * 40 + "x" * 300 + " end."
    for path in (WORDS, BYTES):
        plain = Tokenizer.from_file(path)
        assert list(tokens.counts([text, None, "", "a b"], path)) == [
            len(plain.encode(t or "", add_special_tokens=False).ids) for t in (text, None, "", "a b")]
    assert b"".join(tokens.text_ids([text], WORDS)) == tokens.id_bytes(PLAIN.encode(text, add_special_tokens=False).ids)
    assert "".join(pieces.segments(text, 50)) == text


def test_runs_are_balanced_by_bytes():
    texts = ["a b c " * 40, "日本 語 " * 300, None, "", "é è " * 100, "x" * 500]
    made = list(pieces.runs(texts, size=120, length=pieces.utf8_length))
    assert all(sum(map(pieces.utf8_length, parts)) <= 2 * 120 for _, parts in made if "x" * 500 not in parts)
    for i, text in enumerate(texts):
        assert "".join(p for owners, parts in made for o, p in zip(owners, parts, strict=True) if o == i) == (text or "")


def test_counting_takes_the_library_s_batches(monkeypatch):
    made = tokens.load(WORDS, len)
    assert not made.direct and tokens.load(WORDS, tokens.id_bytes).direct
    words = [f"wörd{i}" for i in range(3000)]
    sizes = []

    class Watched:
        def encode_batch(self, run, add_special_tokens):
            sizes.append(sum(map(pieces.utf8_length, run)))
            return PLAIN.encode_batch(run, add_special_tokens=add_special_tokens)

        model = property(lambda self: pytest.fail("a word went to the model alone"))

    made.tokenizer = Watched()
    found, codes, _ = made.encode([" ".join(words)])
    assert [found[c] for c in codes] == [len(PLAIN.encode(w, add_special_tokens=False).ids) for w in words]
    assert len(sizes) > 1 and max(sizes) <= tokens.BATCH_BYTES + 10


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 10)
    made = tokens.encoder(WORDS)
    texts = [" ".join(f"w{i}x{j}" for j in range(7)) for i in range(6)]
    for t in texts:
        assert list(tokens.counts([t], WORDS)) == [len(PLAIN.encode(t, add_special_tokens=False).ids)]
        assert len(made.known) + len(made.older) <= 10


def test_other_files():
    import sentencepiece
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["Hello  there\n you", "", "ünï <s> x"]
    assert list(tokens.counts(texts, PIECES)) == [len(pieces.encode(t)) for t in texts]
    with pytest.raises(ValueError):
        list(tokens.text_ids(["a"], BYTES))


def test_token_counts_rows(session):
    rows = [(1, "Hello there", "x"), (1, "Hello there", "y"), (None, "é " * 3000, "z"), (3, None, None), (4, "", "")]
    df = session.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(tokens.token_counts(df, WORDS).collect(), key=str)
    n = len(PLAIN.encode("Hello there", add_special_tokens=False).ids)
    assert sorted(map(str, got)) == sorted(map(str, [
        *[type(got[0])(doc_id=1, n_bytes=11, n_tokens=n, over_limit=False)] * 2,
        type(got[0])(doc_id=None, n_bytes=9000, n_tokens=3000 * len(PLAIN.encode("é", add_special_tokens=False).ids),
                     over_limit=True),
        type(got[0])(doc_id=3, n_bytes=0, n_tokens=0, over_limit=False),
        type(got[0])(doc_id=4, n_bytes=0, n_tokens=0, over_limit=False)]))
    assert tokens.token_counts(df.limit(0), WORDS).count() == 0


def test_symbols_behind_a_word_take_no_entry_of_their_own():
    """A word is remembered once, whatever stands behind it; capitals of plain Latin letters share it too."""
    made = tokens.load(WORDS, tokens.id_bytes)
    words = ["éclair", "Éclair", "éclair,", "éclair%%%", "ÉCLAIR?!", "abc)'", "abc", "don't.", "it's", "'s,", "3.5%", "İx.", "...", "<|endoftext|>."]
    found, codes, offsets = made.encode([" ".join(words), "", " "])
    expected = [tokens.id_bytes(made.tokenizer.encode(w, add_special_tokens=False).ids) for w in words]
    assert [found[c] for c in codes[offsets[0]:offsets[1]]] == expected
    assert sum(w.startswith(("éclair", "abc")) for w in made.known) == 2
    again, codes, offsets = made.encode([" ".join(reversed(words))])
    assert [again[c] for c in codes] == expected[::-1]


def test_ids_of_texts_in_short_runs(monkeypatch):
    monkeypatch.setattr(tokens, "RUN_CHARS", 50)
    text = "Some wörds, and then more: it's 1.5 or so... \n" * 40 + "x" * 300 + " end."
    assert list(tokens.text_ids([text, None, "a b"], WORDS)) == [
        tokens.id_bytes(PLAIN.encode(t or "", add_special_tokens=False).ids) for t in (text, None, "a b")]


def test_ids_of_new_words_are_kept_at_once():
    """Lists of ids that live until a run ends are what garbage collections walk over, again and again."""
    seen, lists = [], []

    def kept(ids):
        lists.append(weakref.ref(ids))
        seen.append(sum(x() is not None for x in lists))
        return tokens.id_bytes(ids)

    class Ids(list):
        pass

    made = tokens.load(WORDS, kept)
    words = [f"ab{c}é" for c in "abcdefghijklmnopqrstuvwxyz"]
    made.letters = lambda word: Ids([len(word)])
    found, codes, _ = made.encode([" ".join(words)])
    assert [found[c] for c in codes] == [tokens.id_bytes([4])] * len(words)
    assert max(seen) == 1
