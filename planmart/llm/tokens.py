"""Token counts and token ids with public tokenizer files.

Whole columns of texts go through Arrow functions that return lengths only (or
ids, for packing).  Texts are encoded in runs of balanced size, and a long
text is cut at boundaries that no token crosses, so neither one huge document
nor many at once decide a task's memory.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmart.llm.pieces import of_worker, runs, split, texts_of, utf8_length

CACHE_ENTRIES = 500_000
BATCH_BYTES = 16 << 10   # of words that the library encodes at a time, about
RUN_CHARS = 3 << 20      # characters of text whose ids are held together, about

def _byte_level() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(rest)}


BYTE_LEVEL = _byte_level()


#: Latin characters that normalization leaves alone and whose lower case is one character.
PLAIN_BELOW, NOT_PLAIN = "\u0250", "\u0130"
OTHER_LETTERS = re.compile("[^\x00-\u012f\u0131-\u024f]")


class WordEncoder:
    """Ids by a `tokenizers` file whose normalizer and pre-tokenizer drop white space.

    No token of such a file crosses white space, so a text's ids are those of
    its words in order, and each word is encoded once and then remembered.  The
    memory has two halves of CACHE_ENTRIES / 2 words: when the newer is full the
    older goes, so words met again and again stay.
    """

    def __init__(self, tokenizer, keep: Callable[[list[int]], object]):
        self.tokenizer, self.keep = tokenizer, keep
        specials = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(specials) or "(?!)").search
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}
        # whether one word of plain letters may go straight to the model, as bytes in their byte-level form;
        # counting takes the library's batches throughout
        probes = ("Hello", "\u00c9clair", "na\u00efvet\u00e9", "\u00f1and\u00fa", "stra\u00dfe", "\u0142\u00f3d\u017a")
        # symbols that never join a letter or digit before them
        def ids(text: str) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        self.ends = "".join(c for c in punctuation if all(ids(w + x) == ids(w) + ids(x) for w in ("ab", "1", "\u00e9") for x in (c, c + c)))
        self.direct = keep is not len and all(self.letters(w) == tokenizer.encode(w, add_special_tokens=False).ids for w in probes)

    def letters(self, word: str) -> list[int]:
        lower = word.lower()
        if not lower.isascii():
            lower = lower.encode().decode("latin-1").translate(BYTE_LEVEL)
        return [t.id for t in self.tokenizer.model.tokenize(lower)]

    def prepared(self, text: str) -> str:
        """Lower case where the tokenizer does the same, for fewer different words to remember."""
        return text.lower() if "<" not in text and (text.isascii() or OTHER_LETTERS.search(text) is None) else text

    def learn(self, words: list[str]) -> list[object]:
        """What `keep` makes of each of `words`.  One that ends in symbols is its stem and that run, and only these
        are remembered: a word takes one entry, whatever stands behind it."""
        known, older, ends = self.known, self.older, self.ends
        cuts = [n if (n := len(w.rstrip(ends))) < len(w) and self.cuts_at(w, n) else 0 for w in words]
        parts = {w[:n] if n else w for w, n in zip(words, cuts, strict=True)}
        parts.update({w[n:] for w, n in zip(words, cuts, strict=True) if n})
        made = {p: x for p in parts if (x := known.get(p)) is not None}
        parts.difference_update(made)
        new = {p: x for p in parts if (x := older.get(p)) is not None}
        parts.difference_update(new)
        new.update(self.encode_all(parts))
        if len(known) + len(new) > CACHE_ENTRIES // 2:
            self.known, self.older = {}, known
        if len(new) <= CACHE_ENTRIES // 2:                # else one run of more different words than that
            self.known.update(new)
        made.update(new)
        return [made[w[:n]] + made[w[n:]] if n else made[w] for w, n in zip(words, cuts, strict=True)]

    def cuts_at(self, word: str, n: int) -> bool:
        """Whether the run of symbols from `n` to the end is taken apart: not if what stands before it
        might join it in one pre-token."""
        return n > 0 and (c := word[n - 1]).isalnum() and c < PLAIN_BELOW and c != NOT_PLAIN and not self.special(word)

    def encode_all(self, parts: set[str]) -> dict[str, object]:
        """What `keep` makes of each part's ids, at once: lists of ids that lived on would be walked
        over by every collection of garbage."""
        keep = self.keep
        out, others = ({"": keep([])} if "" in parts else {}), []
        if self.direct:
            tokenize, letters = self.tokenizer.model.tokenize, self.letters
            for p in parts:
                if not p.isalpha():
                    others.append(p)
                elif p.isascii():
                    out[p] = keep([t.id for t in tokenize(p.lower())])
                elif max(p) < PLAIN_BELOW and NOT_PLAIN not in p:
                    out[p] = keep(letters(p))
                else:
                    others.append(p)
        else:
            others = list(parts)
        for _, run in runs(others, None, BATCH_BYTES, utf8_length):
            found = self.tokenizer.encode_batch(run, add_special_tokens=False)
            out.update((w, keep(e.ids)) for w, e in zip(run, found, strict=True))
        return out

    def encode(self, parts: list[str]) -> tuple[list[object], np.ndarray, np.ndarray]:
        """(what `keep` made of the different words, for each word its number among them, where
        each part's words begin and the last ends)."""
        words, codes, offsets = split(list(map(self.prepared, parts)))
        found = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(found) if x is None]
        made = self.learn([words[i] for i in missing])
        for i, x in zip(missing, made, strict=True):
            found[i] = x
        return found, codes, offsets


class TextEncoder:
    """Counts by any other file: whole texts, long ones cut before a single space where that is safe."""

    def __init__(self, encode: Callable[[list[str]], list[int]], cut: re.Pattern | None):
        self.encode_counts, self.cut = encode, cut


def _drops_space(tokenizer) -> bool:
    probe = tokenizer.encode(" \n ", add_special_tokens=False).ids
    joined = tokenizer.encode("ab cd", add_special_tokens=False).ids
    apart = [tokenizer.encode(w, add_special_tokens=False).ids for w in ("ab", "cd")]
    return not probe and joined == apart[0] + apart[1]


def encoder(path: str, keep: Callable[[list[int]], object] = len):
    """The encoder of a tokenizer file; one for each Python worker."""
    return of_worker(("tokens", path, keep.__name__), lambda: load(path, keep))


def load(path: str, keep: Callable[[list[int]], object]):
    if path.endswith(".model"):
        import sentencepiece
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return TextEncoder(lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)], None)
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if _drops_space(tokenizer):
        return WordEncoder(tokenizer, keep)
    # A byte-level file joins one space to the word behind it: between a letter and " x" no token crosses.
    return TextEncoder(lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)],
                       re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])"))


def counts(texts: list[str | None], path: str) -> np.ndarray:
    """Tokens of each text (None: empty), encoded in runs of about as many bytes."""
    made, out = encoder(path), np.zeros(len(texts), np.int64)
    if isinstance(made, WordEncoder):
        for owners, parts in runs(texts, length=utf8_length):
            sizes, codes, offsets = made.encode(parts)
            upto = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64)[codes])])
            np.add.at(out, owners, upto[offsets[1:]] - upto[offsets[:-1]])
    else:
        for owners, parts in runs(texts, made.cut, length=utf8_length):
            np.add.at(out, owners, made.encode_counts(parts))
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > `limit`) of every row of `docs`.

    Whole texts, without begin, end or added tokens, truncation or padding;
    special strings inside a text as the library takes them by default.  NULL
    and empty texts have zero bytes and tokens; NULL and repeated doc_ids stay
    as rows of their own; other columns of `docs` are ignored.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.concatenate([np.zeros(0, np.int64), *(counts(x, path) for x in texts_of(batch.column("text")))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(of, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def id_bytes(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


def text_ids(texts: list[str | None], path: str, size: int | None = None) -> Iterator[bytes]:
    """Little-endian ids of each text in order, for files that drop white space; `size` characters at a time."""
    made = encoder(path, id_bytes)
    if not isinstance(made, WordEncoder):
        raise ValueError(f"ids are given by word; {path} joins white space to words")
    at, held = 0, []                                   # the next text, what is there of it so far

    def upto(owner: int) -> Iterator[bytes]:
        nonlocal at, held
        while at < owner:
            yield b"".join(held)
            at, held = at + 1, []

    for owners, parts in runs(texts, size=size or RUN_CHARS):
        found, codes, offsets = made.encode(parts)
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        by_word = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(found), "<u4")))
        ids = by_word.take(pa.array(codes)).flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])[offsets]
        for k, owner in enumerate(owners):
            yield from upto(owner)
            held.append(ids[ends[k]:ends[k + 1]].tobytes())
    yield from upto(len(texts))
