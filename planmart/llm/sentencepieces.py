"""SentencePiece ids and decoded texts by a table of distinct marked words.

A SentencePiece file marks white space with U+2581 and puts one mark before
the text.  Where no piece of the file has a mark behind another character, no
merge can cross the place between a character and the mark behind it: a text's
ids are those of its marked words (a run of marks and what follows up to the
next one) in order.  Each different marked word of a run of texts is then
segmented once, remembered within a bound, and the ids are joined back by
position.  Files with other pieces, or whose normalizer changes characters,
encode whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmart.llm.pieces import of_worker, runs, slices_of

MARK = "▁"
RUN_CHARS = 2 << 20      # characters of text that are looked at together, about
TABLE_WORDS = 200_000    # marked words that a worker remembers, at most
LONGEST_KEPT = 64        # longer ones are segmented in each run again
DECODE_IDS = 1 << 20     # ids that the library decodes together, about
#: One of each kind that a normalizer other than the identity changes: ligature, wide and no-break space, tab, accent, runs of blanks.
PROBE = "ﬁ 　①\xa0\t é  x\r\n "

_CUT = re.compile(f"(?<![ {MARK}])[ {MARK}]")
_FIRST = re.compile(f"[ {MARK}]*[^ {MARK}]*")
_WORD = re.compile(f"[ {MARK}]([ {MARK}]*[^ {MARK}]*)")
_SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"


class MarkedWords:
    """Segments texts with one SentencePiece file.

    The table has two halves of TABLE_WORDS / 2 words: when the newer is full the
    older goes, so words met again and again stay.
    """

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        vocabulary = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        marked = (MARK + PROBE).replace(" ", MARK)
        self.by_word = (all(MARK not in p.lstrip(MARK) for p in vocabulary) and MARK in vocabulary
                        and self.model.normalize(PROBE) == marked)
        self.lone = self.pack([self.model.piece_to_id(MARK)])
        # a piece to stand before the rest of a text that is decoded in parts; places where it may be cut
        self.anchor = next((i for i, p in enumerate(vocabulary) if p == "a"), None)
        self.opens = np.array([p.startswith(MARK) for p in vocabulary])
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of marked words without their first mark, which the library puts there; '' is a mark alone."""
        found = self.model.encode(words, num_threads=1)
        return [self.pack(ids) if w else self.lone for w, ids in zip(words, found, strict=True)]

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of different marked words, from the table or segmented now."""
        out = list(map(self.new.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        unseen = []
        for i in missing:
            out[i] = self.old.get(words[i])
            if out[i] is None:
                unseen.append(i)
        for i, ids in zip(unseen, self.segment([words[i] for i in unseen]), strict=True):
            out[i] = ids
        for i in missing:
            if len(words[i]) <= LONGEST_KEPT:
                if len(self.new) >= TABLE_WORDS // 2:
                    self.new, self.old = {}, self.new
                self.new[words[i]] = out[i]
        return out

    def words_of(self, rests: list[str]) -> pa.ListArray:
        """The marked words, without their first mark, of texts that are empty or begin with a mark."""
        plain = [bool(r) and "  " not in r and MARK not in r for r in rests]
        kind = pa.list_(pa.large_string())
        clean = pc.split_pattern(pa.array([r[1:] for r, p in zip(rests, plain, strict=True) if p], pa.large_string()), " ").cast(kind)
        other = pa.array([_WORD.findall(r) for r, p in zip(rests, plain, strict=True) if not p], kind)
        if not len(other):
            return clean
        order = np.empty(len(rests), np.int64)
        order[np.flatnonzero(plain)] = np.arange(len(clean))
        order[np.flatnonzero(~np.array(plain, bool))] = len(clean) + np.arange(len(other))
        return pa.concat_arrays([clean, other]).take(pa.array(order))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian ids of each text in order; None is empty."""
        if not self.by_word:
            for text in texts:
                yield self.pack(self.model.encode(text or ""))
            return
        held: list[bytes] = []
        at = 0                                            # the next text, and what is there of it so far
        for owners, parts in runs(texts, _CUT, RUN_CHARS):
            begins = [k == 0 and not (owner == at and held) or k > 0 and owners[k - 1] != owner
                      for k, owner in enumerate(owners)]
            firsts = [_FIRST.match(p).group() if b else "" for p, b in zip(parts, begins, strict=True)]
            lists = self.words_of([p[len(f):] for p, f in zip(parts, firsts, strict=True)])
            coded = lists.flatten().dictionary_encode()
            ids = pa.array(self.look_up(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
            ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
            data = memoryview(ids.buffers()[2] or b"") if len(ids) else memoryview(b"")
            offsets = lists.offsets.to_numpy()
            heads = self.model.encode(firsts, num_threads=1)
            for k, owner in enumerate(owners):
                while at < owner:
                    yield b"".join(held)
                    at, held = at + 1, []
                if begins[k]:
                    held.append(self.pack(heads[k]))
                a, b = (ends[offsets[k + j] - offsets[0]] for j in (0, 1))
                held.append(bytes(data[a:b]))
        while at < len(texts):
            yield b"".join(held)
            at, held = at + 1, []

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode(ids); very many ids in parts that begin with a mark, each behind an anchor."""
        if len(ids) <= DECODE_IDS or self.anchor is None:
            return self.model.decode(ids.tolist())
        places = np.flatnonzero(self.opens[ids])
        out, start = [], 0
        while start < len(ids):
            later = places[np.searchsorted(places, start + DECODE_IDS):]
            end = int(later[0]) if len(later) else len(ids)
            part = ids[start:end].tolist()
            out.append(self.model.decode(part) if start == 0 else self.model.decode([self.anchor, *part])[1:])
            start = end
        return "".join(out)


def of_file(path: str) -> MarkedWords:
    return of_worker(("sentencepiece", path), lambda: MarkedWords(path))


def encode(docs: DataFrame, path: str, bos: bool = True, eos: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded (the library's decode of
    these ids) of every row of `docs` (doc_id, text).

    Ids are those of the library for the whole text, between its begin and end
    ids unless these are switched off, without sampling.  NULL and empty texts
    have just those.  NULL and repeated doc_ids stay as rows of their own, other
    columns are ignored, and an empty table gives no rows.
    """
    def rows_of(made: MarkedWords, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        head = made.pack([made.model.bos_id()] if bos else [])
        tail = made.pack([made.model.eos_id()] if eos else [])
        found = [head + ids + tail for ids in made.encode(texts)]
        if sum(map(len, found)) <= 4 * DECODE_IDS:
            yield from zip(found, made.model.decode([np.frombuffer(x, "<u4").tolist() for x in found]), strict=True)
        else:
            yield from ((x, made.decode(np.frombuffer(x, "<u4"))) for x in found)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = of_file(path)
        for batch in batches:
            for part in slices_of(batch, "text", RUN_CHARS):
                found = list(rows_of(made, part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x, _ in found], pa.int64()),
                     pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, _SCHEMA)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of `encoded`'s ids and decoded texts, lowercase hex."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
