"""Language identification by known words, backing off to shorter character n-grams.

A known word counts with its log frequency in each language.  An unseen word
backs off: its longest n-grams first, and where none of them is known the next
shorter ones.  The model counts every labelled text and holds a bounded number of
words and n-grams, so it can be sent to every task; prediction reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmart.llm.common import arrow_batches, hash_share, written
from planmart.llm.pieces import forget, of_worker, runs, slices_of, split, strings, texts_of, trim

FIT_TEXTS = 1000        # texts that a language with more of them weighs as much as
SEEN = 0.5              # times an item stands in so many texts of a language that has it
COUNTED = 200_000       # words that a task counts before it hands the counts on
KNOWN_WORDS = 30_000    # most frequent words
KNOWN_GRAMS = 30_000    # most frequent n-grams
LONGEST = 4             # n-grams of 4, 3, 2 and 1 characters, word ends marked
SMOOTH = 0.5
ASIDE = 0.2             # share of the labelled texts that `keep_known` learns its limits from, not its model
BINS = 10_000           # shares of backed words are counted to this part
LEAST_OWN = 0.001       # share of a language's own texts that its limit may be above
DEVIATIONS = 4.0        # robust standard deviations below its median that a language's own texts may lie
REMEMBERED = 200_000    # pieces of text whose scores a worker remembers, at most,
REMEMBERED_BYTES = 32 << 20     # and the bytes of those scores
POINT_BITS = 21         # of a Unicode code point
AT_ONCE = 4096          # pieces whose words and n-grams are held while they are scored
RUN_CHARS = 2 << 20     # characters of text that are looked at together, about
UNKNOWN = "und"

_ASCII_WORD = re.compile(r"[a-z]+")
_WORD = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower case."""
    if not text:
        return []
    return _ASCII_WORD.findall(text.lower()) if text.isascii() else _WORD.findall(text.lower())


def piece_words(piece: str) -> list[str]:
    """`words_of` a lower-case piece without white space; quick for a word with its punctuation."""
    bare = piece.strip(".,!?;:")
    return [bare] if bare.isalpha() else words_of(piece)


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def marked_places(words: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The marked words one after the other, and at each of its places the character's code point, the
    number of the word and how many of the word's characters begin there."""
    marked = "^" + "$^".join(words) + "$" if words else ""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    points = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.int64)
    return marked, points, owner, np.cumsum(lengths)[owner] - np.arange(len(points))


class KnownGrams:
    """The n-grams of `ids`, found at all places of many words at once.

    An n-gram is looked up by a number: the place of its beginning, one character shorter, among the
    known beginnings of that length, and its last code point.
    """

    def __init__(self, ids: dict[str, int]):
        starts: dict[str, int] = {"": 0}
        #: For each size the numbers of the beginnings so long, and the n-gram that each is, -1 if none.
        self.sizes: list[tuple[pa.Array, np.ndarray]] = []
        for n in range(1, LONGEST + 1):
            found = sorted({g[:n] for g in ids if len(g) >= n})
            keys = [(starts[g[:-1]] << POINT_BITS) + ord(g[-1]) for g in found]
            self.sizes.append((pa.array(keys, pa.int64()), np.array([ids.get(g, -1) for g in found], np.int64)))
            starts = {g: i for i, g in enumerate(found)}

    def of(self, words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, the words' numbers in ascending order, ids of the known n-grams there), the longest first."""
        _, points, owner, left = marked_places(words)
        at, start = np.arange(len(points)), np.zeros(len(points), np.int64)
        out = []
        for n, (keys, ids) in enumerate(self.sizes, 1):
            inside = left[at] >= n
            at, start = at[inside], start[inside]
            start = pc.index_in(pa.array((start << POINT_BITS) + points[at + n - 1]), keys).fill_null(-1).to_numpy().astype(np.int64)
            at, start = at[start >= 0], start[start >= 0]
            known = ids[start] >= 0
            out.append((n, owner[at[known]], ids[start[known]]))
        yield from reversed(out)


@dataclass
class Model:
    """Log frequencies by language, of known words and of known n-grams."""
    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    gram_ids: dict[str, int] = field(default_factory=dict)
    word_logs: np.ndarray | None = None
    gram_logs: np.ndarray | None = None
    word_seen: np.ndarray | None = None
    gram_seen: np.ndarray | None = None
    word_backed: np.ndarray | None = field(default=None, init=False)
    known_grams: KnownGrams = field(init=False)

    def __post_init__(self) -> None:
        self.known_grams = KnownGrams(self.gram_ids)
        # how much each language backs the known words, once for the model
        if self.word_seen is not None and len(self.words):
            self.word_backed = np.where(self.word_seen, 1.0, self.of_grams(list(self.words))[1])

    def of_grams(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row for each word: the mean log frequency of its longest known n-grams (zero if none is
        known), and by language the share of its 3- and 4-grams seen in it."""
        logs, backed = np.zeros((len(words), len(self.langs))), np.zeros((len(words), len(self.langs)))
        without = np.ones(len(words), bool)         # words without a known n-gram of a longer size
        for n, owner, ids in self.known_grams.of(words):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            some = owner[first]
            if n >= 3 and len(some):
                backed[some] += np.add.reduceat(self.gram_seen[ids].astype(float), first)
            longest = without[owner]
            without[some] = False
            owner, ids = owner[longest], ids[longest]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            if len(first):
                sizes = np.diff(first, append=len(owner))
                logs[owner[first]] = np.add.reduceat(self.gram_logs[ids], first) / sizes[:, None]
        return logs, backed / np.array([[2 * len(w) - 1] for w in words])     # 3- and 4-grams of ^word$

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row for each word: its log frequencies if it is known, else those of its n-grams; and by language
        whether it backs the word: 1 if the word was seen in it, else the share of the word's n-grams."""
        logs, backed = np.zeros((len(words), len(self.langs))), np.zeros((len(words), len(self.langs)))
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        known, unseen = np.flatnonzero(ids >= 0), np.flatnonzero(ids < 0)
        if len(known):
            logs[known], backed[known] = self.word_logs[ids[known]], self.word_backed[ids[known]]
        if len(unseen):
            logs[unseen], backed[unseen] = self.of_grams([words[i] for i in unseen])
        return logs, backed


class Scorer:
    """Scores texts with a model by a bounded table of pieces between white space.

    A piece's row has its words' summed log frequencies by language, how far each language
    backs them, the number of words, and whether there is one.  The table has two halves:
    when the newer is full the older goes, so pieces met again and again stay.
    """

    def __init__(self, model: Model):
        self.model = model
        self.width = 2 * len(model.langs) + 2
        self.half = max(1, min(REMEMBERED, REMEMBERED_BYTES // (8 * self.width)) // 2)
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.new_rows = np.empty((self.half, self.width))
        self.old_rows = np.empty((self.half, self.width))

    def learn(self, pieces: list[str]) -> np.ndarray:
        """Rows of these pieces."""
        out = np.zeros((len(pieces), self.width))
        n = len(self.model.langs)
        for i in range(0, len(pieces), AT_ONCE):
            groups = list(map(piece_words, pieces[i:i + AT_ONCE]))
            words = pa.array(chain.from_iterable(groups), pa.string()).dictionary_encode()
            if len(words):
                owner = np.repeat(np.arange(i, i + len(groups)), np.fromiter(map(len, groups), np.int64, len(groups)))
                at = words.indices.to_numpy()
                logs, backed = self.model.score_words(strings(words.dictionary))
                np.add.at(out[:, :n], owner, logs[at])
                np.add.at(out[:, n:2 * n], owner, backed[at])
                np.add.at(out[:, 2 * n], owner, 1.0)
        out[:, -1] = out[:, 2 * n] > 0
        return out

    def rows_of(self, pieces: list[str]) -> np.ndarray:
        """Rows of these different pieces, from the table or worked out now."""
        out = np.empty((len(pieces), self.width))
        at = np.fromiter(map(self.new.get, pieces, repeat(-1)), np.int64, len(pieces))
        out[at >= 0] = self.new_rows[at[at >= 0]]
        missing = np.flatnonzero(at < 0)
        others = list(map(pieces.__getitem__, missing.tolist()))
        at = np.fromiter(map(self.old.get, others, repeat(-1)), np.int64, len(others))
        out[missing[at >= 0]] = self.old_rows[at[at >= 0]]
        unseen = np.flatnonzero(at < 0)
        if len(unseen):
            out[missing[unseen]] = self.learn(list(map(others.__getitem__, unseen.tolist())))
        for i in range(0, len(missing), self.half):
            part = missing[i:i + self.half]
            if len(self.new) + len(part) > self.half:
                self.new, self.old = {}, self.new
                self.new_rows, self.old_rows = self.old_rows, self.new_rows
            first = len(self.new)
            self.new_rows[first:first + len(part)] = out[part]
            self.new.update(zip(others[i:i + self.half], count(first)))
        return out

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The sums of each text's rows, and whether it has a letter."""
        total = np.zeros((len(texts), self.width))
        for owners, parts in runs(texts, size=RUN_CHARS) if self.model.langs else ():
            pieces, codes, offsets = split([p.lower() for p in parts])
            rows = self.rows_of(pieces)
            for k, owner in enumerate(owners):
                part = codes[offsets[k]:offsets[k + 1]]
                for i in range(0, len(part), 1 << 14):
                    total[owner] += rows[part[i:i + (1 << 14)]].sum(axis=0)
        return total, total[:, -1] > 0

    def score_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior) of each text; ('und', 0) without letter or model. Ties: the first name."""
        total, lettered = self.totals(texts)
        return [self.verdict(t) if seen else (UNKNOWN, 0.0)
                for t, seen in zip(total[:, :len(self.model.langs)], lettered, strict=True)]

    def back_all(self, texts: list[str | None]) -> list[tuple[str, float, list[float]]]:
        """(language, posterior, share of its words that each language backs) of each text."""
        n = len(self.model.langs)
        total, lettered = self.totals(texts)
        return [(*self.verdict(t[:n]), (t[n:2 * n] / max(1.0, t[2 * n])).tolist()) if seen else (UNKNOWN, 0.0, [0.0] * n)
                for t, seen in zip(total, lettered, strict=True)]

    def verdict(self, total: np.ndarray) -> tuple[str, float]:
        best = int(np.argmax(total))
        return self.model.langs[best], float(1.0 / np.exp(total - total[best]).sum())

    def score(self, text: str | None) -> tuple[str, float]:
        return self.score_all([text])[0]


def _top(counts: DataFrame, limit: int) -> list:
    """The `limit` most frequent items with their counts by language (bounded, so it may reach the driver)."""
    weighted = F.round(F.sum(F.col("n") * F.col("share")), 6)      # sums of doubles differ in their last digits by order
    return (counts.groupBy("item")
            .agg(weighted.alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
            .orderBy(F.desc("n"), "item").limit(limit).collect())


def _weighed(items: list, langs: list[str], share: dict[str, float]) -> np.ndarray:
    """How often each item stands in FIT_TEXTS texts of each language (in all of them, if there are fewer)."""
    return np.array([[row["by"].get(lang, 0) * share[lang] for lang in langs] for row in items],
                    float).reshape(len(items), len(langs))


def _logs(found: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return np.log(found + SMOOTH) - np.log(totals + SMOOTH * (len(found) + 1))


_COUNTS = "kind string, lang string, item string, n long"


def _count_batches(kind: str, found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counts in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(counts), pa.string()), pa.array([lang] * len(counts), pa.string()),
             pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["kind", "lang", "item", "n"])


def fit(labelled: DataFrame, words: int = KNOWN_WORDS, n_grams: int = KNOWN_GRAMS) -> Model:
    """A model from `labelled` (text, lang); rows without text or lang don't count.

    Every word of every text is counted.  A language with more than FIT_TEXTS texts weighs
    as much as one with so many (its counts are scaled down), so frequent languages don't
    outweigh rare ones and a few wrong labels among many texts don't make an item seen.
    Each task counts its words, the counts meet by word, and n-grams are counted
    once for each word, weighted by its count.
    """
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")

    def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        found: dict[str, Counter] = {}
        for batch in batches:
            for part in slices_of(batch, "text", RUN_CHARS):
                texts: dict[str, list[str]] = {}
                for text, lang in zip(strings(part.column("text")), strings(part.column("lang")), strict=True):
                    texts.setdefault(lang, []).append(text)
                for lang, own in texts.items():
                    counts = found.setdefault(lang, Counter())
                    for _, parts in runs(own, size=RUN_CHARS):
                        pieces, codes, _ = split([p.lower() for p in parts])
                        groups = list(map(piece_words, pieces))
                        sizes = np.fromiter(map(len, groups), np.int64, len(groups))
                        times = np.repeat(np.bincount(codes, minlength=len(pieces)), sizes).tolist()
                        for word, n in zip(chain.from_iterable(groups), times, strict=True):
                            counts[word] += n
                if sum(map(len, found.values())) > COUNTED:
                    yield from _count_batches("w", found)
                    found = {}
        yield from _count_batches("w", found)
        trim()

    def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            marked, points, owner, left = marked_places(strings(batch.column("item")))
            lang, times = langs.indices.to_numpy()[owner], batch.column("n").to_numpy()[owner]
            # n-grams of a language are numbered by the number of their beginning and their last character
            at, number = np.arange(len(points)), lang.astype(np.int64)
            for size in range(1, LONGEST + 1):
                inside = left[at] >= size
                at, number = at[inside], number[inside]
                coded = pa.array((number << POINT_BITS) + points[at + size - 1]).dictionary_encode()
                number = coded.indices.to_numpy().astype(np.int64)
                some = np.zeros(len(coded.dictionary), np.int64)
                some[number] = at       # a place where it stands
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["g"] * len(some), pa.string()), langs.dictionary.take(pa.array(lang[some])),
                     pa.array([marked[i:i + size] for i in some.tolist()], pa.string()),
                     pa.array(np.bincount(number, times[at], len(some)).astype(np.int64))], ["kind", "lang", "item", "n"])

    texts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {lang: min(1.0, FIT_TEXTS / n) for lang, n in texts.items()}
    with arrow_batches(labelled.sparkSession, RUN_CHARS):
        of_words = written(rows.mapInArrow(word_counts, _COUNTS)
                           .groupBy("kind", "lang", "item").agg(F.sum("n").alias("n")))
    # counts are small files, but taking words apart is work for all cores
    cores = labelled.sparkSession.sparkContext.defaultParallelism
    of_grams = (of_words.select("item", "lang", "n").repartition(cores).mapInArrow(gram_counts, _COUNTS)
                .groupBy("kind", "lang", "item").agg(F.sum("n").alias("n")))
    counts = of_words.unionByName(written(of_grams))
    totals = {(r["kind"], r["lang"]): float(r["n"])
              for r in counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for _, lang in totals})
    if not langs:
        return Model([])
    shares = F.create_map(*[F.lit(x) for lang in langs for x in (lang, share[lang])])
    counts = counts.withColumn("share", shares[F.col("lang")])
    known = _top(counts.where("kind = 'w'"), words)
    found = _top(counts.where("kind = 'g'"), n_grams)
    of = lambda kind: np.array([totals.get((kind, lang), 0.0) * share[lang] for lang in langs])
    by_word, by_gram = _weighed(known, langs, share), _weighed(found, langs, share)
    return Model(langs, {r["item"]: i for i, r in enumerate(known)}, {r["item"]: i for i, r in enumerate(found)},
                 _logs(by_word, of("w")), _logs(by_gram, of("g")), by_word >= SEEN, by_gram >= SEEN)


def predict(text: Column, model: Model, spark) -> Column:
    """struct(lang_pred, score) of a text column.  The model's size is bounded by its parameters."""
    sent = spark.sparkContext.broadcast(model)

    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        scorer = of_worker(("language", id(model)), lambda: Scorer(model))
        for column in columns:
            found = [x for texts in texts_of(column, RUN_CHARS) for x in scorer.score_all(texts)]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], ["lang_pred", "score"])

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return F.arrow_udf(of, kind)(text)


def identify(docs: DataFrame, labelled: DataFrame, *keep: str) -> DataFrame:
    """`keep` columns of `docs` with lang_pred and score, learned from `labelled` (text, lang).

    NULL texts and texts without a letter are 'und' with score 0, as is all
    text when nothing was learned; ties go to the first name; repeated rows are
    predicted each; an empty table gives no rows.
    """
    model = fit(labelled)
    found = docs.select(*[F.col(c) for c in keep],
                        predict(F.col("text").cast("string"), model, docs.sparkSession).alias("_p"))
    return found.select(*keep, "_p.lang_pred", "_p.score")


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def backing(text: Column, sent: Broadcast) -> Column:
    """struct(lang_pred, score, backing) of a text column; backing has a share for each language of the model sent."""
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        scorer = of_worker(("language", id(model)), lambda: Scorer(model))
        for column in columns:
            found = [x for texts in texts_of(column, RUN_CHARS) for x in scorer.back_all(texts)]
            yield pa.StructArray.from_arrays([pa.array([x for x, _, _ in found], pa.string()),
                                              pa.array([s for _, s, _ in found], pa.float64()),
                                              pa.array([b for _, _, b in found], pa.list_(pa.float64()))],
                                             ["lang_pred", "score", "backing"])

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("backing", T.ArrayType(T.DoubleType()))])
    return F.arrow_udf(of, kind)(text)


def quantile(values: np.ndarray, counts: np.ndarray, q: float) -> float:
    """The q-quantile of sorted `values` that occur `counts` times, between two of them in proportion."""
    upto = np.cumsum(counts)
    at = q * (int(upto[-1]) - 1)
    low = int(at)
    below, above = values[np.searchsorted(upto, [low, min(low + 1, int(upto[-1]) - 1)], side="right")]
    return float(below + (at - low) * (above - below))


def _tally(values, counts) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(np.array(values, float), return_inverse=True)
    return found, np.bincount(where, np.array(counts, float), len(found)).astype(np.int64)


def bounds(langs: list[str], own: dict[str, tuple], middles: dict[tuple[str, int], float]) -> list[float]:
    """The least backing by each language that counts as text in it, from texts it wasn't learned from:
    `own` has (shares, how many texts) of the texts of each language by itself, `middles` the median share
    of the texts of any label by each language.

    Midway between the median of its own texts and that of the other language it backs most, which stands
    for a language that wasn't learned; but DEVIATIONS robust deviations below its own texts at least, and
    above LEAST_OWN of them at most, so that they stay.  A language without such texts takes those of all languages; without any, zero.
    """
    have = [own[lang] for lang in langs if lang in own]
    every = tuple(np.concatenate(x) for x in zip(*have, strict=True)) if have else None
    out = []
    for j, lang in enumerate(langs):
        mine = own.get(lang, every)
        if mine is None:
            out.append(0.0)
            continue
        values, counts = _tally(*mine)
        middle = quantile(values, counts, 0.5)
        spread = 1.4826 * quantile(*_tally(np.abs(values - middle), counts), 0.5)
        others = max((m for (x, k), m in middles.items() if k == j and x != lang), default=0.0)
        out.append(max(0.0, min((middle + others) / 2, middle - DEVIATIONS * spread, quantile(values, counts, LEAST_OWN))))
    return out


def limits(langs: list[str], found: list[tuple[str, list[float]]]) -> list[float]:
    """`bounds` from (label, backing) of single texts."""
    by: dict[str, np.ndarray] = {x: np.array([shares for y, shares in found if y == x], float) for x in {x for x, _ in found}}
    own = {lang: (by[lang][:, j], np.ones(len(by[lang]))) for j, lang in enumerate(langs) if lang in by}
    return bounds(langs, own, {(x, j): float(np.median(rows[:, j])) for x, rows in by.items() for j in range(len(langs))})


def limits_of(tried: DataFrame, langs: list[str]) -> list[float]:
    """`bounds` from every row of `tried` (lang, backing); shares are counted to 1 / BINS, so what reaches
    the driver doesn't grow with the texts."""
    counts = written(tried.select("lang", F.posexplode("backing").alias("j", "share"))
                     .groupBy("lang", "j", F.round(F.col("share") * BINS).cast("int").alias("bin"))
                     .agg(F.count(F.lit(1)).alias("n")))
    middles = counts.groupBy("lang", "j").agg(F.percentile("bin", F.lit(0.5), F.col("n")).alias("m"))
    own: dict[str, list] = {}
    mine = F.lit(False)
    for j, lang in enumerate(langs):
        mine = mine | ((F.col("j") == j) & (F.col("lang") == lang))
    for r in counts.where(mine).collect():
        own.setdefault(r["lang"], []).append((r["bin"] / BINS, r["n"]))
    return bounds(langs, {lang: tuple(np.array(x, float) for x in zip(*rows, strict=True)) for lang, rows in own.items()},
                  {(r["lang"], r["j"]): r["m"] / BINS for r in middles.collect()})


def keep_known(docs: DataFrame, labelled: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of `docs` whose language is told with a posterior of `least` or more and backs
    enough of their words (`limits`); all columns.

    The posterior only compares the learned languages and nears 1 within a few
    words; the share of backed words doesn't depend on the length and is low
    in another language and in random letters.
    """
    text = F.col("text").cast("string")
    aside = hash_share(F.lit(23), text) < ASIDE
    rest = labelled.where(F.coalesce(~aside, F.lit(True)))
    model = fit(rest)
    names, sent = docs.columns, docs.sparkSession.sparkContext.broadcast(model)
    held = (labelled.where(aside).select(text.alias("text"), F.col("lang").cast("string").alias("lang"))
            .where("text IS NOT NULL AND lang IS NOT NULL"))
    tried = held.select("lang", backing(F.col("text"), sent).alias("_p")).where(F.col("_p.lang_pred") != UNKNOWN)
    with arrow_batches(docs.sparkSession, RUN_CHARS):
        least_backing = limits_of(tried.select("lang", "_p.backing"), model.langs)
    found = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                        backing(text, sent).alias("_p"))
    enough = F.lit(False)
    for j, lang in enumerate(model.langs):
        enough = enough | ((F.col("_p.lang_pred") == lang) & (F.col("_p.backing")[j] >= least_backing[j]))
    return (found.where((F.col("_p.lang_pred") != UNKNOWN) & (F.col("_p.score") >= least) & enough)
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]))
