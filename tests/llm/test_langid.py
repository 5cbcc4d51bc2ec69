import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import langid

TRAIN = [("the cat and the dog", "en"), ("the house of the cat", "en"), ("der hund und die katze", "de"),
         ("das haus und der garten", "de"), ("le chat et le chien", "fr"), ("la maison et le jardin", "fr")]


@pytest.fixture(scope="module")
def model(session):
    return langid.fit(session.createDataFrame(TRAIN + [(None, "en"), ("x", None)], "text string, lang string"))


def brute(text, train):
    """Word-first backoff straight from the counts."""
    langs = sorted({lang for _, lang in train})
    words = {lang: Counter(w for t, x in train if x == lang for w in langid.words_of(t)) for lang in langs}
    grams = {lang: Counter({}) for lang in langs}
    for lang in langs:
        for w, n in words[lang].items():
            for size in range(1, 5):
                for g in langid.grams(w, size):
                    grams[lang][g] += n

    def log(table, item):
        size = len(set().union(*table.values())) + 1
        return [math.log(table[x][item] + 0.5) - math.log(sum(table[x].values()) + 0.5 * size) for x in langs]

    total = [0.0] * len(langs)
    for w in langid.words_of(text):
        if any(words[x][w] for x in langs):
            add = log(words, w)
        else:
            for size in range(4, 0, -1):
                known = [g for g in langid.grams(w, size) if any(grams[x][g] for x in langs)]
                if known:
                    add = [sum(c) / len(known) for c in zip(*(log(grams, g) for g in known))]
                    break
            else:
                add = [0.0] * len(langs)
        total = [a + b for a, b in zip(total, add)]
    best = max(range(len(langs)), key=lambda i: (total[i], -i))
    return langs[best], 1 / sum(math.exp(t - total[best]) for t in total)


def test_scores_are_those_of_the_method(model):
    scorer = langid.Scorer(model)
    for text in ("the dog", "katzen und hunde", "jardins", "Le Chien, et la dog!", "zzz", "cat " * 500 + "xyz", "ñandú"):
        lang, score = scorer.score(text)
        expected, value = brute(text, TRAIN)
        assert (lang, pytest.approx(score)) == (expected, value)


def test_texts_without_letters(model):
    scorer = langid.Scorer(model)
    for text in (None, "", "12 ² — !", "\n"):
        assert scorer.score(text) == ("und", 0.0)
    assert langid.Scorer(langid.Model([])).score("abc") == ("und", 0.0)


def test_remembered_pieces_are_bounded(model, monkeypatch):
    monkeypatch.setattr(langid, "REMEMBERED", 20)
    scorer = langid.Scorer(model)
    for i in range(40):
        text = " ".join(f"q{chr(97 + i % 26)}{chr(97 + j)}" for j in range(15))
        assert scorer.score(text) == langid.Scorer(model).score(text)
        assert len(scorer.new) + len(scorer.old) <= 20


def test_backing_of_words(model):
    """1 for a word seen in a language, else the share of its 3- and 4-grams seen in it."""
    seen = {lang: {w for t, x in TRAIN if x == lang for w in langid.words_of(t)} for lang in model.langs}
    words = ["the", "katze", "katzen", "qqq", "x", "le", "maisons"]
    _, backed = model.score_words(words)
    for w, row in zip(words, backed, strict=True):
        every = [g for n in (3, 4) for g in langid.grams(w, n)]
        known = [{g for s in seen[x] for n in (3, 4) for g in langid.grams(s, n)} for x in model.langs]
        assert row.tolist() == pytest.approx([1.0 if w in seen[x] else sum(g in k for g in every) / (2 * len(w) - 1)
                                              for x, k in zip(model.langs, known, strict=True)])


def test_long_texts_in_parts(model, monkeypatch):
    text = "the dog, und le chien " * 300
    whole = langid.Scorer(model).score_all([text, None, "jardin", text])
    monkeypatch.setattr(langid, "RUN_CHARS", 100)
    parts = langid.Scorer(model).score_all([text, None, "jardin", text])
    assert [x for x, _ in whole] == [x for x, _ in parts]
    assert [s for _, s in whole] == pytest.approx([s for _, s in parts])


def test_held_out_accuracy_and_rows(session, small_dir):
    docs = session.read.parquet(f"{small_dir}/documents.parquet")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id"))).withColumn("score", F.lit("x"))
    got = langid.identify(docs, docs.where("NOT held_out"), "doc_id", "held_out").collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_keep_known(session):
    rows = [(1, "the cat", "en", "a"), (2, None, None, "a"), (None, "??", "en", "a"), (3, "der hund", "xx", "b"), (3, "der hund", "xx", "b")]
    df = session.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    train = session.createDataFrame(TRAIN, "text string, lang string")
    got = langid.keep_known(df, train)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 3]
    assert langid.keep_known(df.limit(0), train).count() == 0
    assert langid.keep_known(df, train.limit(0)).count() == 0


def test_keep_known_rejects_what_was_not_learned(session):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(1)
    letters = [(-1 - i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)), "en")
               for i, n in enumerate([5, 20, 50, 200] * 25)]
    learned = docs.where("lang <> 'es'")
    got = langid.keep_known(docs.unionByName(session.createDataFrame(letters, docs.schema)), learned.select("text", "lang"))
    kept = Counter("letters" if r.doc_id < 0 else r.lang for r in got.collect())
    total = Counter(r.lang for r in docs.collect())
    assert kept["letters"] == 0
    assert kept["es"] <= 0.02 * total["es"]
    assert all(kept[lang] >= 0.99 * total[lang] for lang in total if lang != "es")


def test_limits_of_backing():
    near = [("a", [1.0, 0.4])] * 9 + [("a", [0.9, 0.4])] + [("b", [0.6, 1.0])] * 10
    assert langid.limits(["a", "b"], near) == pytest.approx([0.8, 0.7])
    close = [("a", [x, 0.9]) for x in (0.9, 0.95, 1.0)] + [("b", [0.94, 1.0])]
    assert langid.limits(["a", "b"], close)[0] == pytest.approx(0.95 - 4 * 1.4826 * 0.05)
    assert langid.limits(["a", "b"], [("a", [0.8, 0.0])]) == pytest.approx([0.4, 0.4])
    assert langid.limits(["a"], []) == [0.0]


def test_every_text_is_counted(session):
    """A language's every text takes part, however many there are; a frequent one doesn't outweigh a rare one."""
    n = langid.FIT_TEXTS + 500
    rows = [(f"common w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "en") for i in range(n)] + [("selten haus", "de")] * 3
    rows += [("selten", "en")] * 2
    model = langid.fit(session.createDataFrame(rows, "text string, lang string"))
    assert len(model.words) == n + 3
    share = langid.FIT_TEXTS / (n + 2)
    en, de = model.langs.index("en"), model.langs.index("de")
    assert model.word_logs[model.words["common"], en] - model.word_logs[model.words["haus"], en] == pytest.approx(
        math.log(n * share + 0.5) - math.log(0.5))
    assert model.word_seen[model.words["selten"]].tolist() == [True, True] and model.word_seen[model.words["haus"], en] == 0
    assert model.word_logs[model.words["selten"], de] > model.word_logs[model.words["selten"], en]


def test_limits_count_every_text(session):
    rng = random.Random(3)
    found = [("a", [round(rng.uniform(0.6, 1), 4), round(rng.uniform(0.1, 0.5), 4)]) for _ in range(3000)]
    found += [("b", [round(rng.uniform(0.2, 0.7), 4), round(rng.uniform(0.8, 1), 4)]) for _ in range(30)] + [("c", [0.1, 0.2])]
    df = session.createDataFrame(found, "lang string, backing array<double>")
    assert langid.limits_of(df, ["a", "b"]) == pytest.approx(langid.limits(["a", "b"], found))
    assert langid.limits_of(df.limit(0), ["a", "b"]) == [0.0, 0.0]


class Asked(dict):
    """A dict that counts how often it is asked for a key."""
    times = 0

    def get(self, *args):
        self.times += 1
        return super().get(*args)


def test_n_grams_of_many_words_are_found_at_once():
    """What the n-grams of unseen words give, without a look-up in Python for each of them."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgß𐐨中", k=rng.randint(1, 9))) for _ in range(3000)]
    every = sorted({g for w in words[:300] for n in range(1, 5) for g in langid.grams(w, n)})
    known = Asked((g, i) for i, g in enumerate(rng.sample(every, len(every) // 3)))
    logs, seen = np.random.default_rng(5).normal(size=(len(known), 2)), np.random.default_rng(6).random((len(known), 2)) < 0.5
    model = langid.Model(["a", "b"], {}, known, None, logs, None, seen)
    known.times = 0
    found, backed = model.of_grams(words)
    assert known.times <= len(words)
    for word, row, shares in zip(words, found, backed, strict=True):
        ids = {n: [known[g] for g in langid.grams(word, n) if g in known] for n in range(1, 5)}
        longest = next((ids[n] for n in range(4, 0, -1) if ids[n]), [])
        assert row.tolist() == pytest.approx((logs[longest].sum(axis=0) / max(1, len(longest))).tolist())
        assert shares.tolist() == pytest.approx((seen[ids[4] + ids[3]].sum(axis=0) / (2 * len(word) - 1)).tolist())


def test_n_grams_are_counted_by_word(session):
    """Counts of n-grams by language, of words that stand more than once, over several batches."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abß𐐨", k=rng.randint(1, 5))) for _ in range(400)]
    rows = [(" ".join(words[i:i + 40]), lang) for i in range(0, 400, 20) for lang in ("x", "y")[:1 + i // 20 % 2]]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = session.conf.get(name)
    session.conf.set(name, 7)
    try:
        model = langid.fit(session.createDataFrame(rows, "text string, lang string"))
    finally:
        session.conf.set(name, before)
    counts = {lang: Counter(g for t, x in rows if x == lang for w in langid.words_of(t) for n in range(1, 5) for g in langid.grams(w, n))
              for lang in ("x", "y")}
    assert set(model.gram_ids) == set(counts["x"]) | set(counts["y"])
    for j, own in enumerate(counts.values()):
        size = own.total() + 0.5 * (len(model.gram_ids) + 1)
        expected = [math.log(own[g] + 0.5) - math.log(size) for g in model.gram_ids]
        assert model.gram_logs[:, j].tolist() == pytest.approx(expected)
