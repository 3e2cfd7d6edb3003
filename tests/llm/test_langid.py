import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from morphloom.llm import langid
from morphloom.llm.training import sample

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"aa": ["the", "ing", "er"], "bb": ["que", "eau", "ré"], "cc": ["sch", "ung", "zu"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(n=240):
    rng = random.Random(0)
    return [(i, prose(rng, lang, rng.randint(3, 60)), lang) for i in range(n) for lang in [rng.choice("abc") * 2]]


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 3])
    emission, move = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    got, expected = langid.posteriors(emission, lengths, move)
    want, pairs, at = np.zeros((8, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        total, mine, mine_pairs = 0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.exp(
                sum(emission[at + i, s] for i, s in enumerate(path))
                + sum(move[a, b] for a, b in zip(path, path[1:]))
            )
            total += p
            for i, s in enumerate(path):
                mine[i, s] += p
            for a, b in zip(path, path[1:]):
                mine_pairs[a, b] += p
        want[at : at + n] = mine / total
        pairs += mine_pairs / total
        at += n
    assert np.allclose(got, want) and np.allclose(expected, pairs)


def test_held_out_accuracy_and_edges(spark):
    rows = documents() + [(900, None, "aa"), (901, "12 | 34", "aa"), (902, "", None), (None, "theing", "aa"), (3, "theing", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    got = langid.predict(df, langid.train(df)).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in documents()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert [r.held_out for r in got if r.doc_id is None] == [True]


def test_code_switched_words():
    rng = random.Random(1)
    model = langid.fit([(lang, text) for _, text, lang in documents()])
    parts = [(lang, prose(rng, lang, 12)) for lang in ("aa", "bb", "cc", "aa")]
    found, spoken = langid.Tagger(model, limit=5).words([" ".join(t for _, t in parts).split()])
    want = np.repeat([model.languages.index(lang) for lang, _ in parts], 12)
    assert spoken.all() and (found.argmax(axis=1) == want).mean() > 0.9
    assert (np.diag(model.transition) > model.transition.mean(axis=1)).all()


@pytest.mark.parametrize("rows", [[], [(1, "text", None)]])
def test_nothing_to_learn(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = langid.predict(df, langid.train(df)).collect()
    assert [(r.doc_id, r.lang_pred, r.score) for r in got] == [(1, "und", 0.0)][: len(rows)]


def test_identified_keeps_rows_whole(spark):
    rows = documents() + [(900, "12 34", "aa"), (901, None, "bb")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("more", F.lit(1))
    got = langid.identified(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == {i for i, _, _ in documents()}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 1024, 1025])
def test_segments_of_a_long_chain(n):
    rng = np.random.default_rng(n)
    emission, move = 3 * rng.normal(size=(n, 4)), 2 * rng.normal(size=(4, 4))
    want, _ = langid.posteriors(emission, np.array([n]), move)
    assert np.allclose(langid.long_posteriors(emission, move), want)


def test_long_and_short_texts_together(monkeypatch):
    rng = random.Random(1)
    model = langid.fit([(lang, text) for _, text, lang in documents(60)])
    texts = [prose(rng, rng.choice(["aa", "bb", "cc"]), n) for n in (3, 50, 0, 200, 7)]
    want = langid.Tagger(model).texts(texts)
    monkeypatch.setattr(langid, "LONG", 40)
    got = langid.Tagger(model).texts(texts)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want])


def test_text_of_five_million_characters():
    model = langid.fit([(lang, text) for _, text, lang in documents(60)])
    text = "eauqueré " * 600_000
    start = time.time()
    assert langid.Tagger(model).texts([text])[0][0] == "bb"
    assert time.time() - start < 10


def test_only_letters_speak_for_a_language(spark):
    rows = documents(60) + [(900, "½ ² ³ Ⅷ ٣ _ ①", None), (901, "the½ing", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in langid.predict(df, langid.train(df)).collect()}
    assert (got[900].lang_pred, got[900].score) == ("und", 0.0)
    assert got[901].lang_pred == "aa"
    assert langid.letters("½²Ⅷ") == b"" and langid.letters("Éa1_b") == "éab".encode()


def test_sample_keeps_the_label_of_each_row(spark):
    """Copies of an id with different labels, and an id that very many rows share."""
    rows = [(1, "english", "en"), (1, "french", "fr"), (2, "z", "en"), (2, "a", "en"), (3, None, "fr"), (4, "x", None)]
    rows += [(7, f"copy {i:03}", "de") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    counts, found = sample(docs.withColumnRenamed("lang", "label"), None, 5)
    assert counts == {"en": 3, "fr": 2, "de": 300}
    assert sorted(found, key=str) == sorted([("en", "english"), ("fr", "french"), ("en", "a"), ("fr", None), ("de", "copy 000")][:3] + [("de", "copy 000")], key=str)
    labels = spark.createDataFrame([(1, "good"), (1, "good"), (2, "bad"), (7, "bad")], "doc_id long, label string")
    counts, found = sample(docs, labels, 5)
    assert counts == {"good": 2, "bad": 2}
    assert sorted(found) == [("bad", "a"), ("bad", "copy 000"), ("good", "english")]
    assert sample(docs, labels, 5, max_labels=1, max_bytes=1)[1] == [("bad", "a")]
