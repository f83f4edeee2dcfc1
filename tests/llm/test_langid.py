import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkmart.llm import langid as L

PARTS = {"aa": ["an", "the", "ion", "ing", "er"], "bb": ["ço", "que", "eau", "é", "ment"], "cc": ["sch", "ü", "keit", "ver", "er"]}


def say(rng, lang, n):
    return ["".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(say(rng, lang, rng.randrange(3, 80))), lang) for i, lang in zip(range(n), itertools.cycle(PARTS))]


@pytest.fixture(scope="module")
def field():
    return L.train([(t, lang) for _, t, lang in corpus()], steps=30)


@pytest.mark.parametrize("column", [1, 3, 256])
def test_marginals_match_enumeration(column):
    rng = np.random.default_rng(1)
    f = L.Field(["a", "b", "c"], {})
    f.moves, f.start = rng.normal(size=(3, 3)), rng.normal(size=3)
    scores = rng.normal(size=(7, 3)) * 3
    first = np.array([1, 0, 0, 0, 1, 0, 1], bool)
    want = np.zeros((7, 3))
    for a, b in ((0, 4), (4, 6), (6, 7)):
        total = 0
        for path in itertools.product(range(3), repeat=b - a):
            s = f.start[path[0]] + sum(scores[a + i, y] for i, y in enumerate(path)) + sum(f.moves[x, y] for x, y in zip(path, path[1:]))
            total += np.exp(s)
            for i, y in enumerate(path):
                want[a + i, y] += np.exp(s)
        want[a:b] /= total
    assert np.allclose(L.marginals(f, scores, first, column), want)


def test_code_switches_are_followed(field):
    rng = random.Random(9)
    words = say(rng, "aa", 15) + say(rng, "bb", 15) + say(rng, "cc", 15)
    p = L.marginals(field, field.emissions(words), np.arange(45) == 0)
    assert (p.argmax(1) == np.repeat([0, 1, 2], 15)).mean() > 0.95


def test_a_small_cache_changes_nothing(field, monkeypatch):
    docs = [t.split() for _, t, _ in corpus(60, 3)] + [[], ["x" * 5000]]
    whole = L.Labeller(field).label(docs)
    monkeypatch.setattr(L, "CACHE_WORDS", 50)
    lab = L.Labeller(field)
    one = [lab.label([d])[0] for d in docs]
    assert [a for a, _ in whole] == [a for a, _ in one]
    assert np.allclose([b for _, b in whole], [b for _, b in one])


def test_held_out_accuracy_and_edges(spark):
    docs = corpus()
    extra = [(900, None, "aa"), (901, "", "bb"), (902, "12 3.4 _", "aa"), (903, " ".join(["the"] * 40_000), None),
             (None, docs[1][1], "bb"), (5, docs[5][1], docs[5][2]), (904, "ñ", None), (905, "x" * 30_000, None)]
    df = spark.createDataFrame([(*r, 1) for r in docs + extra], "doc_id long, text string, lang string, lang_pred int").repartition(3)
    rows = L.label_documents(spark, df, F.pmod(F.col("id"), F.lit(4)) == 2).collect()
    assert len(rows) == len(docs) + len(extra)
    got = {r.id: r for r in rows}
    test = [got[i].lang_pred == lang for i, _, lang in docs if i % 4 == 2]
    assert np.mean(test) > 0.97
    assert {got[i].lang_pred for i in (900, 901, 902)} == {"und"} and got[900].score == 0
    assert got[903].lang_pred == "aa" and got[None].lang_pred == "bb" and got[904].lang_pred != "und"
    assert all(0 <= r.score <= 1 and r.held_out == (r.id is not None and r.id % 4 == 2) for r in rows)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in L.label_documents(spark, df, F.lit(False)).collect()] == ["und"]
    assert L.label_documents(spark, df.limit(0), F.lit(False)).collect() == []


def test_more_languages_than_any_cap(spark):
    rng = random.Random(5)
    names = [f"x{i:02}" for i in range(70)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {n: ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(40)] for n in names}
    rows = [(i, " ".join(rng.choice(words[n]) for _ in range(12)), n) for i, n in enumerate(n for n in names for _ in range(8))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.id: r.lang_pred for r in L.label_documents(spark, df, F.col("id") % 8 == 0).collect()}
    held = [got[i] == n for i, _, n in rows if i % 8 == 0]
    assert len(held) == 70 and sum(held) >= 68
    assert {got[i] for i, _, _ in rows} == set(names)


def test_marginals_by_document_are_those_by_column(monkeypatch):
    rng = np.random.default_rng(6)
    field = L.Field(["a", "b", "c", "d"], {}, bits=4)
    field.moves, field.start = rng.normal(size=(4, 4)), rng.normal(size=4)
    scores, first = rng.normal(size=(700, 4)), rng.random(700) < 0.05
    for begins in (True, False):
        first[0] = begins
        by_column = L.marginals(field, scores, first, column=16)
        monkeypatch.setattr(L, "PRODUCT_LANGUAGES", 2)
        assert np.allclose(L.marginals(field, scores, first), by_column)
        monkeypatch.undo()
