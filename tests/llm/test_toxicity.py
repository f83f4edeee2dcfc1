import random

import numpy as np
from pyspark.sql import functions as F

from linkmart.llm import toxicity as T


def corpus(n=700, seed=1):
    rng = random.Random(seed)
    parts = ["an", "the", "ion", "er", "ing", "st", "ou", "ly", "re", "ha"]
    bad = ["idiot", "worthless", "scum", "pathetic"]
    docs = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 150))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), int(toxic)))
    return docs


def test_toxic_words_are_nearer_the_toxic_dictionary():
    docs = corpus()
    model = T.fit([(t.encode(), y) for _, t, y in docs])
    d = T.Distance(*model.dictionaries)
    assert (d.of([b"worthless", b"pathetic", b"idiot", b"scum"]) >= model.threshold).all()
    assert (d.of([b"the", b"ionst", b"anouly", b"unheard"]) < model.threshold).all()


def test_held_out_accuracy_and_no_leak(spark):
    docs = corpus()
    held = F.pmod(F.col("id"), F.lit(5)) == 0
    df = spark.createDataFrame([(i, t, "clash") for i, t, _ in docs], "doc_id long, text string, toxic string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in docs] + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    got = {r.id: r for r in T.score_toxicity(spark, df, labels, held).collect()}
    assert len(got) == len(docs)
    test = [(got[i].predicted, y) for i, _, y in docs if i % 5 == 0]
    assert np.mean([p == y for p, y in test]) > 0.97
    assert all(r.held_out == (i % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    flipped = labels.withColumn("toxic", F.when(F.col("doc_id") % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.id: r.score for r in T.score_toxicity(spark, df, flipped, held).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_edge_rows(spark):
    docs = corpus(200)
    extra = [(1000, None), (1001, ""), (1002, "the " * 50_000), (1003, "the " * 50_000 + "worthless idiot scum"), (None, "scum"), (7, docs[7][1])]
    df = spark.createDataFrame([(i, t) for i, t, _ in docs] + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in docs], "doc_id long, toxic int")
    rows = T.score_toxicity(spark, df, labels, F.lit(False)).collect()
    assert len(rows) == len(docs) + len(extra)
    score = {r.id: r.score for r in rows}
    assert score[1000] == score[1001] < 0.5 and score[1002] < 0.5 < score[1003]


def test_one_sided_and_empty_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    run = lambda d, x: sorted((r.id, r.score) for r in T.score_toxicity(spark, d, x, F.lit(False)).collect())
    assert run(df, labels.limit(0)) == [(1, 0.0), (2, 0.0)]
    assert run(df, labels) == [(1, 1.0), (2, 1.0)]
    assert run(df.limit(0), labels) == []
