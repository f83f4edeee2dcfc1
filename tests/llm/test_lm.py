import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkmart.llm import lm as L


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    vocab = {0: [f"a{i}" for i in range(150)], 1: [f"Ü{i}" for i in range(150)]}
    docs = [(i, " ".join(rng.choice(vocab[i % 2][: rng.randrange(2, 151)]) for _ in range(rng.randrange(1, 200)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "\t \n"), (n + 3, "A1 unseen-word a1"), (n + 4, "a1 " * 30_000), (3, docs[3][1])]


def test_probabilities_are_normalised():
    m = L.LogBilinear(7, 4, 2)
    p = np.exp(m.log_probabilities(np.array([[7, 7], [0, 3]])))
    assert np.allclose(p.sum(1), 1)


def test_histories():
    h = L.histories(np.array([5, 6, 7, 8]), np.array([0, 3]), 2, 99)
    assert h.tolist() == [[99, 99], [5, 99], [6, 5], [99, 99]]


def test_noise_contrastive_training_learns_a_chain():
    rng = np.random.default_rng(0)
    ids = np.zeros(20_000, int)
    for t in range(1, len(ids)):
        ids[t] = (ids[t - 1] + (1 if rng.random() < 0.9 else rng.integers(5))) % 5
    m = L.LogBilinear(5, 8, 2)
    noise = np.bincount(ids, minlength=5) / len(ids)
    t = L.Trainer(m, noise)
    for _ in range(5):
        t.train(ids, np.array([0]), 256)
    lp = m.log_probabilities(L.histories(ids, np.array([0]), 2, 5))[np.arange(len(ids)), ids]
    assert lp.mean() > -0.9  # chance is log(1 / 5) = -1.61


@pytest.mark.parametrize("head", [100_000, 60])
def test_against_brute_force(spark, head):
    docs = corpus()
    held = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(7)) == 2
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    rows = L.score_documents(spark, df, held, head=head, words=40, classes=16).collect()
    toks = lambda t: [w for w in "".join(c.lower() if c.isascii() else c for c in t or "").split()] + [None]
    out = lambda i: crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in docs if not out(i) for w in toks(t))
    n, v = sum(count.values()), len(count)
    assert len(rows) == len(docs)
    want = Counter()
    for i, t in docs:
        ws = toks(t)
        base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in ws)
        want[(i, out(i), len(ws), sum(count[w] > 0 for w in ws), n, round(base, 6))] += 1
    got = Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == want
    assert all(r.score < 0 for r in rows)
    test = [r for r in rows if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_all_held_out_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (None, "a")], "doc_id long, text string")
    rows = L.score_documents(spark, df, F.lit(True)).collect()
    assert {(r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows} == {(1, 3, 0, 0, 0.0), (None, 2, 0, 0, 0.0)}
    assert all(np.isfinite(r.score) for r in rows)
    assert L.score_documents(spark, df.limit(0), F.lit(False)).collect() == []
