import random

import numpy as np

from linkmart.llm import decontam as D


def brute_align(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = 2 if a[i - 1] == b[j - 1] else -1
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_align_matches_the_textbook_recurrence():
    rng = random.Random(1)
    items = [[rng.randrange(6) for _ in range(rng.randrange(1, 12))] for _ in range(200)]
    windows = [[rng.randrange(6) for _ in range(rng.randrange(1, 20))] for _ in range(200)]
    got = D.align([np.array(x) for x in items], [np.array(x) for x in windows])
    for a, b, (s, x, y) in zip(items, windows, got):
        assert s == brute_align(a, b)
        assert s == 0 or s == brute_align(a, b[x:y])


def test_words():
    assert D.words_of("Ab, c_d É’x 9!") == [b"ab", b"c", b"d", "é".encode(), b"x", b"9"]
    assert D.words_of(None) == D.words_of("_ -") == []


def corpus(seed=2):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    common = ["of", "the", "in", "a"]
    say = lambda n: [rng.choice(vocab if rng.random() < 0.6 else common) for _ in range(n)]
    items = [say(rng.randrange(12, 40)) for _ in range(12)]
    items += [list(items[0]), ["only", "three", "words"], []]
    docs = []
    for i in range(300):
        words = say(rng.randrange(1, 300))
        kind = i % 5
        if kind < 3:
            copy = list(items[rng.randrange(12)])
            if kind == 1:
                copy = [w if k % 7 else "edited" for k, w in enumerate(copy)]
            if kind == 2:
                copy = copy[: max(4, int(len(copy) * rng.random()))]
            at = rng.randrange(len(words) + 1)
            words = words[:at] + copy + words[at:]
        docs.append((i, " ".join(words).capitalize() + "."))
    hot = " ".join(items[3])
    docs += [(1000 + i, f"x{i} y{i} {hot} z{i}") for i in range(200)]
    docs += [(2000, None), (2001, ""), (2002, "long " * 50_000 + hot), (2003, "of the in a " * 3000), (7, docs[7][1])]
    return docs, [(i, " ".join(w).upper() if w else None) for i, w in enumerate(items)]


def test_matches_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id long, text string, item_id string").repartition(4)
    it = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = {(r.id, r.item_id): r.score for r in D.contaminated(spark, df, it).collect()}
    for d, t in docs:
        words = D.words_of(t)
        for i, x in items:
            item = D.words_of(x)
            if len(item) < 4 or len(words) > 5000:
                continue
            score = brute_align(item, words) / (2 * len(item))
            if score >= 0.5:
                assert abs(got.get((d, i), 0) - score) < 1e-9, (d, i, score)
            else:
                assert (d, i) not in got
    assert (2002, 3) in got and not any(d == 2003 for d, _ in got)


def test_items_that_share_all_seeds_keep_some(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta"
    items = spark.createDataFrame([(i, f"{text} v{i}") for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {text} v3 it goes"), (2, "nothing of the kind here at all")], "doc_id long, text string")
    got = {(r.id, r.item_id) for r in D.contaminated(spark, docs, items).collect()}
    assert {d for d, _ in got} == {1} and (1, 3) in got


def test_edited_copies_of_an_item_that_leaked_often(spark):
    changed = {8: [4], 16: [5, 9, 13], 20: [4, 8, 12, 16]}  # one seed is left
    items, edits = [], []
    for i, (n, places) in enumerate(changed.items()):
        item = [f"i{i}w{k}" for k in range(1, n + 1)]
        items.append((i, " ".join(item)))
        edits.append((i, "so " + " ".join("other" if k in places else w for k, w in enumerate(item, 1)) + " ends"))
    leaks = [(100 + 50 * i + k, f"x{k} {t} y{k}") for i, t in items for k in range(40)]
    docs = spark.createDataFrame(edits + leaks, "doc_id long, text string").repartition(3)
    got = {(r.id, r.item_id): round(r.score, 2) for r in D.contaminated(spark, docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {k: got.get((k, k)) for k in range(3)} == {0: 0.81, 1: 0.72, 2: 0.7}
    assert len(got) == 3 + 120


def test_an_edited_copy_keeps_only_seeds_that_many_items_share(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"  # 7 seeds in 30 items
    items = spark.createDataFrame([(i, f"{text} v{i} u{i}") for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(text.split()[k:k + 7])) for k in range(4)], "doc_id long, text string")
    got = {(r.id, r.item_id) for r in D.contaminated(spark, docs, items).collect()}
    assert got == {(k, i) for k in range(4) for i in range(30)}


def test_the_bound_on_common_words_loses_nothing():
    rng = random.Random(4)
    for _ in range(300):
        item = [str(rng.randrange(8)) for _ in range(rng.randrange(4, 12))]
        window = [str(rng.randrange(8)) for _ in range(rng.randrange(1, 20))]
        least = rng.random()
        if brute_align(item, window) >= least * 2 * len(item):
            assert D.may_reach(D.Counter(item), window, least)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(spark, docs, items.limit(0)).collect() == []
    assert D.contaminated(spark, docs.limit(0), items).collect() == []
    assert [(r.id, r.item_id, r.score) for r in D.contaminated(spark, docs, items).collect()] == [(1, 1, 1.0)]
