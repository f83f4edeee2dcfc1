"""The pipeline against the brute-force versions of its operators."""

import hashlib
import random

import pytest
from test_decontam import brute_align
from test_packing import check_pieces
from test_pii import ANY, brute_one
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline as C
from linkmart.llm import pii
from linkmart.llm.decontam import words_of

PARTS = {"en": ["an", "the", "ion", "ing", "er"], "fr": ["ço", "que", "eau", "é", "ment"]}


def rows():
    rng = random.Random(8)
    say = lambda lang, n: ["".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    items = [(i, " ".join(say("en", 25))) for i in range(6)]
    docs = []
    for i in range(160):
        lang = "fr" if i % 3 == 0 else "en"
        words = say(lang, rng.randrange(60, 400))
        if i % 8 == 1:
            words[5:5] = items[rng.randrange(6)][1].split()
        if i % 8 == 2:
            words[9:9] = [f"bob{i}@mail.example", "4041894974608795", "10.1.2.3"]
        docs.append((i, " ".join(words), lang))
        if i % 10 == 5:
            docs.append((1000 + i, " ".join(words), lang))
            docs.append((2000 + i, " ".join(words).upper(), None))
    docs += [(3000, None, "en"), (3001, "", "en"), (3002, "12 34", "fr"), (7, *docs[7][1:]), (None, "anion theer " * 30, "en")]
    return docs, items


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, items = rows()
    root = str(tmp_path_factory.mktemp("sf"))
    df = spark.createDataFrame([(d, t, lang, "src", len(t or ""), 1) for d, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long, extra int")
    df.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    out, at = [], spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in C.STAGES:
        path = f"{root}/{name}"
        stage(spark, at, root).write.parquet(path)
        at = spark.read.parquet(path)
        out.append(at)
    return docs, items, out, root


def test_every_stage_decides_as_brute_force(steps):
    docs, items, (language, unique, clean, private, packed), _ = steps
    columns = ["doc_id", "text", "lang", "source", "n_chars", "extra"]
    assert all(s.columns == columns for s in (language, unique, clean, private))
    key = lambda x: (x[0] is None, x)
    state = lambda s: sorted(((r.doc_id, r.text) for r in s.collect()), key=key)
    lettered = sorted(((d, t) for d, t, _ in docs if any(c.isalpha() for c in t or "")), key=key)
    assert state(language) == lettered

    # one row of each group: the smallest id, then the smallest digest of the text
    groups = {}
    for i, _, component in brute_components([(i, brute_fingerprint(t)) for i, (_, t) in enumerate(lettered)], 2):
        groups.setdefault(component, []).append(lettered[i])
    first = lambda x: (x[0] is None, x[0] or 0, hashlib.md5(x[1].encode()).hexdigest())
    want = sorted((min(members, key=first) for members in groups.values()), key=key)
    assert state(unique) == want

    tests = [words_of(x) for _, x in items]
    kept = [(d, t) for d, t in want if all(brute_align(x, words_of(t)) < 0.5 * 2 * len(x) for x in tests)]
    assert len(kept) < len(want) and state(clean) == kept
    want = kept

    import re

    import test_pii

    test_pii.KEY, old = C.PSEUDONYM_KEY, test_pii.KEY
    want = [(d, re.sub(ANY, lambda m: brute_one(m[0]), t, flags=re.A)) for d, t in want]
    test_pii.KEY = old
    assert state(private) == want
    assert all(r.n_chars == len(r.text) for r in private.collect())
    assert not any("4041894974608795" in t for _, t in want) and pii.ANY == ANY
    assert {r.doc_id for r in packed.collect()} == {d for d, _ in want}


def test_the_pieces_hold_the_documents(spark, steps):
    _, _, (*_, private, _), _ = steps
    from linkmart.llm.packing import pack_documents

    check_pieces(pack_documents(private, C.tokenizer_path()).collect(), [(r.doc_id, r.text) for r in private.collect()])


def test_run_applies_the_stages(spark, steps):
    *_, (*_, packed), root = steps
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows_ = lambda df: sorted(map(str, df.select(cols).collect()))
    assert len(rows_(C.run(spark, root))) == packed.count()


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_stages_decide_by_row(spark, tmp_path):
    """Ids used again by other texts, several groups without ids, a leaking row without an id."""
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 6) + str(rng.randrange(999)) for _ in range(80))
    one, two, three, four, five, item = (text() for _ in range(6))
    leak = f"{text()} {item}"
    rows = [(9, one), (9, two), (None, three), (None, three), (None, four), (None, four), (5, four), (None, five), (12, one), (None, leak), (7, leak), (8, leak + " x")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), i) for i, (d, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, id int")
    kept = C.near_duplicates(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    state = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    unique = state(kept)
    assert [x for x in unique if leak not in x[1]] == sorted([(9, one), (9, two), (None, three), (5, four), (None, five)], key=str)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = C.decontaminate(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert state(clean) == sorted([(d, t) for d, t in rows if item not in t], key=str)


def test_near_duplicates_broadcast_nothing_that_grows(spark, monkeypatch):
    # before: the 64 entries of each fingerprint went through the driver where Spark took them for small
    from linkmart.llm import components, simhash
    from linkmart.llm.common import stored

    plans = {}

    def seen(spark, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(spark, df, name)

    for module in (C, components, simhash):
        monkeypatch.setattr(module, "stored", seen)
    docs, _ = rows()
    df = spark.createDataFrame([(d, t, lang) for d, t, lang in docs], "doc_id long, text string, lang string")
    assert C.near_duplicates(spark, df, "").count() < len(docs)
    assert {"simhash-members", "cc-hook", "simhash-named", "pipeline-groups"} <= plans.keys()
    assert [name for name, plan in plans.items() if "Broadcast" in plan] == []
