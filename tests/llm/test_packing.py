import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkmart.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def plain_ids(text):
    return [*plain().encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab C,.'\n\t  é​1<|>\x1c", max_size=30), max_size=6))
def test_units_encode_as_whole_texts(texts):
    enc = P.encoder(PATH)
    texts = [*texts, "it's  a <|endoftext|> x", " lead", "trail ", "a\n b", "a \nb", "é  x"]
    for text, got in zip(texts, enc(texts)):
        assert np.frombuffer(got, "<u4").tolist() == plain_ids(text)[:-1]


def test_small_cache_gives_the_same_ids():
    texts = [f"one two three w{i} w{i * 7} one" for i in range(200)]
    a, b = P.Encoder(PATH, 5), P.Encoder(PATH)
    assert a(texts) == b(texts) == a(texts)


def check_pieces(rows, docs, window=1024):
    tokens = {}
    for d, t in docs:
        tokens.setdefault(d, []).append(plain_ids(t))
    pieces, seqs = {}, {}
    for r in rows:
        assert 0 < r.length <= window and len(r.ids) == 4 * r.length
        pieces.setdefault(r.id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, want in tokens.items():
        if len(want) == 1:
            got = [x for s, ids, n in sorted(pieces[d]) for x in ids]
            assert got == want[0] and {n for _, _, n in pieces[d]} == {len(got)}
            at = 0
            for s, ids, _ in sorted(pieces[d]):
                assert s == at
                at += len(ids)
        else:
            assert sorted(x for _, ids, _ in pieces[d] for x in ids) == sorted(x for t in want for x in t)
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window
    return sum(window - sum(n for _, n in p) for p in seqs.values()), len(seqs)


def test_pack_documents(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["the", "onwhth", "éle", "x,\ny", "12"]) for _ in range(int(rng.expovariate(1 / 300))))) for i in range(1500)]
    docs += [(5000, None), (5001, ""), (5002, "word " * 30000), (5003, "twice"), (5003, "twice")]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, length int").repartition(2)
    rows = P.pack_documents(df, PATH).collect()
    pad, n = check_pieces(rows, docs)
    assert pad <= 0.01 * 1024 * n + 2 * 1024
    small = P.pack_documents(df, PATH, block_tokens=20_000).collect()
    check_pieces(small, docs)
    assert P.pack_documents(df.limit(0), PATH).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 400), max_size=120), st.integers(8, 64))
def test_plan_block_uses_every_token_once(lengths, window):
    plan = P.plan_block(lengths, window, max_gap=2)
    seen = {}
    for seq in plan:
        assert 0 < sum(n for _, _, n in seq) <= window
        for d, s, n in seq:
            seen.setdefault(d, []).append((s, n))
    for d, n in enumerate(lengths):
        at = 0
        for s, k in sorted(seen[d]):
            assert s == at
            at += k
        assert at == n


def test_least_squares_packs_most_of_a_large_histogram():
    rng = np.random.default_rng(0)
    hist = np.bincount(rng.integers(1, 1024, 50_000), minlength=1025)
    combos, times = P.repeat_counts(hist)
    assert (combos.sum(1) == 1024).all()
    used = np.bincount(combos.ravel(), np.repeat(times, 3), 1025)[1:]
    assert (used <= hist[1:]).all()
    assert used.sum() > 0.8 * hist.sum()


@pytest.mark.parametrize("ids", [[1, 2, 70000]])
def test_digest_is_of_little_endian_ids(spark, ids):
    raw = np.array(ids, "<u4").tobytes()
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(bytearray(raw),)], "ids binary").select(F.crc32("ids")).first()[0]
    assert got == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
