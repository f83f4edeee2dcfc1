"""Byte-level BPE: the perfect hash, the joins against brute force, whole texts against tiktoken."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from linkmart.llm import bpe
from linkmart.llm.bpe import Encoder, PerfectHash, Ranks, decode_ids, encode_texts, join_bytes, load_ranks
from linkmart.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_hash_is_minimal_and_perfect(ranks):
    table = PerfectHash(ranks)
    assert table.n == len(ranks) and sorted(table.keys) == sorted(ranks)
    assert all(table.find(k) == v for k, v in ranks.items())
    rnd = random.Random(3)
    others = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(12))) for _ in range(5000)]
    assert all(table.find(k) == ranks.get(k, -1) for k in others)
    assert PerfectHash({}).find(b"a") == -1
    assert PerfectHash({b"a": 7}).find(b"a") == 7


def _brute(piece, ranks):
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_joins_equal_brute_force():
    rnd = random.Random(4)
    for _ in range(30):
        # a small vocabulary over few bytes gives many ties and overlapping pairs
        vocabulary = {bytes([b]): b for b in range(256)}
        words = list({bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(2, 5))) for _ in range(20)})
        rnd.shuffle(words)
        vocabulary |= {w: 256 + i for i, w in enumerate(words)}
        ranks = Ranks(PerfectHash(vocabulary))
        for _ in range(50):
            piece = bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 14)))
            assert join_bytes(piece, ranks) == _brute(piece, vocabulary)


def test_texts_equal_the_reference(ranks, reference):
    encoder = Encoder(PerfectHash(ranks), public_tokenizers.PATTERN)
    rnd = random.Random(5)
    letters = "abcdeé \n\t'sxyz123!?.ß漢字🙂ABC \u0085 \x1ć½٣"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(80)))
        assert list(encoder.encode(text)) == reference.encode_ordinary(text), text


def test_bounded_memory_changes_nothing(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 8)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    monkeypatch.setattr(bpe, "CHUNK_PIECES", 3)
    encoder = Encoder(PerfectHash(ranks), public_tokenizers.PATTERN)
    text = "Nochmals  unglaublich seltsame\n\n Wörter, it's 12345 " * 40
    assert list(encoder.encode(text)) == reference.encode_ordinary(text)


CASES = [
    (1, "plain words, and more"), (2, None), (3, ""), (3, "a repeated id"), (None, "no id"), (5, " \n\t "),
    (6, "<|endoftext|> is text"), (7, "x" * 300_000), (8, "lang " * 400_000), (9, "🙂é漢\u0000"),
]


def test_defined_cases_round_trip(spark, reference):
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in CASES], "doc_id long, text string, ids string, decoded int")
    encoded = encode_texts(spark, docs.repartition(3), PATH, public_tokenizers.PATTERN)
    rows = decode_ids(spark, encoded, PATH).collect()
    got = sorted(((r["id"], tuple(r["ids"]), bytes(r["decoded"])) for r in rows), key=repr)
    want = sorted(((i, tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in CASES), key=repr)
    assert got == want
    assert encode_texts(spark, docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_ids_of_any_type_and_wrong_ids(spark):
    docs = spark.createDataFrame([("a", "text")], "name string, body string")
    encoded = encode_texts(spark, docs, PATH, public_tokenizers.PATTERN, "name", "body")
    assert encoded.first()["id"] == "a"
    empty = decode_ids(spark, spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH)
    assert [bytes(r["decoded"]) for r in empty.collect()] == [b"", b""]
    for wrong in (-1, 50256):
        with pytest.raises(Exception, match="outside the vocabulary"):
            decode_ids(spark, spark.createDataFrame([([wrong],)], "ids array<int>"), PATH).collect()


def test_the_registered_query(spark, reference):
    got = {r["doc_id"]: r for r in QUERIES["op11_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = reference.encode_ordinary(d["text"])
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()
