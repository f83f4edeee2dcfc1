"""Spelling variants: words one edit apart, grouped under their commonest near form.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.

Reduced-alphabet generation. Every letter is hashed to one of ``SYMBOLS`` symbols. Words one
edit apart have reduced words at most one edit apart, so the reduced vocabulary is joined with
the full one-edit neighbourhoods of its own words: over a few symbols a neighbourhood is small
where over all letters it is ten times as large. The words behind two joined reduced words
are then compared as they are.

A neighbour is written as a 64-bit polynomial hash: prefix sums give the hash of a word with
one symbol deleted, replaced or inserted without building it, so a word of any length costs
one number per neighbour, and neighbourhoods leave in slices. A collision only adds a pair
that the comparison drops.

Reduced words that stand for more than ``HOT`` words take another way, which is as exact: the
words that reach such a bucket have their neighbourhoods over the whole alphabet joined with
its members, which pairs near words only. So candidates per word are bounded by the length
of its neighbourhood times ``HOT``, and no bucket is paired with itself.

Defined cases: NULL texts have no words; words are compared by code points; a word without
a near word, or whose commonest near word is too rare, is its own root; equal counts go to
the smallest word in code-point order; empty tables give no rows. Only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

import string
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmart.llm.common import stored

# Letters of a word, and how much commoner a form must be.
LETTERS = "A-Za-zÀ-ÿ"
FORM_RATIO = 5

#: Symbols of the reduced alphabet, and members above which a reduced word is hot.
SYMBOLS = 8
HOT = 64
#: Neighbours that leave a task together.
_SLICE = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ALPHABET = [*map(ord, string.ascii_lowercase), *range(0xC0, 0x100)]


def reduced_symbols(symbols: int) -> np.ndarray:
    """Symbol (from 1) of each letter of the alphabet, by a hash of its code point."""
    spread = (np.array(_ALPHABET, np.uint64) * np.uint64(2_654_435_761)) & np.uint64(0xFFFFFFFF)
    return ((spread * np.uint64(symbols)) >> np.uint64(32)) + np.uint64(1)


def own_symbols() -> np.ndarray:
    """A symbol of its own for each letter."""
    return np.arange(1, len(_ALPHABET) + 1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(_BASE)
    return np.cumprod(out, dtype=np.uint64)


def _matrices(words: list[str], symbol: np.ndarray):
    """Words of one length as rows of symbols: (indices, matrix), of at most a slice each."""
    table = np.zeros(0x100, np.uint64)
    table[_ALPHABET] = symbol
    lengths = defaultdict(list)
    for i, word in enumerate(words):
        lengths[len(word)].append(i)
    for n, found in lengths.items():
        step = max(1, _SLICE // (16 * max(1, n)))
        for a in range(0, len(found), step):
            some = found[a:a + step]
            points = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le"), np.uint32)
            yield some, table[points].reshape(len(some), n)


def hashes(words: list[str], symbol: np.ndarray) -> np.ndarray:
    """Hash of each word's symbols: the sum of symbol times base to the power of its place."""
    out = np.zeros(len(words), np.uint64)
    for some, m in _matrices(words, symbol):
        out[some] = (m * _powers(m.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def neighbourhoods(words: list[str], symbol: np.ndarray, count: int):
    """Slices (index of the word, hash) of all strings over the symbols 1 to ``count`` at most one
    edit from each word, each once: the word, then with a symbol deleted, replaced, inserted."""
    base, inverse = np.uint64(_BASE), np.uint64(_INVERSE)
    for some, m in _matrices(words, symbol):
        rows, n = m.shape
        index = np.array(some, np.int64)[:, None]
        power = _powers(n + 1)
        before = np.zeros((rows, n + 1), np.uint64)  # sum of the first i symbols
        np.cumsum(m * power[:n], axis=1, dtype=np.uint64, out=before[:, 1:])
        whole = before[:, n:]
        yield index[:, 0], whole[:, 0]
        width = max(1, _SLICE // (rows * count))
        for a in range(0, n + 1, width):
            z = min(a + width, n + 1)
            at, first = power[a:z], before[:, a:z]
            own = np.zeros((rows, z - a), np.uint64)  # no symbol stands behind the end
            own[:, :min(z, n) - a] = m[:, a:z]
            follower = np.zeros_like(own)
            follower[:, :max(0, min(z + 1, n) - a - 1)] = m[:, a + 1:z + 1]
            kept = (own != 0) & (own != follower)  # a run of one symbol loses its last
            gone = first + (whole - before[:, np.minimum(np.arange(a, z) + 1, n)]) * inverse
            yield np.broadcast_to(index, kept.shape)[kept], gone[kept]
            for c in range(1, count + 1):
                c = np.uint64(c)
                other = own != c
                swapped = other & (own != 0)
                yield np.broadcast_to(index, kept.shape)[swapped], (whole + (c - own) * at)[swapped]
                # inserting a symbol before its like is inserting it behind
                yield np.broadcast_to(index, kept.shape)[other], (first + c * at + (whole - first) * base)[other]


def _with_hash(words: DataFrame, symbol: np.ndarray, out: str) -> DataFrame:
    """``words`` and ``out``, the hash of its column ``word``."""
    names = [*words.columns, out]
    place = words.columns.index("word")

    def run(batches):
        for batch in batches:
            h = hashes(batch.column(place).to_pylist(), symbol)
            yield pa.record_batch([*batch.columns, pa.array(h.view(np.int64))], names=names)

    return words.mapInArrow(run, T.StructType([*words.schema.fields, T.StructField(out, T.LongType())]))


def _neighbours(words: DataFrame, count: int, own: str, out: str) -> DataFrame:
    """``own``, the hash of each ``word`` over the first ``count`` letters, each its own symbol, with
    ``out``, the hashes of its neighbourhood."""
    symbol = own_symbols()

    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            mine = hashes(words, symbol).view(np.int64)
            held: list = []
            for index, h in neighbourhoods(words, symbol, count):
                held.append((mine[index], h.view(np.int64)))
                if sum(len(x) for x, _ in held) >= _SLICE:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*held)], names=[own, out])
                    held = []
            if held:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*held)], names=[own, out])

    return words.select("word").mapInArrow(run, f"`{own}` long, `{out}` long")


def _reduced(symbol: np.ndarray) -> Column:
    """The reduced word as text: the alphabet's letter of each symbol's number."""
    return F.translate("word", "".join(map(chr, _ALPHABET)), "".join(chr(_ALPHABET[int(s) - 1]) for s in symbol))


def near_words(spark: SparkSession, words: DataFrame, symbols: int = SYMBOLS, hot: int = HOT) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of near words of ``words(word, n)``, whose
    words are distinct and made of lower-case letters."""
    few, all_letters = reduced_symbols(symbols), own_symbols()
    keyed = stored(spark, _with_hash(words.select("word", "n"), few, "r"), "variants-words")
    vocabulary = keyed.groupBy(_reduced(few).alias("word")).agg(F.first("r").alias("r"))
    sizes = keyed.groupBy("r").agg(F.count("*").alias("members"))
    edges = _neighbours(vocabulary, symbols, "r", "to").join(sizes.withColumnRenamed("r", "to"), "to")
    edges = stored(spark, edges.select("r", "to", (F.col("members") > hot).alias("is_hot")), "variants-edges")

    ends = keyed.select(F.col("r").alias("to"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    cold = edges.where("NOT is_hot").join(ends, "to").join(keyed, "r").select("word", "n", "near", "near_n")

    to_hot = edges.where("is_hot")
    reaching = keyed.join(to_hot.select("r").distinct(), "r", "left_semi").select("word", "n")
    members = keyed.join(to_hot.select(F.col("to").alias("r")).distinct(), "r", "left_semi")
    members = _with_hash(members.select("word", "n"), all_letters, "full").select(
        F.col("full").alias("to"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    warm = (
        _neighbours(reaching, len(_ALPHABET), "full", "to").join(members, "to")
        .join(_with_hash(reaching, all_letters, "full"), "full").select("word", "n", "near", "near_n")
    )
    return cold.unionByName(warm).where(F.levenshtein("word", "near", 1) == 1)


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: forms followed to the last, by doubling steps.
    A form is commoner than its word by a factor, so there are no cycles and few rounds."""
    chain = stored(spark, forms.select("word", F.col("form").alias("root")), "variants-chain")
    while True:
        hop = chain.select(F.col("word").alias("root"), F.col("root").alias("top"))
        nxt = stored(spark, chain.join(hop, "root", "left").select(
            "word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "variants-chain")
        chain = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return chain


def group_variants(
    spark: SparkSession, words: DataFrame, ratio: int = FORM_RATIO, symbols: int = SYMBOLS, hot: int = HOT,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every row of ``words(word, n)``."""
    words = stored(spark, words.select("word", F.col("n").cast("long").alias("n")), "variants-counts")
    near = near_words(spark, words, symbols, hot).repartition("word").groupBy("word", "n", "near", "near_n").agg(F.count("*").alias("seen"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    commoner = -F.col("best.less") >= ratio * F.col("n")
    found = stored(spark, found.select(
        "word", "n_near", F.when(commoner, F.col("best.near")).alias("form"), F.when(commoner, -F.col("best.less")).alias("form_n")), "variants-forms")
    last = roots(spark, found.where("form IS NOT NULL"))
    return words.join(found, "word", "left").join(last, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


# -- words of texts ----------------------------------------------------------------------


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` (as text, '' if NULL) and ``run``: every maximal run of letters of the whole texts,
    with only A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]+"), F.lit(0))
    # outer, then filtered: an inner explode makes the optimizer run the pattern twice
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode_outer(runs).alias("run")).where("run IS NOT NULL")
    return found.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))


def drop_some_letters(runs: DataFrame, every: int) -> DataFrame:
    """``word``: the run, without one letter where ``every`` divides crc32 of ``<id>:<run>``, which
    also places the letter. Gives a corpus known misspellings."""
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.select(F.when(h % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences."""
    return words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
