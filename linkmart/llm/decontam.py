"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Seeds are all word 4-grams of the test items. One pass over the training texts hashes every
4-gram and keeps those in a fixed-size bit filter of the seeds (two bits each), with the
words around them; the exact seeds are then joined by hash. A stretch of a document and an
item that share one seed make a candidate, however many documents or items hold that seed:
an item that leaked often must not hide its edited copies.

Each candidate is aligned word by word (match 2, mismatch -1, gap -1) with the item; the
score is the alignment's share of a perfect one. So edited or partly paraphrased copies
score by what they keep. Candidates with too few words in common to reach the least score
are left out before, which loses nothing, and equal ones of a batch are aligned once.

Words are maximal runs of letters and digits of the lower-cased text. Items of fewer words
than a seed are no evidence and match nothing. NULL texts are empty. Items with the same
words are one class, reported for each of its item ids; rows that repeat a document id are
reported once per item, with the best score.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm.common import stored

SEED_WORDS = 4
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
FILTER_BITS = 24
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_ALIGN_CELLS = 4_000_000
_OTHER = re.compile(r"[^\w\s]|_")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    s = (text or "").lower()
    return _WORD.findall((s if s.isascii() else _OTHER.sub(" ", s)).replace("\xa0", " ").encode())


def gram_hashes(words: list[bytes], n: int = SEED_WORDS) -> np.ndarray:
    """64-bit hash of each run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(crc32, words), np.uint64, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        x = (w[i: len(w) - n + 1 + i] + np.uint64(i + 1)) * np.uint64(_MIX[i % 4])
        h = (h ^ x ^ (x >> np.uint64(29))) * np.uint64(_MIX[(i + 1) % 4])
    return h ^ (h >> np.uint64(32))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """Best local alignment of each item with its window, all at once: (score, start, stop)
    of the window's aligned words; (0, 0, 0) for none."""
    b, m, w = len(items), max(map(len, items)), max(map(len, windows))
    x, y = np.full((b, m), -1, np.int64), np.full((b, w), -2, np.int64)
    for i, (p, q) in enumerate(zip(items, windows)):
        x[i, :len(p)], y[i, :len(q)] = p, q
    place = np.arange(w + 1)
    h, start = np.zeros((b, w + 1), np.int64), np.tile(place, (b, 1))
    top, left, right = np.zeros(b, np.int64), np.zeros(b, np.int64), np.zeros(b, np.int64)
    rows = np.arange(b)
    for i in range(m):
        diagonal = h[:, :-1] + np.where(x[:, i: i + 1] == y, MATCH, MISMATCH)
        down = h[:, 1:] + GAP
        best = np.maximum(np.maximum(diagonal, down), 0)
        origin = np.where(best == diagonal, start[:, :-1], start[:, 1:])
        origin = np.where(best == 0, place[1:], origin)
        h = np.concatenate([np.zeros((b, 1), np.int64), best], axis=1)
        start = np.concatenate([np.zeros((b, 1), np.int64), origin], axis=1)
        level = h - GAP * place  # a gap in the item: the best cell to the left, less its distance
        run = np.maximum.accumulate(level, axis=1)
        source = np.maximum.accumulate(np.where(level == run, place, 0), axis=1)
        h, start = run + GAP * place, np.take_along_axis(start, source, axis=1)
        at = h.argmax(1)
        better = h[rows, at] > top
        top = np.where(better, h[rows, at], top)
        left, right = np.where(better, start[rows, at], left), np.where(better, at, right)
    return list(zip(top.tolist(), left.tolist(), right.tolist()))


def may_reach(item: Counter, window: list[str], least: float) -> bool:
    """Whether an alignment of the item's words with the window can score ``least``: each
    match takes a word of either side."""
    return MATCH * (item & Counter(window)).total() >= least * MATCH * item.total()


def _align_batches(batches, min_score: float):
    """Rows (id, item_class, item, window, from, to, base) -> scores of those that can reach
    ``min_score``; blocks of bounded size."""
    for batch in batches:
        words, same = {}, {}
        for r in batch.to_pylist():
            same.setdefault((r["item_class"], r["window"]), []).append(r)
        pairs = []
        for (item_class, window), rows in same.items():
            if item_class not in words:
                item = rows[0]["item"].split(" ")
                words[item_class] = item, Counter(item)
            item, bag = words[item_class]
            window = window.split(" ")
            if may_reach(bag, window, min_score):
                pairs.append((item, window, rows))
        pairs.sort(key=lambda x: (len(x[1]), len(x[0])))
        a = 0
        while a < len(pairs):
            ids: dict[str, int] = {}
            number = lambda ws: np.array([ids.setdefault(w, len(ids)) for w in ws], np.int64)  # noqa: B023, E731
            b, cells = a, 0
            while b < len(pairs) and (b == a or cells < _ALIGN_CELLS):
                cells += (len(pairs[b][1]) + 1) * 16
                b += 1
            part = pairs[a:b]
            found = align([number(p) for p, _, _ in part], [number(q) for _, q, _ in part])
            out = [(r["id"], r["item_class"], s / (MATCH * len(p)), r["base"] + r["from"] + x, r["base"] + r["from"] + y, len(p))
                   for (p, _, rows), (s, x, y) in zip(part, found) for r in rows]
            cols = list(zip(*out))
            yield pa.record_batch([pa.array(cols[0], batch.schema.field("id").type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                                   *(pa.array(c, pa.int64()) for c in cols[3:])],
                                  names=["id", "item_class", "score", "doc_start", "doc_end", "item_words"])
            a = b


def contaminated(
    spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
) -> DataFrame:
    """One row per (id, item_id) whose best alignment scores ``min_score`` or more: score,
    doc_start and doc_end (words of the document) and item_words."""
    kind = docs.schema[id_col].dataType.simpleString()

    # items: their words, classes of equal items, and seeds
    def item_words(batches):
        for batch in batches:
            ws = [words_of(t) for t in batch.column(1).to_pylist()]
            grams = [gram_hashes(w).view(np.int64).tolist() for w in ws]
            yield pa.record_batch([batch.column(0), pa.array([b" ".join(w).decode() for w in ws], pa.string()),
                                   pa.array(map(len, ws), pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
                                  names=["item_id", "item", "n_words", "grams"])

    tests = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).mapInArrow(
        item_words, "item_id bigint, item string, n_words int, grams array<bigint>")
    tests = stored(spark, tests.where(f"n_words >= {SEED_WORDS}"), "decontam-tests")
    same = tests.groupBy("item").agg(F.min("item_id").alias("least"), F.xxhash64("item").alias("item_class"),
                                     F.first("n_words").alias("n_words"), F.first("grams").alias("grams"))
    classes = stored(spark, same, "decontam-classes")
    seeds = stored(spark, classes.select("item_class", F.posexplode("grams").alias("item_pos", "h")), "decontam-seeds")
    longest = classes.agg(F.max("n_words")).first()[0]
    schema = f"id {kind}, item_id bigint, score double, doc_start bigint, doc_end bigint, item_words bigint"
    if longest is None:
        return spark.createDataFrame([], schema)

    # the filter: a bitmap of fixed size, whatever the number of seeds
    def filter_words(batches):
        for batch in batches:
            low, high = _bits(batch.column(0).to_numpy().view(np.uint64))
            spots = np.unique(np.concatenate([low, high + (1 << FILTER_BITS)]))
            yield pa.record_batch([pa.array(spots >> 6), pa.array((np.uint64(1) << (spots & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    ones = seeds.select("h").distinct().mapInArrow(filter_words, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filled = ones.toArrow()  # at most 2 ** (FILTER_BITS - 5) words
    bitmap = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    bitmap[filled.column(0).to_numpy()] = filled.column(1).to_numpy()
    shared = spark.sparkContext.broadcast(bitmap)
    context = longest + longest // 4 + 8

    # one pass over the documents: stretches of words around seed hits
    def scan(batches):
        bits = np.unpackbits(shared.value.view(np.uint8), bitorder="little").view(bool)
        low_bits, high_bits = bits[: 1 << FILTER_BITS], bits[1 << FILTER_BITS:]
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                h = gram_hashes(words)
                low, high = _bits(h)
                hits = np.flatnonzero(low_bits[low] & high_bits[high])
                if not len(hits):
                    continue
                for run in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * context) + 1):
                    base = max(0, int(run[0]) - context)
                    stretch = words[base: int(run[-1]) + SEED_WORDS + context]
                    out.append((key, doc, base, len(stretch), b" ".join(stretch).decode(), (run - base).tolist(), h[run].view(np.int64).tolist()))
                    key += 1
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], batch.schema.field(0).type), pa.array(cols[2], pa.int64()),
                                   pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string()),
                                   pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int64()))],
                                  names=["stretch", "id", "base", "n", "words", "at", "h"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        scan, f"stretch bigint, id {kind}, base bigint, n bigint, words string, at array<bigint>, h array<bigint>")
    found = stored(spark, found, "decontam-stretches")

    # exact seeds and candidates
    hits = found.select("stretch", "n", F.explode(F.arrays_zip("at", "h")).alias("x")).select("stretch", "n", "x.at", "x.h")
    hits = stored(spark, hits, "decontam-hits")
    size = classes.select("item_class", "n_words", "item")
    pairs = (
        hits.join(seeds, "h").join(size.drop("item"), "item_class")
        .withColumn("bucket", F.floor((F.col("at") - F.col("item_pos")) / F.col("n_words")))
        .groupBy("stretch", "item_class", "bucket")
        .agg(F.first("n_words").alias("n_words"), F.first("n").alias("n"))
        .withColumn("slack", F.floor(F.col("n_words") / 4) + 4)
        .select("stretch", "item_class",
                F.greatest(F.lit(0), F.col("bucket") * F.col("n_words") - F.col("slack")).cast("long").alias("from"),
                F.least(F.col("n"), (F.col("bucket") + 2) * F.col("n_words") + F.col("slack")).cast("long").alias("to"))
    )
    pairs = stored(spark, pairs, "decontam-pairs")
    ready = pairs.join(found.select("stretch", "id", "base", "words"), "stretch").join(size.drop("n_words"), "item_class")
    window = F.array_join(F.slice(F.split("words", " "), (F.col("from") + 1).cast("int"), (F.col("to") - F.col("from")).cast("int")), " ")
    scored = ready.select("id", "item_class", "item", window.alias("window"), "from", "to", "base").mapInArrow(
        lambda batches: _align_batches(batches, min_score), f"id {kind}, item_class bigint, score double, doc_start bigint, doc_end bigint, item_words bigint")
    best = scored.where(F.col("score") >= min_score).groupBy("id", "item_class").agg(
        F.max(F.struct("score", "doc_start", "doc_end", "item_words")).alias("x")).select("id", "item_class", "x.*")
    named = tests.join(classes.select("item", "item_class"), "item").select("item_class", "item_id")
    return best.join(named, "item_class").select("id", "item_id", "score", "doc_start", "doc_end", "item_words")
