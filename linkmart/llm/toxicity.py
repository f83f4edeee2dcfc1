"""Toxicity by compression distance under two zstandard dictionaries.

One dictionary is trained on ordinary labelled text, one on what marks toxic text: the
words that recur over toxic documents (in at least ``RECUR`` of them, after as many
different words, so that copied passages do not count) and are ``LIFT`` times rarer in
ordinary ones. A window is a word with its spaces, put between
fixed carriers that both dictionaries hold, so that the frame's own overhead is the same in both
and a window's length is that of the window alone. Its distance is its compressed length
under the ordinary dictionary less that under the toxic one: positive where toxic text
explains it better.

A document is described by its largest distance and by how many windows reach a threshold.
The threshold is the one that parts the calibration documents best (largest sum of
sensitivity and specificity); a logistic regression on them turns both into a score. The
calibration documents are labelled, not held out, and took no part in the dictionaries.

Learning uses at most ``TOXIC_DOCS`` and ``ORDINARY_DOCS`` labelled documents, chosen by
hash; scoring reads whole texts. Distances of recurring words come from a bounded cache.

NULL and empty texts have no window and get the score of no evidence. Rows without a
usable label teach nothing, a document labelled twice counts as toxic if one label says
so; with no toxic or no ordinary example every score is 0, or 1 if all examples are toxic.
"""

from __future__ import annotations

import uuid
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm.common import hash_share, utf8

TOXIC_DOCS = 2000
ORDINARY_DOCS = 6000
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 4096
RECUR = 0.01
LIFT = 20
LEVEL = 3
CACHE_WORDS = 400_000
#: Control characters, which a word of a text cannot hold in this order.
CARRIER = bytes(range(1, 9)) + bytes(range(14, 32)) + bytes(range(1, 9))
#: The matcher does not look into the last eight bytes.
TRAILER = bytes(range(31, 13, -1))


def windows(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained content; zstandard wants enough samples, fewer are a dictionary as they are."""
    try:
        return zstd.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


class Distance:
    """Percent of a window's length under the ordinary dictionary that the toxic one saves."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = map(self._compressor, (ordinary, toxic))
        self.base = len(self.ordinary.compress(CARRIER + TRAILER))
        self.cache: dict[bytes, int] = {}

    def _distance(self, word: bytes) -> int:
        text = b"".join((CARRIER, b" ", word, b" ", TRAILER))
        whole, toxic = len(self.ordinary.compress(text)), len(self.toxic.compress(text))
        return max(0, 100 * (whole - toxic) // max(1, whole - self.base))

    @staticmethod
    def _compressor(content: bytes) -> zstd.ZstdCompressor:
        raw = content + TRAILER + CARRIER
        params = zstd.ZstdCompressionParameters.from_level(
            LEVEL, min_match=4, window_log=17, dict_size=len(raw), source_size=64,
            write_checksum=False, write_content_size=False, write_dict_id=False)
        return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=params)

    def of(self, words: list[bytes]) -> np.ndarray:
        out = list(map(self.cache.get, words))
        if None in out:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            for i, d in enumerate(out):
                if d is None:
                    w = words[i]
                    d = self.cache.get(w)
                    out[i] = d if d is not None else self.cache.setdefault(w, self._distance(w))
        return np.array(out, np.int64)


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents."""
    in_toxic, in_ordinary = Counter(), Counter()
    for x in toxic:
        in_toxic.update(set(windows(x)))
    for x in ordinary:
        in_ordinary.update(set(windows(x)))
    often = max(2, RECUR * len(toxic))
    marks = {w for w, c in in_toxic.items() if c >= often and c / len(toxic) >= LIFT * (in_ordinary[w] + 0.5) / len(ordinary)}
    after: dict[bytes, set[bytes]] = {w: set() for w in marks}
    for x in toxic:
        ws = windows(x)
        for a, w in zip([b"", *ws], ws):
            if w in marks:
                after[w].add(a)
    marks = {w for w in marks if len(after[w]) >= often}
    line = lambda ws: b" " + b" ".join(ws) + b" "
    toxic_lines = [line(ws) for x in toxic if (ws := [w for w in windows(x) if w in marks])]
    ordinary_lines = []
    for x in ordinary:
        ws = [w for w in windows(x) if w not in marks]
        ordinary_lines += [line(ws[i:i + 8]) for i in range(0, len(ws), 64)]  # an eighth, from all of the text
    learnt = _dictionary(toxic_lines, TOXIC_BYTES)
    # the trainer may leave out a mark, and the fast matcher indexes every third place:
    # each mark once more, in three alignments, the commonest last
    again = b"".join(line([w, w + b" ", w]) for w in sorted(marks, key=lambda w: (in_toxic[w], w)))
    return _dictionary(ordinary_lines, ORDINARY_BYTES), again[-TOXIC_BYTES:] + learnt


def evidence(distances: np.ndarray, threshold: int) -> tuple[float, float]:
    return (float(distances.max()), float(np.log1p((distances >= threshold).sum()))) if len(distances) else (0.0, 0.0)


def calibrate(distances: list[np.ndarray], labels: np.ndarray) -> tuple[int, np.ndarray]:
    """The threshold that parts the labels best, and logistic weights (bias, largest, many)."""
    largest = np.array([d.max() if len(d) else 0 for d in distances])
    gain = {t: (largest[labels == 1] >= t).mean() - (largest[labels == 0] >= t).mean() for t in range(1, 101)}
    best = [t for t in gain if gain[t] == max(gain.values())]
    threshold = best[len(best) // 2]
    x = np.array([(1.0, *evidence(d, threshold)) for d in distances])
    x[:, 1] = np.clip((x[:, 1] - threshold) / 10, -2, 2)
    w = np.zeros(3)
    for _ in range(30):  # Newton steps with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (labels - p) - 0.1 * w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), grad)
    return threshold, w


class Model:
    def __init__(self, dictionaries: tuple[bytes, bytes] | None, threshold: int, weights: np.ndarray):
        self.dictionaries, self.threshold, self.weights = dictionaries, threshold, weights

    def scorer(self):
        if self.dictionaries is None:
            return lambda raw: float(self.weights[0])
        distance = Distance(*self.dictionaries)

        def score(raw: bytes) -> float:
            top, many = evidence(distance.of(windows(raw)), self.threshold)
            z = self.weights @ (1.0, min(2.0, max(-2.0, (top - self.threshold) / 10)), many)
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def fit(examples: list[tuple[bytes, int]]) -> Model:
    """A model of labelled texts; every fourth distinct text calibrates."""
    distinct = dict(examples)
    part = lambda x: crc32(x) % 4 == 0
    toxic = [x for x, y in distinct.items() if y]
    ordinary = [x for x, y in distinct.items() if not y]
    if not toxic or not ordinary:
        return Model(None, 0, np.array([1.0 if toxic else 0.0, 0, 0]))
    rest = lambda xs: [x for x in xs if not part(x)] or xs
    dictionaries = train_dictionaries(rest(toxic), rest(ordinary))
    test = [x for x in toxic if part(x)] or toxic, [x for x in ordinary if part(x)] or ordinary
    distance = Distance(*dictionaries)
    labels = np.array([1] * len(test[0]) + [0] * len(test[1]))
    return Model(dictionaries, *calibrate([distance.of(windows(x)) for xs in test for x in xs], labels))


_SCORERS: dict[str, object] = {}


def score_toxicity(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1) and predicted (score >= 0.5).
    ``labels`` holds ``id_col`` and ``label_col`` (0 or 1); ``held_out`` is a condition over
    the column ``id``; labels of rows for which it is true are not read."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IN (0, 1)") \
        .where(~held).groupBy("id").agg(F.max("label").cast("int").alias("label"))
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    pick = lambda y, n: known.where((F.col("label") == y) & hash_share(2 * n, sizes.get(y, 0), "id")) \
        .orderBy(F.xxhash64("id"), "id").limit(n)
    sample = pick(1, toxic_docs).union(pick(0, ordinary_docs))  # bounded by its two limits
    got = rows.join(F.broadcast(sample), "id").select("raw", "label").toArrow()
    model = fit(sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist())))
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        score = _SCORERS.get(key)  # one for each Python worker, with its cache
        if score is None:
            _SCORERS.clear()
            score = _SCORERS[key] = shared.value.scorer()
        for batch in batches:
            scores = pa.array([score(x.as_py()) for x in batch.column(1)], pa.float64())
            yield pa.record_batch([batch.column(0), scores], names=["id", "score"])

    scored = rows.mapInArrow(run, f"id {kind}, score double")
    return scored.select("id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
