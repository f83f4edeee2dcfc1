"""Language-model scores of whole documents by a log-bilinear model.

Tokens: ASCII-lower-cased words split on ASCII white space, then one end token. Counts of
all training tokens are taken over all training documents.

Model: the ``WORDS`` commonest tokens are outputs of their own, every other token belongs
to one of ``TAIL_CLASSES`` classes by its last three bytes. A context's representation is
the sum of the previous ``CONTEXT`` outputs' vectors, each weighted per position; an
output's score is its product with the output's vector plus a bias (log-bilinear). Inside
a class a token has probability ``(count + 1) / (sum of count + 1, plus 1 for the unseen)``,
so all tokens together with one unseen token per class sum to 1.

Training is noise-contrastive estimation in numpy: each minibatch tells its true outputs
from noise outputs drawn by their frequency and shared by the batch. It starts from the
outputs' frequencies and a short warm-up on a bounded sample; then every partition of the training documents trains
on all its tokens and the resulting parameters are averaged, weighted by tokens.

Scoring takes the distinct contexts of a batch, computes their products with all outputs
as one matrix product and normalises by log-sum-exp, so the probabilities are exact.

The counts needed for tail tokens come from a join, in which only tokens outside the
``HEAD`` commonest take part; those common ones are a bounded broadcast.

NULL texts are empty (one end token). Documents with a NULL id belong to the training part.
Rows that repeat an id are scored and, if training, counted each.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm.common import hash_share, stored, utf8

HEAD = 100_000
WORDS = 384
TAIL_CLASSES = 128
CONTEXT = 2
DIM = 16
NOISE = 32
BATCH = 2048
RATE = 0.15
WARM_DOCS = 400
WARM_BYTES = 4_000_000
_FLUSH = 250_000
_CHUNK_BYTES = 1_000_000
_SCORE_BYTES = 2_500_000  # longer chunks share more contexts
END = b""


def tokens_of(raw: bytes) -> list[bytes]:
    words = raw.lower().split()
    words.append(END)
    return words


def tail_class(token: bytes, words: int, classes: int) -> int:
    return words + crc32(token[-3:]) % classes


# -- the model ---------------------------------------------------------------------------


class LogBilinear:
    """Parameters over ``n`` outputs; row ``n`` of the inputs is the start of a text."""

    def __init__(self, n: int, dim: int = DIM, context: int = CONTEXT, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.n, self.dim, self.context = n, dim, context
        self.parts = {
            "inputs": 0.1 * rng.standard_normal((n + 1, dim)),
            "weights": np.ones((context, dim)) / context,
            "outputs": 0.1 * rng.standard_normal((n, dim)),
            "bias": np.zeros((n, 1)),
        }

    def represent(self, history: np.ndarray) -> np.ndarray:
        p = self.parts
        return sum(p["inputs"][history[:, i]] * p["weights"][i] for i in range(self.context))

    def log_probabilities(self, history: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability of every output after each history."""
        s = self.represent(history).astype(np.float32) @ self.parts["outputs"].astype(np.float32).T + self.parts["bias"][:, 0].astype(np.float32)
        top = s.max(1, keepdims=True)
        return s - top - np.log(np.exp(s - top).sum(1, keepdims=True))

    def flat(self) -> np.ndarray:
        """All parameters as rows of ``dim`` + 1 numbers (the last is the bias)."""
        p = self.parts
        rows = np.zeros((2 * self.n + 1 + self.context, self.dim + 1))
        rows[: self.n, :-1], rows[: self.n, -1:] = p["outputs"], p["bias"]
        rows[self.n: 2 * self.n + 1, :-1] = p["inputs"]
        rows[2 * self.n + 1:, :-1] = p["weights"]
        return rows

    def load(self, rows: np.ndarray) -> LogBilinear:
        self.parts = {"outputs": rows[: self.n, :-1].copy(), "bias": rows[: self.n, -1:].copy(),
                      "inputs": rows[self.n: 2 * self.n + 1, :-1].copy(), "weights": rows[2 * self.n + 1:, :-1].copy()}
        return self


class Trainer:
    """AdaGrad steps of noise-contrastive estimation."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, k: int = NOISE, rate: float = RATE, seed: int = 0):
        self.model, self.k, self.rate = model, k, rate
        self.rng = np.random.default_rng(seed)
        self.noise = noise
        self.bound = np.cumsum(noise)
        self.log_noise = np.log(k * noise)
        self.squares = {name: np.full_like(x, 1e-2) for name, x in model.parts.items()}

    def _add(self, rows: np.ndarray, grad: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(rows, grad[:, d], n) for d in range(grad.shape[1])], axis=1)

    def step(self, history: np.ndarray, target: np.ndarray) -> None:
        m, p = self.model, self.model.parts
        near = np.minimum(np.searchsorted(self.bound, self.rng.random(self.k) * self.bound[-1], side="right"), m.n - 1)
        r = m.represent(history)
        q, v = p["outputs"][target], p["outputs"][near]
        sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        up = 1 - sigmoid((r * q).sum(1) + p["bias"][target, 0] - self.log_noise[target])
        down = -sigmoid(r @ v.T + p["bias"][near, 0] - self.log_noise[near])
        to_r = up[:, None] * q + down @ v
        outputs = self._add(target, np.column_stack([up[:, None] * r, up]), m.n)
        np.add.at(outputs, near, np.column_stack([down.T @ r, down.sum(0)]))
        grads = {"outputs": outputs[:, :-1], "bias": outputs[:, -1:], "weights": np.zeros_like(p["weights"]), "inputs": np.zeros_like(p["inputs"])}
        for i in range(m.context):
            grads["inputs"] += self._add(history[:, i], to_r * p["weights"][i], m.n + 1)
            grads["weights"][i] = (to_r * p["inputs"][history[:, i]]).sum(0)
        for name, g in grads.items():
            g /= len(target)
            self.squares[name] += g * g
            p[name] += self.rate * g / np.sqrt(self.squares[name])

    def train(self, ids: np.ndarray, starts: np.ndarray, batch: int = BATCH) -> None:
        """One pass over concatenated texts of output ids, in shuffled minibatches."""
        history = histories(ids, starts, self.model.context, self.model.n)
        order = self.rng.permutation(len(ids))
        for a in range(0, len(ids), batch):
            cut = order[a:a + batch]
            self.step(history[cut], ids[cut])


def histories(ids: np.ndarray, starts: np.ndarray, context: int, start_id: int) -> np.ndarray:
    """(len, context) previous outputs, nearest first; ``start_id`` before a text's start."""
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    out = np.full((len(ids), context), start_id, np.int64)
    for i in range(context):
        known = place > i
        out[known, i] = ids[np.flatnonzero(known) - i - 1]
    return out


# -- the operator ------------------------------------------------------------------------


def token_counts(docs: DataFrame, raw_col: str = "raw") -> DataFrame:
    """(token, c) over all rows; each task adds up its own before the shuffle."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def flush():
            yield pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "n"])
            held.clear()

        for batch in batches:
            for raw in batch.column(0):
                held.update(tokens_of(raw.as_py()))
                if len(held) > _FLUSH:
                    yield from flush()
        yield from flush()

    return docs.select(raw_col).mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("c"))


def _chunks(batches, id_place: int = 0, raw_place: int = 1, limit: int = _CHUNK_BYTES):
    """Lists of (id, raw) of about ``limit`` bytes."""
    ids, raws, held = [], [], 0
    for batch in batches:
        for i, raw in zip(batch.column(id_place).to_pylist(), batch.column(raw_place)):
            ids.append(i)
            raws.append(raw.as_py())
            held += len(raws[-1])
            if held >= limit:
                yield ids, raws
                ids, raws, held = [], [], 0
    if ids:
        yield ids, raws


def score_documents(
    spark: SparkSession, docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    head: int = HEAD, words: int = WORDS, classes: int = TAIL_CLASSES, dim: int = DIM, context: int = CONTEXT,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score
    and score (log10 of the text's probability under the add-one unigram and the model).
    ``held_out`` is a condition over the column ``id``; rows for which it is true teach nothing.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw")).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    train = rows.where(~F.col("held_out"))
    counts = stored(spark, token_counts(train), "lm-counts")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    # the commonest tokens: all above a count, at most ``head``
    level = F.floor(F.log2("c") * 16).cast("int")
    above, floor_ = 0, None
    for lv, n in sorted(((r.lv, r.n) for r in counts.groupBy(level.alias("lv")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if above + n > head:
            break
        above, floor_ = above + n, lv
    top = counts.where(level >= floor_).toArrow() if floor_ is not None else counts.limit(0).toArrow()
    common = sorted(zip(top.column(1).to_pylist(), top.column(0).to_pylist()), key=lambda x: (-x[0], x[1]))
    words = min(words, len(common))
    n_out = words + classes
    own = {t: i for i, (_, t) in enumerate(common[:words])}

    klass = (F.lit(words) + F.pmod(F.crc32(F.expr("substring(token, -3, 3)")), F.lit(classes))).cast("int")
    in_class = np.ones(n_out)  # one for the unseen token of each class
    mass = np.zeros(n_out)
    for r in counts.select(klass.alias("k"), "c").groupBy("k").agg(F.sum(F.col("c") + 1).alias("s"), F.sum("c").alias("m")).collect():
        in_class[r.k] += r.s
        mass[r.k] += r.m
    for c, t in common[:words]:
        k = tail_class(t, words, classes)
        in_class[k] -= c + 1
        mass[k] -= c
        mass[own[t]] = c
    in_class[:words] = 1
    noise = (mass + 1) / (mass + 1).sum()
    in_class_log = np.log10(in_class)

    token_row = {t: i for i, (_, t) in enumerate(common)}
    head_class = np.array([own[t] if t in own else tail_class(t, words, classes) for _, t in common] + [0], np.int64)
    head_log = np.log10(np.array([c for c, _ in common] + [0], float) + 1)
    shared = spark.sparkContext.broadcast((token_row, head_class, head_log, noise, in_class_log))

    def look_up(raws, table):
        """Token rows (-1: not common), outputs, text starts and the tokens of a chunk."""
        token_row, head_class = table[:2]
        lists = [tokens_of(x) for x in raws]
        flat = [t for ts in lists for t in ts]
        at = np.fromiter(map(token_row.get, flat, repeat(-1)), np.int64, len(flat))
        ids = head_class[at]
        for i in np.flatnonzero(at < 0).tolist():
            ids[i] = tail_class(flat[i], words, classes)
        starts = np.cumsum([0, *map(len, lists)])[:-1]
        return at, ids, starts, flat

    # training
    model = LogBilinear(n_out, dim, context)
    if total:
        texts = next((c for c, t in common if t == END), 0)  # every text has one end
        warm = train.where(hash_share(4 * WARM_DOCS, texts, "id")).orderBy(F.xxhash64("id")).limit(WARM_DOCS).select("raw").toArrow().column(0).to_pylist()
        size = np.cumsum([0, *map(len, warm)])[:-1]
        _, ids, starts, _ = look_up([x for x, n in zip(warm, size) if n < WARM_BYTES], (token_row, head_class))
        model.parts["bias"][:, 0] = np.log(noise)  # start from the outputs' frequencies
        trainer = Trainer(model, noise)
        for _ in range(3):
            trainer.train(ids, starts)
        begin = spark.sparkContext.broadcast((model.flat(), trainer.squares))

        def teach(batches):
            table = shared.value
            rows_, squares = begin.value
            local = LogBilinear(n_out, dim, context).load(rows_)
            teacher = Trainer(local, table[3], seed=TaskContext.get().partitionId())
            teacher.squares = {name: x.copy() for name, x in squares.items()}
            seen = 0
            for _, raws in _chunks(batches):
                _, ids, starts, _ = look_up(raws, table)
                teacher.train(ids, starts)
                seen += len(ids)
            if seen:
                flat = local.flat()
                yield pa.record_batch([pa.array(range(len(flat)), pa.int32()), pa.array([float(seen)] * len(flat)), *(pa.array(c) for c in flat.T)],
                                      names=["row", "weight", *(f"v{i}" for i in range(dim + 1))])

        learnt = train.select("id", "raw").mapInArrow(teach, "row int, weight double, " + ", ".join(f"v{i} double" for i in range(dim + 1)))
        mean = learnt.groupBy("row").agg(*((F.sum(F.col(f"v{i}") * F.col("weight")) / F.sum("weight")).alias(f"v{i}") for i in range(dim + 1)))
        got = mean.collect()  # one row per parameter row, whatever the corpus
        flat = np.zeros((len(got), dim + 1))
        for r in got:
            flat[r.row] = r[1:]
        model.load(flat)
    final = spark.sparkContext.broadcast(model.flat())

    # scoring
    def score(batches):
        table = shared.value
        _, _, head_log, _, in_class_log = table
        net = LogBilinear(n_out, dim, context).load(final.value)
        key = TaskContext.get().partitionId() << 33
        for ids_, raws in _chunks(batches, limit=_SCORE_BYTES):
            at, ids, starts, flat = look_up(raws, table)
            history = histories(ids, starts, context, n_out)
            code = history @ ((n_out + 1) ** np.arange(context))
            distinct, first, where = np.unique(code, return_index=True, return_inverse=True)
            logp = np.empty(len(ids))
            order = np.argsort(where, kind="stable")
            bound = np.searchsorted(where[order], np.arange(len(distinct) + 1))
            for a in range(0, len(distinct), 2048):
                b = min(len(distinct), a + 2048)
                lp = net.log_probabilities(history[first[a:b]])
                cut = order[bound[a]:bound[b]]
                logp[cut] = lp[where[cut] - a, ids[cut]]
            logp = logp / np.log(10) - in_class_log[ids]
            known = at >= 0
            # a common token outside the model's words has its share of its class here
            logp += np.where(known & (ids >= words), head_log[at], 0)
            counts_ = np.where(known, head_log[at], 0)
            n = np.diff(np.append(starts, len(ids)))
            add = lambda x: np.add.reduceat(x, starts)
            doc = np.repeat(np.arange(len(n)), n)
            tails: list[Counter] = [Counter() for _ in n]
            for i in np.flatnonzero(~known).tolist():
                tails[doc[i]][flat[i]] += 1
            yield pa.record_batch([
                pa.array(np.arange(key, key + len(n))), pa.array(ids_, id_type), pa.array(n), pa.array(add(known.astype(np.int64))),
                pa.array(add(counts_)), pa.array(add(logp)),
                pa.array([list(t) for t in tails], pa.list_(pa.binary())), pa.array([list(t.values()) for t in tails], pa.list_(pa.int64())),
            ], names=["key", "id", "n_tokens", "n_common", "counts", "model", "tail", "times"])
            key += len(n)

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    scanned = rows.select("id", "raw").mapInArrow(
        score, f"key bigint, id {kind}, n_tokens bigint, n_common bigint, counts double, model double, tail array<binary>, times array<bigint>")
    scanned = stored(spark, scanned, "lm-scores")
    tail = scanned.select("key", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("key", F.col("x.tail").alias("token"), F.col("x.times").alias("times"))
    rare = counts.where(level < floor_) if floor_ is not None else counts
    seen = tail.join(rare, "token").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("tail_counts"), F.sum("times").alias("tail_known"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    held = F.coalesce(held_out, F.lit(False))
    return scanned.drop("tail", "times").join(seen, "key", "left").select(
        "id", held.alias("held_out"), "n_tokens", (F.col("n_common") + zero("tail_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("counts") + zero("tail_counts") - F.col("n_tokens") * float(np.log10(total + types + 1))).alias("base_score"),
        (F.col("model") + zero("tail_counts")).alias("score"))
