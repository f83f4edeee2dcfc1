"""Language identification by a linear-chain conditional random field over words.

Every word has features: the letter 2- to 4-grams of the word between a start and an end
mark (those at a mark are its affixes), hashed, and the languages in whose lexicon it is.
The lexicon holds training words of which nearly all occurrences are in one language. With
learned transitions between the languages of neighbouring words, forward-backward gives
each word its language probabilities, so switches inside a text are followed; the
document's language is the one with the largest sum, its score that sum's share.

The field is trained in numpy on at most ``TRAIN_DOCS`` labelled documents per language,
by full-batch gradient steps on the log-likelihood of sequences that are spliced from
spans of different documents, which shows it switches.

Scoring concatenates the documents of a chunk (a document's first word cuts the chain) and
runs the recursions over columns of the sequence at once: the product of a column's
transition matrices carries the messages across columns, so the result is exact for any
length. With more than ``PRODUCT_LANGUAGES`` languages, where those products cost too much,
they run over documents at once instead, exact too. Every language is learned, however
many there are: the number of sequences grows with them beyond ``LEAST_SEQUENCES`` for
each, and chunks, caches and blocks shrink, so that memory holds.

A text that is NULL or has no letter is ``und`` with score 0, and so is every text when
there is nothing to learn from.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_DOCS = 300
PRODUCT_LANGUAGES = 32
SPAN_WORDS = 12
SEQUENCE_WORDS = 32
SEQUENCES = 6000
LEAST_SEQUENCES = 94
STEPS = 60
HASH_BITS = 17
LEXICON_SHARE = 0.9
LEXICON_COUNT = 3
CACHE_WORDS = 150_000
_BLOCK = 4_000_000
UNDETERMINED = "und"
_CHUNK_CHARS = 1_000_000
_LONG_WORD = 40
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def _grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word row, feature) of the hashed 2- to 4-grams of words, marks included."""
    rows, feats = [], []
    by_width: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_width.setdefault(_LONG_WORD if len(w) <= _LONG_WORD else len(w), []).append(i)
    for width, at in by_width.items():
        text = np.array([words[i] for i in at], f"U{width}").view(np.uint32).reshape(len(at), width)
        size = np.array([len(words[i]) for i in at])
        m = np.zeros((len(at), width + 2), np.uint64)
        m[:, 0], m[:, 1:-1] = 2, text
        m[np.arange(len(at)), size + 1] = 3
        for n in (2, 3, 4):
            h = np.full((len(at), width + 3 - n), n, np.uint64)
            for i in range(n):
                h = (h ^ m[:, i: width + 3 - n + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(31)
            r, c = np.nonzero(np.arange(h.shape[1])[None, :] + n <= size[:, None] + 2)
            rows.append(np.array(at)[r])
            feats.append((h[r, c] >> np.uint64(64 - bits)).astype(np.int64))
    return (np.concatenate(rows), np.concatenate(feats)) if rows else (np.zeros(0, int), np.zeros(0, int))


class Field:
    """Weights of a trained field; ``languages`` in ascending order."""

    def __init__(self, languages: list[str], lexicon: dict[str, int], bits: int = HASH_BITS):
        n = len(languages)
        self.languages, self.lexicon, self.bits = languages, lexicon, bits
        self.weights = np.zeros(((1 << bits) + n + 1, n), np.float32)
        self.moves = np.zeros((n, n))
        self.start = np.zeros(n)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows, feats = _grams(words, self.bits)
        none = len(self.languages)
        lex = np.array([self.lexicon.get(w, none) for w in words], np.int64) + (1 << self.bits)
        return np.concatenate([rows, np.arange(len(words))]), np.concatenate([feats, lex])

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.languages)))
        step = max(1, _BLOCK // len(self.languages))
        for a in range(0, len(words), step):
            part = words[a:a + step]
            rows, feats = self.features(part)
            scores = self.weights[feats]
            for k in range(len(self.languages)):
                out[a:a + step, k] = np.bincount(rows, scores[:, k], len(part))
        return out


def _by_document(e: np.ndarray, move: np.ndarray, start: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``marginals`` of exponentiated scores, the documents side by side, longest first."""
    begin = np.flatnonzero(np.concatenate([[True], first[1:]]))
    size = np.diff(np.append(begin, len(e)))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    running = np.searchsorted(-size, -np.arange(size[0]))  # documents longer than t
    prior = np.tile(start, (len(begin), 1))
    if not first[0]:
        prior[begin == 0] = move.mean(0)
    out, a = np.empty_like(e), None
    for t, m in enumerate(running.tolist()):
        at = begin[:m] + t
        a = (prior if a is None else a[:m] @ move) * e[at]
        a /= a.sum(1, keepdims=True)
        out[at] = a
    b = np.ones_like(prior)
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        at = begin[:m] + t
        p = out[at] * b[:m]
        out[at] = p / p.sum(1, keepdims=True)
        x = (e[at] * b[:m]) @ move.T
        b[:m] = x / x.sum(1, keepdims=True)
    return out


def marginals(field: Field, scores: np.ndarray, first: np.ndarray, column: int = 256) -> np.ndarray:
    """Each word's language probabilities. ``scores`` are the words' emissions, ``first``
    marks the words that begin a document."""
    n, k = scores.shape
    if not n:
        return scores
    e = np.exp(scores - scores.max(1, keepdims=True))
    move = np.exp(field.moves - field.moves.max())
    start = np.exp(field.start - field.start.max())
    if k > PRODUCT_LANGUAGES:
        return _by_document(e, move, start, first)
    columns = -(-n // column)
    pad = columns * column - n
    e = np.concatenate([e, np.ones((pad, k))]).reshape(columns, column, k).transpose(1, 0, 2)
    cut = np.concatenate([first, np.ones(pad, bool)]).reshape(columns, column).T[:, :, None]

    # the product of each column's matrices; row i is the message that starts in state i
    product = np.broadcast_to(np.eye(k), (columns, k, k))
    for t in range(column):
        product = np.where(cut[t][:, :, None], product.sum(2, keepdims=True) * start, product @ move) * e[t][:, None, :]
        product = product / product.max((1, 2), keepdims=True)
    ahead, back = np.ones((columns, k)) / k, np.ones((columns, k)) / k
    for c in range(1, columns):
        x = ahead[c - 1] @ product[c - 1]
        ahead[c] = x / x.sum()
    for c in range(columns - 2, -1, -1):
        x = product[c + 1] @ back[c + 1]
        back[c] = x / x.sum()

    forward = np.empty_like(e)
    a = ahead
    for t in range(column):
        a = np.where(cut[t], start, a @ move) * e[t]
        a = forward[t] = a / a.sum(1, keepdims=True)
    out = np.empty_like(e)
    b = back
    for t in range(column - 1, -1, -1):
        p = forward[t] * b
        out[t] = p / p.sum(1, keepdims=True)
        x = e[t] * b
        b = np.where(cut[t], (x * start).sum(1, keepdims=True), x @ move.T)
        b = b / b.sum(1, keepdims=True)
    return out.transpose(1, 0, 2).reshape(-1, k)[:n]


def train(examples: list[tuple[str, str]], seed: int = 0, steps: int = STEPS) -> Field | None:
    """A field from (text, language) pairs."""
    rng = random.Random(seed)
    by_language: dict[str, list[list[str]]] = {}
    for text, lang in examples:
        ws = words_of(text)
        if ws:
            by_language.setdefault(lang, []).append(ws)
    languages = sorted(by_language)
    if not languages:
        return None
    where: dict[str, Counter] = {}
    for k, lang in enumerate(languages):
        total = sum(map(len, by_language[lang]))
        for w, c in Counter(w for ws in by_language[lang] for w in ws).items():
            where.setdefault(w, Counter())[k] = c / total
            where[w][-1] += c
    lexicon = {}
    for w, c in where.items():
        n = c.pop(-1)
        k, share = max(c.items(), key=lambda x: (x[1], -x[0]))
        if n >= LEXICON_COUNT and share >= LEXICON_SHARE * sum(c.values()):
            lexicon[w] = k
    field = Field(languages, lexicon)
    k = len(languages)

    # sequences: spans of random documents, languages in turn as likely
    sequences = max(SEQUENCES, LEAST_SEQUENCES * k)
    flat, labels = [], []
    while len(flat) < sequences * SEQUENCE_WORDS:
        lang = rng.randrange(k)
        ws = rng.choice(by_language[languages[lang]])
        size = rng.randrange(1, 2 * SPAN_WORDS)
        at = rng.randrange(max(1, len(ws) - size + 1))
        flat += ws[at:at + size]
        labels += [lang] * len(ws[at:at + size])
    flat, labels = flat[: sequences * SEQUENCE_WORDS], np.array(labels[: sequences * SEQUENCE_WORDS])
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    words = list(vocabulary)
    held_out_of_lexicon = rng.sample(words, len(words) // 2)  # so letters are learned too
    for w in held_out_of_lexicon:
        field.lexicon.pop(w, None)
    rows, feats = field.features(words)
    field.lexicon = lexicon
    at = np.array([vocabulary[w] for w in flat]).reshape(sequences, SEQUENCE_WORDS).T
    y = labels.reshape(sequences, SEQUENCE_WORDS).T
    used, feats = np.unique(feats, return_inverse=True)
    w = np.zeros((k, len(used)))
    squares = [np.full(x.shape, 1e-6) for x in (w, field.moves, field.start)]
    occurs = np.bincount(at.ravel(), minlength=len(words))
    gold = np.zeros((len(words), k))
    np.add.at(gold, (at.ravel(), y.ravel()), 1)
    gold_moves = np.zeros((k, k))
    np.add.at(gold_moves, (y[:-1].ravel(), y[1:].ravel()), 1)
    gold_start = np.bincount(y[0], minlength=k)
    block = max(64, _BLOCK // (SEQUENCE_WORDS * k))
    for _ in range(steps):
        scores = np.empty((len(words), k))
        for j in range(k):
            scores[:, j] = np.bincount(rows, w[j][feats], len(words))
        scores -= scores.max(1, keepdims=True)
        np.exp(scores, out=scores)
        move, start = np.exp(field.moves), np.exp(field.start)
        by_word, expected_moves, expected_start = gold.copy(), np.zeros((k, k)), np.zeros(k)
        for begin in range(0, sequences, block):
            here = at[:, begin:begin + block]
            e = scores[here]
            forward, a = np.empty_like(e), None
            for t in range(SEQUENCE_WORDS):
                a = (start if a is None else a @ move) * e[t]
                a = forward[t] = a / a.sum(1, keepdims=True)
            b = np.ones(a.shape)
            for t in range(SEQUENCE_WORDS - 1, -1, -1):
                p = forward[t] * b
                p /= p.sum(1, keepdims=True)
                if t:
                    x = e[t] * b
                    pairs = ((forward[t - 1] @ move) * x).sum(1, keepdims=True)  # all pairs of states of a sequence
                    expected_moves += move * ((forward[t - 1] / pairs).T @ x)
                    b = x @ move.T
                    b /= b.sum(1, keepdims=True)
                else:
                    expected_start += p.sum(0)
                forward[t] = p
            for j in range(k):
                by_word[:, j] -= np.bincount(here.ravel(), forward[:, :, j].ravel(), len(words))
        by_word /= sequences
        for j in range(k):
            g = np.bincount(feats, by_word[:, j][rows], len(used)) - 1e-4 * w[j]
            squares[0][j] += g * g
            w[j] += 0.3 * g / np.sqrt(squares[0][j])
        grads = (gold_moves - expected_moves) / sequences, (gold_start - expected_start) / sequences
        for x, g, s in zip((field.moves, field.start), grads, squares[1:]):
            s += g * g
            x += 0.3 * g / np.sqrt(s)
    field.weights[used] = w.T
    assert occurs.sum() == len(flat)
    return field


class Labeller:
    """Scores documents; keeps the emissions of recurring words in a bounded cache."""

    def __init__(self, field: Field):
        self.field, self.place = field, {}
        self.table = np.zeros((0, len(field.languages)))
        self.most = CACHE_WORDS * PRODUCT_LANGUAGES // max(PRODUCT_LANGUAGES, len(field.languages))

    def _emissions(self, words: list[str]) -> np.ndarray:
        at = [self.place.get(w, -1) for w in words]
        new = list(dict.fromkeys(w for w, i in zip(words, at) if i < 0))
        if new:
            fresh = self.field.emissions(new)
            if len(self.place) + len(new) > self.most:
                local = {w: i for i, w in enumerate(new)}
                table = np.concatenate([self.table, fresh])
                out = table[[i if i >= 0 else len(self.table) + local[w] for w, i in zip(words, at)]]
                self.place, self.table = {}, self.table[:0]
                return out
            for w in new:
                self.place[w] = len(self.place)
            self.table = np.concatenate([self.table, fresh])
            at = [self.place[w] for w in words]
        return self.table[at]

    def label(self, docs: list[list[str]]) -> list[tuple[str, float]]:
        flat = [w for ws in docs for w in ws]
        sizes = np.array([len(ws) for ws in docs])
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(len(flat), bool)
        first[starts[sizes > 0]] = True
        p = marginals(self.field, self._emissions(flat), first) if flat else np.zeros((0, 1))
        out = []
        for ws, a, n in zip(docs, starts.tolist(), sizes.tolist()):
            if not n or not has_letter(ws):
                out.append((UNDETERMINED, 0.0))
            else:
                total = p[a:a + n].sum(0)
                j = int(total.argmax())
                out.append((self.field.languages[j], min(1.0, float(total[j] / n))))
        return out


def fit_sample(docs: DataFrame, train_docs: int) -> list[tuple[str, str]]:
    """(text, language) of at most ``train_docs`` rows per language of ``docs(id, text, lang)``,
    chosen by hash: about twice as many are looked at."""
    teach = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = teach.groupBy("lang").count().collect()
    if not counts:
        return []
    place = F.pmod(F.xxhash64("id", "lang"), F.lit(1 << 30))
    share = docs.sparkSession.createDataFrame(
        [(r.lang, int(min(1.0, 2 * train_docs / r["count"]) * (1 << 30))) for r in counts], "lang string, share long")
    sample = teach.join(F.broadcast(share), "lang").where(place < F.col("share")).select("lang", "text", place.alias("place"))
    kept: Counter[str] = Counter()
    examples = []
    for r in sorted(sample.orderBy("place").limit(2 * train_docs * len(counts)).collect(), key=lambda r: (r.place, r.lang, r.text)):
        if kept[r.lang] < train_docs:
            kept[r.lang] += 1
            examples.append((r.text, r.lang))
    return examples


def label_documents(
    spark: SparkSession, docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", train_docs: int = TRAIN_DOCS, keep: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred and score. ``held_out`` is a
    condition over the column ``id``; rows for which it is true, and rows without a
    language, teach nothing. With ``keep`` the columns of ``docs`` come along in a struct
    ``doc``."""
    held = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    field = train(fit_sample(rows.where(~held), train_docs))
    shared = spark.sparkContext.broadcast(field)

    def run(batches):
        field = shared.value
        # its cache lives as long as the task: workers go on to other stages
        chunk = _CHUNK_CHARS * PRODUCT_LANGUAGES // max(PRODUCT_LANGUAGES, len(field.languages) if field is not None else 0)
        label = Labeller(field).label if field is not None else lambda ds: [(UNDETERMINED, 0.0)] * len(ds)

        def labelled(part, words):
            found = label(words)
            rest = [c for i, c in enumerate(part.columns) if i != 1]
            return pa.record_batch([*rest, pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())],
                                   names=[*(n for n in part.schema.names if n != "text"), "lang_pred", "score"])

        for batch in batches:
            docs_, size, begin = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                docs_.append(words_of(text))
                size += len(text or "")
                if size >= chunk:
                    yield labelled(batch.slice(begin, i + 1 - begin), docs_)
                    docs_, size, begin = [], 0, i + 1
            if docs_:
                yield labelled(batch.slice(begin), docs_)
        pa.default_memory_pool().release_unused()

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([F.struct(*docs.columns).alias("doc")] if keep else []))
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema if f.name != "text")
    found = read.mapInArrow(run, f"{out}, lang_pred string, score double")
    return found.select("id", held.alias("held_out"), "lang_pred", "score", *(["doc"] if keep else []))
