"""Packing documents into token windows by non-negative least squares.

A document is its token ids and an end id. Whole windows are cut from its front; what is
left (shorter than a window) is packed. Per block of documents:

1. count the histogram of the rest lengths;
2. enumerate the shallow combinations: pairs and triples of present lengths that fill the
   window exactly;
3. solve ``min |A x - histogram|, x >= 0`` for their repeat counts. Combinations enter
   by their gradient, as in the active-set method, a disjoint group at a time, so the
   solution stays sparse; projected gradient steps solve on the active ones;
4. round the counts, taking no more pieces than there are;
5. pack what remains greedily, largest piece that fits first; where nothing fits and more
   than ``MAX_GAP`` tokens are free, a piece is cut to fill them.

A block is ``BLOCK_TOKENS`` tokens of one input partition, so there is no shuffle, no
gathered group and nothing on the driver: every block's sequences are complete, and only
its last one can be short. Sequence numbers are (partition, count).
"""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
END_ID = 0
BLOCK_TOKENS = 8_000_000
MAX_GAP = 16
CACHE_UNITS = 600_000
_CHUNK_CHARS = 300_000
_OUT_ROWS = 4000
_LINE_UNITS = 1000

# -- token ids ---------------------------------------------------------------------------

#: Where single spaces alone separate the units of a text, byte-level pre-tokenisation
#: starts a new piece at each of them, so units encode on their own.
_WIDE = re.compile(r" \s")


def _plain(text: str) -> bool:
    return bool(text) and not (text[0].isspace() or text[-1].isspace() or _WIDE.search(text))


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, through a bounded cache of
    space-separated units (most words recur)."""

    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are text
        self.limit, self.cache = cache_units, {}
        self.after_space = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.after_space[i] = token.startswith("\u0120")  # the byte-level sign of a space

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.frombuffer(array("I", e.ids), "<u4") for e in found]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit after a space: encoded in lines, cut where a token holds a space."""
        out = []
        lines = [" " + " ".join(units[i:i + _LINE_UNITS]) for i in range(0, len(units), _LINE_UNITS)]
        for ids in self._encode(lines):
            raw = ids.tobytes()
            cuts = [*(4 * np.flatnonzero(self.after_space[ids])).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        get = self.cache.get
        whole, split, new = [], [], {}
        for text in texts:
            if _plain(text):
                units = text.split(" ")
                whole.append(units[0])
                del units[0]
                found = list(map(get, units))
                if None in found:
                    new.update((u, None) for u, x in zip(units, found) if x is None)
                split.append((units, found))
            else:
                whole.append(text)
                split.append(None)
        fresh = dict(zip(new, self._encode_units(list(new))))
        out = []
        for start, parts in zip(self._encode(whole), split):
            start = start.tobytes()
            if parts is None:
                out.append(start)
            else:
                if None in parts[1]:
                    start += b"".join([fresh[u] if x is None else x for u, x in zip(*parts)])
                else:
                    start += b"".join(parts[1])
                out.append(start)
        room = self.limit - len(self.cache)
        self.cache.update(fresh if len(fresh) <= room else islice(fresh.items(), max(0, room)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# -- the plan of a block -----------------------------------------------------------------


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """(n, 3) lengths a <= b <= c, all present or a = 0 (a pair), that sum to the window."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    found = []
    for a in [0, *present[present <= window // 3].tolist()]:
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        b = b[has[b] & has[window - a - b]]
        found.append(np.column_stack([np.full(len(b), a), b, window - a - b]))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def _solve(columns: np.ndarray, counts: np.ndarray, x: np.ndarray, steps: int) -> np.ndarray:
    """Accelerated projected gradient for min |A x - counts|^2, x >= 0 (length 0 weighs none)."""
    size = len(counts)
    weight = (columns > 0).astype(float)

    def product(v):
        out = np.bincount(columns.ravel(), (weight * v[:, None]).ravel(), size)
        out[0] = 0
        return out

    v = np.ones(len(x))
    for _ in range(8):  # largest eigenvalue of A'A, for the step
        v = (product(v)[columns] * weight).sum(1)
        norm = np.linalg.norm(v) or 1.0
        v /= norm
    y, t = x, 1.0
    for _ in range(steps):
        grad = ((product(y) - counts)[columns] * weight).sum(1)
        nxt = np.maximum(0, y - grad / (1.05 * norm))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = nxt + (t - 1) / t2 * (nxt - x), nxt, t2
    return x


def repeat_counts(hist: np.ndarray, window: int = WINDOW, rounds: int = 8, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Combinations and their rounded repeat counts for ``hist[length]``; together they use
    no length more often than it occurs."""
    present = np.flatnonzero(hist[:window])
    combos = combinations(present[present > 0], window)
    counts = hist[: window + 1].astype(float)
    counts[0] = 0
    chosen = np.flatnonzero(combos[:, 0] == 0)
    x = np.zeros(len(chosen))
    for _ in range(rounds):
        if len(chosen):
            x = _solve(combos[chosen], counts, x, steps)
        left = counts - np.bincount(combos[chosen].ravel(), np.repeat(x, 3), len(counts))
        left[0] = 0
        gain = left[combos].sum(1)
        gain[chosen] = 0
        used, more = np.zeros(len(counts), bool), []
        for j in np.argsort(-gain, kind="stable")[:4000].tolist():
            lengths = combos[j][combos[j] > 0]
            if gain[j] < 0.5:
                break
            if not used[lengths].any():
                used[lengths] = True
                more.append(j)
        if not more:
            break
        chosen = np.concatenate([chosen, np.array(more, int)])
        x = np.concatenate([x, np.zeros(len(more))])
    free, times = hist[: window + 1].astype(int), np.zeros(len(chosen), int)
    for k in np.argsort(-x, kind="stable").tolist():
        want = int(x[k] + 0.5)
        if not want:
            break
        lengths, need = np.unique(combos[chosen[k]][combos[chosen[k]] > 0], return_counts=True)
        times[k] = max(0, min(want, int((free[lengths] // need).min())))
        free[lengths] -= need * times[k]
    keep = times > 0
    return combos[chosen[keep]], times[keep]


def plan_block(lengths: list[int], window: int = WINDOW, max_gap: int = MAX_GAP) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) for one block of documents."""
    out, rest = [], defaultdict(list)
    for d, n in enumerate(lengths):
        full = n - n % window
        out += [[(d, s, window)] for s in range(0, full, window)]
        if n % window:
            rest[n - full].append((d, full))
    hist = np.zeros(window + 1, np.int64)
    for n, pieces in rest.items():
        hist[n] = len(pieces)
    for combo, times in zip(*(a.tolist() for a in repeat_counts(hist, window))):
        for _ in range(times):
            out.append([(*rest[n].pop(), n) for n in reversed(combo) if n])
    left = np.array([len(rest[n]) if n in rest else 0 for n in range(window + 1)])
    while left.any():
        gap, sequence = window, []
        while gap and left.any():
            fits = np.flatnonzero(left[: gap + 1])
            if len(fits):
                n = int(fits[-1])
                sequence.append((*rest[n].pop(), n))
                left[n] -= 1
                gap -= n
            elif gap > max_gap:
                n = int(np.flatnonzero(left)[-1])
                d, s = rest[n].pop()
                sequence.append((d, s, gap))
                rest[n - gap].append((d, s + gap))
                left[n] -= 1
                left[n - gap] += 1
                gap = 0
            else:
                break
        out.append(sequence)
    return out


# -- the operator ------------------------------------------------------------------------


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, max_gap: int = MAX_GAP,
) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset and the piece's
    ``ids`` (little-endian uint32 bytes). NULL and empty texts are the end id alone; rows
    that repeat an id are packed each on their own."""
    names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def block_rows(ids, tokens, first):
        sequences = plan_block([len(t) // 4 for t in tokens], window, max_gap)
        rows = []
        for k, sequence in enumerate(sequences):
            at = 0
            for d, start, n in sequence:
                rows.append((ids[d], start, n, len(tokens[d]) // 4, first + k, at, tokens[d][4 * start:4 * (start + n)]))
                at += n
        for i in range(0, len(rows), _OUT_ROWS):
            cols = list(zip(*rows[i:i + _OUT_ROWS]))
            yield pa.record_batch([pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:6]), pa.array(cols[6], pa.binary())], names=names)
        return len(sequences)

    def run(batches):
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 33
        ids, tokens, held, texts, waiting = [], [], 0, [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                texts.append(text.as_py())
                waiting += len(texts[-1])
                if waiting >= _CHUNK_CHARS:
                    fresh = [t + end for t in encode(texts)]
                    tokens += fresh
                    held += sum(map(len, fresh)) // 4
                    texts, waiting = [], 0
                    if held >= block_tokens:
                        first += yield from block_rows(ids, tokens, first)
                        ids, tokens, held = [], [], 0
        if ids:
            tokens += [t + end for t in encode(texts)] if texts else []
            yield from block_rows(ids, tokens, first)

    kind = docs.schema[id_col].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    longs = ", ".join(f"{n} bigint" for n in names[1:6])
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .mapInArrow(run, f"id {kind}, {longs}, ids binary")
