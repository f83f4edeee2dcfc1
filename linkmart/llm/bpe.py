"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier one. A minimal perfect hash over the vocabulary's byte strings resolves a pre-token that
is a vocabulary entry as a whole: a bucket's seed sends each of its keys to a slot of its own,
there are as many slots as keys, and the bytes stored in the slot are compared, so a string
outside the vocabulary is told apart.

Tier two. Any other pre-token is a doubly linked list of bytes with a heap of adjacent pairs
by (rank of the joined bytes, place); the smallest pair is joined until none is in the
vocabulary. Pairs that a join has changed are left in the heap and skipped when popped.

Encoding is a map over the documents, decoding a map over the ids: no shuffle. The vocabulary
goes to the tasks as one broadcast, whose size is that of the vocabulary file (``MAX_ENTRIES``
is checked). Pre-tokens are kept per Python worker up to ``CACHE`` entries; a long text is cut into
pre-tokens piece by piece, so beside the text itself memory holds one chunk and its ids.

Defined cases: NULL and empty texts have no ids and decode to no bytes; bytes that are not
UTF-8 count as U+FFFD; ids outside the vocabulary raise; a NULL array of ids decodes to no
bytes; repeated ids of documents stay separate rows; an empty table gives no rows. Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most entries of a vocabulary that is broadcast.
MAX_ENTRIES = 1 << 20
#: Characters of a batch that leaves a task, pre-tokens of a long text taken at once, cached pre-tokens.
CHUNK_CHARS = 1 << 20
CHUNK_PIECES = 1 << 16
CACHE = 1 << 20

_MASK = (1 << 64) - 1
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class PerfectHash:
    """Minimal perfect hash of byte strings: ``find`` gives a key's value, or -1."""

    def __init__(self, values: dict[bytes, int]):
        keys = list(values)
        n = self.n = len(keys)
        hashes = self._hashes(keys)
        buckets: dict[int, list[int]] = {}
        for k, b in enumerate((hashes % np.uint64(max(1, n))).tolist()):
            buckets.setdefault(b, []).append(k)
        self.seeds = array("q", bytes(8 * n))  # of each bucket; -1 - slot for a bucket of one key
        owner = np.full(n, -1, np.int64)
        single = []
        plain = hashes.tolist()
        for b in sorted(buckets, key=lambda b: -len(buckets[b])):
            members = buckets[b]
            if len(members) == 1:
                single.append((b, members[0]))
                continue
            seed = 1
            while True:
                slots = [self._slot(plain[k], seed) for k in members]
                if len(set(slots)) == len(slots) and all(owner[s] < 0 for s in slots):
                    break
                seed += 1
            owner[slots] = members
            self.seeds[b] = seed
        free = np.flatnonzero(owner < 0).tolist()
        for (b, k), slot in zip(single, free):
            owner[slot] = k
            self.seeds[b] = -1 - slot
        self.keys = [keys[k] for k in owner.tolist()]
        self.values = [values[key] for key in self.keys]
        self.longest = max(map(len, keys), default=0)
        self.digest = xxhash.xxh3_128_hexdigest(repr(sorted(values.items())))

    @staticmethod
    def _hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slot(self, h: int, seed: int) -> int:
        z = ((h ^ (seed * _STEP & _MASK)) * _MIX) & _MASK
        return (z ^ (z >> 32)) % self.n

    def find(self, key: bytes) -> int:
        if len(key) > self.longest or not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[h % self.n]
        slot = -1 - seed if seed < 0 else self._slot(h, seed)
        return self.values[slot] if self.keys[slot] == key else -1



def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a vocabulary file (base64 and rank a line)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if len(ranks) > MAX_ENTRIES:
        raise ValueError(f"{len(ranks)} entries; a broadcast vocabulary has at most {MAX_ENTRIES}")
    return ranks


class Ranks(dict):
    """Ranks of byte strings, -1 for others: a bounded memory over ``PerfectHash.find``."""

    def __init__(self, table: PerfectHash):
        super().__init__()
        self.find = table.find
        pairs = [-1] * (1 << 16)  # of two bytes, by their number
        for key, rank in zip(table.keys, table.values):
            if len(key) == 2:
                pairs[key[0] << 8 | key[1]] = rank
        self.pairs = pairs

    def __missing__(self, key: bytes) -> int:
        if len(self) >= CACHE // 4:
            self.clear()
        rank = self[key] = self.find(key)
        return rank


def join_bytes(piece: bytes, ranks: Ranks) -> list[int]:
    """Ranks of ``piece``, joined pair by pair, smallest rank first, leftmost of equal ones."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it was joined to the left
    before = list(range(-1, n))
    # a pair is one number: rank, start, end
    pairs, bits = ranks.pairs, n.bit_length()
    twice, mask = 2 * bits, (1 << bits) - 1
    heap = [rank << twice | i << bits | i + 2 for i, (a, b) in enumerate(zip(piece, piece[1:])) if (rank := pairs[a << 8 | b]) >= 0]
    heapify(heap)
    while heap:
        pair = heappop(heap)
        start, stop = pair >> bits & mask, pair & mask
        middle = end[start]
        if middle == 0 or middle >= stop or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        before[stop] = start
        if stop < n:
            right = end[stop]
            if (rank := ranks[piece[start:right]]) >= 0:
                heappush(heap, rank << twice | start << bits | right)
        left = before[start]
        if left >= 0 and (rank := ranks[piece[left:stop]]) >= 0:
            heappush(heap, rank << twice | left << bits | stop)
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:end[at]]])
        at = end[at]
    return out


class Pieces(dict):
    """Ids of pre-tokens: whole ones by the perfect hash, others joined from bytes. Bounded: when
    half of ``CACHE`` is known, it becomes the older half, from which what is met again comes back."""

    def __init__(self, table: PerfectHash):
        super().__init__()
        self.find, self.ranks, self.older = table.find, Ranks(table), {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            rank = self.find(data)
            ids = (rank,) if rank >= 0 else tuple(join_bytes(data, self.ranks))
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for texts of the first 256 code points only, with their classes written out,
    which the plainer ``re`` matches faster; None if it holds a class that cannot be."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        found = re.compile(r"\\p\{\w+\}|\\[sS]|\\.|.", re.S).match(pattern, at)
        token, at = found.group(), found.end()
        if re.match(r"\\[sS]|\\p", token):
            members = "".join(map(re.escape, filter(regex.compile(token.replace("S", "s")).match, map(chr, range(256)))))
            if token == r"\S" and inside:
                return None
            token = members if inside else f"[{'^' if token == chr(92) + 'S' else ''}{members}]"
        elif re.match(r"\\[a-zA-Z]", token) or token == ".":
            return None
        elif token in "[]":
            inside = token == "["
        out.append(token)
    return re.compile("".join(out))


class Encoder:
    """Texts to ids with one vocabulary and one pre-token pattern."""

    def __init__(self, table: PerfectHash, pattern: str):
        self.known, self.pattern = Pieces(table), regex.compile(pattern)
        self.latin = latin_pattern(pattern) or self.pattern

    def _matcher(self, text: str):
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern
        return self.latin

    def encode(self, text: str) -> array:
        matcher = self._matcher(text)
        if len(text) <= CHUNK_CHARS:
            return array("i", chain.from_iterable(map(self.known.__getitem__, matcher.findall(text))))
        ids, found = array("i"), (m.group() for m in matcher.finditer(text))
        while chunk := list(islice(found, CHUNK_PIECES)):
            ids.extend(chain.from_iterable(map(self.known.__getitem__, chunk)))
        return ids


#: The encoder that this Python worker used last, with its vocabulary and pattern: later tasks find
#: its pre-tokens known.
_last: list = []


def _encoder(table, pattern: str) -> Encoder:
    key = (table.value.digest, pattern)
    if not _last or _last[0] != key:
        _last[:] = [key, Encoder(table.value, pattern)]
    return _last[1]


# -- the operators -----------------------------------------------------------------------


def encode_texts(
    spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id`` and ``ids``, an array of the vocabulary's ranks, of every whole text. ``pattern``'s
    matches are encoded each on its own; special tokens are ordinary text."""
    table = spark.sparkContext.broadcast(PerfectHash(load_ranks(ranks_path)))

    def run(batches):
        encoder = _encoder(table, pattern)

        def rows(ids, texts):
            found = [encoder.encode(text) for text in texts]
            ends = np.cumsum([0, *map(len, found)])
            values = np.concatenate([np.frombuffer(f, np.int32) for f in found])
            return pa.record_batch([ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))], names=["id", "ids"])

        gc.disable()  # many small tuples and no cycles: collecting would walk the known pre-tokens
        try:
            for batch in batches:
                start, texts, held = 0, [], 0
                for at, text in enumerate(batch.column(1)):
                    texts.append(text.as_py())
                    held += len(texts[-1])
                    if held >= CHUNK_CHARS // 2:
                        yield rows(batch.column(0).slice(start, len(texts)), texts)
                        start, texts, held = at + 1, [], 0
                if texts:
                    yield rows(batch.column(0).slice(start, len(texts)), texts)
        finally:
            gc.enable()

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    text = F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(run, schema)


def decode_ids(spark: SparkSession, encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``, the bytes of its array of ids (a column of that name is replaced)."""
    ranks = load_ranks(ranks_path)
    words = [None] * (max(ranks.values(), default=-1) + 1)
    for word, rank in ranks.items():
        words[rank] = word
    table = spark.sparkContext.broadcast(words)
    kept = [f for f in encoded.schema.fields if f.name != out_col]
    schema = T.StructType([*kept, T.StructField(out_col, T.BinaryType())])
    place = [f.name for f in kept].index(ids_col)

    def run(batches):
        word = table.value

        for batch in batches:
            range_ = pc.min_max(batch.column(place).flatten()).as_py()
            if range_["min"] is not None and not 0 <= range_["min"] <= range_["max"] < len(word):
                raise ValueError("an id is outside the vocabulary")
            start, out, held = 0, [], 0
            for at, ids in enumerate(batch.column(place)):
                out.append(b"".join(map(word.__getitem__, ids.values.to_pylist())) if ids.is_valid else b"")
                held += len(out[-1])
                if held >= CHUNK_CHARS or at == batch.num_rows - 1:
                    part = batch.slice(start, len(out))
                    yield pa.record_batch([*part.columns, pa.array(out, pa.binary())], names=schema.names)
                    start, out, held = at + 1, [], 0

    return encoded.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
