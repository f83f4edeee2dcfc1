"""Approximate nearest neighbours by inner product through an inverted multi-index.

Each vector is cut into two halves, quantised separately by k-means; a cell is a pair of
centroids. For a query, the inner product with a pair is the sum of two half products, so
pairs are traversed best first with a heap over the two sorted lists, without scoring all
of them, until the cells hold enough entries; those entries are reranked exactly.

The number of cells grows with the square root of the rows (``centroids_for``). How many
entries are enough is measured, not guessed: for ``TUNE_QUERIES`` queries the exact
neighbours among all rows are found in blocks, and the budget is the number of entries at
which the traversal has covered ``RECALL`` of them, at least ``k`` besides the query's own.

On Spark: the codebooks (fitted on some ``2 * FIT_ROWS`` rows at most) and the cell sizes are
small and bounded. Cells are grouped, and large ones split, into blocks of about ``BLOCK_ROWS``
rows. Queries are sent to the blocks of their cells with the list of these; a block asked by
many queries is replicated once per ``GROUP_QUERIES`` of them. A task holds one block, sorted
by cell, and streams its queries past it; queries of one nearest cell are scored together
with the rows of the cells they want. The best ``k`` of each block are merged per query.

Rows with a NULL id, and vectors that are NULL, empty, zero, hold NULL or non-finite
components or are not of the table's most common length, take no part. Rows that repeat an
id are entries each; a query sees no row with its own id. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmart.llm.common import hash_share, stored

FIT_ROWS = 20_000
CENTROIDS = 1024
TUNE_QUERIES = 128
RECALL = 0.96
BLOCK_ROWS = 8192
GROUP_QUERIES = 1024
_STEP = 256


def centroids_for(rows: int, limit: int = CENTROIDS) -> int:
    """Centroids of a half, so that there are some 4 * sqrt(rows) cells; at most ``limit``, which
    7 * 10^10 rows reach (the cell sizes are on the driver)."""
    return max(2, min(limit, round(2 * rows ** 0.25)))


def kmeans(x: np.ndarray, k: int, rounds: int = 20, seed: int = 0) -> np.ndarray:
    """Lloyd's algorithm from a random start; an emptied centroid moves to the farthest row."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        d = (c * c).sum(1) - 2 * x @ c.T
        near = d.argmin(1)
        n = np.bincount(near, minlength=len(c))
        for j in np.flatnonzero(n):
            c[j] = x[near == j].mean(0)
        if not n.all():
            far = np.argsort(-d.min(1) - (x * x).sum(1))
            c[np.flatnonzero(n == 0)] = x[far[: (n == 0).sum()]]
    return c


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, budget: float):
    """Cells (i, j) in descending order of ``first[i] + second[j]``, until the cells passed
    hold ``budget`` entries; yields (i, j, entries before the cell)."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    a, b, count = a.tolist(), b.tolist(), sizes.tolist()
    heap, passed = [(-(x[0] + y[0]), 0, 0)], 0
    while heap and passed < budget:
        _, i, j = heapq.heappop(heap)
        n = count[a[i]][b[j]]
        if n:
            yield a[i], b[j], passed
            passed += n
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def _floats(column: pa.Array, kind: str) -> np.ndarray:
    """Binary vectors of one length as a matrix in double precision."""
    if not len(column):
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def best(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """(query place, id, score) of each query's ``k`` best ``rows`` whose id is not its own,
    ties to the smaller id. ``rows`` are in ascending order of ``ids``.

    The product of matrices only preselects; the score is a plain sum per pair, so that
    equal vectors have equal scores.
    """
    out = []
    for at in range(0, len(queries), _STEP):
        q, o = queries[at:at + _STEP], own[at:at + _STEP]
        s = q @ rows.T
        s[o[:, None] == ids[None, :]] = -np.inf
        if s.shape[1] > k:
            low = np.partition(s, -k, axis=1)[:, -k]
            low = low - 1e-9 * np.maximum(1, np.abs(low))
        else:
            low = np.full(len(q), -np.inf)
        r, c = np.nonzero((s >= low[:, None]) & (s > -np.inf))
        score = (q[r] * rows[c]).sum(1)
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        out.append((r[keep] + at, ids[c[keep]], score[keep]))
    return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def best_of_cells(queries: np.ndarray, own: np.ndarray, wanted: list[list[int]], rows: np.ndarray, ids: np.ndarray,
                  cells: np.ndarray, k: int):
    """``best`` over the rows of the cells ``wanted[i]`` of query i, the nearest first; ``cells`` ascends.
    Queries with the same nearest cell are scored together, ``_STEP`` at once, with the rows
    of all cells that any of them wants: one large product costs less than many small ones."""
    order = np.argsort([w[0] if w else -1 for w in wanted], kind="stable")
    found = []
    for at in range(0, len(order), _STEP):
        some = order[at:at + _STEP]
        names = np.unique([c for i in some for c in wanted[i]]).astype(cells.dtype)
        lo, hi = np.searchsorted(cells, names), np.searchsorted(cells, names, "right")
        near = slice(lo[0], hi[-1]) if len(names) and (hi - lo).sum() == hi[-1] - lo[0] else \
            np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)] or [np.zeros(0, int)])
        q, hit, score = best(queries[some], own[some], rows[near], ids[near], k)
        found.append((some[q], hit, score))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _valid(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(
        F.col("id").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda v: v != 0))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (common.n if common else 0))


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    spark: SparkSession, table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
    centroids: int | None = None, recall: float = RECALL, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best entries found for every row of
    ``table`` for which ``is_query`` (over the column ``id``) holds."""
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = _valid(table, id_col, vec_col)
    kind = "<f4" if rows.schema["vec"].dataType.elementType.typeName() == "float" else "<f8"
    width = "float" if kind == "<f4" else "double"
    rows = rows.withColumn("vec", F.col("vec").cast(f"array<{width}>"))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], schema)

    # codebooks
    step = max(1, total // FIT_ROWS)  # 1024 centroids have some 20 rows each
    fit = rows.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).limit(2 * FIT_ROWS).select("vec").toArrow().column(0)
    if not len(fit):
        fit = rows.limit(1).select("vec").toArrow().column(0)
    sample = np.array(fit.to_pylist(), np.float64)
    half = sample.shape[1] // 2
    k1 = min(centroids or centroids_for(total), max(1, len(sample) // 8))
    books = kmeans(sample[:, :half], k1, seed=1), kmeans(sample[:, half:], k1, seed=2)

    # cells
    def assign(batches):
        for batch in batches:
            v = batch.column(1)
            x = v.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(v), -1)
            d = x.astype(np.float64)
            code = [((b * b).sum(1) - 2 * part @ b.T).argmin(1) for part, b in zip((d[:, :half], d[:, half:]), books)]
            yield pa.record_batch([pa.array(code[0] * k1 + code[1], pa.int32()), batch.column(0),
                                   pa.array([r.tobytes() for r in x], pa.binary())], names=["cell", "id", "vec"])

    cells = stored(spark, rows.mapInArrow(assign, "cell int, id bigint, vec binary"), "ann-cells")
    sizes = np.zeros(k1 * k1, np.int64)
    for r in cells.groupBy("cell").count().collect():  # at most centroids squared rows
        sizes[r.cell] = r["count"]
    queries = cells.where(is_query).withColumn("query_no", F.monotonically_increasing_id())
    queries = stored(spark, queries, "ann-queries")

    # the budget, from exact neighbours of a few queries among all rows
    tune = queries.where(hash_share(4 * TUNE_QUERIES, queries.count(), "id", "query_no")).orderBy(F.xxhash64("id"), "query_no").limit(TUNE_QUERIES).collect()
    if not tune:
        return spark.createDataFrame([], schema)
    probe = _floats(pa.array([bytes(r.vec) for r in tune]), kind)
    probe_ids = np.array([r.id for r in tune])

    def exact(batches):
        for batch in batches:
            ids = batch.column(1).to_numpy()
            order = np.argsort(ids, kind="stable")
            cell = batch.column(0).to_numpy()[order]
            ids, x = ids[order], _floats(batch.column(2), kind)[order]
            q, place, score = best(probe, probe_ids, x, np.arange(len(x)) - (1 << 62), k)
            hit = ids[place + (1 << 62)]
            other = hit != probe_ids[q]
            yield pa.record_batch([pa.array(q[other], pa.int64()), pa.array(q[other], pa.int64()), pa.array(hit[other], pa.int64()),
                                   pa.array(score[other]), pa.array(cell[place + (1 << 62)][other], pa.int32())],
                                  names=["query_id", "query_no", "vec_id", "score", "cell"])

    truth = _top(cells.mapInArrow(exact, "query_id bigint, query_no bigint, vec_id bigint, score double, cell int"), k).collect()
    passed, grid = {}, sizes.reshape(k1, k1)
    for q in range(len(tune)):
        s = books[0] @ probe[q, :half], books[1] @ probe[q, half:]
        passed[q] = {i * k1 + j: n for i, j, n in traverse(*s, grid, np.inf)}
    need = sorted(passed[r.query_no][r.cell] + 1 for r in truth)
    budget = need[min(len(need) - 1, int(recall * len(need)))] if need else 1
    budget = max(budget, k + 1)  # the query itself is an entry

    # blocks: runs of cells, large cells split
    first, parts, block, held = np.zeros(k1 * k1, np.int64), np.ones(k1 * k1, np.int64), 0, 0
    for c in range(k1 * k1):
        if held and held + sizes[c] > block_rows:
            block, held = block + 1, 0
        first[c] = block
        held += sizes[c]
        if sizes[c] > block_rows:
            parts[c] = -(-int(sizes[c]) // block_rows)
            block, held = block + int(parts[c]), 0

    def place(batches):
        for batch in batches:
            c, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            yield pa.record_batch([pa.array(first[c] + spread % parts[c]), batch.column(0), batch.column(1), batch.column(2)],
                                  names=["block", "cell", "id", "vec"])

    def probe_blocks(batches):
        for batch in batches:
            x, out = _floats(batch.column(1), kind), []
            left, right = x[:, :half] @ books[0].T, x[:, half:] @ books[1].T
            for q in range(len(x)):
                wanted: dict[int, list[int]] = {}
                for i, j, _ in traverse(left[q], right[q], grid, budget):
                    c = i * k1 + j
                    for b in range(first[c], first[c] + parts[c]):
                        wanted.setdefault(b, []).append(c)
                out.append(list(wanted.items()))
            yield pa.record_batch([pa.array(out, pa.map_(pa.int64(), pa.list_(pa.int32()))), *batch.columns], names=["blocks", "id", "vec", "query_no"])

    asked = queries.select("id", "vec", "query_no").mapInArrow(
        probe_blocks, "blocks map<bigint, array<int>>, id bigint, vec binary, query_no bigint")
    asked = asked.select(F.explode("blocks").alias("block", "cells"), "id", "vec", "query_no")
    asked = stored(spark, asked, "ann-asked")
    load = asked.groupBy("block").agg(F.ceil(F.count("*") / group_queries).cast("int").alias("groups"))
    load = stored(spark, load, "ann-load")
    entries = (
        cells.mapInArrow(place, "block bigint, cell int, id bigint, vec binary").join(load, "block")
        .select("block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("kind"), "cell",
                F.lit(None).cast("array<int>").alias("cells"), "id", "vec", F.lit(0).cast("long").alias("no"))
    )
    asks = (
        asked.join(load, "block")
        .select("block", F.pmod(F.xxhash64("query_no"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("kind"),
                F.lit(0).alias("cell"), "cells", "id", "vec", F.col("query_no").alias("no"))
    )

    def score(batches):
        at, held, block = None, [], None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            a = 0
            while a < len(keys):
                b = a
                while b < len(keys) and keys[b] == keys[a]:
                    b += 1
                cut = batch.slice(a, b - a)
                if keys[a][:2] != at:
                    at, held, block = keys[a][:2], [], None
                if keys[a][2] == 0:
                    held.append((_floats(cut.column(6), kind), cut.column(5).to_numpy(), cut.column(3).to_numpy()))
                elif held:
                    if block is None:
                        block, held = tuple(map(np.concatenate, zip(*held))), held[:1]
                    own = cut.column(5).to_numpy()
                    q, hit, s = best_of_cells(_floats(cut.column(6), kind), own, cut.column(4).to_pylist(), *block, k)
                    yield pa.record_batch([pa.array(own[q]), pa.array(cut.column(7).to_numpy()[q]), pa.array(hit), pa.array(s)],
                                          names=["query_id", "query_no", "vec_id", "score"])
                a = b

    dealt = entries.unionByName(asks).repartition("block", "part").sortWithinPartitions("block", "part", "kind", "cell", "id")
    found = dealt.mapInArrow(score, "query_id bigint, query_no bigint, vec_id bigint, score double")
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
