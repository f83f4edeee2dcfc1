import numpy as np
import pytest
from pyspark.sql import functions as F

from linkmart.llm import ann as A


def test_traverse_is_in_descending_order_and_complete():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=7), rng.normal(size=5)
    sizes = rng.integers(0, 4, (7, 5))
    cells = list(A.traverse(x, y, sizes, np.inf))
    scores = [x[i] + y[j] for i, j, _ in cells]
    assert scores == sorted(scores, reverse=True)
    assert {(i, j) for i, j, _ in cells} == {tuple(c) for c in np.argwhere(sizes > 0).tolist()}
    assert [n for _, _, n in cells] == np.cumsum([0, *[sizes[i, j] for i, j, _ in cells]])[:-1].tolist()


def brute(rows, is_query, k):
    out = {}
    for q, v in rows:
        if is_query(q):
            c = sorted((-float((np.float64(v) * np.float64(w)).sum()), i) for i, w in rows if i != q)
            out[q] = [(i, -s) for s, i in c[:k]]
    return out


def run(spark, rows, is_query, kind="float", **kw):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    got = {}
    for r in sorted(A.nearest(spark, df, is_query, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("kind,groups", [("float", 1024), ("double", 3)])
def test_recall_and_exact_scores(spark, kind, groups):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16))
    x = (centres[rng.integers(0, 8, 1500)] + 0.5 * rng.normal(size=(1500, 16))).astype(np.float32)
    x[100:300] = x[100]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = run(spark, rows, F.col("id") % 20 == 0, kind, k=10, block_rows=100, group_queries=groups)
    want = brute(rows, lambda i: i % 20 == 0, 10)
    assert set(got) == set(want)
    hit = 0
    for q, w in want.items():
        assert len(got[q]) == 10
        hit += len({i for i, _ in got[q]} & {i for i, _ in w})
        true = {i: s for i, s in brute([r for r in rows if r[0] == q or r[0] in dict(got[q])], lambda i, q=q: i == q, 10)[q]}
        assert all(abs(s - true[i]) < 1e-9 for i, s in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
    assert hit >= 0.95 * 10 * len(want)


def test_queries_are_scored_with_the_cells_they_want(monkeypatch):
    rng = np.random.default_rng(5)
    x, cells = rng.normal(size=(40, 4)), np.sort(rng.integers(0, 6, 40))
    ids, wanted = np.arange(40), [[0, 3], [5], [], [2, 1, 4, 9]]
    monkeypatch.setattr(A, "_STEP", 1)  # no query shares its rows
    q, hit, score = A.best_of_cells(x[:4], ids[:4], wanted, x, ids, cells, 5)
    for i, w in enumerate(wanted):
        seen = [j for j in range(40) if cells[j] in w and j != i]
        best = sorted(seen, key=lambda j: (-(x[i] * x[j]).sum(), j))[:5]
        assert hit[q == i].tolist() == best and np.allclose(score[q == i], [(x[i] * x[j]).sum() for j in best])
    monkeypatch.setattr(A, "_STEP", 4)
    q, hit, _ = A.best_of_cells(x[:4], ids[:4], wanted, x, ids, cells, 5)
    assert all(hit[q == i].tolist() == sorted((j for j in range(40) if j != i), key=lambda j: (-(x[i] * x[j]).sum(), j))[:5] for i in range(4))


def test_every_query_gets_k_rows_where_one_cell_holds_few(spark):
    # tight pairs: two rows have nearly all of a query's product, the rest are far behind
    rng = np.random.default_rng(6)
    base = rng.normal(size=(200, 8))
    x = np.concatenate([base, base + 1e-3])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = run(spark, rows, F.col("id") % 20 == 0, "double", k=20, recall=0.0, block_rows=8)
    assert len(got) == 20 and all(len(v) == 20 for v in got.values())


def test_cells_grow_with_the_square_root_of_the_rows():
    cells = [A.centroids_for(n) ** 2 for n in (10_000, 1_000_000, 100_000_000)]
    assert 9 < cells[1] / cells[0] < 11 and 9 < cells[2] / cells[1] < 11


def test_invalid_vectors_take_no_part(spark):
    ok = [(i, [1.0, float(i)]) for i in range(6)]
    bad = [(20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
           (120, []), (140, [1.0]), (None, [1.0, 2.0])]
    got = run(spark, ok + bad, F.col("id") % 20 == 0)
    assert got == {0: [(i, 1.0) for i in range(1, 6)]}


def test_repeated_ids_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [2.0, 5.0]), (3, [2.0, 5.0]), (9, [-1.0, 1.0])]
    got = run(spark, rows, F.col("id") % 20 == 0, k=3)
    assert got == {0: [(3, 2.0)] * 4 + [(7, 2.0)] * 2}  # both rows with id 0 ask


def test_empty_tables_and_no_queries(spark):
    assert run(spark, [], F.col("id") % 20 == 0) == {}
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 1.0])], F.col("id") % 20 == 0) == {}
