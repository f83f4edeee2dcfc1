"""Merkle manifest against a plain tree: sweeps, rounds of blocks, proofs, tampering."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from linkmart.llm.merkle import fold, height, leaf_digest, manifest, proof_digest, sweep_down, sweep_up


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][i:i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def _siblings(levels, i, arity):
    out = []
    for level in levels[:-1]:
        run = level[i - i % arity:i - i % arity + arity]
        out.append(("".join(run[:i % arity]), "".join(run[i % arity + 1:])))
        i //= arity
    return out


def _brute(rows, arity):
    """``rows`` of (group, key, leaf) -> Counter-able list of (group, key, leaf, subroot, root, proof)."""
    first = lambda v: (v is not None, v)
    groups = {}
    for g, k, leaf in sorted(rows, key=lambda r: (first(r[0]), first(r[1]), r[2])):
        groups.setdefault(g, []).append((k, leaf))
    trees = {g: _levels([leaf for _, leaf in members], arity) for g, members in groups.items()}
    upper = _levels([t[-1][0] for t in trees.values()], arity)
    out = []
    for n, (g, members) in enumerate(groups.items()):
        for i, (k, leaf) in enumerate(members):
            proof = _siblings(trees[g], i, arity) + _siblings(upper, n, arity)
            out.append((g, k, leaf, trees[g][-1][0], upper[-1][0], tuple(proof)))
    return sorted(out, key=repr)


def _rows(df):
    return sorted(((r["row"]["lang"], r["row"]["doc_id"], r["leaf"], r["subroot"], r["root"],
                    tuple((p["left"], p["right"]) for p in r["proof"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100])
def test_sweeps_give_the_plain_tree(n):
    leaves = [_h(str(i)) for i in range(n)]
    levels = sweep_up(leaves, height(n))
    assert levels == _levels(leaves, 8)
    assert sweep_down(levels, [("a", "b")]) == [_siblings(levels, i, 8) + [("a", "b")] for i in range(n)]


@pytest.mark.parametrize("arity,block_levels", [(8, 3), (2, 1), (3, 2)])
def test_equal_to_the_plain_tree_over_any_blocks(spark, arity, block_levels):
    rnd = random.Random(arity)
    rows = [("en", i) for i in range(130)] + [(None, i) for i in range(5)] + [("é", i) for i in range(17)] + [("z", 3)]
    rows += [("en", 7), ("en", 7), ("en", None), ("en", None), (None, None), ("\U0001f600", 1), ("￿", 1), ("", 2)]
    rows = [(g, k, _h(f"{g}{k}{i % 3}")) for i, (g, k) in enumerate(rows)]
    rows += rows[:9]  # repeated rows
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").repartition(5)
    got = _rows(manifest(spark, frame, "lang", "doc_id", arity=arity, block_levels=block_levels))
    assert got == _brute(rows, arity)


def test_folding_shows_what_was_changed(spark):
    rows = [("a" if i % 3 else "b", i, _h(str(i))) for i in range(600)]
    frame = spark.createDataFrame(rows, "lang string, doc_id long, leaf string")
    found = manifest(spark, frame, "lang", "doc_id", block_levels=1).select(
        "row.doc_id", "root", fold(F.col("leaf"), F.col("proof")).alias("same"),
        fold(F.sha2(F.lit("other"), 256), F.col("proof")).alias("other"), proof_digest(F.col("proof")).alias("d"), "proof")
    for r in found.collect():
        assert r["same"] == r["root"] != r["other"]
        assert r["d"] == _h("".join(p["left"] + p["right"] for p in r["proof"]))


def test_leaves_tell_null_from_empty_and_fields_apart(spark):
    rows = [(1, None, "é"), (1, "", "é"), (1, "-", "é"), (11, "a", "b"), (1, "1a", "b")]
    got = [r[0] for r in spark.createDataFrame(rows, "a long, b string, c string").select(leaf_digest("a", "b", "c")).collect()]
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    assert got == [_h("".join(map(part, r))) for r in rows] and len(set(got)) == 5


def test_empty_single_and_clashing_columns(spark):
    names = "row int, proof string, root string, tree long, block int, pos int, size int, digest string, `group` int, `key` int, tie int, subroot int, all int, `__task` int"
    one = spark.createDataFrame([("x", 1, "f", *[None] * 14)], f"lang string, doc_id long, leaf string, {names}")
    (r,) = manifest(spark, one, "lang", "doc_id").collect()
    assert (r["leaf"], r["subroot"], r["root"], r["proof"]) == ("f", "f", "f", []) and len(r["row"]) == 16
    assert manifest(spark, one.limit(0), "lang", "doc_id").count() == 0


def test_a_hot_group_is_dealt_in_blocks(spark):
    """One group has all rows: no task of a sweep sees more than a few blocks of them."""
    from linkmart.llm import merkle

    frame = spark.range(20_000).select(F.lit("x").alias("lang"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    nodes = frame.select(F.lit(0).cast("long").alias("tree"), F.col("doc_id").alias("pos"), F.lit(None).cast("long").alias("block"))
    sizes = merkle._dealt(nodes, 512).groupBy(F.spark_partition_id(), "block").count().collect()
    assert len(sizes) == 40 and max(r["count"] for r in sizes) == 512
    out = manifest(spark, frame, "lang", "doc_id").select(F.size("proof").alias("n"), (fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert [tuple(r) for r in out.distinct().collect()] == [(5, True)]
