"""Merkle manifest of a dataset: a tree of digests per group, a root over the groups, a proof per row.

Leaves of a group stand in the order of a key. While a group has several nodes, every
``ARITY`` consecutive ones (the last run may have fewer, even one) become the digest of
their digests; what remains is the group's subroot. The subroots, in the order of the
groups, become the root the same way. A row's proof lists, level by level up to the root,
the siblings left and right of its path, so that ``fold`` recomputes the root from a leaf.

Time-forward processing. A node's label is (last leaf below it, level), so every node comes
after its children. Nodes are visited in label order; a priority queue keyed by the
receiver's label delivers each digest to the parent, which is complete when its label is
the smallest. A second sweep in reverse label order delivers to each node the proof suffix
above it. The queue has two parts: messages within a block of ``ARITY ** BLOCK_LEVELS`` leaves
pass through a heap of a few entries a level, and messages between blocks are rows that
Spark's external sort brings to the block's task in label order. Blocks of one group are
dealt over tasks, and each round of blocks shrinks the nodes by the block's size, so a group
of any size takes a logarithmic number of rounds and no task holds more than one block.

Defined cases: NULL groups are one group, before all others; NULL keys come first; equal
keys are ordered by leaf digest, and rows equal in both take either place (their digests
are equal); a group of one row has its leaf as subroot; an empty table gives no rows. All
columns of the caller's row are kept in the struct ``row``, whatever their names. Rows should
be narrow: keep texts out of them, a leaf digest stands for them.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmart.llm.common import stored

# Children of a node, and what stands for a NULL field.
ARITY = 8
MISSING = "-"

#: Levels of a block; 8 ** 3 leaves are swept together.
BLOCK_LEVELS = 3

PROOF_TYPE = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))
_ARROW_PROOF = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf_digest(*fields: str | Column) -> Column:
    """Digest of a row's fields: byte count, colon and value of each, or ``MISSING``."""
    parts = []
    for field in fields:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(MISSING)))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``proof`` give."""
    return F.aggregate(proof, leaf, lambda h, level: F.sha2(F.concat(level["left"], h, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of the proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


# -- sweeps over one block ---------------------------------------------------------------


def height(size: int, arity: int = ARITY) -> int:
    """Levels above ``size`` nodes until one is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // arity), levels + 1
    return levels


def _label(level: int, index: int, leaves: int, arity: int) -> tuple[int, int]:
    return min((index + 1) * arity**level, leaves) - 1, level


def sweep_up(digests: list[str], levels: int, arity: int = ARITY) -> list[list[str]]:
    """Digests of all levels, the leaves' first, visited in label order."""
    found: list[list[str]] = [[] for _ in range(levels + 1)]
    queue: list[tuple[tuple[int, int], int, int, str]] = []  # receiver's label, its index, sender, digest

    def visit(level: int, index: int, digest: str) -> None:
        found[level].append(digest)
        if level < levels:
            parent = index // arity
            heapq.heappush(queue, (_label(level + 1, parent, len(digests), arity), parent, index, digest))

    for i, digest in enumerate(digests):
        visit(0, i, digest)
        while queue and queue[0][0][0] == i:
            (_, level), index = queue[0][:2]
            children = []
            while queue and queue[0][0] == (i, level):
                children.append(heapq.heappop(queue)[3])
            visit(level, index, hashlib.sha256("".join(children).encode()).hexdigest())
    return found


def sweep_down(nodes: list[list[str]], suffix: list[tuple[str, str]], arity: int = ARITY) -> list[list[tuple[str, str]]]:
    """The proof of every leaf, visited in reverse label order from the top, which has ``suffix``."""
    leaves, top = len(nodes[0]), len(nodes) - 1
    proofs: list = [None] * leaves
    queue: list = []

    def send(level: int, index: int, proof: list) -> None:
        last, _ = _label(level, index, leaves, arity)
        heapq.heappush(queue, ((-last, -level), index, proof))

    send(top, 0, suffix)
    while queue:
        (_, minus), index, proof = heapq.heappop(queue)
        level = -minus
        if level == 0:
            proofs[index] = proof
            continue
        children = nodes[level - 1][index * arity:(index + 1) * arity]
        for k in range(len(children)):
            send(level - 1, index * arity + k, [("".join(children[:k]), "".join(children[k + 1:])), *proof])
    return proofs


# -- blocks in label order ---------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (tree, block), which follow one another in the sorted stream."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, block = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("tree", "block"))
        cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if key != (tree[a], block[a]):
                if held:
                    yield pa.Table.from_batches(held)
                held, key = [], (tree[a], block[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _dealt(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes of a block together, in label order: a message to the block (no ``pos``) first."""
    block = F.coalesce(F.col("block"), F.expr(f"pos div {width}"))
    return nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _up(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """The top of each block as a node of the next round."""
    width = arity**levels

    def run(batches):
        for table in _blocks(batches):
            size = table["size"][0].as_py()
            tops = sweep_up(table["digest"].to_pylist(), min(levels, height(size, arity)), arity)[-1]
            yield pa.record_batch(
                [table["tree"].combine_chunks()[:1], table["block"].combine_chunks()[:1],
                 pa.array([-(-size // width)], pa.int64()), pa.array(tops, pa.string())],
                names=["tree", "pos", "size", "digest"])

    slim = nodes.select("tree", F.lit(None).cast("long").alias("block"), "pos", "size", "digest")
    return _dealt(slim, width).mapInArrow(run, "tree bigint, pos bigint, size bigint, digest string")


def _down(nodes: DataFrame, messages: DataFrame, arity: int, levels: int) -> DataFrame:
    """``subroot`` and ``proof`` of each node of a round, from the ``messages(tree, block, subroot,
    proof)`` to its block. All columns of ``nodes`` are kept."""
    kept = nodes.columns
    schema = T.StructType([*nodes.schema.fields, T.StructField("subroot", T.StringType()), T.StructField("proof", PROOF_TYPE)])

    def run(batches):
        for table in _blocks(batches):
            message, rows = table.slice(0, 1).to_pylist()[0], table.slice(1)
            if not rows.num_rows:  # the upper tree of an empty table
                continue
            up = sweep_up(rows["digest"].to_pylist(), min(levels, height(rows["size"][0].as_py(), arity)), arity)
            proofs = sweep_down(up, [(p["left"], p["right"]) for p in message["proof"]], arity)
            yield pa.record_batch(
                [*(rows[c].combine_chunks() for c in kept), pa.array([message["subroot"]] * len(proofs), pa.string()),
                 pa.array([[{"left": x, "right": y} for x, y in proof] for proof in proofs], _ARROW_PROOF)],
                names=schema.names)

    left = nodes.select(*kept, F.lit(None).cast("long").alias("block"))
    return _dealt(left.unionByName(messages, allowMissingColumns=True), arity**levels).mapInArrow(run, schema)


# -- rounds ------------------------------------------------------------------------------


def _grow(spark: SparkSession, nodes: DataFrame, arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every round and, from the last one, ``(tree, digest)`` of the tops.
    ``nodes`` is a table with ``tree, pos, size, digest``."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("size")).first()[0] or 0) > 1:
        rounds.append(stored(spark, _up(rounds[-1], arity, levels), "merkle-round"))
    return rounds, rounds[-1].select("tree", "digest")


def _prove(spark: SparkSession, rounds: list[DataFrame], tops: DataFrame, arity: int, levels: int) -> DataFrame:
    """From ``(tree, subroot, proof)`` of the tops, ``subroot`` and ``proof`` of every node of the
    first round: a node of a round is what its block of the round below gets its message from."""
    mail = tops.select("tree", F.lit(0).cast("long").alias("block"), "subroot", "proof")
    for nodes in rounds[-2:0:-1]:
        found = _down(nodes, mail, arity, levels)
        mail = stored(spark, found.select("tree", F.col("pos").alias("block"), "subroot", "proof"), "merkle-proofs")
    return _down(rounds[0], mail, arity, levels)


def _placed(spark: SparkSession, rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``pos``, their place in their group, and a table with one row per group
    and its ``size``. One range sort; places add up per (task, group), never per group whole."""
    spread = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order) if group or order else rows
    ranked = stored(spark, spread.withColumn("__task", F.spark_partition_id()).withColumn(
        "__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "merkle-ranked")
    parts = ranked.groupBy("__task", *group).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(spark, parts.select(
        "*", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("size")), "merkle-parts")
    both = ranked.alias("r").join(parts.alias("p"), F.expr(" AND ".join(f"r.`{c}` <=> p.`{c}`" for c in ["__task", *group])))
    placed = both.select(*[F.col(f"r.{c}") for c in rows.columns], (F.col("__at") - F.col("__first") + F.col("__before")).alias("pos"), "size")
    return placed, parts.groupBy(*group).agg(F.max("size").alias("size"))


def manifest(
    spark: SparkSession, leaves: DataFrame, group: str, key: str, leaf: str = "leaf",
    arity: int = ARITY, block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Every row of ``leaves``: its ``leaf`` digest, its other columns as struct ``row``, its group's
    ``subroot``, the ``root`` of all and its ``proof``, an array of (left, right) sibling digests
    from the leaf's level up (see ``fold``).

    ``leaf`` names the column of the row's digest (see ``leaf_digest``); groups and keys are
    ordered by Spark's ascending order, strings bytewise, NULL first."""
    rows = stored(spark, leaves.select(
        F.col(group).alias("group"), F.col(key).alias("key"), F.col(leaf).alias("digest"),
        F.monotonically_increasing_id().alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in leaves.columns if c != leaf]).alias("row")), "merkle-leaves")
    placed, groups = _placed(spark, rows, ["group"], ["key", "digest", "tie"])
    # groups in order are the leaves of the upper tree; a group's place there names its tree
    trees, _ = _placed(spark, groups.withColumnRenamed("size", "rows").withColumn("all", F.lit(0)), ["all"], ["group"])
    trees = stored(spark, trees.select(F.col("group").alias("name"), F.col("pos").alias("tree"), F.col("size").alias("trees")), "merkle-trees")
    nodes = placed.join(trees, F.col("group").eqNullSafe(F.col("name"))).select("tree", "pos", "size", "digest", "row")
    lower, subroots = _grow(spark, stored(spark, nodes, "merkle-nodes"), arity, block_levels)
    tops = subroots.join(trees, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("size"), "digest")
    upper, top = _grow(spark, stored(spark, tops, "merkle-subroots"), arity, block_levels)
    root = top.first()  # one row
    start = spark.range(1).select(
        F.col("id").alias("tree"), F.lit(None).cast("string").alias("subroot"), F.array().cast(PROOF_TYPE).alias("proof"))
    above = _prove(spark, upper, start, arity, block_levels).select(
        F.col("pos").alias("tree"), F.col("digest").alias("subroot"), "proof")
    proved = _prove(spark, lower, stored(spark, above, "merkle-above"), arity, block_levels)
    return proved.select(
        F.col("digest").alias("leaf"), "row", "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"), "proof")
