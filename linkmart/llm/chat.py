"""Conversations as a prefix tree of turns, emitted once and depth-first.

Template: a turn is ``### <role>: <text></turn>`` and a line feed. Inside a text the
strings ``\\``, ``###`` and ``</turn>`` are escaped with a backslash, inside a role every
``\\``, ``:``, ``#`` and ``<``; both are undone exactly by ``parse_segments``.

Tree: a node is a turn after a given run of earlier turns, so conversations share the
nodes of the initial turns they have in common. A node's path is the row of its turns'
digests; in the order of paths a parent comes before its children and a subtree is one
run, so sorting by path is the depth-first order and a running sum of node lengths gives
each node's place in the token stream. The sum is taken per range of paths and then over
ranges, so a tree that most conversations share spreads over tasks.

Each node is emitted once with its token ids, its place in the stream (``start``), the
position id of its first token (the tokens of its ancestors), the stream intervals its
tokens may attend to (its ancestors and itself, causally) and the range under the loss
mask (an assistant's text).

Defined cases: NULL role or text is empty; turns are in the order of (turn, role, text),
NULL first, so repeated turn numbers are kept; rows with a NULL conversation id are one
conversation; a repeated row is a turn of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmart.llm.common import stored
from linkmart.llm.packing import encoder

HEAD, MID, TAIL = "### ", ": ", "</turn>\n"
_LEVEL = 24  # hex digits of a turn's digest in a path


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"(\\|###|</turn>)", r"\\$1")


def escape_role(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\:#<])", r"\\$1")


def parse_segments(df: DataFrame, segment: str) -> DataFrame:
    """Add ``role`` and ``text``, unescaped, of the formatted turn in column ``segment``."""
    role = F.regexp_extract(segment, r"(?s)^### ([^\\:]*+(?:\\.[^\\:]*+)*+): ", 1)
    body = F.expr(f"substring({segment}, {len(HEAD) + len(MID) + 1} + length(__role), length({segment}) - length(__role) - {len(HEAD + MID + TAIL)})")
    return df.withColumn("__role", role).withColumn("__text", body).withColumns({
        "role": F.regexp_replace("__role", r"(?s)\\(.)", "$1"),
        "text": F.regexp_replace("__text", r"\\(\\|###|</turn>)", "$1"),
    }).drop("__role", "__text")


def _tokenised(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Adds ids, n_tokens and the loss range; header, text and end are encoded apart, so
    the mask falls on token bounds."""

    def run(batches):
        encode, short = encoder(tokenizer), {}

        def ids_of(s: str) -> bytes:
            if s not in short:
                if len(short) > 10_000:
                    short.clear()
                short[s] = encode([s])[0]
            return short[s]

        for batch in batches:
            head = [ids_of(s) for s in batch.column(batch.schema.get_field_index("header")).to_pylist()]
            text = encode(batch.column(batch.schema.get_field_index("body")).to_pylist())
            tail = ids_of(TAIL)
            loss = batch.column(batch.schema.get_field_index("assistant")).to_pylist()
            n = lambda xs: np.fromiter(map(len, xs), np.int64, len(xs)) // 4
            extra = [
                pa.array([h + t + tail for h, t in zip(head, text)], pa.binary()),
                pa.array(n(head) + n(text) + len(tail) // 4),
                pa.array(n(head)),
                pa.array(np.where(loss, n(text), 0)),
            ]
            yield pa.record_batch([*batch.columns, *extra], names=[*batch.schema.names, "ids", "n_tokens", "loss_start", "loss_tokens"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema)
    return turns.mapInArrow(run, f"{schema}, ids binary, n_tokens bigint, loss_start bigint, loss_tokens bigint")


def prefix_tree(
    spark: SparkSession, turns: DataFrame, tokenizer: str,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(nodes, members).

    nodes: path, depth, start, n_tokens, position, attention (array of [start, stop) in the
    stream, root first, the node itself last), ids (little-endian uint32), loss_start and
    loss_tokens (within the node); sorted depth-first within and across files.
    members: conv, turn_no (from 1), start: the nodes of each conversation in order.
    """
    t = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    t = t.select("conv", "turn", "role", "text", F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(MID)).alias("header"),
                 escape_text(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("assistant"))
    t = t.withColumn("digest", F.substring(F.sha2(F.concat("header", F.lit("\0"), "body"), 256), 1, _LEVEL))
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    t = t.select("conv", "header", "body", "assistant", F.row_number().over(order).alias("turn_no"),
                 F.array_join(F.collect_list("digest").over(order.rowsBetween(Window.unboundedPreceding, 0)), "").alias("path"))
    t = stored(spark, t, "chat-turns")

    same = lambda c: F.first(c).alias(c)  # noqa: E731  equal for all rows of a path
    nodes = t.groupBy("path").agg(*map(same, ("header", "body", "assistant")))
    nodes = _tokenised(nodes, tokenizer).drop("header", "body", "assistant")
    nodes = nodes.repartitionByRange("path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id())
    nodes = stored(spark, nodes, "chat-nodes")
    base = nodes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per partition
    base = base.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("path")) - F.col("n_tokens")
    places = stored(spark, nodes.select("path", "part", "n_tokens", inside.alias("at")).join(base, "part")
                    .select("path", "n_tokens", (F.col("base") + F.col("at")).alias("start")), "chat-places")

    by_turn = Window.partitionBy("conv").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, 0)
    members = t.select("conv", "turn_no", "path").join(places, "path").select(
        "conv", "turn_no", "path", "start",
        (F.sum("n_tokens").over(by_turn) - F.col("n_tokens")).alias("position"),
        F.collect_list(F.struct(F.col("start"), (F.col("start") + F.col("n_tokens")).alias("stop"))).over(by_turn).alias("attention"),
    )
    members = stored(spark, members, "chat-members")
    seen = members.groupBy("path").agg(F.max(F.struct("start", "position", "attention")).alias("x")).select("path", "x.*")
    out = nodes.drop("part").join(seen, "path").withColumn("depth", F.size("attention"))
    out = stored(spark, out.repartitionByRange("start").sortWithinPartitions("start"), "chat-tree")
    return out, members.select("conv", "turn_no", "start")


def read_back(nodes: DataFrame, members: DataFrame, tokenizer: str) -> DataFrame:
    """(conv, turn_no, segment, loss): each turn's formatted text and the text under the
    loss mask, decoded from the emitted ids. Every node is decoded once."""

    def run(batches):
        tk = encoder(tokenizer).tokenizer
        decode = lambda xs: tk.decode_batch([x.tolist() for x in xs], skip_special_tokens=False)
        for batch in batches:
            ids = [np.frombuffer(x, "<u4") for x in batch.column(1).to_pylist()]
            loss = [x[a:a + n] for x, a, n in zip(ids, batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(decode(ids), pa.string()), pa.array(decode(loss), pa.string())], names=["start", "segment", "loss"])

    text = nodes.select("start", "ids", "loss_start", "loss_tokens").mapInArrow(run, "start bigint, segment string, loss string")
    return members.join(text, "start").select("conv", "turn_no", "segment", "loss")


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation of ``read_back``: n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars, all of what was read."""
    t = parse_segments(turns, "segment")
    t = t.withColumn("loss", F.regexp_replace("loss", r"\\(\\|###|</turn>)", "$1"))
    row = F.struct("turn_no", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "loss")
    g = t.groupBy("conv").agg(
        F.count("*").alias("n_turns"), F.sum(F.char_length("segment")).alias("formatted_chars"),
        F.sum(F.char_length("loss")).alias("loss_chars"), F.sort_array(F.collect_list(row)).alias("rows"))
    joined = lambda c: F.sha2(F.array_join(F.transform("rows", lambda r: r[c]), "").cast("binary"), 256)
    return g.select("conv", "n_turns", joined("turn").alias("turns_sha256"), "loss_chars",
                    joined("loss").alias("loss_sha256"), "formatted_chars")
