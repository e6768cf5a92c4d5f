"""Conversation prefix trie by whole-sequence collapse.

1. Turns are placed within their conversation and conversations are rebuilt.
2. A conversation's fingerprint is the exclusive-or of 64-bit hashes of (place, role, text), twice
   over with different seeds. Conversations with equal fingerprints and lengths are one weighted
   sequence; who ends there is a list of rows, never one cell.
3. Each sequence keeps the turns of one member. Running fingerprints give its prefixes; sequences
   that are a proper prefix of another go out by an anti-join, what is left are the leaves.
4. Equal prefixes are one node: weights, leaves and least members are added up per node. For sums
   over subtrees each node belongs to one of the leaves below it; its own value stands on that
   leaf's path and a running sum from the end carries it up to all nodes above. So the work is
   linear in the turns of distinct sequences, however deep or wide the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.positions import running

from .common import read_table, stored

SHARED = 100  # conversations that share the head of the first of them
HEADS = 6  # heads have fewer turns than this
# A parent with more children than this is sent to all tasks; there is at most one per so many nodes.
HOT_CHILDREN = 100_000
NODE = ["depth", "f1", "f2"]


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), role, text; null role and text are empty, null turns come first, ties go by role and text."""
    empty = F.lit("")
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), empty).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), empty).alias("text"),
    )
    first = F.col("turn").asc_nulls_first()
    return running(rows, ["conv_id"], [first, "role", "text"], [first], {"place": F.lit(1).cast("bigint")}).drop("turn")


def rebuilt(turns: DataFrame, shared: int = SHARED, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, len; their rebuilt turns: conv_id, depth, role, text).

    A conversation c takes its first h turns from c - c % ``shared`` (all that this has), h being
    crc32 of the decimal c modulo ``heads``; its own turns follow, the first h left out. The remainder has
    the sign of c. A conversation without an id has h = 0.
    """
    conv = F.col("conv_id")
    head = turns.where((conv % shared == 0) & (F.col("place") < heads))
    known = head.groupBy(conv.alias("base")).agg(F.max("place").alias("has"))
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    h = F.coalesce(F.crc32(conv.cast("string").cast("binary")) % heads, F.lit(0))
    convs = convs.select("conv_id", "own", h.alias("h"), (conv - conv % shared).alias("base")).join(known, "base", "left")
    taken = F.least("h", F.coalesce("has", F.lit(0).cast("bigint")))
    convs = stored(convs.select("conv_id", "base", "own", "h", taken.alias("taken")))
    by_id = convs.select(conv.alias("_conv"), "h", "taken")
    own = turns.join(by_id, _same("conv_id", "_conv")).where("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "role", "text")
    heads_of = convs.where("taken > 0").select("conv_id", "base", "taken")
    first = heads_of.join(head.withColumnRenamed("conv_id", "base"), "base").where("place <= taken")
    first = first.select("conv_id", F.col("place").alias("depth"), "role", "text")
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("bigint"))
    return convs.select("conv_id", length.alias("len")), first.unionByName(own)


def _sha256_of_ends(ends: DataFrame) -> DataFrame:
    """Per node digest of its sorted ids, comma-joined; a list is streamed in order, never held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({**{c: pa.array([v], pa.int64()) for c, v in zip(NODE, key)}, "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in NODE]
            change = np.any([np.diff(c) != 0 for c in columns], axis=0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            ids = batch.column("conv_id").to_pylist()
            whole = {c: [] for c in (*NODE, "ends_sha256")}
            for start, end in zip(cuts, cuts[1:]):
                found = tuple(int(c[start]) for c in columns)
                text = ",".join("" if i is None else str(i) for i in ids[start:end]).encode()
                if found == key:
                    state.update(b"," + text)
                    continue
                if state is not None:
                    for c, v in zip(whole, (*key, state.hexdigest())):
                        whole[c].append(v)
                key, state = found, hashlib.sha256(text)
            if whole["depth"]:
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) if c in NODE else pa.array(v) for c, v in whole.items()})
        if state is not None:
            yield row()

    ordered = ends.repartition(*NODE).sortWithinPartitions(*NODE, F.col("conv_id").asc_nulls_last())
    return ordered.select(*NODE, "conv_id").mapInArrow(run, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")


def _up(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node ``saved_tokens``, the sum of ``gain`` over its subtree. ``paths`` are those of the leaves."""
    gains = nodes.select(F.col("owner").alias("seq"), "depth", "gain")
    rows = paths.select("seq", *NODE).join(gains, ["seq", "depth"], "left")
    up = F.col("depth").desc()
    rows = running(rows, ["seq"], [up], [up], {"above": F.coalesce("gain", F.lit(0).cast("bigint"))})
    return rows.groupBy(*NODE).agg(F.sum("above").alias("saved_tokens"))


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    with_text: bool = True,
    rebuild: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of all conversations, rebuilt or (``rebuild=False``) as they are.

    nodes: depth, f1, f2 (its key), conv_id (least member), parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and ``with_text`` role and text of the last turn (null for the root).
    ends: depth, f1, f2, conv_id of every conversation, at the node where it ends.

    Ids are whole numbers. Null roles and texts are empty; null turns come first; turns of equal
    number go by role and text, equal ones are turns each. Turns without an id make one conversation
    whose id comes last and is empty in digests. An empty table has no node. Long texts are hashed
    whole. Columns of other names play no part.
    """
    turns = stored(turns_of(conversations, conv_id, turn, role, text))
    if rebuild:
        convs, rows = rebuilt(turns)
    else:
        convs, rows = turns.groupBy("conv_id").agg(F.max("place").alias("len")), turns.withColumnRenamed("place", "depth")
    texts = rows
    content = [F.xxhash64(F.lit(seed), "depth", "role", "text").alias(x) for seed, x in ((1, "x1"), (2, "x2"))]
    rows = stored(rows.select("conv_id", "depth", *content, F.length("text").cast("bigint").alias("chars")))
    whole = rows.groupBy(F.col("conv_id").alias("_conv")).agg(F.bit_xor("x1").alias("f1"), F.bit_xor("x2").alias("f2"))
    none = F.lit(0).cast("bigint")
    convs = convs.join(whole, _same("conv_id", "_conv"), "left").select(
        "conv_id", F.col("len").alias("depth"), F.coalesce("f1", none).alias("f1"), F.coalesce("f2", none).alias("f2")
    )
    ends = stored(convs)
    sequences = stored(
        ends.groupBy(*NODE)
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
        .withColumn("seq", F.monotonically_increasing_id())
    )
    mine = sequences.select("seq", "conv", "n", F.col("depth").alias("len"))
    paths = rows.join(mine, _same("conv_id", "conv")).select("seq", "conv", "n", "len", "depth", "x1", "x2", "chars")
    at = F.col("depth").asc()
    paths = running(paths, ["seq"], [at], [at], xors={"f1": F.col("x1"), "f2": F.col("x2")})
    above = [F.col(f).bitwiseXOR(F.col(x)).alias(p) for f, x, p in (("f1", "x1", "p1"), ("f2", "x2", "p2"))]
    paths = paths.select("seq", "conv", "n", "len", *NODE, *above, "chars")
    root = mine.select("seq", "conv", "n", "len", *[none.alias(c) for c in (*NODE, "p1", "p2", "chars")])
    paths = stored(paths.unionByName(root))
    proper = paths.where("depth < len").select(*NODE).distinct()
    leaves = stored(sequences.join(proper, NODE, "left_anti").select("seq", F.lit(1).cast("bigint").alias("leaf")))
    paths = paths.join(leaves, "seq", "left")
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.sum(F.coalesce("leaf", none)).alias("n_leaves"),
        F.min(F.when(F.col("leaf") == 1, F.col("seq"))).alias("owner"),
        *[F.first(c).alias(c) for c in ("p1", "p2", "chars")],
    )
    nodes = stored(nodes.withColumn("gain", (F.col("n_convs") - 1) * F.col("chars")))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    children = children.agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", none))
    nodes = nodes.join(_up(paths.where("leaf = 1"), nodes), NODE).join(_sha256_of_ends(ends), NODE, "left")
    nodes = stored(nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))))
    up = ["depth", "p1", "p2"]
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    hot = F.broadcast(parents.where(F.col("n_children") > HOT_CHILDREN).drop("n_children"))
    rest = parents.where(F.col("n_children") <= HOT_CHILDREN).drop("n_children")
    nodes = nodes.join(hot, up).unionByName(nodes.join(hot, up, "left_anti").join(rest, up, "left"))
    shown = [*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = nodes.select(*shown)
    if with_text:
        last = texts.select(F.col("conv_id").alias("_conv"), F.col("depth").alias("_depth"), "role", "text")
        nodes = nodes.join(last, _same("conv_id", "_conv") & (F.col("depth") == F.col("_depth")), "left").select(*shown, "role", "text")
    return nodes, ends


def query(spark, sf_dir: str) -> DataFrame:
    nodes, _ = prefix_trie(read_table(spark, sf_dir, "conversations"), with_text=False)
    return nodes.drop("f1", "f2")
