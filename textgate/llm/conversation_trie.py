"""Prefix trie of conversations, rolled up in depth bands.

Two conversations share a trie node at depth d when their first d turns are equal. A node is
named by its depth and its smallest member, whose path also holds all the node's ancestors. So a
node finds its ancestors by arithmetic: it explodes to the depths above it inside its band of
fixed height, and a join on (conversation, depth) gives the nodes there. That sums up every band by
itself. The bands' roots form a trie of their own, with depths smaller by the height, and are
summed up the same way, until one band holds all. Then the completed totals of band roots go
down: each explodes to its ancestors in the band above it and adds to what they have. A node
explodes to one band's height of rows at most, and there are about 2 log(depth) rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textgate.llm.mixing import size_of
from textgate.ranking import with_position
from textgate.session import materialise

#: Levels of a band.
HEIGHT = 16
#: Turns of a conversation whose prefix keys one task computes in a row.
CHUNK = 1 << 16


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """One row per turn: conv, place (from 0, without gaps), a, b (128 bits of the SHA-256 of role and
    text), words.

    Turns are placed by turn number, null first; equal numbers by the two hashes, so repeated rows
    are turns next to each other. Null roles and texts are empty ones. Rows without a conversation
    id belong to none and are left out. Other columns are not read. Texts are hashed where they
    are read and never shuffled; places come from a range partitioning, so one conversation may
    hold most of the table.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), size_of(text_col).alias("words")) \
        .select("conv", "turn", F.xxhash64("digest").alias("a"), F.xxhash64(F.lit(1), "digest").alias("b"), "words")
    placed = materialise(with_position(rows, ["conv", "turn", "a", "b"], "at"), "turns")
    first = placed.groupBy("conv").agg(F.min("at").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("at") - F.col("first")).alias("place"), "a", "b", "words")


def _keyed(paths: DataFrame) -> DataFrame:
    """``paths`` (conv, depth, a, b, words) with the 128-bit key of each prefix and of the one before it.

    A prefix's key is the XOR of a hash per (depth, turn), which adds up over parts of a
    conversation: long ones are cut into chunks that other tasks may compute.
    """
    rows = paths.select("conv", "depth", "words", F.xxhash64("depth", "a").alias("za"), F.xxhash64("depth", "b").alias("zb"),
                        F.floor(F.col("depth") / CHUNK).alias("chunk")).repartition("conv", "chunk")
    upto = W.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"ka": F.bit_xor("za").over(upto), "kb": F.bit_xor("zb").over(upto)})
    last = W.partitionBy("conv").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    before = rows.groupBy("conv", "chunk").agg(F.bit_xor("za").alias("za"), F.bit_xor("zb").alias("zb")).select(
        "conv", "chunk", F.bit_xor("za").over(last).alias("oa"), F.bit_xor("zb").over(last).alias("ob")).filter("chunk > 0")
    key = {k: F.col(k).bitwiseXOR(F.coalesce(o, F.lit(0))) for k, o in (("ka", "oa"), ("kb", "ob"))}
    rows = rows.join(before, ["conv", "chunk"], "left").withColumns(key)
    return rows.select("conv", "depth", "words", "ka", "kb", F.col("ka").bitwiseXOR(F.col("za")).alias("pa"),
                       F.col("kb").bitwiseXOR(F.col("zb")).alias("pb"))


def _climb(values: DataFrame, paths: DataFrame, low, high, stride: int) -> DataFrame:
    """``values`` (conv, depth, leaves, saved) of nodes, added up at their ancestors in depths ``low``
    to ``high``. A path's rows are summed by depth before they meet its nodes."""
    steps = values.select("conv", F.explode(F.sequence(low, high, F.lit(stride).cast("long"))).alias("depth"), "leaves", "saved")
    steps = steps.groupBy("conv", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return steps.join(paths, ["conv", "depth"]).groupBy(F.col("owner").alias("conv"), "depth") \
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def roll_up(own: DataFrame, paths: DataFrame, deepest: int, height: int = HEIGHT) -> DataFrame:
    """Subtree sums of ``own`` (conv, depth, leaves, saved: a row per node), by bands of ``height`` levels.

    ``paths`` (conv, depth, owner) gives the node (owner, depth) that a conversation passes at a
    depth, ``deepest`` at most.
    """
    if height < 2:
        raise ValueError("a band has two levels at least")
    depth, bands, values, stride = F.col("depth"), [], own, 1
    while True:
        span = stride * height
        level = paths if stride == 1 else paths.filter(depth % stride == 0)
        band = materialise(_climb(values, level, depth - depth % span, depth, stride), "band")
        bands.append((band, level, stride))
        if span > deepest:
            break
        values, stride = band.filter(depth % span == 0), span
    whole = bands.pop()[0]
    for band, level, stride in reversed(bands):
        roots = whole.filter(depth > 0)
        hung = _climb(roots, level, depth - stride * height, depth - stride, stride)
        whole = materialise(band.unionByName(hung).groupBy("conv", "depth").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "whole")
    return whole


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (owner, depth, conv), sorted, as one row per run of a node in a batch: owner, depth, conv
    (the first), ids (joined by commas)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        owner, depth, conv = batch.columns
        new = pc.or_(pc.not_equal(owner[1:], owner[:-1]), pc.not_equal(depth[1:], depth[:-1])).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]]).astype(np.int32)
        runs = pa.ListArray.from_arrays(pa.array(starts), conv.cast(pa.string()))
        first = pa.array(starts[:-1])
        yield pa.RecordBatch.from_arrays([owner.take(first), depth.take(first), conv.take(first), pc.binary_join(runs, ",")],
                                         ["owner", "depth", "conv", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 per node of its pieces, which come sorted; one running hash is held at a time."""
    key, state, schema = None, None, None
    for batch in batches:
        schema, done = batch.schema, []
        for owner, depth, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            if key == (owner, depth):
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (owner, depth), hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield _ends(done, schema)
    if key is not None:
        yield _ends([(*key, state.hexdigest())], schema)


def _ends(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], schema.field(0).type), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows])], ["conv", "depth", "ends_sha256"])


def prefix_trie(paths: DataFrame, members: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per trie node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``paths`` has a row per turn: conv, depth (from 1, without gaps), a, b (hash of the turn), words;
    ``members`` has one per conversation (conv), also of those without a turn, which end at the
    root. saved_tokens sums (n_convs - 1) * words over the subtree: what storing each
    shared turn once saves. ends_sha256 hashes the ids of the conversations that end at the node,
    ascending, joined by commas. No member gives no node. Nodes are told apart by 128-bit hashes
    of their prefixes.

    Members of a node are only counted. Their ids are range-partitioned and joined to pieces of a
    batch's rows before a node's pieces meet in one task, which hashes them one after the other.
    """
    id_type = members.schema["conv"].dataType.simpleString()
    keyed = materialise(_keyed(paths), "prefixes")
    # a third of the conversations may pass one node: rows meet its smallest member in a join that AQE splits
    groups = materialise(keyed.groupBy("depth", "ka", "kb").agg(
        F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.max("words").alias("words")), "nodes")
    root = members.agg(F.min("conv").alias("conv"), F.lit(0).cast("long").alias("depth"), F.count("*").alias("n_convs"),
                       F.lit(0).cast("long").alias("words")).filter("n_convs > 0")
    top, n = next(((r["conv"], r["n_convs"]) for r in root.collect()), (None, 0))
    top = F.lit(top).cast(id_type)
    owned = keyed.join(groups.select("depth", "ka", "kb", "owner"), ["depth", "ka", "kb"]).select("conv", "depth", "owner")
    owned = materialise(owned.unionByName(members.select("conv", F.lit(0).cast("long").alias("depth"), top.alias("owner"))), "owners")
    nodes = groups.select(F.col("owner").alias("conv"), "depth", "n_convs", "words").unionByName(root)
    above = owned.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    nodes = materialise(nodes.join(above, ["conv", "depth"], "left"), "parents")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(children, ["conv", "depth"], "left").fillna(0, ["n_children"]), "nodes")
    own = nodes.select("conv", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    total = roll_up(own, owned, deepest, height)
    ends = owned.groupBy("conv").agg(F.max(F.struct("depth", "owner")).alias("end")).select("end.owner", "end.depth", "conv")
    by = ["owner", "depth", "conv"]
    pieces = ends.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _pieces, f"owner {id_type}, depth long, conv {id_type}, ids string")
    ends = pieces.repartition("owner", "depth").sortWithinPartitions(*by).mapInArrow(
        _hashed, f"conv {id_type}, depth long, ends_sha256 string")
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(total, ["conv", "depth"]).join(ends, ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", height: int = HEIGHT) -> DataFrame:
    """``prefix_trie`` of the conversations as they are; ``turns_of`` says how rows are read."""
    turns = materialise(turns_of(conversations, id_col, turn_col, role_col, text_col), "turns")
    paths = turns.select("conv", (F.col("place") + 1).alias("depth"), "a", "b", "words")
    return prefix_trie(paths, turns.select("conv").distinct(), height)


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(paths, members) of conversations that begin like their family's first: conversation c gets the
    first h turns of conversation c - c % ``family`` (all if it has fewer, none if it is absent) and
    its own turns after its first h; h = crc32(c as text) % ``most``."""
    sizes = turns.groupBy("conv").agg((F.max("place") + 1).alias("n"))
    convs = sizes.select("conv", (F.col("conv") - F.col("conv") % family).alias("base"),
                         (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n"))
    convs = materialise(convs.join(bases, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")), "families")
    own = turns.join(convs, "conv").filter("place >= h").select(
        "conv", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "a", "b", "words")
    heads = turns.filter(F.col("place") < most - 1).withColumnRenamed("conv", "base")
    lent = heads.join(convs, "base").filter("place < h").select("conv", (F.col("place") + 1).alias("depth"), "a", "b", "words")
    return own.unionByName(lent), convs.select("conv")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    turns = materialise(turns_of(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(*rebuilt(turns))


OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 20 AS base, count(*) AS n,
         xor(4294967295::UBIGINT, list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda r, step: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)))::BIGINT % 4 AS h
  FROM turns GROUP BY c),
family AS (
  SELECT v.c, v.base, v.h, least(v.h, coalesce(b.n, 0)) AS taken FROM convs v LEFT JOIN convs b ON b.c = v.base),
paths AS (
  SELECT f.c, f.taken + t.place - f.h + 1 AS depth, t.role, t.text FROM family f JOIN turns t ON t.c = f.c AND t.place >= f.h
  UNION ALL
  SELECT f.c, t.place + 1, t.role, t.text FROM family f JOIN turns t ON t.c = f.base AND t.place < f.h),
prefix AS (
  SELECT c, depth, string_agg(md5(length(role) || ':' || role || text), '/') OVER (PARTITION BY c ORDER BY depth) AS key,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM paths
  UNION ALL SELECT c, 0, '', 0 FROM convs),
owned AS (
  SELECT c, depth, key, words, min(c) OVER (PARTITION BY depth, key) AS owner, max(depth) OVER (PARTITION BY c) = depth AS ends
  FROM prefix),
node AS (
  SELECT owner, depth, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM owned GROUP BY owner, depth, key),
linked AS (
  SELECT n.*, p.owner AS parent FROM node n LEFT JOIN owned p ON p.c = n.owner AND p.depth = n.depth - 1),
child AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
valued AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN child k ON k.parent = l.owner AND k.depth = l.depth),
total AS (
  SELECT a.owner, a.depth, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.words)::BIGINT AS saved_tokens
  FROM valued v JOIN owned a ON a.c = v.owner AND a.depth <= v.depth GROUP BY a.owner, a.depth)
SELECT v.owner AS conv_id, v.depth::BIGINT AS depth, v.parent AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves, t.saved_tokens,
       v.ends_sha256
FROM valued v JOIN total t USING (owner, depth)
"""
