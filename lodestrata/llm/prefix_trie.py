"""Operator 13: trie of conversation prefixes, its subtree sums by heavy-path decomposition."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import large_keys, running
from ..sources.shared import store

SPAN = 16  # bits of the ids that a piece of joined ids may cover: 2^16 ids, about a megabyte
NODE = ["depth", "k1", "k2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, content, words) of conversations (conv_id, turn, role, text): content is the SHA-256 of role and text (nulls
    count as empty), words the count of ``[^\\x20\\x09-\\x0D]+`` in the text. Rows without conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    return conversations.where("conv_id is not null").select("conv_id", "turn", content.alias("content"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def with_shared_start(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt on the start of their group's first one: conversation c gets the first h turns of conversation
    c - c % group (all, if it has fewer; none, if it is absent), then its own turns after its first h; h = crc32(c) % most.
    Turns are ordered by turn, nulls first, ties by content. Returns (conv_id, depth, content, words, last): the turns at
    depths from 1, and one row at depth 0 for each conversation, those left without turns included."""
    turns = store(turns)
    large = large_keys(turns, ["conv_id"])
    rows = running(turns.withColumn("one", F.lit(1).cast("long")), ["conv_id"], ["turn", "content"], {"pos": ("sum", "one")}, large=large)
    rows = store(rows.select("conv_id", "pos", "content", "words"))
    start = rows.where((F.col("conv_id") % group == 0) & (F.col("pos") < most)).groupBy(F.col("conv_id").alias("base"))
    start = start.agg(F.array_sort(F.collect_list(F.struct("pos", "content", "words"))).alias("start"))  # fewer than ``most`` turns
    n = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    plan = n.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}).join(start, "base", "left")
    plan = plan.withColumn("given", F.slice(F.coalesce("start", F.array()), 1, F.col("h").cast("int"))).drop("start")
    plan = store(plan.withColumn("turns", F.size("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    last = (F.col("depth") == F.col("turns")).alias("last")
    own = rows.join(plan.select("conv_id", "h", "turns", F.size("given").alias("take")), "conv_id").where("pos > h").withColumn("depth", F.col("take") + F.col("pos") - F.col("h"))
    none = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("content"), F.lit(0).cast("long").alias("words"))
    given = plan.select("conv_id", "turns", F.explode(F.concat(F.array(none), "given")).alias("t")).select("conv_id", "turns", F.col("t.pos").alias("depth"), "t.content", "t.words")
    return own.select("conv_id", "depth", "content", "words", last).union(given.select("conv_id", "depth", "content", "words", last))


def _digests(batches):
    """SHA-256 of each node's ids, whose pieces arrive in order; one piece is held at a time."""
    key, state = None, None

    def rows(done):
        cols = list(zip(*done, strict=True))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3])], [*NODE, "ends_sha256"])

    for b in batches:
        done = []
        for *node, text in zip(*[b.column(c).to_pylist() for c in (*NODE, "text")], strict=True):
            if node != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield rows(done)
    if key is not None:
        yield rows([(*key, state.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): SHA-256 of the node's ids in ascending order, joined by commas. A node's ids are
    joined in pieces of at most 2^16 ids each, in parallel; one task then feeds the pieces to the digest one by one, as
    the digest allows no other way; its memory is bounded by a piece."""
    pieces = ends.groupBy(*NODE, F.shiftright("conv_id", SPAN).alias("span")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("text"))
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "span").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def subtree_sums(tree: DataFrame, steps: DataFrame, values: list[str]) -> DataFrame:
    """(node, sums of ``values`` over the node's subtree) of a trie.

    tree: one row per node (depth, k1, k2; p1, p2 of its parent; conv_id; n_children; light: not the child with most members of
    its parent, or a child of the root; ``values``). steps: (conv_id, node) for each conversation and depth.
    Each childless node ends one heavy path; its conversation's steps tell where the path begins (the last step onto a
    light child; the root is a path of its own, so all its children count as light) and how many light edges lie above: at
    most one more than the logarithm of the conversations, as a light child has at most half of its parent's members.
    Rounds go from the paths with most light edges above to those with none: each sums its paths' arrays from their ends, and
    hands the sums at their heads to the parents' places in their own arrays for the next round."""
    leaves = tree.where("n_children = 0").select("conv_id")
    walk = store(steps.join(leaves, "conv_id").join(tree.select(*NODE, "p1", "p2", "light", *values), NODE))
    head = walk.groupBy("conv_id").agg(F.count_if("light").alias("level"), F.coalesce(F.max(F.when(F.col("light"), F.col("depth"))), F.lit(0)).alias("head"))
    up = (-F.col("depth")).alias("up")
    path = store(walk.join(head, "conv_id").where("depth >= head AND (depth > 0 OR level = 0)").select("conv_id", "level", "head", *NODE, "p1", "p2", up, *values), "level")
    parent = path.select("depth", "k1", "k2", F.col("conv_id").alias("onto"))
    heads = path.where("depth = head AND depth > 1").select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    onto = store(heads.join(parent, NODE).select("conv_id", "onto"))  # the path that a path hangs on
    large = large_keys(path, ["conv_id"])
    given, done = None, []
    for level in range(path.agg(F.max("level")).first()[0] or 0, 0, -1):
        rows = path.where(F.col("level") == level).select("conv_id", "head", *NODE, "up", *values)
        if given is not None:  # sums that hang on a place come just before the place itself
            rows = store(rows.unionByName(given, allowMissingColumns=True))
        sums = running(rows, ["conv_id"], ["up", "head"], {f"s_{v}": ("sum", v) for v in values}, large=large).where("head is not null")
        sums = store(sums.select("conv_id", "head", *NODE, *[F.col(f"s_{v}").alias(v) for v in values]))
        done.append(sums.select(*NODE, *values))
        tops = sums.where("depth = head")
        if level > 1:
            given = tops.join(onto, "conv_id").groupBy(F.col("onto").alias("conv_id"), (1 - F.col("depth")).alias("up")).agg(*[F.sum(v).alias(v) for v in values])
        else:
            root = tops.agg(*[F.sum(v).alias(f"in_{v}") for v in values])
    roots = tree.where("depth = 0").select(*NODE, *values)
    if done:
        roots = roots.join(F.broadcast(root)).select(*NODE, *[(F.col(v) + F.coalesce(F.col(f"in_{v}"), F.lit(0))).alias(v) for v in values])  # one row each
    return reduce(DataFrame.union, done, roots)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of conversation prefixes, from the root (depth 0).

    turns: (conv_id, depth, content, words, last: whether the conversation ends there), of each conversation a row at depth 0 and
    its turns at depths from 1 without gaps. A node is a distinct sequence of contents, known by 128 bits: the exclusive or of a
    hash of each content and its depth, so prefixes of a conversation are a running aggregate (one of any length spreads
    over tasks). Returns conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (over the subtree, members but one times words of the last turn), ends_sha256 (of the ids of the members that end here).
    No conversations give no rows, not even a root. Repeated turns are turns like any other."""
    zero = F.lit(0).cast("long")
    some = F.col("depth") > 0
    hashed = turns.withColumns({"h1": F.when(some, F.xxhash64("content", "depth", F.lit(1))).otherwise(zero), "h2": F.when(some, F.xxhash64(F.lit(2), "depth", "content")).otherwise(zero)})
    steps = store(running(store(hashed.drop("content")), ["conv_id"], ["depth"], {"k1": ("bit_xor", "h1"), "k2": ("bit_xor", "h2")}))
    nodes = steps.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.max("h1").alias("h1"), F.max("h2").alias("h2"))
    nodes = store(nodes.select(*NODE, F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "conv_id", "n_convs", "words"))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    kids = kids.agg(F.count("*").alias("n_children"), F.max_by(F.struct("k1", "k2"), F.struct("n_convs", -F.col("conv_id"))).alias("heavy"))
    own = store(nodes.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    above = own.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("heavy").alias("best"))
    light = some & ((F.col("depth") == 1) | (F.col("k1") != F.col("best.k1")) | (F.col("k2") != F.col("best.k2")))
    below = own.where("depth > 0").join(above, ["depth", "p1", "p2"])
    tree = below.union(own.where("depth = 0").select(*[F.lit(None).cast(t).alias(c) if c in ("parent_conv_id", "best") else F.col(c) for c, t in below.dtypes]))
    tree = store(
        tree.select(
            *NODE, "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "n_children", light.alias("light"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        )
    )
    digests = ends_digests(steps.where("last").select(*NODE, "conv_id"))
    sums = subtree_sums(tree, steps.select("conv_id", *NODE), ["n_leaves", "saved_tokens"])
    out = tree.drop("n_leaves", "saved_tokens").join(sums, NODE).join(digests, NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def op13_conversation_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_start(turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


# crc32 of a decimal number: DuckDB has no such function
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
OP13_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS content,
         len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, content) AS pos FROM t),
n AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base FROM r GROUP BY conv_id),
p AS (SELECT a.conv_id, a.base, a.n, {_CRC.replace("conv_id", "a.conv_id")} % 4 AS h, coalesce(b.n, 0) AS base_n FROM n a LEFT JOIN n b ON a.base = b.conv_id),
q AS (SELECT *, least(h, base_n) AS take, least(h, base_n) + greatest(n - h, 0) AS turns FROM p),
s AS (
  SELECT q.conv_id, q.take + r.pos - q.h AS depth, content, words FROM r JOIN q ON r.conv_id = q.conv_id WHERE r.pos > q.h
  UNION ALL SELECT q.conv_id, r.pos, content, words FROM q JOIN r ON r.conv_id = q.base WHERE r.pos <= q.take),
k AS (SELECT conv_id, depth, words, string_agg(content, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM s),
m AS (SELECT k.*, k.depth = q.turns AS last FROM k JOIN q ON k.conv_id = q.conv_id UNION ALL SELECT conv_id, 0, 0, '', turns = 0 FROM q),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN NULL ELSE substr(key, 1, greatest(65 * (depth - 1) - 1, 0)) END AS parent FROM m GROUP BY key, depth),
kids AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
tree AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON nodes.key = kids.parent),
up AS (SELECT substr(key, 1, greatest(65 * d - 1, 0)) AS key, n_children, n_convs, words FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM tree)),
sums AS (SELECT key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM up GROUP BY key)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
FROM tree t JOIN sums s ON t.key = s.key LEFT JOIN tree p ON t.parent = p.key"""
