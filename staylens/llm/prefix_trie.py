"""Prefix trie of conversations by whole-sequence collapse.

A turn is named by its role and the MD5 of its text. The prefix of d turns is named by
d and two 64-bit lanes, each the exclusive or of hashes of (position, role, name) over
its turns: the name of a whole conversation is a combinable aggregate, and the names of
all its prefixes are running ones.

1. Identical conversations collapse into one weighted sequence: how many they are, the
   smallest id, which stands for all of them, and the list of conversations that end
   there (kept as rows, `ends`). Only the sequences go on, copies cost nothing.
2. Every sequence is laid out as its prefixes, one row each. Sequences that are a proper
   prefix of another one are found by an anti join of their names with the prefixes that
   go on; what is left are the leaves.
3. Prefixes with equal names are one node; weights, leaves and words add up over them.
   The words a subtree saves are summed without walking it: a member's words from the
   node to its end, weighted, less the words of the subtree's distinct nodes. Each node
   belongs to its smallest member, and a member owns all nodes of its path from some
   depth on, so the distinct nodes of a subtree are the owned ends of its members.

Positions come from numbers over all turns in the order of (conversation, turn, role,
name), not from a window over a conversation, and running values are cut into blocks of
`BLOCK` positions, so a conversation with a third of all turns is spread like any other.
Aggregates are combined before the shuffle; frequent prefixes (the root, a common first
turn) meet only joins that adaptive execution splits.

Turns without a conversation id take no part. A null turn number comes first; turns with
equal numbers are ordered by role and the MD5 of their text; identical rows are turns one
after another. Null role and text count as empty. Very long texts are read once, to be
named and counted. A conversation without turns is a member of the root. Without any
conversation there is no node. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens.llm.store import written
from staylens.operators.order import dense_keys

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 512
CHUNK = 12
NAME = ["depth", "a", "b"]


def named_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, `at` (position, from 1), role, `name` (MD5 of the text), `words`."""
    body = F.coalesce(F.col(text), F.lit(""))
    short = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.md5(body).alias("name"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("words"),
    )
    numbered = written(dense_keys(short, ["conv_id", "turn", "role", "name"], "row"))
    first = numbered.groupBy("conv_id").agg(F.min("row").alias("first"))
    return written(
        numbered.join(first, "conv_id").select(
            "conv_id", (F.col("row") - F.col("first") + 1).alias("at"), "role", "name", "words"
        )
    )


def grafted(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on shared openings, and the list of all of them (`conv_id`).

    Conversation c takes the first h turns of conversation c - c % `every` (all, if it has
    fewer), then its own turns after its first h; h is the CRC-32 of c's digits modulo
    `most`. `turns` is the result of `named_turns`."""
    own = ["at", "role", "name", "words"]
    sizes = written(
        turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")).select(
            "conv_id", "size", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
            F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).alias("h"),
        )
    )
    bases = sizes.join(
        sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size")), "base", "left"
    ).select("conv_id", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("taken"))
    # at most `most` - 1 turns of a base, met by at most `every` conversations
    openings = turns.where(F.col("at") < most).withColumnRenamed("conv_id", "base")
    head = openings.join(bases, "base").where("at <= taken").select("conv_id", *own)
    tail = turns.join(bases.select("conv_id", "h", "taken"), "conv_id").where("at > h").select(
        "conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "role", "name", "words"
    )
    return written(head.unionByName(tail)), sizes.select("conv_id")


def lane(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "at", "role", "name")


def sequences(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every conversation with the name of its whole sequence: `conv_id`, `depth`, `a`,
    `b`, `words`."""
    whole = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("depth"), F.bit_xor(lane(1)).alias("a"), F.bit_xor(lane(2)).alias("b"),
        F.sum("words").alias("words"),
    )
    zero = F.lit(0).cast("long")
    return conversations.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("depth", "a", "b", "words")]
    )


def prefixes(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """The prefixes of each kept sequence (`conv_id`, `weight`, `total`): `conv_id`, name
    and parent's lanes, `before` (words ahead of the last turn), `last` (its words)."""
    rows = turns.join(kept, "conv_id").select(
        "conv_id", "weight", "total", "leaf", "at", "words", lane(1).alias("x"), lane(2).alias("y"),
        F.floor((F.col("at") - 1) / BLOCK).alias("block"),
    )
    sums = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("words")
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = sums.select(
        "conv_id", "block", F.coalesce(F.bit_xor("x").over(earlier), zero).alias("x0"),
        F.coalesce(F.bit_xor("y").over(earlier), zero).alias("y0"),
        F.coalesce(F.sum("words").over(earlier), zero).alias("w0"),
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    a = F.col("x0").bitwiseXOR(F.bit_xor("x").over(upto))
    b = F.col("y0").bitwiseXOR(F.bit_xor("y").over(upto))
    laid = rows.join(starts, ["conv_id", "block"]).select(
        "conv_id", "weight", "total", "leaf", F.col("at").alias("depth"), a.alias("a"), b.alias("b"), "x", "y",
        (F.col("w0") + F.sum("words").over(upto) - F.col("words")).alias("before"), F.col("words").alias("last"),
    )
    return laid.select(
        "conv_id", "weight", "total", "leaf", *NAME, F.col("a").bitwiseXOR(F.col("x")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("y")).alias("pb"), "before", "last",
    )


def trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of named turns.

    Nodes: name, `conv_id` (smallest member), `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves`, `saved_tokens`. Ends: name and `conv_id` of every conversation at the node
    where it stops."""
    ends = written(sequences(turns, conversations))
    collapsed = written(
        ends.groupBy(*NAME).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("words").alias("total")
        )
    )
    laid = prefixes(turns, collapsed.select("conv_id", "weight", "total", F.lit(0).alias("leaf"))).drop("leaf")
    root = collapsed.select(
        "conv_id", "weight", "total", *[F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b")],
        *[F.lit(None).cast("long").alias(c) for c in ("pa", "pb")],
        *[F.lit(0).cast("long").alias(c) for c in ("before", "last")],
    )
    laid = written(laid.unionByName(root))
    going_on = laid.join(collapsed.select("conv_id", F.col("depth").alias("whole")), "conv_id").where("depth < whole")
    leaves = written(
        collapsed.join(going_on.select(*NAME).distinct(), NAME, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    )
    marked = laid.join(leaves, "conv_id", "left")
    after = F.col("total") - F.col("before")
    nodes = written(
        marked.groupBy(*NAME).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
            F.count("leaf").alias("n_leaves"), F.sum(F.col("weight") * after).alias("all_words"),
            F.first("before").alias("before"), F.first("pa").alias("pa"), F.first("pb").alias("pb"),
        )
    )
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("shared"))
    once = laid.join(owned, "conv_id").groupBy(*NAME).agg(
        F.sum(F.col("total") - F.greatest("before", "shared")).alias("node_words")
    )
    up = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    below = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(*NAME, F.col("conv_id").alias("parent_conv_id"))
    known = nodes.join(once, NAME).join(below, NAME, "left")
    lifted = known.withColumnsRenamed({c: f"own_{c}" for c in NAME}).select(
        "*", (F.col("own_depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")
    )
    zero = F.lit(0).cast("long")
    full = lifted.join(parents, NAME, "left").select(
        *[F.col(f"own_{c}").alias(c) for c in NAME], "conv_id", "parent_conv_id", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (F.col("all_words") - F.col("node_words")).alias("saved_tokens"),
    )
    return full, ends.select(*NAME, "conv_id")


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each name, which come one after another."""
    current, digest = None, None

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(NAME, current), ends_sha256=digest.hexdigest())])

    for batch in batches:
        for depth, a, b, ids in zip(*[batch.column(c).to_pylist() for c in (*NAME, "ids")]):
            if (depth, a, b) == current:
                digest.update(b",")
            else:
                if current is not None:
                    yield row()
                current, digest = (depth, a, b), hashlib.sha256()
            digest.update(ids.encode())
    if current is not None:
        yield row()


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending decimal ids, joined by commas, that end at each node.

    Ids are joined in chunks of at most 2 ** `CHUNK` neighbours, which bounds a list; the
    chunks of a node pass one task in order and only its running digest is held."""
    chunks = ends.groupBy(*NAME, F.shiftright("conv_id", CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")
    )
    ordered = chunks.repartition(*NAME).sortWithinPartitions(*NAME, "chunk").select(*NAME, "ids")
    return ordered.mapInArrow(digested, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of a table of turns, each node with role and text of
    its last turn (null at the root). `columns` names the columns, as in `named_turns`."""
    named = named_turns(turns, **columns)
    nodes, ends = trie(named, named.select("conv_id").distinct())
    role, text = columns.get("role", "role"), columns.get("text", "text")
    said = turns.select(
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        F.md5(F.coalesce(text, F.lit(""))).alias("name"),
    ).groupBy("role", "name").agg(F.first("text").alias("text"))
    last = named.select("conv_id", F.col("at").alias("depth"), "role", "name")
    return nodes.join(last, ["conv_id", "depth"], "left").join(said, ["role", "name"], "left").drop("name"), ends
