"""Exact dedup by deterministic block naming.

A text is cut into blocks of fixed size. The distinct blocks are sorted, and the
place in the order is the block's integer name. Adjacent names are then paired
and the distinct pairs sorted and named in turn, until each text has one name.
Two texts have the same number of rounds and the same name exactly when they are
equal: no hash decides. A 64-bit fingerprint is used one way only: texts whose
length and fingerprint occur once equal no other text and need no name.

All steps are DataFrame operations. Blocks and pairs are combined before each
shuffle, so a text with very many copies costs one row per task; the join that
gives names back is an ordinary join, which adaptive execution splits where a
block is frequent.

Null texts count as empty. An empty table gives an empty result. Rows that repeat
an id and its text are copies of one another, one of them is kept. Null ids come
before all others, so a row with an id is kept before one without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staylens.llm.store import if_small, whole, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 4096


def ascii_lower(text: str | Column) -> Column:
    """The text with A-Z lower-cased and every other character as it is; null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(column, F.lit("")), UPPER, LOWER)


def named(parts: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys with integer names in sorted order. The names are written, so
    that a task that runs again cannot number them anew.

    Rows are dealt to tasks by the order of (start, hash), so that the sample which
    sets the bounds of the tasks holds no whole blocks."""
    start = [F.substring(k, 1, 16) if kind == "binary" else F.col(k) for k, kind in parts.select(*keys).dtypes]
    place = [*start, F.xxhash64(*keys)]
    order = parts.select(*keys).distinct().repartitionByRange(*place).sortWithinPartitions(*place, *keys)
    return written(order.select(*keys, F.monotonically_increasing_id().alias("name")))


def identities(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """`row`, `rounds`, `name` of each row of (`row` long, unique; `body` binary)."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / block)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring("body", i * block + 1, F.lit(block)))
    blocks = texts.select("row", count.alias("n"), F.posexplode(cut).alias("at", "block"))
    level = written(blocks.join(named(blocks, "block"), "block").select("row", "n", "at", "name"))
    most = texts.select(F.max(count)).first()[0] or 1
    rounds, done = 0, []
    while most > 1:
        done.append(level.where("n = 1").select("row", F.lit(rounds).alias("rounds"), "name"))
        pairs = written(
            level.where("n > 1")
            .groupBy("row", "n", F.floor(F.col("at") / 2).cast("int").alias("at"))
            .agg(
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        half = F.ceil(F.col("n") / 2).cast("int").alias("n")
        level = written(pairs.join(named(pairs, "left", "right"), ["left", "right"]).select("row", half, "at", "name"))
        most, rounds = (most + 1) // 2, rounds + 1
    result = level.select("row", F.lit(rounds).alias("rounds"), "name")
    for part in done:
        result = result.unionByName(part)
    return result


def split_by_print(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose fingerprint occurs once, and those whose fingerprint repeats,
    both with `_print` (the fingerprint with the length)."""
    lower = ascii_lower(text)
    mark = F.struct(F.octet_length(lower).alias("n"), F.xxhash64(lower).alias("h"))
    marked = docs.withColumn("_print", mark)
    prints = marked.groupBy(F.col("_print.n").alias("_n"), F.col("_print.h").alias("_h")).count()
    often = if_small(written(prints.where("count > 1").select("_n", "_h")), 12)
    same = (F.col("_print.n") == F.col("_n")) & (F.col("_print.h") == F.col("_h"))
    return marked.join(often, same, "left_anti"), marked.join(often, same, "left_semi")


def copies(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The rows without a copy, and the rows with a possible copy; both with all
    columns of `docs`, the latter also with `keep_id`, `group_size` and `kept`
    below `_group`."""
    single, repeated = split_by_print(docs, text)
    repeated = written(repeated.drop("_print").withColumn("_row", F.monotonically_increasing_id()))
    texts = repeated.select(F.col("_row").alias("row"), F.encode(ascii_lower(text), "UTF-8").alias("body"))
    names = identities(texts, block)
    member = written(names.join(repeated.select(F.col("_row").alias("row"), F.col(id).alias("id")), "row"))
    groups = written(
        member.groupBy("rounds", "name").agg(
            F.max(F.struct("id", "row")).alias("first"), F.count(F.lit(1)).alias("group_size")
        )
    )
    found = member.join(groups, ["rounds", "name"]).select(
        F.col("row").alias("_row"),
        F.struct(
            F.col("first.id").alias("keep_id"),
            "group_size",
            (F.col("first.row") == F.col("row")).alias("kept"),
        ).alias("_group"),
    )
    return single.drop("_print"), repeated.join(found, "_row").drop("_row")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Every row's group of equal texts: id, `keep_id` (largest id of the group),
    `group_size`, `kept`, `text_sha256` of the normalised text."""
    own = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    single, repeated = copies(own, block=block)
    sha = F.sha2(F.encode(ascii_lower("text"), "UTF-8"), 256).alias("text_sha256")
    one = single.select(
        F.col("doc_id").alias(id), F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha,
    )
    return one.unionByName(repeated.select(F.col("doc_id").alias(id), "_group.*", sha))


def without_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """`docs` with one row of each group of equal texts, the one with the largest id."""
    single, repeated = copies(whole(docs), f"all.`{id}`", f"all.`{text}`", block)
    return single.unionByName(repeated.where("_group.kept").drop("_group")).select("all.*")
