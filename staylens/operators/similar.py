"""Near copies by name inside a map cell, without comparing all pairs of a cell.

Two names match when their insert-delete distance is at most a fixed share of
their joint length. Equal token strings are collapsed first. Other pairs are
found by joins on keys that every matching pair shares:

* names one insertion apart share the longer name without one character, and
  names one replaced character apart share a copy without it;
* for larger distances d, d + 1 segments of the shorter name are looked up in
  the longer one, where at least one must occur unchanged and barely shifted.

A name has about as many keys as letters. The planner takes the exploded keys for as
small as the names, so joins on them are marked as merge joins: no side is broadcast.
Keys travel with a name's number; names are brought back for the pairs that were found.
Names of one template share most segments, so a join on segments also holds two sets of
64 bits against each other, which letters a name has an odd number of times: an edit
changes one bit at most, and far names are dropped inside the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from staylens.functions.parsing import num
from staylens.functions.similarity import common_length
from staylens.functions.text import sorted_tokens
from staylens.operators.order import attach
from staylens.operators.quality import ROW_ID, SET, labelled
from staylens.session import checkpoint

BLOCK = (SET, "_y", "_x", "_block")
CELL_DEGREES, SIMILARITY = 0.0005, 98.0


def cell_names(
    df: DataFrame, dataset: str, by: Sequence[str] = (), name: str = "name", lat: str = "latitude", lon: str = "longitude",
    block: str = "room_type", cell: float = CELL_DEGREES,
) -> DataFrame:
    """Rows with coordinates, their cell and block, and their sorted name tokens;
    rows of different tenants never share a block. A missing name reads `nan`, so two missing names are alike."""
    y, x = num(F.col(lat)), num(F.col(lon))
    return labelled(df, dataset, by).where(y.isNotNull() & x.isNotNull()).select(
        "*",
        F.rint(y / F.lit(cell)).cast("long").alias("_y"),
        F.rint(x / F.lit(cell)).cast("long").alias("_x"),
        F.coalesce(F.concat(F.lit("="), F.col(block)), F.lit("")).alias("_block"),
        sorted_tokens(F.coalesce(F.col(name), F.lit("nan"))).alias("_text"),
    )


def allowed(la: Column, lb: Column, threshold: float) -> Column:
    """Largest insert-delete distance that still matches, of the parity that the
    lengths force; negative or below the length gap when none does."""
    most = F.floor((la + lb) * F.lit(100.0 - threshold) / F.lit(100.0))
    return most - F.pmod(most - F.abs(la - lb), F.lit(2))


def odd_letters(c: Column) -> Column:
    """64 bits that tell which letters, some of them taken together, occur an odd number of times."""
    def bit(x: Column) -> Column:
        # an empty name is split into one empty text
        return F.call_function("shiftleft", F.least(F.length(x), F.lit(1)).cast("long"), F.pmod(F.ascii(x), F.lit(64)))

    return F.aggregate(F.split(c, ""), F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(bit(x)))


def without(c: Column, at: Column) -> Column:
    """The string without its character at a 1-based position; whole at 0."""
    cut = F.concat(F.substring(c, F.lit(1), at - 1), F.substring(c, at + 1, F.length(c)))
    return F.when(at == 0, c).otherwise(cut)


def with_names(found: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs of numbers `_a`, `_b` with their names (`_one` is the shorter, or the first of
    equal length), rows and places (`_at_a`, `_at_b`), if any; only pairs of one block."""
    def side(tag: str) -> DataFrame:
        name = F.struct(F.col("_len"), F.col("_text"), F.col("_rows")).alias(f"_name_{tag}")
        return names.select(F.col("_id").alias(f"_{tag}"), F.struct(*BLOCK).alias(f"_block_{tag}"), name)

    met = found.join(side("a").hint("merge"), "_a").join(side("b").hint("merge"), "_b")
    one, two = F.least("_name_a", "_name_b"), F.greatest("_name_a", "_name_b")
    return met.where("_block_a = _block_b").select(
        "_block_a.*", one["_text"].alias("_one"), two["_text"].alias("_two"),
        one["_rows"].alias("rows_a"), two["_rows"].alias("rows_b"),
        F.col("_name_a._text").alias("_text_a"), F.col("_name_b._text").alias("_text_b"),
        *[c for c in found.columns if c not in ("_a", "_b", "_key")],
    )


FOUND = (*BLOCK, "_one", "_two", "rows_a", "rows_b")


def one_edit_pairs(names: DataFrame, threshold: float) -> DataFrame:
    """Pairs at distance 1 (one more character) or 2 (one replaced)."""
    size = F.col("_len")
    longer = allowed(size, size - 1, threshold) >= 1
    equal = allowed(size, size, threshold) >= 2
    shorter = allowed(size + 1, size, threshold) >= 1
    none = F.array().cast("array<int>")
    places = F.concat(
        F.when(shorter, F.array(F.lit(0))).otherwise(none),
        F.when(longer | equal, F.sequence(F.lit(1), size)).otherwise(none),
    )
    keyed = names.select(*BLOCK, "_text", "_len", "_id", F.explode(places).alias("_at")).select(
        F.xxhash64(*BLOCK, without(F.col("_text"), F.col("_at"))).alias("_key"), "_id", "_len", "_at"
    )
    # both sides are the same rows, so their keys are made and shuffled once: no condition on one side alone
    a, b = keyed.toDF("_key", "_a", "_len_a", "_at_a"), keyed.toDF("_key", "_b", "_len_b", "_at_b")
    inserted = (F.col("_at_a") == 0) & (F.col("_len_b") == F.col("_len_a") + 1)
    replaced = (
        (F.col("_len_a") == F.col("_len_b")) & (F.col("_a") < F.col("_b"))
        & (allowed(F.col("_len_a"), F.col("_len_b"), threshold) >= 2)
    )
    found = a.join(b.hint("merge"), "_key").where(inserted | replaced).select("_a", "_b", "_at_a", "_at_b")
    # the hashes of keys may agree by chance, also those of a whole name and of a cut one
    alike = without(F.col("_text_a"), F.col("_at_a")) == without(F.col("_text_b"), F.col("_at_b"))
    return (
        with_names(found, names)
        .where(alike)
        .select(*FOUND, F.when(F.col("_at_a") == 0, 1).otherwise(2).alias("_distance"))
        .distinct()
    )


def segment_pairs(names: DataFrame, threshold: float) -> DataFrame:
    """Pairs with a length gap of two or more, or a distance of three or more; no pair twice."""
    gap_share = (100.0 - threshold) / threshold
    short = F.col("_short")
    gaps = F.sequence(F.lit(0), F.ceil(F.col("_len") * 2 * F.lit(gap_share) + 1).cast("int"))

    def with_plan(df: DataFrame) -> DataFrame:
        """Adds the allowed distance and the bounds of each segment of the shorter name."""
        planned = df.withColumn("_d", allowed(short, short + F.col("_gap"), threshold)).where(
            (F.col("_d") >= F.col("_gap")) & ((F.col("_gap") >= 2) | (F.col("_d") >= 3)) & (short > F.col("_d"))
        )
        parts = F.col("_d") + 1
        return planned.withColumn("_seg", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_d")))).select(
            "*",
            F.floor(F.col("_seg") * short / parts).cast("int").alias("_from"),
            (F.floor((F.col("_seg") + 1) * short / parts) - F.floor(F.col("_seg") * short / parts)).cast("int").alias("_size"),
        )

    base = names.select(*BLOCK, "_text", "_len", "_id", "_odd", F.explode(gaps).alias("_gap"))
    key = [*BLOCK, "_short", "_gap", "_seg"]
    index = with_plan(base.withColumn("_short", F.col("_len"))).select(
        F.xxhash64(*key, F.substring("_text", F.col("_from") + 1, F.col("_size"))).alias("_key"),
        F.col("_id").alias("_a"), F.col("_odd").alias("_odd_a"), "_gap", F.col("_d").alias("_most"),
    )
    lost = ((F.col("_d") - F.col("_gap")) / 2).cast("int")
    gained = ((F.col("_d") + F.col("_gap")) / 2).cast("int")
    probe = (
        with_plan(base.withColumn("_short", F.col("_len") - F.col("_gap")))
        .withColumn("_shift", F.explode(F.sequence(-lost, gained)))
        .withColumn("_at", F.col("_from") + F.col("_shift"))
        .where((F.col("_at") >= 0) & (F.col("_at") + F.col("_size") <= F.col("_len")))
        .select(
            F.xxhash64(*key, F.substring("_text", F.col("_at") + 1, F.col("_size"))).alias("_key"),
            F.col("_id").alias("_b"), F.col("_odd").alias("_odd_b"),
        )
    )
    once = (F.col("_gap") > 0) | (F.col("_a") < F.col("_b"))
    alike = F.bit_count(F.col("_odd_a").bitwiseXOR(F.col("_odd_b"))) <= F.col("_most")
    found = index.join(probe.hint("merge"), "_key").where(once & alike)
    pairs = with_names(found.select("_a", "_b").distinct(), names).select(*FOUND)
    la, lb = F.length("_one"), F.length("_two")
    distance = F.col("_distance")
    # what `one_edit_pairs` finds is left to it
    further = (distance > 2) | (F.abs(la - lb) > 1)
    return (
        pairs.withColumn("_distance", la + lb - 2 * common_length(F.col("_one"), F.col("_two")))
        .where((distance <= allowed(la, lb, threshold)) & further)
        .select(*FOUND, "_distance")
    )


def similar_names(rows: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Matching pairs of different token strings and repeated equal ones, with the
    score and the number of rows on either side. Linear in the distinct names."""
    names = rows.groupBy(*BLOCK, "_text").agg(F.count(F.lit(1)).alias("_rows"))
    # numbered once: a number must not change between the joins
    number = F.monotonically_increasing_id().alias("_id")
    names = checkpoint(names.select("*", F.length("_text").alias("_len"), odd_letters(F.col("_text")).alias("_odd"), number))
    equal = names.where("_rows > 1").select(
        *BLOCK, F.col("_text").alias("_one"), F.col("_text").alias("_two"), F.lit(0).alias("_distance"),
        F.col("_rows").alias("rows_a"), F.col("_rows").alias("rows_b"),
    )
    shared = names.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("_names")).where("_names > 1").select(*BLOCK)
    # few bytes that become many keys: a fixed number of parts, which is not merged into one
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    busy = names.join(shared.hint("merge"), list(BLOCK), "left_semi").repartition(parts, "_id")
    near = one_edit_pairs(busy, threshold).unionByName(segment_pairs(busy, threshold))
    joint = F.length("_one") + F.length("_two")
    pairs = equal.unionByName(near).withColumn(
        "score",
        F.when(joint == 0, 100).otherwise(F.floor((joint - F.col("_distance")) * 100 / F.nullif(joint, F.lit(0)))).cast("int"),
    )
    return pairs.select(*BLOCK, "_two", "_one", "_distance", "score", "rows_a", "rows_b")


def pair_count(rows: DataFrame, names: DataFrame, id: str = "id") -> DataFrame:
    """How many row pairs with different ids the name pairs stand for, counted
    without listing them; a missing id differs from every other."""
    same = F.col("_one") == F.col("_two")
    a, b = F.col("rows_a"), F.col("rows_b")
    all_pairs = names.agg(F.sum(F.when(same, a * (a - 1) / 2).otherwise(a * b)).alias("_all"))
    key = [*BLOCK, "_id"]
    known = rows.where(F.col(id).isNotNull()).select(*BLOCK, "_text", F.col(id).alias("_id"))
    # only an id that a block has twice can stand on both sides of a pair
    twice = known.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
    ids = known.join(twice.hint("merge"), key, "left_semi").groupBy(*BLOCK, "_text", "_id").agg(F.count(F.lit(1)).alias("_n"))
    alike = ids.agg(F.sum(F.col("_n") * (F.col("_n") - 1) / 2).alias("_alike"))
    left = ids.select(*BLOCK, F.col("_text").alias("_one"), "_id", F.col("_n").alias("_na"))
    right = ids.select(*BLOCK, F.col("_text").alias("_two"), "_id", F.col("_n").alias("_nb"))
    crossed = (
        names.where(~same).select(*BLOCK, "_one", "_two")
        .join(left.hint("merge"), [*BLOCK, "_one"])
        .join(right.hint("merge"), [*BLOCK, "_two", "_id"])
        .agg(F.sum(F.col("_na") * F.col("_nb")).alias("_crossed"))
    )
    zero = F.lit(0)
    return attach(attach(all_pairs, alike, ()), crossed, ()).select(
        (F.coalesce("_all", zero) - F.coalesce("_alike", zero) - F.coalesce("_crossed", zero)).cast("long").alias("pairs")
    )


def expand_pairs(
    rows: DataFrame, names: DataFrame, id: str = "id", name: str = "name", order: str = ROW_ID
) -> DataFrame:
    """One row per matching pair of listings with different ids, earlier row first.
    The output is as long as the answer; `similar_names` is its compact form."""
    listing = F.struct(F.col(order).alias("at"), F.col(id).alias("id"), F.col(name).alias("name"))
    one = rows.select(*BLOCK, F.col("_text").alias("_one"), listing.alias("_a"))
    two = rows.select(*BLOCK, F.col("_text").alias("_two"), listing.alias("_b"))
    both = names.select(*BLOCK, "_one", "_two", "score").join(one, [*BLOCK, "_one"]).join(two, [*BLOCK, "_two"])
    once = (F.col("_one") != F.col("_two")) | (F.col("_a.at") < F.col("_b.at"))
    other = F.coalesce(F.col("_a.id") != F.col("_b.id"), F.lit(True))
    swap = F.col("_a.at") > F.col("_b.at")
    first, second = F.when(swap, F.col("_b")).otherwise(F.col("_a")), F.when(swap, F.col("_a")).otherwise(F.col("_b"))
    return both.where(once & other).select(
        F.col(SET).alias("dataset"),
        first["id"].alias("id_a"), second["id"].alias("id_b"),
        first["name"].alias("name_a"), second["name"].alias("name_b"), "score",
    )


def fuzzy_pairs(df: DataFrame, dataset: str, id: str = "id", name: str = "name", threshold: float = SIMILARITY, **cells) -> DataFrame:
    rows = cell_names(df, dataset, name=name, **cells)
    return expand_pairs(rows, similar_names(rows, threshold), id, name)
