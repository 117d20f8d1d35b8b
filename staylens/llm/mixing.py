"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and `most` copies. Among all rates that meet
the token target of each source, the rates closest in entropy to an even draw are
those of an exponential tilt, rate / (most - rate) = exp(tilt * size / mean size),
with one tilt per source. The tilts solve a convex dual; distributed Newton steps
find them over the counted sizes of each source, so a step reads one row per
source and distinct size, not one per document. A bracket per source catches
steps that leave it. The rates are then rounded to whole copies: each document
has a fixed number in [0, 1) and a switch point per source decides which
documents round up, chosen from two levels of bounded bucket sums so that the
source's words come as close to the target as single documents allow.

All steps are DataFrame operations; sources are numbered, counted before every
shuffle, and joined by broadcast only when their count proves them small.

Null and empty texts have size 0 and are taken 0 words. A null source is a source
of its own, last in order. Rows that repeat an id are separate documents with the
same number. Documents of one size and source have the same rate and differ only by
their numbers; equal numbers at the switch point fall on one side together, so a source
misses its target by at most those documents. Very long texts are counted whole; one
that is longer than what its target leaves open may be left out. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens.llm.store import if_small, spread, whole, written
from staylens.operators.order import dense_keys

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Runs of characters other than space and the controls 9 to 13; null is 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """`source_no`, `source_size`, `target` for (`source_no`, `size`): the weights
    repeat in the order of the sources and share `share` of all sizes; a target
    stops at `most` times its source's size, the excess is shared again by weight."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = written(
        sizes.groupBy("source_no")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(cycle, ((F.col("source_no") - 1) % len(weights)).cast("int")))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
    )
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * level > F.col("cap")
        state = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(full, F.lit(1))), F.lit(0)),
        ).first()
        if state[2] == capped or not state[1]:
            break
        capped, level = state[2], (total - state[0]) / state[1]
    return table.select(
        "source_no", "source_size", F.least(F.col("weight") * level, F.col("cap")).alias("target")
    )


def tilts(sizes: DataFrame, targets: DataFrame, most: float = MOST, accuracy: float = 1e-7, steps: int = 60) -> DataFrame:
    """`targets` with the `tilt` of each source and the `mean` size it is scaled by.

    `sizes` has (`source_no`, `size`, `n`). A source whose target is its whole
    stock has an infinite tilt, one whose target is 0 the negative one."""
    big = sizes.where("size > 0")
    means = big.groupBy("source_no").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    stock = F.lit(most) * F.col("source_size")
    state = written(
        targets.join(means, "source_no", "left").select(
            "source_no", "source_size", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"),
            F.when(F.col("target") >= stock * (1 - 1e-12), F.lit(float("inf")))
            .when(F.col("target") <= 0, F.lit(float("-inf")))
            .otherwise(F.lit(0.0)).alias("tilt"),
            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        )
    )
    z = F.col("size") / F.col("mean")
    part = 1 / (1 + F.exp(-F.col("tilt") * z))
    for _ in range(steps):
        open_ = state.where("abs(tilt) < double('infinity')")
        sums = big.join(if_small(open_, 64), "source_no").groupBy("source_no").agg(
            F.sum(F.col("n") * F.col("size") * part * most).alias("taken"),
            F.sum(F.col("n") * F.col("size") * z * part * (1 - part) * most).alias("slope"),
        )
        over = F.col("taken") - F.col("target")
        met = state.join(sums, "source_no", "left")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - over / F.greatest(F.col("slope"), F.lit(1e-300))
        middle = (
            F.when(F.col("low").isNull(), F.col("high") * 2 - F.lit(1.0))
            .when(F.col("high").isNull(), F.col("low") * 2 + F.lit(1.0))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = (
            F.coalesce(F.col("newton") > F.col("low"), F.abs("newton") < 1e3)
            & F.coalesce(F.col("newton") < F.col("high"), F.abs("newton") < 1e3)
        )
        close = F.col("taken").isNull() | (F.abs(over) <= accuracy * F.greatest(F.col("target"), F.lit(1.0)))
        state = written(
            met.withColumn("close", close)
            .withColumn("newton", newton)
            .withColumn("low", low)
            .withColumn("high", high)
            .withColumn("tilt", F.when(F.col("close"), F.col("tilt")).when(inside, F.col("newton")).otherwise(middle))
            .select("source_no", "source_size", "target", "mean", "tilt", "low", "high", "close")
        )
        if state.where("not close").isEmpty():
            break
        state = state.drop("close")
    return state.select("source_no", "source_size", "target", "mean", "tilt")


def rounded_up(rated: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the switch point (`bucket`, `part`) below which a document takes
    one copy more than `floor`, for rows of (`source_no`, `size`, `floor`, `at`)."""
    place = (F.col("at") + 1) / 2 * BUCKETS
    cells = rated.select(
        "source_no", "size", (F.col("size") * F.col("floor")).alias("sure"),
        F.floor(place).cast("int").alias("bucket"),
        F.floor((place - F.floor(place)) * BUCKETS).cast("int").alias("part"),
    )
    group = Window.partitionBy("source_no")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = cells.groupBy("source_no", "bucket").agg(F.sum("size").alias("size"), F.sum("sure").alias("sure"))
    # at most BUCKETS + 1 rows of one source
    placed = (
        sums.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .withColumn("all_sure", F.sum("sure").over(group))
        .join(if_small(targets.select("source_no", "target"), 16), "source_no")
        .withColumn("need", F.col("target") - F.col("all_sure"))
    )
    chosen = written(
        placed.groupBy("source_no").agg(
            F.coalesce(
                F.min(F.when(F.col("before") + F.col("size") >= F.col("need"), F.col("bucket"))), F.lit(BUCKETS + 1)
            ).alias("bucket"),
            F.min_by(
                F.col("need") - F.col("before"),
                F.when(F.col("before") + F.col("size") >= F.col("need"), F.col("bucket")),
            ).alias("rest"),
        )
    )
    inner = (
        cells.join(if_small(chosen, 24), ["source_no", "bucket"])
        .groupBy("source_no", "part")
        .agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    )
    fine = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most BUCKETS rows of one source; the side of the switch that is nearer
    split = (
        inner.withColumn("before", F.coalesce(F.sum("size").over(fine), F.lit(0)))
        .withColumn("gap", F.abs(F.col("before") - F.col("rest")))
        .withColumn("gap_after", F.abs(F.col("before") + F.col("size") - F.col("rest")))
        .groupBy("source_no")
        .agg(
            F.min_by(
                F.when(F.col("gap") <= F.col("gap_after"), F.col("part")).otherwise(F.col("part") + 1),
                F.struct(F.least("gap", "gap_after"), "part"),
            ).alias("part")
        )
    )
    return written(
        chosen.join(split, "source_no", "left").select("source_no", "bucket", F.coalesce("part", F.lit(0)).alias("part"))
    )


def rate_of(most: float) -> Column:
    """Copies of a document of `size` words before rounding, by `tilt` and `mean` of its source."""
    return F.when(F.col("tilt") == float("inf"), F.lit(float(most))).when(
        F.col("tilt") == float("-inf"), F.lit(0.0)
    ).otherwise(most / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean"))))


def floor_of(most: int) -> Column:
    return F.least(F.floor("rate"), F.lit(most - 1)).cast("long")


def place_of(id: str, seed: int) -> Column:
    """Where a document stands on the way to one copy more: its fixed number less its rest."""
    return spread(id, seed=seed) - (F.col("rate") - F.col("floor"))


def copies_of() -> Column:
    """`floor`, and one more below the switch point (`_bucket`, `_part`) of the source."""
    place = (F.col("at") + 1) / 2 * BUCKETS
    bucket, part = F.floor(place), F.floor((place - F.floor(place)) * BUCKETS)
    below = (bucket < F.col("_bucket")) | ((bucket == F.col("_bucket")) & (part < F.col("_part")))
    return (F.col("floor") + F.when(below, F.lit(1)).otherwise(F.lit(0))).cast("long")


def planned(
    docs: DataFrame, id: str, text: str, source: str, weights: Sequence[float], share: float, most: int, seed: int,
    with_source: bool,
) -> tuple[DataFrame, DataFrame]:
    """Rows with `rate`, `floor` and `at`, and the plan: per source its name, numbers,
    tilt and switch point."""
    size = word_count(text)
    sized = written(docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), size.alias("size")))
    last = F.col("source").isNull()
    names = sized.groupBy(last.alias("last"), "source").agg(F.count(F.lit(1)).alias("rows"))
    numbers = written(dense_keys(names, ["last", "source"], "source_no").select("source", "source_no"))
    by_number = F.col("source").eqNullSafe(F.col("source_"))
    rows = sized.join(if_small(numbers.withColumnRenamed("source", "source_"), 64), by_number).drop("source_")
    rows = written(rows if with_source else rows.drop("source"))
    counts = written(rows.groupBy("source_no", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.select("source_no", (F.col("size") * F.col("n")).alias("size"))
    state = tilts(counts, source_targets(totals, weights, share, most), most)
    known = written(state)
    rated = written(
        rows.join(if_small(known, 48), "source_no")
        .withColumn("rate", rate_of(most))
        .withColumn("floor", floor_of(most))
        .withColumn("at", place_of("doc_id", seed))
    )
    switch = rounded_up(rated.select("source_no", "size", "floor", "at"), state).select(
        "source_no", F.col("bucket").alias("_bucket"), F.col("part").alias("_part")
    )
    return rated, written(numbers.join(known, "source_no").join(switch, "source_no"))


def mixed(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = int(MOST), seed: int = 1,
    with_source: bool = False,
) -> DataFrame:
    """id, `size`, `source_size`, `target` (its source's), `rate`, `copies`,
    `taken` (size times copies) of every row, and with `with_source` the source."""
    rated, plan = planned(docs, id, text, source, weights, share, most, seed, with_source)
    return (
        rated.join(if_small(plan.select("source_no", "_bucket", "_part"), 16), "source_no")
        .withColumn("copies", copies_of())
        .select(
            F.col("doc_id").alias(id), "size", "source_size", "target", "rate", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            *([F.col("source").alias(source)] if with_source else []),
        )
    )


def mixture(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = int(MOST), seed: int = 1,
) -> DataFrame:
    """`docs` as the mix takes them: every row as often as its copies say.

    A row's copies follow from its size, its id and the plan of its source, so the rows
    meet one small row per source and their texts stay where they are."""
    _, plan = planned(docs, id, text, source, weights, share, most, seed, False)
    row = whole(docs)
    chosen = (
        row.join(if_small(plan.withColumnRenamed("source", "_source"), 96), F.col(f"all.`{source}`").eqNullSafe(F.col("_source")))
        .withColumn("size", word_count(f"all.`{text}`"))
        .withColumn("rate", rate_of(most))
        .withColumn("floor", floor_of(most))
        .withColumn("at", place_of(f"all.`{id}`", seed))
        .withColumn("copies", copies_of())
        .where("copies > 0")
    )
    return chosen.select("all", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("all.*")
