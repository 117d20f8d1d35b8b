"""Order statistics without a one-task group: quantiles, ranks, first k, keys.

Every operator here first counts equal values (a combinable aggregate, so a hot
value costs one row), cuts the counted values into monotone buckets, adds up the
buckets (a bounded table), and only then orders values inside the few buckets
that matter. Buckets that hold many distinct values are cut again between their own
smallest and largest one, so the slices follow the data whatever its distribution.
No task sees all values of one group, and nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens.functions.numbers import bucket_of
from staylens.session import checkpoint

LINEAR, NEAREST = "linear", "nearest"
# a bucket of more distinct values is cut into parts of about a sixteenth of it, twice
CROWDED = 32_768
CUTS = 1 << 18


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where null equals null, keeping one copy of the keys."""
    if not keys:
        values = [F.col(f"_r.{c}") for c in right.columns]
        one = F.lit(1)
        return (
            left.withColumn("_one", one)
            .join(F.broadcast(right.withColumn("_one", one).alias("_r")), "_one", how)
            .select(*left.columns, *values)
        )
    renamed = right.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_key_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_key_{k}" for k in keys])


def counted(df: DataFrame, by: Sequence[str], value: str | Column) -> DataFrame:
    """Distinct values per group with their bucket and count; null and NaN left out."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return (
        df.select(*by, v.alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*by, bucket_of(F.col("_v")).alias("_b"), "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def refined(counts: DataFrame, by: Sequence[str], passes: int = 2) -> DataFrame:
    """`counts` with its crowded buckets cut evenly between their smallest and largest
    value; the bucket numbers still rise with the values. One row per crowded bucket
    is joined back; where there is none, adaptive execution drops the join."""
    for _ in range(passes):
        crowded = counts.groupBy(*by, "_b").agg(
            F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        ).where((F.col("_m") > CROWDED) & (F.col("_high") > F.col("_low")))
        parts = F.least(F.ceil(F.col("_m") * 16 / CROWDED), F.lit(CUTS))
        # halves, so that the span of the largest doubles does not overflow
        share = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        part = F.least(F.floor(share * parts).cast("long"), parts - 1)
        counts = attach(counts, crowded, [*by, "_b"]).select(
            *by, (F.col("_b") * CUTS + F.coalesce(part, F.lit(0))).alias("_b"), "_v", "_n"
        )
    return counts


def bucket_offsets(counts: DataFrame, by: Sequence[str], weight: str = "_n") -> DataFrame:
    """Rows before each bucket of a group and the group's total."""
    group = Window.partitionBy(*by)
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.groupBy(*by, "_b").agg(F.sum(weight).alias("_rows")).select(
        *by,
        "_b",
        "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias("_total"),
    )


def _position(probability: float, method: str) -> tuple[Column, Column, Column]:
    """Zero-based lower and upper rank and the weight of the upper one."""
    place = (F.col("_total") - 1) * F.lit(float(probability))
    if method == NEAREST:
        rank = F.floor(place + F.lit(0.5))
        return rank, rank, F.lit(0.0)
    low = F.floor(place)
    return low, F.ceil(place), place - low


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str | Column,
    probabilities: Mapping[str, float | tuple[float, str]],
) -> DataFrame:
    """Exact quantiles of one value per group.

    `probabilities` maps an output name to a probability, or to a probability
    and a method: linear (the default) or nearest (closest rank, half up). A
    group without values has no row.
    """
    return quantiles_of(counted(df, by, value), by, probabilities)


def quantiles_of(
    counts: DataFrame,
    by: Sequence[str],
    probabilities: Mapping[str, float | tuple[float, str]],
) -> DataFrame:
    """`quantiles` from the result of `counted`."""
    by = list(by)
    counts = refined(counts, by)
    wanted = {
        name: p if isinstance(p, tuple) else (p, LINEAR) for name, p in probabilities.items()
    }
    ranks = {name: _position(p, method) for name, (p, method) in wanted.items()}
    stop = F.col("_before") + F.col("_rows")
    hit = F.lit(False)
    for low, high, _ in ranks.values():
        for rank in (low, high):
            hit = hit | ((rank >= F.col("_before")) & (rank < stop))
    slices = bucket_offsets(counts, by).where(hit).drop("_rows")
    inside = Window.partitionBy(*by, "_b").orderBy("_v")
    ordered = attach(counts, slices, [*by, "_b"], "inner").withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(inside)
    )
    from_rank = F.col("_upto") - F.col("_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= from_rank) & (rank < F.col("_upto")), F.col("_v")))

    picks, results = [], []
    for i, (name, (low, high, share)) in enumerate(ranks.items()):
        picks += [at(low).alias(f"_low{i}"), at(high).alias(f"_high{i}"), F.max(share).alias(f"_share{i}")]
        a, b = F.col(f"_low{i}"), F.col(f"_high{i}")
        results.append((a + (b - a) * F.col(f"_share{i}")).alias(name))
    return ordered.groupBy(*by).agg(*picks).select(*by, *results)


def unpivot(df: DataFrame, by: Sequence[str], columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Wide to long: one row per column with its name and its value."""
    return df.select(*by, *[F.col(c).cast(kind).alias(c) for c in columns]).unpivot(
        list(by), list(columns), "variable", "value"
    )


def medians(df: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact medians of several columns per group; `columns` maps output to input."""
    by = list(by)
    if len(columns) == 1:
        ((name, column),) = columns.items()
        return quantiles(df, by, column, {name: 0.5})
    long = df.select(
        *by, *[F.col(c).cast("double").alias(n) for n, c in columns.items()]
    ).unpivot(by, list(columns), "_name", "_value")
    found = quantiles(long, [*by, "_name"], "_value", {"_median": 0.5})
    return found.groupBy(*by).agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_median"))).alias(n) for n in columns]
    )


def grouped(df: DataFrame, by: Sequence[str], aggregates: Sequence[Column], median: Mapping[str, str]) -> DataFrame:
    """Ordinary aggregates and exact medians side by side; every group is kept."""
    return attach(df.groupBy(*by).agg(*aggregates), medians(df, by, median), list(by))


def average_ranks(df: DataFrame, value: str | Column) -> DataFrame:
    """Distinct values with their count `t` and average rank over all rows."""
    return ranks_of(counted(df, [], value))


def ranks_of(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`average_ranks`, within groups, from the result of `counted`."""
    by = list(by)
    counts = refined(counts, by)
    inside = Window.partitionBy(*by, "_b").orderBy("_v")
    return attach(counts, bucket_offsets(counts, by), [*by, "_b"], "inner").select(
        *by,
        F.col("_v").alias("value"),
        F.col("_n").alias("t"),
        (
            F.col("_before") + F.sum("_n").over(inside) - F.col("_n") + (F.col("_n") + 1) / 2
        ).alias("rank"),
        F.col("_total").alias("n"),
    )


def first_k(df: DataFrame, by: Sequence[str], order: str, k: int) -> DataFrame:
    """The k rows of each group that come first by a whole-number order column.

    Every task keeps the first k of its own rows of a group before anything is
    shuffled (the plan's group limits), so a group with a third of all rows sends k
    rows per task, whatever its order numbers are. Where k is beyond the session's
    bound for such limits, the rows are first cut at a quantile of their group.
    """
    by = list(by)
    if k >= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        df = cut_above(df, by, order, k)
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= k)


def cut_above(df: DataFrame, by: Sequence[str], order: str, k: int, accuracy: int = 20_000) -> DataFrame:
    """`df` without most rows that cannot be among the first k of their group: those
    above the smallest quantile, of a mergeable sketch, that surely has k rows below it."""
    shares = [0.5**i for i in range(1, 14)]
    sketch = df.groupBy(*by).agg(
        F.count(order).alias("_n"), F.percentile_approx(order, shares, accuracy).alias("_cuts")
    )
    # ten times the error of the sketch's ranks
    sure = F.lit(float(k)) / F.col("_n") + F.lit(10.0 / accuracy)
    cut = F.lit(None)
    for i, share in enumerate(shares):
        cut = F.when(sure <= share, F.get("_cuts", F.lit(i))).otherwise(cut)
    limits = sketch.select(*by, cut.alias("_cut"))
    keep = F.col("_cut").isNull() | F.col(order).isNull() | (F.col(order) <= F.col("_cut"))
    return attach(df, limits, by, "inner").where(keep).drop("_cut")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by the order columns; nulls form one key.

    An aggregate, not a window: copies of a hot key are combined before the
    shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def dense_keys(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number rows 1..n in the order of columns that are unique together.

    Rows are range partitioned and sorted; the row index inside a partition is
    fixed by a checkpoint, and the partition sizes (one row per partition)
    give the offsets.
    """
    row = 1 << 33
    placed = checkpoint(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return number_by_position(placed, "_at", name, row)


def number_by_position(df: DataFrame, position: str, name: str, row: int = 1 << 33) -> DataFrame:
    """1..n from stored `partition * 2^33 + index` positions without a gap inside
    a partition; one offset row per partition."""
    part = F.floor(F.col(position) / F.lit(row)).cast("long")
    sizes = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_offset"))
    # one row per partition of the job: bounded by its task count
    return (
        df.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            (F.col("_offset") + F.col(position) % F.lit(row) + 1).alias(name),
            *[c for c in df.columns if c != "_at"],
        )
    )
