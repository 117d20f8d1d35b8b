"""Hypothesis tests and correlations.

Spark reduces the data to sufficient statistics (moments, counted values, rank
sums); the closing formulas are column expressions on one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from staylens.functions.numbers import correlation, ratio
from staylens.functions.tails import p_chi2, p_f, p_normal, p_rank_sum, p_t
from staylens.operators.order import attach, average_ranks, counted, medians, ranks_of, unpivot
from staylens.operators.quality import row_to_long

# the exact rank sum test is for small groups; beyond this the normal form has its p
EXACT_ROWS, EXACT_CELLS = 8, 200_000


def effect_label(d: Column) -> Column:
    size = F.abs(d)
    return (
        F.when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").when(size >= 0.8, "large")
    )


def pairs_of(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Non-null values marked 1 for group a and 0 for group b."""
    g = F.col(group)
    mark = F.when(g == F.lit(a), 1).when(g == F.lit(b), 0)
    return df.select(mark.alias("first"), F.col(value).cast("double").alias("x")).where(
        F.col("first").isNotNull() & F.col("x").isNotNull()
    )


def two_moments(pairs: DataFrame, x: Column) -> DataFrame:
    """Count, mean and variance of both groups as one row."""
    measures = []
    for name, mark in (("a", 1), ("b", 0)):
        own = F.when(F.col("first") == mark, x)
        measures += [
            F.count(own).alias(f"n_{name}"), F.avg(own).alias(f"mean_{name}"), F.var_samp(own).alias(f"var_{name}"),
        ]
    return pairs.agg(*measures)


def welch(pairs: DataFrame, log: bool = False) -> DataFrame:
    """Welch t with its degrees of freedom, and Cohen's d on the pooled deviation."""
    one = two_moments(pairs, F.ln("x") if log else F.col("x"))
    na, nb = F.col("n_a"), F.col("n_b")
    ea, eb = ratio(F.col("var_a"), na), ratio(F.col("var_b"), nb)
    gap = F.col("mean_a") - F.col("mean_b")
    pooled = F.sqrt(ratio((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b"), na + nb - 2))
    freedom = ratio((ea + eb) * (ea + eb), ratio(ea * ea, na - 1) + ratio(eb * eb, nb - 1))
    return one.select(
        "n_a", "n_b", ratio(gap, F.sqrt(ea + eb)).alias("t"), freedom.alias("t_df"), ratio(gap, pooled).alias("cohen_d")
    )


def anova(groups: DataFrame) -> DataFrame:
    """F and eta squared from one row per group with n, mean and var; one row."""
    totals = groups.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n_total"),
        F.sum(F.col("n") * F.col("mean")).alias("_sum"),
        F.sum((F.col("n") - 1) * F.coalesce("var", F.lit(0.0))).alias("ss_within"),
    )
    between = attach(groups, totals, [], "inner").groupBy("k", "n_total", "ss_within").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("_sum") / F.col("n_total"), 2)).alias("ss_between")
    )
    k, n = F.col("k"), F.col("n_total")
    f = ratio(ratio(F.col("ss_between"), k - 1), ratio(F.col("ss_within"), n - k))
    eta = ratio(F.col("ss_between"), F.col("ss_between") + F.col("ss_within"))
    return between.select("k", "n_total", f.alias("f"), eta.alias("eta2"))


def levene(pairs: DataFrame, log: bool = False) -> DataFrame:
    """Levene's W around the medians: the F of the distances from each group's median."""
    values = pairs.select("first", (F.ln("x") if log else F.col("x")).alias("x"))
    middle = F.broadcast(medians(values, ["first"], {"_median": "x"}))  # two rows
    far = attach(values, middle, ["first"], "inner")
    gap = F.abs(F.col("x") - F.col("_median"))
    groups = far.groupBy("first").agg(
        F.count(gap).alias("n"), F.avg(gap).alias("mean"), F.var_samp(gap).alias("var")
    )
    return anova(groups).select(F.col("f").alias("levene_w"), "k", "n_total")


def mann_whitney(pairs: DataFrame, alternative: str = "two-sided") -> DataFrame:
    """U of group a and its z with tie and continuity correction."""
    return _rank_sums(pairs, alternative).drop("u_ties")


def _rank_sums(pairs: DataFrame, alternative: str) -> DataFrame:
    own = pairs.groupBy("x").agg(F.sum("first").alias("n_a"))
    ranked = average_ranks(pairs, "x").join(own, F.col("value") == F.col("x"))
    t = F.col("t").cast("double")
    one = ranked.agg(
        F.sum("n_a").alias("n_a"), F.sum("t").alias("n_all"),
        F.sum(F.col("n_a") * F.col("rank")).alias("_ranks"), F.sum(t * t * t - t).alias("_ties"),
    )
    na = F.col("n_a").cast("double")
    nb, n = F.col("n_all") - na, F.col("n_all").cast("double")
    u = F.col("_ranks") - na * (na + 1) / 2
    spread = F.sqrt(na * nb / 12 * (n + 1 - ratio(F.col("_ties"), n * (n - 1))))
    off = u - na * nb / 2
    gap = {"greater": off - 0.5, "less": off + 0.5, "two-sided": F.signum(off) * F.greatest(F.abs(off) - 0.5, F.lit(0.0))}
    return one.select(
        u.alias("u"), ratio(gap[alternative], spread).alias("u_z"),
        (1 - ratio(2 * u, na * nb)).alias("rank_biserial"), F.col("n_a"), nb.cast("long").alias("n_b"),
        (F.col("_ties") > 0).alias("u_ties"),
    )


def two_group_statistics(df: DataFrame, value: str, group: str, a, b, alternative: str = "two-sided", log: bool = False) -> DataFrame:
    """Group sizes and medians, Levene, Welch, Mann-Whitney and effect sizes; one row."""
    return _two_groups(df, value, group, a, b, alternative, log).drop("u_ties")


def _two_groups(df: DataFrame, value: str, group: str, a, b, alternative: str, log: bool) -> DataFrame:
    pairs = pairs_of(df, value, group, a, b)
    middle = medians(pairs, ["first"], {"m": "x"}).agg(
        F.max(F.when(F.col("first") == 1, F.col("m"))).alias("median_a"),
        F.max(F.when(F.col("first") == 0, F.col("m"))).alias("median_b"),
    )
    base = welch(pairs, log)
    base = attach(base, levene(pairs, log).select("levene_w"), [])
    base = attach(base, _rank_sums(pairs, alternative).select("u", "u_z", "rank_biserial", "u_ties"), [])
    return attach(base, middle, []).select(
        "n_a", "n_b", "median_a", "median_b", "levene_w", "t", "t_df", "u", "u_z",
        "cohen_d", effect_label(F.col("cohen_d")).alias("effect"), F.abs("rank_biserial").alias("rank_biserial"),
        "u_ties",
    )


def two_group_test(df: DataFrame, value: str, group: str, a, b, alternative: str = "two-sided", log: bool = False) -> DataFrame:
    """`two_group_statistics` with p-values (Levene is two-sided as always). Mann-Whitney's
    is exact where a group has at most 8 values and no values are equal."""
    one = _two_groups(df, value, group, a, b, alternative, log)
    exact = ~F.col("u_ties") & (F.least("n_a", "n_b") <= EXACT_ROWS) & (F.col("n_a") * F.col("n_b") <= EXACT_CELLS)
    normal = F.when(F.col("u_z").isNotNull(), F.least(p_normal(F.col("u_z"), alternative), F.lit(1.0)))
    return one.select(
        "*",
        p_f(F.col("levene_w"), F.lit(1.0), (F.col("n_a") + F.col("n_b") - 2).cast("double")).alias("levene_p"),
        p_t(F.col("t"), F.col("t_df"), alternative).alias("t_p"),
        F.when(exact, p_rank_sum(F.when(exact, F.col("u")), F.col("n_a"), F.col("n_b"), alternative)).otherwise(normal).alias("u_p"),
    ).drop("u_ties")


def k_group_statistics(df: DataFrame, value: str, group: str, min_size: int = 30, log: bool = True) -> DataFrame:
    """F and eta squared on (log) values, Kruskal-Wallis H and epsilon squared, over
    the groups with at least `min_size` values; a null group counts as one."""
    values = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    x = F.ln("x") if log else F.col("x")
    groups = values.groupBy("g").agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"))
    kept = groups.where(F.col("n") >= min_size)
    counts = attach(counted(values, ["g"], "x"), kept.select("g", "n"), ["g"], "inner")
    ranks = ranks_of(counts.groupBy("_b", "_v").agg(F.sum("_n").alias("_n")))
    sums = (
        counts.join(ranks.select(F.col("value").alias("_v"), "rank"), "_v")
        .groupBy("g", F.col("n").alias("size"))
        .agg(F.sum(F.col("_n") * F.col("rank")).alias("r"))
    )
    t = F.col("t").cast("double")
    ties = ranks.agg(F.sum(t * t * t - t).alias("ties"))
    spread = sums.agg(F.sum(F.col("r") * F.col("r") / F.col("size")).alias("spread"))
    one = attach(attach(anova(kept), spread, []), ties, [])
    n, k = F.col("n_total").cast("double"), F.col("k")
    raw = ratio(F.lit(12.0), n * (n + 1)) * F.col("spread") - 3 * (n + 1)
    h = ratio(raw, 1 - ratio(F.col("ties"), n * n * n - n))
    return one.withColumn("h", h).select(
        "k", "n_total", "f", "eta2", "h", ratio(F.col("h") - k + 1, n - k).alias("epsilon2")
    )


def k_group_test(df: DataFrame, value: str, group: str, min_size: int = 30, log: bool = True) -> DataFrame:
    one = k_group_statistics(df, value, group, min_size, log)
    k, n = F.col("k").cast("double"), F.col("n_total").cast("double")
    return one.select("*", p_f(F.col("f"), k - 1, n - k).alias("f_p"), p_chi2(F.col("h"), k - 1).alias("h_p"))


def two_proportion_statistics(df: DataFrame, flag: str, group: str, a, b) -> DataFrame:
    """Shares of true, pooled z and Cohen's h of two groups; null flags are left out."""
    f = F.col(flag)
    measures = []
    for name, key in (("a", a), ("b", b)):
        own = F.when(F.col(group) == F.lit(key), f)
        measures += [F.count(own).alias(f"n_{name}"), F.count_if(own).alias(f"_true_{name}")]
    one = df.agg(*measures)
    na, nb = F.col("n_a"), F.col("n_b")
    pa, pb = ratio(F.col("_true_a"), na), ratio(F.col("_true_b"), nb)
    pool = ratio(F.col("_true_a") + F.col("_true_b"), na + nb)
    z = ratio(pa - pb, F.sqrt(pool * (1 - pool) * (ratio(F.lit(1.0), na) + ratio(F.lit(1.0), nb))))
    h = 2 * F.asin(F.sqrt(pa)) - 2 * F.asin(F.sqrt(pb))
    return one.select("n_a", "n_b", pa.alias("share_a"), pb.alias("share_b"), z.alias("z"), h.alias("cohen_h"))


def two_proportion_test(df: DataFrame, flag: str, group: str, a, b) -> DataFrame:
    return two_proportion_statistics(df, flag, group, a, b).withColumn("p", p_normal(F.col("z"), "two-sided"))


# ---- correlation and fit ------------------------------------------------


def corr_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with the target, strongest first."""
    one = df.agg(*[correlation(F.col(c), F.col(target)).alias(c) for c in columns])
    long = row_to_long(one, [[("variable", F.lit(c)), ("corr", F.col(c))] for c in columns])
    return long.orderBy(F.desc(F.abs("corr")), "variable")


def corr_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(correlation(F.col(a), F.col(b)).alias("corr"))


def slope(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair of columns over rows without a null. All columns
    are ranked as one long table, whose ranks are joined back and laid out once."""
    whole = df.select(*[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]).dropna()
    names = [f"_c{i}" for i in range(len(columns))]
    long = unpivot(whole.withColumn("_row", F.monotonically_increasing_id()), ["_row"], names)
    ranks = ranks_of(counted(long, ["variable"], "value"), ["variable"]).select("variable", "value", "rank")
    ranked = long.join(ranks, ["variable", "value"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("variable") == c, F.col("rank"))).alias(f"_r{i}") for i, c in enumerate(names)]
    )
    pairs = list(combinations(range(len(columns)), 2))
    one = ranked.agg(*[correlation(F.col(f"_r{i}"), F.col(f"_r{j}")).alias(f"_{i}_{j}") for i, j in pairs])

    def entry(i: int, j: int):
        rho = F.lit(1.0) if i == j else F.col(f"_{min(i, j)}_{max(i, j)}")
        return [("column_a", F.lit(columns[i])), ("column_b", F.lit(columns[j])), ("rho", rho)]

    size = range(len(columns))
    return row_to_long(one, [entry(i, j) for i in size for j in size])


def ols(df: DataFrame, y: Column, xs: Sequence[str]) -> DataFrame:
    """Least squares on rows without a null: one row per term, with R squared."""
    rows = df.select(y.cast("double").alias("_y"), *[F.col(x).cast("double").alias(x) for x in xs]).dropna()
    vectors = VectorAssembler(inputCols=list(xs), outputCol="_x").transform(rows)
    model = LinearRegression(
        featuresCol="_x", labelCol="_y", solver="normal", regParam=0.0, standardization=False
    ).fit(vectors)
    terms = [("Intercept", float(model.intercept))] + [(x, float(w)) for x, w in zip(xs, model.coefficients)]
    r2 = float(model.summary.r2)
    return df.sparkSession.createDataFrame([(t, w, r2) for t, w in terms], "term string, coefficient double, r2 double")
