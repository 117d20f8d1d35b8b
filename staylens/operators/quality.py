"""Data quality: duplicates, completeness, outliers, rules, profiles, schemas, keys.

Each function documents the data and changes nothing. `order` names the stored
row number that says which rows come first. `by` names tenant columns: every
tenant gets its own rows, labelled `<tenant>.<dataset>`, from one plan for all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from staylens.config import MISSING_NOTES
from staylens.functions.numbers import ratio, round_even
from staylens.functions.parsing import money, num, strip
from staylens.operators.order import attach, counted, first_k, quantiles_of, unpivot

ROW_ID = "_row_id"
SET = "_set"

# Fields with outlier fences.
OUTLIER_FIELDS = ("price", "minimum_nights", "number_of_reviews", "availability_365", "reviews_per_month")

# Text patterns of the inferred types.
INTEGER_TEXT = r"^-?\d+$"
DECIMAL_TEXT = r"^-?\d+(\.\d+)?$"
MONEY_TEXT = r"^\$?-?[\d,]+(\.\d+)?$"
DATE_TEXT = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}"
BOOLEAN_TEXT = ("t", "f", "true", "false")


def columns_of(df: DataFrame, order: str = ROW_ID) -> list[str]:
    return [c for c in df.columns if c != order]


def labelled(df: DataFrame, dataset: str, by: Sequence[str]) -> DataFrame:
    """Adds the label of the tenant's dataset."""
    return df.withColumn(SET, F.concat_ws(".", *[F.col(c) for c in by], F.lit(dataset)))


def row_to_long(df: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]], *keep: str) -> DataFrame:
    """Turn each row of an aggregate into one row per entry of `rows`."""
    entries = [F.struct(*[c.alias(n) for n, c in row]) for row in rows]
    return df.select(*keep, F.inline(F.array(*entries)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that a frame lacks is null; columns sorted by name."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return whole.select(sorted(whole.columns))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with equal columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def as_number(df: DataFrame, name: str, kind=num) -> Column:
    """A text column parsed, a numeric column as it is."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return kind(F.col(name))
    return F.col(name).cast("double")


# ---- duplicates ---------------------------------------------------------


def exact_duplicates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each group of identical rows.

    Only an 8-byte fingerprint per row is shuffled to find groups that may
    repeat; whole rows are compared for those alone. While the repeated
    fingerprints are few, the other rows are dropped where they are read.
    """
    marked = df.select(*by, *columns, F.xxhash64(*by, *columns).alias("_mark"))
    sizes = marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("_n"))
    repeated = sizes.where(F.col("_n") > 1).select("_mark")
    groups = (
        marked.join(repeated, "_mark", "left_semi")
        .groupBy(*by, *columns)
        .agg((F.count(F.lit(1)) - 1).alias("_extra"))
        .groupBy(*by)
        .agg(F.sum("_extra").alias("_extra"))
    )
    every = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    return attach(every, groups, by).select(*by, F.coalesce("_extra", F.lit(0)).alias("duplicate_rows"))


def key_duplicates(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each key, nulls being one key."""
    groups = df.groupBy(*by, *keys).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return groups.groupBy(*by).agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicate_rows"))


def duplicates(
    df: DataFrame, dataset: str, keys: Sequence[str] = (), by: Sequence[str] = (), order: str = ROW_ID
) -> DataFrame:
    columns = columns_of(df, order)
    sets = labelled(df, dataset, by)

    def rows(found: DataFrame, method: str, key: str) -> DataFrame:
        return found.select(
            F.col(SET).alias("dataset"), F.lit(method).alias("method"), F.lit(key).alias("key"), "duplicate_rows"
        )

    parts = [rows(exact_duplicates(sets, columns, [SET]), "exact_row", "<all columns>")]
    if keys and set(keys) <= set(columns):
        parts.append(rows(key_duplicates(sets, keys, [SET]), "primary_key", "+".join(keys)))
    return stack(parts)


def is_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the key, whether it is unique, and the rows that repeat it."""
    return key_duplicates(df, keys).select(
        F.lit("+".join(keys)).alias("key"),
        (F.col("duplicate_rows") == 0).alias("is_unique"),
        "duplicate_rows",
    )


# ---- completeness -------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Missing values and rows of every column, in one pass."""
    one = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(f"_filled_{i}") for i, c in enumerate(columns)],
    )
    return row_to_long(
        one,
        [
            [
                ("field", F.lit(c)),
                ("missing", F.col("_rows") - F.col(f"_filled_{i}")),
                ("rows", F.col("_rows")),
            ]
            for i, c in enumerate(columns)
        ],
        *by,
    )


def completeness(
    df: DataFrame, dataset: str, notes: Mapping[str, str] = MISSING_NOTES, by: Sequence[str] = (), order: str = ROW_ID
) -> DataFrame:
    pairs = [F.lit(x) for pair in notes.items() for x in pair]
    note = F.try_element_at(F.create_map(*pairs), F.col("field")) if pairs else F.lit(None)
    return (
        null_counts(labelled(df, dataset, by), columns_of(df, order), [SET])
        .where("missing > 0")
        .select(
            F.col(SET).alias("dataset"),
            "field",
            "missing",
            round_even(ratio(F.col("missing"), F.col("rows")) * 100, 2).alias("missing_pct"),
            F.coalesce(note, F.lit("")).alias("implication"),
        )
        .orderBy("dataset", F.desc("missing_pct"), "field")
    )


def null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("nulls"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


# ---- outliers -----------------------------------------------------------


def tukey_outliers(
    df: DataFrame,
    dataset: str,
    fields: Sequence[str] = OUTLIER_FIELDS,
    factor: float = 1.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Values outside q1 - k·IQR .. q3 + k·IQR per field; counts come from the
    same table of distinct values as the quartiles."""
    fields = [f for f in fields if f in df.columns]
    typed = labelled(df, dataset, by).select(
        SET, *[as_number(df, f, money if f == "price" else num).alias(f) for f in fields]
    )
    key = [SET, "variable"]
    counts = counted(unpivot(typed, [SET], fields), key, "value")
    quartiles = quantiles_of(counts, key, {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * factor
    # one row per tenant and field
    fences = F.broadcast(
        quartiles.select(*key, "q1", "q3", (F.col("q1") - spread).alias("lo"), (F.col("q3") + spread).alias("hi"))
    )
    out = F.when((F.col("_v") < F.col("lo")) | (F.col("_v") > F.col("hi")), F.col("_n")).otherwise(0)

    def two(c: str | Column) -> Column:
        return round_even(F.col(c) if isinstance(c, str) else c, 2)

    return (
        counts.join(fences, key)
        .groupBy(*key, "q1", "q3", "lo", "hi")
        .agg(
            F.sum(out).alias("n_outliers"), F.sum("_n").alias("n"),
            F.min("_v").alias("low"), F.max("_v").alias("high"),
        )
        .select(
            F.col(SET).alias("dataset"),
            F.col("variable").alias("field"),
            two("q1").alias("q1"), two("q3").alias("q3"),
            two("lo").alias("lower_fence"), two("hi").alias("upper_fence"),
            "n_outliers",
            two(F.col("n_outliers") / F.col("n") * 100).alias("outlier_pct"),
            two("low").alias("min"), two("high").alias("max"),
        )
    )


# ---- rules --------------------------------------------------------------


def listing_rules(
    df: DataFrame, prices: tuple[float, float] = (0.0, 50_000.0), latitudes: tuple[float, float] = (-90.0, 90.0),
    longitudes: tuple[float, float] = (-180.0, 180.0), most_nights: int = 1125,
) -> dict[str, Column]:
    """Domain rules as violation conditions, for the columns that exist."""
    rules: dict[str, Column] = {}
    if "price" in df.columns:
        price = as_number(df, "price", money)
        rules["price_present"] = price.isNull()
        rules["price_gt_0"] = price <= prices[0]
        rules["price_lt_max"] = price > prices[1]
    for name, (low, high) in (("latitude", latitudes), ("longitude", longitudes)):
        if name in df.columns:
            value = as_number(df, name)
            rules[f"{name}_in_range"] = (value < low) | (value > high)
    if "minimum_nights" in df.columns:
        nights = as_number(df, "minimum_nights")
        rules["minimum_nights_sane"] = (nights < 1) | (nights > most_nights)
    return rules


def validate(
    df: DataFrame, rules: Mapping[str, Column], dataset: str, id: str = "id", by: Sequence[str] = (),
    order: str = ROW_ID,
) -> DataFrame:
    """Violations per rule and the first three ids that break it."""
    broken = labelled(df, dataset, by).select(
        SET,
        F.col(id).cast("string").alias("_id"),
        F.col(order).alias("_order"),
        *[F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()],
    )
    one = broken.groupBy(SET).agg(*[F.count_if(F.col(n)).alias(n) for n in rules])
    totals = row_to_long(
        one,
        [[("rule", F.lit(n)), ("violations", F.col(n)), ("_place", F.lit(i))] for i, n in enumerate(rules)],
        SET,
    )
    hits = broken.select(
        SET, "_id", "_order", F.explode(F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in rules]))).alias("rule")
    )
    samples = (
        first_k(hits, [SET, "rule"], "_order", 3)
        .groupBy(SET, "rule")
        .agg(F.array_sort(F.collect_list(F.struct("_nth", "_id"))).alias("_ids"))
        .select(SET, "rule", F.array_join(F.transform("_ids", lambda r: F.coalesce(r["_id"], F.lit("nan"))), ", ").alias("sample_ids"))
    )
    return (
        totals.join(samples, [SET, "rule"], "left")
        .orderBy(SET, "_place")
        .select(F.col(SET).alias("dataset"), "rule", "violations", F.coalesce("sample_ids", F.lit("")).alias("sample_ids"))
    )


# ---- profiles -----------------------------------------------------------


def infer_types(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), order: str = ROW_ID, voters: int = 1000
) -> DataFrame:
    """Likely meaning of each text column, voted by its first `voters` non-null
    values, with the first three of them."""
    long = unpivot(df, [*by, order], columns, "string").where(F.col("value").isNotNull())
    sample = first_k(long, [*by, "variable"], order, voters).withColumn("_t", strip(F.col("value")))

    def share(condition: Column) -> Column:
        return F.avg(condition.cast("double"))

    text = F.col("_t")
    votes = sample.groupBy(*by, "variable").agg(
        share(F.lower(text).isin(*BOOLEAN_TEXT)).alias("boolean"),
        share(text.rlike(INTEGER_TEXT)).alias("integer"),
        share(text.rlike(MONEY_TEXT)).alias("money"),
        F.bool_or(text.rlike(r"[\$,]")).alias("marked"),
        share(text.rlike(DECIMAL_TEXT)).alias("float"),
        share(text.rlike(DATE_TEXT)).alias("date"),
        share(text.endswith("%")).alias("percent"),
        F.array_sort(F.collect_list(F.when(F.col("_nth") <= 3, F.struct("_nth", "value")))).alias("_first"),
    )
    kind = (
        F.when(F.col("boolean") > 0.95, "boolean")
        .when(F.col("integer") > 0.95, "integer")
        .when((F.col("money") > 0.95) & F.col("marked"), "money")
        .when(F.col("float") > 0.95, "float")
        .when(F.col("date") > 0.90, "date")
        .when(F.col("percent") > 0.90, "percent")
        .otherwise("string")
    )
    examples = F.substring(F.array_join(F.transform("_first", lambda r: r["value"]), ", "), 1, 80)
    return votes.select(*by, F.col("variable").alias("column"), kind.alias("inferred_type"), examples.alias("examples"))


def value_key(c: Column) -> Column:
    """Stands for a text value when counting distinct ones; long text by digest,
    so that it need not be shuffled."""
    return F.when(F.length(c) > 64, F.concat(F.lit("sha2:"), F.sha2(c, 256))).otherwise(c)


def distinct_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, non-null and distinct values per column, by two combinable counts."""
    long = unpivot(df, by, columns, "string")
    values = long.groupBy(*by, "variable", value_key(F.col("value")).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return values.groupBy(*by, F.col("variable").alias("column")).agg(
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_n"))), F.lit(0)).alias("non_null"),
        F.count("_key").alias("distinct"),
    )


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = 14) -> DataFrame:
    """A mergeable sketch of the distinct values per column, with rows and non-null
    values: one small row per tenant and column, to be stored beside a snapshot. Of
    2 ** `size` registers; the standard error of a count is 1.04 / 2 ** (`size` / 2)."""
    long = unpivot(df, by, columns, "string")
    return long.groupBy(*by, F.col("variable").alias("column")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("non_null"),
        F.hll_sketch_agg("value", size).alias("sketch"),
    )


def sketched_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`distinct_counts` from stored sketches of any number of snapshots, merged without
    reading their rows again; `distinct` is an estimate."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"),
    )


def profile(
    df: DataFrame, dataset: str, by: Sequence[str] = (), order: str = ROW_ID,
    sparse_pct: float = 40.0, id_ratio: float = 0.9, few: int = 1,
) -> DataFrame:
    """Counts, inferred type, examples and flags of every column; a column that
    only other tenants have shows as empty."""
    columns = columns_of(df, order)
    sets = labelled(df, dataset, by)
    counts = distinct_counts(sets, columns, [SET])
    full = counts.join(infer_types(sets, columns, [SET], order), [SET, "column"], "left").select(
        F.col(SET).alias("dataset"),
        "column",
        F.coalesce("inferred_type", F.lit("empty")).alias("inferred_type"),
        "non_null",
        (F.col("rows") - F.col("non_null")).alias("nulls"),
        ((F.col("rows") - F.col("non_null")) / F.col("rows") * 100).alias("_pct"),
        "distinct",
        round_even(F.col("distinct") / F.col("rows"), 4).alias("cardinality_ratio"),
        F.coalesce("examples", F.lit("")).alias("examples"),
    )
    id_like = (F.col("cardinality_ratio") >= id_ratio) & F.col("inferred_type").isin("string", "integer")
    constant = (F.col("non_null") > 0) & (F.col("distinct") <= few)
    flags = F.concat_ws(
        "|",
        F.when(constant, "constant"),
        F.when(F.col("_pct") >= sparse_pct, "high_null"),
        F.when(id_like, "likely_id_or_freetext"),
    )
    return full.select(
        "dataset", "column", "inferred_type", "non_null", "nulls", round_even(F.col("_pct"), 2).alias("null_pct"),
        "distinct", "cardinality_ratio", "examples", flags.alias("flags"),
    )


def type_distribution(profiles: DataFrame) -> DataFrame:
    return (
        profiles.groupBy("dataset", "inferred_type")
        .agg(F.count(F.lit(1)).alias("n_columns"))
        .orderBy("dataset", F.desc("n_columns"), "inferred_type")
    )


def declared_types(df: DataFrame, order: str = ROW_ID) -> DataFrame:
    """How often each declared type occurs among the columns."""
    kinds = [(dict(df.dtypes)[c],) for c in columns_of(df, order)]
    return (
        df.sparkSession.createDataFrame(kinds, "data_type string")
        .groupBy("data_type")
        .agg(F.count(F.lit(1)).alias("n_columns"))
    )


# ---- schema and keys ----------------------------------------------------


def describe_schema(df: DataFrame, dataset: str, order: str = ROW_ID) -> DataFrame:
    """Name, declared type, smallest and largest value, and the first value."""
    columns = columns_of(df, order)
    measures: list[Column] = []
    rows = []
    for i, name in enumerate(columns):
        kind = df.schema[name].dataType
        ordered = isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
        value = F.col(name)
        measures.append(F.min_by(value.cast("string"), F.when(value.isNotNull(), F.col(order))).alias(f"_first{i}"))
        if ordered:
            measures += [F.min(value).alias(f"_min{i}"), F.max(value).alias(f"_max{i}")]
        rows.append(
            [
                ("dataset", F.lit(dataset)),
                ("column_name", F.lit(name)),
                ("data_type", F.lit(kind.simpleString())),
                ("min_value", F.col(f"_min{i}").cast("string") if ordered else F.lit("N/A")),
                ("max_value", F.col(f"_max{i}").cast("string") if ordered else F.lit("N/A")),
                ("sample_value", F.col(f"_first{i}")),
            ]
        )
    return row_to_long(df.agg(*measures), rows)


def primary_key_candidates(tables: Mapping[str, DataFrame], order: str = ROW_ID) -> DataFrame:
    """Columns without repeated or missing values, in tables that have rows."""
    found = [
        distinct_counts(df, columns_of(df, order))
        .where("distinct = rows")
        .select(F.lit(name).alias("table"), "column")
        for name, df in tables.items()
    ]
    return stack(found)


def foreign_key_candidates(tables: Mapping[str, DataFrame], order: str = ROW_ID) -> DataFrame:
    """Columns whose values all occur in a like-named key candidate of another table:
    the distinct values of all columns, joined once with those of the candidates."""
    values = stack(
        [
            unpivot(df, [], columns_of(df, order), "string")
            .where("value is not null")
            .select(F.lit(name).alias("table"), F.col("variable").alias("column"), "value")
            .distinct()
            for name, df in tables.items()
        ]
    )
    parents = values.join(primary_key_candidates(tables, order), ["table", "column"], "left_semi").select(
        F.col("table").alias("references_table"), F.col("column").alias("references_column"), "value"
    )
    child, key = F.col("column"), F.col("references_column")
    alike = (F.col("table") != F.col("references_table")) & (child.contains(key) | key.contains(child))
    pair = ["table", "column", "references_table", "references_column"]
    inside = values.join(parents, "value").where(alike).groupBy(*pair).agg(F.count(F.lit(1)).alias("_in"))
    whole = values.groupBy("table", "column").agg(F.count(F.lit(1)).alias("_n"))
    return inside.join(whole, ["table", "column"]).where("_in = _n").select(*pair)


def missing_parents(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null child values that the parent lacks."""
    wanted = child.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    return wanted.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


def layer_drift(before: DataFrame, after: DataFrame, order: str = ROW_ID) -> DataFrame:
    """Per column: whether each layer has it and how many values it holds there."""
    def filled(df: DataFrame, name: str) -> DataFrame:
        return null_counts(df, columns_of(df, order)).select(
            F.col("field").alias("column"), (F.col("rows") - F.col("missing")).alias(name)
        )

    joined = filled(before, "before_non_null").join(filled(after, "after_non_null"), "column", "full")
    return joined.select(
        "column",
        F.col("before_non_null").isNotNull().alias("in_before"),
        F.col("after_non_null").isNotNull().alias("in_after"),
        (F.col("before_non_null").isNull()).alias("added"),
        "before_non_null",
        "after_non_null",
    )
