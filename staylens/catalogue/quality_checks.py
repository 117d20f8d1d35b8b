"""Duplicates, completeness, outliers, rules, profiles, schemas and near copies (D, J6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalogue.registry import RAW, query
from staylens.catalogue.scalars import PRICE, sql_number
from staylens.config import MISSING_NOTES
from staylens.operators import quality, similar
from staylens.session import checkpoint

PROFILED = tuple(c for c in RAW if c != "_row_id")


def long_sql(view: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT _row_id, '{c}' AS variable, {c} AS value FROM {view}" for c in columns)


TWICE = "(SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 3 = 0)"


@query(
    "D1_exact_duplicates",
    "SELECT 'events' AS dataset, 'exact_row' AS method, '<all columns>' AS key, "
    f"CAST((SELECT count(*) FROM {TWICE}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {TWICE})) AS BIGINT) AS duplicate_rows",
)
def _(t):
    events = t.table("events")
    return quality.duplicates(events.unionByName(events.where("event_id % 3 = 0")), "events")


@query(
    "D2_key_duplicates",
    "SELECT r_name || '.lines' AS dataset, 'primary_key' AS method, 'l_orderkey+l_linenumber' AS key, CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicate_rows "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
)
def _(t):
    lines = t._placed(t.table("lineitem").join(t.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")), "s_nationkey")
    keyed = lines.select("r_name", "l_orderkey", "l_linenumber")
    return quality.duplicates(keyed, "lines", ["l_orderkey", "l_linenumber"], ["r_name"]).where("method = 'primary_key'")


@query(
    "D4_completeness",
    "WITH m AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST(count(*) - count({c}) AS BIGINT) AS missing, count(*) AS n FROM raw" for c in PROFILED
    ) + ") SELECT 'raw' AS dataset, field, missing, round_even(missing * 100e0 / n, 2) AS missing_pct, "
    "CASE " + " ".join(f"WHEN field = '{c}' THEN '{note.replace(chr(39), chr(39) * 2)}'" for c, note in MISSING_NOTES.items()) + " ELSE '' END AS implication "
    "FROM m WHERE missing > 0",
)
def _(t):
    return quality.completeness(t.raw(*PROFILED), "raw")


def outlier_sql(field: str, value: str) -> str:
    return (
        f"SELECT 'raw' AS dataset, '{field}' AS field, round_even(q1, 2) AS q1, round_even(q3, 2) AS q3, "
        "round_even(q1 - 1.5e0 * (q3 - q1), 2) AS lower_fence, round_even(q3 + 1.5e0 * (q3 - q1), 2) AS upper_fence, "
        "CAST(count(*) FILTER (v < q1 - 1.5e0 * (q3 - q1) OR v > q3 + 1.5e0 * (q3 - q1)) AS BIGINT) AS n_outliers, "
        "round_even(count(*) FILTER (v < q1 - 1.5e0 * (q3 - q1) OR v > q3 + 1.5e0 * (q3 - q1)) * 100e0 / count(*), 2) AS outlier_pct, "
        "round_even(min(v), 2) AS min, round_even(max(v), 2) AS max "
        f"FROM (SELECT {value} AS v FROM raw WHERE {value} IS NOT NULL) CROSS JOIN "
        f"(SELECT quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3 FROM raw) GROUP BY q1, q3"
    )


@query("D5_outliers", outlier_sql("price", f"({PRICE})") + " UNION ALL " + outlier_sql("minimum_nights", f"({sql_number('minimum_nights')})"))
def _(t):
    return quality.tukey_outliers(t.raw("price", "minimum_nights"), "raw")


RULES = {
    "price_present": f"({PRICE}) IS NULL",
    "price_gt_0": f"({PRICE}) <= 0",
    "price_lt_max": f"({PRICE}) > 50000",
    "latitude_in_range": f"({sql_number('latitude')}) < -90 OR ({sql_number('latitude')}) > 90",
    "longitude_in_range": f"({sql_number('longitude')}) < -180 OR ({sql_number('longitude')}) > 180",
    "minimum_nights_sane": f"({sql_number('minimum_nights')}) < 1 OR ({sql_number('minimum_nights')}) > 1125",
}


@query(
    "D6_rules",
    " UNION ALL ".join(
        f"SELECT 'raw' AS dataset, '{rule}' AS rule, CAST(count(*) AS BIGINT) AS violations, "
        f"coalesce(string_agg(id, ', ' ORDER BY _row_id) FILTER (nth <= 3), '') AS sample_ids "
        f"FROM (SELECT id, _row_id, row_number() OVER (ORDER BY _row_id) AS nth FROM raw WHERE {test})"
        for rule, test in RULES.items()
    ),
)
def _(t):
    raw = t.raw("_row_id", "id", "price", "latitude", "longitude", "minimum_nights")
    return quality.validate(raw, quality.listing_rules(raw), "raw")


INFERRED = f"""SELECT variable AS "column", CASE
    WHEN avg(CASE WHEN lower(v) IN ('t','f','true','false') THEN 1e0 ELSE 0e0 END) > 0.95 THEN 'boolean'
    WHEN avg(CASE WHEN regexp_matches(v, '^-?\\d+$') THEN 1e0 ELSE 0e0 END) > 0.95 THEN 'integer'
    WHEN avg(CASE WHEN regexp_matches(v, '^\\$?-?[\\d,]+(\\.\\d+)?$') THEN 1e0 ELSE 0e0 END) > 0.95 AND bool_or(regexp_matches(v, '[$,]')) THEN 'money'
    WHEN avg(CASE WHEN regexp_matches(v, '^-?\\d+(\\.\\d+)?$') THEN 1e0 ELSE 0e0 END) > 0.95 THEN 'float'
    WHEN avg(CASE WHEN regexp_matches(v, '^\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}') THEN 1e0 ELSE 0e0 END) > 0.90 THEN 'date'
    WHEN avg(CASE WHEN v LIKE '%\\%' ESCAPE '\\' THEN 1e0 ELSE 0e0 END) > 0.90 THEN 'percent' ELSE 'string' END AS inferred_type,
    substr(string_agg(value, ', ' ORDER BY nth) FILTER (nth <= 3), 1, 80) AS examples
    FROM (SELECT variable, value, trim(value) AS v, row_number() OVER (PARTITION BY variable ORDER BY _row_id) AS nth
      FROM ({long_sql('raw', PROFILED)}) WHERE value IS NOT NULL) WHERE nth <= 1000 GROUP BY variable"""


@query("D7_inferred_types", INFERRED)
def _(t):
    return quality.infer_types(t.raw("_row_id", *PROFILED), PROFILED)


PROFILE = f"""WITH kinds AS ({INFERRED}), counts AS (SELECT variable, count(*) AS n, count(value) AS filled, count(DISTINCT value) AS different
      FROM ({long_sql('raw', PROFILED)}) GROUP BY variable),
    p AS (SELECT 'raw' AS dataset, variable AS "column", coalesce(inferred_type, 'empty') AS inferred_type, CAST(filled AS BIGINT) AS non_null,
      CAST(n - filled AS BIGINT) AS nulls, round_even((n - filled) * 100e0 / n, 2) AS null_pct, CAST(different AS BIGINT) AS "distinct",
      round_even(different * 1e0 / n, 4) AS cardinality_ratio, coalesce(examples, '') AS examples
      FROM counts LEFT JOIN kinds ON variable = "column")
    SELECT *, concat_ws('|', CASE WHEN non_null > 0 AND "distinct" <= 1 THEN 'constant' END,
      CASE WHEN nulls * 100e0 / (nulls + non_null) >= 40 THEN 'high_null' END,
      CASE WHEN cardinality_ratio >= 0.9 AND inferred_type IN ('string', 'integer') THEN 'likely_id_or_freetext' END) AS flags FROM p"""


@query("D8_column_profile", PROFILE)
def _(t):
    return quality.profile(t.raw("_row_id", *PROFILED), "raw")


@query(
    "D9_type_distribution",
    f"WITH prof AS ({PROFILE.replace('WITH kinds', 'WITH kinds', 1)}) SELECT dataset, inferred_type, CAST(count(*) AS BIGINT) AS n_columns FROM prof GROUP BY 1, 2",
)
def _(t):
    return quality.type_distribution(quality.profile(t.raw("_row_id", *PROFILED), "raw"))


@query(
    "D9_declared_types",
    "SELECT CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' ELSE 'timestamp_ntz' END AS data_type, "
    "CAST(count(*) AS BIGINT) AS n_columns FROM information_schema.columns WHERE table_name = 'lineitem' GROUP BY 1",
)
def _(t):
    return quality.declared_types(t.table("lineitem"))


@query(
    "D10_schema",
    " UNION ALL ".join(
        f"SELECT 'customer' AS dataset, '{c}' AS column_name, '{kind}' AS data_type, "
        f"{'CAST(min(' + c + ') AS VARCHAR)' if ordered else repr('N/A')} AS min_value, {'CAST(max(' + c + ') AS VARCHAR)' if ordered else repr('N/A')} AS max_value, "
        f"CAST(arg_min({c}, c_custkey) AS VARCHAR) AS sample_value FROM customer"
        for c, kind, ordered in (
            ("c_name", "string", False), ("c_nationkey", "int", True), ("c_acctbal", "double", True), ("c_mktsegment", "string", False)
        )
    ),
)
def _(t):
    return quality.describe_schema(t.table("customer"), "customer", order="c_custkey")


KEY_TABLES = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
}


@query(
    "D11_primary_key_candidates",
    " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\" FROM {table} HAVING count(DISTINCT {c}) = count(*) AND count(*) > 0"
        for table, columns in KEY_TABLES.items()
        for c in columns
    ),
)
def _(t):
    return quality.primary_key_candidates({k: t.table(k).select(*c) for k, c in KEY_TABLES.items()})


def _linked(t):
    return {
        "listing": t.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("room_type")),
        "calendar": t.table("lineitem").select(F.col("l_orderkey").alias("listing_id"), F.col("l_returnflag").alias("state")),
        "reviews": t.table("events").select(F.col("event_id").alias("id"), F.col("user_id").alias("listing_id")),
    }


INCLUDED = (
    "SELECT '{child}' AS \"table\", '{column}' AS \"column\", '{parent}' AS references_table, 'id' AS references_column "
    "WHERE NOT EXISTS (SELECT {c} FROM {ct} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {p} FROM {pt})) AND EXISTS (SELECT 1 FROM {ct} WHERE {c} IS NOT NULL)"
)


@query(
    "D12_foreign_key_candidates",
    " UNION ALL ".join(
        INCLUDED.format(child=child, column=column, parent=parent, c=c, ct=ct, p=p, pt=pt)
        for child, column, parent, c, ct, p, pt in (
            ("calendar", "listing_id", "listing", "l_orderkey", "lineitem", "o_orderkey", "orders"),
            ("reviews", "id", "listing", "event_id", "events", "o_orderkey", "orders"),
            ("reviews", "listing_id", "listing", "user_id", "events", "o_orderkey", "orders"),
            ("listing", "id", "reviews", "o_orderkey", "orders", "event_id", "events"),
            ("calendar", "listing_id", "reviews", "l_orderkey", "lineitem", "event_id", "events"),
        )
    ),
)
def _(t):
    return quality.foreign_key_candidates(_linked(t))


@query(
    "D13_key_uniqueness",
    " UNION ALL ".join(
        f"SELECT '{'+'.join(keys)}' AS key, count(*) = count(DISTINCT ({', '.join(keys)})) AS is_unique, CAST(count(*) - count(DISTINCT ({', '.join(keys)})) AS BIGINT) AS duplicate_rows FROM {table}"
        for table, keys in (("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("conversations", ["conv_id", "turn"]))
    ),
)
def _(t):
    checks = (("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("conversations", ["conv_id", "turn"]))
    return quality.stack([quality.is_unique(t.table(name), keys) for name, keys in checks])


@query(
    "D14_layer_drift",
    """SELECT column_name AS "column", max(b) IS NOT NULL AS in_before, max(a) IS NOT NULL AS in_after, max(b) IS NULL AS added, max(b) AS before_non_null, max(a) AS after_non_null
    FROM (SELECT 'price' AS column_name, CAST(count(price) AS BIGINT) AS b, CAST(count(price) AS BIGINT) AS a FROM listing
    UNION ALL SELECT 'bedrooms', CAST(count(bedrooms) AS BIGINT), CAST(count(bedrooms) AS BIGINT) FROM listing
    UNION ALL SELECT 'city', NULL, CAST(count(city) AS BIGINT) FROM listing) GROUP BY 1""",
)
def _(t):
    return quality.layer_drift(t.listing("price", "bedrooms"), t.listing("price", "bedrooms", "city"))


@query("D15_distinct_values", "SELECT DISTINCT license FROM raw")
def _(t):
    return quality.distinct_values(t.raw("license"), "license")


@query("D15_distinct_count", "SELECT 'price' AS \"column\", CAST(count(*) AS BIGINT) AS rows, CAST(count(price) AS BIGINT) AS non_null, CAST(count(DISTINCT price) AS BIGINT) AS \"distinct\" FROM listing")
def _(t):
    return quality.distinct_counts(t.listing("price"), ["price"])


@query("D16_null_count", "SELECT CAST(count(*) - count(review_scores_rating) AS BIGINT) AS nulls FROM listing")
def _(t):
    return quality.null_count(t.listing("review_scores_rating"), "review_scores_rating")


def _named_parts(t, names: str = "p_name"):
    """Parts on a small map: many share a cell, and their names are short or long."""
    place = F.col("p_partkey")
    # few bytes of many rows: their names are taken apart by all tasks, not by the one that reads a file
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t.table("part").repartition(parts).select(
        place.alias("_row_id"), place.alias("id"), F.expr(names).alias("name"), F.col("p_type").alias("room_type"),
        (place % 20 / 100).alias("latitude"), (place % 3 / 100).alias("longitude"),
    )


LONG_NAME = (
    "concat(p_brand, ' house with garden and a view over the old town ', CAST(p_size AS STRING), ' steps from the sea')"
)
TOKENS = "array_to_string(list_sort(string_split(trim({c}), ' ')), ' ')"


CELLS = f"""SELECT 'part' AS _set, CAST(round_even((p_partkey % 20 / 100e0) / 0.0005e0, 0) AS BIGINT) AS _y,
    CAST(round_even((p_partkey % 3 / 100e0) / 0.0005e0, 0) AS BIGINT) AS _x, '=' || p_type AS _block, p_partkey AS id, {{text}} AS _text FROM part"""


@query(
    "D3_J6_near_copies_short_names",
    f"""WITH n AS (SELECT _set, _y, _x, _block, _text, CAST(count(*) AS BIGINT) AS n FROM ({CELLS.format(text=TOKENS.format(c='p_name'))}) GROUP BY ALL HAVING count(*) > 1)
    SELECT _set, _y, _x, _block, _text AS _one, _text AS _two, 0 AS _distance, 100 AS score, n AS rows_a, n AS rows_b FROM n""",
)
def _(t):
    return similar.similar_names(similar.cell_names(_named_parts(t), "part")).withColumn("_distance", F.col("_distance").cast("int"))


# The length of the longest common subsequence: a row of the usual table per letter of
# one name, for the pairs that a Levenshtein distance no larger lets through.
COMMON = (
    "list_reduce(list_prepend([x * 0 for x in range(len({b}) + 1)], list_transform(range(1, len({a}) + 1), lambda i: [i])), "
    "lambda old, i: list_reduce(range(1, len({b}) + 1), lambda new, j: list_append(new, "
    "CASE WHEN {a}[i[1]] = {b}[j] THEN old[j] + 1 ELSE greatest(old[j + 1], new[j]) END), [CAST(0 AS BIGINT)]))[len({b}) + 1]"
)
NEAR_NAMES = f"""n AS (SELECT _set, _y, _x, _block, _text, CAST(count(*) AS BIGINT) AS n FROM ({CELLS.format(text=TOKENS.format(c=f'({LONG_NAME})'))}) GROUP BY ALL),
    near AS (SELECT a._set, a._y, a._x, a._block, a._text AS _one, b._text AS _two, a.n AS rows_a, b.n AS rows_b, len(a._text) + len(b._text) AS joint
      FROM n a JOIN n b ON a._y = b._y AND a._x = b._x AND a._block = b._block AND (len(a._text) < len(b._text) OR (len(a._text) = len(b._text) AND a._text < b._text))
      WHERE levenshtein(a._text, b._text) <= floor((len(a._text) + len(b._text)) * 2 / 100)),
    tested AS (SELECT *, CAST(joint - 2 * {COMMON.format(a='_one', b='_two')} AS INTEGER) AS _distance FROM near),
    matched AS (SELECT * FROM tested WHERE _distance <= floor(joint * 2 / 100)
      UNION ALL SELECT _set, _y, _x, _block, _text, _text, n, n, 2 * len(_text), 0 FROM n WHERE n > 1)"""


@query(
    "D3_J6_near_copy_names",
    f"WITH {NEAR_NAMES} SELECT _set, _y, _x, _block, _one, _two, _distance, CAST(floor((joint - _distance) * 100 / joint) AS INTEGER) AS score, rows_a, rows_b FROM matched",
)
def _(t):
    rows = similar.cell_names(_named_parts(t, LONG_NAME), "part")
    return similar.similar_names(rows).withColumn("_distance", F.col("_distance").cast("int"))


@query(
    "D3_J6_near_copy_pairs",
    f"WITH {NEAR_NAMES} SELECT CAST(coalesce(sum(CASE WHEN _one = _two THEN rows_a * (rows_a - 1) / 2 ELSE rows_a * rows_b END), 0) AS BIGINT) AS pairs FROM matched",
)
def _(t):
    rows = similar.cell_names(_named_parts(t, LONG_NAME), "part")
    return similar.pair_count(rows, similar.similar_names(rows))


@query("J10_dictionary_lookup", "SELECT id, CASE flag WHEN 't' THEN 'yes' WHEN 'f' THEN 'no' END AS answer FROM raw")
def _(t):
    known = F.create_map(*[F.lit(x) for x in ("t", "yes", "f", "no")])
    return t.raw("id", "flag").select("id", F.try_element_at(known, F.col("flag")).alias("answer"))


@query(
    "A29_distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS rows, CAST(count({c}) AS BIGINT) AS non_null, CAST(count(DISTINCT {c}) AS BIGINT) AS \"distinct\" FROM documents"
        for c in ("text", "lang", "source")
    ),
)
def _(t):
    return quality.distinct_counts(t.table("documents"), ["text", "lang", "source"])


@query(
    "A29_D8_sketched_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS rows, CAST(count({c}) AS BIGINT) AS non_null, CAST(count(DISTINCT {c}) AS BIGINT) AS exact, TRUE AS close FROM listing"
        for c in ("id", "host_id", "neighbourhood", "price")
    ),
)
def _(t):
    """Sketches of every tenant, stored and merged over all of them, beside exact counts.
    Close: within 3.3 %, four standard errors of 2 ** 14 registers."""
    columns = ["id", "host_id", "neighbourhood", "price"]
    listing = t.listing("city_key", *columns)
    stored = checkpoint(quality.distinct_sketches(listing, columns, ["city_key"]))
    exact = quality.distinct_counts(listing, columns).select("column", F.col("distinct").alias("exact"))
    gap = F.abs(F.col("distinct") - F.col("exact"))
    return quality.sketched_counts(stored).join(exact, "column").select(
        "column", "rows", "non_null", "exact", (gap <= 0.033 * F.col("exact")).alias("close")
    )


assert set(PROFILED) <= set(RAW)
