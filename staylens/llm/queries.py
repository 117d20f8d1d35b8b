"""The operators of this folder bound to the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylens.llm.exact_dedup import exact_groups
from staylens.llm.jaccard_join import jaccard_groups
from staylens.llm.line_rules import CLOSING, LEADS, PHRASES, SEPARATORS, line_verdicts
from staylens.llm.mixing import mixed
from staylens.llm.mtree import top_k
from staylens.llm.packing import packed
from staylens.llm.prefix_trie import end_digests, grafted, named_turns, trie
from staylens.llm.quality_cnn import scored
from staylens.llm.repeated_windows import without_repeats
from staylens.llm.style_tree import main_text
from staylens.llm.token_counts import token_counts
from staylens.llm.url_lists import HOST, PATH, listed_captures
from staylens.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@query("op1_mix_sources")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op5_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM t WINDOW same AS (PARTITION BY t)
    """,
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


@query("op6_jaccard_join")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"), words=3, percent=90)


@query("op10_repeated_windows")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op9_token_counts")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query("op2_main_text")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op3_quality_scores")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


WHOLE = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(
    "op4_top_vectors",
    f"""
    WITH v AS (SELECT vec_id, {WHOLE} AS v FROM embeddings WHERE {FINITE}),
    pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM pairs QUALIFY rank <= 5
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


# The pages are the captures. Their fetch days, and a log of entries on their hosts and
# first path segments, follow from page ids by fixed formulas.
FETCHED = "DATE '2024-01-01' + CAST((page_id * 37) % 365 AS INTEGER)"
ENTRY_DAY = "DATE '2024-01-01' + CAST((g * 7 + {shift}) % 365 AS INTEGER)"


@query(
    "op8_url_lists",
    f"""
    WITH captures AS (
        SELECT page_id, url, {FETCHED} AS fetched, lower(regexp_extract(url, '{HOST}', 1)) AS host,
               list_filter(string_split(regexp_extract(url, '{PATH}', 1), '/'), lambda s: s <> '') AS segments
        FROM pages
    ),
    named AS (
        SELECT host AS key, min(page_id) AS g FROM captures WHERE host <> '' GROUP BY 1
        UNION ALL
        SELECT host || '/' || segments[1], min(page_id) FROM captures WHERE host <> '' AND len(segments) > 0 GROUP BY 1
    ),
    entries AS (
        SELECT key, 'add' AS action, {ENTRY_DAY.format(shift=0)} AS since FROM named WHERE g % 3 <> 0
        UNION SELECT key, 'remove', {ENTRY_DAY.format(shift=60)} FROM named WHERE g % 2 = 0
        UNION SELECT key, 'add', {ENTRY_DAY.format(shift=150)} FROM named WHERE g % 5 = 0
    ),
    log AS (SELECT key, since, max(action) = 'add' AS listed FROM entries GROUP BY 1, 2),
    times AS (
        SELECT key, since, listed, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM log
    ),
    keys AS (
        SELECT DISTINCT page_id, fetched, unnest(list_concat(
            list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
            list_transform(range(1, len(segments) + 1), lambda n: host || '/' || array_to_string(segments[1:n], '/'))
        )) AS key
        FROM captures WHERE host <> ''
    ),
    found AS (
        SELECT page_id, count(*) AS n, min(since) AS listed_since, max_by(k.key, (length(k.key), k.key)) AS matched
        FROM keys k JOIN times t ON k.key = t.key AND listed AND since <= fetched AND (until IS NULL OR fetched < until)
        GROUP BY 1
    )
    SELECT c.page_id, c.url, c.fetched, coalesce(n, 0) AS n_active, n IS NOT NULL AS blocked, listed_since, matched
    FROM captures c LEFT JOIN found USING (page_id)
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    captures = table(spark, folder, "pages").selectExpr("page_id", "url", f"{FETCHED} AS fetched")
    host = F.lower(F.regexp_extract("url", HOST, 1))
    first = F.filter(F.split(F.regexp_extract("url", PATH, 1), "/"), lambda s: s != "")
    sited = captures.select("page_id", host.alias("host"), F.get(first, F.lit(0)).alias("first")).where("host <> ''")
    named = sited.groupBy(F.col("host").alias("key")).agg(F.min("page_id").alias("g")).unionByName(
        sited.where("first IS NOT NULL")
        .groupBy(F.concat("host", F.lit("/"), "first").alias("key"))
        .agg(F.min("page_id").alias("g"))
    )
    entries = None
    for action, shift, which in (("add", 0, "g % 3 <> 0"), ("remove", 60, "g % 2 = 0"), ("add", 150, "g % 5 = 0")):
        part = named.where(which).selectExpr("key", f"'{action}' AS action", f"{ENTRY_DAY.format(shift=shift)} AS since")
        entries = part if entries is None else entries.unionByName(part)
    return listed_captures(captures, entries)


def listed(values) -> str:
    """An SQL list of texts."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# CRC-32 of the digits of a number, bit by bit
CRC = """xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT)] || list_transform(range(8), lambda i: -1))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""
SPLIT = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


@query(
    "op11_prefix_trie",
    f"""
    WITH turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos,
               {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    own AS (SELECT conv_id, list(said ORDER BY pos) AS said FROM turns GROUP BY 1),
    rebuilt AS (
        SELECT c.conv_id, coalesce(b.said[1:c.h], []) || c.said[c.h + 1:] AS said
        FROM (SELECT *, CAST({CRC.format("conv_id")} AS BIGINT) % 4 AS h FROM own) c
        LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
    ),
    steps AS (
        SELECT conv_id, d AS depth, said[1:d] AS key, d = len(said) AS ended
        FROM (SELECT *, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)
    ),
    nodes AS (
        SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ends,
               CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len({SPLIT.format("key[depth].t")}) END AS saves
        FROM steps GROUP BY 1, 2
    ),
    children AS (SELECT key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    lines AS (
        SELECT key[1:d] AS key, sum(saves) AS saved, count(*) FILTER (n IS NULL) AS leaves
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM nodes LEFT JOIN children USING (key)) GROUP BY 1
    )
    SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children,
           l.leaves AS n_leaves, CAST(l.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
    FROM nodes x JOIN lines l USING (key) LEFT JOIN children c USING (key)
    LEFT JOIN nodes p ON x.depth > 0 AND p.depth = x.depth - 1 AND p.key = x.key[1:x.depth - 1]
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return trie_digests(table(spark, folder, "conversations"))


def trie_digests(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations, the ends of a node as a digest."""
    turns, conversations = grafted(named_turns(conversations))
    nodes, ends = trie(turns, conversations)
    name = ["depth", "a", "b"]
    return nodes.join(end_digests(ends), name, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


@query(
    "op12_line_rules",
    f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (
        SELECT *, {SPLIT.format("text")} AS words,
               len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
        FROM docs
    ),
    windows AS (
        SELECT row, i, words[i:i + 7] AS run FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM split)
    ),
    twice AS (SELECT row, run FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
    covered AS (
        SELECT row, count(DISTINCT i + k) AS n_repeat_words
        FROM (SELECT row, i, unnest(range(8)) AS k FROM windows JOIN twice USING (row, run)) GROUP BY 1
    ),
    pieces AS (SELECT row, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM split),
    lines AS (
        SELECT *, len(words) AS n, row_number() OVER (PARTITION BY row, line ORDER BY i) > 1 AS again
        FROM (SELECT row, i, line, {SPLIT.format("line")} AS words FROM pieces) WHERE len(words) > 0
    ),
    ruled AS (
        SELECT row, n, again,
               NOT list_bool_or(list_transform({listed(CLOSING)}, lambda e: ends_with(words[-1], e)))
               OR 4 * (len(line) - len(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) > n
               OR 3 * len(regexp_extract_all(line, '[!?]{{2,}}')) > n
               OR len(list_filter(words, lambda w: list_contains({listed(SEPARATORS)}, w))) >= 3
               OR (n < 3 AND list_contains({listed(LEADS)}, lower(array_to_string(words, ' '))))
               OR list_bool_or(list_transform({listed(PHRASES)}, lambda p: contains(lower(line), p)))
               OR again
               OR 2 * len(list_filter(list_zip(words[2:], words[:-2]), lambda w: w[1] = w[2])) > n AS failed
        FROM lines
    ),
    lost AS (
        SELECT row, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(n) FILTER (failed), 0) AS lost FROM ruled GROUP BY 1
    ),
    counted AS (
        SELECT doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: len(w))), 0) AS BIGINT) AS word_chars,
               n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(lost, 0) AS lost
        FROM split LEFT JOIN covered USING (row) LEFT JOIN lost USING (row)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND 100 * lost <= 50 * n_words AS kept
    FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return line_verdicts(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op13_whitened_embeddings")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = whitened(table(spark, folder, "embeddings"))
    # beyond the range of a long (some million vectors) only the operator's decimal holds the deviation
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))
