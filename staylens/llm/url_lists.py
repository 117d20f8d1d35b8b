"""URL filters as a temporal list join.

A list is a log of dated entries: a key is listed (`add`) or taken off (`remove`) from
a moment on. A key is a domain, which covers its subdomains, or a host with a path
prefix, which covers the paths below it. The entries of a key become validity
intervals, and every capture meets the entries that were active when it was fetched.

Intervals are cut at the borders of fixed periods, and so are captures, so the as-of
join is an equality on key and period with a range inside it: a key with a long
history does not pair each of its captures with its whole history, and a key with
very many captures is split by adaptive execution. The next entry of a key is found
inside its period first and then over its periods, so no task orders the whole log
of a key.

All steps are DataFrame operations. Entries with a null key or moment say nothing.
Of several entries of a key at one moment `remove` wins, entries with other actions
are left out. A capture without url, host or fetch moment matches nothing and is kept
with 0 matches. Rows that repeat a capture are evaluated one by one; an entry that
is repeated counts once. Urls are read whole; a url with a path of n segments makes n
keys, the longest as long as the url. Empty tables give an empty result, or 0 matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens.llm.store import clear_of

PERIOD_DAYS = 30
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: str | Column) -> Column:
    """The host in lower case, empty if there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def list_keys(host: Column, path: Column) -> Column:
    """Keys that a list may hold for a host and path: the host and its parent domains,
    and the host with each prefix of whole path segments."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.transform(
        F.when(F.size(segments) > 0, F.sequence(F.lit(1), F.size(segments))).otherwise(F.array().cast("array<int>")),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, n), "/")),
    )
    return F.array_distinct(F.concat(domains, prefixes))


def intervals(entries: DataFrame, key: str = "key", action: str = "action", since: str = "since") -> DataFrame:
    """`key`, `since`, `until` (null: still valid) of the times a key is listed."""
    known = entries.select(F.col(key).alias("key"), F.col(action).alias("action"), F.col(since).alias("since")).where(
        F.col("key").isNotNull() & F.col("since").isNotNull() & F.col("action").isin("add", "remove")
    )
    log = known.groupBy("key", "since").agg((F.max("action") == "add").alias("listed"))
    placed = log.withColumn("period", period_of(F.col("since")))
    inside = Window.partitionBy("key", "period").orderBy("since")
    # one row per period of a key
    later = Window.partitionBy("key").orderBy("period")
    firsts = placed.groupBy("key", "period").agg(F.min("since").alias("first")).select(
        "key", "period", F.lead("first").over(later).alias("next_first")
    )
    return (
        placed.withColumn("next_inside", F.lead("since").over(inside))
        .join(firsts, ["key", "period"])
        .where("listed")
        .select("key", "since", F.coalesce("next_inside", "next_first").alias("until"))
    )


def period_of(moment: Column) -> Column:
    return F.floor(F.unix_date(moment.cast("date")) / PERIOD_DAYS).cast("int")


def listed_captures(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched",
    key: str = "key", action: str = "action", since: str = "since",
) -> DataFrame:
    """`captures` with `n_active` (entries active at the fetch that cover the url),
    `blocked`, `listed_since` (the earliest of them) and `matched` (the longest key)."""
    last = captures.agg(F.max(F.col(fetched))).first()[0]
    host = host_of("u")
    # a url fetched at one moment is evaluated once, however many captures say so
    asked = captures.select(F.col(url).alias("u"), F.col(fetched).alias("at")).distinct()
    keyed = asked.where((host_of("u") != "") & F.col("at").isNotNull()).select(
        "u", "at", period_of(F.col("at")).alias("period"),
        F.explode(list_keys(host, F.regexp_extract("u", PATH, 1))).alias("key"),
    )
    horizon = F.lit(last).cast(captures.schema[fetched].dataType)
    periods = F.sequence(
        period_of(F.col("since")), period_of(F.greatest("since", F.coalesce(F.col("until"), horizon)))
    )
    spans = intervals(entries, key, action, since).where(F.col("since") <= horizon).select(
        "key", "since", "until", F.explode(periods).alias("period")
    )
    active = (F.col("since") <= F.col("at")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    found = (
        keyed.join(spans, ["key", "period"])
        .where(active)
        .groupBy("u", "at")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("since").alias("first"),
            F.max_by("key", F.struct(F.length("key"), F.col("key"))).alias("longest"),
        )
    )
    own = [c for c in captures.columns if c not in ("n_active", "blocked", "listed_since", "matched")]
    place, moment, n, first, longest = clear_of(own, "u", "at", "n", "first", "longest")
    side = found.select(*[F.col(a).alias(b) for a, b in zip(("u", "at", "n", "first", "longest"), (place, moment, n, first, longest))])
    return captures.join(side, (F.col(url) == F.col(place)) & (F.col(fetched) == F.col(moment)), "left").select(
        *[F.col(f"`{c}`") for c in own],
        F.coalesce(F.col(n), F.lit(0)).alias("n_active"),
        F.col(n).isNotNull().alias("blocked"),
        F.col(first).alias("listed_since"),
        F.col(longest).alias("matched"),
    )
