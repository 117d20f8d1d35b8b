"""N-gram Jaccard join with signature trees.

Two documents link when the Jaccard similarity of their sets of word shingles is at
least `percent` / 100. The result is each document's component of links.

1. Documents with equal sets are one node (a 64-bit name of the set).
2. Candidate clusters. Two sets that link differ in at most D shingles, and D
   follows from the size. The range of hashes is cut into an eighth more than D
   parts, so at least that eighth is equal in both: nodes that share as many parts of
   their size range with others meet in a candidate cluster, and no link leaves one.
   A line or passage that many texts hold fills few parts and brings nobody together.
3. The most connected node of each cluster is its pivot; every other node is tested
   against it. That settles clusters of copies of one text in linear work.
4. Nodes that the pivot did not reach are joined with all nodes of their cluster in
   pages of bounded size. A page is a signature tree: its leaves are the sets as
   bitmaps, ordered by smallest hash, and an inner node holds the OR of its bitmaps
   and the range of its sizes. A dual traversal of two trees drops a pair of
   nodes when the largest overlap that their bitmaps and sizes allow is too small
   for a link. Pairs of leaves that stay are tested on the sets.
5. Components of the links.

Pages are cut by hash inside a size class, so a cluster of any size is spread over
tasks; classes that no link can span never meet.

Null, empty and blank texts have the empty set, link with nothing and are their own
component. Rows that repeat an id are documents of their own and share its component
when their sets link. A null id is never the smallest; where all ids of a component
are null its id is null. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylens.llm.store import if_small, whole, written
from staylens.llm.text_bytes import binaries, mix, shingle_sets, signed
from staylens.operators.geo import components

_U = np.uint64
GROWTH = 1.4
PAGE_SHINGLES = 400_000
FILTER_BITS = 1 << 26
FAN = 8


class Rule:
    """When two sizes and an overlap make a link, and how sizes are cut into ranges."""

    def __init__(self, words: int = 3, percent: int = 90):
        self.words, self.percent = words, percent

    def links(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)

    def least_overlap(self, total):
        """Smallest overlap of two linked sets with `total` members together."""
        return -(-self.percent * total // (100 + self.percent))

    @lru_cache(maxsize=None)  # noqa: B019  few rules live in a worker
    def range_at(self, k: int) -> tuple[int, int, int, int]:
        """Sizes from, to (exclusive), parts and spare parts of the k-th size range."""
        low = 1 if k == 0 else self.range_at(k - 1)[1]
        high = max(low + 1, int(low * GROWTH))
        # members of only one of two sets: at most their total less twice the least overlap
        differ = 2 * (high - 1) * (100 - self.percent) // (100 + self.percent)
        spare = 0 if differ == 0 else 1 + differ // 8
        return low, high, differ + 1 + spare, spare

    @lru_cache(maxsize=1 << 14)  # noqa: B019
    def ranges_for(self, size: int) -> list[int]:
        """Ranges of the larger set of any pair this size can link in."""
        k, found = 0, []
        while self.percent * self.range_at(k)[0] <= 100 * size:
            if size < self.range_at(k)[1]:
                found.append(k)
            k += 1
        return found

    def __hash__(self):
        return hash((self.words, self.percent))

    def __eq__(self, other):
        return (self.words, self.percent) == (other.words, other.percent)


@lru_cache(maxsize=4096)
def edges(parts: int) -> np.ndarray:
    return np.array([(j << 64) // parts for j in range(1, parts)], np.uint64)


@lru_cache(maxsize=4096)
def numbers(k: int, parts: int) -> np.ndarray:
    return _U(k << 32) + np.arange(parts, dtype=np.uint64)


def node_of(members: np.ndarray) -> int:
    return int(signed(mix(mix(members).sum(dtype=np.uint64, keepdims=True) + _U(len(members))))[0])


def part_keys(members: np.ndarray, rule: Rule) -> Iterator[tuple[np.ndarray, int]]:
    """Names of the parts of a sorted set, for every range it may link in, and how many
    of them it shares with any set it links with there. The last six bits of a name
    are the range."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(members + _U(77)), dtype=np.uint64)))
    for k in rule.ranges_for(len(members)):
        _, high, parts, spare = rule.range_at(k)
        if parts == 1:
            continue  # only equal sets link here, and they are one node
        cut = np.empty(parts + 1, np.int64)
        cut[0], cut[-1] = 0, len(members)
        cut[1:-1] = np.searchsorted(members, edges(parts))
        total, count = sums[cut], cut[1:] - cut[:-1]
        keys = mix(mix(total[1:] - total[:-1] + count.view(np.uint64)) + numbers(k, parts))
        keys = (keys & ~_U(63)) | _U(k & 63)
        full = np.flatnonzero(count)
        empty = parts - len(full)
        # all parts but those that hold a differing member are equal; empty ones may be left out
        partner = min(high - 1, 100 * len(members) // rule.percent)
        differ = (len(members) + partner) * (100 - rule.percent) // (100 + rule.percent)
        need = max(1, parts - differ - empty)
        yield (keys if empty > spare else keys[full]), need


def sets_in(batch: pa.RecordBatch, rule: Rule) -> Iterator[np.ndarray]:
    data, starts = binaries(batch.column(batch.schema.get_field_index("body")))
    return shingle_sets(data, starts, rule.words)


def described(rule: Rule):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for members in sets_in(batch, rule):
                sizes.append(len(members))
                nodes.append(node_of(members))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                names=["doc_id", "mark", "n", "node"],
            )

    return each


def parts_of(rule: Rule, wanted: np.ndarray | None = None):
    """`key`, `node`, `need` of all parts, or of those whose bit is set in `wanted`. Copies
    that a task has seen are left out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, needs, held = [], [], [], 0
            for members in sets_in(batch, rule):
                if not len(members):
                    continue
                node = node_of(members)
                if node in seen:
                    continue
                seen.add(node)
                for found, need in part_keys(members, rule):
                    if wanted is not None:
                        at = (found >> _U(6)) % _U(64 * len(wanted))
                        found = found[(wanted[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) == 1]
                    keys.append(found)
                    nodes.append(np.full(len(found), node, np.int64))
                    needs.append(np.full(len(found), need, np.int32))
                    held += len(found)
                if held > 200_000:
                    yield part_batch(keys, nodes, needs)
                    keys, nodes, needs, held = [], [], [], 0
            if held:
                yield part_batch(keys, nodes, needs)

    return each


def part_batch(keys: list[np.ndarray], nodes: list[np.ndarray], needs: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(needs))],
        names=["key", "node", "need"],
    )


def bits_of(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the short names in `keys`: a name whose bit is not set
    is not among them. However many names there are, it has `FILTER_BITS` bits."""
    at = F.expr(f"short & {FILTER_BITS - 1}L")
    words = keys.select(at.alias("at")).groupBy(F.expr("shiftright(at, 6)").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    )
    # at most FILTER_BITS / 64 rows of two numbers
    found = words.toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bitmap


def sets_of(rule: Rule):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, members in enumerate(sets_in(batch, rule)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                        pa.array([len(members)], pa.int64()), pa.array([members.tobytes()], pa.binary()),
                    ],
                    names=["cluster", "node", "n", "members"],
                )

    return each


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def pivot_links(rule: Rule):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            own, other = (batch.column(i) for i in (2, 3))
            for a, b in zip(own, other):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                near.append(rule.links(overlap(x, y), len(x), len(y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), pa.array(near, pa.bool_())],
                names=["cluster", "node", "pivot", "near"],
            )

    return each


class Tree:
    """A signature tree over sets: levels from the leaves to one root. `spans[l]` is
    the number of leaves below a node of level l."""

    def __init__(self, members: list[np.ndarray], words: int):
        self.members = members
        sizes = np.array([len(m) for m in members])
        bits = np.zeros((len(members), words), np.uint64)
        for row, m in zip(bits, members):
            place = (m >> _U(20)) % _U(words * 64)
            np.bitwise_or.at(row, (place >> _U(6)).astype(np.int64), _U(1) << (place & _U(63)))
        extra = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, extra)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, extra = self.levels[-1]
            first = np.arange(0, len(low), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, first), np.minimum.reduceat(low, first),
                    np.maximum.reduceat(high, first), np.maximum.reduceat(extra, first),
                )
            )

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of each node on the level below, with the position of the parent."""
        below = len(self.levels[level - 1][1])
        first = nodes * FAN
        count = np.minimum(first + FAN, below) - first
        parent = np.repeat(np.arange(len(nodes)), count)
        return first[parent] + np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count), parent


def can_link(rule: Rule, a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the bounds of node pairs leave room for a link. The members two sets
    share have at most as many distinct bits as both bitmaps have in common, and
    at most `extra` further members fall on a bit another one has."""
    bits_a, low_a, high_a, extra_a = a
    bits_b, low_b, high_b, extra_b = b
    ok = (100 * high_a[i] >= rule.percent * low_b[j]) & (100 * high_b[j] >= rule.percent * low_a[i])
    step = max(1, (1 << 21) // bits_a.shape[1])
    live = np.flatnonzero(ok)
    for s in range(0, len(live), step):
        at = live[s : s + step]
        common = np.bitwise_count(bits_a[i[at]] & bits_b[j[at]]).sum(axis=1).astype(np.int64)
        most = common + np.minimum(extra_a[i[at]], extra_b[j[at]])
        ok[at] = most >= rule.least_overlap(low_a[i[at]] + low_b[j[at]])
    return ok


def leaf_pairs(rule: Rule, x: Tree, y: Tree) -> Iterator[tuple[int, int]]:
    """Leaves of two trees that may link, by dual traversal from both roots."""
    stack = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        lx, ly, i, j = stack.pop()
        ok = can_link(rule, x.levels[lx], y.levels[ly], i, j)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if lx == ly == 0:
            yield from zip(i.tolist(), j.tolist())
            continue
        if lx >= ly:
            child, parent = x.children(lx, i)
            nxt = (lx - 1, ly, child, j[parent])
        else:
            child, parent = y.children(ly, j)
            nxt = (lx, ly - 1, i[parent], child)
        for s in range(0, len(child), 1 << 16):
            stack.append((*nxt[:2], nxt[2][s : s + (1 << 16)], nxt[3][s : s + (1 << 16)]))


def page_links(rule: Rule, left: list[tuple[int, bool, np.ndarray]], right: list[tuple[int, bool, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between two pages of (node, reached by the pivot, members), as many as
    are needed to join what they join."""
    for page in (left, right):
        page.sort(key=lambda e: (int(e[2][0]), len(e[2])))
    largest = max(len(e[2]) for page in (left, right) for e in page)
    words = max(1, 1 << max(0, math.ceil(math.log2(largest * 2 / 64))))
    x, y = (Tree([e[2] for e in page], words) for page in (left, right))
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for page in (left, right):
        for node, reached, _ in page:
            if reached:
                parent[root(node)] = root(-1 << 70)
    found = []
    for i, j in leaf_pairs(rule, x, y):
        a, b = left[i][0], right[j][0]
        ra, rb = root(a), root(b)
        if ra != rb and rule.links(overlap(left[i][2], right[j][2]), len(left[i][2]), len(right[j][2])):
            parent[ra] = rb
            found.append((a, b))
    return found


def tile_links(rule: Rule):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pages in zip(batch.column(0), batch.column(1)):
                left, right = (
                    [(e["node"].as_py(), e["near"].as_py(), np.frombuffer(e["members"].as_buffer(), np.uint64)) for e in page]
                    for page in pages
                )
                out += page_links(rule, left, right)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"]
            )

    return each


def candidate_clusters(texts: DataFrame, rule: Rule, shingles: int) -> DataFrame:
    """`node`, `cluster`, `weight` (parts shared with others) of the nodes that may
    link with another; `shingles` is the number of shingles of all texts."""
    schema = "key long, node long, need int"
    body = texts.select("body")
    # the first pass only counts, by names as short as their number allows: six bits more
    # than it takes to tell all of them apart leave few that meet by chance
    bits = min(58, max(FILTER_BITS.bit_length() - 1, shingles.bit_length() + 6))
    short = F.expr(f"shiftrightunsigned(key, 6) & {(1 << bits) - 1}L").alias("short")
    met = written(
        body.mapInArrow(parts_of(rule), schema).select(short).groupBy("short").count().where("count > 1").select("short")
    )
    # the second pass makes few names that nobody shares
    again = body.mapInArrow(parts_of(rule, bits_of(met)), schema).select("*", short)
    shared = written(again.join(if_small(met, 8), "short", "left_semi").drop("short").distinct())
    # nodes that share too few parts of a range link with nobody there
    k = F.col("key").bitwiseAND(F.lit(63)).alias("k")
    enough = written(
        shared.groupBy("node", k)
        .agg(F.count(F.lit(1)).alias("parts"), F.max("need").alias("need"))
        .where("parts >= need")
        .select("node", "k")
    )
    kept = written(
        shared.select("key", "node", k).join(if_small(enough, 12), ["node", "k"], "left_semi").select("key", "node")
    )
    low = written(
        kept.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
        .select("key", "low")
    )
    star = kept.join(if_small(low, 16), "key").groupBy("node", "low").agg(F.count(F.lit(1)).alias("weight"))
    star = written(star)
    ends = written(star.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    nodes = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct()
    labels = components(nodes, ends).select("node", F.col("label").alias("cluster"))
    weights = star.groupBy("node").agg(F.sum("weight").alias("weight"))
    return written(labels.join(weights, "node", "left"))


def set_links(texts: DataFrame, known: DataFrame, rule: Rule) -> DataFrame:
    """`a`, `b`: links between nodes that join all linked nodes of each cluster.

    `texts` has (`doc_id`, `mark`, `body`), `known` (`doc_id`, `mark`, `n`, `node`)."""
    clusters = candidate_clusters(texts, rule, known.agg(F.sum("n")).first()[0] or 0)
    # one text stands for all rows of a node
    firsts = known.groupBy("node").agg(F.min(F.struct("mark", "doc_id")).alias("first"))
    sources = written(
        firsts.join(clusters.select("node", "cluster"), "node").select(
            "cluster", "node", F.col("first.mark").alias("_mark"), F.col("first.doc_id").alias("_doc_id")
        )
    )
    same = (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    chosen = texts.join(if_small(sources, 32), same).select("cluster", "node", "body")
    # rows that repeat an id and its text are still here more than once
    sets = written(
        chosen.mapInArrow(sets_of(rule), "cluster long, node long, n long, members binary").dropDuplicates(["node"])
    )
    pivots = clusters.groupBy("cluster").agg(F.max_by("node", F.struct("weight", "node")).alias("pivot"))
    centre = written(
        pivots.join(sets.select(F.col("node").alias("pivot"), F.col("members").alias("middle")), "pivot")
    )
    tested = sets.join(centre, "cluster").select("cluster", "node", "members", "middle", "pivot")
    near = written(tested.mapInArrow(pivot_links(rule), "cluster long, node long, pivot long, near boolean"))
    by_pivot = near.where("near and node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    # what the pivot did not reach meets its cluster, page by page
    far = near.where("not near")
    open_ = written(far.select("cluster").distinct())
    marked = sets.join(if_small(open_, 8), "cluster", "left_semi").join(
        near.select("node", "near", "pivot"), "node"
    ).where("node <> pivot")
    size_class = F.floor(F.log("n") / F.log(F.lit(100.0 / rule.percent)) + 1e-9).cast("int")
    marked = marked.withColumn("size_class", size_class)
    marked = written(marked)
    totals = written(
        marked.groupBy("cluster", "size_class").agg(F.ceil(F.sum("n") / PAGE_SHINGLES).cast("int").alias("pages"))
    )
    paged = marked.join(if_small(totals, 16), ["cluster", "size_class"]).withColumn(
        "page", F.pmod(F.xxhash64("node"), F.col("pages")).cast("int")
    )
    entry = F.struct("node", "near", "members")
    pages = written(
        paged.groupBy("cluster", "size_class", "page").agg(
            F.collect_list(entry).alias("entries"), F.collect_list(F.when(~F.col("near"), entry)).alias("open")
        )
    )
    neighbours = F.explode(F.array(*[F.col("size_class") + i for i in (-1, 0, 1)])).alias("size_class")
    left = pages.where(F.size("open") > 0).select("cluster", neighbours, F.col("open").alias("left"))
    tiles = left.join(pages, ["cluster", "size_class"]).select("left", "entries")
    return by_pivot.unionByName(tiles.mapInArrow(tile_links(rule), "a long, b long"))


def grouped_rows(docs: DataFrame, id: str, text: str, rule: Rule) -> DataFrame:
    """`doc_id`, `mark` (of the text), `n`, `first` (smallest id of the component) and
    `first_mark` (smallest mark of that id in the component)."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(body).alias("mark"), body.alias("body"))
    rows = written(texts.mapInArrow(described(rule), "doc_id long, mark long, n long, node long"))
    links = written(set_links(texts, rows.where("n > 0"), rule))
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    labels = written(components(nodes, links).select("node", "label"))
    labelled = written(
        rows.where("n > 0").join(if_small(labels, 16), "node", "left").select(
            "doc_id", "mark", "n", F.coalesce("label", "node").alias("label")
        )
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "mark"))
    first = written(
        labelled.groupBy("label").agg(least.alias("least"))
        .select("label", F.col("least.doc_id").alias("first"), F.col("least.mark").alias("first_mark"))
    )
    some = labelled.join(if_small(first, 24), "label").select("doc_id", "mark", "n", "first", "first_mark")
    alone = rows.where("n = 0").select("doc_id", "mark", "n", F.col("doc_id").alias("first"), F.col("mark").alias("first_mark"))
    return some.unionByName(alone)


def jaccard_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """id, `n_shingles`, `component_id` (smallest id that links reach) of every row."""
    return grouped_rows(docs, id, text, Rule(words, percent)).select(
        F.col("doc_id").alias(id), F.col("n").alias("n_shingles"), F.col("first").alias("component_id")
    )


def without_near_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest id (nulls
    last) and, where texts share that id, the smallest hash. Rows that repeat an id and
    its text stay or go together."""
    rows = grouped_rows(docs, id, text, Rule(words, percent))
    gone = written(
        rows.where(~F.col("doc_id").eqNullSafe(F.col("first")) | (F.col("mark") != F.col("first_mark")))
        .select(F.col("doc_id").alias("_doc_id"), F.col("mark").alias("_mark"))
        .distinct()
    )
    mark = F.xxhash64(F.coalesce(F.col(f"all.`{text}`"), F.lit("")).cast("binary"))
    same = F.col(f"all.`{id}`").cast("long").eqNullSafe(F.col("_doc_id")) & (mark == F.col("_mark"))
    return whole(docs).join(if_small(gone, 16), same, "left_anti").select("all.*")
