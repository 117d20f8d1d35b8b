"""Exact top-k search by inner product in M-trees, best node first.

Vectors become integers, floor(`scale` * x). The largest inner product is the
smallest distance once every vector gets one more component that lifts it to a
common length R: |q - v|^2 = |q|^2 + R^2 - 2 q.v for a query with 0 in that place.
So a metric tree answers the search.

The tree has three paged levels. Its routing objects are a bounded number of vectors
chosen by hash; every vector belongs to the nearest. A shard is a routing object's
vectors (or, by hash, a part of them when it has many: a routing object that a third
of all vectors sit at is spread like any other), and holds pages of neighbouring
vectors, each with its own centre, its covering radius, its distance to the routing
object (the parent), and the distance of each member to the page's centre.

A query first searches a shard of its own routing object. That bounds its k-th
distance, and only shards whose ball reaches inside this bound are searched for it.
In a shard the pages are visited best first, by the smallest distance a member may
have; the visit ends where this exceeds the k-th distance. The distance to a centre is
computed only if the stored distance to the parent does not already rule the page
out, and that to a member only if its stored distance to the centre does not.

Queries meet shards in blocks, so a shard is moved once per block. Bounds are widened
by a rounding margin; scores are integers, so the result is exact.

Vectors that are null, or hold a null or a number that is not finite, take no part.
Vectors of different length never meet. Rows that repeat an id are candidates of
their own, each a possible result; a row is never a result of its own query, nor are
rows with its id. Queries that repeat an id and its vector are one query. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staylens.llm.store import if_small, written

SCALE, K = 256, 5
ROUTES, SHARD, PAGE, BLOCK = 64, 4096, 128, 256
MARGIN = 1e-6


def whole_numbers(vector: str | Column, scale: int = SCALE) -> Column:
    """The vector's components as integers, or null if it takes no part."""
    column = F.col(vector) if isinstance(vector, str) else vector
    wide = F.transform(column, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of `dim` numbers as rows."""
    if not len(column):
        return np.zeros((0, dim))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def distances(rows: np.ndarray, lift: np.ndarray, centre: np.ndarray, centre_lift: float) -> np.ndarray:
    return np.sqrt(((rows - centre) ** 2).sum(axis=1) + (lift - centre_lift) ** 2)


def lifted(rows: np.ndarray, square: float) -> np.ndarray:
    return np.sqrt(np.maximum(square - (rows * rows).sum(axis=1), 0))


def routed(routes: dict[int, np.ndarray], squares: dict[int, float]):
    """Nearest routing object of each vector and the distance to it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            route = np.zeros(len(dims), np.int32)
            far = np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for s in range(0, len(at), 4096):
                    part = at[s : s + 4096]
                    rows = matrix(batch.column(1).take(pa.array(part)), int(dim))
                    lift = lifted(rows, squares[int(dim)])
                    centres = routes[int(dim)]
                    middle = lifted(centres, squares[int(dim)])
                    square = (
                        (rows * rows).sum(1)[:, None] + (centres * centres).sum(1) - 2 * rows @ centres.T
                        + (lift[:, None] - middle) ** 2
                    )
                    best = square.argmin(axis=1)
                    route[part], far[part] = best, np.sqrt(np.maximum(square[np.arange(len(part)), best], 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(route), pa.array(far)], names=[*batch.schema.names, "route", "far"]
            )

    return each


class Shard:
    """One routing object's vectors as a two-level tree of pages."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, square: float, centre: np.ndarray):
        self.centre, self.centre_lift = centre, float(lifted(centre[None], square)[0])
        lift = lifted(rows, square)
        # neighbours share a page: by distance to two far apart vectors
        to_centre = distances(rows, lift, centre, self.centre_lift)
        pole = int(to_centre.argmax())
        to_pole = distances(rows, lift, rows[pole], lift[pole])
        band = np.argsort(to_pole, kind="stable")
        wide = max(PAGE, int(np.sqrt(len(rows) * PAGE)))
        order = np.concatenate([b[np.argsort(to_centre[b], kind="stable")] for b in np.split(band, range(wide, len(band), wide))])
        self.ids, self.rows, self.lift = ids[order], rows[order], lift[order]
        self.pages = np.arange(0, len(order), PAGE)
        self.ends = np.append(self.pages[1:], len(order))
        self.centres, self.centre_lifts, self.radius = [], [], []
        self.stored = np.empty(len(order))
        for a, b in zip(self.pages, self.ends):
            mean, high = self.rows[a:b].mean(axis=0), float(self.lift[a:b].mean())
            away = distances(self.rows[a:b], self.lift[a:b], mean, high)
            self.stored[a:b] = away
            self.centres.append(mean)
            self.centre_lifts.append(high)
            self.radius.append(away.max())
        self.centres, self.centre_lifts = np.array(self.centres), np.array(self.centre_lifts)
        self.radius = np.array(self.radius)
        self.to_parent = distances(self.centres, self.centre_lifts, centre, self.centre_lift)

    def search(self, query: np.ndarray, own: int, k: int, square: float, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best of this shard with a score of at least `floor`."""
        length = float(query @ query)
        ids, scores = np.zeros(0, np.int64), np.zeros(0)

        def reach() -> float:
            # no better result lies farther than the k-th best so far
            least = max(floor, scores[-1]) if len(scores) == k else floor
            return np.sqrt(max(length + square - 2 * least, 0.0)) * (1 + MARGIN) + MARGIN

        from_parent = float(distances(self.centre[None], np.array([self.centre_lift]), query, 0.0)[0])
        limit = reach()
        open_ = np.flatnonzero(np.abs(from_parent - self.to_parent) - self.radius <= limit)
        if not len(open_):
            return ids, scores
        away = distances(self.centres[open_], self.centre_lifts[open_], query, 0.0)
        least = away - self.radius[open_]
        for at in np.argsort(least, kind="stable"):
            limit = reach()
            if least[at] > limit:
                break
            a, b = self.pages[open_[at]], self.ends[open_[at]]
            near = np.flatnonzero(np.abs(away[at] - self.stored[a:b]) <= limit) + a
            score = self.rows[near] @ query
            keep = score >= (max(floor, scores[-1]) if len(scores) == k else floor)
            keep &= self.ids[near] != own
            if keep.any():
                ids, scores = np.append(ids, self.ids[near[keep]]), np.append(scores, score[keep])
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
        return ids, scores


def numbers(buffer: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(buffer.as_buffer(), kind)


def shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of ids and vectors of a shard as two byte strings."""
    for batch in batches:
        ids, rows, far = [], [], []
        for i in range(batch.num_rows):
            entries = batch.column(4)[i].values
            ids.append(entries.field("id").to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            rows.append(entries.field("v").flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            far.append(float(entries.field("far").to_numpy(zero_copy_only=False).max()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(ids, pa.binary()), pa.array(rows, pa.binary()), pa.array(far)],
            names=["shard", "dim", "route", "kind", "ids", "rows", "radius"],
        )


def searched(routes: dict[int, np.ndarray], squares: dict[int, float], k: int):
    """Each block of queries in the shard it is joined with."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shard = None, None
        for batch in batches:
            at = batch.schema.get_field_index
            for i in range(batch.num_rows):
                dim, route = batch.column(at("dim"))[i].as_py(), batch.column(at("route"))[i].as_py()
                key = batch.column(at("shard"))[i].as_py()
                square = squares[dim]
                if key != last:
                    ids = numbers(batch.column(at("ids"))[i], "<i8")
                    rows = numbers(batch.column(at("rows"))[i], "<i8").astype(np.float64).reshape(len(ids), dim)
                    last, shard = key, Shard(ids, rows, square, routes[dim][route])
                block = batch.column(at("queries"))[i].values
                owners = block.field("id").to_numpy(zero_copy_only=False)
                vectors = matrix(block.field("v"), dim)
                floors = block.field("floor").to_numpy(zero_copy_only=False)
                query, rank, id, score = [], [], [], []
                for own, vector, floor in zip(owners.tolist(), vectors, floors.tolist()):
                    others, scores = shard.search(vector, own, k, square, floor)
                    query += [own] * len(others)
                    rank += range(1, len(others) + 1)
                    id += others.tolist()
                    score += map(int, scores.tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(rank, pa.int32()), pa.array(id, pa.int64()), pa.array(score, pa.int64())],
                    names=["query_id", "nth", "vec_id", "score"],
                )

    return each


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the k largest integer inner products of
    each query with all rows of `vectors` but its own; ties go to the smaller id.

    Squared lengths must stay below 2^53, so that scores are exact."""

    def prepared(df: DataFrame) -> DataFrame:
        whole = df.select(F.col(id).cast("long").alias("id"), whole_numbers(vector, scale).alias("v"))
        return whole.where("id IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))

    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    rows = written(prepared(vectors).withColumn("square", square))
    # a row per vector length
    squares = {r["dim"]: float(r["most"]) for r in rows.groupBy("dim").agg(F.max("square").alias("most")).collect()}
    routes = {}
    for dim in squares:
        # at most ROUTES rows
        chosen = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(ROUTES).collect()
        routes[dim] = np.array([r["v"] for r in chosen], np.float64).reshape(len(chosen), dim)
    near = "id long, v array<bigint>, dim int, route int, far double"
    own = routed(routes, squares)
    placed = written(rows.select("id", "v", "dim").mapInArrow(own, near))
    counts = written(placed.groupBy("dim", "route").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")
    shard = F.concat_ws("-", "dim", "route", part).alias("shard")
    shards = written(
        placed.join(if_small(counts, 16), ["dim", "route"])
        .select(shard, "dim", "route", "id", "v", "far")
        .groupBy("shard", "dim", "route")
        .agg(F.collect_list(F.struct("id", "v", "far")).alias("entries"))
        .select("shard", "dim", "route", F.lit(0).alias("kind"), "entries")
        .mapInArrow(shard_rows, "shard string, dim int, route int, kind int, ids binary, rows binary, radius double")
    )
    known = F.col("dim").isin(*squares) if squares else F.lit(False)
    asked = written(prepared(queries).where(known).dropDuplicates(["id", "v"]).mapInArrow(own, near))
    found = searched(routes, squares, k)
    result = "query_id long, nth int, vec_id long, score long"

    def blocks(pairs: DataFrame) -> DataFrame:
        """Queries (`shard`, `id`, `v`, `floor`) in blocks of a shard."""
        cut = F.pmod(F.xxhash64("id", "v"), F.lit(max(1, -(-asked.count() // BLOCK)))).alias("block")
        return pairs.groupBy("shard", cut).agg(F.collect_list(F.struct("id", "v", "floor")).alias("queries"))

    def search(pairs: DataFrame) -> DataFrame:
        joined = blocks(pairs).join(shards, "shard").select("shard", "dim", "route", "ids", "rows", "queries")
        return joined.mapInArrow(found, result)

    # first a shard of a query's own routing object
    balls = written(shards.select("shard", "dim", "route", "radius"))
    homes = balls.groupBy("dim", "route").agg(F.min("shard").alias("home"))
    lowest = F.lit(float("-inf"))
    home = asked.join(if_small(written(homes), 64), ["dim", "route"]).select(
        F.col("home").alias("shard"), "id", "v", lowest.alias("floor"), "home", "dim"
    )
    first = written(search(home.drop("home", "dim")))
    # the k-th score found there is the least that a result can have
    floors = first.where(F.col("nth") == k).groupBy("query_id").agg(F.max("score").cast("double").alias("kth"))
    limits = home.join(floors, home["id"] == floors["query_id"], "left").select(
        "id", "v", "dim", "home", F.coalesce("kth", lowest).alias("floor")
    )
    reach = limits.mapInArrow(
        route_reach(routes, squares), "id long, v array<bigint>, dim int, home string, floor double, route int, away double, bound double"
    )
    others = (
        reach.join(if_small(balls, 64), ["dim", "route"])
        .where("shard <> home AND away - radius <= bound")
        .select("shard", "id", "v", "floor")
    )
    rest = search(others)
    every = first.unionByName(rest).groupBy("query_id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best")
    )
    return every.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"),
        (-F.col("one.s")).alias("score"),
    )


def route_reach(routes: dict[int, np.ndarray], squares: dict[int, float]):
    """Every query with its distance to each routing object of its length, and the
    distance that a result may have at most."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, floor = batch.column(2)[i].as_py(), batch.column(4)[i].as_py()
                query, square = matrix(batch.column(1).slice(i, 1), dim)[0], squares[dim]
                away = distances(routes[dim], lifted(routes[dim], square), query, 0.0)
                bound = np.sqrt(max(float(query @ query) + square - 2 * floor, 0.0)) * (1 + MARGIN) + MARGIN
                near = np.arange(len(away))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.take(pa.array(np.full(len(near), i))) for c in batch.columns),
                        pa.array(near.astype(np.int32)), pa.array(away), pa.array(np.full(len(near), bound)),
                    ],
                    names=[*batch.schema.names, "route", "away", "bound"],
                )

    return each
