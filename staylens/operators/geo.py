"""Density clusters of coordinates (DBSCAN with great-circle distance).

The plane is cut into cells whose diagonal is at most eps, so all points of one
cell are neighbours: a cell with enough points consists of core points, and core
points of one cell share a cluster. What is left are questions between cells,
and those are answered by boxes first: a box is a small part of a cell, and two
boxes are surely within eps, surely not, or unclear. Single points are compared
only for unclear boxes, and never inside a full cell. Points are counted by
distinct coordinate, so copies of a place cost one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import radians, sin, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from staylens.functions.numbers import EARTH_KM, distance_km
from staylens.operators.order import dense_keys
from staylens.session import checkpoint

CELL = ("_gy", "_gx")
REACH = 2  # cell rows within eps, as a cell is eps / sqrt(2) high
PARTS = 8  # boxes per cell side
EDGE = 1e-9  # km: two boxes nearer to eps than this are unclear


def _grid(eps_km: float) -> tuple[float, Column, Column]:
    """Cell height in degrees, cell row, and cell width of a row in degrees: each
    row is as wide as its edge nearest to the equator allows."""
    height = eps_km / sqrt(2.0) / radians(1.0) / EARTH_KM * (1 - 1e-6)
    return height, F.floor(F.col("lat") / F.lit(height)), _width(F.col("_gy"), height)


def _width(row: Column, height: float) -> Column:
    low = F.when(row >= 0, row).otherwise(-row - 1) * F.lit(height)
    return F.lit(height) / F.greatest(F.cos(F.radians(F.least(low, F.lit(89.9)))), F.lit(1e-3))


def place_points(df: DataFrame, by: Sequence[str], lat: str, lon: str, eps_km: float) -> DataFrame:
    """Distinct coordinates per group with their weight, cell and box."""
    height, row, width = _grid(eps_km)
    points = (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(*by, F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        .agg(F.count(F.lit(1)).alias("w"))
    )
    placed = points.withColumn("_gy", row).withColumn("_gx", F.floor(F.col("lon") / width))
    inner_y = F.floor((F.col("lat") / F.lit(height) - F.col("_gy")) * PARTS)
    inner_x = F.floor((F.col("lon") / width - F.col("_gx")) * PARTS)
    return placed.withColumn(
        "_box", (F.least(inner_y, F.lit(PARTS - 1)) * PARTS + F.least(inner_x, F.lit(PARTS - 1))).cast("int")
    )


def boxes_of(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Tight bounds and weight of every occupied box."""
    return points.groupBy(*by, *CELL, "_box").agg(
        F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"),
        F.min("lon").alias("lon_lo"), F.max("lon").alias("lon_hi"), F.sum("w").alias("box_w"),
    )


def near_cells(df: DataFrame, by: Sequence[str], eps_km: float, lat: str, lon_lo: str, lon_hi: str) -> DataFrame:
    """One row per cell (`_ny`, `_nx`) that may hold something within eps."""
    height = _grid(eps_km)[0]
    lifted = df.withColumn("_ny", F.explode(F.sequence(F.col("_gy") - REACH, F.col("_gy") + REACH)))
    farthest = F.least(F.abs(F.col(lat)) + F.lit((REACH + 1) * height), F.lit(89.9))
    turn = F.degrees(F.asin(F.least(F.lit(sin(eps_km / 2 / EARTH_KM)) / F.cos(F.radians(farthest)), F.lit(1.0)))) * 2.0001
    width = _width(F.col("_ny"), height)
    return lifted.withColumn(
        "_nx",
        F.explode(
            F.sequence(F.floor((F.col(lon_lo) - turn) / width), F.floor((F.col(lon_hi) + turn) / width))
        ),
    )


def box_limits(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest possible distance between points of two bounded boxes."""
    def edge(side: str, name: str) -> Column:
        return F.col(f"{side}{name}")

    def gap(axis: str) -> tuple[Column, Column]:
        lo_a, hi_a, lo_b, hi_b = (edge(s, f"{axis}_{e}") for s in (a, b) for e in ("lo", "hi"))
        return F.greatest(lo_a - hi_b, lo_b - hi_a, F.lit(0.0)), F.greatest(hi_a - lo_b, hi_b - lo_a)

    def cosine(side: str, least: bool) -> Column:
        lo, hi = edge(side, "lat_lo"), edge(side, "lat_hi")
        far = F.greatest(F.abs(lo), F.abs(hi))
        near = F.when((lo <= 0) & (hi >= 0), 0.0).otherwise(F.least(F.abs(lo), F.abs(hi)))
        return F.cos(F.radians(far if least else near))

    def km(dlat: Column, dlon: Column, least: bool) -> Column:
        y, x = F.sin(F.radians(dlat) / 2), F.sin(F.radians(dlon) / 2)
        square = y * y + cosine(a, least) * cosine(b, least) * x * x
        return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(square, F.lit(1.0))))

    lat_gap, lat_span = gap("lat")
    lon_gap, lon_span = gap("lon")
    return km(lat_gap, lon_gap, True), km(lat_span, lon_span, False)


def meet_boxes(
    points: DataFrame, boxes: DataFrame, by: Sequence[str], eps_km: float, other: str
) -> tuple[DataFrame, DataFrame]:
    """Points against boxes of near cells, split into boxes surely within eps and
    unclear ones. `other` is the prefix of the box columns."""
    point = near_cells(points, by, eps_km, "lat", "lon", "lon").select(
        *by, *CELL, "lat", "lon", "w",
        F.col("lat").alias("p_lat_lo"), F.col("lat").alias("p_lat_hi"),
        F.col("lon").alias("p_lon_lo"), F.col("lon").alias("p_lon_hi"), "_ny", "_nx",
    )
    box = boxes.select(
        *by, F.col("_gy").alias("_ny"), F.col("_gx").alias("_nx"),
        *[F.col(c).alias(f"{other}{c}") for c in boxes.columns if c not in (*by, *CELL)],
    )
    least, most = box_limits("p_", other)
    met = point.join(box, [*by, "_ny", "_nx"]).withColumn("_least", least).withColumn("_most", most)
    return met.where(F.col("_most") <= eps_km - EDGE), met.where(
        (F.col("_most") > eps_km - EDGE) & (F.col("_least") <= eps_km + EDGE)
    )


def within(unclear: DataFrame, points: DataFrame, by: Sequence[str], eps_km: float, box: str, *extra: str) -> DataFrame:
    """Unclear point-box meetings resolved point by point."""
    near = points.select(
        *by, F.col("_gy").alias("_ny"), F.col("_gx").alias("_nx"), F.col("_box").alias(box),
        F.col("lat").alias("q_lat"), F.col("lon").alias("q_lon"), F.col("w").alias("q_w"),
    )
    km = distance_km(F.col("lat"), F.col("lon"), F.col("q_lat"), F.col("q_lon"))
    return unclear.join(near, [*by, "_ny", "_nx", box]).where(km <= eps_km)


def core_points(points: DataFrame, by: Sequence[str], eps_km: float, min_points: int) -> DataFrame:
    """Points with at least `min_points` points within eps, themselves included."""
    cells = points.groupBy(*by, *CELL).agg(F.sum("w").alias("cell_w"))
    sized = points.join(cells, [*by, *CELL])
    full = sized.where(F.col("cell_w") >= min_points).drop("cell_w")
    sparse = sized.where(F.col("cell_w") < min_points).drop("cell_w")
    sure, unclear = meet_boxes(sparse, boxes_of(points, by), by, eps_km, "b_")
    key = [*by, "lat", "lon"]
    hits = sure.select(*key, F.col("b_box_w").alias("n")).unionByName(
        within(unclear, points, by, eps_km, "b__box").select(*key, F.col("q_w").alias("n"))
    )
    enough = hits.groupBy(*key).agg(F.sum("n").alias("n")).where(F.col("n") >= min_points).select(*key)
    return full.unionByName(sparse.join(enough, key, "left_semi"))


def cell_links(core: DataFrame, by: Sequence[str], eps_km: float) -> DataFrame:
    """Pairs of cells (`a` before `b`) with core points within eps of one another."""
    boxes = boxes_of(core, by)
    bounds = ("lat_lo", "lat_hi", "lon_lo", "lon_hi")
    left = near_cells(boxes, by, eps_km, "lat_lo", "lon_lo", "lon_hi").select(
        *by, *CELL, F.col("_box").alias("a__box"), *[F.col(c).alias(f"a_{c}") for c in bounds], "_ny", "_nx"
    )
    right = boxes.select(
        *by, F.col("_gy").alias("_ny"), F.col("_gx").alias("_nx"),
        F.col("_box").alias("b__box"), *[F.col(c).alias(f"b_{c}") for c in bounds],
    )
    least, most = box_limits("a_", "b_")
    ahead = (F.col("_ny") > F.col("_gy")) | ((F.col("_ny") == F.col("_gy")) & (F.col("_nx") > F.col("_gx")))
    met = left.where(ahead).join(right, [*by, "_ny", "_nx"]).withColumn("_least", least).withColumn("_most", most)
    pair = [*by, *CELL, "_ny", "_nx"]
    sure = met.where(F.col("_most") <= eps_km - EDGE).select(*pair).distinct()
    open_boxes = met.where((F.col("_most") > eps_km - EDGE) & (F.col("_least") <= eps_km + EDGE))
    unclear = open_boxes.join(sure, pair, "left_anti").select(*pair, "a__box", "b__box")
    own = core.select(*by, *CELL, F.col("_box").alias("a__box"), "lat", "lon")
    tested = within(unclear.join(own, [*by, *CELL, "a__box"]), core, by, eps_km, "b__box").select(*pair).distinct()
    return sure.unionByName(tested)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node of the connected component of every node (`node`, `label`).

    Each round, every label joins the neighbour that comes first in a random
    order drawn for the round, and the graph is redrawn between labels. The
    labels left fall by a constant share per round, so the rounds grow with the
    logarithm of the graph, not with its diameter. A round ends in a checkpoint.
    """
    mapping = checkpoint(nodes.select("node", F.col("node").alias("label")))
    links = checkpoint(edges.select("a", "b").where("a <> b").distinct())
    turn = 0
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seed = F.lit(turn)
        best = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b"))).alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("b"))
        parent = checkpoint(best.select(F.col("a").alias("label"), F.least(own, F.col("m"))["b"].alias("next")))
        mapping = checkpoint(
            mapping.join(parent, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        )
        one = parent.select(F.col("label").alias("a"), F.col("next").alias("_a"))
        two = parent.select(F.col("label").alias("b"), F.col("next").alias("_b"))
        redrawn = links.join(one, "a").join(two, "b").select(
            F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")
        )
        links = checkpoint(redrawn.where("a <> b").distinct())
        turn += 1
    first = mapping.groupBy("label").agg(F.min("node").alias("first"))
    return mapping.join(first, "label").select("node", F.col("first").alias("label"))


def dbscan(
    df: DataFrame, lat: str = "latitude", lon: str = "longitude", eps_km: float = 0.3, min_points: int = 30,
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct coordinates with their weight, whether they are core, and their
    cluster: 0, 1, ... within all groups, -1 for noise. A border point near
    several clusters takes the first of them."""
    by = list(by)
    points = checkpoint(place_points(df, by, lat, lon, eps_km))
    core = checkpoint(core_points(points, by, eps_km, min_points))
    cell = F.struct(*by, *CELL)
    links = cell_links(core, by, eps_km).select(
        cell.alias("a"), F.struct(*by, F.col("_ny").alias("_gy"), F.col("_nx").alias("_gx")).alias("b")
    )
    nodes = core.select(cell.alias("node")).distinct()
    labels = checkpoint(components(nodes, links))
    clusters = dense_keys(labels.select("label").distinct(), ["label"], "_number")
    cells = labels.join(clusters, "label").select(
        *[F.col(f"node.{c}").alias(c) for c in (*by, *CELL)], (F.col("_number") - 1).alias("cluster")
    )
    key = [*by, "lat", "lon"]
    inner = core.join(cells, [*by, *CELL]).select(*key, "w", F.lit(True).alias("core"), "cluster")
    rest = points.join(core.select(*key), key, "left_anti")
    core_boxes = boxes_of(core, by).join(cells, [*by, *CELL])
    sure, unclear = meet_boxes(rest, core_boxes, by, eps_km, "b_")
    touched = sure.select(*key, "b_cluster").unionByName(
        within(unclear, core, by, eps_km, "b__box").select(*key, "b_cluster")
    )
    border = touched.groupBy(*key).agg(F.min("b_cluster").alias("cluster"))
    outer = rest.join(border, key, "left").select(
        *key, "w", F.lit(False).alias("core"), F.coalesce("cluster", F.lit(-1)).alias("cluster")
    )
    return inner.unionByName(outer)


def cluster_count(clusters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Clusters without noise, clustered and noise points."""
    own = F.col("cluster") >= 0
    return clusters.groupBy(*by).agg(
        F.count_distinct(F.when(own, F.col("cluster"))).alias("clusters"),
        F.coalesce(F.sum(F.when(own, F.col("w"))), F.lit(0)).alias("clustered"),
        F.coalesce(F.sum(F.when(~own, F.col("w"))), F.lit(0)).alias("noise"),
    )
