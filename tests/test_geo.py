"""Density clusters against plain Python, with crowded places and copies."""

import math
import random

import pytest

from staylens.operators import geo


def km(a, b):
    y, x = math.sin(math.radians(b[0] - a[0]) / 2), math.sin(math.radians(b[1] - a[1]) / 2)
    return 12742.0 * math.asin(min(1.0, math.sqrt(y * y + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * x * x)))


def brute(weights, eps, least):
    points = list(weights)
    near = {p: [q for q in points if km(p, q) <= eps] for p in points}
    core = {p for p in points if sum(weights[q] for q in near[p]) >= least}
    label = {}
    for p in core:
        if p in label:
            continue
        label[p], todo = p, [p]
        while todo:
            for q in near[todo.pop()]:
                if q in core and q not in label:
                    label[q] = p
                    todo.append(q)
    return core, label, near


@pytest.mark.parametrize("lat0,eps,least", [(-37.8, 0.3, 30), (0.0, 0.3, 12), (64.0, 0.5, 8)])
def test_same_clusters_as_brute_force(spark, lat0, eps, least):
    rng = random.Random(lat0)
    rows = []
    for _ in range(12):
        centre = (lat0 + rng.uniform(-0.02, 0.02), 10 + rng.uniform(-0.03, 0.03))
        wide = rng.choice([0.0005, 0.002, 0.004])
        rows += [(centre[0] + rng.gauss(0, wide), centre[1] + rng.gauss(0, wide)) for _ in range(rng.randint(5, 60))]
    rows += [(lat0 + i * 0.0022, 10.2) for i in range(30)] * (least // 3)
    rows += [(lat0 + rng.uniform(-0.03, 0.03), 10 + rng.uniform(-0.04, 0.04)) for _ in range(120)]
    rows = [(round(a, 6), round(b, 6)) for a, b in rows]
    weights = {}
    for p in rows:
        weights[p] = weights.get(p, 0) + 1
    df = spark.createDataFrame(rows + [(None, 1.0)], "latitude double, longitude double")
    found = {(r.lat, r.lon): r for r in geo.dbscan(df, eps_km=eps, min_points=least).collect()}
    core, label, near = brute(weights, eps, least)
    assert {p: r.w for p, r in found.items()} == weights
    assert {p for p, r in found.items() if r.core} == core
    numbers = {}
    for p in core:
        assert numbers.setdefault(label[p], found[p].cluster) == found[p].cluster
    assert sorted(numbers.values()) == list(range(len(numbers))) and len(numbers) >= 2
    for p in weights:
        if p not in core:
            touched = [found[q].cluster for q in near[p] if q in core]
            assert found[p].cluster == (min(touched) if touched else -1)


def test_long_chain_is_one_component(spark):
    nodes = spark.range(3000).withColumnRenamed("id", "node")
    edges = spark.range(2999).selectExpr("id as a", "id + 1 as b").where("a <> 1499")
    found = {r.node: r.label for r in geo.components(nodes, edges).collect()}
    assert found == {i: 0 if i < 1500 else 1500 for i in range(3000)}
