import random

import pytest

from brute import SPLIT
from rows import documents, empty, texts
from staylens.llm.mixing import mixed, mixture, source_targets


def water_level(sizes, weights, share, most):
    """Targets by filling again and again, source by source."""
    target, open_, rest = {}, dict(enumerate(sizes)), share * sum(sizes)
    while True:
        total = sum(weights[i % len(weights)] for i in open_)
        part = {i: rest * weights[i % len(weights)] / total for i in open_}
        over = [i for i in open_ if part[i] > most * sizes[i]]
        if not over:
            return [target.get(i, part.get(i)) for i in range(len(sizes))]
        for i in over:
            target[i] = most * sizes[i]
            rest -= target[i]
            del open_[i]


@pytest.mark.parametrize("sizes", [[100, 900, 50, 400, 1], [10, 10, 10], [0, 5, 1000], [7]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(i + 1, s) for i, s in enumerate(sizes)], "source_no long, size long")
    found = [r["target"] for r in source_targets(rows).orderBy("source_no").collect()]
    assert found == pytest.approx(water_level(sizes, [5, 2, 1], 1.5, 2))


def test_mix_meets_the_targets(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 300)), rnd.choice(["a", "b", "b", "b", "c", None])) for i in range(3000)]
    docs = documents(spark, rows)
    found = mixed(docs, with_source=True).collect()
    size = {i: len(SPLIT.findall(t)) for i, t, _ in rows}
    by: dict = {}
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        by.setdefault(r["source"], []).append(r)
    order = sorted(k for k in by if k is not None) + [None]
    want = water_level([sum(r["size"] for r in by[k]) for k in order], [5, 2, 1], 1.5, 2)
    for k, target in zip(order, want):
        assert by[k][0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in by[k]) - target) <= 300
        # rates are one tilt of the size within a source, and meet the target before rounding
        assert sum(r["rate"] * r["size"] for r in by[k]) == pytest.approx(target, rel=1e-5)
    again = {(r["doc_id"], r["taken"]) for r in mixed(docs).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found}


def test_awkward_rows(spark):
    docs = documents(spark)
    found = mixed(docs).collect()
    assert len(found) == len(texts())
    assert all(r["size"] == 0 and r["taken"] == 0 for r in found if r["doc_id"] in (4, 5, 6))
    left = mixture(docs)
    assert left.dtypes == docs.dtypes
    plan = sum(r["copies"] for r in found)
    assert left.count() == plan


def test_empty_table(spark):
    assert mixed(empty(spark)).count() == 0 and mixture(empty(spark)).count() == 0


def test_only_native_plans(spark):
    plan = mixed(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
