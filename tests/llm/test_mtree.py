import numpy as np

from staylens.llm import mtree
from staylens.llm.mtree import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, dim int, shard string, score long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "v", 3, "s", None) for i, v in rows], SCHEMA)


def brute(rows, wanted, k=5):
    whole = [
        (i, np.floor(np.asarray(v, np.float32).astype(float) * 256).astype(int))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, q in whole:
        if i in wanted:
            best = sorted((-int(q @ c), j) for j, c in whole if j != i and len(c) == len(q))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


def check(spark, rows, wanted):
    df = frame(spark, rows)
    got = top_k(df, df.where(df["vec_id"].isin(*wanted)))
    assert sorted(map(tuple, got.collect())) == brute(rows, set(wanted))


def test_many_pages_and_shards(spark, monkeypatch):
    for name, value in (("ROUTES", 6), ("SHARD", 60), ("PAGE", 7), ("BLOCK", 8)):
        monkeypatch.setattr(mtree, name, value)
    rnd = np.random.default_rng(1)
    rows = [(i, (rnd.normal(size=6) * (1 + i % 5)).tolist()) for i in range(500)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # a crowd at one place, all scores tied
    check(spark, rows, [*range(0, 500, 25), 1000, 1150])


def test_awkward_vectors(spark):
    rows = [
        (0, [0.1, 0.2]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
        (5, [0.3, -0.2]), (6, [1.0, 2.0, 3.0]), (7, [2.0, 2.0, 3.0]), (8, []), (None, [0.1, 0.1]), (9, [0.1, 0.2]),
    ]
    check(spark, rows, [0, 1, 2, 3, 5, 6, 8])


def test_empty_table(spark):
    df = frame(spark, [])
    assert top_k(df, df).count() == 0
