import numpy as np

from staylens.llm.queries import table
from staylens.llm.whitening import Rows, principal, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x string, v int, i int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "x", 3, 4, 6) for i, v in rows], SCHEMA)


class Local(Rows):
    """The same products over one array."""

    def __init__(self, x):
        self.x, self.n, self.width, self.centre, self.scans = x, len(x), x.shape[1], x.mean(axis=0), 0

    def added(self, parts):
        self.scans += 1
        return parts(self.x - self.centre)


def check_axes(x, scans=None):
    rows = Local(np.asarray(x, float))
    deviations, axes = principal(rows, 4)
    want = np.linalg.eigvalsh(np.cov(rows.x.T, bias=True).reshape(rows.width, -1))[::-1][:4]
    want = want[want > 1e-12 * max(want[0], 1e-300)]
    assert np.allclose(deviations**2, want, rtol=1e-11)
    if len(want):
        assert np.abs(axes.T @ axes - np.eye(len(want))).max() < 1e-12
        assert np.abs(rows.covariance(axes / deviations) - np.eye(len(want))).max() < 1e-10
    assert scans is None or rows.scans < scans


def test_axes_of_many_shapes():
    rng = np.random.default_rng(2)
    mirrored = lambda d: np.vstack([np.diag(d), -np.diag(d)])
    check_axes(rng.standard_normal((400, 30)))
    check_axes(rng.standard_normal((400, 5)) @ rng.standard_normal((5, 40)))
    check_axes(rng.standard_normal((900, 200)) * np.r_[np.full(6, 9.0), np.ones(194)], scans=60)
    # equal variances, which one starting vector cannot see
    check_axes(mirrored([5.0, 5, 5, 3, 2, 1, 1, 1]))
    check_axes(mirrored(np.r_[7.0, 7, 7, 7, 7, 6, np.linspace(1, 2, 60)]))
    check_axes(mirrored(np.full(9, 4.0)))
    for shape in ((2, 2), (3, 64), (50, 1), (2, 1)):
        check_axes(rng.standard_normal(shape))
    check_axes(np.ones((1, 5)))


def want_of(rows):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    x = np.array([np.pad(np.floor(256 * np.asarray(v, np.float32).astype(float)), (0, width - len(v))) for _, v in good])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, q = np.linalg.eigh(np.cov(fit.T, bias=True))
    return [i for i, _ in good], x, n, s, e[::-1], q[:, ::-1]


def check(spark, rows):
    ids, x, n, s, e, q = want_of(rows)
    got = whitened(frame(spark, rows)).collect()
    assert len(got) == 4 * len(ids)
    deviation = {}
    for i, v in zip(ids, x):
        deviation.setdefault(i, set()).add(int(sum((n * int(c) - int(t)) ** 2 for c, t in zip(v, s))))
    assert all(r["n"] == n and int(r["deviation"]) in deviation[r["vec_id"]] for r in got)
    assert all(abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-12 and r["identity_error"] < 1e-9 for r in got)
    for k in range(4):
        z = (x - s / n) @ q[:, k] / np.sqrt(e[k])
        own = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["whitened"]) for r in got if r["component"] == k + 1)
        for sign in (1, -1):
            other = sorted((i is None, i or 0, sign * w) for i, w in zip(ids, z))
            if all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-8 for a, b in zip(own, other)):
                break
        else:
            raise AssertionError(f"component {k + 1}")


def test_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(6) * np.arange(1, 7)).tolist()) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(90)]  # one vector again and again
    rows += [(3, rows[5][1]), (None, rows[7][1]), (700, [1.0, 2.0]), (701, []), (702, None), (703, [None] * 6)]
    rows += [(704, [float("nan")] * 6), (705, [float("inf"), 0.0]), (706, [-0.0] * 6), (707, [0.001] * 6)]
    check(spark, rows)


def test_registered_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "/root/testdata/sf0.001", "embeddings").limit(80).collect()]
    check(spark, rows)


def test_without_deviation(spark):
    assert whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitened(frame(spark, [])).count() == 0
    assert whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    one = whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0])])).collect()
    assert sorted((r["vec_id"], r["component"], abs(round(r["whitened"], 9))) for r in one) == [(1, 1, 1.0), (2, 1, 1.0)]
