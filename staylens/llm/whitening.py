"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The fit list is a stored table of vectors, each distinct one once, n rows of d numbers
with the sums S; X stands for its rows less S / n. Two products over its partitions
alternate:

    u_j = X v_j - (its parts along u_1 .. u_{j-1}),   alpha_j = |u_j|
    v_{j+1} = X'u_j / alpha_j - (its parts along v_1 .. v_j)

Both sides are reorthogonalised in full against all earlier vectors. The left vectors
have n entries and are never stored or gathered: u_j = X w_j for a short vector w_j, which
follows the same recurrence, so a task computes the entries of all left vectors of its
own rows from the rows themselves. One scan per step makes u_j, measures what is left of
it along the earlier left vectors, and multiplies it by X'; a task gives back sums of at
most 2 d numbers. What the driver holds is V, W, X'U and the bidiagonal matrix: d x steps
numbers, whatever n is. The singular
value decomposition of the small matrix gives components (V times its right vectors) and
deviations (singular values over the root of n).

A run ends when the wanted components have converged to double precision, or the space
is used up. A single starting vector cannot see a second component of exactly the same
deviation, so further runs start in the complement of what was found and end when they
show that nothing there exceeds the last wanted component; what does is taken over.

Products run as Arrow batches in numpy on centred rows; their sums over partitions are
Spark aggregates of d rows. Frequent vectors are combined before the shuffle that makes
the list distinct.

Vectors that are null or hold null or non-finite entries take no part. A vector shorter
than the longest one counts as followed by zeros; so does an empty one. Rows that repeat
an id or a vector each get their own result, equal ones the same. Components without
deviation (fewer distinct vectors than components, constant dimensions) have no rows; an
empty table gives an empty result. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylens.llm.store import written

COMPONENTS = 4
SCALE = 256
# relative to the largest value: a product this small leads nowhere, a residual this small is none
NOTHING, CONVERGED = 1e-11, 1e-13


def whole_vectors(vectors: DataFrame, id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """id and `x`, floor(scale * entry) of every entry, for vectors of finite numbers."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.col(vector).isNotNull() & ~F.exists(
        entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    )
    x = F.transform("v", lambda c: F.floor(scale * c).cast("long"))
    kept = vectors.select(F.col(id).alias("id"), F.when(finite, entries).alias("v")).where("v IS NOT NULL")
    return kept.select("id", x.alias("x"))


def even(rows: DataFrame, width: int) -> DataFrame:
    """All vectors at the same width."""
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < width, F.concat("x", zeros)).otherwise(F.col("x")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class Rows:
    """The centred fit list as an operator on short vectors."""

    def __init__(self, fit: DataFrame, n: int, sums: np.ndarray):
        self.fit, self.n, self.centre, self.width = fit, n, sums / n, len(sums)

    def added(self, parts) -> np.ndarray:
        """Sums over all rows of the arrays that `parts` makes of a block of rows."""
        width, centre = self.width, self.centre

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    found = parts(matrix(batch.column(0), width) - centre)
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "value"]
                )

        found = self.fit.select("x").mapInArrow(each, "i int, value double").groupBy("i").agg(F.sum("value"))
        return np.array([value for _, value in sorted(found.collect())])

    def product(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """X'u for u = X v, the parts of u along the left vectors X w, its squared length."""
        out = self.added(lambda x: (lambda u: np.concatenate((x.T @ u, (x @ w).T @ u, [u @ u])))(x @ v))
        return out[: self.width], out[self.width : -1], float(out[-1])

    def trace(self) -> float:
        return float(self.added(lambda x: np.array([np.square(x).sum()]))[0]) / self.n

    def covariance(self, components: np.ndarray) -> np.ndarray:
        """Covariance of the rows' values along the columns of `components`."""
        k = components.shape[1]
        out = self.added(lambda x: (lambda z: np.append((z.T @ z).ravel(), z.sum(axis=0)))(x @ components))
        mean = out[k * k :] / self.n
        return out[: k * k].reshape(k, k) / self.n - np.outer(mean, mean)


def clear(v: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """What is left of v beside the orthonormal columns of `bases`; twice is enough."""
    for _ in range(2):
        for basis in bases:
            v = v - basis @ (basis.T @ v)
    return v


def run(rows: Rows, locked: np.ndarray, wanted: int, above: float, rng: np.random.Generator):
    """Singular values (falling) and right vectors of X in the complement of `locked`.

    Ends when `wanted` of them have converged, when the largest is shown to be no
    larger than `above`, or when the complement is used up."""
    d = rows.width
    room = d - locked.shape[1]
    v_all, w_all = np.zeros((d, 0)), np.zeros((d, 0))
    images = np.zeros((d, 0))
    small = np.zeros((0, 0))
    v, beta, largest = None, 0.0, above
    while v_all.shape[1] < room:
        fresh = v is None
        if fresh:
            # a new direction, where the last one led nowhere further
            v = clear(rng.standard_normal(d), locked, v_all)
            v, beta = v / np.linalg.norm(v), 0.0
        # X'u of the earlier left vectors tells the parts of X v along them
        along = images.T @ v
        w = v - w_all @ along
        image, rest, squared = rows.product(w, w_all)
        reach = np.sqrt(squared + along @ along)
        largest = max(largest, reach)
        if fresh and reach <= NOTHING * largest:
            # a random direction has a part along everything that is left
            break
        # the second pass of the reorthogonalisation, by the parts that were measured
        w, image = w - w_all @ rest, image - images @ rest
        alpha = np.sqrt(max(squared - rest @ rest, 0.0))
        k = v_all.shape[1]
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k] = small
        if k:
            grown[k - 1, k] = beta
        ended = alpha <= NOTHING * largest
        grown[k, k] = 0.0 if ended else alpha
        small, v_all = grown, np.column_stack((v_all, v))
        if ended:
            w_all, images = np.column_stack((w_all, np.zeros(d))), np.column_stack((images, np.zeros(d)))
            v, following = None, 0.0
        else:
            w_all, images = np.column_stack((w_all, w / alpha)), np.column_stack((images, image / alpha))
            v = clear(image / alpha, locked, v_all)
            following = np.linalg.norm(v)
            if following <= NOTHING * largest:
                v, following = None, 0.0
            else:
                v, beta = v / following, following
        p, sigma, qt = np.linalg.svd(small)
        gap = following * np.abs(p[-1])
        enough = min(wanted, room)
        if v is not None and len(sigma) >= enough and np.all(gap[:enough] <= CONVERGED * max(sigma[0], above)):
            break
        if v is not None and len(sigma) > 1 and sigma[0] + gap[0] < above:
            break
    if not v_all.shape[1]:
        return np.zeros(0), np.zeros((d, 0))
    _, sigma, qt = np.linalg.svd(small)
    return sigma, v_all @ qt.T


def principal(rows: Rows, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Deviations and components (columns) of the largest variances, falling."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, rows.width)
    sigma, found = run(rows, np.zeros((rows.width, 0)), wanted, 0.0, rng)
    sigma, found = sigma[:wanted], found[:, :wanted]
    # with fewer than wanted nothing but the null space is left
    while found.shape[1] == wanted < rows.width:
        more, others = run(rows, found, 1, sigma[wanted - 1], rng)
        if not len(more) or more[0] <= sigma[wanted - 1] * (1 + 1e-12):
            break
        sigma, found = np.append(sigma, more[0]), np.column_stack((found, others[:, 0]))
        order = np.argsort(-sigma, kind="stable")[:wanted]
        sigma, found = sigma[order], found[:, order]
    real = sigma > (10 * NOTHING * sigma[0] if len(sigma) else 0.0)
    return sigma[real] / np.sqrt(rows.n), found[:, real]


def whitened(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, seed: int = 1,
) -> DataFrame:
    """id, `component` (from 1), `n` (distinct vectors), `deviation` (sum over dimensions
    of (n x - S) ^ 2, exact, decimal), `whitened`, `explained` (share of the variance),
    `identity_error` (largest entry of the whitened covariance less the identity)."""
    found = whole_vectors(vectors, id, vector, scale)
    width = found.agg(F.max(F.size("x"))).first()[0] or 0
    kind = vectors.schema[id].dataType.simpleString()
    if not width:
        return found.sparkSession.createDataFrame(
            [], f"`{id}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
            "identity_error double",
        )
    found = even(found, width)
    fit = written(found.select("x").distinct())
    # d sums of whole numbers, exact
    totals = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c").cast("decimal(19,0)")).cast("long").alias("s")
    )
    sums = [(n, s) for _, n, s in sorted(totals.collect())]
    n, s = sums[0][0], [int(v) for _, v in sums]
    rows = Rows(fit, n, np.array(s, np.float64))
    deviations, axes = principal(rows, components, seed)
    trace = rows.trace()
    scaled = axes / deviations
    k = len(deviations)
    error = float(np.abs(rows.covariance(scaled) - np.eye(k)).max()) if k else 0.0
    explained = (deviations**2 / trace).tolist() if k else []
    centre = rows.centre

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = (matrix(batch.column(1), width) - centre) @ scaled
            at = np.repeat(np.arange(batch.num_rows), k)
            columns = [c.take(pa.array(at)) for c in (batch.column(0), batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    columns[0], pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(at), n)), columns[1], pa.array(z.ravel()),
                    pa.array(np.tile(np.array(explained), batch.num_rows)), pa.array(np.full(len(at), error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    wide = F.lit(0).cast("decimal(38,0)")
    sums_column = F.array(*[F.lit(v).cast("decimal(19,0)") for v in s])
    off = F.zip_with("x", sums_column, lambda x, t: (F.lit(n) * x).cast("decimal(19,0)") - t)
    deviation = F.aggregate(off.cast("array<decimal(19,0)>"), wide, lambda t, e: (t + e * e).cast("decimal(38,0)"))
    out = found.select("id", "x", deviation.alias("deviation")).mapInArrow(
        project,
        f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double",
    )
    return out.withColumnRenamed("id", id)
