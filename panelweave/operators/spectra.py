"""Eigenvalues and principal components of the marker correlation matrix.

A panel of n samples and m markers has the same non-zero eigenvalues in sample
space (n x n) and in marker space (m x m).  Each partition multiplies its rows
with NumPy, one matrix a task is summed, and the smaller of the two reaches the
driver if its side is at most ``MAX_SIDE``.  Larger panels are iterated: each
step multiplies the matrix by a few vectors in one pass over the samples, and
only vectors reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require
from .genotype import assert_hard_calls, wide_markers

#: Largest matrix on the driver, 32 MB.
MAX_SIDE = 2048
COMPONENTS = 10
#: Passes over the samples at most, degree of the filter, and how far a vector may be off.
PASSES, DEGREE, RESIDUAL = 500, 6, 1e-9
#: Calls that a task holds as numbers at a time, 8 MB.
CELLS = 1 << 20
SUM = "r long, row binary"


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """Rows (r, vector as bytes) of all tasks, summed by r."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for r, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[r] = total.get(r, 0) + np.frombuffer(x)
        if total:
            yield _rows(total)

    return {r: np.frombuffer(x) for r, x in parts.repartition("r").mapInArrow(run, SUM).collect()}


def _rows(vectors: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(vectors), pa.int64()), pa.array([np.ascontiguousarray(v, float).tobytes() for v in vectors.values()], pa.binary())], names=["r", "row"])


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, -1)


def _marker_scales(calls: DataFrame) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Markers in order, their means, and the lengths of their centred calls."""
    d = F.col("d").cast("double")
    got = calls.groupBy("j").agg(F.avg(d).alias("mean"), F.coalesce(F.var_pop(d) * F.count(d), F.lit(0.0)).alias("square")).orderBy("j").collect()
    return [r["j"] for r in got], np.array([r["mean"] for r in got]), np.sqrt(np.maximum([r["square"] for r in got], 0))


def _unit(x: np.ndarray, mean: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Samples' calls, each marker centred and of unit length; constant ones 0."""
    return np.divide(x - mean, size, out=np.zeros_like(x), where=size > 0)


def _wide_samples(calls: DataFrame) -> DataFrame:
    return wide_markers(calls.select(F.col("j").alias("i"), F.col("i").alias("j"), "d")).select("calls")


def _marker_space(calls: DataFrame, mean: np.ndarray, size: np.ndarray, vectors: np.ndarray | None = None) -> np.ndarray:
    """The correlation matrix of the markers, or its product with ``vectors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                z = _unit(_matrix(b), mean, size)
                part = z.T @ (z if vectors is None else z @ vectors)
                total = part if total is None else total + part
        if total is not None:
            yield _rows(dict(enumerate(total)))

    got = _added(_wide_samples(calls).mapInArrow(run, SUM))
    return np.array([got[r] for r in range(len(mean))])


def _sample_space(calls: DataFrame, n: int) -> np.ndarray:
    """Sum over markers of the outer product of centred calls of unit length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = _matrix(b)
                x -= x.mean(axis=1, keepdims=True)
                size = np.sqrt((x * x).sum(axis=1, keepdims=True))
                x = np.divide(x, size, out=np.zeros_like(x), where=size > 1e-9)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield _rows(dict(enumerate(total)))

    got = _added(wide_markers(calls).select("calls").mapInArrow(run, SUM))
    return np.array([got[r] for r in range(n)])


def leading(calls: DataFrame, count: int, mean: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues and their vectors in marker space.

    A block of vectors goes through a Chebyshev polynomial of the matrix, shifted
    so that it is small on the eigenvalues below the block's and grows above
    them; each degree is a pass over the samples.  It ends when no vector is off
    by more than ``RESIDUAL`` of the largest eigenvalue, and fails by name where
    ``PASSES`` do not suffice."""
    m = len(mean)
    count = min(count, m)
    times = lambda x: _marker_space(calls, mean, size, x)
    q = np.linalg.qr(np.random.default_rng(11).normal(size=(m, min(m, count + 4))))[0]
    y, passes = times(q), 1
    while True:
        values, turn = np.linalg.eigh(q.T @ y)
        values, turn = values[::-1], turn[:, ::-1]
        q, y = q @ turn, y @ turn
        off = np.linalg.norm(y - q * values, axis=0)[:count].max(initial=0.0)
        if off <= RESIDUAL * max(values[0], 1e-300):
            return values[:count], q[:, :count]
        require(passes + DEGREE <= PASSES, f"eigenvalues have not converged after {passes} passes: residual {off:.3g}")
        half = max(values[-1], 1e-12 * values[0]) / 2
        was, now = q, y / half - q
        for _ in range(DEGREE - 1):
            was, now = now, 2 * (times(now) / half - now) - was
        # columns near their own vectors differ in size, not in direction
        q = np.linalg.qr(now / np.maximum(np.linalg.norm(now, axis=0), 1e-300))[0]
        y, passes = times(q), passes + DEGREE


def eigen_metrics(calls: DataFrame) -> tuple[float, float]:
    """(effective rank, largest eigenvalue) of the marker correlation matrix;
    a missing call is an error, in either space."""
    assert_hard_calls(calls)
    n = calls.agg(F.count_distinct("i")).first()[0]
    ids, mean, size = _marker_scales(calls)
    m, constant = len(ids), int((size == 0).sum())
    if min(n, m) <= MAX_SIDE:
        values = np.linalg.eigvalsh(_marker_space(calls, mean, size) if m <= n else _sample_space(calls, n)) if m else np.zeros(0)
        # fixed value: what counts as a rounding error of zero
        values[(values < 0) & (values > -1e-8)] = 0
        squares, top = float((values**2).sum()), float(values.max(initial=0))
    else:
        from .linkage import window_ld

        # the squares of all correlations, by tiles; each pair comes once
        place = calls.select("j").distinct().select("j", F.col("j").cast("long").alias("bp"))
        pairs = window_ld(calls, place, int(max(ids) - min(ids))).agg(F.sum("r2")).first()[0] or 0.0
        squares, top = 2 * pairs + m - constant, float(leading(calls, 1, mean, size)[0][0])
    # a constant marker is correlated with itself only
    return (m * m / (squares + constant) if m else 0.0), max(top, 1.0 if constant else 0.0)


def eigen_metrics_by(calls: DataFrame, constant: dict[int, int], n_markers: int) -> dict[int, tuple[float, float]]:
    """``eigen_metrics`` of each replicate (replicate, i, j, d) in one pass.

    ``constant`` has each replicate's number of markers that do not vary.  The
    matrices are in marker space, or in sample space where samples are fewer, and
    all of them reach the driver, as long as they are no more than ``MAX_SIDE``
    squared in all."""
    sizes = {r["replicate"]: r["n"] for r in calls.groupBy("replicate").agg(F.count_distinct("i").alias("n")).collect()}
    most = max(sizes.values(), default=0)
    if n_markers <= most and len(sizes) * n_markers * n_markers <= MAX_SIDE * MAX_SIDE:
        found = products_by(calls.groupBy("replicate", "i").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "d"))), lambda s: s["d"]).alias("calls")), n_markers)
        return {r: metrics_of(correlations(*found[r], n), n_markers, constant[r]) for r, n in sizes.items()}
    if most > MAX_SIDE or len(sizes) * most * most > MAX_SIDE * MAX_SIDE:
        return {r: eigen_metrics(calls.where(F.col("replicate") == r)) for r in sizes}
    wide = calls.groupBy("replicate", "j").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "d"))), lambda s: s["d"]).alias("calls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            number = b.column(1).to_numpy()
            for r in np.unique(number).tolist():
                x = _matrix(b.filter(pa.array(number == r)))
                x -= x.mean(axis=1, keepdims=True)
                size = np.sqrt((x * x).sum(axis=1, keepdims=True))
                x = np.divide(x, size, out=np.zeros_like(x), where=size > 1e-9)
                total[r] = total.get(r, 0) + x.T @ x
        if total:
            yield _rows({r * most + k: row for r, t in total.items() for k, row in enumerate(t)})

    got = _added(wide.select("calls", "replicate").mapInArrow(run, SUM))
    return {r: metrics_of(np.array([got[r * most + k] for k in range(n)]), n_markers, constant[r]) for r, n in sizes.items()}


def metrics_of(matrix: np.ndarray, m: int, constant: int) -> tuple[float, float]:
    values = np.linalg.eigvalsh(matrix)
    return m * m / (float((values**2).sum()) + constant), max(float(values.max(initial=0)), 1.0 if constant else 0.0)


def products_by(rows: DataFrame, m: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of each replicate of ``rows`` (replicate, calls), a row a sample, the sums
    of products of its markers' calls, and of the calls: whole numbers, so exact
    whatever the order."""
    step = max(1, CELLS // m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            number = b.column(1).to_numpy()
            for r in np.unique(number).tolist():
                own = b.filter(pa.array(number == r))
                for at in range(0, own.num_rows, step):
                    x = _matrix(own.slice(at, step))
                    total[r] = total.get(r, 0) + np.vstack([x.T @ x, x.sum(axis=0)])
        if total:
            yield _rows({r * (m + 1) + k: row for r, t in total.items() for k, row in enumerate(t)})

    got: dict[int, list] = {}
    for at, row in sorted(_added(rows.select("calls", "replicate").mapInArrow(run, SUM)).items()):
        got.setdefault(at // (m + 1), []).append(row)
    return {r: (np.array(rows[:-1]), rows[-1]) for r, rows in got.items()}


def correlations(products: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """Correlations of markers from those sums over n samples; 0 for constant ones."""
    cov = n * products - np.outer(sums, sums)
    size = np.sqrt(np.maximum(cov.diagonal(), 0))
    scale = np.outer(size, size)
    return np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0)


def pca_reference(calls: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit: j, centre, scale and loadings (array) of each varying marker.

    The number of components is at most ``components``, n - 1 and the number of
    varying markers.  A missing call is an error.
    """
    assert_hard_calls(calls)
    n = calls.agg(F.count_distinct("i")).first()[0]
    ids, mean, size = _marker_scales(calls)
    varying = int((size > 0).sum())
    require(varying >= 2, "a PCA needs two varying markers")
    k = min(components, n - 1, varying)
    stats = calls.groupBy("j").agg(F.avg(F.col("d").cast("double")).alias("centre"), F.stddev_samp(F.col("d").cast("double")).alias("scale")).where("scale > 0")
    if min(n, len(ids)) <= MAX_SIDE and len(ids) > n:
        people = [r[0] for r in calls.select("i").distinct().orderBy("i").collect()]  # at most MAX_SIDE
        values, vectors = np.linalg.eigh(_sample_space(calls, n))
        keep = [c for c in np.argsort(-values)[:k] if values[c] > 1e-9 * values.max()]
        # scaled calls have length sqrt(n - 1)
        weights = vectors[:, keep] / np.sqrt(values[keep] * (n - 1))
        table = calls.sparkSession.createDataFrame([(i, w.tolist()) for i, w in zip(people, weights)], "i int, w array<double>")
        z = (F.col("d") - F.col("centre")) / F.col("scale")
        loads = calls.join(F.broadcast(table), "i").join(stats, "j")
        return loads.groupBy("j", "centre", "scale").agg(F.array(*(F.sum(z * F.col("w")[c]) for c in range(len(keep)))).alias("loading"))
    if len(ids) <= MAX_SIDE:
        values, vectors = np.linalg.eigh(_marker_space(calls, mean, size))
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    else:
        values, vectors = leading(calls, k, mean, size)
    vectors = vectors[:, values > 1e-9 * values.max()]
    table = calls.sparkSession.createDataFrame([(j, v.tolist()) for j, v in zip(ids, vectors)], "j int, loading array<double>")
    return stats.join(table, "j").select("j", "centre", "scale", "loading")


def project(calls: DataFrame, reference: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """i, pc, score of samples on a reference's components.  A call stays one
    row: the components are as many sums."""
    z, count = (F.col("d") - F.col("centre")) / F.col("scale"), reference.select(F.size("loading")).first()
    sums = F.array(*(F.sum(z * F.col("loading")[c]) for c in range(count[0] if count else 0)))
    return calls.join(reference, "j").groupBy(*by, "i").agg(sums.alias("scores")).select(*by, "i", F.posexplode("scores").alias("pc", "score"))


def pca_displacement(calls: DataFrame, reference_calls: DataFrame, components: int = COMPONENTS, by: tuple[str, ...] = ()) -> DataFrame:
    """rms_z, max_abs_z, median_variance_ratio of a panel, or of each group of
    ``by``, against a reference that is fitted once."""
    ref = pca_reference(reference_calls, components)
    side = lambda c, *by: project(c, ref, by).groupBy(*by, "pc").agg(F.avg("score").alias("m"), F.stddev_samp("score").alias("s"))
    both = side(calls, *by).withColumnsRenamed({"m": "m1", "s": "s1"}).join(side(reference_calls), "pc")
    z = (F.col("m1") - F.col("m")) / F.col("s")
    return both.groupBy(*by).agg(F.sqrt(F.avg(z * z)).alias("rms_z"), F.max(F.abs(z)).alias("max_abs_z"), F.median(F.col("s1") * F.col("s1") / (F.col("s") * F.col("s"))).alias("median_variance_ratio"))
