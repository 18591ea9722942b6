"""Complete panels: a row a sample, and what the products of markers give.

A panel without missing calls, its markers numbered from 0 without gaps, is held
as a row a sample.  One pass over those rows sums the products of all pairs of
markers; allele frequencies, linkage, equal markers, eigenvalues and components
follow from these sums, which are a matrix a replicate and no larger for more
samples.  Copies and kinship are counted from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require
from ..functions.columns import DISTANCE_EDGES
from . import kinship, spectra, tiles


@dataclass(frozen=True)
class Complete:
    """Cached rows (replicate, i, calls), samples of each replicate, number of markers."""

    rows: DataFrame
    sizes: dict[int, int]
    markers: int


@dataclass(frozen=True)
class Products:
    """Samples, sums of products of markers, and sums of calls of a replicate."""

    n: int
    square: np.ndarray
    total: np.ndarray

    @property
    def maf(self) -> np.ndarray:
        p = self.total / self.n / 2
        return np.minimum(p, 1 - p)

    @property
    def hets(self) -> np.ndarray:
        return 2 * self.total - self.square.diagonal()

    @property
    def levels(self) -> np.ndarray:
        two = (self.square.diagonal() - self.total) / 2
        return (two > 0).astype(int) + (self.hets > 0) + (self.n - two - self.hets > 0)

    @property
    def spread(self) -> np.ndarray:
        """Covariances times the square of the number of samples."""
        return self.n * self.square - np.outer(self.total, self.total)


def samples(calls: DataFrame) -> DataFrame:
    """replicate, i, calls in the order of markers, and whether these are 0, 1 and so on."""
    pairs = F.sort_array(F.collect_list(F.struct("j", "d")))
    rows = calls.groupBy("replicate", "i").agg(pairs.alias("pairs"))
    return rows.select("replicate", "i", F.col("pairs.d").alias("calls"), (F.col("pairs.j") == F.sequence(F.lit(0), F.size("pairs") - 1)).alias("gapless"))


def summed(rows: DataFrame) -> dict[int, dict]:
    """Of each replicate of ``samples``: samples, least and most calls of one,
    whether markers have no gaps, and calls that are not 0, 1 or 2."""
    bad = F.size(F.filter("calls", lambda d: ~F.coalesce(d.isin(0, 1, 2), F.lit(False))))
    got = rows.groupBy("replicate").agg(F.count("*").alias("n"), F.min(F.size("calls")).alias("least"), F.max(F.size("calls")).alias("most"), F.bool_and("gapless").alias("gapless"), F.sum(bad).alias("bad"))
    return {r["replicate"]: r.asDict() for r in got.collect()}


def fits(found: dict[int, dict], replicates: int | None = None) -> bool:
    """Whether all replicates are complete on the same markers, which are no more
    than the samples of the least one, and their matrices fit the driver."""
    m = {r[k] for r in found.values() for k in ("least", "most")}
    if len(m) != 1 or not all(r["gapless"] for r in found.values()):
        return False
    side, count = m.pop(), replicates or len(found)
    return side <= min(r["n"] for r in found.values()) and count * side * side <= spectra.MAX_SIDE**2


def complete(calls: DataFrame) -> Complete | None:
    """The panel (replicate, i, j, d) in this form, or None where it has none.
    A call that is not 0, 1 or 2 is an error."""
    rows = samples(calls).cache()
    found = summed(rows)
    bad = sum(r["bad"] for r in found.values())
    require(not bad, f"{bad} rows break hard_calls")
    if not found or not fits(found):
        rows.unpersist()
        return None
    return Complete(rows, {k: r["n"] for k, r in found.items()}, next(iter(found.values()))["most"])


def products(panel: Complete) -> dict[int, Products]:
    found = spectra.products_by(panel.rows, panel.markers)
    return {r: Products(n, *found[r]) for r, n in panel.sizes.items()}


def spots(markers: DataFrame) -> list | None:
    """The markers (j, bp and perhaps chr) as rows, or None where they are more than
    a matrix takes, or repeated, or without a position."""
    got = markers.select("j", "bp", *(c for c in markers.columns if c == "chr")).limit(spectra.MAX_SIDE + 1).collect()
    if not got or len(got) > spectra.MAX_SIDE or any(r["j"] is None or r["bp"] is None for r in got) or len({r["j"] for r in got}) < len(got):
        return None
    return got


def copies(rows: DataFrame) -> DataFrame:
    """replicate and duplicated: samples beyond the first of each set with the same calls."""
    sets = rows.groupBy("replicate", "calls").agg(F.count("*").alias("n"))
    return sets.groupBy("replicate").agg(F.sum(F.col("n") - 1).alias("duplicated"))


def king(rows: DataFrame, markers: int) -> DataFrame:
    """replicate and ``kinship.king_metrics`` of its samples."""
    width = (markers - 1) // 64 + 1
    planes = kinship.bit_planes(rows.select("replicate", "i", F.posexplode("calls").alias("j", "d")), ("replicate",))
    values = tiles.king_values(planes, width, F.col("replicate")).withColumn("replicate", F.col("run").cast("int"))
    return kinship.king_metrics(values, ("replicate",), few=tiles.countable(width))


def equal_markers(p: Products) -> int:
    """Pairs of markers with the same calls: their squared differences sum to 0."""
    own = p.square.diagonal()
    return (int((own[:, None] + own[None, :] - 2 * p.square == 0).sum()) - len(own)) // 2


def linkage(p: Products, spots: list, window: int) -> tuple[float | None, list[tuple[int, float | None, float | None]]]:
    """The median LD score of the markers ``spots`` (j, bp and perhaps chr), and
    pairs, mean and median r2 of each distance bin, within ``window``."""
    spread = p.spread
    own = np.outer(spread.diagonal(), spread.diagonal())
    r2 = np.divide(spread * spread, own, out=np.zeros_like(spread), where=own > 0)
    # markers of the map that the panel lacks do not count
    at = [s for s in spots if 0 <= s["j"] < len(r2)]
    j, bp = np.array([s["j"] for s in at], int), np.array([s["bp"] for s in at], np.int64)
    apart = np.abs(bp[:, None] - bp[None, :])
    near = (apart <= window) & (j[:, None] != j[None, :])
    if at and "chr" in at[0]:
        name = np.array([str(s["chr"]) for s in at])
        near &= name[:, None] == name[None, :]
    r2 = r2[np.ix_(j, j)]
    score = np.where(near, r2, 0).sum(axis=1)
    upper = near & (j[:, None] < j[None, :])
    place, value = np.digitize(apart[upper], DISTANCE_EDGES), r2[upper]
    bins = [value[place == b] for b in range(len(DISTANCE_EDGES) + 1)]
    return float(np.median(score)) if at else None, [(len(v), float(v.mean()), float(np.median(v))) if len(v) else (0, None, None) for v in bins]


def eigen(p: Products) -> tuple[float, float]:
    """Effective rank and largest eigenvalue."""
    return spectra.metrics_of(spectra.correlations(p.square, p.total, p.n), len(p.total), int((p.levels < 2).sum()))


def axes(reference: Products, components: int = spectra.COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, weights of calls (a column a component) and deviations of a reference's scores."""
    own = reference.spread / (reference.n * max(reference.n - 1, 1))
    scale = np.sqrt(np.maximum(own.diagonal(), 0))
    varying = int((scale > 0).sum())
    require(varying >= 2, "a PCA needs two varying markers")
    values, vectors = np.linalg.eigh(spectra.correlations(reference.square, reference.total, reference.n))
    k = min(components, reference.n - 1, varying)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    vectors = vectors[:, values > 1e-9 * values.max()]
    weights = np.divide(vectors, scale[:, None], out=np.zeros_like(vectors), where=scale[:, None] > 0)
    return reference.total / reference.n, weights, np.sqrt(np.einsum("jc,jk,kc->c", weights, own, weights))


def displacement(p: Products, fit: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[float, float, float | None]:
    """``spectra.pca_displacement`` from the products: scores are sums over
    markers, so their means and variances follow from those of the calls."""
    centre, weights, s = fit
    z = (p.total / p.n - centre) @ weights / s
    wide = np.einsum("jc,jk,kc->c", weights, p.spread / (p.n * max(p.n - 1, 1)), weights) / (s * s)
    return float(np.sqrt((z * z).mean())), float(np.abs(z).max()), float(np.median(wide)) if p.n > 1 else None
