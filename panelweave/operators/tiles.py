"""Pairs of tiles: bounded blocks of rows that meet in one task.

All-pairs statistics cut their rows (samples or markers) into tiles of a fixed
number; each pair of tiles that can hold a wanted pair is a group of its own.
A task sees two tiles whatever the size of the panel, and a tile travels to as
many groups as it has partners.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.shared import written

SAMPLE_TILE = 256
MARKER_TILE = 256
#: Words of the most that travels as one side of a pair of blocks, and blocks
#: that a panel is cut into: as many whatever its samples, as each block travels
#: to all others and more of them would make the shuffle grow faster than the panel.
BLOCK_WORDS, BLOCKS = 1 << 19, 24
#: Pairs of samples that are worked on at a time (their words should stay in a
#: core's cache), those of wide panels whose values are counted by sorting, and
#: those that are worth a task.
STRIP, SORTED, TASK_PAIRS = 1 << 16, 1 << 19, 1 << 22
#: Cells of a table of counts that a task keeps.
DENSE = 1 << 22
#: Cells of a table of kinships that a task looks up.
ROUNDED = 1 << 18


def on_tile_pairs(rows: DataFrame, pairs: DataFrame, fold: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fold(key, left, right)`` to each (t1, t2); ``rows`` has t."""
    left = rows.join(pairs, F.col("t") == F.col("t1")).withColumn("side", F.lit(0))
    right = rows.join(pairs, F.col("t") == F.col("t2")).withColumn("side", F.lit(1))
    # a panel of more markers than fit is cut by ``part`` before
    keys = [*pairs.columns, *(c for c in ("part",) if c in rows.columns)]

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        a, b = group[group.side == 0], group[group.side == 1]
        return fold(key, a, b)

    return left.unionByName(right).groupBy(*keys).applyInPandas(run, schema)


def tile_pairs(tiles: DataFrame, per: int | None = None) -> DataFrame:
    """t1 <= t2 of tiles (t); with ``per``, only of the same run of ``per`` tiles."""
    run = F.floor(F.col("t") / per) if per else F.lit(0)
    side = lambda name: tiles.select(run.alias("run"), F.col("t").alias(name))
    return side("t1").join(side("t2"), "run").where("t1 <= t2").select("t1", "t2")


def _planes(group: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """Sample numbers and their words of the three planes."""
    ids, place = np.unique(group.i.to_numpy(), return_inverse=True)
    out = []
    for c in "hra":
        m = np.zeros((len(ids), width), np.uint64)
        m[place, group.w.to_numpy()] = group[c].to_numpy().view(np.uint64)
        out.append(m)
    return ids, *out


def _block_pairs(planes: DataFrame, run: Column, width: int) -> DataFrame:
    """run, t1, left, t2, right: each two blocks of samples of a run (i, w, h, r,
    a) that meet, once.  A row travels to as many blocks as its run is cut into:
    ``BLOCKS``, more only of panels of more than ``BLOCKS`` times ``BLOCK_WORDS``."""
    most = max(64, BLOCK_WORDS // width)
    rows = planes.select(run.cast("long").alias("run"), "i", "w", "h", "r", "a")
    sizes = rows.groupBy("run").agg(F.count_distinct("i").alias("n"), F.min("i").cast("long").alias("low"), F.max("i").cast("long").alias("high"))
    each = F.least(F.lit(most), F.greatest(F.lit(SAMPLE_TILE), F.ceil(F.col("n") / BLOCKS))).cast("long")
    # samples that are numbered nearly without gaps stay in order, others are dealt by a hash
    sizes = sizes.withColumn("each", each).withColumn("dense", F.col("high") - F.col("low") < 2 * F.col("n"))
    span = F.when(F.col("dense"), F.col("high") - F.col("low") + 1).otherwise(F.col("n"))
    sizes = sizes.withColumn("m", F.ceil(span / F.col("each")))
    # a row a run
    placed = rows.join(F.broadcast(sizes), "run")
    t = F.when(F.col("dense"), F.floor((F.col("i") - F.col("low")) / F.col("each"))).otherwise(F.pmod(F.xxhash64("i"), F.col("m"))).cast("int")
    blocks = written(placed.groupBy("run", "m", t.alias("t")).agg(F.collect_list(F.struct("i", "w", "h", "r", "a")).alias("rows"), F.count_distinct("i").alias("n")), "blocks")
    # a row two blocks, of some thousands of samples each
    meet = blocks.select("run", F.col("t").alias("t1"), F.explode(F.sequence("t", F.col("m").cast("int") - 1)).alias("t2"))
    size = blocks.select("run", F.col("t").alias("t2"), F.col("n").alias("n2")).join(meet, ["run", "t2"]).join(blocks.select("run", F.col("t").alias("t1"), F.col("n").alias("n1")), ["run", "t1"])
    groups, pairs = size.agg(F.count("*"), F.sum(F.col("n1") * F.col("n2"))).first()
    parts = max(1, min(groups, (pairs or 0) // TASK_PAIRS, 1 << 14))
    # one shuffle: a block goes to each pair that it is in, and the two of a pair are put side by side
    t, o = F.col("t"), F.col("o")
    sides = blocks.select("run", "t", "rows", F.explode(F.sequence(F.lit(0), F.col("m").cast("int") - 1)).alias("o"))
    sides = sides.select("run", F.least(t, o).alias("t1"), F.greatest(t, o).alias("t2"), F.when(t <= o, F.col("rows")).alias("left"), F.when(t >= o, F.col("rows")).alias("right"))
    there = [F.first(c, ignorenulls=True).alias(c) for c in ("left", "right")]
    return sides.repartition(parts, "run", "t1", "t2").groupBy("run", "t1", "t2").agg(*there).where("left is not null and right is not null")


def _side(rows: pa.StructScalar, width: int) -> tuple[np.ndarray, ...]:
    """Sample numbers, their words of the three planes, and their heterozygous calls."""
    values = rows.values
    i, w = (values.field(k).to_numpy() for k in (0, 1))
    ids, place = np.unique(i, return_inverse=True)
    out = []
    for k in (2, 3, 4):
        m = np.zeros((width, len(ids)), np.uint64)
        m[w, place] = values.field(k).to_numpy().view(np.uint64)
        out.append(m)
    return ids, *out, np.bitwise_count(out[0]).sum(axis=0, dtype=np.int64)


def _strips(batches: Iterator[pa.RecordBatch], width: int, tile: int, strip: int = STRIP) -> Iterator[tuple]:
    """run, samples of some rows and of all columns, (shared hets - 2 * opposite
    homozygotes) and hets of both of their pairs, and which pairs count."""
    small = np.int16 if width < 128 else np.int32
    for b in batches:
        for k in range(b.num_rows):
            run, same = b.column(0)[k].as_py(), b.column(1)[k].as_py() == b.column(2)[k].as_py()
            i1, h1, r1, a1, own1 = _side(b.column(3)[k], width)
            i2, h2, r2, a2, own2 = _side(b.column(4)[k], width)
            rows = max(1, min(tile, strip // len(i1)))
            for s in range(0, len(i2), rows):
                # in one block a row meets the columns before it
                n, part = min(s + rows, len(i2)) if same else len(i1), slice(s, s + rows)
                for c in range(0, n, strip):
                    these, num = slice(c, min(c + strip, n)), None
                    for w in range(width):
                        hh = np.bitwise_count(h2[w, part, None] & h1[w, None, these]).astype(small)
                        opposite = (r2[w, part, None] & a1[w, None, these]) | (a2[w, part, None] & r1[w, None, these])
                        hh -= np.bitwise_count(opposite).astype(small) * small(2)
                        num = hh if num is None else num + hh
                    keep = np.arange(c, these.stop)[None, :] < np.arange(s, s + len(num))[:, None] if same else None
                    yield run, i2[part], i1[these], num, own2[part, None], own1[None, these], keep


def half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Rounded as Spark's ``round`` does: the shortest decimal of each, halves away from zero."""
    unit = Decimal(1).scaleb(-digits)
    return np.array([float(Decimal(repr(v)).quantize(unit, ROUND_HALF_UP)) for v in x.tolist()]) + 0.0


def _fractions(width: int, digits: int | None) -> np.ndarray:
    """Every kinship of panels of ``width`` words, rounded, by ``(num + 128 *
    width) + (192 * width + 1) * den``; NaN where ``den`` is 0."""
    num, den = np.arange(-128 * width, 64 * width + 1), np.arange(128 * width + 1)[:, None]
    out = np.divide(num, den, out=np.full((len(den), len(num)), np.nan), where=den > 0).ravel()
    if digits is not None:
        values, at = np.unique(out, return_inverse=True)
        real = values == values
        values[real] = half_up(values[real], digits)
        out = values[at]
    return out


def king_rows(planes: DataFrame, width: int, run: Column, tile: int = SAMPLE_TILE, digits: int | None = None) -> DataFrame:
    """i1 < i2 and kinship of each pair of samples of a run that has a
    heterozygous call, straight from the tasks: no pair is shuffled.

    ``width``: words a sample; a task works through ``tile`` samples at a time
    against those of a block.  Of samples numbered without gaps the pairs of an
    ``i2`` come in the order of ``i1``, a block's after another.  ``digits``
    rounds the kinship: there are few different ones, and each is rounded once."""
    low, span = 128 * width, 192 * width + 1
    table = span * (128 * width + 1) <= ROUNDED

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = None
        for _, i2, i1, num, own2, own1, keep in _strips(batches, width, tile):
            if values is None and table:
                values = _fractions(width, digits)
            shape, den = num.shape, own2 + own1
            if table:
                found = values[(den * span + (num + low)).astype(np.int32)].ravel()
            else:
                found = np.divide(num, den, out=np.full(shape, np.nan), where=den > 0).ravel()
            a, b = np.broadcast_to(i1, shape).ravel(), np.repeat(i2, shape[1])
            lesser, greater = (a, b) if i1[-1] < i2[0] else (np.minimum(a, b), np.maximum(a, b))
            columns = [lesser, greater, found]
            if keep is not None or not den.all():
                real = found == found if keep is None else keep.ravel() & (found == found)
                columns = [c[real] for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i1", "i2", "kinship"])

    kind = planes.schema["i"].dataType.simpleString()
    out = _block_pairs(planes, run, width).mapInArrow(pairs, f"i1 {kind}, i2 {kind}, kinship double")
    return out if table or digits is None else out.withColumn("kinship", F.round("kinship", digits))


def countable(width: int) -> bool:
    """Whether a task keeps a table of the kinships of panels of ``width`` words:
    then there are at most ``DENSE`` of them, however many pairs."""
    return (192 * width + 1) * (128 * width + 1) <= DENSE


def king_values(planes: DataFrame, width: int, run: Column, tile: int = SAMPLE_TILE) -> DataFrame:
    """run, kinship and the number of pairs that have it: what ``king_rows``
    gives, counted in the tasks.

    A kinship is a fraction of small whole numbers, so that a panel of m markers
    has at most 6 m * m of them however many samples it has.  A task keeps
    a table of them where that has at most ``DENSE`` cells; of wider panels it
    counts the values of each strip."""
    low, span = 128 * width, 192 * width + 1  # from -2 m to m
    cells = span * (128 * width + 1)

    def out(run: int, code: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        real = code >= span  # some heterozygous call
        code, count = code[real], count[real]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(code), run)), pa.array(code % span - low), pa.array(code // span), pa.array(count)], names=["run", "num", "den", "pairs"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, np.zeros(cells if cells <= DENSE else 0, np.int64)
        for run, _, _, num, own2, own1, keep in _strips(batches, width, tile, STRIP if cells <= DENSE else SORTED):
            code = (own2 * span + low) + own1 * span
            code += num
            code = code.ravel() if keep is None else code[keep]
            if cells > DENSE:
                yield out(run, *np.unique(code, return_counts=True))
                continue
            if held not in (None, run):
                yield out(held, at := np.flatnonzero(total), total[at])
                total[:] = 0
            held = run
            if cells > 4 * STRIP:  # more cells than a strip should pass over
                np.add.at(total, code, 1)
                continue
            found = np.bincount(code)
            total[: len(found)] += found
        if held is not None:
            yield out(held, at := np.flatnonzero(total), total[at])

    counts = _block_pairs(planes, run, width).mapInArrow(counted, "run long, num long, den long, pairs long")
    sums = counts.groupBy("run", "num", "den").agg(F.sum("pairs").alias("pairs"))
    return sums.select("run", (F.col("num").cast("double") / F.col("den")).alias("kinship"), "pairs")


def king_counts(planes: DataFrame, tile: int = SAMPLE_TILE, part_words: int = 4096, per: int | None = None) -> DataFrame:
    """i1 < i2 and hh, ibs0, den summed over all words (i, w, h, r, a)."""
    rows = planes.select("i", F.pmod("w", F.lit(part_words)).cast("int").alias("w"), "h", "r", "a", F.floor(F.col("i") / tile).cast("int").alias("t"), F.floor(F.col("w") / part_words).cast("int").alias("part"))
    tiles = planes.select(F.floor(F.col("i") / tile).cast("int").alias("t")).distinct()
    pairs = tile_pairs(tiles, per)

    def fold(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("i1", "i2", "hh", "ibs0", "den")})
        if not len(left) or not len(right):
            return none
        width = int(max(left.w.max(), right.w.max())) + 1
        i1, h1, r1, a1 = _planes(left, width)
        i2, h2, r2, a2 = _planes(right, width)
        count = lambda x: np.bitwise_count(x).sum(axis=-1, dtype=np.int64)
        own1, own2, out = count(h1), count(h2), []
        for k in range(len(i1)):
            later = i2 > i1[k]
            if later.any():
                hh = count(h1[k] & h2[later])
                ibs0 = count(r1[k] & a2[later]) + count(a1[k] & r2[later])
                out.append(pd.DataFrame({"i1": i1[k], "i2": i2[later], "hh": hh, "ibs0": ibs0, "den": own1[k] + own2[later]}))
        return pd.concat(out) if out else none

    counts = on_tile_pairs(rows, pairs, fold, "i1 int, i2 int, hh long, ibs0 long, den long")
    return counts.groupBy("i1", "i2").agg(*(F.sum(c).alias(c) for c in ("hh", "ibs0", "den")))


def window_r2(wide: DataFrame, markers: DataFrame, window: int, tile: int = MARKER_TILE, signed: bool = False, summed: bool = False) -> DataFrame:
    """j1 < j2, dist, r2 (or r with its sign) of markers at most ``window`` apart.

    ``wide`` has a marker's calls in one array (j, calls), ``markers`` j, bp
    and perhaps chr.  Tiles are runs of neighbouring markers; two tiles meet if
    their nearest markers are within the window.  A pair counts the samples
    that have both calls; a marker that does not vary gives 0.  ``summed`` gives
    one row a tile pair instead: pairs and the sum of their r2.
    """
    by = ["chr"] if "chr" in markers.columns else []
    place = F.row_number().over(W.partitionBy(*by).orderBy("bp", "j")) - 1
    m = markers.select(*by, "j", "bp", F.floor(place / tile).cast("int").alias("t"))
    spans = m.groupBy(*by, "t").agg(F.min("bp").alias("lo"), F.max("bp").alias("hi"))
    # a row a tile; tiles of one chromosome only
    one, two = spans.withColumnsRenamed({"t": "t1", "lo": "lo1", "hi": "hi1"}), spans.withColumnsRenamed({"t": "t2", "lo": "lo2", "hi": "hi2"})
    near = (F.col("t1") <= F.col("t2")) & (F.col("lo2") - F.col("hi1") <= window)
    pairs = (one.join(two, by).where(near) if by else one.join(two, near)).select(*by, "t1", "t2")
    rows = wide.join(m, "j")
    if by:  # a tile's number names its chromosome as well
        rows, pairs = rows.withColumn("t", F.concat_ws(":", "chr", "t")).drop("chr"), pairs.select(F.concat_ws(":", "chr", "t1").alias("t1"), F.concat_ws(":", "chr", "t2").alias("t2"))

    def fold(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            if summed:
                return pd.DataFrame({"pairs": np.zeros(0, np.int64), "r2": np.zeros(0)})
            return pd.DataFrame({"j1": np.zeros(0, np.int32), "j2": np.zeros(0, np.int32), "dist": np.zeros(0, np.int64), "r2": np.zeros(0)})

        def side(g: pd.DataFrame) -> tuple[np.ndarray, ...]:
            x = np.stack([np.asarray(c, dtype=np.float64) for c in g.calls])
            seen = ~np.isnan(x)
            return g.j.to_numpy(), g.bp.to_numpy(), np.where(seen, x, 0.0), seen.astype(np.float64)

        j1, b1, x, mx = side(left)
        j2, b2, y, my = side(right)
        n, sx, sy, sxy = mx @ my.T, x @ my.T, mx @ y.T, x @ y.T
        sxx, syy = (x * x) @ my.T, mx @ (y * y).T
        cov, var = n * sxy - sx * sy, (n * sxx - sx * sx) * (n * syy - sy * sy)
        r = np.divide(cov * np.abs(cov) if signed else cov * cov, var, out=np.zeros_like(cov), where=var > 0)
        if signed:
            r = np.sign(r) * np.sqrt(np.abs(r))
        dist = np.abs(b2[None, :] - b1[:, None])
        # within one tile each pair once; between tiles by number
        keep = dist <= window
        keep &= (j1[:, None] < j2[None, :]) if key[0] == key[1] else (j1[:, None] != j2[None, :])
        if summed:
            return pd.DataFrame({"pairs": [int(keep.sum())], "r2": [float(r[keep].sum())]})
        p, q = np.nonzero(keep)
        return pd.DataFrame({"j1": np.minimum(j1[p], j2[q]), "j2": np.maximum(j1[p], j2[q]), "dist": dist[p, q], "r2": r[p, q]})

    return on_tile_pairs(rows, pairs, fold, "pairs long, r2 double" if summed else "j1 int, j2 int, dist long, r2 double")
