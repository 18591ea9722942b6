"""Kinship of all pairs as a float32 triangle, in pieces of whole rows.

The triangle of n samples takes 2 n (n - 1) bytes.  PLINK writes it in pieces
(``--make-king triangle bin4 --parallel``), which make up the file one after
another; so does this module.  A task makes a piece, writes it, reads it back,
passes on what a fold makes of the values and takes the next one, whose file
replaces it: pairs stay in the tasks, and the disk holds a piece for each task
that runs.  The whole file is what ``sinks.write_triangle`` writes.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require
from ..operators.kinship import bit_planes
from . import sinks

#: Values of a piece, pieces of a task, samples that rows meet at a time, and
#: words of those samples.
PIECE, EACH, CHUNK, WORDS = 1 << 22, 16, 1 << 15, 1 << 19


def row_cuts(n: int, most: int | None = None) -> np.ndarray:
    """First rows of the pieces, then ``n``: each has at most ``most`` values, or is a row."""
    most, cuts = most or PIECE, [1]
    while cuts[-1] < n:
        row = cuts[-1]
        end = (1 + isqrt(1 + 8 * (most + row * (row - 1) // 2))) // 2
        cuts.append(min(max(end, row + 1), n))
    return np.array(cuts)


def _write_planes(calls: DataFrame, path: str, n: int) -> int:
    """The bit planes of samples 0 to ``n`` - 1 in one file: of each sample its
    words, of each word its three planes.  Returns the words of a sample."""
    last, low, high = calls.agg(F.max("j"), F.min("i"), F.max("i")).first()
    width = (last or 0) // 64 + 1
    require(n == 0 or (low, high) == (0, n - 1), f"samples {low} to {high} of a triangle of {n}")
    rows = bit_planes(calls).groupBy("i").agg(F.collect_list(F.struct("w", "h", "r", "a")).alias("words"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i, lists = b.column(0).to_numpy(), b.column(1)
            if not len(i):
                continue
            words, of = lists.flatten(), np.repeat(np.arange(len(i)), lists.value_lengths().to_numpy())
            out = np.zeros((len(i), width, 3), "<i8")
            for k in range(3):
                out[of, words.field(0).to_numpy(), k] = words.field(k + 1).to_numpy()
            cuts = np.append(0, np.flatnonzero(np.diff(i) != 1) + 1)
            data = [out[x:y].tobytes() for x, y in zip(cuts, np.append(cuts[1:], len(i)))]
            yield pa.RecordBatch.from_arrays([pa.array(i[cuts].astype(np.int64) * (24 * width)), pa.array(data, pa.binary())], names=["offset", "data"])

    packed = rows.repartitionByRange("i").sortWithinPartitions("i").mapInArrow(pack, "offset long, data binary")
    sinks.write_in_place(packed, path, n * 24 * width)
    return width


def _planes(file, low: int, high: int, width: int) -> tuple[np.ndarray, ...]:  # noqa: ANN001
    """Words of the three planes of samples ``low`` to ``high``, and their heterozygous calls."""
    file.seek(24 * width * low)
    raw = np.frombuffer(file.read(24 * width * (high - low)), np.uint64).reshape(-1, width, 3)
    h, r, a = (np.ascontiguousarray(raw[:, :, k].T) for k in range(3))
    return h, r, a, np.bitwise_count(h).sum(axis=0, dtype=np.float32)


def _piece(file, first: int, last: int, width: int) -> np.ndarray:  # noqa: ANN001
    """Values of rows ``first`` to ``last``, the later sample's against all
    before it: float32 holds both counts, so that their quotient is the double
    one rounded; NaN where neither sample has a heterozygous call."""
    start = first * (first - 1) // 2
    out = np.empty(last * (last - 1) // 2 - start, np.float32)
    h2, r2, a2, own2 = _planes(file, first, last, width)
    step = max(64, min(CHUNK, WORDS // width))
    one, two = np.empty((2, step), np.uint64)
    for low in range(0, last - 1, step):
        high = min(low + step, last - 1)
        h1, r1, a1, own1 = _planes(file, low, high, width)
        for i in range(max(first, low + 1), last):
            n, at, k = min(i, high) - low, i * (i - 1) // 2 - start + low, i - first
            x, y, num = one[:n], two[:n], None
            for w in range(width):
                hh = np.bitwise_count(np.bitwise_and(h1[w, :n], h2[w, k], out=x))
                np.bitwise_and(r1[w, :n], a2[w, k], out=x)
                np.bitwise_and(a1[w, :n], r2[w, k], out=y)
                opposite = np.bitwise_count(np.bitwise_or(x, y, out=x))
                hh -= opposite
                hh -= opposite
                # from -128 to 64: what is left of a byte
                part = hh.view(np.int8)
                num = part.astype(np.float32) if num is None else num + part
            den, found = own1[:n] + own2[k], out[at : at + n]
            with np.errstate(divide="ignore", invalid="ignore"):
                np.divide(num, den, out=found)
            if not own2[k]:
                found[den == 0] = np.nan
    return out


def through_pieces(calls: DataFrame, n: int, folder: str, fold: Callable[[int, int, np.ndarray], list[np.ndarray]], schema: str) -> DataFrame:
    """``fold(first, last, values)`` of each piece (rows ``first`` to ``last``, row
    i has its values against samples 0 to i - 1) of the triangle of ``n`` samples'
    calls (i, j, d), as it is read back from its file in ``folder``, which driver
    and executors mount."""
    planes = f"{folder}/planes.bin"
    width, cuts = _write_planes(calls, planes, n), row_cuts(n)
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # another attempt of this task has a file of its own
        path = f"{folder}/k.bin.{TaskContext.get().taskAttemptId()}"
        try:
            with open(planes, "rb") as file:
                for b in batches:
                    for k in b.column(0).to_pylist():
                        first, last = int(cuts[k]), int(cuts[k + 1])
                        made = _piece(file, first, last, width).astype("<f4", copy=False)
                        made.tofile(path)
                        size, made = made.nbytes, None
                        values = np.fromfile(path, "<f4")
                        require(values.nbytes == size, f"rows {first} to {last} of the triangle have another size")
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in fold(first, last, values)], names=names)
        finally:
            if os.path.exists(path):
                os.remove(path)

    pieces = len(cuts) - 1
    tasks = max(1, min(pieces, max(64, pieces // EACH), 1 << 14))
    return calls.sparkSession.range(0, pieces, 1, tasks).mapInArrow(run, schema)


def value_counts(first: int, last: int, values: np.ndarray) -> list[np.ndarray]:
    """value and pairs: how many of a piece's values are the same."""
    found, pairs = np.unique(values, return_counts=True)
    return [found.astype(np.float64), pairs.astype(np.int64)]


def row_figures(first: int, last: int, values: np.ndarray) -> list[np.ndarray]:
    """i1, pairs, low and high of each row of a piece that has a kinship: how many, the least and the greatest."""
    rows = np.arange(first, last)
    at, there = rows * (rows - 1) // 2 - first * (first - 1) // 2, ~np.isnan(values)
    pairs = rows if there.all() else np.add.reduceat(there, at, dtype=np.int64)
    keep = pairs > 0
    found = [f.reduceat(values, at)[keep].astype(np.float64) for f in (np.fmin, np.fmax)]
    return [rows[keep].astype(np.int32), pairs[keep].astype(np.int64), *found]
