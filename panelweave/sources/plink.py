"""PLINK1 filesets: .bed, .bim and .fam.

A BED file is cut at byte ranges of whole markers; a filter on ``j``, or a list of
markers, leaves only the ranges that hold them, and of a list of samples only
their bytes are unpacked.  The dosage counts the allele of BIM column 5: code 00 is 2,
01 missing, 10 is 1 and 11 is 0.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions import require
from ..functions.shared import open_input as _open
from ..operators import integrity, scans
from . import sinks
from .text import with_line_number

MAGIC = b"\x6c\x1b\x01"
#: Dosage of each two-bit code; -1 is missing.
DOSAGE = np.array([2, -1, 1, 0], np.int8)
#: Two-bit code of dosages 0 to 2, and of a missing one.
CODES = np.array([3, 2, 0, 1], np.uint8)
#: Bytes of a partition; bytes between two wanted markers that are read over
#: rather than sought past.
RANGE_BYTES, GAP_BYTES = 64 << 20, 4096
#: Bytes of a task of the second decoder, and of a piece that it decodes at a time.
SQL_BYTES, PIECE = 1 << 20, 256
#: Ids of a list that goes to the reader; a longer one is met by a semi-join.
LISTED = 1 << 20
FAM = ["fid", "iid", "pat", "mat", "sex", "pheno"]
BIM = ["chr", "id", "cm", "pos", "a1", "a2"]


def runs_text(ids: list[int]) -> str:
    """Sorted distinct ids as runs: ``0-3,7-7`` is 0 to 3 and 7."""
    x = np.unique(np.asarray(ids, np.int64))
    cut = np.flatnonzero(np.diff(x) != 1)
    return ",".join(f"{a}-{b}" for a, b in zip(x[np.append(0, cut + 1)], x[np.append(cut, len(x) - 1)])) if len(x) else ""


def runs_ids(text: str) -> np.ndarray:
    ends = [tuple(map(int, r.split("-"))) for r in text.split(",") if r]
    return np.concatenate([np.arange(r[0], r[-1] + 1) for r in ends]) if ends else np.zeros(0, np.int64)


class _Ranges(InputPartition):
    def __init__(self, runs: list[tuple[int, int]]):
        self.runs = runs


class _BedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.n = options["path"], int(options["samples"])
        self.width = -(-self.n // 4)
        self.low, self.high, self.only = 0, None, None
        if "keep_markers" in options:
            self.only = set(runs_ids(options["keep_markers"]).tolist())
        self.lanes = None
        if "keep_samples" in options:
            lanes = runs_ids(options["keep_samples"])
            self.lanes = lanes[(lanes >= 0) & (lanes < self.n)]
        self.step = max(1, int(options.get("range_bytes", RANGE_BYTES)) // max(1, self.width))
        self.gap = min(int(options.get("gap_bytes", GAP_BYTES)) // max(1, self.width), self.step - 1)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("j",):
                if isinstance(f, (EqualTo, In)):
                    wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                    self.only = wanted if self.only is None else self.only & wanted
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    top = f.value + isinstance(f, LessThanOrEqual)
                    self.high = top if self.high is None else min(self.high, top)
            yield f  # Spark filters the rows as well

    def partitions(self) -> list[_Ranges]:
        with _open(self.path) as file:
            head, size = file.read(3), file.size()
        require(head == MAGIC, f"{self.path} is not a SNP-major BED file")
        require((size - 3) % max(1, self.width) == 0, f"{self.path} does not hold whole markers of {self.n} samples")
        n = (size - 3) // self.width if self.width else 0
        low, high = self.low, n if self.high is None else min(n, self.high)
        if self.only is None:
            return [_Ranges([(a, min(a + self.step, high))]) for a in range(low, high, self.step)]
        wanted = np.array(sorted(j for j in self.only if j is not None and low <= j < high), np.int64)
        if not len(wanted):
            return []
        cut = np.flatnonzero(np.diff(wanted) > 1 + self.gap)
        out, held = [], 0
        for a, b in zip(wanted[np.append(0, cut + 1)].tolist(), (wanted[np.append(cut, len(wanted) - 1)] + 1).tolist()):
            for first in range(a, b, self.step):
                last = min(first + self.step, b)
                if not out or held + last - first > self.step:
                    out.append(_Ranges([]))
                    held = 0
                out[-1].runs.append((first, last))
                held += last - first
        return out

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        only = None if self.only is None else np.array(sorted(j for j in self.only if j is not None), np.int64)
        lanes = np.arange(self.n) if self.lanes is None else self.lanes
        byte, shift = lanes // 4, (lanes % 4 * 2).astype(np.uint8)
        rows = max(1, (4 << 20) // max(1, self.n))
        with _open(self.path) as file:
            for first, last in partition.runs:
                file.seek(3 + first * self.width)
                for a in range(first, last, rows):
                    m = min(rows, last - a)
                    raw, j = np.frombuffer(file.read(m * self.width), np.uint8).reshape(m, self.width), np.arange(a, a + m)
                    if only is not None:
                        here = np.isin(j, only)
                        raw, j = raw[here], j[here]
                    calls = DOSAGE[(raw[:, byte] >> shift) & 3].ravel()
                    lists = lambda values: pa.ListArray.from_arrays(pa.array(np.arange(len(j) + 1, dtype=np.int32) * len(lanes)), values)  # noqa: B023, E731
                    columns = {"j": pa.array(j.astype(np.int32)), "calls": lists(pa.array(calls, mask=calls < 0))}
                    if self.lanes is not None:
                        columns["samples"] = lists(pa.array(np.tile(lanes, len(j)).astype(np.int32)))
                    yield pa.RecordBatch.from_pydict(columns)


class BedSource(DataSource):
    """``spark.read.format("plink_bed")`` with options path and samples."""

    @classmethod
    def name(cls) -> str:
        return "plink_bed"

    def schema(self) -> str:
        return "j int, calls array<tinyint>" + (", samples array<int>" if "keep_samples" in self.options else "")

    def reader(self, schema: Any) -> _BedReader:
        return _BedReader(dict(self.options))


def read_bed(spark: SparkSession, path: str, n_samples: int, range_bytes: int = RANGE_BYTES, samples: list[int] | None = None, markers: list[int] | None = None) -> DataFrame:
    """j and calls (in sample order) of each marker, by byte ranges; with a list
    of ``samples`` only theirs, and who they are.  Filters on j reach the reader:
    Spark refuses a reader that takes them unless the session allows it, so it
    is allowed here."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BedSource)
    source = spark.read.format("plink_bed").option("samples", n_samples).option("range_bytes", range_bytes)
    for name, ids in (("keep_samples", samples), ("keep_markers", markers)):
        if ids is not None:
            source = source.option(name, runs_text(ids))
    return source.load(path)


def decode_block(block: Column, n: int | Column) -> Column:
    """A second decoder, of SQL functions only: a marker's bytes to calls.

    Each call takes its byte out of a copy of the block, so blocks are short."""

    def call(i: Column) -> Column:
        byte = F.conv(F.hex(F.substring(block, (F.floor(i / 4) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        code = F.floor(byte / F.pow(F.lit(4), i % 4)).cast("int") % 4
        return F.when(code == 0, 2).when(code == 2, 1).when(code == 3, 0).cast("tinyint")

    return F.transform(F.sequence(F.lit(0), F.lit(n) - 1 if isinstance(n, int) else n - 1), call)


def read_pieces_sql(spark: SparkSession, path: str, n_samples: int, range_bytes: int = SQL_BYTES, piece: int = PIECE) -> DataFrame:
    """j, first and calls of each piece (``piece`` bytes of a marker, from sample
    ``first`` on) of a BED file through ``decode_block``: tasks read byte ranges, of
    a marker or of several, and cut them into pieces, which SQL functions decode."""
    width = -(-n_samples // 4)
    with _open(path) as file:
        m = (file.size() - 3) // width if width else 0
    # sections of one marker each, a whole number of pieces
    section = max(1, min(width, max(range_bytes // piece, 1) * piece))
    each, step = -(-width // section), max(1, range_bytes // section)
    total = m * each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            with _open(path) as file:
                for first in (b.column(0).to_numpy() * step).tolist():
                    for s in range(first, min(first + step, total)):
                        j, low = s // each, s % each * section
                        file.seek(3 + j * width + low)
                        raw = file.read(min(section, width - low))
                        at = np.arange(0, len(raw), piece)
                        blocks = [raw[k : k + piece] for k in at.tolist()]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), j, np.int32)), pa.array((4 * (low + at)).astype(np.int32)), pa.array(blocks, pa.binary())], names=["j", "first", "block"])

    tasks = -(-total // step)
    pieces = spark.range(0, tasks, 1, max(1, tasks)).mapInArrow(run, "j int, first int, block binary")
    held = F.least(4 * F.length("block"), F.lit(n_samples) - F.col("first"))
    return pieces.select("j", "first", decode_block(F.col("block"), held).alias("calls"))


def read_calls_sql(spark: SparkSession, path: str, n_samples: int, range_bytes: int = SQL_BYTES, piece: int = PIECE) -> DataFrame:
    """i, j, d of a BED file by ``read_pieces_sql``."""
    pieces = read_pieces_sql(spark, path, n_samples, range_bytes, piece)
    return pieces.select("j", "first", F.posexplode("calls").alias("k", "d")).select((F.col("first") + F.col("k")).alias("i"), "j", "d")


def decoders_differ(spark: SparkSession, path: str, n_samples: int, piece: int = PIECE) -> DataFrame:
    """differences: pieces of a BED file in which the two decoders disagree on any
    call, or that one of them lacks.  Both sides travel as a list of calls a piece."""
    first = F.sequence(F.lit(0), F.lit(max(n_samples - 1, 0)), F.lit(4 * piece))
    cut = F.transform(first, lambda f: F.struct(f.alias("i"), F.slice("calls", f + 1, 4 * piece).alias("d")))
    one = read_bed(spark, path, n_samples).select("j", F.inline(cut))
    return integrity.calls_differ(one, read_pieces_sql(spark, path, n_samples, piece=piece).select("j", F.col("first").alias("i"), F.col("calls").alias("d")))


def read_bed_sql(spark: SparkSession, path: str, n_samples: int, range_bytes: int = SQL_BYTES) -> DataFrame:
    """j and calls (in sample order) of each marker, by ``read_calls_sql``, for comparison."""
    from ..operators.genotype import wide_markers

    return wide_markers(read_calls_sql(spark, path, n_samples, range_bytes))


def bed_head_ok(spark: SparkSession, path: str) -> bool:
    """Whether a file begins like a SNP-major BED; only those bytes are read."""
    with _open(path) as file:
        return file.read(3) == MAGIC


def read_fam(spark: SparkSession, path: str) -> DataFrame:
    """i, fid, iid, pat, mat, sex, pheno; blanks or tabs; phenotypes stay text."""
    lines = with_line_number(spark, path)
    f = F.split(F.trim("value"), r"\s+")
    return lines.where(F.trim("value") != "").select(F.col("line").cast("int").alias("i"), *(f[k].alias(c) for k, c in enumerate(FAM))).withColumn("sex", F.col("sex").try_cast("tinyint"))


def read_bim(spark: SparkSession, path: str) -> DataFrame:
    """j, chr, id, cm, pos, a1, a2; no comment handling (ids may begin with #)."""
    lines = with_line_number(spark, path)
    f = F.split(F.trim("value"), r"\s+")
    out = lines.where(F.trim("value") != "").select(F.col("line").cast("int").alias("j"), *(f[k].alias(c) for k, c in enumerate(BIM)))
    return out.withColumns({"cm": F.col("cm").try_cast("double"), "pos": F.col("pos").try_cast("long")})


def _listed(df: DataFrame | None, key: str) -> list[int] | None:
    """The ids of a list that is short enough for the reader."""
    if df is None:
        return None
    ids = [r[0] for r in df.select(key).distinct().where(F.col(key).isNotNull()).limit(LISTED + 1).collect()]
    return ids if len(ids) <= LISTED else None


def read_calls(spark: SparkSession, prefix: str, samples: DataFrame | None = None, markers: DataFrame | None = None) -> DataFrame:
    """i, j, d of a fileset; only the given samples (i) and markers (j)."""
    n = read_fam(spark, f"{prefix}.fam").count()
    keep, extract = _listed(samples, "i"), _listed(markers, "j")
    bed = read_bed(spark, f"{prefix}.bed", n, samples=keep, markers=extract)
    if markers is not None and extract is None:
        bed = bed.join(markers.select("j").distinct(), "j", "left_semi")
    if keep is not None:
        return bed.select("j", F.explode(F.arrays_zip("samples", "calls")).alias("c")).select(F.col("c.samples").alias("i"), "j", F.col("c.calls").alias("d"))
    rows = bed.select(F.posexplode("calls").alias("i", "d"), "j")
    if samples is not None:
        rows = rows.join(samples.select("i").distinct(), "i", "left_semi")
    return rows.select("i", "j", "d")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1)
        # a look-up by dosage, nulls last
        flat = CODES[pc.fill_null(lists.flatten().cast(pa.int8()), 3).to_numpy(zero_copy_only=False)]
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        out = []
        for i, j in zip(ends[:-1], ends[1:]):
            x = np.concatenate([flat[i:j], np.zeros((i - j) % 4, np.uint8)]).reshape(-1, 4)
            out.append((x << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["j", "block"])


def write_bed(markers: DataFrame, path: str, append: bool = False) -> None:
    """Write (j, calls) in the order of j; ``append`` adds to an existing file.

    All markers take the same bytes, so each task writes its own where they
    belong; the driver sets up the header and the size."""
    packed = markers.select("j", "calls").mapInArrow(_pack, "j int, block binary")
    placed = scans.places(packed, ["j"])
    n, low, high = placed.agg(F.count("*"), F.min(F.length("block")), F.max(F.length("block"))).first()
    require(low == high, "markers have calls of different numbers of samples")
    if not append:
        with open(path, "wb") as file:
            file.write(MAGIC)
    width = high or 0
    pieces = placed.select(((F.col("place") - 1) * width).alias("offset"), F.col("block").alias("data"))
    sinks.write_in_place(pieces, path, n * width, os.path.getsize(path))


def write_table(df: DataFrame, path: str, order: str, columns: list[str], sep: str = "\t") -> None:
    """A BIM or FAM file, in order."""
    kind = dict(df.dtypes)

    def text(c: str) -> Column:
        shown = F.col(c).cast("string")
        if kind[c] in ("double", "float"):
            shown = _short(F.col(c).cast("double"))  # ten significant digits
        return F.coalesce(shown, F.lit("0"))

    sinks.write_ordered(df.select(order, F.concat_ws(sep, *(text(c) for c in columns)).alias("__line")), path, order, "__line")


@F.pandas_udf(StringType())
def _short(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else f"{v:.10g}")


def default_fam(ids: DataFrame) -> DataFrame:
    """FAM rows of (i, iid): family = id, no parents, unknown sex, phenotype -9."""
    return ids.select("i", F.col("iid").alias("fid"), "iid", F.lit("0").alias("pat"), F.lit("0").alias("mat"), F.lit(0).cast("tinyint").alias("sex"), F.lit("-9").alias("pheno"))


def write_fileset(prefix: str, calls: DataFrame, markers: DataFrame, samples: DataFrame) -> None:
    from ..operators.genotype import wide_markers

    write_bed(wide_markers(calls), f"{prefix}.bed")
    write_table(markers, f"{prefix}.bim", "j", BIM)
    write_table(samples, f"{prefix}.fam", "i", FAM)
