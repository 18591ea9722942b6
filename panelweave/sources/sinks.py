"""Sinks and the life cycle of outputs: staged, verified, then installed."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import require
from ..functions.shared import written
from ..operators import scans


def write_csv(df: DataFrame, path: str, na: str = "", quoted: bool = True, sep: str = ",", single: bool = True) -> None:
    """CSV with header; nulls become ``na``; ``quoted`` False never quotes."""
    out = (df.coalesce(1) if single else df).write.mode("overwrite").option("header", "true").option("sep", sep).option("nullValue", na).option("emptyValue", "")
    if not quoted:
        out = out.option("quote", "").option("escape", "\\")
    out.csv(path)


def write_lines(df: DataFrame, column: str, order: str, path: str, codec: str = "none") -> None:
    """Text lines in order."""
    df.repartitionByRange(order).sortWithinPartitions(order).select(column).write.mode("overwrite").option("compression", codec).text(path)


def ped_lines(samples: DataFrame, cells: DataFrame) -> DataFrame:
    """i and line of a PED file: six fields, then the alleles in marker order."""
    alleles = cells.groupBy("i").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("j", "a1", "a2"))), lambda s: F.concat_ws(" ", s["a1"].cast("string"), s["a2"].cast("string"))), " ").alias("a"))
    return samples.join(alleles, "i").select("i", F.concat_ws(" ", "fid", "iid", "pat", "mat", F.col("sex").cast("string"), "pheno", "a").alias("line"))


def vcf_lines(markers: DataFrame, alleles: DataFrame, names: list[str]) -> DataFrame:
    """j (-1 for the header) and line of a phased VCF."""
    gt = alleles.groupBy("j", F.floor(F.col("hap") / 2).alias("i")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("hap", "allele"))), lambda s: F.coalesce(s["allele"].cast("string"), F.lit("."))), "|").alias("gt"))
    row = gt.groupBy("j").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "gt"))), lambda s: s["gt"]), "\t").alias("g"))
    body = markers.join(row, "j").select("j", F.concat_ws("\t", "chr", F.col("pos").cast("string"), "id", "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT"), "g").alias("line"))
    head = markers.sparkSession.createDataFrame([(-2, "##fileformat=VCFv4.2"), (-1, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names]))], "j int, line string")
    return head.unionByName(body)


def write_in_place(rows: DataFrame, path: str, size: int, start: int = 0) -> None:
    """One file out of pieces (offset, data) that the tasks write where they
    belong, beyond the first ``start`` bytes, which stay.  The pieces must make
    up ``size`` bytes; a task that runs again writes the same bytes again."""
    with open(path, "r+b" if start else "wb") as file:
        file.truncate(start + size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        with open(path, "r+b") as file:
            for b in batches:
                for at, data in sorted(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                    file.seek(start + at)
                    done += file.write(data)
            file.flush()
            os.fsync(file.fileno())
        yield pa.RecordBatch.from_arrays([pa.array([done])], names=["n"])

    done = rows.select(F.col("offset").cast("long"), F.col("data").cast("binary")).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    require(done == size, f"{path}: pieces of {done} bytes for {size}")


def write_ordered(lines: DataFrame, path: str, order: str, column: str) -> None:
    """A text file of lines in order: each line's place is a running sum of the
    sizes of those before it."""
    rows = lines.select(F.col(order).alias("at"), F.col(column).alias("text")).withColumn("size", F.octet_length("text").cast("long") + 1)
    placed = scans.running_sums(rows, ["at"], end=F.col("size"))
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    write_in_place(placed.select((F.col("end") - F.col("size")).alias("offset"), F.concat("text", F.lit("\n")).alias("data")), path, total)


def write_triangle(pairs: DataFrame, path: str, n: int, dealt: bool = False) -> None:
    """A float32 lower triangle without diagonal from (i1 < i2, value) of all
    pairs of ``n`` samples; each task writes the stretches that it holds.

    ``dealt``: the pairs of an ``i2`` come in stretches of ``i1``, as those of
    ``kinship.king_pairs`` do, and are written as they come; others are sorted
    first.  The file is there only once its stretches make up every row."""
    part = f"{path}.part"
    with open(part, "wb") as file:
        file.truncate(2 * n * (n - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(part, "r+b") as file:
            for b in batches:
                i1, i2 = (b.column(k).to_numpy().astype(np.int64) for k in (0, 1))
                if not len(i1):
                    continue
                x = b.column(2).to_numpy(zero_copy_only=False).astype("<f4")
                cuts = np.append(0, np.flatnonzero((np.diff(i1) != 1) | (np.diff(i2) != 0)) + 1)
                sizes = np.diff(np.append(cuts, len(i1)))
                row, low = i2[cuts], i1[cuts]
                inside = (low >= 0) & (low + sizes <= row) & (row < n)
                offsets = 4 * (row * (row - 1) // 2 + low)
                for k in np.flatnonzero(inside)[np.argsort(offsets[inside])].tolist():
                    file.seek(offsets[k])
                    file.write(x[cuts[k] : cuts[k] + sizes[k]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.where(inside, low, -1)), pa.array(sizes)], names=["i2", "low", "n"])
            file.flush()
            os.fsync(file.fileno())

    rows = pairs.select("i1", "i2", F.col("value").cast("double").alias("value"))
    if not dealt:
        rows = rows.repartitionByRange("i2", "i1").sortWithinPartitions("i2", "i1")
    try:
        spans = written(rows.mapInArrow(run, "i2 long, low long, n long"), "stretches")
        # the stretches of a row, whose number is that of the blocks it crosses
        end = F.lag(F.col("low") + F.col("n"), 1, 0).over(W.partitionBy("i2").orderBy("low", "n"))
        gaps = spans.select("i2", "n", (F.col("low") != end).alias("gap")).groupBy("i2").agg(F.sum("n").alias("found"), F.max("gap").alias("gap"))
        rows, bad = gaps.agg(F.count("*"), F.min(F.when(F.expr("i2 < 1 or gap or found <> i2"), F.col("i2")))).first()
        require(bad is None, f"row {bad} of the triangle is not complete")
        require(rows == max(n - 1, 0), f"the triangle has {rows} rows for {n} samples")
    except BaseException:
        os.remove(part)
        raise
    os.replace(part, path)


def sha256_file(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


def copy_exact(source: str, target: str) -> str:
    """Copy a file byte for byte; the digest of both."""
    shutil.copyfile(source, target)
    want = sha256_file(source)
    require(sha256_file(target) == want, f"{target} differs from {source}")
    return want


def install(files: dict[str, str], force: bool = False) -> None:
    """Put staged files (source to target) in place, all or none.

    Copies are verified beside their targets before anything is renamed; what
    stood there is set aside and comes back if any step fails.
    """
    if not force:
        there = [t for t in files.values() if os.path.exists(t)]
        require(not there, f"already there: {', '.join(there)}")
    new, old, done = {t: f"{t}.installing" for t in files.values()}, {t: f"{t}.replaced" for t in files.values()}, []
    # a file that an earlier crash set aside may be the only copy there is
    stale = [t for t in [*new.values(), *old.values()] if os.path.exists(t)]
    require(not stale, f"left by an earlier run: {', '.join(stale)}")
    try:
        digests = {t: copy_exact(s, new[t]) for s, t in files.items()}
        for t in files.values():
            if os.path.exists(t):
                os.replace(t, old[t])
            done.append(t)
            os.replace(new[t], t)
        for t, d in digests.items():
            require(sha256_file(t) == d, f"{t} changed while it was installed")
    except BaseException:
        for t in done:
            if os.path.exists(t):
                os.remove(t)
            if os.path.exists(old[t]):
                os.replace(old[t], t)
        for t in new.values():
            if os.path.exists(t):
                os.remove(t)
        raise
    for t in old.values():
        if os.path.exists(t):
            os.remove(t)


def install_directory(staged: str, target: str, keep: Iterable[str] = ("README.md",), force: bool = False) -> None:
    """Replace a folder by a staged one; files named in ``keep`` stay."""
    require(force or not os.path.exists(target), f"{target} is already there")
    aside = f"{target}.replaced"
    try:
        if os.path.exists(target):
            os.replace(target, aside)
        shutil.copytree(staged, target)
        for name in keep:
            if os.path.exists(f"{aside}/{name}") and not os.path.exists(f"{target}/{name}"):
                shutil.copyfile(f"{aside}/{name}", f"{target}/{name}")
    except BaseException:
        shutil.rmtree(target, ignore_errors=True)
        if os.path.exists(aside):
            os.replace(aside, target)
        raise
    shutil.rmtree(aside, ignore_errors=True)


def safe_remove(path: str, root: str) -> None:
    """Delete a folder that lies inside ``root`` and is not ``root`` itself."""
    inner, outer = os.path.realpath(path), os.path.realpath(root)
    require(inner.startswith(outer + os.sep), f"{path} lies outside {root}")
    shutil.rmtree(inner, ignore_errors=True)


class Blocks:
    """Blocks of a build under one folder: written, verified, then listed.

    A block is computed again unless its manifest agrees with what is expected
    in every entry, so a resumed run never reuses incompatible data.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = lambda *p: hadoop.Path("/".join([root, *p]))
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _read(self, block: int) -> dict | None:
        path = self._path(f"block-{block}", "manifest")
        if not self._fs.exists(path):
            return None
        return json.loads(self.spark.read.text(path.toString()).first()[0])

    def mismatches(self, block: int, expected: dict) -> dict[str, tuple]:
        """Entries of the manifest that are missing or differ, with both values."""
        got = self._read(block) or {}
        return {k: (v, got.get(k)) for k, v in expected.items() if k not in got or type(got[k]) is not type(v) or got[k] != v}

    def valid(self, block: int, expected: dict) -> bool:
        return self._read(block) is not None and not self.mismatches(block, expected)

    def write(self, block: int, df: DataFrame, metadata: dict, replace: bool = False) -> None:
        """Stage, read back and compare, then rename."""
        require(replace or self._read(block) is None, f"block {block} is already there")
        staged = f"block-{block}.staged"
        self._fs.delete(self._path(staged), True)
        df.write.parquet(f"{self.root}/{staged}/data")
        digest = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first())
        back = self.spark.read.schema(df.schema).parquet(f"{self.root}/{staged}/data")
        n, check = digest(back)
        entry = metadata | {"block": block, "rows": n, "digest": str(check), "spark": self.spark.version}
        self.spark.createDataFrame([(json.dumps(entry, sort_keys=True),)], "value string").coalesce(1).write.text(f"{self.root}/{staged}/manifest")
        self._fs.delete(self._path(f"block-{block}"), True)
        require(self._fs.rename(self._path(staged), self._path(f"block-{block}")), f"block {block} could not be installed")

    def build(self, blocks: Iterable[int], make, expected: dict) -> list[int]:  # noqa: ANN001
        """Make the blocks that are not valid; returns those that were made."""
        made = []
        for b in blocks:
            if not self.valid(b, expected | {"block": b}):
                self.write(b, make(b), expected, replace=True)
                made.append(b)
        return made

    def assemble(self, blocks: Iterable[int], expected: dict) -> DataFrame:
        """All blocks as one table; each must be valid, and 1..k complete."""
        numbers = sorted(blocks)
        require(numbers == list(range(1, len(numbers) + 1)), f"blocks are {numbers}")
        for b in numbers:
            bad = self.mismatches(b, expected | {"block": b})
            require(not bad, f"block {b}: {bad}")
        return self.spark.read.parquet(*(f"{self.root}/block-{b}/data" for b in numbers))


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside ``path`` and swap, so that readers see all or nothing new."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, fresh, old = (hadoop.Path(p) for p in (path, f"{path}.fresh", f"{path}.old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(fresh, True)
    df.write.parquet(fresh.toString())
    fs.delete(old, True)
    if fs.exists(target):
        require(fs.rename(target, old), f"{path} could not be set aside")
    require(fs.rename(fresh, target), f"{path} could not be replaced")
    fs.delete(old, True)


def session_record(spark: SparkSession, began: float | None = None) -> DataFrame:
    """name and value of what a build ran on, for its manifest; with ``began``
    (seconds since 1970) also when it started and how long it took so far."""
    import platform
    import time

    rows = [("spark", spark.version), ("python", platform.python_version()), ("system", platform.platform()), ("ansi", str(spark.conf.get("spark.sql.ansi.enabled"))), ("time_zone", spark.conf.get("spark.sql.session.timeZone"))]
    if began is not None:
        rows += [("started", time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(began))), ("elapsed_seconds", f"{time.time() - began:.3f}")]
    return spark.createDataFrame(rows, "name string, value string")


def write_report(lines: DataFrame, path: str, order: str = "line", column: str = "value") -> None:
    """Report lines in order, staged and renamed: readers see all or nothing."""
    write_ordered(lines, f"{path}.part", order, column)
    os.replace(f"{path}.part", path)
