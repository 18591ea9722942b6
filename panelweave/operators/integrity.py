"""Identity, checksums and round trips."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import require
from ..functions.shared import open_input


def ordered_identity(a: DataFrame, b: DataFrame, idx: str) -> DataFrame:
    """differences and identical: rows, matched by idx, that are missing on a
    side or differ in any column; nulls are equal to nulls."""
    cols = [c for c in a.columns if c != idx]
    require(a.columns == b.columns, f"columns differ: {a.columns} and {b.columns}")
    left = a.select(idx, F.struct(*cols, F.lit(True).alias("__there")).alias("l"))
    right = b.select(idx, F.struct(*cols, F.lit(True).alias("__there")).alias("r"))
    return left.join(right, idx, "full").agg(F.count_if(~F.col("l").eqNullSafe(F.col("r"))).alias("differences")).select("differences", (F.col("differences") == 0).alias("identical"))


def record_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """key, expected, actual of metadata (key, value) that is missing or differs."""
    e, a = expected.select("key", F.col("value").alias("expected")), actual.select("key", F.col("value").alias("actual"))
    return e.join(a, "key", "left").where(~F.col("expected").eqNullSafe(F.col("actual")))


#: Bytes that a task holds of a file that it digests.
BUFFER = 1 << 20


def _paths(spark: SparkSession, path: str, pattern: str, recursive: bool) -> DataFrame:
    """Paths of the files below a folder, empty ones too: the listing, not what they hold."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return spark.createDataFrame([(unquote(f),) for f in files.inputFiles()], "path string")


def digests(files: DataFrame, path: str = "path", crlf: bool = False, md5: bool = False) -> DataFrame:
    """Columns of ``files``, bytes and digests of each file, streamed by the tasks.

    Each task takes paths and reads every file of its own in buffers of
    ``BUFFER`` bytes, whatever its size.  sha256 is of the raw bytes;
    crlf_sha256 of what the file would be with CRLF line ends; md5 if asked for.
    """
    names = ["sha256", *(["crlf_sha256"] if crlf else []), *(["md5"] if md5 else [])]
    schema = StructType([*files.schema.fields, StructField("bytes", LongType()), *(StructField(n, StringType()) for n in names)])
    at = files.columns.index(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [file_digests(p, crlf, md5) for p in b.column(at).to_pylist()]
            for k, n in enumerate(["bytes", *names]):
                b = b.append_column(n, pa.array([f[k] for f in found]))
            yield b

    # a path a row: large files are dealt to as many tasks as there are
    return files.repartition(max(1, min(1000, files.count())), path).mapInArrow(run, schema)


def file_digests(path: str, crlf: bool = False, md5: bool = False) -> list:
    """Bytes and digests of one file."""
    sums = [hashlib.sha256(), *([hashlib.sha256()] if crlf else []), *([hashlib.md5(usedforsecurity=False)] if md5 else [])]
    was, size = b"", 0
    with open_input(path) as file:
        while part := file.read(BUFFER):
            size += len(part)
            sums[0].update(part)
            if crlf:
                # a line end that has its CR keeps it, also where a buffer ends between the two
                text = part[1:] if was == b"\r" and part[:1] == b"\n" else part
                sums[1].update((b"\n" if text is not part else b"") + text.replace(b"\r\n", b"\n").replace(b"\n", b"\r\n"))
                was = part[-1:]
            if md5:
                sums[-1].update(part)
    return [size, *(s.hexdigest() for s in sums)]


def file_manifest(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True, md5: bool = False) -> DataFrame:
    """path, bytes, sha256 of each file's raw bytes (and md5 if asked for)."""
    return digests(_paths(spark, path, pattern, recursive), md5=md5).withColumn("path", F.regexp_replace("path", r"^\w+:/*", "/"))


def with_crlf_digest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """As file_manifest, with the digest that the file would have with CRLF line ends."""
    return digests(_paths(spark, path, pattern, True), crlf=True).withColumn("path", F.regexp_replace("path", r"^\w+:/*", "/"))


def compare_manifest(found: DataFrame, recorded: DataFrame) -> DataFrame:
    """path and status: match, match_after_crlf, differs, missing, unlisted.

    Digests are of raw bytes; line ends are never changed silently."""
    has_crlf = "crlf_sha256" in found.columns
    f = found.select("path", F.col("sha256").alias("got"), (F.col("crlf_sha256") if has_crlf else F.lit(None).cast("string")).alias("crlf"))
    r = recorded.select("path", F.lower("sha256").alias("want"))
    status = F.when(F.col("want").isNull(), "unlisted").when(F.col("got").isNull(), "missing").when(F.col("got") == F.col("want"), "match").when(F.col("crlf") == F.col("want"), "match_after_crlf").otherwise("differs")
    return f.join(r, "path", "full").select("path", status.alias("status"))


def oversized(manifest: DataFrame, limit: int = 100_000_000) -> DataFrame:
    return manifest.where(F.col("bytes") >= limit)


def pair_equivalence(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """differences, compared: rows (keys, a1, a2) whose unordered allele pairs
    differ; equal sum and equal product make pairs equal whatever their order."""
    left = a.select(*keys, (F.col("a1") + F.col("a2")).alias("s1"), (F.col("a1") * F.col("a2")).alias("p1"))
    right = b.select(*keys, (F.col("a1") + F.col("a2")).alias("s2"), (F.col("a1") * F.col("a2")).alias("p2"))
    both = left.join(right, list(keys), "full")
    return both.agg(F.count_if(~(F.col("s1").eqNullSafe(F.col("s2")) & F.col("p1").eqNullSafe(F.col("p2")))).alias("differences"), F.count("*").alias("compared"))


def calls_differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """differences of two decoders' (i, j, d), for round trips; ``d`` may be the
    calls of several samples from ``i`` on, which are then one difference at most."""
    both = a.select("i", "j", F.struct("d").alias("x")).join(b.select("i", "j", F.struct("d").alias("y")), ["i", "j"], "full")
    return both.agg(F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("differences"))


def check_fileset(samples: DataFrame, markers: DataFrame, bed_length: int, bed_head: bytes) -> None:
    """Structure of a PLINK1 fileset: magic, size, unique and complete ids."""
    require(bed_head == b"\x6c\x1b\x01", "the BED file is not SNP-major")
    n, m = samples.count(), markers.count()
    require(bed_length == 3 + m * -(-n // 4), f"{bed_length} bytes do not fit {n} samples and {m} markers")
    for df, keys in ((samples, ["fid", "iid"]), (markers, ["id"])):
        require(df.groupBy(*keys).count().where("count > 1").isEmpty(), f"repeated {'/'.join(keys)}")
        require(df.where(" or ".join(f"{k} is null or {k} = ''" for k in keys)).isEmpty(), f"empty {'/'.join(keys)}")
    require(markers.where("pos < 0 or pos is null").isEmpty(), "negative positions")
    require(samples.where("sex not in (0, 1, 2) or sex is null").isEmpty(), "unknown sex codes")
