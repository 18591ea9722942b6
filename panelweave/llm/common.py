"""What the operators share: shared folders, word tables, hashing of ids."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch.  A batch of whole texts has to fit a Python worker
#: several times over; texts have no length bound, so the row count is kept low.
ARROW_ROWS = 1000
#: Bytes of one Arrow batch, and of the rows that a worker lays out together; a
#: longer row is a batch of its own.
ARROW_BYTES = 4 << 20


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that whole texts travel in, by rows and bytes."""
    for key, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(re.sub(r"\D", "", spark.conf.get(key, None) or "") or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is set as checkpoint
    directory once and used from then on; only on one machine, as no other
    machine could see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    now = spark.sparkContext._jsc.sc().getCheckpointDir()
    if now.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="panelweave-"))
        now = spark.sparkContext._jsc.sc().getCheckpointDir()
    return now.get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives
    the loss of executors, and is computed once however often it is read."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete written tables that nothing will read any more."""
    for t in tables:
        for p in [t] if isinstance(t, str) else {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def frugal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, handing Arrow's unused memory back after each, and Python's
    at the end: a worker's memory follows the batch at hand, not the largest one
    so far, and an idle worker keeps little."""
    pool = pa.default_memory_pool()
    try:
        for b in batches:
            yield b
            del b
            pool.release_unused()
    finally:
        if trim := _trim():
            trim(0)


@lru_cache(maxsize=1)
def _trim():  # noqa: ANN202
    """The C library's call that hands free memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def part(b: pa.RecordBatch | pa.Array, at: int, to: int) -> pa.RecordBatch | pa.Array:
    """Rows ``at`` to ``to``, copied: some of Arrow's string kernels misread an
    array that starts within its buffers."""
    return b.take(pa.array(np.arange(at, to)))


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = ARROW_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut where the bytes of a text column pass ``size``, so that what
    a worker lays out follows the bound, not the batch; a longer text is alone.
    Empty batches are left out."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield b if to - at == b.num_rows else part(b, at, to)
            at = to


def merged(batches: Iterator[pa.RecordBatch], column: int, rows: int = 2000, size: int = ARROW_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined, or cut by the bytes of a text column, to about ``rows``
    rows or ``size`` bytes: more texts share the work on their distinct words,
    within the same bound."""
    held: list[pa.RecordBatch] = []
    for b in slices(batches, column, size):
        held.append(b)
        if sum(h.num_rows for h in held) >= rows or sum(h.nbytes for h in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_text(c: Column | str) -> Column:
    """crc32 of a value's decimal text, as the folds are defined."""
    return F.crc32(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def text_key() -> Column:
    """With doc_id, what a row of documents is known by: the hash of its text."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def drawn(hash_: Column) -> Column:
    """A hash as a draw from 0 to 2^62 - 1."""
    return hash_.bitwiseAND(F.lit((1 << 62) - 1))


def threshold(share: float) -> int:
    """Draws below it are that share of all, however small."""
    return (1 << 62) if share >= 1 else int(share * (1 << 62))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_table(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words (runs of anything but ASCII white space) of a batch of texts.

    Returns the distinct words, each word's number in them, and the offsets of
    each text's words.  Null counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:
        texts = part(texts, 0, len(texts))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    offsets = np.concatenate([[0], np.cumsum(real)])[ends]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), offsets


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``values`` between successive offsets."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged_take(lengths: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions, in a flat store, of the entries ``codes`` laid end to end."""
    n = lengths[codes]
    before = np.cumsum(n) - n
    return np.repeat(starts[codes] - before, n) + np.arange(int(n.sum()), dtype=np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n as unsigned 64-bit numbers, modulo 2**64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)
