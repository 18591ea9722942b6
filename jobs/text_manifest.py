"""A manifest of text records that grows with its table.

    python -m jobs.text_manifest TEXTS OUT CHECKPOINT [--config FILE]

Streams the Parquet files of a table that no run has taken before, and writes

* ``OUT/entries``, by ``batch`` and ``part``: for each record its bytes, lines,
  SHA-256, the SHA-256 that it would have with CRLF line ends, and whether it is
  new, same, crlf (the same but for line ends) or changed against the last entry
  of its key in an earlier batch,
* ``OUT/totals``, by ``batch``: records, bytes and an additive fingerprint by
  part and status.

The stream's checkpoint knows the files taken.  A batch writes its own
partitions and overwrites them when it is run again, so a run that dies halfway
is mended by the next one, and a run without new files changes nothing.
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("text_manifest")

ENTRY = "key long, bytes long, lines long, sha256 string, crlf_sha256 string, status string, oversized boolean, batch long, part string"
TOTAL = "part string, status string, records long, bytes long, fingerprint long, batch long"


def digests(texts: DataFrame, s: dict) -> DataFrame:
    """key, part and digests of each record; a null text is an empty one."""
    text = F.coalesce(F.col(s["text"]), F.lit(""))
    unix = F.regexp_replace(text, "\r\n", "\n")
    return texts.select(
        F.col(s["key"]).cast("long").alias("key"),
        F.octet_length(text).cast("long").alias("bytes"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("long").alias("lines"),
        F.sha2(text, 256).alias("sha256"),
        F.sha2(F.regexp_replace(unix, "\n", "\r\n"), 256).alias("crlf_sha256"),
        F.coalesce(F.col(s["part"]).cast("string"), F.lit("none")).alias("part"),
    )


def judged(new: DataFrame, before: DataFrame, limit: int) -> DataFrame:
    """Add status and oversized; ``before`` are the entries of earlier batches.

    The last entry of a key is the one of the latest batch, of several in that
    the one with the largest digest.  Null keys are always new."""
    last = before.groupBy("key").agg(F.max(F.struct("batch", "sha256", "crlf_sha256")).alias("last"))
    # of the keys that arrive: what was known is read, what is not asked for is not shuffled on
    both = new.join(last, "key", "left")
    status = F.when(F.col("last").isNull(), "new").when(F.col("last.sha256") == F.col("sha256"), "same").when(F.col("last.crlf_sha256") == F.col("crlf_sha256"), "crlf").otherwise("changed")
    return both.withColumn("status", status).withColumn("oversized", F.col("bytes") >= limit).drop("last")


def fingerprint() -> Column:
    """A sum over records in which order and batches do not matter (of 40-bit hashes)."""
    return F.sum(F.shiftrightunsigned(F.xxhash64("key", "sha256"), 24))


def replace(df: DataFrame, path: str, *by: str) -> None:
    """Write the partitions that ``df`` has rows of in place of those there."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def entries(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(f"{out}/entries")


def totals(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(TOTAL).parquet(f"{out}/totals")


def add_batch(texts: DataFrame, batch: int, out: str, s: dict) -> None:
    """Entries and totals of one batch, whatever an earlier try of it has left."""
    spark = texts.sparkSession
    now = F.lit(batch).cast("long")
    before = entries(spark, out).where(F.col("batch") < batch) if batch else spark.createDataFrame([], ENTRY)
    rows = judged(digests(texts, s), before, s["max_bytes"]).withColumn("batch", now)
    replace(rows, f"{out}/entries", "batch", "part")
    sums = entries(spark, out).where(F.col("batch") == batch).groupBy("part", "status").agg(F.count("*").alias("records"), F.sum("bytes").alias("bytes"), fingerprint().alias("fingerprint"))
    replace(sums.withColumn("batch", now), f"{out}/totals", "batch")
    told = totals(spark, out).where(F.col("batch") == batch).groupBy("status").agg(F.sum("records"))
    log.info("batch %s wrote %s/entries: %s", batch, out, ", ".join(f"{n} {k}" for k, n in told.collect()) or "0 records")


def run(spark: SparkSession, texts: str, out: str, checkpoint: str, settings: dict) -> None:
    """The job: take the files of ``texts`` that ``checkpoint`` does not know.

    A file is taken once, so rows are appended as new files; a table without
    rows gives no entries.  Other columns are not read."""
    s = settings
    columns = list(dict.fromkeys([s["key"], s["text"], s["part"]]))
    schema = spark.read.parquet(texts).select(columns).schema
    stream = spark.readStream.schema(schema)
    if s["files_per_batch"]:
        stream = stream.option("maxFilesPerTrigger", s["files_per_batch"])
    # a pattern with one choice: a table may be one file as well as a folder
    folder, _, name = texts.rstrip("/").rpartition("/")
    query = stream.parquet(f"{folder}/{{{name}}}").writeStream.foreachBatch(lambda df, n: add_batch(df, n, out, s)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    progress = query.recentProgress
    log.info("read %s: %s rows in %s batches", texts, sum(p.numInputRows for p in progress), sum(p.numInputRows > 0 for p in progress))


def main(argv: list[str] | None = None) -> int:
    from jobs import common

    return common.main("text_manifest", {"texts": "Parquet table of texts", "out": "folder of entries and totals", "checkpoint": "folder of the stream's checkpoint"}, run, argv)


if __name__ == "__main__":
    sys.exit(main())
