"""Exact dedup by a tree merge of sorted digest runs.

Each input partition's distinct digests are a run.  A run is cut into slices of
the digest space, so that the upper levels of the tree keep as many tasks as
the lower ones.  In each round ``fan`` neighbouring runs meet (the binomial
exchange, several rounds at a time): an exchange brings their entries together,
the sort merges them, and one pass folds neighbours that agree.  Entries are
sorted by a 64-bit hash; only those whose SHA-256 agrees as well are folded, at
every level, so a hash collision never joins two texts.  A text with a third of
all rows is one entry in each run, from the first level on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, remove, text_key, tuned, written

ENTRY = "run int, slice int, h long, sha binary, keep_id long, n long"


def _merge(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """Fold neighbouring entries that agree; the last one waits for the next batch."""
    fold = np.maximum if largest else np.minimum
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        sha = t.column("sha").combine_chunks()
        words = np.frombuffer(sha.buffers()[2], "<u8", 4 * len(sha), 32 * sha.offset).reshape(-1, 4)
        key = np.column_stack([*(t.column(c).to_numpy().astype(np.int64) for c in ("run", "slice", "h")), words.view(np.int64)])
        starts = np.concatenate([[0], 1 + np.flatnonzero((key[1:] != key[:-1]).any(axis=1))])
        # a null id loses against any other
        ids = t.column("keep_id").combine_chunks()
        worst = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max
        best = fold.reduceat(ids.fill_null(worst).to_numpy(), starts)
        some = np.maximum.reduceat(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int8), starts) > 0
        out = t.take(pa.array(starts))
        out = out.set_column(4, "keep_id", pa.array(best, mask=~some)).set_column(5, "n", pa.array(np.add.reduceat(t.column("n").to_numpy(), starts)))
        held = out.slice(out.num_rows - 1).combine_chunks()
        yield from out.slice(0, out.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def merge_runs(runs: DataFrame, n_runs: int, fan: int = 8, largest: bool = False) -> DataFrame:
    """Entries of ``n_runs`` runs to those of one run, ``fan`` runs at a time."""
    while n_runs > 1:
        runs = (
            runs.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
            .repartition("run", "slice")
            .sortWithinPartitions("run", "slice", "h", "sha")
            .mapInArrow(lambda batches: _merge(batches, largest), ENTRY)
        )
        n_runs = -(-n_runs // fan)
    return runs


def exact_groups(docs: DataFrame, keep: str = "min", fan: int = 8, slices: int | None = None, keyed: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``.

    Texts are equal when identical after lower-casing A-Z only; null counts as
    the empty text.  ``keep`` is ``min`` or ``max``: the doc_id of the row that
    stays.  A null doc_id is kept only where the group has no other.  Rows that
    repeat both doc_id and text count each in group_size and share the verdict.
    An empty table gives an empty result.  Other columns are ignored.  ``keyed``
    adds h, the hash of the text as it stands, which tells rows of one doc_id
    apart.
    """
    spark = tuned(docs.sparkSession)
    largest = keep == "max"
    if slices is None:
        slices = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key, own = (["text_key"], [text_key().alias("text_key")]) if keyed else ([], [])
    norm = ascii_lower(F.coalesce("text", F.lit("")))
    digests = written(
        docs.select(F.col("doc_id").cast("long"), norm.alias("t"), F.spark_partition_id().alias("run"), *own).select("doc_id", "run", *key, F.xxhash64("t").alias("h"), F.unhex(F.sha2("t", 256)).alias("sha")),
        "digests",
    )
    n_runs = 1 + (digests.agg(F.max("run")).first()[0] or 0)
    choose = F.max if largest else F.min
    leaves = written(digests.groupBy("run", F.pmod(F.shiftrightunsigned("h", 40), F.lit(slices)).cast("int").alias("slice"), "h", "sha").agg(choose("doc_id").alias("keep_id"), F.count("*").alias("n")), "runs")
    # only groups of two or more need an answer; each run gets its own, so the
    # rows of one text are spread over as many tasks as there are runs
    groups = merge_runs(leaves, n_runs, fan, largest).where("n > 1").select("h", "sha", F.col("keep_id").alias("best"), F.col("n").alias("group_size"))
    answers = written(leaves.select("run", "h", "sha").join(groups, ["h", "sha"]), "answers")
    remove(spark, leaves)
    return digests.join(answers, ["run", "h", "sha"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("best")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("best"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *(F.col(c).alias("h") for c in key),
    )
