"""Marker statistics that grow as blocks of calls arrive.

A file stream of Parquet blocks (i, j, d) feeds additive counters of each
marker, a folder a micro-batch: one that is replayed after a failure, or written
by two at once, counts once, and batches may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .batches import BatchSums

CALLS = "i int, j int, d tinyint"
STATE = "j int, n long, total long, het long, missing long"
#: Batches after which the counters are compacted.
EVERY = 100


class MarkerAccumulator(BatchSums):
    """Counters under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, STATE, ["j"])

    def batches(self) -> list[int]:
        """Ids of the committed batches, in order."""
        return sorted(map(int, self.applied()))

    def add(self, calls: DataFrame, batch: int) -> bool:
        """Add a batch; False if it was committed before."""
        added = self.add_batch(str(batch), calls.select("j", F.col("d").isNotNull().cast("long").alias("n"), F.coalesce(F.col("d").cast("long"), F.lit(0)).alias("total"), F.coalesce((F.col("d") == 1).cast("long"), F.lit(0)).alias("het"), F.col("d").isNull().cast("long").alias("missing")))
        if added and batch % EVERY == EVERY - 1:
            self.compact()
        return added

    def stats(self) -> DataFrame:
        """j, n_calls, n_missing, maf, heterozygosity so far."""
        p = F.try_divide(F.col("total").cast("double"), 2.0 * F.col("n"))
        return self.state().select("j", F.col("n").alias("n_calls"), F.col("missing").alias("n_missing"), F.least(p, 1 - p).alias("maf"), F.try_divide(F.col("het").cast("double"), F.col("n").cast("double")).alias("heterozygosity"))


def stream_marker_stats(spark: SparkSession, source: str, state: str, checkpoint: str) -> StreamingQuery:
    """Accumulate every block that is in ``source`` or arrives until stopped;
    here: all that is available, then stop."""
    acc = MarkerAccumulator(spark, state)
    blocks = spark.readStream.schema(CALLS).option("recursiveFileLookup", "true").parquet(source)
    return blocks.writeStream.foreachBatch(lambda df, n: acc.add(df, n) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
