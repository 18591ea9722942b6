"""Token counts as a delta-maintained rollup.

A batch of signed deltas (an insert adds a document, a delete takes one away, a
revision takes its old count away and adds the new one) is summed by source,
language and tokenizer version and written to a folder of its own; Spark's own
success mark commits it.  Totals are the sum over the committed batches, so
writers of different batches do not meet: none has to see the totals of another,
no order is needed, and a writer that dies leaves a folder without a mark that
nobody reads.  A batch that was committed before changes nothing.  ``compact``
writes the totals of all batches so far with their names; as that is true
whatever happens beside it, any complete one may stand for its batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.batches import BatchSums
from .common import scratch

KEY = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


class TokenRollup(BatchSums):
    """Additive totals of one folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        super().__init__(spark, path or scratch(spark, "token-rollup"), TOTALS, KEY)

    def version(self) -> int:
        """Number of committed batches."""
        return len(self._committed())

    def apply(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch (columns of ``DELTA``); False if it was applied before.

        Null keys are groups like any other; null amounts count as nothing; an
        empty batch is a batch.  Other columns are not read.
        """
        amount = lambda c: F.coalesce(c, F.lit(0)).cast("long")
        return self.add_batch(batch, deltas.select(*KEY, amount("docs").alias("n_docs"), amount("tokens").alias("n_tokens")))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups without documents are gone."""
        return self.state().where("n_docs <> 0 or n_tokens <> 0")


def inserts(counts: DataFrame) -> DataFrame:
    """Deltas that add the documents of (source, lang, tokenizer, n)."""
    return counts.select(*KEY, F.lit(1).cast("long").alias("docs"), F.col("n").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Deltas that take those documents away."""
    return counts.select(*KEY, F.lit(-1).cast("long").alias("docs"), (-F.col("n")).alias("tokens"))


def revisions(counts: DataFrame) -> DataFrame:
    """Deltas that replace ``old`` by ``new`` in (source, lang, tokenizer, old, new)."""
    return counts.select(*KEY, F.lit(0).cast("long").alias("docs"), (F.col("new") - F.col("old")).alias("tokens"))
