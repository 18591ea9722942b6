"""Additive tables, kept as one folder a batch.

A batch is summed by its keys and written to a folder of its own; Spark's own
success mark commits it.  The state is the sum over the committed batches, so
writers of different batches do not meet: no order is needed, none has to see
the state of another, and a writer that dies leaves a folder without a mark that
nobody reads.  A batch that was committed before changes nothing.  ``compact``
writes the sums of all batches so far with their names; as that is true whatever
happens beside it, any complete one may stand for its batches.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import require


class BatchSums:
    """Sums of one folder: ``batches/<name>/<attempt>`` and ``compacted/<id>``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        self.values = [c.split()[0] for c in schema.split(", ") if c.split()[0] not in keys]
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._at = lambda name: hadoop.Path(f"{path}/{name}")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._at(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]

    def _attempts(self, name: str) -> list[tuple[int, str]]:
        """Committed attempts of a batch, first to last."""
        out = []
        for attempt in self._names(f"batches/{name}"):
            mark = self._at(f"batches/{name}/{attempt}/_SUCCESS")
            if self._fs.exists(mark):
                out.append((self._fs.getFileStatus(mark).getModificationTime(), attempt))
        return sorted(out)

    def _committed(self) -> dict[str, tuple[int, str]]:
        """The attempt that counts, of each batch that has one: the first."""
        first = {name: self._attempts(name) for name in self._names("batches")}
        return {name: a[0] for name, a in first.items() if a}

    def applied(self) -> list[str]:
        """All committed batches, first to last."""
        return [unquote(n) for n, _ in sorted(self._committed().items(), key=lambda x: x[1])]

    def _summed(self, *parts: DataFrame) -> DataFrame:
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        return every.groupBy(*self.keys).agg(*(F.sum(c).alias(c) for c in self.values))

    def add_batch(self, batch: str, rows: DataFrame) -> bool:
        """Add keys and values of a batch; False if it was added before.  Of two
        writers of one batch, who bring the same rows, one commits."""
        name = quote(batch, safe="")
        require(0 < len(name) <= 200, "a batch has a name of at most 200 letters")
        if self._attempts(name):
            return False
        attempt = uuid.uuid4().hex
        self._summed(rows.select(*self.keys, *self.values)).write.parquet(f"{self.path}/batches/{name}/{attempt}")
        if self._attempts(name)[0][1] == attempt:
            return True
        self._fs.delete(self._at(f"batches/{name}/{attempt}"), True)
        return False

    def _compacted(self) -> tuple[str | None, set[str]]:
        """The compacted sums that cover most batches, and those batches."""
        best, names = None, set()
        for one in self._names("compacted"):
            if self._fs.exists(self._at(f"compacted/{one}/names/_SUCCESS")):
                has = {r[0] for r in self.spark.read.schema("name string").parquet(f"{self.path}/compacted/{one}/names").collect()}
                if len(has) > len(names):
                    best, names = one, has
        return best, names

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def state(self) -> DataFrame:
        """The sums over all committed batches."""
        best, names = self._compacted()
        paths = [f"{self.path}/batches/{n}/{a}" for n, (_, a) in sorted(self._committed().items()) if n not in names]
        parts = [self._read(*paths)] if paths else []
        parts += [self._read(f"{self.path}/compacted/{best}/sums")] if best else []
        return self._summed(*parts) if parts else self.spark.createDataFrame([], self.schema)

    def compact(self) -> None:
        """Write the sums so far under one roof; older ones stay as they are."""
        committed = self._committed()
        if not committed:
            return
        one = f"{self.path}/compacted/{uuid.uuid4().hex}"
        self._summed(self._read(*(f"{self.path}/batches/{n}/{a}" for n, (_, a) in committed.items()))).write.parquet(f"{one}/sums")
        self.spark.createDataFrame([(n,) for n in committed], "name string").coalesce(1).write.parquet(f"{one}/names")
