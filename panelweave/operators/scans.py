"""Scans over one long order, with or without a key.

A window without a key is one task, and one with a hot key nearly so.  Here the
rows are dealt by ranges of the order, a summary of each range (a sum, a last
value) is carried over in one small pass of a row a range, and each range is
finished on its own.  The order must name each row (end it with an id): rows
that tie stay in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.shared import written

PART = "__part"


def in_parts(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with the number of each row's range; written, so that the numbers hold."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()), "ranges")


def _within(order: list[str], *by: str) -> W:
    return W.partitionBy(PART, *by).orderBy(*order)


def _carry(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Each row with its range's summary: at most one row a range is broadcast."""
    return rows.join(F.broadcast(summary), PART, "left")


def running_sums(df: DataFrame, order: list[str], parts: int | None = None, **values: Column) -> DataFrame:
    """Add the running sum of each value, its own row included; null counts as nothing."""
    rows = in_parts(df.withColumns({f"__v_{n}": v for n, v in values.items()}), order, parts)
    names = list(values)
    sums = rows.groupBy(PART).agg(*(F.sum(f"__v_{n}").alias(f"__s_{n}") for n in names))
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select(PART, *(F.sum(f"__s_{n}").over(before).alias(f"__c_{n}") for n in names))
    upto = _within(order).rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns({f"__r_{n}": F.sum(f"__v_{n}").over(upto) for n in names})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return _carry(local, carry).select(*df.columns, *((zero(f"__r_{n}") + zero(f"__c_{n}")).alias(n) for n in names))


def places(df: DataFrame, order: list[str], out: str = "place", parts: int | None = None) -> DataFrame:
    """Add the 1-based place of each row."""
    return running_sums(df, order, parts, **{out: F.lit(1).cast("long")})


def blocks(df: DataFrame, order: list[str], size: int, parts: int | None = None) -> DataFrame:
    """Add block: 1-based number of each run of ``size`` rows."""
    return places(df, order, "__place", parts).withColumn("block", F.ceil(F.col("__place") / size).cast("long")).drop("__place")


def previous(df: DataFrame, order: list[str], parts: int | None = None, **values: str) -> DataFrame:
    """Add, under each name, the column's value in the row before; null at the first."""
    return _previous(in_parts(df, order, parts), df.columns, order, values)


def _previous(rows: DataFrame, columns: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    last = rows.groupBy(PART).agg(F.max_by(F.struct(*(F.col(c).alias(n) for n, c in values.items())), F.struct(*order)).alias("__last"))
    carry = last.select(PART, F.lag("__last").over(W.orderBy(PART)).alias("__before"))
    here = _within(order)
    local = rows.withColumns({f"__p_{n}": F.lag(c).over(here) for n, c in values.items()} | {"__first": F.row_number().over(here) == 1})
    return _carry(local, carry).select(*columns, *(F.when(F.col("__first"), F.col(f"__before.{n}")).otherwise(F.col(f"__p_{n}")).alias(n) for n in values))


def steps(df: DataFrame, order: list[str], value: str, parts: int | None = None) -> DataFrame:
    """Add step: the change of ``value`` from the row before, 0 at the first."""
    return previous(df, order, parts, __was=value).withColumn("step", F.coalesce(F.col(value) - F.col("__was"), F.lit(0))).drop("__was")


def runs(df: DataFrame, order: list[str], value: str, parts: int | None = None) -> DataFrame:
    """value, run, start, size of each maximal run of equal values (null is one)."""
    rows = previous(df.select(value, *(c for c in order if c != value)), order, parts, __was=value)
    numbered = places(rows, order, "__place", parts)
    # the first row starts a run whatever its value
    new = (F.col("__place") == 1) | ~F.col(value).eqNullSafe(F.col("__was"))
    out = running_sums(numbered, order, parts, run=new.cast("long"))
    return out.groupBy("run").agg(F.first(value).alias(value), F.min("__place").alias("start"), F.count("*").alias("size")).select(value, "run", "start", "size")


def last_known(df: DataFrame, order: list[str], value: str, out: str, by: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Add ``out``: the last value that is not null, up to and with each row; of
    rows with the same ``by``, the columns that ``order`` starts with."""
    by = by or []
    rows = in_parts(df, order, parts)
    key, at, known = F.struct(F.lit(0).alias("__k"), *by), F.struct(*order), F.col(value).isNotNull()
    ends = rows.groupBy(PART).agg(
        F.min_by(key, at).alias("first"),
        F.max_by(key, at).alias("last"),
        F.max_by(F.struct(key.alias("key"), F.col(value).alias("v")), F.when(known, at)).alias("told"),
    )
    # of each range: what it asks for (before it), then what it tells of its last key
    told = ends.select(PART, F.lit(1).alias("kind"), F.col("last").alias("key"), F.when(F.col("told.key") == F.col("last"), F.col("told.v")).alias("v"))
    asked = ends.select(PART, F.lit(0).alias("kind"), F.col("first").alias("key"), F.lit(None).cast(rows.schema[value].dataType).alias("v"))
    so_far = W.partitionBy("key").orderBy(PART, "kind").rowsBetween(W.unboundedPreceding, 0)
    carry = told.unionByName(asked).withColumn("v", F.last("v", ignorenulls=True).over(so_far)).where("kind = 0").select(PART, F.col("key").alias("__key"), F.col("v").alias("__carry"))
    local = rows.withColumn("__local", F.last(value, ignorenulls=True).over(_within(order, *by).rowsBetween(W.unboundedPreceding, 0)))
    carried = F.when(key.eqNullSafe(F.col("__key")), F.col("__carry"))
    return _carry(local, carry).select(*df.columns, F.coalesce("__local", carried).alias(out))


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, values: list[str], row: str, out: str = "match", parts: int | None = None) -> DataFrame:
    """Add ``out`` to ``left``: (at, values) of the last row of ``right`` with the
    same ``by`` whose ``at`` is not after its own; null if there is none.

    Both sides go through one sorted stream, so neither the length of a history
    nor the width of a gap costs anything.  ``row`` names the rows of ``left``;
    rows with a null key or time match nothing.  Of rows of ``right`` that tie
    the one with the largest values holds.
    """
    told = right.select(*by, at, F.lit(0).alias("__kind"), F.struct(*values).alias("__tie"), F.lit(None).cast(left.schema[row].dataType).alias("__row"), F.struct(at, *values).alias("__told"))
    told = told.where(" and ".join(f"`{c}` is not null" for c in [*by, at]))
    there = F.lit(None).cast(told.schema["__tie"].dataType)
    asks = left.select(*by, F.col(at).cast(told.schema[at].dataType).alias(at), F.lit(1).alias("__kind"), there.alias("__tie"), F.col(row).alias("__row"), F.lit(None).cast(told.schema["__told"].dataType).alias("__told"), F.struct(*left.columns).alias("__left"))
    told = told.withColumn("__left", F.lit(None).cast(asks.schema["__left"].dataType))
    both = last_known(told.unionByName(asks), [*by, at, "__kind", "__tie", "__row"], "__told", "__match", by, parts)
    good = F.lit(True)
    for c in [*by, at]:
        good &= F.col(c).isNotNull()
    return both.where("__kind = 1").select(F.when(good, F.col("__match")).alias(out), "__left").select("__left.*", out)
