"""Phenotypes: alignment with samples, id audits, trait summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.checks import hold


def first_match(left: DataFrame, right: DataFrame, key: str, order: str | list[str], fill: str | None = "NA") -> DataFrame:
    """All rows of ``left`` with the first row of ``right`` (by ``order``) of
    their key.  Columns of ``right`` become text, ``fill`` where unmatched."""
    order = [order] if isinstance(order, str) else order
    best = right.groupBy(key).agg(F.min_by(F.struct(*(c for c in right.columns if c != key)), F.struct(*order)).alias("r"))
    values = [c for c in right.columns if c != key and c not in left.columns]
    text = lambda c: F.col(f"r.`{c}`").cast("string")
    return left.join(best, key, "left").select(*(left[c] for c in left.columns), *((F.coalesce(text(c), F.lit(fill)) if fill is not None else text(c)).alias(c) for c in values))


def unmatched(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``left`` whose keys ``right`` lacks."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def id_audit(samples: DataFrame, phenotypes: DataFrame, *keys: str) -> DataFrame:
    """phenotype_only, genotype_only, both: distinct keys on each side."""
    a = samples.select(*keys).distinct().withColumn("g", F.lit(1))
    b = phenotypes.select(*keys).distinct().withColumn("p", F.lit(1))
    return a.join(b, list(keys), "full").agg(F.count_if(F.col("g").isNull()).alias("phenotype_only"), F.count_if(F.col("p").isNull()).alias("genotype_only"), F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("both"))


def same_set(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """left_only, right_only, equal: as sets, whatever order and repeats."""
    out = id_audit(a, b, *keys)
    return out.select(F.col("genotype_only").alias("left_only"), F.col("phenotype_only").alias("right_only"), ((F.col("genotype_only") == 0) & (F.col("phenotype_only") == 0)).alias("equal"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    hold(df.groupBy(*keys).agg(F.count("*").alias("n")), unique_keys=F.col("n") == 1)
    return df


def lenient_number(text: Column) -> Column:
    """A number, or null for anything that is not one."""
    return F.trim(text).try_cast("double")


def traits_long(wide: DataFrame, ids: list[str]) -> DataFrame:
    """ids, trait, value: every column that is no id, as text."""
    traits = [c for c in wide.columns if c not in ids]
    text = wide.select(*ids, *(F.col(f"`{c}`").cast("string").alias(c) for c in traits))
    return text.unpivot(ids, [F.col(f"`{c}`") for c in traits], "trait", "value")


def _statistics() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.count("x").alias("nonmissing"),
        (F.count("*") - F.count("x")).alias("missing"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("sd"),
        F.min("x").alias("minimum"),
        F.max("x").alias("maximum"),
    ]


def _numbers(long: DataFrame, *by: str) -> DataFrame:
    x = F.col("value")
    x = lenient_number(x) if dict(long.dtypes)["value"] == "string" else x.cast("double")
    return long.select(*by, x.alias("x"))


def trait_statistics(long: DataFrame, *by: str) -> DataFrame:
    """total, nonmissing, missing, mean, sd, minimum, maximum of ``value`` by
    group; sd is null for a single value."""
    return _numbers(long, *by).groupBy(*by).agg(*_statistics())


def statistics_by_population(long: DataFrame, population: str, label: str = "all") -> DataFrame:
    """Trait statistics of each population and, under ``label``, of all: one
    scan and one aggregate over both grouping sets."""
    sets = _numbers(long, "trait", population).groupingSets([["trait", population], ["trait"]], "trait", population)
    out = sets.agg(*_statistics(), F.grouping(population).alias("__all"))
    return out.withColumn(population, F.when(F.col("__all") == 1, F.lit(label)).otherwise(F.col(population))).drop("__all")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Add idx, 0-based, in a given order (small reference tables)."""
    return df.withColumn("idx", F.row_number().over(W.orderBy(*order)) - 1)
