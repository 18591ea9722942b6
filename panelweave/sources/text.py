"""Text sources.  Every schema is explicit; nothing is inferred."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import require
from ..functions.checks import require_columns
from ..functions.shared import open_input


def with_line_number(spark: SparkSession, path: str) -> DataFrame:
    """line (0-based, over all files by name) and value of text files.

    Lines are numbered within each split and splits by their place in the
    file; what is broadcast is a row a split."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("o"), F.monotonically_increasing_id().alias("m"))
    per = rows.groupBy("f", "o").agg(F.count("*").alias("n"), F.min("m").alias("m0"))
    before = F.coalesce(F.sum("n").over(W.orderBy("f", "o").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(per.withColumn("start", before)), ["f", "o"]).select((F.col("start") + F.col("m") - F.col("m0")).alias("line"), "value")


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True, na: str | None = None, quote: str | None = '"') -> DataFrame:
    """A delimited file with a fixed schema; ``na`` is read as null if given,
    otherwise such text stays text.  Comments are never skipped."""
    r = spark.read.schema(schema).option("sep", sep).option("header", header).option("enforceSchema", "false" if header else "true").option("mode", "FAILFAST").option("quote", quote or "")
    return (r.option("nullValue", na) if na is not None else r).csv(path)


def read_text_table(spark: SparkSession, path: str, sep: str = "\t", na: str | None = None, quote: str | None = None) -> DataFrame:
    """All columns of a table with a header as text, byte for byte."""
    with_header = spark.read.option("sep", sep).option("header", "true").option("inferSchema", "false").option("quote", quote or "")
    return (with_header.option("nullValue", na) if na is not None else with_header).csv(path)


def read_genetic_map(spark: SparkSession, path: str) -> DataFrame:
    """bp, cm from columns 2 and 4 of a (gzipped) map; the header goes."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).select(f[1].try_cast("double").alias("bp"), f[3].try_cast("double").alias("cm")).where("bp is not null and cm is not null")


def read_design(spark: SparkSession, path: str) -> DataFrame:
    """The marker design: j, CHROM, ID, POS, REF, ALT in file order."""
    lines = with_line_number(spark, path)
    names = [c.strip('"') for c in lines.where("line = 0").first()["value"].split(",")]
    f = F.split("value", ",")
    df = lines.where("line > 0").select((F.col("line") - 1).cast("int").alias("j"), *(F.trim(F.regexp_replace(f[k], '^"|"$', "")).alias(n) for k, n in enumerate(names)))
    require_columns(df, ["CHROM", "ID", "POS", "REF", "ALT"])
    return df.withColumn("POS", F.col("POS").try_cast("long"))


def parse_gt(gt: Column) -> Column:
    """Phased genotype text to an array of two alleles (null where missing)."""
    a = F.split(F.split(gt, ":")[0], r"\|")
    return F.transform(a, lambda x: x.try_cast("tinyint"))


def read_vcf(spark: SparkSession, path: str, expected_samples: list[str] | None = None, lines: DataFrame | None = None, where: Column | str = "true") -> tuple[DataFrame, DataFrame, list[str]]:
    """Phased VCF (plain or gzip): markers (j, chr, pos, id, ref, alt), alleles
    (hap, j, allele) with haplotypes 2i and 2i + 1 of sample i, sample names.

    ``lines`` (line, chr, pos, value) may come from ``bgzip.read_bgzip``; then
    ``where``, on chr and pos, reads only the members of the file that it needs."""
    blocks = lines is not None
    lines = lines if blocks else with_line_number(spark, path)
    head = (lines.where("chr is null") if blocks else lines).where(F.col("value").startswith("#CHROM")).select("value", "line").first()
    require(head is not None, "no #CHROM line")
    names = head["value"].split("\t")[9:]
    require(expected_samples is None or names == expected_samples, "the samples differ from the expected ones")
    f = F.split("value", "\t")
    body = (lines.where(where) if blocks else lines).where(~F.col("value").startswith("#") & (F.col("value") != "")).select((F.col("line") - head["line"] - 1).cast("int").alias("j"), f.alias("f"))
    markers = body.select("j", F.col("f")[0].alias("chr"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[2].alias("id"), F.col("f")[3].alias("ref"), F.col("f")[4].alias("alt"))
    cells = body.select("j", F.posexplode(F.slice("f", 10, max(1, len(names)))).alias("i", "gt"))
    alleles = cells.select("j", "i", F.posexplode(parse_gt(F.col("gt"))).alias("s", "allele")).select((2 * F.col("i") + F.col("s")).alias("hap"), "j", "allele")
    return markers, alleles, names


def read_ped(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """samples (i and six fields) and allele pairs (i, j, a1, a2); 0 is missing."""
    f = F.split(F.trim("value"), r"\s+")
    rows = with_line_number(spark, path).where(F.trim("value") != "").select(F.col("line").cast("int").alias("i"), f.alias("f"))
    samples = rows.select("i", *(F.col("f")[k].alias(c) for k, c in enumerate(("fid", "iid", "pat", "mat", "sex", "pheno"))))
    pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size("f") - 6) / 2).cast("int") - 1), lambda k: F.struct(F.element_at("f", 7 + 2 * k).try_cast("tinyint").alias("a1"), F.element_at("f", 8 + 2 * k).try_cast("tinyint").alias("a2")))
    cells = rows.where(F.size("f") > 7).select("i", F.posexplode(pairs).alias("j", "p")).select("i", "j", "p.a1", "p.a2")
    return samples, cells


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """j, chr, id, cm, pos of a MAP file."""
    f = F.split(F.trim("value"), r"\s+")
    return with_line_number(spark, path).where(F.trim("value") != "").select(F.col("line").cast("int").alias("j"), f[0].alias("chr"), f[1].alias("id"), f[2].try_cast("double").alias("cm"), f[3].try_cast("long").alias("pos"))


def read_ped_head(spark: SparkSession, path: str) -> DataFrame:
    """The first six fields of each line only."""
    f = F.slice(F.split(F.trim("value"), r"\s+", 7), 1, 6)
    return with_line_number(spark, path).select(F.col("line").cast("int").alias("i"), *(f[k].alias(c) for k, c in enumerate(("fid", "iid", "pat", "mat", "sex", "pheno"))))


def read_missingness(spark: SparkSession, path: str) -> DataFrame:
    """iid, missing, observed of a sample report, under either set of names."""
    lines = with_line_number(spark, path)
    names = lines.where("line = 0").first()["value"].lstrip("#").split()
    f = F.split(F.trim("value"), r"\s+")
    df = lines.where((F.col("line") > 0) & (F.trim("value") != "")).select(*(f[k].alias(n) for k, n in enumerate(names)))
    pick = lambda a, b: a if a in names else b
    missing, observed = pick("MISSING_CT", "N_MISS"), pick("OBS_CT", "N_GENO")
    require_columns(df, ["IID", missing, observed])
    return df.select(F.col("IID").alias("iid"), F.col(missing).try_cast("long").alias("missing"), F.col(observed).try_cast("long").alias("observed"))


def read_triangle(spark: SparkSession, path: str, n: int, range_values: int = 1 << 24) -> DataFrame:
    """i1 > i2 and value of a float32 lower triangle without diagonal, by ranges of its values."""
    total = n * (n - 1) // 2
    with open_input(path) as file:
        require(file.size() == 4 * total, "the triangle has another size")

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            with open_input(path) as file:
                for part in b.column(0).to_pylist():
                    low, high = part * range_values, min((part + 1) * range_values, total)
                    for at in range(low, high, 1 << 18):
                        file.seek(4 * at)
                        x = np.frombuffer(file.read(4 * min(1 << 18, high - at)), "<f4")
                        k = np.arange(at, at + len(x))
                        # the row that value k is in: r (r - 1) / 2 <= k
                        r = ((1 + np.sqrt(8.0 * k + 1)) / 2).astype(np.int64)
                        r += (r * (r + 1) // 2 <= k).astype(np.int64) - (r * (r - 1) // 2 > k)
                        yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array((k - r * (r - 1) // 2).astype(np.int32)), pa.array(x.astype(float))], names=["i1", "i2", "value"])

    ranges = spark.range(0, -(-total // range_values), 1, max(1, -(-total // range_values)))
    return ranges.mapInArrow(run, "i1 int, i2 int, value double")


def parse_report(text: Column) -> Column:
    """``k=v;k=v`` to a map; padding goes."""
    m = F.str_to_map(text, F.lit(";"), F.lit("="))
    return F.map_from_arrays(F.transform(F.map_keys(m), lambda k: F.trim(k)), F.transform(F.map_values(m), lambda v: F.trim(v)))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """line, key, value of a report; a line without = has no value."""
    rows = with_line_number(spark, path)
    at = F.instr("value", "=")
    return rows.select("line", F.trim(F.when(at > 0, F.expr("substring(value, 1, instr(value, '=') - 1)")).otherwise(F.col("value"))).alias("key"), F.trim(F.when(at > 0, F.expr("substring(value, instr(value, '=') + 1)"))).alias("value"))
