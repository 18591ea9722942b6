"""Commands over filesets: validate, convert, simulate, manifest, installed.

    python -m panelweave.cli validate --prefix P
    python -m panelweave.cli convert --ped X.ped --map X.map --out P
    python -m panelweave.cli simulate --vcf X.vcf.gz --map M.gz --n 100 --rate 20 --seed 1 --block-size 2500 --work DIR --out P [--resume | --force]
    python -m panelweave.cli manifest --dir D --out FILE
    python -m panelweave.cli installed --prefix P --checksums FILE --design FILE --out DIR [--gates FILE]

Of a repeated option the last value holds.
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import PanelError, require
from .operators import gates, genotype, integrity, mosaic, ordered
from .sources import plink, sinks, text


def validate(spark: SparkSession, prefix: str) -> DataFrame:
    """Structure, two decoders on every call, hard calls: a row of figures, status PASS."""
    fam, bim = plink.read_fam(spark, f"{prefix}.fam").cache(), plink.read_bim(spark, f"{prefix}.bim").cache()
    with open(f"{prefix}.bed", "rb") as file:
        head = file.read(3)
    integrity.check_fileset(fam, bim, os.path.getsize(f"{prefix}.bed"), head)
    calls = plink.read_calls(spark, prefix)
    m, n = bim.count(), fam.count()
    require(plink.decoders_differ(spark, f"{prefix}.bed", n).first()[0] == 0, "the decoders differ")
    return genotype.panel_stats(calls).select(F.lit("PASS").alias("status"), F.lit(n).alias("samples"), F.lit(m).alias("markers"), "heterozygosity", "missingness")


def convert(spark: SparkSession, ped: str, map_: str, out: str) -> None:
    """PED and MAP to a fileset; the counted allele is code 2."""
    samples, cells = text.read_ped(spark, ped)
    require(samples.count() > 0, "no samples")
    d = F.when((F.col("a1") == 0) | (F.col("a2") == 0), None).otherwise(F.col("a1") + F.col("a2") - 2)
    markers = text.read_map(spark, map_).withColumns({"a1": F.lit("2"), "a2": F.lit("1")})
    plink.write_fileset(out, cells.select("i", "j", d.cast("tinyint").alias("d")), markers, samples)
    back = plink.read_calls(spark, out)
    require(integrity.calls_differ(cells.select("i", "j", d.cast("tinyint").alias("d")), back).first()[0] == 0, "the fileset differs from its source")


def simulate(spark: SparkSession, vcf: str, map_: str, n: int, rate: float, seed: int, block_size: int, work: str, out: str, resume: bool = False, force: bool = False) -> None:
    """n diploid mosaics of a phased reference, block by block, then a fileset."""
    require(not (resume and force), "--resume and --force exclude each other")
    markers, alleles, names = text.read_vcf(spark, vcf)
    knots = text.read_genetic_map(spark, map_).select(F.col("bp").alias("x"), F.col("cm").alias("y"))
    placed = ordered.interpolate(markers.withColumn("x", F.col("pos").cast("double")), knots, [], out="cm").drop("x")
    placed = ordered.blocks(placed.withColumn("morgan", F.col("cm") / 100), [], ["j"], block_size).cache()
    mosaic.check_inputs(alleles, placed, n, rate)
    haps = spark.range(2 * n).select(F.col("id").cast("int").alias("hap"))
    draw = (2 * len(names), rate, seed)
    steps = mosaic.map_steps(placed.select("j", "morgan", "block"))
    donors = alleles.withColumnRenamed("hap", "donor")
    expected = {"seed": seed, "rate": rate, "n": n, "samples": len(names), "vcf_sha256": sinks.sha256_file(vcf), "block_size": block_size}
    require(resume or force or not os.path.exists(work), f"{work} is already there")
    if force:
        sinks.safe_remove(work, os.path.dirname(os.path.abspath(work)))
    blocks = sinks.Blocks(spark, work)
    last = placed.agg(F.max("block")).first()[0]
    mosaic.block_offsets(haps, placed.select("j", "morgan", "block"), *draw).write.mode("overwrite").parquet(f"{work}/offsets")
    offsets = spark.read.parquet(f"{work}/offsets")

    def make(b: int) -> DataFrame:
        own = F.col("block") == b
        return mosaic.diploid(mosaic.haplotype_alleles(mosaic.block_paths(haps, steps.where(own), offsets.where(own), *draw), donors))

    blocks.build(range(1, last + 1), make, expected)
    calls = blocks.assemble(range(1, last + 1), expected)
    samples = plink.default_fam(spark.range(n).select(F.col("id").cast("int").alias("i"), F.format_string("MOSAIC_%05d", F.col("id") + 1).alias("iid")))
    bim = placed.select("j", "chr", "id", "cm", "pos", F.col("alt").alias("a1"), F.col("ref").alias("a2"))
    plink.write_fileset(f"{work}/panel", calls, bim, samples)
    sinks.install({f"{work}/panel.{x}": f"{out}.{x}" for x in ("bed", "bim", "fam")}, force=force)


def manifest(spark: SparkSession, folder: str, out: str) -> None:
    base = os.path.abspath(folder).rstrip("/") + "/"
    below = F.expr(f"substring(path, {len(base) + 1})")
    files = integrity.file_manifest(spark, folder).select("path", F.concat_ws("  ", "sha256", F.col("bytes").cast("string"), below).alias("line"))
    sinks.write_ordered(files, out, "path", "line")


def installed(spark: SparkSession, prefix: str, checksums: str, design: str, out: str, accepted: str | None = None) -> DataFrame:
    """Check an installed fileset against what was recorded of it.

    ``checksums``: CSV with path (its last part counts), bytes and sha256;
    ``design``: the marker design; ``accepted``: CSV with gate and pass of its
    build.  Each check is a gate; all of them, their details and what they ran
    on go to ``out`` as CSV before a failed one stops the command.
    """
    began = time.time()
    name = F.substring_index("path", "/", -1)
    files = spark.createDataFrame([(f"{prefix}.{x}",) for x in ("bed", "bim", "fam")], "path string")
    found = integrity.digests(files, crlf=True).withColumn("path", name)
    recorded = text.read_text_table(spark, checksums, ",", quote='"').select(name.alias("path"), F.col("bytes").cast("long").alias("recorded_bytes"), "sha256")
    recorded = recorded.join(found.select("path"), "path", "left_semi")
    status = integrity.compare_manifest(found, recorded).join(found.select("path", "bytes"), "path").join(recorded.select("path", "recorded_bytes"), "path", "left")
    files = status.select(F.concat(F.lit("file_"), F.substring_index("path", ".", -1)).alias("gate"), ((F.col("status") == "match") & F.coalesce(F.col("bytes") == F.col("recorded_bytes"), F.lit(False))).alias("pass"), "status")
    own = plink.read_bim(spark, f"{prefix}.bim").select("j", "chr", "id", "pos")
    wanted = text.read_design(spark, design).select("j", F.col("CHROM").alias("chr"), F.col("ID").alias("id"), F.col("POS").alias("pos"))
    order = integrity.ordered_identity(own, wanted, "j").select(F.lit("design_identity").alias("gate"), F.col("identical").alias("pass"), F.concat(F.col("differences").cast("string"), F.lit(" differences")).alias("status"))
    rows = files.unionByName(order)
    try:
        checked = validate(spark, prefix).select(F.lit("structure").alias("gate"), F.lit(True).alias("pass"), F.format_string("%d samples, %d markers", "samples", "markers").alias("status"))
    except PanelError as e:
        checked = spark.createDataFrame([("structure", False, str(e))], "gate string, pass boolean, status string")
    rows = rows.unionByName(checked)
    if accepted:
        gates_csv = text.read_text_table(spark, accepted, ",", quote='"')
        rows = rows.unionByName(gates_csv.select(F.concat(F.lit("accepted_"), "gate").alias("gate"), F.coalesce(F.lower("pass") == "true", F.lit(False)).alias("pass"), F.col("pass").alias("status")))
    rows = rows.persist()

    def evidence(found: DataFrame) -> None:
        sinks.write_csv(found.orderBy("gate"), f"{out}/checks")
        sinks.write_csv(sinks.session_record(spark, began), f"{out}/record")

    gates.stop_unless_passed(rows, evidence)
    return rows


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="panelweave", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    c = commands.add_parser("validate")
    c.add_argument("--prefix", required=True)
    c = commands.add_parser("convert")
    for o in ("--ped", "--map", "--out"):
        c.add_argument(o, required=True)
    c = commands.add_parser("simulate")
    for o in ("--vcf", "--map", "--work", "--out"):
        c.add_argument(o, required=True)
    c.add_argument("--n", type=int, required=True)
    c.add_argument("--rate", type=float, required=True)
    c.add_argument("--seed", type=int, default=1)
    c.add_argument("--block-size", type=int, default=2500)
    c.add_argument("--resume", action="store_true")
    c.add_argument("--force", action="store_true")
    c = commands.add_parser("manifest")
    for o in ("--dir", "--out"):
        c.add_argument(o, required=True)
    c = commands.add_parser("installed")
    for o in ("--prefix", "--checksums", "--design", "--out"):
        c.add_argument(o, required=True)
    c.add_argument("--gates")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("panelweave").getOrCreate()
    if a.command == "validate":
        validate(spark, a.prefix).show(truncate=False)
    elif a.command == "convert":
        convert(spark, a.ped, a.map, a.out)
    elif a.command == "simulate":
        simulate(spark, a.vcf, a.map, a.n, a.rate, a.seed, a.block_size, a.work, a.out, a.resume, a.force)
    elif a.command == "installed":
        installed(spark, a.prefix, a.checksums, a.design, a.out, a.gates).show(truncate=False)
    else:
        manifest(spark, a.dir, a.out)


if __name__ == "__main__":
    main()
