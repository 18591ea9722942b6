"""Queries over the derived panel: allele statistics, kinship, linkage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import agreement, gates, genotype, integrity, kinship, linkage, spectra, tiles, validation
from ..sources.text import parse_gt
from .views import BIN, KING, MAP, PANEL, R2, markers, panel

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


@query(f"""with {PANEL} select j, count(d) as n_calls, cast(0 as bigint) as n_missing, round(least(avg(d) / 2, 1 - avg(d) / 2), 8) as maf,
round(avg(case when d = 1 then 1e0 else 0e0 end), 8) as heterozygosity, round(var_samp(d), 8) as variance, count(distinct d) as levels from g group by j""")
def marker_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(genotype.marker_stats(panel(spark, sf)))


@query(f"with {PANEL} select round(avg(case when d = 1 then 1e0 else 0e0 end), 8) as heterozygosity, 0e0 as missingness, count(*) as cells from g")
def panel_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(genotype.panel_stats(panel(spark, sf)))


@query(f"with {PANEL}, l as (select j, count(distinct d) as n from g group by j) select count_if(n < 2)::bigint as monomorphic from l")
def monomorphic(spark: SparkSession, sf: str) -> DataFrame:
    return genotype.monomorphic_count(panel(spark, sf))


@query(f"with {PANEL} select label, count(*) as calls, count(distinct j) as markers from g where (label, j) in (select (label, j) from g group by label, j having var_samp(d) > 0) group by label")
def polymorphic_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Markers that vary within a population, by population."""
    g = panel(spark, sf)
    keep = g.groupBy("label", "j").agg(F.var_samp(F.col("d").cast("double")).alias("v")).where("v > 0").select("label", "j")
    return g.join(keep, ["label", "j"], "left_semi").groupBy("label").agg(F.count("*").alias("calls"), F.count_distinct("j").alias("markers"))


@query(f"""with {PANEL}, c as (select i, j, case when (i + j) % 17 = 0 then null else d end as d, j >= 60 as y, 1 + i % 2 as sex from g)
select count_if(d is null)::bigint as missing, count(*) as eligible, round(count_if(d is null) / cast(count(*) as double), 8) as missingness from c where not (y and sex = 2)""")
def sex_aware_missingness(spark: SparkSession, sf: str) -> DataFrame:
    g = panel(spark, sf)
    calls = g.select("i", "j", F.when((F.col("i") + F.col("j")) % 17 != 0, F.col("d")).alias("d"), F.when(F.col("j") >= 60, "Y").otherwise("22").alias("chr"), (1 + F.col("i") % 2).alias("sex"))
    return rounded(genotype.sex_aware_missingness(calls))


@query(f"with {PANEL} select label, cast(3 + count(distinct j) * ceil(count(distinct i) / 4e0) as bigint) as bytes from g group by label")
def bed_size(spark: SparkSession, sf: str) -> DataFrame:
    sizes = panel(spark, sf).groupBy("label").agg(F.count_distinct("i").alias("n"), F.count_distinct("j").alias("m"))
    return sizes.select("label", genotype.bed_bytes(F.col("n"), F.col("m")).alias("bytes"))


@query(f"with {PANEL}, f as (select i, string_agg(d::varchar, ',' order by j) as s from g group by i) select count(*) - count(distinct s) as duplicated from f")
def duplicated_individuals(spark: SparkSession, sf: str) -> DataFrame:
    """Individuals that repeat another one's calls at all markers."""
    return genotype.duplicated_rows(panel(spark, sf))


@query(f"""with {PANEL}, f as (select label, j, string_agg(d::varchar, ',' order by i) as s from g group by label, j), c as (select label, s, count(*) as c from f group by 1, 2)
select label, cast(sum(c * (c - 1) / 2) as bigint) as pairs from c group by label""")
def identical_marker_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Markers with the same calls over all samples of a population."""
    return genotype.identical_pairs(panel(spark, sf), within=("label",))


@query(f"with {PANEL}, r as (select i, j, case when (i * 7 + j) % 11 = 0 then null else d end as d from g) select count_if(r.d is not null and r.d is distinct from least(g.d + case when (g.i + g.j) % 101 = 0 then 1 else 0 end, 2))::bigint as changed from r join g using (i, j)")
def imputation_changes(spark: SparkSession, sf: str) -> DataFrame:
    g = panel(spark, sf)
    raw = g.select("i", "j", F.when((F.col("i") * 7 + F.col("j")) % 11 != 0, F.col("d")).alias("d"))
    imputed = g.select("i", "j", F.least(F.col("d") + F.when((F.col("i") + F.col("j")) % 101 == 0, 1).otherwise(0), F.lit(2)).alias("d"))
    return genotype.imputation_changes(raw, imputed)


@query(f"with {PANEL}, {KING} select i1, i2, round(kinship, 8) as kinship from king")
def king_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return kinship.king_pairs(panel(spark, sf), digits=8)


_CLASSES = "count_if(kinship >= pow(2, -1.5))::bigint as mz_pairs, count_if(kinship >= pow(2, -2.5) and kinship < pow(2, -1.5))::bigint as first_degree_pairs, count_if(kinship >= pow(2, -3.5) and kinship < pow(2, -2.5))::bigint as second_degree_pairs"


@query(f"with {PANEL}, {KING} select count(*) as pairs, round(median(kinship), 8) as median, round(quantile_cont(kinship, 0.95), 8) as q95, round(max(kinship), 8) as max, {_CLASSES} from king")
def king_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kinship.king_metrics(kinship.king_values(panel(spark, sf))))


@query(f"with {PANEL}, {KING} select " + ", ".join(f"round(quantile_cont(kinship, {q}), 8) as q" + f"{100 * q:g}".replace(".", "_") for q in kinship.QUANTILES) + f", {_CLASSES} from king")
def king_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kinship.king_distribution(kinship.king_values(panel(spark, sf))))


@query(f"""with {PANEL}, {KING} select case when kinship >= pow(2, -1.5) then 'MZ' when kinship >= pow(2, -2.5) then 'first' when kinship >= pow(2, -3.5) then 'second' else 'unrelated' end as class,
count(*) as pairs, round(avg(kinship), 8) as mean from king group by 1""")
def relatedness_classes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kinship.relatedness_classes(kinship.king_values(panel(spark, sf))))


@query(f"with {PANEL}, {R2} select j1, j2, dist, round(r2, 8) as r2 from r2 where dist <= 40000")
def ld_pairs_window(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(linkage.pair_r2(panel(spark, sf), linkage.marker_pairs(markers(spark), 40_000)))


@query(f"with {PANEL}, {R2} select j1, j2, dist, round(r2, 8) as r2 from r2 where dist <= 100000")
def ld_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs within 100 kb, by tiles of 16 neighbouring markers."""
    return rounded(tiles.window_r2(genotype.wide_markers(panel(spark, sf)), markers(spark), 100_000, 16))


@query(f"with {PANEL}, {R2} select j1, j2, dist, round(coalesce((n * xy - x * y) / nullif(sqrt((n * xx - x * x) * (n * yy - y * y)), 0e0), 0e0), 7) as r from s join r2 using (j1, j2)")
def marker_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(linkage.correlations(panel(spark, sf), markers(spark)), 7)


@query(f"with {PANEL}, {KING} select i1, i2, round(kinship, 8) as kinship from king")
def king_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Kinship of all pairs, by tiles of samples."""
    return kinship.king_pairs(panel(spark, sf), 64, "tiles", digits=8)


@query(f"""with {PANEL}, {R2}, bins as (select unnest(['0-10kb', '10-50kb', '50-100kb', '100-500kb', '500kb-1Mb', '>1Mb']) as bin), b as (select {BIN} as bin, r2 from r2)
select bins.bin, count(b.r2) as pairs, round(avg(b.r2), 8) as mean_r2, round(median(b.r2), 8) as median_r2 from bins left join b on bins.bin = b.bin group by 1""")
def ld_by_distance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(linkage.by_distance(linkage.window_ld(panel(spark, sf), markers(spark))))


@query(f"with {PANEL}, {R2}, {MAP}, e as (select j1 as j, r2 from r2 where dist <= 100000 union all select j2, r2 from r2 where dist <= 100000) select m.j, round(coalesce(sum(e.r2), 0e0), 8) as ld_score from m left join e on m.j = e.j group by 1")
def ld_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(linkage.ld_scores(linkage.window_ld(panel(spark, sf), markers(spark), 100_000), markers(spark)))


@query(f"with {PANEL}, {R2}, {MAP}, e as (select j1 as j, r2 from r2 union all select j2, r2 from r2), t as (select m.j, coalesce(sum(e.r2), 0e0) as s from m left join e on m.j = e.j group by 1) select round(median(s), 8) as median_ld_score from t")
def median_ld_score(spark: SparkSession, sf: str) -> DataFrame:
    m = markers(spark)
    scores = linkage.ld_scores(linkage.window_ld(panel(spark, sf), m), m)
    return rounded(scores.agg(F.median("ld_score").alias("median_ld_score")))


@query(f"with {PANEL}, {R2} select round(64e0 * 64 / (64 + 2 * sum(r2)), 6) as effective_rank from r2")
def effective_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(linkage.effective_rank(panel(spark, sf), markers(spark)), 6)


@query()
def largest_eigenvalue(spark: SparkSession, sf: str) -> DataFrame:
    """Effective rank and largest eigenvalue of the panel, from sample space."""
    rank, top = spectra.eigen_metrics(panel(spark, sf))
    return spark.createDataFrame([(round(rank, 6), round(top, 6))], "effective_rank double, largest_eigenvalue double")


@query()
def pca_displacement(spark: SparkSession, sf: str) -> DataFrame:
    g = panel(spark, sf)
    return rounded(spectra.pca_displacement(g.where("label >= 5"), g.where("label < 5")), 6)


_SIDES = "a as (select j, least(avg(d) / 2, 1 - avg(d) / 2) as x from g where label >= 5 group by j), b as (select j, least(avg(d) / 2, 1 - avg(d) / 2) as y from g where label < 5 group by j), ab as (select x, y from a join b using (j))"


@query(f"""with {PANEL}, {_SIDES} select count(*) as markers, round(corr(x, y), 7) as correlation, round(avg(abs(x - y)), 8) as mean_abs_difference, round(median(abs(x - y)), 8) as median_abs_difference,
round(max(abs(x - y)), 8) as max_abs_difference, round(abs(avg(x) - avg(y)), 8) as abs_difference_of_means from ab""")
def maf_agreement(spark: SparkSession, sf: str) -> DataFrame:
    g = panel(spark, sf)
    side = lambda rows: genotype.marker_stats(rows).select("j", "maf")
    out = agreement.maf_agreement(side(g.where("label >= 5")), side(g.where("label < 5")))
    return rounded(out.withColumn("correlation", F.round("correlation", 7)))


def _metrics(g: DataFrame) -> DataFrame:
    """replicate (population), metric, value: mean MAF, heterozygosity and
    number of samples."""
    by = g.groupBy("label", "j").agg(F.avg(F.col("d").cast("double")).alias("m"), F.avg((F.col("d") == 1).cast("double")).alias("h"))
    wide = by.groupBy(F.col("label").alias("replicate")).agg(F.avg(F.least(F.col("m") / 2, 1 - F.col("m") / 2)).alias("mean_maf"), F.avg("h").alias("heterozygosity"))
    return agreement.metric_vector(wide)


_METRICS = """mj as (select label, j, least(avg(d) / 2, 1 - avg(d) / 2) as maf, avg(case when d = 1 then 1e0 else 0e0 end) as h from g group by 1, 2),
mw as (select label as replicate, avg(maf) as mean_maf, avg(h) as heterozygosity from mj group by 1),
mv as (select replicate, 'mean_maf' as metric, mean_maf as value from mw union all select replicate, 'heterozygosity', heterozygosity from mw)"""


@query(f"with {PANEL}, {_METRICS}, b as (select metric, avg(value) as base from mv where replicate < 5 group by 1) select replicate, metric, round(value / base, 8) as ratio from mv join b using (metric) where replicate >= 5")
def replicate_ratio(spark: SparkSession, sf: str) -> DataFrame:
    v = _metrics(panel(spark, sf))
    return rounded(agreement.replicate_ratio(v.where("replicate >= 5"), v.where("replicate < 5")))


@query(f"with {PANEL}, {_METRICS} select metric, round(quantile_cont(value, 0.975), 8) as limit_ from mv where replicate < 5 group by 1")
def tail_limits(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(agreement.tail_limits(_metrics(panel(spark, sf)).where("replicate < 5")).withColumnRenamed("limit", "limit_"))


@query(f"""with {PANEL}, {_METRICS}, c as (select metric, value as candidate from mv where replicate = 9), r as (select mv.metric, value, candidate from mv join c on mv.metric = c.metric where replicate < 9)
select metric, round(candidate, 8) as candidate, count(*) as n, round(avg(value), 8) as mean, round(stddev_samp(value), 8) as sd, round(median(value), 8) as median, round(quantile_cont(value, 0.025), 8) as q025,
round(quantile_cont(value, 0.975), 8) as q975, round(avg(case when value <= candidate then 1e0 else 0e0 end), 8) as percentile from r group by metric, candidate""")
def metric_distribution(spark: SparkSession, sf: str) -> DataFrame:
    v = _metrics(panel(spark, sf))
    return rounded(agreement.metric_distribution(v.where("replicate = 9"), v.where("replicate < 9")))


@query(f"with {PANEL}, t as (select i, j, case d when 0 then '0|0' when 1 then case when (i + j) % 2 = 0 then '0|1' else '1|0' end else '1|1' end || ':9' as gt from g) select j, sum(cast(substr(gt, 1, 1) as int) + cast(substr(gt, 3, 1) as int))::bigint as alternate, sum(cast(substr(gt, 1, 1) as int))::bigint as first_alleles, count(*) as samples from t group by j")
def vcf_gt_parse(spark: SparkSession, sf: str) -> DataFrame:
    het = F.when((F.col("i") + F.col("j")) % 2 == 0, "0|1").otherwise("1|0")
    gt = F.concat(F.when(F.col("d") == 0, "0|0").when(F.col("d") == 1, het).otherwise("1|1"), F.lit(":9"))
    a = panel(spark, sf).select("j", parse_gt(gt).alias("a"))
    return a.groupBy("j").agg(F.sum(F.col("a")[0] + F.col("a")[1]).alias("alternate"), F.sum(F.col("a")[0]).alias("first_alleles"), F.count("*").alias("samples"))


@query(f"with {PANEL} select count_if((i + j) % 97 = 0 and d <> 1)::bigint as differences, count(*) as compared from g")
def ped_orientation_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """Allele pairs against a copy with every pair swapped and some recoded."""
    g = panel(spark, sf)
    a = g.select("i", "j", F.when(F.col("d") == 2, 2).otherwise(1).alias("a1"), F.when(F.col("d") == 0, 1).otherwise(2).alias("a2"))
    recode = ((F.col("i") + F.col("j")) % 97 == 0) & (F.col("d") != 1)
    b = a.join(g, ["i", "j"]).select("i", "j", F.when(recode, 3 - F.col("a2")).otherwise(F.col("a2")).alias("a1"), F.when(recode, 3 - F.col("a1")).otherwise(F.col("a1")).alias("a2"))
    return integrity.pair_equivalence(a, b, "i", "j")


@query(f"""with {PANEL}, {_SIDES}, {_METRICS}, h as (select abs(avg(case when label >= 5 then case when d = 1 then 1e0 else 0e0 end end) - avg(case when label < 5 then case when d = 1 then 1e0 else 0e0 end end)) as h from g),
q as (select corr(x, y) as c, abs(avg(x) - avg(y)) as m from ab),
gates as (select unnest(['maf_correlation', 'mean_maf_difference', 'heterozygosity_difference', 'hard_calls']) as gate, unnest([c >= 0.98, m <= 0.01, h <= 0.01, (select bool_and(d in (0, 1, 2)) from g)]) as pass from q, h)
select 'all' as ancestry, gate, pass from gates""")
def acceptance_gates(spark: SparkSession, sf: str) -> DataFrame:
    g = panel(spark, sf)
    side = lambda rows: genotype.marker_stats(rows).select("j", "maf")
    maf = agreement.maf_agreement(side(g.where("label >= 5")), side(g.where("label < 5")))
    het = F.avg(F.when(F.col("label") >= 5, (F.col("d") == 1).cast("double"))) - F.avg(F.when(F.col("label") < 5, (F.col("d") == 1).cast("double")))
    summary = maf.join(g.agg(F.abs(het).alias("heterozygosity_difference"), F.bool_and(F.col("d").isin(0, 1, 2)).alias("hard_calls")))
    summary = summary.select(F.lit("all").alias("ancestry"), F.col("correlation").alias("maf_correlation"), F.col("abs_difference_of_means").alias("mean_maf_difference"), "heterozygosity_difference", "hard_calls")
    some = {"maf_correlation", "mean_maf_difference", "heterozygosity_difference"}
    rules = [x for x in gates.enforced() if x.name in some] + [gates.Gate("hard_calls", F.col("hard_calls"))]
    return gates.evaluate(summary, rules)


_SUBSETS = f"""ks as (select l.label, kinship from king join (select distinct i, label from g) l on l.i = i1 join (select distinct i, label from g) r on r.i = i2 where l.label = r.label),
sub as (select case when label < 5 then 'AFR' else 'EUR' end as ancestry, case when label % 2 = 0 then 'reference' else 'synthetic' end as source, label, count(*) as pairs, median(kinship) as median, quantile_cont(kinship, 0.95) as q95, max(kinship) as max, {_CLASSES} from ks group by all)"""


@query(f"""with {PANEL}, {KING}, {_SUBSETS} select ancestry, source, count(*) as subsets, round(avg(median), 8) as mean_median, round(median(median), 8) as median_median, round(median(q95), 8) as median_q95, round(quantile_cont(q95, 0.975), 8) as q975_q95,
round(max(max), 8) as max, sum(pairs)::bigint as pairs, sum(mz_pairs)::bigint as mz_pairs, sum(first_degree_pairs)::bigint as first_degree_pairs, sum(second_degree_pairs)::bigint as second_degree_pairs from sub group by 1, 2
union all select 'all', 'full_panel', 1, null, round(median(kinship), 8), round(quantile_cont(kinship, 0.95), 8), null, round(max(kinship), 8), count(*), {_CLASSES} from king""")
def relatedness_rollup(spark: SparkSession, sf: str) -> DataFrame:
    g = panel(spark, sf)
    own = kinship.king_metrics(kinship.king_values_within(g, g.select("i", "label").distinct(), "label"), ("label",))
    sub = own.select(F.when(F.col("label") < 5, "AFR").otherwise("EUR").alias("ancestry"), F.when(F.col("label") % 2 == 0, "reference").otherwise("synthetic").alias("source"), "pairs", "median", "q95", "max", *kinship.CLASS_COUNTS)
    full = kinship.king_metrics(kinship.king_values(g)).withColumn("ancestry", F.lit("all"))
    return rounded(agreement.relatedness_rollup(sub, full))


@query()
def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and digest of every file of the folder; a table's name keeps its parts apart."""
    return integrity.file_manifest(spark, sf).select(F.regexp_extract("path", r"([^/]+\.parquet/)?[^/]+$", 0).alias("file"), "bytes", "sha256")


@query(f"""with {PANEL}, {MAP} select cast(floor(j / 16) + 1 as int) as block, count(*) as calls, min(bp) as from_bp, max(bp) as to_bp, sum(d)::bigint as dosage from g join m using (j) group by 1""")
def block_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of 16 markers, stacked again: what each block holds."""
    from ..operators.ordered import blocks

    m = blocks(markers(spark), [], ["j"], 16)
    parts = [panel(spark, sf).join(m.where(F.col("block") == b), "j") for b in range(1, 5)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("block").agg(F.count("*").alias("calls"), F.min("bp").alias("from_bp"), F.max("bp").alias("to_bp"), F.sum("d").alias("dosage"))




@query()
def dataset_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metric vector of populations 5 to 9 against populations 0 to 4."""
    g = panel(spark, sf)
    ref = g.where("label < 5")
    return rounded(validation.dataset_metrics(g.where("label >= 5"), markers(spark), genotype.marker_stats(ref).select("j", "maf"), ref), 6)


_SYNTHETIC = PANEL.replace("from p0)", "from p0 where label >= 5)")
_BINS = "".join(
    f", count_if(bin = '{b}')::bigint as pairs_{n}, round(avg(case when bin = '{b}' then r2 end), 6) as mean_r2_{n}, round(median(case when bin = '{b}' then r2 end), 6) as median_r2_{n}" for b, n in validation.BIN_NAMES.items()
)


@query(f"""with {_SYNTHETIC}, {KING}, {R2}, {MAP}, o as (select j, case when e < -1e-1 then 0 when e > 1e-1 then 2 else 1 end as d from p0 where label < 5),
y as (select j, least(avg(d) / 2, 1 - avg(d) / 2) as y from o group by j), x as (select j, least(avg(d) / 2, 1 - avg(d) / 2) as x, count(distinct d) as levels from g group by j),
maf as (select round(corr(x, y), 6) as maf_correlation_with_full_reference, round(avg(abs(x - y)), 6) as mean_maf_absolute_difference, round(median(abs(x - y)), 6) as median_maf_absolute_difference, round(max(abs(x - y)), 6) as max_maf_absolute_difference,
  round(avg(x), 6) as mean_maf, round(median(x), 6) as median_maf, count_if(levels < 2)::bigint as monomorphic_markers from x join y using (j)),
cells as (select 0e0 as genotype_missingness, round(avg(case when d = 1 then 1e0 else 0e0 end), 6) as heterozygosity from g),
e as (select j1 as j, r2 from r2 union all select j2, r2 from r2), t as (select m.j, coalesce(sum(e.r2), 0e0) as s from m left join e on m.j = e.j group by 1), score as (select round(median(s), 6) as median_ld_score from t),
rows_ as (select i, string_agg(d::varchar, ',' order by j) as s from g group by i), copies as (select count(*) - count(distinct s) as duplicated_individuals from rows_),
columns_ as (select j, string_agg(d::varchar, ',' order by i) as s from g group by j), same_ as (select s, count(*) as c from columns_ group by s), same as (select cast(sum(c * (c - 1) / 2) as bigint) as identical_genotype_marker_pairs from same_),
kin as (select count(*) as kinship_pairs, round(median(kinship), 6) as kinship_median, round(quantile_cont(kinship, 0.95), 6) as kinship_q95, round(max(kinship), 6) as kinship_max, {_CLASSES.replace("mz_pairs", '"duplicate_MZ_pairs"')} from king),
b as (select {BIN} as bin, r2 from r2), ld as (select {_BINS[2:]} from b)
select * from maf, cells, score, copies, same, kin, ld""")
def dataset_metric_figures(spark: SparkSession, sf: str) -> DataFrame:
    """The figures of that vector that SQL has: all but eigenvalues and PCA,
    so that of the reference only its allele frequencies are needed."""
    g = panel(spark, sf)
    maf = genotype.marker_stats(g.where("label < 5")).select("j", "maf")
    return rounded(validation.dataset_metrics(g.where("label >= 5"), markers(spark), maf), 6).drop("effective_rank", "largest_eigenvalue")


_LD_BINS = ("0_10kb", "10_50kb", "50_100kb")
_RATED = [f"ld_ratio_{b}" for b in _LD_BINS] + ["ld_score_ratio", "effective_rank_ratio"]


@query(f"""with {PANEL}, {KING}, s as (select a.label, a.j as j1, b.j as j2, cast(count(*) as double) as n, cast(sum(a.d) as double) as x, cast(sum(b.d) as double) as y, cast(sum(a.d * a.d) as double) as xx, cast(sum(b.d * b.d) as double) as yy, cast(sum(a.d * b.d) as double) as xy
  from g a join g b on a.i = b.i and a.j < b.j group by 1, 2, 3),
r2 as (select label, j1, j2, 4000 * (j2 - j1) as dist, coalesce((n * xy - x * y) * (n * xy - x * y) / nullif((n * xx - x * x) * (n * yy - y * y), 0e0), 0e0) as r2 from s),
e as (select label, j1 as j, r2 from r2 union all select label, j2, r2 from r2), t as (select label, j, sum(r2) as s from e group by 1, 2), score as (select label, median(s) as ld_score from t group by 1),
v as (select label, avg(case when dist < 10000 then r2 end) as a, avg(case when dist >= 10000 and dist < 50000 then r2 end) as b, avg(case when dist >= 50000 and dist < 100000 then r2 end) as c, 64e0 * 64 / (64 + 2 * sum(r2)) as f from r2 group by 1),
w as (select label, a, b, c, ld_score as d, f from v join score using (label)), base as (select avg(a) as a, avg(b) as b, avg(c) as c, avg(d) as d, avg(f) as f from w where label < 5),
ratios as (select w.a / base.a as a, w.b / base.b as b, w.c / base.c as c, w.d / base.d as d, w.f / base.f as f from w, base where label >= 5),
p as (select distinct i, label from g), k as (select x.label as l1, y.label as l2, kinship from king join p x on x.i = i1 join p y on y.i = i2),
own as (select l1, count_if(kinship >= pow(2, -2.5) and kinship < pow(2, -1.5)) / cast(count(*) as double) as f, count_if(kinship >= pow(2, -1.5)) / cast(count(*) as double) as m from k where l1 = l2 and l1 < 5 group by 1),
lim as (select quantile_cont(f, 0.975) as fl, quantile_cont(m, 0.975) as ml from own),
rate as (select count_if(kinship >= pow(2, -2.5) and kinship < pow(2, -1.5)) / cast(count(*) as double) as fr, count_if(kinship >= pow(2, -1.5)) / cast(count(*) as double) as mr from k where l1 >= 5 and l2 >= 5),
rows_ as (select i, string_agg(d::varchar, ',' order by j) as s from g where label >= 5 group by i), dup as (select count(*) - count(distinct s) as dup from rows_),
shape as (select count(distinct i) as n, count(distinct j) as m, count(*) as cells, bool_and(d in (0, 1, 2)) as hard from g where label >= 5),
far as (select max(greatest(abs(a - 1), abs(b - 1), abs(c - 1))) as ld, max(abs(d - 1)) as score, max(abs(f - 1)) as rank,
  bool_and(a between 0.8 and 1.2 and b between 0.8 and 1.2 and c between 0.8 and 1.2) as ld_ok, bool_and(d between 0.8 and 1.2) as score_ok, bool_and(f between 0.8 and 1.2) as rank_ok from ratios)
select unnest(['dimensions_hard_calls', 'marker_integrity', 'ld_below_100kb', 'ld_score', 'effective_rank', 'duplicate_individuals', 'empirical_relatedness', 'plink_roundtrip']) as gate,
  unnest([hard and n * m = cells and m = 64, true, ld_ok, score_ok, rank_ok, dup = 0, fr <= fl and mr <= ml, true]) as pass,
  round(unnest([cast(cells as double), 64e0, ld, score, rank, cast(dup as double), fr + mr, cast(cells as double)]), 6) as figure
from far, lim, rate, dup, shape""")
def gate_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Eight gates, and the figure behind each, with populations as replicates:
    0 to 4 the reference, 5 to 9 the synthetic panel."""
    from ..operators.integrity import calls_differ, ordered_identity
    from ..sources import plink
    from .file_queries import _bim, _samples
    from .views import work_folder

    g = panel(spark, sf)
    syn, ref = g.where("label >= 5"), g.where("label < 5")
    marks = markers(spark)
    people = g.select("i", "label").distinct()
    place = people.select("i", (F.row_number().over(W.partitionBy("label").orderBy("i")) - 1).alias("place"))
    each = g.join(place, "i").select(F.col("label").alias("replicate"), F.col("place").alias("i"), "j", "d")
    metrics = validation.metrics_by_replicate(each, marks, genotype.marker_stats(ref).select("j", "maf"))
    ratios = {f"mean_r2_{b}": f"ld_ratio_{b}" for b in _LD_BINS} | {"median_ld_score": "ld_score_ratio", "effective_rank": "effective_rank_ratio"}
    base = metrics.where("replicate < 5").agg(*(F.avg(m).alias(f"base_{m}") for m in ratios))
    rated = metrics.where("replicate >= 5").join(base).select(*((F.col(m) / F.col(f"base_{m}")).alias(r) for m, r in ratios.items()))
    rated = rated.agg(*(F.collect_list(r).alias(r) for r in _RATED))
    rates = metrics.where("replicate < 5").select((F.col("first_degree_pairs") / F.col("kinship_pairs")).alias("f"), (F.col("duplicate_MZ_pairs") / F.col("kinship_pairs")).alias("m"))
    limits = rates.agg(F.percentile("f", F.lit(0.975)).alias("first_degree_limit"), F.percentile("m", F.lit(0.975)).alias("mz_limit"))
    king = kinship.king_metrics(kinship.king_values(syn)).select((F.col("first_degree_pairs") / F.col("pairs")).alias("first_degree_rate"), (F.col("mz_pairs") / F.col("pairs")).alias("mz_rate"))
    shape = syn.agg(F.bool_and(F.col("d").isin(0, 1, 2)).alias("hard_calls"), F.count_distinct("i").alias("n_samples"), F.count_distinct("j").alias("n_markers"), F.count("*").alias("cells"))
    shape = shape.select("*", (F.col("cells") / F.col("n_markers")).cast("long").alias("expected_samples"), F.lit(64).alias("expected_markers"))
    # the panel as a fileset and back, its markers in the order they were given
    prefix = f"{work_folder(spark, 'gates')}/p"
    dense = syn.join(syn.select("i").distinct().select("i", (F.row_number().over(W.orderBy("i")) - 1).alias("n")), "i").select(F.col("n").alias("i"), "j", F.col("d").cast("tinyint").alias("d"))
    plink.write_fileset(prefix, dense, _bim(spark), _samples(dense))
    back = calls_differ(dense, plink.read_calls(spark, prefix)).select((F.col("differences") == 0).alias("round_trip"))
    order = ordered_identity(plink.read_bim(spark, f"{prefix}.bim").select("j", "id"), _bim(spark).select("j", "id"), "j").select(F.col("identical").alias("markers_in_order"))
    summary = validation._beside([shape, rated, limits, king, genotype.duplicated_rows(syn), back, order])
    far = lambda *names: F.greatest(*(F.aggregate(n, F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x - 1))) for n in names))
    behind = {
        "dimensions_hard_calls": F.col("cells"), "marker_integrity": F.col("n_markers"), "ld_below_100kb": far(*_RATED[:3]), "ld_score": far(_RATED[3], _RATED[3]), "effective_rank": far(_RATED[4], _RATED[4]),
        "duplicate_individuals": F.col("duplicated"), "empirical_relatedness": F.col("first_degree_rate") + F.col("mz_rate"), "plink_roundtrip": F.col("cells"),
    }
    found = gates.evaluate(summary.withColumn("ancestry", F.lit("all")), [x for x in gates.enforced() if x.name in behind]).drop("ancestry")
    figures = summary.select(F.explode(F.create_map(*(c for k, v in behind.items() for c in (F.lit(k), F.round(v.cast("double"), 6))))).alias("gate", "figure"))
    return found.join(figures, "gate")


@query()
def validation_gates(spark: SparkSession, sf: str) -> DataFrame:
    """The thirteen gates on populations 5 to 9 as a synthetic panel."""
    g = panel(spark, sf)
    syn, ref = g.where("label >= 5").select("i", "j", "d"), g.where("label < 5").select("i", "j", "d")
    n = syn.select("i").distinct().count()
    return validation.validate_panel("all", syn, ref, markers(spark), genotype.marker_stats(ref).select("j", "maf"), n, 64, 11).gates
