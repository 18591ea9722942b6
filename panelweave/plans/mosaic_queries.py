"""Queries over simulated mosaics: 40 haplotypes of 64 markers from 20 donors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.random import mix_sql
from ..operators import mosaic, ordered, overlap, sampling
from .panel_queries import rounded
from .views import PANEL, panel

QUERIES: dict = {}
SQL: dict[str, str] = {}
HAPS, DONORS, RATE, SEED = 40, 20, 20.0, 20260817


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _markers(spark: SparkSession) -> DataFrame:
    return spark.range(64).select(F.col("id").cast("int").alias("j"), (F.col("id") / 100).alias("morgan"), (F.col("id") * 10_000).alias("bp"))


def _paths(spark: SparkSession) -> DataFrame:
    return mosaic.donor_paths(spark.range(HAPS).select(F.col("id").cast("int").alias("hap")), _markers(spark), DONORS, RATE, SEED)


PATHS = f"""m as (select cast(r.range as int) as j, r.range / 100e0 as morgan, r.range * 10000 as bp from range(64) r),
c as (select cast(h.range as int) as hap, m.j, m.morgan - lag(m.morgan) over (partition by h.range order by m.j) as delta from range({HAPS}) h, m),
{mix_sql("c", "hap", "j", SEED, {"u1": 1, "u2": 2, "u3": 3})},
w as (select hap, j, case when j > 0 and u1 < 1 - exp(-{RATE} * delta) then 1 else 0 end as switched, u2, u3 from u),
paths as (select hap, j, switched, cast(sum(case when j = 0 then floor(u3 * {DONORS}) when switched = 1 then 1 + floor(u2 * {DONORS - 1}) else 0 end) over o as bigint) % {DONORS} as donor, sum(switched) over o as segment from w window o as (partition by hap order by j)),
segs as (select hap, segment, min(donor) as donor, min(p.j) as start_j, max(p.j) as end_j, count(*) as markers, min(morgan) as m0, max(morgan) as m1, min(bp) as b0, max(bp) as b1 from paths p join m on p.j = m.j group by 1, 2)"""
CELLS = """hp as (select a.hap as h1, b.hap as h2, a.j from paths a join paths b on a.j = b.j and a.donor = b.donor and a.hap < b.hap),
hr as (select h1, h2, j, j - row_number() over (partition by h1, h2 order by j) as run from hp),
rr as (select h1, h2, run, min(hr.j) as start_j, max(hr.j) as end_j, count(*) as size, max(m.morgan) - min(m.morgan) as morgan, max(m.bp) - min(m.bp) as bp from hr join m on hr.j = m.j group by 1, 2, 3),
ho as (select h1, h2, sum(size) / 64e0 as overlap, max(morgan) as longest_morgan, max(bp) as longest_bp from rr group by 1, 2)"""


@query(f"with {PATHS} select hap, j, switched, cast(donor as int) as donor, cast(segment as int) as segment from paths")
def mosaic_donor_path(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark)


@query(f"with {PATHS} select hap, j, switched, cast(donor as int) as donor, cast(segment as int) as segment from paths")
def mosaic_block_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The same paths, each block of 16 markers on top of the sums before it."""
    haps, placed = spark.range(HAPS).select(F.col("id").cast("int").alias("hap")), ordered.blocks(_markers(spark), [], ["j"], 16)
    steps, offsets = mosaic.map_steps(placed.select("j", "morgan", "block")), mosaic.block_offsets(haps, placed, DONORS, RATE, SEED)
    parts = [mosaic.block_paths(haps, steps.where(F.col("block") == b), offsets.where(F.col("block") == b), DONORS, RATE, SEED) for b in range(1, 5)]
    return reduce(DataFrame.unionByName, parts)


@query(f"with {PATHS}, s as (select donor, lag(donor) over (partition by hap order by segment) as p from segs) select count_if(p = donor)::bigint as repeats from s")
def successive_donors(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.successive_differ(_paths(spark))


@query(f"with {PATHS} select hap, cast(segment as int) as segment, cast(donor as int) as donor, start_j, end_j, markers, round(m1 - m0, 8) as morgan, b1 - b0 as bp from segs")
def mosaic_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mosaic.segments(_paths(spark), _markers(spark)))


@query(f"with {PATHS} select hap, cast(segment as int) as segment, cast(donor as int) as donor, start_j, end_j, markers, round(coalesce(lead(m0) over (partition by hap order by segment), m1) - m0, 8) as morgan, coalesce(lead(b0) over (partition by hap order by segment), b1) - b0 as bp from segs")
def mosaic_segments_to_next(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mosaic.segments(_paths(spark), _markers(spark), "to_next"))


def _four(c: str, x: str) -> str:
    return f"round(avg({x}), 8) as mean_{c}, round(median({x}), 8) as median_{c}, round(quantile_cont({x}, 0.025), 8) as q025_{c}, round(quantile_cont({x}, 0.975), 8) as q975_{c}"


@query(f"with {PATHS}, h as (select hap, count(*) - 1 as switches, count(distinct donor) as donors from segs group by 1), a as (select {_four('switches', 'switches')}, {_four('donors', 'donors')} from h), b as (select {_four('markers', 'markers')}, {_four('morgan', 'm1 - m0')}, {_four('bp', '(b1 - b0)')} from segs) select * from a, b")
def segment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mosaic.segment_summary(mosaic.segments(_paths(spark), _markers(spark))))


@query(f"with {PANEL}, {PATHS} select cast(floor(hap / 2) as int) as i, p.j, cast(sum(case when g.d > 0 then 1 else 0 end) as int) as d from paths p join g on g.i = p.donor and g.j = p.j group by 1, 2")
def mosaic_diploid(spark: SparkSession, sf: str) -> DataFrame:
    """Alleles of the first twenty samples, copied along the paths, in pairs."""
    donors = panel(spark, sf).where(F.col("i") < DONORS).select(F.col("i").alias("donor"), "j", (F.col("d") > 0).cast("int").alias("allele"))
    return mosaic.diploid(mosaic.haplotype_alleles(_paths(spark), donors))


def _segs(spark: SparkSession) -> DataFrame:
    return mosaic.segments(_paths(spark), _markers(spark))


@query(f"with {PATHS}, {CELLS} select h1, h2, round(overlap, 8) as overlap, round(longest_morgan, 8) as longest_morgan, longest_bp from ho")
def longest_shared_tract(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overlap.haplotype_overlap(_segs(spark), _markers(spark), 16))


_PAIRS = f"e as (select cast(a.range as int) as i1, cast(b.range as int) as i2 from range({HAPS // 2}) a join range({HAPS // 2}) b on a.range < b.range)"


@query(f"""with {PATHS}, {CELLS}, {_PAIRS}, s as (select cast(floor(h1 / 2) as int) as i1, cast(floor(h2 / 2) as int) as i2, * from ho), t as (select i1, i2, sum(overlap) / 4 as mean_overlap, max(overlap) as max_overlap, max(longest_morgan) as longest_morgan, max(longest_bp) as longest_bp from s where i1 < i2 group by 1, 2)
select e.i1, e.i2, round(coalesce(mean_overlap, 0e0), 8) as mean_overlap, round(coalesce(max_overlap, 0e0), 8) as max_overlap, round(coalesce(longest_morgan, 0e0), 8) as longest_morgan, coalesce(longest_bp, 0) as longest_bp from e left join t on e.i1 = t.i1 and e.i2 = t.i2""")
def donor_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overlap.individual_overlap(_segs(spark), _markers(spark), HAPS // 2, 16))


_SAMPLED = f"{_PAIRS}, {mix_sql('e', 'i1', 'i2', 5, {'u': 1}, 'v')}, chosen as (select i1, i2 from v order by u, i1, i2 limit 60)"


@query(f"with {_PAIRS}, {mix_sql('e', 'i1', 'i2', 5, {'u': 1}, 'v')} select i1, i2 from v order by u, i1, i2 limit 60")
def sampled_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sampled_pairs(spark, HAPS // 2, 60, 5)


@query(f"""with {PATHS}, {CELLS}, {_SAMPLED}, r as (select c.i1, c.i2, rr.* from rr join chosen c on floor(h1 / 2) = c.i1 and floor(h2 / 2) = c.i2),
o as (select i1, i2, h1, h2, sum(size) / 64e0 as o from r group by all), best as (select *, row_number() over (partition by i1, i2 order by round(morgan, 12) desc, h1, h2, start_j) as k from r),
t as (select i1, i2, sum(o) / 4 as mean_overlap, max(o) as max_overlap from o group by 1, 2)
select c.i1, c.i2, round(coalesce(mean_overlap, 0e0), 8) as mean_overlap, round(coalesce(max_overlap, 0e0), 8) as max_overlap, round(coalesce(b.morgan, 0e0), 8) as longest_morgan, coalesce(b.bp, 0) as longest_bp
from chosen c left join t on c.i1 = t.i1 and c.i2 = t.i2 left join best b on c.i1 = b.i1 and c.i2 = b.i2 and b.k = 1""")
def sampled_overlap(spark: SparkSession, sf: str) -> DataFrame:
    pairs = sampling.sampled_pairs(spark, HAPS // 2, 60, 5)
    return rounded(overlap.sampled_longest(_segs(spark), _markers(spark), pairs, 16))


@query("select max(rate) filter (where a and b and c and isfinite(rate)) as copy_rate from (values (5e0, true, true, true), (10e0, true, true, true), (25e0, true, false, true), ('inf'::double, true, true, true), (12e0, null, true, true)) t(rate, a, b, c)")
def copy_rate_selection(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(5.0, True, True, True), (10.0, True, True, True), (25.0, True, False, True), (float("inf"), True, True, True), (12.0, None, True, True)]
    return mosaic.select_copy_rate(spark.createDataFrame(rows, "rate double, a boolean, b boolean, c boolean"), "a", "b", "c")


@query(f"with {PATHS} select hap, j, cast(donor as int) as donor from paths")
def segments_to_donors(spark: SparkSession, sf: str) -> DataFrame:
    """Segments unfolded to cells again."""
    return mosaic.segments_to_donors(_segs(spark), HAPS, 64)


_OF = ("mean_overlap", "max_overlap", "longest_morgan", "longest_bp")


@query(f"with t as ({SQL['sampled_overlap']}) select count(*) as pairs, " + ", ".join(f"round(avg({c}), 6) as mean_of_{c}, round(median({c}), 6) as median_of_{c}, round(quantile_cont({c}, 0.995), 6) as q995_of_{c}" for c in _OF) + " from t")
def sampled_overlap_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(overlap.sampled_summary(sampled_overlap(spark, sf)), 6)
