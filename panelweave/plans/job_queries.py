"""The jobs as queries: each runs twice into a new folder; its output is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common, panel_qc, text_manifest

from ..functions.shared import shared_folder


def job1_panel_qc(spark: SparkSession, sf: str) -> DataFrame:
    """Samples, markers and released calls, one under the other."""
    out = f"{shared_folder(spark)}/panel-qc-{uuid.uuid4().hex}"
    for _ in range(2):
        tables = panel_qc.run(spark, f"{sf}/embeddings.parquet", out, common.settings("panel_qc"))
    samples, markers, calls = (df.withColumn("part", F.lit(t)) for t, df in zip(("samples", "markers", "calls"), tables))
    markers = markers.withColumns({c: F.round(c, 8) for c in ("maf", "heterozygosity")} | {"hwe_chi2": F.round("hwe_chi2", 4)})
    every = samples.unionByName(markers, allowMissingColumns=True).unionByName(calls, allowMissingColumns=True)
    return every.select("part", F.col("i").cast("long"), F.col("block").cast("int"), F.col("j").cast("int"), "bp", F.col("d").cast("int"), "n_calls", "n_missing", F.round("missingness", 8).alias("missingness"), "maf", "heterozygosity", "hwe_chi2", "verdict")


_S = common.settings("panel_qc")
JOB1_SQL = f"""
with p0 as (select cast(vec_id as bigint) as i, unnest(range(len(embedding))) as j, cast(unnest(embedding) as double) as e from embeddings where vec_id is not null),
g as (select i, cast(j as int) as j, case when e is null or isnan(e) then null when e < {_S['low']}::double then 0 when e > {_S['high']}::double then 2 else 1 end as d from p0),
t as (select i, count_if(d is null)::bigint as n_missing, avg(case when d is null then 1e0 else 0e0 end) as missingness, string_agg(coalesce(d, -1)::varchar, ',' order by j) as calls from g group by i),
samples as (select i, n_missing, missingness, case when missingness > {_S['max_sample_missing']}::double then 'missing' when min(i) over (partition by calls) < i then 'copy' else 'keep' end as verdict from t),
k as (select g.* from g where i in (select i from samples where verdict = 'keep')),
n as (select j, cast(count_if(d = 0) as double) as n0, cast(count_if(d = 1) as double) as n1, cast(count_if(d = 2) as double) as n2, count_if(d is null)::bigint as n_missing from k group by j),
f as (select *, n0 + n1 + n2 as n, (2 * n2 + n1) / (2 * (n0 + n1 + n2)) as p from n),
h as (select j, n_missing, cast(n as bigint) as n_calls, least(p, 1 - p) as maf, n1 / n as heterozygosity,
  coalesce(pow(n0 - n * (1 - p) * (1 - p), 2) / nullif(n * (1 - p) * (1 - p), 0), 0) + coalesce(pow(n1 - 2 * n * p * (1 - p), 2) / nullif(2 * n * p * (1 - p), 0), 0) + coalesce(pow(n2 - n * p * p, 2) / nullif(n * p * p, 0), 0) as hwe_chi2 from f),
a as (select *, case when n_missing / cast(n_calls + n_missing as double) > {_S['max_marker_missing']}::double then 'missing' when coalesce(maf, 0) < {_S['min_maf']}::double then 'rare' when hwe_chi2 > {_S['max_hwe_chi2']}::double then 'hwe' end as alone from h),
o as (select k.* from k join a on k.j = a.j and a.alone is null where d is not null),
s as (select x.j as j1, y.j as j2, cast(count(*) as double) as n, cast(sum(x.d) as double) as x, cast(sum(y.d) as double) as y, cast(sum(x.d * x.d) as double) as xx, cast(sum(y.d * y.d) as double) as yy, cast(sum(x.d * y.d) as double) as xy
  from o x join o y on x.i = y.i and x.j < y.j and (y.j - x.j) * {_S['step']} <= {_S['ld_window']} group by 1, 2),
linked as (select distinct j2 as j from s where coalesce((n * xy - x * y) * (n * xy - x * y) / nullif((n * xx - x * x) * (n * yy - y * y), 0), 0) > {_S['max_r2']}::double),
markers as (select a.*, coalesce(alone, case when l.j is not null then 'linked' end, 'keep') as verdict from a left join linked l on a.j = l.j)
select 'samples' as part, i, null::int as block, null::int as j, null::bigint as bp, null::int as d, null::bigint as n_calls, n_missing, round(missingness, 8) as missingness, null::double as maf, null::double as heterozygosity, null::double as hwe_chi2, verdict from samples
union all select 'markers', null, j // {_S['block']}, j, cast(j as bigint) * {_S['step']}, null, n_calls, n_missing, null, round(maf, 8), round(heterozygosity, 8), round(hwe_chi2, 4), verdict from markers
union all select 'calls', k.i, k.j // {_S['block']}, k.j, null, k.d, null, null, null, null, null, null, null from k join markers m on k.j = m.j and m.verdict = 'keep'
"""


def job2_text_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of all documents; the second run finds no new files."""
    out = f"{shared_folder(spark)}/text-manifest-{uuid.uuid4().hex}"
    for _ in range(2):
        text_manifest.run(spark, f"{sf}/documents.parquet", out, f"{out}/checkpoint", common.settings("text_manifest"))
    return text_manifest.entries(spark, out).select("key", "part", "bytes", "lines", "sha256", "crlf_sha256", "status", "oversized", "batch")


JOB2_SQL = f"""
with d as (select doc_id as key, coalesce(source, 'none') as part, coalesce(text, '') as t from documents)
select key, part, strlen(t) as bytes, length(t) - length(replace(t, chr(10), '')) as lines, sha256(t) as sha256,
  sha256(replace(replace(t, chr(13) || chr(10), chr(10)), chr(10), chr(13) || chr(10))) as crlf_sha256, 'new' as status,
  strlen(t) >= {common.settings('text_manifest')['max_bytes']} as oversized, cast(0 as bigint) as batch from d
"""

QUERIES = {f.__name__: f for f in (job1_panel_qc, job2_text_manifest)}
SQL = {"job1_panel_qc": JOB1_SQL, "job2_text_manifest": JOB2_SQL}
