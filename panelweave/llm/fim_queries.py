"""Fill-in-middle over ``documents``, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fim


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fim.transform(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    digest = lambda c: F.sha2(c, 256)
    return docs.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP12_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as x from documents),
u as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
  [cast(cast('0x' || substr(x, 8 * k + 1, 8) as ubigint) as bigint) for k in [0, 1, 2, 3]] as h from d),
c as (select doc_id, t, units, cast(len(units) as bigint) as n,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 50 then 'plain' when h[4] % 100 < 80 then 'spm' else 'psm' end as form,
  least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b from u),
p as (select *, array_to_string(units[:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from p
"""
