"""Language-model scores of ``documents``.  The mixed score has no SQL; tests
hold it, and all other columns, against plain Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lm
from .common import crc_text


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.pmod(crc_text("doc_id"), F.lit(10))
    return lm.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"), fold != 0, fold == 0, F.col("lang"))
