"""Samples stay within their bounds however large the table is said to be."""

from pyspark.sql import functions as F

from panelweave.llm import langid, mixing
from panelweave.llm.common import drawn, threshold


def test_thresholds_of_very_small_shares(spark):
    for rows in (10**3, 10**11, 10**15):
        share = 1000 / rows
        assert abs(threshold(share) / 2**62 - min(1, share)) < 1e-6 * share
    assert threshold(1.0) == 2**62  # every draw is below it
    draws = spark.range(200_000).select(drawn(F.xxhash64("id")).alias("d"))
    assert draws.where(f"d < 0 or d >= {2**62}").isEmpty()
    got = draws.where(F.col("d") < threshold(0.001)).count()
    assert 140 < got < 270


def test_labels_with_counts_of_a_huge_table(spark, monkeypatch):
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 2 = 0, 'a', 'b') as lang")
    taken = langid.sample_labelled(docs, "lang", 100, F.lit(True)).groupBy("lang").count().collect()
    assert len(taken) == 2 and all(60 < r["count"] < 150 for r in taken)
    # 10^11 rows a label: a share of 10^-9 is still a share
    class Said:
        def __getitem__(self, k):
            return ("a", 10**11, 10**12)[k]

    real = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: [Said()] if "count(1)" in self.columns else real(self))
    chosen = langid.sample_labelled(docs, "lang", 100, F.lit(True))
    monkeypatch.undo()
    assert chosen.count() <= 1


def test_bytes_of_a_sample_are_bounded(spark):
    docs = spark.range(64).selectExpr("id as doc_id", "repeat('x', 1000000) as text", "'a' as lang").withColumn("text", F.concat("text", F.col("doc_id").cast("string")))
    got = langid.sample_labelled(docs, "lang", 1000, F.lit(True), 8_000_000).agg(F.sum(F.length("text"))).first()[0]
    assert 1e6 <= got <= 2e7


def test_repeats_of_one_row_are_numbered_by_chunks(spark):
    rates = spark.createDataFrame([(1, 3 * mixing.CHUNK + 5), (2, 1), (3, mixing.CHUNK)], "doc_id long, repeats long")
    got = {r.doc_id: r["count"] for r in mixing.each_row(rates).groupBy("doc_id").count().collect()}
    assert got == {1: 3 * mixing.CHUNK + 5, 2: 1, 3: mixing.CHUNK}
