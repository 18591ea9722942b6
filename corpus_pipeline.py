"""A corpus pipeline of five of the operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  All but the last return the columns of documents, whatever their names.
A row is known by its doc_id and the hash of its text, so rows that share a
doc_id have verdicts of their own; null doc_ids are a value like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import exact_dedup, langid, mixing, pieces, similar
from panelweave.llm.common import crc_text, fresh, scratch, text_key, written
from panelweave.llm.queries import table, tokenizer_file

#: Shares of tokens by quality; good documents are taken 1.1 times.
MIX, GOOD, REPEAT = {"good": 0.9, "poor": 0.1}, "good", 1.1


def with_verdict(docs: DataFrame, verdict: DataFrame, how: str) -> DataFrame:
    """``docs`` joined by (doc_id, h), null or not, to ``verdict``.  The merge
    join keeps the plan the same at every size: verdicts grow with the corpus,
    so they are never broadcast."""
    one, two = fresh("verdict_id", docs), fresh("verdict_h", docs)
    verdict = verdict.withColumnsRenamed({"doc_id": one, "h": two})
    on = docs["doc_id"].eqNullSafe(verdict[one]) & (text_key() == verdict[two])
    return docs.hint("merge").join(verdict.hint("merge"), on, how)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language (null or empty text, no
    letter) go; the rest, very long texts included, carries the predicted one.
    Repeated rows have the same verdict.  An empty table stays empty."""
    model = langid.train(docs, F.pmod(crc_text("doc_id"), F.lit(4)) != 2)
    found, name = langid.label(docs, model)
    return found.where(F.col(name) != langid.UNKNOWN).select(*(F.col(name).alias("lang") if c == "lang" else F.col(c) for c in docs.columns))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased; null counts as empty) the row with the
    largest doc_id stays, a null one only where there is no other.  Of rows that
    repeat both doc_id and text one stays.  Different texts of one doc_id stay."""
    groups = written(exact_dedup.exact_groups(docs, keep="max", keyed=True), "exact-groups")
    several = groups.where("group_size > 1")
    # texts that differ in case may share the doc_id: one spelling stays
    chosen = several.where("kept").groupBy("text_sha256").agg(F.min(F.struct("doc_id", "h")).alias("c"), F.count("*").alias("n"))
    chosen = written(chosen.select("c.doc_id", "c.h", "n"), "exact-kept")
    keys = several.select("doc_id", "h").distinct()
    single = chosen.where("n = 1").select("doc_id", "h")
    gone = written(keys.exceptAll(single), "exact-copies")
    rest = with_verdict(docs, gone, "left_anti")
    repeated = chosen.where("n > 1").select("doc_id", "h")
    if repeated.isEmpty():
        return rest
    # one of the rows that repeat: folded in their tasks before they meet
    one = with_verdict(docs, repeated, "left_semi").groupBy("doc_id", text_key()).agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")
    return rest.unionByName(one)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard similarity
    0.8 or more) the row with the smallest doc_id stays, a null one only where
    there is no other.  Null and blank texts are near copies of each other."""
    groups = similar.similar_groups(docs)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id")
    first = groups.groupBy("component").agg(F.min(order).alias("f")).select(F.col("f.id").alias("id"))
    gone = written(groups.join(first, "id", "left_anti").select("doc_id", "h").distinct(), "near-copies")
    return with_verdict(docs, gone, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as their rate says, rounded at random by a
    hash of the row's key.  Domains are the label table's quality; good
    documents are repeated, so none of them goes, and poor ones make up a tenth
    of the tokens.  Without labels every document is taken once."""
    labels = table(spark, sf_dir, "labels").join(docs.select("doc_id"), "doc_id", "left_semi")
    domains = labels.select("doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("domain"))
    rates, _ = mixing.mix(docs, domains, MIX, GOOD, REPEAT)
    copies, number = fresh("copies", docs), fresh("copy", docs)
    taken = written(rates.select("doc_id", "h", mixing.copies(F.col("rate"), F.col("doc_id"), F.col("h")).alias(copies)).where(F.col(copies) > 0), "taken")
    rows = with_verdict(docs, taken, "inner").withColumn(number, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return rows.select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document taken, checked by decoding.  Null and empty
    texts have no pieces; every row comes back."""
    return pieces.encode_documents(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Learned models, XXH64 and Viterbi have no SQL; tests/llm hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
