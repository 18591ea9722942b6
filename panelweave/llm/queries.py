"""The operators over the whole test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, kdtree, langid, mixing, pieces, simhash, token_counts, token_store, toxicity, url_filter
from .common import crc_text, scratch, written
from .fim_queries import OP12_SQL, op12_fill_in_middle
from .lm_queries import op11_lm_scoring


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str, end_id: int = 2) -> DataFrame:
    path = scratch(spark, "token-store")
    token_store.write_token_table(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id)
    return token_store.with_crc(token_store.read_token_table(spark, path))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(crc_text("doc_id"), F.lit(5)) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Day of a page's fetch, and of the entries that its host gets on the list.
FETCH_DAY = "cast(page_id * 37 % 365 as int)"


def host_entries(pages: DataFrame) -> DataFrame:
    """A dated list with entries for every host of ``pages`` and their domains.

    Each host is blocked, allowed and blocked again on days that follow from
    its letters; each registered domain is blocked late in the year.
    """
    hosts = pages.select(url_filter.url_host(F.col("url")).alias("host")).where("host <> ''").distinct()
    k = "length(host) * 31 + ascii(substr(host, 3, 1)) * 17 + ascii(substr(host, 6, 1)) * 7"
    days = hosts.selectExpr("host", f"cast(({k}) % 300 as int) as day", f"({k}) as k")
    own = days.selectExpr(
        "host as domain",
        "explode(array(named_struct('day', day, 'action', 'block'), named_struct('day', cast(day + 20 + k % 50 as int), 'action', 'allow'), named_struct('day', cast(day + 100 + k % 40 as int), 'action', 'block'))) as e",
    ).select("domain", "e.day", "e.action")
    parent = hosts.select(F.substring_index("host", ".", -2).alias("domain")).distinct().selectExpr("domain", "cast(330 + length(domain) % 20 as int) as day", "'block' as action")
    return own.unionByName(parent.join(own.select("domain").distinct(), "domain", "left_anti"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", F.expr(FETCH_DAY).alias("day"))
    out = url_filter.temporal_list_join(captures, written(host_entries(pages), "list"))
    return out.select(F.col("capture_id").alias("page_id"), url_filter.url_host(F.col("url")).alias("host"), F.col("day").alias("fetch_day"), "matched_domain", "valid_from", F.coalesce(F.col("action") == "block", F.lit(False)).alias("blocked"))


OP3_SQL = """
with p as (select page_id, regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)), '\\.+$', '') as host,
  cast(page_id * 37 % 365 as int) as day from pages),
h as (select distinct host, length(host) * 31 + ascii(substr(host, 3, 1)) * 17 + ascii(substr(host, 6, 1)) * 7 as k from p where host <> ''),
own as (select host as domain, k % 300 as day, 'block' as action from h
  union all select host, k % 300 + 20 + k % 50, 'allow' from h
  union all select host, k % 300 + 100 + k % 40, 'block' from h),
parent as (select distinct list_aggregate(list_slice(string_split(host, '.'), -2, -1), 'string_agg', '.') as domain from h),
entries as (select * from own union all
  select domain, 330 + length(domain) % 20, 'block' from parent where domain not in (select host from h)),
day_ as (select domain, day, max(action) as action from entries group by 1, 2),
spans as (select domain, action, day as valid_from, lead(day) over (partition by domain order by day) as valid_to from day_),
asked as (select page_id, day, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.'))) as domain from p where host <> ''),
hits as (select page_id, s.*, row_number() over (partition by page_id order by length(s.domain) desc) as r
  from asked a join spans s on a.domain = s.domain and s.valid_from <= a.day and (s.valid_to is null or a.day < s.valid_to))
select p.page_id, p.host, p.day as fetch_day, hits.domain as matched_domain, cast(hits.valid_from as int) as valid_from, coalesce(hits.action = 'block', false) as blocked
from p left join hits on p.page_id = hits.page_id and hits.r = 1
"""


def op4_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k") -> DataFrame:
    """Loads every document under a tokenizer and as bytes, takes those of low
    quality out, recounts the ones whose runs of blanks shrink to one blank, and
    delivers one batch twice.  Ids have no SQL; tests count with the library."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    path, text = tokenizer_file(f"{tokenizer}.json"), F.coalesce("text", F.lit(""))
    bare = F.regexp_replace(text, "[ \\t]{2,}", " ")
    keys = docs.select("doc_id", "source", "lang", text.alias("text"), F.octet_length(text).cast("long").alias("bytes"), F.octet_length(bare).cast("long").alias("bare_bytes"))
    counts = written(token_store.count_tokens(keys, path), "counts")
    low = labels.where("quality = 0").select("doc_id").distinct()

    def under(rows: DataFrame) -> DataFrame:
        both = F.array(F.struct(F.lit(tokenizer).alias("tokenizer"), F.col("n").alias("n")), F.struct(F.lit("bytes").alias("tokenizer"), F.col("bytes").alias("n")))
        return rows.select("source", "lang", F.explode(both).alias("c")).select("source", "lang", "c.tokenizer", "c.n")

    rollup = token_counts.TokenRollup(spark)
    rollup.apply("load", token_counts.inserts(under(counts)))
    purge = token_counts.deletes(under(counts.join(low, "doc_id", "left_semi")))
    rollup.apply("purge", purge)
    # one row for both counts of a changed text
    changed = docs.select("doc_id", "source", "lang", bare.alias("text"), text.alias("was")).where("text <> was").join(low, "doc_id", "left_anti")
    again = token_store.count_tokens(token_store.count_tokens(changed, path, "new").withColumnRenamed("was", "text"), path, "old")
    rollup.apply("recount", token_counts.revisions(again.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), "old", "new")))
    shrunk = counts.where("bytes <> bare_bytes").join(low, "doc_id", "left_anti")
    rollup.apply("shrink", token_counts.revisions(shrunk.select("source", "lang", F.lit("bytes").alias("tokenizer"), F.col("bytes").alias("old"), F.col("bare_bytes").alias("new"))))
    rollup.compact()
    rollup.apply("purge", purge)
    return rollup.totals()


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


OP5_SQL = """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_text("doc_id"), F.lit(4)) == 2
    model = langid.train(docs, ~held_out)
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")).drop("piece_ids")


def op9_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP9_SQL = """
with v as (select vec_id, [cast(floor(1024 * cast(x as double)) as double) for x in embedding] as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 10
"""

#: Shares of tokens by quality and toxicity of the label table.
MIX = {"q1t0": 0.90, "q0t0": 0.08, "q1t1": 0.01, "q0t1": 0.01}


def quality_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain: q<quality>t<toxic>, null where one is missing."""
    return labels.select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")).alias("domain"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, domains = mixing.mix(table(spark, sf_dir, "documents"), quality_domains(table(spark, sf_dir, "labels")), MIX, "q1t0", 1.1)
    rows = mixing.each_row(rates)  # a row a document
    return rows.select("doc_id", "n_tokens", *(F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(domains)), "rate")


QUERIES = {f.__name__: f for f in (op1_token_store, op2_toxicity, op3_url_filter, op4_token_counts, op5_exact_dedup, op6_simhash, op7_language_id, op8_sentencepiece, op9_kdtree, op10_mixing, op11_lm_scoring, op12_fill_in_middle)}
SQL = {"op3_url_filter": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op9_kdtree": OP9_SQL, "op12_fill_in_middle": OP12_SQL}
