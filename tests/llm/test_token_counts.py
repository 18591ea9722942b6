import re
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

from panelweave.llm import token_counts
from panelweave.llm.queries import op4_token_counts, tokenizer_file

COUNTS = "source string, lang string, tokenizer string, n long"


def test_batches_apply_once_and_add_up(spark):
    r = token_counts.TokenRollup(spark)
    assert r.totals().count() == 0 and r.version() == 0
    a = spark.createDataFrame([("s", "en", "t1", 5), ("s", "en", "t1", 7), (None, None, "t1", 2), ("s", "de", "t1", None)], COUNTS)
    assert r.apply("one", token_counts.inserts(a))
    assert not r.apply("one", token_counts.inserts(a))
    gone = spark.createDataFrame([("s", "en", "t1", 5)], COUNTS)
    assert r.apply("two", token_counts.deletes(gone))
    assert r.apply("three", token_counts.revisions(spark.createDataFrame([("s", "en", "t1", 7, 9)], "source string, lang string, tokenizer string, old long, new long")))
    got = {tuple(x) for x in r.totals().collect()}
    assert got == {("s", "en", "t1", 1, 9), (None, None, "t1", 1, 2), ("s", "de", "t1", 1, 0)}
    assert r.applied() == ["one", "two", "three"]
    # a group whose documents are all gone has no row
    assert r.apply("four", token_counts.deletes(spark.createDataFrame([("s", "en", "t1", 9)], COUNTS)))
    assert r.totals().where("lang = 'en'").count() == 0
    assert r.apply("empty", token_counts.inserts(spark.createDataFrame([], COUNTS))) and r.totals().count() == 2


def test_a_dead_commit_leaves_the_former_version(spark, monkeypatch):
    r = token_counts.TokenRollup(spark)
    a = spark.createDataFrame([("s", "en", "t1", 5)], COUNTS)
    r.apply("one", token_counts.inserts(a))
    bad = a.selectExpr("source", "lang", "tokenizer", "1L as docs", "cast(raise_error('lost') as long) as tokens")
    with pytest.raises(Exception, match="lost"):
        r.apply("two", bad)
    assert r.version() == 1 and r.totals().first().n_tokens == 5
    assert token_counts.TokenRollup(spark, r.path).apply("two", token_counts.inserts(a)) and r.totals().first().n_tokens == 10


def counted(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_query_counts_ids_of_the_tokenizer(spark, sf):
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    low = {r[0] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    want = defaultdict(lambda: [0, 0])
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r.doc_id in low:
            continue
        text = re.sub("[ \t]{2,}", " ", r.text or "")
        for version, n in (("word_bpe_49k", counted(tokenizer, text)), ("bytes", len(text.encode()))):
            sums = want[r.source, r.lang, version]
            sums[0] += 1
            sums[1] += n
    got = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in op4_token_counts(spark, sf).collect()}
    assert got == dict(want)


def one(spark, tokens, docs=1):
    return spark.createDataFrame([("s", "en", "t1", docs, tokens)], token_counts.DELTA)


def totals(r):
    return [(x.n_docs, x.n_tokens) for x in r.totals().collect()]


def test_a_second_writer_at_any_moment_loses_nothing(spark, monkeypatch):
    # between every two steps of one writer another one commits a batch of its own
    first = token_counts.TokenRollup(spark)
    other, raced = token_counts.TokenRollup(spark, first.path), []
    look = token_counts.TokenRollup._attempts

    def late(self, name):
        if self is first and name == "A" and len(raced) < 4:
            raced.append(None)
            assert other.apply(f"B{len(raced)}", one(spark, 1000))
        return look(self, name)

    monkeypatch.setattr(token_counts.TokenRollup, "_attempts", late)
    assert first.apply("A", one(spark, 1))
    monkeypatch.undo()
    n = len(raced)
    assert n >= 2 and totals(first) == totals(other) == [(n + 1, 1000 * n + 1)]
    assert not other.apply("A", one(spark, 1)) and sorted(first.applied()) == ["A", *(f"B{k + 1}" for k in range(n))]


def test_two_writers_of_one_batch(spark, monkeypatch):
    first = token_counts.TokenRollup(spark)
    other, raced = token_counts.TokenRollup(spark, first.path), []
    look = token_counts.TokenRollup._attempts

    def late(self, name):
        if self is first and not raced:
            found = look(self, name)  # nothing yet
            raced.append(other.apply("A", one(spark, 5)))
            return found
        return look(self, name)

    monkeypatch.setattr(token_counts.TokenRollup, "_attempts", late)
    assert not first.apply("A", one(spark, 5)) and raced == [True]
    assert totals(first) == [(1, 5)] and first.version() == 1


def test_a_dead_writer_is_not_waited_for(spark):
    r = token_counts.TokenRollup(spark)
    r.apply("one", one(spark, 5))
    # files without a mark, as a writer leaves them that died before its commit
    one(spark, 77).selectExpr("source", "lang", "tokenizer", "docs as n_docs", "tokens as n_tokens").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{r.path}/batches/two/dead")
    assert totals(r) == [(1, 5)] and r.applied() == ["one"]
    assert r.apply("two", one(spark, 2)) and totals(r) == [(2, 7)]


def test_compaction_changes_nothing(spark):
    r = token_counts.TokenRollup(spark)
    r.compact()
    for k in range(3):
        r.apply(f"b/{k} %", one(spark, 10**k))
    r.compact()
    assert totals(r) == [(3, 111)]
    r.apply("more", one(spark, 5))
    assert totals(r) == [(4, 116)] and not r.apply("b/1 %", one(spark, 10))
    r.compact()
    assert totals(r) == [(4, 116)] and r.applied() == ["b/0 %", "b/1 %", "b/2 %", "more"]
    with pytest.raises(ValueError):
        r.apply("x" * 300, one(spark, 1))


def test_very_large_amounts_and_clashing_columns(spark):
    r = token_counts.TokenRollup(spark)
    rows = [("s", "en", "t1", 1, 2**61, 9, 9, "x"), ("s", "en", "t1", None, -(2**61) + 3, 9, 9, "x")]
    r.apply("a", spark.createDataFrame(rows, token_counts.DELTA + ", n_docs long, n_tokens long, batch string"))
    assert totals(r) == [(1, 3)]
