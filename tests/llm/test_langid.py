import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from panelweave.llm import langid
from panelweave.llm.common import mix64
from panelweave.llm.queries import op7_language_id, table

from .conftest import DOCS, doc_rows


def test_edge_cases(spark, edge, nothing):
    model = langid.train(edge, F.lit(True))
    got = {r.doc_id: r for r in langid.predict(edge, model).collect()}
    assert len(got) == edge.count()
    # null, blank, and signs only
    assert {k for k, r in got.items() if r.lang_pred == "und"} == {0, 1, 2, 9}
    assert all(0 <= r.score <= 1 for r in got.values()) and got[0].score == 0
    assert langid.train(nothing, F.lit(True)) is None
    assert {r.lang_pred for r in langid.predict(edge, None).collect()} == {"und"}
    assert langid.predict(nothing, model).count() == 0
    out, name = langid.label(edge, model)
    assert name == "lang_pred_" and out.columns == [*edge.columns, name]
    assert {(r.doc_id, r[name], r.lang_pred) for r in out.collect()} == {(k, r.lang_pred, "zz") for k, r in got.items()}


def test_languages_within_and_outside_families(spark):
    words = {"nl": "het een niet dat zijn ook maar", "de": "das eine nicht dass sein auch aber", "es": "que los las una pero como", "it": "che gli una per come sono", "xx": "qoq zizi wawa kuku"}
    texts, langs = [], []
    for k in range(200):
        for lang, w in words.items():
            w = w.split()
            texts.append(" ".join(w[(k * 7 + i * 3 + i * i) % len(w)] for i in range(12)))
            langs.append(lang)
    df = spark.createDataFrame(doc_rows(texts, langs), DOCS)
    model = langid.train(df, F.col("doc_id") % 7 != 0)
    assert {f for f in model.families} == {"germanic", "romance", "xx"} and len(model.pairs) == 2
    got = langid.predict(df, model).join(df.select("doc_id", "lang"), "doc_id").where("doc_id % 7 = 0")
    assert got.where("lang <> lang_pred").count() <= 0.02 * got.count()


def test_held_out_accuracy_and_inputs(spark):
    sf = "/root/testdata/sf0.1"
    out = op7_language_id(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98


def test_languages_with_few_rows_in_their_own_scripts(spark):
    big = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text", "lang")
    letters = {"ka": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "hy": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրց"}
    rows = []
    for lang, abc in letters.items():
        for k in range(60):
            text = " ".join("".join(abc[(k * 7 + w * 5 + i * i * (w % 4 + 1)) % 33] for i in range(3 + (k + w) % 5)) for w in range(25))
            rows.append((10**7 + 2 * k + (lang == "hy"), text, lang))
    small = spark.createDataFrame(rows, big.schema)
    model = langid.train(big.union(small), F.col("doc_id") < 10**7 + 60)
    got = langid.predict(small.where(F.col("doc_id") >= 10**7 + 60), model).join(small, "doc_id").collect()
    assert len(got) == 60 and all(r.lang_pred == r.lang for r in got)
    # no n-gram is left to chance hits of buckets that other languages fill
    for lang in letters:
        words = pa.array(sorted({w for i, t, name in rows if name == lang and i < 10**7 + 60 for w in t.split()}))
        assert (model.weights[langid.word_ngrams(words)[0]] != 0).any(axis=1).all()


def plain_guess(model, text):
    """Margins of a text, n-gram by n-gram."""
    total, size = np.zeros(model.weights.shape[1]), 0
    for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        if not regex.search(r"\p{L}", w):
            continue
        data = (" " + w.lower() + " ").encode()
        for n in range(1, 5):
            for k in range(len(data) - n + 1):
                code = 0
                for c in data[k : k + n]:
                    code = code * 257 + c + 1
                total += model.weights[int(mix64(np.array([(code + (n << 40)) % 2**64], np.uint64))[0]) % langid.BUCKETS]
                size += 1
    if not size:
        return langid.UNKNOWN
    m = total / size + model.bias
    family = int(np.argmax(m[: len(model.families)]))
    wins = {x: [0, 0.0] for x in model.members[family]}
    for p, (f, a, b) in enumerate(model.pairs):
        if f == family:
            v = m[len(model.families) + p]
            wins[a if v >= 0 else b][0] += 1
            wins[a][1] += v
            wins[b][1] -= v
    return max(wins, key=lambda x: wins[x])


def test_against_plain_python(spark, edge, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, F.lit(True))
    rows = docs.union(edge.select("doc_id", "text", "lang")).collect()
    rows = [r for r in rows if len(r.text or "") < 3000]
    monkeypatch.setattr(langid, "WORD_BYTES", 50)
    monkeypatch.setattr(langid, "WORDS", 7)
    lang, _ = langid._guess(model, pa.array([r.text for r in rows]))
    assert lang.tolist() == [plain_guess(model, r.text) for r in rows]


def test_svm_comes_close_to_the_widest_margin():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal([2, 2], 0.5, (40, 2)), rng.normal([-2, -2], 0.5, (40, 2))]).astype(np.float32)
    y = np.repeat([1.0, -1.0], 40)
    rows = langid.SparseRows(np.arange(0, 161, 2), np.tile([0, 1], 80), x.ravel())
    w = langid._svm(rows, y, c=1.0, rounds=400)
    w = np.array([w[0], w[1], w[-1]])
    value = lambda w: 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w[:2] + w[2])).sum()
    best = min(value(w + d) for d in rng.normal(0, 0.05, (2000, 3)))
    assert (y * (x @ w[:2] + w[2]) > 0).all() and value(w) <= 1.1 * best


def test_long_texts_are_bounded_in_memory():
    code = """
import resource, sys
import numpy as np, pyarrow as pa
from panelweave.llm import langid
from panelweave.llm.common import frugal, slices
rng = np.random.default_rng(0)
model = langid.LanguageModel(["a", "b"], [["en", "de"], ["fr", "es"]], [(0, "en", "de"), (1, "fr", "es")], rng.normal(size=(langid.BUCKETS, 4)), np.zeros(4))
abc = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
b = pa.RecordBatch.from_arrays([pa.array(["".join(rng.choice(abc, 100_000)) for _ in range(300)])], names=["text"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(len(langid._guess(model, s.column(0))[0]) for s in frugal(slices(iter([b]), 0)))
assert n == 300
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300)
    assert int(out.stdout) < 150  # MB on top of the texts themselves


def test_sample_is_bounded_by_rows(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, id, 7L) as doc_id", "if(id % 2 = 0, 'same', concat('text ', id)) as text", "'en' as lang")
    got = langid.sample_labelled(docs, "lang", 50, F.lit(True)).count()
    assert 10 < got < 100
    assert langid.sample_labelled(docs.withColumn("text", F.lit("x")).withColumn("doc_id", F.lit(7)), "lang", 50, F.lit(True)).count() <= 1
