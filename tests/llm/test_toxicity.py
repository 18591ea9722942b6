import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelweave.llm import toxicity
from panelweave.llm.queries import op2_toxicity, table

from .conftest import DOCS, doc_rows


def test_restoring_disguises(spark, sf):
    docs = spark.createDataFrame(doc_rows(["stupid idiot moron loser worthless scum fool letter book " * 20 + "the cat sat on a mat with another dog " * 50]), DOCS)
    restore = toxicity.Restorer(toxicity.log_model(toxicity.trigram_counts(docs))).restore
    for disguise, word in [("1d10t", "idiot"), ("m0r0n", "moron"), ("stuuuupid", "stupid"), ("s c u m", "scum"), ("l-o-s-e-r", "loser"), ("w0rthl3ss", "worthless"), ("$tup!d", "stupid"), ("5cum!", "scum")]:
        assert restore(disguise) == [word], disguise


def test_long_tokens_decode_like_uncut_paths():
    rng = np.random.default_rng(5)
    model = np.log(rng.dirichlet(np.ones(toxicity.N), (toxicity.N, toxicity.N)))
    for n in (40, 96, 97, 400):
        token = "".join(rng.choice(list("abcdefgor013-.!"), n))
        best = {(0, 0): (0.0, "")}
        for options in [*toxicity.lattice(token), [(" ", 0.0)]]:
            new = {}
            for (a, b), (score, text) in best.items():
                for c, cost in options:
                    s = toxicity.SYMBOL.get(c, 1) if c.strip() else 0
                    key, value = ((b, s), score - cost + (model[a, b, s] if s or b else 0.0)) if c else ((a, b), score - cost)
                    if key not in new or value > new[key][0]:
                        new[key] = value, text + c
            best = new
        assert toxicity.decode(token, model) == " ".join(max(best.values())[1].split())


def test_no_word_is_cut_in_long_tokens(spark):
    words = ["loser", "scum", "book"]
    docs = spark.createDataFrame(doc_rows([" ".join(words * 40)]), DOCS)
    model = toxicity.log_model(toxicity.trigram_counts(docs))
    for sep in (" ", "-", "."):
        assert toxicity.decode(sep.join("".join(words * 20)), model).split() == words * 20


def test_every_disguise_reaches_the_lattice(spark):
    docs = spark.createDataFrame(doc_rows(["stupid idiot ass puss " * 20 + "the cat sat on a mat with another dog " * 50]), DOCS)
    restorer = toxicity.Restorer(toxicity.log_model(toxicity.trigram_counts(docs)))
    for word, tokens in {
        "ass": ["a$$", "@$$", "455", "(a$$)"],
        "puss": ["pu$$"],
        "idiot": ["'1diot'", '"1diot"', '"i.d.i.o.t"', "-i-d-i-o-t-", "i..d..i..o..t", "id-iot", "i/d/i/o/t", "i=d=i=o=t", "“1diot”"],
        "stupid": ["'$tupid'", '"$tupid', "st.up.id"],
    }.items():
        for token in tokens:
            words, _, at = restorer.words(pa.array([token]))
            assert [words[k] for k in at] == [word], token
    words, _, at = restorer.words(pa.array(["plain words, me@here.org!"]))
    assert [words[k] for k in at] == ["plain", "words,", "me@here.org!"]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(4)
    model = np.log(rng.dirichlet(np.ones(toxicity.N), (toxicity.N, toxicity.N)))

    def all_paths(options):
        if not options:
            return [("", 0.0)]
        return [(c + rest, cost + more) for c, cost in options[0] for rest, more in all_paths(options[1:])]

    def score(text, cost):
        a = b = 0
        total = -cost
        for c in text + " ":
            s = toxicity.SYMBOL.get(c, 1) if c != " " else 0
            total += model[a, b, s] if s or b else 0.0
            a, b = b, s
        return total

    for token in ["1d1", "a.b.c", "too0oo", "l3+", "x-y!z"]:
        best = max(all_paths(toxicity.lattice(token)), key=lambda p: score(*p))
        assert toxicity.decode(token, model) == " ".join(best[0].split())


def test_disguised_documents_score_like_plain_ones(spark):
    rng = np.random.default_rng(1)
    syllables = ["ba", "re", "mi", "to", "lu", "sen", "kor", "tal"]
    clean = [" ".join("".join(rng.choice(syllables, 3)) for _ in range(40)) for _ in range(160)]
    bad = [t + (" idiot" if k % 2 else " moron") for k, t in enumerate(clean[:60])]
    texts = clean + bad + [clean[0] + " 1d10t", clean[1] + " m o r o n", clean[2] + " iiidiiiot", clean[3] + " 12 m0re"]
    docs = spark.createDataFrame(doc_rows(texts), DOCS)
    labels = spark.createDataFrame([(k, int(160 <= k)) for k in range(220)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[k] >= 0.5) == (160 <= k) for k in range(220))
    assert all(got[k] >= 0.5 for k in (220, 221, 222)) and got[223] < 0.5


def test_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(edge, labels, F.lit(True))
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score < 0.5 for r in rows)
    assert toxicity.score(nothing, toxicity.train(nothing, labels, F.lit(True))).count() == 0
    one = spark.createDataFrame([(3, 1), (4, 1), (5, None)], "doc_id long, toxic int")
    assert all(r.score > 0.5 for r in toxicity.score(edge, toxicity.train(edge, one, F.lit(True))).collect())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = op2_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    right, all_, clean_wrong = out.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*"), F.sum(((F.col("predicted") == 1) & (F.col("toxic") == 0)).cast("int"))).first()
    assert right / all_ > 0.97 and clean_wrong / all_ < 0.01
