import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import mixing
from panelweave.llm.queries import MIX, op10_mixing, table

from .conftest import DOCS, doc_rows


def members(spark, n, d, seed=1, alpha=0.4):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(np.full(d, alpha), n)
    tokens, repeats = rng.integers(0, 500, n), rng.integers(1, 3, n)
    df = spark.createDataFrame([(k, int(t), int(m), x.tolist()) for k, (t, m, x) in enumerate(zip(tokens, repeats, p))], "doc_id long, n_tokens long, repeats long, p array<double>")
    return df, (tokens * repeats).astype(float), p


def dykstra(tokens, p, goal, rounds=20000):
    """The nearest rates to 1 by plain projected gradient steps on one machine."""
    m = (p * tokens[:, None]).T @ p
    pull, r = np.zeros(p.shape[1]), np.ones(len(p))
    for _ in range(rounds):
        pull += np.linalg.solve(m, (r * tokens) @ p - goal)
        r = np.maximum(0, 1 - p @ pull)
    return r


def test_rates_meet_the_targets_and_stay_near_one(spark):
    for alpha in (0.4, 5.0):
        df, tokens, p = members(spark, 300, 3, alpha=alpha)
        has = tokens @ p
        for share in ([0.6, 0.3, 0.1], [0.2, 0.2, 0.6], [0.4, 0.3, 0.3], [0.25, 0.5, 0.25]):
            if alpha > 1 and min(share) < 0.15:
                continue
            goal = np.array(share) * has.sum()
            rate, totals = mixing.fit_rates(df, ["a", "b", "c"], dict(zip("abc", goal)))
            r = np.array([x[0] for x in df.orderBy("doc_id").select(rate).collect()])
            assert (r >= 0).all() and np.allclose((r * tokens) @ p, goal, rtol=1e-6) and np.allclose(list(totals.values()), goal, rtol=1e-6)
            assert np.allclose(r, dykstra(tokens, p, goal), atol=1e-3)


def test_targets_out_of_reach_give_the_least_and_a_warning(spark):
    df, tokens, p = members(spark, 300, 3, alpha=5.0)
    goal = np.array([0.9, 0.05, 0.05]) * (tokens @ p).sum()
    with pytest.warns(UserWarning, match="out of reach"):
        rate, _ = mixing.fit_rates(df, ["a", "b", "c"], dict(zip("abc", goal)))
    r = np.array([x[0] for x in df.orderBy("doc_id").select(rate).collect()])
    rest = lambda x: np.abs((x * tokens) @ p - goal).max()
    assert (r >= 0).all() and (r <= mixing.MOST).all() and rest(r) < 0.8 * rest(np.ones(300))


def test_posteriors_against_plain_python(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["Ax", "by", "ce", "do", "ed"], int(n))) for n in rng.integers(0, 60, 40)] + [None, "", " \t"]
    marks = {k: "abc"[k % 3] for k in range(40) if k % 4}
    docs = spark.createDataFrame(doc_rows(texts), DOCS)
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts]
    names = sorted({w for x in words for w in x})
    bucket = dict(zip(names, (r[0] for r in spark.createDataFrame([(w,) for w in names], "w string").select(mixing._bucket(F.col("w"))).collect())))
    seen = {d: [0.0] * mixing.BUCKETS for d in "abc"}
    for k, d in marks.items():
        for w in words[k]:
            seen[d][bucket[w]] += 1
    back = [sum(seen[d][b] for d in "abc") + 0.5 for b in range(mixing.BUCKETS)]
    out, domains = mixing.domain_posteriors(docs, spark.createDataFrame(list(marks.items()), "doc_id long, domain string"))
    assert domains == ["a", "b", "c"]
    for r in out.collect():
        x, logit = words[r.doc_id], []
        for d in "abc":
            q = [(seen[d][bucket[w]] + 50 * back[bucket[w]] / sum(back)) / (sum(seen[d]) + 50) / (back[bucket[w]] / sum(back)) for w in x]
            logit.append(math.log(list(marks.values()).count(d) / len(marks)) + (mixing.EVIDENCE * sum(map(math.log, q)) / len(x) if x else 0))
        e = np.exp(np.array(logit) - max(logit))
        assert r.n_tokens == len(x) and r.repeats == 1 and np.allclose(r.p, e / e.sum())


def test_rows_of_one_doc_id_are_documents_of_their_own(spark):
    docs = spark.createDataFrame([(5, "a b"), (5, "c"), (5, "c"), (None, "c"), (None, None), (6, None), (6, None)], "doc_id long, text string")
    out, _ = mixing.domain_posteriors(docs, spark.createDataFrame([], "doc_id long, domain string"))
    assert sorted(((r.doc_id, r.n_tokens, r.repeats) for r in out.collect()), key=str) == sorted([(5, 2, 1), (5, 1, 2), (None, 1, 1), (None, 0, 1), (6, 0, 2)], key=str)


def test_posteriors_follow_the_labels(spark):
    rng = np.random.default_rng(3)
    vocab = {"good": ["fine", "clear", "calm"], "junk": ["buy", "now", "click"]}
    texts, marks = [], []
    for k in range(200):
        d = "good" if k % 3 else "junk"
        texts.append(" ".join(rng.choice(vocab[d] + ["the", "of"], 30)))
        marks.append((k, d if k % 2 else None))
    docs = spark.createDataFrame(doc_rows(texts), DOCS)
    out, domains = mixing.domain_posteriors(docs, spark.createDataFrame(marks, "doc_id long, domain string"))
    assert domains == ["good", "junk"]
    rows = out.collect()
    assert all(abs(sum(r.p) - 1) < 1e-9 and r.n_tokens == 30 for r in rows)
    assert all((r.p[0] > 0.5) == bool(r.doc_id % 3) for r in rows)


def test_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([(5, "a"), (6, "a"), (12, "b"), (13, None), (None, "b")], "doc_id long, domain string")
    out, domains = mixing.mix(edge, labels, {"a": 0.5, "b": 0.5, "absent": 3.0}, "a")
    rows = {r.doc_id: r for r in out.collect()}
    assert domains == ["a", "b"] and len(rows) == edge.count()
    assert rows[0].n_tokens == 0 and all(r.rate >= 0 for r in rows.values())
    none = labels.limit(0)
    out, domains = mixing.mix(edge, none, {"a": 1.0}, "a")
    assert domains == ["all"] and {r.rate for r in out.collect()} == {1.0}
    assert mixing.mix(nothing, labels, {"a": 1.0}, "a")[0].count() == 0
    assert mixing.mix(nothing, none, {"a": 1.0}, "a")[0].count() == 0


def test_copies_round_rates_without_bias(spark):
    df = spark.range(20000).select("id", mixing.copies(F.lit(1.3), F.col("id")).alias("c"))
    mean, low, high = df.agg(F.avg("c"), F.min("c"), F.max("c")).first()
    assert abs(mean - 1.3) < 0.02 and (low, high) == (1, 2)
    assert spark.range(5).select(mixing.copies(F.lit(0.0), F.col("id")).alias("c")).agg(F.max("c")).first()[0] == 0


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_query_meets_its_weights_and_runs_no_python(spark, scale):
    sf = f"/root/testdata/{scale}"
    out = op10_mixing(spark, sf)
    assert not any(x in out._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
    t = out.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in MIX)).first()
    whole = sum(t[d] for d in MIX)
    assert all(abs(t[d] / whole - w) < 1e-5 for d, w in MIX.items())
    assert out.count() == table(spark, sf, "documents").count()
