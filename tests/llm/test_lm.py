import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelweave.functions.shared import written
from panelweave.llm import lm
from panelweave.llm.lm_queries import op11_lm_scoring

SPLIT = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [w for w in (text or "").translate(SPLIT).encode().split()] + [lm.END]


def sample(n=400, seed=3):
    rng = np.random.default_rng(seed)
    parts = ["an", "er", "the", "in", "é", "日", "x", "ing", "zz"]
    words = sorted({"".join(rng.choice(parts, rng.integers(1, 6))).encode() for _ in range(n)} | {b"q" * 60, b"q" * 60 + b"r", lm.END})
    return words, rng.integers(0, 50, len(words))


def test_prefix_counts_are_those_of_all_sharers():
    words, c = sample()
    got = lm.Words(pa.array(words, pa.binary()), c).prefix_counts(2)
    bits = ["".join(f"{b:08b}" for b in w + b" ") for w in words]
    want = []
    for w in bits:
        for d in range(min(len(w), lm.PREFIX * 8) + 1):
            want.append(-1 if d < 16 else sum(n for o, n in zip(bits, c) if o[:d] == w[:d]))
    assert got.tolist() == want


def test_slots_count_the_bits_after_each_context():
    words, c = sample(60)
    w = lm.Words(pa.array(words, pa.binary()), c)
    seen = [defaultdict(set) for _ in lm.SLOT_BITS]
    flat = [(b" " + x + b" ", p + 1, j) for x in words for p in range(len(x) + 1) for j in range(8)]
    for k, slot in enumerate(w.slots()):
        for (text, p, j), s in zip(flat, slot.tolist()):
            seen[k][s].add((text[max(0, p - k - 1) : p].rjust(k + 1, b"\0"), text[p] >> (8 - j), j))
            assert lm.SLOTS[k] <= s < lm.SLOTS[k + 1]
        assert max(map(len, seen[k].values())) <= 2  # two contexts in one slot are rare


def model_of(words, c):
    w = lm.Words(pa.array(words, pa.binary()), c)
    tables = np.zeros((lm.SLOTS[-1], 2), np.float32)
    for slot in w.slots():
        np.add.at(tables, (slot, w.bits()), np.repeat(w.count, np.diff(w.ends) * 8))
    m = lm.ContextModel(lm.coded(tables), 4, np.full((lm.GATES, lm.INPUTS), lm.START))
    return m, w


def test_learning_lowers_the_cost_and_probabilities_sum_to_one():
    words, c = sample()
    m, w = model_of(words, c)
    counts = w.prefix_counts(4)
    before = (c * m.log10(w, counts)).sum()
    curve, hits = np.tile(lm.DAMP * np.eye(lm.INPUTS), (lm.GATES, 1, 1)), np.zeros((256 * lm.CELLS, 2))
    m.learn_all(w, counts, curve, hits)
    after = m.log10(w, counts)
    assert (c * after).sum() > before and np.isfinite(after).all()
    assert (10.0**after).sum() < 1
    # all words of one byte and all longer ones by their first byte: nothing is left out
    firsts = [bytes([a]) for a in range(256) if a != 32]
    every = sorted(firsts)
    f = lm.Words(pa.array(every, pa.binary()), np.zeros(len(every), int))
    x, gate, bit, _ = m.inputs(f, f.prefix_counts(4))
    p = 1 / (1 + np.exp(-m.mixed(x, gate)))
    cost = np.where(bit, p, 1 - p)
    first_byte = np.array([cost[i * 8 : i * 8 + 8].prod() for i in f.ends[:-1]])
    assert 0.9 < first_byte.sum() <= 1 + 1e-9


def test_words_of_a_probability_table_share_what_is_known():
    rng = np.random.default_rng(1)
    c = np.array([5, 0, 3, 1, 0])
    by_group = np.array([[5, 0], [0, 0], [1, 2], [0, 1], [0, 0]])
    p = rng.dirichlet(np.ones(6))[:5]
    known = p[c > 0].sum()
    got = 10.0 ** lm.expert_scores(c, by_group, np.log10(p), by_group.sum(0), (by_group > 0).sum(0), known)
    assert got.shape == (3, 5) and np.allclose(got.sum(axis=1), p.sum())


def test_document_scores_against_a_plain_loop():
    rng = np.random.default_rng(2)
    experts = np.log10(rng.dirichlet(np.ones(9), 3))
    lengths = [1, 30, 7, 200]
    codes, ends = rng.integers(0, 9, sum(lengths)), np.concatenate([[0], np.cumsum(lengths)])
    for some in (experts, experts[:1]):
        got = lm.document_scores(codes, ends, some)
        for i, j, g in zip(ends[:-1], ends[1:], got):
            share, totals, seen = np.ones(len(some)), np.ones(len(lm.STRENGTHS)), Counter()
            for t, w in enumerate(codes[i:j].tolist()):
                p = 10.0 ** some[:, w]
                q = (share * p).sum() / share.sum()
                share *= p
                totals *= [q if math.isinf(s) else (seen[w] + s * q) / (t + s) for s in lm.STRENGTHS]
                seen[w] += 1
            assert g == pytest.approx(np.log10(totals.mean()), abs=1e-9)


def test_count_codes():
    n = np.array([0, 1, 2047, 2048, 5000, 10**6, 10**13])
    assert np.allclose(lm.DECODED[lm.coded(n)], n, rtol=1e-3)


def check_rows(rows, got):
    train = Counter(w for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 10 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    want = sorted((d is None, d or 0, len(tokens(t)), sum(w in train for w in tokens(t)), sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for d, t in rows)
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score) for r in got)
    assert len(want) == len(have)
    for a, b in zip(want, have):
        assert a[:4] == b[:4] and b[4] == pytest.approx(a[4], rel=1e-9)
    for r in got:
        assert r.train_tokens == n and math.isfinite(r.score) and r.score < 0
        assert r.held_out is (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 10 == 0)


def test_query_against_plain_python(spark, sf):
    got = op11_lm_scoring(spark, sf).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check_rows(rows, got)
    assert all(0 < r.bits_per_byte < 16 for r in got)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    # the base gives every unseen word the price of one; spelling takes more, so few must be unseen
    got = op11_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").selectExpr("sum(score) / sum(n_tokens) as s", "sum(base_score) / sum(n_tokens) as b").first()
    assert got.s > got.b + 0.2


def test_odd_tables(spark, edge, nothing):
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10))
    assert lm.score_documents(nothing, fold != 0, fold == 0).count() == 0
    odd = edge.select("doc_id", "text").union(spark.createDataFrame([(None, "no id"), (None, None), (3, "A"), (3, "A"), (99, "w" * 300000), (98, "long words " * 40000)], "doc_id long, text string"))
    got = lm.score_documents(odd, fold != 0, fold == 0, F.when(F.col("doc_id") > 5, "g")).collect()
    check_rows([tuple(r) for r in odd.collect()], got)
    # nothing to learn from
    none = lm.score_documents(odd, F.lit(False), fold == 0).collect()
    assert len(none) == odd.count() and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)


def test_weights_are_fitted_on_every_word(spark, monkeypatch):
    """No bound on the words that the weights see; before, a hash chose some."""
    words, c = sample(200)
    df = written(spark.createDataFrame([(bytearray(w), int(n) + 1) for w, n in zip(words, c)], "word binary, c long").coalesce(1), "words")
    every, _ = lm.train(df)
    monkeypatch.setattr(lm, "FIT_WORDS", 1, raising=False)
    again, _ = lm.train(df)
    assert np.allclose(every.weights, again.weights) and np.allclose(every.cells, again.cells)
    assert not np.allclose(every.weights, lm.START)


def test_words_share_the_work_on_what_they_have_in_common():
    """Neighbours repeat the bytes of the word before; the scores are those of each word alone."""
    words, c = sample()
    words = sorted(words)
    m, w = model_of(words, c)
    counts = w.prefix_counts(4)
    some, of = w.distinct()
    flat = b"".join(x + b" " for x in words)
    assert len(some) < 0.6 * len(flat) and bytes(w.data[some][of]) == flat
    # one byte for each first part of up to PREFIX bytes, and all later bytes
    parts = {x[: k + 1] for x in (y + b" " for y in words) for k in range(min(len(x), lm.PREFIX))}
    assert len(some) == len(parts) + sum(max(len(x) + 1 - lm.PREFIX, 0) for x in words)
    starts = np.concatenate([[0], np.cumsum(w.entries())])
    alone = [m.log10(w.part(i, i + 1), counts[starts[i] : starts[i + 1]])[0] for i in range(len(w))]
    assert np.allclose(m.log10(w, counts), alone, rtol=1e-12)
    # a step on the tree learns what a step on every word would
    fitted = []
    for share in (True, False):
        some_model, curve, hits = model_of(words, c)[0], np.tile(lm.DAMP * np.eye(lm.INPUTS), (lm.GATES, 1, 1)), np.zeros((256 * lm.CELLS, 2))
        v = w.part(0, len(w))
        v.weight = v.count
        if not share:
            v.distinct = lambda n=len(v.data): (np.arange(n), np.arange(n))
        some_model.learn(v, counts, curve, hits)
        fitted.append((some_model.weights, hits))
    assert np.allclose(fitted[0][0], fitted[1][0]) and np.allclose(fitted[0][1], fitted[1][1])
