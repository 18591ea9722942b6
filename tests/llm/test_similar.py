import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelweave.llm import similar

from .conftest import DOCS, doc_rows
from .test_exact_dedup import UPPER


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def brute_similar(texts):
    """Smallest number reachable over pairs of Jaccard similarity 0.8 or more."""
    sets, up = [brute_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 10 * min(len(sets[a]), len(sets[b])) >= 8 * max(len(sets[a]), len(sets[b])) and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(texts))]


def near_texts():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(500)]
    passage = " ".join(rng.choice(vocabulary, 40))
    out = []
    for _ in range(12):
        base = rng.choice(vocabulary, 120)
        for changes in (0, 1, 2, 3, 4, 6):
            t = base.copy()
            t[rng.choice(120, changes, replace=False)] = [f"x{rng.integers(10**6)}" for _ in range(changes)]
            out.append(" ".join(t))
        out.append(passage + " " + " ".join(rng.choice(vocabulary, 60)))
    return [*out, "two words", "two WORDS", "", None]


def roots(spark, texts):
    """Number of the smallest text in each one's group."""
    got = {r.doc_id: r.component for r in similar.similar_groups(spark.createDataFrame(doc_rows(texts), DOCS).repartition(5)).collect()}
    least = {}
    for k, c in got.items():
        least[c] = min(least.get(c, k), k)
    return [least[got[k]] if k in got else k for k in range(len(texts))]


def test_shingle_sets_are_those_of_plain_python():
    texts = [None, "", " \t", "a", "A b", "a b c d", "a b c d e", "a b c d e f", "x x x x x x x", "é b c\x0bd  e f"]
    s, ends = similar.shingle_sets(pa.array(texts))
    sets = [brute_set(t) for t in texts]
    assert np.diff(ends).tolist() == [len(x) for x in sets]
    mine = [set(s[i:j].tolist()) for i, j in zip(ends[:-1], ends[1:])]
    assert all((mine[a] & mine[b] != set()) == (sets[a] & sets[b] != set()) for a in range(len(texts)) for b in range(len(texts)))


def test_stage_removes_what_brute_force_finds(spark, sf):
    texts = near_texts()
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(doc_rows(texts), DOCS).repartition(5), sf).collect()}
    assert kept == set(brute_similar(texts)) and len(kept) < len(texts) - 24


def test_large_groups_are_dealt_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(similar, "SHINGLES", 300)
    monkeypatch.setattr(similar, "WIDE", 3)
    texts = near_texts()
    assert roots(spark, texts) == brute_similar(texts)


def test_chains_across_classes(spark):
    """Copies that reach each other only through others, on both sides of the bound."""
    rng = np.random.default_rng(8)
    texts = []
    for size in (5, 6, 9, 12, 30, 60, 100):
        t = [f"v{size}x{k}" for k in range(size)]
        for _ in range(25):
            texts.append(" ".join(t))
            t[rng.integers(size)] = f"y{rng.integers(10**9)}"
    order = rng.permutation(len(texts))
    texts = [texts[k] for k in order]
    assert roots(spark, texts) == brute_similar(texts)


def test_one_group_with_a_third_of_all_rows(spark):
    rng = np.random.default_rng(9)
    base = [f"b{k}" for k in range(80)]
    texts = []
    for k in range(900):
        t = base.copy() if k % 3 == 0 else [f"r{rng.integers(10**9)}" for _ in range(30)]
        for _ in range(int(rng.integers(0, 4))):
            t[rng.integers(len(t))] = f"e{rng.integers(10**9)}"
        texts.append(" ".join(t))
    assert roots(spark, texts) == brute_similar(texts)


def test_stage_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"]).where(F.col("doc_id").isNotNull())
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    root = brute_similar([r.text for r in rows])
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, None).collect()}
    assert kept == {rows[k].doc_id for k in set(root)}


def test_slices_of_a_batch_read_like_the_batch():
    a = pa.array(["a b", "c d", "E f G", None, "h", "i j K l m n"])
    for at in range(6):
        s, ends = similar.shingle_sets(a.slice(at))
        t, last = similar.shingle_sets(pa.array(a.to_pylist()[at:]))
        assert (ends == last).all() and (s == t).all()


def test_recall_of_planted_pairs_just_above_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.82, and others of 0.77 to 0.80 that must stay apart."""
    draw, rows, near = random.Random(5), [], []
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    while len(near) < 1500:
        changed = draw.choice([1, 2, 3, 5, 8])
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randint(40 * changed, 50 * changed) + 4)]
        other, gap = list(words), len(words) // changed
        for k in range(changed):
            other[k * gap + gap // 2] = f"x{draw.randrange(10**6)}"
        a, b = shingles(words), shingles(other)
        j = len(a & b) / len(a | b)
        if 0.77 <= j <= 0.82:
            rows += [(2 * len(near), " ".join(words)), (2 * len(near) + 1, " ".join(other))]
            near.append(j >= 0.8)
    groups = similar.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    found = {r.doc_id: r.component for r in groups.select("doc_id", "component").collect()}
    linked = [found.get(2 * k) is not None and found.get(2 * k) == found.get(2 * k + 1) for k in range(len(near))]
    assert sum(near) > 300 and linked == near
