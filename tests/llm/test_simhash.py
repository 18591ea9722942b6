import re

import numpy as np
import pytest
import xxhash

from panelweave.llm import components, simhash
from panelweave.llm.queries import op6_simhash

from .conftest import DOCS, doc_rows
from .test_exact_dedup import UPPER


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, prints):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(ids[a]), find(ids[b])
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def check(df):
    rows = df.select("doc_id", "text").collect()
    ids, prints = [r.doc_id for r in rows], [brute_print(r.text) for r in rows]
    want = brute_groups(ids, prints)
    got = {r.doc_id: r for r in simhash.near_groups(df).collect()}
    assert {i: got[i].component_id for i in ids} == want
    assert all(got[i].fingerprint == f"{p:016x}" for i, p in zip(ids, prints))


def test_edge_cases(spark, edge, nothing):
    check(edge)
    assert simhash.near_groups(nothing).count() == 0


def test_near_copies(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    base = [" ".join(rng.choice(words, 300)) for _ in range(6)]
    texts = []
    for t in base:
        texts += [t, t.upper(), t + " extra"] + [t.replace(f"w{k} ", f"v{k} ", 1) for k in range(30)]
    check(spark.createDataFrame(doc_rows(texts), DOCS).repartition(5))


def planted(rng, n):
    """Clusters of words a few bits apart, chains of two-bit steps, lone words."""
    out = {0, 2**64 - 1}
    for _ in range(n):
        x = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        out.add(x)
        for _ in range(6):
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out)


def test_links_connect_what_brute_force_connects(spark):
    prints = planted(np.random.default_rng(9), 60)
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p, k) for k, p in enumerate(prints)], "fp long, rep long")
    links = simhash.near_links(df)
    assert all((prints[r.a] ^ prints[r.b]).bit_count() <= 2 for r in links.collect())
    got = {r.node: r.component for r in components.components(links).collect()}
    want = brute_groups(list(range(len(prints))), prints)
    assert {k: got.get(k, k) for k in want} == want
    # groups that are dealt again give the same components
    again = {r.node: r.component for r in components.components(simhash.near_links(df, split=2)).collect()}
    assert {k: again.get(k, k) for k in want} == want
    with pytest.raises(ValueError):
        simhash.near_links(df, 3)


def test_index_finds_every_pair_of_a_group():
    rng = np.random.default_rng(5)
    codes = np.array(planted(rng, 300), np.uint64)
    rank = codes.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    codes = codes[np.argsort(rank)]
    groups = np.sort(rng.integers(0, 3, len(codes)))
    groups = np.unique(groups, return_inverse=True)[1]
    index = simhash.GrayIndex(codes, groups)
    assert len(index.levels) > 3
    for limit in (0, 1, 2, 5):
        got = {(int(i), int(j)) for a, b in index.search(limit) for i, j in zip(a, b)}
        diff = np.bitwise_count(codes[:, None] ^ codes[None, :])
        want = {(i, j) for i, j in zip(*np.nonzero((diff <= limit) & (groups[:, None] == groups[None, :]))) if i < j}
        assert got == {(int(i), int(j)) for i, j in want}


def test_index_prunes():
    codes = np.arange(4096, dtype=np.uint64) << np.uint64(20)
    codes ^= codes >> np.uint64(1)  # in Gray order
    seen = []
    count = np.bitwise_count
    np.bitwise_count = lambda x: seen.append(np.size(x)) or count(x)
    try:
        list(simhash.GrayIndex(codes, np.zeros(4096, np.int64)).search(2))
    finally:
        np.bitwise_count = count
    assert sum(seen) < 4096 * 4096 / 4


def test_groups_that_span_batches(spark):
    fps = [(k << 3) for k in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(list(zip(fps, range(400))), "fp long, rep long").repartition(3)
        got = {r.node: r.component for r in components.components(simhash.near_links(df)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert got == brute_groups(list(range(400)), fps)


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1000, 1100)] + [(5, k) for k in range(10, 60)] + [(7, 7), (8, 9), (9, 8), (8, 9)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 1000 for k in range(1000, 1101)} | {5: 5} | {k: 5 for k in range(10, 60)} | {8: 8, 9: 8}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, sf, docs):
    got = {r.doc_id: r for r in op6_simhash(spark, sf).collect()}
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = brute_groups([r.doc_id for r in rows], prints)
    assert {i: got[i].component_id for i in want} == want


def test_rows_without_a_doc_id_pass_links_on(spark, monkeypatch):
    prints = spark.createDataFrame([(5, 0), (None, 3), (9, 15), (None, 1 << 40), (None, 1 << 41), (None, -1)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, words: prints)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(prints).collect()), key=str)
    want = [(5, 0, 5), (None, 3, 5), (9, 15, 5), (None, 1 << 40, 5), (None, 1 << 41, 5), (None, 2**64 - 1, None)]
    assert got == sorted(((i, f"{f:016x}", c) for i, f, c in want), key=str)
