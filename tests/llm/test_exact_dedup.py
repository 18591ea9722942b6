import hashlib

from panelweave.llm import exact_dedup
from panelweave.llm.queries import OP5_SQL, op5_exact_dedup
from tests.oracle import assert_same, duck

from .conftest import DOCS, doc_rows

UPPER = {ord("A") + k: ord("a") + k for k in range(26)}


def check(df, keep, **more):
    rows = df.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.text or "").translate(UPPER), []).append(r.doc_id)
    choose = max if keep == "max" else min
    want = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = choose(known) if known else None
        want += [(i, best, len(ids), i == best, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    got = [tuple(r) for r in exact_dedup.exact_groups(df, keep, **more).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_edge_cases(spark, edge, nothing):
    for keep in ("min", "max"):
        check(edge, keep)
        check(nothing, keep)


def test_many_runs_in_several_rounds(spark):
    texts = [f"text {k % 37}" if k % 3 else "the hot one" for k in range(900)]
    rows = doc_rows(texts)
    rows += [(None, *r[1:]) for r in rows[:4]] + rows[5:9]
    df = spark.createDataFrame(rows, DOCS).repartition(13)
    for fan in (2, 4, 16):
        check(df, "max", fan=fan, slices=3)


def test_colliding_short_hashes_are_told_apart(spark):
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    rows = [(run, 0, 7, sha(t), k, 1) for k, (run, t) in enumerate([(0, "a"), (0, "b"), (1, "a"), (2, "b"), (3, "c"), (3, "a")])]
    out = exact_dedup.merge_runs(spark.createDataFrame(rows, exact_dedup.ENTRY), 4, 2, largest=True).collect()
    assert {(bytes(r.sha), r.keep_id, r.n) for r in out} == {(sha("a"), 5, 3), (sha("b"), 3, 2), (sha("c"), 4, 1)}


def test_query(spark, sf):
    assert_same(op5_exact_dedup(spark, sf), duck(sf).sql(OP5_SQL))
