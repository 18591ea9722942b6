"""Scans of one long order against plain Python, at any number of ranges."""

import random

import pytest
from pyspark.sql import functions as F

from panelweave.operators import ordered, scans
from panelweave.plans.sequence_queries import QUERIES, SQL
from tests.oracle import assert_same, duck

PARTS = (1, 3, 40)


def rows(n=200, seed=1):
    draw = random.Random(seed)
    out = [(k, draw.randrange(50), draw.choice("aab"), draw.choice([None, 1, 2, 5])) for k in range(n)]
    draw.shuffle(out)
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "id int, t int, c string, v int")


def in_order():
    return sorted(rows(), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("parts", PARTS)
def test_sums_places_previous(table, parts):
    got = {r.id: r for r in scans.running_sums(table, ["t", "id"], parts, s=F.col("v"), n=F.lit(1)).collect()}
    was = {r.id: r.was for r in scans.previous(table, ["t", "id"], parts, was="v").collect()}
    total, before = 0, None
    for k, (i, _, _, v) in enumerate(in_order(), 1):
        total += v or 0
        assert (got[i].s, got[i].n, was[i]) == (total, k, before)
        before = v


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("column", ["c", "v"])
def test_runs(table, parts, column):
    want, at = [], 2 if column == "c" else 3
    for k, r in enumerate(in_order(), 1):
        if not want or want[-1][0] != r[at]:
            want.append([r[at], len(want) + 1, k, 0])
        want[-1][3] += 1
    assert [list(r) for r in scans.runs(table, ["t", "id"], column, parts).orderBy("run").collect()] == want


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("by", [[], ["c"]])
def test_last_known(table, parts, by):
    got = {r.id: r.k for r in scans.last_known(table, [*by, "t", "id"], "v", "k", by, parts).collect()}
    last = {}
    for i, _, c, v in in_order():
        key = c if by else None
        last[key] = v if v is not None else last.get(key)
        assert got[i] == last[key]


def test_last_known_over_ranges_without_any(spark):
    # one hot key over many ranges, told once at the start, and a key before and after it
    data = [("a", 0, 7)] + [("b", k, 1 if k == 0 else None) for k in range(300)] + [("c", k, None) for k in range(30)]
    df = spark.createDataFrame(data, "c string, t int, v int")
    got = scans.last_known(df, ["c", "t"], "v", "k", ["c"], 20).groupBy("c", "k").count().collect()
    assert sorted((r.c, r.k, r["count"]) for r in got) == [("a", 7, 1), ("b", 1, 300), ("c", None, 30)]


@pytest.mark.parametrize("parts", PARTS)
def test_as_of(spark, parts):
    draw = random.Random(3)
    # any size of gap, as no gap is unfolded
    when = lambda: draw.choice([draw.randrange(-20, 20), 2**62, -(2**62), 10**12, None])
    left = [(k, draw.choice(["x", "y", None]), when(), "same") for k in range(150)]
    right = [(draw.choice(["x", "y", "z", None]), when(), draw.randrange(9)) for _ in range(40)]
    a, b = spark.createDataFrame(left, "id int, k string, t long, match string"), spark.createDataFrame(right, "k string, t long, v int")
    got = {r.id: r for r in scans.as_of(a, b, ["k"], "t", ["v"], "id", "hit", parts).collect()}
    assert len(got) == len(left)
    for i, k, t, same in left:
        fits = [(u, v) for c, u, v in right if c == k and None not in (k, t, u) and u <= t]
        hit = got[i].hit
        assert (None if hit is None else (hit.t, hit.v)) == (max(fits) if fits else None) and got[i].match == same


def test_no_rows(spark, table):
    none = table.where("false")
    assert scans.runs(none, ["t", "id"], "c").count() == 0 and scans.running_sums(none, ["id"], n=F.lit(1)).count() == 0
    assert scans.as_of(table, none, ["c"], "t", ["v"], "id").where("match is not null").count() == 0
    assert scans.as_of(none, table, ["c"], "t", ["v"], "id").count() == 0


def test_every_range_has_a_task_of_its_own(spark, sf):
    """No window over the rows lacks the range as a key, and ranges hold few rows."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    shares = scans.in_parts(events, ["ts", "event_id"], 16).groupBy(scans.PART).count().collect()
    assert len(shares) > 8 and max(r["count"] for r in shares) < events.count() / 4
    for out in (ordered.runs(events, [], ["ts", "event_id"], "event_type"), scans.running_sums(events, ["ts", "event_id"], n=F.lit(1))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all(scans.PART in line for line in windows)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, name):
    assert_same(QUERIES[name](spark, sf), duck(sf).sql(SQL[name]))
