import random

from panelweave.llm import url_filter
from panelweave.llm.queries import OP3_SQL, op3_url_filter
from tests.oracle import assert_same, duck


def brute(captures, entries):
    out = {}
    for cid, url, day in captures:
        from urllib.parse import urlsplit

        host = (urlsplit(url or "").hostname or "").rstrip(".")
        found = None
        labels = host.split(".") if host else []
        for k in range(len(labels)):
            domain = ".".join(labels[k:])
            past = [e for e in entries if e[0] == domain and None not in e and day is not None and e[1] <= day]
            if past:
                last = max(e[1] for e in past)
                found = (domain, max(e[2] for e in past if e[1] == last), last)
                break
        out[cid] = found
    return out


CAPTURES = [(1, "http://a.example.com/x", 5), (2, "https://u:p@A.Example.com.:80/", 15), (3, "http://b.example.com", 9), (4, "http://b.example.com?q", 10), (5, None, 5), (6, "nonsense", 5), (7, "http://c.org/", None), (8, "http://a.example.com", 20), (9, "http://x.a.example.com#f", 16), (9, "http://x.a.example.com#f", 16)]
ENTRIES = [("a.example.com", 5, "block"), ("a.example.com", 15, "allow"), ("a.example.com", 15, "block"), ("example.com", 10, "block"), ("example.com", 30, "allow"), ("c.org", 1, "block"), (None, 1, "block"), ("a.example.com", None, "block"), ("a.example.com", 20, "allow"), ("a.example.com", 20, "allow")]


def joined(spark, ranges):
    c = spark.createDataFrame([(*r, "x") for r in CAPTURES], "capture_id long, url string, day int, domain string")
    e = spark.createDataFrame(ENTRIES, "domain string, day int, action string")
    return url_filter.temporal_list_join(c, e, ranges)


def test_against_brute_force_in_any_number_of_ranges(spark):
    want = brute(CAPTURES, ENTRIES)
    for ranges in (1, 3, 50):
        rows = joined(spark, ranges).collect()
        assert len(rows) == len(CAPTURES)
        for r in rows:
            got = None if r.matched_domain is None else (r.matched_domain, r.action, r.valid_from)
            assert got == want[r.capture_id], r


def test_empty_tables(spark):
    c = spark.createDataFrame([], "capture_id long, url string, day int")
    e = spark.createDataFrame([], "domain string, day int, action string")
    assert url_filter.temporal_list_join(c, e).count() == 0
    one = spark.createDataFrame([(1, "http://a.b", 1)], "capture_id long, url string, day int")
    assert url_filter.temporal_list_join(one, e).first().action is None


def test_rows_keep_their_own_verdict_and_columns_their_names(spark):
    rows = [(1, "http://good.com/", 400, 1, "a", 2, "m", 3, 4), (1, "http://bad.com/", 400, 1, "a", 2, "m", 3, 4), (None, "http://bad.com/", 700, 1, "a", 2, "m", 3, 4), (None, "http://bad.com/", 5, 1, "a", 2, "m", 3, 4)]
    c = spark.createDataFrame(rows, "capture_id long, url string, day int, hit int, action string, row int, matched_domain string, span int, valid_from int")
    e = spark.createDataFrame([("bad.com", 10, "block"), ("bad.com", 600, "allow")], "domain string, day int, action string")
    for ranges in (1, 20):
        out = url_filter.temporal_list_join(c, e, ranges)
        assert out.columns == [*c.columns, "matched_domain_", "action_", "valid_from_"]
        got = sorted(((r.capture_id, r.url, r.day, r.action_, r.valid_from_) for r in out.collect()), key=str)
        assert got == sorted([(1, "http://good.com/", 400, None, None), (1, "http://bad.com/", 400, "block", 10), (None, "http://bad.com/", 700, "allow", 600), (None, "http://bad.com/", 5, None, None)], key=str)


def test_one_host_with_most_captures_and_a_long_history(spark):
    c = spark.range(3000).selectExpr("id as capture_id", "if(id % 3 = 0, 'http://hot.com/', concat('http://h', id, '.org')) as url", "cast(id as int) as day")
    e = spark.range(1000).selectExpr("'hot.com' as domain", "cast(3 * id as int) as day", "if(id % 2 = 0, 'block', 'allow') as action")
    out = url_filter.temporal_list_join(c, e).where("url = 'http://hot.com/'")
    assert out.count() == 1000 and out.where("valid_from <> day or action <> if(day % 2 = 0, 'block', 'allow')").count() == 0


def test_any_day_is_a_day(spark):
    """Brute force over days from -2^62 to 2^62, none of which is unfolded."""
    draw = random.Random(4)
    days = [0, 1, -1, 10**12, 4 * 10**9, 2**62, -(2**62), 17, None]
    captures = [(k, f"http://{draw.choice(['a.hot.com', 'hot.com', 'b.org'])}/{k}", draw.choice(days)) for k in range(200)]
    entries = [(draw.choice(["hot.com", "a.hot.com", "org"]), draw.choice(days), draw.choice(["allow", "block"])) for _ in range(40)]
    c, e = spark.createDataFrame(captures, "capture_id long, url string, day long"), spark.createDataFrame(entries, "domain string, day long, action string")
    want = brute(captures, entries)
    out = url_filter.temporal_list_join(c, e)
    for r in out.collect():
        assert (None if r.matched_domain is None else (r.matched_domain, r.action, r.valid_from)) == want[r.capture_id]
    assert "sequence(0" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_domain_with_a_million_entries(spark):
    e = spark.range(1_000_000).selectExpr("'hot.com' as domain", "id * 5 as day", "if(id % 2 = 0, 'block', 'allow') as action")
    c = spark.range(2000).selectExpr("id as capture_id", "'http://www.hot.com' as url", "id * 2499 + 3 as day")
    out = url_filter.temporal_list_join(c, e, 16)
    assert out.where("valid_from = day - day % 5 and action = if((day div 5) % 2 = 0, 'block', 'allow')").count() == 2000


def test_query(spark, sf):
    assert_same(op3_url_filter(spark, sf), duck(sf).sql(OP3_SQL))
