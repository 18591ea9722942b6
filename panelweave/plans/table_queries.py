"""Queries over the relational tables: phenotypes, order, sets, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import finite, key_values, recode
from ..functions.random import mix_sql
from ..operators import integrity, ordered, phenotype, sampling
from ..sources.text import parse_report
from .panel_queries import rounded
from .views import markers, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_STATS = "count(*) as total, count(x) as nonmissing, count(*) - count(x) as missing, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as sd, min(x) as minimum, max(x) as maximum"


@query(f"with v as (select 'value' as trait, event_type as population, value as x from events) select trait, population, {_STATS} from v group by 1, 2")
def trait_statistics(spark: SparkSession, sf: str) -> DataFrame:
    long = table(spark, sf, "events").select(F.lit("value").alias("trait"), F.col("event_type").alias("population"), "value")
    return rounded(phenotype.trait_statistics(long, "trait", "population"), 6)


@query(f"""with w as (select l_returnflag as population, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) as trait, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as x from lineitem),
a as (select * from w union all select 'all', trait, x from w) select population, trait, {_STATS} from a group by 1, 2""")
def trait_statistics_long(spark: SparkSession, sf: str) -> DataFrame:
    """Four traits of every line by return flag, and over all of them."""
    wide = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("population"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return rounded(phenotype.statistics_by_population(phenotype.traits_long(wide, ["population"]), "population"), 6)


@query("""with f as (select o_custkey, o_orderkey, o_orderpriority, row_number() over (partition by o_custkey order by o_orderkey) as r from orders where o_orderstatus = 'P')
select c_custkey, c_mktsegment, coalesce(cast(o_orderkey as varchar), 'NA') as o_orderkey, coalesce(o_orderpriority, 'NA') as o_orderpriority from customer left join f on c_custkey = o_custkey and r = 1""")
def pheno_align_first_match(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer with the first of its orders in one status, else NA."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    return phenotype.first_match(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), orders, "c_custkey", "o_orderkey")


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def geno_only(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return phenotype.unmatched(table(spark, sf, "customer"), orders, "c_custkey").select("c_custkey", "c_name")


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def pheno_only(spark: SparkSession, sf: str) -> DataFrame:
    some = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return phenotype.unmatched(table(spark, sf, "orders"), some, "o_custkey").select("o_orderkey", "o_custkey")


_FULL = "c as (select distinct c_custkey as k from customer), o as (select distinct o_custkey as k from orders where o_orderstatus = 'P'), f as (select c.k as a, o.k as b from c full join o on c.k = o.k)"


@query(f"with {_FULL} select count_if(a is null)::bigint as phenotype_only, count_if(b is null)::bigint as genotype_only, count_if(a is not null and b is not null)::bigint as both from f")
def id_audit(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return phenotype.id_audit(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), orders, "k")


@query("""with o as (select distinct o_orderkey as k from orders), l as (select distinct l_orderkey as k from lineitem), f as (select o.k as a, l.k as b from o full join l on o.k = l.k)
select count_if(b is null)::bigint as left_only, count_if(a is null)::bigint as right_only, count_if(a is null or b is null) = 0 as equal from f""")
def id_set_equality(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return phenotype.same_set(a, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("""with a as (select o_orderkey as k, o_orderstatus as s from orders), b as (select l_orderkey as k, max(l_linestatus) as s from lineitem group by 1)
select count_if(a.k is null or b.k is null or a.s is distinct from b.s)::bigint as differences, count_if(a.k is null or b.k is null or a.s is distinct from b.s) = 0 as identical from a full join b on a.k = b.k""")
def ordered_identity(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    b = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("s"))
    return integrity.ordered_identity(a, b, "k")


@query("select l_partkey, l_suppkey, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return phenotype.duplicate_keys(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query("""with t as (select event_type, unnest(regexp_split_to_array(props, '[^0-9A-Za-z.]+')) as token from events)
select event_type, count(*) as tokens, count(try_cast(token as double)) as numbers, sum(try_cast(token as double)) as total from t group by 1""")
def lenient_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of the property text, read as numbers where they are."""
    t = table(spark, sf, "events").select("event_type", F.explode(F.split("props", "[^0-9A-Za-z.]+")).alias("token"))
    x = phenotype.lenient_number(F.col("token"))
    return t.select("event_type", x.alias("x")).groupBy("event_type").agg(F.count("*").alias("tokens"), F.count("x").alias("numbers"), F.sum("x").alias("total"))


@query("""with q as (select event_id, epoch(ts) as x from events), k as (select cast(date_trunc('day', ts) as date) as day, epoch(date_trunc('day', ts)) as x, avg(value) as y from events group by 1, 2),
lo as (select q.event_id, q.x, k.x as x0, k.y as y0 from q asof left join k on q.x >= k.x), b as (select lo.*, k.x as x1, k.y as y1 from lo asof left join k on lo.x < k.x)
select event_id, round(case when x1 is null then y0 else y0 + (x - x0) / (x1 - x0) * (y1 - y0) end, 6) as y from b""")
def map_interpolation(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's value on the curve through the daily means."""
    events = table(spark, sf, "events")
    seconds = lambda c: F.unix_micros(c).cast("double") / 1e6
    knots = events.groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.avg("value").alias("y")).select(seconds(F.col("day").cast("timestamp")).alias("x"), "y")
    asked = events.select("event_id", seconds(F.col("ts").cast("timestamp")).alias("x"))
    return rounded(ordered.interpolate(asked, knots, []).select("event_id", "y"), 6)


@query("""with s as (select o_custkey, o_orderdate, o_totalprice - lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey) as d from orders)
select o_custkey, count_if(coalesce(d, 0) < 0)::bigint as falls, round(sum(coalesce(d, 0)), 4) as climb from s group by 1""")
def map_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Steps between a customer's successive orders."""
    o = table(spark, sf, "orders").withColumn("k", F.struct("o_orderdate", "o_orderkey"))
    s = ordered.steps(o, ["o_custkey"], "k", "o_totalprice")
    return rounded(s.groupBy("o_custkey").agg(F.count_if(F.col("step") < 0).alias("falls"), F.sum("step").alias("climb")), 4)


@query("select cast(0 as bigint) as decreases, true as monotone")
def map_monotone(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.is_monotone(markers(spark), [], "j", "morgan")


@query("select o_orderkey, cast(ceil(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) / 3e0) as int) as block from orders")
def marker_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.blocks(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3).select("o_orderkey", "block")


_RUNS = """p as (select user_id, event_type, row_number() over (partition by user_id order by ts, event_id) as place, row_number() over (partition by user_id order by ts, event_id) - row_number() over (partition by user_id, event_type order by ts, event_id) as island from events),
r as (select user_id, event_type, min(place) as start, count(*) as size from p group by user_id, event_type, island)"""


@query(f"with {_RUNS} select user_id, event_type, cast(row_number() over (partition by user_id order by start) as int) as run, cast(start as int) as start, size from r")
def event_runs(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.runs(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type")


@query(f"with {_RUNS}, b as (select *, row_number() over (partition by user_id order by size desc, start) as k from r) select user_id, event_type, cast(start as int) as start, size from b where k = 1")
def longest_runs(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.longest_runs(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type")


@query("select distinct cast(floor(1 + i.range * (n - 1) / 999e0) as bigint) as place from range(1000) i, (select count(*) as n from lineitem)")
def systematic_sample_floor(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.systematic_floor(spark, table(spark, sf, "lineitem").count(), 1000)


@query("select distinct cast(round_even(1 + i.range * (cast(n - 1 as double) / 999e0), 0) as bigint) as place from range(1000) i, (select count(*) as n from lineitem)")
def systematic_sample_round(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.systematic_round(spark, table(spark, sf, "lineitem").count(), 1000)


@query(f"with s as (select c_custkey, cast(r.range as int) as replicate from customer, range(20) r),\n{mix_sql('s', 'c_custkey', 'replicate', 77, {'u': 1})},\nk as (select replicate, c_custkey, row_number() over (partition by replicate order by u, c_custkey) as n from u) select replicate, c_custkey from k where n <= 200")
def seeded_subset(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.seeded_subsets(table(spark, sf, "customer"), "c_custkey", 200, 20, 77)


@query("select p_brand, p_type, cast(null as bigint) as n from part where p_size > 40 group by 1, 2 union all select p_brand, null, count(*) from part group by 1")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Stacked by name; columns that a side lacks are null."""
    p = table(spark, sf, "part")
    return p.where("p_size > 40").select("p_brand", "p_type").distinct().unionByName(p.groupBy("p_brand").agg(F.count("*").alias("n")), allowMissingColumns=True)


@query("select 'both' as side, k from (select c_nationkey as k from customer intersect select s_nationkey from supplier where s_acctbal > 5000) union all select 'customers', k from (select c_nationkey as k from customer except select s_nationkey from supplier where s_acctbal > 5000)")
def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    b = table(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return a.intersect(b).select(F.lit("both").alias("side"), "k").union(a.subtract(b).select(F.lit("customers").alias("side"), "k"))


@query("select p_partkey, p_brand as brand, cast(p_size as varchar) as size from part")
def report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Parts written as padded ``k=v;k=v`` text and read back."""
    text = F.concat(F.lit("brand= "), "p_brand", F.lit(" ; size="), F.lpad(F.col("p_size").cast("string"), 6, " "))
    return table(spark, sf, "part").select("p_partkey", parse_report(text).alias("m")).select("p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["size"].alias("size"))


@query("""with f as (select o_orderkey as path, sha256(o_orderpriority) as d from orders where o_orderstatus <> 'F'), r as (select o_orderkey as path, sha256(case when o_orderkey % 10 = 0 then o_orderpriority || 'x' else o_orderpriority end) as d from orders where o_orderstatus <> 'P'),
j as (select case when r.path is null then 'unlisted' when f.path is null then 'missing' when f.d = r.d then 'match' else 'differs' end as status from f full join r on f.path = r.path) select status, count(*) as files from j group by 1""")
def manifest_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Digests found against digests recorded."""
    o = table(spark, sf, "orders")
    found = o.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("path"), F.sha2("o_orderpriority", 256).alias("sha256"))
    changed = F.when(F.col("o_orderkey") % 10 == 0, F.concat("o_orderpriority", F.lit("x"))).otherwise(F.col("o_orderpriority"))
    recorded = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("path"), F.sha2(changed, 256).alias("sha256"))
    return integrity.compare_manifest(found, recorded).groupBy("status").agg(F.count("*").alias("files"))


@query("""with e as (select p_partkey as key, p_brand as expected from part), a as (select p_partkey as key, case when p_size = 7 then p_type else p_brand end as actual from part where p_size <> 9)
select e.key, expected, actual from e left join a on e.key = a.key where expected is distinct from actual""")
def record_diff(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    actual = p.where("p_size <> 9").select(F.col("p_partkey").alias("key"), F.when(F.col("p_size") == 7, F.col("p_type")).otherwise(F.col("p_brand")).alias("value"))
    return integrity.record_diff(actual, p.select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("value")))


@query("select o_orderkey, case o_orderstatus when 'F' then 'X' when 'O' then 'Y' when 'P' then 'Z' end as code from orders")
def value_recode(spark: SparkSession, sf: str) -> DataFrame:
    """Codes by a table; a status outside it would be an error."""
    return table(spark, sf, "orders").select("o_orderkey", recode(F.col("o_orderstatus"), {"F": "X", "O": "Y", "P": "Z"}).alias("code"))


@query("select event_type, 'n=' || count(*) || ';missing=' || (count(*) - count(value)) || ';users=' || count(distinct user_id) as line from events group by 1")
def trait_report(spark: SparkSession, sf: str) -> DataFrame:
    """Summary lines as key and value text."""
    s = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), (F.count("*") - F.count("value")).alias("m"), F.count_distinct("user_id").alias("u"))
    return s.select("event_type", key_values(n=F.col("n"), missing=F.col("m"), users=F.col("u")).alias("line"))


@query("with v as (select l_returnflag as f, l_tax as x from lineitem) select f, count(*) as kept, round(sum(x), 4) as total from v where isfinite(x) and x > 0 group by 1")
def finite_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Finite values only."""
    v = table(spark, sf, "lineitem").where(finite(F.col("l_tax")) & (F.col("l_tax") > 0))
    return rounded(v.groupBy(F.col("l_returnflag").alias("f")).agg(F.count("*").alias("kept"), F.sum("l_tax").alias("total")), 4)


@query("select o_custkey, sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) is not null as running, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding), 2) as total from orders")
def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Cumulative sums within a key."""
    from pyspark.sql import Window as W

    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    total = F.sum("o_totalprice").over(w.rowsBetween(W.unboundedPreceding, 0))
    return table(spark, sf, "orders").select("o_custkey", total.isNotNull().alias("running"), F.row_number().over(w).cast("long").alias("n"), F.round(total, 2).alias("total"))
