"""All events as one long sequence: scans without a key, and as-of look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ordered, scans
from .views import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


ORDER = ["ts", "event_id"]


@query("select event_id, round(sum(value) over (order by ts, event_id rows unbounded preceding), 4) as total, row_number() over (order by ts, event_id) as place from events")
def sequence_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Running total and place of every event."""
    out = scans.running_sums(table(spark, sf, "events"), ORDER, total=F.col("value").cast("decimal(18,6)"), place=F.lit(1).cast("long"))
    return out.select("event_id", F.round(F.col("total").cast("double"), 4).alias("total"), "place")


@query("select event_id, round(coalesce(value - lag(value) over (order by ts, event_id), 0), 6) as step, cast(ceil(row_number() over (order by ts, event_id) / 100e0) as int) as block from events")
def sequence_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Change from the event before, and blocks of a hundred events."""
    events = table(spark, sf, "events")
    steps = ordered.steps(events.withColumn("at", F.struct(*ORDER)), [], "at", "value").select("event_id", F.round("step", 6).alias("step"))
    return steps.join(ordered.blocks(events, [], ORDER, 100).select("event_id", "block"), "event_id")


@query("""with p as (select event_type, row_number() over (order by ts, event_id) as place, row_number() over (order by ts, event_id) - row_number() over (partition by event_type order by ts, event_id) as island from events),
r as (select event_type, min(place) as start, count(*) as size from p group by event_type, island) select event_type, row_number() over (order by start) as run, start, size from r""")
def sequence_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Maximal runs of one event type over all events."""
    return ordered.runs(table(spark, sf, "events"), [], ORDER, "event_type")


@query("""with e as (select event_id, user_id, ts from events where event_type <> 'purchase'), b as (select user_id, ts, max(struct_pack(value := value, event_id := event_id)) as last from events where event_type = 'purchase' group by all)
select event_id, epoch_us(b.ts) as bought_at, last.value as value, last.event_id as bought from e asof left join b on e.user_id = b.user_id and e.ts >= b.ts""")
def last_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """For every other event its user's last purchase so far."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", "value", F.col("event_id").alias("bought"))
    met = scans.as_of(events.where("event_type <> 'purchase'"), bought, ["user_id"], "ts", ["value", "bought"], "event_id")
    return met.select("event_id", F.unix_micros(F.col("match.ts").cast("timestamp")).alias("bought_at"), F.col("match.value").alias("value"), F.col("match.bought").alias("bought"))
