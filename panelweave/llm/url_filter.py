"""Temporal list join: captures against list entries in force at fetch time.

Dated entries (domain, day, action) of a blocklist become validity intervals:
an entry holds from its day until the domain's next entry.  A capture is looked
up under its host and every parent domain; of the entries in force on the day
of the fetch the one of the longest domain decides.  Captures and intervals go
through one stream sorted by domain and day, dealt by ranges of it: each capture
takes the last interval that began, so neither the length of a history nor the
width of a gap costs anything, and a domain with a third of all captures is
spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import scans
from .common import fresh, written


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port and final dot; '' if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.regexp_replace(F.lower(host), r"\.+$", "")


def domain_suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first; none for ''."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, k, n), ".")))


def validity(entries: DataFrame) -> DataFrame:
    """(domain, day, action) to (domain, action, valid_from, valid_to).

    valid_to is exclusive, null while the entry is still in force.  Of several
    entries of a domain on one day the last in text order holds; rows without
    domain, day or action are no entries.
    """
    day = entries.where("domain is not null and day is not null and action is not null").groupBy("domain", "day").agg(F.max("action").alias("action"))
    return day.select("domain", "action", F.col("day").alias("valid_from"), F.lead("day").over(W.partitionBy("domain").orderBy("day")).alias("valid_to"))


def temporal_list_join(captures: DataFrame, entries: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add matched_domain, action, valid_from to captures (url, day, ...).

    Every row of ``captures`` comes back once, with its own verdict, whether or
    not others share its id; null ids are no matter.  A capture without host,
    day or entry in force has nulls there.  Columns of ``captures`` keep their
    names; an added column whose name is taken gets underscores.  Empty tables
    give no rows, or no matches.  Any day that fits a long is a day.  A domain
    has at most one entry a day, so its window is bounded by the days listed.
    ``ranges`` is the number of ranges, by default that of shuffle partitions.
    """
    row, added = fresh("row", captures), [fresh(c, captures) for c in ("matched_domain", "action", "valid_from")]
    # numbered once, in a written table: a lost task cannot number rows anew
    rows = written(captures.withColumn(row, F.monotonically_increasing_id()), "captures")
    asked = rows.select(F.col(row).alias("r"), F.col("day").cast("long").alias("at"), F.explode(domain_suffixes(url_host(F.col("url")))).alias("domain")).where("at is not null")
    known = validity(entries).select("domain", F.col("valid_from").cast("long").alias("at"), "action", "valid_from", "valid_to")
    met = scans.as_of(asked, known, ["domain"], "at", ["action", "valid_from", "valid_to"], "r", "entry", ranges)
    hits = met.where("entry is not null and (entry.valid_to is null or at < entry.valid_to)").select("r", "domain", "entry.action", "entry.valid_from")
    # a row has few hits at most: one for each of its domains
    best = hits.groupBy("r").agg(F.max_by(F.struct("domain", "action", "valid_from"), F.length("domain")).alias("hit"))
    best = best.select(F.col("r").alias(row), *(F.col(f"hit.{c}").alias(a) for c, a in zip(("domain", "action", "valid_from"), added)))
    return rows.join(best, row, "left").select(*captures.columns, *added)
