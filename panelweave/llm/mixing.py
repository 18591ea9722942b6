"""Mixing sources to target weights by soft membership.

A multinomial naive Bayes classifier, fitted on the labelled table, gives each
document a posterior over the domains.  A document with rate r and n tokens
adds r * n * posterior to the expected tokens of each domain.  Projected
gradient least squares finds nonnegative rates near 1 whose expected totals
match the targets.  Rates are 1 plus the sum of all steps so far, cut to their
bounds (the projection is put off to where a rate is used), so a document's rate
follows from its posterior and one number a domain.  Each step sums, over all
documents, the totals and how they would answer to a step (the curvature of the
rates within bounds); only these K + K * K numbers reach the driver, where the
gradient is scaled by the inverse of that matrix and shortened until the
least-squares objective falls.  Steps end when the totals hold.

Only DataFrame functions run: no Python on the executors.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drawn, text_key, threshold, written

BUCKETS = 4096
#: Labelled documents of each domain that the classifier is fitted on.
TRAIN_ROWS = 4000
#: Words depend on each other, so the evidence of a text of any length is the
#: mean over its words, times this.
EVIDENCE = 40.0
SPACE = "[ \\t-\\r]+"
#: Weight of staying near 1 against the targets, in units of the curvature.
RIDGE = 1e-11
#: Steps after which what is missing must have fallen by a hundredth.
STALL = 8
#: Highest rate: how often a document may be repeated.
MOST = 64.0
#: Repeats of a row that are numbered together.
CHUNK = 1 << 16
#: That weight where the targets are out of reach.
LEAST = 1e-3


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _words(text: Column) -> Column:
    """pos and w of each word; a text without words, and blanks at its ends, give an empty one."""
    return F.posexplode(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE)).alias("pos", "w")


def _doubles(values: list[float]) -> Column:
    """A constant array, one literal after folding."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def domain_posteriors(docs: DataFrame, labelled: DataFrame, per_domain: int = TRAIN_ROWS) -> tuple[DataFrame, list[str]]:
    """doc_id, h, n_tokens, repeats, p (array of posteriors) of each document,
    and the domains.

    ``labelled`` has (doc_id, domain); null domains and null doc_ids are
    unlabelled.  About ``per_domain`` rows of each domain, by a hash of doc_id
    and text, fit the classifier.  A document is a row of ``docs`` (doc_id,
    text), known by doc_id and h = ``text_key()``; ``repeats`` says how many
    rows have both, n_tokens counts the words of one.  Null and empty texts
    have no tokens and the prior as posterior, a null doc_id is a key like any
    other.  Without labelled rows there is one domain, ``all``; without rows no
    document.  Other columns are not read.
    """
    docs = docs.select("doc_id", "text", text_key().alias("h"))
    labelled = labelled.where("domain is not null and doc_id is not null").select("doc_id", F.col("domain").cast("string")).distinct()
    sizes = {r[0]: r[1] for r in labelled.groupBy("domain").count().collect()}
    domains = sorted(sizes) or ["all"]

    def most(of: dict[str, int]) -> Column:
        out = F.lit(0).cast("long")
        for d in of:
            out = F.when(F.col("domain") == d, F.lit(threshold(per_domain / of[d]))).otherwise(out)
        return out

    every = sum(sizes.values())
    weights, prior = [[0.0] * BUCKETS for _ in domains], [0.0] * len(domains)
    if len(domains) > 1:
        marks = labelled.where(drawn(F.xxhash64("doc_id", F.lit(5))) < most(sizes))
        # the sample is bounded, so the texts need not be shuffled to meet it;
        # rows of a doc_id that has many are cut once more, by their texts
        train = docs.join(F.broadcast(marks), "doc_id")
        rows = {r[0]: r[1] for r in train.groupBy("domain").count().collect()}
        train = train.where(drawn(F.xxhash64("doc_id", "h", F.lit(7))) < most(rows))
        train = train.groupBy("doc_id", "domain", "h").agg(F.first("text").alias("text"))
        seen = {d: [0.0] * BUCKETS for d in domains}
        # at most BUCKETS rows a domain
        for r in train.select("domain", _words(F.col("text"))).where("w <> ''").groupBy("domain", _bucket(F.col("w")).alias("b")).count().collect():
            seen[r["domain"]][r["b"]] = float(r["count"])
        background = [sum(seen[d][b] for d in domains) + 0.5 for b in range(BUCKETS)]
        total = sum(background)
        for k, d in enumerate(domains):
            n = sum(seen[d])
            weights[k] = [math.log((seen[d][b] + 50 * background[b] / total) / (n + 50) / (background[b] / total)) for b in range(BUCKETS)]
            prior[k] = math.log(sizes[d] / every)
    one = F.col("w") != ""
    sums = docs.select("doc_id", "h", _words(F.col("text"))).withColumn("b", _bucket(F.col("w")) + 1).groupBy("doc_id", "h").agg(
        F.count_if(one).alias("n"),
        F.count_if(F.col("pos") == 0).alias("repeats"),
        *(F.sum(F.when(one, F.element_at(_doubles(w), F.col("b"))).otherwise(0.0)).alias(f"s{k}") for k, w in enumerate(weights)),
    )
    k = range(len(domains))
    weight = F.lit(EVIDENCE) / F.greatest(F.col("n").cast("double"), F.lit(1.0))
    sums = sums.select("doc_id", "h", (F.col("n") / F.col("repeats")).cast("long").alias("n_tokens"), "repeats", *((F.lit(prior[i]) + F.col(f"s{i}") * weight).alias(f"l{i}") for i in k))
    top = F.greatest(*(F.col(f"l{i}") for i in k)) if len(domains) > 1 else F.col("l0")
    sums = sums.select("doc_id", "h", "n_tokens", "repeats", *(F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in k))
    mass = sum((F.col(f"e{i}") for i in k if i), F.col("e0"))
    return sums.select("doc_id", "h", "n_tokens", "repeats", F.array(*(F.col(f"e{i}") / mass for i in k)).alias("p")), domains


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], tolerance: float = 1e-6, most: float = MOST) -> tuple[Column, dict[str, float]]:
    """The rate of a row of ``members`` (n_tokens, repeats, p) as a column, and
    the expected tokens of each domain under it.

    Rates lie between 0 and ``most``, as near to 1 as can be (by the squares of
    their differences, weighted by tokens), and sum(rate * n_tokens * repeats *
    p) of each domain meets its target to ``tolerance``.  ``targets`` lists
    tokens by domain; a domain that is not listed keeps its total.  Where
    targets cannot be met, what is missing is weighed against staying near 1
    (``LEAST``), and a warning names the domains.  No rows: rates of 1.
    """
    k = range(len(domains))
    tokens, q = (F.col("n_tokens") * F.col("repeats")).cast("double"), [F.col("p")[i] for i in k]

    def before(pull: np.ndarray) -> Column:
        # the numbers are data of a plan that stays the same, not code
        terms = F.zip_with("p", _doubles(pull.tolist()), lambda x, y: x * y)
        return F.lit(1.0) - F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)

    def at(pull: np.ndarray) -> Column:
        return F.least(F.lit(float(most)), F.greatest(F.lit(0.0), before(pull)))

    def measure(pull: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, curvature of the rates within bounds, and the share of the
        objective that the rates have."""
        r, z = at(pull), before(pull)
        moves = tokens * (r == z).cast("double")
        sums = [F.sum(r * tokens * q[i]) for i in k] + [F.sum(moves * q[i] * q[j]) for i in k for j in k if j <= i] + [F.sum(tokens * (r * z - r * r / 2))]
        got = [x or 0.0 for x in members.agg(*(s.alias(f"x{i}") for i, s in enumerate(sums))).first()]
        curve, rest = np.zeros((len(domains),) * 2), iter(got[len(domains) : -1])
        for i in k:
            for j in range(i + 1):
                curve[i, j] = curve[j, i] = next(rest)
        return np.array(got[: len(domains)]), curve, got[-1]

    start = np.zeros(len(domains))
    first, whole, size0 = measure(start)
    goal = np.array([float(targets.get(d, first[i])) for i, d in enumerate(domains)])
    off = lambda has: float((np.abs(has - goal) / np.maximum(goal, 1.0)).max())
    if not whole.any():
        return at(start), dict(zip(domains, first.tolist()))
    # a domain that hardly any document belongs to still has a curvature
    unit = whole + np.eye(len(domains)) * np.trace(whole) / len(domains)

    def descend(weight: float) -> tuple[np.ndarray, np.ndarray]:
        ridge = weight * unit
        worth = lambda pull, size: size + goal @ pull + pull @ ridge @ pull / 2
        pull, has, curve, now, fall = start, first, whole, worth(start, size0), []
        while off(has) > tolerance:
            fall.append(off(has))
            if len(fall) > STALL and min(fall[-STALL:]) > 0.99 * min(fall[:-STALL]):
                break  # what is missing has stopped falling
            slope = has - goal - ridge @ pull
            step = np.linalg.solve(curve + ridge, slope)
            length, gain = 1.0, float(slope @ step)
            if gain <= 1e-13 * abs(now):
                break
            while length > 1e-6:
                got, bent, size = measure(pull + length * step)
                value = worth(pull + length * step, size)
                if value <= now - 1e-4 * length * gain:
                    break
                length /= 4
            else:
                break  # no step makes the objective smaller
            pull, has, curve, now = pull + length * step, got, bent, value
        return pull, has

    pull, has = descend(RIDGE)
    if off(has) > tolerance:
        least = descend(LEAST)
        # close to the targets is better than near to 1; far from them is not
        if off(has) > 1e-3:
            pull, has = least
        warnings.warn("targets out of reach: " + ", ".join(f"{d} has {h:.6g} of {g:.6g} tokens" for d, h, g in zip(domains, has, goal) if abs(h - g) > tolerance * max(g, 1.0)), stacklevel=2)
    return at(pull), dict(zip(domains, has.tolist()))


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], anchor: str, anchor_rate: float = 1.0, most: float = MOST) -> tuple[DataFrame, list[str]]:
    """doc_id, h, n_tokens, repeats, p, rate for target ``weights`` (shares by
    domain), and the domains; see ``domain_posteriors`` for the rows.

    The token budget is the largest that repeats the ``anchor`` domain
    ``anchor_rate`` times.  Weights of domains without labelled rows are left
    out and the rest is scaled; without the anchor among the domains the budget
    is the corpus.  Domains without a weight get none of the tokens.  No document
    is taken more than ``most`` times.  Null and empty texts have the rate of the
    prior.
    """
    members, domains = domain_posteriors(docs, labelled)
    members = written(members, "posteriors")
    known = {d: float(weights.get(d, 0.0)) for d in domains}
    scale = sum(known.values())
    if not scale:
        return members.withColumn("rate", F.lit(1.0)), domains
    has = members.agg(*(F.coalesce(F.sum(F.col("n_tokens") * F.col("repeats") * F.col("p")[k]), F.lit(0.0)) for k in range(len(domains)))).first()
    budget = has[domains.index(anchor)] * anchor_rate / (known[anchor] / scale) if known.get(anchor) else sum(has)
    rate, _ = fit_rates(members, domains, {d: budget * w / scale for d, w in known.items()}, most=most)
    return members.withColumn("rate", rate), domains


def each_row(rates: DataFrame) -> DataFrame:
    """``rates`` with a row for each of a row's ``repeats``: numbered by chunks,
    so that no array holds more than ``CHUNK`` of them however often a row repeats."""
    chunks = rates.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("repeats") - 1) / CHUNK))))
    size = F.least(F.lit(CHUNK).cast("long"), F.col("repeats") - F.col("chunk") * CHUNK)
    return chunks.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("chunk", "row")


def copies(rate: Column, *key: Column) -> Column:
    """How often a document is taken: its rate, rounded at random by a hash of its key."""
    u = F.pmod(F.xxhash64(*key, F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("int")
