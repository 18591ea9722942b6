"""Counter-based uniforms: a draw depends on its coordinates only.

The mix works in integers modulo a prime below 2**31, so that every product
fits 62 bits and any SQL engine gives the same numbers.  Fifth powers permute
the residues.  No draw depends on partitioning or on the order of rows, which
makes blocks, retries and resumed runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

P = 2_147_483_647
ROUND_CONSTANTS = (12_345, 67_891, 424_243)


def with_uniforms(df: DataFrame, a: Column, b: Column, seed: int, **salts: int) -> DataFrame:
    """Add a column in [0, 1) for each ``name=salt``, drawn at coordinates (a, b)."""
    names = list(salts)
    start = {n: F.pmod(a.cast("long") * 1_000_003 + b.cast("long") * 7_919 + F.lit(s * 104_729 + seed).cast("long"), F.lit(P).cast("long")) for n, s in salts.items()}
    df = df.withColumns(start)
    for c in ROUND_CONSTANTS:
        # a projection of its own for each round: inlined, the expression
        # would grow fivefold every time
        df = df.withColumns({n: (F.col(n) * F.col(n) % P * (F.col(n) * F.col(n) % P) % P * F.col(n) % P + c) % P for n in names})
    return df.withColumns({n: F.col(n).cast("double") / P for n in names})


def mix_sql(source: str, a: str, b: str, seed: int, salts: dict[str, int], tag: str = "u") -> str:
    """The same draws as a chain of SQL common table expressions, the last named ``tag``."""
    names = list(salts)
    steps = [f"{tag}0 as (select *, " + ", ".join(f"(cast({a} as bigint) * 1000003 + cast({b} as bigint) * 7919 + {s * 104729 + seed}) % {P} as {n}" for n, s in salts.items()) + f" from {source})"]
    for k, c in enumerate(ROUND_CONSTANTS):
        steps.append(f"{tag}{k + 1} as (select * replace (" + ", ".join(f"({n} * {n} % {P} * ({n} * {n} % {P}) % {P} * {n} % {P} + {c}) % {P} as {n}" for n in names) + f") from {tag}{k})")
    steps.append(f"{tag} as (select * replace (" + ", ".join(f"cast({n} as double) / {P} as {n}" for n in names) + f") from {tag}{len(ROUND_CONSTANTS)})")
    return ",\n".join(steps)
