"""Assertions on tables: one aggregate of violation counts, then an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class PanelError(ValueError):
    """A table breaks a rule of the data model."""


def require(ok: bool, message: str) -> None:
    if not ok:
        raise PanelError(message)


def require_columns(df: DataFrame, names: list[str], exact: bool = False) -> DataFrame:
    """Columns must be there; with ``exact`` those only and in that order."""
    if exact:
        require(df.columns == names, f"columns are {df.columns}, expected {names}")
    missing = [n for n in names if n not in df.columns]
    require(not missing, f"missing columns: {', '.join(missing)}")
    return df


def violations(df: DataFrame, **rules: Column) -> dict[str, int]:
    """Rows that break each rule, in one pass.  A null condition is a breach."""
    row = df.agg(*(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items())).first()
    return {name: int(row[name]) for name in rules}


def hold(df: DataFrame, **rules: Column) -> DataFrame:
    """``df`` itself, or an error that names the broken rules."""
    broken = {k: n for k, n in violations(df, **rules).items() if n}
    require(not broken, ", ".join(f"{n} rows break {k}" for k, n in broken.items()))
    return df
