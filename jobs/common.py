"""What the jobs' command lines share: settings, logging, a session."""

from __future__ import annotations

import argparse
import logging
import os
import sys
import tomllib
from collections.abc import Callable

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def settings(name: str, path: str | None = None) -> dict:
    """The settings of a job: those beside it, overridden by a file of the same keys."""
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.toml"), "rb") as f:
        known = tomllib.load(f)
    if path:
        with open(path, "rb") as f:
            own = tomllib.load(f)
        if unknown := sorted(set(own) - set(known)):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        known |= own
    return known


def main(name: str, paths: dict[str, str], job: Callable[..., object], argv: list[str] | None = None) -> int:
    """Parse paths and settings, run the job in a session of its own, stop it."""
    parser = argparse.ArgumentParser(prog=name)
    for path, text in paths.items():
        parser.add_argument(path, help=text)
    parser.add_argument("--config", help=f"TOML file with settings that differ from {name}.toml")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s", stream=sys.stderr)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        job(spark, *(getattr(args, p) for p in paths), settings(name, args.config))
    finally:
        spark.stop()
    return 0
