"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .checks import require


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a new temporary folder only where there is one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        require(spark.sparkContext.master.startswith("local"), "set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="panelweave-")
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, whatever is lost later."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_input(path: str) -> Any:
    """A file to read from, by a path with or without a scheme, in a task."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/") if path.startswith("file:") else path)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def open_output(path: str) -> Any:
    """A new file to write to, likewise; its folder is made where there is none."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        system, inner = fs.LocalFileSystem(), "/" + path[5:].lstrip("/") if path.startswith("file:") else path
    else:
        system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)
