"""The two jobs: on small made-up tables against plain Python, on copies of the
given tables as they grow, and from the command line."""

import hashlib
import os
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobs import common, panel_qc, text_manifest
from panelweave.plans.job_queries import QUERIES, SQL
from tests.conftest import ROOT
from tests.oracle import assert_same, duck


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, name):
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    assert_same(QUERIES[name](spark, sf), duck(sf).sql(SQL[name]))
    assert before == {k: spark.conf.get(k) for k in before}


def test_panel_without_a_released_marker(spark, tmp_path):
    """No marker passes: the calls are an empty table, which has no file."""
    rows = spark.range(40).select(F.col("id").alias("vec_id"), F.array(*(F.lit(1.0 if j else -1.0) for j in range(3))).alias("embedding"))
    rows.withColumn("label", F.lit(0)).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = QUERIES["job1_panel_qc"](spark, str(tmp_path))
    assert {(r.part, r.verdict): r["count"] for r in out.groupBy("part", "verdict").count().collect()}.keys() >= {("samples", "copy"), ("markers", "rare")}
    assert out.where("part = 'calls'").count() == 0
    con = duck_over(str(tmp_path))
    assert_same(out, con.sql(SQL["job1_panel_qc"]))


def duck_over(folder):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    return con


def test_settings():
    with pytest.raises(FileNotFoundError):
        common.settings("no_such_job")
    assert common.settings("panel_qc")["step"] == 4000


def test_unknown_settings_are_refused(tmp_path):
    path = tmp_path / "own.toml"
    path.write_text("max_maf = 1\n")
    with pytest.raises(ValueError, match="max_maf"):
        common.settings("panel_qc", str(path))


S = {"low": -0.1, "high": 0.1, "step": 4000, "block": 3, "max_sample_missing": 0.3, "min_maf": 0.1, "max_marker_missing": 0.05, "max_hwe_chi2": 30.0, "ld_window": 8000, "max_r2": 0.5}
COMPONENT = {0: -1.0, 1: 0.0, 2: 1.0, None: None}


def write_vectors(spark, path, calls):
    rows = [(k, [COMPONENT[d] for d in row]) for k, row in enumerate(calls)]
    spark.createDataFrame([*rows, (None, [1.0]), (999, None)], "vec_id long, embedding array<double>").write.mode("overwrite").parquet(path)


def panel():
    rng = np.random.default_rng(5)
    calls = rng.choice([0, 1, 2], p=[0.25, 0.5, 0.25], size=(60, 8)).tolist()
    for i, row in enumerate(calls):
        row[1] = row[0] if i % 9 else 1  # in linkage with its neighbour
        row[3] = 2 if i == 7 else 0  # rare
        row[4] = 2 * (i % 2)  # no heterozygote
        row[5] = None if i % 4 == 0 else row[5]  # missing
    calls[10] = list(calls[4])  # a copy
    calls[20] = [None] * 8
    return calls


def by_hand(calls):
    """Verdicts of samples and markers, in plain Python."""
    samples, seen = {}, {}
    for i, row in enumerate(calls):
        share = sum(d is None for d in row) / len(row)
        samples[i] = "missing" if share > S["max_sample_missing"] else "copy" if tuple(row) in seen else "keep"
        seen.setdefault(tuple(row), i)
    kept = [calls[i] for i, v in samples.items() if v == "keep"]
    markers = {}
    for j in range(len(calls[0])):
        d = [r[j] for r in kept if r[j] is not None]
        p, n = sum(d) / 2 / len(d), len(d)
        want = [(d.count(0), n * (1 - p) ** 2), (d.count(1), 2 * n * p * (1 - p)), (d.count(2), n * p * p)]
        chi2 = sum((o - e) ** 2 / e for o, e in want if e)
        markers[j] = "missing" if 1 - n / len(kept) > S["max_marker_missing"] else "rare" if min(p, 1 - p) < S["min_maf"] else "hwe" if chi2 > S["max_hwe_chi2"] else "keep"
    passing = [j for j, v in markers.items() if v == "keep"]
    for a in passing:
        for b in passing:
            if 0 < (b - a) * S["step"] <= S["ld_window"]:
                x, y = np.array([(r[a], r[b]) for r in kept]).T
                if np.corrcoef(x, y)[0, 1] ** 2 > S["max_r2"]:
                    markers[b] = "linked"
    return samples, markers


def test_panel_qc_by_hand_and_again_over_changed_input(spark, tmp_path):
    vectors, out = str(tmp_path / "v"), str(tmp_path / "out")
    calls = panel()
    write_vectors(spark, vectors, calls)

    def state():
        samples = {r.i: r.verdict for r in spark.read.parquet(f"{out}/samples").collect()}
        markers = {r.j: r.verdict for r in spark.read.parquet(f"{out}/markers").collect()}
        released = {(r.i, r.j): r.d for r in spark.read.parquet(f"{out}/calls").collect()}
        return samples, markers, released

    panel_qc.run(spark, vectors, out, S)
    samples, markers, released = state()
    assert (samples, markers) == by_hand(calls)
    assert set(samples.values()) == {"keep", "copy", "missing"} and set(markers.values()) == {"keep", "linked", "rare", "hwe", "missing"}
    assert released == {(i, j): calls[i][j] for i, v in samples.items() if v == "keep" for j, u in markers.items() if u == "keep"}
    panel_qc.run(spark, vectors, out, S)
    assert state() == (samples, markers, released)
    # a smaller panel leaves nothing of the larger one
    calls = [row[:3] for row in calls[:40]]
    write_vectors(spark, vectors, calls)
    panel_qc.run(spark, vectors, out, S)
    assert state()[:2] == by_hand(calls) and {j for _, j in state()[2]} <= {0, 1, 2}
    assert {p for p in os.listdir(f"{out}/markers") if p.startswith("block=")} == {"block=0"}


def test_panel_qc_without_rows(spark, tmp_path):
    write_vectors(spark, str(tmp_path / "v"), [])
    panel_qc.run(spark, str(tmp_path / "v"), str(tmp_path / "out"), S)
    assert spark.read.schema("i long").parquet(str(tmp_path / "out" / "calls")).count() == 0


T = {"key": "doc_id", "text": "text", "part": "source", "max_bytes": 1000, "files_per_batch": 0}


def add_file(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").coalesce(1).write.mode("append").parquet(path)


def test_text_manifest_takes_only_what_is_new(spark, tmp_path):
    texts, out, mark = str(tmp_path / "texts"), str(tmp_path / "out"), str(tmp_path / "mark")
    first = [(1, "a\nb\n", "s", 0), (2, "x", "s", 0), (3, None, None, 0), (None, "n", "t", 0), (4, "y" * 1000, "t", 0)]
    add_file(spark, texts, first)
    text_manifest.run(spark, texts, out, mark, T)
    state = lambda: sorted(map(tuple, text_manifest.entries(spark, out).collect()), key=str)
    sums = lambda: sorted(map(tuple, text_manifest.totals(spark, out).collect()), key=str)
    one = state()
    assert {r[5] for r in one} == {"new"} and len(one) == 5
    by_key = {r[0]: r for r in one}
    assert by_key[1][1:5] == (4, 2, hashlib.sha256(b"a\nb\n").hexdigest(), hashlib.sha256(b"a\r\nb\r\n").hexdigest())
    assert by_key[3][1:4] == (0, 0, hashlib.sha256(b"").hexdigest()) and by_key[3][8] == "none" and by_key[4][6] and not by_key[2][6]
    # nothing new
    text_manifest.run(spark, texts, out, mark, T)
    assert state() == one
    add_file(spark, texts, [(1, "a\r\nb\r\n", "s", 0), (2, "x", "s", 0), (4, "z", "t", 0), (5, "new", "u", 0), (None, "n", "t", 0)])
    text_manifest.run(spark, texts, out, mark, T)
    two = state()
    assert [r for r in two if r[7] == 0] == one
    assert {r[0]: r[5] for r in two if r[7] == 1} == {1: "crlf", 2: "same", 4: "changed", 5: "new", None: "new"}
    # a key is held against its last entry
    add_file(spark, texts, [(1, "a\r\nb\r\n", "s", 0), (4, "z", "t", 0)])
    text_manifest.run(spark, texts, out, mark, T)
    three = state()
    assert {r[0]: r[5] for r in three if r[7] == 2} == {1: "same", 4: "same"}
    counted = Counter((r[8], r[5], r[7]) for r in three)
    assert {(p, v, b): n for p, v, n, _, _, b in sums()} == counted
    # a batch that ran halfway is run again by the stream under its number
    again = spark.createDataFrame([(1, "a\r\nb\r\n", "s"), (4, "z", "t")], "doc_id long, text string, source string")
    text_manifest.add_batch(again, 2, out, T)
    assert state() == three and len(sums()) == len(set(sums()))


def test_text_manifest_of_growing_documents(spark, sf, tmp_path):
    texts, out, mark = str(tmp_path / "texts"), str(tmp_path / "out"), str(tmp_path / "mark")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.where("doc_id < 120").repartition(2).write.parquet(texts)
    text_manifest.run(spark, texts, out, mark, T | {"files_per_batch": 1})
    assert text_manifest.entries(spark, out).count() == 120
    docs.where("doc_id >= 120").coalesce(1).write.mode("append").parquet(texts)
    text_manifest.run(spark, texts, out, mark, T | {"files_per_batch": 1})
    got = text_manifest.entries(spark, out)
    assert got.groupBy("batch").count().count() == 3 and got.where("status <> 'new'").isEmpty()
    want = docs.select(F.col("doc_id").alias("key"), F.sha2("text", 256).alias("sha256"))
    assert got.select("key", "sha256").exceptAll(want).isEmpty() and got.count() == docs.count()
    # the additive fingerprint does not depend on how the rows came
    whole = str(tmp_path / "whole")
    text_manifest.run(spark, f"{sf}/documents.parquet", whole, str(tmp_path / "mark2"), T)
    prints = lambda p: {r[0]: r[1] for r in text_manifest.totals(spark, p).groupBy("part").agg(F.sum("fingerprint")).collect()}
    assert prints(out) == prints(whole)


def test_a_table_without_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "t"))
    text_manifest.run(spark, str(tmp_path / "t"), str(tmp_path / "o"), str(tmp_path / "m"), T)
    assert not os.path.exists(tmp_path / "o" / "entries") or text_manifest.entries(spark, str(tmp_path / "o")).count() == 0


@pytest.mark.parametrize("job", ["panel_qc", "text_manifest"])
def test_command_line(sf, tmp_path, job):
    table, own = ("embeddings", "block = 32\n") if job == "panel_qc" else ("documents", "max_bytes = 5000\n")
    (tmp_path / "own.toml").write_text(own)
    extra = [] if job == "panel_qc" else [str(tmp_path / "mark")]
    done = subprocess.run([sys.executable, "-m", f"jobs.{job}", f"{sf}/{table}.parquet", str(tmp_path / "out"), *extra, "--config", str(tmp_path / "own.toml")], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read" in done.stderr and "wrote" in done.stderr
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == (["calls", "markers", "samples"] if job == "panel_qc" else ["entries", "totals"])
