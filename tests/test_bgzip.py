"""Block-gzip text: any gzip reader reads it, an index finds its lines."""

import gzip
import json
import os

import pytest

from panelweave.functions import PanelError
from panelweave.sources import bgzip


def vcf_lines():
    head = ["##fileformat=VCFv4.2", "##x=" + "y" * 200_000, "#CHROM\tPOS\tID"]
    body = [f"{c}\t{100 * k + 1}\tid{k}\t" + "0|1\t" * (30_000 if k == 7 else 900) for c in ("1", "2", "X") for k in range(60)]
    return head + body


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('bgzip')}/v"
    df = spark.createDataFrame(list(enumerate(vcf_lines())), "n int, value string")
    bgzip.write_bgzip(df.repartition(5), "value", "n", path, 3)
    return path


def counted(monkeypatch):
    opened, got = bgzip.open_input, []

    class Counted:
        def __init__(self, path):
            self.file, self.path = opened(path), path

        def __enter__(self):
            return self

        def __exit__(self, *e):
            self.file.close()

        def __getattr__(self, name):
            return getattr(self.file, name)

        def read(self, *k):
            out = self.file.read(*k)
            if self.path.endswith(".gz"):
                got.append(len(out))
            return out

    monkeypatch.setattr(bgzip, "open_input", Counted)
    return got


def test_any_gzip_reader_reads_it(spark, folder):
    parts = json.load(open(f"{folder}/_parts.json"))
    assert len(parts) == 3
    text = b"".join(open(f"{folder}/{p[0]}", "rb").read() for p in parts)
    assert gzip.decompress(text).decode().splitlines() == vcf_lines()
    for name, size, _ in parts:
        with open(f"{folder}/{name}", "rb") as f:
            assert os.path.getsize(f.name) == size and all(len(t) <= bgzip.MEMBER for _, t in bgzip.members(f, 0))


def test_lines_come_back_with_their_numbers_from_any_ranges(spark, folder):
    want = list(enumerate(vcf_lines()))
    for step in (1 << 9, 1 << 30):
        got = bgzip.read_bgzip(spark, folder, step)
        assert [(r.line, r.value) for r in got.orderBy("line").collect()] == want
        assert got.rdd.getNumPartitions() == 3 if step > 1 << 20 else got.rdd.getNumPartitions() > 3
    row = bgzip.read_bgzip(spark, folder).where("value like 'X\t601%'").first()
    assert (row.chr, row.pos) == ("X", 601)


def test_a_region_reads_only_its_members(folder, monkeypatch):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNull, LessThanOrEqual

    got = counted(monkeypatch)

    def rows(*filters):
        got.clear()
        reader = bgzip._Reader({"path": folder})
        list(reader.pushFilters(list(filters)))
        return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()], sum(got)

    every, whole = rows()
    assert len(every) == len(vcf_lines())
    some, read = rows(EqualTo(("chr",), "2"), GreaterThanOrEqual(("pos",), 3001), LessThanOrEqual(("pos",), 3401))
    inside = [r["line"] for r in some if r["chr"] == "2" and 3001 <= r["pos"] <= 3401]
    assert inside == [r["line"] for r in every if r["chr"] == "2" and 3001 <= r["pos"] <= 3401] and len(inside) == 5
    assert len(some) < 60 and read < whole / 4
    head, read = rows(IsNull(("chr",)))
    assert {r["line"] for r in head} >= {0, 1, 2} and read < whole / 2


def test_filters_reach_the_reader_through_spark(spark, folder):
    df = bgzip.read_bgzip(spark, folder).where("chr = 'X' and pos > 5000")
    assert df.count() == 10
    assert bgzip.read_bgzip(spark, folder).where("chr is null").count() == 3


def test_files_from_elsewhere_are_indexed(spark, tmp_path):
    """Members that end in the middle of lines."""
    text = "\n".join(vcf_lines()).encode() + b"\n"
    cut = len(text) // 2
    cut = text.index(b"\n", cut) + 1
    for name, some in (("a.gz", text[:cut]), ("b.gz", text[cut:].rstrip(b"\n"))):
        with open(tmp_path / name, "wb") as f:
            for k in range(0, len(some), 7001):
                f.write(bgzip.member(some[k : k + 7001]))
            f.write(bgzip.END)
    bgzip.index_files(spark, str(tmp_path), ["a.gz", "b.gz"])
    for step in (5000, 1 << 30):
        got = bgzip.read_bgzip(spark, str(tmp_path), step)
        assert [(r.line, r.value) for r in got.orderBy("line").collect()] == list(enumerate(vcf_lines()))


def test_damage_and_other_gzip_files_are_refused(tmp_path):
    good = bgzip.member(b"some text\n")
    for bad, why in ((gzip.compress(b"x"), "block-gzip|size"), (good[:-6] + b"\0" * 6, "damaged")):
        (tmp_path / "x.gz").write_bytes(bad)
        with open(tmp_path / "x.gz", "rb") as f, pytest.raises(PanelError, match=why):
            list(bgzip.members(f, 0))


def test_no_lines(spark, tmp_path):
    df = spark.createDataFrame([], "n int, value string")
    bgzip.write_bgzip(df, "value", "n", f"{tmp_path}/e")
    assert bgzip.read_bgzip(spark, f"{tmp_path}/e").count() == 0
