"""Round trips of the file formats, and the life cycle of outputs."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from panelweave.functions import PanelError
from panelweave.operators import genotype, integrity
from panelweave.sources import plink, sinks, text
from panelweave.streaming import MarkerAccumulator, stream_marker_stats


@pytest.fixture
def panel(spark):
    n, m = 7, 11
    calls = spark.createDataFrame([(i, j, None if (i * j) % 5 == 4 else (i + j) % 3) for i in range(n) for j in range(m)], "i int, j int, d int")
    markers = spark.createDataFrame([(j, "22", f"#m{j}", -0.5 + j / 7, 100 * j, "A", "G") for j in range(m)], "j int, chr string, id string, cm double, pos long, a1 string, a2 string")
    samples = plink.default_fam(spark.createDataFrame([(i, f"s{i}") for i in range(n)], "i int, iid string"))
    return calls, markers, samples


def test_fileset_round_trip_by_two_decoders(spark, panel, tmp_path):
    calls, markers, samples = panel
    prefix = f"{tmp_path}/p"
    plink.write_fileset(prefix, calls, markers, samples)
    assert os.path.getsize(f"{prefix}.bed") == 3 + 11 * 2
    assert plink.bed_head_ok(spark, f"{prefix}.bed")
    got = plink.read_calls(spark, prefix)
    assert integrity.calls_differ(calls, got).first()[0] == 0
    small = plink.read_bed(spark, f"{prefix}.bed", 7, range_bytes=4)
    assert small.rdd.getNumPartitions() > 3
    second = genotype.long_calls(plink.read_bed_sql(spark, f"{prefix}.bed", 7))
    assert integrity.calls_differ(genotype.long_calls(small), second).first()[0] == 0
    bim, fam = plink.read_bim(spark, f"{prefix}.bim"), plink.read_fam(spark, f"{prefix}.fam")
    assert [r.id for r in bim.orderBy("j").collect()] == [f"#m{j}" for j in range(11)]
    assert bim.where("cm < 0").count() == 4
    integrity.check_fileset(fam, bim, os.path.getsize(f"{prefix}.bed"), b"\x6c\x1b\x01")
    with pytest.raises(PanelError, match="bytes"):
        integrity.check_fileset(fam.limit(3), bim, os.path.getsize(f"{prefix}.bed") + 1, b"\x6c\x1b\x01")
    keep, extract = spark.createDataFrame([(1,), (5,)], "i int"), spark.createDataFrame([(2,), (10,)], "j int")
    assert plink.read_calls(spark, prefix, keep, extract).count() == 4


def test_marker_filter_skips_byte_ranges(spark, panel, tmp_path):
    calls, markers, samples = panel
    plink.write_bed(genotype.wide_markers(calls), f"{tmp_path}/p.bed")
    all_ = plink.read_bed(spark, f"{tmp_path}/p.bed", 7, range_bytes=2)
    assert all_.rdd.getNumPartitions() == 11
    one = all_.where("j = 4")
    assert one.count() == 1 and one.rdd.getNumPartitions() == 1
    assert sorted(r.j for r in all_.where("j >= 8 and j < 10").collect()) == [8, 9]


def test_blocks_append_to_one_file(spark, panel, tmp_path):
    wide = genotype.wide_markers(panel[0])
    plink.write_bed(wide, f"{tmp_path}/whole.bed")
    plink.write_bed(wide.where("j < 6"), f"{tmp_path}/parts.bed")
    plink.write_bed(wide.where("j >= 6"), f"{tmp_path}/parts.bed", append=True)
    assert open(f"{tmp_path}/whole.bed", "rb").read() == open(f"{tmp_path}/parts.bed", "rb").read()


def test_bad_bed_is_refused(spark, tmp_path):
    open(f"{tmp_path}/x.bed", "wb").write(b"\x6c\x1b\x00\x00\x00")
    with pytest.raises(Exception, match="SNP-major"):
        plink.read_bed(spark, f"{tmp_path}/x.bed", 4).count()


def test_fam_with_tabs_or_blanks(spark, tmp_path):
    open(f"{tmp_path}/a.fam", "w").write("f1\ts1\t0\t0\t1\t-9\nf2 s2 0 0  2 1\n")
    rows = plink.read_fam(spark, f"{tmp_path}/a.fam").orderBy("i").collect()
    assert [(r.iid, r.sex, r.pheno) for r in rows] == [("s1", 1, "-9"), ("s2", 2, "1")]


def test_ped_round_trip(spark, panel, tmp_path):
    calls, _, samples = panel
    pairs = calls.select("i", "j", F.when(F.col("d").isNull(), 0).when(F.col("d") == 0, 1).when(F.col("d") == 1, 1).otherwise(2).cast("tinyint").alias("a1"), F.when(F.col("d").isNull(), 0).when(F.col("d") == 0, 1).otherwise(2).cast("tinyint").alias("a2"))
    sinks.write_lines(sinks.ped_lines(samples, pairs), "line", "i", f"{tmp_path}/ped")
    s, back = text.read_ped(spark, f"{tmp_path}/ped")
    assert integrity.pair_equivalence(pairs, back, "i", "j").first().differences == 0
    assert s.count() == 7 and text.read_ped_head(spark, f"{tmp_path}/ped").first().fid == "s0"


def test_vcf_round_trip_gzipped(spark, tmp_path):
    markers = spark.createDataFrame([(j, "22", 10 * j, f"m{j}", "A", "C") for j in range(5)], "j int, chr string, pos long, id string, ref string, alt string")
    alleles = spark.createDataFrame([(h, j, (h * j) % 2) for h in range(6) for j in range(5)], "hap int, j int, allele int")
    lines = sinks.vcf_lines(markers, alleles, ["a", "b", "c"])
    body = "\n".join(r.line for r in lines.orderBy("j").collect()) + "\n"
    with gzip.open(f"{tmp_path}/x.vcf.gz", "wt") as f:
        f.write(body)
    m, back, names = text.read_vcf(spark, f"{tmp_path}/x.vcf.gz", ["a", "b", "c"])
    assert names == ["a", "b", "c"] and m.orderBy("j").first().id == "m0"
    assert back.select("hap", "j", F.col("allele").cast("int")).exceptAll(alleles).isEmpty() and back.count() == 30
    with pytest.raises(PanelError):
        text.read_vcf(spark, f"{tmp_path}/x.vcf.gz", ["a", "c", "b"])


def test_map_ids_may_begin_with_a_hash(spark, tmp_path):
    open(f"{tmp_path}/x.map", "w").write("1 m1 0 5\n1 #m2 0 6\n")
    assert [r.id for r in text.read_map(spark, f"{tmp_path}/x.map").orderBy("j").collect()] == ["m1", "#m2"]


def test_tables_with_and_without_na(spark, tmp_path):
    open(f"{tmp_path}/p.csv", "w").write("FID,IID,T\n1,a,NA\n2,b,3\n")
    assert text.read_delimited(spark, f"{tmp_path}/p.csv", "FID string, IID string, T string", na="NA").where("T is null").count() == 1
    assert text.read_delimited(spark, f"{tmp_path}/p.csv", "FID string, IID string, T string").where("T = 'NA'").count() == 1
    with pytest.raises(Exception):
        text.read_delimited(spark, f"{tmp_path}/p.csv", "FID string, X string, T string").collect()
    open(f"{tmp_path}/t.tsv", "w").write('id\tx\ns1\t"q\n')
    assert text.read_text_table(spark, f"{tmp_path}/t.tsv").first().x == '"q'
    df = spark.createDataFrame([("a", None)], "a string, b string")
    sinks.write_csv(df, f"{tmp_path}/out", na="NA", quoted=False)
    assert "".join(r.value + "\n" for r in spark.read.text(f"{tmp_path}/out").collect()) == "a,b\na,NA\n"


def test_other_text_sources(spark, tmp_path):
    open(f"{tmp_path}/m.smiss", "w").write("#FID IID N_MISS N_GENO\n1 a 2 10\n")
    r = text.read_missingness(spark, f"{tmp_path}/m.smiss").first()
    assert (r.iid, r.missing, r.observed) == ("a", 2, 10)
    open(f"{tmp_path}/g.map", "w").write("chr bp rate cm\n22 100 0.1 0.5\n22 200 0.1 0.7\n")
    assert text.read_genetic_map(spark, f"{tmp_path}/g.map").count() == 2
    open(f"{tmp_path}/d.csv", "w").write("CHROM,ID,POS,REF,ALT\n22,x,5,A,G\n22,y,7,A,G\n")
    assert [x.POS for x in text.read_design(spark, f"{tmp_path}/d.csv").orderBy("j").collect()] == [5, 7]
    import numpy as np

    np.array([1, 2, 3], "<f4").tofile(f"{tmp_path}/k.bin")
    t = {(x.i1, x.i2): x.value for x in text.read_triangle(spark, f"{tmp_path}/k.bin", 3).collect()}
    assert t == {(1, 0): 1.0, (2, 0): 2.0, (2, 1): 3.0}
    open(f"{tmp_path}/r.txt", "w").write("title\nn= 5 \n")
    assert [(x.key, x.value) for x in text.read_report(spark, f"{tmp_path}/r.txt").orderBy("line").collect()] == [("title", None), ("n", "5")]


def test_checksums_tell_line_ends_apart(spark, tmp_path):
    open(f"{tmp_path}/a.txt", "wb").write(b"x\ny\n")
    open(f"{tmp_path}/b.txt", "wb").write(b"x\r\ny\r\n")
    found = integrity.with_crlf_digest(spark, str(tmp_path), "*.txt").cache()
    by = {r.path.rsplit("/", 1)[1]: r for r in found.collect()}
    assert by["a.txt"].crlf_sha256 == by["b.txt"].sha256 == by["b.txt"].crlf_sha256
    recorded = spark.createDataFrame([(by["a.txt"].path, by["b.txt"].sha256), (by["b.txt"].path, by["b.txt"].sha256.upper()), ("gone", "00")], "path string, sha256 string")
    status = {r.path.rsplit("/", 1)[-1]: r.status for r in integrity.compare_manifest(found, recorded).collect()}
    assert status == {"a.txt": "match_after_crlf", "b.txt": "match", "gone": "missing"}


def test_install_is_all_or_nothing(tmp_path, monkeypatch):
    s, t = tmp_path / "s", tmp_path / "t"
    s.mkdir(), t.mkdir()
    for n in "ab":
        (s / n).write_text("new" + n)
        (t / n).write_text("old" + n)
    files = {str(s / n): str(t / n) for n in "ab"}
    with pytest.raises(PanelError, match="already"):
        sinks.install(files)
    with monkeypatch.context() as m:  # the second copy is cut short
        copy = sinks.shutil.copyfile
        m.setattr(sinks.shutil, "copyfile", lambda a, b: open(b, "w").write("x") if a.endswith("b") else copy(a, b))
        with pytest.raises(PanelError, match="differs"):
            sinks.install(files, force=True)
    with pytest.raises(FileNotFoundError):
        sinks.install({**files, str(s / "missing"): str(t / "c")}, force=True)
    assert sorted(p.name for p in t.iterdir()) == ["a", "b"] and (t / "a").read_text() == "olda"
    sinks.install(files, force=True)
    assert (t / "b").read_text() == "newb" and sorted(p.name for p in t.iterdir()) == ["a", "b"]
    # what a crash set aside is never renamed onto a target
    (t / "a.replaced").write_text("older")
    with pytest.raises(PanelError, match="earlier run"):
        sinks.install(files, force=True)
    assert (t / "a").read_text() == "newa" and (t / "a.replaced").read_text() == "older"
    with pytest.raises(PanelError):
        sinks.safe_remove(str(s), str(t))


def test_blocks_resume_only_what_fits(spark, tmp_path):
    blocks = sinks.Blocks(spark, f"{tmp_path}/b")
    make = lambda b: spark.range(b).withColumn("block_no", F.lit(b))
    assert blocks.build([1, 2], make, {"seed": 1}) == [1, 2]
    assert blocks.build([1, 2, 3], make, {"seed": 1}) == [3]
    assert blocks.assemble([1, 2, 3], {"seed": 1}).count() == 6
    assert blocks.mismatches(1, {"seed": "1"}) == {"seed": ("1", 1)}
    with pytest.raises(PanelError):
        blocks.assemble([1, 2, 3], {"seed": 2})
    with pytest.raises(PanelError):
        blocks.assemble([1, 3], {"seed": 1})
    assert blocks.build([2], make, {"seed": 2}) == [2]
    sinks.replace_table(spark.range(3), f"{tmp_path}/t")
    sinks.replace_table(spark.range(4), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4


def test_stream_accumulates_blocks_once(spark, panel, tmp_path):
    calls = panel[0].withColumn("d", F.col("d").cast("tinyint"))
    calls.where("i < 3").coalesce(1).write.parquet(f"{tmp_path}/in/b1")
    stream_marker_stats(spark, f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    calls.where("i >= 3").coalesce(1).write.parquet(f"{tmp_path}/in/b2")
    stream_marker_stats(spark, f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    acc = MarkerAccumulator(spark, f"{tmp_path}/state")
    assert acc.add(calls, acc.batches()[-1]) is False
    want = genotype.marker_stats(calls).select("j", "n_calls", "n_missing", F.round("maf", 9), F.round("heterozygosity", 9))
    got = acc.stats().select("j", "n_calls", "n_missing", F.round("maf", 9), F.round("heterozygosity", 9))
    assert got.exceptAll(want).isEmpty() and got.count() == 11


def test_batches_in_any_order_by_any_writer_add_up(spark, tmp_path, monkeypatch):
    from panelweave.streaming.batches import BatchSums

    path = f"{tmp_path}/state"
    calls = lambda *d: spark.createDataFrame([(k, 0, v) for k, v in enumerate(d)], "i int, j int, d tinyint")
    first, other, raced = MarkerAccumulator(spark, path), MarkerAccumulator(spark, path), []
    look = BatchSums._attempts

    def late(self, name):
        # another writer commits a batch of its own, and then the very same batch,
        # after this one has looked and before it commits
        found = look(self, name)
        if self is first and not raced:
            raced.append((other.add(calls(2, 2), 8), other.add(calls(1, None), 7)))
        return found

    monkeypatch.setattr(BatchSums, "_attempts", late)
    assert first.add(calls(1, None), 7) is False and raced == [(True, True)]
    monkeypatch.undo()
    assert first.add(calls(0), 3) and first.batches() == [3, 7, 8]
    # a writer that died before its commit
    first.state().write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batches/9/dead")
    want = (0, 4, 5, 1, 1)
    assert [tuple(r) for r in other.state().select("j", "n", "total", "het", "missing").collect()] == [want]
    first.compact()
    assert tuple(other.state().first()) == want and other.add(calls(2), 9) and other.state().first().total == 7


def test_fetch_checks_and_unpacks(tmp_path):
    import zipfile

    from panelweave.sources import fetch

    with zipfile.ZipFile(tmp_path / "inner.zip", "w") as z:
        z.writestr("a.txt", "x")
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.write(tmp_path / "inner.zip", "d/inner.zip")
    url, size = f"file://{tmp_path}/outer.zip", os.path.getsize(tmp_path / "outer.zip")
    digest = sinks.sha256_file(f"{tmp_path}/outer.zip")
    got = fetch.fetch(url, f"{tmp_path}/got.zip", size, digest.upper())
    with pytest.raises(PanelError, match="pinned"):
        fetch.fetch(url, f"{tmp_path}/bad.zip", size + 1, digest, attempts=2, wait=0)
    assert not os.path.exists(f"{tmp_path}/bad.zip") and not os.path.exists(f"{tmp_path}/bad.zip.part")
    files = fetch.unpack(got, f"{tmp_path}/out")
    assert [os.path.basename(f) for f in files] == ["a.txt"] and open(files[0]).read() == "x"


def test_reports_records_and_codes(spark, tmp_path):
    from panelweave.functions import key_values, recode

    df = spark.createDataFrame([(0, "Male"), (1, None)], "line int, sex string")
    code = recode(F.col("sex"), {"Male": "1", "Female": "2"})
    assert [r.c for r in df.select(code.alias("c")).collect()] == ["1", None]
    with pytest.raises(Exception, match="no code for Male"):
        df.select(recode(F.col("sex"), {"Female": "2"}).alias("c")).collect()
    lines = df.select("line", key_values(line=F.col("line"), sex=F.col("sex")).alias("value"))
    sinks.write_report(lines, f"{tmp_path}/r.txt")
    assert open(f"{tmp_path}/r.txt").read() == "line=0;sex=Male\nline=1;sex=NA\n"
    assert sinks.session_record(spark).where("name = 'spark'").first().value == spark.version


def test_only_the_wanted_markers_are_read_and_only_the_wanted_samples_unpacked(spark, tmp_path, monkeypatch):
    """The reader alone, over a file that counts what is read of it."""
    import numpy as np

    n, m = 4001, 300
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 4, (m, 4 * 1001)).astype(np.uint8)
    raw = (codes.reshape(m, -1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2).astype(np.uint8)
    path = f"{tmp_path}/big.bed"
    open(path, "wb").write(plink.MAGIC + raw.tobytes())
    dosage = plink.DOSAGE[codes][:, :n]
    opened, got = plink._open, []

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *e):
            self.file.close()

        def __getattr__(self, name):
            return getattr(self.file, name)

        def read(self, k):
            got.append(k)
            return self.file.read(k)

    monkeypatch.setattr(plink, "_open", lambda p: Counted(opened(p)))
    markers, samples = [3, 4, 5, 150, 299], [0, 5, 6, 2047, 4000]

    def rows(**options):
        got.clear()
        reader = plink._BedReader({"path": path, "samples": str(n), **options})
        parts = reader.partitions()
        return [r for p in parts for b in reader.read(p) for r in b.to_pylist()], sum(got), len(parts)

    found, read, _ = rows(keep_markers=plink.runs_text(markers), keep_samples=plink.runs_text(samples), gap_bytes="0")
    assert [r["j"] for r in found] == markers and read == 3 + len(markers) * 1001
    for r in found:
        assert r["samples"] == samples and r["calls"] == [None if d < 0 else d for d in dosage[r["j"], samples].tolist()]
    # a gap of one marker is read over, a wide one is not; partitions are bounded by bytes
    assert rows(keep_markers=plink.runs_text([3, 5, 200]))[1] == 3 + 4 * 1001
    every, read, parts = rows(range_bytes="20020")
    assert len(every) == m and read == 3 + m * 1001 and parts == 15
    assert rows(keep_markers="0-299", range_bytes="20020")[1:] == (read, 15)
    assert rows(keep_markers=plink.runs_text([]))[0] == [] and plink.runs_text([9, 7, 8, 1]) == "1-1,7-9"


def test_in_lists_reach_the_reader(spark, panel, tmp_path):
    plink.write_bed(genotype.wide_markers(panel[0]), f"{tmp_path}/p.bed")
    some = plink.read_bed(spark, f"{tmp_path}/p.bed", 7, range_bytes=2, samples=[6, 1]).where("j in (1, 2, 9)")
    assert some.rdd.getNumPartitions() == 3 and sorted(r.j for r in some.collect()) == [1, 2, 9]
    assert {tuple(r.samples) for r in some.collect()} == {(1, 6)}


def test_digests_are_streamed_by_the_tasks(spark, tmp_path, monkeypatch):
    import hashlib

    texts = {"a.txt": b"one\ntwo\r\nthree\r", "b.txt": b"", "c.txt": b"\n" * 7 + b"\r\n\r\r\n", "d.bin": bytes(range(256)) * 50}
    for name, content in texts.items():
        (tmp_path / name).write_bytes(content)
    want = {name: (len(c), hashlib.sha256(c).hexdigest(), hashlib.sha256(c.replace(b"\r\n", b"\n").replace(b"\n", b"\r\n")).hexdigest()) for name, c in texts.items()}
    got = integrity.with_crlf_digest(spark, str(tmp_path))
    assert {os.path.basename(r.path): (r.bytes, r.sha256, r.crlf_sha256) for r in got.collect()} == want
    md5 = {os.path.basename(r.path): r.md5 for r in integrity.file_manifest(spark, str(tmp_path), md5=True).collect()}
    assert md5 == {name: hashlib.md5(c).hexdigest() for name, c in texts.items()}
    # wherever a buffer ends
    for size in (1, 2, 3, 5):
        monkeypatch.setattr(integrity, "BUFFER", size)
        for name in ("a.txt", "c.txt"):
            assert tuple(integrity.file_digests(str(tmp_path / name), crlf=True)) == want[name]
    # no file is a value of the plan
    assert "content" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_sparse_file_of_three_gigabytes(spark, tmp_path):
    path, size = tmp_path / "big.bin", 3 << 30
    with open(path, "wb") as f:
        f.truncate(size)
    row = integrity.file_manifest(spark, str(tmp_path)).first()
    assert row.bytes == size and row.sha256 == "305b66a59d15b252092fbda9d09711230c429f351897cbd430e7b55a35fd3b97"  # of as many zeros


def test_second_decoder_in_pieces(spark, tmp_path):
    """Tasks of a few bytes, within a marker and across markers; a marker whole
    was one row before, which was copied for each of its calls."""
    import numpy as np

    g = np.random.default_rng(6).integers(-1, 3, (5, 77))
    codes = np.pad(np.array([3, 2, 0, 1], np.uint8)[np.where(g < 0, 3, g)], ((0, 0), (0, 3))).reshape(5, 20, 4)
    body = (codes << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2).astype(np.uint8)
    open(f"{tmp_path}/p.bed", "wb").write(plink.MAGIC + body.tobytes())
    want = {(i, j): None if g[j, i] < 0 else int(g[j, i]) for j in range(5) for i in range(77)}
    for range_bytes, piece in ((4, 4), (7, 3), (60, 8), (1 << 20, 256)):
        rows = plink.read_calls_sql(spark, f"{tmp_path}/p.bed", 77, range_bytes, piece)
        got = rows.collect()
        assert len(got) == len(want) and {(r.i, r.j): r.d for r in got} == want
        if piece < 20:
            assert rows.rdd.getNumPartitions() > 1
