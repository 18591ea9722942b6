"""The commands, end to end on small files."""

import os

import pytest

from panelweave import cli
from panelweave.functions import PanelError
from panelweave.sources import plink, sinks


def files(tmp_path):
    rows = ["##fileformat=VCFv4.2", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "a", "b"])]
    rows += ["\t".join(["22", str(100 * j + 100), f"m{j}", "A", "C", ".", ".", ".", "GT", f"{j % 2}|{j // 2 % 2}", f"0|{j % 3 % 2}"]) for j in range(9)]
    (tmp_path / "x.vcf").write_text("\n".join(rows) + "\n")
    (tmp_path / "m.txt").write_text("chr bp rate cm\n22 100 0 0.0\n22 900 0 40.0\n")


def test_simulate_resumes_and_installs_once(spark, tmp_path):
    files(tmp_path)
    run = lambda out, **k: cli.simulate(spark, f"{tmp_path}/x.vcf", f"{tmp_path}/m.txt", 6, 20.0, 3, 4, f"{tmp_path}/work", f"{tmp_path}/{out}", **k)
    run("one")
    assert sorted(os.listdir(tmp_path / "work"))[:3] == ["block-1", "block-2", "block-3"]
    with pytest.raises(PanelError):
        run("one")
    run("two", resume=True)
    assert (tmp_path / "one.bed").read_bytes() == (tmp_path / "two.bed").read_bytes()
    with pytest.raises(PanelError):
        run("two", resume=True, force=True)
    run("two", force=True)
    assert (tmp_path / "one.bed").read_bytes() == (tmp_path / "two.bed").read_bytes()
    row = cli.validate(spark, f"{tmp_path}/one").first()
    assert (row.status, row.samples, row.markers, row.missingness) == ("PASS", 6, 9, 0.0)
    assert [r.iid for r in plink.read_fam(spark, f"{tmp_path}/one.fam").orderBy("i").collect()][0] == "MOSAIC_00001"
    cli.manifest(spark, f"{tmp_path}/work", f"{tmp_path}/sums.txt")
    assert "panel.bed" in (tmp_path / "sums.txt").read_text()


def test_convert(spark, tmp_path):
    (tmp_path / "x.ped").write_text("f a 0 0 1 -9 1 2 0 0 2 2\nf b 0 0 2 -9 1 1 2 1 1 2\n")
    (tmp_path / "x.map").write_text("1 m1 0 5\n1 #m2 0 6\n1 m3 0 7\n")
    cli.convert(spark, f"{tmp_path}/x.ped", f"{tmp_path}/x.map", f"{tmp_path}/y")
    got = {(r.i, r.j): r.d for r in plink.read_calls(spark, f"{tmp_path}/y").collect()}
    assert got == {(0, 0): 1, (0, 1): None, (0, 2): 2, (1, 0): 0, (1, 1): 1, (1, 2): 1}


def test_installed_panel_is_held_against_its_record(spark, tmp_path):
    test_convert(spark, tmp_path)
    prefix = f"{tmp_path}/y"
    rows = ["path,bytes,sha256"] + [f"panel/y.{x},{os.path.getsize(f'{prefix}.{x}')},{sinks.sha256_file(f'{prefix}.{x}').upper()}" for x in ("bed", "bim", "fam")]
    (tmp_path / "sums.csv").write_text("\n".join([*rows, "panel/other.bed,1,00"]) + "\n")
    (tmp_path / "design.csv").write_text('"CHROM","ID","POS","REF","ALT"\n1,m1,5,1,2\n1,#m2,6,1,2\n1,m3,7,1,2\n')
    (tmp_path / "gates.csv").write_text("ancestry,gate,pass\nEUR,maf_correlation,TRUE\n")
    check = lambda out, design="design.csv", accepted="gates.csv": cli.installed(spark, prefix, f"{tmp_path}/sums.csv", f"{tmp_path}/{design}", f"{tmp_path}/{out}", f"{tmp_path}/{accepted}")
    assert {r.gate for r in check("ok").collect()} == {"file_bed", "file_bim", "file_fam", "design_identity", "structure", "accepted_maf_correlation"}
    record = {r.name: r.value for r in spark.read.option("header", "true").csv(f"{tmp_path}/ok/record").collect()}
    assert float(record["elapsed_seconds"]) > 0 and record["started"].endswith("Z") and record["spark"] == spark.version
    # another marker in the design, a failed gate, a file with other line ends: each is named, and the evidence is there
    (tmp_path / "other.csv").write_text("CHROM,ID,POS,REF,ALT\n1,m1,5,1,2\n1,mX,6,1,2\n1,m3,7,1,2\n")
    with pytest.raises(PanelError, match="gates failed: design_identity$"):
        check("one", "other.csv")
    (tmp_path / "bad.csv").write_text("ancestry,gate,pass\nEUR,maf_correlation,FALSE\n")
    with pytest.raises(PanelError, match="gates failed: accepted_maf_correlation$"):
        check("two", accepted="bad.csv")
    fam = (tmp_path / "y.fam").read_bytes()
    (tmp_path / "y.fam").write_bytes(fam.replace(b"\n", b"\r\n"))
    with pytest.raises(PanelError, match="file_fam"):
        check("three")
    found = {r.gate: (r["pass"], r.status) for r in spark.read.option("header", "true").csv(f"{tmp_path}/three/checks").collect()}
    assert found["file_fam"] == ("false", "differs") and found["file_bed"] == ("true", "match")
