"""Sources on hand-written files."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from dockgrid.functions.scalars import capri_class, dockq, elapsed_str, norm_chain, quality_bin
from dockgrid.operators.energy import lookup_forcefield
from dockgrid.sources import structures, tables


def atom(serial, name, res, chain, seq, x, y, z, icode=" ", record="ATOM  ", element=None):
    shown = f" {name:<3}" if len(name) < 4 else name
    return f"{record}{serial:5d} {shown} {res:>3} {chain}{seq:4d}{icode}   {x:8.3f}{y:8.3f}{z:8.3f}  1.00  0.00          {element or name[0]:>2}"


LINES = [
    "REMARK made up", atom(1, "N", "ALA", "H", 1, 0, 0, 0), atom(2, "CA", "ALA", "H", 1, 1.5, 0, 0), atom(3, "H", "ALA", "H", 1, 0.5, 0.5, 0), atom(4, "OXT", "ALA", "H", 1, 2, 2, 2, element="O"),
    atom(5, "CA", "XYZ", "L", 2, 4, 0, 0, icode="A"), atom(6, "CA", "GLY", "T", 7, -3.25, 0, 1), atom(7, "O", "HOH", "T", 900, 9, 9, 9, record="HETATM"), "TER", "END",
]


def test_read_pdb(spark, tmp_path):
    (tmp_path / "one.pdb").write_text("\n".join(LINES))
    got = structures.read_pdb(spark, str(tmp_path / "one.pdb")).orderBy("serial").collect()
    assert [r["serial"] for r in got] == [1, 2, 5, 6, 7]
    r = got[2]
    assert (r["graph_id"], r["chain"], r["res_seq"], r["res_name"], r["icode"], r["het"], r["x"]) == ("one", "L", 2, "XYZ", "A", False, 4.0)
    assert got[3]["x"] == -3.25 and got[4]["het"]
    assert structures.read_pdb(spark, str(tmp_path / "one.pdb"), cure=False).count() == 7


def test_ensembles(spark, tmp_path):
    (tmp_path / "two.pdb").write_text("\n".join(["MODEL        1", LINES[1], "ENDMDL", "MODEL        2", LINES[2], "ENDMDL"]))
    (tmp_path / "one.PDB").write_text("\n".join(["MODEL        1", LINES[1], "ENDMDL"]))
    got = structures.read_pdb(spark, str(tmp_path)).select("graph_id", "serial").collect()
    assert sorted(map(tuple, got)) == [("one", 1), ("two_model_0", 1), ("two_model_1", 2)]


def test_discover(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, size in (("a.pdb", 5), ("sub/b.PDB", 9), ("manifest.pdb", 3), ("x_xray_tidy.pdb", 4), ("c.txt", 1), ("empty.pdb", 0)):
        (tmp_path / name).write_text("x" * size)
    assert [r["name"] for r in structures.discover(spark, str(tmp_path)).collect()] == ["b.PDB", "a.pdb"]
    assert [r["name"] for r in structures.discover(spark, str(tmp_path), start=1, limit=1).collect()] == ["a.pdb"]
    good, bad = structures.drop_bad_sources(spark, str(tmp_path))
    assert good.count() == 5 and bad.count() == 1


def test_fasta(spark, tmp_path):
    df = spark.createDataFrame([("m1", "A", "ACDE"), ("m1", "B", ""), ("m2", "B", "GG")], "mol string, chain string, sequence string")
    structures.write_fasta(df, str(tmp_path / "f"))
    got = structures.read_fasta(spark, str(tmp_path / "f")).orderBy("label").collect()
    assert [(r["label"], r["mol"], r["role"], r["sequence"]) for r in got] == [("m1.A", "m1", "A", "ACDE"), ("m2.B", "m2", "B", "GG")]


def test_manifest(spark, tmp_path):
    with gzip.open(tmp_path / "m.tsv.gz", "wt") as f:
        f.write("label\tlength\tsequence\nm1.A\tx\tACD\nm.2.B\t9\tAC\n\t\t\n")
    got = structures.read_manifest(spark, str(tmp_path / "m.tsv.gz")).orderBy("label").collect()
    assert [tuple(r) for r in got] == [("m.2.B", "m.2", "B", 9, "AC"), ("m1.A", "m1", "A", 3, "ACD")]
    (tmp_path / "bad.tsv").write_text("label\tx\nm\ty\n")
    with pytest.raises(ValueError, match="sequence"):
        structures.read_manifest(spark, str(tmp_path / "bad.tsv"))


def test_forcefield_files(spark, tmp_path):
    (tmp_path / "t.top").write_text("# c\nALA atom N type=NH1 charge=-0.36 end\nALA atom CA type = CH1E  charge = 0.10 end\nnonsense\n")
    (tmp_path / "p").write_text("! c\nNTER modify atom N type=NH3 charge=0.129 end\nNTER add atom HT3 type=HC charge=0.2 end\n")
    (tmp_path / "c").write_text("NTER: name=all present(N, CA) absent(CB)\nCTER: name=ALA present(OXT)\n")
    (tmp_path / "l").write_text("NONBonded NH3 0.1 2.0 0.2 1.9\nNONBonded CH1E 0.3 3.0 0.3 2.8\n")
    top, patch, cls, par = structures.read_topology(spark, str(tmp_path / "t.top")), structures.read_patches(spark, str(tmp_path / "p")), structures.read_residue_classes(spark, str(tmp_path / "c")), structures.read_lj_params(spark, str(tmp_path / "l"))
    assert [r["action"] for r in patch.orderBy("line_no").collect()] == ["modify", "add"]
    assert [tuple(r)[1:] for r in cls.orderBy("rule_no").collect()] == [("NTER", "all", ["N", "CA"], ["CB"]), ("CTER", "ALA", ["OXT"], [])]
    atoms = spark.createDataFrame([("g", "A", 1, "ALA", 1, "N"), ("g", "A", 1, "ALA", 2, "CA"), ("g", "A", 2, "UNK", 3, "C9")], "graph_id string, chain string, res_seq int, res_name string, serial int, atom_name string")
    got = lookup_forcefield(atoms, top, cls, patch, par).orderBy("serial").collect()
    assert [(r["type"], r["charge"], r["eps"]) for r in got] == [("NH3", 0.129, 0.1), ("CH1E", 0.1, 0.3), (None, 0.0, 0.0)]
    (tmp_path / "bad").write_text("NONBonded X 1 2\n")
    with pytest.raises(Exception, match="unparsable parameter line"):
        structures.read_lj_params(spark, str(tmp_path / "bad")).collect()


def test_regions(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"m1.pdb": [["E", "CONST"], ["V", "H1"]], "m2": []}')
    df = structures.read_region_json(spark, str(tmp_path / "r.json"))
    assert [tuple(r) for r in df.orderBy("ord").collect()] == [("m1", 1, "E", "CONST"), ("m1", 2, "V", "H1")]
    structures.write_region_json(df, str(tmp_path / "out"))
    assert structures.read_region_json(spark, str(tmp_path / "out")).count() == 2


def test_checksums(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a").write_bytes(b"abc")
    want = spark.createDataFrame([("a", hashlib.sha256(b"abc").hexdigest()), ("b", "00")], "name string, sha256 string")
    assert {r["name"]: r["ok"] for r in structures.verify_checksums(spark, str(tmp_path / "d"), want).collect()} == {"a": True, "b": False}


def test_checksums_of_names_that_many_files_share(spark, tmp_path):
    """One row an expected file, however many files have its name; hidden and unreadable files are none."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for k in range(40):
        (tmp_path / "d" / f"f{k}").mkdir(parents=True)
        (tmp_path / "d" / f"f{k}" / "p").write_bytes(b"x" * (k // 2))
    (tmp_path / "d" / "_h").write_bytes(b"")
    (tmp_path / "d" / "q").symlink_to(tmp_path / "nowhere")
    want = [("p", sha(b"x" * k)) for k in range(20)] + [("p", "00"), ("q", "00"), ("_h", sha(b""))]
    got = structures.verify_checksums(spark, str(tmp_path / "d"), spark.createDataFrame(want, "name string, sha256 string")).collect()
    least = min(h for n, h in want[:20])
    assert sorted(map(tuple, got), key=str) == sorted([(n, h, h, True) for n, h in want[:20]] + [("p", "00", least, False), ("q", "00", None, False), ("_h", sha(b""), None, False)], key=str)


def test_metrics_and_process_logs(spark, tmp_path):
    (tmp_path / "sys_metrics_a_12345_1_host.csv").write_text("timestamp,cpu_total_pct,load1\n2024-01-01T00:00:00.500,10.5,x\n,3,1\n")
    (tmp_path / "gpu_metrics_a_12345_1_host.csv").write_text("timestamp,util\n2024-01-01T00:00:02.000,7\n")
    got = tables.read_metrics(spark, str(tmp_path)).collect()
    assert {(r["prefix"], r["source"], r["metric"], r["value"], r["ts"] is None) for r in got} == {("a_12345_1_host", "sys", "cpu_total_pct", 10.5, False), ("a_12345_1_host", "sys", "load1", 0.0, False), ("a_12345_1_host", "sys", "cpu_total_pct", 3.0, True), ("a_12345_1_host", "sys", "load1", 1.0, True), ("a_12345_1_host", "gpu", "util", 7.0, False)}
    assert tables.read_metrics(spark, str(tmp_path), ("proc",)).count() == 0
    (tmp_path / "pmon.log").write_text("# gpu pid\n 20240101 00:00:01 0 123 C 45 3 - - - python\n 20240101 00:00:01 1 - - - - - - - -\nshort line\n")
    assert [(r["gpu"], r["pid"], r["sm"]) for r in tables.read_pmon(spark, str(tmp_path / "pmon.log")).collect()] == [(0, "123", 45.0)]


def test_scalars(spark):
    row = spark.range(1).select(*[elapsed_str(F.lit(s)) for s in (59, 3661)]).first()
    assert tuple(row) == ("0m59s", "1h01m")
    df = spark.createDataFrame([(0.5, 1.0, None, "None"), (0.1, 20.0, 9.0, " b ")], "fnat double, lrmsd double, irmsd double, c string")
    got = df.select(dockq("fnat", "lrmsd", "irmsd"), capri_class("irmsd"), quality_bin("fnat"), norm_chain("c")).collect()
    assert tuple(got[0]) == (None, None, "high", None)
    assert got[1][1] == 5 and got[1][2] == "low" and got[1][3] == "b"


def test_epochs_add_no_folders(spark, tmp_path):
    """300 epochs of two phases, written twice: a folder for each phase, and few files."""
    from dockgrid.sources.tables import read_epoch_results, write_epoch_results

    at = str(tmp_path / "epochs")
    df = spark.range(600).selectExpr("CAST(id % 300 AS INT) AS epoch", "IF(id < 300, 'train', 'valid') AS phase", "'loss' AS name", "IF(id = 7, NULL, CAST(id AS STRING)) AS value")
    write_epoch_results(df, at)
    write_epoch_results(df.withColumn("epoch", df["epoch"] + 300), at)
    assert sorted(p.name for p in (tmp_path / "epochs").iterdir() if p.is_dir()) == ["phase=train", "phase=valid"]
    assert len(list((tmp_path / "epochs").rglob("*.parquet"))) <= 20
    got = {(r["epoch"], r["name"], r["value"]) for r in read_epoch_results(spark, at, "valid").collect()}
    assert got == {(k % 300 + more, "loss", str(k)) for k in range(300, 600) for more in (0, 300)}
    assert read_epoch_results(spark, at).count() == 1198
