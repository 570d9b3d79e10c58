"""Listing in tasks and reading in ranges, against plain Python."""

import gzip
import os
import random

from pyspark.sql import functions as F

from dockgrid.sources import files, structures


def tree(root, seed=3):
    """Folders of depth 4, files of random lines (with and without a last line end, \\r\\n, empty lines, one very long line)."""
    rng = random.Random(seed)
    out = {}
    for k in range(40):
        folder = root
        for _ in range(k % 4):
            folder = folder / f"d{rng.randrange(3)}"
        folder.mkdir(parents=True, exist_ok=True)
        ends = rng.choice(["\n", "\r\n"])
        text = ends.join("x" * rng.choice([0, 1, 30, 200]) + str(i) * (i % 3) for i in range(rng.randrange(60))) + rng.choice(["", ends])
        path = folder / f"f{k}.{'pdb' if k % 2 else 'PDB'}"
        path.write_bytes(text.encode())
        out[str(path)] = text
    (root / "long.txt").write_text("ab" * 300_000 + "\nend")
    out[str(root / "long.txt")] = "ab" * 300_000 + "\nend"
    return out


def lines_of(text):
    out = text.replace("\r\n", "\n").split("\n")
    return out[:-1] if out[-1] == "" else out


def test_listing(spark, tmp_path):
    texts = tree(tmp_path)
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "f.pdb").write_text("x")
    plain = [r["name"] for r in structures.discover(spark, str(tmp_path)).collect()]
    os.symlink(tmp_path / "nowhere", tmp_path / "lost.pdb")
    os.symlink(tmp_path, tmp_path / "ring")
    assert sorted(r["name"] for r in structures.discover(spark, str(tmp_path), in_tasks=True).collect()) == sorted(plain)
    got = {r["path"]: r for r in files.list_files(spark, str(tmp_path)).collect()}
    assert set(got) == {*texts, str(tmp_path / "lost.pdb")}
    assert all(got[p]["length"] == os.path.getsize(p) and abs(got[p]["mtime"].timestamp() - os.path.getmtime(p)) < 1 for p in texts)
    assert got[str(tmp_path / "lost.pdb")]["length"] is None and "No such file" in got[str(tmp_path / "lost.pdb")]["error"]
    some = files.list_files(spark, str(tmp_path), suffix=".pdb", prefix="f1").filter("error IS NULL").collect()
    assert {r["path"] for r in some} == {p for p in texts if os.path.basename(p).startswith("f1")}


def test_absent_root_raises_and_empty_root_is_empty(spark, tmp_path):
    (tmp_path / "none").mkdir()
    listing = files.list_files(spark, str(tmp_path / "none"))
    assert listing.count() == 0 and files.read_listed(listing).count() == 0 and files.checked_files(listing).count() == 0
    try:
        files.list_files(spark, str(tmp_path / "absent"))
    except FileNotFoundError:
        return
    raise AssertionError("an absent root must raise")


def test_lines_of_ranges(spark, tmp_path):
    texts = tree(tmp_path)
    packed = tmp_path / "p.pdb.gz"
    packed.write_bytes(gzip.compress(b"one\ntwo\n" * 500))
    texts[str(packed)] = "one\ntwo\n" * 500
    listing = files.list_files(spark, str(tmp_path)).persist()
    for size in (1, 1000, 1 << 27):
        if size == 1:  # every byte of the small files begins a range
            listing_, texts_ = listing.filter("length < 300"), {p: t for p, t in texts.items() if os.path.getsize(p) < 300}
        else:
            listing_, texts_ = listing, texts
        rows = files.read_listed(listing_, size).filter("error IS NULL").collect()
        found: dict = {}
        for r in rows:
            found.setdefault(r["path"], []).append((r["at"], r["line"]))
        assert {p: [line for _, line in sorted(v)] for p, v in found.items()} == {p: lines_of(t) for p, t in texts_.items() if t}
        for p, v in found.items():
            assert all(texts_[p].encode()[at:].startswith(line.encode()) for at, line in v)


def test_one_long_file_is_many_ranges(spark, tmp_path):
    (tmp_path / "big.txt").write_text("0123456789\n" * 20_000)
    listing = files.list_files(spark, str(tmp_path))
    assert files.splits(listing, 10_000).count() == 22
    df = files.read_listed(listing, 10_000)
    assert df.rdd.getNumPartitions() > 1
    assert df.agg(F.count("*"), F.countDistinct("at")).first()[:] == (20_000, 20_000)


def test_conditions_on_names_open_no_other_file(spark, tmp_path):
    """Files that fail the pushed condition are taken away after listing: opening one would be a row with error."""
    for k in range(6):
        (tmp_path / f"{'a' if k % 2 else 'b'}{k}.txt").write_text(f"{k}\n")
    df = files.read_listed(files.list_files(spark, str(tmp_path)))
    for k in range(0, 6, 2):
        (tmp_path / f"b{k}.txt").unlink()
    assert sorted(r["line"] for r in df.filter(F.col("name").startswith("a") & F.col("name").endswith(".txt")).collect()) == ["1", "3", "5"]
    assert sorted(r["line"] for r in df.filter(F.col("name").isin("a1.txt", "a3.txt")).collect()) == ["1", "3"]
    assert [r["line"] for r in df.filter(F.col("path") == str(tmp_path / "a5.txt")).collect()] == ["5"]
    assert df.filter(F.col("error").isNotNull()).count() == 3
    assert "StringStartsWith" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_faults_are_rows(spark, tmp_path):
    (tmp_path / "ok.txt").write_text("a\nb")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "ok.gz").write_bytes(gzip.compress(b"c\n"))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(b"line\n" * 1000)[:-9])
    (tmp_path / "no.gz").write_text("not packed")
    (tmp_path / "odd.txt").write_bytes(b"\xff\xfe\n")
    os.symlink(tmp_path / "nowhere", tmp_path / "lost.txt")
    good, bad = structures.drop_bad_sources(spark, str(tmp_path))
    assert {os.path.basename(r["path"]) for r in good.collect()} == {"ok.txt", "ok.gz", "odd.txt"}
    why = {os.path.basename(r["path"]): r["error"] for r in bad.collect()}
    assert set(why) == {"empty.txt", "cut.gz", "no.gz", "lost.txt"} and why["empty.txt"] == "empty" and why["cut.gz"].startswith("EOFError")
    rows = files.read_listed(files.list_files(spark, str(tmp_path))).collect()
    assert sorted(r["line"] for r in rows if r["error"] is None and r["name"] != "cut.gz") == ["a", "b", "c", "��"]
    assert {r["name"] for r in rows if r["error"] is not None} == {"cut.gz", "no.gz"}


def test_folders_are_written_whole_without_spark_moving_files(spark, tmp_path):
    """A file longer than an Arrow batch keeps its order; nothing hidden is left; writing again leaves one file a folder."""
    lines = spark.range(25_000).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.lit(7)).alias("g"), F.format_string("line %05d é", "id").alias("value"), "id")
    root = f"file://{tmp_path}/out"
    for _ in range(2):
        files.write_folders(lines.repartition("g").sortWithinPartitions("g", "id"), root, "g")
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()) == [f"out/g={k}/part-0.txt" for k in (0, 1, 2, 7)]
    assert (tmp_path / "out/g=7/part-0.txt").read_text() == "".join(f"line {i:05d} é\n" for i in range(3, 25_000))
    assert (tmp_path / "out/g=2/part-0.txt").read_text() == "line 00002 é\n"
