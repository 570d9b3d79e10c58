"""Registered queries of the file sources: a given table is written in the format to shared storage and read back."""

from __future__ import annotations

import gzip
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from dockgrid.operators import spatial as sp, workflow as wf
from dockgrid.plans import views as v
from dockgrid.plans.queries import TOPOLOGY, query
from dockgrid.sources import files, structures, tables
from dockgrid.storage import new_path, settle

C = F.col


def _graph() -> Column:
    """The molecule of a file's folder."""
    return F.regexp_extract("path", r"graph_id=(\d+)", 1).cast("long")


def _record(name: Column, element: Column) -> Column:
    return F.format_string("ATOM  %5d %-4s %3s %s%4d    %8.3f%8.3f%8.3f  1.00  0.00          %2s", C("serial"), name, C("res_name"), C("chain"), C("res_seq"), *[F.floor(C(k) * 1000) / 1000 for k in "xyz"], element)


def _written(spark, d, models: bool = False) -> str:
    """Atoms as records, a folder a molecule; every tenth is a terminal oxygen, every seventh a hydrogen. models: a model a chain."""
    at = new_path(spark, "records")
    a = v.atoms(spark, d)
    name = F.when(C("serial") % 10 == 0, " OXT").otherwise(F.concat(F.lit(" "), "atom_name"))
    lines = a.select("graph_id", "chain", "serial", _record(name, F.when(C("serial") % 7 == 0, "H").otherwise(F.left("atom_name", F.lit(1)))).alias("value"))
    if models:
        begins = a.select("graph_id", "chain").distinct().select("graph_id", "chain", F.lit(0).cast("long").alias("serial"), F.concat(F.lit("MODEL        "), F.when(C("chain") == "A", "1").otherwise("2")).alias("value"))
        lines = lines.unionByName(begins)
    files.write_folders(lines.repartition("graph_id").sortWithinPartitions("graph_id", "chain", "serial"), at, "graph_id")
    return at


_COLUMNS = "graph_id, serial, chain, res_seq::INT AS res_seq, res_name, CASE WHEN serial % 10 = 0 THEN 'OXT' ELSE atom_name END AS atom_name, floor(x * 1000) / 1000 AS x, floor(y * 1000) / 1000 AS y, floor(z * 1000) / 1000 AS z"


def _parsed(spark, d, cure: bool) -> DataFrame:
    lines = structures.read_lines(spark, _written(spark, d)).withColumn("graph_id", _graph())
    out = structures.parse_atoms(structures.cure_lines(lines) if cure else lines)
    return out.select("graph_id", C("serial").cast("long").alias("serial"), "chain", "res_seq", "res_name", "atom_name", "x", "y", "z")


@query(f"WITH {v.ATOMS} SELECT {_COLUMNS} FROM atoms")
def a1_read_pdb(spark, d):
    return _parsed(spark, d, cure=False)


@query(f"WITH {v.ATOMS} SELECT {_COLUMNS} FROM atoms WHERE serial % 10 > 0 AND serial % 7 > 0")
def b1_cure_atoms(spark, d):
    return _parsed(spark, d, cure=True)


@query(f"WITH {v.ATOMS} SELECT {_COLUMNS} FROM atoms")
def a1_listed_files(spark, d):
    """As a1_read_pdb, with files listed in tasks and read in ranges of 2,000 bytes; the condition on names is pushed."""
    lines = files.read_listed(files.list_files(spark, _written(spark, d)), split_bytes=2000).filter(C("name").endswith(".txt") & C("error").isNull())
    out = structures.parse_atoms(lines.withColumnRenamed("at", "line_no").withColumn("graph_id", _graph()))
    return out.select("graph_id", C("serial").cast("long").alias("serial"), "chain", "res_seq", "res_name", "atom_name", "x", "y", "z")


def _spoiled(frames):
    """An empty and a damaged packed file in each folder."""
    for f in frames:
        for folder in f["folder"]:
            Path(folder, "none.txt").write_bytes(b"")
            Path(folder, "cut.txt.gz").write_bytes(gzip.compress(b"ATOM" * 100)[:-9])
        yield f


@query(f"WITH {v.ATOMS} SELECT graph_id, 79 * count(*) AS good_bytes, CASE WHEN graph_id % 3 = 0 THEN 1 ELSE 0 END AS n_empty, CASE WHEN graph_id % 3 = 0 THEN 1 ELSE 0 END AS n_damaged FROM atoms GROUP BY graph_id")
def a15_drop_bad_sources(spark, d):
    """Every third molecule's folder gets an empty and a damaged file besides its records."""
    at = _written(spark, d)
    folders = v.atoms(spark, d).filter("graph_id % 3 = 0").select(F.concat(F.lit(at.removeprefix("file://") + "/graph_id="), "graph_id").alias("folder")).distinct()
    settle(folders.mapInPandas(_spoiled, "folder string"), "spoiled")
    good, bad = structures.drop_bad_sources(spark, at)
    both = good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)
    number = lambda test: F.count_if(test).alias
    return both.groupBy(_graph().alias("graph_id")).agg(F.sum(F.when(C("error").isNull(), C("length"))).alias("good_bytes"), number(C("error") == "empty")("n_empty"), number(C("error").startswith("EOFError"))("n_damaged"))


@query(f"WITH {v.ATOMS} SELECT graph_id, 79 * count(*) AS length FROM atoms GROUP BY graph_id")
def a2_discover(spark, d):
    found = structures.discover(spark, _written(spark, d), suffix="TXT", in_tasks=True)
    return found.groupBy(_graph().alias("graph_id")).agg(F.sum("length").alias("length"))


@query(f"WITH {v.ATOMS} SELECT graph_id, CASE WHEN count(DISTINCT chain) OVER (PARTITION BY graph_id) > 1 AND chain = 'B' THEN 1 ELSE 0 END AS model, count(*) AS n, min(serial) AS first FROM (SELECT graph_id, chain, serial FROM atoms) GROUP BY graph_id, chain".replace("count(DISTINCT chain) OVER (PARTITION BY graph_id)", "count(*) OVER (PARTITION BY graph_id)"))
def a3_split_models(spark, d):
    lines = structures.split_models(structures.read_lines(spark, _written(spark, d, models=True)), always_number=True)
    model = F.regexp_extract("graph_id", r"_model_(\d+)$", 1).cast("int")
    atoms = structures.parse_atoms(lines.withColumn("graph_id", F.concat_ws("/", _graph().cast("string"), model.cast("string"))))
    parts = F.split("graph_id", "/")
    return atoms.groupBy("graph_id").agg(F.count("*").alias("n"), F.min("serial").cast("long").alias("first")).select(parts[0].cast("long").alias("graph_id"), parts[1].cast("int").alias("model"), "n", "first")


@query("SELECT doc_id || '.' || CASE WHEN doc_id % 2 = 0 THEN 'H' ELSE 'L' END AS label, doc_id::VARCHAR AS mol, CASE WHEN doc_id % 2 = 0 THEN 'H' ELSE 'L' END AS role, sha256(text) AS sequence FROM documents WHERE doc_id % 5 > 0")
def a4_fasta(spark, d):
    at = new_path(spark, "fasta")
    role = F.when(C("doc_id") % 2 == 0, "H").otherwise("L")
    s = v.table(spark, d, "documents").select(C("doc_id").cast("string").alias("mol"), role.alias("chain"), F.when(C("doc_id") % 5 > 0, F.sha2("text", 256)).otherwise("").alias("sequence"))
    structures.write_fasta(s, at)
    return structures.read_fasta(spark, at)


@query("SELECT conv_id::VARCHAR AS graph_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS ord, left(role, 1) AS aa, ['CONST', 'H1', 'L3'][turn % 3 + 1] AS label FROM conversations")
def a9_region_json(spark, d):
    from pyspark.sql import Window

    at = new_path(spark, "regions")
    c = v.table(spark, d, "conversations")
    regions = c.select(C("conv_id").cast("string").alias("graph_id"), F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role")).alias("ord"), F.left("role", F.lit(1)).alias("aa"), F.element_at(F.array(*map(F.lit, ("CONST", "H1", "L3"))), (C("turn") % 3 + 1).cast("int")).alias("label"))
    structures.write_region_json(regions, at)
    return structures.read_region_json(spark, at).withColumn("ord", C("ord").cast("long"))


@query("SELECT 'sys' AS source, metric, count(*) AS n, round(sum(value), 4) AS total, count(*) FILTER (ts IS NULL) AS undated FROM (SELECT CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END AS ts, unnest(['cpu_total_pct', 'load1']) AS metric, unnest([CASE WHEN event_id % 8 = 0 THEN 0 ELSE value END, user_id::DOUBLE]) AS value FROM events) GROUP BY metric")
def a10_read_metrics(spark, d):
    at = new_path(spark, "metrics")
    e = v.table(spark, d, "events").select(F.when(C("event_id") % 9 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"), F.when(C("event_id") % 8 == 0, "no number").otherwise(C("value").cast("string")).alias("cpu_total_pct"), C("user_id").alias("load1"))
    e.write.option("header", "true").csv(at)
    _named(spark, at, "sys_metrics_stage_12345_1_host")
    return tables.read_metrics(spark, at, ("sys",)).groupBy("source", "metric").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.count_if(C("ts").isNull()).alias("undated"))


def _named(spark, at: str, stem: str) -> None:
    """Gives the data files of a folder names as the recorder of metrics gives them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for k, status in enumerate(fs.listStatus(path)):
        if status.getPath().getName().endswith(".csv"):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{stem}{k}.csv"))


@query("SELECT date_trunc('second', ts) AS ts, (event_id % 4)::INT AS gpu, user_id::VARCHAR AS pid, (event_id % 100)::DOUBLE AS sm FROM events WHERE event_id % 6 > 0 AND event_id % 5 > 0")
def a11_read_pmon(spark, d):
    at = new_path(spark, "pmon")
    row = F.format_string("%s %d %s C %d 3 - - python", F.date_format("ts", " yyyyMMdd HH:mm:ss"), C("event_id") % 4, F.when(C("event_id") % 6 == 0, "-").otherwise(C("user_id").cast("string")), C("event_id") % 100)
    v.table(spark, d, "events").select(F.when(C("event_id") % 5 == 0, "# gpu pid type sm").otherwise(row).alias("value")).write.text(at)
    return tables.read_pmon(spark, at)


@query(f"WITH {v.ATOMS}, {TOPOLOGY} SELECT res_name, atom_name, type, round(charge, 4) AS charge FROM topology")
def a12_read_forcefield(spark, d):
    at = new_path(spark, "topology")
    named = v.atoms(spark, d).filter("atom_name <> 'SD'").select("res_name", "atom_name").distinct()
    line = F.format_string("%s atom %-4s type=t%d charge = %.2f end", C("res_name"), C("atom_name"), F.ascii("res_name") % 3, (F.length("atom_name") - 2) * 0.25)
    named.select(line.alias("value")).unionByName(named.limit(1).select(F.lit("! a comment atom X").alias("value"))).write.text(at)
    return structures.read_topology(spark, at).withColumn("charge", F.round("charge", 4))


@query(f"WITH {v.ATOMS} SELECT graph_id, graph_id % 5 > 0 AS ok FROM atoms GROUP BY graph_id")
def a13_verify_checksums(spark, d):
    at = _written(spark, d)
    found = files.hashed_files(files.list_files(spark, at)).select(_graph().alias("graph_id"), "name", F.when(_graph() % 5 > 0, C("sha256")).otherwise(F.sha2(F.lit("other"), 256)).alias("sha256"))
    expected = settle(found, "expected")
    # Folders share names: a file is there if one of its name has the content.
    checked = structures.verify_checksums(spark, at, expected.select("name", "sha256").distinct()).select("name", "sha256", "ok")
    return expected.join(checked, ["name", "sha256"], "left").groupBy("graph_id").agg(F.min(F.coalesce("ok", F.lit(False))).alias("ok"))


@query(f"WITH {v.ATOMS} SELECT graph_id, count(*) AS n, round(sqrt(var_pop(x) + var_pop(y) + var_pop(z)), 4) AS rmsd FROM atoms GROUP BY graph_id")
def d23_superposed_rmsd(spark, d):
    # The reference is the molecule turned, moved and twice as large: what is left after superposition is its radius of gyration.
    p = v.atoms(spark, d).select("graph_id", "x", "y", "z", (5 - 2 * C("y")).alias("rx"), (2 * C("x") + 1).alias("ry"), (2 * C("z") - 3).alias("rz"))
    return sp.superposed_rmsd(p).withColumn("rmsd", F.round("rmsd", 4))


@query("""WITH n AS (SELECT p_partkey AS mol, i AS ord FROM part, unnest(range(1, 61 + p_partkey % 65)) AS t(i))
SELECT mol::VARCHAR AS mol, string_agg(CASE WHEN ord % 4 = 0 THEN 'CONST' WHEN ord BETWEEN 27 AND 38 THEN 'H1' WHEN ord BETWEEN 56 AND 65 THEN 'H2' WHEN ord BETWEEN 105 AND 117 THEN 'H3' ELSE 'CONST' END, ',' ORDER BY ord) AS labels FROM n GROUP BY mol""")
def e8_label_regions(spark, d):
    # Letters in turn from a part's own start; every position numbers its letter, but each fourth is a gap. Parts are one small file: their keys are dealt before they become chains.
    keys = v.table(spark, d, "part").select(C("p_partkey").cast("string").alias("mol"), "p_partkey").repartition(4 * spark.sparkContext.defaultParallelism, "mol")
    places = F.sequence(F.lit(1), (60 + C("p_partkey") % 65).cast("int"))
    letter = lambda i: F.char(161 + (i + C("p_partkey")) % 94)
    numbering = F.transform(places, lambda i: F.struct(i.alias("position"), F.when(i % 4 == 0, "-").otherwise(letter(i)).alias("aa")))
    chains = keys.select("mol", F.lit("H").alias("role"), F.array_join(F.transform(places, letter), "").alias("sequence"), F.lit(1).alias("start"), numbering.alias("numbering"))
    return wf.merge_regions(wf.label_regions(chains)).select("mol", F.array_join("labels", ",").alias("labels"))
