"""Intermediate tables that go when a block ends, and tools that are set up once a worker."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dockgrid.operators import scoring
from dockgrid.storage import cleared, new_path, settle


def folders(spark):
    at = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    return {p.name for p in at.iterdir()} if at.exists() else set()


def test_blocks_clear_what_was_written_within(spark, tmp_path):
    df = spark.range(10)
    kept = settle(df, "kept")
    before = folders(spark)
    with cleared(spark):
        settle(df, "outer").write.parquet(str(tmp_path / "out"))
        with cleared(spark):
            assert settle(df, "inner").count() == 10
        assert {n.split("-")[0] for n in folders(spark) - before} == {"outer"}
        new_path(spark, "never_written")
    assert folders(spark) == before and kept.count() == 10
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    with pytest.raises(ValueError, match="stop"), cleared(spark):
        settle(df, "raised")
        raise ValueError("stop")
    assert folders(spark) == before


def test_tools_start_once_a_worker(spark, tmp_path):
    """40 structures; each start leaves a file named by its process: no process starts twice, and failing structures start nothing anew."""
    at = str(tmp_path)

    def start():
        import uuid

        Path(at, f"{os.getpid()}-{uuid.uuid4().hex}").write_text("")
        return lambda f: {"n": 10 // int(f["v"].iloc[0])}

    atoms = spark.createDataFrame([(g, g % 10) for g in range(40) for _ in range(2)], "graph_id long, v long")
    got = {r["graph_id"]: r for r in scoring.map_structures(atoms, None, "n long", start=start).collect()}
    assert all((r["status"], r["n"]) == (("fail", None) if g % 10 == 0 else ("ok", 10 // (g % 10))) for g, r in got.items()) and len(got) == 40
    pids = [n.split("-")[0] for n in os.listdir(at)]
    assert pids and len(pids) == len(set(pids))
    with pytest.raises(ValueError, match="tool or a start"):
        scoring.map_structures(atoms, None, "n long")


def test_starts_that_fail_are_rows(spark):
    def start():
        raise RuntimeError("no model")

    got = scoring.map_structures(spark.createDataFrame([(1, 2)], "graph_id long, v long"), None, "n long", start=start).collect()
    assert [(r["status"], r["error"]) for r in got] == [("fail", "no model")]


def test_molecules_stay_where_they_are_dealt(spark):
    """Radius joins over atoms that are dealt by molecule move nothing: one exchange a side, none by cells; so do joins with dealt tables."""
    from dockgrid.operators import graph, spatial
    from dockgrid.plans import views

    a = views.atoms(spark, "/root/testdata/sf0.001")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    moved = lambda df: [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]
    pairs = spatial.contact_pairs(a)
    assert len(moved(pairs)) == 2 and not any("cell_" in line or "at_x" in line for line in moved(pairs))
    assert not any("serial" in line or "cell_" in line for line in moved(spatial.internal_pairs(graph.valid_nodes(a, pairs))))
    df = spark.range(100).selectExpr("id % 7 AS graph_id", "id")
    both = settle(df, "dealt", by="graph_id").hint("merge").join(settle(df, "dealt", by="graph_id"), ["graph_id", "id"])
    assert len(moved(both)) == 2 and not any("id#" in line.replace("graph_id#", "") for line in moved(both)) and both.count() == 100


def test_graphs_for_clusters_are_found_once(spark):
    """Nodes and edges are read from tables: no plan that uses them finds contacts again."""
    from dockgrid.plans.queries import _internal_graphs

    for df in _internal_graphs(spark, "/root/testdata/sf0.001"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Join" not in plan


def test_graphs_that_are_dealt_stay_when_they_are_stored(spark, tmp_path, monkeypatch):
    """Rows dealt by graph_id aren't dealt again, and each graph is in one file of its bucket."""
    from dockgrid.sources import tables

    dealt = settle(spark.range(400).selectExpr("id % 20 AS graph_id", "id AS node_idx", "id AS src_idx"), "rows", by="graph_id")
    plans, by = [], type(dealt).sortWithinPartitions
    monkeypatch.setattr(type(dealt), "sortWithinPartitions", lambda self, *c: plans.append(self._jdf.queryExecution().executedPlan().toString()) or by(self, *c))
    tables.write_graphs(str(tmp_path / "store"), dealt, dealt, buckets=4)
    rows = spark.read.parquet(str(tmp_path / "store/nodes")).select("graph_id", "bucket", F.input_file_name().alias("f"))
    assert rows.count() == 400 and rows.groupBy("graph_id").agg(F.countDistinct("f").alias("n")).filter("n > 1").isEmpty()
    assert [p.count("Exchange") for p in plans] == [1, 1]


def test_dealt_tables_are_read_where_they_lie(spark):
    """Tables that were dealt before they were written join without an exchange; null keys stay rows, the catalog and blocks keep nothing."""
    from dockgrid.storage import settle_dealt

    before = folders(spark)
    with cleared(spark):
        a, b = (settle_dealt(spark.range(100).selectExpr("nullif(id % 7, 3) AS graph_id", "id", "array(id) AS ids"), "dealt", by="graph_id") for _ in range(2))
        both = a.hint("merge").join(b, ["graph_id", "id"])
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString() and both.count() == 86
        assert a.filter("graph_id IS NULL").count() == 14 and sorted(r["ids"][0] for r in a.collect()) == list(range(100))
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("dealt")] and len(folders(spark) - before) == 2
    assert folders(spark) == before


def test_whole_graphs_are_dealt_once(spark):
    """Joins of edges with nodes, areas and frames move nothing: of the whole graph's edges only the pairs move, once, before they are turned."""
    from dockgrid.plans import queries_graphs, views
    from dockgrid.plans.interface_graphs import build_graphs
    from dockgrid.storage import settle

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = views.atoms(spark, "/root/testdata/sf0.001").drop("charge", "eps", "sigma", "eps14", "sigma14")
        areas = settle(a.selectExpr("graph_id", "serial AS u", "serial + 1 AS v", "x AS area"), "areas")
        for grain, u in (("atom", "u"), ("residue", "string(u)")):
            some = areas.selectExpr("graph_id", f"{u} AS u", f"{u.replace('u', 'v')} AS v", "area")
            edges = build_graphs(a, grain=grain, forcefield=queries_graphs._forcefield(spark, a), areas=some, orientation=True)["edges"]
            assert edges._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 1 and edges.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
