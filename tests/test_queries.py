"""Every registered query against its SQL at the smallest size."""

import os
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from dockgrid.operators import cluster
from dockgrid.plans import queries as plans, queries_graphs, queries_runs, queries_sources  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "null" if v != v else f"{v + 0.0:.6g}"
    return "null" if v is None else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are absent")
@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(plans.SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(plain(r[k]) for k in at) for r in rel.fetchall())
    assert got == want


def test_unchecked_queries_run(spark):
    for name in set(plans.QUERIES) - set(plans.SQL) - {"j2_louvain", "j3_cluster_hierarchy"}:
        assert plans.QUERIES[name](spark, SF).limit(5).count() >= 1


def test_clusters_of_the_given_graphs(spark):
    """j2: no graph's modularity is below a floor, and every node has a cluster. j3: the second depth joins clusters of the first."""
    nodes, edges = (x.persist() for x in plans._internal_graphs(spark, SF))
    found = plans.QUERIES["j2_louvain"](spark, SF).persist()
    assert found.select("graph_id", "node").exceptAll(nodes).isEmpty() and nodes.exceptAll(found.select("graph_id", "node")).isEmpty()
    assert min(r["modularity"] for r in cluster.modularity(edges.withColumn("weight", F.lit(1.0)), found).collect()) > 0.6
    deep = plans.QUERIES["j3_cluster_hierarchy"](spark, SF)
    got = deep.groupBy("graph_id", "depth_0").agg(F.countDistinct("depth_1").alias("n"), F.count("*").alias("nodes")).collect()
    assert all(r["n"] == 1 for r in got) and sum(r["nodes"] for r in got) == nodes.count()
