"""Views of the given tables that stand in for domain tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dockgrid.functions import fixed
from dockgrid.storage import stay_dealt

C = F.col
NAMES = ["N", "CA", "C", "O", "CB", "CG", "SD"]
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atoms, dealt by molecule (the window of serial does that). Joins within molecules then keep them where they are."""
    stay_dealt(spark)
    # The molecule is named before the window: its rows count as dealt by graph_id only if that is the window's own column.
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "graph_id")
    li = li.withColumn("serial", F.row_number().over(Window.partitionBy("graph_id").orderBy(*ORDER)).cast("long"))
    return li.select(
        "graph_id", "serial", F.when(C("l_orderkey") % 2 == 0, "A").otherwise("B").alias("chain"),
        (C("l_partkey") % 50 + 1).alias("res_seq"), F.element_at(F.array(*map(F.lit, fixed.RESIDUES)), (C("l_partkey") % 20 + 1).cast("int")).alias("res_name"),
        F.element_at(F.array(*map(F.lit, NAMES)), C("l_linenumber")).alias("atom_name"), C("l_quantity").alias("x"), (C("l_extendedprice") / 2100).alias("y"), (C("l_discount") * 500).alias("z"),
        ((C("l_linenumber") - 4) * 0.1).alias("charge"), (C("l_linenumber") * 0.05).alias("eps"), (C("l_linenumber") * 0.1 + 2).alias("sigma"), (C("l_linenumber") * 0.04).alias("eps14"), (C("l_linenumber") * 0.1 + 1.8).alias("sigma14"),
    )


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


ATOMS = f"""atoms AS MATERIALIZED (SELECT l_suppkey AS graph_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(ORDER)}) AS serial, CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS chain,
 l_partkey % 50 + 1 AS res_seq, {_list(fixed.RESIDUES)}[l_partkey % 20 + 1] AS res_name, {_list(NAMES)}[l_linenumber] AS atom_name, l_quantity AS x, l_extendedprice / 2100 AS y, l_discount * 500 AS z,
 (l_linenumber - 4) * 0.1::DOUBLE AS charge, l_linenumber * 0.05::DOUBLE AS eps, l_linenumber * 0.1::DOUBLE + 2 AS sigma, l_linenumber * 0.04::DOUBLE AS eps14, l_linenumber * 0.1::DOUBLE + 1.8::DOUBLE AS sigma14 FROM lineitem)"""
D2 = "((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"
#: Cells of width 5 in the equality, so that no join order compares whole molecules.
_CELLS = ", ".join(f"floor({k} / 5)::BIGINT{{}} AS c{k}" for k in "xyz")
CONTACTS = f"""near AS MATERIALIZED (SELECT graph_id, serial, x, y, z, {_CELLS.format(" + i", " + j", " + k")} FROM atoms, unnest([-1, 0, 1]) AS t(i), unnest([-1, 0, 1]) AS u(j), unnest([-1, 0, 1]) AS w(k) WHERE chain = 'A'),
own AS MATERIALIZED (SELECT graph_id, serial, x, y, z, {_CELLS.format("", "", "")} FROM atoms WHERE chain = 'B'),
contacts AS MATERIALIZED (SELECT a.graph_id, a.serial AS l_serial, b.serial AS r_serial, {D2} AS d2 FROM near a JOIN own b ON a.graph_id = b.graph_id AND a.cx = b.cx AND a.cy = b.cy AND a.cz = b.cz AND {D2} <= 25)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of molecules with heavy ties: grp, mol, pred, y, and 0.1 of each as dockq-like scores."""
    li = table(spark, sf_dir, "lineitem")
    mol = F.row_number().over(Window.partitionBy("l_suppkey").orderBy(*ORDER)).cast("long")
    return li.select(C("l_suppkey").alias("grp"), mol.alias("mol"), (C("l_discount") * 10).alias("pred"), (C("l_tax") * 12.5).alias("y"))


PREDS = f"preds AS (SELECT l_suppkey AS grp, row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(ORDER)}) AS mol, l_discount * 10 AS pred, l_tax * 12.5::DOUBLE AS y FROM lineitem)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.lit(0).cast("long").alias("graph_id"), C("vec_id").alias("serial"), C("label"), *[(40 * C("embedding")[k].cast("double")).alias(c) for k, c in enumerate("xyz")])


POINTS = "points AS (SELECT 0::BIGINT AS graph_id, vec_id AS serial, label, 40 * embedding[1]::DOUBLE AS x, 40 * embedding[2]::DOUBLE AS y, 40 * embedding[3]::DOUBLE AS z FROM embeddings)"


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(C("o_orderkey").alias("graph_id"), C("o_custkey").alias("target"), (C("o_totalprice") % 10).alias("irmsd"), (C("o_totalprice") % 30).alias("lrmsd"), ((C("o_orderkey") % 101) / 100.0).alias("fnat"))


SCORES = "scores AS (SELECT o_orderkey AS graph_id, o_custkey AS target, o_totalprice % 10 AS irmsd, o_totalprice % 30 AS lrmsd, (o_orderkey % 101) / 100.0::DOUBLE AS fnat FROM orders)"


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(C("user_id").alias("prefix"), "ts", C("event_type").alias("metric"), "value", "event_id")


SAMPLES = "samples AS (SELECT user_id AS prefix, ts, event_type AS metric, value, event_id FROM events)"
