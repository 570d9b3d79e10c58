"""Registered queries over whole graphs: all features of the flagship, at both grains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dockgrid.operators import spatial as sp
from dockgrid.plans import views as v
from dockgrid.plans.interface_graphs import build_graphs, feature_summary
from dockgrid.plans.queries import _FRAME, _UNIT, ENERGY, INTERNAL, LJ, NODES, RES_CONTACTS, TOPOLOGY, query
from dockgrid.storage import settle_dealt

C = F.col
LABELS = ["CONST", "H1", "L3", "FR"]


def _annotations(atoms: DataFrame) -> DataFrame:
    """Labels in turn for the residues of chain A; every seventh graph has none, so it fails."""
    own = atoms.filter("chain = 'A' AND graph_id % 7 <> 0").select("graph_id", "res_seq").distinct().withColumn("ord", F.row_number().over(Window.partitionBy("graph_id").orderBy("res_seq")))
    return own.select("graph_id", "ord", F.element_at(F.array(*map(F.lit, LABELS)), (C("ord") % 4 + 1).cast("int")).alias("label"))


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return v.table(spark, d, "embeddings").select(F.concat(C("vec_id").cast("string"), F.lit(".A")).alias("label"), C("embedding").alias("values"))


def _forcefield(spark: SparkSession, atoms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    topology = atoms.filter("atom_name <> 'SD'").select("res_name", "atom_name").distinct().select("*", F.concat(F.lit("t"), (F.ascii("res_name") % 3).cast("string")).alias("type"), ((F.length("atom_name") - 2) * 0.25).alias("charge"))
    classes = spark.createDataFrame([(1, "GLYC", "GLY", [], []), (2, "MAIN", "all", ["CA"], [])], "rule_no int, class string, res_name string, present array<string>, absent array<string>")
    patches = spark.createDataFrame([(1, "MAIN", "modify", "CA", None, -0.5), (2, "MAIN", "add", "O", "t0", None)], "line_no int, class string, action string, atom_name string, type string, charge double")
    params = spark.createDataFrame([("t0", 0.1, 3.0, 0.1, 2.8), ("t1", 0.2, 3.1, 0.1, 2.9)], "type string, eps double, sigma double, eps14 double, sigma14 double")
    return topology, classes, patches, params


# Graphs without annotations fail and are left out.
RAW = v.ATOMS.replace("atoms AS", "every AS", 1)
KEPT = "good AS (SELECT * FROM every WHERE graph_id NOT IN (SELECT graph_id FROM every WHERE graph_id % 7 = 0 AND chain = 'A'))"
PLACED = "ann AS (SELECT graph_id, chain, res_seq, ['CONST', 'H1', 'L3', 'FR'][row_number() OVER (PARTITION BY graph_id ORDER BY res_seq) % 4 + 1] AS label FROM (SELECT DISTINCT graph_id, chain, res_seq FROM atoms WHERE chain = 'A'))"
EMB = "emb AS (SELECT vec_id || '.A' AS label, embedding AS vals FROM embeddings)"
OF_NODES = """SELECT n.graph_id, count(*) AS n_nodes, count(*) FILTER (n.chain = 'B') AS n_antigen, count(DISTINCT coalesce(ann.label, 'AG')) AS n_regions, round(sum(coalesce(e.vals[n.res_seq]::DOUBLE, 0)), 4) AS sum_embedding{more}
 FROM nodes n LEFT JOIN ann ON ann.graph_id = n.graph_id AND ann.chain = n.chain AND ann.res_seq = n.res_seq LEFT JOIN emb e ON e.label = n.graph_id || '.' || n.chain{join} GROUP BY n.graph_id"""
# directed: graph_id, s_chain, s_res, d_chain, d_res.
ORIENT = f"""frames AS (SELECT graph_id, chain, res_seq, {_FRAME} FROM atoms GROUP BY ALL),
w AS (SELECT e.graph_id, {", ".join(f"s.ca_{k} - t.ca_{k} AS w{k}, s.c_{k} - s.ca_{k} AS v1{k}, s.n_{k} - s.ca_{k} AS v2{k}" for k in "xyz")} FROM directed e JOIN frames s ON s.graph_id = e.graph_id AND s.chain = e.s_chain AND s.res_seq = e.s_res JOIN frames t ON t.graph_id = e.graph_id AND t.chain = e.d_chain AND t.res_seq = e.d_res),
w1 AS (SELECT *, {_UNIT("w", "e0", "greatest({n}, 1e-12)")}, {_UNIT("v1", "e1", "{n} + 1e-6")} FROM w),
w2 AS (SELECT *, {", ".join(f"v2{k} - (v2x * e1x + v2y * e1y + v2z * e1z) * e1{k} AS u2{k}" for k in "xyz")} FROM w1), w3 AS (SELECT *, {_UNIT("u2", "e2", "{n} + 1e-6")} FROM w2),
w4 AS (SELECT *, e1y * e2z - e1z * e2y AS e3x, e1z * e2x - e1x * e2z AS e3y, e1x * e2y - e1y * e2x AS e3z FROM w3),
orient AS (SELECT graph_id, round(sum({" + ".join(f"{i} * (e0x * e{i}x + e0y * e{i}y + e0z * e{i}z)" for i in (1, 2, 3))}), 1) AS sum_orientation FROM w4 GROUP BY graph_id)"""
ALL = """SELECT n.*, coalesce(n_interface, 0) AS n_interface, coalesce(n_internal, 0) AS n_internal, min_dist, sum_elec, coalesce(n_attractive, 0) AS n_attractive, sum_area, sum_orientation FROM ({nodes}) n LEFT JOIN s USING (graph_id) LEFT JOIN orient USING (graph_id)"""

FIELD_SQL = f"""{TOPOLOGY.replace("FROM atoms", "FROM every")}, named AS (SELECT graph_id, chain, res_seq, res_name, CASE WHEN res_name = 'GLY' THEN 'GLYC' WHEN count(*) FILTER (atom_name = 'CA') > 0 THEN 'MAIN' END AS class FROM every GROUP BY graph_id, chain, res_seq, res_name),
typed AS (SELECT a.graph_id, a.serial, a.chain, a.res_seq, a.res_name, a.atom_name, a.x, a.y, a.z, CASE WHEN c.class = 'MAIN' AND a.atom_name = 'O' THEN 't0' ELSE t.type END AS type, CASE WHEN c.class = 'MAIN' AND a.atom_name = 'CA' THEN -0.5::DOUBLE ELSE coalesce(t.charge, 0) END AS charge
 FROM good a JOIN named c USING (graph_id, chain, res_seq, res_name) LEFT JOIN topology t ON t.res_name = a.res_name AND t.atom_name = a.atom_name),
atoms AS MATERIALIZED (SELECT *, CASE type WHEN 't0' THEN 0.1::DOUBLE WHEN 't1' THEN 0.2::DOUBLE ELSE 0 END AS eps, CASE type WHEN 't0' THEN 3.0::DOUBLE WHEN 't1' THEN 3.1::DOUBLE ELSE 0 END AS sigma FROM typed)"""


@query(f"""WITH {RAW}, {KEPT}, {FIELD_SQL}, {v.CONTACTS}, {NODES}, {INTERNAL}, {PLACED}, {EMB},
pairs AS (SELECT graph_id, l_serial, r_serial, d2, FALSE AS same FROM contacts UNION ALL SELECT graph_id, l_serial, r_serial, d2, TRUE FROM internal),
e AS (SELECT p.*, a.chain AS l_chain, a.res_seq AS l_res, b.chain AS r_chain, b.res_seq AS r_res, {ENERGY.format(same="p.same")} AS elec, CASE WHEN p.same THEN 0 ELSE {LJ.format(e="eps", s="sigma")} END AS vdw, CASE WHEN NOT p.same AND (l_serial + r_serial) % 3 > 0 THEN round(d2, 3) ELSE 0 END AS area
 FROM (SELECT *, sqrt(d2) AS d FROM pairs) p JOIN atoms a ON a.graph_id = p.graph_id AND a.serial = p.l_serial JOIN atoms b ON b.graph_id = p.graph_id AND b.serial = p.r_serial),
directed AS (SELECT graph_id, l_chain AS s_chain, l_res AS s_res, r_chain AS d_chain, r_res AS d_res FROM e UNION ALL SELECT graph_id, r_chain, r_res, l_chain, l_res FROM e), {ORIENT},
s AS (SELECT graph_id, 2 * count(*) FILTER (NOT same) AS n_interface, 2 * count(*) FILTER (same) AS n_internal, round(min(d), 4) AS min_dist, round(2 * sum(elec), 2) AS sum_elec, 2 * count(*) FILTER (vdw < 0) AS n_attractive, round(2 * sum(area), 2) AS sum_area FROM e GROUP BY graph_id)
{ALL.format(nodes=OF_NODES.format(more="", join=""))}""")
def j11_atom_features(spark, d):
    a = settle_dealt(v.atoms(spark, d).drop("charge", "eps", "sigma", "eps14", "sigma14"), "atoms", by="graph_id")
    areas = sp.contact_pairs(a).filter((C("l_serial") + C("r_serial")) % 3 > 0).select("graph_id", C("l_serial").alias("u"), C("r_serial").alias("v"), F.round("d2", 3).alias("area"))
    return feature_summary(build_graphs(a, forcefield=_forcefield(spark, a), annotations=_annotations(a), embeddings=_embeddings(spark, d), areas=areas, orientation=True))


_LJ_SAME = LJ.format(e="eps14", s="sigma14")


@query(f"""WITH {RAW}, {KEPT}, atoms AS MATERIALIZED (SELECT * FROM good), {RES_CONTACTS}, {PLACED}, {EMB},
nodes AS MATERIALIZED (SELECT graph_id, 'A' AS chain, l_res_seq AS res_seq, l_res_name AS res_name FROM res_contacts UNION SELECT graph_id, 'B', r_res_seq, r_res_name FROM res_contacts),
own AS (SELECT * FROM atoms SEMI JOIN nodes USING (graph_id, chain, res_seq, res_name)),
pairs AS (SELECT graph_id, 'A' AS l_chain, l_res_seq, l_res_name, 'B' AS r_chain, r_res_seq, r_res_name FROM res_contacts
 UNION ALL SELECT DISTINCT a.graph_id, a.chain, a.res_seq, a.res_name, b.chain, b.res_seq, b.res_name FROM own a JOIN own b ON a.graph_id = b.graph_id AND a.chain = b.chain AND (a.res_seq < b.res_seq OR (a.res_seq = b.res_seq AND a.res_name < b.res_name)) AND {v.D2} < 9),
p AS (SELECT r.*, a.charge, a.charge * b.charge AS qq, sqrt({v.D2}) AS d, {", ".join(f"a.{k} AS a_{k}, b.{k} AS b_{k}" for k in ("eps", "sigma", "eps14", "sigma14"))} FROM pairs r JOIN atoms a ON a.graph_id = r.graph_id AND a.chain = r.l_chain AND a.res_seq = r.l_res_seq AND a.res_name = r.l_res_name JOIN atoms b ON b.graph_id = r.graph_id AND b.chain = r.r_chain AND b.res_seq = r.r_res_seq AND b.res_name = r.r_res_name),
e AS (SELECT graph_id, l_chain, l_res_seq, l_res_name, r_chain, r_res_seq, r_res_name, l_chain = r_chain AS same, min(d) AS d, sum(CASE WHEN l_chain = r_chain AND d < 3.6 THEN 0 ELSE 332.0636 * qq / nullif(d, 0) END) AS elec,
 sum(CASE WHEN l_chain = r_chain AND d < 3.6 THEN 0 WHEN l_chain = r_chain AND d < 4.2 THEN {_LJ_SAME.replace("a.", "a_").replace("b.", "b_")} ELSE {LJ.format(e="eps", s="sigma").replace("a.", "a_").replace("b.", "b_")} END) AS vdw FROM p GROUP BY ALL),
directed AS (SELECT graph_id, l_chain AS s_chain, l_res_seq AS s_res, r_chain AS d_chain, r_res_seq AS d_res FROM e UNION ALL SELECT graph_id, r_chain, r_res_seq, l_chain, l_res_seq FROM e), {ORIENT},
centre AS (SELECT graph_id, chain, res_seq, res_name, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM atoms GROUP BY ALL),
normal AS (SELECT *, {", ".join(f"2 * {k} - lag({k}) OVER w - lead({k}) OVER w AS n{k}" for k in "xyz")} FROM centre WINDOW w AS (PARTITION BY graph_id, chain ORDER BY res_seq, res_name)),
sides AS (SELECT a.graph_id, a.chain, a.res_seq, a.res_name, a.nx * (b.x - a.x) + a.ny * (b.y - a.y) + a.nz * (b.z - a.z) AS side FROM normal a JOIN centre b ON a.graph_id = b.graph_id AND a.nx IS NOT NULL AND NOT (a.chain = b.chain AND a.res_seq = b.res_seq AND a.res_name = b.res_name) AND {v.D2} < 144),
hse AS (SELECT graph_id, chain, res_seq, res_name, count(*) FILTER (side > 0) AS up, count(*) FILTER (side <= 0) AS down FROM sides GROUP BY ALL),
s AS (SELECT graph_id, 2 * count(*) FILTER (NOT same) AS n_interface, 2 * count(*) FILTER (same) AS n_internal, round(min(d), 4) AS min_dist, round(2 * sum(elec), 2) AS sum_elec, 2 * count(*) FILTER (vdw < 0) AS n_attractive, round(2 * sum(CASE WHEN NOT same AND (l_res_seq + r_res_seq) % 3 > 0 THEN round(d, 3) ELSE 0 END), 2) AS sum_area FROM e GROUP BY graph_id)
{ALL.format(nodes=OF_NODES.format(more=", sum(coalesce(h.up, 0))::BIGINT AS up, sum(coalesce(h.down, 0))::BIGINT AS down", join=" LEFT JOIN hse h ON h.graph_id = n.graph_id AND h.chain = n.chain AND h.res_seq = n.res_seq AND h.res_name = n.res_name"))}""")
def j11_residue_features(spark, d):
    a = settle_dealt(v.atoms(spark, d), "atoms", by="graph_id")
    c = sp.residue_contacts(a).filter((C("l_res_seq") + C("r_res_seq")) % 3 > 0)
    areas = c.select("graph_id", F.concat_ws(".", F.lit("A"), "l_res_seq", "l_res_name").alias("u"), F.concat_ws(".", F.lit("B"), "r_res_seq", "r_res_name").alias("v"), F.round("d", 3).alias("area"))
    return feature_summary(build_graphs(a, grain="residue", annotations=_annotations(a), embeddings=_embeddings(spark, d), areas=areas, orientation=True, exposure=12.0))
