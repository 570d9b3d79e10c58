"""Operators on tiny tables, invariants, and parity of streams and batches."""

import math
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window, functions as F

from dockgrid import storage
from dockgrid.operators import cluster, energy, evaluate as ev, graph as gr, scoring, spatial as sp, telemetry as tl, workflow as wf
from dockgrid.plans.interface_graphs import FIELD, build_graphs
from dockgrid.storage import cleared
from dockgrid.streaming import streams


def points(spark, n=120, seed=3, turn=None, shift=0.0):
    rng = np.random.default_rng(seed)
    p = rng.uniform(-8, 8, (n, 3))
    q = p @ (turn if turn is not None else np.eye(3)) + shift
    rows = [("g" if k % 2 else "h", "AB"[k % 3 % 2], k, k // 4, "ALA", "CA", 1.6, *map(float, q[k])) for k in range(n)]
    return spark.createDataFrame(rows, "graph_id string, chain string, serial int, res_seq int, res_name string, atom_name string, radius double, x double, y double, z double"), q


def test_radius_join_is_brute_force_and_rigid(spark):
    df, p = points(spark)
    want = {(a, b) for a in range(120) for b in range(120) if a % 2 == b % 2 and a % 3 % 2 == 0 and b % 3 % 2 == 1 and ((p[a] - p[b]) ** 2).sum() <= 9}
    got = {(r["l_serial"], r["r_serial"]) for r in sp.contact_pairs(df, 3.0).collect()}
    assert got == want and got
    c, s = math.cos(0.7), math.sin(0.7)
    moved, _ = points(spark, turn=np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]]), shift=100.3)
    assert {(r["l_serial"], r["r_serial"]) for r in sp.contact_pairs(moved, 3.0).collect()} == want


def test_cutoffs_are_inclusive_across_and_strict_within(spark):
    rows = [("g", "A", 1, 0.0), ("g", "B", 2, 3.0), ("g", "A", 3, 3.0)]
    df = spark.createDataFrame([(*r[:3], "CA", r[3], 0.0, 0.0) for r in rows], "graph_id string, chain string, serial int, atom_name string, x double, y double, z double")
    assert {(r["l_serial"], r["r_serial"]) for r in sp.contact_pairs(df, 3.0).collect()} == {(1, 2), (3, 2)}
    assert sp.internal_pairs(df, 3.0).count() == 0 and sp.internal_pairs(df, 3.01).count() == 1
    assert sp.contact_pairs(df.limit(0), 3.0).count() == 0


def spheres(spark, rows):
    """rows: graph_id, serial, radius, x, y, z."""
    return spark.createDataFrame([(g, "A" if k % 2 else "B", k, k // 3, "ALA", r, x, y, z) for g, k, r, x, y, z in rows], "graph_id string, chain string, serial int, res_seq int, res_name string, radius double, x double, y double, z double")


def test_surface(spark):
    df, _ = points(spark, 40)
    alone = {r["serial"]: r["area"] for r in sp.sasa(df, by_chain=True).collect()}
    whole = {r["serial"]: r["area"] for r in sp.sasa(df).collect()}
    assert all(whole[k] <= alone[k] + 1e-9 for k in alone) and len(whole) == 40
    one = df.limit(1)
    assert sp.sasa(one).first()["area"] == pytest.approx(4 * math.pi * 9)
    assert all(r["bsa"] >= -1e-9 for r in sp.bsa(df).collect())


def test_two_spheres_hide_a_cap_of_each_other(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for k in range(60):
        r, q, d = rng.uniform(2.2, 3.4, 3).tolist()
        u = rng.normal(size=3)
        u *= d / np.linalg.norm(u)
        c = rng.uniform(-20, 20, 3)
        rows += [(f"g{k}", 1, r - 1.4, *c.tolist()), (f"g{k}", 2, q - 1.4, *(c + u).tolist())]
        for serial, a, b in ((1, r, q), (2, q, r)):
            depth = min(max(a - (d * d + a * a - b * b) / (2 * d), 0), 2 * a)
            want[f"g{k}", serial] = 2 * math.pi * a * (2 * a - depth)
    got = {(r["graph_id"], r["serial"]): r["area"] for r in sp.sasa(spheres(spark, rows), slices=400).collect()}
    assert all(got[k] == pytest.approx(want[k], rel=4e-3, abs=0.05) for k in want)
    few = {(r["graph_id"], r["serial"]): r["area"] for r in sp.sasa(spheres(spark, rows)).collect()}
    assert np.mean([abs(few[k] - want[k]) / want[k] for k in want]) < 0.03


def test_spheres_alike_or_within_others_or_nowhere(spark):
    rows = [("same", k, 1.6, 1.0, 2.0, 3.0) for k in (4, 2, 9)] + [("within", 1, 4.0, 0.0, 0.0, 0.0), ("within", 2, 1.0, 0.5, 0.0, 0.0), ("touch", 1, 1.6, 0.0, 0.0, 0.0), ("touch", 2, 1.6, 6.0, 0.0, 0.0)]
    rows += [("odd", 1, 1.6, None, 0.0, 0.0), ("odd", 2, 1.6, 0.0, 0.0, 0.0), ("odd", 3, 1.6, float("nan"), 0.0, 0.0), ("odd", 4, 1.6, float("inf"), 0.0, 0.0), ("odd", 5, None, 0.0, 0.0, 0.0), (None, 6, 1.6, 0.0, 0.0, 0.0)]
    got = {(r["graph_id"], r["serial"]): r["area"] for r in sp.sasa(spheres(spark, rows)).collect()}
    full = pytest.approx(4 * math.pi * 9)
    assert got == {("same", 2): full, ("same", 4): 0, ("same", 9): 0, ("within", 1): pytest.approx(4 * math.pi * 5.4**2), ("within", 2): 0, ("touch", 1): full, ("touch", 2): full, ("odd", 1): None, ("odd", 2): full, ("odd", 3): None, ("odd", 4): None, ("odd", 5): None, (None, 6): None}
    assert sp.sasa(spheres(spark, rows[:1]).limit(0)).count() == 0
    named = spark.createDataFrame([("g", "A", k, 1, "ALA", n, 50.0 * k, 0.0, 0.0) for k, n in enumerate(["N", "CA", " OG", "SD", "X1", None])], "graph_id string, chain string, serial int, res_seq int, res_name string, atom_name string, x double, y double, z double")
    assert [r["radius"] for r in sp.element_radius(named).orderBy("serial").collect()] == [1.55, 1.7, 1.52, 1.8, 1.7, 1.7]


def surface_points(p, r, slices=20, around=360):
    """Points of the slices' circles that lie in no other sphere, by trying them all: coordinates and owners."""
    angle = 2 * np.pi * np.arange(around) / around
    out, owner = [], []
    for i in range(len(p)):
        for k in range(slices):
            h = r * ((2 * k + 1) / slices - 1)
            rho = math.sqrt(r * r - h * h)
            s = p[i] + np.column_stack((rho * np.cos(angle), rho * np.sin(angle), np.full(around, h)))
            d2 = ((s[:, None] - p[None]) ** 2).sum(2)
            d2[:, i] = np.inf
            s = s[(d2 >= r * r).all(1)]
            out.append(s)
            owner += [i] * len(s)
    return np.concatenate(out), np.array(owner)


def test_depth_has_no_cap(spark):
    rng = np.random.default_rng(5)
    p = rng.uniform(-6, 6, (300, 3))
    p = p[(p**2).sum(1) <= 36]
    rows = [("ball", k, 1.6, *map(float, x)) for k, x in enumerate(p)] + [("one", 1, 1.6, 500.0, 0.0, 0.0), ("none", 1, 1.6, None, 0.0, 0.0)]
    df = spheres(spark, rows)
    s, owner = surface_points(p, 3.0)
    areas = {r["serial"]: r["area"] for r in sp.sasa(df.filter("graph_id = 'ball'")).collect()}
    tried = np.bincount(owner, minlength=len(p)) * 4 * math.pi * 9 / (20 * 360)
    assert all(areas[k] == pytest.approx(tried[k], abs=0.4) for k in areas)
    d = np.sqrt(((p[:, None] - s[None]) ** 2).sum(2).min(1))
    got = {(r["graph_id"], r["chain"], r["res_seq"]): r["depth"] for r in sp.residue_depth(df, 1.5).collect()}
    assert d.max() > 5 and got["one", "A", 0] == pytest.approx(3) and got["none", "A", 0] is None
    want = {}
    for k, x in enumerate(d):
        want.setdefault(("ball", "A" if k % 2 else "B", k // 3), []).append(x)
    assert all(got[k] == pytest.approx(np.mean(x), abs=0.08) for k, x in want.items()) and len(got) == len(want) + 2


def test_surfaces_hold_slabs_and_write_no_arcs(spark):
    """no row a copy or a list of neighbours below the step, and nothing like an arc is written for atoms that show."""
    rng = np.random.default_rng(11)
    rows = [(f"g{k % 4}", k, 1.6, *map(float, x)) for k, x in enumerate(rng.uniform(0, 40, (8000, 3)))]
    df = spheres(spark, rows).repartition(3)
    plan = sp.sasa(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan
    with cleared(spark):
        sp.residue_depth(df).write.format("noop").mode("overwrite").save()
        root = storage._OPEN[-1][0].rpartition("/")[0].removeprefix("file://")
        made = sum(f.stat().st_size for at in storage._OPEN[-1] for f in Path(at.removeprefix("file://")).rglob("*.parquet"))
    assert Path(root).is_dir() and made < 120 * len(rows)
    # However the rows come, and by slabs or at once, areas are the same.
    atoms = df.filter("graph_id = 'g1'").withColumn("r", F.col("radius") + 1.4).withColumn("slab", F.floor(F.col("x") / 6.1)).withColumn("place", F.row_number().over(Window.orderBy("slab")))
    atoms = pa.Table.from_pandas(atoms.drop("radius").orderBy("place").toPandas())
    got = [pa.Table.from_batches(list(sp._sliced(20, 6.1, True, True, False, least, most)(atoms.to_batches(max_chunksize=70)))).to_pandas() for least, most in ((100, 37), (10**6, 1000))]
    assert len(got[0]) == atoms.num_rows and all(np.allclose(got[0][c], got[1][c], atol=1e-8) for c in ("serial", "area", "alone"))
    with pytest.raises(RuntimeError, match="one sequence"):
        list(sp._sliced(20, 6.1, True, True, False, 100)(atoms.take(pa.array(rng.permutation(atoms.num_rows))).to_batches()))


def test_contrastive_loss_makes_no_row_a_pair(spark):
    """batches are arrays; nulls and rows that are alike count as in a join of the batch with itself."""
    rng = np.random.default_rng(2)
    rows = [(k % 3, k, float(rng.normal()), float(rng.normal())) for k in range(30)] + [(0, 0, None, 1.0), (1, 91, 0.5, None), (None, 92, 0.5, 0.5), (5, 93, None, None)]
    rows += [rows[2], rows[2], rows[5]]
    got = ev.contrastive_loss(spark.createDataFrame(rows, "b int, i int, p double, y double"), "b", "i", "p", "y", 0.7)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for b in (0, 1, 2, 5):
        terms = []
        for _, i, p, y in {r for r in rows if r[0] == b}:
            ls = [-((p - t) ** 2) / 1.4 for _, j, q, u in rows if (_, j, q, u) == (b, i, p, y) for c, *_x, t in rows if c == b and t is not None] if p is not None else []
            if ls and y is not None:
                terms.append(math.log(sum(map(math.exp, ls))) + (p - y) ** 2 / 1.4)
        want[b] = 1.4 * sum(terms) / len(terms) if terms else None
    assert {r["b"]: r["loss"] for r in got.collect()} == {b: None if w is None else pytest.approx(w) for b, w in want.items()}


def test_rmsd_ignores_rigid_motion(spark):
    a, p = points(spark, 30)
    c, s = math.cos(1.1), math.sin(1.1)
    b, _ = points(spark, 30, turn=np.array([[1, 0, 0], [0, c, -s], [0, s, c]]), shift=4.0)
    pairs = a.join(b.select("serial", *[F.col(k).alias(f"r{k}") for k in "xyz"]), "serial")
    assert all(r["rmsd"] < 1e-5 for r in sp.superposed_rmsd(pairs).collect())
    off = pairs.withColumn("rx", F.col("rx") + F.when(F.col("serial") == 3, 2.0).otherwise(0.0))
    assert max(r["rmsd"] for r in sp.superposed_rmsd(off).collect()) > 0.1


def triangles(spark):
    e = [(1, 2), (2, 3), (1, 3), (4, 5), (5, 6), (4, 6), (3, 4)]
    edges = spark.createDataFrame([("g", a, b, 1.0) for a, b in e], "graph_id string, src int, dst int, weight double")
    return spark.createDataFrame([("g", k) for k in range(1, 8)], "graph_id string, node int"), edges


def groups(rows, key="cluster"):
    out = {}
    for r in rows:
        out.setdefault(r[key], set()).add(r["node"])
    return sorted(map(sorted, out.values()))


def test_clusters_of_two_triangles(spark):
    nodes, edges = triangles(spark)
    want = [[1, 2, 3], [4, 5, 6], [7]]
    assert groups(cluster.mcl(nodes, edges).collect()) == want
    found = cluster.louvain(nodes, edges)
    assert groups(found.collect()) == want
    assert cluster.modularity(edges, found).first()["modularity"] == pytest.approx(2 * (3 / 7 - (7 / 14) ** 2))
    deep = cluster.cluster_hierarchy(nodes, edges).collect()
    assert groups(deep, "depth_0") == want and len({r["depth_1"] for r in deep}) <= 3


def test_pairs_within_a_table_come_once(spark):
    """own_pairs against all pairs: points on borders of cells, at negative places, equal places, equal orders and without a place; half of the copies."""
    rng = np.random.default_rng(6)
    xyz = rng.integers(-12, 13, (300, 3)) * 0.75
    rows = [(f"g{k % 2}", k // 4, *map(float, p)) for k, p in enumerate(xyz)] + [("g0", 900, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "graph_id string, serial int, x double, y double, z double")
    for strict in (True, False):
        found = sp.own_pairs(df, 3.0, ("serial",), strict=strict)
        key = lambda r, p: (r[f"{p}_serial"], r[f"{p}_x"], r[f"{p}_y"], r[f"{p}_z"])
        got = sorted((r["l_graph_id"], key(r, "l"), key(r, "r"), r["d2"]) for r in found.collect())
        d2 = lambda a, b: sum((u - v) ** 2 for u, v in zip(a[2:], b[2:], strict=True))
        want = sorted((a[0], a[1:], b[1:], d2(a, b)) for a in rows[:-1] for b in rows[:-1] if a[0] == b[0] and a[1] < b[1] and (d2(a, b) < 9 if strict else d2(a, b) <= 9))
        assert got == want and len(want) > 100


def test_residue_pairs_move_each_atom_once(spark):
    """Atoms are dealt before they are copied into cells, and nothing moves after that."""
    rows = [("g", c, k % 9, "ALA", "CA", k, float(k % 7), float(k % 5), 0.0) for k in range(60) for c in "AB"]
    atoms = spark.createDataFrame(rows, "graph_id string, chain string, res_seq int, res_name string, atom_name string, serial int, x double, y double, z double")
    for found in (sp.residue_internal_pairs(atoms), sp.residue_contacts(atoms)):
        moved = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
        assert moved and not any("cell_" in line or "d2" in line for line in moved)


def test_surface_features_are_found_in_one_sweep(spark, monkeypatch):
    """Buried areas and depths of a graph's nodes read one surface and no further contacts, and are what each gives alone."""
    rng = np.random.default_rng(12)
    rows = [("g", "AB"[k % 2], k % 13, ["ALA", "GLY"][k % 3 % 2], "CA", k, *map(float, rng.uniform(0, 9, 3))) for k in range(120)]
    kinds = "graph_id string, chain string, res_seq int, res_name string, atom_name string, serial int, x double, y double, z double"
    atoms = spark.createDataFrame(rows, kinds).withColumns({k: F.lit(0.5) for k in FIELD})
    key = ["graph_id", "chain", "res_seq", "res_name"]
    plain = lambda df: sorted((*r[:4], round(r[4], 9)) for r in df.collect())
    alone = plain(sp.bsa(atoms)), plain(sp.residue_depth(atoms))
    every = build_graphs(atoms, grain="residue", surface=True)
    asked, sweep, contacts = [], sp._surfaces, []
    monkeypatch.setattr(sp, "_surfaces", lambda *a: asked.append(a[3:]) or sweep(*a))
    monkeypatch.setattr(sp, "contact_pairs", lambda *a, **k: contacts.append(a))
    nodes = build_graphs(atoms, grain="residue", surface=True, with_edges=False)
    both = [plain(x["nodes"].select(*key, k)) for k in ("bsa", "depth", "x", "node_idx") for x in (nodes, every)]
    assert "edges" not in nodes and both[::2] == both[1::2] and both[0]
    assert [a for a in asked if True not in a] == [(("alone", "area"),)] and not contacts
    found = plain(nodes["nodes"].select(*key, "bsa")), plain(nodes["nodes"].select(*key, "depth"))
    assert set(found[0]) <= set(alone[0]) and set(found[1]) <= set(alone[1])


def test_chains_move_no_row_a_kmer(spark):
    """Sequences meet once, by key; a query longer than its target, repeats alone and keys without seeds or letters included."""
    rows = [("a", "TTACGTACCA", "ACGTACC"), ("b", "ACGACGACG", "ACGACG"), ("c", "AAAA", "CCCC"), ("d", None, "ACGT"), ("e", "ACG", "")]
    df = spark.createDataFrame(rows, "mol string, q string, t string")
    found = wf.locate_by_chain(df.selectExpr("mol", "q AS sequence"), df.selectExpr("mol", "t AS sequence"), 3)
    assert sorted(map(tuple, found.collect())) == [("a", -1, 8, 4, 0), ("b", 1, 9, 4, 0)]
    assert "gram" not in found._jdf.queryExecution().executedPlan().toString()


def test_small_graphs_are_clustered_in_tasks(spark, monkeypatch):
    """Graphs of few rows take no join a step; they get what joins of matrix entries give, alone or beside a graph that is too large."""
    rng = np.random.default_rng(4)
    rows = {(f"g{g}", int(a), int(b)) for g, n in enumerate((3, 9, 40, 150)) for a, b in rng.integers(0, n, (3 * n // 2, 2))}
    edges = spark.createDataFrame(sorted(rows), "graph_id string, src long, dst long")
    nodes = spark.createDataFrame([(f"g{g}", k) for g, n in enumerate((3, 9, 40, 150)) for k in range(n)], "graph_id string, node long")
    plain = lambda df: sorted(map(tuple, df.collect()))
    want = plain(cluster.mcl(nodes, edges, most_rows=0))
    assert plain(cluster.mcl(nodes, edges, most_rows=200)) == want and len(want) == 202
    monkeypatch.setattr(cluster, "mcl_step", None)
    assert plain(cluster.mcl(nodes, edges)) == want
    graph, a, b = (np.array(x) for x in zip(*[(int(g[1:]), x, y) for g, x, y in rows] + [(3, k, k) for k in range(150)], strict=True))
    i, j, v = a[graph == 3], b[graph == 3], np.ones((graph == 3).sum())
    at = np.lexsort((i, j))
    whole, cut = (cluster._columns_step(i[at], j[at], v, 150, 2.0, 0.001, most) for most in (10**6, 1))
    assert all(np.array_equal(x, y) for x, y in zip(whole, cut, strict=True))


def test_embeddings_on_missing(spark):
    nodes = spark.createDataFrame([("m", "A", 1), ("m", "A", 9), ("n", "A", 1)], "mol string, chain string, res_seq int")
    emb = spark.createDataFrame([("m.A", [0.5, 0.25])], "label string, values array<float>")
    got = {(r["mol"], r["res_seq"]): (r["embedding"], r["missing"]) for r in gr.inject_embeddings(nodes, emb).collect()}
    assert got == {("m", 1): (0.5, None), ("m", 9): (0.0, "bounds"), ("n", 1): (0.0, "label")}
    with pytest.raises(Exception, match="no embedding"):
        gr.inject_embeddings(nodes, emb, "error").collect()


def test_areas_prefer_the_nonzero_direction(spark):
    e = spark.createDataFrame([("g", 1, 2), ("g", 2, 1), ("g", 3, 4)], "graph_id string, src int, dst int")
    a = spark.createDataFrame([("g", 1, 2, 0.0), ("g", 2, 1, 7.5)], "graph_id string, u int, v int, area double")
    assert {(r["src"], r["dst"]): r["voro_area"] for r in gr.attach_contact_areas(e, a).collect()} == {(1, 2): 7.5, (2, 1): 7.5, (3, 4): 0.0}


def test_orientation_is_at_most_one_long(spark):
    df, _ = points(spark, 40)
    a = df.withColumn("atom_name", F.element_at(F.array(*map(F.lit, ["N", "CA", "C", "O"])), F.col("serial") % 4 + 1)).withColumn("graph_id", F.lit("g")).withColumn("chain", F.lit("A"))
    e = spark.createDataFrame([("g", "A", 1, "A", 2), ("g", "A", 3, "A", 3), ("g", "A", 1, "A", 99)], "graph_id string, s_chain string, s_res int, d_chain string, d_res int")
    got = {(r["s_res"], r["d_res"]): r["orientation"] for r in gr.edge_orientation(e, gr.backbone(a)).collect()}
    assert len(got) == 3 and all(sum(x * x for x in o) <= 1 + 1e-6 for o in got.values()) and got[3, 3] == [0.0, 0.0, 0.0]


def test_early_stop_needs_min_delta(spark):
    log = spark.createDataFrame([("r", k, m) for k, m in enumerate([5.0, 4.0, 3.95, 3.9, 3.85, 1.0])], "run string, epoch int, mse double")
    assert ev.early_stop_point(log, 2, 0.5).first()["stop_epoch"] == 3
    assert ev.early_stop_point(log, 2, 0.0).first()["stop_epoch"] is None
    nan = spark.createDataFrame([("r", 0, float("nan")), ("r", 1, 2.0), ("r", 2, 1.0)], "run string, epoch int, mse double")
    assert [r["epoch"] for r in ev.top_k_epochs(nan, 1).collect()] == [2]


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 1.0, 1), ("a", 2.0, 1), ("b", 1.0, 1)], "k string, s double, y int")
    assert {r["k"]: r["auc"] for r in ev.roc_auc(df, ["k"], "s", "y").collect()} == {"a": 0.75, "b": None}


def test_filter_by_score(spark):
    df = spark.createDataFrame([(0.6, 1.0), (0.4, 1.0), (None, 1.0)], "dockq double, irmsd double")
    assert ev.filter_by_score(df, {"dockq": ">0.5"}).count() == 1 and ev.filter_by_score(df, {"irmsd": "==1"}).count() == 3
    with pytest.raises(ValueError):
        ev.filter_by_score(df, {"dockq": 0.5})


def test_label_regions_walks_the_numbering(spark):
    rows = [("m", "H", "XACDE", 2, [(26, "A"), (27, "-"), (28, "C"), (56, "E")]), ("m", "L", "XACDE", 1, [(105, "X"), (1, "Q")])]
    df = spark.createDataFrame(rows, "mol string, role string, sequence string, start int, numbering array<struct<position:int,aa:string>>")
    got = {r["role"]: r["labels"] for r in wf.label_regions(df).collect()}
    assert got == {"H": ["CONST", "CONST", "H1", "CONST", "H2"], "L": ["L3", "CONST", "CONST", "CONST", "CONST"]}
    assert wf.merge_regions(wf.label_regions(df)).first()["labels"] == ["L3", "CONST", "H1", "CONST", "H2"]


def test_regions_of_odd_chains_and_no_row_a_place(spark):
    rows = [("a", "H", "", 1, [(27, "A")]), ("b", "H", "AB", 1, [(27, "A"), (28, None), (29, "B")]), ("b", "L", "ABC", 1, [(56, "B"), (105, "X")]), ("c", "H", None, 1, None), ("d", "L", "ABA", 2, [(27, "A")]), ("e", "L", "AB", 1, None)]
    df = spark.createDataFrame(rows, "mol string, role string, sequence string, start int, numbering array<struct<position:int,aa:string>>")
    merged = wf.merge_regions(wf.label_regions(df))
    got = {r["mol"]: r["labels"] for r in merged.collect()}
    assert got == {"a": [], "b": ["H1", "L2", "CONST"], "c": [], "d": ["CONST", "CONST", "L1"], "e": ["CONST", "CONST"]}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("ArrowEvalPython") == 1


def test_bins_and_balance(spark):
    files = spark.createDataFrame([(k, s) for k, s in enumerate([50, 60, 10, 10, 10, 200, 5])], "ord int, size int")
    got = {r["ord"]: r["bin"] for r in wf.bin_by_size(files, 100, 3).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 2, 5: 3, 6: 4}
    items = spark.createDataFrame([("a", 10), ("b", 9), ("c", 3), ("d", 2)], "label string, length int")
    got = {r["label"]: r["bin"] for r in wf.balance_by_load(items, 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_renumbering_modes(spark):
    rows = [("g", "L", 5, None, False, 1), ("g", "H", 2, "A", False, 2), ("g", "H", 2, None, False, 3), ("g", "T", 1, None, True, 4), ("g", "Z", 1, None, False, 5)]
    df = spark.createDataFrame([(*r, "ALA", "CA", 0.0, 0.0, 0.0) for r in rows], "graph_id string, chain string, res_seq int, icode string, het boolean, serial int, res_name string, atom_name string, x double, y double, z double")
    roles = {"H": ("A", 0), "L": ("A", 1), "T": ("B", 0)}
    by = lambda mode: {r["serial"]: (r["chain"], r["res_seq"]) for r in wf.merge_and_renumber(df, roles, mode).collect()}
    assert by("file") == {2: ("A", 1), 3: ("A", 2), 1: ("A", 3), 4: ("B", 1)}
    assert by("sorted") == {3: ("A", 1), 2: ("A", 2), 1: ("A", 3), 4: ("B", 1)}


def test_message_passing_is_numpy(spark):
    rng = np.random.default_rng(1)
    h, x = rng.normal(size=(5, 3)), rng.normal(size=(5, 3)) * 4
    w = scoring.random_weights(3, 1, seed=2)
    w["norm"] = (rng.normal(size=3), rng.normal(size=3))
    e = [(0, 1, 0.5), (1, 2, -1.0), (2, 1, 2.0), (3, 9, 1.0)]
    nodes = spark.createDataFrame([("g", k, list(map(float, h[k])), list(map(float, x[k]))) for k in range(5)], "graph_id string, node int, h array<double>, x array<double>")
    edges = spark.createDataFrame([("g", a, b, [f]) for a, b, f in e], "graph_id string, src int, dst int, f array<double>")

    def sigmoid(v):
        return 1 / (1 + np.exp(-v))

    def linear(v, layer):
        return layer[0] @ v + layer[1]

    dh, dx = np.zeros((5, 3)), np.zeros((5, 3))
    for a, b, f in e[:3]:
        r = x[a] - x[b]
        d = np.sqrt((r * r).sum())
        m = np.concatenate((h[a], h[b], [np.exp(-(((d - 30 / 17 * k) / (30 / 18 + 1e-8)) ** 2)) for k in range(18)], [f]))
        for layer in w["message"]:
            m = linear(m, layer)
            m = m * sigmoid(m)
        m = m * sigmoid(linear(np.maximum(0, linear(m, w["gate"][0])), w["gate"][1]))
        u = linear(m, w["update"][0])
        dh[b] += u * sigmoid(u)
        u = linear(m, w["move"][0])
        dx[b] += r * linear(u * sigmoid(u), w["move"][1]) * 0.08
    v = h + sigmoid(0.8) * dh
    want = (v - v.mean(1, keepdims=True)) / np.sqrt(v.var(1, keepdims=True) + 1e-5) * w["norm"][0] + w["norm"][1]
    got = {r["node"]: r for r in scoring.message_passing_layer(nodes, edges, w).collect()}
    assert np.allclose([got[k]["h"] for k in range(5)], want) and np.allclose([got[k]["x"] for k in range(5)], x + dx)
    assert scoring.message_passing_layer(nodes, edges.limit(0), w).count() == 5


def test_failing_models_become_rows(spark):
    nodes = spark.createDataFrame([("a", 1), ("b", 2)], "graph_id string, v int")

    def model(n, e):
        if n["v"].iloc[0] == 2:
            raise ValueError("x" * 5000)
        return 0.5

    got = {r["graph_id"]: r for r in scoring.score_graphs(nodes, nodes, model).collect()}
    assert got["a"]["score"] == 0.5 and got["b"]["status"] == "fail" and len(got["b"]["error"]) == 2000


def test_stream_is_batch(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"p{rng.randrange(3)}", "cpu", 1_700_000_000 + rng.randrange(4000), float(rng.randrange(100))) for _ in range(300)]
    df = spark.createDataFrame(rows, "prefix string, metric string, t long, value double").select("prefix", "metric", F.timestamp_seconds("t").alias("ts"), "value")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    q = streams.metric_windows(stream, "10 minutes", "2 hours").writeStream.format("memory").queryName("windows").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, streams.metric_windows(df, "10 minutes", "2 hours").collect()))


def test_ingest_goes_on_where_it_ended(spark, tmp_path):
    seen = []
    schema = "k int"
    spark.createDataFrame([(1,), (2,)], schema).write.parquet(str(tmp_path / "in"))
    run = lambda: streams.ingest(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "log"), lambda df, n: seen.extend(r["k"] for r in df.collect())).awaitTermination()
    run()
    spark.createDataFrame([(3,)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(seen) == [1, 2, 3]


def test_gaps_keep_microseconds(spark):
    """Of a gap of 0.05887 seconds in 2024, whose ends as doubles of seconds are 0.0588701 apart."""
    rows = [("h", "d", "2024-01-14 10:49:26.417201", 0.0), ("h", "d", "2024-01-14 10:49:26.476071", 17.58), ("h", "d", "2024-01-14 10:49:26.534941", 17.58)]
    df = spark.createDataFrame(rows, "host string, dev string, t string, n double").withColumn("ts", F.col("t").cast("timestamp"))
    rates = sorted(r["rate"] for r in tl.counter_rates(df, "host", "dev", "ts", "n").collect())
    assert rates == pytest.approx([0.0, 0.0, 17.58 / 0.05887 / 1048576], rel=1e-12)
    assert tl.median_sampling(df, "host", "ts").first()["sampling"] == pytest.approx(0.05887, rel=1e-12)
    assert max(r["rel"] for r in tl.relative_time(df, "host", "ts", "t").collect()) == pytest.approx(0.11774, rel=1e-12)
    assert tl.progress_eta(df, "host", "ts", 4).first()["eta"] == pytest.approx(0.05887, rel=1e-12)


def test_gaps_and_relative_time(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, None), ("a", 3, 14), ("b", 1, None), ("b", 2, None)], "p string, k int, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = {(r["p"], r["k"]): r["rel"] for r in tl.relative_time(df, "p", "ts", "k").collect()}
    assert got == {("a", 1): 0.0, ("a", 2): 0.0, ("a", 3): 4.0, ("b", 1): 0.0, ("b", 2): 1.0}


def test_evaluate_by_several_columns(spark):
    rows = [("v", 1, k, 0.9 - k / 100, 0.9) for k in range(4)] + [("v", 2, 10 + k, 0.5, 0.1) for k in range(4)] + [("w", 1, 20, 0.5, 0.9), ("w", 1, 21, 0.4, 0.1)]
    df = spark.createDataFrame(rows, "phase string, epoch int, mol int, pred double, y double")
    got = {(r["phase"], r["epoch"]): (r["hitrate"], r["success"]) for r in ev.evaluate(df, "dockq", 0.23, ["phase", "epoch"], "mol", 2).collect()}
    assert got == {("v", 1): (1.0, 1), ("v", 2): (0.0, 0), ("w", 1): (0.5, 1)}
    assert ev.evaluate(df, "dockq", 0.23, [], "mol", 2).first()["hitrate"] == 1.0


def test_places_and_job_order(spark):
    df = spark.range(500).select(F.lit("x").alias("g"), F.col("id"), (F.col("id") % 7).alias("size"))
    got = {r["id"]: (r["_r"], r["_n"], r["_sum"]) for r in wf.placed(df, "g", [F.col("size").desc(), F.col("id")], "size").collect()}
    total = 0
    for k, (size, i) in enumerate(sorted((-(i % 7), i) for i in range(500)), 1):
        total -= size
        assert got[i] == (k, 500, total)
    names = ["stage_50879909_7_host", "plain", "stage_50879909_12", "stage_10000_3_a"]
    assert [r["prefix"] for r in wf.order_by_job(spark.createDataFrame([(n,) for n in names], "prefix string")).collect()] == ["plain", "stage_10000_3_a", "stage_50879909_7_host", "stage_50879909_12"]


def test_start_walks_left_to_the_first_letter(spark):
    q = spark.createDataFrame([("a", "QWERTYUIOPAS"), ("b", "CDEFGHIJKLMN")], "mol string, sequence string")
    t = spark.createDataFrame([("a", "xxQQzzWERTYUIOPAS"), ("b", "zzzzCDEFGHIJKLMN")], "mol string, sequence string")
    assert {r["mol"]: r["start"] for r in wf.locate_subsequence(q, t, 6).collect()} == {"a": 4, "b": 5}


def test_residue_graphs(spark):
    from dockgrid.plans.interface_graphs import build_graphs

    kinds = "graph_id int, serial long, chain string, res_seq int, res_name string, atom_name string, x double, y double, z double, charge double, eps double, sigma double, eps14 double, sigma14 double"
    atom = lambda g, s, c, n, r, a, x: (g, s, c, n, r, a, x, 0.0, 0.0, 0.5, 0.1, 3.0, 0.1, 3.0)
    rows = [atom(1, 1, "A", 1, "ALA", "CA", 0.0), atom(1, 2, "A", 1, "ALA", "CB", 1.0), atom(1, 3, "A", 2, "GLY", "CA", 2.5), atom(1, 4, "B", 1, "SER", "CA", 4.0), atom(1, 5, "B", 9, "HOH", "O", 3.0), atom(2, 1, "A", 1, "ALA", "CA", 0.0)]
    rows += [(1, None, None, None, None, None, None, None, None, None, None, None, None, None)]
    atoms = spark.createDataFrame(rows, kinds)
    labels = spark.createDataFrame([(1, 1, "H1"), (1, 2, "nowhere"), (2, 1, "H1")], "graph_id int, ord int, label string")
    got = build_graphs(atoms, grain="residue", exposure=12.0)
    assert {r["residue"]: r["node_idx"] for r in got["nodes"].collect()} == {"A.1.ALA": 0, "A.2.GLY": 1, "B.1.SER": 2}
    dist = {(r["src_idx"], r["dst_idx"], r["edge_type"]): r["dist"] for r in got["edges"].collect()}
    assert dist == {(0, 2, "interface"): 3.0, (2, 0, "interface"): 3.0, (1, 2, "interface"): 1.5, (2, 1, "interface"): 1.5, (0, 1, "internal"): 1.5, (1, 0, "internal"): 1.5}
    failed = build_graphs(atoms, annotations=labels)
    assert [r["graph_id"] for r in failed["failed"].collect()] == [1] and failed["nodes"].count() == 0
    for grain in ("atom", "residue"):
        empty = build_graphs(atoms.limit(0), grain=grain, annotations=labels, orientation=True)
        assert empty["nodes"].count() == empty["edges"].count() == empty["failed"].count() == 0


def modularity_of(edges, label):
    """edges: {(a, b): weight}, each once."""
    two = 2 * sum(edges.values())
    tot, inner = {}, {}
    for (a, b), w in edges.items():
        for x in (a, b):
            tot[label[x]] = tot.get(label[x], 0) + w
        if label[a] == label[b]:
            inner[label[a]] = inner.get(label[a], 0) + w
    return sum(2 * inner.get(c, 0) / two - (t / two) ** 2 for c, t in tot.items())


def test_modularity_grows_from_level_to_level(spark):
    graphs = {}
    ring = {}
    for c in range(30):  # thirty cliques in a ring: pairs of them are better together
        nodes = range(5 * c, 5 * c + 5)
        ring |= {(a, b): 1.0 for a in nodes for b in nodes if a < b}
        ring[tuple(sorted((5 * c, (5 * c + 6) % 150)))] = 1.0
    graphs["ring"] = ring
    rng = np.random.default_rng(4)
    for g in range(4):
        graphs[f"small{g}"] = {(a, b): float(rng.integers(1, 4)) for a in range(7) for b in range(a, 7) if rng.random() < 0.4}
    rows = [(g, a, b, w) for g, e in graphs.items() for (a, b), w in e.items()]
    edges = spark.createDataFrame(rows, "graph_id string, src int, dst int, weight double")
    nodes = spark.createDataFrame([*{(g, x) for g, a, b, _ in rows for x in (a, b)}, ("ring", 999)], "graph_id string, node int")
    one, many = {}, {}
    for out, found in ((one, cluster.local_moves(nodes, edges)), (many, cluster.louvain(nodes, edges))):
        for r in found.collect():
            out.setdefault(r["graph_id"], {})[r["node"]] = r["cluster"]
    for g, e in graphs.items():
        q1, q2 = modularity_of(e, one[g]), modularity_of(e, many[g])
        assert q2 >= q1 - 1e-9
        assert all(many[g][x] == min(y for y in many[g] if many[g][y] == many[g][x]) for x in many[g])
        near = {(x, y) for a, b in e for x, y in ((a, b), (b, a))}
        # No node's move to a neighbour's cluster is better after the first level, no union of neighbouring clusters after the last.
        assert all(modularity_of(e, one[g] | {x: one[g][y]}) <= q1 + 1e-6 for x, y in near)
        assert all(modularity_of(e, {n: many[g][y] if c == many[g][x] else c for n, c in many[g].items()}) <= q2 + 1e-6 for x, y in near)
    assert modularity_of(ring, many["ring"]) > 0.88 > modularity_of(ring, {x: x // 5 for x in range(150)}) and many["ring"][999] == 999
    loops = cluster.contract(edges, spark.createDataFrame([(g, x, c) for g in many for x, c in many[g].items()], "graph_id string, node int, cluster int"))
    back = {}
    for r in loops.collect():
        back.setdefault(r["graph_id"], {})[r["src"], r["dst"]] = r["weight"]
    assert all(modularity_of(back[g], {x: x for k in back[g] for x in k}) == pytest.approx(modularity_of(e, many[g])) for g, e in graphs.items())
    assert cluster.louvain(nodes.limit(0), edges.limit(0)).count() == 0


def folded(sizes, target, max_n, min_n):
    bin_ = n = total = 0
    out = []
    for s in sizes:
        if (n >= max_n or total + s > target) and n >= min_n:
            bin_, n, total = bin_ + 1, 0, 0
        n, total = n + 1, total + s
        out.append(bin_)
    return out


@pytest.mark.parametrize(("target", "max_n", "min_n"), [(100, 10, 1), (40, 3, 2), (0, 5, 1), (10**9, 7, 1), (60, 2, 4)])
def test_greedy_bins_are_the_fold(spark, target, max_n, min_n):
    rng = np.random.default_rng(target + max_n)
    groups = {g: [int(x) for x in rng.choice([0, 0, 5, 30, 200], n)] for g, n in (("a", 150), ("b", 1), (None, 40), ("c", 333))}
    df = spark.createDataFrame([(g, k, x or None, "keep") for g, s in groups.items() for k, x in enumerate(s)], "g string, k int, bytes int, bin_ string").repartition(5)
    got = {}
    for r in wf.bin_greedily(df, "g", ["k"], "bytes", target, max_n, min_n).collect():
        got.setdefault(r["g"], {})[r["k"]] = r["bin"]
        assert r["bin_"] == "keep"
    assert {g: [got[g][k] for k in range(len(s))] for g, s in groups.items()} == {g: folded(s, target, max_n, min_n) for g, s in groups.items()}


def test_greedy_bins_within_and_across_ranges(spark, monkeypatch):
    """Groups in one range, in two and in many get the fold's bins, NaN, null and large keys too; only those in many ranges need pointers."""
    rng = np.random.default_rng(3)
    sizes = {g: [int(x) for x in rng.choice([0, 5, 30, 200], n)] for g, n in ((2.0, 40), (-1e300, 30), (float("nan"), 90), (None, 50), (7.0, 900), (0.1, 35), (8.0, 30))}
    named = lambda g: "nan" if g is not None and g != g else g
    want = {(named(g), k): b for g, s in sizes.items() for k, b in enumerate(folded(s, 100, 6, 2))}
    followed, by_pointers = [], wf._binned_by_pointers
    monkeypatch.setattr(wf, "_binned_by_pointers", lambda df, *a: followed.append({named(r["g"]) for r in df.select("g").distinct().collect()}) or by_pointers(df, *a))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, x in conf.items():
            spark.conf.set(k, x)
        df = spark.createDataFrame([(g, k, x) for g, s in sizes.items() for k, x in enumerate(s)], "g double, k int, bytes int").repartition(5)
        assert {(named(r["g"]), r["k"]): r["bin"] for r in wf.bin_greedily(df, "g", ["k"], "bytes", 100, 6, 2).collect()} == want and followed == [{7.0}]
        assert {(named(r["g"]), r["k"]): r["bin"] for r in wf.bin_greedily(df.filter("g <> 7 OR g IS NULL"), "g", ["k"], "bytes", 100, 6, 2).collect()} == {x: b for x, b in want.items() if x[0] != 7.0} and len(followed) < 3
    finally:
        for k, x in was.items():
            spark.conf.set(k, x)


def test_greedy_bins_of_large_keys(spark):
    df = spark.range(60).selectExpr("9007199254740993L - id % 3 AS g", "id AS k", "10 AS size")
    got = wf.bin_greedily(df, "g", ["k"], "size", 35, 9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert sorted((r["g"], r["k"] // 3, r["bin"]) for r in got.collect()) == sorted((2**53 + 1 - g, i, i // 3) for g in range(3) for i in range(20))


def test_greedy_bins_of_nothing(spark):
    assert wf.bin_greedily(spark.createDataFrame([], "g string, k int, bytes int"), "g", ["k"], "bytes", 1, 1).count() == 0


def test_class_rules_are_found_by_their_rarest_name(spark):
    rng = np.random.default_rng(1)
    names = ["N", "CA", "C", "O", "CB", "CG", "SD", "OG", "X"]
    pick = lambda n: sorted(rng.choice(names, n, replace=False).tolist())
    residues = [("g", k, ["ALA", "GLY", "SER"][k % 3], pick(rng.integers(1, 8))) for k in range(120)]
    rules = [(k, f"c{k}", ["all", "ALA", "GLY", "nobody"][k % 4], pick(rng.integers(0, 4)), pick(rng.integers(0, 3))) for k in range(80)] + [(500, "same", "all", ["CA"], []), (501, "later", "all", ["CA", "CA"], None), (502, "none", "all", None, ["Q"])]

    def brute(res, has):
        met = [(no, c) for no, c, r, p, a in rules if r in ("all", res) and set(p or []) <= set(has) and not set(a or []) & set(has)]
        return min(met)[1] if met else None

    kinds = spark.createDataFrame(residues, "graph_id string, res_seq int, res_name string, names array<string>")
    table = spark.createDataFrame(rules, "rule_no int, class string, res_name string, present array<string>, absent array<string>")
    got = {(r["res_name"], tuple(r["names"])): r["class"] for r in energy.residue_classes(kinds, table).collect()}
    assert all(got.get((res, tuple(has))) == brute(res, has) for _, _, res, has in residues) and len(set(got.values())) > 5
    assert energy.residue_classes(kinds, table.limit(0)).count() == 0 and energy.residue_classes(kinds.limit(0), table).count() == 0


def test_quantiles_by_counting_are_exact(spark):
    rng = np.random.default_rng(2)
    lists = [rng.normal(size=5000), np.exp(rng.normal(size=7001) * 40), rng.integers(0, 4, 6000).astype(float), np.zeros(3000), np.array([5.0]), np.array([1.0, 2.0])]
    shares = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    for x in lists:
        df = spark.createDataFrame([(v,) for v in x.tolist()] + [(None,)], "v double").repartition(3)
        want = df.agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q")).first()["q"]
        assert gr.exact_quantiles(df, "v", shares, enough=20, accuracy=100) == pytest.approx(want, rel=1e-12)
    none = spark.createDataFrame([(None,)], "v double")
    assert gr.exact_quantiles(none, "v", [0.5]) == [None] and tuple(gr.fit_robust_scaler(none, "v").first()) == (None, None)
    flat = gr.fit_robust_scaler(spark.createDataFrame([(2.0,)] * 9, "v double"), "v").first()
    assert (flat["centre"], flat["scale"]) == (2.0, 1.0)


def pdb_text(rng, k, models=1):
    """A structure of chains A and B as records."""
    out = []
    for m in range(models):
        out += [f"MODEL     {m + 1:4d}"] if models > 1 else []
        for i in range(40):
            name = ["N", "CA", "C", "O", "CB"][i % 5]
            x, y, z = rng.uniform(0, 9, 3)
            out.append(f"ATOM  {i + 1:5d}  {name:<3s} {['ALA', 'GLY', 'SER'][i % 3]} {'AB'[i // 20]}{i // 5 + 1:4d}    {x:8.3f}{y:8.3f}{z:8.3f}  1.00  0.00          {name[0]:>2s}")
        out += ["ENDMDL"] if models > 1 else []
    return "\n".join(out)


def test_a_batch_cut_short_and_repeated_leaves_what_one_run_leaves(spark, tmp_path, monkeypatch):
    from dockgrid.plans.interface_graphs import build_graphs
    from dockgrid.sources import structures, tables

    rng, root, store = np.random.default_rng(6), tmp_path / "in" / "deeper", str(tmp_path / "store")
    root.mkdir(parents=True)
    for k in range(5):
        (root / f"m{k}.pdb").write_text(pdb_text(rng, k, models=1 + (k == 3)))
    (root / "apart.pdb").write_text("\n".join(x for x in pdb_text(rng, 9).splitlines() if " A " in x))
    (root / "bare.pdb").write_text("REMARK nothing\n")
    run = lambda: streams.ingest_structures(spark, str(tmp_path / "in"), store, str(tmp_path / "log"), per_batch=2, buckets=2)
    real, calls = streams.write_graphs, []

    def cut_short(path, nodes, edges, **options):
        calls.append(options["batch"])
        if calls.count(1) == 1 and options["batch"] == 1:
            nodes.limit(3).withColumn("bucket", F.lit(7)).write.partitionBy("bucket").parquet(f"{path}/nodes/batch=1")
            raise OSError("lost")
        real(path, nodes, edges, **options)

    monkeypatch.setattr(streams, "write_graphs", cut_short)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    assert tables.read_graphs(spark, store, ("nodes",))["nodes"].select("graph_id").distinct().count() <= 2
    run().awaitTermination()
    (root / "later.pdb").write_text(pdb_text(rng, 11))
    run().awaitTermination()
    n_calls = len(calls)
    run().awaitTermination()
    assert calls.count(1) == 2 and len(calls) == n_calls
    want = build_graphs(structures.read_pdb(spark, str(root)).withColumns({c: F.lit(0.0) for c in ("charge", "eps", "sigma", "eps14", "sigma14")}))
    got = tables.read_graphs(spark, store, ("nodes", "edges", "status"))
    for name in ("nodes", "edges"):
        cols = sorted(c for c in want[name].columns if c not in ("line_no",))
        assert sorted(map(repr, got[name].select(cols).collect())) == sorted(map(repr, want[name].select(cols).collect()))
    status = {r["graph_id"] or r["path"].rpartition("/")[2]: (r["n_atoms"], r["error"]) for r in got["status"].collect()}
    assert status["apart"] == (20, "no contacts") and status["bare.pdb"] == (0, "no atoms") and status["later"] == (40, None) and {"m3_model_0", "m3_model_1"} <= set(status) and len(status) == 9


def test_progress_state_falls_with_the_watermark(spark, tmp_path):
    rng, day = random.Random(2), 86_400
    rows = [(k, t * day + rng.randrange(day), f"s{rng.randrange(9)}", t) for t in range(8) for k in ([0] if t % 3 == 0 else []) + [10 * t + i for i in range(5)]]
    df = spark.createDataFrame(rows, "shard_id long, t long, status string, part int").withColumn("ts", F.timestamp_seconds("t"))
    for t in range(8):
        df.filter(f"part = {t}").select("shard_id", "ts", "status").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("shard_id long, ts timestamp, status string").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    held, seen = [], []
    q = streams.progress_sessions(stream, "1 hour", "1 day").writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True)
    q = q.foreachBatch(lambda b, n: held.extend(map(tuple, b.collect()))).start()
    q.awaitTermination()
    seen = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(seen) <= 22 < df.select("shard_id").distinct().count() and seen[-1] < max(seen)
    got = streams.progress_of(spark.createDataFrame(held, "shard_id long, session long, status string, at timestamp, n_events long, closed boolean"))
    want = streams.latest_progress(df)
    assert sorted(map(tuple, got.collect())) == sorted((r["shard_id"], r["status"], r["at"], r["n_events"]) for r in want.collect())
    assert len({x[1] for x in held if x[0] == 0}) == 3 and any(x[5] for x in held)


def test_first_labels_are_kept_once(spark, tmp_path):
    rng = random.Random(7)
    for part in range(4):
        spark.createDataFrame([(f"l{rng.randrange(30)}" if k % 9 else None, part * 100 + k) for k in range(40)], "label string, k int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("label string, k int").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    store = str(tmp_path / "store")
    streams.ingest_labels(stream(), store, str(tmp_path / "log"), order=("k",)).awaitTermination()
    got = {r["label"]: r["k"] for r in spark.read.parquet(store).collect()}
    assert got == {r["label"]: r["k"] for r in spark.read.parquet(str(tmp_path / "in")).filter("label IS NOT NULL").groupBy("label").agg(F.min("k").alias("k")).collect()}
    assert spark.read.parquet(store).count() == len(got)


def test_merged_sketches_stay_within_their_bound(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = np.concatenate((rng.normal(size=20_000), np.exp(rng.normal(size=20_000) * 5)))
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "dockq double").repartition(6)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("dockq double").option("maxFilesPerTrigger", "2").parquet(str(tmp_path / "in"))
    store = str(tmp_path / "store")
    streams.ingest_predictions(stream, store, str(tmp_path / "log")).awaitTermination()
    assert spark.read.parquet(store).count() == 3
    got = streams.merged_predictions(spark, store, (0.01, 0.5, 0.99)).first()
    assert got["rows"] == 40_001 and got["mean"] == pytest.approx(x.mean()) and got["high"] + got["med"] + got["low"] == 40_000
    assert all(abs((x <= q).mean() - share) < 0.004 for q, share in zip(got["quantiles"], (0.01, 0.5, 0.99), strict=True))


def test_packed_graphs_score_alike_and_are_few_calls(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows, edges = [], []
    for g in range(60):
        size = int(rng.integers(1, 30))
        rows += [(g, k, float(rng.normal()), float(g)) for k in range(size)]
        edges += [(g, int(rng.integers(size)), int(rng.integers(size)), 1.0) for _ in range(g % 7 * size)]
    nodes = spark.createDataFrame(rows, "graph_id long, node_idx int, value double, own double").repartition(5)
    links = spark.createDataFrame([*edges, (999, 0, 0, 1.0)], "graph_id long, src_idx int, dst_idx int, w double")
    calls = str(tmp_path)

    def model(n, index, e, n_graphs):
        import uuid
        from pathlib import Path

        Path(calls, uuid.uuid4().hex).touch()
        own, graph = n["own"].to_numpy(), n["graph"].to_numpy()
        assert (own[index[0]] == own[index[1]]).all() and (own[index[0]] == e["graph_id"].to_numpy()).all()
        assert n_graphs == len(set(graph)) and (n["node_idx"].to_numpy()[index[0]] == e["src_idx"].to_numpy()).all()
        if 17.0 in own:
            raise ValueError("seventeen")
        return scoring.reference_batch(n, index, e, n_graphs)

    got = {r["graph_id"]: r for r in scoring.score_packed(nodes, links, model, 100).collect()}
    alone = {r["graph_id"]: r["score"] for r in scoring.score_graphs(nodes, links.filter("graph_id < 999"), scoring.reference_model).collect()}
    assert set(got) == set(range(60)) and got[17]["status"] == "fail" and got[17]["error"] == "seventeen"
    assert all(got[g]["score"] == pytest.approx(alone[g]) for g in range(60) if g != 17)
    import os

    assert len(os.listdir(calls)) < 40  # about nine batches, and one of them again graph by graph


def test_chains_are_the_longest(spark):
    rng = random.Random(10)
    word = lambda n, letters="ACDEFGHIKLMNPQRSTVWY": "".join(rng.choice(letters) for _ in range(n))
    queries, targets, planted = {}, {}, {}
    for k in range(40):
        a, b, c = word(30), word(rng.randint(0, 9)), word(25)
        head = word(rng.randint(0, 40))
        queries[k], targets[k] = a + c, head + a + b + c + word(20)
        planted[k] = (len(head) + 1, len(head) + len(a + b + c), int(bool(b)))
    for k in range(40, 80):
        queries[k], targets[k] = word(60, "AC"), word(90, "AC")
    queries |= {80: "A" * 3000, 81: "short", 82: None, 83: "", 84: word(20)}
    targets |= {80: "A" * 5000, 81: "short", 82: "x" * 20, 83: None, 84: word(20)}
    frame = lambda d: spark.createDataFrame(list(d.items()), "mol long, sequence string")
    got = {r["mol"]: r for r in wf.locate_by_chain(frame(queries), frame(targets), 6).collect()}
    assert all((got[k]["start"], got[k]["stop"], got[k]["n_gaps"]) == planted[k] for k in planted)
    assert tuple(got[80])[1:] == (1, 3000, 2995, 0) and not {81, 82, 83, 84} & set(got)
    for k in range(40, 80):
        grams = [[s[i : i + 6] for i in range(len(s) - 5)] for s in (queries[k], targets[k])]
        once = [(i, grams[1].index(g)) for i, g in enumerate(grams[0]) if grams[0].count(g) == 1 and grams[1].count(g) == 1]
        best = []
        for i, (_, t) in enumerate(once):
            best.append(1 + max((best[j] for j in range(i) if once[j][1] < t), default=0))
        if once:
            assert got[k]["n_seeds"] == max(best)


def test_entry_tells_absent_operators_from_broken_ones(tmp_path):
    """With both text folders gone the other queries are there; a text module that names a module that isn't fails aloud."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(here, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    run = lambda: subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print('op1_token_counts' in e.queries(), len(e.queries()) > 100)"], cwd=copy, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)})
    if (copy / "dockgrid" / "llm").is_dir():
        assert run().stdout.split() == ["True", "True"]
        broken = copy / "dockgrid" / "llm" / "queries.py"
        broken.write_text(broken.read_text() + "\nfrom dockgrid.llm.no_such_module import nothing\n")
        assert run().returncode and "no_such_module" in run().stderr
        shutil.rmtree(copy / "dockgrid" / "llm")
        (copy / "corpus_pipeline.py").unlink()
    assert run().stdout.split() == ["False", "True"]


def test_split_is_exact_with_many_ties_and_nulls(spark):
    rng = np.random.default_rng(4)
    orders = [None if k % 11 == 0 else float(rng.choice([0.0, 0.5, 0.5, 0.5, rng.random()])) for k in range(1000)]
    df = spark.createDataFrame(list(enumerate(orders)), "k int, o double").repartition(6)
    known = sorted((o, k) for k, o in enumerate(orders) if o is not None)
    for fraction in (0.0, 0.3, 0.5, 0.8, 1.0):
        got = {r["k"] for r in ev.train_valid_split(df, fraction, "k", F.col("o")).filter("is_train").collect()}
        assert got == {k for _, k in known[: int(fraction * 1000)]}
    assert ev.train_valid_split(df.limit(0), 0.5, "k", F.col("o")).count() == 0


def test_softmax_and_job_labels(spark):
    from dockgrid.functions import scalars as sc

    df = spark.createDataFrame([([1.0, 2.0, -1000.0], "st_123456_7_site-n3"), ([5.0], "st_12345_7"), (None, "x_12_3_n")], "v array<double>, p string")
    got = df.select(sc.softmax("v").alias("s"), sc.job_label("p", "site-").alias("l")).collect()
    e = math.exp(-1)
    assert got[0]["s"] == pytest.approx([e / (1 + e), 1 / (1 + e), 0]) and got[1]["s"] == [1.0] and got[2]["s"] is None
    assert [r["l"] for r in got] == ["idx=7  node=n3", "st_12345_7", "x_12_3_n"]


def test_long_targets_are_cut_in_one_pass(spark):
    """One target of 400,000 letters: cut by walking to each place from the start, it took minutes."""
    import time

    rng = random.Random(3)
    target = "é" + "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(400_000))
    q = spark.createDataFrame([(1, target[300_000:300_060])], "mol long, sequence string")
    t = spark.createDataFrame([(1, target)], "mol long, sequence string")
    began = time.time()
    assert wf.locate_subsequence(q, t, 12).select("start", "votes").collect() == [(300_001, 49)]
    assert tuple(wf.locate_by_chain(q, t, 12).first())[1:] == (300_001, 300_060, 49, 0)
    assert time.time() - began < 60
