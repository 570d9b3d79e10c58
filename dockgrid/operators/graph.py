"""Nodes, edges and their features; pooling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dockgrid.functions import fixed

C = F.col


def whole_graphs(batches: Iterator[pa.RecordBatch], least: int = 50_000) -> Iterator[pa.Table]:
    """Tables of whole graphs from batches in which the rows of a graph_id come together: at least so many rows each, if there are."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= least:
            t = pa.Table.from_batches(held)
            graph = np.asarray(t.column("graph_id").combine_chunks().dictionary_encode().indices)
            end = int(np.argmax(graph == graph[-1]))  # the last graph may go on
            if end:
                yield t.slice(0, end)
            held = t.slice(end).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def valid_nodes(atoms: DataFrame, contacts: DataFrame) -> DataFrame:
    """Atoms that are nodes: ends of contacts (graph_id, l_serial, r_serial) with a valid residue and a listed atom name.

    A contact whose left end has an invalid residue does not carry its right end; that one counts if another contact does.
    """
    names = atoms.select("graph_id", "serial", "res_name")
    ok = C("res_name").isin(*fixed.RESIDUES, *fixed.ALSO_VALID)
    keys = contacts.join(names.filter(ok).select("graph_id", C("serial").alias("l_serial")), ["graph_id", "l_serial"], "left_semi")
    ends = keys.select("graph_id", F.explode(F.array("l_serial", "r_serial")).alias("serial")).distinct()
    return atoms.filter(ok & C("atom_name").isin(*fixed.ATOMS)).join(ends, ["graph_id", "serial"], "left_semi")


def valid_residues(residues: DataFrame, contacts: DataFrame) -> DataFrame:
    """valid_nodes for residues (graph_id, residue, res_name) and contacts between them (graph_id, l_residue, r_residue)."""
    valid = residues.filter(C("res_name").isin(*fixed.RESIDUES, *fixed.ALSO_VALID))
    keys = contacts.join(valid.select("graph_id", C("residue").alias("l_residue")), ["graph_id", "l_residue"], "left_semi")
    ends = keys.select("graph_id", F.explode(F.array("l_residue", "r_residue")).alias("residue")).distinct()
    return valid.join(ends, ["graph_id", "residue"], "left_semi")


def node_set(contacts: DataFrame) -> DataFrame:
    return contacts.select("graph_id", C("l_serial").alias("serial")).union(contacts.select("graph_id", "r_serial")).distinct()


def symmetrise(edges: DataFrame, a: str = "src", b: str = "dst", keys: tuple[str, ...] = ("graph_id",)) -> DataFrame:
    """Each edge in both directions, one row for a direction."""
    # Both directions come from one row: after a union it wouldn't be known how rows are dealt.
    ends = [F.struct(C(p).alias("a"), C(q).alias("b")) for p, q in ((a, b), (b, a))]
    both = edges.select("*", F.explode(F.array(*ends)).alias("_ends"))
    return both.select(*[C("_ends.a" if c == a else "_ends.b" if c == b else c).alias(c) for c in edges.columns]).dropDuplicates([*keys, a, b])


def index_nodes(nodes: DataFrame, ident: str = "serial") -> DataFrame:
    """node_idx: 0-based number within the graph by (chain, res_seq, ident)."""
    w = Window.partitionBy("graph_id").orderBy("chain", "res_seq", ident)
    return nodes.withColumn("node_idx", (F.row_number().over(w) - 1).cast("int"))


def index_edges(edges: DataFrame, nodes: DataFrame, ident: str = "serial") -> DataFrame:
    """edges (graph_id, src, dst as ident) with src_idx, dst_idx; edges of which an end is no node go."""
    n = nodes.select("graph_id", ident, "node_idx")
    one = edges.join(n.select("graph_id", C(ident).alias("src"), C("node_idx").alias("src_idx")), ["graph_id", "src"])
    return one.join(n.select("graph_id", C(ident).alias("dst"), C("node_idx").alias("dst_idx")), ["graph_id", "dst"])


def attach_regions(residues: DataFrame, annotations: DataFrame, antigen: str = "B") -> tuple[DataFrame, DataFrame]:
    """residues (graph_id, chain, res_seq) with region, and the graphs that fail (graph_id, error).

    annotations: graph_id, ord (from 1), label: matched by place with the residues of the non-antigen chain, 'UNK' past their end.
    The antigen is 'AG'. A graph with a label that is no region fails as a whole.
    """
    w = Window.partitionBy("graph_id", "chain").orderBy("res_seq")
    placed = residues.withColumn("ord", F.row_number().over(w))
    got = placed.join(annotations.select("graph_id", "ord", "label"), ["graph_id", "ord"], "left")
    out = got.withColumn("region", F.when(C("chain") == antigen, "AG").otherwise(F.coalesce("label", F.lit("UNK")))).drop("label", "ord")
    bad = out.filter(~C("region").isin(*fixed.REGIONS)).groupBy("graph_id").agg(F.concat(F.lit("unknown region "), F.min("region")).alias("error"))
    return out.join(bad, "graph_id", "left_anti"), bad


def inject_embeddings(nodes: DataFrame, embeddings: DataFrame, on_missing: str = "zero") -> DataFrame:
    """nodes (mol, chain, res_seq) with embedding = values[res_seq - 1] of label mol.chain, and missing: null, 'label' or 'bounds'.

    Missing ones are 0 (on_missing='zero') or an error (on_missing='error').
    """
    e = embeddings.select(C("label").alias("emb_label"), C("values").alias("emb_values"))
    out = nodes.join(e, F.concat_ws(".", "mol", "chain") == C("emb_label"), "left")
    missing = F.when(C("emb_label").isNull(), "label").when((C("res_seq") < 1) | (C("res_seq") > F.size("emb_values")), "bounds")
    value = F.when(missing.isNull(), F.try_element_at("emb_values", F.when(C("res_seq") > 0, C("res_seq").cast("int"))).cast("double")).otherwise(0.0)
    if on_missing == "error":
        value = F.when(missing.isNotNull(), F.raise_error(F.concat(F.lit("no embedding for "), F.concat_ws(".", "mol", "chain")))).otherwise(value)
    return out.withColumns({"missing": missing, "embedding": value}).drop("emb_label", "emb_values")


def attach_contact_areas(edges: DataFrame, areas: DataFrame) -> DataFrame:
    """edges (graph_id, src, dst) with voro_area: areas(u, v) if not 0, else areas(v, u), else 0."""
    there = areas.select("graph_id", C("u").alias("src"), C("v").alias("dst"), F.nullif("area", F.lit(0.0)).alias("a1"))
    back = areas.select("graph_id", C("v").alias("src"), C("u").alias("dst"), F.nullif("area", F.lit(0.0)).alias("a2"))
    out = edges.join(there, ["graph_id", "src", "dst"], "left").join(back, ["graph_id", "src", "dst"], "left")
    return out.withColumn("voro_area", F.coalesce("a1", "a2", F.lit(0.0))).drop("a1", "a2")


def backbone(atoms: DataFrame) -> DataFrame:
    """One row for each residue with the coordinates of N, CA and C (0 where missing): n_x ... c_z."""
    cols = [F.coalesce(F.max(F.when(C("atom_name") == name, C(k))), F.lit(0.0)).alias(f"{name.lower()}_{k}") for name in ("N", "CA", "C") for k in "xyz"]
    return atoms.groupBy("graph_id", "chain", "res_seq").agg(*cols)


def edge_orientation(edges: DataFrame, frames: DataFrame, eps: float = 1e-6) -> DataFrame:
    """edges (graph_id, s_chain, s_res, d_chain, d_res) with orientation: the direction CA(source) - CA(target) in the source's frame.

    frames: backbone(). Residues that are missing stand at the origin.
    """
    cols = [f"{n}_{k}" for n in ("n", "ca", "c") for k in "xyz"]
    s = frames.select("graph_id", C("chain").alias("s_chain"), C("res_seq").alias("s_res"), *[C(c).alias(f"s_{c}") for c in cols])
    d = frames.select("graph_id", C("chain").alias("d_chain"), C("res_seq").alias("d_res"), *[C(f"ca_{k}").alias(f"d_ca_{k}") for k in "xyz"])
    out = edges.join(s, ["graph_id", "s_chain", "s_res"], "left").join(d, ["graph_id", "d_chain", "d_res"], "left").fillna(0.0, [*[f"s_{c}" for c in cols], *[f"d_ca_{k}" for k in "xyz"]])

    def columns(prefix: str, values: dict) -> DataFrame:
        return out.withColumns({f"{prefix}{k}": v for k, v in values.items()})

    def length(prefix: str):
        return F.sqrt(sum((C(f"{prefix}{k}") * C(f"{prefix}{k}") for k in "xyz"), F.lit(0.0)))

    out = columns("w_", {k: C(f"s_ca_{k}") - C(f"d_ca_{k}") for k in "xyz"})
    out = columns("e0_", {k: C(f"w_{k}") / F.greatest(length("w_"), F.lit(1e-12)) for k in "xyz"})
    out = columns("v1_", {k: C(f"s_c_{k}") - C(f"s_ca_{k}") for k in "xyz"})
    out = columns("e1_", {k: C(f"v1_{k}") / (length("v1_") + eps) for k in "xyz"})
    out = columns("v2_", {k: C(f"s_n_{k}") - C(f"s_ca_{k}") for k in "xyz"})
    along = sum((C(f"v2_{k}") * C(f"e1_{k}") for k in "xyz"), F.lit(0.0))
    out = columns("u2_", {k: C(f"v2_{k}") - along * C(f"e1_{k}") for k in "xyz"})
    out = columns("e2_", {k: C(f"u2_{k}") / (length("u2_") + eps) for k in "xyz"})
    out = columns("e3_", {k: C(f"e1_{a}") * C(f"e2_{b}") - C(f"e1_{b}") * C(f"e2_{a}") for k, a, b in (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y"))})
    parts = [sum((C(f"e0_{k}") * C(f"e{i}_{k}") for k in "xyz"), F.lit(0.0)) for i in (1, 2, 3)]
    return out.select(*edges.columns, F.array(*parts).alias("orientation"))


def pool_nodes(nodes: DataFrame, clusters: DataFrame, scalars: tuple[str, ...], means: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """Per cluster the largest value of each scalar and the mean of positions; clusters: graph_id, node, cluster."""
    return nodes.join(clusters, ["graph_id", "node"]).groupBy("graph_id", "cluster").agg(*[F.max(c).alias(c) for c in scalars], *[F.avg(c).alias(c) for c in means], F.count("*").alias("n_nodes"))


def pool_edges(edges: DataFrame, clusters: DataFrame, values: tuple[str, ...] = ("weight",)) -> DataFrame:
    """Edges between clusters: ends replaced, loops removed, parallel edges summed."""
    a = clusters.select("graph_id", C("node").alias("src"), C("cluster").alias("c_src"))
    b = clusters.select("graph_id", C("node").alias("dst"), C("cluster").alias("c_dst"))
    both = edges.join(a, ["graph_id", "src"]).join(b, ["graph_id", "dst"]).filter("c_src <> c_dst")
    return both.groupBy("graph_id", C("c_src").alias("src"), C("c_dst").alias("dst")).agg(*[F.sum(c).alias(c) for c in values])


def consecutive_clusters(clusters: DataFrame) -> DataFrame:
    """Cluster numbers 0 .. K-1 within each graph, in their order."""
    w = Window.partitionBy("graph_id").orderBy("cluster")
    return clusters.withColumn("cluster", (F.dense_rank().over(w) - 1).cast("long"))


def attention_pool(nodes: DataFrame, gate: str, value: str, by: str = "graph_id") -> DataFrame:
    """Mean of value weighted by softmax(gate) within each graph."""
    top = nodes.groupBy(by).agg(F.max(gate).alias("top"))
    w = F.exp(C(gate) - C("top"))
    return nodes.join(top, by).groupBy(by).agg((F.sum(w * C(value)) / F.sum(w)).alias("pooled"))


def max_pool_graph(nodes: DataFrame, scalars: tuple[str, ...], vector: tuple[str, ...], by: tuple[str, ...] = ("graph_id", "cluster")) -> DataFrame:
    """Per cluster the largest scalars, and the largest length of the vector."""
    length = F.sqrt(sum((C(v) * C(v) for v in vector), F.lit(0.0)))
    return nodes.groupBy(*by).agg(*[F.max(c).alias(c) for c in scalars], F.max(length).alias("vector_norm"))


def message_aggregate(nodes: DataFrame, edges: DataFrame, message: str) -> DataFrame:
    """Sum of messages at each node; 0 without edges."""
    got = edges.groupBy("graph_id", C("dst").alias("node")).agg(F.sum(message).alias("received"))
    return nodes.join(got, ["graph_id", "node"], "left").withColumn("received", F.coalesce("received", F.lit(0.0)))


def values_at(values: DataFrame, column: str, places: set[int], n: int, enough: int = 1000, accuracy: int = 10_000) -> dict[int, float]:
    """The values of column (double) at places (from 0) in rising order; n: how many are not null.

    Selection by counting: for each place sought, two values near it (from a mergeable sketch of what is left) part the values into
    below, between and above, and exact counts say in which part the place is; the part shrinks by about accuracy a pass, and at
    most enough values of it are read at the end. No task holds all values.
    """
    v = values.select(C(column).cast("double").alias("v")).filter("v IS NOT NULL")
    found: dict[int, float] = {}
    left = {k: (None, None, 0, n) for k in places}  # the place's value is after the first and before the second; rows up to the first; rows between
    inside = lambda low, high: (C("v") > low if low is not None else F.lit(True)) & (C("v") < high if high is not None else F.lit(True))
    while left:
        few = {x for x in left.values() if x[3] <= enough}
        for low, high, below, m in few:
            read = sorted(r["v"] for r in v.filter(inside(low, high)).limit(m).collect())
            found |= {k: read[k - below] for k, x in left.items() if x == (low, high, below, m)}
        left = {k: x for k, x in left.items() if x not in few}
        if not left:
            break
        slack = 4 / accuracy
        near = lambda k, x: [min(1.0, max(0.0, (k - x[2]) / x[3] + d)) for d in (-slack, slack)]
        sketched = v.agg(*[F.approx_percentile(F.when(inside(*x[:2]), C("v")), F.array(*map(F.lit, near(k, x))), F.lit(accuracy)).alias(str(k)) for k, x in left.items()]).first()
        pivots = {k: sketched[str(k)] for k in left}
        counts = v.agg(*[F.count_if(test).alias(f"{k}_{i}") for k, (p, q) in pivots.items() for i, test in enumerate((C("v") < p, C("v") <= p, C("v") < q, C("v") <= q))]).first()
        for k, (p, q) in pivots.items():
            low, high, below, m = left[k]
            c = [counts[f"{k}_{i}"] for i in range(4)]
            if k < c[0]:
                left[k] = (low, p, below, c[0] - below)
            elif k < c[1]:
                found[k] = p
            elif k < c[2]:
                left[k] = (p, q, c[1], c[2] - c[1])
            elif k < c[3]:
                found[k] = q
            else:
                left[k] = (q, high, c[3], below + m - c[3])
        left = {k: x for k, x in left.items() if k not in found}
    return found


def exact_quantiles(values: DataFrame, column: str, shares: list[float], **options: int) -> list[float | None]:
    """The quantiles of column at shares (0 to 1), interpolated between neighbours at (n - 1) share, as percentile() gives them.

    Null values don't count; None where there are none. options: of values_at.
    """
    n = values.agg(F.count(C(column).cast("double"))).first()[0]
    if not n:
        return [None] * len(shares)
    at = [(n - 1) * q for q in shares]
    found = values_at(values, column, {x for k in at for x in (math.floor(k), math.ceil(k))}, n, **options)
    return [found[math.floor(k)] + (found[math.ceil(k)] - found[math.floor(k)]) * (k - math.floor(k)) if math.floor(k) < k else found[math.floor(k)] for k in at]


def fit_robust_scaler(values: DataFrame, column: str) -> DataFrame:
    """One row: centre (median) and scale (q75 - q25, 1 if that is 0), exact; null without values."""
    low, centre, high = exact_quantiles(values, column, [0.25, 0.5, 0.75])
    scale = None if centre is None else (high - low) or 1.0
    return values.sparkSession.createDataFrame([(centre, scale)], "centre double, scale double")


def apply_robust_scaler(values: DataFrame, column: str, fitted: DataFrame) -> DataFrame:
    """The one row of fitted is a scalar of the plan."""
    row = fitted.first()
    centre, scale = (row["centre"], row["scale"]) if row and row["centre"] is not None else (0.0, 1.0)
    return values.withColumn(column, (C(column) - centre) / scale)


def select_features(table: DataFrame, names: list[str] | str, keys: tuple[str, ...]) -> DataFrame:
    """keys and the named features ('all': every numeric one); unknown names are an error."""
    numeric = [c for c, t in table.dtypes if c not in keys and t in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    if names == "all":
        names = numeric
    if unknown := [n for n in names if n not in table.columns]:
        raise ValueError(f"unknown features: {', '.join(unknown)}")
    return table.select(*keys, *names)


def fit_width(column: str, width: int) -> Column:
    """An array column cut or filled with 0 to width."""
    return F.slice(F.concat(C(column), F.array_repeat(F.lit(0.0), width)), 1, width)


def embedding_reduce(embeddings: DataFrame, most: int = 2500) -> DataFrame:
    """label, values: mean and number of the first `most` values."""
    v = F.slice("values", 1, most)
    return embeddings.select("label", F.size(v).alias("n"), (F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(v), F.lit(0))).alias("mean"))
