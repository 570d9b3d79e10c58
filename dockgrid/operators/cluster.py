"""Clustering of all graphs in one job: Markov clustering, greedy modularity, and their hierarchy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from dockgrid.operators.graph import pool_edges, whole_graphs
from dockgrid.storage import settle

C = F.col


def column_normalised(m: DataFrame) -> DataFrame:
    """m: graph_id, i, j, v; columns (j) sum to 1."""
    return m.withColumn("v", C("v") / F.sum("v").over(Window.partitionBy("graph_id", "j")))


def mcl_start(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The column-stochastic matrix of the undirected, unweighted graph with self loops. nodes: graph_id, node; edges: graph_id, src, dst."""
    loops = nodes.select("graph_id", C("node").alias("i"), C("node").alias("j"))
    both = edges.select("graph_id", C("src").alias("i"), C("dst").alias("j")).union(edges.select("graph_id", C("dst").alias("i"), C("src").alias("j")))
    return column_normalised(loops.union(both).distinct().withColumn("v", F.lit(1.0)))


def mcl_step(m: DataFrame, inflation: float = 2.0, prune: float = 0.001) -> DataFrame:
    """One expansion (m times m), inflation and pruning."""
    a = m.select("graph_id", "i", C("j").alias("k"), C("v").alias("a"))
    b = m.select("graph_id", C("i").alias("k"), "j", C("v").alias("b"))
    expanded = a.join(b, ["graph_id", "k"]).groupBy("graph_id", "i", "j").agg(F.sum(C("a") * C("b")).alias("v"))
    inflated = column_normalised(expanded.withColumn("v", F.pow("v", inflation))).filter(C("v") >= prune)
    return column_normalised(inflated)


def _columns_step(i: np.ndarray, j: np.ndarray, v: np.ndarray, n: int, inflation: float, prune: float, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """mcl_step on arrays: entries v at (i, j) of an n x n matrix, sorted by (j, i). Columns are expanded in blocks of about most products."""
    first = np.searchsorted(j, np.arange(n + 1))
    size = np.diff(first)[i]
    done = np.concatenate(([0], np.cumsum(size)))
    found, e = [], 0
    while e < len(j):
        # Whole columns, one at least.
        end = int(np.searchsorted(done, done[e] + most, "right")) - 1
        end = max(int(first[j[min(end, len(j) - 1)]]) if end < len(j) else len(j), int(first[j[e] + 1]))
        part = size[e:end]
        at = np.arange(done[end] - done[e]) + np.repeat(first[i[e:end]] - done[e:end] + done[e], part)
        key = np.repeat(j[e:end], part) * n + i[at]
        order = np.argsort(key, kind="stable")
        key, product = key[order], (v[at] * np.repeat(v[e:end], part))[order]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, w = key[starts], np.add.reduceat(product, starts) ** inflation
        column = key // n
        w = w / np.bincount(column, w)[column]
        key, column, w = (x[w >= prune] for x in (key, column, w))
        found.append((key % n, column, w / np.bincount(column, w)[column]))
        e = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (i, j, v)


def _attractors(graph: np.ndarray, a: np.ndarray, b: np.ndarray, inflation: float, prune: float, most_rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Graph, node and cluster of the nodes of many graphs, whose loops and edges are a to b: one matrix of blocks, from which graphs drop out as they stand still."""
    graph, a, b = np.concatenate((graph, graph)), np.concatenate((a, b)), np.concatenate((b, a))
    order = np.lexsort((a, graph))
    new = np.concatenate(([True], (np.diff(graph[order]) != 0) | (np.diff(a[order]) != 0)))
    owner, node = graph[order][new], a[order][new]  # by graph, then node: numbers keep the order of nodes
    n, ident = len(node), np.empty(len(a), np.int64)
    ident[order] = np.cumsum(new) - 1
    half = len(a) // 2
    key = np.unique(ident * n + np.concatenate((ident[half:], ident[:half])))
    i, j = key % n, key // n
    v = 1.0 / np.bincount(j, minlength=n)[j]
    out = []
    for _ in range(0, most_rounds, 3):
        before = j * n + i, v
        for _ in range(3):
            i, j, v = _columns_step(i, j, v, n, inflation, prune)
        both, at = np.unique(np.concatenate((before[0], j * n + i)), return_inverse=True)
        change = np.bincount(at, np.concatenate((-before[1], v)), len(both))
        moving = np.isin(owner, owner[both[np.abs(change) > tolerance] // n])
        # Of a column's largest entries (to six places) the smallest node.
        still = ~moving[j]
        si, sj, sv = i[still], j[still], np.floor(v[still] * 1e6 + 0.5)
        top = np.lexsort((si, -sv, sj))
        si, sj = si[top], sj[top]
        lead = np.flatnonzero(np.concatenate(([True], sj[1:] != sj[:-1]))) if len(sj) else []
        out.append((sj[lead], si[lead]))
        i, j, v = i[~still], j[~still], v[~still]
        if not len(j):
            nodes, clusters = (np.concatenate(x) for x in zip(*out, strict=True))
            return owner[nodes], node[nodes], node[clusters]
    raise RuntimeError(f"the matrix still changes after {most_rounds} rounds")


def _graph_by_graph(run: Callable):
    """run on arrays of whole graphs, whose rows (graph_id, i, j) come together."""

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_graphs(batches):
            names = t.column("graph_id").combine_chunks().dictionary_encode()
            graph, node, found = run(np.asarray(names.indices), *(t.column(c).to_numpy() for c in "ij"))
            kind = t.schema.field("i").type
            yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(graph)), pa.array(node, kind), pa.array(found, kind)], ["graph_id", "node", "cluster"])

    return call


def mcl(nodes: DataFrame, edges: DataFrame, inflation: float = 2.0, prune: float = 0.001, most_rounds: int = 90, tolerance: float = 1e-5, most_rows: int = 10_000) -> DataFrame:
    """graph_id, node, cluster: the smallest attractor of the node's column. Isolated nodes are clusters of their own.

    Steps until three of them change no entry of the graph by more than tolerance; raises if that is not so after most_rounds. Graphs of at most
    most_rows nodes and edges are stepped as arrays, many of them at a time, by the task to which they are dealt: nothing but nodes and
    edges moves or is written. For larger ones each step is a join of the matrix's entries, three steps a table.
    """
    loops = nodes.select("graph_id", C("node").alias("i"), C("node").alias("j"))
    pairs = settle(loops.union(edges.select("graph_id", C("src").alias("i"), C("dst").alias("j"))).dropna(), "mcl", by="graph_id")
    large = settle(pairs.groupBy("graph_id").count().filter(C("count") > most_rows).select("graph_id"), "large")
    fields = {f.name: f.dataType for f in pairs.schema.fields}
    schema = T.StructType().add("graph_id", fields["graph_id"]).add("node", fields["i"]).add("cluster", fields["i"])
    run = lambda graph, a, b: _attractors(graph, a, b, inflation, prune, most_rounds, tolerance)
    # The count brings graphs whole to a task, their rows together.
    small = pairs.withColumn("n", F.count("*").over(Window.partitionBy("graph_id"))).filter(C("n") <= most_rows).select("graph_id", "i", "j")
    found = small.mapInArrow(_graph_by_graph(run), schema)
    if large.isEmpty():
        return found
    big = pairs.join(large, "graph_id", "left_semi")
    return found.union(_mcl_by_joins(big, inflation, prune, most_rounds, tolerance))


def _mcl_by_joins(pairs: DataFrame, inflation: float, prune: float, most_rounds: int, tolerance: float) -> DataFrame:
    """mcl of graph_id, i, j (loops and edges) in joins of matrix entries."""
    m = settle(mcl_start(pairs.filter("i = j").select("graph_id", C("i").alias("node")), pairs.filter("i <> j").select("graph_id", C("i").alias("src"), C("j").alias("dst"))), "mcl")
    for _ in range(0, most_rounds, 3):
        before = m.withColumnRenamed("v", "old")
        for _ in range(3):
            m = mcl_step(m, inflation, prune)
        m = settle(m, "mcl")
        if m.join(before, ["graph_id", "i", "j"], "full_outer").filter(F.abs(F.coalesce("v", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))) > tolerance).isEmpty():
            break
    else:
        raise RuntimeError(f"the matrix still changes after {most_rounds} rounds")
    most = m.groupBy("graph_id", C("j").alias("node")).agg(F.max(F.struct(F.round("v", 6).alias("v"), -C("i"))).alias("top"))
    return most.select("graph_id", "node", (-C("top")["col2"]).alias("cluster"))


def modularity(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """edges: graph_id, src, dst, weight, each undirected edge once."""
    a = clusters.select("graph_id", C("node").alias("src"), C("cluster").alias("cs"))
    b = clusters.select("graph_id", C("node").alias("dst"), C("cluster").alias("cd"))
    e = edges.join(a, ["graph_id", "src"]).join(b, ["graph_id", "dst"])
    ends = e.select("graph_id", C("cs").alias("c"), "weight", F.when(C("cs") == C("cd"), C("weight")).otherwise(0.0).alias("inner")).union(e.select("graph_id", "cd", "weight", F.lit(0.0)))
    per = ends.groupBy("graph_id", "c").agg(F.sum("weight").alias("tot"), F.sum("inner").alias("inner"))
    total = per.groupBy("graph_id").agg(F.sum("tot").alias("m2"))
    return per.join(total, "graph_id").groupBy("graph_id").agg(F.sum(2 * C("inner") / C("m2") - F.pow(C("tot") / C("m2"), 2)).alias("modularity"))


def local_moves(nodes: DataFrame, edges: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """graph_id, node, cluster: nodes move to neighbouring clusters until no single move raises the modularity.

    edges may hold loops (src = dst): their weight counts for both ends of the node. In each round a node's best move is made if it is
    the best of all that touch its old or its new cluster. No cluster takes part in two moves then, so their gains add up exactly
    and the modularity grows in every round. Nodes are numbers. Raises if moves are left after most_rounds.
    """
    clusters = settle(nodes.select("graph_id", "node", C("node").alias("cluster")), "louvain")
    w = edges.select("graph_id", "src", "dst", "weight")
    ends = settle(w.union(w.select("graph_id", C("dst").alias("src"), C("src").alias("dst"), "weight")), "ends")
    degree = ends.groupBy("graph_id", C("src").alias("node")).agg(F.sum("weight").alias("k"))
    total = degree.groupBy("graph_id").agg(F.sum("k").alias("m2"))
    degree = settle(degree.join(total, "graph_id"), "degree")
    both = ends.filter("src <> dst")
    for _ in range(most_rounds):
        placed = clusters.join(degree, ["graph_id", "node"])
        sums = placed.groupBy("graph_id", "cluster").agg(F.sum("k").alias("tot"))
        near = both.join(clusters.select("graph_id", C("node").alias("dst"), "cluster"), ["graph_id", "dst"]).groupBy("graph_id", C("src").alias("node"), "cluster").agg(F.sum("weight").alias("links"))
        own = placed.join(sums, ["graph_id", "cluster"]).select("graph_id", "node", C("cluster").alias("own"), "k", "m2", C("tot").alias("own_tot"))
        met = near.join(own, ["graph_id", "node"]).join(sums, ["graph_id", "cluster"])
        gain = F.when(C("cluster") != C("own"), F.struct(F.round(C("links") - C("k") * C("tot") / C("m2"), 9).alias("g"), (-C("cluster")).alias("c")))
        best = met.groupBy("graph_id", "node", "own", "k", "m2", "own_tot").agg(F.max(gain).alias("top"), F.coalesce(F.max(F.when(C("cluster") == C("own"), C("links"))), F.lit(0.0)).alias("stay"))
        more = C("top")["g"] - (C("stay") - C("k") * (C("own_tot") - C("k")) / C("m2"))
        moves = settle(best.filter("top IS NOT NULL").select("graph_id", "node", "own", (-C("top")["c"]).alias("to"), more.alias("more")).filter("more > 1e-8"), "moves")
        if moves.isEmpty():
            return clusters
        rank = F.struct("more", (-C("node")).alias("node"))
        touched = moves.select("graph_id", C("own").alias("c"), rank.alias("r")).union(moves.select("graph_id", C("to").alias("c"), rank.alias("r"))).groupBy("graph_id", "c").agg(F.max("r").alias("r"))
        first = lambda side, name: touched.select("graph_id", C("c").alias(side), C("r").alias(name))
        made = moves.join(first("own", "r1"), ["graph_id", "own"]).join(first("to", "r2"), ["graph_id", "to"]).filter((C("r1") == rank) & (C("r2") == rank)).select("graph_id", "node", "to")
        clusters = settle(clusters.join(made, ["graph_id", "node"], "left").select("graph_id", "node", F.coalesce("to", "cluster").alias("cluster")), "louvain")
    raise RuntimeError(f"nodes still move after {most_rounds} rounds")


def contract(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """edges between clusters, each undirected one once (src <= dst), weights summed; edges within a cluster become its loop."""
    a = clusters.select("graph_id", C("node").alias("src"), C("cluster").alias("s"))
    b = clusters.select("graph_id", C("node").alias("dst"), C("cluster").alias("d"))
    both = edges.join(a, ["graph_id", "src"]).join(b, ["graph_id", "dst"])
    return both.groupBy("graph_id", F.least("s", "d").alias("src"), F.greatest("s", "d").alias("dst")).agg(F.sum("weight").alias("weight"))


def louvain(nodes: DataFrame, edges: DataFrame, most_rounds: int = 1000, most_levels: int = 30) -> DataFrame:
    """graph_id, node, cluster (its smallest node): modularity raised by moves of nodes, then of whole clusters, level by level.

    After each level clusters become the nodes of a contracted graph, whose loops keep the weight within them, so modularity is the
    same there and can only grow. Graphs that a level leaves as they are drop out of the next. Labels are unfolded back to the nodes. Nodes
    without edges are clusters of their own. edges: graph_id, src, dst, weight, each undirected one once. Raises after most_levels.
    """
    labels = settle(nodes.select("graph_id", "node", C("node").alias("cluster")), "labels")
    level_nodes, level_edges = labels.select("graph_id", "node"), settle(contract(edges, labels), "level")
    for _ in range(most_levels):
        found = local_moves(level_nodes, level_edges, most_rounds)
        # A cluster is named by its smallest member, which keeps names and nodes the same kind of thing.
        names = found.groupBy("graph_id", "cluster").agg(F.min("node").alias("name"))
        found = settle(found.join(names, ["graph_id", "cluster"]).select("graph_id", "node", C("name").alias("cluster")), "level")
        moved = settle(found.filter("node <> cluster").select("graph_id").distinct(), "moved")
        if moved.isEmpty():
            return labels
        step = found.select("graph_id", C("node").alias("cluster"), C("cluster").alias("to"))
        labels = settle(labels.join(step, ["graph_id", "cluster"], "left").select("graph_id", "node", F.coalesce("to", "cluster").alias("cluster")), "labels")
        found = found.join(moved, "graph_id", "left_semi")
        level_edges = settle(contract(level_edges.join(moved, "graph_id", "left_semi"), found), "level")
        level_nodes = found.select("graph_id", C("cluster").alias("node")).distinct()
    raise RuntimeError(f"clusters still merge after {most_levels} levels")


def cluster_hierarchy(nodes: DataFrame, edges: DataFrame, present: DataFrame | None = None, **options) -> DataFrame:
    """graph_id, node, depth_0, depth_1: clusters of the graph, and clusters of the pooled graph.

    present: a table of graph_id; graphs that it names have their clusters already and are skipped.
    """
    if present is not None:
        there = present.select("graph_id").distinct()
        nodes, edges = nodes.join(there, "graph_id", "left_anti"), edges.join(there, "graph_id", "left_anti")
    zero = settle(mcl(nodes, edges, **options), "depth0", by="graph_id")
    pooled = pool_edges(edges.select("graph_id", "src", "dst", F.lit(1.0).alias("weight")), zero)
    one = mcl(zero.select("graph_id", C("cluster").alias("node")).distinct(), pooled.select("graph_id", "src", "dst"), **options)
    return zero.withColumnRenamed("cluster", "depth_0").join(one.select("graph_id", C("node").alias("depth_0"), C("cluster").alias("depth_1")), ["graph_id", "depth_0"]).select("graph_id", "node", "depth_0", "depth_1")
