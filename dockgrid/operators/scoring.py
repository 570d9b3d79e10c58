"""Where user models meet the tables: Arrow batches by graph or by sequence."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from dockgrid.functions.scalars import gaussian_rbf
from dockgrid.operators.workflow import bin_by_running_size
from dockgrid.storage import settle

C = F.col


def score_graphs(nodes: DataFrame, edges: DataFrame, model: Callable[[pd.DataFrame, pd.DataFrame], float]) -> DataFrame:
    """graph_id, score, status, error: model(nodes, edges) of each graph; a graph that raises gets a fail row."""

    def one(key: tuple, n: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        try:
            return pd.DataFrame([(key[0], float(model(n, e)), "ok", None)], columns=["graph_id", "score", "status", "error"])
        except Exception as why:  # noqa: BLE001  reported as a row
            return pd.DataFrame([(key[0], None, "fail", str(why)[:2000])], columns=["graph_id", "score", "status", "error"])

    kind = dict(nodes.dtypes)["graph_id"]
    return nodes.groupBy("graph_id").cogroup(edges.groupBy("graph_id")).applyInPandas(one, f"graph_id {kind}, score double, status string, error string")


def score_packed(nodes: DataFrame, edges: DataFrame, model: Callable[[pd.DataFrame, np.ndarray, pd.DataFrame, int], np.ndarray], most_nodes: int = 50_000) -> DataFrame:
    """graph_id, score, status, error: graphs are packed into batches of about most_nodes nodes, and the model is called once for each batch.

    nodes: graph_id, node_idx (0-based in the graph) and features; edges: graph_id, src_idx, dst_idx and features, as build_graphs gives
    them. model(nodes, index, edges, n_graphs) gets the nodes of a batch in order with `graph` (0 to n_graphs - 1), a 2 x E array of
    places in that order (so edges join nodes of one graph only, as blocks of a diagonal), the edges' columns, and returns a score for
    each graph. A batch that raises is scored graph by graph, so only graphs that fail get a fail row. Edges whose graph has no
    nodes go; a graph of more than most_nodes nodes is a batch of its own or with those that end it.
    """
    sizes = nodes.groupBy("graph_id").agg(F.count("*").alias("size")).withColumn("_all", F.lit(0))
    packs = settle(bin_by_running_size(sizes, "_all", ["graph_id"], "size", most_nodes).select("graph_id", C("bin").alias("_batch")), "packs")
    n, e = (df.join(packs.select("graph_id", C("_batch").alias(name)), "graph_id") for df, name in ((nodes, "_pack"), (edges, "_of")))

    def scores(n: pd.DataFrame, e: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        n = n.sort_values(["graph_id", "node_idx"], kind="stable", ignore_index=True)
        names, graph, size = np.unique(n["graph_id"], return_inverse=True, return_counts=True)
        first = np.cumsum(size) - size
        e = e[e["graph_id"].isin(names)].sort_values(["graph_id", "src_idx", "dst_idx"], kind="stable", ignore_index=True)
        at = first[np.searchsorted(names, e["graph_id"])] if len(e) else np.zeros(0, np.int64)
        index = np.stack([at + e[k].to_numpy(np.int64) for k in ("src_idx", "dst_idx")])
        out = np.asarray(model(n.assign(graph=graph), index, e, len(names)), float)
        if out.shape != (len(names),):
            raise ValueError(f"the model gave {out.shape} scores for {len(names)} graphs")
        return names, out

    def one(_: tuple, n: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        try:
            names, out = scores(n, e)
            return pd.DataFrame({"graph_id": names, "score": out, "status": "ok", "error": None})
        except Exception:  # noqa: BLE001  whose fault it is, is found out below
            rows = []
            for name, part in n.groupby("graph_id"):
                try:
                    rows.append((name, float(scores(part, e[e["graph_id"] == name])[1][0]), "ok", None))
                except Exception as why:  # noqa: BLE001  reported as a row
                    rows.append((name, None, "fail", str(why)[:2000]))
            return pd.DataFrame(rows, columns=["graph_id", "score", "status", "error"])

    kind = dict(nodes.dtypes)["graph_id"]
    return n.groupBy("_pack").cogroup(e.groupBy("_of")).applyInPandas(one, f"graph_id {kind}, score double, status string, error string")


def reference_batch(n: pd.DataFrame, index: np.ndarray, e: pd.DataFrame, n_graphs: int) -> np.ndarray:
    """reference_model for the graphs of a batch at once."""
    size = np.bincount(n["graph"], minlength=n_graphs)
    mean = np.bincount(n["graph"], n["value"], n_graphs) / size
    return np.tanh(mean * np.bincount(n["graph"].to_numpy()[index[0]], minlength=n_graphs) / size)


def reference_model(n: pd.DataFrame, e: pd.DataFrame) -> float:
    """A small deterministic model: tanh of mean node value times the number of edges a node."""
    return float(np.tanh(n["value"].mean() * len(e) / max(1, len(n))))


def _silu(x: np.ndarray) -> np.ndarray:
    # x * sigmoid(x) in one new array. On many edges most time goes here; exp takes a third of tanh's, and where it overflows the limit is right.
    out = -x
    with np.errstate(over="ignore"):
        np.exp(out, out=out)
    out += 1
    return np.divide(x, out, out=out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _relu(x: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, x)


def _dense(x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], between: Callable, last: Callable | None) -> np.ndarray:
    for k, (w, b) in enumerate(layers):
        x = x @ w.T + b
        x = between(x) if k + 1 < len(layers) else last(x) if last else x
    return x


def _rows(a: pa.Array) -> np.ndarray:
    """Arrays of one length as a matrix: no object a row."""
    wide = pa.compute.list_value_length(a)
    if a.null_count or pa.compute.min_max(wide)["min"] != pa.compute.min_max(wide)["max"]:
        raise ValueError("arrays are missing or differ in length")
    return a.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(a), -1)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.reshape(-1), pa.float64()))


_NONE = pa.array([], pa.list_(pa.float64()))


def _normed(v: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    return (v - v.mean(1, keepdims=True)) / np.sqrt(v.var(1, keepdims=True) + 1e-5) * scale + shift


def _sent(hs: np.ndarray, hd: np.ndarray, r: np.ndarray, rbf: np.ndarray, f: np.ndarray, weights: dict, x_scale: float) -> tuple[np.ndarray, np.ndarray]:
    """What edges add to h and x of their targets."""
    m = _dense(np.column_stack([hs, hd, rbf, f]), weights["message"], _silu, _silu)
    m = m * _dense(m, weights["gate"], _relu, _sigmoid)
    return _dense(m, weights["update"], _silu, _silu), r * _dense(m, weights["move"], _silu, None) * x_scale


def pass_messages(h: np.ndarray, x: np.ndarray, src: np.ndarray, dst: np.ndarray, f: np.ndarray, weights: dict, n_rbf: int = 18, reach: float = 30.0, x_scale: float = 0.08, most: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """message_passing_layer on arrays: h and x of nodes after edges src to dst (rows of h, sorted by dst), so many edges at a time."""
    dh, dx = np.zeros_like(h), np.zeros_like(x)
    width, gap = reach / n_rbf, reach / (n_rbf - 1)
    for at in range(0, len(src), most):
        s, d = src[at : at + most], dst[at : at + most]
        r = x[s] - x[d]
        rbf = np.exp(-(((np.sqrt((r * r).sum(1))[:, None] - np.arange(n_rbf) * gap) / (width + 1e-8)) ** 2))
        starts = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        for total, part in zip((dh, dx), _sent(h[s], h[d], r, rbf, f[at : at + most], weights, x_scale), strict=True):
            total[d[starts]] += np.add.reduceat(part, starts)
    return _normed(h + float(_sigmoid(np.asarray(weights["alpha"], float))) * dh, *weights["norm"]), x + dx


def message_passing_layer(nodes: DataFrame, edges: DataFrame, weights: dict, n_rbf: int = 18, reach: float = 30.0, x_scale: float = 0.08) -> DataFrame:
    """One layer over all graphs: nodes (graph_id, node, h array, x array of 3), edges (graph_id, src, dst, f array); returns nodes.

    weights: lists of (matrix, bias) for 'message', 'gate', 'update' and 'move', the number 'alpha', and 'norm' (scale, shift).
    With r = x_src - x_dst, an edge's message is m = message[h_src, h_dst, rbf(|r|), f], times gate(m). Summed at dst,
    h = norm(h + sigmoid(alpha) sum update(m)) and x = x + x_scale sum r move(m). A node without edges gets norm(h) and keeps x;
    edges of which an end is no node go. Dense parts run on Arrow batches of edges; weights travel with the function.
    """
    share, (scale, shift) = float(_sigmoid(np.asarray(weights["alpha"], float))), weights["norm"]
    width = len(weights["update"][-1][1])

    @F.arrow_udf("dh array<double>, dx array<double>")
    def send(hs: pa.Array, hd: pa.Array, xs: pa.Array, xd: pa.Array, f: pa.Array, rbf: pa.Array) -> pa.Array:
        if not len(hs):
            return pa.StructArray.from_arrays([_NONE, _NONE], ["dh", "dx"])
        return pa.StructArray.from_arrays([_lists(m) for m in _sent(_rows(hs), _rows(hd), _rows(xs) - _rows(xd), _rows(rbf), _rows(f), weights, x_scale)], ["dh", "dx"])

    @F.arrow_udf("array<double>")
    def norm(h: pa.Array) -> pa.Array:
        if not len(h):
            return _NONE
        return _lists(_normed(_rows(h), scale, shift))

    end = lambda k, p: nodes.select("graph_id", C("node").alias(k), C("h").alias(f"h{p}"), C("x").alias(f"x{p}"))
    both = edges.select("graph_id", "src", "dst", "f").join(end("src", "s"), ["graph_id", "src"]).join(end("dst", "d"), ["graph_id", "dst"])
    d = F.sqrt(F.aggregate(F.zip_with("xs", "xd", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    sent = both.withColumn("d", d).withColumn("m", send("hs", "hd", "xs", "xd", "f", gaussian_rbf("d", n_rbf, 0.0, reach)))
    total = lambda k, n: F.array(*[F.sum(C("m")[k][i]) for i in range(n)])
    got = sent.groupBy("graph_id", C("dst").alias("node")).agg(total("dh", width).alias("dh"), total("dx", 3).alias("dx"))
    add = lambda k, by: F.when(C(f"d{k}").isNull(), C(k)).otherwise(F.zip_with(k, f"d{k}", lambda a, b: a + by * b))
    return nodes.join(got, ["graph_id", "node"], "left").select("graph_id", "node", norm(add("h", F.lit(share))).alias("h"), add("x", F.lit(1.0)).alias("x"))


def random_weights(n_h: int, n_f: int, n_rbf: int = 18, seed: int = 5) -> dict:
    """Weights of the published layer's shape, drawn at random: a stand-in where no trained ones are at hand."""
    rng = np.random.default_rng(seed)

    def layers(*sizes: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(rng.normal(size=(b, a)) / np.sqrt(a), np.zeros(b)) for a, b in zip(sizes, sizes[1:], strict=False)]

    return {"message": layers(2 * n_h + n_rbf + n_f, 320, 160, 128), "gate": layers(128, 64, 1), "update": layers(128, n_h), "move": layers(128, 32, 1), "alpha": 0.8, "norm": (np.ones(n_h), np.zeros(n_h))}


def embed_sequences(sequences: DataFrame, embed: Callable[[list[str]], list[list[float]]], budget: int = 20_000, most: int = 2500) -> DataFrame:
    """label, values: embed is called on batches of sequences (cut at most letters) of about budget letters."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.assign(sequence=f["sequence"].fillna("").str.slice(0, most))
            f = f.iloc[f["sequence"].str.len().argsort(kind="stable")]
            batch = (f["sequence"].str.len().cumsum() // budget).to_numpy()
            for _, part in f.groupby(batch, sort=False):
                yield pd.DataFrame({"label": part["label"], "values": embed(part["sequence"].tolist())})

    return sequences.select("label", "sequence").mapInPandas(run, "label string, values array<double>")


def composition(sequences: list[str]) -> list[list[float]]:
    """A deterministic embedding: for each letter its place in the alphabet, over 26."""
    return [[(ord(c.lower()) - 96) / 26 if c.isascii() and c.isalpha() else 0.0 for c in s] for s in sequences]


_STARTED: dict[str, Callable] = {}


def _started(key: str, start: Callable[[], Callable]) -> Callable:
    """What start gives, called once in each Python worker for a key; a start that raises is tried again by the next structure."""
    if key not in _STARTED:
        _STARTED[key] = start()
    return _STARTED[key]


def map_structures(atoms: DataFrame, tool: Callable[[pd.DataFrame], dict] | None, columns: str, start: Callable[[], Callable[[pd.DataFrame], dict]] | None = None) -> DataFrame:
    """A tool called on each structure's atoms; columns: its result's names and types. Failures become rows with their error.

    start, instead of a tool, gives one: what is dear to set up (a model, a program's handle) is made once a worker, by the first
    structure that needs it, and serves all structures after it.
    """
    if (tool is None) == (start is None):
        raise ValueError("give a tool or a start")
    names = [c.split()[0] for c in columns.split(",")]
    mark = uuid.uuid4().hex

    def one(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        try:
            got = (tool or _started(mark, start))(f)
            return pd.DataFrame([[key[0], *[got[n] for n in names], "ok", None]], columns=["graph_id", *names, "status", "error"])
        except Exception as why:  # noqa: BLE001  reported as a row
            return pd.DataFrame([[key[0], *[None] * len(names), "fail", str(why)[:2000]]], columns=["graph_id", *names, "status", "error"])

    kind = dict(atoms.dtypes)["graph_id"]
    return atoms.groupBy("graph_id").applyInPandas(one, f"graph_id {kind}, {columns}, status string, error string")
