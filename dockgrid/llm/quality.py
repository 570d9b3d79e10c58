"""Quality classifier by compression.

Two zstandard dictionaries are built, from pieces of good and of bad labelled texts. A text's raw score is the difference of its
sizes under the two dictionaries over its size without one; logistic regression on labelled texts that gave the
dictionaries no pieces turns it (and the logarithm of the length) into a probability. What is fitted on is bounded by
sample rows of each label, taken in the order of a hash of their ids; scoring reads every text whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import arrow, doc_hash, rows

OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


@dataclass
class Compression:
    """Dictionaries (bad, good; empty: none), and weights of the constant, the difference and the log length."""

    bad: bytes
    good: bytes
    weights: tuple[float, float, float]
    level: int = 3

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in (self.bad, self.good, b""):
            more = {}
            if data:
                more["dict_data"] = zstandard.ZstdCompressionDict(data)
                more["dict_data"].precompute_compress(level=self.level)
            out.append(zstandard.ZstdCompressor(level=self.level, write_content_size=False, write_checksum=False, write_dict_id=False, **more))
        return out

    @staticmethod
    def features(compressors, text: str | None) -> tuple[float, float]:
        data = (text or "").encode("utf-8", "surrogatepass")
        bad, good, plain = (len(c.compress(data)) for c in compressors)
        return (bad - good) / plain, math.log1p(len(data))

    def score(self, x: tuple[float, float]) -> float:
        z = self.weights[0] + self.weights[1] * x[0] + self.weights[2] * x[1]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-5, rounds: int = 60) -> np.ndarray:
    """Weights of (1, x) by Newton steps."""
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack((np.ones(len(x)), (x - centre) / spread))
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge * len(x) * np.eye(len(w)), a.T @ (weight * (y - p)) - ridge * len(x) * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return np.concatenate(([w[0] - (w[1:] * centre / spread).sum()], w[1:] / spread))


def _features(model: Compression):
    def run(batches):
        compressors = model.compressors()
        for held in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array([q for q, _, _ in held], pa.int32()), pa.array([k for _, k, _ in held], pa.int64()), *(pa.array(x, pa.float64()) for x in zip(*(model.features(compressors, t) for _, _, t in held), strict=True))], names=["label", "rank", "d", "n"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, piece: int = 400, dict_bytes: int = 112_640) -> Compression:
    """Learns from at most sample rows of each label (labels: doc_id, quality 0 or 1; null labels, null doc_ids and empty texts are left out;
    rows of one doc_id are told apart by their texts, and rows alike count once).

    Half of the rows (by hash) give three pieces of piece characters each to the dictionaries; the others calibrate, weighted to
    the labels' shares. With no rows of one label the score is the share of the other (0.5 without any).
    """
    rank = F.xxhash64(F.lit(11), "doc_id")
    labels = labels.select("doc_id", F.col("quality").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    share = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        p = {(): 0.5, (0,): 0.02, (1,): 0.98}[tuple(share)]
        return Compression(b"", b"", (math.log(p / (1 - p)), 0.0, 0.0))
    chosen = F.broadcast(reduce(DataFrame.unionByName, [labels.filter(F.col("label") == q).orderBy(rank, "doc_id").limit(sample) for q in (0, 1)]))
    both = docs.select("doc_id", "text").join(chosen, "doc_id").filter(F.length("text") > 0)
    teach = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(2)) == 0
    places = [F.expr(f"substring(text, cast(1 + pmod(xxhash64(13, doc_id, {k}), greatest(length(text) - {piece}, 1)) AS int), {piece})") for k in range(3)]
    # Rows that share a doc_id are told apart by their texts; at most sample rows of a label come to the driver, rows alike once.
    both = both.withColumn("rank", F.xxhash64(rank, "text"))

    def bounded(made):
        return reduce(DataFrame.unionByName, [x.distinct().orderBy(*x.columns).limit(sample) for x in (made(both.filter(F.col("label") == q)) for q in (0, 1))]).toPandas()

    pieces = bounded(lambda x: x.filter(teach).select("label", "rank", F.array(*places).alias("pieces"))).sort_values(["label", "rank"])
    dicts = []
    for q in (0, 1):
        data = [p.encode("utf-8", "surrogatepass") for x in pieces["pieces"][pieces["label"] == q] for p in x]
        try:
            dicts.append(zstandard.train_dictionary(dict_bytes, data, level=3).as_bytes())
        except zstandard.ZstdError:  # too few pieces to train on: they are the dictionary themselves
            dicts.append(b"".join(data)[-dict_bytes:])
    raw = Compression(dicts[0], dicts[1], (0.0, 1.0, 0.0))
    seen = bounded(lambda x: x.filter(~teach).select(F.col("label").cast("int"), "rank", "text").mapInArrow(_features(raw), "label int, rank long, d double, n double"))
    if seen["label"].nunique() < 2:
        p = share[1] / (share[0] + share[1])
        return Compression(dicts[0], dicts[1], (math.log(p / (1 - p)), 0.0, 0.0))
    seen = seen.sort_values(["label", "rank", "d", "n"])
    y = seen["label"].to_numpy(float)
    weight = np.where(y == 1, share[1] / y.sum(), share[0] / (len(y) - y.sum()))
    return Compression(dicts[0], dicts[1], tuple(logistic(seen[["d", "n"]].to_numpy(), y, weight * len(y) / weight.sum()).tolist()))


def quality_scores(docs: DataFrame, model: Compression) -> DataFrame:
    """doc_id, score double (0 to 1, higher: label 1 likelier); one row for each row of docs, repeated ones too. Null text counts as empty, which has a score too; texts are compressed whole."""

    def run(batches):
        compressors = model.compressors()
        for held in rows(batches):
            yield arrow({"doc_id": [i for i, _ in held], "score": [model.score(model.features(compressors, t)) for _, t in held]}, OUT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def held_out(modulus: int, value: int):
    return F.coalesce(F.pmod(doc_hash(), F.lit(modulus)) == value, F.lit(False))
