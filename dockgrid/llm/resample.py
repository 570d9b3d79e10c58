"""Importance resampling of documents towards a target distribution of hashed word n-grams.

Every bucket of hashed features has a gain, the logarithm of its share in the target over that in the corpus; a document's weight is
the mean of its features' gains, read from one array. With Gumbel noise from a hash of the id, the highest scores are a draw
without replacement in proportion to the weights. The exact cutoff is found by weighted median of medians: each partition names the
median of the keys it has left and their number, and the median of these, weighted by the numbers, has at least a quarter of what is left
on either side of it, so each round discards that much for sure. Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import arrow, rows, settle
from dockgrid.llm.decontaminate import TABLE
from dockgrid.operators.workflow import placed

#: The table of the reflected CRC-32 (polynomial 0xEDB88320).
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> np.uint32(1) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1)).astype(np.uint32)
#: Bytes of a word that are stepped through side by side with those of other words.
_ABREAST = 48


def crc_step(c: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(c ^ byte) & np.uint32(255)] ^ (c >> np.uint32(8))


def crc_words(data: bytes, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the words, each from its own state before."""
    b = np.frombuffer(data, np.uint8)
    size = ends - starts
    order = np.argsort(-np.minimum(size, _ABREAST + 1), kind="stable")
    at, c = starts[order], state[order]
    left = np.searchsorted(-size[order], -np.arange(min(int(size.max(initial=0)), _ABREAST)), side="left") if len(size) else []
    for k, m in enumerate(left):
        c[:m] = crc_step(c[:m], b[at[:m] + k])
    out = np.empty_like(c)
    out[order] = c
    for i in np.flatnonzero(size > _ABREAST).tolist():
        out[i] = zlib.crc32(data[starts[i] + _ABREAST : ends[i]], int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def features(texts: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each text's words begin in all texts' words (and the end), and for runs of 1 to longest words the bucket of the run that
    ends at each word (-1: the text has no such run there)."""
    data = b"\n".join(texts).translate(TABLE)
    edge = np.flatnonzero(np.diff(np.frombuffer(data, np.uint8) != 32, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))))
    place = np.arange(len(starts)) - np.repeat(first[:-1], np.diff(first))
    out, state = [], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    before = None
    for n in range(1, longest + 1):
        if before is not None:  # the run of one word less that ends at the word before, and a space
            state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
            state[1:] = crc_step(before[:-1], np.uint32(32))
        before = crc_words(data, starts, ends, state)
        out.append(np.where(place >= n - 1, (before ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets, -1))
    return first, out


def _counted(longest: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for held in rows(batches, 1 << 19):
            for x in features([t or b"" for (t,) in held], longest, buckets)[1]:
                total += np.bincount(x + 1, minlength=buckets + 1)[1:]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts (column text) fall into each bucket; what comes to the driver is one number a bucket."""
    parts = texts.select(F.col("text").cast("binary")).mapInArrow(_counted(longest, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the corpus), in doubles, for each bucket."""
    k, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])


def scored(docs: DataFrame, gain: np.ndarray, longest: int = 2, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score long; a row for each row of docs."""

    def run(batches):
        for held in rows(batches, 1 << 19):
            first, found = features([t or b"" for _, t in held], longest, len(gain))
            total, n = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
            for x in found:
                for out, value in ((total, np.where(x >= 0, gain[x], 0)), (n, x >= 0)):
                    run_ = np.concatenate(([0], np.cumsum(value)))
                    out += run_[first[1:]] - run_[first[:-1]]
            weight = total // np.maximum(n, 1)
            yield arrow({"doc_id": [d for d, _ in held], "n_words": np.diff(first), "n_features": n, "weight": weight, "score": [w + noise(d, seed) for (d, _), w in zip(held, weight.tolist(), strict=True)]}, SCORED)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


#: The order in which rows are drawn: by falling score, then doc_id (null ones last), then a number that no two rows share.
KEY = ("a", "b", "c")


def _keys(table: DataFrame) -> DataFrame:
    return table.withColumns({"a": -F.col("score"), "b": F.coalesce("doc_id", F.lit((1 << 63) - 1)), "c": F.col("row")})


def _after(key: tuple | None, strict: bool = True):
    """Rows whose key comes after the given one (or is it, unless strict)."""
    if key is None:
        return F.lit(True)
    a, b, c = key
    return F.expr(f"a >= {a} AND (a > {a} OR b > {b} OR (b = {b} AND c {'>' if strict else '>='} {c}))")


def _median(batches):
    held = [np.column_stack([np.asarray(x) for x in b.columns]) for b in batches if b.num_rows]
    if held:
        x = np.concatenate(held)
        k = len(x) // 2
        a = np.partition(x[:, 0], k)[k]
        ties = x[x[:, 0] == a]
        at = ties[np.lexsort((ties[:, 2], ties[:, 1]))][k - int((x[:, 0] < a).sum())]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (len(x), *at.tolist())], names=["n", *KEY])


def cutoff(keys: DataFrame, draw: int, enough: int = 10_000) -> tuple | None:
    """The key at place draw (from 1) of keys (a, b, c long; no two rows alike), or None if there are fewer.

    Each round reads the keys that may still be it: their partitions' medians and sizes come to the driver (a row a partition). When
    at most `enough` keys are left, those up to the place sought are sorted.
    """
    low = high = None  # the key is after low and not after high
    keys, enough = keys.select(*KEY), max(enough, 8)  # of more than 8 keys some are before and some after the middle
    while True:
        left = keys.filter(_after(low) & (~_after(high) if high else F.lit(True)))
        medians = sorted((tuple(r[k] for k in KEY), r["n"]) for r in left.mapInArrow(_median, "n long, a long, b long, c long").collect())
        total = sum(n for _, n in medians)
        if draw < 1 or draw > total:
            return None
        if total <= enough:
            return tuple(left.orderBy(*KEY).limit(draw).collect()[-1])
        seen = 0
        for middle, n in medians:
            seen += n
            if 2 * seen >= total:
                break
        upto = left.filter(~_after(middle)).count()
        if draw <= upto:
            high = middle
        else:
            low, draw = middle, draw - upto


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, longest: int = 2, buckets: int = 10_000, seed: int = 7, enough: int = 10_000) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank long; a row for each row of docs.

    Words are runs of [0-9a-z] and non-ASCII characters after A-Z is lower-cased; features are runs of 1 to longest of them joined by a space,
    counted as often as they occur, in the bucket that their crc32 leaves modulo buckets. weight: the mean of the features' gains, rounded
    down (0 without features); score: weight and Gumbel noise from sha256 of 'seed:doc_id' (a null id counts as an empty one). Of the N rows
    with at least least_words words the floor(percent N / 100) highest scores are drawn, ties to the smaller doc_id (null last), further ones
    to either row; rank is their place from 1, null for the others. Null texts hold no words; rows may repeat. An empty target or table is fine.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    table = settle(scored(docs, gain, longest, seed).withColumn("row", F.monotonically_increasing_id()), "scored")
    may = F.col("n_words") >= least_words
    draw = percent * table.filter(may).count() // 100
    keyed = _keys(table)
    last = cutoff(keyed.filter(may), draw, enough)
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    if last is None:
        return table.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = may & ~_after(last)
    winners = placed(keyed.filter(drawn).withColumn("all", F.lit(0)), "all", [F.col(k) for k in KEY]).select(*columns, F.col("_r").cast("long").alias("rank"))
    return winners.unionByName(keyed.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
