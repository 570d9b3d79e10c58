"""Language identification with a linear-chain conditional random field over words.

Every word of a line gets a label; its scores come from hashed features (the word itself as lexicon entry, affixes, character
n-grams), neighbouring labels from learned transitions. Marginals by forward-backward say how likely each label is for each
word, which also labels code-switched text (returned as runs of words); a document's language is the label with the largest sum.
Chains are lines. Long ones are stepped through in chunks side by side: each chunk's transfer matrix carries the forward
and backward messages over its borders. Training reads a bounded sample of labelled pieces on the driver; labelling reads
every text whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from dockgrid.llm.common import ODD, mixed, slices

WORD = re.compile(r"[^\W\d_]+")
CHUNK, BUCKETS = 128, 1 << 16
RUNS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("lang", pa.string())]))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' features, word by word, and where each word's begin.

    A lower-cased word between marks has its pairs and triples of characters, four characters at each end (affixes; shorter ones are
    pairs and triples with a mark) and itself (lexicon entry).
    """
    marked = [f"<{w.lower()}>" for w in words]
    c = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(c)) - np.repeat(first, size)
    left = np.repeat(size, size) - at  # characters from here to the word's end
    d = np.concatenate((c, np.zeros(3, np.uint64)))
    n = len(c)
    pair = mixed(d[:n] * np.uint64(0x1F123BB5) + d[1 : n + 1] + np.uint64(2 << 40))
    triple = mixed(pair * np.uint64(31) + d[2 : n + 2])
    four = mixed(triple * np.uint64(31) + d[3 : n + 3])
    power = np.cumprod(np.full(int(size.max()), ODD), dtype=np.uint64)
    whole = mixed(np.add.reduceat(mixed(c) * power[at], first) + size.astype(np.uint64))
    kinds = ((left >= 2, pair), (left >= 3, triple), ((left >= 4) & (at == 0), four), (left == 4, four + np.uint64(1)))
    keys = np.concatenate([*(x[ok] for ok, x in kinds), whole])
    owners = np.concatenate([*(owner[ok] for ok, _ in kinds), np.arange(len(words))])
    order = np.argsort(owners, kind="stable")
    return (keys[order] % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(owners[order], np.arange(len(words)))


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray = field(repr=False)  # BUCKETS x labels
    moves: np.ndarray = field(repr=False)  # from label x to label

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.langs)))
        flat, first = features(words)
        return np.add.reduceat(self.weights[flat], first, axis=0)


def marginals(emit: np.ndarray, moves: np.ndarray, starts: np.ndarray, size: np.ndarray, expected_moves: np.ndarray | None = None, chunk: int | None = None) -> np.ndarray:
    """Label probabilities of each word; emit: log scores in rows, chains from starts with size words (at least 1).

    All chains step together, the longest first. With chunk, chains longer than that are stepped through in chunks, between which the
    messages are carried exactly. expected_moves gathers expected transition counts (without chunk).
    """
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    a = np.exp(moves - moves.max())
    back = np.ones_like(e)
    enter = None
    if chunk and len(size) and size.max() > chunk:
        starts, size, enter, leave = carried(e, a, starts, size, chunk)
        back[starts + size - 1] = leave
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    fore = np.empty_like(e)
    longest = int(size[0]) if len(size) else 0
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest + 1)]  # chains of more than t words
    for t in range(longest):
        at = starts[: active[t]] + t
        if t:
            x = (fore[at - 1] @ a) * e[at]
        elif enter is None:
            x = e[at]
        else:
            x = np.where(np.isnan(enter[order]), e[at], (enter[order] @ a) * e[at])
        fore[at] = x / x.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        x = (e[at + 1] * back[at + 1]) @ a.T
        back[at] = x / x.sum(axis=1, keepdims=True)
    both = fore * back
    if expected_moves is not None:
        later = np.ones(len(e), bool)
        later[starts] = False
        at = np.flatnonzero(later)
        x = fore[at - 1][:, :, None] * a[None] * (e[at] * back[at])[:, None, :]
        expected_moves += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return both / both.sum(axis=1, keepdims=True)


def carried(e: np.ndarray, a: np.ndarray, starts: np.ndarray, size: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes of chunks of the chains, and for each the forward message that enters it (nan: it begins a chain) and the backward
    message that its last word gets from behind."""
    k = e.shape[1]
    pieces = -(-size // chunk)
    chain = np.repeat(np.arange(len(size)), pieces)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    c_starts = starts[chain] + number * chunk
    c_size = np.minimum(chunk, size[chain] - number * chunk)
    enter, leave = np.full((len(chain), k), np.nan), np.ones((len(chain), k))
    # Transfer matrices of the chunks of chains with several: message in, message out.
    mine = np.flatnonzero(pieces[chain] > 1)
    mine = mine[np.argsort(-c_size[mine], kind="stable")]
    transfer = np.empty((len(chain), k, k))
    first = number[mine] == 0
    x = np.where(first[:, None, None], 1.0, a[None]) * e[c_starts[mine]][:, None, :]
    active = [int(np.searchsorted(-c_size[mine], -t, side="left")) for t in range(chunk + 1)]
    x /= x.sum(axis=(1, 2), keepdims=True)
    for t in range(1, chunk):
        n = active[t]
        if not n:
            break
        y = (x[:n] @ a) * e[c_starts[mine[:n]] + t][:, None, :]
        x[:n] = y / y.sum(axis=(1, 2), keepdims=True)
    transfer[mine] = x
    by_number = [np.flatnonzero((number == j) & (pieces[chain] > j + 1)) for j in range(int(pieces.max()) - 1)]
    for at in by_number:  # chunk j of each chain that has a chunk j + 1
        before = np.where(np.isnan(enter[at]), 1.0 / k, enter[at])
        out = (before[:, None, :] @ transfer[at])[:, 0]
        enter[at + 1] = out / out.sum(axis=1, keepdims=True)
    for at in reversed(by_number):
        out = (transfer[at + 1] @ leave[at + 1][:, :, None])[:, :, 0]
        leave[at] = out / out.sum(axis=1, keepdims=True)
    return c_starts, c_size, enter, leave


def train_crf(pieces: list[tuple[str, str]], rounds: int = 40, rate: float = 0.5, ridge: float = 1e-5) -> Crf:
    """pieces: (text, language). Likelihood ascent with AdaGrad steps over all chains."""
    langs = sorted({lang for _, lang in pieces})
    number = {x: k for k, x in enumerate(langs)}
    vocab: dict[str, int] = {}
    ids, gold, size = [], [], []
    for text, lang in pieces:
        if words := WORD.findall(text):
            ids += [vocab.setdefault(w, len(vocab)) for w in words]
            gold += [number[lang]] * len(words)
            size.append(len(words))
    model = Crf(langs, np.zeros((BUCKETS, len(langs))), np.zeros((len(langs), len(langs))))
    if not ids:
        return model
    ids, gold, size = np.array(ids), np.array(gold), np.array(size)
    starts = np.cumsum(size) - size
    flat, first = features(list(vocab))
    owner = np.repeat(np.arange(len(vocab)), np.diff(np.append(first, len(flat))))
    inner = np.ones(len(ids), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    seen = np.zeros_like(model.moves)
    np.add.at(seen, (gold[at - 1], gold[at]), 1)
    # Weak labels never change within a text; a share of changes keeps code-switched chains possible.
    seen = 0.98 * seen + 0.02 * seen.sum(axis=1, keepdims=True) / len(langs)
    sum_w, sum_m = np.full_like(model.weights, 1e-8), np.full_like(model.moves, 1e-8)
    for _ in range(rounds):
        emit = np.add.reduceat(model.weights[flat], first, axis=0)[ids]
        moves = np.zeros_like(model.moves)
        p = marginals(emit, model.moves, starts, size, moves)
        p[np.arange(len(ids)), gold] -= 1
        by_word = np.column_stack([np.bincount(ids, -p[:, k], len(vocab)) for k in range(len(langs))])
        grad = np.column_stack([np.bincount(flat, by_word[owner, k], BUCKETS) for k in range(len(langs))]) / len(ids) - ridge * model.weights
        step = (seen - moves) / len(ids)
        sum_w += grad**2
        sum_m += step**2
        model.weights += rate * grad / np.sqrt(sum_w)
        model.moves += rate * step / np.sqrt(sum_m)
    return model


def fit_language(docs: DataFrame, sample: int = 250, piece: int = 1500) -> Crf:
    """Learns from docs (text, lang): at most sample rows of each language, taken by a hash of doc_id and text, piece characters of each from a
    place that the hash gives. Rows alike count once. Null languages and texts take no part; null doc_ids do. The number of languages
    is taken to be small."""
    docs = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    row = F.xxhash64(F.lit(21), "doc_id", "text")
    count = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.approx_count_distinct(row).alias("n")).collect()}
    if not count:
        return Crf([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, 2.0 * sample / n))) for k, n in count.items()])
    rank = F.pmod(row, F.lit(1 << 40)) / F.lit(float(1 << 40))
    place = F.expr(f"substring(text, cast(1 + pmod(xxhash64(22, doc_id, text), greatest(length(text) - {piece}, 1)) AS int), {piece})")
    near = docs.filter(rank < share).select("lang", rank.alias("rank"), place.alias("piece")).distinct()
    # At most sample rows of a language come to the driver.
    got = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "piece"))).filter(F.col("n") <= sample).toPandas().sort_values(["lang", "rank", "piece"])
    return train_crf(list(zip(got["piece"], got["lang"], strict=True)))


@dataclass
class Memory:
    """Scores of words met before: their rows in a table. Bounded in words and in characters."""

    rows: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None
    chars: int = 0

    def of(self, model: Crf, words: list[str]) -> np.ndarray:
        if len(self.rows) > 300_000 or self.chars > 8_000_000:
            self.rows, self.scores, self.chars = {}, None, 0
        if new := [w for w in dict.fromkeys(words) if w not in self.rows]:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.chars += sum(map(len, new))
            fresh = model.emissions(new)
            self.scores = fresh if self.scores is None else np.concatenate([self.scores, fresh])
        return self.scores[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]


def label(model: Crf, texts: list[str | None], memory: Memory, with_runs: bool = False) -> tuple[list[str], list[float], list[list[dict]]]:
    """Language and its share for each text, and (with_runs) runs of its words of one label."""
    words: list[str] = []
    size: list[int] = []
    docs: list[int] = []
    letters = []
    for k, text in enumerate(texts):
        found = False
        for line in (text or "").split("\n"):
            if part := WORD.findall(line):
                found = found or any(c.isalpha() for w in part for c in w)
                words += part
                size.append(len(part))
                docs.append(k)
        letters.append(found and bool(model.langs))
    if not words or not model.langs:
        return ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    sizes = np.array(size)
    p = marginals(memory.of(model, words), model.moves, np.cumsum(sizes) - sizes, sizes, chunk=CHUNK)
    owner = np.repeat(np.array(docs), sizes)
    total = np.column_stack([np.bincount(owner, p[:, k], len(texts)) for k in range(len(model.langs))])
    best = total.argmax(axis=1)
    share = total[np.arange(len(texts)), best] / np.maximum(total.sum(axis=1), 1e-12)
    runs: list[list[dict]] = [[] for _ in texts]
    if with_runs:
        of = p.argmax(axis=1)
        new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (owner[1:] != owner[:-1]))))
        begins = np.searchsorted(owner, np.arange(len(texts)))
        for s, e in zip(new.tolist(), [*new[1:].tolist(), len(of)], strict=True):
            k = int(owner[s])
            if letters[k]:
                runs[k].append({"s": s - int(begins[k]), "e": e - int(begins[k]), "lang": model.langs[of[s]]})
    return [model.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], [min(1.0, float(s)) if ok else 0.0 for s, ok in zip(share, letters, strict=True)], runs


def languages(docs: DataFrame, model: Crf, with_runs: bool = False) -> DataFrame:
    """All columns of docs and lang_pred string, score double, word_langs array<struct<s int, e int, lang string>> (only with_runs); a row for each row.

    Texts that are null or hold no letter are 'und' with score 0. score: the language's share in the sum of the words' label probabilities.
    Ties go to the language first in the alphabet. word_langs: runs of words, from s to before e, that get one label. Columns of docs
    with the names of added ones are replaced; doc_ids may be null or repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "word_langs")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    if with_runs:
        schema.add("word_langs", ArrayType(StructType([StructField("s", IntegerType()), StructField("e", IntegerType()), StructField("lang", StringType())])))

    def run(batches):
        memory = Memory()
        for batch in batches:
            for part in slices(batch, "text", 500_000):
                langs, scores, runs = label(shared.value, part.column(part.schema.get_field_index("text")).to_pylist(), memory, with_runs)
                added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *([pa.array(runs, RUNS)] if with_runs else [])]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=schema.names)

    return docs.mapInArrow(run, schema)
