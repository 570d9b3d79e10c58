"""Benchmark decontamination with a generalised suffix automaton over the words of the benchmark items.

Documents stream through the automaton word by word, keeping the longest suffix that some item holds. Words covered by a
window (`window` consecutive words of an item, or a whole shorter item) are hit. The automaton has at most two states for
each benchmark word. Larger benchmarks are dealt into shards of about shard_words words; tasks build the shards' automata, which
are written to shared storage and broadcast one after the other, so what a machine holds stays bounded however large the
benchmark is.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import arrow, rows, settle, slices

#: Bytes: A-Z to a-z; all ASCII but letters and digits to a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
SPANS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("text_key", pa.string())])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


class Automaton:
    """Of several word sequences: steps[state] maps a word's number to a state, whose longest string has size[state] words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.ids = window, {}
        self.steps, self.link, self.size = [{}], [-1], [0]
        ends: dict[int, set[str]] = {}  # state -> items in which its longest string ends
        self.whole: dict[int, list[tuple[int, str]]] = {}  # state -> (length, item) of short items that are windows themselves
        for name, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
                ends.setdefault(last, set()).add(name)
        # Item names climb to the state that holds strings of `window` words, and no further.
        by_size = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for s in reversed(by_size):
            if s in ends and self.size[self.link[s]] >= window:
                ends.setdefault(self.link[s], set()).update(ends.pop(s))
        for name, words in items:
            if 0 < len(words) < window:
                s = 0
                for w in words:
                    s = self.steps[s][self.ids[w]]
                self.whole.setdefault(s, []).append((len(words), name))
        # Items whose windows end at a state: those of its ancestor that holds strings of `window` words.
        self.full = {s: frozenset(e) for s, e in ends.items() if self.size[self.link[s]] < window <= self.size[s]}
        self.top = list(range(len(self.size)))  # that ancestor
        self.short = [0] * len(self.size)  # the nearest state, itself or an ancestor, whose string is a short item (0: none)
        for s in by_size:
            if self.size[self.link[s]] >= window:
                self.top[s] = self.top[self.link[s]]
            self.short[s] = s if s in self.whole else self.short[self.link[s]]
        self.least = min([window, *(n for x in self.whole.values() for n, _ in x)])
        numbers = [[self.ids[w] for w in words] for _, words in items]
        self.pairs = np.unique(np.array([(a << 32) + b for x in numbers for a, b in pairwise(x)], np.int64))

    def _extend(self, last: int, w: int) -> int:
        steps, link, size = self.steps, self.link, self.size
        if w in steps[last]:
            q = steps[last][w]
            return q if size[q] == size[last] + 1 else self._clone(last, w, q)
        steps.append({}), link.append(0), size.append(size[last] + 1)
        new, p = len(size) - 1, last
        while p >= 0 and w not in steps[p]:
            steps[p][w] = new
            p = link[p]
        if p >= 0:
            q = steps[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        steps, link, size = self.steps, self.link, self.size
        steps.append(dict(steps[q])), link.append(link[q]), size.append(size[p] + 1)
        copy = len(size) - 1
        link[q] = copy
        while p >= 0 and steps[p].get(w) == q:
            steps[p][w] = copy
            p = link[p]
        return copy

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of words, start to end, that can hold a window: all their neighbouring pairs occur in items."""
        ok = ids >= 0
        if self.least > 1:
            pair = (ids[:-1] << 32) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
            ok = ok[:-1] & ok[1:] & (self.pairs[at] == pair) if len(self.pairs) and len(pair) else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.astype(np.int8), [0]))))
        more = 1 if self.least > 1 else 0
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a + more >= self.least:
                yield a, b + more

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words covered by windows, overlapping ones merged, and the items whose windows occur."""
        ids = np.fromiter((self.ids.get(w, -1) for w in words), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        seen: set[int] = set()
        steps, link, size, window, top, short = self.steps, self.link, self.size, self.window, self.top, self.short
        for a, b in self.runs(ids):
            s = n = 0
            for i, w in enumerate(ids[a:b].tolist(), a):
                while s and w not in steps[s]:
                    s = link[s]
                    n = size[s]
                if (to := steps[s].get(w)) is None:
                    n = 0
                    continue
                s, n = to, n + 1
                longest = 0
                if n >= window:
                    longest, t = window, top[s]
                    if t not in seen:
                        seen.add(t)
                        items |= self.full[t]
                t = short[s]
                while t:
                    for length, name in self.whole[t]:
                        if length <= n:
                            items.add(name)
                            longest = max(longest, length)
                    t = short[link[t]]
                if longest:
                    x = i + 1 - longest
                    if spans and x <= spans[-1][1]:
                        while spans and x <= spans[-1][1]:
                            x = min(x, spans.pop()[0])
                    spans.append((x, i + 1))
        return spans, items


PIECES = pa.schema([("item", pa.string()), ("piece", pa.int32()), ("words", pa.binary()), ("n", pa.int64())])
SHARDS = pa.schema([("shard", pa.int64()), ("automaton", pa.binary())])


def _pieces(window: int, step: int):
    """Texts of items in pieces that overlap in window - 1 words."""

    def run(batches):
        for held in rows(batches):
            out = [(item, k, b" ".join(words[at : at + step + window - 1]), len(words[at : at + step + window - 1])) for item, text in held for words in [words_of(text)] for k, at in enumerate(range(0, max(1, len(words) - window + 1), step)) if words]
            if out:
                yield arrow(dict(zip(PIECES.names, zip(*out, strict=True), strict=True)), PIECES)

    return run


def _built(window: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("item", "ascending"), ("piece", "ascending"), ("words", "ascending")])
        items = [(i, w.split(b" ")) for i, w in zip(table["item"].to_pylist(), table["words"].to_pylist(), strict=True)]
        return pa.table({"shard": table["shard"][:1], "automaton": [pickle.dumps(Automaton(items, window))]}, schema=SHARDS)

    return run


def shards_of(benchmark: DataFrame, window: int, shard_words: int) -> DataFrame:
    """shard long, automaton binary: of about shard_words words each, built in tasks, in shared storage. No rows for a benchmark without words.

    Pieces are dealt by item and words, so an item_id of many rows is in as many shards as its words need; equal pieces of an item are one.
    """
    items = benchmark.select(F.col("item_id").cast("string"), "text").filter("item_id is not null")
    pieces = items.mapInArrow(_pieces(window, max(window, shard_words // 16)), "item string, piece int, words binary, n long")
    # Of equal pieces the number of the first one stays, for a fixed order within the shard.
    pieces = settle(pieces.groupBy("item", "words").agg(F.min("piece").alias("piece"), F.first("n").alias("n")), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = 1 if total <= shard_words else -(-5 * total // (4 * shard_words))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)).cast("long"))
    return settle(dealt.groupBy("shard").applyInArrow(_built(window), "shard long, automaton binary"), "automata")


#: The automaton that this worker used last, by its broadcast's number.
_loaded: dict[int, Automaton] = {}


def automaton_of(number: int, data: bytes) -> Automaton:
    if number not in _loaded:
        _loaded.clear()
        _loaded[number] = pickle.loads(data)
    return _loaded[number]


def _apply(shared, number: int):
    def run(batches):
        found = automaton_of(number, shared.value)
        for held in rows(batches, 1 << 20):
            out = []
            for doc, text in held:
                words = words_of(text)
                spans, items = found.matches(words)
                out.append((doc, len(words), [x for s in spans for x in s], sorted(items), hashlib.md5((text or "").encode("utf-8", "surrogatepass")).hexdigest()))
            yield arrow(dict(zip(SPANS.names, zip(*out, strict=True), strict=True)), SPANS)

    return run


SPANS_SQL = "doc_id long, n_words long, hits array<int>, items array<string>, text_key string"


def _shared(automata: DataFrame, shard: int | None):
    """A broadcast of a shard's automaton (None: of an empty one), as bytes, and a number that tells it from others."""
    data = pickle.dumps(Automaton([], 1)) if shard is None else bytes(automata.filter(F.col("shard") == shard).first()["automaton"])
    return automata.sparkSession.sparkContext.broadcast(data), uuid.uuid4().int


def _merged(docs: DataFrame, automata: DataFrame, shards: list[int]) -> DataFrame:
    """_id, _key, hits, items of the rows of docs that some shard hits. The shards take turns: each one's hits are written before the next one's
    automaton is sent."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = []
    for shard in shards:
        shared, number = _shared(automata, shard)
        parts.append(settle(docs.mapInArrow(_apply(shared, number), SPANS_SQL).filter(F.size("hits") > 0), "hits"))
        shared.destroy()
    spans = F.expr("transform(sequence(0, size(hits) div 2 - 1), i -> struct(hits[2 * i] AS s, hits[2 * i + 1] AS e))")
    last = lambda done: F.element_at(done, -1)
    merged = F.aggregate(
        F.array_sort("p"), F.expr("cast(array() AS array<struct<s:int,e:int>>)"),
        lambda done, x: F.when((F.size(done) > 0) & (last(done)["e"] >= x["s"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["s"].alias("s"), F.greatest(last(done)["e"], x["e"]).alias("e"))))).otherwise(F.concat(done, F.array(x))),
    )
    gathered = reduce(DataFrame.unionByName, parts).withColumn("p", spans).groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_set("p")).alias("p"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    return gathered.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.flatten(F.transform(merged, lambda x: F.array(x["s"], x["e"]))).alias("_hits"), F.col("items").alias("_items"))


def _with_hits(docs: DataFrame, hits: DataFrame) -> DataFrame:
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return docs.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (key == F.col("_key")), "left")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 200_000) -> DataFrame:
    """doc_id, n_words long, hits array<int> (starts and ends of hit word spans), items array<string> (sorted), text_key; a row for each row of docs.

    Words are runs of [0-9a-z] and non-ASCII characters after A-Z is lower-cased. Null texts have no words; null item_ids take no
    part; rows of docs may repeat and doc_ids be null. Items of one item_id are one item. Columns of docs but doc_id and text are left out.
    """
    automata = shards_of(benchmark, window, shard_words)
    shards = [r["shard"] for r in automata.select("shard").collect()]
    if len(shards) < 2:
        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_apply(*_shared(automata, shards[0] if shards else None)), SPANS_SQL)

    def counted(batches):
        for held in rows(batches):
            yield arrow({"doc_id": [x[0] for x in held], "n_words": [len(words_of(x[1])) for x in held], "hits": [x[2] or [] for x in held], "items": [x[3] or [] for x in held], "text_key": [hashlib.md5((x[1] or "").encode("utf-8", "surrogatepass")).hexdigest() for x in held]}, SPANS)

    return _with_hits(docs, _merged(docs, automata, shards)).select(F.col("doc_id").cast("long"), "text", "_hits", "_items").mapInArrow(counted, SPANS_SQL)


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    plain = np.frombuffer(data.translate(TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], plain.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep, at = [], 0
    for a, b in spans:
        keep.append(data[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*keep, data[at:]]).decode("utf-8", "surrogatepass")


def _cut(batch: pa.RecordBatch, spans: list[list[tuple[int, int]]], n_words: list[int], max_coverage: float) -> pa.RecordBatch:
    """The batch without the spans of its texts and without the rows of which more than max_coverage is hit."""
    at = batch.schema.get_field_index("text")
    keep = [sum(b - a for a, b in x) <= max_coverage * n for x, n in zip(spans, n_words, strict=True)]
    texts = [cut_spans(text, x) if x else text for text, x in zip(batch.column(at).to_pylist(), spans, strict=True)]
    out = batch.set_column(at, batch.schema.field(at).name, pa.array(texts, batch.schema.field(at).type))
    return out.filter(pa.array(keep))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, shard_words: int = 200_000) -> DataFrame:
    """docs without the spans that benchmark items hold; documents of which more than max_coverage is hit go.

    All columns of docs; text loses its hit words and what stands between them. Null and empty texts stay as they are; rows may
    repeat and doc_ids be null. Benchmarks of more than shard_words words are dealt into shards: their spans are merged by doc_id
    and text and joined back.
    """
    automata = shards_of(benchmark, window, shard_words)
    shards = [r["shard"] for r in automata.select("shard").collect()]
    if not shards:
        return docs
    if len(shards) == 1:
        shared, number = _shared(automata, shards[0])

        def run(batches):
            found = automaton_of(number, shared.value)
            for batch in (part for whole in batches for part in slices(whole, "text", 1 << 19)):
                words = [words_of(x) for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                yield _cut(batch, [found.matches(x)[0] for x in words], [len(x) for x in words], max_coverage)

        return docs.mapInArrow(run, docs.schema)

    joined = _with_hits(docs, _merged(docs, automata, shards)).select(*docs.columns, "_hits")

    def run_joined(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 19)):
            hits = [x or [] for x in batch.column(batch.num_columns - 1).to_pylist()]
            batch = batch.select(batch.schema.names[:-1])
            n_words = [len(words_of(x)) for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield _cut(batch, [list(zip(x[::2], x[1::2], strict=True)) for x in hits], n_words, max_coverage)

    return joined.mapInArrow(run_joined, docs.schema)
