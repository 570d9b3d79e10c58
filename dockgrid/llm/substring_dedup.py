"""Substring deduplication by level-wise doubling.

Level one looks at windows of half the length sought, and of those only at anchors: the smallest hash among the half windows
of each full window, so every full window holds an anchor and equal windows hold equal ones. Only full windows whose
anchor repeats in another document are looked at on the next level, at every position; windows of twice a length are looked
at only where both halves repeat, until no candidates survive. Entries of a block are combined before the shuffle, so a
passage in a third of all documents travels once for each block, not once for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import DEALT_SQL, arrow, deal, grams, groups_of, hash_words, mixed, repeated, row_tags, rows, settle

RANGES = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("later", pa.bool_())])
RANGES_SQL = "doc_id long, tag long, s int, e int, later boolean"


def sliding(x: np.ndarray, n: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) over every n neighbouring values."""
    done = 1
    while done * 2 <= n:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (n - done)], x[n - done :]) if n > done else x


def least_of(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of half windows, and for each full window the smallest among its half windows."""
    half = grams(words, window // 2)
    return half, sliding(half, window - window // 2 + 1, np.minimum)


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the half windows that are the smallest of some full window."""
    half, least = least_of(words, window)
    n = window - window // 2 + 1
    edge = np.zeros(n - 1, np.uint64)
    at = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), n, np.maximum) == half)
    return at, half[at]


def _words(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class Block:
    """Gathers entries and deals them out when there are many."""

    def __init__(self, groups: int, most: int = 300_000):
        self.groups, self.most, self.parts, self.n = groups, most, [], 0

    def add(self, keys, doc: int, places, q, tag: int = 0, more=None) -> bool:
        self.parts.append((keys, np.zeros(len(keys), np.uint64) if more is None else more, np.full(len(keys), doc, np.int64), np.full(len(keys), tag, np.int64), places.astype(np.int64), q))
        self.n += len(keys)
        return self.n >= self.most

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            *entries, q = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.parts, self.n = [], 0
            yield from deal(*entries, q % np.uint64(self.groups), self.groups)


def _level_one(window: int, groups: int):
    def run(batches):
        block = Block(groups)
        for held in rows(batches, 200_000):
            h, _, _, first, _ = hash_words([_words(t) for _, t, _ in held])
            for k, (doc, _, tag) in enumerate(held):
                words = h[first[k] : first[k + 1]]
                if len(words) >= window:
                    at, keys = anchors(words, window)
                    if block.add(keys, doc, at, mixed(keys), tag):
                        yield from block.flush()
        yield from block.flush()

    return run


def _within(places: np.ndarray, s: np.ndarray, e: np.ndarray, n: int) -> np.ndarray:
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, np.minimum(s, n), 1)
    np.add.at(mark, np.minimum(e, n), -1)
    return np.cumsum(mark)[places] > 0


def _next_level(window: int, length: int, groups: int):
    """length is that of the windows to look at; ranges are those that repeat at half of it."""

    def run(batches):
        block = Block(groups)
        for held in rows(batches, 200_000):
            h, _, _, first, _ = hash_words([_words(t) for _, t, _, _ in held])
            for k, (doc, _, tag, ranges) in enumerate(held):
                words = h[first[k] : first[k + 1]]
                n = len(words) - length + 1
                if n <= 0:
                    continue
                s, e = (np.array([r[x] for r in ranges], np.int64) for x in ("s", "e"))
                if length == window:
                    half, least = least_of(words, window)
                    held_there = np.flatnonzero(_within(np.arange(len(half)), s, e, len(half)))
                    at = np.flatnonzero(np.isin(least, half[held_there]))
                    q = least[at]
                else:
                    at = np.arange(n)
                    both = _within(np.arange(n + length), s, e, n + length)
                    at = at[both[:n] & both[length // 2 : length // 2 + n]]
                    q = grams(words, length // 2)[at]
                # The half that deals the window out belongs to its key: equal windows agree in 128 bits.
                if block.add(grams(words, length)[at], doc, at, mixed(q + np.uint64(1)), tag, q):
                    yield from block.flush()
        yield from block.flush()

    return run


def _ranges(later_only: bool):
    def run(table: pa.Table) -> pa.Table:
        docs, tags, places, _, _, later = repeated(table, np.uint64)
        if later_only:
            docs, tags, places, later = docs[later], tags[later], places[later], later[later]
        order = np.lexsort((places, tags, docs))
        docs, tags, places, later = docs[order], tags[order], places[order], later[order]
        if not len(docs):
            return RANGES.empty_table()
        new = np.flatnonzero(np.concatenate(([True], (docs[1:] != docs[:-1]) | (tags[1:] != tags[:-1]) | (places[1:] > places[:-1] + 1) | (later[1:] != later[:-1]))))
        last = np.append(new[1:], len(docs)) - 1
        return pa.table({"doc_id": docs[new], "tag": tags[new], "s": places[new].astype(np.int32), "e": (places[last] + 1).astype(np.int32), "later": later[new]}, schema=RANGES)

    return run


def repeated_windows(docs: DataFrame, window: int = 50, grow: bool = False) -> DataFrame:
    """doc_id, tag, length, s, e: ranges of places where windows of length words start that a document of smaller doc_id holds too.

    With grow the windows are doubled (window, 2 window, ...) until none repeats; otherwise length is window. window is even.
    Words stand between ASCII white space. Null texts hold no words; rows with null doc_id take no part. Rows of one doc_id are one
    document (they don't repeat each other); their texts may differ, and tag (see row_tags) tells which row a range is of.
    """
    groups = groups_of(docs)
    docs = row_tags(docs).filter("doc_id is not null")
    ranges = docs.mapInArrow(_level_one(window, groups), DEALT_SQL).groupBy("q").applyInArrow(_ranges(False), RANGES_SQL)
    length, found = window, []
    while True:
        grown = docs.join(ranges.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("s", "e")).alias("ranges")), ["doc_id", "tag"]).select("doc_id", "text", "tag", "ranges")
        dealt = grown.mapInArrow(_next_level(window, length, groups), DEALT_SQL)
        if not grow:
            return dealt.groupBy("q").applyInArrow(_ranges(True), RANGES_SQL).select("doc_id", "tag", F.lit(length).alias("length"), "s", "e")
        ranges = settle(dealt.groupBy("q").applyInArrow(_ranges(False), RANGES_SQL), "windows")
        found.append(ranges.filter("later").select("doc_id", "tag", F.lit(length).alias("length"), "s", "e"))
        if ranges.isEmpty():
            out = found[0]
            for x in found[1:]:
                out = out.unionByName(x)
            return out
        length *= 2


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string()), ("kept_sha256", pa.string())])


def _kept(window: int, with_text: bool):
    def run(batches):
        for held in rows(batches):
            out = []
            for doc, text, ranges in held:
                words = _words(text).split()
                gone = 0
                if ranges:
                    mark = np.zeros(len(words) + 1, np.int32)
                    for r in ranges:
                        mark[r["s"]] += 1
                        mark[r["e"] - 1 + window] -= 1
                    keep = np.cumsum(mark)[:-1] == 0
                    gone = int((~keep).sum())
                    kept = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
                else:
                    kept = b" ".join(words)
                out.append((doc, len(words), gone, kept.decode("utf-8", "surrogatepass") if with_text else None, hashlib.sha256(kept).hexdigest()))
            yield arrow(dict(zip(KEPT.names, zip(*out, strict=True), strict=True)), KEPT)

    return run


def substring_dedup(docs: DataFrame, window: int = 50, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by a space; null unless with_text), kept_sha256; a row for each row of docs.

    Words covered by a window that also starts in a document with a smaller doc_id go; windows are judged on the input. Null text
    has no words; rows with null doc_id lose nothing and make none lose; rows of one doc_id are one document, each judged by its
    own text. Columns of docs but doc_id and text are left out.
    """
    ranges = repeated_windows(docs, window).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    whole = row_tags(docs).join(ranges, ["doc_id", "tag"], "left").select("doc_id", "text", "ranges")
    return whole.mapInArrow(_kept(window, with_text), "doc_id long, n_words long, n_removed long, text string, kept_sha256 string")
