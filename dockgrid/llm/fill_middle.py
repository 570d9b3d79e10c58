"""Fill-in-middle transformation with cuts at unit borders, found through a Fenwick tree over fixed text blocks.

A text is UTF-8 bytes in blocks of fixed size. A Fenwick tree over the blocks holds how many units (lines) end and how many code
points begin in each; a cut after so many units descends the tree by halving steps to the block in which the last of them ends,
and only that block is looked into. Code points before a cut are those of the blocks passed on the way down and of the block's
own part. Building the tree is linear in the blocks, a cut takes their logarithm.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dockgrid.llm.common import arrow, rows

OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])
OUT_SQL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


class Fenwick:
    """Sums of rows (units, code points) over prefixes of blocks; built in linear time."""

    def __init__(self, counts: np.ndarray):
        self.n = len(counts)
        self.tree = np.concatenate((np.zeros((1, counts.shape[1]), np.int64), counts.astype(np.int64)))
        step = 1
        while step <= self.n:  # each node of one level takes in its left neighbour of that level
            at = np.arange(2 * step, self.n + 1, 2 * step)
            self.tree[at] += self.tree[at - step]
            step *= 2

    def descend(self, k: int) -> tuple[int, int, int]:
        """The block (from 0) in which the k-th unit ends, k at least 1, and the units and code points of the blocks before it."""
        at = units = chars = 0
        step = 1 << self.n.bit_length()
        while step := step >> 1:
            if at + step <= self.n and units + self.tree[at + step, 0] < k:
                at += step
                units += int(self.tree[at, 0])
                chars += int(self.tree[at, 1])
        return at, units, chars


class Cutter:
    """Units, and the places of cuts after so many of them, of one text (UTF-8)."""

    def __init__(self, data: bytes, block: int):
        self.block, self.bytes = block, np.frombuffer(data, np.uint8)
        self.ends = self.bytes == 10
        self.begins = (self.bytes & 0xC0) != 0x80
        self.n = int(np.count_nonzero(self.ends)) + bool(data and data[-1] != 10)
        self.chars = int(np.count_nonzero(self.begins))
        if data:
            firsts = np.arange(0, len(data), block)
            self.tree = Fenwick(np.column_stack([np.add.reduceat(x, firsts, dtype=np.int64) for x in (self.ends, self.begins)]))

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points before the place after so many units."""
        if units <= 0:
            return 0, 0
        if units >= self.n:
            return len(self.bytes), self.chars
        at, before, chars = self.tree.descend(units)
        a = at * self.block
        b = a + 1 + int(np.flatnonzero(self.ends[a : a + self.block])[units - before - 1])
        return b, chars + int(np.count_nonzero(self.begins[a:b]))


def transformed(doc: int | None, data: bytes, seed: int, fim_percent: int, spm_percent: int, marks: tuple[bytes, bytes, bytes], block: int) -> tuple:
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    text = Cutter(data, block)
    if not data or any(m in data for m in marks) or h3 % 100 >= fim_percent:
        return doc, text.n, "plain", None, None, data
    (a, a_chars), (b, b_chars) = (text.cut(k) for k in sorted((h1 % (text.n + 1), h2 % (text.n + 1))))
    p, s, m = marks
    view = memoryview(data)
    if h4 % 100 < spm_percent:
        return doc, text.n, "spm", a_chars, b_chars - a_chars, b"".join((s, view[b:], p, view[:a], m, view[a:b]))
    return doc, text.n, "psm", a_chars, b_chars - a_chars, b"".join((p, view[:a], s, view[b:], m, view[a:b]))


def fill_in_middle(docs: DataFrame, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"), block: int = 4096) -> DataFrame:
    """doc_id, n long (units), form (plain, psm or spm), prefix_chars, middle_chars long (code points, null if plain), output string; a row for each row of docs.

    Units are lines with their line feed, the last one perhaps without. Cuts and forms follow from sha256 of 'seed:doc_id', so equal
    rows (repeated ids too) are cut alike; a null doc_id counts as an empty one. Null and empty texts are plain, with no units; so are
    texts that hold a mark, and the share 100 - fim_percent. marks: before prefix, suffix and middle; the first character of each
    must not occur further in, so that no mark arises where parts meet. Other columns of docs are left out.
    """
    if any(len(m) < 2 or m[0] in m[1:] or m[0] in x[1:] or x.startswith(m) for m, x in permutations(marks, 2)):
        raise ValueError("no mark may begin another, and their first characters must not occur further in")
    raw = tuple(m.encode() for m in marks)

    def run(batches):
        for held in rows(batches):
            out = [transformed(doc, text or b"", seed, fim_percent, spm_percent, raw, block) for doc, text in held]
            yield arrow(dict(zip(OUT.names, zip(*out, strict=True), strict=True)), OUT)

    cut = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, OUT_SQL)
    return cut.withColumn("output", F.col("output").cast("string"))


def restored(output: str | Column = "output", form: str | Column = "form", marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in marks), -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
