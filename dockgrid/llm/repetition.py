"""Quality rules by repetition coverage.

Word n-grams of several lengths get rolling hashes from one running sum in numpy: with S(i) the sum of the word hashes times powers
of an odd number, the window that starts at i has (S(i + n) - S(i)) over the i-th power, modulo 2^64. Windows that a text holds
twice or more cover words; the share of the text's characters in them, and in lines that came before, is what the rules judge
(besides the number of symbols, as a measure that costs nothing more).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import ODD, WHITE, arrow, hash_words, mixed, rows

#: Most percent of the characters of words that duplicated n-grams may cover, by n, and that repeated lines may hold.
COVERAGE = {3: 40, 5: 30, 7: 25, 10: 20}
LINES = 30
#: Most symbols for a hundred words: a published rule for web text.
SYMBOLS = 10

_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_NOT_COUNTED = WHITE.encode() + bytes(range(0x80, 0xC0))  # white space, and bytes that begin no code point
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers (at least n of them) of the odd number and of its inverse."""
    size = 1 << max(n - 1, 1).bit_length()
    if size not in _powers:
        _powers.clear()
        _powers[size] = tuple(np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, x), dtype=np.uint64))) for x in (ODD, _INVERSE))
    return _powers[size]


class Rolling:
    """Words of several texts in one array; first: where each text's words begin, and the end."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        self.n, self.first = len(words), first
        self.owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        up, self.down = powers(self.n + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: self.n], dtype=np.uint64)))

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of n words that lie in one text, and their hashes, which tell texts apart."""
        if self.n < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        starts = np.flatnonzero(self.owner[: self.n - n + 1] == self.owner[n - 1 :])
        h = (self.sums[starts + n] - self.sums[starts]) * self.down[starts]
        return starts, mixed(h + mixed(self.owner[starts].astype(np.uint64) + np.uint64(n)))

    def covered(self, n: int) -> np.ndarray:
        """Which words lie in a window of n words that its text holds twice or more."""
        starts, h = self.hashes(n)
        s = np.sort(h)
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        if not len(twice):
            return np.zeros(self.n, bool)
        at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
        starts = starts[twice[at] == h]
        mark = np.zeros(self.n + 1, np.int64)
        mark[starts] += 1
        mark[starts + n] -= 1  # each start once, so each end once
        return np.cumsum(mark)[:-1] > 0


def repeated_lines(data: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    seen: set[bytes] = set()
    lines = chars = 0
    for line in data.split(b"\n"):
        if line in seen:
            lines += 1
            chars += len(line.translate(None, _NOT_COUNTED))
        elif line.strip():
            seen.add(line)
    return lines, chars


def measure(texts: list[bytes], lengths: tuple[int, ...], base: int) -> dict[str, np.ndarray]:
    """Of each text: n_words, word_chars, n_symbols, n_dup_lines, dup_line_chars, n_repeat_words (in windows of base words), covered (characters, a row for each length)."""
    h, starts, ends, first, data = hash_words(texts)
    b = np.frombuffer(data, np.uint8)
    begun = np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))
    size = begun[ends] - begun[starts]
    rolling = Rolling(h, first)

    def by_text(x: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(x)))
        return total[first[1:]] - total[first[:-1]]

    lengths_ = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    marks = np.concatenate(([0], np.cumsum(_SYMBOL[b]), [0]))
    marks[-1] = marks[-2]
    lines = np.array([repeated_lines(t) for t in texts], np.int64).reshape(-1, 2)
    covers = {n: rolling.covered(n) for n in {base, *lengths}}
    return {
        "n_words": np.diff(first), "word_chars": by_text(size), "n_symbols": marks[lengths_[1:]] - marks[lengths_[:-1]], "n_dup_lines": lines[:, 0], "dup_line_chars": lines[:, 1],
        "n_repeat_words": by_text(covers[base]), "covered": np.column_stack([by_text(np.where(covers[n], size, 0)) for n in lengths]) if lengths else np.zeros((len(texts), 0), np.int64),
    }


OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")), ("covered", pa.list_(pa.int64()))])
OUT_SQL = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, covered array<long>"


def repetition(docs: DataFrame, lengths: tuple[int, ...] = tuple(COVERAGE), base: int = 5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars long, covered array<long>; a row for each row of docs.

    Words stand between ASCII white space; word_chars counts their code points, n_symbols the characters #*$%&|<> of the text,
    n_dup_lines the lines with a word that equal an earlier line of the text and dup_line_chars the code points of their words,
    n_repeat_words the words in windows of base words that the text holds twice or more, covered the code points of the words in such windows
    of each of the lengths. Null text is empty: all 0. Rows may repeat and doc_ids be null; other columns of docs are left out.
    """

    def run(batches):
        for held in rows(batches, 1 << 19):
            got = measure([t or b"" for _, t in held], lengths, base)
            got["covered"] = got["covered"].tolist()
            yield arrow({"doc_id": [d for d, _ in held], **got}, OUT)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, OUT_SQL)


def quality_rules(docs: DataFrame, least_words: int = 10, most_repeat: int = 20, coverage: dict[int, int] = COVERAGE, most_lines: int = LINES, most_symbols: int = SYMBOLS) -> DataFrame:
    """The columns of repetition(), base_failed and kept boolean; a row for each row of docs.

    base_failed: fewer than least_words words, or more than most_repeat percent of them in windows of five words that repeat. Of the
    others those are kept of whose word characters duplicated n-grams cover no more than coverage says for each n, and repeated
    lines hold no more than most_lines percent, and that have at most most_symbols symbols for a hundred words. Shares are compared as whole numbers; one that equals its limit is kept.
    """
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat * F.col("n_words"))
    verdict = (100 * F.col("dup_line_chars") <= most_lines * F.col("word_chars")) & (100 * F.col("n_symbols") <= most_symbols * F.col("n_words"))
    for k, most in enumerate(coverage.values()):
        verdict &= 100 * F.col("covered")[k] <= most * F.col("word_chars")
    return repetition(docs, tuple(coverage)).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict)
