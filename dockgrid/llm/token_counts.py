"""Token counts by overlap resynchronisation.

Texts longer than a chunk are encoded in overlapping chunks with offsets. Where two chunks overlap, their token streams are spliced at a
boundary that both have and that is proven stable: a token starts there in both and ASCII white space stands before it, where
no token, no normalisation and no special string reaches across. Where an overlap holds no such place, the text is gone through
chunk by chunk and the overlap doubled until there is one (at last it reaches the end of the text). Every count is the
library's on this text; nothing is remembered from one text to another.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockgrid.llm.common import WHITE, arrow, rows

OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


@cache
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def stable(text: str, at: int) -> bool:
    """Tokens of text can't reach across at: white space stands before it, none after."""
    return text[at - 1] in WHITE and text[at] not in WHITE


def chunk_ids(encode, text: str, chunk: int, overlap: int) -> Iterator[list[int]]:
    """Ids of text in pieces that, joined, are those of the whole. encode: text -> (ids, starts of tokens)."""
    start = 0
    while start < len(text):
        wide, end = overlap, min(len(text), start + chunk)
        while True:
            stop = min(len(text), end + wide)
            ids, at = encode(text[start:stop])
            if stop == len(text):
                yield ids
                return
            # The next chunk begins where this one's overlap does; both must have the boundary.
            _, other = encode(text[end:stop])
            there = {x + end for x in other}
            splice = next((k for k, x in enumerate(at) if x + start in there and x + start > end and stable(text, x + start)), None)
            if splice is not None:
                yield ids[:splice]
                start += at[splice]
                break
            wide *= 2


def spliced(text: str, begin: int, end: int, left, right, start: int) -> tuple[int, int] | None:
    """Numbers of the tokens of left (which starts at `start` of text) and right (at begin) that start at the first stable place
    after begin and before end."""
    for at in range(begin + 1, end):
        if stable(text, at):
            a, b = left.char_to_token(at - start), right.char_to_token(at - begin)
            if a is not None and b is not None and left.token_to_chars(a)[0] == at - start and right.token_to_chars(b)[0] == at - begin:
                return a, b
    return None


def count_all(path: str, texts: list[str], chunk: int, overlap: int) -> list[int]:
    t = tokenizer(path)
    starts = [range(0, max(1, len(x) - overlap), chunk) for x in texts]
    parts = (x[k : k + chunk + overlap] for x, at in zip(texts, starts, strict=True) for k in at)
    # Some chunks at a time: the encodings of a huge text are never held at once.
    coded = (e for block in iter(lambda: list(islice(parts, 256)), []) for e in t.encode_batch(block, add_special_tokens=False))

    def encode(part: str):
        e = t.encode(part, add_special_tokens=False)
        return e.ids, [a for a, _ in e.offsets]

    out = []
    for x, at in zip(texts, starts, strict=True):
        left, n, first, whole = next(coded), 0, 0, None
        for k in range(1, len(at)):
            right = next(coded)
            if whole is None:
                found = spliced(x, at[k], min(len(x), at[k - 1] + chunk + overlap), left, right, at[k - 1])
                if found is None:
                    whole = sum(map(len, chunk_ids(encode, x, chunk, 2 * overlap)))
                else:
                    n, first = n + found[0] - first, found[1]
            left = right
        n = n + len(left) - first if whole is None else whole
        out.append(n)
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 2048, chunk: int = 4096, overlap: int = 128) -> DataFrame:
    """doc_id, n_bytes long (UTF-8), n_tokens long, over_limit boolean; one row for each row of docs.

    path: a tokenizers JSON file on every machine, whose tokenizer must not join text across ASCII white space (the
    word_bpe and other word-splitting vocabularies). Tokens are those of the library without added special tokens, truncation or
    padding; special strings within texts count as the library takes them. Null text is empty; repeated rows and null doc_ids are
    counted like others; columns of docs but doc_id and text are left out. chunk, overlap: characters.
    """

    def run(batches):
        for held in rows(batches, 1 << 20):
            texts = [t or "" for _, t in held]
            yield arrow({"doc_id": [i for i, _ in held], "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": np.array(count_all(path, texts, chunk, overlap), np.int64)}, OUT)

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
