"""What several of the text operators share: reading, staging in shared storage, hashing words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from dockgrid.storage import settle  # noqa: F401  the operators take it from here

#: ASCII white space, and the capital letters that the word and line keys fold.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_hash(column: str = "doc_id"):
    """crc32 of the id as text: the rule by which rows are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def rows(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[list[tuple]]:
    """Rows of Arrow batches in lists of bounded text size (one longer text makes a list of its own)."""
    for batch in batches:
        columns = [c.to_pylist() if pa.types.is_integer(c.type) else c for c in batch.columns]
        held, size = [], 0
        for i in range(batch.num_rows):
            row = tuple(c[i] if isinstance(c, list) else c[i].as_py() for c in columns)
            held.append(row)
            size += sum(len(x) for x in row if isinstance(x, str | bytes)) + 64
            if size >= most_bytes:
                yield held
                held, size = [], 0
        if held:
            yield held


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose strings in the column have about most_bytes bytes (one longer text makes a part of its own)."""
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))), 0)).cumsum()
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + most_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


#: A fixed odd multiplier (the golden ratio in 64 bits).
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * ODD
    return x ^ (x >> np.uint64(32))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, by doubling; empty when there are fewer words."""
    if len(words) < n:
        return words[:0]
    out, done, power, step = None, 0, words, 1
    mult = int(ODD)
    while True:
        if n & step:
            part = power[done : done + len(words) - n + 1] if out is not None else power
            out = power.copy() if out is None else out[: len(words) - n + 1] * np.uint64(mult) + part[: len(words) - n + 1]
            done += step
        if step * 2 > n:
            return mixed(out[: len(words) - n + 1])
        power = power[:-step] * np.uint64(mult) + mixed(power[step:] + np.uint64(step))
        mult = (mult * int(ODD) + 2) % (1 << 64)
        step *= 2


#: Bytes of a word that count by table: an own random number for each byte at each place.
_PLACES = 64
_TABLE = np.random.default_rng(77).integers(0, 1 << 64, _PLACES * 256, dtype=np.uint64)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Of the words between ASCII white space: hashes, and starts and ends in the joined bytes, which come last; before them, each text's first word and the end.

    Words of up to 64 bytes are hashed by tables (the sum of a random number for each byte at its place), longer ones by XXH3.
    """
    data = b"\n".join(texts)
    b = np.frombuffer(data, np.uint8)
    solid = ~_BLANK[b]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    h = np.add.reduceat(_TABLE[np.minimum(at, _PLACES - 1) * 256 + b[solid]], first) if len(first) else np.zeros(0, np.uint64)
    for k in np.flatnonzero(size > _PLACES).tolist():
        h[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    return mixed(h + size.astype(np.uint64)), starts, ends, bounds, data


def planes(x: np.ndarray) -> bytes:
    """Bytes of the values, first bytes first: small numbers then compress to nearly nothing."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    n = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(n, len(data) // n).T).view(kind).reshape(-1)


def arrow(columns: dict[str, list | np.ndarray | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in zip(schema, (columns[f.name] for f in schema), strict=True)], schema=schema)


def repeated_ids(docs: DataFrame) -> DataFrame | None:
    """_again: the doc_ids that several rows of docs have; None if there are none."""
    again = docs.groupBy(F.col("doc_id").cast("long").alias("_again")).agg(F.count("*").alias("n")).filter("_again IS NOT NULL AND n > 1").select("_again")
    return None if again.isEmpty() else again


def row_tags(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id long, text, tag long and the columns: tag is 0 where no other row has the doc_id, else a hash of the text, which tells such rows apart."""
    again = repeated_ids(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *columns)
    if again is None:
        return docs.withColumn("tag", F.lit(0).cast("long")).select("doc_id", "text", "tag", *columns)
    tagged = docs.join(again, F.col("doc_id") == F.col("_again"), "left")
    return tagged.select("doc_id", "text", F.when(F.col("_again").isNull(), 0).otherwise(F.xxhash64(F.coalesce("text", F.lit("")))).cast("long").alias("tag"), *columns)


def groups_of(docs: DataFrame, each: int = 256 << 20) -> int:
    """Into how many groups entries are dealt: eight a shuffle partition, more where a group would stand for over `each` bytes of text."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(8 * partitions(docs.sparkSession), -(-size // each))


#: How the keys of many documents are dealt: one row a task's block and group q holds many entries (packed, first bytes first).
#: A key's further 64 bits (more) and the rows' tags are left out where all are 0.
PACKED = ("keys", "more", "docs", "tags", "places")
DEALT = pa.schema([("q", pa.int32()), ("sure", pa.bool_()), *((x, pa.binary()) for x in PACKED)])
DEALT_SQL = "q int, sure boolean, keys binary, more binary, docs binary, tags binary, places binary"


def deal(keys: np.ndarray, more: np.ndarray, docs: np.ndarray, tags: np.ndarray, places: np.ndarray, q: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """A block's entries (key, document, place), pre-aggregated: only those of a key's smallest document of the block travel to
    the key's group, marked when others share the key; the others, known to repeat, travel apart, spread evenly over groups."""
    if not len(keys):
        return
    whole = (q.astype(np.uint64) << np.uint64(32) | keys,) if keys.itemsize == 4 else (keys, q)
    order = np.lexsort((places, docs, more, *whole)) if more.any() else np.lexsort((places, docs, *whole))
    keys, more, docs, tags, places, q = keys[order], more[order], docs[order], tags[order], places[order], q[order].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (more[1:] != more[:-1]) | (q[1:] != q[:-1]))))
    size = np.diff(np.append(new, len(keys)))
    other = docs != np.repeat(docs[new], size)
    many = np.repeat(np.add.reduceat(other, new) > 0, size)
    places = places * 2 + many
    for part, sure in ((~other, False), (other, True)):
        if not part.any():
            continue
        k, m, d, t, p, g = keys[part], more[part], docs[part], tags[part], places[part], q[part]
        if sure:  # they keep their own group's number beside the place
            p, g = p + (g << 40), (d * 2654435761 + p // 64) % groups
        by = np.argsort(g, kind="stable")
        k, m, d, t, p, g = k[by], m[by], d[by], t[by], p[by], g[by]
        at = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        ends = np.append(at[1:], len(g))
        cut = lambda x, pack, at=at, ends=ends: [pack(x[a:b]) for a, b in zip(at, ends, strict=True)]
        unless_0 = lambda x: x.tobytes() if x.any() else b""
        yield arrow({"q": g[at].astype(np.int32), "sure": np.full(len(at), sure), "keys": cut(k, np.ndarray.tobytes), "more": cut(m, unless_0), "docs": cut(d, planes), "tags": cut(t, unless_0), "places": cut(p, planes)}, DEALT)


def repeated(table: pa.Table, kind: type) -> tuple[np.ndarray, ...]:
    """Of a group's rows: documents, tags, places, keys and the keys' groups of entries whose key two documents hold, and whether a smaller document holds it too."""
    out, own = [], int(table["q"][0].as_py()) if len(table) else 0
    for sure in (False, True):
        part = table.filter(pa.compute.equal(table["sure"], sure))
        data = [part[x].to_pylist() for x in PACKED]
        joined = lambda k, kind, read, data=data: np.concatenate([read(x) if x else np.zeros(len(docs) // 8, kind) for x, docs in zip(data[k], data[2], strict=True)] or [np.zeros(0, kind)])
        plain = lambda kind: lambda x: np.frombuffer(x, kind)
        keys, more, tags = joined(0, kind, plain(kind)), joined(1, np.uint64, plain(np.uint64)), joined(3, np.int64, plain(np.int64))
        docs, places = (joined(k, np.int64, lambda x: unplanes(x, np.int64)) for k in (2, 4))
        if sure or not len(keys):
            out.append((docs, tags, places % (1 << 40) >> 1, keys, places >> 40, np.ones(len(docs), bool)))
            continue
        order = np.lexsort((docs, more, keys)) if more.any() else np.lexsort((docs, keys))
        keys, more, docs, tags, places = keys[order], more[order], docs[order], tags[order], places[order]
        new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (more[1:] != more[:-1]))))
        size = np.diff(np.append(new, len(keys)))
        later = docs != np.repeat(docs[new], size)
        both = np.repeat(np.add.reduceat(later | (places & 1 == 1), new) > 0, size)
        out.append((docs[both], tags[both], places[both] >> 1, keys[both], np.full(int(both.sum()), own, np.int64), later[both]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
