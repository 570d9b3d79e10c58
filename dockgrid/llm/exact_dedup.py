"""Exact deduplication by content-defined chunk recipes.

A rolling hash over the bytes of a text cuts it where its content says so. Each text becomes a recipe: the ordered list of its
chunks' identifiers. An identifier is a chunk's 64-bit hash once it is verified that all chunks with that hash are the same
bytes (chunks are grouped by hash and content, so a chunk's bytes move once for each task that holds it); hashes that
several contents share get a further number by content. Equal texts are those with equal recipes; texts as such never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from dockgrid.llm.common import arrow, repeated_ids, rows, settle
from dockgrid.storage import if_small

_rng = np.random.default_rng(20240601)
#: One random 64-bit value for each byte, for the rolling hash.
GEAR = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
RECIPES = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("n_bytes", pa.int64()), ("recipe", pa.list_(pa.int64()))])
CHUNKS = pa.schema([("h", pa.int64()), ("content", pa.binary())])
PLACED = pa.schema([("text_sha256", pa.string()), ("pos", pa.int64()), ("h", pa.int64()), ("content", pa.binary())])


def cuts(data: bytes, least: int = 1024, mean_bits: int = 12, most: int = 16384) -> list[int]:
    """Ends of the chunks of data: where the hash of the last 32 bytes has mean_bits zeros, between least and most bytes apart."""
    if len(data) <= least:
        return [len(data)]
    h = GEAR[np.frombuffer(data, np.uint8)]
    for s in (1, 2, 4, 8, 16):
        h[s:] = h[s:] + (h[:-s] << np.uint64(s))
    ends, start = [], 0
    for at in (np.flatnonzero((h >> np.uint64(64 - mean_bits)) == 0) + 1).tolist():
        while at - start > most:
            start += most
            ends.append(start)
        if at - start >= least:
            ends.append(start := at)
    while len(data) - start > most:
        start += most
        ends.append(start)
    return ends if start == len(data) else [*ends, len(data)]


def chunks_of(text: str | None, hash_bits: int) -> Iterator[tuple[int, bytes]]:
    data, start = (text or "").encode("utf-8", "surrogatepass"), 0
    for end in cuts(data):
        part = data[start:end]
        yield (xxhash.xxh3_64_intdigest(part) >> (64 - hash_bits)) - (1 << 63 if hash_bits == 64 else 0), part
        start = end


def _recipes(hash_bits: int):
    def run(batches):
        for held in rows(batches):
            ids, texts = zip(*held, strict=True)
            coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            yield arrow({"doc_id": ids, "text_sha256": [hashlib.sha256(x).hexdigest() for x in coded], "n_bytes": [len(x) for x in coded], "recipe": [[h for h, _ in chunks_of(t, hash_bits)] for t in texts]}, RECIPES)

    return run


def _chunks(hash_bits: int):
    def run(batches):
        for held in rows(batches):
            seen: set[tuple[int, bytes]] = set()
            for _, text in held:
                seen.update(chunks_of(text, hash_bits))
            h, content = zip(*seen, strict=True)
            yield arrow({"h": h, "content": content}, CHUNKS)

    return run


def _key(recipe: str) -> Column:
    """A digest of an ordered list of identifiers."""
    return F.sha2(F.concat_ws(",", F.transform(recipe, lambda x: x.cast("string"))), 256)


def exact_dedup(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size long, kept boolean, text_sha256, n_bytes long, recipe array<long>; one row for each row of docs.

    Texts are equal when identical; null counts as ''. Of equal texts one row with the largest doc_id stays (null doc_ids are
    smallest; if all are null, keep_id is null and none stays; of rows alike in doc_id and text one stays). Columns of docs but
    doc_id and text are left out. hash_bits below 64 makes collisions likely, for tests.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(_recipes(hash_bits), "doc_id long, text_sha256 string, n_bytes long, recipe array<long>")
    contents = docs.mapInArrow(_chunks(hash_bits), "h long, content binary").groupBy("h", "content").agg(F.count("*").alias("n"))
    shared = contents.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    if not shared.isEmpty():
        found = _numbered(docs, found, contents, settle(shared, "shared"), hash_bits)
    found = found.withColumn("recipe_key", _key("recipe"))
    groups = found.groupBy("recipe_key", "recipe", "n_bytes").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).drop("recipe")
    same = found.join(groups, ["recipe_key", "n_bytes"])
    if (again := repeated_ids(docs)) is None:
        return same.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256", "n_bytes", "recipe")
    # Rows alike in doc_id and text become one with a count, of which the first stays.
    alike = same.join(again, F.col("doc_id") == F.col("_again"), "left_semi").groupBy("doc_id", "keep_id", "group_size", "text_sha256", "n_bytes", "recipe").agg(F.count("*").alias("copies"))
    alike = alike.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    single = same.join(again, F.col("doc_id") == F.col("_again"), "left_anti").withColumn("copy", F.lit(1).cast("long"))
    whole = single.select(*alike.columns).unionByName(alike)
    return whole.select("doc_id", "keep_id", "group_size", F.coalesce((F.col("doc_id") == F.col("keep_id")) & (F.col("copy") == 1), F.lit(False)).alias("kept"), "text_sha256", "n_bytes", "recipe")


def _numbered(docs: DataFrame, found: DataFrame, contents: DataFrame, shared: DataFrame, hash_bits: int) -> DataFrame:
    """found, in whose recipes a hash that several contents share is followed by the number of the content.

    Only texts that hold such a hash are read again, and of them only the chunks in question meet the contents.
    """
    small = if_small(shared)
    numbers = contents.join(small, "h", "left_semi").select("h", "content", F.row_number().over(Window.partitionBy("h").orderBy("content")).cast("long").alias("variant"))
    held = found.select("text_sha256", F.explode(F.array_distinct("recipe")).alias("h")).join(small, "h").groupBy("text_sha256").agg(F.collect_set("h").alias("hs"))
    held = settle(held, "held")
    texts = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).join(held, "text_sha256").dropDuplicates(["text_sha256"]).select("text_sha256", "text", "hs")

    def placed(batches):
        for some in rows(batches):
            out = [(key, p, h, c) for key, t, hs in some for wanted in [set(hs)] for p, (h, c) in enumerate(chunks_of(t, hash_bits)) if h in wanted]
            yield arrow(dict(zip(PLACED.names, zip(*out, strict=True), strict=True)), PLACED)

    parts = texts.mapInArrow(placed, "text_sha256 string, pos long, h long, content binary").join(numbers, ["h", "content"])
    variants = parts.groupBy("text_sha256").agg(F.map_from_entries(F.collect_list(F.struct("pos", "variant"))).alias("variants"))
    exact = F.flatten(F.transform("recipe", lambda h, p: F.when(F.try_element_at("variants", p.cast("long")).isNull(), F.array(h)).otherwise(F.array(h, F.try_element_at("variants", p.cast("long"))))))
    return found.join(variants, "text_sha256", "left").withColumn("recipe", F.when(F.col("variants").isNull(), F.col("recipe")).otherwise(exact)).drop("variants")
