"""Line deduplication with DataFrame operations only.

Hashes of line keys are dealt by range and sorted by (hash, document, position) within each range; the first document of a key
is streamed over its sorted run in the same stage, without a further exchange of lines. Keys so common that they would fill
much of a range are split into blocks of documents, which the ranges part; only the first documents of those few keys' blocks
are carried from one range to another. Lines that lose are returned as sparse bitmaps (64 lines a word; words without a
dropped line are absent), and only those bitmaps meet the texts again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockgrid.llm.common import LOWER, UPPER, WHITE, partitions, settle


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _common(lines: DataFrame, each: int = 200) -> DataFrame:
    """h1, h2 of keys that hold about half of an even range or more: at most twice as many as there are ranges.

    Judged on about `each` lines a range, taken by hash. This only settles where runs are split, never what is dropped.
    """
    ranges = partitions(lines.sparkSession)
    share = min(1.0, each * ranges / max(1, lines.count()))
    taken = lines.filter(F.pmod(F.xxhash64(F.lit(31), "doc_id", "pos"), F.lit(1 << 40)) < int(share * (1 << 40)))
    return taken.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= each // 2).select("h1", "h2")


def _streamed(lines: DataFrame, common: DataFrame, blocks: int) -> DataFrame:
    """lines with common (whether the key is) and first_doc, the first document of the key, or of the key's block: one range exchange."""
    ranged = lines.join(F.broadcast(common.withColumn("common", F.lit(True))), ["h1", "h2"], "left").withColumn("common", F.coalesce("common", F.lit(False)))
    ranged = ranged.withColumn("block", F.when(F.col("common"), F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).otherwise(0).cast("int"))
    run = Window.partitionBy("h1", "h2", "block").orderBy("doc_id", "pos")
    return ranged.repartitionByRange("h1", "h2", "block").withColumn("first_doc", F.first("doc_id").over(run))


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, text_key, drop_bits map<word number, 64 bits>, n_dropped long; documents that lose no line are absent.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least min_chars code points
    that occur in two documents or more lose all lines except those of the smallest doc_id. Null text is one empty line.
    Rows with null doc_id take no part and lose nothing; rows of equal doc_id count as one document.
    """
    key = F.translate(F.btrim(F.col("line"), F.lit(WHITE)), UPPER, LOWER)
    lines = (
        docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & (F.char_length("text") >= min_chars))
        .select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "text_key", "pos", key.alias("key")).filter(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key", F.char_length("key")).alias("h2"), "doc_id", "text_key", "pos")
    )
    lines = settle(lines, "lines")
    common = _common(lines)
    streamed = _streamed(lines, common, partitions(docs.sparkSession))
    streamed = settle(streamed.filter("common OR doc_id > first_doc"), "later")
    carried = streamed.filter("common").groupBy("h1", "h2").agg(F.min("first_doc").alias("carried"))
    lost = streamed.join(F.broadcast(carried), ["h1", "h2"], "left").filter(F.col("doc_id") > F.coalesce("carried", "first_doc"))
    words = lost.groupBy("doc_id", "text_key", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc_id", "text_key").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("drop_bits"), F.sum(F.bit_count("bits")).cast("long").alias("n_dropped")
    )


def line_dedup(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """All columns of docs with text replaced by its kept lines, and n_lines long, n_dropped long, keep_bits.

    keep_bits: map<int, long>, the words of the keep bitmap in which some line is dropped (null: every line is kept). Null text
    becomes ''. Columns of docs with the names of added ones are replaced.
    """
    lost = dropped_lines(docs, min_chars).select(F.col("doc_id").alias("_ld_id"), F.col("text_key").alias("_ld_key"), F.col("drop_bits").alias("_ld_bits"), F.col("n_dropped").alias("_ld_n"))
    whole = F.coalesce("text", F.lit(""))
    kept = F.filter(
        lines_of(F.col("text")),
        lambda _, i: F.coalesce(F.getbit(F.try_element_at("_ld_bits", F.shiftright(i, 6)), (i % 64)), F.lit(0)) == 0,
    )
    return (
        docs.join(lost, (F.col("doc_id") == F.col("_ld_id")) & (F.xxhash64("text") == F.col("_ld_key")), "left")
        .withColumn("n_lines", F.size(lines_of(F.col("text"))).cast("long"))
        .withColumn("n_dropped", F.coalesce("_ld_n", F.lit(0)).cast("long"))
        .withColumn("keep_bits", F.transform_values("_ld_bits", lambda _, v: F.bitwise_not(v)))
        .withColumn("text", F.when(F.col("_ld_bits").isNull(), whole).otherwise(F.array_join(kept, "\n")))
        .drop("_ld_id", "_ld_key", "_ld_bits", "_ld_n")
    )
