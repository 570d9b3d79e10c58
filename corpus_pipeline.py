"""A corpus pipeline of five stages over documents; each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockgrid.llm.common import row_tags, settle, table
from dockgrid.llm.decontaminate import decontaminate
from dockgrid.llm.language import fit_language, languages
from dockgrid.llm.line_dedup import line_dedup
from dockgrid.llm.near_dup import near_duplicates
from dockgrid.llm.queries import vocabulary
from dockgrid.llm.sentencepiece_codec import sentencepiece

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.4) -> DataFrame:
    """Documents without letters, and those of which no language holds the share least, go; lang becomes the predicted one.

    The model learns from the langs of the same rows (a bounded sample). Each row is judged by its own text: null and repeated doc_ids don't matter. Null and empty texts hold no letter.
    """
    docs = docs.select(*COLUMNS)
    found = languages(docs, fit_language(docs)).filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of smaller doc_id holds go from the texts; documents that lose all they had go whole.

    Rows with null doc_id keep their lines; rows that share a doc_id are one document. Null texts become empty and stay.
    """
    left = line_dedup(docs.select(*COLUMNS))
    return _sized(left.filter((F.col("text") != "") | (F.col("n_dropped") == 0)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: one with the smallest doc_id.

    Rows that share a doc_id are documents of their own; of rows alike in doc_id and text one stays. Rows with null doc_id stay,
    as no group names them. Texts without words are in no group.
    """
    stay = near_duplicates(docs).filter("stays").select("doc_id", "tag").distinct()
    kept = row_tags(docs.filter("doc_id IS NOT NULL"), "lang", "source", "n_chars").join(stay, ["doc_id", "tag"], "left_semi")
    kept = kept.filter("tag = 0").unionByName(kept.filter("tag <> 0").dropDuplicates(["doc_id", "tag"]))
    return kept.select(*COLUMNS).unionByName(docs.filter("doc_id IS NULL").select(*COLUMNS))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go from the texts; documents of which more than half is such go whole. Each row is judged by its own text; null and empty texts stay as they are."""
    return _sized(decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, round_trip: a row for each row that is left. Null and empty texts have no ids."""
    return sentencepiece(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "n_ids", "ids", "round_trip")


STAGES = [("language_id", language_id), ("line_dedup", lines), ("near_duplicates", near), ("decontamination", benchmark_free), ("sentencepiece", encoded)]

#: Models and tokenizers have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's result written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
