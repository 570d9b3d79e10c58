"""Graph stores, predictions, metrics and epoch results."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dockgrid.functions.scalars import clean_mol_id

C = F.col
FAMILIES = ("sys", "disk", "net", "proc", "core", "gpu")


#: Order of the rows of a graph within its bucket, as far as a table has the columns.
STORE_ORDER = ("node_idx", "edge_type", "src_idx", "dst_idx", "chain", "res_seq", "serial", "node")


def write_graphs(path: str, nodes: DataFrame, edges: DataFrame, scores: DataFrame | None = None, clusters: DataFrame | None = None, buckets: int = 64, *, batch: int | None = None, **more: DataFrame) -> None:
    """One Parquet table for each kind, partitioned by a hash bucket of graph_id, rows of a graph together and in their order.

    edges hold both types with the integer index of their ends, as build_graphs gives them. batch: a part of a store that grows: its
    rows go to a folder of their own, which a repeated batch overwrites, and count once the batch is noted as whole. So a batch that was
    cut short and repeated leaves the store as if it had run once.
    """
    spark = nodes.sparkSession
    for name, df in {"nodes": nodes, "edges": edges, "scores": scores, "clusters": clusters, **more}.items():
        if df is not None:
            b = df.withColumn("bucket", F.pmod(F.xxhash64("graph_id"), F.lit(buckets)).cast("int"))
            order = [c for c in STORE_ORDER if c in df.columns]
            # A graph has one bucket, so rows dealt by graph_id already, as build_graphs leaves them, stay where they are.
            out = b.repartition("graph_id").sortWithinPartitions("bucket", "graph_id", *order).write.partitionBy("bucket")
            out.parquet(f"{path}/{name}") if batch is None else out.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
    if batch is not None:
        spark.range(1).select(F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{path}/whole/number={batch}")


def _noted(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("batch long").parquet(f"{path}/whole").select("batch")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def is_whole(spark: SparkSession, path: str, batch: int) -> bool:
    """Whether a batch of the store was written to its end."""
    noted = _noted(spark, path)
    return noted is not None and not noted.filter(C("batch") == batch).isEmpty()


def read_graphs(spark: SparkSession, path: str, names: tuple[str, ...] = ("nodes", "edges", "scores", "clusters")) -> dict[str, DataFrame]:
    """The tables of a store; of one that grows by batches only those written to their end."""
    noted = _noted(spark, path)
    if noted is None:
        return {n: spark.read.parquet(f"{path}/{n}").drop("bucket") for n in names}
    return {n: spark.read.parquet(f"{path}/{n}").join(noted.distinct(), "batch", "left_semi").drop("bucket", "batch") for n in names}


def merge_predictions(parts: list[DataFrame]) -> DataFrame:
    """mol string, dockq float of all shards; no rows at all are an error."""
    out = reduce(DataFrame.unionByName, [p.select(C("mol").cast("string").alias("mol"), C("dockq").cast("float").alias("dockq")) for p in parts])
    if out.isEmpty():
        raise ValueError("no predictions in any shard")
    return out


def export_predictions(df: DataFrame, path: str | None = None, compress: bool = True) -> DataFrame:
    """pdb_id, predicted_dockq with model numbers stripped; written as gzipped TSV (or CSV) if path is given."""
    out = df.select(clean_mol_id("mol").alias("pdb_id"), C("dockq").alias("predicted_dockq"))
    if path:
        out.write.csv(path, sep="\t" if compress else ",", header=True, **({"compression": "gzip"} if compress else {}))
    return out


def read_metrics(spark: SparkSession, root: str, families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """prefix, source, ts, metric, value of <family>_metrics_<prefix>.csv files; unparsable numbers are 0."""
    parts = []
    for family in families:
        try:
            df = spark.read.option("header", "true").option("pathGlobFilter", f"{family}_metrics_*.csv").option("recursiveFileLookup", "true").csv(root)
        except Exception as e:  # noqa: BLE001
            if "UNABLE_TO_INFER_SCHEMA" in str(e):
                continue
            raise
        cols = [c for c in df.columns if c != "timestamp"]
        if not cols:
            continue
        name = F.regexp_extract(F.input_file_name(), rf"{family}_metrics_(.*)\.csv$", 1)
        wide = df.select(name.alias("prefix"), C("timestamp").try_cast("timestamp_ntz").alias("ts"), *[F.coalesce(C(c).try_cast("double"), F.lit(0.0)).alias(c) for c in cols])
        parts.append(wide.unpivot(["prefix", "ts"], cols, "metric", "value").withColumn("source", F.lit(family)))
    if not parts:
        return spark.createDataFrame([], "prefix string, ts timestamp_ntz, metric string, value double, source string")
    return reduce(DataFrame.unionByName, parts)


def read_pmon(spark: SparkSession, path: str) -> DataFrame:
    """ts, gpu, pid, sm of GPU process logs; comments, malformed lines and rows without a process go."""
    parts = spark.read.text(path).filter(~F.trim("value").startswith("#")).select(F.split(F.trim("value"), r"\s+").alias("p")).filter(F.size("p") >= 6)
    ok = C("p")[0].rlike(r"^\d{8}$") & C("p")[1].rlike(r"^\d\d:\d\d:\d\d$") & C("p")[2].rlike(r"^\d+$") & (C("p")[3] != "-")
    return parts.filter(ok).select(F.try_to_timestamp(F.concat_ws(" ", C("p")[0], C("p")[1]), F.lit("yyyyMMdd HH:mm:ss")).cast("timestamp_ntz").alias("ts"), C("p")[2].cast("int").alias("gpu"), C("p")[3].alias("pid"), F.coalesce(C("p")[5].try_cast("double"), F.lit(0.0)).alias("sm"))


def write_epoch_results(df: DataFrame, path: str) -> None:
    """df: epoch, phase, name, value (array or number as string); null values are skipped.

    A folder for each phase; epochs are a column in rising order within its files, so reads of some skip the rest, and neither files
    nor folders grow in number with the epochs.
    """
    df.filter("value IS NOT NULL").repartitionByRange("phase", "epoch").sortWithinPartitions("phase", "epoch").write.mode("append").partitionBy("phase").parquet(path)


def read_epoch_results(spark: SparkSession, path: str, phase: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(C("phase") == phase) if phase else df


def load_atoms(atoms: DataFrame, columns: tuple[str, ...], chain: str | None = None, names: tuple[str, ...] | None = None) -> DataFrame:
    """A filtered projection; filter and columns reach the Parquet scan."""
    if chain is not None:
        atoms = atoms.filter(C("chain") == chain)
    if names:
        atoms = atoms.filter(C("atom_name").isin(*names))
    return atoms.select(*columns)
