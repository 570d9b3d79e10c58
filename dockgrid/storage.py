"""Intermediate tables in shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; in local mode, where it names none, a new one.

    Raises on a cluster that names none: machines would write to folders of their own.
    """
    if not (at := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='dockgrid-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that is not there yet."""
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(at)
    return at


_OPEN: list[list[str]] = []


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Takes away, when the block ends, the intermediate tables that operators wrote within it.

    A result must be written (or collected) inside the block, since its plan reads these tables:

        with cleared(spark):
            cluster_hierarchy(nodes, edges).write.parquet(out)

    Blocks may stand in blocks. A block that raises is cleared too.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        # By identity: lists of paths that are equal are still other blocks'.
        del _OPEN[next(k for k, x in enumerate(_OPEN) if x is made)]
        for at in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stay_dealt(spark: SparkSession) -> None:
    """Joins on a key and more leave rows where they are if both sides are dealt by the key alone; Spark would deal them again by all columns."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def settle(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes df to shared storage and reads it back: lineage ends here, and a lost executor costs no recomputation.

    by: a column by which the rows are dealt when they are read, once, with the columns that are asked for. Joins, groups and windows
    on it (alone or among others) then move nothing more.
    """
    at = new_path(df.sparkSession, name)
    df.write.parquet(at)
    back = df.sparkSession.read.schema(df.schema).parquet(at)
    if by is None:
        return back
    stay_dealt(df.sparkSession)
    return back.repartition(by)


def settle_dealt(df: DataFrame, name: str, by: str) -> DataFrame:
    """settle for a table of which several joins read different columns: rows are dealt by `by` once, before they are written, as buckets.

    Joins, groups and windows on it (alone or among others) then move nothing, whoever reads. There are spark.sql.shuffle.partitions buckets.
    The catalog names the table only until it is resolved; the files stay, as settle's do.
    """
    spark = df.sparkSession
    stay_dealt(spark)
    at, n = new_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = at.rpartition("/")[2].replace("-", "_")
    df.repartition(n, by).write.format("parquet").bucketBy(n, by).option("path", at).saveAsTable(table)
    back = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return back


def if_small(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """df to be broadcast if it has at most most_rows rows, as it is (for a shuffled join) otherwise."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
