"""Structured Streaming forms of what the batch operators do once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StreamingQuery

from dockgrid.plans.interface_graphs import FIELD, build_graphs
from dockgrid.sources.structures import cure_lines, lines_of, parse_atoms, split_models
from dockgrid.sources.tables import is_whole, write_graphs
from dockgrid.storage import settle

C = F.col


def metric_windows(samples: DataFrame, width: str, watermark: str, ts: str = "ts", by: tuple[str, ...] = ("prefix", "metric")) -> DataFrame:
    """Tumbling windows: start, by, n, mean, max. The same plan runs on a batch table, which is its oracle."""
    df = samples.withWatermark(ts, watermark) if samples.isStreaming else samples
    out = df.groupBy(F.window(ts, width), *by).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max"))
    return out.select(C("window.start").alias("start"), *by, "n", "mean", "max")


def latest_progress(events: DataFrame, key: str = "shard_id", ts: str = "ts") -> DataFrame:
    """Latest status of each shard (update or complete mode)."""
    return events.groupBy(key).agg(F.max_by("status", ts).alias("status"), F.max(ts).alias("at"), F.count("*").alias("n_events"))


def dedup_labels(labels: DataFrame, label: str = "label", ts: str | None = None, watermark: str | None = None) -> DataFrame:
    """First occurrence of each label; with a watermark the state is bounded to late arrivals within it."""
    if labels.isStreaming and ts and watermark:
        return labels.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([label])
    return labels.dropDuplicates([label])


def running_predictions(parts: DataFrame, score: str = "dockq") -> DataFrame:
    """One row: count, sketched quantiles and bins over all shards so far (complete mode)."""
    s = C(score)
    return parts.groupBy().agg(F.count("*").alias("rows"), F.avg(s).alias("mean"), F.percentile_approx(s, [0.1, 0.25, 0.5, 0.75, 0.9]).alias("quantiles"), F.count_if(s >= 0.49).alias("high"), F.count_if((s >= 0.23) & (s < 0.49)).alias("med"), F.count_if(s < 0.23).alias("low"))


def ingest(files: DataFrame, checkpoint: str, build: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Calls build(new rows, batch number) for what arrived since the checkpoint, then stops; a rerun goes on where it ended."""
    return files.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_structures(spark: SparkSession, root: str, store: str, checkpoint: str, *, per_batch: int | None = None, named: Column | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 64, **options) -> StreamingQuery:
    """Interface graphs of the structure files that have come below root since the checkpoint go to the store (read_graphs); then it stops.

    Each file is read once. A micro-batch is parsed, cured and built as build_graphs(**options) builds it and written under its number, so one
    that was cut short and is repeated leaves what one run leaves. status: a row for each graph with n_atoms, n_nodes and error
    (of a bad annotation, or 'no contacts'); a file without atoms has no graph and is named by its path. per_batch: most files of a batch.
    named: graph_id as an expression of path, instead of the file's name and model. prepare: what is done to the atoms before, such as
    merging chains. Without a force field atoms that carry no parameters have 0.
    """
    files = spark.readStream.format("text").schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true")
    if per_batch:
        files = files.option("maxFilesPerTrigger", per_batch)

    def build(new: DataFrame, number: int) -> None:
        session = new.sparkSession
        if is_whole(session, store, number):
            return
        whole = settle(new, "files")
        lines = lines_of(whole) if named is not None else split_models(lines_of(whole))
        lines = lines.withColumn("graph_id", named) if named is not None else lines
        atoms = parse_atoms(cure_lines(lines))
        atoms = prepare(atoms) if prepare else atoms
        atoms = settle(atoms.withColumns({c: F.lit(0.0) for c in FIELD if c not in atoms.columns}), "atoms")
        graphs = build_graphs(atoms, **options)
        sizes = settle(graphs["nodes"].groupBy("graph_id").agg(F.count("*").alias("n_nodes")), "sizes")
        status = atoms.groupBy("graph_id").agg(F.count("*").alias("n_atoms")).join(sizes, "graph_id", "left").join(graphs["failed"], "graph_id", "left")
        status = status.select("graph_id", F.lit(None).cast("string").alias("path"), "n_atoms", F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"), F.coalesce("error", F.when(C("n_nodes").isNull(), "no contacts")).alias("error"))
        bare = whole.filter(~C("value").rlike("(?m)^(ATOM  |HETATM)")).select(F.lit(None).cast(atoms.schema["graph_id"].dataType).alias("graph_id"), "path", F.lit(0).cast("long").alias("n_atoms"), F.lit(0).cast("long").alias("n_nodes"), F.lit("no atoms").alias("error"))
        write_graphs(store, graphs["nodes"], graphs["edges"], buckets=buckets, batch=number, status=status.unionByName(bare))

    return ingest(files.load(root).select(C("_metadata.file_path").alias("path"), "value"), checkpoint, build)


def progress_sessions(events: DataFrame, watermark: str, idle: str, key: str = "shard_id", ts: str = "ts") -> DataFrame:
    """key, session long, status, at, n_events long, closed boolean: of each shard that a batch touches or that falls idle (update mode).

    A shard's state lives until the watermark has passed its last event by idle; then its row comes once more, closed, and the state is
    gone. A shard that goes on later begins a new session. Of events at one time the greatest status counts. Events with a null time or key
    are left out. progress_of() puts the sessions of a shard together.
    """
    schema = T.StructType([events.schema[key], T.StructField("session", T.LongType()), T.StructField("status", T.StringType()), T.StructField("at", T.LongType()), T.StructField("n_events", T.LongType()), T.StructField("closed", T.BooleanType())])
    at = C(ts).cast("timestamp")
    wait = events.sparkSession.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {idle}"))).first()[0]

    def step(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if closed := state.hasTimedOut:
            session, status, last, n = state.get
            state.remove()
        else:
            session, status, last, n = state.get if state.exists else (state.getCurrentWatermarkMs(), None, None, 0)
            for part in parts:
                n += len(part)
                top = part[part["_us"] == part["_us"].max()]["status"].dropna().max()
                top = None if isinstance(top, float) else top
                newest = int(part["_us"].max())
                if last is None or newest > last or (newest == last and (top or "") > (status or "")):
                    last, status = newest, top
            state.update((session, status, last, n))
            state.setTimeoutTimestamp(max(last // 1000 + wait, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [keys[0]], "session": [session], "status": [status], "at": [last], "n_events": [n], "closed": [closed]})

    timed = events.filter(C(ts).isNotNull() & C(key).isNotNull()).select(key, "status", at.alias(ts)).withWatermark(ts, watermark).withColumn("_us", F.unix_micros(ts))
    out = timed.groupBy(key).applyInPandasWithState(step, schema, "session long, status string, at long, n long", "update", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("at", F.timestamp_micros("at"))


def progress_of(sessions: DataFrame, key: str = "shard_id") -> DataFrame:
    """key, status, at, n_events: what latest_progress says of all events, from all rows that progress_sessions gave."""
    last = sessions.groupBy(key, "session").agg(F.max(F.struct("n_events", "at", "status")).alias("last"))
    return last.groupBy(key).agg(F.max(F.struct(C("last")["at"].alias("at"), C("last")["status"].alias("status"))).alias("top"), F.sum(C("last")["n_events"]).alias("n_events")).select(key, C("top")["status"].alias("status"), C("top")["at"].alias("at"), "n_events")


def ingest_labels(labels: DataFrame, store: str, checkpoint: str, label: str = "label", order: tuple[str, ...] = ()) -> StreamingQuery:
    """The first row of each label over all that arrives goes to the store (Parquet, a folder a batch), exactly once; then it stops.

    No streaming state: a batch's labels (the first by order, then any) are held against those of the store's earlier batches. A repeated
    batch overwrites its own folder. Null labels are left out. labels must have no column named batch.
    """
    schema = T.StructType([*labels.schema.fields, T.StructField("batch", T.LongType())])

    def keep(new: DataFrame, number: int) -> None:
        w = Window.partitionBy(label).orderBy(*(order or (label,)))
        first = new.filter(C(label).isNotNull()).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
        if number:
            before = new.sparkSession.read.schema(schema).parquet(store).filter(C("batch") < number)
            first = first.join(before.select(label), label, "left_anti")
        first.select(*labels.columns).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return ingest(labels, checkpoint, keep)


def ingest_predictions(parts: DataFrame, store: str, checkpoint: str, score: str = "dockq", k: int = 2000) -> StreamingQuery:
    """A row for each batch of shards goes to the store: rows, sum, bins and a mergeable sketch of its scores; then it stops.

    A repeated batch overwrites its own row. A KLL sketch of size k holds a few k values however many came.
    """
    s = C(score).cast("double")

    def keep(new: DataFrame, number: int) -> None:
        row = new.agg(F.count("*").alias("rows"), F.sum(s).alias("total"), F.count(s).alias("n"), F.count_if(s >= 0.49).alias("high"), F.count_if((s >= 0.23) & (s < 0.49)).alias("med"), F.count_if(s < 0.23).alias("low"), F.kll_sketch_agg_double(s, F.lit(k)).alias("sketch"))
        row.write.mode("overwrite").parquet(f"{store}/batch={number}")

    return ingest(parts, checkpoint, keep)


def merged_predictions(spark: SparkSession, store: str, shares: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """One row: rows, mean, quantiles (array), high, med, low of all batches of the store; nothing is read but their rows.

    The rank of a quantile is off by no more than about 2.5 / k^0.94 of all rows (0.2 percent for k = 2000) with 99 percent confidence.
    """
    sums = [F.sum(c).alias(c) for c in ("rows", "total", "n", "high", "med", "low")]
    one = spark.read.parquet(store).agg(*sums, F.kll_merge_agg_double("sketch").alias("sketch"))
    quantiles = F.when(C("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares))))
    return one.select("rows", F.try_divide("total", "n").alias("mean"), quantiles.alias("quantiles"), "high", "med", "low")
