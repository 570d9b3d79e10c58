"""Run telemetry: series statistics, counters, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

C = F.col


def _micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone. Gaps are taken between these: seconds since 1970 as doubles are 0.2 microseconds apart."""
    return F.unix_micros(C(ts).cast("timestamp"))


def series_stats(df: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """n, mean, median, p95, max, min, pstdev and shares above 0, at 10, 50, 80 and more; quantiles interpolate at (n-1) q."""
    v = C(value)
    share = lambda test: F.avg(test.cast("double"))
    return df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.percentile(v, 0.95).alias("p95"), F.max(v).alias("max"), F.min(v).alias("min"),
        F.stddev_pop(v).alias("pstdev"), share(v > 0).alias("frac_gt0"), share(v >= 10).alias("frac_ge10"), share(v >= 50).alias("frac_ge50"), share(v >= 80).alias("frac_ge80"),
    ).fillna(0.0)


def prediction_stats(df: DataFrame, by: list[str], score: str = "dockq", exact: bool = True) -> DataFrame:
    """Counts, quantiles and quality bins; exact=False uses a quantile sketch of bounded size."""
    s = C(score)
    q = (lambda p: F.percentile(s, p)) if exact else (lambda p: F.percentile_approx(s, p, 10_000))
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.avg(s).alias("mean"), q(0.5).alias("median"), F.min(s).alias("min"), F.max(s).alias("max"), q(0.1).alias("p10"), q(0.25).alias("p25"), q(0.75).alias("p75"),
        q(0.9).alias("p90"), F.count_if(s >= 0.49).alias("high"), F.count_if((s >= 0.23) & (s < 0.49)).alias("med"), F.count_if(s < 0.23).alias("low"),
    )


def counter_rates(df: DataFrame, host: str, device: str, ts: str, counter: str) -> DataFrame:
    """MiB a second by host and time: growth of each device's counter since its last reading (never below 0), summed, over the
    time since the host's last sample; 0 without one."""
    w = Window.partitionBy(host, device).orderBy(ts)
    grown = df.withColumn("grown", F.greatest(F.lit(0.0), C(counter) - F.lag(counter).over(w)))
    per = grown.groupBy(host, ts).agg(F.coalesce(F.sum("grown"), F.lit(0.0)).alias("grown"))
    gap = (_micros(ts) - F.lag(_micros(ts)).over(Window.partitionBy(host).orderBy(ts))) / 1e6
    return per.withColumn("gap", gap).select(host, ts, F.when(C("gap").isNull(), 0.0).otherwise(C("grown") / F.greatest(C("gap"), F.lit(1e-6)) / 1048576).alias("rate"))


def median_sampling(df: DataFrame, by: str, ts: str) -> DataFrame:
    """Median of the positive gaps between samples in seconds; 0 with fewer than three samples."""
    w = Window.partitionBy(by).orderBy(ts)
    gaps = df.select(by, ((_micros(ts) - F.lag(_micros(ts)).over(w)) / 1e6).alias("gap"))
    return gaps.groupBy(by).agg(F.when(F.count("*") < 3, 0.0).otherwise(F.coalesce(F.percentile(F.when(C("gap") > 0, C("gap")), 0.5), F.lit(0.0))).alias("sampling"))


def relative_time(df: DataFrame, by: str, ts: str, order: str) -> DataFrame:
    """rel: seconds since the first time; a missing time carries the last one; without any time the row number."""
    w = Window.partitionBy(by).orderBy(order)
    micros = _micros(ts)
    carried = F.last(micros, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    first = F.min(micros).over(Window.partitionBy(by))
    return df.withColumn("rel", F.when(first.isNull(), (F.row_number().over(w) - 1).cast("double")).otherwise((F.coalesce(carried, first) - first) / 1e6))


def progress_eta(done: DataFrame, by: str, ts: str, total: int, newest: int = 20) -> DataFrame:
    """done: completions. rate (1/s) of the newest ones and eta in seconds; null eta and status 'insufficient' if fewer than two, no
    time between them, or nothing left."""
    last = done.withColumn("rn", F.row_number().over(Window.partitionBy(by).orderBy(C(ts).desc())))
    n = last.groupBy(by).agg(F.count("*").alias("n_done"), F.count_if(C("rn") <= newest).alias("k"), F.max(_micros(ts)).alias("t1"), F.min(F.when(C("rn") <= newest, _micros(ts))).alias("t0"))
    ok = (C("k") >= 2) & (C("t1") > C("t0")) & (C("n_done") < total)
    rate = (C("k") - 1) / (F.nullif(C("t1") - C("t0"), F.lit(0)) / 1e6)
    return n.select(by, "n_done", F.when(ok, rate).alias("rate"), F.when(ok, (total - C("n_done")) / rate).alias("eta"), F.when(ok, "ok").otherwise("insufficient").alias("status"))


def stage_time_share(df: DataFrame, columns: tuple[str, ...] = ("prep_s", "annotate_s", "graphs_s", "cluster_s")) -> DataFrame:
    """stage, seconds, percent of all."""
    sums = df.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns])
    total = sum((C(c) for c in columns), F.lit(0.0))
    parts = F.array(*[F.struct(F.lit(c).alias("stage"), C(c).cast("double").alias("seconds"), F.when(total > 0, 100 * C(c) / total).otherwise(0.0).alias("percent")) for c in columns])
    return sums.select(F.inline(parts))


def run_rollup(df: DataFrame, by: str) -> DataFrame:
    """Shards by outcome, inputs and wall time of each run; inputs fall back to the listed number."""
    return df.groupBy(by).agg(F.count_if(C("status") == "done").alias("ok"), F.count_if(C("status") == "skipped").alias("skipped"), F.count_if(C("status") == "failed").alias("failed"), F.sum(F.coalesce("n_inputs", "n_listed")).alias("inputs"), F.sum("wall_s").alias("wall_s"))


def failure_gate(df: DataFrame, by: list[str], failed: str, seconds: str, most: float = 0.05) -> DataFrame:
    """rows, failed, rate, rows a second, and error where nothing came or the rate is above `most`."""
    agg = df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(C(failed)).alias("n_failed"), F.sum(seconds).alias("wall_s"))
    rate = F.try_divide(C("n_failed").cast("double"), C("n").cast("double"))
    return agg.withColumns({"fail_rate": rate, "throughput": F.try_divide(C("n").cast("double"), C("wall_s").cast("double")), "gate": F.when((C("n") == 0) | (rate > most), "error").otherwise("ok")})


def gpu_activity(df: DataFrame, n_gpus: int = 0) -> DataFrame:
    """df: prefix, gpu, util, mem, power, pid. Activity of each GPU of each prefix; numbers up to n_gpus that are missing count as idle."""
    agg = df.groupBy("prefix", "gpu").agg(F.max("util").alias("max_util"), F.avg("util").alias("mean_util"), F.max("mem").alias("max_mem"), F.max("power").alias("max_power"), F.avg((C("util") > 0).cast("double")).alias("frac_busy"), F.countDistinct("pid").alias("n_pids"))
    if n_gpus:
        agg = df.select("prefix").distinct().select("prefix", F.explode(F.sequence(F.lit(0), F.lit(n_gpus - 1)).cast(f"array<{dict(df.dtypes)['gpu']}>")).alias("gpu")).join(agg, ["prefix", "gpu"], "left").fillna(0)
    return agg.withColumn("active", (C("max_util") > 0) | (C("max_mem") > 50) | (C("max_power") > 45))


def bottleneck_notes(df: DataFrame) -> DataFrame:
    """df: prefix, iowait_p95, active_gpus (array of numbers), gpu0_mean. notes: what slows a run."""
    notes = F.array(
        F.when(C("iowait_p95") >= 10, "high iowait"), F.when(F.size("active_gpus") == 0, "no active gpu"), F.when((C("active_gpus") == F.array(F.lit(0))) & (C("gpu0_mean") < 5), "only gpu 0 active, barely used")
    )
    return df.withColumn("notes", F.filter(notes, lambda x: x.isNotNull()))


def flatten_report(df: DataFrame, key: str, metric: str, value: str, metrics: list[str]) -> DataFrame:
    """One wide row a key with a column for each listed metric."""
    return df.groupBy(key).pivot(metric, metrics).agg(F.first(value))


def job_runtime_summary(df: DataFrame) -> DataFrame:
    """df: state, elapsed as [D-]HH:MM:SS. n by state; mean and lower median of seconds for COMPLETED."""
    p = r"^(?:(\d+)-)?(\d+):(\d+):(\d+)$"
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract("elapsed", p, k), F.lit("")).cast("long"), F.lit(0))
    s = F.when(C("elapsed").rlike(p), part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4))
    done = F.when(C("state") == "COMPLETED", C("s"))
    return df.withColumn("s", s).groupBy("state").agg(F.count("*").alias("n"), F.avg(done).alias("mean_s"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN state = 'COMPLETED' THEN s END)").cast("double").alias("median_s"))


def visible_rows(df: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The first rows by (running and failed oldest first, done, pending), and the others counted by status."""
    group = F.when(C("status").isin("running", "failed"), 0).when(C("status") == "done", 1).otherwise(2)
    first = df.withColumn("grp", group).orderBy("grp", "started_at", "shard_id").limit(most)
    rest = df.groupBy("status").agg(F.count("*").alias("n")).join(first.groupBy("status").agg(F.count("*").alias("shown")), "status", "left")
    return first.drop("grp"), rest.select("status", (C("n") - F.coalesce("shown", F.lit(0))).alias("hidden"))


def progress_funnel(df: DataFrame, stages: list[str]) -> DataFrame:
    """df: shard_id, stage (the one it is at, or 'done'), n_ok. Models past each stage."""
    at = F.coalesce(F.array_position(F.array(*map(F.lit, [*stages, "done"])), C("stage")), F.lit(0))
    past = [F.coalesce(F.sum(F.when(at > k + 1, C("n_ok"))), F.lit(0)).alias(s) for k, s in enumerate(stages)]
    return df.agg(*past, (100 * F.avg((C("stage") == "done").cast("double"))).alias("percent_done"))


def impute_time_range(sources: dict[str, DataFrame], by: str, ts: str, priority: tuple[str, ...] = ("gpu", "sys", "disk", "net", "proc")) -> DataFrame:
    """Start and end from the first source of the priority that has the key; overall: first start and last end of all."""
    order = [p for p in priority if p in sources]
    if not order:
        raise ValueError("no source of the priority list")
    rows = None
    for k, p in enumerate(order):
        one = sources[p].groupBy(by).agg(F.min(ts).alias("t0"), F.max(ts).alias("t1")).withColumn("k", F.lit(k)).withColumn("source", F.lit(p))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(by).agg(F.min_by("t0", "k").alias("start"), F.min_by("t1", "k").alias("end"), F.min_by("source", "k").alias("source"), F.min("t0").alias("first"), F.max("t1").alias("last"))
