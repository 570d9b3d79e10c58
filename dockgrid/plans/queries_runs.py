"""Registered queries: evaluation, telemetry, workflow, scalar functions, sources, models and streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from dockgrid.functions import scalars as sc
from dockgrid.operators import evaluate as ev, graph as gr, scoring, telemetry as tl, two_branch, workflow as wf
from dockgrid.plans import views as v
from dockgrid.plans.interface_graphs import build_graphs
from dockgrid.plans.queries import INTERNAL, NODES, query
from dockgrid.sources import structures, tables
from dockgrid.storage import new_path, settle_dealt
from dockgrid.streaming import streams

C = F.col


def _round(df: DataFrame, n: int, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in names})


# ---- evaluation

HIT = "CAST(y > 4 AS INT)"


@query(f"WITH {v.PREDS} SELECT grp, mol, pred, y FROM preds WHERE pred IS NOT NULL AND y IS NOT NULL AND isfinite(pred) AND isfinite(y) AND pred <> 0.0")
def b14_finite_pairs(spark, d):
    p = v.predictions(spark, d).withColumn("pred", F.when(C("pred") == 0, float("nan")).otherwise(C("pred")))
    return ev.finite_pairs(p)


CONF = "count(*) FILTER (pred > 4 AND y > 4) AS tp, count(*) FILTER (pred > 4 AND NOT y > 4) AS fp, count(*) FILTER (NOT pred > 4 AND NOT y > 4) AS tn, count(*) FILTER (NOT pred > 4 AND y > 4) AS fn"


@query(f"WITH {v.PREDS} SELECT grp, {CONF} FROM preds GROUP BY grp")
def d5_confusion(spark, d):
    return ev.confusion(v.predictions(spark, d), "dockq", 4, ["grp"])


@query(f"WITH {v.PREDS}, c AS (SELECT grp, CAST(floor(pred / 2) AS INT) AS p, CAST(floor(y / 2) AS INT) AS t FROM preds), k AS (SELECT unnest([1, 2, 3, 4, 5])::INT AS class) SELECT grp, class, count(*) FILTER (p = class AND t = class) AS tp, count(*) FILTER (p = class AND t <> class) AS fp, count(*) FILTER (p <> class AND t <> class) AS tn, count(*) FILTER (p <> class AND t = class) AS fn FROM c, k GROUP BY grp, class")
def d5_confusion_multiclass(spark, d):
    p = v.predictions(spark, d).select("grp", F.floor(C("pred") / 2).cast("int").alias("pred"), F.floor(C("y") / 2).cast("int").alias("y"))
    return ev.confusion_multiclass(p, [1, 2, 3, 4, 5], ["grp"])


RATES = {"sensitivity": ("tp", "tp + fn"), "specificity": ("tn", "tn + fp"), "precision": ("tp", "tp + fp"), "npv": ("tn", "tn + fn"), "fpr": ("fp", "fp + tn"), "fnr": ("fn", "tp + fn"), "fdr": ("fp", "tp + fp"), "accuracy": ("(tp + tn)", "tp + tn + fp + fn"), "f1": ("2 * tp", "2 * tp + fp + fn")}


@query(f"WITH {v.PREDS}, c AS (SELECT grp, {CONF} FROM preds GROUP BY grp) SELECT grp, {', '.join(f'round({a} / nullif({b}, 0)::DOUBLE, 6) AS {n}' for n, (a, b) in RATES.items())} FROM c")
def d6_classification_rates(spark, d):
    return _round(ev.classification_rates(ev.confusion(v.predictions(spark, d), "dockq", 4, ["grp"])), 6, *RATES).select("grp", *RATES)


REG = "count(*) AS n, round(avg(abs(y - pred)), 6) AS mae, round(avg((y - pred) * (y - pred)), 6) AS mse, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse, round(max(abs(y - pred)), 6) AS max_error, round(1 - var_pop(y - pred) / nullif(var_pop(y), 0), 6) AS explained_variance, round(1 - sum((y - pred) * (y - pred)) / nullif(count(*) * var_pop(y), 0), 6) AS r2"


@query(f"WITH {v.PREDS} SELECT grp, {REG} FROM preds GROUP BY grp")
def d7_regression_metrics(spark, d):
    return _round(ev.regression_metrics(v.predictions(spark, d), ["grp"]), 6, "mae", "mse", "rmse", "max_error", "explained_variance", "r2")


AUC = f"r AS (SELECT grp, {HIT} AS hit, rank() OVER (PARTITION BY grp ORDER BY pred) + (count(*) OVER (PARTITION BY grp, pred) - 1) / 2.0::DOUBLE AS rk FROM preds), auc AS (SELECT grp, (sum(rk) FILTER (hit = 1) - sum(hit) * (sum(hit) + 1) / 2.0::DOUBLE) / nullif(sum(hit) * (count(*) - sum(hit)), 0) AS auc FROM r GROUP BY grp)"


@query(f"WITH {v.PREDS}, {AUC} SELECT grp, round(auc, 6) AS auc FROM auc")
def d8_roc_auc(spark, d):
    return _round(ev.roc_auc(v.predictions(spark, d).withColumn("hit", (C("y") > 4).cast("int")), ["grp"], "pred", "hit"), 6, "auc")


@query("WITH n AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1) SELECT l_returnflag, n, round((1.0::DOUBLE / n) / (SELECT sum(1.0::DOUBLE / n) FROM n), 6) AS weight FROM n")
def d9_class_weights(spark, d):
    return _round(ev.class_weights(v.table(spark, d, "lineitem"), "l_returnflag"), 6, "weight")


@query(f"WITH {v.PREDS} SELECT grp, mol, {HIT} AS hit, row_number() OVER w AS rank, sum({HIT}) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS hits FROM preds WINDOW w AS (PARTITION BY grp ORDER BY pred DESC, mol)")
def e1_hitrate_curve(spark, d):
    return ev.hitrate_curve(v.predictions(spark, d), "grp", "dockq", "pred", "mol", C("y") > 4).withColumn("rank", C("rank").cast("long"))


@query(f"WITH {v.PREDS}, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pred DESC, mol) AS rk FROM preds) SELECT grp, round(avg({HIT}), 6) AS hitrate FROM r WHERE rk <= 20 GROUP BY grp")
def e2_hitrate_at_k(spark, d):
    return _round(ev.hitrate_at_k(v.predictions(spark, d), "grp", "dockq", "pred", "mol", C("y") > 4, 20), 6, "hitrate")


@query(f"WITH {v.PREDS}, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pred, mol) AS rk FROM preds) SELECT grp, max(CAST(y < 1 AS INT)) AS success FROM r WHERE rk <= 3 GROUP BY grp")
def e3_success_at_k(spark, d):
    return ev.success_at_k(v.predictions(spark, d), "grp", "irmsd", "pred", "mol", C("y") < 1, 3)


@query(f"WITH {v.PREDS}, r AS (SELECT grp, mol, pred, row_number() OVER (PARTITION BY grp ORDER BY pred DESC, mol) AS rank FROM preds) SELECT * FROM r WHERE rank <= 10")
def f1_rank_molecules(spark, d):
    return ev.rank_molecules(v.predictions(spark, d).drop("y"), "grp", "pred", "mol", 10).withColumn("rank", C("rank").cast("long"))


@query(f"WITH {v.PREDS}, b AS (SELECT grp * 1000 + mol // 16 AS batch, mol, pred, y FROM preds), l AS (SELECT a.batch, a.mol, -(a.pred - a.y) * (a.pred - a.y) / 2 AS own, ln(sum(exp(-(a.pred - b.y) * (a.pred - b.y) / 2))) AS lse FROM b a JOIN b USING (batch) GROUP BY a.batch, a.mol, a.pred, a.y) SELECT batch, round(avg(lse - own) * 2, 4) AS loss FROM l GROUP BY batch")
def c17_contrastive_loss(spark, d):
    p = v.predictions(spark, d).withColumn("batch", C("grp") * 1000 + F.floor(C("mol") / 16))
    return _round(ev.contrastive_loss(p, "batch", "mol", "pred", "y"), 4, "loss")


@query(f"WITH {v.SCORES} SELECT graph_id, fnat AS y FROM scores WHERE graph_id % 3 > 0 UNION ALL SELECT graph_id, NULL FROM scores WHERE graph_id % 3 = 0")
def c24_attach_target(spark, d):
    s = v.scores(spark, d)
    return ev.attach_target(s.select("graph_id"), s.filter("graph_id % 3 > 0"), "fnat")


@query(f"WITH {v.SCORES} SELECT graph_id FROM scores WHERE fnat > 0.3 AND irmsd < 4")
def b8_filter_by_score(spark, d):
    return ev.filter_by_score(v.scores(spark, d), {"fnat": ">0.3", "irmsd": "<4"}).select("graph_id")


@query("WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY (o_orderkey * 7919) % 10007, o_orderkey) AS r, count(*) OVER () AS n FROM orders) SELECT o_orderkey, r <= floor(0.8 * n) AS is_train FROM o")
def b15_train_valid_split(spark, d):
    return ev.train_valid_split(v.table(spark, d, "orders").select("o_orderkey"), 0.8, "o_orderkey", ((C("o_orderkey") * 7919) % 10007).cast("double"))


@query(f"WITH {v.PREDS}, c AS (SELECT grp, {CONF} FROM preds GROUP BY grp), g AS (SELECT grp, {REG} FROM preds GROUP BY grp), {AUC}, k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pred DESC, mol) AS rk FROM preds), h AS (SELECT grp, round(avg({HIT}), 6) AS hitrate, max({HIT}) AS success FROM k WHERE rk <= 10 GROUP BY grp) SELECT c.grp, tp, fp, tn, fn, round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 6) AS f1, rmse, r2, round(auc, 6) AS auc, hitrate, success FROM c JOIN g USING (grp) JOIN auc USING (grp) JOIN h USING (grp)")
def j9_evaluate(spark, d):
    out = ev.evaluate(v.predictions(spark, d), "dockq", 4, ["grp"], "mol", 10)
    return _round(out, 6, "f1", "rmse", "r2", "auc", "hitrate").select("grp", "tp", "fp", "tn", "fn", "f1", "rmse", "r2", "auc", "hitrate", "success")


EPOCHS = "log AS (SELECT user_id AS run, event_id AS epoch, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS mse FROM events)"


def _epochs(spark, d):
    return v.table(spark, d, "events").select(C("user_id").alias("run"), C("event_id").alias("epoch"), F.when(C("event_type") != "error", C("value")).alias("mse"))


@query(f"WITH {EPOCHS} SELECT run, epoch, mse, rank FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY mse, epoch) AS rank FROM log WHERE mse IS NOT NULL) WHERE rank <= 3")
def e11_top_k_epochs(spark, d):
    return ev.top_k_epochs(_epochs(spark, d), 3).withColumn("rank", C("rank").cast("long"))


@query("""WITH log AS (SELECT user_id AS run, event_id AS epoch, value AS mse FROM events), b AS (SELECT *, mse < coalesce(min(mse) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e300) AS better, row_number() OVER (PARTITION BY run ORDER BY epoch) AS r FROM log),
g AS (SELECT *, r - max(CASE WHEN better THEN r ELSE 0 END) OVER (PARTITION BY run ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS misses FROM b), s AS (SELECT run, min(epoch) FILTER (misses >= 5) AS stop_epoch FROM g GROUP BY run) SELECT s.run, s.stop_epoch, min(l.mse) AS best FROM s JOIN log l ON l.run = s.run AND (s.stop_epoch IS NULL OR l.epoch <= s.stop_epoch) GROUP BY ALL""")
def e12_early_stop(spark, d):
    return ev.early_stop_point(v.table(spark, d, "events").select(C("user_id").alias("run"), C("event_id").alias("epoch"), C("value").alias("mse")), 5)


# ---- telemetry

STATS = "count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, max(value) AS max, min(value) AS min, round(stddev_pop(value), 6) AS pstdev, round(avg(CAST(value > 0 AS INT)), 6) AS frac_gt0, round(avg(CAST(value >= 10 AS INT)), 6) AS frac_ge10, round(avg(CAST(value >= 50 AS INT)), 6) AS frac_ge50, round(avg(CAST(value >= 80 AS INT)), 6) AS frac_ge80"


@query(f"WITH {v.SAMPLES} SELECT prefix, metric, {STATS} FROM samples GROUP BY ALL")
def d3_series_stats(spark, d):
    return _round(tl.series_stats(v.samples(spark, d), ["prefix", "metric"]), 6, "mean", "median", "p95", "pstdev", "frac_gt0", "frac_ge10", "frac_ge50", "frac_ge80")


@query("SELECT l_suppkey AS shard, count(*) AS rows, round(avg(s), 6) AS mean, round(quantile_cont(s, 0.5), 6) AS median, round(min(s), 6) AS min, round(max(s), 6) AS max, round(quantile_cont(s, 0.1), 6) AS p10, round(quantile_cont(s, 0.25), 6) AS p25, round(quantile_cont(s, 0.75), 6) AS p75, round(quantile_cont(s, 0.9), 6) AS p90, count(*) FILTER (s >= 0.49) AS high, count(*) FILTER (s >= 0.23 AND s < 0.49) AS med, count(*) FILTER (s < 0.23) AS low FROM (SELECT l_suppkey, l_quantity / 50 AS s FROM lineitem) GROUP BY ALL")
def d4_prediction_stats(spark, d):
    p = v.table(spark, d, "lineitem").select(C("l_suppkey").alias("shard"), (C("l_quantity") / 50).alias("dockq"))
    return _round(tl.prediction_stats(p, ["shard"]), 6, "mean", "median", "min", "max", "p10", "p25", "p75", "p90")


@query("""WITH c AS (SELECT user_id, event_type, ts, sum(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS counter FROM events), u AS (SELECT user_id, event_type, ts, max(counter) AS counter FROM c GROUP BY ALL), g AS (SELECT *, greatest(0, counter - lag(counter) OVER (PARTITION BY user_id, event_type ORDER BY ts)) AS grown FROM u), p AS (SELECT user_id, ts, sum(CASE WHEN grown IS NULL THEN 0 ELSE grown END) AS grown FROM g GROUP BY ALL)
SELECT user_id, ts, round(coalesce(grown / greatest((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6, 1e-6) * 1000 / 1048576, 0), 6) AS rate FROM p""")
def e4_counter_rates(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    c = v.table(spark, d, "events").withColumn("counter", F.sum("value").over(w)).groupBy("user_id", "event_type", "ts").agg(F.max("counter").alias("counter"))
    return tl.counter_rates(c, "user_id", "event_type", "ts", "counter").withColumn("rate", F.round(C("rate") * 1000, 6))


@query("WITH g AS (SELECT user_id AS prefix, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 AS gap FROM events) SELECT prefix, round(CASE WHEN count(*) < 3 THEN 0 ELSE coalesce(quantile_cont(gap, 0.5) FILTER (gap > 0), 0) END, 3) AS sampling FROM g GROUP BY prefix")
def e5_median_sampling(spark, d):
    return _round(tl.median_sampling(v.samples(spark, d), "prefix", "ts"), 3, "sampling")


@query("WITH e AS (SELECT user_id AS prefix, event_id, CASE WHEN event_id % 4 = 0 OR user_id % 10 = 3 THEN NULL ELSE epoch_us(ts) / 1e6 END AS s FROM events), f AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY prefix ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS c, min(s) OVER (PARTITION BY prefix) AS m, row_number() OVER (PARTITION BY prefix ORDER BY event_id) - 1 AS r FROM e) SELECT event_id, round(CASE WHEN m IS NULL THEN r::DOUBLE ELSE coalesce(c, m) - m END, 3) AS rel FROM f")
def e6_relative_time(spark, d):
    s = v.samples(spark, d).withColumn("ts", F.when((C("event_id") % 4 != 0) & (C("prefix") % 10 != 3), C("ts")))
    return _round(tl.relative_time(s, "prefix", "ts", "event_id").select("event_id", "rel"), 3, "rel")


@query("WITH r AS (SELECT user_id AS prefix, epoch_us(ts) / 1e6 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events), n AS (SELECT prefix, count(*) AS n_done, count(*) FILTER (rn <= 20) AS k, max(s) AS t1, min(s) FILTER (rn <= 20) AS t0 FROM r GROUP BY prefix) SELECT prefix, n_done, round(CASE WHEN k >= 2 AND t1 > t0 AND n_done < 80 THEN 1e6 * (k - 1) / (t1 - t0) END, 3) AS rate_m, round(CASE WHEN k >= 2 AND t1 > t0 AND n_done < 80 THEN (80 - n_done) * (t1 - t0) / (k - 1) END, 1) AS eta, CASE WHEN k >= 2 AND t1 > t0 AND n_done < 80 THEN 'ok' ELSE 'insufficient' END AS status FROM n")
def e7_progress_eta(spark, d):
    return tl.progress_eta(v.samples(spark, d), "prefix", "ts", 80).select("prefix", "n_done", F.round(C("rate") * 1e6, 3).alias("rate_m"), F.round("eta", 1).alias("eta"), "status")


STAGES = "SELECT l_suppkey AS shard_id, sum(l_quantity) AS prep_s, sum(l_tax) * 100 AS annotate_s, sum(l_discount) * 1000 AS graphs_s, count(*)::DOUBLE AS cluster_s FROM lineitem GROUP BY l_suppkey"


def _stages(spark, d):
    return v.table(spark, d, "lineitem").groupBy(C("l_suppkey").alias("shard_id")).agg(F.sum("l_quantity").alias("prep_s"), (F.sum("l_tax") * 100).alias("annotate_s"), (F.sum("l_discount") * 1000).alias("graphs_s"), F.count("*").cast("double").alias("cluster_s"))


@query(f"WITH s AS ({STAGES}), t AS (SELECT sum(prep_s) AS a, sum(annotate_s) AS b, sum(graphs_s) AS c, sum(cluster_s) AS e FROM s) SELECT stage, round(seconds, 3) AS seconds, round(100 * seconds / (a + b + c + e), 4) AS percent FROM (SELECT 'prep_s' AS stage, a AS seconds, * FROM t UNION ALL SELECT 'annotate_s', b, * FROM t UNION ALL SELECT 'graphs_s', c, * FROM t UNION ALL SELECT 'cluster_s', e, * FROM t)")
def d10_stage_time_share(spark, d):
    out = tl.stage_time_share(_stages(spark, d))
    return out.select("stage", F.round("seconds", 3).alias("seconds"), F.round("percent", 4).alias("percent"))


SHARDS = "shards AS (SELECT o_orderkey AS shard_id, o_custkey % 97 AS run, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE 'running' END AS status, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey % 100 END AS n_inputs, o_custkey % 50 AS n_listed, o_totalprice / 1000 AS wall_s, ['prep', 'annotate', 'graphs', 'cluster', 'done'][o_orderkey % 5 + 1] AS stage, o_custkey % 40 AS n_ok, o_orderdate AS started_at FROM orders)"


def _shards(spark, d):
    return v.table(spark, d, "orders").select(
        C("o_orderkey").alias("shard_id"), (C("o_custkey") % 97).alias("run"), F.when(C("o_orderstatus") == "F", "done").when(C("o_orderstatus") == "O", "failed").otherwise("running").alias("status"), F.when(C("o_orderkey") % 5 > 0, C("o_custkey") % 100).alias("n_inputs"), (C("o_custkey") % 50).alias("n_listed"), (C("o_totalprice") / 1000).alias("wall_s"),
        F.element_at(F.array(*map(F.lit, ["prep", "annotate", "graphs", "cluster", "done"])), (C("o_orderkey") % 5 + 1).cast("int")).alias("stage"), (C("o_custkey") % 40).alias("n_ok"), C("o_orderdate").alias("started_at"),
    )


@query(f"WITH {SHARDS} SELECT run, count(*) FILTER (status = 'done') AS ok, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, sum(coalesce(n_inputs, n_listed))::BIGINT AS inputs, round(sum(wall_s), 3) AS wall_s FROM shards GROUP BY run")
def d11_run_rollup(spark, d):
    return _round(tl.run_rollup(_shards(spark, d), "run"), 3, "wall_s")


@query(f"WITH {SHARDS}, a AS (SELECT run, count(*) AS n, count(*) FILTER (status = 'failed') AS n_failed, sum(wall_s) AS w FROM shards GROUP BY run) SELECT run, n, n_failed, round(n_failed / n::DOUBLE, 6) AS fail_rate, round(n / w, 6) AS throughput, CASE WHEN n_failed / n::DOUBLE > 0.3 THEN 'error' ELSE 'ok' END AS gate FROM a")
def d12_failure_gate(spark, d):
    s = _shards(spark, d).withColumn("bad", C("status") == "failed")
    return _round(tl.failure_gate(s, ["run"], "bad", "wall_s", 0.3), 6, "fail_rate", "throughput").drop("wall_s")


GPU = "gpu AS (SELECT user_id AS prefix, event_id % 4 AS gpu, CASE WHEN event_id % 4 = 3 THEN 0 ELSE value END AS util, value % 60 AS mem, value % 50 AS power, event_type AS pid FROM events)"


def _gpu(spark, d):
    return v.table(spark, d, "events").select(C("user_id").alias("prefix"), (C("event_id") % 4).alias("gpu"), F.when(C("event_id") % 4 == 3, 0.0).otherwise(C("value")).alias("util"), (C("value") % 60).alias("mem"), (C("value") % 50).alias("power"), C("event_type").alias("pid"))


@query(f"WITH {GPU}, a AS (SELECT prefix, gpu, max(util) AS max_util, avg(util) AS mean_util, max(mem) AS max_mem, max(power) AS max_power, avg(CAST(util > 0 AS INT)) AS frac_busy, count(DISTINCT pid) AS n_pids FROM gpu GROUP BY ALL), k AS (SELECT DISTINCT prefix, g AS gpu FROM gpu, unnest(range(5)) AS t(g)) SELECT k.prefix, k.gpu, round(coalesce(max_util, 0), 9) AS max_util, round(coalesce(mean_util, 0), 9) AS mean_util, coalesce(n_pids, 0) AS n_pids, coalesce(max_util > 0 OR max_mem > 50 OR max_power > 45, FALSE) AS active FROM k LEFT JOIN a USING (prefix, gpu)")
def d24_gpu_activity(spark, d):
    return _round(tl.gpu_activity(_gpu(spark, d), 5), 9, "max_util", "mean_util").select("prefix", "gpu", "max_util", "mean_util", "n_pids", "active")


@query("SELECT user_id AS prefix, array_to_string([x FOR x IN [CASE WHEN quantile_cont(value, 0.95) >= 100 THEN 'high iowait' END, CASE WHEN count(*) FILTER (event_type = 'purchase') = 0 THEN 'no active gpu' END, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 AND count(DISTINCT user_id % 3) FILTER (event_type = 'purchase') = 1 AND min(user_id % 3) = 0 AND avg(value) < 50 THEN 'only gpu 0 active, barely used' END] IF x IS NOT NULL], '|') AS notes FROM events GROUP BY user_id")
def d25_bottleneck_notes(spark, d):
    e = v.table(spark, d, "events").groupBy(C("user_id").alias("prefix")).agg((F.percentile("value", 0.95) / 10).alias("iowait_p95"), F.collect_set(F.when(C("event_type") == "purchase", (C("user_id") % 3).cast("int"))).alias("active_gpus"), (F.avg("value") / 10).alias("gpu0_mean"))
    return tl.bottleneck_notes(e).select("prefix", F.array_join("notes", "|").alias("notes"))


TYPES = ["click", "view", "purchase", "signup", "error"]


@query("SELECT user_id AS prefix, " + ", ".join(f"round(sum(value) FILTER (event_type = '{t}'), 3) AS {t}" for t in TYPES) + " FROM events GROUP BY user_id")
def d26_flatten_report(spark, d):
    s = v.table(spark, d, "events").groupBy("user_id", "event_type").agg(F.round(F.sum("value"), 3).alias("value"))
    return tl.flatten_report(s, "user_id", "event_type", "value", TYPES).withColumnRenamed("user_id", "prefix")


@query("WITH j AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'RUNNING' END AS state, (o_orderkey % 3) * 86400 + (o_custkey % 24) * 3600 + (o_orderkey % 60) * 60 + o_custkey % 60 AS s FROM orders) SELECT state, count(*) AS n, round(avg(s) FILTER (state = 'COMPLETED'), 3) AS mean_s, (quantile_disc(s, 0.5) FILTER (state = 'COMPLETED'))::DOUBLE AS median_s FROM j GROUP BY state")
def d28_job_runtime_summary(spark, d):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    clock = F.concat_ws(":", two(C("o_custkey") % 24), two(C("o_orderkey") % 60), two(C("o_custkey") % 60))
    j = v.table(spark, d, "orders").select(F.when(C("o_orderstatus") == "F", "COMPLETED").when(C("o_orderstatus") == "O", "FAILED").otherwise("RUNNING").alias("state"), F.when(C("o_orderkey") % 3 > 0, F.concat((C("o_orderkey") % 3).cast("string"), F.lit("-"), clock)).otherwise(clock).alias("elapsed"))
    return _round(tl.job_runtime_summary(j), 3, "mean_s")


@query(f"WITH {SHARDS} SELECT {', '.join(f'coalesce(sum(n_ok) FILTER (list_position([{chr(39)}prep{chr(39)}, {chr(39)}annotate{chr(39)}, {chr(39)}graphs{chr(39)}, {chr(39)}cluster{chr(39)}, {chr(39)}done{chr(39)}], stage) > {k + 1}), 0)::BIGINT AS {s}' for k, s in enumerate(['prep', 'annotate', 'graphs', 'cluster']))}, round(100 * avg(CAST(stage = 'done' AS INT)), 4) AS percent_done FROM shards")
def e14_progress_funnel(spark, d):
    return _round(tl.progress_funnel(_shards(spark, d), ["prep", "annotate", "graphs", "cluster"]), 4, "percent_done")


@query(f"WITH {SHARDS} SELECT shard_id, status FROM shards ORDER BY CASE WHEN status IN ('running', 'failed') THEN 0 WHEN status = 'done' THEN 1 ELSE 2 END, started_at, shard_id LIMIT 25")
def e13_visible_rows(spark, d):
    return tl.visible_rows(_shards(spark, d), 25)[0].select("shard_id", "status")


@query(f"WITH {SHARDS}, f AS (SELECT shard_id, status FROM shards ORDER BY CASE WHEN status IN ('running', 'failed') THEN 0 WHEN status = 'done' THEN 1 ELSE 2 END, started_at, shard_id LIMIT 25) SELECT status, count(*) - (SELECT count(*) FROM f WHERE f.status = s.status) AS hidden FROM shards s GROUP BY status")
def e13_hidden_counts(spark, d):
    return tl.visible_rows(_shards(spark, d), 25)[1]


@query("WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'stage_' || (o_custkey + 10000) || '_' || (o_orderkey % 40) || '_site-n' || (o_orderkey % 7) ELSE 'stage_' || o_custkey END AS name FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'idx=' || (o_orderkey % 40) || '  node=n' || (o_orderkey % 7) ELSE name END AS label FROM p")
def h16_job_label(spark, d):
    o = v.table(spark, d, "orders")
    key, text = C("o_orderkey"), lambda c: c.cast("string")
    named = F.concat(F.lit("stage_"), text(C("o_custkey") + 10000), F.lit("_"), text(key % 40), F.lit("_site-n"), text(key % 7))
    return o.select(key, F.when(key % 3 > 0, named).otherwise(F.concat(F.lit("stage_"), text(C("o_custkey")))).alias("name")).select("o_orderkey", sc.job_label("name", "site-").alias("label"))


@query("WITH s AS (SELECT user_id AS prefix, ts, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 END AS k FROM events WHERE event_type IN ('purchase', 'signup', 'click')), f AS (SELECT prefix, min(k) AS k, min(ts) AS first, max(ts) AS last FROM s GROUP BY prefix) SELECT f.prefix, min(s.ts) AS start, max(s.ts) AS \"end\", ['gpu', 'sys', 'disk'][f.k + 1] AS source, f.first, f.last FROM f JOIN s ON s.prefix = f.prefix AND s.k = f.k GROUP BY f.prefix, f.k, f.first, f.last")
def c23_impute_time_range(spark, d):
    e = v.samples(spark, d)
    return tl.impute_time_range({n: e.filter(C("metric") == t) for n, t in (("gpu", "purchase"), ("sys", "signup"), ("disk", "click"))}, "prefix", "ts")


# ---- workflow


@query("WITH c AS (SELECT o_orderkey, trim([' A ', 'None', '-', 'NA', '', 'b'][o_orderkey % 6 + 1]) AS c FROM orders) SELECT o_orderkey, CASE WHEN lower(c) IN ('', 'none', 'null', '-', 'na') THEN NULL ELSE c END AS chain FROM c")
def b2_norm_chain(spark, d):
    return v.table(spark, d, "orders").select("o_orderkey", sc.norm_chain(F.element_at(F.array(*map(F.lit, [" A ", "None", "-", "NA", "", "b"])), (C("o_orderkey") % 6 + 1).cast("int"))).alias("chain"))


@query("WITH c AS (SELECT o_custkey AS graph_id, list(DISTINCT ['H', 'L', 'T'][o_orderkey % 3 + 1]) AS h FROM orders GROUP BY 1) SELECT graph_id, CASE WHEN list_has_all(h, ['H', 'T', 'L']) THEN 'ok' ELSE 'fail' END AS status, array_to_string([x FOR x IN ['H', 'T', 'L'] IF NOT list_contains(h, x)], ',') AS missing FROM c")
def b3_validate_chains(spark, d):
    c = v.table(spark, d, "orders").select(C("o_custkey").alias("graph_id"), F.element_at(F.array(*map(F.lit, "HLT")), (C("o_orderkey") % 3 + 1).cast("int")).alias("chain"))
    return wf.validate_chains(c, "H", "T", "L").select("graph_id", "status", F.array_join("missing", ",").alias("missing"))


MERGED = f"{v.ATOMS}, src AS (SELECT *, ['H', 'L', 'T', 'X'][res_seq % 4 + 1] AS c0 FROM atoms), r AS (SELECT graph_id, c0, res_seq, res_name, min(serial) AS s0 FROM src WHERE c0 <> 'X' GROUP BY ALL), m AS (SELECT *, CASE WHEN c0 = 'T' THEN 'B' ELSE 'A' END AS out, dense_rank() OVER (PARTITION BY graph_id, CASE WHEN c0 = 'T' THEN 'B' ELSE 'A' END ORDER BY CASE c0 WHEN 'L' THEN 1 ELSE 0 END, s0) AS new_seq FROM r)"


def _sources(spark, d):
    return v.atoms(spark, d).withColumn("chain", F.element_at(F.array(*map(F.lit, "HLTX")), (C("res_seq") % 4 + 1).cast("int"))).withColumn("icode", F.lit(None).cast("string")).withColumn("het", F.lit(False))


ROLES = {"H": ("A", 0), "L": ("A", 1), "T": ("B", 0)}


@query(f"WITH {MERGED} SELECT s.graph_id, m.out AS chain, m.new_seq AS res_seq, s.res_name, s.serial FROM src s JOIN m USING (graph_id, c0, res_seq, res_name)")
def b4_merge_and_renumber(spark, d):
    return wf.merge_and_renumber(_sources(spark, d), ROLES).select("graph_id", "chain", C("res_seq").cast("long").alias("res_seq"), "res_name", "serial")


@query(f"WITH {MERGED} SELECT graph_id, out AS chain, string_agg(CASE res_name {' '.join(f'WHEN {k!r} THEN {x!r}' for k, x in __import__('dockgrid.functions.fixed', fromlist=['x']).ONE_LETTER.items())} ELSE 'X' END, '' ORDER BY new_seq) AS sequence FROM m GROUP BY ALL")
def b5_chain_sequences(spark, d):
    r = wf.merge_and_renumber(_sources(spark, d), ROLES).select("graph_id", "chain", "res_seq", "res_name").distinct()
    return wf.chain_sequences(r, ["graph_id", "chain"])


@query("SELECT o_orderkey, 'm' || o_custkey AS mol FROM orders")
def b6_clean_mol_id(spark, d):
    return v.table(spark, d, "orders").select("o_orderkey", sc.clean_mol_id(F.concat(F.lit("m"), C("o_custkey").cast("string"), F.when(C("o_orderkey") % 2 == 0, F.concat(F.lit("_model_"), C("o_orderkey").cast("string"))).otherwise(""))).alias("mol"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i IN (0, 2, 5)")
def b9_select_index(spark, d):
    return wf.select_index(v.table(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", [0, 2, 5])


@query("SELECT p_partkey, p_size, p_retailprice, array_to_string(list_resize([p_size, p_partkey % 7]::DOUBLE[], 4, 0.0), ',') AS padded FROM part")
def b10_select_features(spark, d):
    p = gr.select_features(v.table(spark, d, "part"), "all", ("p_partkey",)).withColumn("v", F.array(C("p_size").cast("double"), (C("p_partkey") % 7).cast("double")))
    return p.select("p_partkey", "p_size", "p_retailprice", F.array_join(F.transform(gr.fit_width("v", 4), lambda x: x.cast("string")), ",").alias("padded"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def b11_dedup_by_label(spark, d):
    return wf.dedup_by_label(v.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("SELECT shard, count(*) AS n_total, count(*) FILTER (r = 1) AS n_unique FROM (SELECT event_type AS shard, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS r FROM events) GROUP BY shard")
def b11_dedup_report(spark, d):
    return wf.dedup_report(v.table(spark, d, "events").select("user_id", C("event_type").alias("shard"), "event_id"), "user_id", "shard", "event_id")


@query("WITH l AS (SELECT doc_id, doc_id || '.' || source || '.' || ['A', 'B', 'C'][doc_id % 3 + 1] AS label FROM documents) SELECT doc_id, doc_id % 3 < 2 AS ok, CASE WHEN doc_id % 3 < 2 THEN left(label, length(label) - 2) END AS mol, CASE WHEN doc_id % 3 < 2 THEN right(label, 1) END AS chain FROM l")
def b12_validate_labels(spark, d):
    l = v.table(spark, d, "documents").select("doc_id", F.concat_ws(".", C("doc_id").cast("string"), "source", F.element_at(F.array(*map(F.lit, "ABC")), (C("doc_id") % 3 + 1).cast("int"))).alias("label"))
    return wf.validate_labels(l).drop("label")


@query("WITH x AS (SELECT d.doc_id::VARCHAR AS label, 63 + d.doc_id % 2 AS length, e.vec_id FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id) SELECT count(*) AS n_expected, count(*) FILTER (vec_id IS NULL) AS n_missing, count(*) FILTER (vec_id IS NOT NULL AND length <> 64) AS n_wrong, coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM (SELECT label FROM x WHERE vec_id IS NULL ORDER BY label LIMIT 3)), '') AS missing, coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM (SELECT label FROM x WHERE vec_id IS NOT NULL AND length <> 64 ORDER BY label LIMIT 3)), '') AS wrong FROM x")
def b13_validate_embeddings(spark, d):
    want = v.table(spark, d, "documents").select(C("doc_id").cast("string").alias("label"), (63 + C("doc_id") % 2).alias("length"))
    got = v.table(spark, d, "embeddings").select(C("vec_id").cast("string").alias("label"), C("embedding").alias("values"))
    return wf.validate_embeddings(want, got).select("n_expected", "n_missing", "n_wrong", F.array_join("missing_samples", ",").alias("missing"), F.array_join("length_samples", ",").alias("wrong"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def b16_drop_missing_graphs(spark, d):
    return wf.drop_missing_graphs(v.table(spark, d, "orders"), v.table(spark, d, "customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select("o_orderkey")


@query("WITH e AS (SELECT c_custkey, array_to_string([x FOR x IN [CASE WHEN NOT c_acctbal >= 0 THEN 'negative balance' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment closed' END] IF x IS NOT NULL], '; ') AS s FROM customer) SELECT c_custkey, CASE WHEN s = '' THEN 'ok' ELSE 'fail' END AS status, nullif(s, '') AS error FROM e")
def b17_failure_capture(spark, d):
    c = v.table(spark, d, "customer")
    return wf.failure_capture(c, {"negative balance": C("c_acctbal") >= 0, "segment closed": C("c_mktsegment") != "BUILDING"}).select("c_custkey", "status", "error")


@query("WITH a AS (SELECT o_orderkey AS k, o_totalprice AS x FROM orders WHERE o_orderkey % 7 > 0), b AS (SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS x FROM orders WHERE o_orderkey % 5 > 0) SELECT k, CASE WHEN b.x IS NULL THEN 'left_only' WHEN a.x IS NULL THEN 'right_only' WHEN abs(a.x - b.x) > 1e-6 THEN 'differs' ELSE 'same' END AS state FROM a FULL JOIN b USING (k)")
def c15_compare_tables(spark, d):
    o = v.table(spark, d, "orders").select(C("o_orderkey").alias("k"), C("o_totalprice").alias("x"))
    return wf.compare_tables(o.filter("k % 7 > 0"), o.filter("k % 5 > 0").withColumn("x", C("x") + F.when(C("k") % 11 == 0, 1).otherwise(0)), ["k"], "x").select("k", "state")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0")
def c16_pending(spark, d):
    o = v.table(spark, d, "orders").select("o_orderkey")
    return wf.pending(o, o.filter("o_orderkey % 3 = 0"), o.filter("o_orderkey % 2 = 0"), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'done' WHEN o_orderkey % 5 = 0 THEN 'failed' WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'blocked' END AS status FROM orders")
def c16_status(spark, d):
    o = v.table(spark, d, "orders").select("o_orderkey")
    return wf.status_of(o, *[o.filter(f"o_orderkey % {k} = 0") for k in (3, 5, 2)], "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def a14_process_new(spark, d):
    return wf.process_new(v.table(spark, d, "orders"), v.table(spark, d, "customer").filter("c_nationkey < 12").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select("o_orderkey")


@query("WITH t AS (SELECT doc_id AS mol, left(text, 100000) AS s FROM documents), q AS (SELECT doc_id AS mol, substr(text, 1 + doc_id % 50, 60) AS s FROM documents), tg AS (SELECT mol, i AS p, substr(s, i, 12) AS g FROM t, unnest(range(1, length(s) - 10)) AS u(i)), qg AS (SELECT mol, i AS p, substr(s, i, 12) AS g FROM q, unnest(range(1, length(s) - 10)) AS u(i)), votes AS (SELECT q.mol, t.p - q.p + 1 AS start, count(*) AS votes FROM qg q JOIN tg t USING (mol, g) GROUP BY ALL), b AS (SELECT mol, start, votes, strpos(reverse(left(t.s, start)), left(q.s, 1)) AS back FROM (SELECT *, row_number() OVER (PARTITION BY mol ORDER BY votes DESC, start) AS r FROM votes) JOIN t USING (mol) JOIN q USING (mol) WHERE r = 1) SELECT mol, CASE WHEN start < 1 THEN start WHEN back > 0 THEN start - back + 1 ELSE 1 END AS start, votes FROM b".replace("left(text, 100000)", "text"))
def c22_locate_subsequence(spark, d):
    t = v.table(spark, d, "documents").select(C("doc_id").alias("mol"), C("text").alias("sequence"))
    q = t.select("mol", F.substring("sequence", (1 + C("mol") % 50).cast("int"), F.lit(60)).alias("sequence"))
    return wf.locate_subsequence(q, t, 12).select("mol", C("start").cast("long").alias("start"), "votes")


@query(None)
def c22_locate_by_chain(spark, d):
    """Queries with a piece of 25 letters left out in the middle; longest chains have no SQL form (tests compare with brute force)."""
    t = v.table(spark, d, "documents").select(C("doc_id").alias("mol"), C("text").alias("sequence"))
    q = t.select("mol", F.concat(F.substring("sequence", (1 + C("mol") % 50).cast("int"), F.lit(60)), F.substring("sequence", (86 + C("mol") % 50).cast("int"), F.lit(60))).alias("sequence"))
    return wf.locate_by_chain(q, t, 12)


@query("SELECT doc_id, floor((sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n_chars) / 50000.0)::BIGINT AS bin FROM documents")
def e9_bin_by_running_size(spark, d):
    return wf.bin_by_running_size(v.table(spark, d, "documents"), "source", ["doc_id"], "n_chars", 50000).select("doc_id", "bin")


@query(f"""WITH RECURSIVE {v.ATOMS}, items AS MATERIALIZED (SELECT graph_id, serial, (x * 10)::BIGINT AS size FROM atoms),
walk(graph_id, serial, bin, n, total) AS (SELECT graph_id, serial, 0::BIGINT, 1, size FROM items WHERE serial = 1
 UNION ALL SELECT i.graph_id, i.serial, CASE WHEN close THEN bin + 1 ELSE bin END, CASE WHEN close THEN 1 ELSE n + 1 END, CASE WHEN close THEN i.size ELSE total + i.size END
 FROM (SELECT i.*, w.bin, w.n, w.total, (w.n >= 12 OR w.total + i.size > 2000) AND w.n >= 2 AS close FROM walk w JOIN items i ON i.graph_id = w.graph_id AND i.serial = w.serial + 1) i)
SELECT graph_id, serial, bin FROM walk""")
def e9_greedy_bins(spark, d):
    a = v.atoms(spark, d).select("graph_id", "serial", F.floor(C("x") * 10).alias("size"))
    return wf.bin_greedily(a, "graph_id", ["serial"], "size", 2000, 12, 2).select("graph_id", "serial", "bin")


@query("WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) - 1 AS r FROM documents) SELECT doc_id, (CASE WHEN (r // 4) % 2 = 0 THEN r % 4 ELSE 3 - r % 4 END)::INT AS bin FROM r")
def e10_balance_snake(spark, d):
    return wf.balance_snake(v.table(spark, d, "documents"), "source", [C("n_chars").desc(), C("doc_id")], 4).select("doc_id", "bin")


@query("WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) SELECT doc_id, CAST((r * 4 + n - 1) // n - 1 AS INT) AS task FROM r")
def e15_even_ranges(spark, d):
    return wf.even_ranges(v.table(spark, d, "documents"), "source", ["doc_id"], 4).select("doc_id", "task")


@query("WITH a AS (SELECT count(*) AS n, sum(n_chars)::BIGINT AS b FROM documents) SELECT n AS n_files, b AS n_bytes, round(b / n::DOUBLE, 4) AS mean_bytes, greatest(ceil(b / 100000.0), ceil(n / 50.0), 1)::BIGINT AS n_bins, least(32, greatest(8, floor(n / greatest(ceil(b / 100000.0), ceil(n / 50.0), 1) / 5)))::INT AS parallelism FROM a")
def d29_profile_inputs(spark, d):
    return _round(wf.profile_inputs(v.table(spark, d, "documents"), "n_chars", 100000, 50), 4, "mean_bytes")


@query("SELECT doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS place FROM documents")
def f2_order_by_size(spark, d):
    return wf.order_by_size(v.table(spark, d, "documents"), "lang", "n_chars", "doc_id").select("doc_id", "n_chars", "place")


@query("SELECT CASE WHEN o_orderkey % 4 > 0 THEN 'stage_' || (100000 + o_custkey) || '_' || o_orderkey % 40 || '_n' || o_orderkey ELSE 'plain' || o_orderkey END AS prefix, CASE WHEN o_orderkey % 4 > 0 THEN 100000 + o_custkey ELSE 0 END AS job, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 40 ELSE 1000000000 END AS job_index FROM orders")
def f4_order_by_job(spark, d):
    name = F.when(C("o_orderkey") % 4 > 0, F.concat(F.lit("stage_"), (100000 + C("o_custkey")).cast("string"), F.lit("_"), (C("o_orderkey") % 40).cast("string"), F.lit("_n"), C("o_orderkey").cast("string"))).otherwise(F.concat(F.lit("plain"), C("o_orderkey").cast("string")))
    return wf.order_by_job(v.table(spark, d, "orders").select(name.alias("prefix")))


@query("SELECT l_suppkey AS mol, l_orderkey AS k, l_quantity AS x FROM lineitem UNION ALL SELECT o_custkey, o_orderkey, NULL FROM orders")
def g3_union_families(spark, d):
    a = v.table(spark, d, "lineitem").select(C("l_suppkey").alias("mol"), C("l_orderkey").alias("k"), C("l_quantity").alias("x"))
    return a.unionByName(v.table(spark, d, "orders").select(C("o_custkey").alias("mol"), C("o_orderkey").alias("k")), allowMissingColumns=True)


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def g4_set_difference(spark, d):
    return v.table(spark, d, "customer").select("c_custkey").exceptAll(v.table(spark, d, "orders").select(C("o_custkey").alias("c_custkey")).distinct())


# ---- scalar functions


@query("SELECT p_partkey, array_to_string([CASE WHEN i = p_size % 9 THEN 1 ELSE 0 END FOR i IN range(9)], '') AS hot FROM part")
def h1_one_hot(spark, d):
    return v.table(spark, d, "part").select("p_partkey", F.array_join(F.transform(sc.one_hot(C("p_size") % 9, 9), lambda x: x.cast("int").cast("string")), "").alias("hot"))


_FIX = __import__("dockgrid.functions.fixed", fromlist=["x"])


@query(f"WITH {v.ATOMS} SELECT graph_id, serial, list_position({v._list(_FIX.RESIDUES)}, res_name) - 1 AS res, CASE res_name {' '.join(f'WHEN {k!r} THEN {x}::DOUBLE' for k, x in _FIX.HYDROPATHY.items())} END AS hydro, list_position({v._list(_FIX.ATOMS)}, atom_name) - 1 AS atom, CASE WHEN res_name IN ({', '.join(map(repr, _FIX.APOLAR))}) THEN 0 WHEN res_name IN ({', '.join(map(repr, _FIX.POLAR))}) THEN 1 WHEN res_name IN ('GLU', 'ASP') THEN 2 ELSE 3 END AS polarity FROM atoms")
def h2_encoders(spark, d):
    return v.atoms(spark, d).select("graph_id", "serial", sc.residue_index("res_name").alias("res"), sc.hydropathy("res_name").alias("hydro"), sc.atom_index("atom_name").alias("atom"), sc.polarity_index("res_name").alias("polarity"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(tanh(-l_quantity / 2 + 2) + 1, 8) AS t, CAST(l_quantity < 2.1 AS DOUBLE) AS covalent FROM lineitem")
def h6_dist_transform(spark, d):
    return v.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(sc.dist_transform("l_quantity"), 8).alias("t"), sc.covalent_flag("l_quantity").alias("covalent"))


@query("WITH e AS (SELECT vec_id, (embedding[1:3])::DOUBLE[] AS u FROM embeddings) SELECT vec_id, round(u[1] / (sqrt(u[1] * u[1] + u[2] * u[2] + u[3] * u[3]) + 1e-6), 6) AS x, round(u[3] / (sqrt(u[1] * u[1] + u[2] * u[2] + u[3] * u[3]) + 1e-6), 6) AS z FROM e")
def h7_unit_vector(spark, d):
    e = v.table(spark, d, "embeddings").select("vec_id", sc.unit_vector(F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))).alias("u"))
    return e.select("vec_id", F.round(C("u")[0], 6).alias("x"), F.round(C("u")[2], 6).alias("z"))


@query("SELECT p_partkey, round(exp(-pow((p_size - 0) / (30 / 18.0::DOUBLE + 1e-8), 2)), 8) AS first, round(exp(-pow((p_size - 30) / (30 / 18.0::DOUBLE + 1e-8), 2)), 8) AS last FROM part")
def h8_gaussian_rbf(spark, d):
    p = v.table(spark, d, "part").select("p_partkey", sc.gaussian_rbf(C("p_size").cast("double")).alias("r"))
    return p.select("p_partkey", F.round(C("r")[0], 8).alias("first"), F.round(C("r")[17], 8).alias("last"))


@query(f"WITH {v.SCORES}, q AS (SELECT *, (fnat + 1 / (1 + pow(irmsd / 1.5, 2)) + 1 / (1 + pow(lrmsd / 8.5, 2))) / 3 AS dockq FROM scores) SELECT graph_id, round(dockq, 6) AS dockq, irmsd < 4 AS bin_class, CASE WHEN irmsd < 1 THEN 1 WHEN irmsd < 2 THEN 2 WHEN irmsd < 4 THEN 3 WHEN irmsd < 6 THEN 4 ELSE 5 END AS capri_class, CASE WHEN dockq >= 0.49 THEN 'high' WHEN dockq >= 0.23 THEN 'med' ELSE 'low' END AS bin, CAST(dockq > 0.3 AS INT) AS good FROM q")
def h9_docking_scores(spark, d):
    s = v.scores(spark, d).withColumn("dockq", sc.dockq("fnat", "lrmsd", "irmsd"))
    return s.select("graph_id", F.round("dockq", 6).alias("dockq"), sc.bin_class("irmsd").alias("bin_class"), sc.capri_class("irmsd").alias("capri_class"), sc.quality_bin("dockq").alias("bin"), sc.binarize("dockq", 0.3, "dockQ").alias("good"))


@query("SELECT p_partkey, round(p_retailprice / nullif(p_size % 3, 0), 6) AS q FROM part")
def h13_safe_div(spark, d):
    return v.table(spark, d, "part").select("p_partkey", F.round(sc.safe_div("p_retailprice", C("p_size") % 3), 6).alias("q"))


@query("SELECT p_partkey, CASE WHEN n BETWEEN 27 AND 38 THEN 'H1' WHEN n BETWEEN 56 AND 65 THEN 'H2' WHEN n BETWEEN 105 AND 117 THEN 'H3' ELSE 'CONST' END AS region FROM (SELECT p_partkey, p_partkey % 128 AS n FROM part)")
def h15_imgt_region(spark, d):
    return v.table(spark, d, "part").select("p_partkey", sc.imgt_region(C("p_partkey") % 128, "H").alias("region"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN (100000 + o_custkey)::VARCHAR END AS job, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 40)::VARCHAR END AS idx, CASE WHEN o_orderkey % 3 > 0 THEN 'node' || o_orderkey % 9 END AS node FROM orders")
def h16_parse_job(spark, d):
    name = F.when(C("o_orderkey") % 3 > 0, F.concat(F.lit("stage_b_"), (100000 + C("o_custkey")).cast("string"), F.lit("_"), (C("o_orderkey") % 40).cast("string"), F.lit("_node"), (C("o_orderkey") % 9).cast("string"))).otherwise("plain_name")
    p = sc.parse_job(name)
    return v.table(spark, d, "orders").select("o_orderkey", p["job"].cast("string").alias("job"), p["index"].cast("string").alias("idx"), p["node"].alias("node"))


@query("WITH s AS (SELECT o_orderkey, (o_custkey * 37) % 20000 AS s FROM orders) SELECT o_orderkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad(((s % 3600) // 60)::VARCHAR, 2, '0') || 'm' ELSE (s // 60) || 'm' || lpad((s % 60)::VARCHAR, 2, '0') || 's' END AS elapsed, CASE WHEN length('worker' || o_orderkey || 'rackrack') > 16 THEN left('worker' || o_orderkey || 'rackrack', 15) || '~' ELSE 'worker' || o_orderkey || 'rackrack' END AS host FROM s")
def h17_elapsed_and_host(spark, d):
    return v.table(spark, d, "orders").select("o_orderkey", sc.elapsed_str((C("o_custkey") * 37) % 20000).alias("elapsed"), sc.short_host(F.concat(F.lit("worker"), C("o_orderkey").cast("string"), F.lit("rackrack.site.org"))).alias("host"))


@query("WITH e AS (SELECT vec_id, (embedding[1:4])::DOUBLE[] AS u FROM embeddings) SELECT vec_id, round(1 / (1 + exp(-u[1])), 6) AS sig, round(exp(u[2]) / (exp(u[1]) + exp(u[2]) + exp(u[3]) + exp(u[4])), 6) AS soft, list_position(u, list_max(u)) - 1 AS arg FROM e")
def h18_outputs(spark, d):
    e = v.table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double")).alias("u"))
    return e.select("vec_id", F.round(sc.sigmoid(C("u")[0]), 6).alias("sig"), F.round(sc.softmax("u")[1], 6).alias("soft"), sc.argmax("u").alias("arg"))


@query("WITH e AS (SELECT vec_id, (embedding[1:3])::DOUBLE[] AS a, (embedding[4:6])::DOUBLE[] AS b FROM embeddings) SELECT vec_id, round(a[1] * b[1] + a[2] * b[2] + a[3] * b[3], 8) AS dot, round(a[2] * b[3] - a[3] * b[2], 8) AS cx, round(a[1] * b[2] - a[2] * b[1], 8) AS cz FROM e")
def h19_vectors(spark, d):
    e = v.table(spark, d, "embeddings").select("vec_id", *[F.transform(F.slice("embedding", k, 3), lambda x: x.cast("double")).alias(n) for k, n in ((1, "a"), (4, "b"))])
    return e.select("vec_id", F.round(sc.dot(C("a"), C("b")), 8).alias("dot"), F.round(sc.cross(C("a"), C("b"))[0], 8).alias("cx"), F.round(sc.cross(C("a"), C("b"))[2], 8).alias("cz"))


# ---- sources and sinks


@query("SELECT doc_id || '.A' AS label, doc_id::VARCHAR AS mol, 'A' AS chain, 64::INT AS length, sha256(text) AS sequence FROM documents")
def a5_manifest(spark, d):
    at = new_path(spark, "manifest")
    s = v.table(spark, d, "documents").select(F.concat(C("doc_id").cast("string"), F.lit(".A")).alias("label"), C("doc_id").cast("string").alias("mol"), F.lit("A").alias("chain"), F.sha2("text", 256).alias("sequence"))
    structures.write_manifest(s, at)
    return structures.read_manifest(spark, at)


@query("SELECT l_orderkey::VARCHAR AS mol, CAST(l_tax AS FLOAT)::DOUBLE AS dockq FROM lineitem")
def a6_merge_predictions(spark, d):
    li = v.table(spark, d, "lineitem").select(C("l_orderkey").alias("mol"), C("l_tax").alias("dockq"), "l_linenumber")
    return tables.merge_predictions([li.filter(C("l_linenumber") == k) for k in range(1, 8)]).withColumn("dockq", C("dockq").cast("double"))


@query("SELECT 'm' || l_orderkey AS pdb_id, l_tax AS predicted_dockq FROM lineitem")
def a7_export_predictions(spark, d):
    at = new_path(spark, "export")
    p = v.table(spark, d, "lineitem").select(F.concat(F.lit("m"), C("l_orderkey").cast("string"), F.lit("_model_"), C("l_linenumber").cast("string")).alias("mol"), C("l_tax").alias("dockq"))
    tables.export_predictions(p, at)
    return spark.read.csv(at, sep="\t", header=True, schema="pdb_id string, predicted_dockq double")


@query(f"WITH {v.ATOMS}, {v.CONTACTS}, n AS (SELECT graph_id, count(*) AS n, round(sum(x), 3) AS sx FROM atoms GROUP BY graph_id), e AS (SELECT graph_id, count(*) AS n_edges, round(sum(d2), 3) AS sd2, sum(r_serial - l_serial)::BIGINT AS spread FROM contacts GROUP BY graph_id), c AS (SELECT graph_id, count(DISTINCT res_seq % 8) AS n_clusters FROM atoms GROUP BY graph_id) SELECT n.*, coalesce(n_edges, 0) AS n_edges, sd2, spread, n_clusters, n.graph_id % 10 / 10.0::DOUBLE AS irmsd FROM n LEFT JOIN e USING (graph_id) JOIN c USING (graph_id)")
def a8_graph_store(spark, d):
    from dockgrid.operators.spatial import contact_pairs

    at = new_path(spark, "graphs")
    a = v.atoms(spark, d)
    edges = contact_pairs(a).select("graph_id", C("l_serial").alias("src"), C("r_serial").alias("dst"), F.lit("interface").alias("edge_type"), "d2")
    scores = a.select("graph_id", (C("graph_id") % 10 / 10.0).alias("irmsd")).distinct()
    tables.write_graphs(at, a, edges, scores, a.select("graph_id", C("serial").alias("node"), (C("res_seq") % 8).alias("cluster")), buckets=8)
    g = tables.read_graphs(spark, at)
    e = g["edges"].filter("edge_type = 'interface'").groupBy("graph_id").agg(F.count("*").alias("n_edges"), F.round(F.sum("d2"), 3).alias("sd2"), F.sum(C("dst") - C("src")).alias("spread"))
    n = g["nodes"].groupBy("graph_id").agg(F.count("*").alias("n"), F.round(F.sum("x"), 3).alias("sx")).join(e, "graph_id", "left").fillna(0, ["n_edges"])
    return n.join(g["clusters"].groupBy("graph_id").agg(F.countDistinct("cluster").alias("n_clusters")), "graph_id").join(g["scores"], "graph_id")


@query(f"WITH {v.ATOMS} SELECT graph_id, res_seq, x, y, z FROM atoms WHERE chain = 'A' AND atom_name IN ('N', 'CA', 'C')")
def a16_load_backbone(spark, d):
    return tables.load_atoms(v.atoms(spark, d), ("graph_id", "res_seq", "x", "y", "z"), "A", ("N", "CA", "C"))


@query("SELECT user_id::INT AS epoch, event_type AS phase, event_id::VARCHAR AS name, value::VARCHAR AS value FROM events WHERE event_type = 'view'")
def a17_epoch_results(spark, d):
    at = new_path(spark, "epochs")
    e = v.table(spark, d, "events").filter("event_type IN ('view', 'click')").select(C("user_id").cast("int").alias("epoch"), C("event_type").alias("phase"), C("event_id").cast("string").alias("name"), C("value").cast("string").alias("value"))
    tables.write_epoch_results(e, at)
    return tables.read_epoch_results(spark, at, "view").select("epoch", "phase", "name", "value")


# ---- models


@query(None)
def j4_message_passing(spark, d):
    a = v.atoms(spark, d)
    x = F.array(*[C(k).cast("double") for k in "xyz"])
    nodes = a.select("graph_id", C("serial").alias("node"), F.array(C("charge"), C("eps"), C("sigma")).alias("h"), x.alias("x"))
    from dockgrid.operators.spatial import contact_pairs

    c = contact_pairs(a).select("graph_id", C("l_serial").alias("src"), C("r_serial").alias("dst"), F.array(F.sqrt("d2")).alias("f"))
    return scoring.message_passing_layer(nodes, gr.symmetrise(c), scoring.random_weights(3, 1))


@query(f"WITH {v.ATOMS}, {v.CONTACTS}, n AS (SELECT graph_id, avg(charge) AS m, count(*) AS n FROM atoms GROUP BY graph_id), e AS (SELECT graph_id, count(*) AS n FROM contacts GROUP BY graph_id) SELECT n.graph_id, round(tanh(n.m * coalesce(e.n, 0) / n.n), 6) AS score, 'ok' AS status FROM n LEFT JOIN e USING (graph_id)")
def j5_score_graphs(spark, d):
    from dockgrid.operators.spatial import contact_pairs

    a = v.atoms(spark, d)
    n = a.select("graph_id", C("serial").alias("node"), C("charge").alias("value"))
    return _round(scoring.score_graphs(n, contact_pairs(a).select("graph_id", "l_serial"), scoring.reference_model), 6, "score").select("graph_id", "score", "status")


@query(f"WITH {v.ATOMS}, {v.CONTACTS}, n AS (SELECT graph_id, avg(charge) AS m, count(*) AS n FROM atoms GROUP BY graph_id), e AS (SELECT graph_id, count(*) AS n FROM contacts GROUP BY graph_id) SELECT n.graph_id, round(tanh(n.m * coalesce(e.n, 0) / n.n), 6) AS score, 'ok' AS status FROM n LEFT JOIN e USING (graph_id)")
def j5_packed_scores(spark, d):
    from dockgrid.operators.spatial import contact_pairs

    a = v.atoms(spark, d)
    n = a.select("graph_id", (C("serial") - 1).alias("node_idx"), C("charge").alias("value"))
    e = contact_pairs(a).select("graph_id", (C("l_serial") - 1).alias("src_idx"), (C("r_serial") - 1).alias("dst_idx"))
    return _round(scoring.score_packed(n, e, scoring.reference_batch, 5000), 6, "score").select("graph_id", "score", "status")


@query(None)
def j5_two_branch_scores(spark, d):
    """Contacts between chains and pairs within them are the branches; residues and chains are the depths of pooling."""
    from dockgrid.operators.spatial import contact_pairs, internal_pairs

    # Read by nodes, clusters and both kinds of pairs: dealt once.
    a = settle_dealt(v.atoms(spark, d).select("graph_id", "serial", "chain", "res_seq", "atom_name", "x", "y", "z", "charge", "eps", "sigma"), "atoms", by="graph_id")
    nodes = a.select("graph_id", C("serial").alias("node"), F.array("charge", "eps", "sigma").alias("f"), F.array(*[C(k).cast("double") for k in "xyz"]).alias("x"))
    clusters = a.select("graph_id", C("serial").alias("node"), F.concat_ws(":", "chain", "res_seq").alias("depth_0"), C("chain").alias("depth_1"))
    outer, inner = (gr.symmetrise(e.select("graph_id", C("l_serial").alias("src"), C("r_serial").alias("dst"), F.array(F.sqrt("d2")).alias("f"))) for e in (contact_pairs(a), internal_pairs(a, 3.0)))
    return two_branch.two_branch_scores(nodes, outer, inner, clusters, two_branch.random_two_branch(3, 1, 1)).select("graph_id", F.round(C("scores")[0], 6).alias("score"))


@query("SELECT p_partkey::VARCHAR AS label, length(p_name)::BIGINT AS n, round(list_sum([CASE WHEN lower(p_name)[i] BETWEEN 'a' AND 'z' THEN (ascii(lower(p_name)[i]) - 96) / 26.0::DOUBLE ELSE 0 END FOR i IN range(1, length(p_name) + 1)]), 6) AS total FROM part")
def j6_embed_sequences(spark, d):
    s = v.table(spark, d, "part").select(C("p_partkey").cast("string").alias("label"), C("p_name").alias("sequence"))
    return scoring.embed_sequences(s, scoring.composition).select("label", F.size("values").cast("long").alias("n"), F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query(f"WITH {v.ATOMS} SELECT graph_id, CASE WHEN graph_id % 5 > 0 THEN round(max(x) - min(x), 4) END AS width, CASE WHEN graph_id % 5 > 0 THEN 'ok' ELSE 'fail' END AS status FROM atoms GROUP BY graph_id")
def j7_map_structures(spark, d):
    def start():
        def tool(f: pd.DataFrame) -> dict:
            if f["graph_id"].iloc[0] % 5 == 0:
                raise ValueError("no such structure")
            return {"width": float(f["x"].max() - f["x"].min())}

        return tool

    return _round(scoring.map_structures(v.atoms(spark, d).select("graph_id", "x"), None, "width double", start=start), 4, "width").select("graph_id", "width", "status")


# ---- streams


def _streamed(df: DataFrame, mode: str, spark: SparkSession, name: str) -> DataFrame:
    """Runs a streaming plan over what is there and returns its last result, written to shared storage by each batch."""
    at = new_path(spark, name)
    last: list[str] = []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/{number}")
        last.append(f"{at}/{number}")

    q = df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{at}-log").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(last[-1]) if mode == "complete" else spark.read.schema(df.schema).parquet(*last)


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    t = v.table(spark, d, name)
    return spark.readStream.schema(t.schema).option("pathGlobFilter", f"{name}.parquet").parquet(d) if not _is_folder(spark, d, name) else spark.readStream.schema(t.schema).parquet(f"{d}/{name}.parquet")


def _is_folder(spark: SparkSession, d: str, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, user_id AS prefix, event_type AS metric, count(value) AS n, round(avg(value), 6) AS mean, max(value) AS max FROM events GROUP BY ALL")
def i1_metric_windows(spark, d):
    e = _stream(spark, d, "events").select(C("user_id").alias("prefix"), C("event_type").alias("metric"), C("ts").cast("timestamp").alias("ts"), "value")
    out = _streamed(streams.metric_windows(e, "1 day", "2 hours"), "complete", spark, "windows")
    return _round(out, 6, "mean").withColumn("start", C("start").cast("timestamp_ntz"))


@query("SELECT user_id AS shard_id, arg_max(event_type, ts) AS status, max(ts) AS at, count(*) AS n_events FROM events GROUP BY user_id")
def i2_stream_progress(spark, d):
    e = _stream(spark, d, "events").select(C("user_id").alias("shard_id"), C("event_type").alias("status"), C("ts"))
    return _streamed(streams.latest_progress(e), "complete", spark, "progress")


@query("SELECT count(*) AS rows, round(avg(l_tax), 6) AS mean, count(*) FILTER (l_tax >= 0.49) AS high, count(*) FILTER (l_tax >= 0.23 AND l_tax < 0.49) AS med, count(*) FILTER (l_tax < 0.23) AS low FROM lineitem")
def i4_stream_predictions(spark, d):
    p = _stream(spark, d, "lineitem").select(C("l_tax").alias("dockq"))
    return _round(_streamed(streams.running_predictions(p), "complete", spark, "preds"), 6, "mean").drop("quantiles")


@query("SELECT DISTINCT user_id AS label FROM events")
def i5_stream_dedup(spark, d):
    e = _stream(spark, d, "events").select(C("user_id").alias("label"))
    return _streamed(streams.dedup_labels(e), "append", spark, "labels")


_PLACES = ", ".join(f"floor({k} * 1000) / 1000 AS {k}" for k in "xyz")
_CURED = f"""raw AS ({v.ATOMS.partition("(")[2][:-1]}), atoms AS MATERIALIZED (SELECT graph_id, serial, chain, res_seq, res_name, atom_name, {_PLACES}, 0.0::DOUBLE AS charge, 0.0::DOUBLE AS eps, 0.0::DOUBLE AS sigma, 0.0::DOUBLE AS eps14, 0.0::DOUBLE AS sigma14 FROM raw WHERE serial % 10 > 0 AND serial % 7 > 0)"""


@query(f"""WITH {_CURED}, {v.CONTACTS}, {NODES}, {INTERNAL}, n AS (SELECT graph_id, count(*) AS n_nodes, round(sum(x), 3) AS sum_x FROM nodes GROUP BY graph_id), a AS (SELECT graph_id, count(*) AS n_atoms FROM atoms GROUP BY graph_id)
SELECT graph_id, n_atoms, n_nodes, sum_x, coalesce(e.n, 0) AS n_interface, coalesce(i.n, 0) AS n_internal FROM a JOIN n USING (graph_id) LEFT JOIN (SELECT graph_id, 2 * count(*) AS n FROM contacts GROUP BY graph_id) e USING (graph_id) LEFT JOIN (SELECT graph_id, 2 * count(*) AS n FROM internal GROUP BY graph_id) i USING (graph_id)""")
def i3_stream_ingest(spark, d):
    from dockgrid.plans.queries_sources import _graph, _written

    root, store = _written(spark, d), new_path(spark, "store")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).count()
    streams.ingest_structures(spark, root, store, f"{store}-log", per_batch=max(1, -(-files // 2)), named=_graph(), buckets=8).awaitTermination()
    g = tables.read_graphs(spark, store, ("nodes", "edges", "status"))
    e = g["edges"].groupBy("graph_id").agg(F.count_if(C("edge_type") == "interface").alias("n_interface"), F.count_if(C("edge_type") == "internal").alias("n_internal"))
    n = g["nodes"].groupBy("graph_id").agg(F.round(F.sum("x"), 3).alias("sum_x"))
    return g["status"].filter("error IS NULL").select("graph_id", "n_atoms", "n_nodes").join(n, "graph_id").join(e, "graph_id")


@query(f"""WITH {v.ATOMS}, {v.CONTACTS}, {NODES}, {INTERNAL}, idx AS (SELECT graph_id, serial, row_number() OVER (PARTITION BY graph_id ORDER BY chain, res_seq, serial) - 1 AS i FROM nodes),
e AS (SELECT graph_id, 'interface' AS edge_type, l_serial, r_serial, d2 FROM contacts UNION ALL SELECT graph_id, 'internal', l_serial, r_serial, d2 FROM internal)
SELECT e.graph_id, e.edge_type, 2 * count(*) AS n_edges, sum(a.i + b.i)::BIGINT AS sum_src, sum(2 * a.i * b.i)::BIGINT AS sum_product, round(2 * sum(sqrt(d2)), 3) AS sum_dist FROM e JOIN idx a ON a.graph_id = e.graph_id AND a.serial = e.l_serial JOIN idx b ON b.graph_id = e.graph_id AND b.serial = e.r_serial GROUP BY e.graph_id, e.edge_type""")
def a8_whole_store(spark, d):
    at = new_path(spark, "store")
    built = build_graphs(v.atoms(spark, d))
    tables.write_graphs(at, built["nodes"], built["edges"], buckets=8)
    e = tables.read_graphs(spark, at, ("nodes", "edges"))["edges"]
    i, j = C("src_idx").cast("long"), C("dst_idx").cast("long")
    return e.groupBy("graph_id", "edge_type").agg(F.count("*").alias("n_edges"), F.sum(i).alias("sum_src"), F.sum(i * j).alias("sum_product"), F.round(F.sum("dist"), 3).alias("sum_dist"))


@query("SELECT user_id AS shard_id, arg_max(event_type, (ts, event_type)) AS status, max(ts) AS at, count(*) AS n_events FROM events GROUP BY user_id")
def i2_bounded_progress(spark, d):
    e = _stream(spark, d, "events").select(C("user_id").alias("shard_id"), C("event_type").alias("status"), C("ts"))
    rows = _streamed(streams.progress_sessions(e, "1 hour", "2 days"), "update", spark, "sessions")
    return streams.progress_of(rows).withColumn("at", C("at").cast("timestamp_ntz"))


@query("SELECT user_id AS label, min(event_id) AS event_id FROM events GROUP BY user_id")
def i5_label_store(spark, d):
    store = new_path(spark, "labels")
    e = _stream(spark, d, "events").select(C("user_id").alias("label"), "event_id")
    streams.ingest_labels(e, store, f"{store}-log", order=("event_id",)).awaitTermination()
    return spark.read.parquet(store).select("label", "event_id")


#: Whether each quantile's rank is within half a percent of what was asked; ties may stand for a range of ranks.
@query("SELECT count(*) AS rows, round(avg(l_extendedprice), 4) AS mean, 0 AS n_off, count(*) FILTER (l_extendedprice >= 0.49) AS high, count(*) FILTER (l_extendedprice >= 0.23 AND l_extendedprice < 0.49) AS med, count(*) FILTER (l_extendedprice < 0.23) AS low FROM lineitem")
def i4_merged_quantiles(spark, d):
    store, shares = new_path(spark, "sketches"), (0.1, 0.25, 0.5, 0.75, 0.9)
    p = _stream(spark, d, "lineitem").select(C("l_extendedprice").alias("dockq"))
    streams.ingest_predictions(p, store, f"{store}-log").awaitTermination()
    one = streams.merged_predictions(spark, store, shares)
    q = one.first()["quantiles"]
    ranks = v.table(spark, d, "lineitem").agg(F.count("*").alias("n"), *[F.count_if(C("l_extendedprice") < x).alias(f"a{k}") for k, x in enumerate(q)], *[F.count_if(C("l_extendedprice") <= x).alias(f"b{k}") for k, x in enumerate(q)]).first()
    off = sum(not ranks[f"a{k}"] - 0.005 * ranks["n"] <= share * ranks["n"] <= ranks[f"b{k}"] + 0.005 * ranks["n"] for k, share in enumerate(shares))
    return _round(one, 4, "mean").select("rows", "mean", F.lit(off).alias("n_off"), "high", "med", "low")
