"""Model evaluation: confusion counts, rates, regression errors, ranking metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockgrid.functions.scalars import higher_is_better, safe_div
from dockgrid.operators.graph import values_at
from dockgrid.operators.workflow import placed

C = F.col


def finite_pairs(df: DataFrame, pred: str = "pred", y: str = "y") -> DataFrame:
    ok = lambda c: C(c).isNotNull() & ~F.isnan(C(c).cast("double")) & (F.abs(C(c)) < float("inf"))
    return df.filter(ok(pred) & ok(y))


def train_valid_split(df: DataFrame, fraction: float, key: str, order: Column) -> DataFrame:
    """df with is_train for the first int(fraction n) rows by (order, key): exact sizes. Rows with null order are never among them.

    The order's value at the border is found by counting (values_at); of the rows that share it those that are needed are
    numbered over ranges of their keys. So neither all rows nor a value that many rows share go through one task.
    """
    span = df.withColumn("_o", order.cast("double"))
    n, known = span.agg(F.count("*"), F.count("_o")).first()
    want = int(fraction * n)
    if want < 1 or want >= known:
        return span.withColumn("is_train", C("_o").isNotNull() & F.lit(want > 0)).drop("_o")
    border = values_at(span, "_o", {want - 1}, known)[want - 1]
    below = span.filter(C("_o") < border).count()
    ties = placed(span.filter(C("_o") == border).select(C(key).alias("_k")).withColumn("_all", F.lit(0)), "_all", [C("_k")])
    chosen = ties.filter(C("_r") <= want - below).select("_k", F.lit(True).alias("_in"))
    out = span.join(chosen, (C(key) == C("_k")) & (C("_o") == border), "left")
    return out.withColumn("is_train", F.coalesce((C("_o") < border) | C("_in"), F.lit(False))).drop("_o", "_k", "_in")


def confusion(df: DataFrame, target: str, threshold: float, by: list[str], pred: str = "pred", y: str = "y") -> DataFrame:
    """tp, fp, tn, fn by group: strictly above the threshold for targets where more is better, else strictly below."""
    hit = (lambda c: C(c) > threshold) if higher_is_better(target) else (lambda c: C(c) < threshold)
    p, t = hit(pred), hit(y)
    return df.groupBy(*by).agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & ~t).alias("tn"), F.count_if(~p & t).alias("fn"))


def confusion_multiclass(df: DataFrame, classes: list[int], by: list[str], pred: str = "pred", y: str = "y") -> DataFrame:
    """One row a group and class, one against the rest."""
    each = df.select(*by, pred, y, F.explode(F.array(*map(F.lit, classes))).alias("class"))
    p, t = C(pred) == C("class"), C(y) == C("class")
    return each.groupBy(*by, "class").agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & ~t).alias("tn"), F.count_if(~p & t).alias("fn"))


def classification_rates(counts: DataFrame) -> DataFrame:
    """Adds the rates of tp, fp, tn, fn; null where a denominator is 0."""
    tp, fp, tn, fn = (C(k) for k in ("tp", "fp", "tn", "fn"))
    rates = {
        "sensitivity": safe_div(tp, tp + fn), "specificity": safe_div(tn, tn + fp), "precision": safe_div(tp, tp + fp), "npv": safe_div(tn, tn + fn), "fpr": safe_div(fp, fp + tn),
        "fnr": safe_div(fn, tp + fn), "fdr": safe_div(fp, tp + fp), "accuracy": safe_div(tp + tn, tp + tn + fp + fn), "f1": safe_div(2 * tp, 2 * tp + fp + fn),
    }
    return counts.withColumns(rates)


def regression_metrics(df: DataFrame, by: list[str], pred: str = "pred", y: str = "y") -> DataFrame:
    e = C(y) - C(pred)
    agg = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.max(F.abs(e)).alias("max_error"),
        F.var_pop(e).alias("_ve"), F.var_pop(y).alias("_vy"), F.sum(e * e).alias("_se"),
    )
    return agg.withColumns({"explained_variance": 1 - safe_div("_ve", "_vy"), "r2": 1 - safe_div(C("_se"), C("n") * C("_vy"))}).drop("_ve", "_vy", "_se")


def roc_auc(df: DataFrame, by: list[str], score: str, label: str) -> DataFrame:
    """Area under the curve by group, ties counted half; null if a group has one class only. Scores are aggregated by value first."""
    per = df.groupBy(*by, score).agg(F.sum(C(label).cast("long")).alias("pos"), F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum(C("n") - C("pos")).over(w), F.lit(0))
    ranked = per.withColumn("below", below)
    sums = ranked.groupBy(*by).agg(F.sum(C("pos") * (C("below") + (C("n") - C("pos")) / 2)).alias("u"), F.sum("pos").alias("p"), F.sum(C("n") - C("pos")).alias("q"))
    return sums.select(*by, F.try_divide("u", C("p") * C("q")).alias("auc"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Inverse counts, normalised to sum 1."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    total = n.agg(F.sum(1 / C("n"))).first()[0] or 1.0
    return n.withColumn("weight", 1 / C("n") / F.lit(total))


def _order(target: str, score: str, ident: str) -> list[Column]:
    return [C(score).desc() if higher_is_better(target) else C(score).asc(), C(ident).asc()]


def _keys(by: str | list[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def hitrate_curve(df: DataFrame, by: str | list[str], target: str, score: str, ident: str, hit: Column) -> DataFrame:
    """Rank and running number of hits within each group; groups are molecules' decoys, ties go by ident."""
    w = Window.partitionBy(*_keys(by)).orderBy(*_order(target, score, ident))
    return df.select(*_keys(by), ident, hit.cast("int").alias("hit"), F.row_number().over(w).alias("rank"), F.sum(hit.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("hits"))


def _first_k(df: DataFrame, by: str | list[str], target: str, score: str, ident: str, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*_keys(by)).orderBy(*_order(target, score, ident)))).filter(C("rank") <= k)


def hitrate_at_k(df: DataFrame, by: str | list[str], target: str, score: str, ident: str, hit: Column, k: int) -> DataFrame:
    return _first_k(df, by, target, score, ident, k).groupBy(*_keys(by)).agg(F.avg(hit.cast("double")).alias("hitrate"))


def success_at_k(df: DataFrame, by: str | list[str], target: str, score: str, ident: str, hit: Column, k: int) -> DataFrame:
    return _first_k(df, by, target, score, ident, k).groupBy(*_keys(by)).agg(F.max(hit.cast("int")).alias("success"))


def rank_molecules(df: DataFrame, by: str | list[str], score: str, ident: str, k: int, descending: bool = True) -> DataFrame:
    """The k best of each group."""
    w = Window.partitionBy(*_keys(by)).orderBy(C(score).desc() if descending else C(score), ident)
    return df.withColumn("rank", F.row_number().over(w)).filter(C("rank") <= k)


def contrastive_loss(df: DataFrame, batch: str, ident: str, pred: str, y: str, sigma2: float = 1.0) -> DataFrame:
    """Cross-entropy of logits -(pred_i - y_j)^2 / 2 sigma2 on the diagonal, times 2 sigma2, by batch (bounded training batches)."""
    # A batch is one row's array: no row a pair, which would be sorted by row to be collected.
    rows = df.filter(C(batch).isNotNull()).groupBy(batch).agg(F.collect_list(F.struct(C(ident).alias("i"), C(pred).alias("p"), C(y).alias("own"))).alias("rows"))

    def term(x: Column) -> Column:
        logits = F.filter(F.transform("rows", lambda o: -F.pow(x["p"] - o["own"], 2) / (2 * sigma2)), lambda v: v.isNotNull())
        # Rows alike in all are one row that meets the batch as often.
        alike = F.when(C("repeats"), F.log(F.size(F.filter("rows", lambda o: o.eqNullSafe(x))).cast("double"))).otherwise(0.0)
        tops = F.transform(F.array(logits), lambda ls: F.struct(ls.alias("ls"), F.array_max(ls).alias("top")))
        lse = F.transform(tops, lambda z: z["top"] + F.log(F.aggregate(z["ls"], F.lit(0.0), lambda s, v: s + F.exp(v - z["top"]))))[0]
        return lse + alike + F.pow(x["p"] - x["own"], 2) / (2 * sigma2)

    rows = rows.withColumn("own_rows", F.array_distinct("rows")).withColumn("repeats", F.size("own_rows") < F.size("rows"))
    terms = rows.select(batch, F.explode(F.transform("own_rows", term)).alias("term"))
    return terms.groupBy(batch).agg((F.avg("term") * (2 * sigma2)).alias("loss"))


def attach_target(graphs: DataFrame, scores: DataFrame, target: str) -> DataFrame:
    """y: the named score of the graph, null without one."""
    y = scores.select("graph_id", C(target).cast("double").alias("y")) if target in scores.columns else scores.select("graph_id", F.lit(None).cast("double").alias("y"))
    return graphs.join(y, "graph_id", "left")


def filter_by_score(df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """Rows that meet all conditions such as {'dockq': '>0.5'}; ops are > < ==; a missing score meets none."""
    out: list[Column] = []
    for name, text in conditions.items():
        if not isinstance(text, str):
            raise ValueError(f"condition for {name} is no text: {text!r}")
        op = next((o for o in ("==", ">", "<") if text.strip().startswith(o)), None)
        if op is None:
            raise ValueError(f"condition for {name}: {text!r}")
        v = float(text.strip()[len(op) :])
        out.append(C(name) > v if op == ">" else C(name) < v if op == "<" else C(name) == v)
    return df.filter(reduce(lambda a, b: a & b, out)) if out else df


def evaluate(df: DataFrame, target: str, threshold: float, by: list[str], ident: str, k: int = 10) -> DataFrame:
    """One row a group (by, such as phase and epoch; none: all rows are one group): rates, errors, AUC, hit rate and success at k of
    finite pairs pred, y."""
    if not by:
        return evaluate(df.withColumn("_all", F.lit(0)), target, threshold, ["_all"], ident, k).drop("_all")
    ok = finite_pairs(df)
    hit = C("y") > threshold if higher_is_better(target) else C("y") < threshold
    first = _first_k(ok, by, target, "pred", ident, k).groupBy(*by).agg(F.avg(hit.cast("double")).alias("hitrate"), F.max(hit.cast("int")).alias("success"))
    out = classification_rates(confusion(ok, target, threshold, by)).join(regression_metrics(ok, by), by)
    return out.join(roc_auc(ok.withColumn("_hit", hit.cast("int")), by, "pred", "_hit"), by).join(first, by)


def top_k_epochs(log: DataFrame, k: int, by: str = "run") -> DataFrame:
    """The k epochs of smallest mse of each run; NaN and null are ignored."""
    ok = log.filter(C("mse").isNotNull() & ~F.isnan("mse"))
    return ok.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy("mse", "epoch"))).filter(C("rank") <= k)


def early_stop_point(log: DataFrame, patience: int, min_delta: float = 0.0, by: str = "run") -> DataFrame:
    """run, best, stop_epoch (null: never): an ordered fold over a run's epochs, of which only improvements beyond min_delta count."""
    state = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("misses"), F.lit(None).cast("long").alias("stop"))

    def step(s: Column, x: Column) -> Column:
        better = x["mse"] < s["best"] - min_delta
        misses = F.when(better, 0).otherwise(s["misses"] + 1)
        going = F.struct(F.when(better, x["mse"]).otherwise(s["best"]).alias("best"), misses.alias("misses"), F.when(misses >= patience, x["epoch"]).alias("stop"))
        return F.when(s["stop"].isNotNull(), s).otherwise(going)

    runs = log.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(C("epoch").cast("long").alias("epoch"), C("mse").cast("double").alias("mse")))).alias("log"))
    folded = F.aggregate("log", state, step)
    return runs.select(by, folded["best"].alias("best"), folded["stop"].alias("stop_epoch"))
