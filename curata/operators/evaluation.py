"""Distributed evaluation (V1-V9).

Every evaluator takes a (label, prediction[, score]) table and returns a
one-row DataFrame built by aggregates, so the row data never leaves the
executors (the original pulled all predictions into pandas for the
confusion matrix).  Metrics follow MLlib's definitions:
``MulticlassClassificationEvaluator`` (accuracy, weighted precision/recall/F1,
0 where a denominator is 0) and ``BinaryClassificationEvaluator`` with exact
ROC (tied scores form one step, i.e. the tie-averaged rank-sum AUC).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.blocks import block_count, with_blocks
from curata.functions.exprs import safe_div
from curata.sources.sinks import persist

METRICS = ("auc_roc", "accuracy", "f1", "weighted_precision", "weighted_recall")


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V6: one row (tn, fp, fn, tp, n_other) from ONE aggregate; ``n_other``
    counts rows whose label or prediction is not 0 or 1, so the five add up to
    the input."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    cells = {"tn": (y == 0) & (p == 0), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tp": (y == 1) & (p == 1)}
    known = F.coalesce(y.isin(0.0, 1.0) & p.isin(0.0, 1.0), F.lit(False))
    return df.agg(*[F.count_if(c).alias(n) for n, c in cells.items()], F.count_if(~known).alias("n_other"))


def confusion_by(df: DataFrame, by: str = "model", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V6 for several scored tables in one: rows by (``by``, label, prediction), one grouped aggregate."""
    return df.groupBy(by, F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V2-V5 for any number of classes: accuracy and class-frequency-weighted
    precision, recall and F1 over the classes present in ``label``.

    Rows are grouped by (label, prediction) first; what follows works on one
    row per cell.  Rows without label or prediction are counted in
    ``n_unclassified`` and take no part in the metrics.
    """
    y, p = (F.col(c).cast("double") for c in (label, prediction))
    cells = df.groupBy(F.when(~F.isnan(y), y).alias("y"), F.when(~F.isnan(p), p).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    both = F.col("y").isNotNull() & F.col("p").isNotNull()
    entry = lambda c, t, h, q: F.struct(c.alias("c"), t.alias("true"), h.alias("hit"), q.alias("predicted"))
    n, zero = F.col("n"), F.lit(0).cast("long")
    parts = F.when(both, F.array(entry(F.col("y"), n, F.when(F.col("y") == F.col("p"), n).otherwise(zero), zero), entry(F.col("p"), zero, zero, n))).otherwise(
        F.array(entry(F.lit(None).cast("double"), n, zero, zero)))
    by_class = cells.select(F.inline(parts)).groupBy("c").agg(*[F.sum(x).cast("double").alias(x) for x in ("true", "hit", "predicted")])
    classes = by_class.withColumn("precision", _zero_div(F.col("hit"), F.col("predicted"))).withColumn("recall", _zero_div(F.col("hit"), F.col("true")))
    classes = classes.withColumn("f1", _zero_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    of = lambda x: F.sum(F.when(F.col("c").isNotNull(), x))
    weighted = lambda m: safe_div(of(F.col("true") * F.col(m)), of(F.col("true")))
    return classes.agg(
        F.coalesce(of(F.col("true")), F.lit(0.0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("c").isNull(), F.col("true"))), F.lit(0.0)).cast("long").alias("n_unclassified"),
        safe_div(of(F.col("hit")), of(F.col("true"))).alias("accuracy"),
        weighted("f1").alias("f1"), weighted("precision").alias("weighted_precision"), weighted("recall").alias("weighted_recall"))


def _zero_div(num, den):
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def auc_roc(df: DataFrame, label: str = "label", score: str = "score", blocks: int | None = None) -> DataFrame:
    """V1: exact area under the ROC curve, with ties averaged, as one row
    (auc_roc, n_pos, n_neg, n_unscored).

    AUC = sum over distinct scores s of pos(s) * (neg(<s) + neg(s)/2) / (P*N).
    neg(<s) is a prefix sum in score order, computed without a global sort
    in one task: distinct scores (infinite ones too) are cut into contiguous
    blocks at approximate quantiles (a bounded sketch, ``blocks`` numbers reach
    the driver); each block runs its own running sum, and a block's offset is a
    running sum over the per-block totals (``blocks`` rows, broadcast).
    A skewed score is one row after the first aggregate, which is kept while
    its small jobs run, so the input is computed once.  Rows without label or
    score (NULL or NaN) are counted in ``n_unscored``.  One class only: NULL.
    """
    s = F.col(score).cast("double")
    known = s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull()
    grouped = df.groupBy(F.when(known, s).alias("s")).agg(
        F.count_if(known & (F.col(label) == 1)).cast("double").alias("pos"),
        F.count_if(known & (F.col(label) != 1)).cast("double").alias("neg"),
        F.count_if(~known).alias("unscored"))
    grouped = persist(grouped)
    try:
        sizes = grouped.agg(F.count("s").alias("distinct"), F.coalesce(F.sum("unscored"), F.lit(0)).alias("unscored")).first()
        blocked = with_blocks(grouped.where("s IS NOT NULL"), "s", blocks or block_count(sizes["distinct"]))
        within = Window.partitionBy("block").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        ranked = blocked.withColumn("neg_before", F.coalesce(F.sum("neg").over(within), F.lit(0.0)))
        totals = blocked.groupBy("block").agg(F.sum("neg").alias("block_neg"))
        before = F.sum("block_neg").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        offsets = totals.select("block", F.coalesce(before, F.lit(0.0)).alias("offset"))
        row = ranked.join(F.broadcast(offsets), "block").agg(
            F.sum(F.col("pos") * (F.col("offset") + F.col("neg_before") + F.col("neg") / 2.0)).alias("u"),
            F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    finally:
        grouped.unpersist()
    pos, neg = row["p"] or 0.0, row["n"] or 0.0
    auc = row["u"] / (pos * neg) if pos and neg else None
    return df.sparkSession.createDataFrame([(auc, int(pos), int(neg), int(sizes["unscored"]))], "auc_roc double, n_pos bigint, n_neg bigint, n_unscored bigint")


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """All five metrics of one scored table in one row."""
    auc = auc_roc(df, label, score).first()
    cls = classification_metrics(df, label, prediction)
    return cls.select(F.lit(auc["auc_roc"]).cast("double").alias("auc_roc"), *[F.lit(auc[c]).alias(c) for c in ("n_pos", "n_neg", "n_unscored")], "*")


def leaderboard(rows: DataFrame, digits: int = 4) -> DataFrame:
    """V7: metrics rounded for display (one row per model)."""
    return rows.select("position", "model", *[F.round(m, digits).alias(m) for m in METRICS])


def best_model(board: DataFrame, metric: str = "f1") -> DataFrame:
    """V8: highest ``metric``; on a tie the model listed first wins."""
    return board.orderBy(F.desc(metric), F.asc("position")).limit(1)


def metric_comparison(board: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """V9: long form (model, metric, value)."""
    return board.unpivot(["position", "model"], list(metrics), "metric", "value")
