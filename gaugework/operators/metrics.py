"""Classification metrics over a scored table, for all models and folds at once.

A scored table has one row per (model, fold, example): the grouping columns, ``actual``,
``predicted`` and ``probs`` (``map<string,double>``). Every function takes the grouping
columns as ``by``; nothing loops over models.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from gaugework.functions.exprs import log_loss_term, prob_of, ratio, ratio_or_zero, tile_of
from gaugework.operators.ordering import sorted_rank
from gaugework.session import materialise

BY = ("run_id", "model_name", "fold_id")


def join_truth(scores: DataFrame, truth: DataFrame, key: str = "id") -> DataFrame:
    """Scores with their true labels, joined on the unique row key.

    Feature values are no key: rows with equal features would match each other.
    """
    return scores.join(truth, key)


def unpack_prediction(held: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Replace a ``struct<predicted_value, probability>`` by two plain columns."""
    return held.withColumns({
        "predicted_label": F.col(f"{prediction}.predicted_value"),
        "predicted_prob": F.col(f"{prediction}.probability"),
    }).drop(prediction)


def confusion_matrix(scored: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(by, actual, predicted, cnt)."""
    return scored.groupBy(*by, "actual", "predicted").agg(F.count(F.lit(1)).alias("cnt"))


def fold_accuracy(scored: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(by, correct, total, accuracy)."""
    return scored.groupBy(*by).agg(
        F.count_if(F.col("predicted") == F.col("actual")).alias("correct"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("accuracy", ratio(F.col("correct"), F.col("total")))


def per_class_counts(
    matrix: DataFrame, by: Sequence[str] = BY, macro_over: Sequence[str] | None = None
) -> DataFrame:
    """(by, class_label, tp, actual_total, predicted_total) from a confusion matrix.

    The classes are those that occur as actual label, or the fixed list ``macro_over``. Each cell
    counts for the class it is of and the class it was taken for, in one aggregate.
    """
    nothing = F.lit(0).cast("bigint")
    cnt = F.col("cnt")

    def line(label, tp, actual, predicted):
        return F.struct(label.alias("class_label"), tp.alias("tp"), actual.alias("actual_total"),
                        predicted.alias("predicted_total"))

    hit = F.when(F.col("actual") == F.col("predicted"), cnt).otherwise(nothing)
    lines = [line(F.col("actual"), hit, cnt, nothing), line(F.col("predicted"), nothing, nothing, cnt)]
    for label in macro_over or ():
        lines.append(line(F.lit(label), nothing, nothing, nothing))
    counts = matrix.select(*by, F.inline(F.array(*lines))).groupBy(*by, "class_label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "actual_total", "predicted_total")]
    )
    if macro_over is None:
        return counts.filter("actual_total > 0")
    return counts.filter(F.col("class_label").isin(list(macro_over)))


def macro_scores(
    matrix: DataFrame, by: Sequence[str] = BY, macro_over: Sequence[str] | None = None
) -> DataFrame:
    """(by, precision_macro, recall_macro, f1_of_macro, f1_macro_mean).

    ``f1_of_macro`` is the harmonic mean of the two macro values, ``f1_macro_mean`` the mean
    of the classes' own F1. A class that is never predicted has precision 0.
    """
    tp = F.col("tp")
    precision = ratio_or_zero(tp, F.col("predicted_total"))
    recall = ratio_or_zero(tp, F.col("actual_total"))
    f1 = ratio_or_zero(2 * tp, F.col("predicted_total") + F.col("actual_total"))
    p, r = F.col("precision_macro"), F.col("recall_macro")
    return per_class_counts(matrix, by, macro_over).groupBy(*by).agg(
        F.avg(precision).alias("precision_macro"),
        F.avg(recall).alias("recall_macro"),
        F.avg(f1).alias("f1_macro_mean"),
    ).withColumn("f1_of_macro", ratio_or_zero(2 * p * r, p + r))


def cv_mean(
    fold_metrics: DataFrame,
    by: Sequence[str],
    value: str = "accuracy",
    fold: str = "fold_id",
) -> DataFrame:
    """Unweighted mean of a fold metric per ``by``; fold 0 (summaries) does not count."""
    return fold_metrics.filter(F.col(fold) != 0).groupBy(*by).agg(
        F.avg(value).alias(f"cv_mean_{value}")
    )


def cross_validation_rows(scored: DataFrame, prefix: str) -> DataFrame:
    """(run_id, model_name, fold_number, metric_name, metric_value) of a k-fold run.

    Accuracy and number of predictions per fold, and their run's mean accuracy as fold 0.
    """
    per_fold = fold_accuracy(scored, BY)
    lines = per_fold.select("run_id", "model_name", F.col("fold_id").alias("fold_number"), F.inline(
        F.array(
            F.struct(F.lit("accuracy").alias("metric_name"), F.col("accuracy").alias("metric_value")),
            F.struct(F.lit("total_predictions").alias("metric_name"),
                     F.col("total").cast("double").alias("metric_value")),
        )
    ))
    mean = cv_mean(per_fold, ["run_id"]).select(
        "run_id", F.lit(f"{prefix}_cv").alias("model_name"), F.lit(0).alias("fold_number"),
        F.lit("cv_mean_accuracy").alias("metric_name"), F.col("cv_mean_accuracy").alias("metric_value"),
    )
    return lines.unionByName(mean)


def rank_scores(
    scored: DataFrame, positive: str, by: Sequence[str] = BY, key: str = "id"
) -> DataFrame:
    """One-vs-rest ranking by probability of ``positive``, highest first, ties by key.

    (by, key, score, hit, rank, rows). :func:`roc_auc` and :func:`lift_table` both read it,
    so the table is sorted once for the two. Rows without a score rank last.
    """
    narrow = scored.select(
        *by, key,
        prob_of(F.col("probs"), F.lit(positive)).alias("score"),
        F.coalesce((F.col("actual") == positive).cast("int"), F.lit(0)).alias("hit"),
    )
    return sorted_rank(narrow, by, [F.col("score").desc_nulls_last(), F.col(key)])


def roc_auc(ranked: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(by, positives, negatives, roc_auc): exact, ties count half; NULL for one class only."""
    rows = F.col("rows").cast("double")
    ties = ranked.groupBy(*by, "score").agg(
        F.sum("hit").alias("hits"),
        F.count(F.lit(1)).alias("n"),
        # Mean rank counted from the lowest score.
        F.first(rows + 1).alias("above"), ((F.min("rank") + F.max("rank")) / 2).alias("mid"),
    )
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return ties.groupBy(*by).agg(
        F.sum("hits").alias("positives"),
        (F.sum("n") - F.sum("hits")).alias("negatives"),
        F.sum(F.col("hits") * (F.col("above") - F.col("mid"))).alias("_ranks"),
    ).withColumn("roc_auc", ratio(F.col("_ranks") - p * (p + 1) / 2, p * n)).drop("_ranks")


def lift_table(ranked: DataFrame, by: Sequence[str] = BY, buckets: int = 10) -> DataFrame:
    """(by, bucket, n_rows, hits, lift, cumulative_lift): equal-count buckets, best first.

    Lift is the bucket's share of positives over the overall share; NULL for one class only.
    """
    per_bucket = (
        ranked.withColumn("bucket", tile_of(F.col("rank"), F.col("rows"), buckets))
        .groupBy(*by, "bucket")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("hit").alias("hits"))
    )
    whole = Window.partitionBy(*by)
    so_far = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    base_rate = F.when(
        F.col("all_hits") < F.col("all_rows"), ratio(F.col("all_hits"), F.col("all_rows"))
    )
    return (
        per_bucket
        .withColumn("all_hits", F.sum("hits").over(whole))
        .withColumn("all_rows", F.sum("n_rows").over(whole))
        .withColumn("cum_hits", F.sum("hits").over(so_far))
        .withColumn("cum_rows", F.sum("n_rows").over(so_far))
        .select(
            *by, "bucket", "n_rows", "hits",
            ratio(ratio(F.col("hits"), F.col("n_rows")), base_rate).alias("lift"),
            ratio(ratio(F.col("cum_hits"), F.col("cum_rows")), base_rate).alias("cumulative_lift"),
        )
    )


def top_bucket_lift(lifts: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(by, lift_value): the lift of the lowest-numbered bucket."""
    return lifts.groupBy(*by).agg(F.min_by("lift", "bucket").alias("lift_value"))


def log_loss(scored: DataFrame, by: Sequence[str] = BY, eps: float = 1e-15) -> DataFrame:
    """(by, log_loss): mean -ln of the clipped probability of the true class."""
    p_true = prob_of(F.col("probs"), F.col("actual"))
    return scored.groupBy(*by).agg(F.avg(log_loss_term(p_true, eps)).alias("log_loss"))


def evaluate(
    scored: DataFrame,
    positive: str,
    by: Sequence[str] = BY,
    macro_over: Sequence[str] | None = None,
    key: str = "id",
) -> DataFrame:
    """All metrics of all models and folds, one row per group (the wide metrics form).

    The scored table is read once, into narrow rows; of these one pass gives the confusion matrix with
    the summed loss per cell, from which accuracy, macro scores and log loss follow, and one the
    ranking. Groups with a NULL key part are groups.
    """
    keys = list(by)
    scored = materialise(scored.select(*dict.fromkeys([*by, key, "actual", "predicted", "probs"])))
    loss = log_loss_term(prob_of(F.col("probs"), F.col("actual")))
    matrix = materialise(scored.groupBy(*by, "actual", "predicted").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(loss).alias("loss")
    ))
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("cnt")).otherwise(0))
    totals = matrix.groupBy(*by).agg(
        ratio(hits, F.sum("cnt")).alias("accuracy"),
        F.sum("cnt").alias("total_predictions"),
        ratio(F.sum("loss"), F.sum("cnt")).alias("log_loss"),
    )
    ranked = rank_scores(scored, positive, by, key)
    parts = [macro_scores(matrix, by, macro_over), roc_auc(ranked, by).select(*by, "roc_auc"),
             top_bucket_lift(lift_table(ranked, by), by)]
    return reduce(lambda a, b: same_group(a, b, keys), parts, totals)


def same_group(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on the grouping columns in which NULL is a value like any other."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in by})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_{c}"]) for c in by])
    return left.join(renamed, same).drop(*[f"_{c}" for c in by])
