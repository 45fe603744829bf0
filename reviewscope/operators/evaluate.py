"""Quality metrics of scored rows, each from one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.functions.numbers import is_number


def confusion_counts(scored: DataFrame, prediction: str = "prediction", label: str = "trueLabel") -> DataFrame:
    """One row with tp, fp, tn, fn of 0/1 predictions."""
    p, y = F.col(prediction), F.col(label)
    return scored.agg(
        F.count_if((p == 1.0) & (y == 1)).alias("tp"),
        F.count_if((p == 1.0) & (y == 0)).alias("fp"),
        F.count_if((p == 0.0) & (y == 0)).alias("tn"),
        F.count_if((p == 0.0) & (y == 1)).alias("fn"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    """NULL instead of an error where a class is empty."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _precision() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return _ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def _weighted_f1() -> Column:
    """F1 of both classes, weighted by their true sizes."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    positive = F.coalesce(_ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    negative = F.coalesce(_ratio(2 * tn, 2 * tn + fp + fn), F.lit(0.0))
    return _ratio(positive * (tp + fn) + negative * (tn + fp), tp + fp + tn + fn)


def _hard_auc() -> Column:
    """Area under the one-threshold ROC: the mean of both classes' hit rates."""
    return (_recall() + _ratio(F.col("tn"), F.col("tn") + F.col("fp"))) / 2


def precision_recall(scored: DataFrame, **columns: str) -> DataFrame:
    return confusion_counts(scored, **columns).select(
        _precision().alias("precision"), _recall().alias("recall"),
    )


def f1_weighted(scored: DataFrame, **columns: str) -> DataFrame:
    return confusion_counts(scored, **columns).select(_weighted_f1().alias("f1_weighted"))


def auc_hard(scored: DataFrame, **columns: str) -> DataFrame:
    return confusion_counts(scored, **columns).select(_hard_auc().alias("auc_hard"))


def _tidy(counts: DataFrame, rows: dict[str, Column]) -> DataFrame:
    pairs = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
             for name, value in rows.items()]
    return counts.select(F.inline(F.array(*pairs)))


def metrics_table(scored: DataFrame, **columns: str) -> DataFrame:
    """(metric, value) rows TP, FP, TN, FN, Precision, Recall from one pass over ``scored``."""
    return _tidy(confusion_counts(scored, **columns), {
        "TP": F.col("tp"), "FP": F.col("fp"), "TN": F.col("tn"), "FN": F.col("fn"),
        "Precision": _precision(), "Recall": _recall(),
    })


def classifier_report(scored: DataFrame, **columns: str) -> DataFrame:
    """``metrics_table`` plus weighted F1, AUC of the hard predictions, and the majority baseline."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    share = _ratio(F.greatest(tp + fn, tn + fp), tp + fp + tn + fn)
    return _tidy(confusion_counts(scored, **columns), {
        "TP": tp, "FP": fp, "TN": tn, "FN": fn, "Precision": _precision(), "Recall": _recall(),
        "F1 weighted": _weighted_f1(), "AUC hard": _hard_auc(),
        # F1 weighted of always predicting the larger class.
        "F1 weighted, majority class": _ratio(2 * share * share, 1 + share),
    })


def rmse(scored: DataFrame, prediction: str = "prediction", label: str = "trueLabel") -> DataFrame:
    error = F.col(prediction).cast("double") - F.col(label)
    return scored.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def rating_report(scored: DataFrame, prediction: str = "prediction", label: str = "trueLabel") -> DataFrame:
    """RMSE of rounded scores, and how many rows got a score at all."""
    usable = is_number(F.col(prediction))
    rounded = F.abs(F.round(F.col(prediction).cast("double"), 0))
    error = F.when(usable, rounded - F.col(label))
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count_if(usable).alias("n_scored"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
