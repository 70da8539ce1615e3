"""Threshold sweep and evaluation metrics on any (score, label) columns.

Everything is an aggregation over distinct scores followed by a running sum
in score order (``ordering.running_totals``), so the cost is one shuffle of
per-score counts plus one range pass, whatever the number of rows.

Semantics follow the reference's metric library:

* PR curve: one point per distinct score ``t`` (predict fail when
  ``score >= t``); ``precision = tp / (tp + fp)``, ``recall = tp / P`` (1 when
  there is no positive); ``F1 = 2PR / (P + R + 1e-9)``;
* best threshold: largest F1, the lowest threshold among ties;
* ROC-AUC: exact, ties count one half (rank-sum form);
* classification report: per class, accuracy, macro and weighted average,
  zero when a ratio has a zero denominator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import running_totals

F1_EPS = 1e-9


def pr_curve(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    lab = F.col(label_col) == 1
    per = scored.groupBy(F.col(score_col).alias("threshold")).agg(
        F.count_if(lab).alias("pos"), F.count_if(~lab | lab.isNull()).alias("neg")
    )
    cum = running_totals(per, [F.col("threshold").desc()], ["pos", "neg"])
    # Reads the checkpointed per-score table, not the raw rows again.
    n_pos = cum.select(F.coalesce(F.sum("pos"), F.lit(0))).scalar()
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    precision = F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp))
    recall = F.when(n_pos == 0, F.lit(1.0)).otherwise(tp / n_pos)
    out = cum.select(
        "threshold",
        tp.cast("long").alias("tp"),
        fp.cast("long").alias("fp"),
        precision.alias("precision"),
        recall.alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.lit(2.0) * p * r / (p + r + F.lit(F1_EPS)))


def best_f1_threshold(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """One row: the F1-maximising threshold and its precision / recall / F1."""
    return (
        pr_curve(scored, score_col, label_col)
        .orderBy(F.desc("f1"), F.asc("threshold"))
        .limit(1)
        .select("threshold", "precision", "recall", "f1")
    )


def apply_threshold(
    scored: DataFrame, score_col: str, threshold, out_col: str = "Predicted_Class"
) -> DataFrame:
    """``score >= threshold`` as 0/1 on the unrounded score. ``threshold`` is
    a number or a one-row, one-column DataFrame (used as a scalar subquery)."""
    t = threshold.scalar() if isinstance(threshold, DataFrame) else F.lit(float(threshold))
    return scored.withColumn(out_col, (F.col(score_col) >= t).cast("int"))


def build_predictions(
    scored: DataFrame,
    threshold,
    id_col: str = "Wafer_ID",
    ts_col: str = "Timestamp",
    label_col: str = "Label",
    score_col: str = "probability",
) -> DataFrame:
    """The ml_predictions table: id, time, actual, predicted, probability
    (rounded to 6 decimals after the threshold is applied)."""
    applied = apply_threshold(scored, score_col, threshold)
    return applied.select(
        F.col(id_col).alias("Wafer_ID"),
        F.col(ts_col).alias("Timestamp"),
        F.col(label_col).cast("int").alias("Actual_Result"),
        F.col("Predicted_Class"),
        F.round(F.col(score_col).cast("double"), 6).alias("Failure_Probability"),
    )


def roc_auc(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Exact ROC-AUC with tied scores counted one half.

    With ``C(s)`` rows scoring ``<= s`` and ``n(s)`` rows scoring ``s``, twice
    the mean rank of score ``s`` is ``2C - n + 1``; summing it over positives
    gives ``S`` and ``AUC = (S - P(P+1)) / (2PN)`` in exact integers.
    """
    lab = F.col(label_col) == 1
    per = scored.groupBy(F.col(score_col).alias("_s")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(lab).alias("pos")
    )
    cum = running_totals(per, [F.col("_s").asc()], ["n"])
    twice_rank = F.lit(2) * F.col("n_cum") - F.col("n") + F.lit(1)
    agg = cum.agg(
        F.sum(F.col("pos") * twice_rank).alias("_S"),
        F.sum("pos").alias("n_pos"),
        F.sum(F.col("n") - F.col("pos")).alias("n_neg"),
    )
    P, N = F.col("n_pos"), F.col("n_neg")
    auc = F.when((P == 0) | (N == 0), F.lit(None).cast("double")).otherwise(
        (F.col("_S") - P * (P + 1)).cast("double")
        / (F.lit(2.0) * P.cast("double") * N.cast("double"))
    )
    return agg.select(P.cast("long").alias("n_pos"), N.cast("long").alias("n_neg"), auc.alias("roc_auc"))


def _counts(pred: DataFrame, actual_col: str, predicted_col: str) -> DataFrame:
    a, p = F.col(actual_col), F.col(predicted_col)
    return pred.agg(
        F.count_if((a == 0) & (p == 0)).alias("n00"),
        F.count_if((a == 0) & (p == 1)).alias("n01"),
        F.count_if((a == 1) & (p == 0)).alias("n10"),
        F.count_if((a == 1) & (p == 1)).alias("n11"),
    )


def confusion_matrix(
    pred: DataFrame, actual_col: str = "Actual_Result", predicted_col: str = "Predicted_Class"
) -> DataFrame:
    """All four cells of the 2x2 matrix (zero cells included)."""
    return _counts(pred, actual_col, predicted_col).select(
        F.expr(
            "stack(4, 0, 0, n00, 0, 1, n01, 1, 0, n10, 1, 1, n11) AS (Actual, Predicted, n)"
        )
    )


def _ratio(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def classification_report(
    pred: DataFrame,
    actual_col: str = "Actual_Result",
    predicted_col: str = "Predicted_Class",
    names: tuple[str, str] = ("Pass", "Fail"),
) -> DataFrame:
    """Rows: each class, ``accuracy``, ``macro avg``, ``weighted avg`` with
    precision, recall, f1_score and support."""
    c = _counts(pred, actual_col, predicted_col)
    n00, n01, n10, n11 = (F.col(x) for x in ("n00", "n01", "n10", "n11"))
    p0, r0 = _ratio(n00, n00 + n10), _ratio(n00, n00 + n01)
    p1, r1 = _ratio(n11, n11 + n01), _ratio(n11, n11 + n10)
    per = c.select(
        p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
        (n00 + n01).alias("s0"), (n10 + n11).alias("s1"),
        (n00 + n11).alias("hits"),
    )
    f = lambda p, r: F.when(p + r == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * p * r / (p + r)
    )
    P0, R0, P1, R1 = (F.col(x) for x in ("p0", "r0", "p1", "r1"))
    S0, S1 = F.col("s0"), F.col("s1")
    tot = S0 + S1
    withf = per.select("*", f(P0, R0).alias("f0"), f(P1, R1).alias("f1"), tot.alias("tot"))
    F0, F1c, T = F.col("f0"), F.col("f1"), F.col("tot")
    w = lambda a, b: F.when(T == 0, F.lit(0.0)).otherwise(
        (a * S0.cast("double") + b * S1.cast("double")) / T.cast("double")
    )
    rows = [
        (F.lit(names[0]), P0, R0, F0, S0),
        (F.lit(names[1]), P1, R1, F1c, S1),
        (F.lit("accuracy"), F.lit(None).cast("double"), F.lit(None).cast("double"),
         _ratio(F.col("hits"), T), T),
        (F.lit("macro avg"), (P0 + P1) / F.lit(2.0), (R0 + R1) / F.lit(2.0),
         (F0 + F1c) / F.lit(2.0), T),
        (F.lit("weighted avg"), w(P0, P1), w(R0, R1), w(F0, F1c), T),
    ]
    structs = [
        F.struct(
            a.alias("label"), b.alias("precision"), r.alias("recall"),
            g.alias("f1_score"), s.cast("long").alias("support"),
        )
        for a, b, r, g, s in rows
    ]
    return withf.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def balanced_error_rate(
    pred: DataFrame, actual_col: str = "Actual_Result", predicted_col: str = "Predicted_Class"
) -> DataFrame:
    """Mean of the two per-class error rates (the dataset notes' figure of
    merit): ``(FP / (TN + FP) + FN / (FN + TP)) / 2``; a class without rows
    contributes an error rate of 0."""
    c = _counts(pred, actual_col, predicted_col)
    n00, n01, n10, n11 = (F.col(x) for x in ("n00", "n01", "n10", "n11"))
    return c.select(
        ((_ratio(n01, n00 + n01) + _ratio(n10, n10 + n11)) / F.lit(2.0)).alias(
            "balanced_error_rate"
        )
    )
