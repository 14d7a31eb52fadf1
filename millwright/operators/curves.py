"""ROC and precision-recall curves, and the area under ROC, from (label, score) rows.

Rows collapse to distinct scores first, so a score shared by many rows is one
row; running counts over the scores then give every point exactly. A null label or
score and a label other than 0 and 1 are errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwright.operators.prefix import running_totals


def binary_rows(label: Column, score: Column) -> tuple[Column, Column]:
    """Label and score; a row that cannot be counted fails the job."""
    wrong = F.raise_error(F.concat(F.lit("labels must be 0 or 1, not "), F.coalesce(label.cast("string"), F.lit("null"))))
    truth = F.when(label.cast("double").isin(0.0, 1.0), label.cast("int")).otherwise(wrong.cast("int"))
    none = F.raise_error(F.lit("a score is null or not a number")).cast("double")
    value = score.cast("double")
    return truth, F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(none)


def score_steps(df: DataFrame, label: str | Column = "label", score: str | Column = "score") -> DataFrame:
    """``score, pos, neg, pos_below, neg_below`` and the totals, one row per distinct score."""
    truth = F.col(label) if isinstance(label, str) else label
    value = F.col(score) if isinstance(score, str) else score
    truth, value = binary_rows(truth, value)
    rows = df.select(truth.alias("truth"), value.alias("score"))
    steps = rows.groupBy("score").agg(
        F.count_if(F.col("truth") == 1).alias("pos"), F.count_if(F.col("truth") != 1).alias("neg")
    )
    return running_totals(
        steps,
        ["score"],
        sums={"pos_below": F.col("pos"), "neg_below": F.col("neg")},
        totals=True,
        sample_from=rows,
    ).withColumnsRenamed({"pos_below_total": "pos_all", "neg_below_total": "neg_all"})


def roc_auc(df: DataFrame, label: str | Column = "label", score: str | Column = "score") -> DataFrame:
    """``roc_auc``: the share of (positive, negative) pairs in order, ties counted half.

    Null when a class is absent.
    """
    won = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all").cast("double")
    return score_steps(df, label, score).agg(
        F.try_divide(F.sum(won), F.when(pairs > 0, pairs)).alias("roc_auc")
    )


def roc_auc_by(df: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """``by..., roc_auc`` per group, e.g. per fold."""
    truth, value = binary_rows(F.col(label), F.col(score))
    rows = df.select(*by, truth.alias("truth"), value.alias("score"))
    steps = rows.groupBy(*by, "score").agg(
        F.count_if(F.col("truth") == 1).alias("pos"), F.count_if(F.col("truth") != 1).alias("neg")
    )
    return auc_of_steps(steps, by)


def auc_of_steps(steps: DataFrame, by: list[str]) -> DataFrame:
    """``by..., roc_auc`` from ``by..., score, pos, neg`` with one row for each distinct score."""
    ordered = running_totals(steps, ["score"], sums={"neg_below": F.col("neg")}, group=by)
    won = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ordered.groupBy(*by).agg(F.try_divide(F.sum(won), F.when(pairs > 0, pairs)).alias("roc_auc"))


def _origin(df: DataFrame, **values) -> DataFrame:
    return df.sparkSession.range(1).select(
        *[F.lit(v).cast("double").alias(name) for name, v in values.items()]
    )


def _counts_at_score(steps: DataFrame) -> tuple[Column, Column]:
    return F.col("pos_all") - F.col("pos_below"), F.col("neg_all") - F.col("neg_below")


def roc_points(df: DataFrame, label: str | Column = "label", score: str | Column = "score") -> DataFrame:
    """``threshold, fpr, tpr`` for every distinct score, and the origin (null threshold)."""
    steps = score_steps(df, label, score)
    tp, fp = _counts_at_score(steps)
    points = steps.select(
        F.col("score").alias("threshold"),
        F.try_divide(fp.cast("double"), F.col("neg_all").cast("double")).alias("fpr"),
        F.try_divide(tp.cast("double"), F.col("pos_all").cast("double")).alias("tpr"),
    )
    return points.unionByName(_origin(df, threshold=None, fpr=0.0, tpr=0.0))


def pr_points(df: DataFrame, label: str | Column = "label", score: str | Column = "score") -> DataFrame:
    """``threshold, precision, recall`` for every distinct score, and the closing point (1, 0)."""
    steps = score_steps(df, label, score)
    tp, fp = _counts_at_score(steps)
    points = steps.select(
        F.col("score").alias("threshold"),
        F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
        F.try_divide(tp.cast("double"), F.col("pos_all").cast("double")).alias("recall"),
    )
    return points.unionByName(_origin(df, threshold=None, precision=1.0, recall=0.0))
