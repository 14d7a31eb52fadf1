"""Classification numbers over any table with a true and a predicted class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwright.operators.prefix import union_all

MOST_CLASSES = 1000
REPORT_SCHEMA = "section string, label string, metric string, value double"


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: tuple | None = (0, 1)
) -> DataFrame:
    """``label, prediction, rows`` for every pair of classes, empty cells included.

    Without ``classes`` they are read from both columns (``MOST_CLASSES`` at most). A
    null, or a class that is not among ``classes``, is an error: no row is left out.
    """
    if classes is None:
        both = df.select(F.explode(F.array(label, prediction)).alias("c")).distinct()
        classes = tuple(sorted(r.c for r in both.filter("c is not null").limit(MOST_CLASSES + 1).collect()))
        if len(classes) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes")
    known = F.col(label).isin(*classes) & F.col(prediction).isin(*classes)
    others = F.count_if(~F.coalesce(known, F.lit(False))).alias("_others")
    error = F.raise_error(F.concat(F.col("_others").cast("string"), F.lit(f" rows with a class that is not in {list(classes)}")))
    pairs = [(a, b) for a in classes for b in classes]
    counts = [
        F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"_{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    cells = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.when(F.col("_others") == 0, F.col(f"_{i}")).otherwise(error).alias("rows"))
        for i, (a, b) in enumerate(pairs)
    ]
    return df.agg(*counts, others).select(F.inline(F.array(*cells)))


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_report(matrix: DataFrame) -> DataFrame:
    """``label, metric, value``: precision, recall, f1 and support per class, then the averages.

    Reads a confusion matrix, whose size depends on the classes alone.
    """
    as_label = matrix.groupBy(F.col("label").alias("class")).agg(
        F.sum("rows").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)).alias("hits"),
    )
    as_guess = matrix.groupBy(F.col("prediction").alias("class")).agg(F.sum("rows").alias("guessed"))
    per_class = as_label.join(F.broadcast(as_guess), "class").select(
        "class",
        "support",
        "hits",
        _ratio(F.col("hits"), F.col("guessed")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("guessed") + F.col("support")).alias("f1"),
    )
    by_class = per_class.select(
        F.col("class").cast("string").alias("label"),
        F.inline(_cells({m: F.col(m) for m in ("precision", "recall", "f1", "support")})),
    )
    weight = F.sum("support")
    averages = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), _cells({
                "accuracy": _ratio(F.sum("hits"), weight),
                "support": weight,
            }).alias("cells")),
            F.struct(F.lit("macro avg").alias("label"), _cells({
                **{m: F.avg(m) for m in ("precision", "recall", "f1")},
                "support": weight,
            }).alias("cells")),
            F.struct(F.lit("weighted avg").alias("label"), _cells({
                **{m: _ratio(F.sum(F.col(m) * F.col("support")), weight) for m in ("precision", "recall", "f1")},
                "support": weight,
            }).alias("cells")),
        ).alias("rows")
    ).select(F.inline("rows")).select("label", F.inline("cells"))
    return by_class.unionByName(averages)


def _cells(values: dict[str, Column]) -> Column:
    return F.array(
        *[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in values.items()]
    )


def accuracy_and_f1(matrix: DataFrame, positive: int = 1) -> DataFrame:
    """``metric, value``: accuracy, and f1 of the positive class."""
    cell = lambda a, b: F.sum(F.when(a & b, F.col("rows")).otherwise(0))
    is_true, is_guess = F.col("label") == positive, F.col("prediction") == positive
    hit = cell(is_true, is_guess)
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0))
    wrong = cell(~is_true, is_guess) + cell(is_true, ~is_guess)
    return matrix.agg(
        _cells({"accuracy": _ratio(right, F.sum("rows")), "f1": _ratio(2 * hit, 2 * hit + wrong)}).alias("cells")
    ).select(F.inline("cells"))


def metrics_report(matrix: DataFrame, auc: DataFrame) -> DataFrame:
    """Report, AUC and confusion matrix in one table ``section, label, metric, value``."""
    report = class_report(matrix).select(F.lit("report").alias("section"), "label", "metric", "value")
    area = auc.select(
        F.lit("roc_auc").alias("section"), F.lit("all").alias("label"), F.lit("roc_auc").alias("metric"),
        F.col("roc_auc").alias("value"),
    )
    cells = matrix.select(
        F.lit("confusion").alias("section"),
        F.col("label").cast("string").alias("label"),
        F.concat(F.lit("predicted "), F.col("prediction").cast("string")).alias("metric"),
        F.col("rows").cast("double").alias("value"),
    )
    return union_all([report, area, cells])


def false_cases(
    df: DataFrame,
    order: list[str],
    label: str = "label",
    prediction: str = "prediction",
    rows: int = 10,
) -> DataFrame:
    """The first ``rows`` false negatives and false positives in ``order``, tagged by ``case_kind``."""
    def first(kind: str, truth: int, guess: int) -> DataFrame:
        wrong = df.filter((F.col(label) == truth) & (F.col(prediction) == guess))
        return wrong.orderBy(*order).limit(rows).withColumn("case_kind", F.lit(kind))

    return first("false_negative", 1, 0).unionByName(first("false_positive", 0, 1))


def mean_and_std(scores: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Mean and population deviation of a score per group."""
    return scores.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
