"""Metrics and curves over scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millwright.functions.text import as_report_text
from millwright.models.validate import fold_metrics, score_counts
from millwright.operators.classification import (
    accuracy_and_f1,
    class_report,
    confusion_matrix,
    false_cases as first_false_cases,
    mean_and_std,
    metrics_report as full_report,
)
from millwright.operators.curves import pr_points, roc_auc, roc_points
from millwright.operators.splits import size_fractions, with_fold, with_prefix_step
from millwright.queries.splits import LINE_HASH, LINE_HASH_43
from millwright.session import fresh_path
from millwright.sources.reports import write_report
from millwright.queries.views import EVENT_SCORES, LINE_KEY, LINE_SCORES, digits, event_scores, line_scores, q


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(line_scores(spark, sf_dir))


def confusion_empty_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction that never says 1: its cells stay, with zero rows."""
    return confusion_matrix(line_scores(spark, sf_dir).withColumn("prediction", F.lit(0)))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(class_report(confusion_matrix(line_scores(spark, sf_dir))), ["value"])


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with four fixed decimals, as text."""
    return report(spark, sf_dir).withColumn("value", as_report_text(F.col("value")))


def f1_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(accuracy_and_f1(confusion_matrix(event_scores(spark, sf_dir))), ["value"])


def auc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(roc_auc(line_scores(spark, sf_dir)), ["roc_auc"])


def auc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(roc_auc(event_scores(spark, sf_dir)), ["roc_auc"])


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_scores(spark, sf_dir)
    return digits(full_report(confusion_matrix(rows), roc_auc(rows)), ["value"], 4)


def report_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report written as a table and read back."""
    paths = write_report({"metrics": metrics_report(spark, sf_dir)}, fresh_path(spark, "reports"), "parquet")
    return spark.read.parquet(paths["metrics"])


def roc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(roc_points(line_scores(spark, sf_dir)), ["threshold", "fpr", "tpr"])


def roc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(roc_points(event_scores(spark, sf_dir)), ["threshold", "fpr", "tpr"])


def pr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(pr_points(line_scores(spark, sf_dir)), ["threshold", "precision", "recall"])


def pr_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(pr_points(event_scores(spark, sf_dir)), ["threshold", "precision", "recall"])


def false_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten misses and the first ten false alarms, in time order."""
    return first_false_cases(event_scores(spark, sf_dir), ["ts", "event_id"])


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fold(line_scores(spark, sf_dir), "label", LINE_KEY)


def fold_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and AUC per fold, then mean and deviation over the folds."""
    counts = score_counts(_folded(spark, sf_dir).withColumn("split", F.lit("test")))
    found = fold_metrics(counts).filter("metric <> 'f1'")
    return digits(mean_and_std(found, ["metric"]), ["mean", "std"])


def size_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy per fold within each nested prefix, then mean and deviation per prefix."""
    rows = with_prefix_step(_folded(spark, sf_dir), LINE_KEY, size_fractions(), seed=43)
    counted = rows.groupBy("fold", "step").agg(
        F.count_if(F.col("label") == F.col("prediction")).alias("hits"), F.count(F.lit(1)).alias("rows")
    )
    # Ten rows per fold from here on.
    upto = Window.partitionBy("fold").orderBy("step")
    scores = counted.select(
        "fold", "step", (F.sum("hits").over(upto) / F.sum("rows").over(upto)).alias("value")
    )
    return digits(mean_and_std(scores, ["step"]), ["mean", "std"])


def _line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_linenumber") % 3).cast("int").alias("label"), (F.col("l_quantity").cast("int") % 3).cast("int").alias("prediction")
    )


def confusion_three_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes found in the data."""
    return confusion_matrix(_line_classes(spark, sf_dir), classes=None)


QUERIES = {
    "confusion": confusion,
    "confusion_three_classes": confusion_three_classes,
    "confusion_empty_cells": confusion_empty_cells,
    "class_report": report,
    "report_text": report_text,
    "f1_accuracy": f1_accuracy,
    "roc_auc": auc_lines,
    "roc_auc_events": auc_events,
    "metrics_report": metrics_report,
    "metrics_report_stored": report_stored,
    "roc_points": roc_lines,
    "roc_points_events": roc_events,
    "pr_points": pr_lines,
    "pr_points_events": pr_events,
    "false_cases": false_cases,
    "fold_mean_std": fold_mean_std,
    "size_mean_std": size_mean_std,
}


def _confusion_sql(source: str) -> str:
    return f"""
        SELECT a.v AS label, b.v AS prediction, count(s.label) AS rows
        FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) b(v)
        LEFT JOIN ({source}) s ON s.label = a.v AND s.prediction = b.v
        GROUP BY a.v, b.v
    """


def _report_sql(source: str) -> str:
    return f"""
        WITH m AS ({_confusion_sql(source)}),
        c AS (
            SELECT CAST(k.v AS VARCHAR) AS label,
                   CAST(sum(CASE WHEN m.label = k.v THEN rows END) AS DOUBLE) AS support,
                   CAST(sum(CASE WHEN m.label = k.v AND m.prediction = k.v THEN rows END) AS DOUBLE) AS hits,
                   CAST(sum(CASE WHEN m.prediction = k.v THEN rows END) AS DOUBLE) AS guessed
            FROM m, (VALUES (0), (1)) k(v) GROUP BY k.v
        ),
        s AS (
            SELECT label, support, hits,
                   CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS "precision",
                   CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
                   CASE WHEN guessed + support = 0 THEN 0 ELSE 2 * hits / (guessed + support) END AS f1
            FROM c
        ),
        report AS (
            SELECT label, 'precision' AS metric, "precision" AS value FROM s
            UNION ALL SELECT label, 'recall', recall FROM s
            UNION ALL SELECT label, 'f1', f1 FROM s
            UNION ALL SELECT label, 'support', support FROM s
            UNION ALL SELECT 'accuracy', 'accuracy', sum(hits) / sum(support) FROM s
            UNION ALL SELECT k, 'support', sum(support) FROM s, (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(k) GROUP BY k
            UNION ALL SELECT 'macro avg', 'precision', avg("precision") FROM s
            UNION ALL SELECT 'macro avg', 'recall', avg(recall) FROM s
            UNION ALL SELECT 'macro avg', 'f1', avg(f1) FROM s
            UNION ALL SELECT 'weighted avg', 'precision', sum("precision" * support) / sum(support) FROM s
            UNION ALL SELECT 'weighted avg', 'recall', sum(recall * support) / sum(support) FROM s
            UNION ALL SELECT 'weighted avg', 'f1', sum(f1 * support) / sum(support) FROM s
        )
    """


def _steps_sql(source: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
        SELECT {group}score, pos, neg,
               coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
               coalesce(sum(pos) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
               {f'sum(pos) OVER (PARTITION BY {by})' if by else 'sum(pos) OVER ()'} AS pos_all,
               {f'sum(neg) OVER (PARTITION BY {by})' if by else 'sum(neg) OVER ()'} AS neg_all
        FROM (SELECT {group}score, sum(label) AS pos, sum(1 - label) AS neg FROM ({source}) GROUP BY {group}score)
    """


_AUC = "sum(CAST(pos AS DOUBLE) * (neg_below + neg / 2.0)) / (max(CAST(pos_all AS DOUBLE)) * max(neg_all))"


def _roc_sql(source: str) -> str:
    return f"""
        SELECT {q('score')} AS threshold, {q('CAST(neg_all - neg_below AS DOUBLE) / neg_all')} AS fpr,
               {q('CAST(pos_all - pos_below AS DOUBLE) / pos_all')} AS tpr
        FROM ({_steps_sql(source)})
        UNION ALL SELECT NULL, 0.0, 0.0
    """


def _pr_sql(source: str) -> str:
    return f"""
        SELECT {q('score')} AS threshold,
               {q('CAST(pos_all - pos_below AS DOUBLE) / (pos_all - pos_below + neg_all - neg_below)')} AS "precision",
               {q('CAST(pos_all - pos_below AS DOUBLE) / pos_all')} AS recall
        FROM ({_steps_sql(source)})
        UNION ALL SELECT NULL, 1.0, 0.0
    """


_FOLDED = f"""
    SELECT *, CAST((place - 1) * 5 // n AS INT) AS fold
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {LINE_HASH}) AS place,
                 count(*) OVER (PARTITION BY label) AS n
          FROM ({LINE_SCORES}))
"""

ORACLES = {
    "confusion_three_classes": """
        WITH c(k) AS (VALUES (0), (1), (2)),
        rows AS (SELECT l_linenumber % 3 AS label, CAST(trunc(l_quantity) AS INTEGER) % 3 AS prediction FROM lineitem)
        SELECT a.k AS label, b.k AS prediction, count(r.label) AS rows
        FROM c a CROSS JOIN c b LEFT JOIN rows r ON r.label = a.k AND r.prediction = b.k GROUP BY a.k, b.k""",
    "confusion": _confusion_sql(LINE_SCORES),
    "confusion_empty_cells": _confusion_sql(f"SELECT label, 0 AS prediction FROM ({LINE_SCORES})"),
    "class_report": f"{_report_sql(LINE_SCORES)} SELECT label, metric, {q('value')} AS value FROM report",
    "report_text": f"{_report_sql(LINE_SCORES)} SELECT label, metric, format('{{:.4f}}', {q('value')}) AS value FROM report",
    "f1_accuracy": f"""
        SELECT 'accuracy' AS metric, {q('avg(CAST(label = prediction AS INT))')} AS value FROM ({EVENT_SCORES})
        UNION ALL
        SELECT 'f1', {q('2.0 * sum(label * prediction) / (sum(label) + sum(prediction))')} FROM ({EVENT_SCORES})
    """,
    "roc_auc": f"SELECT {q(_AUC)} AS roc_auc FROM ({_steps_sql(LINE_SCORES)})",
    "roc_auc_events": f"SELECT {q(_AUC)} AS roc_auc FROM ({_steps_sql(EVENT_SCORES)})",
    "metrics_report": f"""
        {_report_sql(EVENT_SCORES)}
        SELECT 'report' AS section, label, metric, {q('value', 4)} AS value FROM report
        UNION ALL
        SELECT 'roc_auc', 'all', 'roc_auc', {q(_AUC, 4)} FROM ({_steps_sql(EVENT_SCORES)})
        UNION ALL
        SELECT 'confusion', CAST(label AS VARCHAR), concat('predicted ', prediction), CAST(rows AS DOUBLE)
        FROM ({_confusion_sql(EVENT_SCORES)})
    """,
    "roc_points": _roc_sql(LINE_SCORES),
    "roc_points_events": _roc_sql(EVENT_SCORES),
    "pr_points": _pr_sql(LINE_SCORES),
    "pr_points_events": _pr_sql(EVENT_SCORES),
    "false_cases": f"""
        SELECT event_id, ts, value, label, score, prediction, case_kind FROM (
            SELECT *, CASE WHEN label = 1 THEN 'false_negative' ELSE 'false_positive' END AS case_kind,
                   row_number() OVER (PARTITION BY label ORDER BY ts, event_id) AS place
            FROM ({EVENT_SCORES}) WHERE label <> prediction
        ) WHERE place <= 10
    """,
    "fold_mean_std": f"""
        WITH scores AS (
            SELECT 'accuracy' AS metric, fold, avg(CAST(label = prediction AS INT)) AS value FROM ({_FOLDED}) GROUP BY fold
            UNION ALL
            SELECT 'roc_auc', fold, {_AUC} FROM ({_steps_sql(_FOLDED, 'fold')}) GROUP BY fold
        )
        SELECT metric, {q('avg(value)')} AS mean, {q('stddev_pop(value)')} AS std FROM scores GROUP BY metric
    """,
    "size_mean_std": f"""
        WITH placed AS (
            SELECT *, row_number() OVER (ORDER BY {LINE_HASH_43}) AS all_place, count(*) OVER () AS all_rows FROM ({_FOLDED})
        ),
        scores AS (
            SELECT CAST(i AS INT) AS step, fold, avg(CAST(label = prediction AS INT)) AS value
            FROM placed, range(1, 11) t(i) WHERE all_place <= i * all_rows // 10 GROUP BY i, fold
        )
        SELECT step, {q('avg(value)')} AS mean, {q('stddev_pop(value)')} AS std FROM scores GROUP BY step
    """,
}

ORACLES["metrics_report_stored"] = ORACLES["metrics_report"]
