"""Forests over the line items in the layout of the fused table.

A forest cannot be said in SQL; what SQL can state of the same fits is in ``queries/jobs.py``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.columns import NUMERIC_FEATURES
from millwright.functions.features import engineered
from millwright.models.explain import mean_attributions, shap_values
from millwright.models.score import score, score_spread
from millwright.models.train import Recipe, fit_forest, importances
from millwright.models.validate import cross_validate, learning_curve
from millwright.operators.classification import confusion_matrix, mean_and_std, metrics_report
from millwright.operators.curves import roc_auc
from millwright.operators.splits import stratified_split
from millwright.queries.views import LINE_KEY, fused_lines
from millwright.session import fresh_path
from millwright.sources.models import load_model, save_model
from millwright.sources.tables import latest_rows
from millwright.streaming.scoring import request_schema, request_stream, score_stream_by_batch

PLAIN = Recipe(balanced=False)
BALANCED = Recipe(balanced=True)

SHARED_ROLES = {
    "air": "air_temp_K",
    "process": "proc_temp_K",
    "speed": "rot_speed_rpm",
    "torque": "torque_Nm",
    "wear": "tool_wear_min",
}


def _trained(spark: SparkSession, sf_dir: str, recipe: Recipe = BALANCED) -> PipelineModel:
    return fit_forest(fused_lines(spark, sf_dir), recipe)


def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain forest on 80 %: class and probability of the held-out rows."""
    lines = fused_lines(spark, sf_dir)
    train, test = stratified_split(lines, "machine_failure", LINE_KEY)
    return score_spread(test, fit_forest(train, PLAIN), like=lines)


def rf_balanced_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced forest on 80 %: class and probability of the held-out rows."""
    lines = fused_lines(spark, sf_dir)
    train, test = stratified_split(lines, "machine_failure", LINE_KEY)
    return score_spread(test, fit_forest(train, BALANCED), like=lines)


def holdout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full report of the held-out rows of a plain forest."""
    path = fresh_path(spark, "holdout")
    rf_predict(spark, sf_dir).select(
        F.col("machine_failure").alias("label"),
        F.col("predicted_failure").alias("prediction"),
        F.col("failure_prob").alias("score"),
    ).write.parquet(path)
    scored = spark.read.parquet(path)
    return metrics_report(confusion_matrix(scored), roc_auc(scored))


def cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, F1 and AUC of five folds, with mean and deviation."""
    folds = cross_validate(fused_lines(spark, sf_dir), BALANCED, LINE_KEY)
    return mean_and_std(folds, ["split", "metric"])


def cv_engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with engineered features."""
    rich = engineered(fused_lines(spark, sf_dir), SHARED_ROLES)
    powers = [f"{c}_{p}" for c in SHARED_ROLES.values() for p in ("squared", "cubed")]
    numbers = [*NUMERIC_FEATURES, "speed_x_torque", "temp_diff", "wear_rate", *powers]
    folds = cross_validate(rich, Recipe(numeric=numbers), LINE_KEY)
    return mean_and_std(folds, ["split", "metric"])


def curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning_curve(fused_lines(spark, sf_dir), BALANCED, LINE_KEY, parallel=8)


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy against training size: ten sizes, five folds."""
    return mean_and_std(curve_points(spark, sf_dir), ["fraction", "split"])


def top_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importances(_trained(spark, sf_dir), spark)


def shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributions of a fixed sample of 500 rows."""
    return shap_values(fused_lines(spark, sf_dir), _trained(spark, sf_dir), LINE_KEY)


def shap_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_attributions(shap(spark, sf_dir))


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with class and probability, from a model that was stored and loaded."""
    path = save_model(_trained(spark, sf_dir), fresh_path(spark, "model"))
    return score_spread(fused_lines(spark, sf_dir).drop("machine_failure"), load_model(path))


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows scored as a stream of files, each with the key of its line."""
    return streamed(spark, sf_dir, _trained(spark, sf_dir)).drop("batch")


def streamed(spark: SparkSession, sf_dir: str, model: PipelineModel) -> DataFrame:
    """The lines as requests with their key, scored batch by batch."""
    lines = fused_lines(spark, sf_dir)
    schema = request_schema([lines.schema[c] for c in LINE_KEY])
    requests = fresh_path(spark, "requests")
    lines.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(requests)
    target = fresh_path(spark, "stream-scores")
    query = score_stream_by_batch(
        request_stream(spark, requests, schema, files_per_batch=4), model, target, fresh_path(spark, "stream-state")
    )
    query.awaitTermination()
    return spark.read.parquet(target)


def score_last_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 latest rows, scored."""
    lines = fused_lines(spark, sf_dir)
    return score(latest_rows(lines, 20, "timestamp", LINE_KEY), _trained(spark, sf_dir))


QUERIES = {
    "rf_predict": rf_predict,
    "rf_balanced_predict": rf_balanced_predict,
    "holdout_report": holdout_report,
    "cv_metrics": cv_metrics,
    "cv_engineered": cv_engineered,
    "learning_curve": curve,
    "importances": top_importances,
    "shap_values": shap,
    "shap_mean": shap_mean,
    "batch_score": batch_score,
    "stream_score": stream_score,
    "score_last_20": score_last_20,
}

ORACLES: dict[str, str] = {}
