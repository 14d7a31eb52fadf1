"""Whole jobs, and what SQL can state of fitted forests.

No SQL gives a forest's scores. It does give which rows are scored, how many each report holds, and what must
add up, so these queries run the same fits and jobs and return that: held-out keys, rows behind every class
and fold, and whether scores belong to their class, attributions to their score, streamed scores to batch scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.columns import NUMERIC_FEATURES, ROLE_TEXT
from millwright.models.score import score_spread
from millwright.models.train import fit_forest, importances
from millwright.models.validate import fold_scores, score_counts
from millwright.operators.splits import SAMPLE_ROWS
from millwright.plans.evaluation import evaluate
from millwright.plans.profiling import profile_job
from millwright.plans.training import train_engineered, train_fused, train_with_holdout
from millwright.queries import models
from millwright.queries.models import BALANCED
from millwright.queries.splits import LINE_HASH
from millwright.queries.views import LINE_KEY, LINE_ORDER, fused_lines, table
from millwright.session import fresh_path

SLOTS = len(NUMERIC_FEATURES)


def _sound(scored: DataFrame) -> DataFrame:
    """The key, and whether class and probability belong together."""
    p = F.col("failure_prob")
    return scored.select(*LINE_KEY, (p.between(0.0, 1.0) & (F.col("predicted_failure") == (p > 0.5).cast("int"))).alias("sound"))


def rf_predict_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sound(models.rf_predict(spark, sf_dir))


def rf_balanced_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sound(models.rf_balanced_predict(spark, sf_dir))


def batch_score_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, scored by a model that was stored and loaded."""
    return _sound(models.batch_score(spark, sf_dir))


def last_20_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sound(models.score_last_20(spark, sf_dir))


def stream_agrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line scored once as a stream and once as a batch, compared by its key (a few lines share one)."""
    lines = fused_lines(spark, sf_dir)
    model = fit_forest(lines, BALANCED)
    scores = F.array_sort(F.collect_list(F.struct("predicted_failure", "failure_prob")))
    batch = score_spread(lines, model).groupBy(*LINE_KEY).agg(scores.alias("batch"), F.count("*").alias("rows"))
    stream = models.streamed(spark, sf_dir, model).groupBy(*LINE_KEY).agg(scores.alias("stream"))
    same = F.coalesce(F.col("batch") == F.col("stream"), F.lit(False))
    return batch.join(stream, LINE_KEY, "full").select(*LINE_KEY, "rows", same.alias("agrees"))


def shap_adds_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each row of the sample: its features, and whether attributions and base give the probability."""
    gap = F.abs(F.sum("shap") + F.first("base") - F.first("failure_prob"))
    return models.shap(spark, sf_dir).groupBy(*LINE_KEY).agg(F.count("*").alias("features"), (gap < 1e-9).alias("adds_up"))


def importances_add_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importances(fit_forest(fused_lines(spark, sf_dir), BALANCED), spark, 1_000_000)
    return found.agg(F.count("*").alias("slots"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up"), (F.min("importance") >= 0).alias("none_negative"))


def cv_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows of each fold and class, from the table that all metrics are reduced from."""
    counts = score_counts(fold_scores(fused_lines(spark, sf_dir), BALANCED, LINE_KEY))
    sound = F.bool_and(F.col("score").between(0.0, 1.0) & (F.col("prediction") == (F.col("score") > 0.5).cast("int")))
    return counts.groupBy("fold", "split").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), sound.alias("sound"))


def curve_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fit of the curve: its rows, and that it learned something."""
    points = models.curve_points(spark, sf_dir).groupBy("fold", "fraction", "size").agg(
        F.count("*").alias("splits"), F.min("value").alias("least")
    )
    return points.select("fold", "fraction", "size", "splits", F.col("least").between(0.75, 1.0).alias("learned"))


def holdout_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on 80 % of the lines with every number but the ids: held-out rows of each class in the report."""
    trained = train_with_holdout(fused_lines(spark, sf_dir), LINE_KEY, "machine_failure", exclude=LINE_KEY)
    cells = trained.tables["metrics"].filter("section = 'confusion'")
    return cells.groupBy("label").agg(F.sum("value").cast("bigint").alias("rows"))


def _folds_of(tables: dict[str, DataFrame]) -> DataFrame:
    return tables["cv_folds"].select("fold", "split", "metric", F.col("value").between(0.0, 1.0).alias("in_range"))


def engineered_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines under raw sensor headers: engineered features, cross-validation and a fit on all rows."""
    lines = fused_lines(spark, sf_dir)
    named = {"air": "air_temp_K", "process": "proc_temp_K", "speed": "rot_speed_rpm", "torque": "torque_Nm", "wear": "tool_wear_min", "target": "machine_failure"}
    raw = lines.select(*LINE_KEY, *[F.col(c).alias(f"Lines {ROLE_TEXT[role]}") for role, c in named.items()])
    return _folds_of(train_engineered(raw, LINE_KEY, exclude=LINE_KEY, curve=False).tables)


def fused_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validation and a fit on all rows of the fused table."""
    return _folds_of(train_fused(fused_lines(spark, sf_dir), LINE_KEY).tables)


def evaluation_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report of an evaluation, by its rows; both curves have one point for each distinct score and one more."""
    lines = fused_lines(spark, sf_dir)
    found = evaluate(lines, fit_forest(lines, BALANCED), LINE_KEY, ["timestamp", *LINE_KEY])
    scores = found["scored"].select("y_proba").distinct().count() + 1
    rows = {name: df.count() for name, df in found.items()}
    wrong = found["scored"].filter("y_true <> y_pred").groupBy("y_true").count().collect()
    cases = sum(min(r["count"], 10) for r in wrong)
    out = [(n, rows[n]) for n in ("scored", "shap", "shap_mean", "importances")]
    out += [(f"{n}_as_expected", int(rows[n] == scores)) for n in ("roc", "pr")]
    return spark.createDataFrame([*out, ("false_cases_as_expected", int(rows["false_cases"] == cases))], "report string, rows bigint")


def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile job over the parts: rows of each table that it wrote."""
    paths = profile_job(table(spark, sf_dir, "part"), fresh_path(spark, "profile"))
    found = [(name, spark.read.option("header", True).csv(path).count()) for name, path in paths.items()]
    return spark.createDataFrame(found, "report string, rows bigint")


QUERIES = {
    "rf_predict_sound": rf_predict_sound,
    "rf_balanced_sound": rf_balanced_sound,
    "batch_score_sound": batch_score_sound,
    "last_20_sound": last_20_sound,
    "stream_agrees": stream_agrees,
    "shap_adds_up": shap_adds_up,
    "importances_add_up": importances_add_up,
    "cv_sizes": cv_sizes,
    "learning_curve_sizes": curve_sizes,
    "holdout_job": holdout_job,
    "engineered_job": engineered_job,
    "fused_job": fused_job,
    "evaluation_job": evaluation_job,
    "profile_job": profile_report,
}

_LABELLED = "(SELECT *, CAST(l_extendedprice * l_quantity > 4000000 AS INT) AS label FROM lineitem)"
_PLACED = f"""
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY {LINE_HASH}) AS place, count(*) OVER (PARTITION BY label) AS n
    FROM """
_HELD_OUT = f"SELECT * FROM ({_PLACED} {_LABELLED}) WHERE place <= floor(n * 0.2 + 0.5)"
_FOLDED = f"SELECT label, CAST((place - 1) * 5 // n AS INT) AS fold FROM ({_PLACED}"
_FOLD_METRICS = """
    SELECT CAST(f AS INT) AS fold, 'test' AS split, metric, TRUE AS in_range
    FROM range(5) t(f), (VALUES ('accuracy'), ('f1'), ('roc_auc')) m(metric)
"""
_FEATURES = f"({SLOTS} + (SELECT count(DISTINCT l_linenumber) FROM lineitem))"

ORACLES = {
    "rf_predict_sound": f"SELECT {LINE_ORDER}, TRUE AS sound FROM ({_HELD_OUT})",
    "rf_balanced_sound": f"SELECT {LINE_ORDER}, TRUE AS sound FROM ({_HELD_OUT})",
    "batch_score_sound": f"SELECT {LINE_ORDER}, TRUE AS sound FROM lineitem",
    "last_20_sound": f"""
        SELECT {LINE_ORDER}, TRUE AS sound FROM lineitem
        ORDER BY l_shipdate DESC, {', '.join(f'{c} DESC' for c in LINE_KEY)} LIMIT 20
    """,
    "stream_agrees": f"SELECT {LINE_ORDER}, count(*) AS rows, TRUE AS agrees FROM lineitem GROUP BY {LINE_ORDER}",
    "shap_adds_up": f"""
        SELECT {LINE_ORDER}, {_FEATURES} AS features, TRUE AS adds_up
        FROM (SELECT * FROM lineitem ORDER BY {LINE_HASH}, {LINE_ORDER} LIMIT {SAMPLE_ROWS})
    """,
    "importances_add_up": f"SELECT {_FEATURES} AS slots, TRUE AS adds_up, TRUE AS none_negative",
    "cv_sizes": f"""
        SELECT fold, 'test' AS split, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg, TRUE AS sound
        FROM ({_FOLDED} {_LABELLED})) GROUP BY fold
    """,
    "learning_curve_sizes": f"""
        WITH folded AS ({_FOLDED} {_LABELLED})),
        held AS (SELECT fold, (SELECT count(*) FROM folded) - count(*) AS n FROM folded GROUP BY fold)
        SELECT fold, i / 10.0::DOUBLE AS fraction, CAST(i * n // 10 AS BIGINT) AS size, CAST(2 AS BIGINT) AS splits, TRUE AS learned
        FROM held, range(1, 11) t(i)
    """,
    "holdout_job": f"SELECT CAST(label AS VARCHAR) AS label, count(*) AS rows FROM ({_HELD_OUT}) GROUP BY label",
    "engineered_job": _FOLD_METRICS,
    "fused_job": _FOLD_METRICS,
    "evaluation_job": f"""
        SELECT 'scored' AS report, count(*) AS rows FROM lineitem
        UNION ALL SELECT 'shap', {SAMPLE_ROWS} * {_FEATURES}
        UNION ALL SELECT 'shap_mean', {_FEATURES}
        UNION ALL SELECT 'importances', least(10, {_FEATURES})
        UNION ALL SELECT 'roc_as_expected', 1 UNION ALL SELECT 'pr_as_expected', 1
        UNION ALL SELECT 'false_cases_as_expected', 1
    """,
    "profile_job": """
        SELECT 'missing' AS report, CAST(6 AS BIGINT) AS rows UNION ALL SELECT 'missing_nonzero', 0 UNION ALL SELECT 'summary', 3
        UNION ALL SELECT 'density', 600 UNION ALL SELECT 'correlation', 9
        UNION ALL SELECT 'histogram', CAST(sum(n) AS BIGINT) FROM (
            SELECT count(DISTINCT least(floor((x - low) / (high - low) * 30.0), 29)) AS n FROM (
                SELECT c, x, min(x) OVER (PARTITION BY c) AS low, max(x) OVER (PARTITION BY c) AS high FROM (
                    SELECT 'a' AS c, CAST(p_partkey AS DOUBLE) AS x FROM part UNION ALL SELECT 'b', p_size FROM part
                    UNION ALL SELECT 'c', p_retailprice FROM part)) GROUP BY c)
    """,
}
