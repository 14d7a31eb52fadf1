"""Metrics and curves against hand-made values and the definition."""

import random

import pytest

from millwright.operators.classification import (
    accuracy_and_f1,
    class_report,
    confusion_matrix,
    false_cases,
    mean_and_std,
    metrics_report,
)
from millwright.operators.curves import pr_points, roc_auc, roc_auc_by, roc_points


@pytest.fixture(scope="module")
def published(spark):
    """1932 true negatives, 3 misses, 65 hits."""
    rows = [(0, 0, 0.1)] * 1932 + [(1, 0, 0.2)] * 3 + [(1, 1, 0.9)] * 65
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_published_report(published):
    matrix = confusion_matrix(published)
    assert {(r.label, r.prediction): r.rows for r in matrix.collect()} == {(0, 0): 1932, (0, 1): 0, (1, 0): 3, (1, 1): 65}
    got = {(r.label, r.metric): r.value for r in class_report(matrix).collect()}
    assert got["0", "precision"] == pytest.approx(1932 / 1935) and got["0", "recall"] == 1.0
    assert got["1", "precision"] == 1.0 and got["1", "recall"] == pytest.approx(65 / 68)
    assert got["1", "f1"] == pytest.approx(130 / 133) and got["accuracy", "accuracy"] == pytest.approx(1997 / 2000)
    rounded = {k: round(v, 2) for k, v in got.items()}
    # The published table, two digits.
    assert [rounded["macro avg", m] for m in ("precision", "recall", "f1")] == [1.0, 0.98, 0.99]
    assert [rounded["weighted avg", m] for m in ("precision", "recall", "f1")] == [1.0, 1.0, 1.0]
    assert (got["0", "support"], got["1", "support"], got["macro avg", "support"]) == (1932, 68, 2000)


def test_report_table_has_all_sections(published):
    rows = metrics_report(confusion_matrix(published), roc_auc(published)).collect()
    assert {r.section for r in rows} == {"report", "roc_auc", "confusion"} and len(rows) == 8 + 2 + 8 + 1 + 4


def test_no_predicted_positive_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    got = {(r.label, r.metric): r.value for r in class_report(confusion_matrix(df)).collect()}
    assert got["1", "precision"] == 0.0 and got["1", "f1"] == 0.0
    assert {r.metric: r.value for r in accuracy_and_f1(confusion_matrix(df)).collect()} == {"accuracy": 0.5, "f1": 0.0}


@pytest.mark.parametrize(
    "rows, area",
    [
        ([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], 0.75),
        ([(0, 0.5), (1, 0.5), (1, 0.5)], 0.5),
        ([(1, 0.5), (1, 0.7)], None),
    ],
)
def test_auc_golden(spark, rows, area):
    assert roc_auc(spark.createDataFrame(rows, "label int, score double")).first().roc_auc == area


def scored(seed, n=900):
    rng = random.Random(seed)
    # A third of the rows share one score.
    return [(int(rng.random() < 0.3), 0.5 if rng.random() < 0.34 else round(rng.random(), 3)) for _ in range(n)]


def pairwise(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", range(2))
def test_auc_is_the_share_of_ordered_pairs(spark, seed):
    rows = scored(seed)
    df = spark.createDataFrame(rows, "label int, score double")
    assert roc_auc(df).first().roc_auc == pytest.approx(pairwise(rows), abs=1e-12)


def test_auc_per_group(spark):
    groups = {g: scored(g) for g in (1, 2)}
    df = spark.createDataFrame([(g, y, s) for g, rows in groups.items() for y, s in rows], "g int, label int, score double")
    got = {r.g: r.roc_auc for r in roc_auc_by(df, ["g"]).collect()}
    for g, rows in groups.items():
        assert got[g] == pytest.approx(pairwise(rows), abs=1e-12)


def test_curves_follow_the_definition(spark):
    rows = scored(4)
    df = spark.createDataFrame(rows, "label int, score double")
    p, n = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    roc = {r.threshold: (r.fpr, r.tpr) for r in roc_points(df).collect()}
    pr = {r.threshold: (r.precision, r.recall) for r in pr_points(df).collect()}
    assert roc.pop(None) == (0.0, 0.0) and pr.pop(None) == (1.0, 0.0)
    assert set(roc) == set(pr) == {s for _, s in rows}
    for t in roc:
        tp = sum(y for y, s in rows if s >= t)
        fp = sum(1 - y for y, s in rows if s >= t)
        assert roc[t] == pytest.approx((fp / n, tp / p)) and pr[t] == pytest.approx((tp / (tp + fp), tp / p))


def test_false_cases_and_means(spark):
    df = spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(100)], "k int, label int, prediction int")
    rows = false_cases(df, ["k"], rows=3).collect()
    assert [r.k for r in rows if r.case_kind == "false_negative"] == [1, 5, 9]
    assert [r.k for r in rows if r.case_kind == "false_positive"] == [2, 6, 10]
    s = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "m string, value double")
    assert tuple(mean_and_std(s, ["m"]).first()) == ("a", 2.0, 1.0)
