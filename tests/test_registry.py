"""Every registered query against its SQL on the smallest tables; plan checks."""

import pytest

import __spark_entry__ as registry
from millwright.queries import models
from tools.compare import compare

ORACLES = registry.oracle_sql()
PLAIN = sorted(ORACLES)


@pytest.mark.parametrize("name", PLAIN)
def test_query_equals_sql_without_pairwise_join(spark, sf_dir, name):
    def checked(session, folder):
        frame = registry.queries()[name](session, folder)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        return frame

    fine, note, _ = compare(spark, sf_dir, name, checked, ORACLES[name])
    assert fine, note
    assert "types:" not in note, note


# The forests themselves run in queries/jobs.py, whose results SQL can state.
FITTED = set(models.QUERIES)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(ORACLES) - FITTED))
def test_queries_without_sql_give_rows_with_a_stable_schema(spark, sf_dir, name):
    """What SQL cannot state is checked by its own tests; here it runs whole through the registry."""
    frame = registry.queries()[name](spark, sf_dir)
    rows = frame.collect()
    assert rows and rows[0].__fields__ == frame.columns and len(set(frame.columns)) == len(frame.columns)


@pytest.mark.parametrize("name", ["rf_predict", "importances", "batch_score", "score_last_20", "holdout_report"])
def test_forest_queries_keep_their_columns(spark, sf_dir, name):
    columns = {
        "rf_predict": {"predicted_failure", "failure_prob", "machine_failure"}, "importances": {"feature", "importance"},
        "batch_score": {"predicted_failure", "failure_prob"}, "score_last_20": {"predicted_failure", "failure_prob"},
        "holdout_report": {"section", "label", "metric", "value"},
    }
    frame = registry.queries()[name](spark, sf_dir)
    assert columns[name] <= set(frame.columns) and frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registry.queries())


def test_entry(spark):
    frame = registry.entry(spark)
    assert frame.columns == ["event_id", "ts", "user_id", "value", "job_id", "task_id", "machine_value"]
    assert frame.count() > 0
