"""As-of join against the definition."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwright.operators.asof import asof_join

START = datetime(2024, 1, 1)
LEFT = "id int, ts timestamp_ntz"
RIGHT = "ts timestamp_ntz, job_id int, task_id int"


def at(minute, second=0, micro=0):
    return START + timedelta(minutes=minute, seconds=second, microseconds=micro)


def expected(left, right, tolerance):
    out = {}
    for i, ts in left:
        best = None
        if ts is not None:
            fits = [r for r in right if r[0] is not None and r[0] <= ts and (tolerance is None or ts - r[0] <= tolerance)]
            best = max(fits, default=None)
        out[i] = (best[1], best[2]) if best else (None, None)
    return out


def run(spark, left, right, tolerance, how="left"):
    rows = asof_join(
        spark.createDataFrame(left, LEFT),
        spark.createDataFrame(right, RIGHT),
        "ts",
        tolerance,
        how,
        ["job_id", "task_id"],
    ).collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: (r.job_id, r.task_id) for r in rows}


@pytest.mark.parametrize(
    "right, match",
    [
        ([(at(5), 1, 1)], (1, 1)),
        ([(at(2), 1, 1)], (1, 1)),
        ([(at(1, 59, 999999), 1, 1)], (None, None)),
        ([(at(5, 0, 1), 1, 1)], (None, None)),
        ([(at(3), 1, 1), (at(4), 2, 2)], (2, 2)),
        ([(at(4), 1, 2), (at(4), 3, 1)], (3, 1)),
        ([], (None, None)),
    ],
)
def test_golden(spark, right, match):
    assert run(spark, [(0, at(5))], right, timedelta(minutes=3)) == {0: match}


def test_inner_drops_unmatched(spark):
    left = [(0, at(5)), (1, at(50))]
    assert run(spark, left, [(at(4), 7, 1)], timedelta(minutes=3), "inner") == {0: (7, 1)}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("tolerance", [timedelta(0), timedelta(seconds=40), timedelta(minutes=30), None])
def test_random(spark, seed, tolerance):
    rng = random.Random(seed)
    span = rng.choice([30, 3000])
    moment = lambda: None if rng.random() < 0.03 else at(0, rng.randrange(span))
    left = [(i, moment()) for i in range(200)]
    right = [(moment(), rng.randrange(5), i) for i in range(150)]
    assert run(spark, left, right, tolerance) == expected(left, right, tolerance)


def test_one_moment_holds_a_third_of_both_sides(spark):
    rng = random.Random(1)
    moment = lambda: at(10) if rng.random() < 0.34 else at(0, rng.randrange(1200))
    left = [(i, moment()) for i in range(900)]
    right = [(moment(), rng.randrange(50), i) for i in range(900)]
    tolerance = timedelta(seconds=5)
    assert run(spark, left, right, tolerance) == expected(left, right, tolerance)


def test_long_gap_is_carried_over_many_ranges(spark):
    left = [(i, at(i)) for i in range(1, 500)]
    assert set(run(spark, left, [(at(0), 9, 9)], None).values()) == {(9, 9)}


def test_shared_column_names_are_refused(spark):
    left = spark.createDataFrame([(1, at(1))], "job_id int, ts timestamp_ntz")
    with pytest.raises(ValueError, match="job_id"):
        asof_join(left, spark.createDataFrame([], RIGHT), "ts")


def test_plan_has_no_pairwise_join_and_only_range_rows_in_one_task(spark):
    big = spark.range(100_000).select(
        F.col("id").cast("int").alias("id"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("ts"),
    )
    right = big.select("ts", F.col("id").alias("job_id"), F.col("id").alias("task_id"))
    plan = asof_join(big, right, "ts", timedelta(minutes=3))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange SinglePartition") == 1
