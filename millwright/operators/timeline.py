"""Job routes and minute matrices to timestamped operations; a clock for sensor rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions.clock import CLOCK_START, SENSOR_STEP_SECONDS, moment, plus_minutes, seconds
from millwright.functions.columns import SENSOR_NAMES, rename
from millwright.operators.prefix import HOT_ROWS, running_totals


def check_jobs(**inputs: DataFrame) -> None:
    """Raise unless every input has exactly one row per job and all name the same jobs."""
    frames = [
        df.select("job_id", *[F.lit(1 if n == name else 0).alias(n) for n in inputs])
        for name, df in inputs.items()
    ]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionAll(frame)
    per_job = stacked.groupBy("job_id").agg(*[F.sum(n).alias(n) for n in inputs])
    uneven = F.lit(False)
    for name in inputs:
        uneven = uneven | (F.col(name) != 1)
    bad = per_job.filter(uneven).orderBy("job_id").take(5)
    if bad:
        counts = {name: df.count() for name, df in inputs.items()}
        raise ValueError(f"jobs differ between inputs: row counts {counts}, first jobs {[r.job_id for r in bad]}")


def matrix_long(df: DataFrame, key: str, array: str, value: str = "value") -> DataFrame:
    """One row per cell of a matrix kept as arrays: ``key, position (from 1), value``."""
    return df.select(key, F.posexplode(array).alias("_at", value)).select(
        key, (F.col("_at") + 1).alias("position"), value
    )


def cell(array: Column, position: Column, what: Column) -> Column:
    """The 1-based cell of an array; a position outside it, or an empty cell, is an error."""
    inside = (position >= 1) & (position <= F.size(array))
    picked = F.get(array, position - 1)
    named = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return F.when(inside & picked.isNotNull(), picked).otherwise(
        F.raise_error(F.concat(F.lit("no value at position "), named(position), F.lit(" for "), named(what)))
    )


def matrix_lookup(requests: DataFrame, matrix: DataFrame, key: str, position: str, array: str, value: str):
    """Fetch one matrix cell per request row, joining on ``key``; an unknown key is an error."""
    what = F.concat(F.lit(f"{key} "), F.col(key).cast("string"))
    return requests.join(matrix.select(key, array), key, "left").select(
        *[F.col(c) for c in requests.columns], cell(F.col(array), F.col(position), what).alias(value)
    )


def operations_timeline(
    operations: DataFrame,
    job: str,
    order: list[str],
    setup: str,
    processing: str,
    start: str = CLOCK_START,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number each job's operations in ``order`` and stamp them.

    An operation starts when all earlier ones of its job are over; minutes are
    whole (fractions are cut off). Adds ``timestamp`` and ``task_id``.
    """
    spent = F.col(setup).cast("int").cast("bigint") + F.col(processing).cast("int").cast("bigint")
    numbered = running_totals(
        operations, order, sums={"_elapsed": spent}, number="_task", group=[job], hot_rows=hot_rows
    )
    return numbered.select(
        plus_minutes(moment(start), F.col("_elapsed")).alias("timestamp"),
        F.col("_task").cast("int").alias("task_id"),
        *operations.columns,
    )


def shop_floor(
    routes: DataFrame, process: DataFrame, setup: DataFrame, start: str = CLOCK_START, check: bool = True
) -> DataFrame:
    """Routes and two minute matrices to one row per operation.

    The three inputs meet on ``job_id`` before the routes are unrolled; the
    unrolled rows and the running sum then stay where that join put them.
    """
    if check:
        check_jobs(routes=routes, process=process, setup=setup)
    wide = routes.join(process.withColumnRenamed("minutes", "_process"), "job_id").join(
        setup.withColumnRenamed("minutes", "_setup"), "job_id"
    )
    visits = wide.select("job_id", "_process", "_setup", F.posexplode("route").alias("_at", "machine_id"))
    what = F.concat(F.lit("job "), F.col("job_id").cast("string"))
    operations = visits.select(
        "job_id",
        "_at",
        "machine_id",
        cell(F.col("_setup"), F.col("machine_id"), what).alias("setup_time"),
        cell(F.col("_process"), F.col("machine_id"), what).alias("processing_time"),
    )
    # A job's operations come from one route row, so no group outgrows a task.
    stamped = operations_timeline(
        operations, "job_id", ["_at"], "setup_time", "processing_time", start, hot_rows=None
    )
    return stamped.select("timestamp", "job_id", "task_id", "machine_id", "setup_time", "processing_time")


def with_row_clock(
    df: DataFrame,
    order: list[str],
    start: str = CLOCK_START,
    step_seconds: int = SENSOR_STEP_SECONDS,
    name: str = "timestamp",
) -> DataFrame:
    """Give the i-th row in ``order`` the time ``start + i * step``; gaps in the keys do not count."""
    numbered = running_totals(df, order, number="_row")
    stamp = moment(start) + seconds((F.col("_row") - 1) * step_seconds)
    return numbered.select(stamp.alias(name), *df.columns)


def clocked_sensors(raw: DataFrame) -> DataFrame:
    """Raw sensor rows with a clock and short column names."""
    return rename(with_row_clock(raw, ["UDI"]), SENSOR_NAMES)
