"""From raw files to the fused table: one lazy chain, one write."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from millwright.functions.clock import TOLERANCE_MINUTES
from millwright.functions.columns import present, rename
from millwright.operators.asof import asof_join
from millwright.operators.timeline import clocked_sensors, shop_floor
from millwright.sources.files import SENSOR_SCHEMA, read_csv, read_minutes, read_routes
from millwright.sources.tables import replace_table


def fuse(sensors: DataFrame, operations: DataFrame, tolerance_minutes: int = TOLERANCE_MINUTES) -> DataFrame:
    """Sensor rows with the last operation started within the tolerance; others are left out.

    Both inputs carry ``timestamp``; the result carries ``ts``. Among operations
    of one moment the last by job and task is taken.
    """
    matched = asof_join(
        rename(sensors, {"timestamp": "ts"}),
        rename(operations, {"timestamp": "ts"}),
        "ts",
        timedelta(minutes=tolerance_minutes),
        "inner",
        last_by=["job_id", "task_id"],
    )
    return present(matched, ["job_id", "task_id"])


def fuse_files(
    spark: SparkSession,
    routes: str,
    process_times: str,
    setup_times: str,
    sensors: str,
    tolerance_minutes: int = TOLERANCE_MINUTES,
) -> DataFrame:
    """Read the four files and fuse them."""
    operations = shop_floor(
        read_routes(spark, routes), read_minutes(spark, process_times), read_minutes(spark, setup_times)
    )
    return fuse(clocked_sensors(read_csv(spark, sensors, SENSOR_SCHEMA)), operations, tolerance_minutes)


def build_table(spark: SparkSession, target: str, partition_by_day: bool = False, **files) -> int:
    """Fuse the files into a new version of the table at ``target``; returns its rows."""
    return replace_table(fuse_files(spark, **files), target, partition_by_day=partition_by_day, versioned=True)
