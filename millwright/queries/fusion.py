"""As-of joins, scans by time, stored tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.clock import TOLERANCE_MINUTES, minutes, moment
from millwright.functions.columns import present, project, rename, without
from millwright.operators.asof import asof_join
from millwright.operators.timeline import with_row_clock
from millwright.plans.fusion import fuse
from millwright.queries.timeline import ORACLES as TIMELINE_SQL, flatten_timeline
from millwright.queries.views import table
from millwright.session import fresh_path
from millwright.sources.files import read_csv, write_csv
from millwright.sources.tables import latest_rows, range_or_latest, read_table, replace_table, scan_range

TOLERANCE = timedelta(minutes=TOLERANCE_MINUTES)


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'error'")
        .select("event_id", "ts", "user_id", "value")
    )


def _others(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter("event_type <> 'error'")
        .select(
            "ts",
            F.col("event_id").alias("job_id"),
            F.col("event_type").alias("task_id"),
            F.col("value").alias("machine_value"),
        )
    )


def asof_inner_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events with the latest other event of the three minutes before."""
    matched = asof_join(_errors(spark, sf_dir), _others(spark, sf_dir), "ts", TOLERANCE, "left", ["job_id"])
    return present(matched, ["job_id", "task_id"])


def asof_left_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(
        _errors(spark, sf_dir), _others(spark, sf_dir), "ts", TOLERANCE, "left", ["job_id"], keep_right_time="match_ts"
    )


def asof_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right times cut to the hour: many rows share one moment, the largest id wins."""
    hourly = _others(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return asof_join(_errors(spark, sf_dir), hourly, "ts", timedelta(minutes=60), "inner", ["job_id"])


def asof_exact_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right times exactly one tolerance before the left ones, and a microsecond earlier."""
    lag = minutes(TOLERANCE_MINUTES)
    errors = _errors(spark, sf_dir)
    right = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.col("ts") - lag)
        .otherwise(F.col("ts") - lag - F.expr("INTERVAL '0.000001' SECOND"))
        .alias("ts"),
        F.col("event_id").alias("job_id"),
    )
    return asof_join(errors, right, "ts", TOLERANCE, "left", ["job_id"], keep_right_time="match_ts")


_ASOF = """
    SELECT l.event_id, l.ts, l.user_id, l.value{columns}
    FROM (SELECT * FROM events WHERE event_type = 'error') l
    ASOF {how} JOIN ({right}) r ON l.ts >= r.ts
    {where}
"""
_OTHERS = """SELECT ts, event_id AS job_id, event_type AS task_id, value AS machine_value
             FROM events WHERE event_type <> 'error'"""
_WITHIN = "l.ts - r.ts <= INTERVAL 3 MINUTE"


def _july(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No event lies in July 2024, so the 1000 latest rows come back."""
    return range_or_latest(
        table(spark, sf_dir, "events"),
        moment("2024-07-01 00:00:00"),
        moment("2024-07-15 00:00:00"),
        1000,
        "ts",
        ["event_id"],
    ).select("event_id", "ts", "event_type", "value")


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_or_latest(
        table(spark, sf_dir, "events"),
        moment("2024-01-05 00:00:00"),
        moment("2024-01-15 00:00:00"),
        1000,
        "ts",
        ["event_id"],
    ).select("event_id", "ts", "event_type", "value")


def range_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both bounds are order dates themselves and stay inside."""
    return scan_range(
        table(spark, sf_dir, "orders"),
        moment("1996-01-01 00:00:00"),
        moment("1996-01-31 00:00:00"),
        "o_orderdate",
        ["o_orderkey"],
    ).select("o_orderkey", "o_orderdate", "o_totalprice")


def top_n_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(table(spark, sf_dir, "events"), 1000, "ts", ["event_id"])


def ordered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order in time order."""
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate", "o_orderstatus")
        .orderBy("o_orderdate", "o_orderkey")
    )


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ten-row preview in a fixed order."""
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(10)


def table_replace_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, overwrite and read back a table; the observed row count is the table's own."""
    path = fresh_path(spark, "orders")
    orders = rename(table(spark, sf_dir, "orders"), {"o_orderdate": "ts"})
    replace_table(orders.select("o_orderkey", "ts"), path)
    written = replace_table(orders, path)
    return read_table(spark, path).withColumn("rows_written", F.lit(written).cast("bigint"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV with a header and timestamps, written and read back by schema."""
    orders = table(spark, sf_dir, "orders")
    return read_csv(spark, write_csv(orders, fresh_path(spark, "orders-csv")), orders.schema)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as CSV, read back with inferred types."""
    parts = table(spark, sf_dir, "part")
    return read_csv(spark, write_csv(parts, fresh_path(spark, "part-csv"))).select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )


def fused_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: customers on a clock meet the operations of all orders, stored as a table.

    Every order starts at the same instant, so most operations share few moments.
    """
    sensors = with_row_clock(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_custkey"])
    path = fresh_path(spark, "fused")
    replace_table(fuse(sensors, flatten_timeline(spark, sf_dir), TOLERANCE_MINUTES), path)
    return read_table(spark, path)


def rename_project_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rename(
        table(spark, sf_dir, "lineitem"), {"l_quantity": "torque_Nm", "l_extendedprice": "rot_speed_rpm"}
    )
    return without(
        project(lines, ["l_orderkey", "l_linenumber", "torque_Nm", "rot_speed_rpm", "l_returnflag"]), "l_returnflag"
    )


def null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that keep both ids after some of them are blanked."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("job_id"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("task_id"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
    )
    return present(lines, ["job_id", "task_id"])


QUERIES = {
    "asof_inner_tolerance": asof_inner_tolerance,
    "asof_left_tolerance": asof_left_tolerance,
    "asof_ties": asof_ties,
    "asof_exact_boundary": asof_exact_boundary,
    "range_scan": range_scan,
    "range_edges": range_edges,
    "last_n_fallback": _july,
    "top_n_desc": top_n_desc,
    "ordered_scan": ordered_scan,
    "head_rows": head_rows,
    "table_replace_roundtrip": table_replace_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "csv_inferred": csv_inferred,
    "fused_timeline": fused_timeline,
    "rename_project_drop": rename_project_drop,
    "null_filter": null_filter,
}

_LATEST = """
    SELECT {columns} FROM (
        SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS place FROM events
    ) WHERE place <= 1000 ORDER BY ts, event_id
"""

ORACLES = {
    "asof_inner_tolerance": _ASOF.format(
        columns=", r.job_id, r.task_id, r.machine_value", how="", right=_OTHERS, where=f"WHERE {_WITHIN}"
    ),
    "asof_left_tolerance": _ASOF.format(
        columns=f""",
           CASE WHEN {_WITHIN} THEN r.job_id END AS job_id,
           CASE WHEN {_WITHIN} THEN r.task_id END AS task_id,
           CASE WHEN {_WITHIN} THEN r.machine_value END AS machine_value,
           CASE WHEN {_WITHIN} THEN r.ts END AS match_ts""",
        how="LEFT",
        right=_OTHERS,
        where="",
    ),
    "asof_ties": _ASOF.format(
        columns=", r.job_id, r.task_id, r.machine_value",
        how="",
        right="""SELECT date_trunc('hour', ts) AS ts, max(event_id) AS job_id,
                        arg_max(event_type, event_id) AS task_id, arg_max(value, event_id) AS machine_value
                 FROM events WHERE event_type <> 'error' GROUP BY 1""",
        where="WHERE l.ts - r.ts <= INTERVAL 60 MINUTE",
    ),
    "asof_exact_boundary": _ASOF.format(
        columns=f""",
           CASE WHEN {_WITHIN} THEN r.job_id END AS job_id,
           CASE WHEN {_WITHIN} THEN r.ts END AS match_ts""",
        how="LEFT",
        right="""SELECT CASE WHEN event_type = 'error' THEN ts - INTERVAL 3 MINUTE
                             ELSE ts - INTERVAL 3 MINUTE - INTERVAL 1 MICROSECOND END AS ts,
                        max(event_id) AS job_id
                 FROM events GROUP BY 1""",
        where="",
    ),
    "range_scan": """
        SELECT event_id, ts, event_type, value FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'
        ORDER BY ts, event_id
    """,
    "range_edges": """
        SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-01-31 00:00:00'
        ORDER BY o_orderdate, o_orderkey
    """,
    "last_n_fallback": _LATEST.format(columns="event_id, ts, event_type, value"),
    "top_n_desc": _LATEST.format(columns="event_id, ts, user_id, event_type, value, props"),
    "ordered_scan": "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders ORDER BY o_orderdate, o_orderkey",
    "head_rows": "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10",
    "table_replace_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS "timestamp", o_orderpriority,
               (SELECT count(*) FROM orders) AS rows_written
        FROM orders
    """,
    "csv_roundtrip": "SELECT * FROM orders",
    "csv_inferred": "SELECT * FROM part",
    "fused_timeline": f"""
        WITH operations AS ({TIMELINE_SQL["flatten_timeline"]}),
        last_of_moment AS (
            SELECT "timestamp" AS ts, job_id, task_id, machine_id, setup_time, processing_time FROM (
                SELECT *, row_number() OVER (PARTITION BY "timestamp" ORDER BY job_id DESC, task_id DESC) AS place
                FROM operations
            ) WHERE place = 1
        ),
        sensors AS ({TIMELINE_SQL["row_clock"].replace("c_name", "c_acctbal")})
        SELECT l."timestamp", l.c_custkey, l.c_acctbal, r.job_id, r.task_id, r.machine_id, r.setup_time, r.processing_time
        FROM sensors l ASOF JOIN last_of_moment r ON l."timestamp" >= r.ts
        WHERE l."timestamp" - r.ts <= INTERVAL 3 MINUTE
    """,
    "rename_project_drop": """
        SELECT l_orderkey, l_linenumber, l_quantity AS "torque_Nm", l_extendedprice AS rot_speed_rpm FROM lineitem
    """,
    "null_filter": """
        SELECT l_linenumber AS job_id, l_returnflag AS task_id, l_orderkey, l_partkey, l_suppkey FROM lineitem
        WHERE nullif(l_linenumber, 3) IS NOT NULL AND nullif(l_returnflag, 'A') IS NOT NULL
    """,
}
