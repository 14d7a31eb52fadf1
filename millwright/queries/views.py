"""The given tables seen as sensor, operation and score tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millwright.functions.text import rounded

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_ORDER = ", ".join(LINE_KEY)

# Roles of the line-item columns in the feature queries.
LINE_ROLES = {
    "speed": "l_extendedprice",
    "torque": "l_quantity",
    "air": "l_discount",
    "process": "l_tax",
    "wear": "l_linenumber",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digits(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    """Round the listed columns, so that summation order does not show."""
    return df.withColumns({c: rounded(F.col(c), places) for c in columns})


def fused_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the layout of the fused table; a heavy load on an expensive part fails."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_discount").alias("air_temp_K"),
        F.col("l_tax").alias("proc_temp_K"),
        F.col("l_extendedprice").alias("rot_speed_rpm"),
        F.col("l_quantity").alias("torque_Nm"),
        F.col("l_suppkey").cast("double").alias("tool_wear_min"),
        F.col("l_linenumber").cast("double").alias("setup_time"),
        F.col("l_quantity").alias("processing_time"),
        F.col("l_linenumber").alias("machine_id"),
        (F.col("l_extendedprice") * F.col("l_quantity") > 4.0e6).cast("int").alias("machine_failure"),
    )


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored rows: was it returned, how sure was the quantity."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") / 50.0).alias("score"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
    )


LINE_SCORES = f"""
    SELECT {LINE_ORDER},
           CAST(l_returnflag = 'R' AS INT) AS label,
           l_quantity / 50.0 AS score,
           CAST(l_quantity > 25 AS INT) AS prediction
    FROM lineitem
"""


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows with many distinct scores: is it an error, how large is its value."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "value",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("value").alias("score"),
        (F.col("value") > 40).cast("int").alias("prediction"),
    )


EVENT_SCORES = """
    SELECT event_id, ts, value,
           CAST(event_type = 'error' AS INT) AS label,
           value AS score,
           CAST(value > 40 AS INT) AS prediction
    FROM events
"""


def q(expression: str, places: int = 6) -> str:
    """The SQL twin of ``rounded``."""
    return f"(round(CAST({expression} AS DOUBLE), {places}) + 0.0)"
