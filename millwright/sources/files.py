"""Text and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from millwright.functions.text import digit_cells, number_cells

NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("UDI", T.IntegerType()),
        T.StructField("Product ID", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Air temperature [K]", T.DoubleType()),
        T.StructField("Process temperature [K]", T.DoubleType()),
        T.StructField("Rotational speed [rpm]", T.DoubleType()),
        T.StructField("Torque [Nm]", T.DoubleType()),
        T.StructField("Tool wear [min]", T.DoubleType()),
        T.StructField("Machine failure", T.IntegerType()),
        T.StructField("TWF", T.IntegerType()),
        T.StructField("HDF", T.IntegerType()),
        T.StructField("PWF", T.IntegerType()),
        T.StructField("OSF", T.IntegerType()),
        T.StructField("RNF", T.IntegerType()),
    ]
)

OPERATION_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType())]
    + [
        T.StructField(name, T.IntegerType())
        for name in ("job_id", "task_id", "machine_id", "setup_time", "processing_time")
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, mode: str = "FAILFAST") -> DataFrame:
    """A CSV with a header. Without a schema the types are inferred (one more pass).

    A cell that does not fit its type is an error, unless another of the reader's modes is asked for.
    """
    reader = spark.read.option("header", True).option("mode", mode).option("timestampNTZFormat", NTZ_FORMAT)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Write a table as CSV part files with a header each."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )
    return path


def numbered_lines(spark: SparkSession, path: str, skip_blank: bool = False) -> DataFrame:
    """Lines with their 1-based number, in file order: ``line_no, value``.

    Every file split numbers its own lines; a table with one row per split adds
    the lines of the splits before it. Files of a folder follow in path order.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    if skip_blank:
        lines = lines.filter(F.trim("value") != "")
    lines = lines.withColumn("_id", F.monotonically_increasing_id())
    splits = lines.groupBy("_path", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    earlier = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_path", "_block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")
    )
    return lines.join(starts, ["_path", "_block"]).select(
        (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value"
    )


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """One job per line, machine ids in visiting order; a blank line is an empty route."""
    return numbered_lines(spark, path).select(
        F.col("line_no").cast("int").alias("job_id"), digit_cells(F.col("value")).alias("route")
    )


def read_minutes(spark: SparkSession, path: str) -> DataFrame:
    """A headerless matrix: line = job, cell = minutes on the machine of that position."""
    return numbered_lines(spark, path, skip_blank=True).select(
        F.col("line_no").cast("int").alias("job_id"), number_cells(F.col("value")).alias("minutes")
    )
