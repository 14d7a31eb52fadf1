"""Profiles that grow with the data: the state of each part of a table is stored and merged, not read again.

A part (a day, a file) leaves one row for each column, with counts, moments, ends and a quantile sketch, and one row for
each pair of columns, with Gram sums. Adding a part reads that part only; adding it again replaces it. Moments,
missing cells and correlations of the whole are exact; quartiles come from the merged sketches, and their exact
values from one pass over the rows in which the sketches' brackets leave few values to sort.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.columns import value_or_null
from millwright.operators.profile import QUARTILES, correlations_of, gram_sums
from millwright.operators.ranks import merged, slice_of, values_at_ranks
from millwright.session import stored

# Size of a quantile sketch, and the share of ranks to either side that a bracket reaches: several of its errors.
SKETCH = 2_000
REACH = 0.006


def part_moments(df: DataFrame, columns: list[str], part: str) -> DataFrame:
    """``part, column_name, rows, n, mean, m2, min, max, sketch``: one pass over the rows."""
    numbers = df.select(F.col(part).cast("string").alias("part"), *[value_or_null(df, c).alias(f"_{i}") for i, c in enumerate(columns)])
    cells = [
        F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("min"), F.max(x).alias("max"),
            F.kll_sketch_agg_double(x, F.lit(SKETCH)).alias("sketch"),
        ).alias(x)
        for name, x in ((c, f"_{i}") for i, c in enumerate(columns))
    ]
    return numbers.groupBy("part").agg(*cells).select("part", F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def add_parts(df: DataFrame, columns: list[str], part: str, folder: str) -> None:
    """Write the state of the parts in ``df``; other parts in the folder stay as they are.

    ``part`` is a column with the name of a row's part (not null). All sums are taken from the means of what came first, which are kept
    with the state, and the columns must be those of the first call.
    """
    spark, base = df.sparkSession, folder.rstrip("/")
    about = _read(spark, f"{base}/columns")
    if about is None:
        means = df.agg(*[F.avg(value_or_null(df, c)).alias(f"_{i}") for i, c in enumerate(columns)]).first()
        rows = [(i, c, means[f"_{i}"] or 0.0) for i, c in enumerate(columns)]
        about = spark.createDataFrame(rows, "at int, column_name string, shift double")
        about.write.parquet(f"{base}/columns")
    known = about.orderBy("at").collect()
    if [r.column_name for r in known] != list(columns):
        raise ValueError(f"the state in {folder} has the columns {[r.column_name for r in known]}")
    gram = gram_sums(df, columns, [r.shift for r in known], F.col(part))
    tables = {"moments": part_moments(df, columns, part), "gram": gram.groupBy("part", "i", "j").agg(*[F.sum(c).alias(c) for c in "nsqp"])}
    for name, table in tables.items():
        writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part").parquet(f"{base}/{name}")


def whole_moments(spark: SparkSession, folder: str) -> DataFrame:
    """``column_name, rows, n, mean, m2, min, max, sketch`` of all parts together."""
    parts = spark.read.parquet(f"{folder.rstrip('/')}/moments")
    means = parts.groupBy("column_name").agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("_mean"))
    # One row for each column.
    away = parts.join(F.broadcast(means), "column_name").withColumn("_away", F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2)
    return away.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum("_away").alias("m2"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("sketch"),
    )


def merged_summary(spark: SparkSession, folder: str, exact_from: DataFrame | None = None) -> DataFrame:
    """``column_name, count, missing_count, mean, std, min, p25, p50, p75, max`` of all parts.

    Quartiles are those of the merged sketches; with the rows themselves as ``exact_from`` they are exact.
    """
    whole = stored(whole_moments(spark, folder), "whole-moments")
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    base = whole.select(
        "column_name", F.col("n").alias("count"), (F.col("rows") - F.col("n")).alias("missing_count"), "mean", spread.alias("std"), "min", "max"
    )
    if exact_from is None:
        at = {p: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))) for p in QUARTILES}
        quartiles = whole.select("column_name", *[v.alias(f"p{int(p * 100)}") for p, v in at.items()])
    else:
        quartiles = exact_quartiles(exact_from, whole)
    return base.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", "count", "missing_count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def exact_quartiles(df: DataFrame, whole: DataFrame) -> DataFrame:
    """``column_name, p25, p50, p75``: one pass over the rows, between brackets from the merged sketches."""
    sides = [min(1.0, max(0.0, p + side * REACH)) for p in QUARTILES for side in (-1, 1)]
    ends = whole.filter("n > 0").select(
        "column_name", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(s)).alias(f"_{i}") for i, s in enumerate(sides)]
    ).collect()
    ranks, cells = {}, []
    for group, row in enumerate(ends):
        spots = [(row.n - 1) * p for p in QUARTILES]
        ranks[group] = sorted({int(f(s)) for s in spots for f in (math.floor, math.ceil)})
        value = value_or_null(df, row.column_name)
        brackets = [(F.lit(low), F.lit(high)) for low, high in merged([(row[f"_{2 * i}"], row[f"_{2 * i + 1}"]) for i in range(len(QUARTILES))])]
        cells.append(F.struct(F.lit(group).alias("group"), slice_of(value, brackets).alias("slice"), value.alias("value")))
    found = {}
    if cells:
        rows = df.select(F.inline(F.array(*cells))).filter("value is not null")
        found = values_at_ranks(rows, ranks, 2 * REACH * max(r.n for r in ends) * len(QUARTILES))
    out = []
    for group, row in enumerate(ends):
        values = []
        for p in QUARTILES:
            spot = (row.n - 1) * p
            low, high = found[group][math.floor(spot)], found[group][math.ceil(spot)]
            values.append(low + (high - low) * (spot - math.floor(spot)))
        out.append((row.column_name, *values))
    return df.sparkSession.createDataFrame(out, "column_name string, p25 double, p50 double, p75 double")


def merged_correlations(spark: SparkSession, folder: str) -> DataFrame:
    """``column_a, column_b, correlation`` of all parts."""
    base = folder.rstrip("/")
    columns = [r.column_name for r in spark.read.parquet(f"{base}/columns").orderBy("at").collect()]
    gram = spark.read.parquet(f"{base}/gram").groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "nsqp"])
    return correlations_of(gram, columns)
