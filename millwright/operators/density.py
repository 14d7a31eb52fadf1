"""Distributions: equal-width histograms and Gaussian kernel densities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millwright.functions.columns import value_or_null

# Bins of a histogram, points of a density curve.
HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
# Terms of the Hermite series of a box.
TERMS = 20


def _spans(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Count, min, max and sample deviation per column: a handful of numbers on the driver."""
    numbers = df.select(*[value_or_null(df, name).alias(f"_{i}") for i, name in enumerate(columns)])
    row = numbers.agg(
        *[
            F.struct(
                F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.stddev_samp(v).alias("std")
            ).alias(v)
            for v in numbers.columns
        ]
    ).first()
    return {name: row[f"_{i}"].asDict() for i, name in enumerate(columns)}


def histogram(df: DataFrame, columns: list[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``column_name, bin, bin_low, bin_high, rows`` with empty bins kept out.

    Bins are equally wide between min and max, and the max belongs to the last
    one. A constant column fills bin 0 alone. Missing cells are left out.
    """
    spans = {name: span for name, span in _spans(df, columns).items() if span["n"]}
    if not spans:
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, bin_low double, bin_high double, rows bigint"
        )
    cells, low, width = [], F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, span in spans.items():
        x = F.col(f"`{name}`")
        extent = span["high"] - span["low"]
        if extent > 0:
            spot = F.floor((x - F.lit(span["low"])) / F.lit(extent) * F.lit(float(bins))).cast("int")
        else:
            spot = F.lit(0)
        # ``least`` skips nulls: without the guard a missing cell would fill the last bin.
        spot = F.when(x.isNotNull(), F.least(spot, F.lit(bins - 1)))
        cells.append(F.struct(F.lit(name).alias("column_name"), spot.alias("bin")))
        mine = F.col("column_name") == name
        low = F.when(mine, F.lit(span["low"])).otherwise(low)
        width = F.when(mine, F.lit(extent / bins)).otherwise(width)
    numbers = df.select(*[value_or_null(df, name).alias(name) for name in spans])
    counts = (
        numbers.select(F.inline(F.array(*cells)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counts.select(
        "column_name",
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        "rows",
    )


def _powers(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``p1 .. p19``, the powers of a column, each one product."""
    out = rows.withColumn("p1", F.col(value))
    known = 1
    while known < TERMS - 1:
        more = min(known, TERMS - 1 - known)
        out = out.withColumns({f"p{known + i}": F.col(f"p{known}") * F.col(f"p{i}") for i in range(1, more + 1)})
        known += more
    return out


def kernel_densities(
    df: DataFrame, columns: list[str], points: int = DENSITY_POINTS, histogram_bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """``column_name, point, x, density, scaled``: Gaussian kernel densities over even grids from min to max.

    The bandwidth is the sample deviation times ``n ** -0.2``; ``scaled`` is the density in rows per
    histogram bin. Constant and empty columns have no density.

    A fast Gauss transform: each row falls into a box one bandwidth wide, and one aggregate adds up, for all
    columns and boxes at once, the powers of the distances to the box centres. A box then acts on the grid by its
    Hermite series, cut after ``TERMS`` terms. A row is half a bandwidth from its centre at most, so its share is
    exact to 1e-15 of the kernel's peak. Two passes over the rows, whatever the number of columns.
    """
    spans = {name: span for name, span in _spans(df, columns).items() if span["n"] and span["std"]}
    schema = "column_name string, point int, x double, density double, scaled double"
    if not spans:
        return df.sparkSession.createDataFrame([], schema)
    names = list(spans)
    low = [spans[n]["low"] for n in names]
    width = [spans[n]["std"] * spans[n]["n"] ** -0.2 for n in names]
    step = [(spans[n]["high"] - spans[n]["low"]) / (points - 1) for n in names]
    cells = [
        F.struct(F.lit(i).alias("of"), ((value_or_null(df, name) - F.lit(low[i])) / F.lit(width[i])).alias("z"))
        for i, name in enumerate(names)
    ]
    boxed = df.select(F.inline(F.array(*cells))).filter("z is not null").withColumn("box", F.floor("z"))
    distances = _powers(boxed.select("of", "box", (F.col("z") - F.col("box") - 0.5).alias("t")), "t")
    sums = [F.count(F.lit(1)).cast("double").alias("s0"), *[F.sum(f"p{k}").alias(f"s{k}") for k in range(1, TERMS)]]
    boxes = distances.groupBy("of", "box").agg(*sums)

    def series(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            of = batch["of"].to_numpy()
            grid = np.arange(points) * (np.array(step) / np.array(width))[of][:, None]
            u = grid - (batch["box"].to_numpy() + 0.5)[:, None]
            before, now = np.zeros_like(u), np.exp(-0.5 * u * u)
            total, factor = now * batch["s0"].to_numpy()[:, None], 1.0
            for k in range(1, TERMS):
                # He_k(u) = u He_(k-1)(u) - (k - 1) He_(k-2)(u), each times the kernel.
                before, now = now, u * now - (k - 1) * before
                factor /= k
                total += now * (factor * batch[f"s{k}"].to_numpy())[:, None]
            for i in np.unique(of).tolist():
                yield pd.DataFrame({"of": i, "point": np.arange(points, dtype="int32"), "total": total[of == i].sum(axis=0)})

    summed = boxes.mapInPandas(series, "of int, point int, total double").groupBy("of", "point").agg(F.sum("total").alias("total"))
    about = [
        (i, n, low[i], step[i], spans[n]["n"] * width[i] * float(np.sqrt(2 * np.pi)), spans[n]["n"] * (spans[n]["high"] - low[i]) / histogram_bins)
        for i, n in enumerate(names)
    ]
    # One row for each column.
    constants = df.sparkSession.createDataFrame(about, "of int, column_name string, low double, step double, mass double, scale double")
    density = F.col("total") / F.col("mass")
    return summed.join(F.broadcast(constants), "of").select(
        "column_name", "point", (F.col("low") + F.col("point") * F.col("step")).alias("x"), density.alias("density"),
        (density * F.col("scale")).alias("scaled"),
    )


def kernel_density(
    df: DataFrame, column: str, points: int = DENSITY_POINTS, histogram_bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """``point, x, density, scaled`` of one column."""
    return kernel_densities(df, [column], points, histogram_bins).drop("column_name")
