"""Table profile: summary numbers, missing cells, correlations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions.columns import missing, value_or_null
from millwright.operators.ranks import percentiles

# The quartiles of a summary.
QUARTILES = [0.25, 0.5, 0.75]
# A sum of squares below this share of the uncentred one is that of a constant.
CONSTANT = 1e-12
# Parts whose sums a task holds at a time.
MOST_PARTS = 64
STATISTICS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def _moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, max. One pass."""
    numbers = df.select(*[value_or_null(df, name).alias(f"_{i}") for i, name in enumerate(columns)])
    cells = numbers.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(f"_{i}").alias("count"),
                F.avg(f"_{i}").alias("mean"),
                F.stddev_samp(f"_{i}").alias("std"),
                F.min(f"_{i}").alias("min"),
                F.max(f"_{i}").alias("max"),
            ).alias(f"_{i}")
            for i, name in enumerate(columns)
        ]
    )
    return cells.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))


def summary(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """``column_name, count, mean, std, min, p25, p50, p75, max`` per numeric column.

    Quartiles are exact and interpolated; ``approximate`` takes them from a
    sketch in the same pass instead.
    """
    base = _moments(df, columns)
    if approximate:
        row = df.agg(
            *[F.percentile_approx(value_or_null(df, c), QUARTILES).alias(c) for c in columns]
        )
        found = row.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"),
                            *[F.get(f"`{c}`", i).alias(f"p{int(p * 100)}") for i, p in enumerate(QUARTILES)],
                        )
                        for c in columns
                    ]
                )
            )
        )
    else:
        found = (
            percentiles(df, columns, QUARTILES)
            .groupBy("column_name")
            .agg(*[F.max(F.when(F.col("share") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES])
        )
    return base.join(found, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """``column_name, missing_count`` for every column, in one pass."""
    sums = [
        F.sum(missing(df, name).cast("bigint")).alias(f"_{i}") for i, name in enumerate(df.columns)
    ]
    cells = [
        F.struct(F.lit(name).alias("column_name"), F.coalesce(F.col(f"_{i}"), F.lit(0).cast("bigint")).alias("missing_count"))
        for i, name in enumerate(df.columns)
    ]
    return df.agg(*sums).select(F.inline(F.array(*cells)))


def only_missing(counts: DataFrame) -> DataFrame:
    """The columns that miss at least one cell."""
    return counts.filter("missing_count > 0")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_a, column_b, correlation`` for all ordered pairs, each over its complete rows.

    Masked Gram matrices: with gaps as zeros, the products of the values, of their squares and of the masks give
    every pair its sums over the rows complete in both. They are added up batch by batch where the rows lie, and
    one row for each column leaves a task. Values are taken from the column's mean, found in a first pass.
    The diagonal is 1, or null for a constant column, as is any pair with a constant.
    Fewer than two columns give an empty table.
    """
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    numbers = df.select(*[value_or_null(df, name).alias(f"_{i}") for i, name in enumerate(columns)])
    middle = numbers.agg(*[F.avg(c).alias(c) for c in numbers.columns]).first()
    sums = gram_sums(df, columns, [middle[c] or 0.0 for c in numbers.columns])
    return correlations_of(sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "nsqp"]), columns)


def gram_sums(df: DataFrame, columns: list[str], shift: list[float], part: Column | None = None) -> DataFrame:
    """``part, i, j, n, s, q, p``: sums over the rows complete in columns i and j, of every part, as each task finds them.

    ``n`` counts rows; ``s``, ``q`` and ``p`` add up x, its square and the product of both, taken from ``shift``.
    """
    size, middle = len(columns), np.array(shift)
    cells_of = [value_or_null(df, name).alias(f"_{i}") for i, name in enumerate(columns)]
    numbers = df.select((F.lit("") if part is None else part.cast("string")).alias("part"), *cells_of)

    def of(sums: dict) -> pa.RecordBatch:
        names = [name for name in sums for _ in range(size)]
        columns_of = [pa.array([row for s in sums.values() for row in s[k]], pa.list_(pa.float64())) for k in range(4)]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(list(range(size)) * len(sums), pa.int32()), *columns_of], ["part", "i", "n", "s", "q", "p"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]], axis=1)
            codes = batch.column(0).dictionary_encode()
            own = codes.indices.fill_null(len(codes.dictionary)).to_numpy()
            for code, name in enumerate([*codes.dictionary.to_pylist(), None]):
                rows = cells if len(codes.dictionary) == 1 and code == 0 and not codes.null_count else cells[own == code]
                if not len(rows):
                    continue
                there = ~np.isnan(rows)
                x = np.where(there, rows - middle, 0.0)
                mask = there.astype(float)
                sums[name] = sums.get(name, 0) + np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
            if len(sums) > MOST_PARTS:
                yield of(sums)
                sums = {}
        if sums:
            yield of(sums)

    kind = "part string, i int, n array<double>, s array<double>, q array<double>, p array<double>"
    return numbers.mapInArrow(run, kind).select(
        "part", "i", F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("j", "_sums")
    ).select("part", "i", "j", "_sums.*")


def correlations_of(gram: DataFrame, columns: list[str]) -> DataFrame:
    """``column_a, column_b, correlation`` from the sums ``i, j, n, s, q, p`` of every ordered pair."""
    # Sums of one column over the rows that the other one has, too; one row for each pair of columns.
    other = gram.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    spread_of = lambda s, q: F.when(F.col(q) - F.col(s) * F.col(s) / F.col("n") > CONSTANT * F.col(q), F.col(q) - F.col(s) * F.col(s) / F.col("n"))
    both = F.sqrt(spread_of("s", "q")) * F.sqrt(spread_of("s2", "q2"))
    r = F.when(F.col("i") == F.col("j"), F.when(both.isNotNull(), F.lit(1.0))).otherwise((F.col("p") - F.col("s") * F.col("s2") / F.col("n")) / both)
    names = F.array(*[F.lit(c) for c in columns])
    return gram.join(other, ["i", "j"]).select(
        F.get(names, F.col("i")).alias("column_a"), F.get(names, F.col("j")).alias("column_b"),
        F.when(F.col("n") > 0, r).alias("correlation"),
    )
