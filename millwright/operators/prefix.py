"""Row numbers and running totals over a total order, without a one-task window.

Rows are cut into ranges of the order column, each range gets its own window,
and the (small) table of range totals supplies what came before. The cut points
decide only how evenly the work spreads, never the result.
"""

from __future__ import annotations

import os
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millwright.functions.clock import order_value
from millwright.session import stored

# A group above this many rows is cut into ranges instead of going to one task.
HOT_ROWS = 1_000_000
# Doubles tell whole numbers apart up to here; beyond it ties are not cut further.
EXACT_DOUBLE = 2.0**53
# Heavy keys whose marks are broadcast; with more of them the planner chooses the join.
MOST_MARKS = 100_000
# Tasks that merge the quantile sketches of the input splits.
SKETCHES = 64

INFINITY = float("inf")


def range_count(spark: SparkSession) -> int:
    """How many ranges to cut: a few per shuffle partition, so that hashing them evens out."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(8192, 4 * partitions))


def sketch(df: DataFrame, columns: list[str], shares: list[float], resolution: int) -> dict[str, tuple[list[float], int]]:
    """Approximate quantiles and exact counts of double columns, ``{column: (values, rows)}``.

    Input splits are summarised in ``SKETCHES`` groups, so no single task merges
    all of them; groups x resolution numbers per column meet on the driver.
    """
    # One text constant: thousands of literals would make a slow plan.
    text = ",".join(repr(i / resolution) for i in range(resolution + 1))
    fine = F.split(F.lit(text), ",").cast("array<double>")
    names = {c: f"_{i}" for i, c in enumerate(columns)}
    rows = (
        df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("_part"))
        .agg(
            *[
                F.struct(
                    F.percentile_approx(f"`{c}`", fine, 2 * resolution).alias("at"),
                    F.count(f"`{c}`").alias("n"),
                ).alias(n)
                for c, n in names.items()
            ]
        )
        .collect()
    )
    found = {}
    for column, name in names.items():
        parts = [row[name] for row in rows if row[name].n]
        if not parts:
            found[column] = ([], 0)
            continue
        values = np.concatenate([p["at"] for p in parts])
        weights = np.concatenate([np.full(len(p["at"]), p.n / len(p["at"])) for p in parts])
        order = np.argsort(values, kind="stable")
        passed = np.cumsum(weights[order])
        spots = np.searchsorted(passed, np.array(shares) * passed[-1]).clip(0, len(values) - 1)
        found[column] = (values[order][spots].tolist(), sum(p.n for p in parts))
    return found


def shared_beginning(df: DataFrame, column: str) -> str:
    """What all values of a text column begin with; empty for other types."""
    if dict(df.dtypes)[column] != "string":
        return ""
    ends = df.agg(F.min(f"`{column}`").alias("low"), F.max(f"`{column}`").alias("high")).first()
    return os.path.commonprefix([ends.low or "", ends.high or ""])


def spread_value(df: DataFrame, column: str, shared: str = "") -> Column:
    """The order value of a column, with NaN as null."""
    value = order_value(F.col(f"`{column}`"), dict(df.dtypes)[column], shared)
    return F.when(~F.isnan(value), value)


def cut_points(df: DataFrame, column: str, ranges: int, shared: str = "") -> tuple[list[float], dict[float, int]]:
    """Quantiles of ``column`` as doubles, and how many ranges the repeated ones fill.

    Different texts or decimals may share a double: ``truly_repeated`` tells which stand for one value.
    """
    shares = [i / ranges for i in range(1, ranges)]
    raw, _ = sketch(df.select(spread_value(df, column, shared).alias("v")), ["v"], shares, ranges)["v"]
    points = sorted({p for p in raw if abs(p) != INFINITY})
    return points, {v: n for v, n in Counter(raw).items() if n > 1 and abs(v) < EXACT_DOUBLE}


def _splits(points: list[float]) -> list[float]:
    return [-INFINITY, *(points or [0.0]), INFINITY]


def most_ranges(points: list[float]) -> int:
    """One more than the largest range number: the ranges, then NaN, then null."""
    return len(_splits(points)) + 1


def with_cut(df: DataFrame, column: str, points: list[float], name: str, shared: str = "") -> DataFrame:
    """Add the index of the range a row falls into. Equal values share a range; null is last."""
    kind = dict(df.dtypes)[column]
    probe = f"{name}_probe"
    cutter = Bucketizer(splits=_splits(points), inputCol=probe, outputCol=name, handleInvalid="keep")
    spread = df.withColumn(probe, order_value(F.col(f"`{column}`"), kind, shared))
    number = F.coalesce(F.col(name).cast("bigint"), F.lit(most_ranges(points) - 1).cast("bigint"))
    return cutter.transform(spread).withColumn(name, number).drop(probe)


def truly_repeated(df: DataFrame, column: str, values: list[float], shared: str) -> list[float]:
    """Those order values behind which only one value of the column stands (different texts may share one)."""
    number = spread_value(df, column, shared)
    ends = (
        df.select(number.alias("v"), F.col(f"`{column}`").alias("c")).filter(F.col("v").isin(values))
        .groupBy("v").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low = high")
    )
    return [r.v for r in ends.collect()]


def with_ranges(
    df: DataFrame,
    order: list[str],
    name: str,
    sample_from: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add a range number that grows with ``order``.

    A value of the first column that fills several ranges on its own, null included, is cut again along the
    next one, and so on, so no repeated value or combination of values can overload a task.
    """
    base = df if sample_from is None else sample_from
    return _cut_by(df, order, name, base, ranges or range_count(df.sparkSession))[0]


def _cut_by(df: DataFrame, order: list[str], name: str, base: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """``with_ranges``, and a bound above the largest number."""
    first, rest = order[0], order[1:]
    shared = shared_beginning(base, first)
    points, repeated = cut_points(base, first, ranges, shared)
    cut = with_cut(df, first, points, name, shared)
    if not rest or not set(rest) <= set(base.columns):
        return cut, most_ranges(points)
    value = F.col(f"`{first}`")
    filled = sum(repeated.values())
    again = F.lit(False)
    if repeated:
        again = F.coalesce(spread_value(df, first, shared).isin(truly_repeated(base, first, list(repeated), shared)), F.lit(False))
    total, none = base.agg(F.count(F.lit(1)), F.count_if(value.isNull())).first()
    # Nulls have a range of their own, the last one.
    if none * ranges > 2 * total:
        again, filled = again | value.isNull(), filled + none * ranges // total
    if not filled:
        return cut, most_ranges(points)
    # Inside a repeated value the next columns decide. It is a cut point, hence the lowest of its range: it goes first.
    inner, most = _cut_by(cut, rest, f"{name}_next", base.filter(again), max(2, filled))
    place = F.when(again, F.col(f"{name}_next")).otherwise(F.lit(most))
    return inner.withColumn(name, F.col(name) * (most + 1) + place).drop(f"{name}_next"), most_ranges(points) * (most + 1)


def _ordering(order: list[str]) -> list[Column]:
    return [F.asc_nulls_last(F.col(f"`{name}`")) for name in order]


def _plain(df: DataFrame, order: list[str], sums: dict[str, Column], number: str | None, group):
    before = (
        Window.partitionBy(*group).orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    added = {name: F.sum(value).over(before) for name, value in sums.items()}
    out = df.withColumns(added) if added else df
    if number:
        out = out.withColumn(number, F.row_number().over(Window.partitionBy(*group).orderBy(*_ordering(order))).cast("bigint"))
    return out


def running_totals(
    df: DataFrame,
    order: list[str],
    sums: dict[str, Column] | None = None,
    number: str | None = None,
    group: list[str] | None = None,
    totals: bool = False,
    sample_from: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add running sums of the rows before each row, and 1-based row numbers.

    ``sums`` maps new column names to the summed expressions; ``number`` names
    the row number. With ``group`` both restart in every group; only groups of
    more than ``hot_rows`` rows are cut into ranges (None: the caller knows that
    every group is small). Without it the whole input is one group, always cut. ``totals`` adds ``<name>_total`` (whole-input
    form only). ``order`` (nulls last) must be unique within a group for a
    repeatable row number.
    """
    sums = dict(sums or {})
    group = list(group or [])
    if not group:
        return _ranged(df, order, sums, number, [], totals, sample_from)
    if hot_rows is None:
        return _zero_first(_plain(df, order, sums, number, group), sums)
    heavy = stored(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*group), "heavy")
    keys = heavy.count()
    if keys == 0:
        return _zero_first(_plain(df, order, sums, number, group), sums)
    base = stored(df, "totals")
    marks = heavy.select(*[F.col(f"`{c}`").alias(f"_of_{i}") for i, c in enumerate(group)], F.lit(True).alias("_heavy"))
    # Null keys are groups as well.
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(group)])
    marked = base.join(F.broadcast(marks) if keys <= MOST_MARKS else marks, same, "left")
    light = marked.filter(F.col("_heavy").isNull()).select(*df.columns)
    hot = marked.filter("_heavy").select(*df.columns)
    done = _ranged(hot, order, sums, number, group, False, None)
    return _zero_first(_plain(light, order, sums, number, group), sums).unionByName(done)


def _zero_first(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    return df.withColumns({n: F.coalesce(n, F.lit(0).cast(dict(df.dtypes)[n])) for n in sums}) if sums else df


def _ranged(df, order, sums, number, group, totals, sample_from) -> DataFrame:
    # Written once: cutting, totals and windows read it, each only what it needs.
    values = {f"_value_{i}": v for i, v in enumerate(sums.values())}
    base = stored(df.withColumns(values) if values else df, "ranges")
    sums = {n: F.col(v) for n, v in zip(sums, values)}
    cut = with_ranges(base, order, "_range", sample_from)
    keys = [*group, "_range"]
    local = _plain(cut, order, sums, number, keys)

    parts = {f"_part_{n}": F.sum(v) for n, v in sums.items()}
    parts["_part_rows"] = F.count(F.lit(1))
    per_range = cut.groupBy(*keys).agg(*[v.alias(n) for n, v in parts.items()])
    # One row per range: this window sees thousands of rows, whatever the input holds.
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    carried = [F.sum(n).over(earlier).alias(n.replace("_part_", "_carry_")) for n in parts]
    if totals:
        carried += [F.sum(f"_part_{n}").over(whole).alias(f"{n}_total") for n in sums]
    offsets = per_range.select(*keys, *carried)
    # The rows already lie and sort by these keys after their window: nothing moves again.
    if group:
        named = offsets.withColumnsRenamed({k: f"_at_{i}" for i, k in enumerate(keys)})
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_at_{i}")) for i, k in enumerate(keys)])
        joined = local.join(named, same, "left")
    else:
        joined = local.join(offsets, keys, "left")
    kinds = dict(joined.dtypes)
    added = {
        n: F.coalesce(F.col(n), F.lit(0).cast(kinds[n])) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0).cast(kinds[n]))
        for n in sums
    }
    if number:
        added[number] = F.col(number) + F.coalesce(F.col("_carry_rows"), F.lit(0))
    out = joined.withColumns(added)
    extra = [f"{n}_total" for n in sums] if totals else []
    return out.select(*df.columns, *sums, *([number] if number else []), *extra)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
