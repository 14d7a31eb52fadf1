"""Backward as-of join with a tolerance, as a merge scan.

Both sides are written once as one table of moments. It is cut into even time ranges, and inside a
range one forward pass in time order hands the last right row to the left rows that follow.
Across ranges the newest right row of each is handed over, one row per range. So each side is
evaluated once and moves once; no pairs are formed and no match is capped. Rows of a moment that
fills several ranges alone are dealt to ranges of their own, first the right ones, then the left ones.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.functions.clock import order_value
from millwright.operators.prefix import cut_points, range_count, truly_repeated, with_cut
from millwright.session import stored

#: Ranges that left rows without a time are dealt to.
UNTIMED = 64


def _constants(values: list) -> Column:
    """Numbers as one constant array; thousands of literals would make a slow plan."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _parts_of(on: str, kind: str, points: list[float], repeated: dict[float, int]) -> Column:
    """The number of a row's range: its time range, and inside it the part of a repeated moment.

    A repeated moment is the lowest of its range. With ``m`` parts its right rows fill the parts 0 to m - 1 and
    its left rows m parts after them, so that all right rows come before all left rows; the other rows come last.
    """
    most = max([UNTIMED, *repeated.values()])
    dealt = F.monotonically_increasing_id()
    part = F.lit(2 * most)
    if repeated:
        index = F.col("_range").cast("int")
        parts = F.get(_constants([float(repeated.get(p, 0)) for p in (None, *points)]), index).cast("bigint")
        lowest = F.get(_constants([0.0, *points]), index)
        hot = (parts > 0) & (order_value(F.col(on), kind) == lowest)
        part = F.when(hot, F.col("_side") * most + F.pmod(dealt, parts)).otherwise(part)
    untimed = F.pmod(dealt, F.lit(UNTIMED))
    return F.col("_range") * (2 * most + 1) + F.when(F.col(on).isNull(), untimed).otherwise(part)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    tolerance: timedelta | None = None,
    how: str = "left",
    last_by: list[str] | None = None,
    keep_right_time: str | None = None,
) -> DataFrame:
    """Give each left row the last right row at or before it, within ``tolerance``.

    Equal times match, and so does a gap of exactly ``tolerance``. Among right
    rows of one moment the largest by ``last_by``, then by the other columns in
    order, is taken. ``how`` is "left" or "inner"; ``keep_right_time`` names an
    extra output column for the matched right time. Left rows without a time match nothing.
    The inputs are read when this is called; the result is read from the shared folder.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    payload = [c for c in right.columns if c != on]
    shared = sorted((set(payload) | {keep_right_time}) & set(left.columns))
    if shared:
        raise ValueError(f"columns on both sides: {', '.join(shared)}")
    ranked = list(last_by or [])
    ranked += [c for c in payload if c not in ranked]
    spark = left.sparkSession

    own = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    match = F.struct(F.col(on).alias("_time"), *[F.col(f"`{c}`") for c in ranked])
    right_rows = right.filter(F.col(on).isNotNull()).select(on, F.lit(0).alias("_side"), match.alias("_match"))
    left_rows = left.select(on, F.lit(1).alias("_side"), own.alias("_own"))
    rows = stored(left_rows.unionByName(right_rows, allowMissingColumns=True), "asof-rows")

    points, repeated = cut_points(rows.select(on), on, range_count(spark))
    if repeated:
        repeated = {moment: repeated[moment] for moment in truly_repeated(rows, on, list(repeated), "")}
    kind = dict(rows.dtypes)[on]
    cut = with_cut(rows, on, points, "_range").withColumn("_range", _parts_of(on, kind, points, repeated))
    # The right rows of a moment come first, the wanted one last; then the left rows of the moment.
    forward = Window.partitionBy("_range").orderBy(on, "_side", "_match")
    passed = forward.rowsBetween(Window.unboundedPreceding, 0)
    scanned = cut.select(
        on, "_range", "_side", "_own",
        F.last("_match", ignorenulls=True).over(passed).alias("_match"),
        F.lead(F.lit(0)).over(forward).isNull().alias("_last"),
    )
    scanned = stored(scanned.filter("_side = 1 or _last"), "asof-matches")

    # One row per range: a few for each shuffle partition.
    newest = scanned.filter("_last").select("_range", "_match")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = newest.select("_range", F.max("_match").over(earlier).alias("_handed")).filter("_handed is not null")
    found = F.coalesce("_match", "_handed")
    near = F.col("_found").isNotNull() & F.col(on).isNotNull()
    if tolerance is not None:
        near = near & (F.col("_found._time") >= F.col(on) - F.lit(tolerance))
    out = scanned.filter("_side = 1").join(F.broadcast(handed), "_range", "left").withColumn("_found", found)
    out = out.withColumn("_found", F.when(near, F.col("_found")))
    if how == "inner":
        out = out.filter("_found is not null")
    return out.select(
        *[F.col(f"_own.`{c}`").alias(c) for c in left.columns],
        *[F.col(f"_found.`{c}`").alias(c) for c in payload],
        *([F.col("_found._time").alias(keep_right_time)] if keep_right_time else []),
    )
