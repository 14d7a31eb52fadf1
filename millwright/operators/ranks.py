"""Exact order statistics without sorting the input.

Each wanted rank is bracketed beforehand. One pass counts the rows outside the
brackets and keeps the few values inside; should a bracket turn out wrong, the
lookup is repeated with every value kept. Brackets cost or save time, nothing else.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.functions.columns import value_or_null
from millwright.operators.prefix import HOT_ROWS, running_totals, sketch

# Steps of the quantile sketch, and how many of them a bracket reaches to either side.
RESOLUTION = 2_000
MARGIN = 3


def merged(brackets: list[tuple]) -> list[tuple]:
    """Closed intervals in order, overlapping ones joined."""
    out: list[tuple] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def slice_of(value: Column, brackets: list[tuple[Column, Column]]) -> Column:
    """0 below the first bracket, 1 inside it, 2 between it and the next, and so on."""
    passed = F.lit(0)
    for low, high in brackets:
        passed = passed + F.coalesce((value >= low).cast("int"), F.lit(0))
        passed = passed + F.coalesce((value > high).cast("int"), F.lit(0))
    return passed


def values_at_ranks(rows: DataFrame, ranks: dict, inside: float) -> dict:
    """The value at each 0-based rank of each group, as ``{group: {rank: value}}``.

    ``rows`` has ``group, slice, value`` with slices as ``slice_of`` numbers them.
    Only groups x ranks values reach the driver. ``inside`` is the number of rows
    expected in the largest bracket; a large one is not left to one task.
    """
    ranks = {group: wanted for group, wanted in ranks.items() if wanted}
    if not ranks:
        return {}
    wanted = F.create_map(
        *chain.from_iterable((F.lit(g), F.array(*[F.lit(r) for r in sorted(set(w))])) for g, w in ranks.items())
    )

    def look(keep_all: bool) -> dict:
        kept = F.col("value") if keep_all else F.when(F.col("slice") % 2 == 1, F.col("value"))
        counted = rows.groupBy("group", "slice", kept.alias("value")).agg(F.count(F.lit(1)).alias("same"))
        # One row per group and slice, a few per wanted rank.
        earlier = Window.partitionBy("group").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counted.groupBy("group", "slice").agg(F.sum("same").alias("rows")).select(
            "group", "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
        )
        placed = running_totals(
            counted,
            ["value"],
            sums={"lower": F.col("same")},
            group=["group", "slice"],
            hot_rows=HOT_ROWS if keep_all or inside > HOT_ROWS else None,
        )
        placed = placed.join(F.broadcast(offsets), ["group", "slice"]).withColumn(
            "first", F.col("before") + F.col("lower")
        )
        hits = placed.filter(
            F.exists(
                F.try_element_at(wanted, F.col("group")),
                lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("same")),
            )
        ).collect()
        found: dict = {g: {} for g in ranks}
        for hit in hits:
            for rank in ranks[hit.group]:
                if hit.first <= rank < hit.first + hit.same and hit.value is not None:
                    found[hit.group][rank] = hit.value
        return found

    found = look(keep_all=False)
    if any(rank not in found[g] for g, w in ranks.items() for rank in w):
        found = look(keep_all=True)
    return found


def percentiles(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """``column_name, share, value``: exact percentiles, linear between neighbours.

    One pass sketches the brackets, one looks the exact values up.
    """
    numbers = df.select(*[value_or_null(df, name).alias(name) for name in columns])
    reach = MARGIN / RESOLUTION
    around = [min(1.0, max(0.0, p + side * reach)) for p in shares for side in (-1, 1)]
    sketched = sketch(numbers, columns, around, RESOLUTION)
    ranks, cells = {}, []
    for i, name in enumerate(columns):
        at, n = sketched[name]
        spots = [(n - 1) * p for p in shares] if n else []
        ranks[i] = sorted({int(edge(s)) for s in spots for edge in (math.floor, math.ceil)})
        value = F.col(f"`{name}`")
        brackets = [(F.lit(low), F.lit(high)) for low, high in merged(list(zip(at[::2], at[1::2])))]
        cells.append(
            F.struct(F.lit(i).alias("group"), slice_of(value, brackets).alias("slice"), value.alias("value"))
        )
    rows = numbers.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    largest = max((n for _, n in sketched.values()), default=0)
    found = values_at_ranks(rows, ranks, 2 * reach * largest * len(shares))

    result = []
    for i, name in enumerate(columns):
        n = sketched[name][1]
        at = found.get(i, {})
        for p in shares if n else []:
            spot = (n - 1) * p
            low, high = at[math.floor(spot)], at[math.ceil(spot)]
            result.append((name, p, low + (high - low) * (spot - math.floor(spot))))
    return df.sparkSession.createDataFrame(result, "column_name string, share double, value double")
