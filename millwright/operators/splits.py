"""Repeatable splits that keep class shares, without moving the rows.

A row's place is the md5 of its unique key and a seed. Where to cut each class
is an order statistic of those hashes, found among the few hashes near the expected
place; with the cut values as literals the split is a plain filter on every row.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions.text import row_hash
from millwright.operators.ranks import merged, slice_of, values_at_ranks

# The split settings.
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
SAMPLE_ROWS = 500

MOST_CLASSES = 1000
# Width of the bracket around an expected cut value.
MOST_DEVIATIONS = 6


def class_counts(df: DataFrame, label: str | Column) -> dict:
    """Rows per class, on the driver. More than ``MOST_CLASSES`` classes is an error."""
    column = F.col(label) if isinstance(label, str) else label
    rows = (
        df.groupBy(column.cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("label is not null")
        .limit(MOST_CLASSES + 1)
        .collect()
    )
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes to stratify by")
    return {row.label: row.n for row in rows}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, rows, weight`` with weight = all rows / (classes * rows of the class)."""
    counts = class_counts(df, label)
    total, kinds = sum(counts.values()), len(counts)
    kind = dict(df.dtypes)[label]
    rows = [(c, n, total / (kinds * n)) for c, n in sorted(counts.items())]
    return df.sparkSession.createDataFrame(rows, "label string, rows bigint, weight double").select(
        F.col("label").cast(kind).alias("label"), "rows", "weight"
    )


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add the balance weight of the row's class as a literal lookup."""
    counts = class_counts(df, label)
    total, kinds = sum(counts.values()), len(counts)
    weights = {c: F.lit(total / (kinds * n)) for c, n in counts.items()}
    return df.withColumn(name, _by_class(F.col(label).cast("string"), weights))


def _by_class(label: Column, values: dict[str, Column]) -> Column:
    pairs = chain.from_iterable((F.lit(c), v) for c, v in values.items())
    return F.try_element_at(F.create_map(*pairs), label)


def _around(rank: int, n: int) -> tuple[str, str]:
    """Where the hash of that rank must lie: evenly spread hashes stray by a few deviations at most."""
    share = (rank + 0.5) / n
    slack = (MOST_DEVIATIONS * math.sqrt(n * share * (1 - share)) + 2) / n
    low, high = max(0.0, share - slack), min(1.0, share + slack)
    return f"{int(low * 16**12):012x}", f"{min(int(high * 16**12), 16**12 - 1):012x}g"


def _cuts(
    df: DataFrame, label: str | None, key: list[str], seed: int, ranks: dict[str, list[int]], counts: dict[str, int]
) -> dict[str, list[str]]:
    """Hash values at the given ranks of each class, in rank order: classes x cuts strings."""
    brackets = {c: merged([_around(r, counts[c]) for r in sorted(set(wanted))]) for c, wanted in ranks.items()}
    group = F.lit("all") if label is None else F.col(f"`{label}`").cast("string")
    limits = []
    for i in range(max((len(b) for b in brackets.values()), default=0)):
        limits.append(
            tuple(
                _by_class(F.col("group"), {c: F.lit(b[i][side]) for c, b in brackets.items() if i < len(b)})
                for side in (0, 1)
            )
        )
    hashed = df.select(group.alias("group"), row_hash(key, seed).alias("value")).filter("group is not null")
    sliced = hashed.withColumn("slice", slice_of(F.col("value"), limits))
    inside = 2 * MOST_DEVIATIONS * math.sqrt(max(counts.values(), default=0)) * max((len(w) for w in ranks.values()), default=0)
    found = values_at_ranks(sliced, ranks, inside)
    return {c: [found[c][rank] for rank in wanted] for c, wanted in ranks.items()}


def _cuts_passed(df: DataFrame, label: str | None, key: list[str], seed: int, cuts) -> Column:
    """How many of its class's cut values the row's hash lies above; null for a null class."""
    group = F.lit("all") if label is None else F.col(f"`{label}`").cast("string")
    limits = []
    for i in range(max((len(values) for values in cuts.values()), default=0)):
        if label is None:
            limits.append(F.lit(cuts["all"][i]))
        else:
            limits.append(_by_class(group, {c: F.lit(values[i]) for c, values in cuts.items() if i < len(values)}))

    def passed(own: Column) -> Column:
        return sum((F.coalesce((own > cut).cast("int"), F.lit(0)) for cut in limits), F.lit(0))

    # The lambda binds the hash, so it is computed once per row, in filters too.
    return F.when(group.isNotNull(), F.get(F.transform(F.array(row_hash(key, seed)), passed), F.lit(0)))


def with_test_flag(
    df: DataFrame, label: str, key: list[str], share: float = TEST_SHARE, seed: int = SEED, name: str = "is_test"
) -> DataFrame:
    """Mark ``round(share * n)`` rows of every class (half up) for testing, first by hash."""
    counts = class_counts(df, label)
    tested = {c: int(math.floor(n * share + 0.5)) for c, n in counts.items()}
    cuts = _cuts(df, label, key, seed, {c: [t - 1] if t else [] for c, t in tested.items()}, counts)
    passed = _cuts_passed(df, label, key, seed, cuts)
    some = _by_class(
        F.col(f"`{label}`").cast("string"), {c: F.lit(bool(values)) for c, values in cuts.items()}
    )
    return df.withColumn(name, F.when(some, (passed == 0)).otherwise(F.when(~some, F.lit(False))))


def stratified_split(df: DataFrame, label: str, key: list[str], share: float = TEST_SHARE, seed: int = SEED):
    """The (train, test) parts."""
    flagged = with_test_flag(df, label, key, share, seed, "_test")
    return flagged.filter("not _test").drop("_test"), flagged.filter("_test").drop("_test")


def with_fold(
    df: DataFrame, label: str, key: list[str], folds: int = FOLDS, seed: int = SEED, name: str = "fold"
) -> DataFrame:
    """Deal every class evenly into ``folds`` parts: fold = floor((place - 1) * folds / n) by hash."""
    counts = class_counts(df, label)
    if max(counts.values(), default=0) < folds:
        raise ValueError(f"no class has {folds} rows")
    # Last 0-based place with floor(place * folds / n) < i.
    ends = {c: [-(-n * i // folds) - 1 for i in range(1, folds)] for c, n in counts.items()}
    cuts = _cuts(df, label, key, seed, ends, counts)
    return df.withColumn(name, _cuts_passed(df, label, key, seed, cuts))


def size_fractions(steps: int = 10) -> list[float]:
    """Evenly spaced fractions that end at 1."""
    return [i / steps for i in range(1, steps + 1)]


def prefix_sizes(rows: int, fractions: list[float]) -> list[int]:
    """``floor(fraction * rows)`` of each fraction, which must grow and give at least one row."""
    # A fraction is the nearest double, so its product may lie a little below a whole number.
    sizes = [int(f * rows * (1 + 1e-12) + 1e-9) for f in fractions]
    if sizes != sorted(sizes) or sizes[0] < 1:
        raise ValueError(f"fractions must grow and give at least one row: sizes {sizes}")
    return sizes


def with_prefix_step(
    df: DataFrame,
    key: list[str],
    fractions: list[float],
    seed: int = SEED,
    name: str = "step",
    within: Column | None = None,
) -> DataFrame:
    """Add the number of the smallest nested prefix a row belongs to (from 1).

    Prefix i holds the first ``floor(fractions[i-1] * n)`` rows by hash, so the
    rows with ``step <= i`` are the i-th training part. With ``within`` only the
    rows that meet it count and get a number.
    """
    base = df if within is None else df.filter(within)
    rows = base.count()
    sizes = prefix_sizes(rows, fractions)
    cuts = _cuts(base, None, key, seed, {"all": [s - 1 for s in sizes]}, {"all": rows})
    step = _cuts_passed(df, None, key, seed, cuts) + 1
    return df.withColumn(name, step if within is None else F.when(within, step))


def fixed_sample(df: DataFrame, key: list[str], rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """At most ``rows`` rows without replacement, the same ones on every run."""
    order = row_hash(key, seed)
    return df.orderBy(order, *key).limit(rows)


def top_rows(df: DataFrame, order: list[Column], rows: int) -> DataFrame:
    """The first ``rows`` rows of an order that ends in a unique key."""
    return df.orderBy(*order).limit(rows)
