"""Row numbers and running totals against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from millwright.operators.prefix import cut_points, running_totals, with_ranges


def data(seed, rows=1500, hot=0.4):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        first = 7 if rng.random() < hot else rng.randrange(100)
        out.append((None if rng.random() < 0.02 else first, i, rng.randrange(10)))
    rng.shuffle(out)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))


@pytest.mark.parametrize("seed", range(3))
def test_whole_input(spark, seed):
    rows = data(seed)
    df = spark.createDataFrame(rows, "a int, b int, v int").repartition(5)
    got = running_totals(df, ["a", "b"], sums={"before": F.col("v")}, number="place", totals=True)
    by_b = {r.b: (r.place, r.before, r.before_total) for r in got.collect()}
    total, want = 0, {}
    for place, (_, b, v) in enumerate(ordered(rows), 1):
        want[b] = (place, total, sum(r[2] for r in rows))
        total += v
    assert by_b == want


def test_repeated_value_is_cut_again(spark):
    df = spark.createDataFrame([(7, i) for i in range(4000)] + [(i, i) for i in range(100)], "a int, b int")
    points, repeated = cut_points(df, "a", 32)
    assert list(repeated) == [7]
    counts = [r["count"] for r in with_ranges(df, ["a", "b"], "part").groupBy("part").count().collect()]
    assert max(counts) < 600


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000, None])
def test_groups(spark, hot_rows):
    rng = random.Random(3)
    rows = [(("big" if rng.random() < 0.4 else f"g{rng.randrange(60)}"), i, rng.randrange(9)) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, b int, v int")
    got = running_totals(df, ["b"], sums={"before": F.col("v")}, number="place", group=["g"], hot_rows=hot_rows)
    state, want = {}, {}
    for g, b, v in rows:
        place, total = state.get(g, (0, 0))
        want[b] = (place + 1, total)
        state[g] = (place + 1, total + v)
    assert {r.b: (r.place, r.before) for r in got.collect()} == want


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(data(9), "a int, b int, v int")
    results = []
    for partitions, shuffle in ((1, 3), (7, 8), (13, 40)):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        rows = running_totals(df.repartition(partitions), ["a", "b"], number="place").collect()
        results.append(sorted((r.b, r.place) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert results[0] == results[1] == results[2]


def test_infinities_and_nan_keep_their_place(spark):
    values = [float("-inf"), -1.0, 0.0, 2.5, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a double, b int")
    rows = running_totals(df, ["a", "b"], number="place").collect()
    assert {r.b: r.place for r in rows} == {i: i + 1 for i in range(len(values))}


def test_text_order(spark):
    rng = random.Random(4)
    values = sorted({"".join(rng.choice("abé7") for _ in range(rng.randrange(12))) for _ in range(900)}, key=lambda v: v.encode())
    df = spark.createDataFrame([("g", v) for v in values], "g string, v string").repartition(4)
    for group in ([], ["g"]):
        rows = running_totals(df, ["v"], number="place", group=group, hot_rows=1).collect()
        assert {r.v: r.place for r in rows} == {v: i + 1 for i, v in enumerate(values)}
