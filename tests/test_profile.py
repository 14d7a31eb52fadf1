"""Summaries, histograms, densities, correlations, schema helpers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millwright.functions.columns import categorical_columns, columns_by_role, numeric_columns, require_columns, require_rows
from millwright.functions.features import engineered
from millwright.operators.density import histogram, kernel_densities, kernel_density
from millwright.operators.profile import correlations, missing_counts, summary
from millwright.operators.profile_state import add_parts, merged_correlations, merged_summary
from millwright.operators.ranks import percentiles
from millwright.plans.profiling import profile_job


def test_quartiles_golden(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    row = summary(df, ["x"]).first()
    assert (row.p25, row.p50, row.p75) == (1.75, 3.0, 5.0)
    assert row["count"] == 4 and row.mean == 3.75


def test_percentiles_with_a_value_in_a_third_of_the_rows(spark):
    rng = random.Random(5)
    values = [3.0 if rng.random() < 0.34 else rng.random() * 10 for _ in range(3000)] + [None, float("nan")]
    df = spark.createDataFrame([(v, 1) for v in values], "x double, y int")
    got = {(r.column_name, r.share): r.value for r in percentiles(df, ["x", "y"], [0.0, 0.1, 0.5, 0.999, 1.0]).collect()}
    full = sorted(v for v in values if v is not None and not math.isnan(v))
    for p in (0.0, 0.1, 0.5, 0.999, 1.0):
        spot = (len(full) - 1) * p
        low, high = full[math.floor(spot)], full[math.ceil(spot)]
        assert got["x", p] == pytest.approx(low + (high - low) * (spot - math.floor(spot)), abs=1e-12)
        assert got["y", p] == 1.0


def test_approximate_summary_is_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    row = summary(df, ["x"], approximate=True).first()
    assert abs(row.p50 - 4999.5) < 5


def test_missing_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b")], "x double, s string")
    assert {r.column_name: r.missing_count for r in missing_counts(df).collect()} == {"x": 2, "s": 1}


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, None, 7.0)], "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.correlation for r in correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(1.0)
    assert got["a", "a"] == 1.0 and got["c", "c"] is None and got["a", "c"] is None
    assert correlations(df, ["a"]).count() == 0


def test_histogram_counts_every_present_row_once(spark):
    df = spark.createDataFrame([(float(i % 61), None if i % 5 else 1.0) for i in range(1000)], "x double, y double")
    rows = histogram(df, ["x", "y"]).collect()
    assert sum(r.rows for r in rows if r.column_name == "x") == 1000
    assert [(r.bin, r.rows) for r in rows if r.column_name == "y"] == [(0, 200)]
    assert max(r.bin for r in rows) == 29


def test_densities_are_exact_kernel_sums(spark):
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1), rng.expovariate(1) ** 3, None if i % 3 else 2.0 + i % 2, 5, float("nan")) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, heavy double, two double, same int, none double").repartition(3)
    found = kernel_densities(df, df.columns).orderBy("column_name", "point").collect()
    assert {r.column_name for r in found} == {"x", "heavy", "two"}
    for name in ("x", "heavy", "two"):
        curve = [r for r in found if r.column_name == name]
        xs = [r[name] for r in df.collect() if r[name] is not None]
        h = df.agg(F.stddev_samp(name)).first()[0] * len(xs) ** -0.2
        assert len(curve) == 200 and curve[0].x == min(xs) and curve[-1].x == pytest.approx(max(xs), abs=1e-12)
        for at in curve[::7]:
            want = sum(math.exp(-0.5 * ((at.x - x) / h) ** 2) for x in xs) / (len(xs) * h * math.sqrt(2 * math.pi))
            assert at.density == pytest.approx(want, rel=1e-9, abs=1e-14)
    step = found[1].x - found[0].x
    alone = kernel_density(df, "x").orderBy("point").collect()
    assert [r.density for r in alone] == pytest.approx([r.density for r in found if r.column_name == "x"], rel=1e-12)
    assert 0.97 < sum(r.density for r in alone) * (alone[1].x - alone[0].x) < 1.0 and step > 0


def test_passes_over_the_table_do_not_grow_with_the_columns(spark):
    """Jobs that densities and correlations run before their result is read."""
    def jobs(run):
        before = spark.sparkContext.statusTracker()
        group = f"count-{random.random()}"
        spark.sparkContext.setJobGroup(group, "count")
        run()
        found = len(before.getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    wide = spark.range(500).select(*[(F.rand(i) * (i + 1)).alias(f"c{i}") for i in range(12)])
    for operator in (kernel_densities, correlations):
        assert jobs(lambda: operator(wide, ["c0", "c1"])) == jobs(lambda: operator(wide, wide.columns))


def test_correlations_with_gaps_equal_the_definition(spark):
    rng = random.Random(11)
    rows = []
    for i in range(800):
        a = rng.gauss(1e6, 1)
        rows.append((a if i % 3 else None, a * 2 + rng.gauss(0, 3) if i % 5 else float("nan"), rng.random() if i % 2 else None, 0.1, 4.2 if i % 3 else float(i)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    got = {(r.column_a, r.column_b): r.correlation for r in correlations(df, df.columns).collect()}
    assert len(got) == 25
    data = {c: [r[c] for r in df.collect()] for c in df.columns}
    for x in df.columns:
        for y in df.columns:
            both = [(p, q) for p, q in zip(data[x], data[y]) if p is not None and q is not None and p == p and q == q]
            mx, my = (math.fsum(v) / len(both) for v in zip(*both))
            sx, sy = (math.sqrt(math.fsum((v - m) ** 2 for v in c)) for c, m in zip(zip(*both), (mx, my)))
            if min(sx, sy) < 1e-9:
                assert got[x, y] is None, (x, y)
            else:
                want = math.fsum((p - mx) * (q - my) for p, q in both) / (sx * sy)
                assert got[x, y] == pytest.approx(want, abs=1e-9)


def test_profile_job_writes_every_table(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i * i % 17), "k" if i % 3 else None) for i in range(200)], "a int, b double, s string")
    paths = profile_job(df, str(tmp_path))
    assert set(paths) == {"missing", "missing_nonzero", "summary", "histogram", "density", "correlation"}
    back = spark.read.option("header", True).csv(paths["missing_nonzero"]).collect()
    assert [(r.column_name, r.missing_count) for r in back] == [("s", "66")] or back[0].column_name == "s"


def test_columns_by_type_and_text(spark):
    df = spark.createDataFrame(
        [], "`UDI` int, `Type` string, `Air Temperature [K]` double, `PROCESS temperature` float, flag boolean, "
        "`Rotational speed [rpm]` int, `Torque [Nm]` double, `Tool wear [min]` double, `Machine failure` int, `torque 2` double",
    )
    assert numeric_columns(df)[:3] == ["UDI", "Air Temperature [K]", "PROCESS temperature"]
    assert "flag" not in numeric_columns(df) and categorical_columns(df) == ["Type"]
    roles = columns_by_role(df)
    assert roles["torque"] == "Torque [Nm]" and roles["target"] == "Machine failure"
    with pytest.raises(KeyError, match="tool wear"):
        columns_by_role(df.drop("Tool wear [min]"))
    with pytest.raises(KeyError, match="a, b"):
        require_columns(df, ["a", "UDI", "b"])
    with pytest.raises(ValueError, match="no rows"):
        require_rows(df)


def test_feature_golden(spark):
    df = spark.createDataFrame([(300.0, 310.0, 1500, 40.0, 3), (300.0, 310.0, 0, 40.0, 3)], "a double, p double, s int, t double, w int")
    rows = engineered(df, {"air": "a", "process": "p", "speed": "s", "torque": "t", "wear": "w"}).collect()
    assert rows[0].speed_x_torque == 60000 and rows[0].temp_diff == -10
    assert rows[0].wear_rate == 3 / (1500 + 1e-8) and rows[1].wear_rate == pytest.approx(3e8)
    assert rows[0].t_squared == 1600 and rows[0].t_cubed == 64000
    assert len(rows[0]) == 5 + 3 + 10


def test_a_profile_grows_part_by_part(spark, tmp_path):
    """Merged parts give the profile of the whole; a part that is added again replaces itself and nothing else is read."""
    rng = random.Random(9)
    rows = [(f"d{i % 4}", rng.gauss(1e5, 2) if i % 7 else None, rng.random() if i % 3 else float("nan"), 5) for i in range(4_000)]
    df = spark.createDataFrame(rows, "day string, a double, b double, same int")
    names, folder = ["a", "b", "same"], str(tmp_path / "state")
    for i in range(4):
        add_parts(df.filter(F.col("day") == f"d{i}"), names, "day", folder)
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    again = df.filter("day = 'd2'").mapInArrow(run, df.schema)
    add_parts(again, names, "day", folder)
    assert seen.value <= 2 * 1_000
    want = {r.column_name: r for r in summary(df, names).collect()}
    exact = {r.column_name: r for r in merged_summary(spark, folder, df).collect()}
    rough = {r.column_name: r for r in merged_summary(spark, folder).collect()}
    for name in names:
        w, e, q = want[name], exact[name], rough[name]
        assert e["count"] == w["count"] and e.missing_count == 4_000 - w["count"]
        for x in ("mean", "std", "min", "max", "p25", "p50", "p75"):
            assert getattr(e, x) == pytest.approx(getattr(w, x), rel=1e-9, abs=1e-9)
        values = sorted(r[name] for r in df.collect() if r[name] is not None and r[name] == r[name])
        for p, x in ((0.25, q.p25), (0.5, q.p50), (0.75, q.p75)):
            at = sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)
            assert at[0] - 0.01 <= p <= at[1] + 0.01
    whole = {(r.column_a, r.column_b): r.correlation for r in correlations(df, names).collect()}
    parts = {(r.column_a, r.column_b): r.correlation for r in merged_correlations(spark, folder).collect()}
    assert {k: v is None for k, v in parts.items()} == {k: v is None for k, v in whole.items()}
    assert all(v is None or v == pytest.approx(whole[k], abs=1e-9) for k, v in parts.items())
    with pytest.raises(ValueError, match="has the columns"):
        add_parts(df, ["a"], "day", folder)
