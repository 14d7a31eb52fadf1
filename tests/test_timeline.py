"""Routes, matrices, timeline, clock, fused files."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwright.operators.timeline import check_jobs, matrix_lookup, operations_timeline, shop_floor, with_row_clock
from millwright.plans.fusion import build_table, fuse_files
from millwright.sources.files import numbered_lines, read_minutes, read_routes
from millwright.sources.tables import latest_rows, range_or_latest, read_table, replace_table

ZERO = datetime(2020, 1, 1)
HEADER = (
    "UDI,Product ID,Type,Air temperature [K],Process temperature [K],Rotational speed [rpm],Torque [Nm],"
    "Tool wear [min],Machine failure,TWF,HDF,PWF,OSF,RNF"
)


def write(path, text):
    path.write_text(text)
    return str(path)


def matrix(rows, width=50):
    return "\n".join(",".join(str(row.get(i, 0)) for i in range(1, width + 1)) for row in rows) + "\n"


@pytest.fixture()
def files(tmp_path):
    return dict(
        routes=write(tmp_path / "routes.csv", "17,42\n\n 5 ,,x,7,5\n"),
        process_times=write(tmp_path / "process.csv", matrix([{17: 10, 42: 8}, {}, {5: 4, 7: 6}])),
        setup_times=write(tmp_path / "setup.csv", matrix([{17: 2, 42: 3}, {}, {5: 1, 7: 2}])),
        sensors=write(
            tmp_path / "sensors.csv",
            HEADER + "\n" + "\n".join(f"{u},M{u},M,300.1,310.2,1500,40.5,{u},0,0,0,0,0,0" for u in (7, 3, 9)) + "\n",
        ),
    )


def test_golden_flatten(spark, files):
    rows = shop_floor(
        read_routes(spark, files["routes"]),
        read_minutes(spark, files["process_times"]),
        read_minutes(spark, files["setup_times"]),
    ).orderBy("job_id", "task_id").collect()
    assert [tuple(r) for r in rows] == [
        (ZERO, 1, 1, 17, 2, 10),
        (ZERO + timedelta(minutes=12), 1, 2, 42, 3, 8),
        (ZERO, 3, 1, 5, 1, 4),
        (ZERO + timedelta(minutes=5), 3, 2, 7, 2, 6),
        (ZERO + timedelta(minutes=13), 3, 3, 5, 1, 4),
    ]


@pytest.mark.parametrize("machine", [0, 51])
def test_machine_outside_the_matrix_is_an_error(spark, tmp_path, machine):
    routes = read_routes(spark, write(tmp_path / "r.csv", f"{machine}\n"))
    times = read_minutes(spark, write(tmp_path / "p.csv", matrix([{1: 1}])))
    with pytest.raises(Exception, match="no value at position"):
        shop_floor(routes, times, times).collect()


def test_different_job_counts_are_an_error(spark, tmp_path, files):
    short = read_minutes(spark, write(tmp_path / "p.csv", matrix([{1: 1}])))
    with pytest.raises(ValueError, match="jobs differ"):
        check_jobs(routes=read_routes(spark, files["routes"]), process=short, setup=short)


def test_line_numbers_over_many_splits_and_files(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    text = ["" if i % 7 == 0 else f"line {i}" for i in range(5000)]
    write(folder / "a.txt", "\n".join(text[:3000]) + "\n")
    write(folder / "b.txt", "\n".join(text[3000:]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        rows = numbered_lines(spark, str(folder)).collect()
        dense = numbered_lines(spark, str(folder), skip_blank=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(rows, key=lambda r: r.line_no)] == text
    assert sorted(r.line_no for r in rows) == list(range(1, 5001))
    full = [t for t in text if t]
    assert [(r.line_no, r.value) for r in sorted(dense, key=lambda r: r.line_no)] == list(enumerate(full, 1))


def test_long_jobs_pass_many_days(spark):
    ops = spark.createDataFrame([(1, i, 100_000, 100_000) for i in range(30)], "job int, k int, s int, p int")
    last = operations_timeline(ops, "job", ["k"], "s", "p").orderBy(F.desc("task_id")).first()
    assert last.timestamp == ZERO + timedelta(minutes=29 * 200_000)


def test_clock_ignores_gaps(spark):
    df = spark.createDataFrame([(7,), (3,), (9,)], "UDI int")
    rows = with_row_clock(df, ["UDI"]).collect()
    assert {r.UDI: (r.timestamp - ZERO).seconds for r in rows} == {3: 0, 7: 10, 9: 20}


def test_missing_cell_is_an_error(spark):
    m = spark.createDataFrame([(1, [1, None])], "k int, minutes array<int>")
    wanted = spark.createDataFrame([(1, 2)], "k int, p int")
    with pytest.raises(Exception, match="no value"):
        matrix_lookup(wanted, m, "k", "p", "minutes", "v").collect()


def test_fused_files_and_table(spark, files, tmp_path):
    rows = fuse_files(spark, **files).orderBy("ts").collect()
    assert [(r.UDI, (r.ts - ZERO).seconds, r.job_id, r.task_id, r.machine_id) for r in rows] == [
        (3, 0, 3, 1, 5), (7, 10, 3, 1, 5), (9, 20, 3, 1, 5),
    ]
    assert rows[0].rot_speed_rpm == 1500.0 and rows[0].machine_failure == 0
    target = str(tmp_path / "table")
    assert build_table(spark, target, **files) == 3
    table = read_table(spark, target)
    assert "timestamp" in table.columns and "ts" not in table.columns and table.count() == 3


def test_replace_by_day_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select(
        F.col("id"), (F.lit(ZERO).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("ts")
    )
    assert replace_table(df.limit(5), path) == 5
    assert replace_table(df, path, partition_by_day=True) == 100
    day = spark.read.parquet(path).filter("day = date'2020-01-03'")
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 1


def test_range_is_inclusive_and_falls_back(spark):
    df = spark.createDataFrame([(i, datetime(2024, 7, i)) for i in range(1, 21)], "k int, timestamp timestamp_ntz")
    bound = lambda s: F.to_timestamp_ntz(F.lit(s), F.lit("yyyy-MM-dd"))
    inside = range_or_latest(df, bound("2024-07-01"), bound("2024-07-15"), 3, tie=["k"])
    assert [r.k for r in inside.collect()] == list(range(1, 16))
    empty = range_or_latest(df, bound("2023-07-01"), bound("2023-07-15"), 3, tie=["k"])
    assert [r.k for r in empty.collect()] == [18, 19, 20]
    assert [r.k for r in latest_rows(df, 2, tie=["k"]).collect()] == [19, 20]
