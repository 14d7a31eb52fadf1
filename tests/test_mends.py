"""Rows that must not vanish, texts that must spread, fits that must not depend on the layout."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from millwright.functions.clock import moment
from millwright.models import validate
from millwright.models.score import score
from millwright.models.train import Recipe, check_categories, fit_forest
from millwright.operators.classification import confusion_matrix
from millwright.operators.prefix import running_totals, with_ranges
from millwright.operators.timeline import matrix_lookup
from millwright.sources.files import read_csv
from millwright.sources.tables import replace_table, scan_range


def test_text_keys_with_one_beginning_spread(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_name")
    counts = [r["count"] for r in with_ranges(names, ["c_name"], "part").groupBy("part").count().collect()]
    assert max(counts) <= 0.25 * sum(counts)


def test_text_order_holds_beyond_the_sampled_beginning(spark):
    sample = spark.createDataFrame([(f"site-{i:04}",) for i in range(200)], "k string")
    rows = sample.unionAll(spark.createDataFrame([("alpha",), ("zulu",), (None,), ("site",)], "k string"))
    got = running_totals(rows, ["k"], number="n").orderBy("n").collect()
    assert [r.k for r in got] == sorted(r.k for r in got if r.k is not None) + [None]
    ranged = with_ranges(rows, ["k"], "part", sample_from=sample).orderBy("part").collect()
    known = [r for r in ranged if r.k is not None]
    assert all(a.part <= b.part for a, b in zip(*(sorted(known, key=lambda r: r.k)[s] for s in (slice(0, -1), slice(1, None)))))


def test_other_classes_and_nulls_are_errors(spark):
    rows = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (None, 0)], "label int, prediction int")
    with pytest.raises(Exception, match="2 rows with a class"):
        confusion_matrix(rows).collect()
    full = confusion_matrix(rows.filter("label is not null"), classes=None).collect()
    assert len(full) == 9 and sum(r.rows for r in full) == 3


def test_unknown_lookup_key_is_an_error(spark):
    matrix = spark.createDataFrame([(1, [5.0])], "job_id int, minutes array<double>")
    asked = spark.createDataFrame([(1, 1), (9, 1)], "job_id int, at int")
    with pytest.raises(Exception, match="no value at position 1 for job_id 9"):
        matrix_lookup(asked, matrix, "job_id", "at", "minutes", "value").collect()


def test_bad_cell_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2020-01-01 00:00:00\nx,junk\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.TimestampNTZType())])
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "x.csv"), schema).collect()
    assert read_csv(spark, str(tmp_path / "x.csv"), schema, mode="PERMISSIVE").count() == 2


def test_range_scan_reads_only_its_days(spark, tmp_path):
    start = dt.datetime(2024, 7, 1)
    rows = spark.createDataFrame([(start + dt.timedelta(hours=6 * i), i) for i in range(40)], "ts timestamp_ntz, v int")
    path = str(tmp_path / "by-day")
    assert replace_table(rows, path, partition_by_day=True) == 40
    found = scan_range(spark.read.parquet(path), moment("2024-07-02 00:00:00"), moment("2024-07-03 06:00:00"))
    assert [r.v for r in found.collect()] == [4, 5, 6, 7, 8, 9] and found.columns == ["timestamp", "v"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_seed_and_rows_alone_decide_a_fit(spark):
    rows = spark.range(600).select(
        F.rand(1).alias("x"), F.rand(2).alias("y"), (F.rand(3) < 0.3).cast("int").alias("label"), F.col("id").alias("k")
    ).toPandas()
    recipe = Recipe(numeric=["x", "y"], categorical=[], label="label", trees=5, depth=4)
    seen = []
    for parts in (1, 4, 8):
        df = spark.createDataFrame(rows).repartition(parts)
        out = score(df, fit_forest(df, recipe), "p", "prob").orderBy("k").collect()
        seen.append([r.prob for r in out])
    assert seen[0] == seen[1] == seen[2]


def test_category_limit_is_exact(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("c"))
    check_categories(rows, ["c"], most=1000)
    with pytest.raises(ValueError):
        check_categories(rows, ["c"], most=999)


def test_each_fold_is_scored_by_a_job_of_its_own(spark, monkeypatch):
    rows = spark.range(300).select(
        F.rand(1).alias("x"), (F.rand(2) < 0.4).cast("int").alias("label"), F.col("id").alias("k")
    )
    recipe = Recipe(numeric=["x"], categorical=[], label="label", trees=2, depth=2)
    written, keep = [], validate.stored
    monkeypatch.setattr(validate, "stored", lambda df, name: written.append(keep(df, name)) or written[-1])
    found = validate.fold_scores(rows, recipe, ["k"], folds=3, train_scores=True)
    # A job over several folds would unpack all of their models in each task.
    assert sorted([r.fold for r in df.select("fold").distinct().collect()] for df in written) == [[0], [1], [2]]
    counts = {(r.fold, r.split): r["count"] for r in found.groupBy("fold", "split").count().collect()}
    assert sum(n for (_, split), n in counts.items() if split == "test") == 300
    assert all(counts[f, "test"] + counts[f, "train"] == 300 for f in range(3))
