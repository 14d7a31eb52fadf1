"""One evaluation of each input, keys that no task may hold alone, writes that may fail, inputs that must be refused."""

import subprocess
import sys
import textwrap
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millwright.functions.columns import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from millwright.models.score import score
from millwright.models.train import Recipe, fit_forest
from millwright.models.validate import cross_validate, fold_scores, learning_curve
from millwright.operators.asof import asof_join
from millwright.operators.curves import pr_points, roc_auc, roc_auc_by, roc_points
from millwright.operators.encode import category_dictionary, category_slots, one_hot_vectors
from millwright.operators import encode
from millwright.operators.prefix import running_totals, with_ranges
from millwright.session import application_dir, drop_intermediates, fresh_path, stored
from millwright.sources.tables import read_table, replace_table
from millwright.streaming.scoring import request_schema, request_stream, score_stream_by_batch

START = datetime(2024, 1, 1)
SMALL = dict(trees=5, depth=4)


def counted(spark, df):
    """``df`` behind a filter that counts the rows it lets through, and the count."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def moments(spark, n, name):
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 997).cast("decimal(18,6)"))
    return spark.range(n).select(F.col("id").alias(name), (F.lit(START).cast("timestamp_ntz") + seconds).alias("ts"))


def test_asof_evaluates_and_moves_each_side_once(spark):
    left, seen_left = counted(spark, moments(spark, 5_000, "l"))
    right, seen_right = counted(spark, moments(spark, 3_000, "r"))
    joined = asof_join(left, right, "ts", timedelta(seconds=5))
    assert joined.count() == 5_000
    assert (seen_left.value, seen_right.value) == (5_000, 3_000)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_asof_spreads_a_moment_and_rows_without_time(spark):
    """Most rows of both sides share one moment or none; each meets the largest right row."""
    hot = lambda n, name: spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.lit(START)).cast("timestamp_ntz").alias("ts"), F.col("id").alias(name)
    )
    joined = asof_join(hot(9_000, "l"), hot(6_000, "r"), "ts", None, "left", ["r"])
    rows = joined.groupBy(F.col("ts").isNull().alias("none"), "r").count().collect()
    assert {(r.none, r.r, r["count"]) for r in rows} == {(True, None, 3_000), (False, 5_999, 6_000)}


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "string"])
def test_asof_on_other_types(spark, kind):
    values = ["2024-01-01", "2024-01-01", "2024-01-05", "2024-02-01"] if kind in ("date", "string") else ["1", "1", "5", "9"]
    left = spark.createDataFrame([(v, i) for i, v in enumerate([values[0], values[2], values[3]])], "k string, l int")
    right = spark.createDataFrame([(v, i) for i, v in enumerate(values[:3])], "k string, r int")
    joined = asof_join(left.withColumn("k", F.col("k").cast(kind)), right.withColumn("k", F.col("k").cast(kind)), "k", None, "left", ["r"])
    assert {(r.l, r.r) for r in joined.collect()} == {(0, 1), (1, 2), (2, 2)}


def parts(df, order):
    counts = [r["count"] for r in with_ranges(df, order, "part").groupBy("part").count().collect()]
    return max(counts) / sum(counts)


def test_ranges_are_cut_along_all_columns(spark):
    rows = spark.range(4_000)
    same = rows.select(F.lit(1).alias("a"), F.lit("one").alias("b"), F.lit(None).cast("int").alias("c"), "id")
    assert parts(same, ["a", "b", "c", "id"]) < 0.2
    mixed = rows.select(F.when(F.col("id") % 3 > 0, "error").otherwise(F.col("id").cast("string")).alias("a"), "id")
    assert parts(mixed, ["a", "id"]) < 0.2
    got = running_totals(same, ["a", "b", "c", "id"], {"before": F.col("id")}, "place").collect()
    assert all(r.place == r.id + 1 and r.before == r.id * (r.id - 1) // 2 for r in got)


def test_texts_behind_one_order_value_keep_their_order(spark):
    names = [f"prefix-is-long-{i:05}" for i in range(500)] + ["prefix"] * 400
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(names)], "k string, i int")
    got = running_totals(rows, ["k", "i"], number="n").orderBy("n").collect()
    assert [(r.k, r.i) for r in got] == sorted((v, i) for i, v in enumerate(names))


def test_a_null_group_is_split_and_read_once(spark):
    rows, seen = counted(spark, spark.range(3_000).select(F.when(F.col("id") % 2 == 0, F.lit("g")).alias("g"), "id", F.lit(2).alias("v")))
    got = running_totals(rows, ["id"], {"before": F.col("v")}, "place", group=["g"], hot_rows=100)
    assert all(r.place == r.id // 2 + 1 and r.before == 2 * (r.id // 2) for r in got.collect())
    # Once to find the large groups, once to store them.
    assert seen.value == 2 * 3_000
    whole, seen = counted(spark, spark.range(3_000))
    assert running_totals(whole, ["id"], number="place").count() == 3_000
    assert seen.value == 3_000


@pytest.mark.parametrize("bad", [(None, 0.5), (2, 0.5), (1, None), (0, float("nan"))])
def test_curves_refuse_other_labels_and_missing_scores(spark, bad):
    rows = spark.createDataFrame([(1, 0.9, 1), (0, 0.1, 1), (*bad, 1)], "label int, score double, g int")
    for run in (roc_auc, roc_points, pr_points, lambda df: roc_auc_by(df, ["g"])):
        with pytest.raises(Exception, match="labels must be 0 or 1|a score is null"):
            run(rows).collect()


def broken(spark, df):
    return df.withColumn("ts", F.when(F.rand() < 2, F.raise_error(F.lit("broken"))).cast("timestamp_ntz"))


@pytest.mark.parametrize("versioned", [False, True])
def test_a_failed_replacement_keeps_the_table(spark, tmp_path, versioned):
    path = str(tmp_path / "t")
    good = moments(spark, 100, "k")
    assert replace_table(good, path, versioned=versioned) == 100
    with pytest.raises(Exception, match="broken"):
        replace_table(broken(spark, good), path, versioned=versioned)
    assert read_table(spark, path).count() == 100
    before = read_table(spark, path)
    # A table may be replaced by what is read from it.
    assert replace_table(read_table(spark, path).filter("k < 40"), path, "timestamp", versioned=versioned) == 40
    assert read_table(spark, path).count() == 40
    if versioned:
        assert before.count() == 100
        for i in range(4):
            replace_table(good.limit(i + 1), path, versioned=True)
        assert read_table(spark, path).count() == 4
        assert len([p for p in Path(path).iterdir() if p.name.startswith("_version")]) == 2


def test_any_number_of_categories(spark, monkeypatch):
    labels = 200_000
    rows = spark.range(300_000).select(
        F.col("id"), F.concat(F.lit("c"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % labels).cast("string")).alias("wide"),
        F.when(F.col("id") % 2 == 0, "even").alias("few"),
    )
    learned = rows.filter("id < 250000")
    names = category_dictionary(learned, ["wide", "few"])
    known = names.filter("column_name = 'wide'").count()
    assert known > 130_000
    found = category_slots(rows, names, ["wide", "few"])
    assert found.count() == 300_000
    monkeypatch.setattr(encode, "SENT_LABELS", 1_000)
    again = category_slots(rows, names, ["wide", "few"])
    assert found.select("id", "wide_slot", "few_slot").exceptAll(again.select("id", "wide_slot", "few_slot")).isEmpty()
    assert found.filter("few is null and few_slot is not null or few is not null and few_slot is null").isEmpty()
    by_label = found.filter("wide_slot is not null").select("wide", "wide_slot").distinct().orderBy("wide").collect()
    assert [r.wide_slot for r in by_label] == list(range(known))
    unseen = found.filter("wide_slot is null").agg(F.min("id")).first()[0]
    vectors = one_hot_vectors(rows.filter(F.col("id").isin(0, 7, unseen)), names, ["wide", "few"]).orderBy("id").collect()
    assert {v.categories.size for v in vectors} == {known + 1}
    assert [len(v.categories.indices) for v in vectors] == [2, 1, int(unseen % 2 == 0)]
    assert vectors[0].categories.indices[0] == vectors[1].categories.indices[0] - 0 or vectors[0].wide != vectors[1].wide


def test_local_sessions_need_no_setting():
    """A plain local session without ``spark.checkpoint.dir`` writes below a folder of its own."""
    code = """
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        assert spark.conf.get("spark.checkpoint.dir", "") == ""
        from millwright.session import fresh_path, shared_dir
        from millwright.operators.prefix import running_totals
        assert shared_dir(spark) == shared_dir(spark) and fresh_path(spark, "x").startswith(shared_dir(spark))
        print("rows", running_totals(spark.range(50), ["id"], number="n").count())
    """
    empty = fresh_conf()
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=240,
        cwd=Path(__file__).resolve().parent.parent, env=empty,
    )
    assert "rows 50" in run.stdout, run.stderr[-2000:]


def fresh_conf():
    """The environment with an empty Spark configuration folder."""
    import os
    import tempfile

    return {**os.environ, "SPARK_CONF_DIR": tempfile.mkdtemp(prefix="conf-")}


def test_workers_get_the_package_from_any_folder(tmp_path):
    code = f"""
        import sys
        sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
        from millwright.session import local_session, ship
        spark = local_session("2", 2)
        ship(spark)
        from millwright.operators.profile import correlations
        rows = spark.range(100).selectExpr("double(id) as a", "double(id * id) as b")
        print("pairs", correlations(rows, ["a", "b"]).count())
    """
    import os

    env = {k: v for k, v in fresh_conf().items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=240, cwd=tmp_path, env=env
    )
    assert "pairs 4" in run.stdout, run.stderr[-2000:]
    assert os.listdir(tmp_path) == [] or "metastore_db" not in os.listdir(tmp_path)


def test_intermediates_can_be_dropped():
    code = """
        import os
        from millwright.session import application_dir, drop_intermediates, local_session, stored
        spark = local_session("2", 2)
        rows = stored(spark.range(10), "x")
        assert rows.count() == 10 and os.path.isdir(application_dir(spark).replace("file:", ""))
        assert drop_intermediates(spark) and not os.path.exists(application_dir(spark).replace("file:", ""))
        print("dropped")
    """
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=240,
        cwd=Path(__file__).resolve().parent.parent, env=fresh_conf(),
    )
    assert "dropped" in run.stdout, run.stderr[-2000:]


@pytest.fixture(scope="module")
def fused(spark):
    numbers = [(F.rand(i) * 100).alias(c) for i, c in enumerate(NUMERIC_FEATURES)]
    rows = spark.range(900).select("id", *numbers, *[(F.col("id") % 4).cast("int").alias(c) for c in CATEGORICAL_FEATURES])
    first, second = NUMERIC_FEATURES[:2]
    return stored(rows.withColumn("machine_failure", (F.col(first) + F.col(second) > 120).cast("int")), "fused")


def test_streamed_rows_keep_their_key_and_a_restart_repeats_nothing(spark, fused, tmp_path):
    model = fit_forest(fused, Recipe(**SMALL))
    schema = request_schema([fused.schema["id"]])
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    lines = fused.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    lines.repartition(6).write.parquet(source)
    for _ in range(2):
        score_stream_by_batch(request_stream(spark, source, schema, files_per_batch=2), model, target, state).awaitTermination()
    got = spark.read.parquet(target)
    assert got.select("batch").distinct().count() == 3 and got.count() == 900
    assert got.drop("batch").exceptAll(score(lines, model)).isEmpty()
    # A batch that is run again takes its own place.
    third = got.filter("batch = 2").drop("batch")
    score_again = stored(third, "again")
    score_again.write.mode("overwrite").parquet(f"{target}/batch=2")
    assert spark.read.parquet(target).count() == 900


def test_streamed_batches_of_large_files_are_dealt_over_the_cores(spark, fused, monkeypatch, tmp_path):
    from millwright.streaming import scoring

    model, schema, cores = fit_forest(fused, Recipe(**SMALL)), request_schema([fused.schema["id"]]), spark.sparkContext.defaultParallelism
    lines = fused.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    lines.coalesce(1).write.parquet(str(tmp_path / "in"))
    files = {}
    for least in (901, 900):
        monkeypatch.setattr(scoring, "SPREAD_ROWS", least)
        target = str(tmp_path / f"out-{least}")
        score_stream_by_batch(request_stream(spark, str(tmp_path / "in"), schema), model, target, str(tmp_path / f"state-{least}")).awaitTermination()
        got = spark.read.parquet(target).drop("batch")
        files[least] = len(list((tmp_path / f"out-{least}").glob("*/*.parquet")))
        assert got.count() == 900 and got.exceptAll(score(lines, model)).isEmpty()
    assert files[901] == 1 and files[900] > cores


def test_large_tables_in_few_splits_are_scored_by_all_cores(spark, fused, monkeypatch):
    from millwright.models import score as scoring

    model, one = fit_forest(fused, Recipe(**SMALL)), fused.coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert scoring.score_spread(one, model).rdd.getNumPartitions() == 1
    monkeypatch.setattr(scoring, "SPREAD_ROWS", 900)
    even = fused.repartition(cores)
    assert scoring.score_spread(even, model).rdd.getNumPartitions() == cores
    dealt = scoring.score_spread(one, model)
    assert dealt.rdd.getNumPartitions() > cores
    assert sorted(dealt.collect()) == sorted(score(fused, model).collect())
    part, seen = counted(spark, one.filter("id % 5 = 0"))
    found = scoring.score_spread(part, model, like=one)
    # The table tells how the part lies: the part itself is gone through only to be scored.
    assert seen.value == 0 and found.count() == 180 and found.rdd.getNumPartitions() > cores


def test_evaluation_and_holdout_deal_large_splits_over_the_cores(spark, fused, monkeypatch):
    from millwright.models import score as scoring
    from millwright.plans import evaluation, training

    monkeypatch.setattr(scoring, "SPREAD_ROWS", 900)
    dealt, spread = [], scoring.spread

    def noted(*args):
        dealt.append(spread(*args).rdd.getNumPartitions())
        return spread(*args)

    monkeypatch.setattr(scoring, "spread", noted)
    one = fused.coalesce(1)
    evaluation.evaluate(one, fit_forest(fused, Recipe(**SMALL)), ["id"], ["id"])
    training.train_with_holdout(one, ["id"], "machine_failure", exclude=["id"], **SMALL)
    assert len(dealt) == 2 and min(dealt) > spark.sparkContext.defaultParallelism


def test_cross_validation_reduces_to_the_same_metrics(spark, fused):
    recipe = Recipe(**SMALL)
    metrics = {(r.fold, r.metric): r.value for r in cross_validate(fused, recipe, ["id"]).collect()}
    scored = [r for r in fold_scores(fused, recipe, ["id"]).collect()]
    for fold in range(5):
        own = [r for r in scored if r.fold == fold]
        hits = sum(r.label == r.prediction == 1 for r in own)
        wrong = sum(r.label != r.prediction for r in own)
        assert metrics[fold, "accuracy"] == pytest.approx(1 - wrong / len(own))
        assert metrics[fold, "f1"] == pytest.approx(2 * hits / (2 * hits + wrong))
        pos, neg = ([r.score for r in own if r.label == c] for c in (1, 0))
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert metrics[fold, "roc_auc"] == pytest.approx(want)


def test_learning_curve_is_bounded_and_repeats(spark, fused):
    recipe = Recipe(**SMALL)
    curve = lambda df, **more: sorted(map(tuple, learning_curve(df, recipe, ["id"], fractions=[0.5, 1.0], **more).collect()))
    one = curve(fused, most_rows=500)
    # Folds are dealt by class, so they differ by a row or two.
    assert len(one) == 20 and all(abs(r[2] - 400 * r[1]) <= 2 for r in one)
    assert curve(fused.repartition(7), most_rows=500) == one
    whole = curve(fused, most_rows=None)
    assert sum(r[2] for r in whole if r[1] == 1.0 and r[3] == "train") == 4 * 900
    assert all(r[4] > 0.8 for r in whole if r[3] == "validation" and r[1] == 1.0)


def test_kept_nodes_change_no_model_and_bound_the_fits_at_once(spark, fused, monkeypatch):
    from millwright.models import train, validate

    recipe, at_once, each = Recipe(**SMALL), [], validate._each

    def noted(session, work, tasks, parallel):
        at_once.append(parallel)
        return each(session, work, tasks, parallel)

    monkeypatch.setattr(validate, "_each", noted)
    forests, folds = [], []
    # 900 rows x 5 trees: all nodes are kept, then none; of a fold with 720 rows two fit at once, then none.
    for most in (2 * 4500 - 1, 0):
        monkeypatch.setattr(train, "MOST_KEPT_NODES", most)
        forest = fit_forest(fused, recipe).stages[-1]
        assert forest.getCacheNodeIds() == (most > 0)
        forests.append(forest.toDebugString.split("\n", 1)[1])
        folds.append(sorted(map(tuple, fold_scores(fused, recipe, ["id"]).collect())))
    assert at_once == [2, 0] and forests[0] == forests[1] and folds[0] == folds[1]


def test_learning_curve_reads_a_table_once_for_its_sample(spark, fused):
    rows, seen = counted(spark, fused)
    points = learning_curve(rows, Recipe(**SMALL), ["id"], folds=2, fractions=[0.5, 1.0], most_rows=500)
    # Once for the categories, once for the sample; folds, steps and fits read the sample.
    assert points.count() == 8 and seen.value == 2 * fused.count()


def test_learning_curve_takes_all_rows_unless_told_otherwise(spark, fused):
    rows = fused.crossJoin(spark.range(13).select(F.col("id").alias("copy"))).withColumn("id", F.col("copy") * 900 + F.col("id"))
    points = learning_curve(rows, Recipe(trees=1, depth=2), ["id"], folds=2, fractions=[0.5, 1.0]).collect()
    whole = {r.fold: r.size for r in points if r.fraction == 1.0}
    assert sum(whole.values()) == 13 * 900
    assert all(r.size == whole[r.fold] // 2 for r in points if r.fraction == 0.5)


def test_failing_attributions_leave_the_other_reports(spark, fused, monkeypatch):
    from millwright.plans import evaluation

    model = fit_forest(fused, Recipe(**SMALL))

    def fail(*_, **__):
        raise MemoryError("too many leaves")

    monkeypatch.setattr(evaluation, "shap_values", fail)
    found = evaluation.evaluate(fused, model, ["id"], ["id"])
    assert "shap" not in found and "too many leaves" in found["shap_error"].first().error
    assert found["scored"].count() == 900 and found["metrics"].count() > 5 and found["importances"].count() == 10
