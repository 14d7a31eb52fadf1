"""Forests: encoding, persistence, validation, explanation, whole jobs, streaming."""

import math
import random
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from millwright.functions.columns import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from millwright.models import explain
from millwright.models.explain import mean_attributions, node_table, shap_values
from millwright.models.score import feature_arrays, score, score_csv
from millwright.models.train import Recipe, check_categories, feature_names, fit_forest, importances
from millwright.models.validate import cross_validate, learning_curve
from millwright.operators.encode import categories, one_hot, scale_parameters, scaled, slots
from millwright.plans.evaluation import evaluate
from millwright.plans.training import train_engineered, train_fused, train_with_holdout
from millwright.queries import models
from millwright.sources.files import SENSOR_SCHEMA, read_csv, write_csv
from millwright.sources.models import load_model, save_model
from millwright.streaming.scoring import REQUEST_SCHEMA, request_stream, score_stream

SMALL = dict(trees=5, depth=4)


def fused_rows(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        speed, torque = rng.uniform(1200, 2800), rng.uniform(10, 70)
        rows.append(
            (
                i, datetime(2020, 1, 1) + timedelta(seconds=10 * i), rng.uniform(295, 305), rng.uniform(305, 314),
                speed, torque, float(rng.randrange(250)), float(rng.randrange(10)), float(rng.randrange(30)),
                rng.randrange(1, 6), int(speed * torque > 120_000),
            )
        )
    return rows


FUSED = "UDI int, timestamp timestamp_ntz, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES) + ", machine_id int, machine_failure int"


@pytest.fixture(scope="module")
def fused(spark):
    return spark.createDataFrame(fused_rows(), FUSED).cache()


@pytest.fixture(scope="module")
def model(fused):
    return fit_forest(fused, Recipe(**SMALL))


def test_learns_and_scores_every_row_once(fused, model):
    rows = score(fused, model).collect()
    assert len(rows) == 600 and set(rows[0].asDict()) == {*fused.columns, "predicted_failure", "failure_prob"}
    assert sum(r.predicted_failure == r.machine_failure for r in rows) > 540
    assert all(0 <= r.failure_prob <= 1 and r.predicted_failure == int(r.failure_prob > 0.5) for r in rows if r.failure_prob != 0.5)


def test_unseen_category_gives_zero_slots(fused, model):
    names = feature_names(model)
    assert names == NUMERIC_FEATURES + [f"machine_id_{i}" for i in range(1, 6)]
    strange = fused.limit(1).withColumn("machine_id", F.lit(99))
    assert feature_arrays(strange, model, ["UDI"]).first().features[-5:] == [0.0] * 5
    known = fused.filter("machine_id = 2").limit(1)
    assert feature_arrays(known, model, ["UDI"]).first().features[-5:] == [0.0, 1.0, 0.0, 0.0, 0.0]


def test_one_hot_and_scaling(spark):
    train = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 8.0)], "m int, x double")
    labels = categories(train, ["m"])
    assert slots(labels) == ["m_1", "m_2", "m_3"]
    row = one_hot(spark.createDataFrame([(99,)], "m int"), labels).first()
    assert (row.m_1, row.m_2, row.m_3) == (0, 0, 0)
    z = [r.x_scaled for r in scaled(train, scale_parameters(train, ["x"])).collect()]
    assert sum(z) == pytest.approx(0) and sum(v * v for v in z) / 3 == pytest.approx(1)
    with pytest.raises(ValueError, match="categories"):
        categories(spark.range(50), ["id"], most=10)
    with pytest.raises(ValueError, match="id"):
        check_categories(spark.range(500), ["id"], most=10)


def test_stored_model_scores_the_same(fused, model, tmp_path):
    again = load_model(save_model(model, str(tmp_path / "m")))
    save_model(model, str(tmp_path / "m"))
    assert score(fused, again).exceptAll(score(fused, model)).count() == 0


def test_scoring_survives_an_observed_query(spark, fused):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    assert len(score(fused, fit_forest(fused, Recipe(trees=2, depth=2))).collect()) == 600


def test_importances_sum_to_one(spark, model):
    assert importances(model, spark, 100).agg(F.sum("importance")).first()[0] == pytest.approx(1)
    top = [r.feature for r in importances(model, spark).collect()]
    assert len(top) == 10 and {"rot_speed_rpm", "torque_Nm"} <= set(top[:3])


def conditional(nodes, at, x, known):
    """The tree's expectation when only the features in ``known`` are given."""
    node = nodes[at]
    if node.left < 0:
        return node.stats[1] / sum(node.stats)
    left, right = nodes[node.left], nodes[node.right]
    if node.feature in known:
        value = x[node.feature]
        goes_left = (value in list(node.test)) if node.kinds > 0 else value <= node.test[0]
        return conditional(nodes, node.left if goes_left else node.right, x, known)
    weight = sum(node.stats)
    return (
        sum(left.stats) * conditional(nodes, node.left, x, known)
        + sum(right.stats) * conditional(nodes, node.right, x, known)
    ) / weight


def test_shap_equals_the_shapley_definition(spark, fused):
    recipe = Recipe(numeric=["rot_speed_rpm", "torque_Nm", "tool_wear_min"], categorical=["machine_id"], trees=3, depth=4)
    narrow = fused.filter("machine_id <= 2")
    model = fit_forest(narrow, recipe)
    size = len(feature_names(model))
    trees = {}
    for row in node_table(model, spark).collect():
        trees.setdefault(row.tree, {})[row.id] = row
    got = {}
    for r in shap_values(narrow, model, ["UDI"], rows=6).collect():
        got.setdefault(r.UDI, []).append(r.shap)
    arrays = {r.UDI: r.features for r in feature_arrays(narrow, model, ["UDI"]).collect()}
    assert len(got) == 6
    for key, values in got.items():
        x = arrays[key]
        game = lambda s: sum(conditional(n, 0, x, set(s)) for n in trees.values()) / len(trees)
        for j in range(size):
            others = [k for k in range(size) if k != j]
            want = sum(
                math.factorial(len(s)) * math.factorial(size - len(s) - 1) / math.factorial(size) * (game((*s, j)) - game(s))
                for m in range(size)
                for s in combinations(others, m)
            )
            assert values[j] == pytest.approx(want, abs=1e-9)


def test_shap_adds_up_and_all_rows_can_be_asked_for(fused, model):
    rows = shap_values(fused, model, ["UDI"], rows=None)
    sums = rows.groupBy("UDI").agg((F.sum("shap") + F.max("base")).alias("s"), F.max("failure_prob").alias("p"))
    assert sums.count() == 600
    assert sums.filter(F.abs(F.col("s") - F.col("p")) > 1e-9).count() == 0
    assert mean_attributions(rows).count() == len(feature_names(model))


def test_shap_of_a_forest_beyond_one_task(fused, model, monkeypatch):
    whole = {(r.UDI, r.feature): r.shap for r in shap_values(fused, model, ["UDI"], rows=40).collect()}
    monkeypatch.setattr(explain, "MOST_CELLS", 50)
    monkeypatch.setattr(explain, "BLOCK_ROWS", 16, raising=False)
    found = evaluate(fused, model, ["UDI"], ["timestamp", "UDI"], explain_rows=40)
    parts = {(r.UDI, r.feature): r.shap for r in found["shap"].collect()}
    assert parts == pytest.approx(whole, abs=1e-12) and len(parts) == 40 * len(feature_names(model))
    assert found["shap_mean"].count() == len(feature_names(model))


def test_cross_validation_and_curve(fused):
    recipe = Recipe(trees=3, depth=3)
    folds = cross_validate(fused, recipe, ["UDI"], train_scores=True).collect()
    assert len(folds) == 5 * 2 * 3 and all(0 <= r.value <= 1 for r in folds)
    assert sum(r.value for r in folds if r.metric == "roc_auc" and r.split == "test") / 5 > 0.9
    curve = learning_curve(fused, recipe, ["UDI"], fractions=[0.5, 1.0]).collect()
    assert len(curve) == 2 * 5 * 2
    assert {r.size for r in curve if r.fraction == 1.0} == {480} and {r.size for r in curve if r.fraction == 0.5} == {240}


def raw_sensors(spark, n=400):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        speed, torque = rng.uniform(1200, 2800), rng.uniform(10, 70)
        fail = int(speed * torque > 125_000)
        rows.append((i + 1, f"M{i}", rng.choice("LMH"), 300.0, 310.0 + rng.random(), speed, torque, float(i % 200), fail, 0, 0, fail, 0, 0))
    return spark.createDataFrame(rows, SENSOR_SCHEMA)


def test_holdout_job(spark, tmp_path):
    trained = train_with_holdout(raw_sensors(spark), ["UDI"], folder=str(tmp_path), **SMALL)
    names = feature_names(trained.model)
    assert not {"UDI", "PWF"} & set(names) and {"Type_H", "Type_L", "Type_M"} <= set(names)
    rows = trained.tables["metrics"].collect()
    assert next(r.value for r in rows if r.section == "roc_auc") > 0.9
    assert sum(r.value for r in rows if r.section == "confusion") == 80
    assert load_model(str(tmp_path / "model")).stages
    leaky = train_with_holdout(raw_sensors(spark).drop("Product ID"), ["UDI"], exclude=[], **SMALL)
    assert {"UDI", "PWF"} <= set(feature_names(leaky.model))


def test_engineered_job(spark):
    trained = train_engineered(raw_sensors(spark), ["UDI"], trees=3, depth=3, curve_settings={"trees": 1, "depth": 2})
    assert "speed_x_torque" in feature_names(trained.model)
    assert trained.tables["cv_summary"].count() == 3
    assert trained.tables["learning_curve"].count() == 10 * 2


def test_fused_job_and_evaluation(fused, spark):
    trained = train_fused(fused, ["UDI"], **SMALL)
    assert {r.metric for r in trained.tables["cv_summary"].collect()} == {"accuracy", "f1", "roc_auc"}
    found = evaluate(fused, trained.model, ["UDI"], ["timestamp", "UDI"], explain_rows=50)
    assert found["scored"].count() == 600 and found["shap"].select("UDI").distinct().count() == 50
    assert found["importances"].count() == 10 and found["roc"].count() == found["pr"].count()
    assert found["false_cases"].count() <= 20
    with pytest.raises(KeyError, match="torque_Nm"):
        evaluate(fused.drop("torque_Nm"), trained.model, ["UDI"], ["UDI"])
    with pytest.raises(ValueError, match="no rows"):
        evaluate(fused.limit(0), trained.model, ["UDI"], ["UDI"])


def test_stream_equals_batch(spark, fused, model, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = fused.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA.fields])
    rows.repartition(5).write.parquet(source)
    for _ in range(2):  # the second start finds nothing new
        score_stream(request_stream(spark, source, files_per_batch=2), model, target, state).awaitTermination()
    got = spark.read.parquet(target)
    assert got.count() == 600
    assert got.exceptAll(score(rows, model)).count() == 0


def test_score_csv_round_trip(spark, fused, model, tmp_path):
    source = write_csv(fused, str(tmp_path / "in"))
    back = read_csv(spark, source, fused.schema)
    assert back.exceptAll(fused).count() == 0
    path = save_model(model, str(tmp_path / "m"))
    scored = read_csv(spark, score_csv(spark, path, source, str(tmp_path / "out")))
    assert scored.count() == 600 and {"predicted_failure", "failure_prob"} <= set(scored.columns)


def test_registered_models_use_the_whole_recipe(spark, sf_dir, monkeypatch):
    used = []

    class Stop(Exception):
        pass

    def caught(df, recipe, *rest, **more):
        used.append(recipe)
        raise Stop

    for name in ("fit_forest", "cross_validate", "learning_curve"):
        monkeypatch.setattr(models, name, caught)
    for query in models.QUERIES.values():
        with pytest.raises(Stop):
            query(spark, sf_dir)
    assert len(used) == len(models.QUERIES) and {(r.trees, r.depth) for r in used} == {(100, 15)}
