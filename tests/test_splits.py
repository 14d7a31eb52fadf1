"""Stratified splits, folds, prefixes, samples, weights."""

import random
from collections import Counter
from hashlib import md5

import pytest

from millwright.operators.splits import (
    class_weights,
    fixed_sample,
    prefix_sizes,
    size_fractions,
    stratified_split,
    with_class_weight,
    with_fold,
    with_prefix_step,
    with_test_flag,
)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    return spark.createDataFrame([(i * 3, int(rng.random() < 0.07)) for i in range(2003)], "k int, y int").repartition(6).cache()


def by_hash(rows, seed=42):
    return sorted(rows, key=lambda r: md5(f"{r.k}|{seed}".encode()).hexdigest())


def test_folds_follow_the_definition(labelled):
    got = {r.k: r.fold for r in with_fold(labelled, "y", ["k"]).collect()}
    rows = labelled.collect()
    for y in (0, 1):
        part = by_hash([r for r in rows if r.y == y])
        for place, row in enumerate(part):
            assert got[row.k] == place * 5 // len(part)


def test_fold_shares_within_one_row(labelled):
    counts = Counter((r.y, r.fold) for r in with_fold(labelled, "y", ["k"]).collect())
    for y in (0, 1):
        sizes = [counts[y, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_tiny_classes_are_still_placed(spark):
    df = spark.createDataFrame([(i, 0 if i < 20 else i) for i in range(23)], "k int, y int")
    rows = with_fold(df, "y", ["k"]).collect()
    assert len(rows) == 23 and all(0 <= r.fold < 5 for r in rows)
    split = with_test_flag(df, "y", ["k"]).collect()
    assert sum(r.is_test for r in split) == 4
    with pytest.raises(ValueError):
        with_fold(df.filter("k < 3"), "y", ["k"])


def test_split_is_disjoint_complete_and_stratified(labelled):
    train, test = stratified_split(labelled, "y", ["k"])
    a, b = {r.k for r in train.collect()}, {r.k for r in test.collect()}
    assert not a & b and len(a | b) == 2003
    sizes = Counter(r.y for r in labelled.collect())
    tested = Counter(r.y for r in test.collect())
    for y, n in sizes.items():
        assert tested[y] == int(n * 0.2 + 0.5)


def test_prefixes_are_nested_and_sized(labelled):
    steps = Counter(r.step for r in with_prefix_step(labelled, ["k"], size_fractions()).collect())
    total = 0
    for i in range(1, 11):
        total += steps[i]
        assert total == 2003 * i // 10
    with pytest.raises(ValueError):
        with_prefix_step(labelled.limit(3), ["k"], size_fractions())


def test_prefixes_of_many_rows_lose_none():
    for rows in (10, 41_943_050, 172_800_000):
        assert prefix_sizes(rows, size_fractions()) == [i * rows // 10 for i in range(1, 11)]


def test_sample_is_fixed(labelled):
    a = {r.k for r in fixed_sample(labelled, ["k"], 100).collect()}
    b = {r.k for r in fixed_sample(labelled.repartition(3), ["k"], 100).collect()}
    assert a == b == {r.k for r in by_hash(labelled.collect())[:100]}
    assert fixed_sample(labelled.limit(7), ["k"], 100).count() == 7


def test_splits_move_no_rows(spark, labelled, tmp_path):
    labelled.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for split in (with_fold(stored, "y", ["k"]), with_test_flag(stored, "y", ["k"]), with_prefix_step(stored, ["k"], size_fractions())):
        assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


def test_class_weights_golden(spark):
    df = spark.createDataFrame([(0,)] * 1932 + [(1,)] * 68, "y int")
    assert {r.label: r.weight for r in class_weights(df, "y").collect()} == {0: 2000 / (2 * 1932), 1: 2000 / (2 * 68)}
    assert with_class_weight(df, "y").filter("y = 1").first().weight == 2000 / (2 * 68)


def test_repeated_keys_share_their_place(spark):
    """A third of the rows with one key: the expected places are wrong, the cut hashes still right."""
    df = spark.createDataFrame([(0 if i % 3 == 0 else i, 0) for i in range(3000)], "k int, y int")
    folds = {}
    for r in with_fold(df, "y", ["k"]).collect():
        folds.setdefault(r.k, set()).add(r.fold)
    assert all(len(f) == 1 for f in folds.values()) and {f for s in folds.values() for f in s} <= set(range(5))
    rows = by_hash(df.collect())
    for place in (0, 500, 1700, 2999):
        if rows[place].k:
            assert folds[rows[place].k] == {place * 5 // 3000}
