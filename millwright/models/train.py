"""The forest pipeline: scale numbers, one-hot categories, fit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from millwright.functions.columns import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from millwright.operators.encode import MOST_CATEGORIES
from millwright.operators.splits import with_class_weight

# The forest settings.
TREES = 100
SEED = 42
#: Rows x trees up to which fits keep the node of each row in each tree, four bytes a cell and twice that
#: while a level is written. Above, the kept nodes would push the rows themselves out of memory.
MOST_KEPT_NODES = 1_000_000_000


@dataclass(frozen=True)
class Recipe:
    """What to learn from and how. Depth and bins are Spark's: it has no "until pure"."""

    numeric: list[str] = field(default_factory=lambda: list(NUMERIC_FEATURES))
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL_FEATURES))
    label: str = TARGET
    balanced: bool = True
    trees: int = TREES
    depth: int = 15
    bins: int = 64
    seed: int = SEED
    #: Parts the rows are dealt to by their values; with the seed they alone decide the bags.
    partitions: int = 32


def check_categories(df: DataFrame, columns: list[str], most: int = MOST_CATEGORIES) -> None:
    """Raise before an id-like column turns into millions of one-hot slots."""
    if not columns:
        return
    seen = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in columns]).first().asDict()
    # An estimate decides only far from the limit.
    close = [c for c in columns if 0.8 * most < seen[c] < 1.25 * most]
    if close:
        seen |= df.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in close]).first().asDict()
    wide = [c for c in columns if seen[c] > most]
    if wide:
        raise ValueError(f"too many categories, leave out or group: {', '.join(wide)}")


def feature_stages(recipe: Recipe) -> list:
    """Unfitted stages that turn the columns of the recipe into ``features``.

    Unseen categories become all-zero slots; columns not named are left out.
    """
    stages = []
    parts = []
    if recipe.numeric:
        stages += [
            VectorAssembler(inputCols=recipe.numeric, outputCol="numeric_raw"),
            StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True),
        ]
        parts.append("numeric_scaled")
    if recipe.categorical:
        index = [f"{c}_index" for c in recipe.categorical]
        hot = [f"{c}_slots" for c in recipe.categorical]
        stages += [
            StringIndexer(
                inputCols=recipe.categorical,
                outputCols=index,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            # The indexer's extra "unseen" index is the last one, which the encoder drops.
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True, handleInvalid="error"),
        ]
        parts += hot
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def forest_of(recipe: Recipe, label: str, rows: int | None = None) -> RandomForestClassifier:
    """The unfitted forest over ``features``.

    With not too many ``rows`` a level of the trees goes on from the nodes that the last one found, which
    changes no model; else (or None) each row walks down from the root again.
    """
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        numTrees=recipe.trees,
        maxDepth=recipe.depth,
        maxBins=recipe.bins,
        featureSubsetStrategy="sqrt",
        seed=recipe.seed,
        cacheNodeIds=rows is not None and rows * recipe.trees <= MOST_KEPT_NODES,
        checkpointInterval=-1,
    )
    return forest.setWeightCol("weight") if recipe.balanced else forest


def forest_pipeline(recipe: Recipe, rows: int | None = None) -> Pipeline:
    """The unfitted pipeline: features, then the forest."""
    return Pipeline(stages=[*feature_stages(recipe), forest_of(recipe, recipe.label, rows)])


def arranged(rows: DataFrame, partitions: int) -> DataFrame:
    """The rows in a layout that depends on their values alone, not on how they came."""
    names = [F.col(f"`{c}`") for c in rows.columns]
    return rows.repartition(partitions, *names).sortWithinPartitions(*names)


def fit_forest(df: DataFrame, recipe: Recipe, kept: bool = False) -> PipelineModel:
    """Fit preprocessing and forest on ``df``, reading only the columns of the recipe.

    Each stage reads the rows once more, so they are kept meanwhile; ``kept``
    says that the caller has checked and persisted them already.
    """
    rows = df.select(
        *recipe.numeric, *recipe.categorical, F.col(f"`{recipe.label}`").cast("int").alias(recipe.label)
    )
    if not kept:
        check_categories(rows, recipe.categorical)
        rows = arranged(rows, recipe.partitions).persist()
    weighted = with_class_weight(rows, recipe.label) if recipe.balanced else rows
    # The copy leaves the training summary behind: it holds the session, and scoring
    # would have to ship it to the executors.
    model = forest_pipeline(recipe, rows.count()).fit(weighted).copy()
    if not kept:
        rows.unpersist()
    return model


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the slots of the feature vector, in order."""
    numeric: list[str] = []
    slots: list[str] = []
    for stage in model.stages:
        if isinstance(stage, VectorAssembler) and stage.getOutputCol() == "numeric_raw":
            numeric = stage.getInputCols()
        elif hasattr(stage, "labelsArray"):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                slots += [f"{column}_{label}" for label in labels]
    return list(numeric) + slots


def importances(model: PipelineModel, spark, rows: int = 10) -> DataFrame:
    """``feature, importance``: the ``rows`` most important feature slots; all of them sum to 1."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(feature_names(model), values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(rows)
