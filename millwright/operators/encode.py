"""Scaling and one-hot encoding: fitted on one part of the rows, applied to any.

``categories``, ``one_hot`` and ``one_hot_slot`` are for few labels, which they make literals and columns of;
``category_dictionary``, ``category_slots`` and ``one_hot_vectors`` take any number of labels.
"""

from __future__ import annotations

from itertools import chain

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from millwright.functions.columns import value_or_null
from millwright.operators.prefix import running_totals
from millwright.session import stored

# More categories than this point to an id column, not to a category: ``categories`` brings them to the driver.
MOST_CATEGORIES = 100_000
# Labels of a column that are sent to all executors; a longer dictionary is joined by a shuffle.
SENT_LABELS = 200_000


def scale_parameters(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, mean, scale``: mean and population deviation; a constant column gets scale 1."""
    cells = []
    for name in columns:
        x = value_or_null(df, name)
        spread = F.stddev_pop(x)
        cells.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.avg(x).alias("mean"),
                F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("scale"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def scaled(df: DataFrame, parameters: DataFrame, suffix: str = "_scaled") -> DataFrame:
    """Add standardised columns. The parameters are one row per column and become literals."""
    fitted = {row.column_name: row for row in parameters.collect()}
    return df.withColumns(
        {
            f"{name}{suffix}": (F.col(f"`{name}`").cast("double") - F.lit(row.mean)) / F.lit(row.scale)
            for name, row in fitted.items()
        }
    )


def categories(df: DataFrame, columns: list[str], most: int = MOST_CATEGORIES) -> dict[str, list[str]]:
    """The sorted distinct labels of each column, as text. More than ``most`` is an error."""
    found = {}
    for name in columns:
        labels = (
            df.select(F.col(f"`{name}`").cast("string").alias("label"))
            .filter("label is not null")
            .distinct()
            .orderBy("label")
            .limit(most + 1)
            .collect()
        )
        if len(labels) > most:
            raise ValueError(f"{name} has more than {most} categories; leave ids out of the features")
        found[name] = [row.label for row in labels]
    return found


def slots(labels: dict[str, list[str]]) -> list[str]:
    """Names of the one-hot slots, column by column in label order."""
    return [f"{name}_{label}" for name, column in labels.items() for label in column]


def one_hot(df: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
    """Add one 0/1 column per category; an unseen or missing label gives zeros throughout."""
    return df.withColumns(
        {
            f"{name}_{label}": F.coalesce((F.col(f"`{name}`").cast("string") == label).cast("int"), F.lit(0))
            for name, column in labels.items()
            for label in column
        }
    )


def one_hot_slot(df: DataFrame, name: str, labels: list[str], slot: str = "slot") -> DataFrame:
    """Add the 0-based slot of the row's only one; null when the label is unseen."""
    if not labels:
        return df.withColumn(slot, F.lit(None).cast("int"))
    places = F.create_map(*chain.from_iterable((F.lit(v), F.lit(i)) for i, v in enumerate(labels)))
    return df.withColumn(slot, F.try_element_at(places, F.col(f"`{name}`").cast("string")))


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, label, slot, rows``: every label of the columns as text, numbered from 0 in label order.

    A stored table with one row for each label, however many there are. Nulls have no slot.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("label")) for c in columns]
    labels = df.select(F.inline(F.array(*cells))).filter("label is not null")
    counted = stored(labels.groupBy("column_name", "label").agg(F.count(F.lit(1)).alias("rows")), "labels")
    numbered = running_totals(counted, ["label"], number="_place", group=["column_name"])
    return stored(numbered.select("column_name", "label", (F.col("_place") - 1).alias("slot"), "rows"), "dictionary")


def category_slots(df: DataFrame, dictionary: DataFrame, columns: list[str], suffix: str = "_slot") -> DataFrame:
    """Add each column's slot; null for a label that is not in the dictionary.

    A long dictionary is joined by a shuffle, but for the labels that hold more than an even share of
    the rows: those, fewer than ``SENT_LABELS``, are looked up without it, so no task gets a frequent label.
    """
    sizes = {r.column_name: (r.n, r.rows) for r in dictionary.groupBy("column_name").agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).collect()}
    for name in columns:
        own, total = sizes.get(name, (0, 0))
        text = F.col(f"`{name}`").cast("string")
        entry = dictionary.filter(F.col("column_name") == name).select(F.col("label").alias("_label"), F.col("slot").alias(f"{name}{suffix}"), "rows")
        if own <= SENT_LABELS:
            df = df.join(F.broadcast(entry.drop("rows")), text == F.col("_label"), "left").drop("_label")
            continue
        least = total / SENT_LABELS
        often = entry.filter(F.col("rows") > least).select("_label", F.col(f"{name}{suffix}").alias("_often"))
        rest = entry.filter(F.col("rows") <= least).drop("rows")
        marked = df.join(F.broadcast(often), text == F.col("_label"), "left").drop("_label")
        # Rows whose slot is known, or that have no label, are spread by a key that matches nothing.
        key = F.when(F.col("_often").isNull(), F.concat(F.lit("v"), text))
        key = F.coalesce(key, F.concat(F.lit("n"), F.pmod(F.monotonically_increasing_id(), F.lit(1024)).cast("string")))
        joined = marked.withColumn("_key", key).join(rest.withColumn("_key", F.concat(F.lit("v"), "_label")), "_key", "left")
        df = joined.withColumn(f"{name}{suffix}", F.coalesce("_often", f"{name}{suffix}")).drop("_often", "_key", "_label")
    return df


def one_hot_vectors(df: DataFrame, dictionary: DataFrame, columns: list[str], name: str = "categories") -> DataFrame:
    """Add one sparse vector with a one at the slot of each column's label, column after column.

    The vector is as long as the dictionary; an unseen or missing label leaves its column's part zero.
    """
    sizes = {r.column_name: r["count"] for r in dictionary.groupBy("column_name").count().collect()}
    used = [c for c in columns if sizes.get(c)]
    slots_of = [f"_{c}_slot" for c in used]
    indexed = reduce(
        lambda out, c: out.withColumnRenamed(f"{c}_slot_", f"_{c}_slot"), used, category_slots(df, dictionary, used, "_slot_")
    )
    for c, slot in zip(used, slots_of):
        # One index more, for unseen labels, which the encoder drops; the sizes are told, not looked for.
        about = {"ml_attr": {"type": "nominal", "num_vals": sizes[c] + 1}}
        indexed = indexed.withColumn(slot, F.coalesce(F.col(slot), F.lit(sizes[c])).cast("double"))
        indexed = indexed.withMetadata(slot, about)
    hot = [f"{slot}_hot" for slot in slots_of]
    encoder = OneHotEncoder(inputCols=slots_of, outputCols=hot, dropLast=True, handleInvalid="error")
    encoded = encoder.fit(indexed).transform(indexed)
    return VectorAssembler(inputCols=hot, outputCol=name).transform(encoded).drop(*slots_of, *hot)
