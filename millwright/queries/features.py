"""Engineered features, scaling, one-hot slots."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.columns import categorical_columns, columns_by_role, numeric_columns
from millwright.functions.features import engineered, with_interactions, with_powers, with_wear_rate
from millwright.models.train import Recipe, feature_names, feature_stages
from millwright.operators.encode import categories, one_hot, one_hot_slot, scale_parameters, scaled
from millwright.queries.profile import LINE_NUMBERS
from millwright.queries.views import LINE_KEY, LINE_ORDER, LINE_ROLES, digits, q, table


def features_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = with_interactions(table(spark, sf_dir, "lineitem"), LINE_ROLES)
    return digits(added.select(*LINE_KEY, "speed_x_torque", "temp_diff"), ["speed_x_torque", "temp_diff"])


def features_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wear per speed; the tax serves as a second speed that is often zero."""
    lines = table(spark, sf_dir, "lineitem")
    both = with_wear_rate(lines, LINE_ROLES).withColumnRenamed("wear_rate", "rate_by_price")
    both = with_wear_rate(both, {**LINE_ROLES, "speed": "l_tax"})
    return digits(both.select(*LINE_KEY, "rate_by_price", "wear_rate"), ["rate_by_price", "wear_rate"])


def features_poly(spark: SparkSession, sf_dir: str) -> DataFrame:
    core = [LINE_ROLES[r] for r in ("air", "process", "speed", "torque", "wear")]
    powers = [f"{c}_{p}" for c in core for p in ("squared", "cubed")]
    return with_powers(table(spark, sf_dir, "lineitem"), core).select(*LINE_KEY, *powers)


def scale_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the open lines; the constant gets scale 1."""
    train = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'").withColumn("constant", F.lit(3))
    return digits(scale_parameters(train, [*LINE_NUMBERS, "constant"]), ["mean", "scale"])


def scale_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of the open lines applied to all lines."""
    lines = table(spark, sf_dir, "lineitem")
    fitted = scale_parameters(lines.filter("l_linestatus = 'O'"), LINE_NUMBERS)
    names = [f"{c}_scaled" for c in LINE_NUMBERS]
    return digits(scaled(lines, fitted).select(*LINE_KEY, *names), names)


def onehot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of the return flag, learned without the N lines, so that N has none."""
    lines = table(spark, sf_dir, "lineitem")
    labels = categories(lines.filter("l_returnflag <> 'N'"), ["l_returnflag"])["l_returnflag"]
    return one_hot_slot(lines, "l_returnflag", labels).select(*LINE_KEY, "l_returnflag", "slot")


def onehot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    labels = categories(lines.filter("l_returnflag <> 'N'"), ["l_returnflag", "l_linenumber"])
    names = [f"{c}_{v}" for c, values in labels.items() for v in values]
    return one_hot(lines, labels).select(*LINE_KEY, *names)


def select_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the line items, and their text columns joined into one."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        *numeric_columns(lines), F.concat_ws("/", *categorical_columns(lines)).alias("texts")
    )


def engineered_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under raw sensor headers: the roles are found by their text, then engineered."""
    raw = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.col("l_discount").alias("Air temperature [K]"),
        F.col("l_tax").alias("Process temperature [K]"),
        F.col("l_extendedprice").alias("Rotational speed [rpm]"),
        F.col("l_quantity").alias("Torque [Nm]"),
        F.col("l_linenumber").alias("Tool wear [min]"),
        (F.col("l_returnflag") == "R").cast("int").alias("Machine failure"),
    )
    roles = columns_by_role(raw)
    rich = engineered(raw, roles)
    return digits(
        rich.select(
            *LINE_KEY, "speed_x_torque", "temp_diff", "wear_rate",
            F.col(f"`{roles['torque']}_squared`").alias("torque_squared"),
            F.col(f"`{roles['wear']}_cubed`").alias("wear_cubed"),
            F.col(f"`{roles['target']}`").alias("target"),
        ),
        ["speed_x_torque", "temp_diff", "wear_rate"],
    )


def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector slot by slot: scaled numbers, then one slot per category.

    The pipeline's scaler divides by the sample deviation; trees do not mind.
    """
    lines = table(spark, sf_dir, "lineitem")
    recipe = Recipe(numeric=["l_quantity", "l_discount"], categorical=["l_linenumber", "l_returnflag"])
    train = lines.filter("l_returnflag <> 'N'")
    model = Pipeline(stages=feature_stages(recipe)).fit(train)
    names = feature_names(model)
    dense = model.transform(lines).select(*LINE_KEY, vector_to_array("features").alias("slots"))
    return digits(
        dense.select(*LINE_KEY, *[F.get("slots", F.lit(i)).alias(f"f_{n}") for i, n in enumerate(names)]),
        ["f_l_quantity", "f_l_discount"],
    )


QUERIES = {
    "select_by_type": select_by_type,
    "engineered_by_role": engineered_by_role,
    "feature_columns": feature_columns,
    "features_interaction": features_interaction,
    "features_ratio": features_ratio,
    "features_poly": features_poly,
    "scale_params": scale_params,
    "scale_apply": scale_apply,
    "onehot_long": onehot_long,
    "onehot_wide": onehot_wide,
}

_CORE = ["l_discount", "l_tax", "l_extendedprice", "l_quantity", "l_linenumber"]


def _power(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"{x} * {x} AS {c}_squared, {x} * {x} * {x} AS {c}_cubed"


ORACLES = {
    "select_by_type": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               concat(l_returnflag, '/', l_linestatus) AS texts
        FROM lineitem
    """,
    "engineered_by_role": f"""
        SELECT {LINE_ORDER}, {q('l_extendedprice * l_quantity')} AS speed_x_torque, {q('l_discount - l_tax')} AS temp_diff,
               {q('l_linenumber / (l_extendedprice + CAST(1e-8 AS DOUBLE))')} AS wear_rate,
               l_quantity * l_quantity AS torque_squared,
               CAST(l_linenumber AS DOUBLE) * l_linenumber * l_linenumber AS wear_cubed,
               CAST(l_returnflag = 'R' AS INT) AS target
        FROM lineitem
    """,
    "feature_columns": f"""
        WITH fitted AS (
            SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_discount) AS dm, stddev_samp(l_discount) AS ds
            FROM lineitem WHERE l_returnflag <> 'N'
        )
        SELECT {LINE_ORDER}, {q('(l_quantity - qm) / qs')} AS f_l_quantity, {q('(l_discount - dm) / ds')} AS f_l_discount,
               {', '.join(f'CAST(l_linenumber = {v} AS DOUBLE) AS f_l_linenumber_{v}' for v in range(1, 8))},
               {', '.join(f"CAST(l_returnflag = '{v}' AS DOUBLE) AS f_l_returnflag_{v}" for v in 'AR')}
        FROM lineitem, fitted
    """,
    "features_interaction": f"""
        SELECT {LINE_ORDER}, {q('l_extendedprice * l_quantity')} AS speed_x_torque,
               {q('l_discount - l_tax')} AS temp_diff
        FROM lineitem
    """,
    "features_ratio": f"""
        SELECT {LINE_ORDER}, {q('l_linenumber / (l_extendedprice + CAST(1e-8 AS DOUBLE))')} AS rate_by_price,
               {q('l_linenumber / (l_tax + CAST(1e-8 AS DOUBLE))')} AS wear_rate
        FROM lineitem
    """,
    "features_poly": f"SELECT {LINE_ORDER}, {', '.join(_power(c) for c in _CORE)} FROM lineitem",
    "scale_params": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {q(f'avg({c})')} AS mean, {q(f'stddev_pop(CAST({c} AS DOUBLE))')} AS scale
            FROM lineitem WHERE l_linestatus = 'O'"""
        for c in LINE_NUMBERS
    )
    + " UNION ALL SELECT 'constant', 3.0, 1.0",
    "scale_apply": f"""
        WITH fitted AS (
            SELECT {', '.join(f'avg({c}) AS {c}_mean, stddev_pop(CAST({c} AS DOUBLE)) AS {c}_scale' for c in LINE_NUMBERS)}
            FROM lineitem WHERE l_linestatus = 'O'
        )
        SELECT {LINE_ORDER}, {', '.join(q(f'({c} - {c}_mean) / {c}_scale') + f' AS {c}_scaled' for c in LINE_NUMBERS)}
        FROM lineitem, fitted
    """,
    "onehot_long": f"""
        SELECT {LINE_ORDER}, l_returnflag,
               CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END AS slot
        FROM lineitem
    """,
    "onehot_wide": f"""
        SELECT {LINE_ORDER}, {', '.join(f"CAST(l_returnflag = '{v}' AS INT) AS l_returnflag_{v}" for v in 'AR')},
               {', '.join(f'CAST(l_linenumber = {v} AS INT) AS l_linenumber_{v}' for v in range(1, 8))}
        FROM lineitem
    """,
}
