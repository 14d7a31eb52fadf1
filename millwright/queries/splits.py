"""Class weights, splits, folds, prefixes, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.operators.splits import (
    class_weights,
    fixed_sample,
    size_fractions,
    with_class_weight,
    with_fold,
    with_prefix_step,
    with_test_flag,
)
from millwright.queries.views import LINE_KEY, LINE_ORDER, digits, event_scores, q, table

# The prefixes of the folds use a seed of their own.
LINE_HASH_43 = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '43'))"
LINE_HASH = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42'))"
EVENT_HASH = "md5(concat_ws('|', event_id, '42'))"
DOC_HASH = "md5(concat_ws('|', doc_id, '42'))"


def weights_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(class_weights(table(spark, sf_dir, "labels"), "toxic"), ["weight"])


def weighted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the balance weight of its class."""
    rows = with_class_weight(event_scores(spark, sf_dir), "label")
    return digits(rows.select("event_id", "label", "weight"), ["weight"])


def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_test_flag(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic", ["doc_id"])


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    return with_test_flag(lines, "l_returnflag", LINE_KEY)


def folds_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fold(event_scores(spark, sf_dir).select("event_id", "label"), "label", ["event_id"])


def folds_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fold(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic", ["doc_id"])


def nested_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest of the ten nested training parts each line belongs to."""
    return with_prefix_step(table(spark, sf_dir, "lineitem").select(*LINE_KEY), LINE_KEY, size_fractions())


def train_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each of the ten fractions of the training rows stands for."""
    rows = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n"))
    shares = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: i.cast("double") / 10.0)
    return rows.select(F.explode(shares).alias("fraction"), "n").select(
        "fraction", F.floor(F.col("fraction") * F.col("n") + 1e-9).cast("bigint").alias("size")
    )


def sample_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_sample(table(spark, sf_dir, "events"), ["event_id"])


QUERIES = {
    "class_weights": weights_by_class,
    "weighted_rows": weighted_rows,
    "split_80_20": split_80_20,
    "split_lines": split_lines,
    "folds_5": folds_5,
    "folds_labels": folds_labels,
    "nested_prefixes": nested_prefixes,
    "train_sizes": train_sizes,
    "sample_500": sample_500,
}

_PLACED = """
    SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {hash}) AS place,
           count(*) OVER (PARTITION BY {label}) AS n
    FROM {source}
"""
_EVENT_LABELS = "(SELECT event_id, CAST(event_type = 'error' AS INT) AS label FROM events)"


def _fold_sql(columns: str, label: str, hash_: str, source: str) -> str:
    return f"""
        SELECT {columns}, CAST((place - 1) * 5 // n AS INT) AS fold
        FROM ({_PLACED.format(label=label, hash=hash_, source=source)})
    """


def _split_sql(columns: str, label: str, hash_: str, source: str) -> str:
    return f"""
        SELECT {columns}, place <= floor(n * 0.2 + 0.5) AS is_test
        FROM ({_PLACED.format(label=label, hash=hash_, source=source)})
    """


ORACLES = {
    "class_weights": f"""
        SELECT toxic AS label, count(*) AS rows,
               {q('(SELECT count(*) FROM labels) / ((SELECT count(DISTINCT toxic) FROM labels) * count(*))')} AS weight
        FROM labels GROUP BY toxic
    """,
    "weighted_rows": f"""
        SELECT event_id, label, {q('count(*) OVER () / (2 * count(*) OVER (PARTITION BY label))')} AS weight
        FROM {_EVENT_LABELS}
    """,
    "split_80_20": _split_sql("doc_id, toxic", "toxic", DOC_HASH, "labels"),
    "split_lines": _split_sql(f"{LINE_ORDER}, l_returnflag", "l_returnflag", LINE_HASH, "lineitem"),
    "folds_5": _fold_sql("event_id, label", "label", EVENT_HASH, _EVENT_LABELS),
    "folds_labels": _fold_sql("doc_id, toxic", "toxic", DOC_HASH, "labels"),
    "nested_prefixes": f"""
        SELECT {LINE_ORDER},
               CAST(1 + len([i FOR i IN range(1, 11) IF place > i * n // 10]) AS INT) AS step
        FROM (SELECT *, row_number() OVER (ORDER BY {LINE_HASH}) AS place, count(*) OVER () AS n FROM lineitem)
    """,
    "train_sizes": """
        SELECT i / 10.0::DOUBLE AS fraction, CAST(i * (SELECT count(*) FROM events) // 10 AS BIGINT) AS size
        FROM range(1, 11) t(i)
    """,
    "sample_500": f"SELECT * FROM events ORDER BY {EVENT_HASH}, event_id LIMIT 500",
}
