"""A bounded sample of labelled texts to fit a model on, and the split it must respect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bounds of the sample: rows, and bytes of a text that may enter it. Scoring has no bounds.
SAMPLE_ROWS = 4000
SAMPLE_TEXT_BYTES = 20_000
FOLDS = 5


def held_out(key: Column) -> Column:
    """Whether a row is kept out of learning: crc32 of its key as text is divisible by five. Null keys are."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == 0, F.lit(True))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int = SAMPLE_ROWS,
    text_bytes: int = SAMPLE_TEXT_BYTES,
    seed: int = 7,
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``rows`` documents, first by a seeded hash of the key.

    Only rows that are not held out and have a label count; of several labels for
    one key the largest does. The bounds limit what is learnt from, never what is scored.
    """
    place = F.xxhash64(F.col("_key"), F.lit(seed))
    known = (
        labels.select(F.col("doc_id").alias("_key"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_key").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_key")))
        .groupBy("_key").agg(F.max("_label").alias("_label"))
        .orderBy(place, "_key").limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("_key"), F.coalesce("text", F.lit("")).alias("_text")).filter(
        F.octet_length("_text") <= text_bytes
    )
    # At most ``rows`` keys, so this side is small whatever the size of the table.
    found = texts.join(F.broadcast(known), "_key").orderBy(place, "_key", "_text").limit(rows).collect()
    return [r._text for r in found], [r._label for r in found]
