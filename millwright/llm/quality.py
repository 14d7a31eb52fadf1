"""Document quality from learned vectors of hashed words and character n-grams.

Every word, every pair of neighbouring words and every run of three or four bytes picks
a row of a table of vectors; a document is the mean of its rows, and a softmax over that mean gives the classes.
The table and the softmax are learned together by stochastic gradient descent. With
two classes the score depends on the mean of one number per row (the row times the
difference of the class weights), so scoring is a lookup and a sum for each feature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millwright.llm.labelled import held_out, labelled_sample
from millwright.llm.stored import in_batches, schema_with
from millwright.llm.text import flat, mixed, prefix_sums, slices, span_hashes, words

BITS = 18
GRAMS = (3, 4)
KEEP_FROM = 0.3


def features(data: np.ndarray, offsets: np.ndarray):
    """For each feature kind: table rows, and for each text the range of its features."""
    starts, ends, ranges = words(data, offsets)
    hashed = span_hashes(prefix_sums(data), starts, ends)
    yield (hashed >> np.uint64(64 - BITS)).astype(np.int64), ranges
    # Neighbouring words by the difference of their hashes: all doubled words share one row.
    pairs = mixed(hashed[1:] - hashed[:-1]) if len(hashed) else hashed
    same_text = np.ones(len(pairs), bool)
    edges = ranges[1:-1]
    same_text[edges[(edges > 0) & (edges <= len(pairs))] - 1] = False
    kept = np.concatenate([[0], np.cumsum(same_text)])
    ids = (pairs[same_text] >> np.uint64(64 - BITS)).astype(np.int64)
    yield ids, kept[np.minimum(ranges, len(pairs))]
    wide = data.astype(np.uint32)
    for size in GRAMS:
        count = max(len(data) - size + 1, 0)
        gram = np.zeros(count, np.uint32)
        for i in range(size):
            gram |= wide[i : i + count] << np.uint32(8 * i)
        gram = (gram + np.uint32(size)) * np.uint32(2654435761)
        gram ^= gram >> np.uint32(15)
        gram = (gram * np.uint32(2246822519)) >> np.uint32(32 - BITS)
        # Runs that begin in one text and end in the next are left out.
        whole = np.ones(count, bool)
        for i in range(1, size):
            late = offsets[1:] - i
            whole[late[(late >= 0) & (late < count)]] = False
        kept = np.concatenate([[0], np.cumsum(whole)])
        yield gram[whole].astype(np.int64), kept[np.minimum(offsets, count)]


@dataclass
class QualityModel:
    """One number for each table row, and the shift of the log-odds."""

    rows: np.ndarray
    shift: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text; a text without features gets the shift alone."""
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for ids, ranges in features(data, offsets):
            sums = np.concatenate([[0.0], np.cumsum(self.rows[ids], dtype=np.float64)])
            total += sums[ranges[1:]] - sums[ranges[:-1]]
            count += np.diff(ranges)
        odds = self.shift + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(
    texts: list[str], labels: list[int], size: int = 8, epochs: int = 5, rate: float = 1.0, seed: int = 7
) -> QualityModel:
    """Learn vectors and softmax by stochastic gradient descent, one document at a step.

    Without any text, or with one class only, the score is the share of label 1
    (smoothed by one row of each class) for every text.
    """
    ones = sum(1 for x in labels if x == 1)
    shift = float(np.log((ones + 1) / (len(labels) - ones + 1)))
    if not 0 < ones < len(labels):
        return QualityModel(np.zeros(1 << BITS), shift)
    bags = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        ids = np.concatenate([i for i, _ in features(data, np.array([0, len(data)]))])
        rows, counts = np.unique(ids, return_counts=True)
        bags.append((rows.astype(np.int32), (counts / max(len(ids), 1)).astype(np.float32)))
    draw = np.random.default_rng(seed)
    table = draw.uniform(-1 / size, 1 / size, (1 << BITS, size)).astype(np.float32)
    heads = np.zeros((2, size), np.float32)
    bias = np.array([0.0, shift], np.float32)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for at in draw.permutation(len(bags)):
            rows, shares = bags[at]
            mean = shares @ table[rows]
            odds = heads @ mean + bias
            chance = np.exp(odds - odds.max())
            error = chance / chance.sum()
            error[1 if labels[at] == 1 else 0] -= 1
            step = rate * (1 - done / steps)
            # The step of a row grows with the root of its share: rare features learn too.
            back = error @ heads
            heads -= step * np.outer(error, mean)
            bias -= step * 0.1 * error
            table[rows] -= step * np.outer(np.sqrt(shares), back)
            done += 1
    return QualityModel((table @ (heads[1] - heads[0])).astype(np.float32), float(bias[1] - bias[0]))


def score_quality(
    docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score"
) -> DataFrame:
    """Add the score of each whole text (0 to 1; a null text counts as empty).

    Rows keep all their columns; the column ``score`` must not exist yet.
    """
    if score in docs.columns:
        raise ValueError(f"there is a column {score!r} already")

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(batch.schema.get_field_index(text)))
            parts = [
                model.score(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for a, b in slices(offsets)
            ]
            column = pa.array(np.concatenate([np.empty(0), *parts]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, score])

    return in_batches(docs, run, schema_with(docs, f"{score} double"))


def quality_scores(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Learns ``labels.quality`` from a bounded sample of the rows that are not held
    out. A null or empty text has a score, too; a null key counts as held out;
    repeated rows give repeated results; an empty table gives no rows.
    """
    model = fit(*labelled_sample(docs, labels, "quality"), **fitting)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )
