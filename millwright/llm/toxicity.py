"""Toxic spans from a linear-chain conditional random field over words.

Two states, clean and toxic. A word's leaning to the toxic state is learned for the
word itself, for its first four, five and six bytes (inflected words share them) and for
its neighbours on either side, with the transitions between the states. Forward and backward sweeps give the exact marginal of every word; a document's
score is its largest marginal, and runs of words at 0.5 or more are its toxic spans.

Labels come by document, so the words to learn from are labelled first: in a toxic
document a word is toxic if the documents with it, or with its beginning, are mostly
toxic and too many for chance; every other word is clean. Near copies count once there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millwright.llm.labelled import held_out, labelled_sample
from millwright.llm.stored import in_batches, schema_with
from millwright.llm.text import LOWER, NOT_LETTER, flat, mixed, prefix_sums, slices, span_hashes, words

BITS = 18
TOXIC_FROM = 0.5
SLICE = 2_000_000
#: Share of toxic documents among those with a word, and how many documents, to call the word toxic.
PURITY = 0.8
LEAST_DOCS = 6
LIFT = 10.0
HEADS = (4, 5, 6)


def word_rows(data: np.ndarray, offsets: np.ndarray):
    """Table rows (word, then its heads; 0 for none), starts and ends of the words, and each text's range.

    Words are runs of letters with A-Z lowered.
    """
    data = LOWER[data]
    starts, ends, ranges = words(data, offsets, NOT_LETTER)
    sums = prefix_sums(data)
    rows = np.zeros((1 + len(HEADS), len(starts)), np.int32)
    rows[0] = (span_hashes(sums, starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)
    for i, size in enumerate(HEADS, 1):
        long = np.flatnonzero(ends - starts > size)
        hashes = mixed(span_hashes(sums, starts[long], starts[long] + size) + np.uint64(size))
        rows[i, long] = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    rows[rows == 0] = 1
    for i, size in enumerate(HEADS, 1):
        rows[i, ends - starts <= size] = 0
    return rows, starts, ends, ranges


def neighbours(rows: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words before and after as rows; row 0 stands for the edge of a text."""
    before, after = np.zeros_like(rows[0]), np.zeros_like(rows[0])
    if len(before):
        before[1:], after[:-1] = rows[0, :-1], rows[0, 1:]
        filled = ranges[:-1] < ranges[1:]
        before[ranges[:-1][filled]] = 0
        after[ranges[1:][filled] - 1] = 0
    return before, after


@dataclass
class ToxicModel:
    """Leanings by word or head (row 0 is none), word before and word after; ``steps[i, j]`` is the score of going from i to j."""

    word: np.ndarray
    before: np.ndarray
    after: np.ndarray
    shift: float
    steps: np.ndarray

    def leanings(self, rows: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        before, after = neighbours(rows, ranges)
        return sum(self.word[row] for row in rows) + self.before[before] + self.after[after] + self.shift

    def sweep(self, rows: np.ndarray, ranges: np.ndarray, pairs: bool = False):
        """Marginal of the toxic state for every word; with ``pairs`` also the summed pair marginals.

        All texts advance together, word by word, longest first, so each step is one array operation.
        """
        odds = np.exp(np.clip(self.leanings(rows, ranges), -30, 30))
        t = np.exp(self.steps)
        lengths = np.diff(ranges)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = ranges[:-1][order], lengths[order]
        most = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(most), "left") if most else np.empty(0, int)
        ahead, back = np.ones(rows.shape[1]), np.ones(rows.shape[1])
        for at in range(most):
            spot = starts[: active[at]] + at
            if at:
                last = ahead[spot - 1]
                ahead[spot] = (t[0, 1] + t[1, 1] * last) / (t[0, 0] + t[1, 0] * last) * odds[spot]
            else:
                ahead[spot] = odds[spot]
        for at in range(most - 2, -1, -1):
            spot = starts[: active[at + 1]] + at
            following = odds[spot + 1] * back[spot + 1]
            back[spot] = (t[1, 0] + t[1, 1] * following) / (t[0, 0] + t[0, 1] * following)
        both = ahead * back
        marginal = both / (1 + both)
        if not pairs:
            return marginal
        inner = np.ones(rows.shape[1], bool)
        inner[ranges[:-1][ranges[:-1] < ranges[1:]]] = False
        at = np.flatnonzero(inner)
        a, f = ahead[at - 1], odds[at] * back[at]
        both = a * f
        share = 1 / (t[0, 0] + t[0, 1] * f + t[1, 0] * a + t[1, 1] * both)
        cells = [share.sum(), (f * share).sum(), (a * share).sum(), (both * share).sum()]
        return marginal, at, t * np.array(cells).reshape(2, 2)

    def score(self, data: np.ndarray, offsets: np.ndarray):
        """Score of each text, and its spans as (text, start, end, score) in bytes of ``data``."""
        rows, starts, ends, ranges = word_rows(data, offsets)
        marginal = self.sweep(rows, ranges)
        scores = np.zeros(len(offsets) - 1)
        filled = np.flatnonzero(ranges[:-1] < ranges[1:])
        if len(filled):
            scores[filled] = np.maximum.reduceat(marginal, ranges[:-1][filled])
        hot = np.flatnonzero(marginal >= TOXIC_FROM)
        owner = np.searchsorted(ranges, hot, "right") - 1
        fresh = np.ones(len(hot), bool)
        fresh[1:] = (np.diff(hot) > 1) | (np.diff(owner) > 0)
        first = np.flatnonzero(fresh)
        if not len(first):
            return scores, (hot, hot, hot, marginal[hot])
        last = np.append(first[1:], len(hot)) - 1
        peak = np.maximum.reduceat(marginal[hot], first)
        return scores, (owner[first], starts[hot[first]], ends[hot[last]], peak)


def first_copies(rows: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Indices of the texts whose minimum hashes were not mostly seen in an earlier text."""
    seen: set[tuple[int, int]] = set()
    out = []
    runs = mixed(rows[:-2].astype(np.uint64) + mixed(rows[1:-1].astype(np.uint64) + mixed(rows[2:].astype(np.uint64))))
    for at in range(len(ranges) - 1):
        own = runs[ranges[at] : max(ranges[at], ranges[at + 1] - 2)]
        keys = [(seed, int(mixed(own ^ mixed(np.array([seed], np.uint64))).min())) for seed in range(8)] if len(own) else []
        if not keys or sum(k in seen for k in keys) < 3:
            out.append(at)
        seen.update(keys)
    return np.array(out, int)


def word_labels(rows: np.ndarray, ranges: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for the words to learn as toxic, from the labels of their documents."""
    counts = np.zeros((2, 1 << BITS))
    single = first_copies(rows[0], ranges)
    for at in single:
        counts[int(toxic[at]), np.unique(rows[:, ranges[at] : ranges[at + 1]])] += 1
    totals = np.bincount(toxic[single].astype(int), minlength=2) + 1.0
    lift = ((counts[1] + 0.5) / totals[1]) / ((counts[0] + 0.5) / totals[0])
    bad = (counts[1] >= LEAST_DOCS) & (counts[1] >= PURITY * counts.sum(axis=0)) & (lift >= LIFT)
    bad[0] = False
    return bad[rows].any(axis=0) & np.repeat(toxic, np.diff(ranges))


def fit(texts: list[str], labels: list[int], rounds: int = 30, rate: float = 1.0, keep: float = 0.01) -> ToxicModel:
    """Learn the field by gradient steps on the likelihood of the labelled words (per-weight rates).

    Without a toxic document every word leans far to the clean state.
    """
    size = 1 << BITS
    weights = [np.zeros(size), np.zeros(size), np.zeros(size), np.array([-4.0]), np.zeros((2, 2))]
    model = ToxicModel(weights[0], weights[1], weights[2], -4.0, weights[4])
    toxic = np.array([x == 1 for x in labels], bool)
    if not toxic.any():
        return model
    encoded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in encoded])])
    rows, _, _, ranges = word_rows(np.frombuffer(b"".join(encoded), np.uint8), offsets)
    del encoded
    if not rows.shape[1]:
        return model
    truth = word_labels(rows, ranges, toxic).astype(float)
    before, after = neighbours(rows, ranges)
    seen = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(rounds):
        marginal, inner, expected = model.sweep(rows, ranges, pairs=True)
        error = truth - marginal
        observed = np.zeros((2, 2))
        np.add.at(observed, (truth[inner - 1].astype(int), truth[inner].astype(int)), 1)
        grads = [
            sum(np.bincount(row, error, size) for row in rows), np.bincount(before, error, size), np.bincount(after, error, size),
            np.array([error.sum()]), observed - expected,
        ]
        grads[0][0] = 0.0
        for weight, grad, past in zip(weights, grads, seen):
            grad = grad - keep * weight
            past += grad * grad
            weight += rate * grad / np.sqrt(past)
        model.shift = float(weights[3][0])
    narrow = lambda w: w.astype(np.float32)
    return ToxicModel(narrow(weights[0]), narrow(weights[1]), narrow(weights[2]), model.shift, weights[4])


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """Add ``score`` and ``spans`` (code points from 0, end not included) to every row.

    A null or empty text, or one without letters, has score 0 and no spans.
    """
    clash = {"score", "spans"} & set(docs.columns)
    if clash:
        raise ValueError(f"there are columns {sorted(clash)} already")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(batch.schema.get_field_index(text)))
            scores, spans = [np.empty(0)], []
            for a, b in slices(offsets, SLICE):
                part = data[offsets[a] : offsets[b]]
                own = offsets[a : b + 1] - offsets[a]
                found, (owner, start, end, peak) = model.score(part, own)
                scores.append(found)
                chars = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                base = chars[own[owner]]
                lists: list[list[dict]] = [[] for _ in range(b - a)]
                for o, s, e, p in zip(owner.tolist(), (chars[start] - base).tolist(), (chars[end] - base).tolist(), peak.tolist()):
                    lists[o].append({"start": s, "end": e, "score": p})
                spans += lists
            columns = [*batch.columns, pa.array(np.concatenate(scores), pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "spans"])

    found = "score double, spans array<struct<start: bigint, end: bigint, score: double>>"
    return in_batches(docs, run, schema_with(docs, found))


def toxicity_scores(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every document.

    Learns ``labels.toxic`` from a bounded sample of the rows that are not held out.
    A null key counts as held out; repeated rows give repeated results; an empty
    table gives no rows; without labels every score is near 0.
    """
    model = fit(*labelled_sample(docs, labels, "toxic"), **fitting)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "spans",
    )
