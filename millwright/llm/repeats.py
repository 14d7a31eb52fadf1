"""Bytes covered by long strings that occur again, by ranking sampled positions at growing lengths.

Prefix doubling over every byte position would sort as many rows as there are bytes in
each round. Here only sampled positions are ranked. In every string of the threshold's
length the leftmost smallest 32-byte gram is its anchor, so equal strings have equal
anchors at equal distances, and neighbouring strings mostly share theirs: a few
positions in a thousand remain.

Round one ranks the anchors by their first 32 bytes and drops those that are unique.
Round two ranks the pair of that rank and the whole span of the strings that share the
anchor (400 to 768 bytes): where the pair occurs again, the whole span does. What is left
are anchors at the borders of repeated passages. Their contexts meet by their first
rank, and the last round ranks every single string of the threshold's length in them.
Fingerprints of 64 bits stand for ranks, so equal ones are counted and nothing is
numbered; a group too large for a task is counted by a shuffle of its strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.llm.stored import SENT_KEYS, free_names, in_batches, only_keys, whole_groups, written
from millwright.llm.text import flat, mixed, powers, prefix_sums, slices, span_hashes

GRAM = 32
LENGTH = 400
PLACE = np.uint64((1 << 31) - 1)
#: Contexts with one first rank that a task compares at once; larger groups are counted by a shuffle.
MOST_TOGETHER = 5_000
#: Parts that the anchors of one span are dealt to, so that a span of any number of documents fits a task.
SPAN_PARTS = 256
#: Contexts that are compared at once if their groups are small.
TOGETHER = 2_000


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Anchors of all strings of ``length`` bytes, each with the run of the strings that share it.

    Returns text, anchor, first and last string start (all in ``data``), the anchor's
    gram and the fingerprint of the span from the first start to the last end.
    """
    reach = length - GRAM + 1
    sums = prefix_sums(data)
    count = max(len(data) - GRAM + 1, 0)
    long = np.flatnonzero(np.diff(offsets) >= length)
    if not len(long):
        none = np.empty(0, np.int64)
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * powers(len(sums))[1][:count])
    # The place in the low bits: the smallest value is the leftmost of the smallest grams.
    least = (grams & ~PLACE) | np.arange(count, dtype=np.uint64)
    done = 1
    while done * 2 <= reach:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < reach:
        least = np.minimum(least[: len(least) - (reach - done)], least[reach - done :])
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
    at = (least[starts] & PLACE).astype(np.int64)
    owner = np.searchsorted(offsets, starts, "right") - 1
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    opens, closes = starts[first], starts[last]
    return owner[first], at[first], opens, closes, grams[at[first]], span_hashes(sums, opens, closes + length)


def row_key() -> Column:
    """One number for a document; rows that repeat key and text share it, and their result."""
    return F.xxhash64("doc_id", "text")


def anchor_table(docs: DataFrame, length: int) -> DataFrame:
    """``row, anchor, low, high, gram, span``: places count from the start of the document."""
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            rows = batch.column(0).to_numpy()
            for a, b in slices(offsets):
                own = offsets[a : b + 1] - offsets[a]
                owner, at, low, high, gram, span = anchors(data[offsets[a] : offsets[b]], own, length)
                base = own[owner]
                narrow = lambda x: pa.array((x - base).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[a + owner]), narrow(at), narrow(low), narrow(high),
                     pa.array(gram.view(np.int64)), pa.array(span.view(np.int64))],
                    ["row", "anchor", "low", "high", "gram", "span"],
                )

    texts = docs.select(row_key().alias("row"), "text").filter(F.octet_length("text") >= length)
    return in_batches(texts, run, "row long, anchor int, low int, high int, gram long, span long")


def context_table(texts: DataFrame, length: int) -> DataFrame:
    """``gram, row, low, high, whole, context`` for ``texts(row, text, places)``."""
    names = ["gram", "row", "low", "high", "whole", "context"]

    def run(batches):
        for batch in batches:
            for row, text, places in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                cut = [data[p["low"] : p["high"] + length] for p in places]
                column = lambda n, kind: pa.array([p[n] for p in places], kind)  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [column("gram", pa.int64()), pa.array([row] * len(cut), pa.int64()), column("low", pa.int32()),
                     column("high", pa.int32()), column("whole", pa.bool_()), pa.array(cut, pa.binary())],
                    names,
                )

    return in_batches(texts, run, "gram long, row long, low int, high int, whole boolean, context binary")


def strings_of(batch: pa.RecordBatch, length: int):
    """Fingerprint of every string of ``length`` bytes in the contexts, and the context it is from."""
    data, offsets = flat(batch.column(5))
    counts = np.diff(offsets) - length + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + within
    return span_hashes(prefix_sums(data), starts, starts + length), owner, within


def runs_of(owner: np.ndarray, within: np.ndarray):
    """First and last of each run of consecutive strings of one context."""
    if not len(owner):
        return owner, owner
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)
    first = np.flatnonzero(fresh)
    return first, np.append(first[1:], len(owner)) - 1


def border_cover(contexts: DataFrame, length: int) -> DataFrame:
    """``row, low, high``: covered bytes found by comparing the contexts of one gram with one another."""
    def cover(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, owner, within = strings_of(batch, length)
        _, back, counts = np.unique(found, return_inverse=True, return_counts=True)
        whole = np.array(batch.column(4).to_pylist(), bool)
        again = (counts[back] > 1) & ~whole[owner]
        owner, within = owner[again], within[again]
        first, last = runs_of(owner, within)
        rows, low = batch.column(1).to_numpy()[owner[first]], batch.column(2).to_numpy()[owner[first]]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(low + within[first].astype(np.int32), pa.int32()),
             pa.array((low + within[last] + length).astype(np.int32), pa.int32())],
            ["row", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(cover, whole_groups(batches, ["gram"], TOGETHER))

    near = contexts.repartition("gram").sortWithinPartitions("gram")
    return in_batches(near, run, "row long, low int, high int")


def crowd_cover(contexts: DataFrame, length: int) -> DataFrame:
    """As ``border_cover`` for groups of any size: equal strings are counted by a shuffle."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found, owner, within = strings_of(batch, length)
            whole = np.array(batch.column(4).to_pylist(), bool)
            low = batch.column(2).to_numpy()[owner] + within
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(batch.column(1).to_numpy()[owner]),
                 pa.array(low.astype(np.int32)), pa.array(whole[owner])],
                ["string", "row", "low", "whole"],
            )

    strings = in_batches(contexts, run, "string long, row long, low int, whole boolean")
    again = strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string")
    return strings.filter("not whole").join(again, "string").select("row", "low", (F.col("low") + length).alias("high"))


def whole_spans(places: DataFrame, ranked: DataFrame, length: int) -> DataFrame:
    """``row, low, high`` of the anchors whose whole span occurs again.

    The anchors of a span are dealt to parts by their rows. Two in one part need no more than the
    part to know of each other; those that are alone in theirs, at most ``SPAN_PARTS`` a span, look the span up.
    """
    own = ["gram", "span", "_part"]
    dealt = places.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(SPAN_PARTS)))
    counted = dealt.withColumn("_n", F.count("*").over(Window.partitionBy(*own)))
    counted = written(counted.select("gram", "span", "row", "low", "high", (F.col("_n") > 1).alias("_again")), "spans")
    alone = counted.filter("not _again").join(ranked.filter("n > 1").select("gram", "span"), ["gram", "span"], "left_semi")
    return counted.filter("_again").unionByName(alone).select("row", "low", (F.col("high") + length).alias("high"))


def covered(docs: DataFrame, length: int = LENGTH, most_together: int = MOST_TOGETHER) -> DataFrame:
    """``row, spans``: for each document with repeated strings the byte ranges they cover."""
    if length < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes are needed, not {length}")
    places = written(anchor_table(docs, length), "anchors")
    spans = places.groupBy("gram", "span").agg(F.count("*").alias("n"), F.min(F.struct("row", "low", "high")).alias("lead"))
    grams = spans.groupBy("gram").agg(F.sum("n").alias("all"), F.count("*").alias("kinds")).filter("all > 1")
    ranked = written(spans.join(grams, "gram"), "ranks")
    whole = written(whole_spans(places, ranked, length), "whole-spans")
    # One context for each different span of a gram; those found whole above only testify.
    border = ranked.filter("kinds > 1").groupBy("lead.row").agg(
        F.collect_list(F.struct("gram", "lead.low", "lead.high", (F.col("n") > 1).alias("whole"))).alias("places")
    )
    border = written(border, "borders")
    texts = docs.select(row_key().alias("row"), "text")
    near = only_keys(texts, border.select("row"), ["row"], border.count())
    near = near.join(border, "row").select("row", "text", "places").dropDuplicates(["row"])
    contexts = written(context_table(near, length), "contexts")
    crowds = written(ranked.filter(F.col("kinds") > most_together).select("gram").distinct(), "crowds")
    few = crowds.count()
    sent = F.broadcast(crowds) if few <= SENT_KEYS else crowds
    parts = [whole, border_cover(contexts.join(sent, "gram", "left_anti"), length)]
    if few:
        parts.append(crowd_cover(contexts.join(sent, "gram", "left_semi"), length))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return written(
        found.distinct().groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "covered"
    )


def joined_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def with_spans(docs: DataFrame, found: DataFrame, spans: str) -> DataFrame:
    """``docs`` with the column ``spans`` (null where nothing is covered); only documents with spans are shuffled."""
    (row,) = free_names(docs, "_repeat_row")
    keyed = docs.withColumn(row, row_key())
    keys = found.select(F.col("row").alias(row))
    few = found.count()
    hit = only_keys(keyed, keys, [row], few).join(found.select(F.col("row").alias(row), F.col("spans").alias(spans)), row)
    rest = keyed.join(F.broadcast(keys) if few <= SENT_KEYS else keys, row, "left_anti")
    return hit.drop(row).unionByName(rest.drop(row), allowMissingColumns=True)


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document.

    A byte is removed if a string of ``length`` bytes over it also starts elsewhere, in
    this or another document. A null text counts as empty; shorter texts lose nothing;
    rows that repeat a text lose it whole, if it is long enough; a null key is kept as
    null; an empty table gives no rows.
    """
    slim = docs.select("doc_id", "text")

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, runs = (text or "").encode(), joined_spans(spans)
                out[0].append(len(data))
                out[1].append(sum(high - low for low, high in runs))
                out[2].append(len(runs))
                out[3].append(hashlib.sha256(kept_bytes(data, runs)).hexdigest())
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_batches(
        with_spans(slim, covered(slim, length), "spans"),
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the covered bytes cut out of ``text``, and ``n_chars`` counted anew if there is one.

    Bytes of a character of which only a part is covered go, too. A null text stays null.
    """
    names = docs.columns
    (found,) = free_names(docs, "_repeat_spans")

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            spans = batch.column(batch.schema.get_field_index(found)).to_pylist()
            for i, ranges in enumerate(spans):
                if ranges:
                    texts[i] = kept_bytes(texts[i].encode(), joined_spans(ranges)).decode("utf-8", "ignore")
            batch = batch.set_column(at, "text", pa.array(texts, pa.string()))
            yield batch.select(names)

    out = in_batches(with_spans(docs, covered(docs, length), found).select(*names, found), run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
