"""Two tokenizers aligned on bytes: groups between common token ends, and pairs of ids that overlap.

The tokens of a text in both vocabularies cover the same bytes. Where a token of each ends, a
group ends. Most groups hold one token of each, and then both stand for the same bytes: an
array from an id of the first to the id of the second with the same bytes, made once, knows such
pairs, so in how many documents they occur is added up in a vector as long as the vocabulary.
Only pairs from irregular groups are counted by a shuffle. Overlapping tokens are the
pieces between neighbouring ends of either kind, so links are as many as distinct ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F

from millwright.llm.bpe import Vocabulary, encoded, vocabulary
from millwright.llm.stored import SENT_KEYS, in_batches, written
from millwright.llm.text import slices

#: Fixed value: the pattern that cuts text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of texts that are encoded at once, about.
SLICE_BYTES = 500_000
#: Longest run of characters without a change of kind that goes through the fast encoder; others go word by word.
LONGEST_RUN = 10_000
SHIFT = 32


class First:
    """The byte-level vocabulary: ids of a text, and the bytes of an id."""

    def __init__(self, path: str):
        self.path = path
        # The merges and suffixes are for long runs only: a worker that meets none does not keep them.
        read = Vocabulary(path)
        special = set(read.special.values())
        ranks = {word: i for word, i in read.ids.items() if i not in special}
        self.fast = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [read.bytes_of.get(i, b"") for i in range(max(read.bytes_of) + 1)]
        self.cut = read.cut

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.one(t) for t in texts]

    def one(self, text: str) -> list[int]:
        # The fast encoder descends once for each character of a very long run.
        if len(text) > LONGEST_RUN and max(map(len, self.cut(text))) > LONGEST_RUN:
            return np.frombuffer(next(encoded(vocabulary(self.path), [text], True)), "<u4").tolist()
        return self.fast.encode_ordinary(text)


class Second:
    """The piece vocabulary, which adds the space before a text by itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
            else b"" if self.model.is_control(i) or self.model.is_unknown(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Pair:
    """Both vocabularies, the identity map, and the spellings of ids."""

    def __init__(self, first: str, second: str):
        self.first, self.second = First(first), Second(second)
        own: dict[bytes, int] = {}
        for i, word in enumerate(self.second.bytes_of):
            # Of two ids with the same bytes the one that is not a single byte's stand-in.
            if word and (word not in own or not self.second.model.is_byte(i)):
                own[word] = i
        self.same = np.array([own.get(word, -1) if word else -1 for word in self.first.bytes_of], np.int64)
        self.widths = [np.array([len(w) for w in v.bytes_of], np.int64) for v in (self.first, self.second)]
        a, b = len(self.first.bytes_of), len(self.second.bytes_of)
        self.spelled = [f"{i}," for i in range(max(a, b))] + [f"{i}|" for i in range(a)] + [f"{i};" for i in range(b)]
        self.bar, self.stop = max(a, b), max(a, b) + a


@lru_cache(maxsize=2)
def vocabularies(first: str, second: str) -> Pair:
    """One pair of vocabularies for each Python worker and pair of files."""
    return Pair(first, second)


def tokenised(both: Pair, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both vocabularies of all texts in a row, tokens and bytes of each text; what cannot be aligned has none."""
    wanted = [i for i, t in enumerate(texts) if t]
    spaced = [" " + texts[i] for i in wanted]
    a, b = both.first.encode(spaced), both.second.encode([texts[i] for i in wanted])
    n_a, n_b, size = (np.zeros(len(texts), np.int64) for _ in range(3))
    kept_a, kept_b = [], []
    for i, text, left, right in zip(wanted, spaced, a, b):
        data = text.encode()
        if b"".join(map(both.first.bytes_of.__getitem__, left)) == data == b"".join(map(both.second.bytes_of.__getitem__, right)):
            kept_a.append(left)
            kept_b.append(right)
            n_a[i], n_b[i], size[i] = len(left), len(right), len(data)
    flat = lambda lists, n: np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))
    return flat(kept_a, n_a), flat(kept_b, n_b), n_a, n_b, size


def distinct(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text, how often each occurs, and where each text's values begin."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(fresh)
    return values[first], np.diff(np.append(first, len(owner))), np.searchsorted(owner[first], np.arange(n + 1))


def spelled_groups(both: Pair, ids_a, ids_b, group_a, group_b, n_groups: int) -> list[str]:
    """The spelling of every token with the sign behind it, in the order of the groups."""
    per_a, per_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    ends_a, ends_b = np.cumsum(per_a), np.cumsum(per_b)
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[ends_a - 1] = last_b[ends_b - 1] = True
    out[np.arange(len(ids_a)) + (ends_b - per_b)[group_a]] = ids_a + last_a * both.bar
    out[np.arange(len(ids_b)) + ends_a[group_b]] = ids_b + last_b * both.stop
    return list(map(both.spelled.__getitem__, out.tolist()))


def aligned(both: Pair, texts: list[str | None]) -> dict[str, list]:
    """For each text: counts, digest of its groups, its exact pairs and its irregular pairs with their numbers."""
    n = len(texts)
    ids_a, ids_b, n_a, n_b, size = tokenised(both, texts)
    ends_a, ends_b = np.cumsum(both.widths[0][ids_a]), np.cumsum(both.widths[1][ids_b])
    # Texts follow one another, and both vocabularies end with each: one row of bytes for all.
    text_ends = np.cumsum(size)
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    pieces = np.union1d(ends_a, ends_b)
    owner = np.searchsorted(text_ends, pieces, "left")
    at_a, at_b = np.searchsorted(ends_a, pieces, "left"), np.searchsorted(ends_b, pieces, "left")
    left, right = ids_a[at_a], ids_b[at_b]
    exact = both.same[left] == right if len(left) else np.zeros(0, bool)
    group_a, group_b = np.searchsorted(common, ends_a, "left"), np.searchsorted(common, ends_b, "left")
    spelled = spelled_groups(both, ids_a, ids_b, group_a, group_b, len(common)) if len(common) else []
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    digests = [
        hashlib.sha256("".join(spelled[a:b])[:-1].encode()).hexdigest() if b > a else "" for a, b in zip(bounds, bounds[1:])
    ]
    same, same_n, same_at = distinct(owner[exact], left[exact], n)
    pairs, pairs_n, pairs_at = distinct(owner[~exact], left[~exact] << SHIFT | right[~exact], n)
    cells = lambda values, at, kind: [values[a:b].astype(kind).tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]
    return {
        "n_a": n_a, "n_b": n_b,
        "n_groups": np.bincount(np.searchsorted(text_ends, common, "left"), minlength=n), "n_links": np.bincount(owner, minlength=n),
        "groups_sha256": digests,
        "same": cells(same, same_at, "<u4"), "same_n": cells(same_n, same_at, "<u4"),
        "pair_a": cells(pairs >> SHIFT, pairs_at, "<u4"), "pair_b": cells(pairs & 0xFFFFFFFF, pairs_at, "<u4"),
        "pair_n": cells(pairs_n, pairs_at, "<u4"),
    }


COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
CELLS = "same binary, same_n binary, pair_a binary, pair_b binary, pair_n binary"


def alignments(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its key, counts of tokens, groups and links, digest of the groups, and distinct linked pairs.

    ``same`` has the ids of the first vocabulary that are linked with the id of the same bytes, ``pair_a`` and
    ``pair_b`` the ids of all other linked pairs, ``same_n`` and ``pair_n`` how often, all as unsigned 32-bit integers.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, {COUNTS}, {CELLS}"
    names = [part.split()[0] for part in schema.replace(f"key {kind}", "key x").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(first, second)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(t or "") for t in texts])])
            for a, b in slices(offsets, SLICE_BYTES):
                found = aligned(both, texts[a:b])
                columns = [pa.array(found[n], pa.binary() if n.startswith(("same", "pair")) else None) for n in names[1:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], names)

    return in_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, schema)


def ids_of(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<u4").astype(np.int64)


def pair_counts(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``a, b, n``: in how many rows each pair of ids is linked."""
    # Tasks that encode nothing get the identity map alone, not the vocabularies.
    known = rows.sparkSession.sparkContext.broadcast(vocabularies(first, second).same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = known.value
        vector = np.zeros(len(same), np.int64)
        out = lambda a, b, n: pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, n)], ["a", "b", "n"])
        for batch in batches:
            exact, a, b = (ids_of(batch.column(i).to_pylist()) for i in range(3))
            vector += np.bincount(exact, minlength=len(same))
            codes, n = np.unique(a << SHIFT | b, return_counts=True)
            yield out(codes >> SHIFT, codes & 0xFFFFFFFF, n)
        used = np.flatnonzero(vector)
        yield out(used, same[used], vector[used])

    counted = in_batches(rows.select("same", "pair_a", "pair_b"), run, "a long, b long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def link_counts(rows: DataFrame, pairs: DataFrame, first: str, second: str, most_sent: int = SENT_KEYS) -> DataFrame:
    """``rows`` (with ``row``) with ``n_best`` and ``count_sum`` of its links; ``pairs(a, b, n, best)``.

    The pairs of the identity map are a vector of the vocabulary's length. Of the others the most frequent ones,
    fewer than ``most_sent``, go to all tasks as arrays; links of the rest are joined by a shuffle, in
    which no pair has more than an even share of the rows.
    """
    same = np.asarray(vocabularies(first, second).same)
    total = pairs.agg(F.count("*"), F.sum("n")).first()
    least = 0 if total[0] <= most_sent else total[1] / most_sent
    sent = pairs.filter(F.col("n") > least).toPandas()
    a, b = sent["a"].to_numpy(np.int64), sent["b"].to_numpy(np.int64)
    codes = a << SHIFT | b
    order = np.argsort(codes)
    codes, n_of, best_of = codes[order], sent["n"].to_numpy(np.int64)[order], sent["best"].to_numpy(bool)[order]
    known = rows.sparkSession.sparkContext.broadcast((codes, n_of, best_of, same))
    names = ["row", "n_best", "count_sum", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n_of, best_of, same = known.value
        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in range(1, 6)]
            exact, exact_n, left, right, pair_n = map(ids_of, cells)
            owners = [np.repeat(np.arange(batch.num_rows), [len(c) // 4 for c in cells[i]]) for i in (0, 2)]
            owner = np.concatenate(owners)
            wanted = np.concatenate([exact << SHIFT | same[exact], left << SHIFT | right])
            times = np.concatenate([exact_n, pair_n])
            spot = np.minimum(np.searchsorted(codes, wanted), max(len(codes) - 1, 0))
            there = codes[spot] == wanted if len(codes) else np.zeros(len(wanted), bool)
            n_best, count_sum = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            np.add.at(n_best, owner[there], times[there] * best_of[spot[there]])
            np.add.at(count_sum, owner[there], times[there] * n_of[spot[there]])
            left_over = np.flatnonzero(~there)
            left_over = left_over[np.argsort(owner[left_over], kind="stable")]
            at = np.searchsorted(owner[left_over], np.arange(batch.num_rows + 1))
            rest = pa.ListArray.from_arrays(
                pa.array(at.astype(np.int32)),
                pa.StructArray.from_arrays(
                    [pa.array(x[left_over]) for x in (wanted >> SHIFT, wanted & 0xFFFFFFFF, times)], ["a", "b", "times"]
                ),
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_best), pa.array(count_sum), rest], names)

    kind = "row long, n_best long, count_sum long, rest array<struct<a:long,b:long,times:long>>"
    found = in_batches(rows.select("row", "same", "same_n", "pair_a", "pair_b", "pair_n"), run, kind)
    if total[0] <= most_sent:
        return found.drop("rest")
    found = written(found, "links-found")
    rare = pairs.filter(F.col("n") <= least)
    rest = found.select("row", F.inline("rest")).join(rare, ["a", "b"])
    rest = rest.groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum")
    )
    added = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
    return found.join(rest, "row", "left").select("row", added("n_best", "_best"), added("count_sum", "_sum"))


def align_tokenizers(
    docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", most_sent: int = SENT_KEYS
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    ``first`` is a byte-level vocabulary file, ``second`` a piece model; both see a space and the whole text.
    Special tokens in a text are plain text. A pair's count is the number of rows that hold it linked; ``n_best``
    counts the links whose count is the highest of their first id. A null or empty text, or one that a
    vocabulary changes, has zeros and an empty digest. Repeated rows count each, a null key stays null, other
    columns are not read, and an empty table gives no rows.
    """
    rows = written(alignments(docs, first, second, key, text).withColumn("row", F.monotonically_increasing_id()), "alignments")
    counted = written(pair_counts(rows, first, second), "pair-counts")
    # One row for each id of the first vocabulary.
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    pairs = counted.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    linked = link_counts(rows, pairs, first, second, most_sent)
    slim = rows.drop("same", "same_n", "pair_a", "pair_b", "pair_n")
    return slim.join(linked, "row").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
