"""Spelling variants: words of a corpus one edit apart, found by banded edit rows over sorted lists.

Words are counted in the tasks and added up by a shuffle. For the search a word stands in lists in
which all words agree but for a stretch ``[low, high)`` of the longer word's places. Two words that
differ by one edit differ at one place of the longer one, the first at which they part; so the
halves of a word are two such lists, and each pair is found in exactly one. A list that is too long is cut
by halving its stretch; at one place it holds no more words than there are letters, and one.

A list is sorted. Each word is compared with the whole list by the edit matrix, of which only three
diagonals matter. Rows of the matrix belong to prefixes, so neighbours in the list share the
rows of their common prefix: a row is computed once for each range of words with one prefix, and
a range whose row exceeds one edit is skipped. All lists of a batch advance by one
letter at a time, as arrays of (word, range) pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.stored import in_batches, looked_up, whole_groups, written
from millwright.llm.text import LOWER, flat, prefix_sums, slices, span_hashes, words

#: Words of a list beyond which its stretch is halved.
MOST_WORDS = 2_000
#: Rows of sorted lists that a task compares at once.
TOGETHER = 4_000
PARTS = np.array([False, True])
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: Rounds of following forms; each doubles the way, and a chain has fewer than 64 words as counts grow.
MOST_ROUNDS = 8


def parting_of(data: np.ndarray) -> np.ndarray:
    """True for the bytes outside runs of A-Z, a-z and U+00C0 to U+00FF (in UTF-8: C3 and the byte after it)."""
    upper = data == 0xC3
    inside = ((data >= 0x41) & (data <= 0x5A)) | ((data >= 0x61) & (data <= 0x7A)) | upper
    inside[1:] |= upper[:-1]
    return ~inside


def letters_before(data: np.ndarray) -> np.ndarray:
    """Code points that begin before each byte."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def checksum_table() -> np.ndarray:
    """What each byte does to a crc32."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


CHECKSUMS = checksum_table()


def span_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """The crc32 of each span, continued from ``begun``."""
    out = begun ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(starts - ends, kind="stable")
    lengths = (ends - starts)[order]
    for step in range(int(lengths[0]) if len(lengths) else 0):
        alive = order[: int(np.searchsorted(-lengths, -step, "left"))]
        out[alive] = CHECKSUMS[(out[alive] ^ data[starts[alive] + step]) & 0xFF] ^ (out[alive] >> np.uint32(8))
    return out ^ np.uint32(0xFFFFFFFF)


def counted_words(keys: list, data: np.ndarray, offsets: np.ndarray, slips: int, least: int) -> tuple[list[bytes], np.ndarray]:
    """The words of some texts and how often each occurs; every ``slips``-th checksum loses a letter (0: none)."""
    data = LOWER[data]
    parting = parting_of(data)
    starts, ends, ranges = words(parting.view(np.uint8), offsets, PARTS)
    if not len(starts):
        return [], np.empty(0, np.int64)
    changed: list[bytes] = []
    plain = np.ones(len(starts), bool)
    if slips:
        begun = np.array([zlib.crc32(f"{k}:".encode()) for k in keys], np.uint32)
        sums = span_checksums(data, starts, ends, np.repeat(begun, np.diff(ranges)))
        plain = sums % np.uint32(slips) != 0
        for i in np.flatnonzero(~plain).tolist():
            word = data[starts[i] : ends[i]].tobytes().decode()
            at = int(sums[i]) % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) >= least:
                changed.append(word.encode())
    before = letters_before(data)
    plain &= before[ends] - before[starts] >= least
    starts, ends = starts[plain], ends[plain]
    hashes = span_hashes(prefix_sums(data), starts, ends)
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    found = [data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return found + changed, np.append(counts, np.ones(len(changed), np.int64))


def vocabulary(docs: DataFrame, key: str, text: str, slips: int, least: int, count: int) -> DataFrame:
    """``word, n`` for the words of at least ``least`` letters that occur ``count`` times or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            keys = batch.column(0).to_pylist()
            for a, b in slices(offsets):
                found, counts = counted_words(
                    keys[a:b], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], slips, least
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"]
                )

    spelled = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(spelled.alias("key"), F.col(text).alias("text")).filter("text is not null")
    return in_batches(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


def listed(low: Column, high: Column, longer: Column) -> Column:
    """A list of words, named by what they agree in: all but the stretch of the longer ones."""
    after = F.col("length") - (longer - high)
    return F.struct(
        longer.alias("longer"), low.alias("low"), high.alias("high"),
        F.xxhash64(longer, low, high, F.substring("word", F.lit(1), low), F.substring("word", after + 1, longer)).alias("list"),
    )


def lists_of(words_n: DataFrame, most: int) -> DataFrame:
    """``word, length, longer, low, high, list``: each word in the lists in which a partner may stand."""
    rows = words_n.select("word", F.char_length("word").alias("length"))
    halves = []
    for more in (0, 1):
        longer = F.col("length") + more
        half = F.floor(longer / 2).cast("int")
        halves += [listed(F.lit(0), half, longer), listed(half, longer, longer)]
    rows = rows.withColumn("_list", F.explode(F.array(*halves))).select("word", "length", "_list.*")
    done = None
    while True:
        rows = written(rows, "lists")
        sizes = rows.groupBy("list").agg(F.count("*").alias("_n"), F.first("longer").alias("_l"), F.max("length").alias("_m"))
        # A list without words of the longer length, or with one word, has no pairs.
        sizes = written(sizes.filter("_n > 1 and _m = _l").select("list", "_n"), "list-sizes")
        long = sizes.filter(F.col("_n") > most)
        kept = looked_up(rows, sizes.filter(F.col("_n") <= most), ["list"], "_n").drop("_n")
        done = kept if done is None else done.unionByName(kept)
        if long.isEmpty():
            return done
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        whole = looked_up(rows, long, ["list"], "_n").drop("_n")
        single = whole.filter("high - low = 1")
        done = done.unionByName(single)
        parts = F.array(listed(F.col("low"), middle, F.col("longer")), listed(middle, F.col("high"), F.col("longer")))
        rows = whole.filter("high - low > 1").withColumn("_list", F.explode(parts)).select("word", "length", "_list.*")


def partners(texts: list[str], lengths: np.ndarray, lists: np.ndarray, longer: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Pairs of rows whose words are one edit apart at a place of their list's stretch.

    The rows are sorted by list and by the stretch of the word. The first of a pair has the longer length.
    """
    # Letters of the stretches, one behind the other.
    widths = (high - low) - (longer - lengths)
    cut = [t[a : a + w] for t, a, w in zip(texts, low.tolist(), widths.tolist())]
    letters = np.frombuffer("".join(cut).encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum(widths)])
    letters = np.append(letters, np.uint32(0))
    n = len(texts)
    ask = np.flatnonzero(lengths == longer)
    ask_at, ask_width = at[:-1][ask], widths[ask]
    fresh = np.ones(n, bool)
    fresh[1:] = lists[1:] != lists[:-1]
    heads = np.flatnonzero(fresh)
    # Pairs of a word and a range of rows with one prefix: the range's first row, and three cells of the edit matrix.
    word = np.arange(len(ask))
    node = heads[np.searchsorted(heads, ask, "right") - 1]
    big = np.int64(9)
    left, mid, right = np.full(len(word), big), np.zeros(len(word), np.int64), np.ones(len(word), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    depth = 0

    def letter(of: np.ndarray, place: int) -> np.ndarray:
        """The letter of the asking words at a place; a value of its own outside of them."""
        inside = (place >= 0) & (place < ask_width[of])
        return np.where(inside, letters[np.where(inside, ask_at[of] + place, 0)], np.uint32(0xFFFFFFFF))

    while len(word):
        # Rows that end here: the first of their range, as a prefix sorts before what goes on.
        ends = widths[node] == depth
        same = ends & (ask_width[word] == depth) & (mid == 1) & (node > ask[word])
        shorter = ends & (ask_width[word] == depth + 1) & (right == 1)
        hit = same | shorter
        found.append((ask[word[hit]], node[hit]))
        # Ranges of the next prefix, in the order of the rows.
        alive = widths > depth
        now = np.where(alive, letters[np.minimum(at[:-1] + depth, len(letters) - 1)], np.uint32(0xFFFFFFFF))
        parent = np.cumsum(fresh) - 1
        edge = fresh.copy()
        edge[1:] |= now[1:] != now[:-1]
        starts = np.flatnonzero(edge & alive)
        of_parent = parent[starts]
        first = np.searchsorted(of_parent, parent[node], "left")
        count = np.searchsorted(of_parent, parent[node], "right") - first
        owner = np.repeat(np.arange(len(word)), count)
        child = starts[np.repeat(first, count) + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)]
        word, row_left, row_mid, row_right = word[owner], left[owner], mid[owner], right[owner]
        own = now[child]
        width = ask_width[word]
        left = np.minimum(row_left + (letter(word, depth - 1) != own), row_mid + 1)
        mid = np.minimum(np.minimum(row_mid + (letter(word, depth) != own), row_right + 1), left + 1)
        right = np.minimum(row_right + (letter(word, depth + 1) != own), mid + 1)
        mid = np.where(depth + 1 <= width, mid, big)
        right = np.where(depth + 2 <= width, right, big)
        good = np.minimum(np.minimum(left, mid), right) <= 1
        word, node, left, mid, right = word[good], child[good], left[good], mid[good], right[good]
        fresh, depth = edge, depth + 1
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def one_edit(a: str, b: str) -> int:
    """The place of the only edit between ``a`` and ``b`` (not the longer one); -1 if there is not one."""
    at = 0
    while at < len(b) and a[at] == b[at]:
        at += 1
    rest = b[at:] if len(b) < len(a) else b[at + 1 :]
    return at if a != b and a[at + 1 :] == rest else -1


def near_pairs(lists: DataFrame, together: int = TOGETHER) -> DataFrame:
    """``word, near``: both directions of every pair of words one edit apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["list"], together):
            read = lambda name: batch.column(batch.schema.get_field_index(name))
            texts = read("word").to_pylist()
            number = lambda name: read(name).to_numpy().astype(np.int64)
            longer, low, high = number("longer"), number("low"), number("high")
            a, b = partners(texts, number("length"), number("list"), longer, low, high)
            out: list[tuple[str, str]] = []
            for i, j in zip(a.tolist(), b.tolist()):
                # Also apart in the list's stretch, and nowhere else: lists are named by a digest.
                if low[i] <= one_edit(texts[i], texts[j]) < high[i]:
                    out += [(texts[i], texts[j]), (texts[j], texts[i])]
            names = [pa.array([p[k] for p in out], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(names, ["word", "near"])

    width = F.col("high") - F.col("low") - (F.col("longer") - F.col("length"))
    stretch = F.substring("word", F.col("low") + 1, width)
    dealt = lists.repartition("list").sortWithinPartitions("list", stretch)
    return in_batches(dealt, run, "word string, near string")


def rooted(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)``: forms followed to the last one, by doubling.

    A form is at least ``TIMES`` as frequent as its word, so there are no cycles, and no word is the
    form of more words than there are edits of it.
    """
    ways = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = ways.join(ahead, "root", "left")
        ways = written(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_more")), "roots")
        if ways.filter("_more").isEmpty():
            break
        ways = ways.drop("_more")
    return ways.select("word", "root")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", slips: int = 0,
    least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every frequent word of the texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered. Near words differ by exactly one
    inserted, deleted or replaced letter. ``form`` is the most frequent near word (ties: the smallest), if it is
    ``times`` as frequent, else null; ``root`` is where the forms end, the word itself without one. With
    ``slips`` a run loses a letter where the crc32 of ``<key>:<run>`` is divisible by it, so that the search
    can be tried on known misspellings.

    A null or empty text has no words; a null key is spelled as nothing; texts and words may have any length;
    repeated rows count each; other columns are not read; an empty table gives no rows.
    """
    frequent = written(vocabulary(docs, key, text, slips, least_letters, least_count), "vocabulary")
    pairs = written(near_pairs(lists_of(frequent, most_words)), "near-words")
    # Every word has a bounded number of near words: those one edit away.
    weighed = pairs.join(frequent.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = weighed.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    joined = frequent.join(best, "word", "left")
    enough = -F.col("_best.less") >= times * F.col("n")
    named = written(
        joined.select(
            "word", F.when(enough, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("_best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = rooted(named.filter("form is not null").select("word", "form"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
