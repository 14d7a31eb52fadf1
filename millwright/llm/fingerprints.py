"""Packed one-permutation MinHash fingerprints, all in DataFrame functions.

The hashes of a text's five-word shingles are sorted once; their first seven bits deal
them to 128 bins, so the first of each bin is its minimum. An empty bin takes the minimum
of the filled bin that comes first in an order of the bins drawn for the empty one
(densification by hashing, alike for every text). Four low bits of each bin are kept as one hexadecimal digit.
Two texts agree in a digit with the chance ``c + (1 - c) * likeness``, ``c`` = 1/16,
which the estimate undoes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 128
SHIFT = 57  # leaves the first seven bits of a signed 64-bit number
DIGITS = "0123456789abcdef"
CHANCE = 1 / 16
SHINGLE = 5
BLANKS = " \t\n\x0b\f\r"
FIRST_KEY = -(2**63)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """Hashes of all runs of five words; of all words, if fewer; none without words."""
    words = F.split(F.btrim(F.lower(text), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")

    def hashes(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)])
        )
        return (
            F.when(F.size(w) >= SHINGLE, runs)
            .when(F.get(w, F.lit(0)) != "", F.array(F.xxhash64(w)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return bound(words, hashes)


def dense(least: Column) -> Column:
    """All 128 bins in order, from the minima of the filled ones."""
    bins = F.transform(least, lambda v: F.shiftright(v, SHIFT))
    empty = F.array_except(F.sequence(F.lit(-BINS // 2).cast("bigint"), F.lit(BINS // 2 - 1).cast("bigint")), bins)

    def lender(e: Column) -> Column:
        mask = BINS - 1
        drawn = F.transform(least, lambda v, i: F.xxhash64(e, F.shiftright(v, SHIFT)).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("bigint")))
        return F.get(least, F.array_min(drawn).bitwiseAND(F.lit(mask)).cast("int"))

    cell = lambda b, v: F.struct(b.alias("b"), v.alias("v"))
    full = F.array_sort(F.concat(
        F.transform(least, lambda v: cell(F.shiftright(v, SHIFT), v)), F.transform(empty, lambda e: cell(e, lender(e)))
    ))
    return F.when(F.size(least) == BINS, least).otherwise(F.transform(full, lambda c: c["v"]))


def fingerprint(text: Column) -> Column:
    """128 hexadecimal digits; the empty string for a text without words."""
    def minima(h: Column) -> Column:
        return F.filter(
            h, lambda v, i: (i == 0) | (F.shiftright(v, SHIFT) != F.shiftright(F.get(h, i - 1), SHIFT))
        )

    def packed(least: Column) -> Column:
        digits = F.transform(dense(least), lambda v: F.substring(F.lit(DIGITS), v.bitwiseAND(F.lit(15)).cast("int") + 1, F.lit(1)))
        return F.when(F.size(least) == 0, "").otherwise(F.array_join(digits, ""))

    return bound(bound(F.sort_array(shingle_hashes(text)), minima), packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, from 0 to 1; two empty fingerprints are alike."""
    equal = F.size(F.filter(
        F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))
    )) / BINS
    estimate = F.greatest(F.lit(0.0), (equal - CHANCE) / (1 - CHANCE))
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(estimate)


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` from the document that follows by ``_key`` (then text); the first follows the last.

    The keys are cut into ranges of about equal rows, each a window of its own. The
    first row of a range is also sent to the range before it, as its end.
    """
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    shares = [i / ranges for i in range(1, ranges)]
    marks = docs.agg(F.percentile_approx("_key", shares, 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(x).cast("bigint") for x in sorted(set(marks))]) if marks else F.array().cast("array<bigint>")
    # One number for each range: its smallest key.
    rough = F.size(F.filter(cuts, lambda c: c <= F.col("_key")))
    lows = sorted(r[0] for r in docs.groupBy(rough.alias("r")).agg(F.min("_key")).select("min(_key)").collect())
    firsts = F.array(*[F.lit(x).cast("bigint") for x in lows]) if lows else F.array().cast("array<bigint>")
    own = F.size(F.filter(firsts, lambda c: c <= F.col("_key"))) - 1
    count = len(lows)
    guest = F.when(
        F.array_contains(firsts, F.col("_key")), F.array(F.struct(F.pmod(F.col("_own") + count - 1, F.lit(max(count, 1))).alias("range"), F.lit(True).alias("guest")))
    ).otherwise(F.array().cast("array<struct<range:int,guest:boolean>>"))
    home = F.array(F.struct(F.col("_own").alias("range"), F.lit(False).alias("guest")))
    dealt = docs.withColumn("_own", own).withColumn("_spot", F.explode(F.concat(home, guest)))
    window = Window.partitionBy("_spot.range").orderBy("_spot.guest", "_key", "text")
    ahead = [F.lead(c).over(window).alias(f"next_{c}") for c in columns]
    return dealt.select("*", *ahead).filter("not _spot.guest").drop("_own", "_spot")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last quarter replaced by as many first characters of the
    next document. A null text counts as empty; rows with a null key come first, rows
    with equal keys follow by text; a single document is its own next; an empty table
    gives no rows.
    """
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = slim.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_KEY)))
    marked = keyed.withColumn("fingerprint", fingerprint(F.col("text")))
    ranged = with_next(marked, ["text", "fingerprint"])
    length = F.length("text")
    quarter = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - quarter), F.substring("next_text", F.lit(1), quarter))
    both = ranged.select(
        "doc_id", length.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited")
    )
    done = both.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
