"""Near-duplicate documents by compressed minimum hashes, verified on full shingle sets.

A document is the set of its five-word shingles. Its sketch has 128 registers: the
shingle hashes are dealt to the registers by their first bits, and a register keeps of
its smallest hash the count of leading zeros and the ten bits after the first one. Four
registers at a time make 32 bands; documents that agree in a band are candidates. Two
sets of similarity 0.75 agree in no band with a chance of (1 - 0.75^4)^32, 5 in a million.

Equal sets become one class before anything else. In each band bucket every class meets
the smallest one only, so a bucket of any size gives one candidate for each member; the
verified links are closed to components. Where a bucket still holds several components,
its registers are compared in blocks of bounded size, and components that may be linked
are tied to clusters. The documents of a cluster that have such a partner and are of like
size are compared in blocks again: registers first, then the full sets in the same task,
which hands on no more links than components. Only pairs whose estimate
(corrected for chance collisions of registers) can belong to a similarity of 0.75 are
verified. Links count only when the full sets confirm them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.components import components
from millwright.llm.stored import in_batches, only_keys, whole_groups, written
from millwright.llm.text import flat, mixed, shingle_hashes, slices

REGISTERS = 128
REGISTER_BITS = 7
MANTISSA = 10
BAND = 4
BANDS = REGISTERS // BAND
SHARE = 75  # of a hundred: least intersection over union
#: Standard deviations below 0.75 at which an estimate is given up.
SLACK = 4.5
#: Rows and shingles of a block, at most (one larger document is a block of its own size).
BLOCK = 2048
BLOCK_SHINGLES = 2_000_000
#: Rows of a block that are compared with another block at a time.
STRIP = 64
#: Rows up to which a bucket is compared together with others, pairs compared at a time, rows held.
SMALL = 64
PAIRS = 20_000
TOGETHER = 5_000


def registers_of(own: np.ndarray) -> np.ndarray:
    """Registers of a sorted set of 64-bit hashes; 0 where no hash fell."""
    bounds = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - REGISTER_BITS)
    first = np.searchsorted(own, bounds)
    filled = first < np.append(first[1:], len(own))
    out = np.zeros(REGISTERS, np.uint16)
    # 53 of the bits behind the register's number: exact as a double, so its exponent tells the zeros.
    rest = (own[first[filled]] << np.uint64(REGISTER_BITS)) >> np.uint64(11)
    zeros = 53 - np.frexp(rest.astype(np.float64))[1]
    follow = ((rest << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out[filled] = ((zeros + 1) << MANTISSA).astype(np.uint16) | follow.astype(np.uint16)
    return out


def corrected(equal: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Similarity from equal and from filled registers, without the expected chance collisions."""
    # Two smallest hashes out of different shingles agree with the chance that both have the
    # same zeros (1/3 over all counts) and the same mantissa.
    chance = 2.0**-MANTISSA / 3
    return np.clip((equal / np.maximum(filled, 1) - chance) / (1 - chance), 0, 1)


def least_estimate(filled: np.ndarray) -> np.ndarray:
    """The smallest estimate that a similarity of 0.75 may still show."""
    return SHARE / 100 - SLACK * np.sqrt(0.1875 / np.maximum(filled, 1))


def may_link(estimate: np.ndarray, filled: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Which pairs may belong to sets of similarity 0.75, by estimate and by size."""
    close = 100 * np.minimum(size_a, size_b) >= SHARE * np.maximum(size_a, size_b)
    return close & (estimate >= least_estimate(filled))


def compared(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """``may_link`` of registers, row by row."""
    equal = ((a == b) & (a > 0)).sum(axis=-1)
    filled = ((a > 0) | (b > 0)).sum(axis=-1)
    return may_link(corrected(equal, filled), filled, size_a, size_b)


def row_of(key: str = "doc_id", text: str = "text") -> Column:
    """A number for key and text; with the signature of its set it names a text."""
    return F.xxhash64(key, text)


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, row, n_shingles, sig1, sig2, registers``: size, signature and registers of each set.

    ``row`` stands for key and text, so rows are told apart whose key is null or repeated.
    """
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(2))
            sizes, sig1, sig2, sketch = [], [], [], []
            for a, b in slices(offsets):
                hashes, ranges = shingle_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for i in range(b - a):
                    own = np.unique(hashes[ranges[i] : ranges[i + 1]])
                    sizes.append(len(own))
                    sig1.append(own.sum(dtype=np.uint64))
                    sig2.append(mixed(own + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    sketch.append(registers_of(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                    pa.array(np.array(sig1, np.uint64).view(np.int64)), pa.array(np.array(sig2, np.uint64).view(np.int64)),
                    pa.array(sketch, pa.binary()),
                ],
                ["key", "row", "n_shingles", "sig1", "sig2", "registers"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, row long, n_shingles long, sig1 long, sig2 long, registers binary"
    return in_batches(docs.select(F.col(key).alias("key"), row_of(key, text).alias("row"), F.col(text).alias("text")), run, schema)


def bands(classes: DataFrame) -> DataFrame:
    """``band, key, n_shingles``: one row for each class and band that is not empty."""
    width = 2 * BAND
    piece = lambda i: F.substring("registers", i * width + 1, width)
    empty = F.lit(bytes(width))
    rows = F.filter(
        F.array(*[F.when(piece(i) != empty, F.xxhash64(piece(i), F.lit(i))) for i in range(BANDS)]),
        lambda x: x.isNotNull(),
    )
    return classes.select(F.explode(rows).alias("band"), "key", "n_shingles")


def shingle_sets(docs: DataFrame, classes: DataFrame, packed: bool = False) -> DataFrame:
    """``key, shingles``: the sorted set of shingle hashes of the text ``docs(row, text)`` that stands for each class.

    ``classes(key, row, sig1)``. The sets are arrays, or with ``packed`` their bytes.
    """
    kind = pa.binary() if packed else pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for a, b in slices(offsets):
                hashes, ranges = shingle_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sets = [np.unique(hashes[ranges[i] : ranges[i + 1]]) for i in range(b - a)]
                sums = np.array([own.sum(dtype=np.uint64) for own in sets], np.uint64).view(np.int64)
                cells = [own.tobytes() if packed else own.view(np.int64) for own in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sums), pa.array(cells, kind)], ["row", "sig1", "shingles"]
                )

    schema = f"row long, sig1 long, shingles {'binary' if packed else 'array<bigint>'}"
    wanted = classes.select("key", "row", "sig1")
    read = only_keys(docs.select("row", "text"), wanted.select("row").distinct(), ["row"], wanted.count())
    return in_batches(read, run, schema).join(wanted, ["row", "sig1"]).dropDuplicates(["key"]).select("key", "shingles")


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the candidate pairs ``a, b`` whose registers may belong to a similarity of 0.75."""
    side = lambda n: classes.select(
        F.col("key").alias(n), F.col("registers").alias(f"r{n}"), F.col("n_shingles").alias(f"n{n}")
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            read = lambda i: np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            good = compared(read(2), read(4), batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "na", "rb", "nb")
    kind = pairs.schema["a"].dataType.simpleString()
    return in_batches(joined, run, f"a {kind}, b {kind}")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets have a similarity of at least 0.75."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = written(shingle_sets(docs, written(classes.join(keys, "key").select("key", "row", "sig1"), "wanted")), "sets")
    side = lambda n: sets.select(F.col("key").alias(n), F.col("shingles").alias(f"s{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - shared
    return both.filter(100 * shared >= SHARE * union).select("a", "b")


def spanning_links(left: pd.DataFrame, right: pd.DataFrame) -> tuple[list, list]:
    """Enough confirmed links to join all components that two blocks link directly."""
    pair = Blocks(left, right)
    joined = Forest(pair.components)
    sets_a, sets_b = ([np.frombuffer(x, np.uint64) for x in f["shingles"]] for f in (left, right))
    keys_a, keys_b = left["key"].tolist(), right["key"].tolist()
    grade_a, grade_b = left["grade"].to_numpy(), right["grade"].to_numpy()
    found: tuple[list, list] = ([], [])
    for at_a, at_b, estimate in pair.hits():
        # Two documents of the lower size grade meet in the group of that grade.
        own = np.flatnonzero((grade_a[at_a] == 1) | (grade_b[at_b] == 1))
        for k in own[np.argsort(-estimate[own], kind="stable")].tolist():
            i, j = int(at_a[k]), int(at_b[k])
            a, b = joined.root(int(pair.group_a[i])), joined.root(int(pair.group_b[j]))
            if a == b:
                continue
            small, large = sorted((sets_a[i], sets_b[j]), key=len)
            spot = np.minimum(np.searchsorted(large, small), len(large) - 1)
            shared = int((large[spot] == small).sum())
            if 100 * shared >= SHARE * (len(small) + len(large) - shared):
                joined.join(a, b)
                found[0].append(keys_a[i])
                found[1].append(keys_b[j])
    return found


def in_blocks(rows: DataFrame, group: list[str], blocks: DataFrame) -> DataFrame:
    """``rows`` with ``i, j, block``: each group cut into blocks, each row sent to all pairs with its own block."""
    cut = rows.join(blocks, group).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1), lambda o: F.struct(
        F.least(F.col("block"), o.cast("long")).alias("i"), F.greatest(F.col("block"), o.cast("long")).alias("j")
    ))
    return cut.withColumn("pair", F.explode(F.array_distinct(pairs))).select(*rows.columns, "pair.i", "pair.j", "block")


def ties(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, component, tie`` for documents whose registers may link them to another component of a bucket.

    ``members(band, key, component)``. Buckets with the same members are compared once.
    ``tie`` is a component that the document's component is tied to in its bucket.
    """
    name = [F.sum(F.xxhash64("key", F.lit(i)).cast("decimal(38,0)")).alias(f"_{i}") for i in range(2)]
    buckets = members.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / BLOCK).alias("blocks"), *name
    )
    once = buckets.filter("low < high").dropDuplicates(["_0", "_1", "low", "high"]).select("band", "blocks")
    dealt = in_blocks(members, ["band"], once).join(classes.select("key", "n_shingles", "registers"), "key")
    kind = members.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in whole_groups(batches, ["band", "i", "j"], TOGETHER):
            yield pa.RecordBatch.from_pandas(tied_rows(batch.to_pandas()), preserve_index=False)

    near = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return in_batches(near, run, f"key {kind}, component {kind}, tie {kind}")


def tied_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """``ties`` of whole buckets: many small ones at once, large ones by themselves."""
    band, i, j = (frame[n].to_numpy() for n in ("band", "i", "j"))
    fresh = np.ones(len(frame), bool)
    fresh[1:] = (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    begins = np.flatnonzero(fresh)
    sizes = np.diff(np.append(begins, len(frame)))
    names, groups = np.unique(frame["component"], return_inverse=True)
    head = Forest(len(names))
    some = np.zeros(len(frame), bool)
    small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    ends = np.repeat(begins + sizes, sizes)[small]
    # Every row with the later rows of its bucket.
    counts = ends - small - 1
    first = np.repeat(small, counts)
    second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
    rivals = groups[first] != groups[second]
    first, second = first[rivals], second[rivals]
    regs, shingles = registers_read(frame), frame["n_shingles"].to_numpy()
    for at in range(0, len(first), PAIRS):
        a, b = first[at : at + PAIRS], second[at : at + PAIRS]
        good = compared(regs[a], regs[b], shingles[a], shingles[b])
        a, b = a[good], b[good]
        some[a] = some[b] = True
        head.join_all(groups[a], groups[b])
    for begin, size in zip(begins[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        rows = np.arange(begin, begin + size)
        block = frame["block"].to_numpy()[rows]
        left, right = rows[block == i[begin]], rows[block == j[begin]]
        pair = Blocks(frame.iloc[left], frame.iloc[right])
        for at_a, at_b, _ in pair.hits():
            some[left[at_a]] = some[right[at_b]] = True
            head.join_all(groups[left[at_a]], groups[right[at_b]])
    out = pd.DataFrame({"key": frame["key"].to_numpy()[some], "component": frame["component"].to_numpy()[some]})
    roots = np.array([head.root(g) for g in groups[some].tolist()], int)
    return out.assign(tie=names[roots]).drop_duplicates()


class Forest:
    """Disjoint sets of numbers."""

    def __init__(self, size: int):
        self.head = list(range(size))

    def root(self, x: int) -> int:
        while self.head[x] != x:
            self.head[x] = self.head[self.head[x]]
            x = self.head[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.head[self.root(a)] = self.root(b)

    def join_all(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            for x, y in np.unique(np.stack([a, b], axis=1), axis=0).tolist():
                self.join(x, y)


class Blocks:
    """Two blocks of documents, and which pairs of them may be linked."""

    def __init__(self, left: pd.DataFrame, right: pd.DataFrame):
        self.regs_a, self.regs_b = registers_read(left), registers_read(right)
        self.size_a, self.size_b = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
        groups = np.concatenate([left["component"], right["component"]])
        names, codes, counts = np.unique(groups, return_inverse=True, return_counts=True)
        self.group_a, self.group_b = codes[: len(left)], codes[len(left) :]
        self.main, self.components = int(counts.argmax()), len(names)

    def hits(self):
        """Pairs of different components that may be linked: rows left, rows right, estimates.

        No two rows of the largest component are compared.
        """
        minor, main = np.flatnonzero(self.group_a != self.main), np.flatnonzero(self.group_a == self.main)
        every, minor_b = np.arange(len(self.group_b)), np.flatnonzero(self.group_b != self.main)
        for rows, columns in ((minor, every), (main, minor_b)):
            wide = len(rows) > len(columns)
            short, long = (columns, rows) if wide else (rows, columns)
            for at in range(0, len(short) if len(long) else 0, STRIP):
                a, b = (long, short[at : at + STRIP]) if wide else (short[at : at + STRIP], long)
                estimate, good = strip_links(self.regs_a[a], self.regs_b[b], self.size_a[a], self.size_b[b])
                good &= self.group_a[a][:, None] != self.group_b[b][None, :]
                i, j = np.nonzero(good)
                if len(i):
                    yield a[i], b[j], estimate[i, j]


def registers_read(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["registers"]), np.uint16).reshape(-1, REGISTERS)


def strip_links(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of all pairs of two register tables, and which may belong to a similarity of 0.75."""
    has_a, has_b = (a > 0).astype(np.float32), (b > 0).astype(np.float32)
    filled = has_a.sum(axis=1)[:, None] + has_b.sum(axis=1)[None, :] - has_a @ has_b.T
    same = (a[:, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int32)
    estimate = corrected(same - (REGISTERS - filled), filled)
    return estimate, may_link(estimate, filled, size_a[:, None], size_b[None, :])


def across(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links between different components of a cluster, enough to join what is linked.

    ``members(cluster, key, row, sig1, component, n_shingles, registers)``. Sizes of linked sets
    differ by a third at most, so a document meets those of its own size grade and of the
    one below. Each such group is cut into blocks, and each task compares two of them.
    """
    sets = shingle_sets(docs, members, packed=True)
    own = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100.0 / SHARE))).cast("int")
    spots = F.explode(F.array(F.struct(own.alias("size"), F.lit(1).alias("grade")), F.struct((own + 1).alias("size"), F.lit(0).alias("grade"))))
    graded = members.withColumn("_spot", spots).select(
        "cluster", "_spot.size", "_spot.grade", "key", "component", "n_shingles", "registers"
    )
    group = ["cluster", "size"]
    weight = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    sizes = graded.groupBy(*group).agg(
        weight.alias("blocks"), F.min("component").alias("low"), F.max("component").alias("high"), F.max("grade").alias("top")
    )
    # Groups of one component, or without a document of their own size grade, have nothing to compare.
    dealt = in_blocks(graded, group, sizes.filter("low < high and top = 1").select(*group, "blocks")).join(sets, "key")
    kind = members.schema["key"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        a, b = spanning_links(frame[frame["block"] == i], frame[frame["block"] == j])
        return pd.DataFrame({"a": a, "b": b}).astype(frame["key"].dtype)

    return dealt.groupBy(*group, "i", "j").applyInPandas(run, f"a {kind}, b {kind}").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document.

    Documents are linked when 100 * intersection >= 75 * union of their sets. A null
    text or one without words has an empty set and no links. Rows that repeat a key
    are all returned, and each text of theirs links by itself. A row with a null key links
    like any other; a component takes its smallest key that is not null, and
    rows with a null key are kept only where there is none. An empty table gives no rows.
    """
    own = written(sketches(docs), "sketches")
    sig = ["sig1", "sig2", "n_shingles"]
    # One class for each different set, numbered when it is written.
    classes = own.filter("n_shingles > 0").groupBy(*sig).agg(
        F.min("key").alias("least"), F.min("row").alias("row"), F.first("registers").alias("registers")
    )
    classes = written(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
    texts = docs.select(row_of().alias("row"), "text")
    banded = bands(classes)
    shared = written(
        banded.groupBy("band").agg(F.min("key").alias("head"), F.count("*").alias("n")).filter("n > 1"), "buckets"
    )
    stars = banded.join(shared, "band").filter("key != head").select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()
    stars = written(stars, "stars")
    links = written(confirmed(plausible(stars, classes), classes, texts), "links")
    roots = components(links)
    members = (
        banded.join(shared.select("band"), "band")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("band", "key", F.coalesce("component", "key").alias("component"))
    )
    members = written(members, "members")
    tied = written(ties(members, classes), "ties")
    if not tied.isEmpty():
        knots = components(tied.select(F.col("component").alias("a"), F.col("tie").alias("b")))
        clusters = knots.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
        left = tied.select("key", "component").distinct().join(clusters, "component").join(classes.drop("least", "sig2"), "key")
        more = written(across(written(left, "left"), texts), "links")
        if not more.isEmpty():
            roots = components(links.unionAll(more))
    placed = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        *sig, F.coalesce("component", "key").alias("_class"), "least"
    )
    placed = written(placed, "placed")
    first = placed.groupBy("_class").agg(F.min("least").alias("_first"))
    named = own.join(placed.join(first, "_class").select(*sig, "_first"), sig, "left")
    component = F.coalesce("_first", "key")
    return named.select(
        F.col("key").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("key"), component.isNull()).alias("kept"),
    )
