"""Shards cut out of a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``2^bits`` steps of about equally many rows; the steps are the
coordinates of a cell. The cells, at most ``2^16`` whatever the input holds, are numbered along the
Hilbert curve, so neighbours on the curve are neighbours in every dimension, and a run of the
curve has narrow ranges in all of them: a filter on any dimension leaves out most files. Inside
a cell rows lie by a digest. A row's place is the rows before its cell, the rows before its
piece of the cell, and its number inside the piece; only slim rows are shuffled, by pieces of
about ``PIECE_ROWS`` rows, so that no cell is too large for a task.

Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from millwright.llm.stored import SENT_KEYS, free_names, looked_up, written
from millwright.operators.prefix import running_totals

#: Cells of all dimensions together; they are numbered in one task and sent to all executors.
MOST_CELL_BITS = 16
#: Rows of a cell that one window numbers, about.
PIECE_ROWS = 1_000
#: Steps of a numeric dimension before it is cut into parts of equally many rows.
STEPS = 256
LAWS = ("rows", "bytes")


def gray(x: int) -> int:
    return x ^ (x >> 1)


def curve_tables(dims: int) -> tuple[list[int], list[int], list[int]]:
    """For each of the ``2^dims`` parts of a cube: its number by Gray code, entry corner and direction."""
    parts = range(1 << dims)
    number = [0] * len(parts)
    for w in parts:
        number[gray(w)] = w
    ones = lambda x: (~x & (x + 1)).bit_length() - 1  # noqa: E731  trailing ones
    entry = [gray(2 * ((w - 1) // 2)) if w else 0 for w in parts]
    direction = [0 if w == 0 else ones(w if w % 2 else w - 1) % dims for w in parts]
    return number, entry, direction


def curve_index(cells: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """Add the place along the Hilbert curve of the cell with the coordinates ``axes`` (``bits`` bits each)."""
    dims = len(axes)
    number, entry, direction = (F.array(*map(F.lit, t)) for t in curve_tables(dims))
    full = (1 << dims) - 1

    def turned(x: Column, by: Column) -> Column:
        """The ``dims`` low bits turned to the left."""
        up, down = F.call_function("shiftleft", x, by), F.call_function("shiftright", x, F.lit(dims) - by)
        return up.bitwiseOR(down).bitwiseAND(F.lit(full))

    out = cells.withColumns({"_corner": F.lit(0), "_axis": F.lit(0), name: F.lit(0)})
    for level in reversed(range(bits)):
        corner = sum((F.shiftright(F.col(a).cast("int"), level).bitwiseAND(F.lit(1)) * F.lit(1 << i) for i, a in enumerate(axes)), F.lit(0))
        by = F.col("_axis") + 1
        out = out.withColumn("_part", turned(corner.bitwiseXOR(F.col("_corner")), F.lit(dims) - by))
        out = out.withColumn("_part", F.get(number, F.col("_part")))
        out = out.withColumns({
            name: F.col(name) * (1 << dims) + F.col("_part"),
            "_corner": F.col("_corner").bitwiseXOR(turned(F.get(entry, F.col("_part")), by)),
            "_axis": (F.col("_axis") + F.get(direction, F.col("_part")) + 1) % dims,
        })
    return out.drop("_corner", "_axis", "_part")


def magnitude(value: Column) -> Column:
    """A number's power of two and the two bits behind its first one: at most 256 steps; -1 for null."""
    digits = F.length(F.bin(value))
    shift = F.greatest(digits - 3, F.lit(0))
    bits = F.call_function("shiftright", value, shift).cast("int").bitwiseAND(F.lit(3))
    return F.when(value.isNull(), -1).when(value <= 0, 0).otherwise(digits * 4 + bits)


def even_steps(value: Column, low, high) -> Column:
    """``STEPS`` steps of equal width from ``low`` to ``high``; -1 for null."""
    if low is None:
        return F.lit(-1)
    wide = F.lit(int(high)).cast("decimal(20,0)") - F.lit(int(low)).cast("decimal(20,0)") + 1
    step = F.floor((value.cast("decimal(20,0)") - F.lit(int(low))) * STEPS / wide).cast("int")
    return F.coalesce(step, F.lit(-1))


def steps_of(rows: DataFrame, dims: dict[str, str]) -> DataFrame:
    """``_v0, _v1, ...``: the value that each dimension is quantised by."""
    wide = [name for name, kind in dims.items() if kind == "width"]
    ends = rows.agg(*[f(name).alias(f"{k}_{i}") for i, name in enumerate(wide) for k, f in (("a", F.min), ("b", F.max))]).first() if wide else None
    steps = []
    for name, kind in dims.items():
        if kind == "value":
            # A null stands before all values.
            steps.append(F.coalesce(F.concat(F.lit("v"), F.col(name).cast("string")), F.lit("n")))
        elif kind == "magnitude":
            steps.append(magnitude(F.col(name).cast("long")))
        elif kind == "width":
            i = wide.index(name)
            steps.append(even_steps(F.col(name), ends[f"a_{i}"], ends[f"b_{i}"]))
        else:
            raise ValueError(f"a dimension is taken by value, magnitude or width, not {kind!r}")
    return rows.withColumns({f"_v{i}": s for i, s in enumerate(steps)})


def even_parts(rows: DataFrame, value: str, total: int, bits: int, name: str) -> DataFrame:
    """Add ``name``: the part of ``value`` among ``2^bits`` parts of about equally many rows, in its order."""
    counts = written(rows.groupBy(value).agg(F.count("*").alias("_n")), "values")
    if counts.count() <= SENT_KEYS:
        before = F.sum("_n").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
        placed = counts.withColumn("_before", F.coalesce(before, F.lit(0)))
    else:
        placed = running_totals(counts, [value], {"_before": F.col("_n")})
    parts = placed.select(value, F.floor(F.col("_before") * (1 << bits) / total).cast("int").alias(name), "_n")
    return looked_up(rows, parts, [value], "_n").drop("_n")


def placed_on_curve(rows: DataFrame, dims: dict[str, str], tie: Column, bits: int) -> DataFrame:
    """Add ``_place`` (from 0) and ``_before`` (sum of ``size`` of earlier rows) along the curve."""
    axes = [f"_axis{i}" for i in range(len(dims))]
    slim = written(steps_of(rows, dims).withColumn("_head", F.conv(F.substring(F.md5(tie), 1, 8), 16, 10).cast("long")), "curve-rows")
    total = slim.count()
    cut = slim
    for i, axis in enumerate(axes):
        cut = even_parts(cut, f"_v{i}", total, bits, axis).drop(f"_v{i}")
    cut = written(cut, "curve-axes")
    cells = cut.groupBy(*axes).agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    cells = curve_index(cells, axes, bits, "_cell").withColumn("_pieces", F.ceil(F.col("_n") / PIECE_ROWS))
    # One row for each cell, 65,536 at most: the only window without a partition.
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(cells.withColumns({"_cell_rows": F.sum("_n").over(earlier), "_cell_size": F.sum("_size").over(earlier)}), "cells")
    cut = cut.join(F.broadcast(cells.drop("_n", "_size")), axes).drop(*axes)
    cut = cut.withColumn("_piece", F.floor(F.col("_head") * F.col("_pieces") / (1 << 32)))
    pieces = cut.groupBy("_cell", "_piece").agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    earlier = Window.partitionBy("_cell").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "_cell", "_piece", F.sum("_n").over(earlier).alias("_piece_rows"), F.sum("_size").over(earlier).alias("_piece_size")
    )
    own = Window.partitionBy("_cell", "_piece").orderBy("_head", *rows.columns)
    numbered = cut.withColumns({
        "_own_rows": F.row_number().over(own) - 1,
        "_own_size": F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)),
    }).join(pieces, ["_cell", "_piece"])
    added = lambda of: sum((F.coalesce(f"_{n}_{of}", F.lit(0)) for n in ("cell", "piece", "own")), F.lit(0)).cast("long")
    return numbered.select(*rows.columns, added("rows").alias("_place"), added("size").alias("_before"))


def hilbert_shards(
    rows: DataFrame, dims: dict[str, str], tie: Column, shards: int = 8, law: str = "rows", bits: int = 4
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: runs of the Hilbert order of ``dims``.

    ``rows`` has a column ``size``. ``dims`` maps a column to how it is quantised: ``value`` (any type,
    in the order of its text), ``magnitude`` (numbers from 0, by power of two) or ``width`` (numbers, by
    equal width); each is then cut into ``2^bits`` parts of about equally many rows. Law ``rows``: counts of
    the shards are at most one apart. Law ``bytes``: a shard's ``size`` differs from an even share by no more
    than the largest row. ``slot`` counts from 0 in each shard. ``tie`` is a text that orders the rows of a cell.

    Nulls are a value of their own before all others; rows that are equal in all columns are
    interchangeable; an empty table gives no rows. Column names that begin with ``_`` are not allowed.
    """
    if law not in LAWS or not dims or bits * len(dims) > MOST_CELL_BITS:
        raise ValueError(f"law one of {LAWS}, at least one dimension and {MOST_CELL_BITS} bits in all at most")
    if taken := [c for c in rows.columns if c.startswith("_") or c in ("shard", "slot")]:
        raise ValueError(f"columns {taken} need other names")
    placed = written(placed_on_curve(rows, dims, tie, bits), "curve")
    n, total = placed.agg(F.count("*"), F.sum("size").cast("decimal(38,0)")).first()
    if law == "rows":
        shard = F.floor(F.col("_place") * shards / F.lit(max(n, 1)))
    else:
        shard = F.floor((F.col("_before") * 2 + F.col("size")) * shards / F.lit(2 * int(total or 1)))
    cut = placed.withColumn("shard", F.least(shard, F.lit(shards - 1)).cast("int"))
    # One row for each shard.
    first = cut.groupBy("shard").agg(F.min("_place").alias("_first"))
    cut = cut.join(F.broadcast(first), "shard").withColumn("slot", (F.col("_place") - F.col("_first")).cast("long"))
    return cut.select(*rows.columns, "shard", "slot")


def slim_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, size, text_crc32`` of documents; a null text has no bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", "lang", "source",
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
    )


#: Dimensions of documents, and how each is quantised.
DOCUMENT_DIMS = {"source": "value", "lang": "value", "size": "magnitude", "doc_id": "width"}


def document_shards(docs: DataFrame, shards: int = 8, law: str = "rows") -> DataFrame:
    """``doc_id, lang, source, size, text_crc32, shard, slot`` for every document.

    A null text has size 1 and checksum 0; null keys, languages and sources are values of their
    own; keys may be numbers or texts; repeated rows have a slot each; other columns are not read; an empty table
    gives no rows.
    """
    tie = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string"))
    slim = slim_documents(docs)
    text_key = isinstance(slim.schema["doc_id"].dataType, StringType)
    return hilbert_shards(slim, {**DOCUMENT_DIMS, "doc_id": "value"} if text_key else DOCUMENT_DIMS, tie, shards, law)


def write_shards(docs: DataFrame, folder: str, shards: int = 8, law: str = "rows") -> None:
    """The documents as one folder for each shard, in the order of the curve inside; all columns are kept.

    Rows are matched by key and text; rows that repeat both lie together. Each shard is written in pieces of equal runs, so
    that a reader that filters on language, source, size or key skips most files by their statistics. The documents must
    have no column ``shard``.
    """
    if "shard" in docs.columns:
        raise ValueError("the column 'shard' needs another name")
    keys = ["doc_id", "lang", "source", "text_crc32"]
    names = free_names(docs, "_crc", "_slot", *[f"_of_{k}" for k in keys])
    crc, slot, of = names[0], names[1], names[2:]
    once = document_shards(docs, shards, law).groupBy(*keys).agg(F.min("shard").alias("shard"), F.min("slot").alias(slot))
    once = once.withColumnsRenamed(dict(zip(keys, of)))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(["doc_id", "lang", "source", crc], of)]
    joined = docs.withColumn(crc, F.crc32(F.coalesce("text", F.lit(""))).cast("long")).join(once, same).drop(crc, *of)
    ranged = joined.repartitionByRange("shard", slot).sortWithinPartitions("shard", slot).drop(slot)
    ranged.write.partitionBy("shard").parquet(folder)
