"""Flat token files without an index: writing them, and counting the tokens of each document.

A file is nothing but token ids, each document followed by the end-of-document id. A
scan cuts a file into blocks and finds the ends in each by one vector comparison. A
document may span blocks: running sums over the blocks' counts and the last end before
each block give every document its number and its start.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millwright.llm.bpe import encoded, vocabulary
from millwright.llm.stored import in_batches, written

BLOCK_TOKENS = 1 << 20
END = 50256
KIND = "<u2"
DOCS_PER_FILE = 20_000
DOCS_AT_ONCE = 1000
#: Bytes up to which a file is read whole by Spark, and blocks that a range of a larger one has.
WHOLE_BYTES = 64 << 20
RANGE_BLOCKS = 16
#: Numbers of the task and of the file of that task in a written file's name.
NAME = re.compile(r"part-(\d+)-.*-c(\d+)")


def write_token_files(docs: DataFrame, path: str, folder: str, end: int = END) -> None:
    """Encode the texts and write them to ``folder`` as flat files of unsigned 16-bit ids.

    Documents keep their order within a file. A null or empty text leaves its end only.
    """
    def narrow(ids: bytes) -> bytes:
        wide = np.frombuffer(ids, "<u4")
        if len(wide) and (wide.max() > 65535 or (wide == end).any()):
            raise ValueError("an id is the end-of-document id or does not fit 16 bits")
        return wide.astype(KIND).tobytes()

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                texts = [t or "" for t in batch.column(0).slice(at, DOCS_AT_ONCE).to_pylist()]
                cells = [narrow(ids) for ids in encoded(vocab, texts, plain_specials=True)]
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary())], ["ids"])

    ids = in_batches(docs.select("text"), run, "ids binary")
    # The line writer puts the bytes of each row and then the separator: here the end's two bytes.
    mark = np.array([end], KIND).tobytes().decode("latin-1")
    ids.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", mark).option("encoding", "ISO-8859-1").option(
        "maxRecordsPerFile", DOCS_PER_FILE
    ).text(folder)


def block_ends(spark: SparkSession, folder: str, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, block, ends, over``: places after each end in the block, in tokens from the file's start.

    ``over`` is the file's length where it does not close with an end, else null.
    """
    def found(name: str, tokens: np.ndarray, before: int, closes: bool) -> pa.RecordBatch:
        """The ends in ``tokens``, which begin ``before`` tokens into the file and, with ``closes``, end it."""
        files, blocks, ends, over = [], [], [], []
        for start in range(0, len(tokens), block_tokens):
            part = tokens[start : start + block_tokens]
            files.append(name)
            blocks.append((before + start) // block_tokens)
            ends.append(np.flatnonzero(part == end) + before + start + 1)
            last = closes and start + len(part) == len(tokens) and part[-1] != end
            over.append(before + len(tokens) if last else None)
        return pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(blocks, pa.int32()), pa.array(ends, pa.list_(pa.int64())), pa.array(over, pa.int64())],
            ["file", "block", "ends", "over"],
        )

    def whole(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                view = content.as_buffer()
                yield found(name, np.frombuffer(view, KIND, count=view.size // 2), 0, True)

    def ranges(batches):
        # Only workers that read ranges load it.
        from pyarrow.fs import FileSystem

        for batch in batches:
            for name, length, begin in zip(*(c.to_pylist() for c in batch.columns)):
                # Spark spells a local path with one slash.
                system, path = FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", name))
                with system.open_input_file(path) as file:
                    data = file.read_at(min(step, length - begin), begin)
                yield found(name, np.frombuffer(data, KIND, count=len(data) // 2), begin // 2, begin + len(data) >= length - length % 2)

    step = 2 * block_tokens * RANGE_BLOCKS
    schema = "file string, block int, ends array<bigint>, over long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    small = files.filter(F.col("length") <= WHOLE_BYTES).select("path", "content").mapInArrow(whole, schema)
    large = files.filter(F.col("length") > WHOLE_BYTES).select("path", "length")
    if large.isEmpty():
        return small
    cut = large.withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 2, F.lit(step).cast("long"))))
    return small.unionByName(cut.repartition("path", "begin").mapInArrow(ranges, schema))


def document_places(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, part, piece, doc_no``: where ``write_token_files`` puts each row of the same ``docs``.

    A task writes its rows in order, ``DOCS_PER_FILE`` to a file. Files are named after the task, so the rows must
    come from a scan (or another source that deals the same rows to the same tasks again).
    """
    row = F.monotonically_increasing_id()
    place = docs.select(F.col(key).alias("key"), F.shiftright(row, 33).cast("int").alias("part"), F.pmod(row, F.lit(1 << 33)).alias("_at"))
    return place.select(
        F.col("key").alias(key), "part", F.floor(F.col("_at") / DOCS_PER_FILE).cast("int").alias("piece"), F.pmod(F.col("_at"), F.lit(DOCS_PER_FILE)).alias("doc_no")
    )


def file_numbers(file: Column) -> list[Column]:
    """``part, piece`` of a file that ``write_token_files`` wrote."""
    return [F.regexp_extract(file, NAME.pattern, i + 1).cast("int").alias(n) for i, n in enumerate(("part", "piece"))]


def token_counts(spark: SparkSession, folder: str, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, doc_no, first_token, n_tokens`` for every document, the end not counted.

    Numbers and places count from 0 in each file. Tokens behind the last end are a
    document, too; a document between two ends has none; an empty file has no document.
    """
    blocks = written(block_ends(spark, folder, end, block_tokens), "blocks")
    own = blocks.select("file", "block", F.size("ends").alias("n"), F.array_max("ends").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.select(
        "file", "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs"),
        F.coalesce(F.max("last").over(before), F.lit(0)).alias("open"),
    )
    stitched = blocks.join(carried, ["file", "block"])
    closes = F.concat(
        F.transform("ends", lambda e: F.struct(e.alias("next"), (e - 1).alias("stop"))),
        F.when(F.col("over").isNotNull(), F.array(F.struct((F.col("over") + 1).alias("next"), F.col("over").alias("stop"))))
        .otherwise(F.array().cast("array<struct<next:bigint,stop:bigint>>")),
    )
    listed = stitched.select("file", "docs", "open", closes.alias("closes"))
    found = listed.select("file", "docs", "open", "closes", F.posexplode("closes").alias("at", "close"))
    start = F.when(F.col("at") == 0, F.col("open")).otherwise(F.get("closes", F.col("at") - 1)["next"])
    return found.select(
        "file", (F.col("docs") + F.col("at")).alias("doc_no"), start.alias("first_token"), (F.col("close.stop") - start).alias("n_tokens")
    )
