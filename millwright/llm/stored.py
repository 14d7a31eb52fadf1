"""Written intermediates and joins whose small side is checked."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from millwright.session import fresh_path

#: Most keys (of at most 16 bytes) that a join may send to every executor; more are joined by a shuffle.
SENT_KEYS = 500_000
#: Bytes of a batch that Spark sends to Python, about; a longer row is a batch of its own.
BATCH_BYTES = 2_000_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_OWN = "67108864b"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def only_keys(df: DataFrame, keys: DataFrame, on: list[str], count: int) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` (distinct, ``count`` of them)."""
    return df.join(F.broadcast(keys) if count <= SENT_KEYS else keys, on, "left_semi")


def looked_up(df: DataFrame, table: DataFrame, on: list[str], weight: str) -> DataFrame:
    """``df`` with the columns of ``table``, which has one row for each key (not null) and the key's ``weight``.

    A small table is sent to all executors. Of a larger one the keys above the ``SENT_KEYS``-th
    part of all weight are sent, which are fewer than ``SENT_KEYS``; the rows of the others
    are joined by a shuffle, in which no key is heavy. Rows without a key in ``table`` go.
    """
    if table.count() <= SENT_KEYS:
        return df.join(F.broadcast(table), on)
    least = table.agg(F.sum(weight)).first()[0] / SENT_KEYS
    heavy, light = table.filter(F.col(weight) > least), table.filter(F.col(weight) <= least)
    sent = df.join(F.broadcast(heavy), on)
    rest = df.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return sent.unionByName(rest.join(light, on))


def in_batches(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes: ten thousand long texts do not stand in memory at once.

    Spark reads the bound when the job starts, so it stays set in the session. A bound that
    the session has set itself is kept; only Spark's own is replaced.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, SPARKS_OWN) == SPARKS_OWN:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def schema_with(df: DataFrame, more: str) -> StructType:
    """The columns of ``df`` and those of the definition ``more``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows cut anew so that no group is divided: about ``rows`` rows, or one larger group."""
    def merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        while held and sum(b.num_rows for b in held) >= rows:
            table = merged(held)
            fresh = np.zeros(table.num_rows - 1, bool)
            for key in keys:
                column = table.column(table.schema.get_field_index(key)).to_numpy()
                fresh |= column[1:] != column[:-1]
            ends = np.flatnonzero(fresh) + 1
            held = [table]
            if not len(ends):
                break  # one group so far: it may go on in the next batch
            early = ends[ends <= rows]
            end = int(early[-1] if len(early) else ends[0])
            yield table.slice(0, end)
            held = [table.slice(end)]
            if held[0].num_rows < rows:
                break
    if held:
        yield merged(held)
