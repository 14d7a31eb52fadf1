"""Nearest neighbours by cosine from randomly rotated one-bit codes, reranked on the vectors.

A vector is scaled to length one and turned by a seeded random rotation; its code is the
sign of each coordinate. The inner product of code and rotated vector, kept as a
correction scalar, turns the inner product of code and query into an unbiased estimate
of the cosine, with an error bound that shrinks with the root of the dimension. A block
of rows is searched by a block of queries: estimates and bounds come from the packed
codes, and only rows whose upper bound reaches the k-th best lower bound are compared
in double precision. Every row is in the index; nothing is fitted.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millwright.llm.stored import in_batches, written

ROW_BLOCK = 16_384
#: A row is sent to as many blocks as there are blocks of queries, so these are large.
QUERY_BLOCK = 16_384
#: Queries of a block that are estimated at a time.
STRIP = 512
#: Width of the error bound in its standard unit; a true neighbour falls outside about once in 500 times.
WIDTH = 3.0


@lru_cache(maxsize=8)
def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def one_bit_codes(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the inner product of each with its code."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(vectors.shape[1], seed).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def estimates(codes: np.ndarray, own: np.ndarray, queries: np.ndarray, seed: int):
    """Estimated cosine of every code (rows) with every query (columns), and the error bound of each row."""
    size = queries.shape[1]
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    turned = (unit @ rotation(size, seed).T).astype(np.float32)
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    near = (signs @ turned.T) / (np.sqrt(size) * own[:, None]).astype(np.float32)
    return near, WIDTH * np.sqrt(np.maximum(1 - own**2, 0) / (own**2 * max(size - 1, 1)))


def index(embeddings: DataFrame, seed: int = 7) -> DataFrame:
    """``vec_id, size, code, own, vector, mark`` for every usable row: packed code, correction scalar, doubles, digest.

    Rows with a null id, and vectors that are null, empty, zero or hold null or
    non-finite components are left out. Rows that repeat id and vector count once; an id with
    several vectors has a row for each.
    """
    usable = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(
        F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy()
            begins = np.concatenate([[0], np.cumsum(sizes)])
            codes, own, raw = [None] * len(sizes), np.zeros(len(sizes)), [None] * len(sizes)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                vectors = flat[begins[rows][:, None] + np.arange(size)]
                packed, own[rows] = one_bit_codes(vectors, seed)
                for row, code, vector in zip(rows, packed, vectors):
                    codes[row], raw[row] = code.tobytes(), vector.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(codes, pa.binary()), pa.array(own), pa.array(raw, pa.binary())],
                ["vec_id", "size", "code", "own", "vector"],
            )

    table = in_batches(
        usable.withColumn("vec_id", F.col("vec_id").cast("long")), run, "vec_id long, size int, code binary, own double, vector binary"
    )
    # A digest of the vector tells the rows of an id apart.
    return table.withColumn("mark", F.xxhash64("vector")).dropDuplicates(["vec_id", "size", "mark"])


def search(table: DataFrame, queries: DataFrame, k: int = 5, seed: int = 7) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of ``table`` for each row of ``queries``.

    Both are indexes; a row is no neighbour of itself, and only vectors of equal length are
    compared. Ties go to the smaller id. Fewer than k candidates give fewer rows; an empty side gives none. Where an
    id has several vectors, each is a query and a candidate of its own.
    """
    row_blocks = max(1, -(-table.count() // ROW_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = table.withColumn("rb", F.pmod(F.xxhash64("vec_id", "mark"), F.lit(row_blocks)).cast("int")).withColumn("qb", every(query_blocks))
    asked = queries.select("vec_id", "mark", "size", "vector")
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", "mark", F.lit(1)), F.lit(query_blocks)).cast("int")).withColumn("rb", every(row_blocks))

    def run(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "mark": [], "vec_id": [], "score": []}
        if len(rows) and len(wanted):
            read = lambda column, kind: np.frombuffer(b"".join(column), kind).reshape(len(column), -1)
            vectors, asked_for = read(rows["vector"], np.float64), read(wanted["vector"], np.float64)
            codes, ids, own, marks = read(rows["code"], np.uint8), *(rows[c].to_numpy() for c in ("vec_id", "own", "mark"))
            query_ids, query_marks = wanted["vec_id"].to_numpy(), wanted["mark"].to_numpy()
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            most = min(k + 1, len(ids))
            for begin in range(0, len(asked_for), STRIP):
                near, error = estimates(codes, own, asked_for[begin : begin + STRIP], seed)
                for at in range(near.shape[1]):
                    query, mark, vector = query_ids[begin + at], query_marks[begin + at], asked_for[begin + at]
                    low, high = near[:, at] - error, near[:, at] + error
                    kth = np.partition(low, len(ids) - most)[len(ids) - most]
                    found = np.flatnonzero((high >= kth) & ((ids != query) | (marks != mark)))
                    score = (vectors[found] * vector).sum(axis=1) / (lengths[found] * np.sqrt((vector * vector).sum()))
                    best = np.lexsort((ids[found], -score))[:k]
                    out["query_id"] += [query] * len(best)
                    out["mark"] += [mark] * len(best)
                    out["vec_id"] += ids[found[best]].tolist()
                    out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "mark": "int64", "vec_id": "int64", "score": "float64"})

    found = dealt.groupBy("size", "rb", "qb").cogroup(asked.groupBy("size", "rb", "qb")).applyInPandas(
        run, "query_id long, mark long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k nearest rows of each vector whose id is divisible by ``every``."""
    table = written(index(embeddings), "codes")
    return search(table, table.filter(F.col("vec_id") % every == 0), k)
