"""Training documents from raw ones: quality, near copies, repeated passages, mixture, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.llm.bpe import encode_texts
from millwright.llm.labelled import labelled_sample
from millwright.llm.mixing import mixed_documents
from millwright.llm.neardup import near_duplicates
from millwright.llm.quality import KEEP_FROM, fit, score_quality
from millwright.llm.queries import BUDGET, EPOCHS, PATH, SEED, mix_weights, table, with_domain
from millwright.llm.repeats import without_repeats
from millwright.llm.stored import SENT_KEYS, free_names, written
from millwright.session import fresh_path

#: Bytes of a string that the documents lose where it stands elsewhere. A passage of 50 words has some
#: 300 bytes here, so the 400 bytes of the registered query would leave it.
REPEAT_BYTES = 250


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score is high enough."""
    model = fit(*labelled_sample(docs, table(spark, sf_dir, "labels"), "quality"))
    (before,) = free_names(docs, "_score_before")
    slim = docs.withColumnsRenamed({"score": before} if "score" in docs.columns else {})
    scored = score_quality(slim, model).filter(F.col("score") >= KEEP_FROM).drop("score")
    return scored.withColumnsRenamed({before: "score"}).select(*docs.columns)


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, null ids last.

    Each row has a number of its own, written with the rows, so that rows without an id and rows
    that repeat one are told apart. A row that is in no group stays.
    """
    row, tie = free_names(docs, "_row", "_tie")
    numbered = written(docs.withColumns({row: F.monotonically_increasing_id(), tie: F.xxhash64("doc_id", "text")}), "numbered")
    found = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    keys = numbered.select(F.col(row).alias("row"), F.col(tie).alias("tie"), "doc_id")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "row")
    placed = written(found.join(keys, "row"), "groups")
    first = placed.groupBy("group").agg(F.min(place).alias("first")).select("first.row")
    copies = written(placed.select("row").join(first, "row", "left_anti").withColumnRenamed("row", row), "copies")
    sent = F.broadcast(copies) if copies.count() <= SENT_KEYS else copies
    return numbered.join(sent, row, "left_anti").select(*docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the strings of ``REPEAT_BYTES`` bytes that also stand elsewhere."""
    return without_repeats(docs, REPEAT_BYTES)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to the target weights, some twice where a weight asks for more than there is."""
    return mixed_documents(with_domain(docs), PATH, mix_weights(), BUDGET, EPOCHS, SEED).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``: the documents as token ids."""
    ids = encode_texts(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return ids.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_quality),
    ("near copies", first_copies),
    ("repeated strings", unrepeated),
    ("mixture", mixture),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
