"""The operators as registered queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.llm import oracles
from millwright.llm.alignment import align_tokenizers
from millwright.llm.bpe import encode_digests
from millwright.llm.fingerprints import document_fingerprints
from millwright.llm.hilbert import document_shards
from millwright.llm.licences import BASE, scan_licences
from millwright.llm.mixing import chosen
from millwright.llm.neardup import near_duplicates
from millwright.llm.neighbours import nearest
from millwright.llm.quality import quality_scores
from millwright.llm.repeats import repeat_digests
from millwright.llm.spelling import spelling_variants
from millwright.llm.tokenfiles import document_places, file_numbers, token_counts, write_token_files
from millwright.llm.toxicity import toxicity_scores
from millwright.session import fresh_path

# Parameters of the mixture: a tree of domain, language and source.
PATH = ["domain", "lang", "source"]
DOMAINS = {"web": 0.5, "forum": 0.3, "reference": 0.2}
LANGUAGES = {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1}
BUDGET, EPOCHS, SEED = 0.8, 2, 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_domain(docs: DataFrame) -> DataFrame:
    """``domain``, dealt by the source's name; a column of that name is used as it is."""
    if "domain" in docs.columns:
        return docs
    names = F.array(*[F.lit(d) for d in DOMAINS])
    at = F.pmod(F.length("source") + F.ascii(F.substring("source", -1, 1)), F.lit(len(DOMAINS)))
    return docs.withColumn("domain", F.coalesce(F.get(names, at), F.lit("web")))


def mix_weights() -> list:
    named = lambda column, shares, rest: F.coalesce(
        *[F.when(F.col(column) == k, F.lit(v)) for k, v in shares.items()], F.lit(rest)
    )
    return [named("domain", DOMAINS, 0.1), named("lang", LANGUAGES, 0.05), F.lit(1.0)]


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document in flat files that Spark writes from all documents."""
    folder = fresh_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    counts = token_counts(spark, folder)
    found = counts.select(*file_numbers(F.col("file")), "doc_no", "first_token", "n_tokens")
    return document_places(docs).join(found, ["part", "piece", "doc_no"], "left").select(
        "doc_id", "part", "piece", "doc_no", "first_token", "n_tokens"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents"))
    return chosen(docs, PATH, mix_weights(), BUDGET, EPOCHS, SEED).drop("_row")


def op10_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), slips=199)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), *paths)


def licence_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can state of the licence scan: words, and places of the base phrases."""
    return op1_licence_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def nearest_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors with nine digits of the cosine."""
    return op2_nearest_vectors(spark, sf_dir).withColumn("score", F.round("score", 9))


def fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can state of the fingerprints: lengths and edited texts."""
    return op4_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_licence_scan, op2_nearest_vectors, op3_quality, op4_fingerprints, op5_near_duplicates,
        op6_token_counts, op7_toxicity, op8_repeated_strings, op9_mixture, op10_byte_pairs,
        op11_hilbert_shards, op12_spelling_variants, op13_tokenizer_alignment,
        licence_places, nearest_rounded, fingerprint_edits,
    )
}
ORACLES: dict[str, str] = {
    "licence_places": oracles.licence_places(BASE),
    "nearest_rounded": oracles.nearest_ids(),
    "fingerprint_edits": oracles.edits(),
    "op5_near_duplicates": oracles.near_duplicates(),
    "op8_repeated_strings": oracles.repeated_strings(),
    "op11_hilbert_shards": oracles.sharding(),
    "op12_spelling_variants": oracles.spelling(),
}
