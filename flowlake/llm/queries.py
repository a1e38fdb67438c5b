"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import (
    decontamination, divergence, language_model, languages, neighbours, packing, sharding, simhash,
    suffixes, toxicity, url_filter, warc, whitening,
)
from flowlake.llm.common import crc_remainder, table

TOXIC_FROM = 0.3
LEAST_REPEAT = 200
SEQUENCE_LENGTH = 2048
#: Characters of a benchmark item for each edit that a copy of it may have.
BENCHMARK_PER_ERROR = 12
SHARDS = 40
COMPONENTS = 32


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizers have a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.SentenceModel:
    """Fitted on a bounded sample of the labelled rows that are not held out."""
    return toxicity.fit(*toxicity.training_sample(
        docs, labels.where(crc_remainder("doc_id", 4) != 2)))


#: Rules of the URL query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of each vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of held-out documents are not read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxic_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, TOXIC_FROM).select(
        "doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        F.when(F.col("toxicity.score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
        F.size("toxicity.sentences").alias("offending_sentences"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        "component_id")


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from those that are not held out."""
    docs = language_model.bodies(table(spark, sf_dir, "documents"))
    held_out = crc_remainder("doc_id", 7) == 2
    counts, words, weights = language_model.fitted(docs.where(~held_out))
    scored = language_model.scored(docs, words, weights, counts)
    return scored.withColumns({"held_out": held_out, "train_tokens": F.lit(words.tokens).cast("long")})


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable bundles and read back."""
    return warc.archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(table(spark, sf_dir, "pages").select("page_id", "url"),
                             rules).drop("url")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, and where in the normalised text."""
    found = decontamination.matched(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"), BENCHMARK_PER_ERROR)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the packed sequences."""
    pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), SEQUENCE_LENGTH)
    return packing.packed(pieces, SEQUENCE_LENGTH)


def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder("doc_id", 3) == 1
    model = languages.fit(*languages.training_sample(docs.where(~held_out)))
    return languages.predicted(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings take from each document."""
    cut = suffixes.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                   LEAST_REPEAT)
    return cut.select(
        "document.doc_id", F.octet_length("body").cast("long").alias("n_bytes"),
        (F.octet_length("body") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document; counts of shards are at most one apart."""
    found = sharding.sharded(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                        "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are from each other, and by which terms."""
    return divergence.audited(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector, and how well they are whitened."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), COMPONENTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_language_model": op4_language_model,
    "op5_warc": op5_warc,
    "op6_url_filter": op6_url_filter,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_languages": op9_languages,
    "op10_suffixes": op10_suffixes,
    "op11_sharding": op11_sharding,
    "op12_divergence": op12_divergence,
    "op13_whitening": op13_whitening,
}
