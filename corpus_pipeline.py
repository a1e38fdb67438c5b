"""A corpus cleaning pipeline of five operators: filter, deduplicate, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. Its
result is written as Parquet to the shared folder and read again. All stages but the last
return the columns of ``documents``, extra ones included.

Null and empty texts pass every filter; one document without a word stays, as such texts are
near duplicates of each other. Empty tables stay empty. Extra columns keep their names and
values, whatever their names. Texts are taken whole at any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import decontamination, packing, simhash, suffixes, toxicity
from flowlake.llm.common import all_columns, free_name, quoted, table, written
from flowlake.llm.queries import (
    BENCHMARK_PER_ERROR, LEAST_REPEAT, SEQUENCE_LENGTH, TOXIC_FROM, tokenizer_path, toxic_model,
)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    score = toxicity.scorer(docs, toxic_model(docs, table(spark, sf_dir, "labels")), TOXIC_FROM)
    name = free_name(docs, "toxicity")
    return (docs.withColumn(name, score("text")["score"])
            .where(F.col(name) < TOXIC_FROM).select(*all_columns(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that repeat; ``n_chars`` follows the text."""
    cut = suffixes.without_repeats(docs, LEAST_REPEAT, characters=True)
    text = F.when(~F.col("no_text"), F.col("kept").cast("string"))
    columns = {c: F.col(f"document.{quoted(c)}") for c in docs.columns if c != "text"}
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        columns["n_chars"] = F.when(F.size("spans") > 0, F.length(text).cast(kind)).otherwise(
            columns["n_chars"])
    columns["text"] = text
    return cut.select(*(columns[c].alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    matches = free_name(docs, "matches")
    found = decontamination.matched(docs, table(spark, sf_dir, "benchmark"), BENCHMARK_PER_ERROR,
                                    column=matches)
    return found.where(F.size(matches) == 0).select(*all_columns(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets."""
    return packing.packed(packing.pieces(docs, tokenizer_path(), SEQUENCE_LENGTH),
                          SEQUENCE_LENGTH)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: No stage can be stated in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
