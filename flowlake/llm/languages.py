"""Language identification with string kernels.

A text is the set of byte n-grams of its letters, lengths 1 to 3 (a blended spectrum, presence
only). The kernel of two texts is the number of grams they share over the geometric mean of
their numbers of grams. Landmarks drawn from the training rows give Nyström features, a
one-versus-rest kernel ridge regression is fitted on them, and batches of texts are scored by
matrix products: texts by grams, by landmarks, by languages.

Grams are counted in ``2 ** BITS`` hashed places, which bounds the landmark matrix.

Defined results: ``und`` with score 0 where the text is null or has no letter, or where nothing
could be learned; ties go to the first language by name; repeated rows are scored one by one;
a null language is never learned. Only the text is read for a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import smallest_text

BITS = 14
LENGTHS = (1, 2, 3)
NOT_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
ROWS_AT_ONCE = 256
#: Shares of a language that are ranked by themselves first.
SHARES = 64


@dataclass(frozen=True)
class KernelModel:
    """``landmarks``: grams by landmarks, scaled; ``weights``: landmarks and 1 by languages."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray


def grams(text: str | None) -> np.ndarray:
    """Hashed places of a text's n-grams; empty without a letter."""
    letters = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    data = np.frombuffer(f" {letters} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if not letters:
        return np.zeros(0, np.int64)
    places, value = [], np.zeros(len(data), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        value = (value[:len(data) - n + 1] << np.uint32(8)) | data[n - 1:]
        if n in LENGTHS:
            marked = value + np.uint32(n << 24)
            places.append((marked * np.uint32(2654435761)) >> np.uint32(32 - BITS))
    return np.concatenate(places)


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Texts by grams, each row scaled to length one; which rows have a gram."""
    rows = np.zeros((len(texts), 1 << BITS), np.float32)
    for row, text in zip(rows, texts, strict=True):
        row[grams(text)] = 1
    size = rows.sum(1)
    rows /= np.sqrt(np.maximum(size, 1))[:, None]
    return rows, size > 0


def fit(texts: list[str], languages: list[str], per_language: int = 16,
        ridge: float = 1e-2) -> KernelModel | None:
    """Ridge regression on Nyström features; the first texts of a language are its landmarks."""
    rows, some = presence(texts)
    names = tuple(sorted({v for v, s in zip(languages, some, strict=True) if s}))
    if not names:
        return None
    label = np.array(languages)
    chosen = np.concatenate([np.flatnonzero(some & (label == v))[:per_language] for v in names])
    landmarks = rows[chosen].astype(float)
    values, vectors = np.linalg.eigh(landmarks @ landmarks.T)
    large = values > 1e-6 * values[-1]
    whiten = vectors[:, large] / np.sqrt(values[large])
    mapped = rows[some].astype(float) @ landmarks.T @ whiten
    mapped = np.hstack([mapped, np.ones((len(mapped), 1))])
    target = np.where(label[some][:, None] == np.array(names), 1.0, -1.0)
    weights = np.linalg.solve(mapped.T @ mapped + ridge * np.eye(mapped.shape[1]),
                              mapped.T @ target)
    return KernelModel(names, landmarks.T.astype(np.float32),
                       np.vstack([whiten @ weights[:-1], weights[-1:]]).astype(np.float32))


def predict(model: KernelModel | None, texts: list[str | None]) -> pd.DataFrame:
    """``lang_pred`` and ``score``, half the best margin plus a half, held in 0 to 1."""
    if model is None or not texts:
        return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
    rows, some = presence(texts)
    margins = rows @ model.landmarks @ model.weights[:-1] + model.weights[-1]
    best = margins.argmax(1)
    score = np.clip((margins.max(1).astype(float) + 1) / 2, 0, 1)
    return pd.DataFrame({
        "lang_pred": np.where(some, np.array(model.languages)[best], UNKNOWN),
        "score": np.where(some, score, 0.0)})


def training_sample(docs: DataFrame, per_language: int = 150,
                    max_chars: int = 20_000) -> tuple[list[str], list[str]]:
    """Up to ``per_language`` texts of each language, chosen by a hash of the id.

    Texts longer than ``max_chars`` are not sampled; both bounds keep the fit on one machine. An
    id takes one place of a language, a null id none; of several texts of one id the one with the
    smallest hash is sampled.
    """
    rows = docs.where(F.col("lang").isNotNull() & (F.length("text") <= max_chars))
    order = F.xxhash64("doc_id", F.lit(29))
    # First within shares of a language, so that no task sees more of one than of their best.
    ids = rows.where("doc_id is not null").select("doc_id", "lang").distinct().withColumns(
        {"o": order, "share": F.pmod(order, F.lit(SHARES))})
    for groups in (["lang", "share"], ["lang"]):
        turn = F.row_number().over(Window.partitionBy(*groups).orderBy("o", "doc_id"))
        ids = ids.withColumn("turn", turn).where(F.col("turn") <= per_language)
    ids = ids.select(F.col("doc_id").alias("sample_id"), F.col("lang").alias("sample_lang"), "o")
    sample = rows.join(F.broadcast(ids), (F.col("doc_id") == F.col("sample_id"))
                       & (F.col("lang") == F.col("sample_lang")))
    found = (sample.groupBy("o", "sample_id", "sample_lang").agg(smallest_text().alias("text"))
             .toPandas().sort_values(["o", "sample_id", "sample_lang"]))
    return found["text"].tolist(), found["sample_lang"].tolist()


def predicted(docs: DataFrame, model: KernelModel | None,
              column: str = "language") -> DataFrame:
    """``docs`` with ``column``: the prediction and its score.

    It takes the place of a column of that name; ``common.free_name`` gives one that is free.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.concat([predict(shared.value, texts.iloc[a:a + ROWS_AT_ONCE].tolist())
                             for a in range(0, max(1, len(texts)), ROWS_AT_ONCE)])

    return docs.withColumn(column, language("text"))
