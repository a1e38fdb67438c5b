"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score, a document is toxic if
any of its sentences is (noisy-or), and the sentence model is trained from document labels
alone. The sentence scores then say where the offending sentences are.

Defined results: null and empty texts have no sentence and score 0; without a toxic label in
the training rows every score is 0; of contradicting labels for one id the larger counts;
repeated rows are scored one by one; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import smallest_text

SENTENCE = re.compile(r"[^.!?\n]*\w[^.!?\n]*")
WORD = re.compile(r"\w+")
PREFIXES = (4, 5)


@dataclass(frozen=True)
class SentenceModel:
    """Weights of words and of word beginnings.

    No weight is negative: what else a sentence says does not excuse an insult in it. A
    sentence without any weighted feature has no evidence and scores 0, however many a text has.
    """

    bias: float
    weights: dict[str, float]


def features(word: str) -> list[str]:
    """A word and its beginnings; a beginning ends in ``*``, which no word holds."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def softplus(z):
    return np.logaddexp(0.0, z)


class Scorer:
    """Scores texts: weighted features are found by one automaton over the whole text."""

    def __init__(self, model: SentenceModel, threshold: float):
        self.model = model
        self.least = np.log(threshold / (1 - threshold))
        self.finder = ahocorasick.Automaton()
        for feature in model.weights:
            self.finder.add_word(feature.rstrip("*"), len(feature.rstrip("*")))
        if model.weights:
            self.finder.make_automaton()

    def __call__(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of all sentence scores; places and scores of the offending sentences."""
        none, found = 0.0, []
        low = (text or "").lower()
        for start, end in self.touched(low):
            weight = self.weight(low[start:end])
            if weight:
                z = self.model.bias + weight
                none += float(softplus(z))
                if z >= self.least:
                    found.append((start, end, float(1 / (1 + np.exp(-z)))))
        return -float(np.expm1(-none)), found

    def touched(self, low: str) -> list[tuple[int, int]]:
        """Places of the sentences that hold the letters of a weighted feature, in order."""
        ends = [end for end, _ in self.finder.iter(low)] if self.model.weights else []
        if not ends:
            return []
        spans = [m.span() for m in SENTENCE.finditer(low)]
        starts = [s for s, _ in spans]
        return [spans[k] for k in sorted({bisect_right(starts, end) - 1 for end in ends})]

    def weight(self, sentence: str) -> float:
        get = self.model.weights.get
        words = set(WORD.findall(sentence))
        return sum(get(f, 0.0) for f in {f for w in words for f in features(w)})


def fit(texts: list[str], labels: np.ndarray, steps: int = 150, rate: float = 0.2,
        penalty: float = 1.0, least_documents: int = 3, excess: float = 4.0) -> SentenceModel:
    """Maximum likelihood of the noisy-or by Adam, weights held at zero or above.

    ``penalty`` is the L1 charge in documents. Features take part if ``least_documents`` toxic
    texts hold them and their share of toxic texts is ``excess`` times that of clean ones.
    """
    y = np.asarray(labels, float)
    if not len(texts) or not y.any():
        return SentenceModel(-1e9, {})
    known: dict[str, list[str]] = {}
    bags = [set(WORD.findall(text.lower())) for text in texts]
    held = (Counter(), Counter())
    for bag, label in zip(bags, y, strict=True):
        found: set[str] = set()
        for word in bag:
            if word not in known:
                known[word] = features(word)
            found.update(known[word])
        held[int(label)].update(found)
    ratio = excess * y.sum() / max(1.0, (1 - y).sum())
    names = sorted(f for f, n in held[1].items()
                   if n >= least_documents and n > ratio * held[0][f])
    number = {f: i for i, f in enumerate(names)}
    telling = {w: ids for w, fs in known.items() if (ids := [number[f] for f in fs if f in number])}
    owner, row, column, n = [], [], [], 0
    for d, (text, bag) in enumerate(zip(texts, bags, strict=True)):
        if bag.isdisjoint(telling):
            continue
        for sentence in SENTENCE.findall(text.lower()):
            words = telling.keys() & set(WORD.findall(sentence))
            ids = {i for w in words for i in telling[w]}
            if ids:
                owner.append(d)
                column += ids
                row += [n] * len(ids)
                n += 1
    if not n:
        return SentenceModel(-1e9, {})
    column, row, owner = (np.array(x, np.int64) for x in (column, row, owner))
    w, bias = np.zeros(len(names)), -6.0
    m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, w[column], n)
        p = 1 / (1 + np.exp(-z))
        none = np.minimum(np.bincount(owner, softplus(z), len(y)), 50.0)
        # d(-log likelihood)/dz: p for clean documents, -p (1-P)/P for toxic ones.
        pull = np.where(y > 0, -1 / np.maximum(np.expm1(none), 1e-6), 1.0)
        g = p * pull[owner] / len(y)
        grad = np.append(np.bincount(column, g[row], len(w)) + penalty / len(y), g.sum())
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad * grad
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        w = np.maximum(w - move[:-1], 0.0)
        bias -= move[-1]
    return SentenceModel(float(bias), {f: float(w[i]) for f, i in number.items() if w[i] > 0.05})


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = 1500,
                    max_chars: int = 60_000) -> tuple[list[str], np.ndarray]:
    """Up to ``per_class`` labelled texts of each label, chosen by a hash of the id.

    Texts longer than ``max_chars`` are not sampled; both bounds keep the fit on one machine. Of
    several texts of one id the one with the smallest hash is sampled.
    """
    ids = (labels.where("doc_id is not null and toxic is not null")
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = F.xxhash64(F.col("doc_id"), F.lit(17))
    chosen = None
    for label in (0, 1):
        part = (ids.where(F.col("toxic") == label).select(
            F.col("doc_id").alias("sample_id"), "toxic", order.alias("o"))
            .orderBy("o", "sample_id").limit(per_class))
        chosen = part if chosen is None else chosen.union(part)
    rows = (docs.select("doc_id", "text")
            .where(F.length("text") <= max_chars)
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("sample_id"))
            .groupBy("sample_id", "toxic").agg(smallest_text().alias("text")).toPandas()
            .sort_values("sample_id"))
    return rows["text"].tolist(), rows["toxic"].to_numpy()


def scorer(docs: DataFrame, model: SentenceModel, threshold: float):
    """Function from a text column to ``struct(score, sentences)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, sentences array<struct<start:int,end:int,score:double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score_text = Scorer(shared.value, threshold)
        for texts in batches:
            done = [score_text(t) for t in texts]
            yield pd.DataFrame({"score": [s for s, _ in done],
                                "sentences": [found for _, found in done]})

    return score


def scored(docs: DataFrame, model: SentenceModel, threshold: float = 0.3,
           text: str | Column = "text", column: str = "toxicity") -> DataFrame:
    """``docs`` with ``column``: the score and the offending sentences' places.

    It takes the place of a column of that name; ``common.free_name`` gives one that is free.
    """
    return docs.withColumn(column, scorer(docs, model, threshold)(text))
