"""A log-bilinear language model trained by noise-contrastive estimation.

Words are counted over all training documents. The most frequent words are outputs of the
network by themselves; all others share outputs by their ending, within which a word has its
smoothed share of the counts. The network predicts the next output from the two before it:
the sum of their position-dependent vectors, times the outputs' vectors, plus a bias. It is
trained in numpy on every training document, in rounds: shards of a fixed number of tokens take
noise-contrastive steps from common weights, which are then averaged by tokens.

A text's probability is normalised: the softmax over all outputs, its denominators for all
contexts by one matrix product, times the word's share in its output. Shares need the exact counts of all
words. Those of the most frequent ones are broadcast, a fixed number of short words; words
beyond it meet their counts in a join.

Defined results: null and empty texts are the end token alone; unknown words take the share
kept for them in their output; without a training document the counts are empty and all
words unknown; repeated rows are scored one by one; columns other than the id and the text are
not read. Scores are sums of base-10 logarithms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zlib import crc32

from flowlake.llm.common import text_bytes, written

#: No word is empty, so the empty one stands for the end of a text.
END = b""
#: Words with counts of their own in every task, and the longest such word.
TOP_WORDS = 200_000
LONGEST_TOP = 48
#: Outputs for single words, the end included, and for groups of the others.
SINGLES = 512
GROUPS = 256
WIDTH = 32
TOKENS_AT_ONCE = 1024
NOISE = 64
NOISE_PER_TOKEN = 10
RATE = 0.6
#: Training tokens of a shard, and of a shard's tokens those that are shuffled among each other.
SHARD_TOKENS = 4_000_000
SHUFFLED = 200_000
#: Tokens of documents that are scored by one matrix product.
SCORED_TOGETHER = 20_000
CACHED_WORDS = 200_000


@dataclass(frozen=True)
class Weights:
    """``near``, ``far``: vectors of the last output and the one before; the last row: none."""

    near: np.ndarray
    far: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.near, self.far, self.output, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    @classmethod
    def unflat(cls, values: np.ndarray) -> Weights:
        outputs = SINGLES + GROUPS
        shapes = [(outputs + 1, WIDTH), (outputs + 1, WIDTH), (outputs, WIDTH), (outputs,)]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        parts = np.split(np.asarray(values, np.float32), ends[:-1])
        return cls(*(p.reshape(s) for p, s in zip(parts, shapes, strict=True)))


@dataclass(frozen=True)
class Words:
    """The most frequent words in order, their counts, and the totals of each output."""

    names: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    output_tokens: np.ndarray
    output_distinct: np.ndarray


def words_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def group_of(word: bytes) -> int:
    """Output of a word that has none of its own: by its last letters and what follows them."""
    stem = word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~0123456789")
    return SINGLES + crc32(stem[-2:] + b"|" + word[len(stem):][:1]) % GROUPS


class Lexicon(dict):
    """Number of a word among the frequent ones, then outputs of words."""

    def __init__(self, words: Words):
        super().__init__((w, i) for i, w in enumerate(words.names))
        self.rare: dict[bytes, int] = {}
        singles = min(SINGLES, len(words.names))
        self.outputs = np.array([i if i < singles else group_of(w)
                                 for i, w in enumerate(words.names)], np.int32)

    def output_of_rare(self, word: bytes) -> int:
        found = self.rare.get(word)
        if found is None:
            if len(self.rare) > CACHED_WORDS:
                self.rare.clear()
            found = group_of(word)
            if len(word) <= LONGEST_TOP:
                self.rare[word] = found
        return found

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Frequent numbers (-1: rare), outputs, and the places of rare words."""
        numbers = np.fromiter(map(self.get, words, [-1] * len(words)), np.int64, len(words))
        rare = np.flatnonzero(numbers < 0).tolist()
        outputs = self.outputs[numbers] if len(self.outputs) else np.zeros(len(words), np.int32)
        if rare:
            outputs[rare] = [self.output_of_rare(words[i]) for i in rare]
        return numbers, outputs, rare


def counted(texts: DataFrame) -> DataFrame:
    """``word, count`` over all training texts, written to the shared folder."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for text in batch["body"]:
                counts.update(words_of(text))
                if len(counts) > 500_000:
                    yield pd.DataFrame({"word": list(counts), "count": list(counts.values())})
                    counts.clear()
            if counts:
                yield pd.DataFrame({"word": list(counts), "count": list(counts.values())})

    return written(texts.select("body").mapInPandas(count, "word binary, count long")
                   .groupBy("word").agg(F.sum("count").alias("count")), "words")


def most_frequent(counts: DataFrame) -> pd.DataFrame:
    """At most ``TOP_WORDS`` short words, more frequent ones first.

    Words are taken by whole classes of counts, a sixteenth of a power of two
    wide, so that the driver receives the classes' sizes and those words alone.
    """
    level = F.floor(F.log2("count") * 16).cast("int")
    short = counts.where((F.octet_length("word") <= LONGEST_TOP)
                         & (F.octet_length("word") > 0)).withColumn("level", level)
    sizes = sorted((r[0], r[1]) for r in short.groupBy("level").count().collect())[::-1]
    total, least = 0, None
    for at, size in sizes:
        total += size
        if total > TOP_WORDS:
            break
        least = at
    if least is None:
        return pd.DataFrame({"word": [], "count": []})
    return (short.where(F.col("level") >= least).select("word", "count").toPandas()
            .sort_values(["count", "word"], ascending=[False, True]))


def frequent(counts: DataFrame) -> Words:
    """The bounded broadcast part of the counts, and the totals of all words by output."""
    ends = counts.where(F.octet_length("word") == 0).toPandas()
    # The end is always the first output.
    top = pd.concat([ends, most_frequent(counts)], ignore_index=True)
    names = [bytes(w) for w in top["word"]]
    shared = counts.sparkSession.sparkContext.broadcast(
        {w: i for i, w in enumerate(names[:SINGLES])})

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        singles = shared.value
        for batch in batches:
            output = [singles[w] if w in singles else group_of(w)
                      for w in map(bytes, batch["word"])]
            sums = (pd.DataFrame({"output": output, "tokens": batch["count"].to_numpy()})
                    .groupby("output")["tokens"].agg(["sum", "size"]).reset_index())
            yield pd.DataFrame({"output": sums["output"], "tokens": sums["sum"],
                                "words": sums["size"]})

    sums = (counts.mapInPandas(total, "output int, tokens long, words long")
            .groupBy("output").agg(F.sum("tokens"), F.sum("words")).toPandas().to_numpy())
    tokens, distinct = np.zeros(SINGLES + GROUPS, np.int64), np.zeros(SINGLES + GROUPS, np.int64)
    if len(sums):
        tokens[sums[:, 0]], distinct[sums[:, 0]] = sums[:, 1], sums[:, 2]
    return Words(names, top["count"].to_numpy(np.int64), int(tokens.sum()), int(distinct.sum()),
                 tokens, distinct)


def contexts(outputs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The output before each token and the one before that; before a text's start there is none."""
    none = SINGLES + GROUPS
    near = np.append(none, outputs[:-1])
    near[starts] = none
    far = np.append(none, near[:-1])
    far[starts] = none
    return near, far


def unigram(words: Words) -> np.ndarray:
    share = words.output_tokens + 1.0
    return share / share.sum()


def started(words: Words) -> Weights:
    """Small fixed random vectors; biases that make the model the outputs' unigram."""
    random = np.random.default_rng(7)
    outputs = SINGLES + GROUPS

    def small(n):
        return random.normal(0, 0.1, (n, WIDTH)).astype(np.float32)

    return Weights(small(outputs + 1), small(outputs + 1), small(outputs),
                   np.log(unigram(words)).astype(np.float32))


def rows_added(places: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows given to each of ``n`` places."""
    width = rows.shape[1]
    cells = (places[:, None] * width + np.arange(width)).ravel()
    return np.bincount(cells, rows.ravel(), n * width).reshape(n, width)


class Trainer:
    """Noise-contrastive steps with per-weight rates (Adagrad) over a stream of tokens."""

    def __init__(self, flat: np.ndarray, squares: np.ndarray, noise: np.ndarray,
                 rate: float = RATE, seed=0):
        self.values, self.squares = (
            [x.copy() for x in Weights.unflat(part).parts()] for part in (flat, squares))
        self.noise, self.log_noise = noise, np.log(NOISE_PER_TOKEN * noise).astype(np.float32)
        self.edges = np.cumsum(noise)
        self.rate, self.random, self.tokens = rate, np.random.default_rng(seed), 0

    def step(self, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> None:
        vn, vf, vo, bias = self.values
        n = len(target)
        drawn = np.minimum(np.searchsorted(self.edges, self.random.random(NOISE)),
                           len(bias) - 1)
        q = vn[near] + vf[far]
        true = vo[target]
        s = np.einsum("ij,ij->i", q, true) + bias[target] - self.log_noise[target]
        false = q @ vo[drawn].T + bias[drawn] - self.log_noise[drawn]
        # Chance of being noise for data, of being data for noise; the latter weighted.
        miss = 1 / (1 + np.exp(np.clip(s, -30, 30)))
        hit = (NOISE_PER_TOKEN / NOISE) / (1 + np.exp(-np.clip(false, -30, 30)))
        gq = miss[:, None] * true - hit @ vo[drawn]
        gradients = [
            rows_added(near, gq, len(vn)), rows_added(far, gq, len(vf)),
            rows_added(np.append(target, drawn),
                       np.concatenate([miss[:, None] * q, -(hit.T @ q)]), len(vo)),
            np.bincount(np.append(target, drawn), np.append(miss, -hit.sum(0)), len(bias))]
        for value, square, gradient in zip(self.values, self.squares, gradients, strict=True):
            gradient = (gradient / n).astype(np.float32)
            square += gradient * gradient
            value += self.rate * gradient / np.sqrt(square)
        self.tokens += n

    def state(self) -> list[np.ndarray]:
        return [Weights(*part).flat() for part in (self.values, self.squares)]

    def learn(self, outputs: list[np.ndarray]) -> None:
        target, lengths = np.concatenate(outputs), [len(x) for x in outputs]
        near, far = contexts(target, np.cumsum(lengths) - lengths)
        order = self.random.permutation(len(target))
        for a in range(0, len(order), TOKENS_AT_ONCE):
            part = order[a:a + TOKENS_AT_ONCE]
            self.step(near[part], far[part], target[part])


def encoded(texts: DataFrame, words: Words, shards: int, rounds: int) -> DataFrame:
    """``shard, turn, outputs``: the texts' outputs, dealt to shards and rounds by a hash.

    Shards depend on the number of training tokens alone, not on files, tasks or cores. The hash
    takes a row's place in, so that copies of one text spread like any other rows.
    """
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            outputs = [lexicon.read(words_of(t))[1].astype("<u2").tobytes() for t in batch["body"]]
            yield pd.DataFrame({"part": batch["part"], "outputs": outputs})

    part = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.octet_length("body")),
                  F.lit(shards * rounds)).cast("int")
    return (texts.select(part.alias("part"), "body").mapInPandas(encode, "part int, outputs binary")
            .select((F.col("part") % shards).alias("shard"),
                    F.expr(f"part div {shards}").cast("int").alias("turn"), "outputs"))


def trained(texts: DataFrame, words: Words, rounds: int = 2,
            shard_tokens: int = SHARD_TOKENS) -> Weights:
    """Weights after one pass over all training texts, in rounds.

    A round deals its share of the texts to shards; each shard takes its steps from the common
    weights, and the results are averaged by tokens. There is a shard per ``shard_tokens``
    training tokens, so the steps behind a model do not fall as files or tasks are added.
    """
    context = texts.sparkSession.sparkContext
    weights = started(words)
    state = [weights.flat(), np.full_like(weights.flat(), 1e-2)]
    shards = max(1, -(-words.tokens // shard_tokens))
    held = written(encoded(texts, words, shards, rounds), "outputs")
    noise = unigram(words)
    for turn in range(rounds):
        shared = context.broadcast((state, noise))
        places = (held.where(F.col("turn") == turn).repartitionByRange(shards, "shard")
                  .sortWithinPartitions("shard").select("shard", "outputs")
                  .mapInPandas(learner(shared, turn),
                               "place int, tokens long, value double, square double")
                  .groupBy("place").agg(*((F.sum(c) / F.sum("tokens")).alias(c)
                                          for c in ("value", "square")))
                  .toPandas())
        if len(places):
            for flat, column in zip(state, ("value", "square"), strict=True):
                flat[places["place"]] = places[column]
    return Weights.unflat(state[0])


def learner(shared, turn: int):
    """Function from rows sorted by shard to sums of the shards' weights, times their tokens."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, noise = shared.value
        sums, tokens = [np.zeros(len(x)) for x in state], 0
        trainer, held, size, number = None, [], 0, None

        def finish() -> int:
            if held:
                trainer.learn(held)
            for total, own in zip(sums, trainer.state(), strict=True):
                total += own.astype(float) * trainer.tokens
            return trainer.tokens

        for batch in batches:
            for shard, outputs in batch.itertuples(index=False):
                if shard != number:
                    if trainer:
                        tokens += finish()
                    trainer = Trainer(*state, noise, RATE / (1 + turn / 2), [turn, shard])
                    held, size, number = [], 0, shard
                held.append(np.frombuffer(outputs, "<u2").astype(np.int64))
                size += len(held[-1])
                if size > SHUFFLED:
                    trainer.learn(held)
                    held, size = [], 0
        if trainer:
            tokens += finish()
            yield pd.DataFrame({"place": np.arange(len(sums[0])), "tokens": tokens,
                                "value": sums[0], "square": sums[1]})

    return learn


class Normaliser:
    """Logarithms of the softmax's denominators of all contexts.

    A context's logits are the sum of one part for each of its two words, so the exponentials
    are products of two, and one matrix product over the outputs sums them for all contexts.
    """

    def __init__(self, weights: Weights):
        near = weights.near.astype(float) @ weights.output.T
        far = weights.far.astype(float) @ weights.output.T + weights.bias
        tops = near.max(1)[:, None], far.max(1)[:, None]
        sums = np.exp(near - tops[0]) @ np.exp(far - tops[1]).T
        self.known = (tops[0] + tops[1].T + np.log(sums)).astype(np.float32)

    def __call__(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        return self.known[near, far]


def scored(docs: DataFrame, words: Words, weights: Weights, counts: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of each row of ``docs(doc_id, body)``."""
    shared = docs.sparkSession.sparkContext.broadcast((words, weights))
    schema = ("row long, word binary, doc_id long, n_tokens long, n_known long, base double, "
              "score double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value
        lexicon, normaliser = Lexicon(words), Normaliser(weights)
        gain = np.append(np.log10(words.counts + 1.0), 0.0)  # the last is for rare words
        floor = float(np.log10(words.tokens + words.distinct + 1.0))
        # A single word is its output; others have a share of theirs.
        share = np.log10(words.output_tokens + words.output_distinct + 1.0)
        singles = min(SINGLES, len(words.names))
        row = TaskContext.get().partitionId() << 36

        def several(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
            """Rows of documents that are scored together, and of their rare words."""
            nonlocal row
            lengths = np.array([len(t) for t in texts])
            starts = np.cumsum(lengths) - lengths
            tokens = [t for own in texts for t in own]
            numbers, outputs, rare = lexicon.read(tokens)
            near, far = contexts(outputs, starts)
            logit = np.einsum("ij,ij->i", weights.near[near] + weights.far[far],
                              weights.output[outputs]) + weights.bias[outputs]
            known = gain[numbers]
            grouped = (numbers < 0) | (numbers >= singles)
            network, base, within = (np.add.reduceat(x.astype(float), starts) for x in (
                logit - normaliser(near, far), known,
                np.where(grouped, known - share[outputs], 0.0)))
            owner = np.searchsorted(starts, rare, "right") - 1
            rows = row + np.arange(len(texts))
            row += len(texts)
            # Words hold no space, so a document's own meets no count and spreads evenly.
            names = [b" %d" % r for r in rows.tolist()] + [tokens[i] for i in rare]
            of_document = [ids, *map(pa.array, (
                lengths, lengths - np.bincount(owner, minlength=len(texts)),
                base - lengths * floor, network / np.log(10) + within))]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(rows, rows[owner])), pa.array(names, pa.binary()),
                 *(pa.concat_arrays([c, pa.nulls(len(rare), c.type)]) for c in of_document)],
                ["row", "word", "doc_id", "n_tokens", "n_known", "base", "score"])

        for batch in batches:
            ids, held, size, first = batch.column("doc_id"), [], 0, 0
            for at, text in enumerate(batch.column("body").to_pylist(), 1):
                held.append(words_of(text))
                size += len(held[-1])
                if size > SCORED_TOGETHER or at == batch.num_rows:
                    yield several(ids.slice(first, len(held)), held)
                    held, size, first = [], 0, at

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "body").mapInArrow(
        score, schema)
    gain = F.log10(F.coalesce("count", F.lit(0)) + 1)
    is_word = F.col("n_tokens").isNull()
    added = rows.join(counts, "word", "left").withColumns({
        "gain": F.when(is_word, gain).otherwise(0.0),
        "known": F.when(is_word & F.col("count").isNotNull(), 1).otherwise(0)})
    return added.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum("known")).alias("n_known"),
        (F.max("base") + F.sum("gain")).alias("base_score"),
        (F.max("score") + F.sum("gain")).alias("score")).drop("row")


def bodies(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_bytes().alias("body"))


def fitted(texts: DataFrame, rounds: int = 2) -> tuple[DataFrame, Words, Weights]:
    """Counts, frequent words and weights learned from ``texts(body)``."""
    counts = counted(texts)
    words = frequent(counts)
    return counts, words, trained(texts, words, rounds)
