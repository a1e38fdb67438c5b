"""Exact URL rules through a cascade of Bloom filters, in DataFrame operations only.

A rule is a host and the beginning of a path. All URLs of the corpus are known, so all keys a
rule could be looked up by are: for each shape of rule (labels of the host, letters of the path)
the URL has one key. The first filter holds the listed keys; the second those keys of the corpus
that pass the first without being listed; the third the listed keys that pass the second; and so
on until a level has no false positives left. For every key of the corpus the cascade then
answers exactly, from a few small arrays and without a join.

Filters are sized from the counted keys. A list whose first filter would exceed ``most_bytes``
is not broadcast; its rules are found by one equi-join per shape, with the same result.

Defined results: null URLs and those without ``://`` have an empty host and path and meet no
rule; rules with a null part, or a path that is neither empty nor begins with ``/``, meet no
URL; of rules that fit the longest text wins, then the longer host, then ``block``; repeated
rows are judged one by one; an empty list leaves all to the default. Other columns are kept,
unless the result has one of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits per key and hashes, of the first filter and of the later ones.
FIRST, LATER = (12, 2), (4, 2)


@dataclass(frozen=True)
class Level:
    """One filter: its words of 64 bits in a one-row table, its bits, its hashes."""

    words: DataFrame
    bits: int
    hashes: int
    number: int

    def position(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits))

    def positions(self, key: Column) -> Column:
        return F.array(*(self.position(key, i) for i in range(self.hashes)))

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        tests = []
        for i in range(self.hashes):
            at = self.position(key, i)
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            tests.append(word.bitwiseAND(_bit(at)) != 0)
        return reduce(lambda a, b: a & b, tests)


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"),
                           position.bitwiseAND(F.lit(63)).cast("int"))


def build_level(keys: DataFrame, number: int, count: int) -> Level:
    """Filter over ``keys(key)``: words are combined per task, then per word."""
    per_key, hashes = FIRST if number == 0 else LATER
    bits = max(64, -(-count * per_key // 64) * 64)
    level = Level(keys, bits, hashes, number)
    at = keys.select(F.explode(level.positions(F.col("key"))).alias("at"))
    set_words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(_bit(F.col("at"))).alias("value"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"))
    full = every.join(set_words, "word", "left").select(
        F.struct("word", F.coalesce("value", F.lit(0)).alias("value")).alias("w"))
    row = full.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["value"])
                   .alias("words"))
    return Level(written(row, "filter"), bits, hashes, number)


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that tell the ``listed`` keys from all others of ``universe``."""
    listed = written(listed.select("key").distinct(), "listed")
    levels: list[Level] = []
    inside, outside = listed, universe
    count = inside.count()
    while count:
        level = build_level(inside, len(levels), count)
        levels.append(level)
        passing = outside.where(level.holds(F.col("key"))).select("key").distinct()
        if outside is universe:  # the only level that has to be told what is listed
            passing = passing.join(listed, "key", "left_anti")
        inside, outside = written(passing, "passing"), inside
        count = inside.count()
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: in level one, unless in level two, unless ..."""
    answer = F.lit(False)
    for level in reversed(levels):
        answer = level.holds(key) & ~answer
    return answer


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Lower-cased host and path; empty without ``://``."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(
        url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def keys_by_shape(host: Column, path: Column,
                  shapes: list[tuple[int, int]]) -> list[tuple[int, Column]]:
    """For each shape, its labels and the URL's key; null where the URL is too short."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    return [(n, F.when((labels >= n) & (F.length(path) >= p),
                       F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, p))))
            for n, p in shapes]


def usable_rules(rules: DataFrame) -> DataFrame:
    host, path = F.translate("host", UPPER, LOWER), F.col("path")
    return (rules.where("host is not null and path is not null and verdict is not null")
            .where((F.length(path) == 0) | path.startswith("/"))
            .select(F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("letters"),
                    F.concat(host, path).alias("key"), "verdict"))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
           most_bytes: int = 32 << 20) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; its shapes are read by the driver.
    """
    host, path = split_url(url)
    rules = usable_rules(rules)
    shapes = sorted(tuple(r) for r in rules.select("labels", "letters").distinct().collect())
    new = ("host", "path", "rule", "verdict")
    parts = pages.select(*(c for c in pages.columns if c not in new),
                         host.alias("host"), path.alias("path"))
    keys = keys_by_shape(F.col("host"), F.col("path"), shapes)
    verdicts = [r[0] for r in rules.select("verdict").distinct().orderBy("verdict").collect()]
    found = []
    if rules.count() * FIRST[0] // 8 <= most_bytes:
        universe = parts.select(F.explode(F.array(F.lit(None).cast("string"), *(
            k for _, k in keys))).alias("key")).where("key is not null")
        for verdict in verdicts:
            cascade = build_cascade(rules.where(F.col("verdict") == verdict), universe)
            found += [F.when(k.isNotNull() & member(cascade, k), _fit(n, k, F.lit(verdict)))
                      for n, k in keys]
    else:
        for i, (n, k) in enumerate(keys):
            labels, letters = shapes[i]
            rule = (rules.where((F.col("labels") == labels) & (F.col("letters") == letters))
                    .groupBy("key").agg(F.max("verdict").alias(f"_verdict{i}"))
                    .withColumnRenamed("key", f"_key{i}"))
            parts = parts.join(rule, k == F.col(f"_key{i}"), "left")
            found.append(F.when(F.col(f"_key{i}").isNotNull(),
                                _fit(n, F.col(f"_key{i}"), F.col(f"_verdict{i}"))))
    best = F.array_max(F.array(F.lit(None).cast(
        "struct<letters:int,labels:int,verdict:string,rule:string>"), *found))
    return parts.withColumn("_best", best).select(
        *(c for c in pages.columns if c not in new), "host", "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def _fit(labels: int, key: Column, verdict: Column) -> Column:
    return F.struct(F.length(key).alias("letters"), F.lit(labels).alias("labels"),
                    verdict.alias("verdict"), key.alias("rule"))
