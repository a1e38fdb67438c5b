"""Which sources diverge from their language, and in which terms, by cells of counts.

A cell is a pair of counts: of a term in a group (a source within a language) and in what the
group is compared with. The divergence ``f`` of a term depends on its cell alone, so it is
evaluated once per cell. Cells of equal value are merged, ranked by value, and their running
multiplicity gives each class of equal terms its first rank; only classes that begin within the
wanted ranks are expanded to terms, in UTF-8 order. For two sources the cells of terms that both
have come from a join on the term; those of terms that one or neither has follow from the
sources' own cells by subtraction.

All arithmetic is in whole numbers: probabilities in units of 1 / 1,000,000,000, products in
decimals wide enough for any count.

Defined results: null text, language and source count as empty text; a document without a term
still makes its group occur; a language without kept terms has pairs of value 0 and no terms;
equal values are ranked by the UTF-8 order of their items; repeated rows count each; an empty
table gives no rows. Only text, language and source are read, so other columns may have any name.
Texts are taken whole; a task holds the terms of one text at a time.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import text_bytes, written

# A term is a run of ASCII letters, A-Z taken as a-z, and of bytes from 128 on;
# probabilities are counted in units of this part of 1.
FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32
             for b in range(256))
UNIT = 1_000_000_000

GROUP = ["lang", "source"]
#: Terms a task holds before it sends their counts.
HELD = 400_000


def probability(count: str, total: str, kept: str) -> Column:
    """Smoothed share of a count, in units, at least 1; exact for any long."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) "
                  f"div (cast({total} as decimal(20,0)) + cast({kept} as decimal(20,0)))")


def divergence(p: str, q: str) -> Column:
    """Squared difference over ``q``, rounded down; shares keep the square within a long."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def group_columns(docs: DataFrame) -> DataFrame:
    """``lang, source`` and the bytes of the text; null counts as empty."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP),
                       text_bytes().alias("body"))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that hold the term.

    Tasks count whole texts into one table per group and send it when it has ``HELD`` entries.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurring, holding = defaultdict(Counter), defaultdict(Counter)
        held = 0
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                       strict=True)
            for key, body in zip(keys, batch.column("body"), strict=True):
                terms = body.as_py().translate(FOLD).split()
                before = len(occurring[key])
                occurring[key].update(terms)
                holding[key].update(set(terms))
                held += len(occurring[key]) - before
                if held >= HELD:
                    yield counted(occurring, holding)
                    occurring, holding, held = defaultdict(Counter), defaultdict(Counter), 0
        yield counted(occurring, holding)

    # Tasks have combined their counts already; dealing them out first spares a second time.
    return (docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")
            .repartition(*GROUP, "term")
            .groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def counted(occurring: dict[tuple[str, str], Counter],
            holding: dict[tuple[str, str], Counter]) -> pa.RecordBatch:
    sizes = [len(c) for c in occurring.values()]
    which = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    langs, sources = ([key[i] for key in occurring] for i in (0, 1))
    terms = [t for c in occurring.values() for t in c]
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()).take(which), pa.array(sources, pa.string()).take(which),
        pa.array(terms, pa.binary()).cast(pa.string()),
        pa.array([n for c in occurring.values() for n in c.values()], pa.int64()),
        pa.array([holding[key][t] for key, c in occurring.items() for t in c], pa.int64()),
    ], [*GROUP, "term", "n", "docs"])


class Counts:
    """The written counts an audit is made from.

    ``held`` has a row per group and kept term of the group (``n``) with the language's count
    (``n_lang``), ``groups`` one per group with its total and that of its language, and the
    number of terms the language keeps.
    """

    def __init__(self, docs: DataFrame, least_docs: int = 3):
        texts = group_columns(docs)
        # At most one row per source and term comes together here.
        term = Window.partitionBy("lang", "term")
        counts = term_counts(texts).withColumns({
            "n_lang": F.sum("n").over(term), "docs": F.sum("docs").over(term),
            "is_first": F.row_number().over(term.orderBy("source")) == 1})
        self.held = written(counts.where(F.col("docs") >= least_docs).drop("docs"), "held")
        langs = self.held.groupBy("lang").agg(F.sum("n").alias("total_lang"),
                                              F.count_if("is_first").alias("kept"))
        totals = self.held.groupBy(*GROUP).agg(F.sum("n").alias("total"))
        self.groups = written(
            texts.select(*GROUP).distinct().join(totals, GROUP, "left").join(langs, "lang", "left")
            .na.fill(0, ["total", "total_lang", "kept"]), "groups")


def pair_values(counts: Counts) -> DataFrame:
    """``lang, source, other, value`` for every two sources of a language, both ways round."""
    left = counts.held.select("lang", "term", "source", "n")
    right = counts.held.select("lang", "term", F.col("source").alias("other"),
                               F.col("n").alias("n_other"))
    # Each two sources once; the cells serve both directions.
    both = (left.join(right, ["lang", "term"]).where("source < other")
            .groupBy("lang", "source", "other", "n", "n_other").agg(F.count("*").alias("terms")))
    both = written(both.unionByName(both.select(
        "lang", F.col("other").alias("source"), F.col("source").alias("other"),
        F.col("n_other").alias("n"), F.col("n").alias("n_other"), "terms")), "cells")
    names = counts.groups
    sources = names.select("lang", "source", "total", "kept")
    others = names.select("lang", F.col("source").alias("other"), F.col("total").alias("total_other"))
    pairs = written(sources.join(others, "lang").where("source <> other"), "pairs")
    # A source's cells against each other source, less those of terms that the other has too.
    own = counts.held.groupBy(*GROUP, "n").agg(F.count("*").alias("terms"))
    pair = ["lang", "source", "other"]
    alone = (pairs.select(*pair).join(own, GROUP)
             .unionByName(both.select(*pair, "n", (-F.col("terms")).alias("terms")))
             .groupBy(*pair, "n").agg(F.sum("terms").alias("terms")).where("terms > 0"))
    zero = F.lit(0).cast("long")
    cells = both.unionByName(alone.select(*pair, "n", zero.alias("n_other"), "terms")).unionByName(
        alone.select("lang", F.col("other").alias("source"), F.col("source").alias("other"),
                     zero.alias("n"), F.col("n").alias("n_other"), "terms"))
    # Terms that neither has.
    seen = cells.groupBy(*pair).agg(F.sum("terms").alias("seen"))
    neither = (pairs.join(seen, pair, "left").select(
        *pair, zero.alias("n"), zero.alias("n_other"),
        (F.col("kept") - F.coalesce("seen", F.lit(0))).alias("terms")))
    f = divergence("p", "q")
    return (cells.unionByName(neither).join(pairs, pair)
            .withColumns({"p": F.when(F.col("kept") > 0, probability("n", "total", "kept")),
                          "q": F.when(F.col("kept") > 0,
                                      probability("n_other", "total_other", "kept"))})
            .groupBy(*pair).agg(F.coalesce(F.sum(f.cast("decimal(20,0)") * F.col("terms")),
                                           F.lit(0)).cast("long").alias("value")))


def ranked_pairs(counts: Counts) -> DataFrame:
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "other")
    return pair_values(counts).select(
        *GROUP, F.lit("pair").alias("part"), F.col("other").alias("item"), "value",
        F.row_number().over(order).alias("rank"))


def ranked_terms(counts: Counts, ranks: int = 200) -> DataFrame:
    """Terms more likely in the group than in its language, by divergence from it."""
    cells = (counts.held.groupBy(*GROUP, "n", "n_lang").agg(F.count("*").alias("terms"))
             .join(counts.groups, GROUP)
             .withColumns({"p": probability("n", "total", "kept"),
                           "q": probability("n_lang", "total_lang", "kept")})
             .where("p > q").withColumn("value", divergence("p", "q")))
    cells = written(cells.select(*GROUP, "n", "n_lang", "terms", "value"), "values")
    # Cells of equal value are one class. No more classes than ranks can matter.
    best = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
    classes = (cells.groupBy(*GROUP, "value").agg(F.sum("terms").alias("terms"))
               .withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= ranks))
    until = best.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    classes = (classes.withColumn("before", F.sum("terms").over(until) - F.col("terms"))
               .where(F.col("before") < ranks).select(*GROUP, "value", "before"))
    wanted = cells.join(classes, [*GROUP, "value"]).select(*GROUP, "n", "n_lang", "value", "before")
    named = Window.partitionBy(*GROUP, "value").orderBy("term")
    return (counts.held.join(wanted, [*GROUP, "n", "n_lang"])
            .withColumn("turn", F.row_number().over(named)).where(F.col("turn") <= ranks)
            .withColumn("rank", (F.col("before") + F.col("turn")).cast("int"))
            .where(F.col("rank") <= ranks)
            .select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value",
                    "rank"))


def audited(docs: DataFrame, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: see the module's text.

    Part ``pair`` ranks the other sources of the language, part ``term`` the first ``ranks``
    terms that the source has more of than its language.
    """
    counts = Counts(docs, least_docs)
    return ranked_pairs(counts).unionByName(ranked_terms(counts, ranks))
