import re
from collections import Counter, defaultdict

from flowlake.llm import divergence
from flowlake.llm.oracles import ORACLES
from flowlake.llm.queries import op12_divergence
from tests.llm.helpers import CLASHING, EXTRA, LARGER, SMALL
from tests.parity import compare, duck

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, ranks=200):
    """The audit of ``(text, lang, source)`` rows, straight from its definition."""
    rows = [tuple(x or "" for x in row) for row in rows]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holding, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(fold))
        counts[lang, source].update(terms)
        holding[lang].update(set(terms))
    found = []
    for lang in {r[1] for r in rows}:
        sources = {r[2] for r in rows if r[1] == lang}
        kept = [t for t, n in holding[lang].items() if n >= least]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // total for t in kept}

        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in sources}

        def f(a, b):
            return (a - b) * (a - b) // b

        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, i, v, r + 1)
                          for r, (i, v) in enumerate(items[:most])]
    return sorted(found)


def audit(spark, rows, **options):
    docs = spark.createDataFrame(
        [(*r, *CLASHING) for r in rows], f"text string, lang string, source string{EXTRA}")
    return sorted(map(tuple, divergence.audited(docs, **options).collect()))


def test_query_matches_sql(spark):
    for folder in (SMALL, LARGER):
        assert not compare(op12_divergence(spark, folder), duck(folder), ORACLES["op12_divergence"])


def test_odd_rows(spark):
    rows = [
        (None, "en", "a"), ("", None, None), ("12 34 --", "en", "quiet"),
        ("Straße STRASSE ÄÖ äö", "en", "a"), ("straße don't ÄÖ", "en", "b"),
        ("Straße naïve 日本 語\U0001f600x", "en", "c"), ("日本 语 naïve", "en", "c"),
        ("日本 naïve naïve", "en", "d"), ("alone", "fr", "only"), ("alone alone", "fr", "only"),
        ("x" * 3_000_000 + " tail", "en", "long"), ("tail " * 200_000, "en", "long"),
        ("tail", "en", "a"),
    ] + [("same same", "de", "s1")] * 4 + [("same other", "de", "s2")] * 3
    assert audit(spark, rows) == brute(rows)


def test_ties_cross_the_last_rank_in_utf8_order(spark):
    # Many terms of one value: the class that holds the last rank is cut in UTF-8 order.
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)] + ["é", "\U0001f600", "ﬀ"]
    rows = [(" ".join(words), "en", "a"), (" ".join(words[::-1]), "en", "a"),
            (" ".join(words + ["zz"] * 5), "en", "a"), ("zz zz yy", "en", "b"),
            ("yy zz", "en", "b"), ("yy yy yy", "en", "b")]
    assert audit(spark, rows) == brute(rows)
    assert audit(spark, rows, ranks=7) == brute(rows, ranks=7)


def test_counts_beyond_a_task_and_beyond_a_long_product(spark, monkeypatch):
    rows = [(f"w{chr(97 + i % 20)} common word", "en", f"s{i % 3}") for i in range(90)]
    monkeypatch.setattr(divergence, "HELD", 5)
    assert audit(spark, rows) == brute(rows)
    big = spark.sql("select 9000000000000000000 as n, 9100000000000000000 as t, 5L as v")
    value = big.select(divergence.probability("n", "t", "v").alias("p")).collect()[0][0]
    assert value == 1 + 10 ** 9 * (9 * 10 ** 18 + 1) // (91 * 10 ** 17 + 5)


def test_empty_table(spark):
    assert audit(spark, []) == []
