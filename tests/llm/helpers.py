"""Small tables for the operators' tests."""

from __future__ import annotations

import duckdb

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"

CLASHING = ("score", "component_id", "simhash", "toxicity", "matches", "language", "body", "kept",
            "rank", "key", "hash", "host", "verdict", "document", "piece", "spans", "found", "cut",
            "turn", "simhash_0", "_toxicity", "_matches", "_found", "_digest", "_near_key",
            "_near_hash", "_near_turn", "_best", "_key0", "_document", "a.b", "od`d", "term", "n")
#: The same, as DDL.
EXTRA = "".join(f", `{c.replace('`', '``')}` string" for c in CLASHING)


def docs(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), *CLASHING) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long{EXTRA}")


def extras_kept(row):
    """Whether the extra columns of a row of ``docs`` hold what they held."""
    return all(row[c] == c for c in CLASHING)


def sql(sf_dir, query):
    return duckdb.connect().sql(query.replace("$", sf_dir)).fetchall()
