"""Each stage against a brute-force version, on what the one before it kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from flowlake.llm import decontamination, queries, toxicity
from flowlake.llm.common import table
from tests.llm import helpers
from tests.llm.test_packing import check_layout
from tests.llm.test_simhash import classes, plain_fingerprint
from tests.llm.test_suffixes import plain

STAGE = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs, seen = table(spark, helpers.SMALL, "documents"), {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, helpers.SMALL)
        seen[name] = (docs.collect(), out.collect(), out.columns)
        docs = spark.createDataFrame(seen[name][1], out.schema)
    return seen


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == [
        "toxicity", "near_duplicates", "repeated_strings", "decontamination", "packing"]
    for name, (before, _, columns) in stages.items():
        if name != "packing":
            assert columns == list(before[0].__fields__)


def test_toxicity(spark):
    docs, labels = (table(spark, helpers.LARGER, t) for t in ("documents", "labels"))
    before = docs.collect()
    score = toxicity.Scorer(queries.toxic_model(docs, labels), queries.TOXIC_FROM)
    after = pipeline.toxicity_filter(spark, docs, helpers.LARGER).collect()
    assert sorted(after) == sorted(r for r in before if score(r.text)[0] < queries.TOXIC_FROM)
    assert 0 < len(after) < len(before)


def test_near_duplicates(stages):
    before, after, _ = stages["near_duplicates"]
    before = sorted(before, key=lambda r: r.doc_id)
    roots = classes([plain_fingerprint(r.text) for r in before])
    assert sorted(after) == sorted(r for i, r in enumerate(before) if roots[i] == i)


def test_repeated_strings(stages):
    before, after, _ = stages["repeated_strings"]
    got = {r.doc_id: r for r in after}
    assert len(got) == len(before)
    for r, (kept, _) in zip(before, plain([r.text.encode() for r in before], 200), strict=True):
        text = kept.decode("utf-8", "ignore")
        assert got[r.doc_id].text == text
        assert got[r.doc_id].n_chars == (r.n_chars if text == r.text else len(text))


def test_decontamination(stages):
    before, after, _ = stages["decontamination"]
    items = [(i, decontamination.normal(t)) for i, t in helpers.sql(
        helpers.SMALL, "select item_id, text from '$/benchmark.parquet'")]
    kept = {r.doc_id for r in after}
    for r in before:
        text = decontamination.normal(r.text)
        if any(t in text for _, t in items):
            assert r.doc_id not in kept
        elif not any(t[k:k + 9] in text for _, t in items for k in range(0, len(t) - 9)):
            assert r.doc_id in kept


def test_packing(stages):
    before, after, _ = stages["packing"]
    check_layout(after, {r.doc_id: r.text for r in before}, 2048)


def test_run_is_all_stages(spark, stages):
    got = pipeline.run(spark, helpers.SMALL)
    want = stages["packing"][1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got.select(*columns).collect()) == sorted(
        tuple(getattr(r, c) for c in columns) for r in want)


def test_odd_rows_pass_all_stages(spark):
    texts = [None, "", " ", "one", "one", "x" * 300_000, "word " * 30, "other text " * 40]
    docs = helpers.docs(spark, texts, [1, 2, None, 4, 4, 6, 7, 8])
    for docs in (docs, docs.limit(0)):
        empty = not docs.count()
        for name, stage in pipeline.STAGES:
            columns = docs.columns
            out = stage(spark, docs, helpers.SMALL)
            rows = out.collect()
            if name != "packing":
                assert out.columns == columns and all(map(helpers.extras_kept, rows))
            if name == "toxicity":
                assert len(rows) == (0 if empty else len(texts))
            docs = spark.createDataFrame(rows, out.schema)
            if name == "decontamination":
                # Blank texts are near duplicates, texts that repeat themselves are cut empty.
                assert {r.doc_id: (r.text, r.n_chars) for r in rows} == ({} if empty else {
                    1: (None, 0), 4: ("one", 3), 6: ("", 0), 7: ("word " * 30, 150), 8: ("", 0)})
        assert sorted(r.doc_id for r in docs.collect()) == ([] if empty else [1, 4, 6, 7, 8])


def test_toxic_and_repeated_rows_leave_the_pipeline(spark):
    docs, labels = (table(spark, helpers.LARGER, t) for t in ("documents", "labels"))
    score = toxicity.Scorer(queries.toxic_model(docs, labels), queries.TOXIC_FROM)
    toxic = next(r.text for r in docs.collect() if score(r.text)[0] > 0.9)
    clean = "a quiet walk along the river " * 3
    first = 1_000_001
    rows = helpers.docs(spark, [toxic, clean, clean, "another plain text"],
                        [first, first + 1, first + 2, None])
    rows = rows.unionByName(docs.select(
        "doc_id", "text", "lang", "source", "n_chars",
        *(F.lit(c).alias(c) for c in helpers.CLASHING)))
    kept = pipeline.toxicity_filter(spark, rows, helpers.LARGER)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert first not in ids and {first + 1, first + 2, None} <= ids
    once = pipeline.near_duplicates(spark, kept, helpers.LARGER).collect()
    assert [r.doc_id for r in once if r.text == clean] == [first + 1]
    assert sum(r.doc_id is None for r in once) == 1 and all(map(helpers.extras_kept, once))
