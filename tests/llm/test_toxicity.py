from zlib import crc32

import numpy as np
import pytest

from flowlake.llm import queries, toxicity
from tests.llm import helpers


@pytest.fixture(scope="module")
def model():
    clean = [f"a calm day number {i}. The sea is wide. Nothing else" for i in range(40)]
    toxic = [f"a calm day number {i}. You are vilest{'abc'[i % 3]} folk. Sea" for i in range(40)]
    return toxicity.fit(clean + toxic, np.array([0] * 40 + [1] * 40))


def test_score_is_the_noisy_or_of_the_sentences(model):
    score = toxicity.Scorer(model, 0.3)
    text = "Good day. You VILESTa man! \n vilestb, he said"
    total, found = score(text)
    assert [text[a:b].strip() for a, b, _ in found] == ["You VILESTa man", "vilestb, he said"]
    none = 1.0
    for start, end, p in found:
        assert p == pytest.approx(1 / (1 + np.exp(-model.bias - score.weight(text[start:end].lower()))))
        none *= 1 - p
    assert total == pytest.approx(1 - none)
    # A beginning learned from other words counts for a new one.
    assert score("so vilestzzz")[0] > 0.3 > score("so mild")[0] == 0


def test_a_long_clean_text_stays_clean(model):
    assert toxicity.Scorer(model, 0.3)("The sea is wide. " * 50_000) == (0.0, [])


def test_empty_cases(spark, model):
    rows = helpers.docs(spark, [None, "", "  ", "vilesta", "vilesta"], [1, 2, None, 4, 4])
    got = toxicity.scored(rows, model).select("doc_id", "toxicity.score").collect()
    assert [r.score > 0.3 for r in sorted(got, key=lambda r: r.doc_id or 0)] == [
        False, False, False, True, True]
    assert toxicity.scored(rows.limit(0), model).count() == 0
    nothing = toxicity.fit([], np.array([]))
    assert toxicity.Scorer(nothing, 0.3)("vilesta") == (0.0, [])
    assert toxicity.Scorer(toxicity.fit(["a"], np.array([0])), 0.3)("a") == (0.0, [])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.training_sample(rows, labels)[0] == []


def test_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op2_toxicity(spark, helpers.LARGER).collect()}
    labels = dict(helpers.sql(helpers.LARGER, "select doc_id, toxic from '$/labels.parquet'"))
    assert len(got) == 1000
    for i, r in got.items():
        assert r.held_out == (crc32(str(i).encode()) % 4 == 2)
        assert r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1
    held = [(labels[i], r.predicted) for i, r in got.items() if r.held_out and i in labels]
    assert sum(a == b for a, b in held) / len(held) >= 0.95


def test_a_repeated_id_takes_one_place_of_the_sample(spark):
    ids = [i for i in (*range(8), None) for _ in range(5)]
    rows = helpers.docs(spark, [f"{i} text {k % 5 // 2}" for k, i in enumerate(ids)], ids)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] * 2, "doc_id long, toxic int")
    texts, toxic = toxicity.training_sample(rows, labels, per_class=3)
    assert len({t.split()[0] for t in texts}) == len(texts) == 6 and toxic.sum() == 3
    again = toxicity.training_sample(rows.orderBy(rows.text.desc()), labels, per_class=3)
    assert again[0] == texts
