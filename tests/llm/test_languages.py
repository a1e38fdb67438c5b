from zlib import crc32

import numpy as np
import pytest

from flowlake.llm import languages, queries
from tests.llm import helpers


def test_presence_kernel_is_that_of_gram_sets():
    texts = ["the cat sat", "the dog sat down", "el gato", "a"]
    rows, some = languages.presence(texts)
    assert some.all()
    sets = [set(languages.grams(t).tolist()) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert rows[i] @ rows[j] == pytest.approx(len(a & b) / np.sqrt(len(a) * len(b)), 1e-5)
    # " a " has the grams " ", "a", " a", "a " and " a ".
    assert len(set(languages.grams("A!").tolist())) == 5


def test_model_in_one_place_equals_kernel_ridge_regression():
    texts = ["the cat and the dog", "this is that", "el gato y el perro", "esto es eso"]
    names = ["en", "en", "es", "es"]
    model = languages.fit(texts, names, per_language=2, ridge=1e-2)
    rows, _ = languages.presence(texts)
    kernel = rows.astype(float) @ rows.T.astype(float)
    target = np.where(np.array(names)[:, None] == np.array(["en", "es"]), 1.0, -1.0)
    # With all rows as landmarks the features span the kernel's space; a constant joins it.
    joint = kernel + 1
    margins = joint @ np.linalg.solve(joint + 1e-2 * np.eye(4), target)
    got = rows @ model.landmarks @ model.weights[:-1] + model.weights[-1]
    assert np.allclose(got, margins, atol=1e-3)


def test_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op9_languages(spark, helpers.LARGER).collect()}
    rows = helpers.sql(helpers.LARGER, "select doc_id, lang from '$/documents.parquet'")
    assert len(got) == len(rows)
    for i, _ in rows:
        assert got[i].held_out == (crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1
    held = [lang == got[i].lang_pred for i, lang in rows if got[i].held_out and lang]
    assert sum(held) / len(held) >= 0.97


def test_empty_cases(spark):
    rows = helpers.docs(spark, [None, "", "123 !?", "the cat", "the cat", "é" * 100_000],
                        [1, 2, 3, 4, 4, None])
    model = languages.fit(["the cat", "el gato", None], ["en", "es", "xx"])
    assert model.languages == ("en", "es")
    got = languages.predicted(rows, model).select("doc_id", "language.*").collect()
    assert [r.lang_pred for r in got[:5]] == ["und", "und", "und", "en", "en"]
    assert [r.score for r in got[:3]] == [0, 0, 0] and got[5].lang_pred in ("en", "es")
    nothing = languages.fit(*languages.training_sample(rows.limit(0)))
    assert nothing is None
    assert {r["language"]["lang_pred"] for r in languages.predicted(rows, nothing).collect()} == {"und"}
    assert languages.predicted(rows.limit(0), model).count() == 0


def test_a_repeated_id_takes_one_place_of_the_sample(spark):
    ids = [i for i in (*range(8), None) for _ in range(5)]
    rows = helpers.docs(spark, [f"{i} text {k % 5 // 2}" for k, i in enumerate(ids)], ids)
    texts, names = languages.training_sample(rows, per_language=6)
    assert len({t.split()[0] for t in texts}) == len(texts) == 6 and set(names) == {"en"}
    again = languages.training_sample(rows.orderBy(rows.text.desc()), per_language=6)
    assert again[0] == texts
