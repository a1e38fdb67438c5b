import math

import numpy as np
import pytest

from flowlake.llm import whitening
from flowlake.llm.queries import op13_whitening
from tests.llm.helpers import CLASHING, EXTRA, SMALL


def brute(vectors):
    """Whole numbers, their exact deviations and their covariance, one vector after the other."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, total = len(x), x.sum(0)
    scaled = n * x - total
    covariance = (scaled.T @ scaled).astype(float) / float(n) ** 3
    return x, (scaled ** 2).sum(1), covariance


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, *CLASHING) for r in rows], f"vec_id long, embedding array<float>{EXTRA}")


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding")
    rows = table.collect()
    x, deviation, covariance = brute([r.embedding for r in rows])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    plain = (len(x) * x - x.sum(0)).astype(float) / len(x)
    expected = plain @ vectors / np.sqrt(values)
    got = op13_whitening(spark, SMALL).toPandas()
    assert len(got) == 32 * len(rows)
    assert (got["n"] == len(rows)).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] <= 1e-4
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    order = np.argsort([r.vec_id for r in rows])
    signs = np.sign((wide.to_numpy() * expected[order]).sum(0))
    assert np.allclose(wide.to_numpy() * signs, expected[order], atol=1e-6)
    assert np.allclose(got[got.vec_id == rows[0].vec_id].sort_values("component")["explained"],
                       values / np.trace(covariance), rtol=1e-9)
    exact = dict(zip((r.vec_id for r in rows), deviation, strict=True))
    assert (got["deviation"] == got["vec_id"].map(exact)).all()


def test_covariance_is_the_exact_one(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) * 10.0 ** np.arange(5) + 900).astype("float32").tolist())
            for i in range(70)]
    fit = whitening.fitted(whitening.usable(frame(spark, rows)))
    _, _, covariance = brute([v for _, v in rows])
    assert np.allclose(fit.covariance, covariance, rtol=1e-13, atol=0)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i * i % 11), float(i % 3)]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 2.0]),
           (104, [inf, 1.0, 2.0]), (105, [1.0, 2.0])]
    odd = [(None, [0.5, 0.25, 1.0]), (3, good[3][1]), (3, good[3][1])]
    got = whitening.whitened(frame(spark, good + bad + odd)).toPandas()
    taking = good + odd
    _, deviation, _ = brute([v for _, v in taking])
    assert len(got) == 3 * len(taking) and (got["n"] == len(taking)).all()
    assert sorted(got["deviation"]) == sorted(int(d) for d in deviation for _ in range(3))
    assert got["vec_id"].isna().sum() == 3 and (got["vec_id"] == 3).sum() == 9
    assert got["identity_error"].max() < 1e-9


def test_degenerate_tables(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [3.0, 4.0]) for i in range(5)]):
        got = whitening.whitened(frame(spark, rows))
        assert got.columns == columns and not got.collect()
    # A dimension that doubles another one leaves one component only.
    line = whitening.whitened(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).toPandas()
    assert set(line["component"]) == {1}
    assert np.isclose(line["explained"].iloc[0], 1) and line["identity_error"].iloc[0] < 1e-9


def test_entries_too_large_for_whole_numbers_of_64_bits(spark):
    rows = [(i, [1e30 * i, float(i % 3)]) for i in range(1, 6)]
    got = whitening.whitened(frame(spark, rows), 2).toPandas()
    assert got["deviation"].isna().all()
    assert len(got) in (5, 10) and np.isfinite(got["whitened"]).all()
    rows = [(i, [3e38 * (-1) ** i, float(i)]) for i in range(4)]
    assert np.isfinite(whitening.whitened(frame(spark, rows)).toPandas()["whitened"]).all()


def test_partial_sums_do_not_depend_on_partitions(spark, monkeypatch):
    rows = [(i, [math.sin(i), math.cos(3 * i), (i % 5) / 7]) for i in range(200)]
    monkeypatch.setattr(whitening, "ROWS", 7)
    one, many = (whitening.fitted(whitening.usable(frame(spark, rows).repartition(n)))
                 for n in (1, 13))
    assert one.sums == many.sums and (one.covariance == many.covariance).all()


@pytest.mark.parametrize("value", [0, 5, -5, 10 ** 40, -10 ** 40, 10 ** 90 + 7])
def test_totals_of_any_size(spark, value):
    def partials(batches):
        yield 0, value
    got = whitening._totals(spark.range(8, numPartitions=4), partials, ["i"])
    assert got == {(0,): 4 * value}
