import numpy as np

from flowlake.llm import neighbours, queries
from tests.llm import helpers


def plain(rows, queries_, k):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], float)
    out = {}
    for q, v in queries_:
        distance = np.sqrt(((matrix - np.array(v, float)) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, distance)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(distance[j])) for j in order]
    return out


def recall(got, want):
    hits = total = 0
    for q, own in want.items():
        far = own[-1][1] if own else 0
        hits += sum(r.score <= far + 1e-12 for r in got.get(q, []))
        total += len(own)
    return hits / total


def by_query(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, []).append(r)
    for own in out.values():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
    return out


def test_query_against_brute_force(spark):
    rows = helpers.sql(helpers.LARGER, "select vec_id, embedding from '$/embeddings.parquet'")
    want = plain(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = by_query(queries.op1_neighbours(spark, helpers.LARGER))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert recall(got, want) >= 0.9


def test_forest_finds_most_of_many(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.3 * random.normal(size=16)).tolist()) for i in range(4000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(neighbours.nearest(table, table.where("vec_id % 50 = 0"), leaf=32, share=0.05,
                                      least=100))
    want = plain(rows, [r for r in rows if r[0] % 50 == 0], 10)
    assert recall(got, want) >= 0.9
    for q, own in want.items():
        scores = dict(own)
        assert all(abs(r.score - scores[r.vec_id]) < 1e-12 for r in got[q] if r.vec_id in scores)


def test_the_queue_takes_nearer_planes_first():
    random = np.random.default_rng(1)
    forest = neighbours.grow(random.normal(size=(256, 4)), trees=3, depth=4)
    query = random.normal(size=(1, 4))
    leaves = forest.route(query)[:, 0]
    first = forest.search(query, 3)[0]
    assert sorted(first) == [(t, int(leaf)) for t, leaf in enumerate(leaves)]
    assert len(set(forest.search(query, 1000)[0])) == 3 * 16


def test_equal_vectors_ties_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [
        (1000, None), (1001, [0.0, 0.0]), (1002, [nan, 1.0]), (1003, [inf, 1.0]), (1004, []),
        (1005, [1.0, None]), (1006, [1.0, 2.0, 3.0]), (None, [1.0, 0.5]), (7, [1.0, 0.0]),
        (400, [1.0, 1.0]), (401, [-1.0, 0.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows],
                                  "vec_id long, embedding array<double>, score string")
    got = by_query(neighbours.nearest(table, table.where("vec_id % 100 = 0")))
    assert got.keys() == {0, 100, 200, 400}
    assert [r.vec_id for r in got[0]] == list(range(1, 11))
    assert [r.vec_id for r in got[100]] == list(range(10)) == [r.vec_id for r in got[400]]
    assert {r.score for r in got[200]} == {0.0} and {r.score for r in got[400]} == {1.0}
    few = table.where("vec_id >= 399")
    assert [r.vec_id for r in by_query(neighbours.nearest(few, few.where("vec_id = 400")))[400]] == [401]
    assert neighbours.nearest(table.limit(0), table).count() == 0
