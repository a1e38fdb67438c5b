from itertools import combinations

import numpy as np
import pytest
import xxhash

from flowlake.llm import queries, simhash
from flowlake.llm.components import components
from tests.llm import helpers


def plain_fingerprint(text):
    words = [w for w in text.translate({c: c + 32 for c in range(65, 91)}).encode().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=4):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= distance:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One TWO three", "É é\x0bx\x1cy z  a\r\nb",
                                  "a b c d " * 50, "x y z w v u t s"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)


def test_every_close_pair_shares_a_byte_group():
    groups = simhash.covering_groups(4, 3)
    assert len(groups) == 20
    for shared in combinations(range(8), 4):
        assert any(set(g) <= set(shared) for g in groups)


@pytest.mark.parametrize("block,width", [(4, 3), (1500, 3), (1500, 4), (1500, 2)])
def test_links_connect_what_all_pairs_connect(spark, block, width):
    random = np.random.default_rng(5)
    values = set()
    for _ in range(12):  # clouds and chains around a few centres
        at = int(random.integers(0, 2**63))
        for _ in range(25):
            for bit in random.choice(64, random.integers(0, 4), replace=False):
                at ^= 1 << int(bit)
            values.add(at)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "simhash long")
    found = components(simhash.links(prints, 4, width, block))
    got = {r.node: r.root for r in found.collect()}
    want = classes(values)
    ours = [got.get(s, s) for s in signed]
    pairs = {(a, b) for a, b in zip(want, ours, strict=True)}
    assert len(pairs) == len(set(want)) == len(set(ours))


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {
        **dict.fromkeys(range(61), 0), 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op3_simhash(spark, helpers.LARGER).collect()}
    rows = helpers.sql(helpers.LARGER, "select doc_id, text from '$/documents.parquet' order by 1")
    values = [plain_fingerprint(t) for _, t in rows]
    for (i, _), v, c in zip(rows, values, classes(values), strict=True):
        assert got[i].fingerprint == f"{v:016x}" and got[i].component_id == rows[c][0]


def test_empty_cases(spark):
    rows = helpers.docs(spark, [None, "", "a b c d e", "a b c d e", "other words here now"],
                        [5, 3, None, 9, 1])
    got = sorted((r.doc_id is None, r.doc_id, r.component_id)
                 for r in simhash.near_duplicates(rows).collect())
    assert got == [(False, 1, 1), (False, 3, 3), (False, 5, 3), (False, 9, 9), (True, None, 9)]
    assert simhash.near_duplicates(rows.limit(0)).count() == 0
    kept = simhash.one_of_each(rows.union(rows))
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 9]
    assert [r.doc_id for r in simhash.one_of_each(
        helpers.docs(spark, ["q r s t"] * 2, [None, None])).collect()] == [None]
    assert simhash.one_of_each(rows.limit(0)).count() == 0
