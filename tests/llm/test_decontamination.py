import random

import numpy as np
import pytest

from flowlake.llm import decontamination as dc
from flowlake.llm import queries
from tests.llm import helpers


def plain(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row), row.index(min(row))


def test_bit_parallel_distance_equals_the_table():
    pick = random.Random(1)
    for _ in range(500):
        p = "".join(pick.choices("abc", k=pick.randrange(1, 14)))
        t = "".join(pick.choices("abc", k=pick.randrange(0, 30)))
        assert dc.closest(dc.masks(p), len(p), t) == plain(p, t)


def test_every_text_within_the_budget_is_found():
    pick = random.Random(2)
    for _ in range(300):
        item = "".join(pick.choices("abcd ", k=pick.randrange(5, 60))).strip() or "a"
        text = "".join(pick.choices("abcd ", k=80))
        if pick.random() < 0.7:
            copy = list(dc.normal(item))
            for _ in range(pick.randrange(0, 5)):
                copy[pick.randrange(len(copy))] = pick.choice(["", "x", "ab"])
            text += "".join(copy) + "dcba"
        norm = dc.normal(item)
        distance, _ = plain(norm, dc.normal(text))
        found = dc.Items([(1, item)], 8).find(text)
        assert bool(found) == (distance <= len(norm) // 8)
        if found:
            (_, start, end, least), = found
            assert least == distance == plain(norm, dc.normal(text)[start:end])[0]


@pytest.mark.parametrize("block", [100, 1 << 20])
def test_blocks_and_empty_cases(spark, block):
    items = spark.createDataFrame(
        [(1, "the quick brown fox jumps over the lazy dog again"), (2, None), (3, ""),
         (4, "The QUICK brown fox  jumps over the lazy dog again"), (None, "sentence"),
         (5, "an entirely different passage of sufficient length")], "item_id long, text string")
    rows = helpers.docs(spark, [
        None, "", "so THE quick\nbrown fox jumped over the lazy dog again!", "nothing here",
        "an entirely different passage of sufficient length"], [1, 2, 3, 4, None])
    got = dc.matched(rows.union(rows), items, 12, block).collect()
    found = sorted((r.doc_id or 0, m.item_id, m.distance) for r in got for m in r.matches)
    assert found == sorted([(3, 1, 2), (3, 4, 2), (0, 5, 0)] * 2)
    assert dc.matched(rows, items.limit(0)).where("size(matches) > 0").count() == 0
    assert dc.matched(rows.limit(0), items).count() == 0


def test_query_finds_exact_copies_and_little_else(spark):
    got = {(r.doc_id, r.item_id): r.distance
           for r in queries.op7_decontamination(spark, helpers.LARGER).collect()}
    exact = set(helpers.sql(helpers.LARGER, """
        select doc_id, item_id from '$/documents.parquet' d, '$/benchmark.parquet' b
        where contains(d.text, b.text)"""))
    assert {k for k, d in got.items() if d == 0} >= exact and len(exact) > 10
    assert len(got) <= 1.2 * len(exact)


def test_one_block_is_in_memory_at_a_time(spark, monkeypatch):
    context, shared, most = type(spark.sparkContext), set(), [0]
    broadcast = context.broadcast

    def counted(self, value):
        made = broadcast(self, value)
        destroy = made.destroy
        shared.add(id(made))
        most[0] = max(most[0], len(shared))
        made.destroy = lambda *a: (shared.discard(id(made)), destroy(*a))
        return made

    passages = [f"passage {i} of its own, number {i * 7919} in the list" for i in range(12)]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(passages)] * 20,
                                  "item_id long, text string")
    rows = helpers.docs(spark, [None, "", "nothing", *passages, " and ".join(passages)],
                        [None, 1, 2, *range(100, 113)])

    def found(block):
        got = dc.matched(rows.union(rows), items, 50, block)
        assert got.columns == rows.columns
        return sorted((r.doc_id or 0, [tuple(m) for m in r.matches]) for r in got.collect())

    whole = found(1 << 20)
    assert sum(len(m) for _, m in whole) == 2 * (12 + 12)
    monkeypatch.setattr(context, "broadcast", counted)
    assert len(dc.item_blocks(items, 150)) < 8
    assert found(150) == whole and most[0] == 1


def test_all_disjoint_places_are_given():
    pick = random.Random(4)
    several = 0
    for trial in range(300):
        per = pick.choice([2, 3, 8])
        item = "".join(pick.choices("abcd", k=pick.randrange(2, 12))) if trial else "aa"
        copies = [item.replace(pick.choice(item), pick.choice("xa"), 1) if pick.random() < 0.4
                  else item for _ in range(pick.randrange(6))]
        text = "".join(c + "".join(pick.choices("abcd", k=pick.randrange(12))) for c in copies)
        found = dc.Items([(1, item), (None, item)], per).occurrences(text)
        assert [m[0] for m in found] == [1] * (len(found) // 2) + [None] * (len(found) // 2)
        places = [m[1:] for m in found[:len(found) // 2]]
        assert [m[1:] for m in found[len(found) // 2:]] == places
        assert all(a[1] <= b[0] for a, b in zip(places, places[1:], strict=False))
        for start, end, distance in places:
            assert distance == plain(item, text[start:end])[0] <= len(item) // per
        # Nothing that could be found is left between the places.
        edges = [0, *(x for p in places for x in p[:2]), len(text)]
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            assert plain(item, text[a:b])[0] > len(item) // per
        several += len(places) > 1
    assert several > 100


def test_further_copies_and_items_without_an_id(spark):
    passage, other = "a passage of the benchmark, here again", "and one that has no id of its own"
    items = spark.createDataFrame([(1, passage), (None, other)], "item_id long, text string")
    rows = helpers.docs(spark, [f"{passage} twice: {passage}.", f"see {other}", "nothing"])
    got = {r.doc_id: r.matches for r in dc.matched(rows, items, 12).collect()}
    assert [(m.item_id, m.start, m.distance) for m in got[0]] == [
        (1, 0, 0), (1, len(passage) + 8, 0)]
    assert [(m.item_id, m.start) for m in got[1]] == [(None, 4)] and not got[2]
    parted = {r.doc_id: r.matches for r in dc.matched(rows, items, 12, 20).collect()}
    assert parted == got


def least_distances(items, text):
    """Of each item the smallest edit distance to any part of the text, a letter at a time."""
    width = max(map(len, items))
    codes = np.zeros((len(items), width), np.int64)
    for row, item in zip(codes, items, strict=True):
        row[:len(item)] = [ord(c) for c in item]
    lengths, step = np.array([len(i) for i in items]), np.arange(width + 1)
    table = np.broadcast_to(step, (len(items), width + 1)).copy()
    best = lengths.copy()
    for letter in text:
        free = np.minimum(table[:, 1:] + 1, table[:, :-1] + (codes != ord(letter)))
        table[:, 1:], table[:, 0] = free, 0
        table = np.minimum.accumulate(table - step, axis=1) + step
        best = np.minimum(best, table[np.arange(len(items)), lengths])
    return best


def test_query_equals_brute_force_over_the_whole_table(spark):
    docs = helpers.sql(helpers.SMALL, "select doc_id, text from '$/documents.parquet'")
    items = [(i, dc.normal(t)) for i, t in helpers.sql(
        helpers.SMALL, "select item_id, text from '$/benchmark.parquet' where text is not null")]
    items = [(i, t) for i, t in items if t]
    budgets = np.array([len(t) // queries.BENCHMARK_PER_ERROR for _, t in items])
    want = {}
    for doc_id, text in docs:
        best = least_distances([t for _, t in items], dc.normal(text))
        want |= {(doc_id, items[k][0]): int(best[k]) for k in np.flatnonzero(best <= budgets)}
    got = {}
    for r in queries.op7_decontamination(spark, helpers.SMALL).collect():
        key = (r.doc_id, r.item_id)
        got[key] = min(r.distance, got.get(key, r.distance))
    assert got == want and want
