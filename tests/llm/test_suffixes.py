import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from flowlake.llm import queries, suffixes
from tests.llm import helpers


def plain(bodies, least):
    """Kept bytes and removed spans of each body."""
    seen = Counter(b[i:i + least] for b in bodies for i in range(len(b) - least + 1))
    out = []
    for b in bodies:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - least + 1):
            if seen[b[i:i + least]] > 1:
                covered[i:i + least] = True
        start, length = suffixes.stretches(covered)
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        out.append((kept, list(zip(start.tolist(), length.tolist(), strict=True))))
    return out


@pytest.mark.parametrize("seed", range(25))
def test_blocks_equal_brute_force(seed):
    pick = random.Random(seed)
    least = pick.choice([1, 3, 9, 30])
    base = bytes(pick.choices(b"ab\x00\xff", k=200))
    strings = [base[pick.randrange(150):][:pick.randrange(90)]
               + bytes(pick.choices(b"abc", k=pick.randrange(20))) for _ in range(30)]
    seen = Counter(s[i:i + least] for s in strings for i in range(len(s) - least + 1))
    for s, flags in zip(strings, suffixes.repeated_windows(strings, least), strict=True):
        assert flags.tolist() == [seen[s[i:i + least]] > 1 for i in range(len(s) - least + 1)]


def corpus():
    pick = random.Random(3)

    def words(n):
        return " ".join("".join(pick.choices("abcdé ", k=6)) for _ in range(n))

    passage, lead = words(60), words(50)
    texts = [words(pick.randrange(40)) for _ in range(20)]
    # One passage behind and before many different contexts.
    texts += [words(8) + passage[pick.randrange(40):] + words(8) for _ in range(25)]
    texts += [lead, lead, lead[:-1] + "x", "ab" * 400, "z" * 201, None, "", "y" * 200,
              words(400) + lead + words(100)]
    return texts


@pytest.mark.parametrize("limit", [2500, 3])
def test_operator_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(suffixes, "GROUP_LIMIT", limit)
    monkeypatch.setattr(suffixes, "CHUNK", 1 << 12)
    monkeypatch.setattr(suffixes, "LOW", np.uint64((1 << 12) - 1))
    monkeypatch.setattr(suffixes, "PIECE", 300)
    texts = corpus()
    got = {r["document"]["doc_id"]: r for r in suffixes.without_repeats(
        helpers.docs(spark, texts)).collect()}
    want = plain([(t or "").encode() for t in texts], 200)
    for i, (kept, spans) in enumerate(want):
        assert bytes(got[i]["kept"]) == kept
        assert [tuple(s) for s in got[i]["spans"]] == spans
    assert sum(bool(s) for _, s in want) > 25
    assert all(r["document"][c] == c for r in got.values() for c in helpers.CLASHING)


def test_spans_do_not_depend_on_batches(spark):
    pick = random.Random(8)
    rows = [(k, -k, pick.randrange(600), pick.randrange(1, 40)) for k in range(6)
            for _ in range(pick.choice([1, 4, 60]))]
    frame = spark.createDataFrame(rows, "key long, hash long, start long, windows int").coalesce(1)
    want = {}
    for key in range(6):
        covered = np.zeros(700, bool)
        for k, _, start, windows in rows:
            if k == key:
                covered[start:start + windows + 9] = True
        start, length = suffixes.stretches(covered)
        want[key] = list(zip(start.tolist(), (start + length).tolist(), strict=True))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for size in ("1", "7", "10000"):
            spark.conf.set(name, size)
            got = suffixes.spans_of(frame, 10).collect()
            assert {r["key"]: [tuple(p) for p in np.frombuffer(r["spans"], np.int64)
                               .reshape(-1, 2).tolist()] for r in got} == want
    finally:
        spark.conf.set(name, before)


def test_query_equals_brute_force(spark):
    rows = helpers.sql(helpers.SMALL, "select doc_id, text from '$/documents.parquet' order by 1")
    got = {r.doc_id: r for r in queries.op10_suffixes(spark, helpers.SMALL).collect()}
    bodies = [t.encode() for _, t in rows]
    for (i, _), body, (kept, spans) in zip(rows, bodies, plain(bodies, 200), strict=True):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (
            len(body), len(body) - len(kept), len(spans))
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_characters_stay_whole(spark):
    # Equal bytes that begin inside one character and end inside another.
    texts = ["é" + "w" * 250 + "é", "ũ" + "w" * 250 + "è"]
    got = suffixes.without_repeats(helpers.docs(spark, texts), characters=True).collect()
    assert all(bytes(r["kept"]).decode() is not None for r in got)


def test_empty_cases(spark):
    rows = helpers.docs(spark, [None, "", "q" * 150, "r" * 300, "r" * 300], [None, 2, 2, 7, 7])
    got = suffixes.without_repeats(rows).collect()
    assert sorted(len(r["kept"]) for r in got) == [0, 0, 0, 0, 150]
    assert suffixes.without_repeats(rows.limit(0)).count() == 0


def test_equal_rows_share_one_list_of_starts(spark):
    pick = random.Random(5)
    texts = [" ".join("".join(pick.choices("abcde", k=6)) for _ in range(300)) for _ in range(2)]
    texts.append(texts[1][:900] + "other")  # A mixed minimizer.

    def stretches_of(copies):
        rows = helpers.docs(spark, [texts[0]] * copies + [texts[1]] * copies + texts[2:],
                            [7] * copies + [None] * copies + [8])
        found = suffixes.repeated_starts(suffixes.keyed(rows), 200).collect()
        return rows, Counter(tuple(r) for r in found)

    _, few = stretches_of(2)
    rows, many = stretches_of(30)
    assert many == few and set(many.values()) == {1}
    kept = [bytes(r["kept"]) for r in suffixes.without_repeats(rows).collect()]
    assert sorted(kept) == [b""] * 60 + [b"other"]
