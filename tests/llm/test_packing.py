import random
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowlake.llm import packing, queries
from tests.llm import helpers

PATH = queries.tokenizer_path()
FULL = Tokenizer.from_file(PATH)
ENCODE = packing.Encoder(PATH)


def ids_of(text):
    return FULL.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sltvred.é0½€\x85\xa0\x1c"), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_ids_are_the_tokenizers(text):
    assert ENCODE.quick
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == ids_of(text)


def test_special_strings_and_long_texts():
    for text in ("a <|endoftext|> b", "word " * 5000, "x" * 3000, "  \n " * 500):
        assert np.frombuffer(ENCODE(text), "<u4").tolist() == ids_of(text)


def test_long_runs_of_white_space(spark):
    blank = [" " * 5_000_000, "a" + "\n" * 1_000_000 + "b", " \t\n\x85\xa0" * 300_000,
             ("word" + " " * 9_999) * 3 + "\n" * 10_001 + "x"]
    for text in blank:
        assert np.frombuffer(ENCODE(text), "<u4").tolist() == ids_of(text)
    got = packing.pieces(helpers.docs(spark, blank), PATH, 2048).collect()
    for i, text in enumerate(blank):
        assert sum(r.length for r in got if r.doc_id == i) == len(ids_of(text)) + 1


def plain_best_fit(lengths, capacity, most):
    bins, made, out = {}, 0, []
    for n in lengths:
        fits = sorted((free, b) for b, free in bins.items() if free >= n)
        if fits:
            least = fits[0][0]
            b = next(b for b in reversed(list(bins)) if bins[b] == least)
            free = bins.pop(b)
        else:
            b, free, made = made, capacity, made + 1
        out.append(capacity - free)
        if free > n:
            if len(bins) >= most:
                fullest = min(bins.values())
                if free - n <= fullest:
                    continue
                del bins[next(k for k in reversed(list(bins)) if bins[k] == fullest)]
            bins[b] = free - n
    return out, made


def test_open_bins_equal_a_plain_search():
    pick = random.Random(4)
    for most in (1, 3, 50):
        lengths = [pick.randrange(1, 65) for _ in range(400)]
        bins = packing.OpenBins(64, most)
        offsets = [bins.place(n)[1] for n in lengths]
        want, made = plain_best_fit(lengths, 64, most)
        assert bins.made == made and offsets == want


def check_layout(rows, texts, length):
    """``texts`` by id; returns the number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, own in by_doc.items():
        ids = [*ids_of(texts[i] or ""), 0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // length)
        at = 0
        for r in own:
            assert r.start == at and 0 < r.length <= length
            assert r.length == length or r.piece == 0
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == crc32(part)
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence)


def test_query(spark):
    rows = queries.op8_packing(spark, helpers.LARGER).collect()
    texts = dict(helpers.sql(helpers.LARGER, "select doc_id, text from '$/documents.parquet'"))
    sequences = check_layout(rows, texts, 2048)
    assert sequences <= 1.05 * -(-sum(r.length for r in rows) // 2048) + 8


def test_empty_cases(spark):
    texts = {1: None, 2: "", 3: "word " * 100, None: "a b"}
    rows = packing.packed(packing.pieces(
        helpers.docs(spark, list(texts.values()), list(texts)), PATH, 16, True), 16, 2).collect()
    check_layout(rows, texts, 16)
    assert [i for r in sorted((r for r in rows if r.doc_id == 3), key=lambda r: r.piece)
            for i in r.ids] == [*ids_of(texts[3]), 0]
    twice = helpers.docs(spark, ["same text"] * 2, [7, 7])
    assert packing.packed(packing.pieces(twice, PATH, 16), 16).count() == 2
    assert packing.packed(packing.pieces(twice.limit(0), PATH, 16), 16).count() == 0
