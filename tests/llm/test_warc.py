import hashlib
import io

import zstandard

from flowlake.config import shared_folder
from flowlake.llm import queries, warc
from flowlake.llm.oracles import ORACLES
from tests.llm import helpers
from tests.parity import compare, duck

LONG = "<p>" + "long page " * 20 + "</p>"
ROWS = [(3, "http://a/x", LONG), (1, None, LONG), (2, "http://b\r\n/é", LONG), (4, "u", None),
        (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", LONG),
        (8, "http://c", "ü" * 100_000), (9, "u", "\x00\r\n\r\nWARC/1.1")]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS],
                                  "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc.archived(pages).collect()}
    assert len(got) == len(ROWS)
    for i, _, html in ROWS:
        body = (html or "").encode()
        assert got[i].payload_bytes == len(body)
        assert got[i].payload_digest == hashlib.sha256(body).hexdigest()
        revisit = i in (2, 3)
        assert got[i].record_type == ("revisit" if revisit else "response")
        assert got[i].refers_to == (1 if revisit else None)
    assert warc.archived(pages.limit(0)).count() == 0


def test_bundles_are_one_zstandard_stream_and_seekable(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"{i} " * 20_000) for i in range(160)],
                                  "page_id long, url string, html string")
    path = shared_folder(spark, "warc-test")
    warc.write_bundles(pages.coalesce(1), path, bundle_bytes=1 << 20)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    seen, frames = set(), []
    for data in files:
        plain = zstandard.ZstdDecompressor().stream_reader(
            io.BytesIO(data), read_across_frames=True).read()
        reader = warc.SeekableReader(data)
        assert b"".join(reader.records()) == plain and plain.startswith(b"WARC/1.1\r\n")
        frames.append(len(reader.starts) - 2)
        for i in reader.entries["id"].tolist():
            record, = reader.find(i)
            assert record.endswith(f"{i} ".encode() * 20_000 + b"\r\n\r\n")
            seen.add(i)
    assert seen == set(range(160)) and len(files) > 1 and max(frames) > 3


def test_query_equals_sql(spark):
    got = queries.op5_warc(spark, helpers.LARGER)
    assert compare(got, duck(helpers.LARGER), ORACLES["op5_warc"]) == []
