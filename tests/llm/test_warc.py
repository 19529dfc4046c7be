import hashlib
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import SF

from sluice.llm import warc
from sluice.llm.queries import op5_warc


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunks(data, size):
    assert warc.unchunked(warc.chunked(data, size)) == data
    assert warc.payload_of(warc.HTTP + warc.chunked(data, size)) == data


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=3000), st.integers(100, 900), st.randoms())
def test_segments_in_any_order(data, size, rng):
    digest = hashlib.sha256(data).hexdigest()
    raw = list(warc.records(5, "page:5:0", "http://x/\r\nevil ü", data, digest, None, size))
    parts = [warc.parsed(m) for m in warc.members(io.BytesIO(b"".join(raw)), read=97)]
    assert all(b"\n" not in f.get("warc-target-uri", "").encode() for f, _ in parts)
    if len(parts) == 1:
        assert "warc-segment-number" not in parts[0][0]
        block = parts[0][1]
    else:
        segments = [(int(f["warc-segment-number"]), int(t) if (t := f.get("warc-segment-total-length")) else None, b) for f, b in parts]
        rng.shuffle(segments)
        block, status = warc.reassembled(segments)
        assert status == "ok"
        assert warc.reassembled(segments + segments[:1])[1] == "ok"  # a repeated segment
        gone = [s for s in segments if s[0] != 2]
        assert warc.reassembled(gone)[1] == "missing segment"
        bad = [(n, t, b[1:] if n == 1 else b) for n, t, b in segments]
        assert warc.reassembled(bad)[1] == "bad length"
    assert warc.payload_of(block) == data


def test_broken_records():
    member = next(warc.members(io.BytesIO(next(warc.records(1, "n", None, b"x", "d", None, 10_000)))))
    with pytest.raises(ValueError):
        warc.parsed(member[:-1])
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")
    fields, block = warc.parsed(member)
    assert warc.described(fields, block, True)[-1] == "bad digest"
    assert warc.described(fields, b"junk", True)[-1] == "bad framing"
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(next(warc.records(1, "n", None, b"x", "d", None, 10_000))[:-9])))


def test_round_trip_of_odd_pages(spark):
    rng = random.Random(3)
    big = "".join(rng.choices("abc é\r\n", k=200_000))
    rows = [(1, "u", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", big), (7, "u", "x" * 100), (7, "u", "x" * 100), (None, "v", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = warc.resolved(warc.read_archives(*warc.write_archives(pages, segment_bytes=4096))).collect()
    assert len(read) == len(rows) and {r.status for r in read} == {"ok"} and len({r.record_id for r in read}) == len(rows)
    by = sorted(((r.page, r.type, r.refers_page, r.payload_bytes) for r in read), key=str)
    n = len(big.encode())
    want = [(1, "response", None, n), (2, "revisit", 1, n), (3, "response", None, 0), (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 5), (None, "revisit", 1, n), (7, "response", None, 100), (7, "revisit", 7, 100), (None, "response", None, 100)]
    assert by == sorted(want, key=str)
    assert next(r.payload for r in read if r.page == 1) == big.encode()
    assert all(r.payload_digest == hashlib.sha256((h or "").encode()).hexdigest() for r in read for p, _, h in rows if p is not None and p == r.page)
    assert warc.read_archives(*warc.write_archives(pages.where("false"))).count() == 0


def test_query(spark):
    rows = {r.page_id: r for r in op5_warc(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        got = rows[r.page_id]
        assert (got.payload_bytes, got.payload_digest) == (len(r.html.encode()), hashlib.sha256(r.html.encode()).hexdigest())
