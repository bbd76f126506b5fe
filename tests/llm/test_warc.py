"""WARC archives: exact round trip, revisits, validation."""
import base64
import hashlib
import io
import random

import pytest
import zstandard

from shelfspark.llm import warc

SCHEMA = "page_id long, url string, html string, record_type int"


def data():
    rng = random.Random(8)
    rows = [(i, f"http://h{i % 7}.example.org/p/{i}", f"<html>{rng.choice('abc') * 50} page {i}</html>" * rng.randrange(1, 30), 1) for i in range(120)]
    rows += [(200 + i, "http://copy.example/", "<p>the same page</p>", 1) for i in range(60)]
    rows += [(300, None, None, 1), (301, "bad url\r\nX: y", "", 1), (302, "u", "é\U0001F600\r\n\r\nWARC/1.1", 1), (303, "u", "z" * 3_000_000, 1),
             (5, rows[5][1], rows[5][2], 1), (None, "n", "<p>the same page</p>", 1), (None, "m", "only unnamed", 1), (None, "k", "only unnamed", 1)]
    rng.shuffle(rows)
    return rows


def test_round_trip(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = warc.archived(df).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h, _ in rows:
        first.setdefault(h or "", []).append(i)
    first = {h: min((i for i in ids if i is not None), default=None) for h, ids in first.items()}
    want = []
    done = set()
    for i, _, h, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (h or "").encode()
        kind = "response" if first[h or ""] == i and h not in done else "revisit"
        if kind == "response":
            done.add(h)
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, raw if kind == "response" else None))
    assert sorted(((r.page_id, r.payload_length, r.payload_digest, r.record_type, r.payload and bytes(r.payload) or (b"" if r.payload is not None else None))
                   for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert (r.refers_to is None) == (r.record_type == "response")


def test_archives_carry_a_dictionary_and_a_frame_per_record(spark):
    df = spark.createDataFrame([(i, "u", f"<html><body>common words of every page {i}</body></html>" * 20, 1) for i in range(400)], SCHEMA)
    manifest = warc.write_archives(warc.page_records(df).coalesce(1)).collect()
    assert sum(m.records for m in manifest) == 400 and manifest[0].dictionary_bytes > 0
    files, at = warc._filesystem(manifest[0].path)
    raw = files.open_input_stream(at).read()
    assert int.from_bytes(raw[:4], "little") == warc.DICT_MAGIC
    assert sum(1 for _ in warc.frames(io.BytesIO(raw))) == manifest[0].records


def good():
    return warc._record("urn:x:1:2", "response", "u", hashlib.sha1(b"abc").hexdigest(), 3, None, b"abc")


def test_frames_without_a_dictionary_and_broken_ones():
    press = zstandard.ZstdCompressor(write_checksum=True)
    raw = press.compress(b"one") + press.compress(b"two" * 500_000)
    assert list(warc.frames(io.BytesIO(raw))) == [b"one", b"two" * 500_000]
    assert list(warc.frames(io.BytesIO(b""))) == []
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(raw[:-3])))


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), lambda r: r[:-1], lambda r: r.replace(b"abc", b"abd"),
    lambda r: r.replace(b"WARC-Date: 1970-01-01T00:00:00Z\r\n", b""), lambda r: r.replace(b"Length: 3", b"Length: 4"),
    lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Type: response"), lambda r: r.replace(b"response", b"metadata"),
    lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit")])
def test_broken_records_are_refused(change):
    assert warc.parse_record(good())[1] == "response"
    with pytest.raises(ValueError):
        warc.parse_record(change(good()))


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0
