import base64
import hashlib
import io

import pytest
import zstandard

from quarry.llm import warc
from quarry.llm._common import scratch_path
from quarry.llm.queries import op1_warc
from tests.llm.data import SF01, table


def expected(pages, min_bytes=0):
    top = {}
    for p in pages:
        raw = (p["html"] or "").encode()
        if p["page_id"] is not None:
            top[raw] = max(top.get(raw, p["page_id"]), p["page_id"])
    out = []
    for p in pages:
        raw = (p["html"] or "").encode()
        best = top.get(raw)
        revisit = p["page_id"] is not None and len(raw) >= min_bytes and best != p["page_id"]
        out.append((p["page_id"], len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    assert got(op1_warc(spark, SF01)) == expected(table("pages"))


PAGES = [(1, "u1", "same"), (2, "u2", "same"), (3, None, "same"), (4, "u\r\n4", None), (5, "u5", ""), (6, "u6", "é" * 400_000),
         (7, "u7", "\r\n\r\nWARC/1.1\r\n"), (7, "u7", "\r\n\r\nWARC/1.1\r\n"), (None, "u8", "same"), (None, None, None)]


@pytest.mark.parametrize("min_bytes", [0, 3, 5])
def test_awkward_pages(spark, min_bytes):
    df = spark.createDataFrame([p + ("c",) for p in PAGES], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "t")
    warc.write_archives(df, path, min_bytes=min_bytes, frame_bytes=64, bundle_bytes=500)
    want = expected([dict(zip(("page_id", "url", "html"), p)) for p in PAGES], min_bytes)
    assert got(warc.read_archives(spark, path)) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "t")
    warc.write_archives(df, path)
    assert warc.read_archives(spark, path).count() == 0


def test_bundle_is_a_plain_zstandard_stream_with_a_seek_table(spark):
    df = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string")
    path = scratch_path(spark, "t")
    warc.write_archives(df.coalesce(1), path, frame_bytes=2000)
    files = spark.read.format("binaryFile").load(path + "/part-*").collect()
    records = 0
    for f in files:
        data = bytes(f["content"])
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        records += raw.count(b"WARC/1.1\r\nWARC-Type")
        frames = warc.seek_table(data)
        assert sum(x[2] for x in frames) == len(raw) and len(frames) > 2
        for rid, frame, offset, length in warc.bundle_index(data):
            start, size, n = frames[frame]
            one = zstandard.ZstdDecompressor().decompress(data[start:start + size], max_output_size=n)[offset:offset + length]
            assert warc.parse_record(one)["record_id"] == rid
    assert records == 40


def test_fetch_by_record_id(spark):
    df = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string")
    path = scratch_path(spark, "t")
    warc.write_archives(df, path, frame_bytes=2000, bundle_bytes=6000)
    index = warc.archive_index(spark, path)
    assert index.count() == 40
    wanted = index.filter("record_id like '%:page:7:%' or record_id like '%:page:31:%'").select("record_id")
    rows = warc.fetch_records(spark, path, index, wanted).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in rows} == {i: f"page {i} " * 50 for i in (7, 31)}
