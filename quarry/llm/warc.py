"""WARC archives as seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each holding a few whole records. A
skippable frame with the record index (record id, frame, offset inside the frame, length) and the
seek table of the public seekable format close the file, so one record is read by decompressing
one frame. Bundles are written and read by Spark's own sinks and sources, so any file system that
Spark reaches will do.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME_BYTES = 256 << 10    # raw bytes after which a frame closes
BUNDLE_BYTES = 16 << 20    # raw bytes after which a bundle closes
SALTS = 32                 # ways in which the copies of one payload are dealt out
SKIPPABLE, SEEK_TABLE = 0x184D2A50, 0x184D2A5E
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "record_id string, target_uri string, bundle string, frame int, frame_offset long, record_length long, payload binary")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:quarry:page:{'' if page_id is None else page_id}:{digest}>"


def _page_of(rid: str) -> int | None:
    page = rid.split(":")[3]
    return int(page) if page else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header (with the payload's length) only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
            f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(url.splitlines()))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        payload = b""
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(["WARC/1.1", *head]).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; the payload digest of a response is computed anew and checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = fields.get("WARC-Refers-To")
    if refers is None and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": None if refers is None else _page_of(refers),
            "record_id": fields["WARC-Record-ID"], "target_uri": fields.get("WARC-Target-URI"),
            "payload": None if refers is not None else payload}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Bundle:
    """Frames of one bundle; ``close`` gives the file without the seek table's last four bytes,
    which the text sink adds as its line separator."""

    def __init__(self, frame_bytes: int):
        self.frame_bytes, self.zstd = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.out, self.table, self.index, self.open, self.fill, self.raw = [], [], [], [], 0, 0

    def add(self, rid: str, record: bytes) -> None:
        self.index.append((rid, len(self.table), self.fill, len(record)))
        self.open.append(record)
        self.fill += len(record)
        self.raw += len(record)
        if self.fill >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if self.open:
            frame = self.zstd.compress(b"".join(self.open))
            self.out.append(frame)
            self.table.append((len(frame), self.fill))
            self.open, self.fill = [], 0

    def close(self) -> bytes:
        self._flush()
        packed = zstandard.ZstdCompressor(level=3).compress(json.dumps(self.index).encode())
        frame = struct.pack("<II", SKIPPABLE, len(packed)) + packed
        self.out.append(frame)
        self.table.append((len(frame), 0))
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IB", len(self.table), 0)
        self.out.append(struct.pack("<II", SEEK_TABLE, len(entries) + len(footer) + 4) + entries + footer)
        return b"".join(self.out)


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, raw size) of every frame, from the table at the end of a bundle."""
    if data[-4:] != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    count, descriptor = struct.unpack("<IB", data[-9:-4])
    width = 12 if descriptor & 0x80 else 8
    at, frames = len(data) - 9 - count * width, []
    start = 0
    for k in range(count):
        size, raw = struct.unpack_from("<II", data, at + k * width)
        frames.append((start, size, raw))
        start += size
    return frames


def bundle_index(data: bytes, frames: list[tuple[int, int, int]] | None = None) -> list[list]:
    """[record id, frame, offset in the frame, length] of every record of a bundle."""
    start, size, _ = (frames or seek_table(data))[-1]
    return json.loads(zstandard.ZstdDecompressor().decompress(data[start + 8: start + size]))


def _writer(frame_bytes: int, bundle_bytes: int):
    def run(batches):
        bundle = _Bundle(frame_bytes)
        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(k) for k in range(4)), strict=True):
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                digest, page_id = sha1_base32(payload), page_id.as_py()
                bundle.add(record_id(page_id, digest), build_record(page_id, url.as_py(), payload, digest, refers.as_py()))
                if bundle.raw >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], names=["bundle"])
                    bundle = _Bundle(frame_bytes)
        if bundle.index:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], names=["bundle"])
    return run


def with_revisits(pages: DataFrame, id_col: str, url_col: str, body_col: str, min_bytes: int) -> DataFrame:
    """(page_id, url, body, refers_to): of equal bodies of ``min_bytes`` or more the largest id is the
    response. The choice is made on (id, digest) rows alone, salted, so neither a body that a third
    of the pages share nor its length reaches one task; bodies move once, by their own id."""
    page = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("body"))
    raw = F.col("body").cast("binary")
    page = page.withColumn("digest", F.unhex(F.sha1(raw)))
    slim = page.filter(F.col("page_id").isNotNull() & (F.octet_length("body") >= min_bytes)).select("page_id", "digest")
    groups = (slim.groupBy("digest").agg(F.max("page_id").alias("top"), F.min("page_id").alias("low"))
              .filter("top <> low").select("digest", "top", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    refers = (slim.distinct().withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
              .join(groups, ["digest", "salt"]).filter("page_id <> top").select("page_id", "digest", F.col("top").alias("refers_to")))
    return page.join(refers, ["page_id", "digest"], "left").select("page_id", "url", "body", "refers_to")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Write one WARC record per row to bundles under ``path``.

    Payload: the body in UTF-8, null as empty. Defined cases: a row without an id is a response of
    its own and takes no part in choosing one; rows that share both id and payload are all
    responses or all revisits; a null URL leaves the header field out; an empty table writes no
    bundle. A record longer than a frame fills a frame alone.
    """
    rows = with_revisits(pages, id_col, url_col, body_col, min_bytes)
    bundles = rows.mapInArrow(_writer(frame_bytes, bundle_bytes), "bundle binary")
    (bundles.select(F.col("bundle").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE_MAGIC.decode("latin-1")).option("compression", "none")
     .option("maxRecordsPerFile", 1).text(path))


def _reader(keep_payload: bool, wanted: bool):
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "frame": pa.int32(),
             "frame_offset": pa.int64(), "record_length": pa.int64(), "payload": pa.binary()}

    def rows(path: str, data: bytes, ids: set | None):
        frames = seek_table(data)
        by_frame: dict[int, list] = {}
        for rid, frame, offset, length in bundle_index(data, frames):
            if ids is None or rid in ids:
                by_frame.setdefault(frame, []).append((offset, length))
        for frame, records in by_frame.items():
            start, size, raw = frames[frame]
            text = zstandard.ZstdDecompressor().decompress(data[start: start + size], max_output_size=raw)
            for offset, length in records:
                got = parse_record(text[offset: offset + length])
                if not keep_payload:
                    got["payload"] = None
                yield got | {"bundle": path, "frame": frame, "frame_offset": offset, "record_length": length}

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = set(batch.column(2)[k].as_py()) if wanted else None
                found = []
                for got in rows(batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), ids):
                    found.append(got)
                    if len(found) == 500:
                        yield _batch(found)
                        found = []
                if found:
                    yield _batch(found)

    def _batch(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[n] for x in found], kinds.get(n, pa.string())) for n in names], names=names)
    return run


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """Every record under ``path`` (see ``RECORD``); payloads on request only."""
    return _bundles(spark, path).select("path", "content").mapInArrow(_reader(keep_payload, False), RECORD)


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, bundle, frame, frame_offset, record_length) from the bundles' own indexes."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                bundle = batch.column(0)[k].as_py()
                index = bundle_index(batch.column(1)[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in index], pa.string()), pa.array([bundle] * len(index), pa.string()),
                     *(pa.array(np.array([x[j] for x in index], np.int64)) for j in (1, 2, 3))],
                    names=["record_id", "bundle", "frame", "frame_offset", "record_length"])
    return _bundles(spark, path).select("path", "content").mapInArrow(
        run, "record_id string, bundle string, frame long, frame_offset long, record_length long")


def fetch_records(spark: SparkSession, path: str, index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records named in ``record_ids`` (column record_id) with payloads: only the bundles that
    hold one are opened and only the frames that hold one are decompressed."""
    where = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    per_bundle = where.groupBy("bundle").agg(F.collect_list("record_id").alias("ids"))  # a bundle holds few records
    files = _bundles(spark, path)
    return (files.join(per_bundle, files["path"] == per_bundle["bundle"]).select("path", "content", "ids")
            .mapInArrow(_reader(True, True), RECORD))
