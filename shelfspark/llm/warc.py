"""WARC archives in Zstandard: one frame per record, a dictionary in the leading skippable frame.

``write_archives`` turns every partition of records into archives in the
shared folder; ``read_archives`` streams them back, checking every header.
Files are written under names no other attempt uses, and only the rows that
Spark itself commits (the manifest) say which files count, so lost executors
and repeated attempts leave at most unused files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import small_batches, stored
from shelfspark.session import scratch_path

DICT_MAGIC = 0x184D2A5D  # skippable frame that carries the dictionary
# An archive is closed beyond this many compressed bytes.
ARCHIVE_BYTES = 256 * 2**20
# The dictionary is trained on at most this many leading bytes of an archive's records.
SAMPLE_BYTES = 512 * 2**10
SAMPLE_PIECE = 4096
DICT_BYTES = 32 * 2**10
LEVEL = 3
CHUNK = 256 * 2**10

MANIFEST = "path string, records long, bytes long, dictionary_bytes long"
RECORD = ("record_id string, record_type string, target_uri string, payload_digest string, "
          "payload_length long, refers_to string, payload binary")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    import base64
    import hashlib
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(rid: str, kind: str, uri: str | None, sha1: str, length: int, refers: str | None, payload: bytes) -> bytes:
    """One WARC/1.1 record. A revisit names the response and leaves the payload out."""
    import base64
    sha1 = base64.b32encode(bytes.fromhex(sha1)).decode()
    safe = "".join(c if c > " " else f"%{ord(c):02X}" for c in uri or "about:blank")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {safe}", f"WARC-Payload-Digest: sha1:{sha1}", f"WARC-X-Payload-Length: {length}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload if kind == "response" else http
    if refers is not None:
        head += [f"WARC-Refers-To: <{refers}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith(("file:", "/")) else f"file://{uri}")


def _trained(samples: list[bytes]):
    """A dictionary of the leading records, or None where there is too little to learn from."""
    import zstandard
    pieces = [s[i:i + SAMPLE_PIECE] for s in samples for i in range(0, len(s), SAMPLE_PIECE)]
    if len(pieces) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, k=200, d=8)
    except zstandard.ZstdError:
        return None


def write_archives(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``record_id, record_type, target_uri, payload_sha1 (hex), payload_length, refers_to, payload``
    rows as archives; returns the manifest (path, records, bytes, dictionary_bytes), stored."""
    spark = records.sparkSession
    small_batches(spark)
    base = folder or scratch_path(spark, f"warc-{uuid.uuid4().hex}")

    def run(batches: Iterator) -> Iterator:
        import struct

        import pyarrow as pa
        import zstandard

        files, base_path = _filesystem(base)
        files.create_dir(base_path, recursive=True)

        def archives(rows: Iterator) -> Iterator:
            row = next(rows, None)
            while row is not None:
                lead, load = [], 0
                while row is not None and load < SAMPLE_BYTES:
                    lead.append(row)
                    load += len(row)
                    row = next(rows, None)
                words = _trained([x[: max(SAMPLE_BYTES // 8, SAMPLE_PIECE)] for x in lead])
                press = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=True)
                name = f"{uuid.uuid4().hex}.warc.zst"
                size = count = 0
                with files.open_output_stream(f"{base_path}/{name}") as out:
                    if words is not None:
                        body = zstandard.ZstdCompressor(level=LEVEL).compress(words.as_bytes())
                        out.write(struct.pack("<II", DICT_MAGIC, len(body)) + body)
                        size += 8 + len(body)
                    for x in lead:
                        size += out.write(press.compress(x)) or 0
                        count += 1
                    del lead
                    while row is not None and size < ARCHIVE_BYTES:
                        size += out.write(press.compress(row)) or 0
                        count += 1
                        row = next(rows, None)
                full = f"{base.rstrip('/')}/{name}"
                yield full, count, files.get_file_info(f"{base_path}/{name}").size, 0 if words is None else len(words.as_bytes())

        def rows() -> Iterator:
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    yield _record(*r)

        for made in archives(rows()):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                made, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["path", "records", "bytes", "dictionary_bytes"])

    wanted = records.select("record_id", "record_type", "target_uri", "payload_sha1", "payload_length", "refers_to", "payload")
    return stored(wanted.mapInArrow(run, MANIFEST), "warc-manifest")


def frames(stream) -> Iterator[bytes]:
    """Decoded frames of an archive, one by one; the leading skippable frame gives the dictionary."""
    import struct

    import zstandard
    head = stream.read(8)
    words, pending = None, head
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICT_MAGIC:
            body = stream.read(size)
            if len(body) != size:
                raise ValueError("archive ends inside its dictionary")
            if body[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be a frame
                body = zstandard.ZstdDecompressor().decompress(body)
            words, pending = zstandard.ZstdCompressionDict(body), b""
    tool = zstandard.ZstdDecompressor(dict_data=words)
    while True:
        pending = pending or stream.read(CHUNK)
        if not pending:
            return
        one, parts = tool.decompressobj(), []
        while True:
            parts.append(one.decompress(pending))
            if one.eof:
                pending = one.unused_data
                break
            pending = stream.read(CHUNK)
            if not pending:
                raise ValueError("archive ends inside a frame")
        yield b"".join(parts)


def parse_record(raw: bytes) -> tuple:
    """A validated record as a RECORD row; raises ValueError for a broken one."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1" or not gap:
        raise ValueError(f"not a WARC/1.1 record: {lines[0][:40]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise ValueError(f"bad or repeated header: {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header {name} is missing")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record is {len(rest) - 4} bytes long, its header says {length}")
    block, kind = rest[:length], fields["warc-type"]
    if fields.get("warc-block-digest") not in (None, f"sha1:{digest(block)}"):
        raise ValueError("block digest differs")
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected record type {kind}")
    payload = block.partition(b"\r\n\r\n")[2]
    sha1 = fields["warc-payload-digest"].removeprefix("sha1:")
    known, refers = int(fields["warc-x-payload-length"]), fields.get("warc-refers-to")
    if kind == "response" and (len(payload) != known or digest(payload) != sha1):
        raise ValueError("payload differs from its digest or length")
    if (kind == "revisit") != (refers is not None) or kind == "revisit" and payload:
        raise ValueError("a revisit names a response and has no payload")
    return (fields["warc-record-id"].strip("<>"), kind, fields.get("warc-target-uri"), sha1, known,
            None if refers is None else refers.strip("<>"), payload if kind == "response" else None)


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """RECORD rows of every archive in ``manifest``; a task reads whole archives, a record at a time.

    A broken archive, frame, header or length fails the job, as does a file
    with another number of records than the manifest says.
    """
    small_batches(spark)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        names = [c.split()[0] for c in RECORD.split(", ")]

        def batch(rows: list):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                files, at = _filesystem(path)
                held, load, count = [], 0, 0
                with files.open_input_stream(at) as stream:
                    for frame in frames(stream):
                        held.append(parse_record(frame))
                        count += 1
                        load += len(frame)
                        if load > 8 * 2**20 or len(held) >= 500:
                            yield batch(held)
                            held, load = [], 0
                if held:
                    yield batch(held)
                if count != records:
                    raise ValueError(f"{path}: {count} records, {records} were written")

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path", "records").repartition(tasks, "path").mapInArrow(run, RECORD)


def page_records(pages: DataFrame) -> DataFrame:
    """A record per row of ``page_id, url, html``: of equal payloads the smallest page_id is the response.

    The rows of one payload, however many, meet only as counts and ids; the
    payloads themselves are dealt by page_id and digest. Null html counts as
    empty, null page_ids come last, and of rows that repeat page_id and html
    the others revisit the first.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_sha1"))
    rows = rows.withColumn("__key", F.concat_ws(":", name, "payload_sha1"))
    ids = pages.select("page_id", F.sha1(payload).alias("payload_sha1")).distinct()
    first = ids.groupBy("payload_sha1").agg(F.min("page_id").alias("first_id"))
    named = ids.join(first, "payload_sha1").select(F.concat_ws(":", name, "payload_sha1").alias("__key"), "first_id")
    nth = F.row_number().over(Window.partitionBy("__key").orderBy(F.col("url").asc_nulls_first()))
    response = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("nth") == 1)
    uri = F.lit("urn:shelfspark:page:")
    return rows.join(named, "__key").withColumn("nth", nth).select(
        F.concat(uri, name, F.when(F.col("nth") > 1, F.concat(F.lit(":"), F.col("nth").cast("string"))).otherwise(""))
         .alias("record_id"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.col("url").alias("target_uri"), "payload_sha1", F.length("payload").cast("long").alias("payload_length"),
        F.when(~response, F.concat(uri, F.coalesce(F.col("first_id").cast("string"), F.lit("")))).alias("refers_to"),
        F.when(response, F.col("payload")).alias("payload"))


def page_id(uri: str):
    """The page_id in a record's URI; null for the empty one."""
    return F.expr(f"try_cast(element_at(split({uri}, ':'), 4) AS BIGINT)")


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back, and return RECORD rows with page_id.

    An empty table gives no archive and an empty result; extra columns are ignored.
    """
    manifest = write_archives(page_records(pages))
    return read_archives(pages.sparkSession, manifest).withColumn("page_id", page_id("record_id"))
