"""WARC archives: a writer of one gzip member a record, and a splittable reader.

write_warc() names each payload by its SHA-1, makes the record with the largest page_id of equal payloads the response and
the others revisits of it, and lets each task write its own files under names that no other attempt shares. Only files that
the committed manifest names are ever read, so a lost executor or a repeated task leaves no doubled record.

read_warc() deals out byte ranges, sized from the archives' bytes and the cluster's cores, a task each. A task looks in its range for the gzip magic, accepts a candidate only if it decodes to a
WARC header, and owns the records that start inside its range; the last of them may end beyond it. From an accepted member
on, the next one starts where it ends, so members aren't searched for again. A task holds one record and one read block.

Null html is the empty payload; a null page_id is written and read back as null, and it is the response only if no
equal payload has an id; rows equal in page_id and payload all take the same type; an empty table gives an empty archive;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm.shared import fresh_path, settle, whole_text

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 20
#: Bytes of a range, least and most, and tasks of a read at most (a task takes several ranges then).
SPLIT_LEAST, SPLIT_MOST, TASKS_MOST = 1 << 20, 32 << 20, 100_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, n_bytes long, n_records long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record_bytes(page_id: int | None, url: str | None, html: bytes, digest: str, keeper: int | None, date: str) -> bytes:
    """One record, not yet compressed. keeper: the page that a revisit refers to, None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    block = http + html if keeper is None else http
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else None
    head = ["WARC/1.1", f"WARC-Type: {'response' if keeper is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {clean}"] if clean is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest}"]
    head += [] if keeper is None else [f"WARC-Refers-To: <urn:page:{keeper}>", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compress(record: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def write_warc(pages: DataFrame, folder: str | None = None, min_payload: int = 0, file_bytes: int = 256 << 20, level: int = 4, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write page_id, url, html as archives below folder; the manifest (path, n_bytes, n_records) comes back, committed.

    min_payload: payloads with fewer bytes are never revisits.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    rows = pages.select("page_id", "url", whole_text("html").alias("html")).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    group = rows.filter(F.octet_length("html") >= min_payload).groupBy(F.col("digest").alias("__digest")).agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    group = settle(group.filter("n > 1").drop("n"), "warc-payloads")  # a plain side of the join: AQE can split a hot payload
    rows = rows.join(group, F.col("digest") == F.col("__digest"), "left").select("page_id", "url", "html", "digest", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper")).alias("keeper"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, written, count, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, html, digest, keeper = row
                if out is not None and written >= file_bytes:
                    out.close()
                    done.append((name, written, count))
                    out = None
                if out is None:
                    name, written, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                member = compress(record_bytes(page_id, url, html.encode("utf-8"), base32_sha1(digest), keeper, date), level)
                out.write(member)
                written, count = written + len(member), count + 1
        if out is not None:
            out.close()
            done.append((name, written, count))
        paths = [f"{folder}/{d[0]}" for d in done]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "n_bytes", "n_records"])

    return settle(rows.mapInArrow(run, MANIFEST), "warc-manifest")


class Members:
    """The gzip members of a file that start in [start, end), each decoded whole: (offset, bytes)."""

    def __init__(self, file, size: int, start: int, end: int):
        self.file, self.size, self.start, self.end = file, size, start, end

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at)) if at < self.size else b""

    def is_record(self, at: int) -> bool:
        head = self.read(at, 4096)
        try:
            return head.startswith(MAGIC) and zlib.decompressobj(31).decompress(head, 7) == b"WARC/1."
        except zlib.error:
            return False

    def first(self) -> int | None:
        at = self.start
        while at < self.end:
            block = self.read(at, BLOCK + len(MAGIC) - 1)
            hit = block.find(MAGIC)
            while hit >= 0 and at + hit < self.end:
                if self.is_record(at + hit):
                    return at + hit
                hit = block.find(MAGIC, hit + 1)
            at += BLOCK
        return None

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        at = self.first()
        if at is None:
            return
        pos, data = at, b""
        while at < self.end and at < self.size:
            d, parts = zlib.decompressobj(31), []
            while not d.eof:
                if not data:
                    data = self.read(pos, BLOCK)
                    pos += len(data)
                    if not data:
                        raise ValueError(f"a member that starts at {at} is cut off")
                parts.append(d.decompress(data))
                data = d.unused_data
            yield at, b"".join(parts)
            at = pos - len(data)


def parse(record: bytes) -> tuple:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (None for a revisit)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode("utf-8").split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: None if x is None or ":null>" in x else int(re.search(r"(-?\d+)>$", x)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
        return number(fields["warc-record-id"]), fields.get("warc-target-uri"), "revisit", number(fields.get("warc-refers-to")), length, digest, None
    if base32_sha1(hashlib.sha1(payload).hexdigest()) != digest:
        raise ValueError(f"{fields['warc-record-id']}: the payload doesn't have its digest")
    return number(fields["warc-record-id"]), fields.get("warc-target-uri"), "response", None, len(payload), digest, payload


def read_warc(spark: SparkSession, manifest: DataFrame, split_bytes: int | None = None, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files (see RECORDS; payload left out if not wanted). split_bytes: unless given, four ranges for
    each core, between SPLIT_LEAST and SPLIT_MOST."""
    if split_bytes is None:
        total = manifest.agg(F.sum("n_bytes")).first()[0] or 0
        split_bytes = min(SPLIT_MOST, max(SPLIT_LEAST, total // (4 * spark.sparkContext.defaultParallelism)))
    splits = manifest.filter("n_bytes > 0").select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    schema = RECORDS if payloads else RECORDS.rsplit(",", 1)[0]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 7 if payloads else 6]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, where = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(where) as f:
                    for _, record in Members(f, size, start, min(start + split_bytes, size)):
                        row = parse(record)
                        rows.append(row if payloads else row[:6])
                        held += len(record) if payloads else 200
                        if held >= 4 * BLOCK:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    # a stated number of tasks, which isn't merged again as the tiny rows of a shuffle would be
    n = splits.count()
    return splits.repartition(max(1, min(n, TASKS_MOST))).mapInArrow(run, schema)
