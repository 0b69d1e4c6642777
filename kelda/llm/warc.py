"""WARC archives in seekable Zstandard bundles (operator 10).

Records are grouped into frames of about ``FRAME_BYTES``, each compressed on its own; a bundle ends
with a seek table in a skippable frame (compressed and plain size of every frame), so a reader
needs the table and one frame to get at a record. The index has, for every record, its bundle,
frame and place in the frame.

Of pages with equal payloads of ``REVISIT_BYTES`` or more, the one with the largest id is the
response and the others are revisits of it, without payload. Null payloads are empty. Pages
with a null id are responses of their own and are never referred to. Of repeated rows with the
largest id, each is a response. An empty table makes no bundle and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelda.llm.files import TaskFiles, folder_of, one_task_a_file, read_range
from kelda.llm.tables import stored
from kelda.sources.scratch import scratch_path

REVISIT_BYTES = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 128 << 20
#: Fixed values of the seekable format: skippable frame, and the seek table's own mark.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has the HTTP head alone; it tells the payload's size."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at a place of a frame: page_id, url, type, payload, digest.., and where it ends."""
    head_end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:head_end].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin, size = head_end + 4, int(fields["Content-Length"])
    block = raw[begin : begin + size]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(re.search(rb"Content-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    number = lambda name: int(n) if (n := fields[name][len("<urn:page:") : -1]) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload": None if revisit else payload,
        "payload_bytes": told if revisit else len(payload),
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"][len("sha1:") :]).hex()
        if revisit
        else hashlib.sha1(payload).hexdigest(),
        "refers_to": number("WARC-Refers-To") if revisit else None,
    }, begin + size + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frame_sizes(folder: str, name: str) -> list[tuple[int, int]]:
    """Compressed and plain size of each frame, from the end of the bundle."""
    system, path = folder_of(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        total = file.size()
        file.seek(total - 9)
        count, _, mark = struct.unpack("<IBI", file.read(9))
        if mark != SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        file.seek(total - 9 - 8 * count)
        raw = file.read(8 * count)
    return [struct.unpack_from("<II", raw, 8 * i) for i in range(count)]


def read_frame(folder: str, name: str, frame: int, sizes: list[tuple[int, int]] | None = None) -> bytes:
    sizes = sizes or frame_sizes(folder, name)
    start = sum(s for s, _ in sizes[:frame])
    raw = read_range(folder, name, start, sizes[frame][0])
    return zstandard.ZstdDecompressor().decompress(raw, max_output_size=sizes[frame][1])


def read_record(folder: str, name: str, frame: int, offset: int) -> dict:
    """One record by its entry of the index: reads the seek table and its frame alone."""
    return parse(read_frame(folder, name, frame), offset)[0]


def revisits(pages: DataFrame, id_col: str, html_col: str, least: int = REVISIT_BYTES) -> DataFrame:
    """The pages as (id, payload, size, sha1, refers_to), refers_to null for responses."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    told = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        *([F.col("url").cast("string").alias("url")] if "url" in pages.columns else [F.lit(None).cast("string").alias("url")]),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("size"),
        F.sha1(payload).alias("sha1"),
    )
    copies = (
        told.where((F.col("size") >= least) & F.col("id").isNotNull())
        .groupBy("sha1")
        .agg(F.max("id").alias("largest"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select("sha1", "largest")
    )
    joined = told.join(stored(copies, "equal-payloads"), "sha1", "left")
    other = F.when(F.col("size") >= least, F.when(F.col("id") != F.col("largest"), F.col("largest")))
    return joined.select("id", "url", "payload", "size", "sha1", other.alias("refers_to"))


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    html_col: str = "html",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
) -> DataFrame:
    """Write all pages; returns the index (page_id, file, frame, offset, size), a row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, compress = TaskFiles(folder, ".warc.zst"), zstandard.ZstdCompressor(level=level).compress
        frame: list[bytes] = []
        done: list[bytes] = []
        sizes: list[tuple[int, int]] = []
        places: list[tuple] = []
        filled = total = 0

        def close_frame() -> None:
            nonlocal filled
            plain = b"".join(frame)
            done.append(compress(plain))
            sizes.append((len(done[-1]), len(plain)))
            frame.clear()
            filled = 0

        def close_bundle() -> pa.RecordBatch:
            nonlocal total
            if frame:
                close_frame()
            name = files.write(*done, seek_table(sizes))
            ids, frames, offsets, lengths = zip(*places)
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([name] * len(ids), pa.string()),
                *(pa.array(x, pa.int64()) for x in (frames, offsets, lengths)),
            ]
            for x in (done, sizes, places):
                x.clear()
            total = 0
            return pa.RecordBatch.from_arrays(columns, names=["page_id", "file", "frame", "offset", "size"])

        for batch in batches:
            for row in batch.to_pylist():
                refers = row["refers_to"]
                raw = record(row["id"], row["url"], row["payload"], row["size"], row["sha1"], refers)
                places.append((row["id"], len(done), filled, len(raw)))
                frame.append(raw)
                filled += len(raw)
                total += len(raw)
                if filled >= frame_bytes:
                    close_frame()
                if total >= bundle_bytes:
                    yield close_bundle()
        if places:
            yield close_bundle()

    rows = revisits(pages, id_col, html_col)
    schema = "page_id bigint, file string, frame bigint, offset bigint, size bigint"
    return stored(rows.mapInArrow(run, schema), "warc-index")


def read_bundles(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the bundles that the index names, read frame by frame through it."""
    listing = index.groupBy("file").agg(F.count("*").alias("records"))
    files = listing.count()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, wanted in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                sizes, found = frame_sizes(folder, name), 0
                for frame in range(len(sizes)):
                    raw, at, rows = read_frame(folder, name, frame, sizes), 0, []
                    while at < len(raw):
                        row, at = parse(raw, at)
                        rows.append(row)
                    found += len(rows)
                    columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                if found != wanted:
                    raise ValueError(f"{name} has {found} records instead of {wanted}")

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    spread = one_task_a_file(listing, files)
    return spread.mapInArrow(run, schema + ", payload binary" * with_payload)


def round_trip(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write the bundles to a folder of their own and read every record back."""
    folder = scratch_path(spark, "warc")
    return read_bundles(write_bundles(pages, folder, **options), folder, with_payload=False)


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), g AS (
  SELECT html, max(page_id) AS largest FROM p WHERE payload_bytes >= 1000 GROUP BY html
)
SELECT page_id, payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
"""
