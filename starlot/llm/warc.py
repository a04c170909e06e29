"""WARC records in seekable Zstandard bundles, with one response for equal payloads.

A payload's digest is its SHA-1. Of the records that share a payload of ``least_bytes`` or more, the one
with the smallest id holds it (response) and the others refer to that one (revisit). Only ids and
digests are shuffled for this, minima are combined before the shuffle, and the join that brings a
large group's ids back to its rows is a plain one that adaptive execution splits.

A bundle is a file of independent Zstandard frames, each of records of about ``frame_bytes``, and a last
skippable frame with the seek table of the Zstandard seekable format: sizes of each frame before and
after decompression. Any Zstandard reader gives the whole archive; one record is read by its frame
alone. Each task writes its bundles itself, through the file system of the shared folder, under
names no other attempt uses, and returns one row a record: bundle, frame, offset in the frame and
length. That index is a Spark table, so only records of tasks that ended well are in it, and a
task that runs again leaves at most a file that no row names.

Defined cases: a null payload is empty; a null URL is left out of the record; a row without
an id is a response of its own; rows that repeat the smallest id of a payload are all responses; an
empty table writes no bundle; other columns are ignored.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.session import materialise, shared_folder

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 128 * 1024 * 1024
LEAST_BYTES = 0
LEVEL = 3

# Fixed values of the formats: magic numbers of skippable frames and of the seek table's end, record types' profile.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = "page_id bigint, record_type string, bundle string, frame bigint, frame_start bigint, frame_bytes bigint, offset bigint, length bigint"


def digest(payload: Column) -> Column:
    """SHA-1 as upper-case hexadecimal; records carry it in base32."""
    return F.upper(F.sha1(payload))


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has no block; its digest is that of the whole payload."""
    block = payload if refers_to is None else b""
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32(sha1)}", f"WARC-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of the record that ``data`` holds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[:int(fields["Content-Length"])]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle, from (compressed, whole) sizes."""
    entries = b"".join(struct.pack("<II", a, b) for a, b in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(stream, size: int) -> list[tuple[int, int, int]]:
    """``(start, compressed, whole)`` of each frame of an open bundle."""
    stream.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    stream.seek(size - 9 - 8 * count)
    sizes = list(struct.iter_unpack("<II", stream.read(8 * count)))
    out, at = [], 0
    for compressed, whole in sizes:
        out.append((at, compressed, whole))
        at += compressed
    return out


def store(folder: str):
    """File system and path of a folder that driver and executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class Bundle:
    """Writes one bundle; records of a frame are compressed together once they are large enough."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        import zstandard

        self.files, base = store(folder)
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.out = self.files.open_output_stream(f"{base}/{self.name}", compression=None)
        self.coder, self.frame_bytes = zstandard.ZstdCompressor(level=level), frame_bytes
        self.frames, self.at, self.open, self.waiting, self.rows, self.size = [], 0, [], [], [], 0

    def add(self, page_id, record_type: str, data: bytes) -> None:
        self.waiting.append((page_id, record_type, self.size, len(data)))
        self.open.append(data)
        self.size += len(data)
        if self.size >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.open:
            return
        packed = self.coder.compress(b"".join(self.open))
        self.out.write(packed)
        self.rows += [(p, t, self.name, len(self.frames), self.at, len(packed), o, n) for p, t, o, n in self.waiting]
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.open, self.waiting, self.size = [], [], 0

    def close(self) -> list[tuple]:
        self.end_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return self.rows


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, level: int):
    names = [c.split()[0] for c in INDEX.split(", ")]

    def run(batches):
        bundle = None
        for batch in batches:
            ids = [p if known else None for p, known in zip(batch["page_id"], batch["has_id"])]
            rows = zip(ids, batch["url"], batch["payload"], batch["sha1"], batch["refers_to"], batch["revisit"])
            for page_id, url, payload, sha1, refers_to, revisit in rows:
                bundle = bundle or Bundle(folder, frame_bytes, level)
                data = record(page_id, url, bytes(payload), sha1, int(refers_to) if revisit else None)
                bundle.add(page_id, "revisit" if revisit else "response", data)
                if bundle.at >= bundle_bytes:
                    yield pd.DataFrame(bundle.close(), columns=names)
                    bundle = None
        if bundle:
            yield pd.DataFrame(bundle.close(), columns=names)
    return run


def with_responses(pages: DataFrame, page_id: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """``(page_id, has_id, url, payload, sha1, refers_to, revisit)`` for every row."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    read = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"), digest(body).alias("sha1"))
    same = read.where(F.octet_length("payload") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Only payloads that stand more than once travel back; a page alone in its group is its own response.
    again = same.where("n > 1").select(F.col("sha1").alias("s"), "first")
    found = read.join(again, F.col("sha1") == F.col("s"), "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first"), F.lit(False))
    return found.select(
        F.coalesce("page_id", F.lit(0)).alias("page_id"), F.col("page_id").isNotNull().alias("has_id"), "url", "payload", "sha1",
        F.coalesce("first", F.lit(0)).alias("refers_to"), revisit.alias("revisit"),
    )


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = LEAST_BYTES, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL,
) -> DataFrame:
    """Writes the bundles below ``folder`` and returns their index, itself written to ``folder``/index."""
    files, base = store(folder)
    files.create_dir(f"{base}/bundles")
    rows = with_responses(pages, page_id, url, payload, least_bytes)
    return materialise(rows.mapInPandas(_writer(f"{folder}/bundles", frame_bytes, bundle_bytes, level), INDEX), f"{folder}/index")


def _id(urn: str) -> int | None:
    page = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if page == "none" else int(page)


def _reader(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        import zstandard

        files, base = store(folder)
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for name, rows in batch.groupby("bundle", sort=False):
                with files.open_input_file(f"{base}/{name}") as stream:
                    table = read_seek_table(stream, stream.size())
                    for frame, members in rows.groupby("frame", sort=True):
                        start, packed, whole = table[frame]
                        stream.seek(start)
                        data = plain.decompress(stream.read(packed), max_output_size=whole)
                        for offset, length in zip(members["offset"], members["length"]):
                            fields, block = read_record(data[offset:offset + length])
                            revisit = fields["WARC-Type"] == "revisit"
                            own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            if not revisit and base64.b32encode(hashlib.sha1(block).digest()).decode() != own:
                                raise ValueError(f"a payload in {name} does not have its digest")
                            out.append((
                                _id(fields["WARC-Record-ID"]), int(fields["WARC-Payload-Length"]), own, fields["WARC-Type"],
                                _id(fields["WARC-Refers-To"]) if revisit else 0, revisit, block,
                            ))
            yield pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "revisit", "block"])
    return run


def read_archives(spark, folder: str) -> DataFrame:
    """Every record of the index, read from its frame: header values and ``block`` (empty for revisits)."""
    index = spark.read.parquet(f"{folder}/index")
    # A frame's records are neighbours in the index; bundles are read side by side, a frame once.
    asked = index.select("bundle", "frame", "offset", "length").repartition("bundle", F.expr("frame div 64")).sortWithinPartitions("bundle", "frame", "offset")
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, revisit boolean, block binary"
    read = asked.mapInPandas(_reader(f"{folder}/bundles"), schema)
    return read.withColumn("refers_to", F.when(F.col("revisit"), F.col("refers_to"))).drop("revisit")


def op7_warc_bundles(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, upper(sha1(b)) AS h FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d),
bits AS (
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0x' || substr(h, 1 + 5 * (k // 4), 5))::BIGINT AS INTEGER) // (32 ** (3 - k % 4))::INTEGER % 32, 1), '' ORDER BY k) AS b32
  FROM m, range(32) AS r(k) GROUP BY page_id
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM m JOIN bits USING (page_id)
"""
