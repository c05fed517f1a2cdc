"""WARC archives in seekable Zstandard: records in independent frames, a record index and a seek table at the end.

A bundle is a sequence of Zstandard frames, so that any decoder turns it into plain WARC:

* data frames, each of whole records, independent of each other;
* one skippable frame with the record index: (record id, frame, offset within the frame, length);
* one skippable frame with the seek table (compressed and plain size of every frame) and its footer.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bounded_batches, filesystem, new_file, spread, stored, write_file

# Fixed values of the seekable Zstandard format and of WARC 1.1.
SKIPPABLE_INDEX = 0x184D2A5D
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 32 << 20
READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "target_uri string, bundle string, frame int, frame_offset long")


class BundleWriter:
    """Collects records, and closes a frame when it holds `frame_bytes` of plain text."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.packer = zstandard.ZstdCompressor(level=level)
        self.frame_bytes, self.open, self.open_bytes = frame_bytes, [], 0
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.packed_bytes = 0

    def add(self, record_id: str, record: bytes) -> None:
        if self.open_bytes and self.open_bytes + len(record) > self.frame_bytes:
            self._close_frame()
        self.index.append((record_id, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)

    def _close_frame(self) -> None:
        plain = b"".join(self.open)
        packed = self.packer.compress(plain)
        self.frames.append(packed)
        self.sizes.append((len(packed), len(plain)))
        self.packed_bytes += len(packed)
        self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        if self.open:
            self._close_frame()
        text = "\n".join(f"{i}\t{f}\t{o}\t{n}" for i, f, o, n in self.index).encode()
        packed = self.packer.compress(text)
        index = struct.pack("<II", SKIPPABLE_INDEX, len(packed)) + packed
        sizes = [*self.sizes, (len(index), 0)]
        table = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_FOOTER)
        return b"".join([*self.frames, index, struct.pack("<II", SKIPPABLE_SEEK, len(table)), table])


class BundleReader:
    """Random access to the frames and records of a bundle; only the parts asked for are read."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        source.seek(0, 2)
        end = source.tell()
        count, _, magic = struct.unpack("<IBI", self._bytes(end - 9, 9))
        if magic != SEEK_FOOTER:
            raise ValueError("not a seekable Zstandard bundle")
        table = self._bytes(end - 9 - 8 * count, 8 * count)
        self.sizes = [struct.unpack_from("<II", table, 8 * i) for i in range(count)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        head = self._bytes(self.starts[count - 1], self.sizes[-1][0])
        text = self.unpacker.decompress(head[8:]).decode()
        self.index = [(r[0], int(r[1]), int(r[2]), int(r[3]))
                      for r in (line.rsplit("\t", 3) for line in text.split("\n") if line)]

    def _bytes(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def frame(self, number: int) -> bytes:
        packed, plain = self.sizes[number]
        return self.unpacker.decompress(self._bytes(self.starts[number], packed), max_output_size=plain)

    def record(self, record_id: str) -> bytes:
        """One record by its id: one frame is read."""
        _, number, offset, length = next(r for r in self.index if r[0] == record_id)
        return self.frame(number)[offset:offset + length]

    def records(self) -> Iterator[tuple[str, int, int, bytes]]:
        """(id, frame, offset, record) of all, a frame in memory at a time."""
        at, plain = -1, b""
        for record_id, number, offset, length in self.index:
            if number != at:
                at, plain = number, self.frame(number)
            yield record_id, number, offset, plain[offset:offset + length]


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                date: str) -> bytes:
    """A response with its payload, or (refers_to given) a revisit with the HTTP head only."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:page:without-address"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers and payload facts of one record; a response whose payload does not fit its digest is an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"page_id": page_of(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": page_of(fields.get("WARC-Refers-To")),
            "target_uri": fields["WARC-Target-URI"]}


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES,
               bundle_bytes: int = BUNDLE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write pages (page_id, url, html) as seekable bundles below folder; returns (bundle, n_records).

    Of the pages with equal payloads of at least min_bytes the largest page_id is the response and the others
    are revisits of it. The largest id of a payload is aggregated before its shuffle; the join back to the pages is
    a plain equality join, whose hot payloads adaptive execution splits. A missing html is an empty payload. Rows
    that repeat the largest page_id are all responses, and so is a payload whose pages have no id at all; a page
    without an id can revisit but never be revisited. Other columns of pages are ignored. An empty table gives no
    bundle.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = bounded_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    chosen = rows.groupBy("digest").agg(F.max("page_id").alias("first_id"))
    refers = F.when((F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    marked = rows.join(chosen, "digest").select("page_id", "url", "html", "digest", refers.alias("refers_to"))

    def write(batches):
        import pyarrow as pa

        out, made = BundleWriter(frame_bytes), []

        def close():
            name = new_file(folder, "warc.zst")
            write_file(name, out.finish())
            made.append((name, len(out.index)))

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                bare = base64.b32encode(bytes.fromhex(digest)).decode()
                out.add(record_id(page_id), make_record(page_id, url, html.encode("utf-8", "surrogatepass"), bare, refers_to, date))
                if out.packed_bytes >= bundle_bytes:
                    close()
                    out = BundleWriter(frame_bytes)
        if out.index:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
                                         ["bundle", "n_records"])

    return stored(marked.mapInArrow(write, "bundle string, n_records long"), "warc-bundles")


def read_warc(bundles: DataFrame) -> DataFrame:
    """A row per record of the bundles, read frame by frame; see READ_SCHEMA."""

    def read(batches):
        import pyarrow as pa

        names = [p.split()[0] for p in READ_SCHEMA.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
        types = [kinds[p.split()[1]] for p in READ_SCHEMA.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)

        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                system, path = filesystem(bundle)
                with system.open_input_file(path) as source:
                    rows = []
                    for _, frame, offset, record in BundleReader(source).records():
                        rows.append(parse_record(record) | {"bundle": bundle, "frame": frame, "frame_offset": offset})
                        if len(rows) == 5000:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    return spread(bundles.select("bundle"), "bundle").mapInArrow(read, READ_SCHEMA)


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages as bundles in the shared folder and return what the bundles hold."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, min_bytes))
