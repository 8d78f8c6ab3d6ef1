"""WARC archives of Zstandard frames: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.common import lookup, pieces
from donorloom.session import durable, new_folder

DICTIONARY = 0x184D2A5D  # magic of the skippable frame that holds the dictionary
ARCHIVE_BYTES = 64 << 20  # payload bytes after which a task begins another archive
REVISIT_FROM = 100  # payloads of fewer bytes are never revisits
SAMPLES, SAMPLE_CHARS, DICTIONARY_BYTES = 512, 8192, 32768  # bounds of what the dictionary is trained on
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages carry no time
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
READ = 1 << 14


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def train(pages: DataFrame) -> bytes:
    """A dictionary from at most SAMPLES beginnings of payloads; empty where they are too few or too small."""
    text = F.substring(F.col("html").cast("string"), 1, SAMPLE_CHARS)
    rows = pages.select(text.alias("t"), F.xxhash64("page_id").alias("h")).filter(F.length("t") > 0)
    # Keys first, so that only the chosen texts come to the driver.
    last = rows.select("h").orderBy("h").limit(SAMPLES).agg(F.max("h")).first()[0]
    samples = [r["t"].encode() for r in rows.filter(F.col("h") <= F.lit(last)).limit(SAMPLES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def _id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the page with the equal one."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id(page)), ("WARC-Date", DATE),
            ("WARC-Target-URI", _clean(url or "")), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http;msgtype=response")]
    block = HTTP + payload
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))]
        block = HTTP
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; a ValueError names what does not hold."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] != "WARC/1.1":
        raise ValueError("no WARC/1.1 header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header line {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header {name} is missing")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, Content-Length says {n}")
    block = rest[:n]
    if fields["warc-type"] == "revisit":
        if "warc-refers-to" not in fields or fields.get("warc-profile") != PROFILE:
            raise ValueError("a revisit without its reference or profile")
        return fields, b""
    if fields["warc-type"] != "response":
        raise ValueError(f"unknown type {fields['warc-type']}")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields.get("warc-payload-digest") != f"sha256:{hashlib.sha256(payload).hexdigest()}" or fields.get("warc-payload-length") != str(len(payload)):
        raise ValueError("the payload is not what its digest and length say")
    return fields, payload


def frames(stream) -> Iterator[bytes]:
    """Decoded frames of an archive, one at a time; the leading skippable frame gives the dictionary."""
    data = stream.read(8)
    if len(data) < 8:
        if data:
            raise ValueError("truncated archive")
        return
    magic, size = struct.unpack("<II", data)
    held = None
    if magic == DICTIONARY:
        content = stream.read(size)
        if len(content) != size:
            raise ValueError("truncated dictionary")
        held, data = zstandard.ZstdCompressionDict(content), b""
    reader = zstandard.ZstdDecompressor(dict_data=held) if held else zstandard.ZstdDecompressor()
    while True:
        data = data or stream.read(READ)
        if not data:
            return
        frame, out = reader.decompressobj(), []
        while True:
            try:
                out.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise ValueError(f"not a frame: {e}") from e
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(READ)
            if not data:
                raise ValueError("truncated frame")
        yield b"".join(out)


def decide(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """``pages(page_id, url, html)`` as (page_id, url, html, digest, refers_to)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    rows = rows.withColumn("same", F.when(F.octet_length("html") >= revisit_from, F.col("digest")))
    first = rows.filter("same is not null").groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    found = lookup(rows, durable(first), ["same"], "n")
    return found.select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, dictionary: bytes | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives into ``folder``, which all machines share: (path, records) of each.

    Of pages with equal payloads of at least 100 bytes that with the smallest
    page_id is a response and the others revisit it. Pages that repeat the
    smallest id are responses too, and so are all where none has an id. A task
    writes its pages to files of its own name and reports them when they are
    whole, so what a lost task leaves behind is named nowhere.
    """
    held = train(pages) if dictionary is None else dictionary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        system.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True, **({"dict_data": zstandard.ZstdCompressionDict(held)} if held else {}))
        out, name, done, size = None, "", 0, 0

        def finish():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([done], pa.int64())], ["path", "records"])

        for batch in pieces(batches, 2):
            for page, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, done, size = f"pages-{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(f"{root}/{name}")
                    if held:
                        out.write(struct.pack("<II", DICTIONARY, len(held)) + held)
                payload = html.encode()
                out.write(packer.compress(record(page, url, payload, digest, refers_to)))
                done, size = done + 1, size + len(payload)
                if size >= ARCHIVE_BYTES:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    return durable(decide(pages).mapInArrow(write, "path string, records long"))


RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``archives(path, records)``; see ``RECORD``. A malformed record or a wrong number of them is an
    error. payload is null for revisits, and everywhere without ``payloads``."""
    number = re.compile(r"<urn:page:(?:none|(-?\d+))>")

    def page(text: str) -> int | None:
        m = number.fullmatch(text)
        if not m:
            raise ValueError(f"unknown record id {text[:80]}")
        return None if m.group(1) is None else int(m.group(1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [part.split()[0] for part in RECORD.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

        for whole in batches:
            for path, records in zip(whole.column(0).to_pylist(), whole.column(1).to_pylist()):
                system, place = _place(path)
                rows, size, seen = [], 0, 0
                with system.open_input_stream(place) as stream:
                    for raw in frames(stream):
                        fields, payload = parse(raw)
                        revisit = fields["warc-type"] == "revisit"
                        rows.append((page(fields["warc-record-id"]), fields.get("warc-target-uri"),
                                     payload if payloads and not revisit else None, int(fields["warc-payload-length"]),
                                     fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"],
                                     page(fields["warc-refers-to"]) if revisit else None))
                        seen, size = seen + 1, size + len(payload)
                        if size > (4 << 20) or len(rows) >= 4096:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)
                if seen != records:
                    raise ValueError(f"{path} has {seen} records, not {records}")

    return archives.select("path", "records").mapInArrow(read, RECORD)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """``pages`` written to archives and read back: one row per page, with the columns of ``RECORD`` but url and payload.

    Null html is an empty payload, null urls are empty, repeated rows are
    records of their own, an empty table gives no archive and no row. Columns
    besides page_id, url and html are not looked at.
    """
    back = read_archives(write_archives(pages, folder or new_folder(pages.sparkSession, "warc")), payloads=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
