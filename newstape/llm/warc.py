"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

The writer gives equal payloads one ``response`` record and turns the others into
``revisit`` records that refer to it.  A task writes files of bounded size under names
of its own; only files of tasks that succeeded are in the manifest, so a repeated task
leaves an unlisted file at worst.  The reader inflates a file chunk by chunk, frames
records by their content length and verifies both digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import fresh, rows, stage, text_of

#: bytes after which a task begins another file
FILE_BYTES = 256 << 20
CHUNK = 1 << 18
DATE = "2026-01-01T00:00:00Z"
RECORD_ID = "urn:page:"
NO_PAGE = "none"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, n_records long, n_bytes long"
READ = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
        "valid boolean, payload binary")


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value: line breaks and other controls percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(kind: str, headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One WARC/1.1 record as a gzip member of its own."""
    fields = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", "sha1:" + digest(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response, or a revisit: that keeps the HTTP headers, whose Content-Length is that of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    named = lambda n: f"<{RECORD_ID}{NO_PAGE if n is None else n}>"
    headers = [
        ("WARC-Record-ID", named(page_id)), ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _line(url)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", named(refers_to))]
    return record("revisit" if revisit else "response", headers, http if revisit else http + payload)


def with_roles(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``body``, ``keeper``, ``revisit`` per row.

    Of rows with equal payloads of at least ``min_bytes``, those with the largest id are
    responses, the others revisit it.  NULL payloads are empty; a NULL id is below all
    others, and rows that repeat the largest id are all responses.
    """
    body = text_of(body_col).cast("binary")
    plain = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("body"),
        F.sha1(body).alias("digest"),
    )
    # only payloads that stand on several pages have another keeper; written apart from the join that uses
    # them, so Spark may split a payload that very many pages share
    keepers = plain.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    keepers = stage(keepers.where("n > 1").select("digest", "keeper", F.lit(True).alias("again")), "keepers")
    found = plain.join(keepers, "digest", "left")
    keeper = F.when(F.col("again"), F.col("keeper")).otherwise(F.col("page_id"))
    first = F.col("page_id").eqNullSafe(keeper) | (F.octet_length("body") < min_bytes)
    return found.select("page_id", "url", "body", keeper.alias("keeper"), (~first).alias("revisit"))


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, **options) -> DataFrame:
    """Write every page as a record below ``folder``, a store that all tasks reach; returns the manifest of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, count, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return rows(path=[path], n_records=pa.array([count], pa.int64()), n_bytes=pa.array([size], pa.int64()))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "body", "keeper", "revisit")]
            for page_id, url, body, keeper, revisit in zip(*columns):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    path, count = f"{folder}/{name}", 0
                    out = store.open_output_stream(f"{root}/{name}")
                    info = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                               ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                member = page_record(page_id, url, body, keeper, revisit)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return stage(with_roles(pages, **options).mapInArrow(run, MANIFEST), "manifest")


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes = field(repr=False, default=b"")

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    def page(self, name: str) -> int | None:
        value = self.headers.get(name, "").strip("<>")
        value = value.removeprefix(RECORD_ID) if value.startswith(RECORD_ID) else NO_PAGE
        return None if value == NO_PAGE else int(value)


def records(stream) -> Iterator[Record]:
    """Records of an archive in order, inflated member by member from chunks of the file.

    A truncated file, a member that holds no record or more than its content length, or
    bytes that are no member raise ``ValueError``.
    """
    waiting = b""
    while True:
        waiting = waiting or stream.read(CHUNK)
        if not waiting:
            return
        unpacker = zlib.decompressobj(31)
        parts: list[bytes] = []
        head: bytes | None = None
        need, have = 0, 0
        while not unpacker.eof:
            if not waiting:
                waiting = stream.read(CHUNK)
                if not waiting:
                    raise ValueError("the archive ends inside a record")
            try:
                part = unpacker.decompress(waiting)
            except zlib.error as error:
                raise ValueError(f"no gzip member: {error}") from error
            waiting = unpacker.unused_data
            parts.append(part)
            have += len(part)
            if head is None:
                joined = b"".join(parts)
                end = joined.find(b"\r\n\r\n")
                if end >= 0:
                    head, parts, have = joined[:end], [joined[end + 4 :]], len(joined) - end - 4
                    version, *lines = head.decode().split("\r\n")
                    if not version.startswith("WARC/"):
                        raise ValueError("no WARC record")
                    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                    need = int(headers["content-length"]) + 4
                else:
                    parts = [joined]
        if head is None or have != need:
            raise ValueError("a record is not as long as it says")
        body = b"".join(parts)
        if body[-4:] != b"\r\n\r\n":
            raise ValueError("a record does not end as it should")
        yield Record(headers, body[:-4])


def _parsed(found: Record, with_payload: bool) -> tuple:
    """A page record's row; ``valid`` says whether both digests hold (a revisit has no payload to check)."""
    http, _, payload = found.block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}
    named = found.headers.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = found.kind == "revisit"
    size = int(fields.get("content-length", len(payload)))
    valid = found.headers.get("warc-block-digest", "").removeprefix("sha1:") == digest(found.block)
    valid = valid and (revisit or (digest(payload) == named and size == len(payload)))
    return (
        found.page("warc-record-id"), found.headers.get("warc-target-uri"), found.kind, named, size,
        found.page("warc-refers-to") if revisit else None, valid, payload if with_payload and not revisit else None,
    )


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per response or revisit record of the files in ``manifest`` (path): see ``READ``.

    A task reads a file from beginning to end and passes rows on as it goes; other record types are skipped.
    """
    names = [c.split()[0] for c in READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = pafs.FileSystem.from_uri(path)
                held: list[tuple] = []
                size = 0
                with store.open_input_stream(name, buffer_size=CHUNK) as stream:
                    for found in records(stream):
                        if found.kind not in ("response", "revisit"):
                            continue
                        held.append(_parsed(found, with_payload))
                        size += len(held[-1][-1] or b"")
                        if len(held) >= 2000 or size > 8 << 20:
                            yield rows(**{n: pa.array(c, t) for n, t, c in zip(names, types, zip(*held))})
                            held, size = [], 0
                if held:
                    yield rows(**{n: pa.array(c, t) for n, t, c in zip(names, types, zip(*held))})

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(run, READ)


def archive_folder(pages: DataFrame) -> str:
    return fresh(pages.sparkSession, "warc")
