"""Web archives of Zstandard frames: writer and reader.

An archive starts with a skippable frame that holds the compression dictionary. Each record follows in a frame of
its own, so a reader may start at any record and needs no more memory than the largest record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.workspace import Workspace, numbered

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", VERSION)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"

DICTIONARY_PAGES = 400
DICTIONARY_BYTES = 32_768
READ_BYTES = 1 << 20

RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, archive string"
)
_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("archive", pa.string()),
    ]
)


class ArchiveError(ValueError):
    """An archive that breaks its format."""


def opened(path: str):
    """File system and path for a folder as Spark names it."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on the samples; their raw content where there are too few to train on; may be empty."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _tools(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def archive_head(raw: bytes) -> bytes:
    """The skippable frame with the dictionary, itself compressed."""
    body = zstandard.ZstdCompressor().compress(raw) if raw else b""
    return struct.pack("<II", DICTIONARY_FRAME, len(body)) + body


def record_id(page_id: int | None, row_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{row_id}')}>"


def _line(value: str) -> str:
    """A header value on one line."""
    return quote(value, safe="".join(map(chr, range(33, 127))) + " ") if not value.isprintable() else value


def record(row: dict, payload: bytes) -> bytes:
    """One record. A revisit keeps the response's headers, and so the payload's length, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"], row["row_id"])),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", _line(row["url"] or "about:blank")),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
    ]
    if row["page_id"] is not None:
        head.append(("X-Page-ID", str(row["page_id"])))
    if row["url"] is None:
        head.append(("X-No-URL", "true"))
    if revisit:
        head += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(row["refers_to"], row["refers_row"])),
        ]
        if row["refers_to"] is not None:
            head.append(("X-Refers-To-Page-ID", str(row["refers_to"])))
    head.append(("Content-Length", str(len(block))))
    text = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + text + b"\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes], where: str) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space goes on with the field before it."""
    fields: dict[str, str] = {}
    name = ""
    for line in lines:
        text = line.decode(errors="replace")
        if name and text[:1] in (" ", "\t"):
            fields[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise ArchiveError(f"{where}: header {line!r}")
        # A URL keeps its spaces, so that what was written comes back.
        fields[name] = value.removeprefix(" ") if name == "warc-target-uri" else value.strip()
    return fields


def _digest_of(value: str, data: bytes) -> str | None:
    """The announced digest of the kind of ``value`` made from ``data``, written as there; None for kinds not known."""
    kind, _, text = value.partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return None
    made = hashlib.new(kind.lower(), data)
    written = made.hexdigest() if len(text) == 2 * made.digest_size else base64.b32encode(made.digest()).decode()
    return f"{kind}:{written}"


def _checked(fields: dict[str, str], name: str, data: bytes, where: str) -> None:
    if name in fields:
        made = _digest_of(fields[name], data)
        if made is not None and made.lower() != fields[name].lower():
            raise ArchiveError(f"{where}: {name}")


def _sha1_hex(value: str) -> str | None:
    """The lower-case hex SHA-1 an announced digest stands for, if it is one."""
    kind, _, text = value.partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()
    except ValueError:
        raise ArchiveError(f"digest {value!r}") from None


def parsed(data: bytes, where: str = "") -> dict:
    """The record in one frame, of any type and of version 1.0 or 1.1, with headers, lengths and digests validated.

    Of a response the payload is what follows the HTTP header, of other types the block; a revisit has none, and its
    length and digest are those announced for the full payload, null where they are not.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in VERSIONS:
        raise ArchiveError(f"{where}: not a record")
    fields = _headers(lines[1:], where)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ArchiveError(f"{where}: no {name}")
    if not re.fullmatch("[0-9]+", fields["content-length"]):
        raise ArchiveError(f"{where}: content-length {fields['content-length']!r}")
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: block of {len(rest) - 4} bytes, {length} announced")
    _checked(fields, "warc-block-digest", block, where)
    kind = fields["warc-type"].lower()
    payload, announced = block, None
    if kind in ("response", "revisit") and fields.get("content-type", "").lower().startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        sizes = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
        # A revisit may leave out the headers altogether.
        if (not gap and (kind == "response" or block)) or len(sizes) > 1:
            raise ArchiveError(f"{where}: HTTP header")
        if sizes:
            if not sizes[0].strip().isdigit():
                raise ArchiveError(f"{where}: HTTP content-length")
            announced = int(sizes[0])
    elif kind == "revisit":
        payload = b""
    if kind == "revisit":
        if payload:
            raise ArchiveError(f"{where}: a revisit with a payload")
        size, digest = announced, _sha1_hex(fields.get("warc-payload-digest", ""))
    else:
        if announced is not None and announced != len(payload) and "warc-truncated" not in fields:
            raise ArchiveError(f"{where}: payload")
        _checked(fields, "warc-payload-digest", payload, where)
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("x-page-id"),
        "url": None if "x-no-url" in fields else fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number("x-refers-to-page-id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if kind == "revisit" else payload,
    }


def records(stream, where: str = "") -> Iterator[dict]:
    """All records of an archive, one frame decoded at a time."""
    data = stream.read(8)
    if len(data) < 8 or struct.unpack("<II", data)[0] != DICTIONARY_FRAME:
        raise ArchiveError(f"{where}: no dictionary frame")
    size = struct.unpack("<II", data)[1]
    body = stream.read(size)
    if len(body) != size:
        raise ArchiveError(f"{where}: dictionary cut short")
    known = _tools(zstandard.ZstdDecompressor().decompress(body) if body[:4] == b"\x28\xb5\x2f\xfd" else body)
    maker = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    pending = b""
    while True:
        if not pending:
            pending = stream.read(READ_BYTES)
            if not pending:
                return
        frame, out = maker.decompressobj(), io.BytesIO()
        while True:
            out.write(frame.decompress(pending))
            if frame.eof:
                pending = frame.unused_data
                break
            pending = stream.read(READ_BYTES)
            if not pending:
                raise ArchiveError(f"{where}: frame cut short")
        yield parsed(out.getvalue(), where)


def _writer(folder: str, raw: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        known = _tools(raw)
        press = zstandard.ZstdCompressor(level=3, dict_data=known) if known else zstandard.ZstdCompressor(level=3)
        name, out, count = None, None, 0
        for batch in batches:
            if batch.num_rows and out is None:
                system, root = opened(folder)
                name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.zst"
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}", compression=None)
                out.write(archive_head(raw))
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode()
                out.write(press.compress(record(row, payload)))
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([count], pa.int64())})

    return write


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, expected in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist()):
                system, root = opened(folder)
                held, size, count = [], 0, 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for row in records(stream, name):
                        held.append(row | {"archive": name})
                        size += len(row["payload"] or b"")
                        count += 1
                        if size > 8 << 20 or len(held) >= 5000:
                            yield pa.RecordBatch.from_pylist(held, schema=_RECORD_ARROW)
                            held, size = [], 0
                if expected is not None and count != expected:
                    raise ArchiveError(f"{name}: {count} records, {expected} written")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_RECORD_ARROW)

    return read


def decided(pages: DataFrame, workspace: Workspace, least_bytes: int = 1000) -> DataFrame:
    """Pages with digest and length of the payload, the record type and the page a revisit refers to.

    Among equal payloads of at least ``least_bytes`` the largest page_id is the response (a null id is smallest; one
    of several equal ids is taken); all shorter payloads are responses. The comparison is an aggregate per digest,
    reduced before the shuffle; only digests met more than once are joined back.
    """
    html = F.coalesce("html", F.lit(""))
    rows = workspace.keep(
        numbered(pages.select("page_id", "url", "html"))
        .withColumn("payload_bytes", F.octet_length(html).cast("long"))
        .withColumn("payload_digest", F.sha1(html)),
        "pages",
    )
    groups = workspace.keep(
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.max(F.struct("page_id", "row_id")).alias("best"))
        .where("copies > 1")
        .select("payload_digest", F.col("best.page_id").alias("refers_to"), F.col("best.row_id").alias("refers_row")),
        "groups",
    )
    revisit = F.col("refers_row").isNotNull() & (F.col("refers_row") != F.col("row_id"))
    return (
        rows.join(groups, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("refers_to")))
        .withColumn("refers_row", F.when(revisit, F.col("refers_row")))
    )


def write_archives(pages: DataFrame, workspace: Workspace, name: str = "archives") -> DataFrame:
    """Write a record for each page, an archive for each partition; the result lists archives and record counts.

    Archives are named by task attempt and listed by the attempts that ended well, so what a lost
    executor left half written is never read. Null html is an empty payload, a null url is marked as such, an empty
    table gives no archive. Extra columns are ignored.
    """
    rows = decided(pages, workspace)
    # A hash thins the rows out first, so that the tasks together hand over a few times DICTIONARY_PAGES rows at most.
    share = min(1.0, 4 * DICTIONARY_PAGES / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64("row_id"), F.lit(10**9)) < int(10**9 * share)).where(F.length("html") > 0)
    sample = [
        r.html.encode()
        for r in drawn.orderBy(F.xxhash64("row_id"))
        .select(F.substring("html", 1, 16_384).alias("html"))
        .limit(DICTIONARY_PAGES)
        .collect()
    ]
    folder = workspace.folder(name)
    columns = [
        "row_id", "page_id", "url", "html", "payload_digest", "record_type", "refers_to", "refers_row"
    ]
    written = rows.select(*columns).mapInArrow(_writer(folder, dictionary(sample)), "archive string, records long")
    return workspace.keep(written, f"{name}-list")


def read_archives(listing: DataFrame, folder: str) -> DataFrame:
    """All records of the listed archives (``archive`` and, where known, ``records``), validated while read.

    An archive is read by one task as a stream, and archives are dealt to as many tasks. A broken header, length, digest or frame fails the job with
    ``ArchiveError``. Of a revisit the payload is null; its length and digest are those of the full payload.
    """
    tasks = max(1, listing.count())
    return listing.repartition(tasks, "archive").mapInArrow(_reader(folder), RECORD)
