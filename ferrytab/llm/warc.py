"""WARC archives of Zstandard frames: writer and reader.

An archive starts with a skippable frame that holds the dictionary; then every record is a frame of
its own. A page whose payload came before is written as a revisit record without payload. Archives
are rows (``archive``, ``content``) of bounded size, so that Spark's writers and any store that Spark
reaches carry them; ``content`` is the exact file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Magic numbers of the skippable frame that holds a dictionary, of a plain frame, and of a dictionary. Fixed values.
SKIPPABLE, FRAME, DICTIONARY = b"\x5d\x2a\x4d\x18", b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Rows and bytes of payload the dictionary is trained on: a bounded sample, as the dictionary changes only the size.
SAMPLE_ROWS, SAMPLE_BYTES = 512, 2_000_000

#: Payload bytes after which a task starts the next archive.
ARCHIVE_BYTES = 8_000_000

#: Bytes of an archive handed to the decoder at once.
STEP = 65_536

RECORDS = (
    "archive string, offset long, page_id long, url string, record_type string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to long"
)


def payload(html: Column) -> Column:
    """The html's UTF-8 bytes; null has none."""
    return F.coalesce(html.cast("binary"), F.lit(b""))


def train_dictionary(pages: DataFrame, size: int = 32_768) -> bytes:
    """A dictionary from the ``SAMPLE_ROWS`` pages that come first by a hash; empty if they are too few to train on."""
    import zstandard

    # Ids alone are ordered, so that a task sends the driver a few kilobytes; at most SAMPLE_ROWS of them are broadcast.
    some = pages.where("length(html) > 0 and page_id is not null").select("page_id")
    chosen = some.orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_ROWS).distinct()
    head = F.expr(f"substring(html, 1, {SAMPLE_BYTES // SAMPLE_ROWS})")
    heads = pages.where("length(html) > 0").join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min(head).alias("head"))
    rows = sorted(heads.collect())
    samples = [row["head"].encode() for row in rows]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``sha1`` (hex), ``size``, and ``first``: the smallest page_id with the same payload.

    ``first`` is null for payloads under ``min_bytes``. The smallest id per digest is a partial
    aggregate, so equal pages cost one row per task; in the join Spark may split them.
    """
    data = pages.select("page_id", "url", "html").withColumns(
        {"sha1": F.sha1(payload(F.col("html"))), "size": F.octet_length(payload(F.col("html"))).cast("long")}
    )
    slim = pages.select("page_id", F.sha1(payload(F.col("html"))).alias("sha1"))
    firsts = slim.groupBy("sha1").agg(F.min("page_id").alias("first"))
    return data.join(firsts, "sha1").withColumn("first", F.when(F.col("size") >= min_bytes, F.col("first")))


def base32_of(digest_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(digest_hex)).decode()


def record_bytes(page_id, url, body: bytes, sha1: str, size: int, first, date: str) -> bytes:
    """One WARC record. Without ``first`` or with the page's own id it is a response, else a revisit."""
    revisit = first is not None and first != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + body
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32_of(sha1)}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    head += [f"WARC-Target-URI: {uri}"] * (url is not None)
    head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"] * revisit
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, dictionary: bytes, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z"):
    """Archives (``archive``, ``content``) of ``pages`` (page_id, url, html).

    Every row becomes a record. Of rows with equal payloads of at least ``min_bytes`` bytes the one
    with the smallest page_id is the response and the others revisit it; rows that repeat this
    page_id are responses too, as is a row whose group has no id at all. Null html is the empty payload.
    """
    marked = mark_revisits(pages, min_bytes)
    sent = marked.select(
        "page_id", "url", "sha1", "size", "first",
        F.when(F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first")), payload(F.col("html"))).alias("body"),
    )

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=True)
        lead = SKIPPABLE + struct.pack("<I", len(dictionary)) + dictionary
        part, parts, size, made = TaskContext.get().partitionId(), [lead], 0, 0

        def archive():
            name = f"pages-{part:06d}-{made:06d}.warc.zst"
            return pa.RecordBatch.from_pydict({"archive": [name], "content": [b"".join(parts)]})

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "body", "sha1", "size", "first")]
            for i in range(batch.num_rows):
                page, url, body, sha1, n, first = (c[i].as_py() for c in columns)
                parts.append(squeeze.compress(record_bytes(page, url, body or b"", sha1, n, first, date)))
                size += len(body or b"") + 512
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    parts, size, made = [lead], 0, made + 1
        if len(parts) > 1:
            yield archive()

    return sent.mapInArrow(pack, "archive string, content binary")


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of every record of one archive.

    Skippable frames may stand anywhere; the first one, before all records, holds the dictionary,
    plain or itself compressed. Each record must be exactly one frame of its announced size.
    """
    import zstandard

    if content[:4] != SKIPPABLE:
        raise ValueError("the archive does not start with a dictionary frame")
    (size,) = struct.unpack_from("<I", content, 4)
    dictionary, at = content[8 : 8 + size], 8 + size
    if len(dictionary) != size:
        raise ValueError("the dictionary frame is cut short")
    if dictionary[:4] == FRAME:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    if dictionary and dictionary[:4] != DICTIONARY:
        raise ValueError("the leading frame holds no dictionary")
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    expand = zstandard.ZstdDecompressor(dict_data=known)
    view = memoryview(content)
    while at < len(content):
        magic = content[at : at + 4]
        if magic != FRAME and magic[1:] == SKIPPABLE[1:] and 0x50 <= magic[0] <= 0x5F:
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            continue
        if magic != FRAME:
            raise ValueError(f"no frame at {at}")
        one, pieces, end = expand.decompressobj(), [], at
        while not one.eof:
            if end >= len(content):
                raise ValueError(f"the frame at {at} is cut short")
            pieces.append(one.decompress(view[end : end + STEP]))
            end = min(end + STEP, len(content))
        data = b"".join(pieces)
        announced = zstandard.get_frame_parameters(content[at : at + 18]).content_size
        if announced not in (len(data), zstandard.CONTENTSIZE_UNKNOWN):
            raise ValueError(f"the frame at {at} has another length than announced")
        yield at, data
        at = end - len(one.unused_data)


def parse_record(data: bytes) -> dict:
    """Fields of a record; raises ``ValueError`` where a header, length or digest does not hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    named = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line!r}")
        named[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - named.keys()
    if missing:
        raise ValueError(f"headers missing: {sorted(missing)}")
    length = int(named["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block has another length than its header says")
    block = rest[:length]
    http, _, body = block.partition(b"\r\n\r\n")
    sizes = [int(x[15:]) for x in http.decode("latin-1").lower().split("\r\n") if x.startswith("content-length:")]
    if "warc-block-digest" in named and named["warc-block-digest"] != _digest(block):
        raise ValueError("the block's digest does not hold")
    kind, payload_digest = named["warc-type"], named.get("warc-payload-digest", "")
    if kind == "response" and (sizes[:1] not in ([], [len(body)]) or payload_digest not in ("", _digest(body))):
        raise ValueError("the payload's length or digest does not hold")
    return {
        "page_id": _page(named["warc-record-id"]),
        "url": named.get("warc-target-uri"),
        "record_type": kind,
        "payload": body if kind == "response" else None,
        "payload_bytes": len(body) if kind == "response" else (sizes or [None])[0],
        "payload_digest": payload_digest.removeprefix("sha1:"),
        "refers_to": _page(named["warc-refers-to"]) if "warc-refers-to" in named else None,
    }


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of archives (``archive`` or ``path``, ``content``), with their offsets.

    Takes the rows of :func:`write_archives` as well as those of ``spark.read.format("binaryFile")``.
    A broken archive fails the read; nothing is skipped.
    """
    name = "archive" if "archive" in archives.columns else "path"

    def unpack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in RECORDS.split(", "))])
        for batch in batches:
            for i in range(batch.num_rows):
                found, size = [], 0
                title, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for at, data in frames(content):
                    fields = parse_record(data)
                    size += len(fields["payload"] or b"")
                    if not with_payload:
                        fields["payload"] = None
                    found.append({"archive": title, "offset": at, **fields})
                    if size > ARCHIVE_BYTES // 2:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema)

    return archives.select(name, "content").mapInArrow(unpack, RECORDS)

