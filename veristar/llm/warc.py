"""WARC archives: a writer that revisits equal payloads and a reader that salvages.

Writing. Records are rows of a text table whose line separator is the blank line that
ends a WARC record, so Spark's own committed output makes the files and a lost
executor costs a task, not an archive. Of records with equal payloads of at least
``MIN_REVISIT`` bytes, that of the smallest page is the response, the others are
revisits without a payload. The choice is made on digests alone; a payload is shuffled
once, by page, never by its digest, so a payload that a third of all pages share is no
hot group. Archives hold about ``ARCHIVE_BYTES`` each.

They are packed with gzip, a member a record, so that a broken byte loses one record. A member is text to Spark's writer: all
but its last byte, a zero, which is the line separator.

Reading. An archive (plain, or gzip members one after another) is checked record by
record: version line, header, length, block digest, closing blank line. What stands at each place decides how it is
read: a version line opens a plain record, gzip magic bytes a member. After a failed check the reader goes on at the next
sound record, be it plain at the start of a line or in a valid member, and logs the bytes between
as quarantined: path, offset, length, reason. A member without a sound record, such as a packed body of a broken
response, is no place to go on. Offsets are those of the file for plain
records and of the unpacked member otherwise (member start in ``member_offset``).

Defined results: a null html is an empty payload; a null page id counts as larger than all;
rows that repeat a page id and a payload are equal records (all responses, or all
revisits); an empty table gives an empty result; further columns stay out.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veristar.session import shared_dir

from .common import slices

MIN_REVISIT = 100
ARCHIVE_BYTES = 16 << 20
CRLF = "\r\n"
BLANK = CRLF * 2

RECORDS = ("path string, member_offset long, offset long, kind string, page string, refers_to string, "
           "payload_bytes long, payload_digest string, payload binary, gap_length long, reason string")
_SCHEMA = pa.schema([
    ("path", pa.string()), ("member_offset", pa.int64()), ("offset", pa.int64()), ("kind", pa.string()),
    ("page", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("gap_length", pa.int64()), ("reason", pa.string()),
])


def with_record_types(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                      min_bytes: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """page_id, page (id as text), payload (string), payload_bytes, payload_digest, refers_to (null: a response)."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    base = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).alias("page"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))
    narrow = base.filter(F.col("payload_bytes") >= min_bytes).select("page_id", "page", "payload_digest")
    firsts = (
        narrow.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null")
    )
    # Only digests and ids meet here; a hot digest is a skewed join of narrow rows.
    revisits = (
        narrow.join(firsts.select("payload_digest", "refers_to"), "payload_digest")
        .filter(F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to")))
        .select("page", "payload_digest", "refers_to").distinct()
    )
    # Dealt by page and payload: even, the same again if a task is repeated, and as the archives are written.
    total = base.agg(F.sum("payload_bytes")).first()[0] or 0
    files = max(1, -(-total // archive_bytes))
    return base.repartition(files, "page", "payload_digest").join(revisits, ["page", "payload_digest"], "left")


def record_text(rows: DataFrame) -> DataFrame:
    """One string a record, without the blank line that ends it."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    page = F.col("page")
    header = F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: urn:page:"), page),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.sha2(block, 256)),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(header, F.lit(BLANK), block).alias("value"))


def packed(record: bytes) -> bytes:
    """A gzip member that ends with a zero byte."""
    member = gzip.compress(record, 6, mtime=0)
    # It ends with the highest byte of its length; from 16 MB on an empty member follows.
    return member if member[-1] == 0 else member + gzip.compress(b"", 6, mtime=0)


def write_archives(rows: DataFrame, path: str) -> str:
    """Write what ``with_record_types`` gives, a file for each of its parts. Each record ends with a blank line."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            values = [packed(v.as_py().encode("utf-8", "surrogatepass") + b"\r\n\r\n")[:-1] for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])

    members = record_text(rows).mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    members.write.option("lineSep", "\0").option("compression", "none").text(path)
    return path


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MAGIC = b"\x1f\x8b\x08"


def _record(data: bytes, at: int) -> tuple[dict[str, str] | str, bytes, int]:
    """The record at ``at``: its header, block and end; or the reason why there is none."""
    version = _VERSION.match(data, at)
    if not version:
        return "no version line", b"", at
    close = data.find(b"\r\n\r\n", at)
    if close < 0:
        return "header without an end", b"", at
    header = {}
    for line in data[version.end():close].decode("utf-8", "replace").split(CRLF):
        name, colon, value = line.partition(":")
        if not colon:
            return "bad header line", b"", at
        header[name.strip().lower()] = value.strip()
    if not re.fullmatch("[0-9]{1,15}", header.get("content-length", "")):
        return "no length", b"", at
    start = close + 4
    end = start + int(header["content-length"])
    if end + 4 > len(data):
        return "truncated", b"", at
    if data[end:end + 4] != b"\r\n\r\n":
        return "no blank line after the block", b"", at
    block = data[start:end]
    kind, _, digest = header.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        return "block digest differs", b"", at
    return header, block, end + 4


def _next_version(data: bytes, at: int) -> int:
    """The next version line at the start of a line, or the end."""
    for found in _VERSION.finditer(data, at):
        if found.start() == 0 or data[found.start() - 1:found.start()] == b"\n":
            return found.start()
    return len(data)


def salvage_records(data: bytes) -> Iterator[tuple[int, dict[str, str] | str, bytes | int]]:
    """(offset, header, block) of each sound record, (offset, reason, length) of each gap."""
    at = 0
    while at < len(data):
        header, block, end = _record(data, at)
        if isinstance(header, str):
            gap, reason = at, header
            at = _next_version(data, at + 1)
            # A version line inside a payload may open nothing: the gap goes on.
            while at < len(data) and isinstance(_record(data, at)[0], str):
                at = _next_version(data, at + 1)
            yield gap, reason, at - gap
            continue
        yield at, header, block
        at = end


def _member(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What a gzip member at ``at`` unpacks to, and its end; no end if it breaks off or its checksum fails."""
    unpack, out, size = zlib.decompressobj(wbits=31), [], 1 << 16
    view = memoryview(data)
    try:
        for start in range(at, len(data), size):
            out.append(unpack.decompress(view[start:start + size]))
            if unpack.eof:
                return b"".join(out), min(start + size, len(data)) - len(unpack.unused_data)
    except zlib.error:
        pass
    return b"".join(out), None


def _next_sound(data: bytes, at: int) -> int:
    """The next place from ``at`` on with a sound plain record, or a valid member that holds one; or the end."""
    version, magic = _next_version(data, at), data.find(_MAGIC, at)
    while version < len(data) or magic >= 0:
        if magic < 0 or version < magic:
            if not isinstance(_record(data, version)[0], str):
                return version
            version = _next_version(data, version + 1)
        else:
            out, end = _member(data, magic)
            if end is not None and any(isinstance(header, dict) for _, header, _ in salvage_records(out)):
                return magic
            magic = data.find(_MAGIC, magic + 1)
    return len(data)


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | str, bytes | int]]:
    """(member offset, offset, header or reason, block or length of the gap)."""
    at = 0
    while at < len(data):
        if data.startswith(_MAGIC, at):
            out, end = _member(data, at)
            # Records in front of the place where a member breaks have their own digests and count.
            for offset, header, block in salvage_records(out):
                if end is not None or not isinstance(header, str):
                    yield at, offset, header, block
            if end is None:
                gap, at = at, _next_sound(data, at + 1)
                yield gap, 0, "no valid member", at - gap
            else:
                at = end
            continue
        header, block, end = _record(data, at)
        if isinstance(header, str):
            gap, at = at, _next_sound(data, at + 1)
            yield 0, gap, header, at - gap
        else:
            yield 0, at, header, block
            at = end


_URN = re.compile(r"<?urn:page:([^>]*)>?")


def _rows(path: str, data: bytes, payloads: bool) -> Iterator[tuple]:
    def page(urn: str | None) -> str | None:
        found = _URN.fullmatch(urn or "")
        return found[1] if found else urn

    for member, offset, header, block in salvage(data):
        if isinstance(header, str):
            yield path, member, offset, "gap", None, None, None, None, None, block, header
            continue
        kind, digest = header.get("warc-type"), header.get("warc-payload-digest", "").rpartition(":")[2]
        if kind == "response":
            length = len(block)
            digest = hashlib.sha256(block).hexdigest()
        else:
            length = header.get("warc-payload-length", "")
            length = int(length) if length.isdigit() else len(block)
        yield (path, member, offset, kind, page(header.get("warc-target-uri")), page(header.get("warc-refers-to")),
               length, digest, block if payloads else None, None, None)


def read_archives(spark, path: str, payloads: bool = True) -> DataFrame:
    """Sound records and, as kind ``gap``, the quarantined bytes of all archives below ``path``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_py() or b""
                rows, held = [], 0
                for row in _rows(batch.column(0)[i].as_py(), data, payloads):
                    rows.append(row)
                    held += len(row[8] or b"")
                    if len(rows) == 4096 or held > 1 << 23:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=f.type) for column, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def archived_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = write_archives(with_record_types(pages, id_col, html_col), shared_dir(spark, "warc"))
    found = read_archives(spark, path, payloads=False).filter("kind != 'gap'")
    return found.select(
        F.expr("try_cast(page as long)").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("kind").alias("record_type"), F.expr("try_cast(refers_to as long)").alias("refers_to"))
