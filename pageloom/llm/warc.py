"""WARC archives: a writer that turns repeated payloads into revisits, and a salvage reader.

Writing and reading go through Spark's own sources, so any store that Spark reaches will do. Archives are
plain or gzip members; the reader checks every record, and after a failed check looks for the next valid
member or version line, goes on from there, and logs the bytes it had to leave out.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the archive format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
DATE = "2020-01-01T00:00:00Z"

#: Payloads from this size on are stored once.
LEAST = 100
#: An archive ends before it passes this many bytes; rows are given on after this many bytes of payload.
ARCHIVE, BATCH = 32 << 20, 8 << 20
#: Bytes beyond twice the stated length in which the end of a failed record is looked for.
LOOK = 1 << 12


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``(id, url, payload, payload_bytes, payload_digest, refers_to)``.

    Of rows with equal payloads of at least 100 bytes those with the smallest id keep them; the others get
    that id in ``refers_to``. A null payload is empty. Rows with a null id refer to the smallest id of their
    equals, if any has one."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    large = rows.where(F.col("payload_bytes") >= LEAST)
    firsts = large.groupBy("payload_digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    told = rows.join(firsts, "payload_digest", "left")
    later = (F.col("payload_bytes") >= LEAST) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return told.select("id", "url", "payload", "payload_bytes", "payload_digest", F.when(later, F.col("first")).alias("refers_to"))


def _header(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def record_text(rows: DataFrame) -> DataFrame:
    """``(record)``: each row as one record, without the two line ends that close it."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    head = F.concat(
        F.lit(VERSION + "\r\n"), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", urn(F.col("id"))), _header("WARC-Date", F.lit(DATE)), _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        F.when(revisit, F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", urn(F.col("refers_to"))))).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(head, http, body).alias("record"))


def zip_archives(most_bytes: int, most_records: int):
    """Tasks that turn records into archives: a gzip member per record, members joined to one value per archive.

    Spark's text writer ends each value with a separator, here one zero byte. A gzip member ends with the high
    byte of its length, zero below 16 MB; so that byte is left to the separator. A longer member is followed by
    an empty one, which ends the same way. The members do not depend on the run, so a repeated task writes
    the same bytes."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for record in batch.column(0):
                member = zlib.compress(b"".join((record.as_buffer(), END.encode())), wbits=31)
                if held and (size + len(member) > most_bytes or len(held) >= most_records):
                    yield _archive(held)
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield _archive(held)

    return archives


def _archive(members: list[bytes]) -> pa.RecordBatch:
    data = b"".join(members)
    if data[-1]:
        data += zlib.compress(b"", wbits=31)
    return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["archive"])


def write_warc(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE, records_per_file: int = 100_000) -> None:
    """Gzip archives under ``path``, a member per record.

    An archive ends before it passes ``archive_bytes`` bytes or ``records_per_file`` records; a longer record
    gets an archive of its own, and none crosses archives. Repeated rows are records of their own, columns
    beside those of ``with_revisits`` are not written, and an empty table gives no archive with content."""
    zipped = record_text(rows).select(F.col("record").cast("binary").alias("record")).mapInArrow(
        zip_archives(archive_bytes, records_per_file), "archive binary")
    options = {"lineSep": "\0", "maxRecordsPerFile": "1", "compression": "none"}
    zipped.select(F.col("archive").cast("string").alias("archive")).write.options(**options).text(path)


@dataclass
class Salvage:
    """What one archive gave: records, and the byte ranges left out with the reason."""

    records: list[dict] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


def _fields(data: bytes, at: int) -> tuple[dict, int]:
    """The header fields of the record at ``at`` and the place of its block; ValueError with the failed check."""
    if not VERSION_LINE.match(data, at):
        raise ValueError("no version line")
    head_end = data.find(END.encode(), at)
    if head_end < 0:
        raise ValueError("header without end")
    if VERSION_LINE.search(data, at + 1, head_end + 2):
        raise ValueError("version line inside a header")
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields, head_end + 4


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record that begins at ``at`` and the place after it; ValueError with the failed check."""
    fields, start = _fields(data, at)
    if not fields.get("content-length", "").isdecimal():
        raise ValueError("no content length")
    end = start + int(fields["content-length"])
    if data[end : end + 4] != END.encode():
        raise ValueError("length does not meet the record's end")
    block = data[start:end]
    http = b""
    if fields.get("content-type", "").startswith("application/http"):
        http, found, block = block.partition(END.encode())
        if not found:
            raise ValueError("http header without end")
    stated = fields.get("warc-payload-digest", "")
    kind = fields.get("warc-type", "")
    digest = hashlib.sha256(block).hexdigest()
    if kind != "revisit" and stated.startswith("sha256:") and stated[7:] != digest:
        raise ValueError("payload digest differs")
    size = len(block)
    if kind == "revisit":
        digest = stated.removeprefix("sha256:")
        length = re.search(rb"(?im)^content-length: *(\d+)\r?$", http)
        size = int(length[1]) if length else 0
    return {"type": kind, "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
            "payload": block, "payload_bytes": size, "payload_digest": digest}, end + 4


def _starts(data: bytes, at: int) -> bool:
    return at == len(data) or VERSION_LINE.match(data, at) is not None


def _proven_end(data: bytes, at: int) -> int | None:
    """Where the record at ``at``, which failed a check, surely ends: after its stated length, if a record or
    nothing follows there, or where the bytes before a version line have its stated digest. The latter is looked
    for within twice the lengths that its headers state, so that many failures cost no more than their bytes."""
    try:
        fields, start = _fields(data, at)
    except ValueError:
        return None
    most = 0
    if fields.get("content-length", "").isdecimal():
        most = int(fields["content-length"])
        if data[start + most : start + most + 4] == END.encode() and _starts(data, start + most + 4):
            return start + most + 4
    stated = fields.get("warc-payload-digest", "")
    if not stated.startswith("sha256:") or fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").startswith("application/http"):
        block, start = start, data.find(END.encode(), start) + 4
        if start < 4:
            return None
        length = re.search(rb"(?im)^content-length: *(\d+)\r?$", data[block:start])
        most = max(most, int(length[1]) if length else 0)
    seen, hashed = hashlib.sha256(), start
    last = min(len(data), start + 2 * most + LOOK)
    ends = [m.start() for m in VERSION_LINE.finditer(data, start, last)]
    for after in [*ends, len(data)] if last == len(data) else ends:
        if after - 4 >= hashed and data[after - 4 : after] == END.encode():
            seen.update(data[hashed : after - 4])
            hashed = after - 4
            if seen.hexdigest() == stated[7:]:
                return after
    return None


def _plain_steps(data: bytes) -> Iterator[dict | tuple[int, int, str]]:
    """Records, with ``offset``, ``end`` and ``in_gap``, and gaps of an archive that is not compressed.

    After a failed check the reader goes on where the failed record surely ends, else at the next version
    line. What it finds there may lie in the payload of the failed record. Then the rest of that payload
    follows, and neither a version line, a record's header fields nor the archive's end; records up to there
    are ``in_gap``."""
    at, loose = 0, None
    while at < len(data):
        try:
            record, after = _parse(data, at)
        except ValueError as e:
            if loose:
                rest = data[at : max(data.find(END.encode(), at + 4), at)]
                inside = not (VERSION_LINE.match(data, at) or b"\r\nWARC-Type:" in rest)
                yield from (r | {"in_gap": inside} for r in loose)
            sure = _proven_end(data, at)
            later = VERSION_LINE.search(data, at + 1)
            later = sure or (later.start() if later else len(data))
            loose = None if sure else []
            yield (at, later, str(e))
            at = later
        else:
            record |= {"offset": at, "end": after, "in_gap": False}
            if loose is None:
                yield record
            else:
                loose.append(record)
            at = after
    yield from loose or ()


def _unzipped(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` gives, the place after it, and the failed check, if any."""
    unzip, out = zlib.decompressobj(31), []
    step, at, before = 1 << 16, at, None
    while at < len(data):
        if step > 1:
            before = unzip.copy()
        try:
            out.append(unzip.decompress(data[at : at + step]))
        except zlib.error as e:
            if step == 1:
                return b"".join(out), len(data), f"bad gzip member: {e}"
            unzip, step = before, 1  # byte by byte up to the fault
            continue
        at = min(at + step, len(data))
        if unzip.eof:
            return b"".join(out), at - len(unzip.unused_data), ""
    return b"".join(out), len(data), "bad gzip member: cut off"


def _zipped_place(data: bytes, at: int, size: int) -> int:
    """The place in the archive by which the member at ``at`` has given its first ``size`` bytes."""
    if not size:
        return at
    unzip, step = zlib.decompressobj(31), 1 << 16
    while size > 0:
        size -= len(unzip.decompress(data[at : at + step], size))
        at = min(at + step, len(data)) - len(unzip.unconsumed_tail) - len(unzip.unused_data)
    return at


def _member_steps(data: bytes) -> Iterator[dict | tuple[int, int, str]]:
    """The same for gzip members with one record or many. What a bad member gave before its fault is used; the
    search goes on at the next member header. Gaps are what lies between members, and of a member the bytes
    that gave no record."""
    at = 0
    while at < len(data):
        found = data.find(GZIP, at)
        if found != at:
            found = len(data) if found < 0 else found
            yield (at, found, "no gzip header")
            at = found
            continue
        text, end, fault = _unzipped(data, at)
        if fault:
            later = data.find(GZIP, at + 1)
            end = len(data) if later < 0 else later
        used = 0
        for step in _plain_steps(text):
            if isinstance(step, dict):
                used = max(used, step["end"])
                yield step | {"offset": at}
            elif not fault:
                yield (_zipped_place(data, at, step[0]), end if step[1] == len(text) else _zipped_place(data, at, step[1]), step[2])
        if fault:
            yield (_zipped_place(data, at, used), end, fault)
        at = end


def salvage_steps(data: bytes) -> Iterator[dict | tuple[int, int, str]]:
    """Records and gaps of one archive as they are met; gaps that touch come as one."""
    zipped = data[:3] == GZIP or (GZIP in data and not VERSION_LINE.search(data))
    gap = None
    for step in _member_steps(data) if zipped else _plain_steps(data):
        if isinstance(step, dict):
            yield step
        elif gap and gap[1] == step[0]:
            gap = (gap[0], step[1], gap[2])
        elif step[0] < step[1]:
            if gap:
                yield gap
            gap = step
    if gap:
        yield gap


def salvage(data: bytes) -> Salvage:
    """All valid records of one archive, and its quarantined gaps in bytes of the archive."""
    out = Salvage()
    for step in salvage_steps(data):
        (out.records if isinstance(step, dict) else out.gaps).append(step)
    return out


READ = "archive string, kind string, in_gap boolean, offset long, gap_end long, reason string, record_id string, url string, refers_to string, payload binary, payload_bytes long, payload_digest string"


def read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in READ.split(", ")])
    for batch in batches:
        for i in range(len(batch)):
            path = batch.column(0)[i].as_py()
            rows, size = [], 0
            for step in salvage_steps(batch.column(1)[i].as_py()):
                if isinstance(step, dict):
                    row = {"kind": step["type"]} | step
                    size += len(step["payload"])
                else:
                    row = dict(zip(("kind", "in_gap", "offset", "gap_end", "reason"), ("gap", False, *step)))
                rows.append({n: row.get(n) for n in schema.names} | {"archive": path})
                if len(rows) >= 500 or size >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path`` and, as rows of kind ``gap``, the bytes left out.

    ``in_gap`` marks records that seem to lie in the payload of a record that failed. One task holds one archive
    at a time and gives its records on as it meets them, so archives are to be written in bounded files.
    Empty archives give no rows; records that repeat come as often as they are there."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    return files.select("path", "content").mapInArrow(read_archives, READ)


def page_records(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of the records of ``write_warc``, without
    those found in gaps."""
    number = lambda c: F.expr(f"try_cast(nullif(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1), '') as bigint)")
    return records.where("kind <> 'gap' and not in_gap").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), number("refers_to").alias("refers_to"))
