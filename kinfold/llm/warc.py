"""WARC archives: writing with revisits, and a reader that salvages damaged archives.

An archive is a run of bytes: gzip members (one record each) or plain records. Spark keeps
archives as rows (archive_id, content) of a table in the shared folder, so any store that
Spark reaches will do; `read_files` reads ready-made .warc/.warc.gz files the same way.

Defined results: a null html is an empty payload; a null page_id is the lowest of its group;
rows that repeat the largest page_id of a group are all responses; an empty table gives no
archive and no row; columns other than page_id, url and html are ignored. Gaps of archives that
were read are rows beside the records, with the reason; `gaps` selects them. `read_files` holds
a file in one value, so that files must stay under 2 GB (cut larger ones at any byte: the reader
picks up at the next record).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import small, table, written

REVISIT_BYTES = 1000
#: An archive is closed after so many bytes.
ARCHIVE_BYTES = 4 << 20
#: A record's header, and a gzip member's content, may take so many bytes; more is quarantined.
HEADER_BYTES = 1 << 20
MEMBER_BYTES = 1 << 30
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "archive_id string, kind string, start long, length long, reason string, record_type string, record_id string, refers_to_id string, target_uri string, payload_digest string, payload_bytes long"


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, sha1: str, kind: str, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One uncompressed record. A revisit keeps the HTTP head of the full payload and no body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {date}"]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_urn(refers_to)}"]
    head += [f"WARC-Payload-Digest: {digest}", "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(), "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(data: bytes, at: int) -> tuple[dict | None, int, str]:
    """The record at `at`: its fields with its block, where it ends, or why it fails the checks."""
    m = VERSION.match(data, at)
    if not m:
        return None, at, "no version line"
    ends = [(i, n) for i, n in ((data.find(b"\r\n\r\n", at, at + HEADER_BYTES), 4), (data.find(b"\n\n", at, at + HEADER_BYTES), 2)) if i >= 0]
    if not ends:
        return None, at, "unfinished header"
    head, n = min(ends)
    fields = {}
    for line in data[m.end() : head].split(b"\n"):
        k, sep, v = line.strip(b"\r").partition(b":")
        if not sep:
            return None, at, "header line without a colon"
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None, at, "no length or type"
    begin, size = head + n, int(fields["content-length"])
    block = data[begin : begin + size]
    if len(block) < size:
        return None, at, "block cut short"
    if not data.startswith((b"\r\n\r\n", b"\n\n"), begin + size):
        return None, at, "no record end"
    want = fields.get("warc-block-digest", "")
    if want.startswith("sha1:") and base64.b32encode(hashlib.sha1(block).digest()).decode() != want[5:]:
        return None, at, "block digest differs"
    fields["block"] = block
    return fields, begin + size + (4 if data.startswith(b"\r\n", begin + size) else 2), ""


def plain(data: bytes, base: int = 0) -> Iterator[tuple[str, int, int, dict | str]]:
    """('record', start, length, fields) and ('gap', start, length, reason) of plain records."""
    at, bad, why = 0, -1, ""
    while at < len(data):
        fields, end, reason = parse(data, at)
        if fields is not None:
            if bad >= 0:
                yield "gap", base + bad, at - bad, why
                bad = -1
            yield "record", base + at, end - at, fields
            at = end
            continue
        if bad < 0:
            bad, why = at, reason
        m = VERSION.search(data, at + 1)
        at = m.start() if m else len(data)
    if bad >= 0:
        yield "gap", base + bad, len(data) - bad, why


def inflate(view: memoryview, limit: int = MEMBER_BYTES) -> tuple[bytes, int]:
    """The bytes of the gzip member that `view` begins with, and how many it takes there."""
    z, out, size, used = zlib.decompressobj(31), [], 0, 0
    while not z.eof and used < len(view):
        step = view[used : used + (1 << 20 if used else 1 << 16)]
        out.append(z.decompress(step, limit - size + 1))
        size += len(out[-1])
        if size > limit:
            raise zlib.error("member too long")
        used += len(step)
    if not z.eof:
        raise zlib.error("member cut short")
    return b"".join(out), used - len(z.unused_data)


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict | str]]:
    """All records that pass the checks, in order, and the byte gaps between them.

    After a failed check the search goes on one byte later, for the next gzip member that
    inflates whole (its CRC and length hold) and has a record, or the next version line.
    """
    at, bad, why, view = 0, -1, "", memoryview(data)
    while at < len(data):
        reason, end, found, skip = "no member or version line", at, [], 0
        if data.startswith(MAGIC, at):
            try:
                got, used = inflate(view[at:])
            except zlib.error as e:
                reason = str(e)[:80]
            else:
                # a record's place is its member; a gap inside one is named as such
                found = [(kind, at, used, x if kind == "record" else f"in member, {start}+{length}: {x}") for kind, start, length, x in plain(got)]
                if any(kind == "record" for kind, *_ in found):
                    end = at + used
                else:
                    reason, skip = "member without a record", used
        elif data.startswith(b"WARC/1.", at):
            fields, end, reason = parse(data, at)
            found = [("record", at, end - at, fields)]
        if end > at:
            if bad >= 0:
                yield "gap", bad, at - bad, why
                bad = -1
            yield from found
            at = end
            continue
        if bad < 0:
            bad, why = at, reason
        at += max(skip, 1)
        at = min((i for i in (data.find(MAGIC, at), data.find(b"WARC/1.", at)) if i >= 0), default=len(data))
    if bad >= 0:
        yield "gap", bad, len(data) - bad, why


def payload_length(fields: dict) -> int | None:
    """Bytes of the full payload, from the HTTP head that a revisit keeps too."""
    head, sep, body = fields["block"].partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"HTTP/"):
        return len(fields["block"])
    m = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return int(m[1]) if m else len(body)


def payload_of(fields: dict) -> bytes:
    block = fields["block"]
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


def bare_hex(digest: str) -> str | None:
    """sha1:BASE32 as bare lower-case hex."""
    algorithm, _, value = digest.partition(":")
    if algorithm.lower() != "sha1" or len(value) not in (32, 40):
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, sha1, refers_to: the response a page revisits, or null.

    Winners are found on digests alone. Where they are few they go to every task; else whole
    pages are shuffled by digest, a plain equi-join whose hot partitions Spark splits.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    winners = (
        p.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .where("n > 1 AND winner IS NOT NULL")
        .select("sha1", "winner")
    )
    joined = p.join(small(written(winners, "warc-winners")), "sha1", "left")
    revisit = F.col("winner").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("winner")))
    return joined.select("page_id", "url", "html", "sha1", F.when(revisit, F.col("winner")).alias("refers_to"))


def write_archives(pages: DataFrame) -> DataFrame:
    """Archives (archive_id, content) in the shared folder, a gzip member for each page."""

    def pack(batches):
        parts, size = [], 0

        def closed():
            content = b"".join(parts)
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha1(content).hexdigest()]), pa.array([content], pa.binary())], ["archive_id", "content"])

        for b in batches:
            cols = [b.column(n) for n in ("page_id", "url", "html", "sha1", "refers_to")]
            for i in range(b.num_rows):
                page_id, url, html, sha1, refers_to = (c[i].as_py() for c in cols)
                payload = html.encode("utf-8", "surrogatepass")
                kind = "response" if refers_to is None else "revisit"
                parts.append(member(record(page_id, url, payload, sha1, kind, refers_to)))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    parts, size = [], 0
        if parts:
            yield closed()

    return written(with_types(pages).mapInArrow(pack, "archive_id string, content binary"), "warc")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for each record and each quarantined gap of the archives (see RECORDS)."""

    def read(batches):
        for b in batches:
            for archive_id, content in zip(b.column("archive_id"), b.column("content"), strict=True):
                rows, name = [], archive_id.as_py()
                for kind, start, length, x in salvage(content.as_py() or b""):
                    if kind == "gap":
                        rows.append((name, kind, start, length, x, None, None, None, None, None, None))
                        continue
                    digest = bare_hex(x.get("warc-payload-digest", ""))
                    if x["warc-type"] == "response" and digest is not None and hashlib.sha1(payload_of(x)).hexdigest() != digest:
                        rows.append((name, "gap", start, length, "payload digest differs", None, None, None, None, None, None))
                        continue
                    rows.append((name, kind, start, length, None, x["warc-type"], x.get("warc-record-id"), x.get("warc-refers-to"), x.get("warc-target-uri"), digest, payload_length(x)))
                if rows:
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in RECORDS.split(", ")])

    # an archive is some MB: few rows to an Arrow batch keep a worker's memory bounded
    return archives.select("archive_id", "content").mapInArrow(read, RECORDS)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of .warc or .warc.gz files at `path`."""
    files = spark.read.format("binaryFile").load(path)
    return read_archives(files.select(F.col("path").alias("archive_id"), "content"))


def gaps(records: DataFrame) -> DataFrame:
    """The quarantined byte ranges: archive_id, start, length, reason."""
    return records.where("kind = 'gap'").select("archive_id", "start", "length", "reason")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of freshly written archives; a gap in these would be lost pages, and raises."""
    records = written(read_archives(write_archives(table(spark, sf_dir, "pages"))), "warc-records")
    lost = gaps(records).limit(5).collect()
    if lost:
        raise RuntimeError(f"archives could not be read back: {lost}")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to_id").alias("refers_to"))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
w AS (SELECT payload_digest, max(page_id) AS winner FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN winner IS NOT NULL AND (page_id IS NULL OR page_id < winner) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN winner IS NOT NULL AND (page_id IS NULL OR page_id < winner) THEN winner END AS refers_to
FROM d LEFT JOIN w USING (payload_digest)
"""
