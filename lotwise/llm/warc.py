"""Operator 10: WARC archives with segmented records.

A record larger than a segment is written as a first record and continuation records, which
may lie in other files than the first. Reading groups segments by the origin's identifier,
orders them by number, checks that none is missing and that the total length is right, and
then decodes the chunked transfer framing of the HTTP response inside.

Archives have what the format asks of every record. Readers take any: plain or compressed, with
one member for all records or one for each, decompressed a piece at a time; records of other types
are skipped, and a response of another writer has no page_id but its address and payload.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, shared_folder, stored, table

#: Bytes of a block that go into one record; of a chunk in the transfer framing.
SEGMENT, CHUNK = 16_384, 4096
#: Smaller payloads are never revisits.
LEAST = 1000
#: Records of one archive file, so that a file holds 8 MB of blocks at most.
RECORDS = 512

# Fixed value: how a revisit says that its payload is that of another record.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; ``ValueError`` if it is cut off."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2:
            raise ValueError("a chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the two line ends that follow it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def pieces(archive: bytes, size: int = 1 << 20):
    """The archive's bytes, decompressed member by member if it is compressed."""
    if archive[:2] != b"\x1f\x8b":
        yield archive
        return
    at = 0
    while at < len(archive):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(archive):
                raise ValueError("a member is cut off")
            fed = archive[at : at + size]
            yield member.decompress(fed)
            at += len(fed) - len(member.unused_data)
        # Some writers fill up with zeros.
        while at < len(archive) and archive[at] == 0:
            at += 1


def parsed(archive: bytes):
    """(headers, block) of each record, in the order of the archive. Names of headers are in
    lower case."""
    source, held = pieces(archive), bytearray()

    def more() -> bool:
        part = next(source, None)
        if part is not None:
            held.extend(part)
        return part is not None

    while True:
        while held[:2] in (b"", b"\r", b"\r\n"):
            if held[:2] == b"\r\n":
                del held[:2]
            elif not more():
                if held:
                    raise ValueError("a record is cut off")
                return
        looked = 0
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not more():
                raise ValueError("a record is cut off")
        lines = held[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record where {lines[0][:40]!r} stands")
        headers: dict[str, str] = {}
        name = ""
        for line in lines[1:]:
            if line[:1] in (" ", "\t") and name:
                headers[name] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
        size = int(headers["content-length"])
        while len(held) < end + 4 + size:
            if not more():
                raise ValueError("a record is cut off")
        yield headers, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size]


def payload_of(block: bytes) -> bytes:
    """What an HTTP response carries, without its transfer framing."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return b""
    framed = any(line.lower().replace(b" ", b"").startswith(b"transfer-encoding:") and b"chunked" in line.lower() for line in head.split(b"\r\n"))
    return unchunked(body) if framed else body


def matches(payload: bytes, digest: str) -> bool:
    """Whether the payload has the digest that a record gives, if that is a SHA-1."""
    kind, _, value = digest.partition(":")
    if kind.lower() != "sha1":
        return True
    own = hashlib.sha1(payload)
    return value.lower() == own.hexdigest() or value.upper() == base64.b32encode(own.digest()).decode()


def judged(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages with ``digest`` (SHA-1 of the html in UTF-8; null: empty) and ``refers_to``: of
    equal payloads of at least ``least`` bytes, all but those of the largest page_id refer
    to it. A page without id keeps its own payload. ``record`` identifies the rows' records,
    repeated ones too, and ``refers_record`` and ``refers_url`` are those of the page referred to."""
    # Extra columns stay behind here.
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    # The same on a repeated task: places of rows in the given files.
    unique = F.md5(F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "digest", F.monotonically_increasing_id()))
    rows = rows.withColumn("record", F.regexp_replace(unique, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))
    large = F.octet_length("html") >= least
    # Partly aggregated before the shuffle; only payloads that occur more than once remain.
    shared = rows.filter(large).groupBy("digest").agg(F.max(F.struct("page_id", "record", "url")).alias("_last"), F.count("*").alias("_n"))
    shared = shared.filter("_n > 1").select(F.col("digest").alias("_digest"), "_last", F.col("_last.page_id").alias("_keeper"))
    # A payload that many pages share is a skewed key: the adaptive planner splits it.
    joined = rows.join(shared, large & (F.col("digest") == F.col("_digest")), "left")
    other = F.col("page_id") != F.col("_keeper")
    return joined.select(
        "page_id", "url", "html", "digest", "record", F.when(other, F.col("_keeper")).alias("refers_to"),
        F.when(other, F.col("_last.record")).alias("refers_record"), F.when(other, F.col("_last.url")).alias("refers_url"),
    )


def written(
    pages: DataFrame, folder: str, least: int = LEAST, segment: int = SEGMENT, per_file: int = RECORDS, at: dt.datetime | None = None,
) -> None:
    """Write the pages as gzip archives into ``folder``. ``at`` (UTC) is the records' date; if
    not given, now."""
    date = f"{at or dt.datetime.now(dt.timezone.utc):%Y-%m-%dT%H:%M:%SZ}"

    def name(page_id) -> str:
        return f"<urn:page:{'' if page_id is None else page_id}>"

    def address(url) -> str:
        return quote(url or "", safe=":/?#[]@!$&'()*+,;=%")

    def records(row: dict):
        page = [("WARC-Date", date), ("WARC-Page", name(row["page_id"])), ("WARC-Target-URI", address(row["url"]))]
        own, digest = f"<urn:uuid:{row['record']}>", ("WARC-Payload-Digest", f"sha1:{row['digest']}")
        kind = ("Content-Type", "application/http; msgtype=response")
        if row["refers_to"] is not None:
            refers = [
                ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{row['refers_record']}>"),
                ("WARC-Refers-To-Target-URI", address(row["refers_url"])), ("WARC-Refers-To-Date", date), ("WARC-Refers-To-Page", name(row["refers_to"])),
            ]
            yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *page, digest, *refers, kind], _HEAD)
            return
        block = _HEAD + chunked(row["html"].encode())
        first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *page, digest, kind]
        if len(block) <= segment:
            yield record(first, block)
            return
        yield record([*first, ("WARC-Segment-Number", 1)], block[:segment])
        for number, start in enumerate(range(segment, len(block), segment), 2):
            headers = [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *page,
                ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number),
            ]
            if start + segment >= len(block):
                headers.append(("WARC-Segment-Total-Length", len(block)))
            yield record(headers, block[start : start + segment])

    def batches(rows):
        for batch in rows:
            for at in range(0, batch.num_rows, 64):
                found = [r for row in batch.slice(at, 64).to_pylist() for r in records(row)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    made = judged(pages, least).mapInArrow(batches, "record binary").select(F.col("record").cast("string"))
    made.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(folder)


def read(spark: SparkSession, folder: str, with_payload: bool = False, strict: bool = True) -> DataFrame:
    """A row per response or revisit of the archives: page_id, payload_bytes, payload_digest
    (SHA-1 in hex), record_type, refers_to, uri (and payload). A missing segment, a wrong total
    length, a broken chunk or a wrong digest fails the read. A revisit's payload is that of the
    response it refers to; if the archives lack that, the read fails, or with ``strict`` off the
    revisit has no payload. Records of other types are skipped. A response or revisit
    without ``WARC-Page`` is of another writer and has null page ids."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    kinds = {
        "origin": pa.string(), "number": pa.int32(), "total": pa.int64(), "block": pa.binary(), "record": pa.string(), "refers_record": pa.string(),
        "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
        "uri": pa.string(), "payload": pa.binary(),
    }
    said = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    schema = ", ".join(f"{n} {said[k]}" for n, k in kinds.items())

    def page(text: str | None) -> int | None:
        digits = (text or "")[len("<urn:page:") : -1]
        return int(digits) if digits else None

    def opened(row: dict, block: bytes, digest: str) -> dict:
        payload = payload_of(block)
        if not matches(payload, digest):
            raise ValueError(f"payload digest of {row['record']} is not {digest}")
        row |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}
        return row | {"payload": payload} if with_payload else row

    def table_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in kinds.items()], list(kinds))

    def segments(rows):
        for batch in rows:
            for archive in batch.column(0):
                found, held = [], 0
                for headers, block in parsed(archive.as_py()):
                    kind, digest = headers.get("warc-type"), headers.get("warc-payload-digest", "")
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    row = {"page_id": page(headers.get("warc-page")), "record_type": kind, "uri": headers.get("warc-target-uri"), "record": headers["warc-record-id"]}
                    if "warc-segment-number" in headers:
                        row |= {
                            "origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]),
                            "number": int(headers["warc-segment-number"]),
                            "total": int(headers.get("warc-segment-total-length", -1)),
                            "block": block, "payload_digest": digest,
                        }
                    elif kind == "response":
                        row = opened(row, block, digest)
                    else:
                        value = digest.partition(":")[2]
                        own = value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex() if len(value) == 32 else None
                        row |= {"refers_to": page(headers.get("warc-refers-to-page")), "refers_record": headers.get("warc-refers-to"), "payload_digest": own}
                    found.append(row)
                    held += len(block)
                    if held > 4_000_000:
                        yield table_of(found)
                        found, held = [], 0
                yield table_of(found)

    def reassembled(rows):
        for batch in rows:
            for at in range(batch.num_rows):
                parts = sorted(batch.column(0)[at].as_py(), key=lambda p: p["number"])
                block = b"".join(p["block"] for p in parts)
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block):
                    raise ValueError(f"segments of page {parts[0]['page_id']} are not complete")
                row = {n: parts[0][n] for n in ("page_id", "uri", "record")} | {"record_type": "response"}
                yield table_of([opened(row, block, parts[0]["payload_digest"] or "")])

    found = stored(files.mapInArrow(segments, schema), "records")
    # A group is one record, so no larger than a page.
    part = F.struct("number", "total", "block", "page_id", "uri", "record", "payload_digest")
    parts = found.filter("origin IS NOT NULL").groupBy("origin").agg(F.collect_list(part).alias("parts"))
    whole = parts.select("parts").mapInArrow(reassembled, schema)
    columns = ["record", "refers_record", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", *(["payload"] if with_payload else [])]
    complete = stored(found.filter("origin IS NULL").select(columns).unionByName(whole.select(columns)), "responses")
    revisits, responses = complete.filter("record_type = 'revisit'"), complete.filter("record_type = 'response'")
    # One response a record: what very many revisits refer to is a skewed key, which the adaptive planner splits.
    kept = {"payload_bytes": "_bytes", "payload_digest": "_digest"} | ({"payload": "_payload"} if with_payload else {})
    known = responses.select(F.col("record").alias("refers_record"), *(F.col(c).alias(n) for c, n in kept.items()))
    joined = revisits.join(known, "refers_record", "left")
    if strict:
        lost = F.concat(F.lit("no response for revisit "), "record")
        joined = joined.withColumn("_bytes", F.when(F.col("_digest").isNull(), F.raise_error(lost)).otherwise(F.col("_bytes")))
    filled = {"payload_bytes": F.col("_bytes"), "payload_digest": F.coalesce("_digest", "payload_digest")} | ({"payload": F.col("_payload")} if with_payload else {})
    return responses.select(columns[2:]).unionByName(joined.select(*(filled.get(c, F.col(c)).alias(c) for c in columns[2:])))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as archives and read back."""
    folder = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    written(table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


by_value(__name__)
