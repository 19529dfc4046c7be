"""WARC archives: written with revisits, segments and chunked framing, and read back whole.

A record is a gzip member. A response's HTTP block has its payload in chunked
transfer framing; a block of more than segment_bytes goes into a first record and
continuation records. Reading groups segments by their origin's identifier, orders them by segment
number, holds them against the total length and takes the chunked framing off.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh_path, saved
from sluice.llm.mixing import small

MIN_REVISIT, SEGMENT_BYTES, CHUNK_BYTES, READER_BYTES = 100, 32 << 10, 8 << 10, 32 << 20
DATE = "2025-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for i in range(0, len(payload), size) if (c := payload[i : i + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload in chunked framing; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("no chunk size")
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        end = line + 2 + size
        if body[end : end + 2] != b"\r\n":
            raise ValueError("broken chunk")
        parts.append(body[line + 2 : end])
        at = end + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of HTTP headers")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One gzip member; fields that are None are left out."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def records(page: int | None, name: str, url: str | None, payload: bytes, digest: str, refers: tuple[int | None, str] | None, segment_bytes: int) -> Iterator[bytes]:
    """A page's records: a revisit, a response, or a response's first segment and its continuations."""
    uri = None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")
    common = [("WARC-Record-ID", f"<urn:{name}>"), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Page-ID", page)]
    if refers:
        yield record([("WARC-Type", "revisit"), *common, ("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:{refers[1]}>"), ("Refers-To-Page-ID", refers[0])], HTTP)
        return
    block = HTTP + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    kind = [("WARC-Type", "response"), *common, ("Content-Type", "application/http; msgtype=response")]
    if len(parts) == 1:
        yield record(kind, block)
        return
    yield record([*kind, ("WARC-Segment-Number", 1)], parts[0])
    for i, part in enumerate(parts[1:], 2):
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:{name}:{i}>"), ("WARC-Date", DATE), ("WARC-Segment-Number", i), ("WARC-Segment-Origin-ID", f"<urn:{name}>"), ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None)], part)


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT, segment_bytes: int = SEGMENT_BYTES, folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes a record for each row; returns a manifest (file, records, bytes) and the folder.

    A null payload is empty. Of the rows with equal payloads of min_revisit bytes or more
    the one with the least id, then the least URL (nulls after all others) is a response and the others
    revisit it; of rows that are equal in all three one is the response. What a row becomes depends on the table alone, never on the
    order in which a task reads it: responses that others refer to are named by id and payload. Payloads stay where they are read
    while the repeated ones' digests are few enough to be broadcast, beyond that they go through a join by digest. A task writes one file under another name
    and moves it into place, so that a task that runs again replaces its file.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    payload = F.coalesce(F.encode(payload_col, "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= min_revisit
    each = rows.where(large).groupBy("digest", "page", "url").agg(F.count("*").alias("twins"))
    first = F.min(F.struct(F.col("page").isNull().alias("p"), "page", F.col("url").isNull().alias("u"), "url", "twins")).alias("first")
    repeated = each.groupBy("digest").agg(first, F.sum("twins").alias("n")).where("n > 1").select(F.col("digest").alias("of"), F.col("first.page").alias("first_page"), F.col("first.url").alias("first_url"), F.col("first.twins").alias("twins"))
    repeated = saved(repeated, "repeated")
    joined = rows.join(small(repeated), (F.col("digest") == F.col("of")) & large, "left")
    chief = F.col("of").isNotNull() & F.col("page").eqNullSafe(F.col("first_page")) & F.col("url").eqNullSafe(F.col("first_url"))
    revisit = F.col("of").isNotNull() & ~chief
    ready = joined.select("page", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "first_page", chief.alias("chief"), revisit.alias("revisit"), F.when(chief, F.col("twins") - 1).otherwise(0).alias("more"))
    if not repeated.where("twins > 1").isEmpty():  # of equal rows one stands for all
        one = ready.where("more > 0").groupBy("page", "url", "digest", "first_page", "chief", "revisit", "more").agg(F.first("payload").alias("payload"))
        ready = ready.where("more = 0").unionByName(one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name, n, size = f"part-{part:06d}.warc.gz", 0, 0
        attempt = f"{root}/{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(attempt, compression=None) as out:
            for page, url, data, digest, first_page, is_chief, is_revisit, more in (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("page", "url", "payload", "digest", "first_page", "chief", "revisit", "more")), strict=True)):
                to = (first_page, f"page:{first_page}:{digest}")
                for refers in [to if is_revisit else None, *[to] * more]:
                    own = to[1] if is_chief and refers is None else f"page:{page}:{part}:{n}"
                    for x in records(page, own, url, data or b"", digest, refers, segment_bytes):
                        out.write(x)
                        n, size = n + 1, size + len(x)
        fs.move(attempt, f"{root}/{name}")
        yield pa.record_batch([[name], [n], [size]], names=["file", "records", "bytes"])

    return saved(ready.mapInArrow(run, "file string, records long, bytes long"), "manifest"), folder


def members(stream: BinaryIO, read: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, inflated."""
    data, ended = b"", False
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                data = stream.read(read)
                if not data:
                    if parts:
                        raise ValueError("a record is cut off")
                    ended = True
                    break
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
        if ended:
            return
        yield b"".join(parts)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """The fields (names in lower case) and the block of a record; ValueError if its length is wrong."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    if not version.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:n]


FIELDS = "record_id string, page long, type string, digest string, refers_page long, refers_to string, payload_bytes long, payload_digest string, payload binary, status string"
FIELD_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
FIELD_NAMES = [x.split()[0] for x in FIELDS.split(", ")]


def described(fields: dict[str, str], block: bytes | None, keep: bool, status: str = "ok") -> tuple:
    """A row of FIELDS for a whole record."""
    number = lambda k: int(fields[k]) if k in fields else None
    digest, data = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None, None
    if fields["warc-type"] != "revisit" and block is not None:
        try:
            data = payload_of(block)
        except ValueError:
            status = "bad framing"
    own = None if data is None else hashlib.sha256(data).hexdigest()
    if own and digest and own != digest:
        status = "bad digest"
    return fields["warc-record-id"], number("page-id"), fields["warc-type"], digest, number("refers-to-page-id"), fields.get("warc-refers-to"), None if data is None else len(data), own, data if keep else None, status


def reassembled(segments: list[tuple[int, int | None, bytes]]) -> tuple[bytes | None, str]:
    """The block of (number, total length, part) segments in any order, and ok or what is wrong."""
    ranked = sorted(dict((s[0], s) for s in segments).values(), key=lambda s: s[0])
    totals = [s[1] for s in ranked if s[1] is not None]
    if [s[0] for s in ranked] != list(range(1, len(ranked) + 1)) or not totals:
        return None, "missing segment"
    block = b"".join(s[2] for s in ranked)
    return (block, "ok") if len(block) == totals[-1] else (None, "bad length")


def read_archives(manifest: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """A row of FIELDS for each response and revisit in the archives of the manifest.

    digest is what the record says, payload_bytes and payload_digest what its payload has;
    a revisit has none of its own. status is ok, bad framing, bad digest, bad length or missing
    segment. keep_payload: whether the payload comes as well.
    """
    spark = manifest.sparkSession
    cut = "fields map<string,string>, origin string, number long, total long, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [*FIELD_TYPES, pa.map_(pa.string(), pa.string()), pa.string(), pa.int64(), pa.int64(), pa.binary()], strict=True)]
            return pa.record_batch(columns, names=[*FIELD_NAMES, "fields", "origin", "number", "total", "block"])

        for name in (x for b in batches for x in b.column(0).to_pylist()):
            with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for member in members(stream):
                    fields, block = parsed(member)
                    if "warc-segment-number" in fields:
                        total = fields.get("warc-segment-total-length")
                        first = fields["warc-type"] != "continuation"
                        rows.append((*[None] * len(FIELD_NAMES), list(fields.items()) if first else None, fields["warc-record-id"] if first else fields["warc-segment-origin-id"], int(fields["warc-segment-number"]), total and int(total), block))
                    else:
                        rows.append((*described(fields, block, keep_payload), None, None, None, None, None))
                    held += len(block)
                    if len(rows) >= 2048 or held > 16 << 20:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    readers = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // READER_BYTES))
    files = manifest.where("records > 0").select("file").repartition(readers)
    found = saved(files.mapInArrow(run, f"{FIELDS}, {cut}"), "records")

    def gather(rows: pa.Table) -> pa.Table:
        parts = list(zip(*(rows.column(c).to_pylist() for c in ("number", "total", "block")), strict=True))
        fields = next((dict(x) for x in rows.column("fields").to_pylist() if x), None)
        if fields is None:  # continuations without a first segment
            out = (rows.column("origin")[0].as_py(), None, "response", None, None, None, None, None, None, "missing segment")
        else:
            block, status = reassembled(parts)
            out = described(fields, block, keep_payload, status)
        return pa.table([pa.array([x], t) for x, t in zip(out, FIELD_TYPES, strict=True)], names=FIELD_NAMES)

    segments = found.where("origin is not null").select("fields", "origin", "number", "total", "block")
    whole = saved(segments.groupBy("origin").applyInArrow(gather, FIELDS), "reassembled")  # resolved reads it twice
    return found.where("origin is null").select(*FIELD_NAMES).unionByName(whole)


def resolved(read: DataFrame) -> DataFrame:
    """read, with revisits' payload_bytes and payload_digest from the response that they refer to; missing target is their status without one."""
    of = read.where("type = 'response'").select(F.col("record_id").alias("target"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d"))
    out = read.join(of, F.col("refers_to") == F.col("target"), "left")
    missing = (F.col("type") == "revisit") & F.col("target").isNull()
    return out.withColumns({"payload_bytes": F.coalesce("payload_bytes", "n"), "payload_digest": F.coalesce("payload_digest", "d"), "status": F.when(missing, "missing target").otherwise(F.col("status"))}).drop("target", "n", "d")


#: What op5_warc returns, over a view pages, by DuckDB.
ORACLE = """
with rows as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
first as (select payload_digest, min(page_id) as first_id from rows where payload_bytes >= 100 group by payload_digest)
select r.page_id, r.payload_bytes, r.payload_digest, case when f.first_id < r.page_id then 'revisit' else 'response' end as record_type,
  case when f.first_id < r.page_id then f.first_id end as refers_to
from rows r left join first f on r.payload_digest = f.payload_digest and r.payload_bytes >= 100
"""
