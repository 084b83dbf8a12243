"""WARC archives: one gzip member per record; read sequentially by incremental decompression.

Writing: each partition of pages becomes one .warc.gz below a folder. Of pages with equal payloads of at least
MIN_REVISIT bytes the one with the largest id is a response and the others are revisit records that refer to it.
Reading: a file is read in chunks; each member is decompressed as its bytes come, its header block ends at the blank
line, content-length frames the block, and the SHA-1 of block and payload are verified.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, spool
from .sstable import put_file, store

MIN_REVISIT = 1000
BROADCAST_ROWS = 200_000
CHUNK = 1 << 16
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the WARC 1.1 format


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload (binary, null: empty), digest, record_type, refers_to. Only ids, sizes and digests are grouped; a group costs one row for each task."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_revisit
    groups = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("digest", "first_id")
    groups = spool(groups, "payloads")
    if groups.count() <= BROADCAST_ROWS:  # 50 bytes each; with more the payloads shuffle
        groups = F.broadcast(groups)
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(large & (F.col("first_id") != F.col("page_id")), "revisit").otherwise("response").alias("record_type"),
        F.when(large & (F.col("first_id") != F.col("page_id")), F.col("first_id")).alias("refers_to"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value)


def member(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record as one gzip member."""
    head = HTTP % len(payload)
    block = head + payload if kind == "response" else head
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_clean(url or 'urn:x-none')}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}", f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    zipper = zlib.compressobj(6, zlib.DEFLATED, 31)
    return zipper.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + zipper.flush()


def write_archives(classified: DataFrame, folder: str) -> DataFrame:
    """Manifest (path, records), a table in the shared folder: the archives are written once."""

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        batches = (b for b in batches if b.num_rows)
        if (head := next(batches, None)) is None:
            return
        path, n = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz", [0]

        def body(out):
            for part in ([head], batches):
                for b in part:
                    for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                        out.write(member(*row))
                        n[0] += 1

        put_file(path, body)
        yield pa.RecordBatch.from_pydict({"path": [path], "records": n})

    rows = classified.select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return spool(rows.mapInArrow(write, "path string, records long"), "archives")


class WarcError(ValueError):
    pass


def members(file, chunk: int = CHUNK) -> Iterator[Iterator[bytes]]:
    """Of each gzip member an iterator of its decompressed pieces; at most a chunk is held."""
    raw = file.read(chunk)
    while raw:
        state = {"rest": raw}

        def pieces(state=state):
            unzip, raw = zlib.decompressobj(31), state["rest"]
            while True:
                got = unzip.decompress(raw, chunk)
                if got:
                    yield got
                if unzip.eof:
                    state["rest"] = unzip.unused_data
                    return
                raw = unzip.unconsumed_tail or file.read(chunk)
                if not raw and not got:
                    raise WarcError("archive cut short")

        own = pieces()
        yield own
        for _ in own:  # what the caller left
            pass
        raw = state["rest"] or file.read(chunk)


def records(file, chunk: int = CHUNK) -> Iterator[dict]:
    """Headers of each record with the payload (a view of the record's bytes, which are held once) and its digest, verified."""
    for pieces in members(file, chunk):
        buffer = b""
        for piece in pieces:
            buffer += piece
            if (end := buffer.find(b"\r\n\r\n")) >= 0:
                break
        else:
            raise WarcError("no end of header")
        first, *lines = buffer[:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise WarcError(f"no record: {first[:20]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        body = bytearray(buffer[end + 4 :])
        for piece in pieces:
            body += piece
        if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
            raise WarcError(f"record of {len(body) - 4} bytes where {length} were told")
        block = memoryview(body)[:length]
        if headers.get("warc-block-digest", "") != f"sha1:{hashlib.sha1(block).hexdigest()}":
            raise WarcError("block digest differs")
        begin = body.find(b"\r\n\r\n", 0, length)
        payload = block[begin + 4 if begin >= 0 else length :]
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if headers.get("warc-type") == "response" and digest != hashlib.sha1(payload).hexdigest():
            raise WarcError("payload digest differs")
        yield {"headers": headers, "payload": payload, "digest": digest}


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url (and payload; null of revisits)."""
    spark = manifest.sparkSession
    paths = [(r.path,) for r in manifest.select("path").orderBy("path").collect()]  # one for each partition that wrote
    todo = spark.createDataFrame(paths, "path string").repartition(max(1, len(paths)))

    def read(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * with_payload
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * with_payload

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            for path in b.column(0).to_pylist():
                files, place = store(path)
                with files.open_input_stream(place, compression=None) as file:
                    rows, held = [], 0
                    for r in records(file):
                        h = r["headers"]
                        number = lambda k, h=h: int(h[k]) if h.get(k) else None
                        size = number("x-payload-length") if h["warc-type"] == "revisit" else len(r["payload"])  # a revisit holds no payload
                        rows.append((number("x-page-id"), size, r["digest"], h["warc-type"], number("x-refers-to-page-id"), h.get("warc-target-uri")))
                        if with_payload:
                            rows[-1] += (bytes(r["payload"]) if h["warc-type"] == "response" else None,)
                            held += len(r["payload"])
                        if len(rows) >= 10000 or held > 1 << 24:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    return todo.mapInArrow(read, f"{RECORD}, url string" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write archives of all pages below the shared folder and read them back. Null html is an empty payload; null ids and urls are kept as such; repeated rows are records of their own; an empty table gives no rows."""
    return read_archives(write_archives(classify(pages, id_col, url_col, html_col), fresh_path(pages.sparkSession, "warc")))
