"""Token ids in sorted-string-table shards: prefix-compressed blocks, sparse index, Bloom filter, footer.

File:   blocks | index | Bloom filter | footer
Block:  zstd of entries; entry = varint(shared key bytes) varint(other key bytes) varint(value bytes) key value.
        The first entry of a block shares nothing.
Key:    the document's number as 8 bytes, big-endian, sign bit turned, so that bytes sort as numbers; a null id has
        the empty key and comes first.
Value:  ids as little-endian integers of `width` bytes (2 where the vocabulary allows, else 4).
Index:  per block varint(key bytes) first key, then offset, stored bytes, raw bytes, crc32 as <QIII.
Footer: <QQQQQIB: index offset, index bytes, filter offset, filter bytes, entries, blocks, width; then MAGIC.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import fresh_path, rows_of, spool
from .tokens import by_chars, default_tokenizer, encoder

MAGIC = b"FOLIOSST"
FOOTER = struct.Struct("<QQQQQIB")
ENTRY = struct.Struct("<QIII")
BLOCK = 1 << 16
BITS_PER_KEY, PROBES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & (2**64 - 1))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = raw[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _hashes(key: bytes) -> tuple[int, int]:
    return zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1


def _probes(a, b, bits: int) -> list:
    return [(a + i * b) % bits for i in range(PROBES)]


class Writer:
    """add() entries in key order, then close()."""

    def __init__(self, out, width: int):
        import zstandard

        self.out, self.width, self.at = out, width, 0
        self.zip = zstandard.ZstdCompressor(level=1)
        self.block, self.first, self.last = bytearray(), b"", None
        self.index, self.hashes, self.blocks = bytearray(), array("Q"), 0  # of each key its two hashes, 16 bytes an entry

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.last is not None and key < self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.block:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first = key
        value = ids.astype(f"<u{self.width}").tobytes()
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = key
        self.hashes.extend(_hashes(key))
        if len(self.block) >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            raw = bytes(self.block)
            stored = self.zip.compress(raw)
            self.index += _varint(len(self.first)) + self.first + ENTRY.pack(self.at, len(stored), len(raw), zlib.crc32(stored))
            self.out.write(stored)
            self.at += len(stored)
            self.blocks += 1
            self.block = bytearray()

    def close(self) -> None:
        self._flush()
        n = len(self.hashes) // 2
        bloom = np.zeros(-(-max(64, BITS_PER_KEY * n) // 8), np.uint8)
        own = np.frombuffer(self.hashes, np.uint64).reshape(-1, 2)
        for some in (own[i : i + 100_000] for i in range(0, n, 100_000)):
            for p in _probes(some[:, 0], some[:, 1], np.uint64(len(bloom) * 8)):
                np.bitwise_or.at(bloom, (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        self.out.write(bytes(self.index))
        self.out.write(bloom.tobytes())
        self.out.write(FOOTER.pack(self.at, len(self.index), self.at + len(self.index), len(bloom), n, self.blocks, self.width) + MAGIC)


class Reader:
    """Over a seekable file: entries() in order, get() by binary search."""

    def __init__(self, file, size: int):
        self.file = file
        if size < FOOTER.size + len(MAGIC):
            raise ValueError("not a table: too short")
        tail = self._at(size - FOOTER.size - len(MAGIC), FOOTER.size + len(MAGIC))
        if tail[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a table: no footer")
        index_at, index_n, self.bloom_at, self.bloom_n, self.entries_n, blocks, self.width = FOOTER.unpack(tail[: FOOTER.size])
        raw, at, self.firsts, self.blocks, self._bloom = self._at(index_at, index_n), 0, [], [], None
        for _ in range(blocks):
            n, at = _read_varint(raw, at)
            self.firsts.append(raw[at : at + n])
            self.blocks.append(ENTRY.unpack_from(raw, at + n))
            at += n + ENTRY.size

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        got = self.file.read(n)
        if len(got) != n:
            raise ValueError("table cut short")
        return got

    def block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        import zstandard

        at, stored, raw_n, crc = self.blocks[k]
        got = self._at(at, stored)
        if zlib.crc32(got) != crc:
            raise ValueError(f"block {k} is damaged")
        raw, at, key = zstandard.ZstdDecompressor().decompress(got, max_output_size=raw_n), 0, b""
        while at < len(raw):
            shared, at = _read_varint(raw, at)
            other, at = _read_varint(raw, at)
            n, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + other]
            at += other
            yield key, np.frombuffer(raw, f"<u{self.width}", n // self.width, at)
            at += n

    def entries(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for k in range(len(self.blocks)):
            yield from self.block(k)

    def may_hold(self, key: bytes) -> bool:
        if self._bloom is None:
            self._bloom = self._at(self.bloom_at, self.bloom_n)
        return all(self._bloom[p >> 3] >> (p & 7) & 1 for p in _probes(*_hashes(key), self.bloom_n * 8))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """All values of an id (more than one only where ids repeat)."""
        key, out = key_of(doc_id), []
        if self.blocks and self.may_hold(key):
            k = max(0, bisect.bisect_left(self.firsts, key) - 1)
            while k < len(self.blocks) and self.firsts[k] <= key:
                out += [v for x, v in self.block(k) if x == key]
                k += 1
        return out


def store(path: str):
    """(pyarrow filesystem, path in it) of a path in the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def put_file(path: str, write) -> None:
    """write(file) beside the path, then move: a task that runs again leaves the same file, never half of one."""
    import uuid

    files, at = store(path)
    part = f"{at}.{uuid.uuid4().hex}.part"
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(part, compression=None) as out:
        write(out)
    files.move(part, at)


def write_tables(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards in ascending doc_id order below folder; the manifest: path, shard, entries, tokens, first_id, last_id.

    Texts are range-partitioned by doc_id and sorted in each partition; null texts count as empty, null ids come
    first, repeated ids stay beside each other. Ids must be numbers that fit a long. The manifest has one row per shard and is a table in the shared folder.
    """
    tokenizer = tokenizer or default_tokenizer()
    rows = rows_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        batches = (b for b in batches if b.num_rows)
        if (head := next(batches, None)) is None:
            return
        shard = TaskContext.get().partitionId()
        path, code = f"{folder}/shard-{shard:06d}.sst", encoder(tokenizer)
        seen = {"entries": 0, "tokens": 0, "first": None, "last": None}

        def body(out):
            writer = Writer(out, code.kind().itemsize)
            for keys, texts in by_chars((x for part in ([head], batches) for x in part)):
                ids, offsets = code.encode(texts)
                for k, key in enumerate(keys):
                    writer.add(key_of(key), np.append(ids[offsets[k] : offsets[k + 1]], np.uint32(end_id)))
                if not seen["entries"]:
                    seen["first"] = keys[0]
                seen["last"] = keys[-1]
                seen["entries"] += len(keys)
                seen["tokens"] += len(ids) + len(keys)
            writer.close()

        put_file(path, body)
        yield pa.RecordBatch.from_pydict({"path": [path], "shard": pa.array([shard], pa.int64()), "entries": [seen["entries"]], "tokens": [seen["tokens"]], "first_id": pa.array([seen["first"]], pa.int64()), "last_id": pa.array([seen["last"]], pa.int64())})

    return spool(ordered.mapInArrow(write, "path string, shard long, entries long, tokens long, first_id long, last_id long"), "manifest")


def read_tables(manifest: DataFrame) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    before = F.coalesce(F.sum("tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row per shard
    shards = manifest.select("path", "shard", before.alias("before"))
    listed = [(r.path, r.before) for r in shards.orderBy("shard").collect()]
    spark = manifest.sparkSession
    todo = spark.createDataFrame(listed, "path string, before long").repartition(max(1, len(listed)))

    def read(batches):
        import pyarrow as pa

        for b in batches:
            for path, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                files, place = store(path)
                with files.open_input_file(place) as file:
                    entries = Reader(file, file.size()).entries()
                    while some := list(islice(entries, 200)):
                        out = []
                        for key, ids in some:
                            out.append((id_of(key), at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                            at += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return todo.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, doc_id: int) -> list[np.ndarray]:
    """The ids of one document: its shards by the manifest's ranges, then Bloom filter and binary search."""
    out = []
    rows = manifest.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id) | F.col("first_id").isNull()).orderBy("shard").collect()
    for r in rows:
        files, place = store(r.path)
        with files.open_input_file(place) as file:
            out += Reader(file, file.size()).get(doc_id)
    return out


def round_trip(docs: DataFrame, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """Write to a new folder of the shared one and read the files back."""
    return read_tables(write_tables(docs, fresh_path(docs.sparkSession, "sst"), tokenizer, end_id))
