"""Target-distribution importance resampling by a dictionary of distinct features.

Features are runs of one to three consecutive words, as strings; a feature counts in the bucket that its CRC-32 names.

1. Each worker cuts its documents into blocks of bounded size and counts a block's distinct features. They are dealt over
   parts by a hash of their first word, or of their first two if that word is hot: each once a block, sorted, as a tree of
   words, compressed.
2. Each part of the dictionary merges what all blocks sent, so that every distinct string is in one part and is hashed
   there once; it adds up its buckets, and sends back to each block the buckets of the features that the block sent.
3. Gains come of the buckets of both corpora, 10,000 numbers at most. Blocks are cut again, the buckets of their features
   are joined to them, and each document's feature counts are weighed.
4. Scores are put in order by range, rows of each range are numbered, and the best of them are drawn.

A word, line or passage that stands everywhere costs one entry a block. The documents are read three times, each time in
the same blocks, so they must be a table, or whatever gives the same rows in the same partitions when it is read again;
the number of features of each block is compared, and a difference ends the job.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import fresh_path, rows_of, spool
from .sstable import store

BLOCK = 7_000_000  # bytes of text in a block; longer texts take several
BUCKETS = 10_000
HOT = 4096  # a word that makes up more than one in so many is hot; so there are no more of them
LEVEL = 6  # of compression
SHORT = 64  # bytes of features that are hashed together

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)  # odd numbers


def _strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Arrow binary array of raw[starts[i]:ends[i]], which ascend and don't overlap."""
    import pyarrow as pa

    offsets = np.empty(2 * len(starts) + 1, np.int64)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = starts, ends, ends[-1] if len(ends) else 0
    every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])
    return every.take(pa.array(np.arange(0, 2 * len(starts), 2)))


def _joined(strings) -> bytes:
    """An Arrow binary array as one string, each entry with a line's end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not len(strings):
        return b""
    ended = pc.binary_join_element_wise(strings, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    first, last = (int(np.frombuffer(ended.buffers()[1], np.int64)[ended.offset + k]) for k in (0, len(ended)))
    return ended.buffers()[2][first:last].to_pybytes()


def _split(data: bytes):
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw == 10)
    return _strings(raw, np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends, ends)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crcs(strings, step: int = 1 << 15) -> np.ndarray:
    """CRC-32 of each entry of an Arrow binary array: all entries move on by a byte at a time, the longest first, so that those that go on stand together; long ones are hashed alone."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    out = np.empty(len(strings), np.int64)
    for i in range(0, len(strings), step):
        starts, size = offsets[i : i + step][: len(strings) - i], np.diff(offsets[i : i + step + 1])
        long = np.flatnonzero(size > SHORT)
        size = np.where(size > SHORT, 0, size).astype(np.uint8)
        order = np.argsort(SHORT - size, kind="stable")
        # how many have more than k bytes
        left = len(size) - np.cumsum(np.bincount(size, minlength=SHORT + 1))
        at, crc = starts[order], np.full(len(size), 0xFFFFFFFF, np.uint32)
        for n in left[left > 0].tolist():
            at, some = at[:n], crc[:n]
            some[:] = _CRC[(some ^ raw[at]) & 255] ^ (some >> 8)
            at += 1
        own = out[i : i + step]
        own[order] = ~crc
        for k in long.tolist():
            own[k] = zlib.crc32(raw[offsets[i + k] : offsets[i + k + 1]])
    return out


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, ascending, the number of each key among them)."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys[new], number


class Features:
    """Distinct features of a block, and where they stand.

    texts: lower-cased bytes. skip: how many words at the beginning of the first text were counted with the block before.
    words_only: of one word alone.
    """

    def __init__(self, texts: list[bytes], skip: int, words_only: bool = False):
        import pyarrow as pa
        import pyarrow.compute as pc

        raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = _IN_WORD[raw]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts = edges[0::2]
        found = _strings(raw, starts, edges[1::2]).dictionary_encode()
        order = pc.sort_indices(found.dictionary).to_numpy()
        self.words = found.dictionary.take(pa.array(order))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ids = rank[found.indices.to_numpy()]
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right").astype(np.int32)
        self.tail = [self.words[int(i)].as_py() for i in ids[-2:][doc[-2:] == len(texts) - 1]]
        del raw, inside, edges, starts, found
        if words_only:
            self.at = [(ids[skip:], doc[skip:])]
            self.sizes, self.counts = [len(order)], [np.bincount(ids[skip:], minlength=len(order)).astype(np.uint32)]
            return
        n, v = len(ids), max(1, len(order))
        two = np.flatnonzero(doc[1:] == doc[:-1]).astype(np.int32)
        three = two[:-1][(two[1:] == two[:-1] + 1) & (doc[two[:-1]] == doc[two[1:]])]
        pairs, pair_of = _numbered(ids[two].astype(np.int64) * v + ids[two + 1])
        at = np.empty(n, np.int32)
        at[two] = pair_of
        triples, triple_of = _numbered(at[three].astype(np.int64) * v + ids[three + 2])
        self.first, self.second, self.third = ((x).astype(np.int32) for x in (pairs // v, pairs % v, triples % v))
        self.prefix = (triples // v).astype(np.int32)  # the pair that a triple begins with
        #: Of each order: occurrences as (feature, its document), the number of distinct features and their counts. An occurrence counts in the block of its last word.
        self.at = []
        for which, places, length in ((ids, None, 1), (pair_of, two, 2), (triple_of, three, 3)):
            last = (np.arange(n, dtype=np.int32) if places is None else places) + (length - 1)
            self.at.append((which[last >= skip], doc[last][last >= skip]) if skip else (which, doc if places is None else doc[places]))
        self.sizes = [len(order), len(pairs), len(triples)]
        self.counts = [np.bincount(which, minlength=k).astype(np.uint32) for (which, _), k in zip(self.at, self.sizes, strict=True)]

    def order(self, parts: int, hot: frozenset = frozenset()) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each order: features by part, ascending in each part, and where each part's begin and the last one's end. A part is named by a feature's first word, by its first two if that word is hot."""
        import pyarrow as pa
        import pyarrow.compute as pc

        own = _crcs(self.words).view(np.uint64)
        is_hot = pc.is_in(self.words, value_set=pa.array(sorted(hot), pa.large_binary())).to_numpy(zero_copy_only=False)
        one, pair = (((x * _MIX[0]) >> np.uint64(33)) % np.uint64(parts) for x in (own, (own[self.first] * _MIX[0]) ^ (own[self.second] * _MIX[1])))
        two = np.where(is_hot[self.first], pair, one[self.first])
        out = []
        small = np.uint16 if parts <= 1 << 16 else np.uint32  # 16 bits are sorted by counting
        one, two = one.astype(small), two.astype(small)
        for part in (one, two, two[self.prefix]):
            out.append((np.argsort(part, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))))
        return out

    def sent(self, parts: int, hot: frozenset = frozenset()):
        """(part, what it is sent): words, how many pairs begin with each and their second words, how many triples begin with each pair and their third words; and counts of all."""
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=LEVEL)
        order = self.order(parts, hot)
        for p in range(parts):
            one, two, three = (by[at[p] : at[p + 1]] for by, at in order)
            heads = np.union1d(one, self.first[two])  # a hot word heads pairs in parts that aren't its own
            if not len(heads):
                continue
            pairs = np.bincount(np.searchsorted(heads, self.first[two]), minlength=len(heads)).astype(np.uint32)
            triples = np.bincount(np.searchsorted(two, self.prefix[three]), minlength=len(two)).astype(np.uint32)
            texts = [_joined(self.words.take(pa.array(k))) for k in (heads, self.second[two], self.third[three])]
            sections = [*texts, np.isin(heads, one).tobytes(), pairs.tobytes(), triples.tobytes(), *(c[k].tobytes() for c, k in zip(self.counts, (one, two, three), strict=True))]
            yield p, press.compress(np.array([len(s) for s in sections], np.int64).tobytes() + b"".join(sections))

    def weights(self, gains: list[np.ndarray], docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, features, sum of gains) of each document, by its feature counts."""
        n = [np.bincount(doc, minlength=docs) for _, doc in self.at]
        weight = np.zeros(docs, np.int64)
        for (which, doc), gain in zip(self.at, gains, strict=True):
            np.add.at(weight, doc, gain[which])
        return n[0], sum(n), weight


def received(data: bytes):
    """What sent() wrote: (Arrow array of features, their counts)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(data)
    at, sections, blank = 72, [], pa.scalar(b" ", pa.large_binary())
    for n in np.frombuffer(data, np.int64, 9).tolist():
        sections.append(data[at : at + n])
        at += n
    heads, second, third = map(_split, sections[:3])
    own, pairs, triples = (np.frombuffer(s, kind) for s, kind in zip(sections[3:6], (bool, np.uint32, np.uint32), strict=True))
    two = pc.binary_join_element_wise(heads.take(pa.array(np.repeat(np.arange(len(heads)), pairs))), second, blank)
    three = pc.binary_join_element_wise(two.take(pa.array(np.repeat(np.arange(len(two)), triples))), third, blank)
    return pa.concat_arrays([heads.filter(pa.array(own)), two, three]), np.concatenate([np.frombuffer(s, np.uint32) for s in sections[6:]]).astype(np.int64)


def pack(buckets: np.ndarray) -> bytes:
    """Three numbers below 10,000 in five bytes."""
    threes = np.append(buckets, [0] * (-len(buckets) % 3)).astype("<u8").reshape(-1, 3) @ np.array([1, 10**4, 10**8], "<u8")
    return np.ascontiguousarray(threes.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    threes = wide.view("<u8")[:, 0]
    return np.stack([threes % 10**4, threes // 10**4 % 10**4, threes // 10**8], 1).ravel()[:n].astype(np.int64)


@dataclass
class Block:
    keys: list  # of the documents that begin here or go on from the block before
    goes_on: bool  # the first text is the rest of the document that ended the block before
    features: Features


def blocks(batches, size: int = BLOCK, words_only: bool = False):
    """The documents of Arrow batches of (id, text), in order, in blocks of about so many bytes."""
    keys, texts, held, skip, goes_on = [], [], 0, 0, False
    for b in batches:
        for key, text in zip(b.column(0), b.column(1), strict=True):
            data = (text.as_buffer().to_pybytes() if text.is_valid else b"").translate(_LOWER)
            keys.append(key.as_py())
            begin = 0
            while held + len(data) - begin >= size:
                end = _word_end(data, begin + max(0, size - held))
                texts.append(data[begin:end] if begin else data[:end])
                yield Block(keys, goes_on, f := Features(texts, skip, words_only))
                keys, texts, held, skip, goes_on, begin = [], [], 0, 0, False, end
                if begin < len(data):
                    keys, goes_on, skip = [key.as_py()], True, len(f.tail)
                    data, begin = b" ".join([*f.tail, data[begin:]]), 0
                else:
                    data = None
                    break
            if data is not None:
                texts.append(data[begin:])
                held += len(data) - begin
    if keys:
        yield Block(keys, goes_on, Features(texts, skip, words_only))


def _word_end(data: bytes, at: int) -> int:
    """The end of the word that goes on at `at`, or `at`."""
    if at and at < len(data) and _IN_WORD[data[at - 1]]:
        step = 4096
        while at < len(data):
            out = np.flatnonzero(~_IN_WORD[np.frombuffer(data, np.uint8, min(step, len(data) - at), at)])
            if len(out):
                return at + int(out[0])
            at += min(step, len(data) - at)
    return min(at, len(data))


def _hot_words(rows: DataFrame, block_bytes: int) -> frozenset:
    """Words that make up more than one in HOT of all: HOT at most, so that they may go to every task."""

    def count(batches):
        import pyarrow as pa

        for block in blocks(batches, block_bytes, words_only=True):
            f = block.features
            often = np.flatnonzero(f.counts[0] > f.counts[0].sum() / HOT)
            yield pa.RecordBatch.from_arrays([f.words.take(pa.array(often)).cast(pa.binary()), pa.array(f.counts[0][often], pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([f.counts[0].sum()], pa.int64())], ["word", "n"])

    counts = rows.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("word").isNull(), F.col("n"))).over(W.partitionBy())
    return frozenset(bytes(r.word) for r in counts.orderBy(F.desc("n")).limit(HOT + 1).withColumn("total", total).filter(f"word is not null and n > total / {HOT}").collect())


def _hashed(rows: DataFrame, parts: int, hot: frozenset, block_bytes: int, return_blocks: bool = True) -> str:
    """A table in the shared folder, by source: at -1 the bucket counts of each part of the dictionary, at others the buckets of the features of each of its blocks."""

    def send(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        source = TaskContext.get().partitionId()
        for k, block in enumerate(blocks(batches, block_bytes)):
            for part, data in block.features.sent(parts, hot):
                yield pa.RecordBatch.from_arrays([pa.array([source], pa.int32()), pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([data], pa.binary())], ["source", "block", "part", "data"])

    def merge(table):
        import pyarrow as pa
        import zstandard

        got = [received(d.as_buffer().to_pybytes()) for d in table.column("data")]
        bounds, counts = np.cumsum([0, *(len(f) for f, _ in got)]), np.concatenate([c for _, c in got])
        features = pa.concat_arrays([f for f, _ in got])
        del got
        features = features.dictionary_encode()
        at, distinct = features.indices.to_numpy(), features.dictionary
        bucket = _crcs(distinct) % BUCKETS
        n = np.zeros(BUCKETS, np.int64)
        np.add.at(n, bucket[at], counts)
        names = ["source", "block", "part", "n", "data"]
        part = table.column("part").slice(0, 1)
        totals = pa.Table.from_arrays([pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), part, pa.array([BUCKETS], pa.int64()), pa.array([zstandard.compress(n.tobytes())], pa.binary())], names)
        if not return_blocks:
            return totals
        back = [pack(bucket[at[a:b]]) for a, b in zip(bounds, bounds[1:], strict=False)]
        return pa.concat_tables([totals, pa.Table.from_arrays([*(table.column(c).combine_chunks() for c in names[:3]), pa.array(np.diff(bounds), pa.int64()), pa.array(back, pa.binary())], names)])

    spark = rows.sparkSession
    path = fresh_path(spark, "buckets")
    sent = rows.mapInArrow(send, "source int, block int, part int, data binary")
    merged = sent.groupBy("part").applyInArrow(merge, "source int, block int, part int, n long, data binary")
    by_source = merged.repartition("source", F.when(F.col("source") < 0, F.col("part"))).sortWithinPartitions("source", "block")
    by_source.write.option("compression", "none").partitionBy("source").parquet(path)
    return path


_HASHED = "block int, part int, n long, data binary, source int"


def _bucket_counts(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, n): what the parts of the dictionary counted, added up in each task and then over all."""

    def add(batches):
        import pyarrow as pa
        import zstandard

        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for data in b.column(0):
                n += np.frombuffer(zstandard.decompress(data.as_py()), np.int64)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used], pa.int64())], ["bucket", "n"])

    own = spark.read.schema(_HASHED).parquet(path).filter("source = -1").select("data")
    return own.mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _from_table(path: str, source: int):
    """(block, part, n, data) of a source, by block: from its files in the shared folder, a few rows at a time."""
    import heapq

    import pyarrow.parquet as pq
    from pyarrow import fs

    files, at = store(path)
    folder = f"{at}/source={source}"

    def rows(name):
        with files.open_input_file(name) as f:
            for b in pq.ParquetFile(f).iter_batches(16, columns=["block", "part", "n", "data"]):
                yield from zip(*(b.column(c).to_pylist() for c in ("block", "part", "n", "data")), strict=True)

    names = [x.path for x in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.path.endswith(".parquet")]
    return heapq.merge(*map(rows, sorted(names)), key=lambda r: r[0])


def _weights(rows: DataFrame, path: str, parts: int, hot: frozenset, block_bytes: int, gains: np.ndarray) -> DataFrame:
    """doc_id, words, n_features, weight of each document: gains joined to the features of its block."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["doc_id"].dataType)

    def weigh(batches):
        from itertools import groupby

        import pyarrow as pa
        from pyspark import TaskContext

        def batch(keys, numbers):
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(x, pa.int64()) for x in numbers)], ["doc_id", "words", "n_features", "weight"])

        back = groupby(_from_table(path, TaskContext.get().partitionId()), lambda r: r[0])
        open_ = None  # the last document, which may go on
        for k, block in enumerate(blocks(batches, block_bytes)):
            f = block.features
            own = [np.zeros(n, np.int64) for n in f.sizes]
            if sum(f.sizes):
                order = f.order(parts, hot)
                got, seen = next(back, (None, ()))
                count = 0
                for _, p, n, data in seen:
                    which = [by[at[p] : at[p + 1]] for by, at in order]
                    if got != k or n != sum(map(len, which)):
                        raise RuntimeError("the documents were not the same when they were read again; write them as a table first")
                    found = gains[unpack(data, n)]
                    count += n
                    for mine, w, g in zip(own, which, np.split(found, np.cumsum([len(w) for w in which])[:-1]), strict=True):
                        mine[w] = g
                if count != sum(f.sizes):
                    raise RuntimeError("the documents were not the same when they were read again; write them as a table first")
            numbers = np.array(f.weights(own, len(block.keys)))
            keys = block.keys
            if open_ is not None:
                if block.goes_on:
                    numbers[:, 0] += open_[1][:, 0]
                else:
                    yield batch(*open_)
            if len(keys) > 1:
                yield batch(keys[:-1], numbers[:, :-1])
            open_ = keys[-1:], numbers[:, -1:]
        if open_ is not None:
            yield batch(*open_)

    return rows.mapInArrow(weigh, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, words long, n_features long, weight long")


def bucket_counts(texts: DataFrame, id_col: str = "item_id", text_col: str = "text", parts: int | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """(bucket, n) of all features of a table of texts, by its dictionary."""
    spark = texts.sparkSession
    rows = rows_of(texts, id_col, text_col)
    return _bucket_counts(spark, _hashed(rows, parts or _parts(spark), _hot_words(rows, block_bytes), block_bytes, False))


def _parts(spark: SparkSession) -> int:
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", target_text: str = "text", parts: int | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """Every document with its weight and, if it is drawn, its rank: doc_id, n_features, weight, score, rank, n_words.

    A document's weight is the sum of the gains of its features, its score that and a Gumbel number of `seed:doc_id`; of the
    documents of `min_words` words or more, `percent` in a hundred of the highest scores are drawn, ties to the smaller id.
    Null and empty texts have no features and weigh 0. A null id counts as an empty one, and sorts first. Repeated rows and
    ids are each weighed and counted; rows that are equal in score and id are ranked in any order. Texts of any length are
    counted whole, block by block. Other columns aren't looked at. An empty table of documents gives no rows; an empty
    target makes every gain that of t = 0.
    """
    spark = docs.sparkSession
    parts = parts or _parts(spark)
    rows = rows_of(docs, id_col, text_col)
    hot = _hot_words(rows, block_bytes)
    path = _hashed(rows, parts, hot, block_bytes)
    both = _bucket_counts(spark, path).withColumnRenamed("n", "s").join(bucket_counts(target, target_id, target_text, parts, block_bytes).withColumnRenamed("n", "t"), "bucket", "full")
    every = both.join(spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")), "bucket", "right").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    sums = every.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    s, t, all_s, all_t = (F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t"))
    gain = F.floor(1000 * F.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS))))
    found = every.crossJoin(F.broadcast(sums)).select("bucket", gain.alias("gain")).toArrow()  # BUCKETS rows, and one
    gains = np.zeros(BUCKETS, np.int64)
    gains[found.column("bucket").to_numpy()] = found.column("gain").to_numpy()
    return draw(_weights(rows, path, parts, hot, block_bytes, gains), percent, seed, min_words)


def draw(weighed: DataFrame, percent: int, seed: int, min_words: int) -> DataFrame:
    """Scores and ranks: put in order by range and written, each range numbered from the count of those before it."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    fits: Column = F.col("words") >= min_words
    scored = weighed.withColumns({"score": F.col("weight") + gumbel, "fits": fits, "row": F.monotonically_increasing_id()})
    by = [F.desc("fits"), F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row")]
    ranged = spool(spool(scored, "scores").repartitionByRange(*by).withColumn("range", F.spark_partition_id()), "ranges")
    held = ranged.groupBy("range").agg(F.count(F.when(F.col("fits"), 1)).alias("held"))  # one row a range
    before = held.select("range", (F.sum("held").over(W.orderBy("range")) - F.col("held")).alias("before"), F.sum("held").over(W.partitionBy()).alias("of"))
    place = F.row_number().over(W.partitionBy("range").orderBy(*by)) + F.col("before")
    rank = F.when(F.col("fits") & (place <= F.floor(F.col("of") * percent / 100)), place).cast("long")
    return ranged.join(F.broadcast(before), "range").select("doc_id", "n_features", "weight", "score", rank.alias("rank"), F.col("words").alias("n_words"))
