"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle check.

Each benchmark item has a 64-bit SimHash of its five-word shingles, weighted by how often they occur. Each document is
slid over by windows of an item's own number of words. A window is a candidate for an item if its SimHash is within
RADIUS bits of the item's: the 64 bits are cut into BLOCKS blocks, and of two fingerprints within RADIUS at least one
block is within RADIUS // BLOCKS bits, so looking up each block of the window in a table of all block values within
that distance of the items' finds every item within the radius. Candidates are verified by the weighted Jaccard
similarity of the shingles (sum of the lesser over sum of the greater counts).

A window that holds none of the item's shingles has similarity 0, whatever its fingerprint; such windows are passed over
before they are fingerprinted, which changes no result.

The items' tables are on each worker. BENCHMARK_BYTES bounds the text of items handled in one pass over the documents;
larger benchmarks take several passes, so that what is broadcast doesn't grow with them.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minhash import _mix, _words
from .tokens import text_slices

_U = np.uint64
WIDTH, PERCENT = 5, 80
BLOCKS, RADIUS = 4, 19
BENCHMARK_BYTES = 2 << 20
EXPANDED = 400  # items up to which all block values near theirs are tabled (160 KB an item); with more, near values of the windows are looked up


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_words.__getitem__, words), _U, len(words))


def shingle_hashes(w: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Of each place; fewer words than width are one shingle, none are none."""
    if not len(w):
        return w
    n = max(1, len(w) - width + 1)
    h = np.full(n, min(len(w), width), _U)
    for k in range(min(width, len(w))):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + w[k : k + n])
    return h


def _bits(h: np.ndarray) -> np.ndarray:
    """n x 64: bits of hashes as -1 and 1."""
    return np.unpackbits(_mix(h).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(_U).ravel()


def simhash(h: np.ndarray) -> int:
    return int(_fingerprints(_bits(h).sum(axis=0, dtype=np.int64)[None, :])[0])


class Index:
    """The items of one number of words."""

    def __init__(self, items: list[tuple[int, Counter, int]], radius: int, blocks: int, expand: bool = True):
        self.items, self.radius, self.blocks, self.width = items, radius, blocks, 64 // blocks
        self.prints = np.array([p for _, _, p in items], _U)
        near = [0]
        for k in range(1, radius // blocks + 1):
            near += [sum(1 << b for b in c) for c in combinations(range(self.width), k)]
        self.near = np.array(near, np.int64)
        own_side, self.window_side = (self.near, np.zeros(1, np.int64)) if expand else (np.zeros(1, np.int64), self.near)
        self.tables = []
        for b in range(blocks):
            own = ((self.prints >> _U(b * self.width)) & _U((1 << self.width) - 1)).astype(np.int64)
            values = (own[:, None] ^ own_side[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], np.repeat(np.arange(len(items)), len(own_side))[order]))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in prints, item) of all within the radius."""
        found = [np.zeros(0, np.int64)]
        step = max(1, (1 << 20) // len(self.window_side))
        for i in range(0, len(prints), step):
            some = prints[i : i + step]
            for b, (values, items) in enumerate(self.tables):
                own = ((some >> _U(b * self.width)) & _U((1 << self.width) - 1)).astype(np.int64)
                own = (own[:, None] ^ self.window_side[None, :]).ravel()
                lo, hi = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                n = hi - lo
                at = np.repeat(np.arange(len(own)) // len(self.window_side), n)
                item = items[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                close = np.bitwise_count(some[at] ^ self.prints[item]) <= self.radius
                found.append((i + at[close]) * len(self.items) + item[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.items), pairs % len(self.items)


class Benchmark:
    def __init__(self, rows: list[tuple[int, str]], width: int = WIDTH, radius: int = RADIUS, blocks: int = BLOCKS):
        self.width = width
        own: dict[int, list] = {}
        owners: dict[int, set[int]] = {}
        for item, text in rows:
            w = word_hashes(text or "")
            h = shingle_hashes(w, width)
            if len(h):
                own.setdefault(len(w), []).append((item, Counter(h.tolist()), simhash(h)))
                for x in h.tolist():
                    owners.setdefault(x, set()).add(len(w))
        self.by_words = {n: Index(items, radius, blocks, len(rows) <= EXPANDED) for n, items in own.items()}
        self.known = np.array(sorted(owners), _U)  # all shingles of the items
        self.sizes = [sorted(owners[x]) for x in self.known.tolist()]
        self.low = np.zeros(1 << 20, bool)  # a first look, by the low bits
        self.low[(self.known & _U((1 << 20) - 1)).astype(np.int64)] = True
        self.short = sorted(n for n in own if n < width)

    def scan(self, text: str, percent: int) -> list[tuple[int, float, int, int]]:
        """(item, best similarity, first word, words) of each item that a window of the text matches."""
        w = word_hashes(text)
        if not len(w):
            return []
        h = shingle_hashes(w, self.width)
        todo: dict[int, list[np.ndarray]] = {}
        if len(w) >= self.width:
            hits = np.flatnonzero(self.low[(h & _U((1 << 20) - 1)).astype(np.int64)])
            if len(hits):
                at = np.minimum(np.searchsorted(self.known, h[hits]), len(self.known) - 1)
                for p, k in zip(hits[self.known[at] == h[hits]].tolist(), at[self.known[at] == h[hits]].tolist(), strict=True):
                    for n in self.sizes[k]:
                        if n >= self.width:  # windows that hold the shingle at p; a text shorter than the item is its own window
                            todo.setdefault(n, []).append(np.arange(max(0, p + self.width - n), max(0, min(p, len(w) - n)) + 1))
        best: dict[int, tuple[float, int, int]] = {}
        for n, starts in todo.items():
            self._match(h, np.unique(np.concatenate(starts)), n, min(n, len(w)) - self.width + 1, percent, best)
        for n in self.short:  # items of fewer words than a shingle: windows of their size are one shingle
            if len(w) >= n:
                self._match(shingle_hashes_of(w, n), np.arange(len(w) - n + 1), n, 1, percent, best)
        return [(item, *x) for item, x in sorted(best.items())]

    def _match(self, h, starts, n, size, percent, best) -> None:
        index = self.by_words[n]
        for i in range(0, len(starts), 4096):
            some = starts[i : i + 4096]
            first, last = int(some[0]), int(some[-1]) + size
            sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_bits(h[first:last]), axis=0, dtype=np.int32)))
            place, item = index.within(_fingerprints(sums[some - first + size] - sums[some - first]))
            for p, k in zip(some[place].tolist(), item.tolist(), strict=True):
                key, weights, _ = index.items[k]
                own = Counter(h[p : p + size].tolist())
                common = sum(min(c, weights[x]) for x, c in own.items() if x in weights)
                total = sum(own.values()) + sum(weights.values()) - common
                if 100 * common >= percent * total and common / total > best.get(key, (0.0,))[0]:
                    best[key] = (common / total, p, n)


def shingle_hashes_of(w: np.ndarray, n: int) -> np.ndarray:
    """Windows of n words, n below the shingle width, as items of n words hash."""
    h = np.full(len(w) - n + 1, n, _U)
    for k in range(n):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + w[k : k + len(w) - n + 1])
    return h


def _parts(benchmark: DataFrame, limit: int) -> int:
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // limit))


def _benchmarks(benchmark: DataFrame, limit: int):
    """Broadcast parts of the benchmark, each of about `limit` bytes of text at most."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null and item_id is not null")
    parts = _parts(items, limit)
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        yield benchmark.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in own.distinct().orderBy("item_id", "text").collect()]))


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, limit: int = BENCHMARK_BYTES) -> DataFrame:
    """One row per input row: doc_id, found: an array of (item_id, similarity, first_word, n_words), the best window of the text for each item that it matches, ascending by item within a part of the benchmark.

    Null and empty texts and items, and items without an id, match nothing; of items of fewer than five words the whole is
    one shingle; repeated rows and rows with a null doc_id are judged each. A document shorter than an item is one window.
    Ties in similarity: the first window. Rows of one item_id with different texts are items of their own, the best of which
    counts. Empty tables give no rows. Further columns are ignored. Nothing shuffles: rows pass the parts one after another.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    item = benchmark.schema["item_id"].dataType
    entry = f"array<struct<item_id: {item.simpleString()}, similarity: double, first_word: bigint, n_words: bigint>>"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.array().cast(entry).alias("found"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, found {entry}"
    arrow = to_arrow_type(rows.schema["found"].dataType)
    for shared in _benchmarks(benchmark, limit):

        def scan(batches, shared=shared):
            import pyarrow as pa

            bench = shared.value
            for b in batches:
                for start, texts in text_slices(b.column(1)):
                    some = b.slice(start, len(texts))
                    found = [had + [dict(zip(("item_id", "similarity", "first_word", "n_words"), x, strict=True)) for x in bench.scan(t, percent)] for had, t in zip(some.column(2).to_pylist(), texts, strict=True)]
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(found, arrow)], ["doc_id", "text", "found"])

        rows = rows.mapInArrow(scan, schema)
    return rows.select("doc_id", "found")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, limit: int = BENCHMARK_BYTES) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: a row for each entry of `judge`."""
    return judge(docs, benchmark, id_col, text_col, percent, limit).select("doc_id", F.inline("found"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs without the rows that match an item; all columns stay. Judged row by row, so repeated and null ids do no harm."""
    for shared in _benchmarks(benchmark, BENCHMARK_BYTES):

        def keep(batches, shared=shared):
            import pyarrow as pa

            bench = shared.value
            for b in batches:
                for start, texts in text_slices(b.column(b.schema.names.index(text_col))):
                    yield b.slice(start, len(texts)).filter(pa.array([not bench.scan(t, percent) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
