"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): in round i < t each shingle is thrown into a hashed bin of t with a value
that begins with i; in round t + k all go into bin k. A bin keeps its least value, and rounds stop once all bins are
filled, which the second t rounds guarantee and the first few nearly always do. Each coordinate agrees with the
probability of the Jaccard similarity, and the fixed bins concentrate the share that agrees.

Banding gives candidates; all links are confirmed on full shingle sets:

1. equal sets are one node, its number the smallest doc_id;
2. in each bucket, the member that shares most buckets is the pivot and is compared with all others;
3. components of the confirmed links; those that met one pivot but are in different components are compared with each
   other, unless what they lack of the pivot and have besides it shows that they can't be linked (see `_reach`).

So a group of many near copies costs about as many comparisons as it has members, and no candidate is dropped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, rows_of, spool

ROWS, BANDS = 6, 40  # a pair at 0.85 shares no band with probability 6e-9, at 0.8 with 6e-6
WORDS_KEPT = 400_000  # word hashes that a worker keeps
BROADCAST_IDS = 400_000  # 8 bytes each; with more ids the texts shuffle
PART = 256
LACKS, HAS = 4, 3  # 64-bit words of the bitmaps of what a set lacks of its pivot's and has besides it

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles: A-Z lower-cased, words split at ASCII white space; fewer words than width are one shingle, none are none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, _U)
    w = np.fromiter(map(_words.__getitem__, words), _U, len(words))
    n = max(1, len(words) - width + 1)
    h = np.full(n, min(len(words), width), _U)
    for k in range(min(width, len(words))):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + w[k : k + n])
    return np.unique(h)


def sketch(h: np.ndarray, t: int) -> np.ndarray:
    """t coordinates of a non-empty set."""
    out = np.full(t, ~_U(0), _U)
    step = max(1, min(t, 1024 // len(h)))
    i = 0
    while i < 2 * t:
        rounds = np.arange(i, min(i + step, 2 * t, t if i < t else 2 * t), dtype=_U)
        g = _mix(h[None, :] ^ _mix(rounds + _U(1))[:, None])
        bins = np.where(rounds[:, None] < _U(t), (g >> _U(32)) % _U(t), rounds[:, None] - _U(t)).astype(np.int64).ravel()
        values = ((rounds << _U(32))[:, None] | (g & _U(0xFFFFFFFF))).ravel()
        if i:
            some = out[bins] > (_U(i) << _U(32))
            bins, values = bins[some], values[some]
        np.minimum.at(out, bins, values)
        if out.max() != ~_U(0):
            break
        i += len(rounds)
    return out


def bands(h: np.ndarray, rows: int = ROWS, n: int = BANDS) -> np.ndarray:
    s = sketch(h, rows * n).reshape(n, rows)
    out = np.arange(n, dtype=_U)
    for k in range(rows):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + s[:, k])
    return out


def _prepared(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, n (set size), k1, k2 (128 bits of the set), bands."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def prepare(batches):
        import pyarrow as pa

        for b in batches:
            n, k1, k2, rows_ = [], [], [], []
            for text in b.column(1).to_pylist():
                h = shingles(text, width)
                n.append(len(h))
                k1.append(int(_mix(h).sum(dtype=_U).astype(np.int64)))
                k2.append(int(_mix(h ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).astype(np.int64)))
                rows_.append(bands(h).view(np.int64) if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(rows_, pa.list_(pa.int64()))], ["doc_id", "n", "k1", "k2", "bands"])

    return spool(rows.mapInArrow(prepare, f"doc_id {kind.simpleString()}, n long, k1 long, k2 long, bands array<long>"), "sketches")


def verify(pairs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """pairs (a, b) of doc_ids -> (a, b, common, total, lacks, has): sizes of intersection and union of their full sets; bitmaps of what a lacks of b and has besides it. b may be a hub."""
    ids = spool(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    own = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = spool(rows.join(own, "doc_id", "left_semi"), "texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def compare(batches):
        import pyarrow as pa

        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            common, total, lacks, has = [], [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if len(kept) > 64:
                    kept.clear()
                hx = shingles(x, width)
                hy = kept.get(y)
                if hy is None:
                    hy = kept[y] = shingles(y, width)
                c = len(np.intersect1d(hx, hy, assume_unique=True))
                common.append(c)
                total.append(len(hx) + len(hy) - c)
                lacks.append(_bitmap(np.setdiff1d(hy, hx, assume_unique=True), LACKS))
                has.append(_bitmap(np.setdiff1d(hx, hy, assume_unique=True), HAS))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64()), pa.array(lacks, kind), pa.array(has, kind)], ["a", "b", "common", "total", "lacks", "has"])

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(compare, f"a {kind}, b {kind}, common long, total long, lacks array<long>, has array<long>")


def _bitmap(h: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words, _U)
    bit = _mix(h ^ _U(0xA0761D6478BD642F)) % _U(64 * words)
    np.bitwise_or.at(out, (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
    return out.view(np.int64)


def _sides(s: str) -> list:
    """Columns of one side of a pair, as plain longs: a join's condition over arrays is too long a method to be compiled."""
    word = lambda name, k, other: F.coalesce(F.get(name, F.lit(k)), F.lit(other).cast("long"))
    return [
        *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "pivot_n", "component")), F.coalesce(F.col("n") - F.col("common"), "n").alias(f"beside_{s}"),
        *(word("lacks", k, 0).alias(f"lacks{k}_{s}") for k in range(LACKS)), *(word("has", k, 0).alias(f"has{k}_{s}") for k in range(HAS)), *(word("has", k, -1).alias(f"may{k}_{s}") for k in range(HAS)),
    ]


def _reach():
    """The most that the sets of x and y can have in common, by their pivot p: |p| less what either lacks of it, and of what
    they have besides p no more than one's less those that the other surely hasn't. A bitmap never shows more elements than
    there are, and a set that wasn't compared with the pivot may lack nothing and have anything, so no link is lost."""
    bits = lambda f, words: sum((F.bit_count(f(k)).cast("long") for k in range(words)), F.lit(0).cast("long"))
    lacked = bits(lambda k: F.col(f"lacks{k}_a").bitwiseOR(F.col(f"lacks{k}_b")), LACKS)
    only = lambda x, y: bits(lambda k: F.col(f"has{k}_{x}").bitwiseAND(F.bitwise_not(f"may{k}_{y}")), HAS)
    return F.col("pivot_n_a") - lacked + F.least(F.col("beside_a") - only("a", "b"), F.col("beside_b") - only("b", "a"))


def near_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Documents link where 100 * intersection >= percent * union of their sets of `width`-word shingles. Null and empty
    texts, and texts of white space, have no shingles and no links. Rows with a null doc_id are kept and link with
    nothing (component_id null). Rows of the same doc_id count as one document for linking. An empty table gives no rows.
    """
    rows = rows_of(docs, id_col, text_col)
    prepared = _prepared(rows, width)
    sets = spool(prepared.filter("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands")), "sets")

    # members of buckets that have more than one
    members = sets.select(F.col("node"), F.col("n"), F.posexplode("bands").alias("band", "hash")).select("node", "n", F.xxhash64("band", "hash").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = spool(members.join(sizes, "bucket"), "buckets")

    # pivots: who shares most
    weight = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    pivots = shared.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("p")).select("bucket", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"))
    shared = spool(shared.join(pivots, "bucket"), "pivots")
    near = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))  # noqa: E731  else too unlike in size
    stars = shared.filter("node <> pivot").filter(near(F.col("n"), F.col("pivot_n"))).select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    first = spool(verify(spool(stars, "pairs"), rows, width), "verified")
    links = first.filter(f"100 * common >= {percent} * total").select("a", "b")
    labels = connected_components(links)

    # what is left: of those that met one pivot, pairs in different components; two that share a bucket share its pivot
    met = shared.filter("node <> pivot").select("pivot", "node", "n", "pivot_n").distinct()
    own = met.join(first.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "common", "lacks", "has"), ["node", "pivot"], "left")
    own = own.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = own.groupBy("pivot").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most").select("pivot")
    open_ = spool(own.join(mixed, "pivot"), "open")
    # the members of a pivot are dealt into parts of about PART, each of which meets all others: no task has them all
    parts = open_.groupBy("pivot").agg((F.count("*") / PART).cast("int").alias("last")).filter("last > 0")
    dealt = open_.join(parts, "pivot", "left").withColumn("last", F.coalesce("last", F.lit(0)))
    x = dealt.select("pivot", F.pmod(F.xxhash64("node"), F.col("last") + 1).cast("int").alias("part"), *_sides("a"))
    y = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("last")))).select("pivot", "part", *_sides("b"))
    can = (100 + percent) * _reach() >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = x.join(y, ["pivot", "part"]).filter("node_a < node_b and component_a <> component_b").filter(near(F.col("n_a"), F.col("n_b"))).filter(can)
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = spool(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    more = spool(verify(pairs, rows, width).filter(f"100 * common >= {percent} * total").select("a", "b"), "links")
    if more.limit(1).count():
        labels = connected_components(links.unionByName(more))

    classes = sets.join(labels, "node", "left").select("k1", "k2", "n", F.coalesce("component", "node").alias("component"))
    found = prepared.drop("bands").join(classes, ["k1", "k2", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def clean(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group, that of the smallest doc_id; all columns stay. Of rows that repeat a doc_id one stays."""
    found = spool(near_components(docs, width, percent, id_col, text_col).select("doc_id", "kept"), "components")
    gone = found.filter("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    twice = spool(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias(id_col)).count().filter("count > 1").select(id_col), "repeated")
    left = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, id_col, "left_anti").select(*docs.columns)
    if not twice.limit(1).count():
        return left
    again = left.join(twice, id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col])
    return left.join(twice, id_col, "left_anti").select(*docs.columns).unionByName(again)
