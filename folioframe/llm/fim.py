"""Fill-in-the-middle transformation: cut points by a parallel automaton scan.

A token is white space and what follows it up to the next white space, so one automaton over bytes finds both the ends of
tokens and the three markers. A stretch of text acts on its four states as a function (the state in which it leaves each
state) with two counts for each state in which it may begin (ends of tokens, markers). Such functions compose, whatever
the order of composition:

- within a stretch, those of four bytes each come from a table and are composed pairwise, level by level;
- a text longer than a chunk is cut into chunks that are dealt over the tasks; each gives its function, which are
  composed by groups of `FAN` until one is left for each text. The k-th end of a token is then found downwards: each level
  names the group, the chunk and at last the byte, and nothing but the chunks that hold a cut is read again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import rows_of, spool

CHUNK = 32768  # bytes; longer texts are scanned in chunks
FAN = 256  # functions composed at once
MARKERS = ("<P>", "<S>", "<M>")

#: Kinds of bytes: 0 white space, 1 <, 2 the letter of a marker, 3 >, 4 all others, 5 nothing (fills up the last four).
_KIND = np.full(256, 4, np.int32)
_KIND[[0x20, 9, 10, 11, 12, 13]], _KIND[ord("<")], _KIND[[ord(m[1]) for m in MARKERS]], _KIND[ord(">")] = 0, 1, 2, 3
#: States: 0 at the start or after white space, 1 in a token, 2 after <, 3 after < and a marker's letter.
_NEXT = np.array([[0, 2, 1, 1, 1, 0], [0, 2, 1, 1, 1, 1], [0, 2, 3, 1, 1, 2], [0, 2, 1, 1, 1, 3]])
_ENDS = np.array([[0] * 6] + [[1, 0, 0, 0, 0, 0]] * 3)
_MARKS = np.array([[0] * 6] * 3 + [[0, 0, 0, 1, 0, 0]])
_STATES = np.arange(4)


def _then(a: tuple, b: tuple) -> tuple:
    """Functions a[i] and then b[i]: (states left in, ends, markers), each an array of one row a function."""
    at = a[0] + 4 * np.arange(len(a[0]), dtype=np.int32)[:, None]
    return np.take(b[0].ravel(), at), a[1] + np.take(b[1].ravel(), at), a[2] + np.take(b[2].ravel(), at)


def _of_kinds(kinds: np.ndarray) -> tuple:
    return tuple(t[:, kinds].T.astype(np.int32) for t in (_NEXT, _ENDS, _MARKS))


def _fours() -> tuple:
    """The functions of all rows of four kinds."""
    every = np.arange(6**4)
    out = _of_kinds(every // 216)
    for power in (36, 6, 1):
        out = _then(out, _of_kinds(every // power % 6))
    return out


_FOURS = _fours()


class Scan:
    """The functions of a stretch of text, at every level of composition."""

    def __init__(self, data: bytes):
        self.data = data
        kinds = np.full(max(4, -(-len(data) // 4) * 4), 5, np.int32)
        kinds[: len(data)] = _KIND[np.frombuffer(data, np.uint8)]
        code = kinds.reshape(-1, 4) @ np.array([216, 36, 6, 1], np.int32)
        level = tuple(t[code] for t in _FOURS)
        self.levels = [level]
        while len(level[0]) > 1:
            if len(level[0]) % 2:
                level = tuple(np.concatenate((x, y)) for x, y in zip(level, (_STATES.astype(np.int32)[None], *[np.zeros((1, 4), np.int32)] * 2), strict=True))
                self.levels[-1] = level
            level = _then(tuple(x[0::2] for x in level), tuple(x[1::2] for x in level))
            self.levels.append(level)
        self.next, self.ends, self.marks = (x[0] for x in level)

    def select(self, state: int, k: int) -> int:
        """The byte before which the k-th token ends (counted from 1), for a stretch that begins in `state`."""
        at = 0
        for nexts, ends, _ in reversed(self.levels[:-1]):
            at *= 2
            if k > ends[at, state]:
                k, state, at = k - ends[at, state], nexts[at, state], at + 1
        for i in range(4 * at, 4 * at + 4):
            kind = _KIND[self.data[i]]
            k -= _ENDS[state, kind]
            if not k:
                return i
            state = _NEXT[state, kind]
        raise ValueError("fewer ends than asked for")


def _scan_text(text: str, first: int, second: int, wanted: bool) -> tuple:
    """(n, marked, characters before the first cut, before the second)."""
    data = text.encode()
    scan = Scan(data)
    n = int(scan.ends[0]) + 1 if data else 0
    if scan.marks[0] or not wanted or not data:
        return n, bool(scan.marks[0]), None, None
    at = [0 if k == 0 else len(data) if k == n else scan.select(0, k) for k in sorted((first % (n + 1), second % (n + 1)))]
    return n, False, len(data[: at[0]].decode()), len(data[: at[1]].decode())


_SCAN = "n long, marked boolean, first long, second long"


def _scanned(text: Column, first: Column, second: Column, wanted: Column) -> Column:
    @F.arrow_udf(StructType.fromDDL(_SCAN))
    def scan(texts, ones, twos, flags):
        import pyarrow as pa

        rows = [_scan_text(t.as_py(), a, b, w) for t, a, b, w in zip(texts, ones.to_pylist(), twos.to_pylist(), flags.to_pylist(), strict=True)]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.bool_(), pa.int64(), pa.int64()), strict=True)] if rows else [pa.array([], k) for k in (pa.int64(), pa.bool_(), pa.int64(), pa.int64())]
        return pa.StructArray.from_arrays(columns, ["n", "marked", "first", "second"])

    return scan(text, first, second, wanted)


def _compose(functions: Column) -> Column:
    """One function of an array of functions in order."""
    start = F.struct(F.array(*(F.lit(s) for s in range(4))).alias("next"), F.array_repeat(F.lit(0).cast("long"), 4).alias("ends"), F.array_repeat(F.lit(0).cast("long"), 4).alias("marks"), F.lit(0).cast("long").alias("chars"))

    def then(a, b):
        def plus(name):
            return F.zip_with(a[name], a["next"], lambda x, s: x + b[name][s]).alias(name)

        return F.struct(F.transform(a["next"], lambda s: b["next"][s]).alias("next"), plus("ends"), plus("marks"), (a["chars"] + b["chars"]).alias("chars"))

    return F.aggregate(functions, start, then)


def _chunks(long_: DataFrame, chunk: int) -> DataFrame:
    """(row, at, text): chunks of about so many bytes, cut between characters, dealt over the tasks and written once."""

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data, at, begin = text.as_buffer(), 0, 0
                data = data.to_pybytes()
                while begin < len(data):
                    end = min(len(data), begin + chunk)
                    while end < len(data) and data[end] & 0xC0 == 0x80:
                        end += 1
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([at], pa.int64()), pa.array([data[begin:end].decode()])], ["row", "at", "text"])
                    begin, at = end, at + 1

    return spool(long_.select("row", "text").mapInArrow(cut, "row long, at long, text string").repartition("row", "at"), "chunks")


def _functions(chunks: DataFrame) -> DataFrame:
    """(row, at, f): the function of each chunk."""

    def scan(batches):
        import pyarrow as pa

        for b in batches:
            scans = [(Scan(t.encode()), len(t)) for t in b.column(2).to_pylist()]
            fs = [{"next": s.next.tolist(), "ends": s.ends.tolist(), "marks": s.marks.tolist(), "chars": n} for s, n in scans]
            kind = pa.struct([("next", pa.list_(pa.int32())), ("ends", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("chars", pa.int64())])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fs, kind)], ["row", "at", "f"])

    return spool(chunks.mapInArrow(scan, "row long, at long, f struct<next: array<int>, ends: array<long>, marks: array<long>, chars: long>"), "functions")


def _cuts_of_long(long_: DataFrame, chunk: int, fan: int) -> DataFrame:
    """(row, n, marked, first, second) of texts that are scanned in chunks: functions are composed upwards, cuts are found downwards."""
    chunks = _chunks(long_, chunk)
    level, groups = _functions(chunks), []
    most = level.agg(F.max("at")).first()[0] or 0
    while most > 0 or not groups:
        group = level.groupBy("row", F.floor(F.col("at") / fan).alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "f"))).alias("parts"))  # at most `fan`
        group = spool(group.withColumn("f", _compose(F.transform("parts", lambda p: p["f"]))), "composed")
        groups.append(group)
        level, most = group.select("row", "at", "f"), most // fan
    whole = level.select("row", (F.col("f.ends")[0] + 1).alias("n"), (F.col("f.marks")[0] > 0).alias("marked"), F.col("f.chars").alias("chars"))
    sizes = long_.select("row", "h1", "h2", "wanted").join(whole, "row")
    tops = spool(sizes.withColumns({"a": F.col("h1") % (F.col("n") + 1), "b": F.col("h2") % (F.col("n") + 1)}), "cuts")
    # one row a cut: k ends of tokens are still to pass from chunk or group `at` on, entered in `state` after `before` characters
    todo = tops.filter("wanted and not marked").select("row", "n", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.least("a", "b").alias("k")), F.struct(F.lit(1).alias("which"), F.greatest("a", "b").alias("k")))).alias("c"))
    todo = todo.filter("c.k > 0 and c.k < n").select("row", "c.which", "c.k", F.lit(0).cast("long").alias("at"), F.lit(0).alias("state"), F.lit(0).cast("long").alias("before"))
    for group in reversed(groups):

        def step(a, p):
            here = p["f"]["ends"][a["state"]]
            passed = (a["at"] < 0) & (a["k"] > here)
            return F.struct(
                F.when(passed, a["k"] - here).otherwise(a["k"]).alias("k"),
                F.when(passed | (a["at"] >= 0), a["at"]).otherwise(p["at"]).alias("at"),
                F.when(passed, p["f"]["next"][a["state"]]).otherwise(a["state"]).alias("state"),
                F.when(passed, a["before"] + p["f"]["chars"]).otherwise(a["before"]).alias("before"),
            )

        start = F.struct("k", F.lit(-1).cast("long").alias("at"), "state", "before")
        todo = todo.join(group.select("row", "at", "parts"), ["row", "at"]).withColumn("s", F.aggregate("parts", start, step)).select("row", "which", "s.k", "s.at", "s.state", "s.before")

    def select(batches):
        import pyarrow as pa

        for b in batches:
            row, which, k, state, before, text = (c.to_pylist() for c in b.columns)
            found = [p + len((data := t.encode())[: Scan(data).select(s, n)].decode()) for n, s, p, t in zip(k, state, before, text, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.int64())], ["row", "which", "chars"])

    held = todo.join(chunks, ["row", "at"]).select("row", "which", "k", "state", "before", "text").mapInArrow(select, "row long, which int, chars long")
    cuts = held.groupBy("row").agg(F.max(F.when(F.col("which") == 0, F.col("chars"))).alias("x"), F.max(F.when(F.col("which") == 1, F.col("chars"))).alias("y"))

    def place(k, found):
        return F.when(F.col("wanted") & ~F.col("marked"), F.when(k == 0, 0).when(k == F.col("n"), F.col("chars")).otherwise(found))

    return tops.join(cuts, "row", "left").select("row", "n", "marked", place(F.least("a", "b"), F.col("x")).cast("long").alias("first"), place(F.greatest("a", "b"), F.col("y")).cast("long").alias("second"))


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Each document transformed: doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars, output.

    Where a document is cut, and in which form it is written, comes of the SHA-256 of `seed:doc_id` alone. Null texts
    count as empty; empty texts and texts that hold a marker stay plain. A null id counts as an empty one. Repeated rows
    are each transformed, equal ids alike. Texts of any length are scanned whole; the one bound is that of a Spark string.
    Other columns of docs are not looked at. An empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    rows = rows_of(docs, id_col, text_col).withColumns({"h1": h[0], "h2": h[1], "wanted": h[2] % 100 < rate, "spm": h[3] % 100 < spm_rate})
    large = F.octet_length("text") > chunk
    short = rows.filter(~large).withColumn("scan", _scanned(F.col("text"), F.col("h1"), F.col("h2"), F.col("wanted")))
    short = short.select("doc_id", "text", "spm", "scan.*")
    long_ = spool(rows.filter(large).withColumn("row", F.monotonically_increasing_id()), "long")
    joined = long_.join(_cuts_of_long(long_, chunk, fan), "row").select(short.columns)
    first, second = F.col("first").cast("int"), F.col("second").cast("int")
    prefix, middle = F.substring(F.col("text"), F.lit(1), first), F.substring(F.col("text"), first + 1, second - first)
    suffix = F.substring(F.col("text"), second + 1, F.length("text"))
    p, s, m = (F.lit(x) for x in MARKERS)
    form = F.when(F.col("first").isNull(), "plain").when(F.col("spm"), "spm").otherwise("psm")
    output = F.when(form == "plain", F.col("text")).when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    return short.unionByName(joined).select("doc_id", "n", form.alias("form"), F.col("first").alias("prefix_chars"), (F.col("second") - F.col("first")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text of an output and its form alone; parts hold no marker, so each stands once."""
    p, s, m = MARKERS

    def between(begin: str, end: str | None) -> Column:
        rest = F.substring_index(output, begin, -1)
        return F.substring_index(rest, end, 1) if end else rest

    return F.when(form == "plain", output).when(form == "psm", F.concat(between(p, s), between(m, None), between(s, m))).otherwise(F.concat(between(p, m), between(m, None), between(s, p)))
