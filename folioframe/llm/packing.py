"""Best-fit packing of token pieces into sequences, after Martello and Toth's dominance reduction.

Pieces are at most `capacity` ids long, so the instance is a histogram of at most `capacity` lengths, whatever the
corpus. The driver solves that histogram:

1. Reduction. A set that holds the longest open piece is fixed for good where it dominates every other set that could
   hold it: no partner fits; an exact partner fills the sequence; one partner at most fits (take the longest); or two
   at most fit and the longest partner outweighs, or covers one by one, every pair.
2. What remains is packed best-fit decreasing.

The pieces are ranked within their length (in salted cells, so that no length lands in one task) and each rank range
is looked up in the plan, whose size is bounded by the number of lengths and not by the number of documents.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import rows_of, spool
from .tokens import by_chars, default_tokenizer, encoder

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document of n ids: pieces of `capacity`, the first may be shorter."""
    first = n - capacity * ((n - 1) // capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, if asked for). Null texts count as empty: one piece that holds the end id."""
    tokenizer = tokenizer or default_tokenizer()
    rows = rows_of(docs, id_col, text_col)
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()) + (", ids array<int>" if with_ids else "")

    def pieces(batches):
        import pyarrow as pa

        kinds = None
        code = encoder(tokenizer)
        for keys, texts in by_chars(batches):
            ids, offsets = code.encode(texts)
            out: list[list] = [[], [], [], [], []]
            own = []
            for k, key in enumerate(keys):
                doc = np.append(ids[offsets[k] : offsets[k + 1]], np.uint32(end_id)).astype("<u4")
                for p, (s, n) in enumerate(cut_points(len(doc), capacity)):
                    for column, x in zip(out, (key, p, s, n, zlib.crc32(doc[s : s + n].tobytes())), strict=True):
                        column.append(x)
                    if with_ids:
                        own.append(doc[s : s + n].astype(np.int32))
            kinds = kinds or [rows_kind, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(own, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    from pyspark.sql.pandas.types import to_arrow_type

    rows_kind = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(pieces, schema)


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Martello and Toth's reduction on a histogram: (fixed sets with how often each, what remains)."""
    counts = {n: c for n, c in counts.items() if c}
    fixed = []

    def fitting(room: int, sizes: list[int], without: int, most: int) -> list[int]:
        """The `most` shortest open pieces, but for one of length `without`, as far as they fit into room."""
        out = []
        for n in sizes:
            for _ in range(min(most - len(out), counts[n] - (n == without))):
                if n > room:
                    return out
                room -= n
                out.append(n)
            if len(out) == most or n > room:
                break
        return out

    def longest(room: int, sizes: list[int], taken: tuple[int, ...]) -> int:
        at = bisect.bisect_right(sizes, room)
        while at and counts[sizes[at - 1]] <= taken.count(sizes[at - 1]):
            at -= 1
        return sizes[at - 1] if at else 0

    for n in sorted(counts, reverse=True):
        while counts.get(n):
            sizes = sorted(k for k in counts if k <= max(n, capacity - n))
            room = capacity - n
            mate = longest(room, sizes, (n,))
            few = fitting(room, sizes, n, 3)  # that many pieces at most can join n
            if not mate:
                chosen = (n,)
            elif mate == room or len(few) == 1:
                chosen = (n, mate)
            elif len(few) == 2:
                third = longest(room - mate, sizes, (n, mate))
                # every feasible pair is within the mate's length together, or piece by piece within (mate, third)
                above = [k for k in sizes if k > third and counts[k] > (k == n)][:2]
                least = above[0] * 2 if above and counts[above[0]] - (above[0] == n) > 1 else sum(above) if len(above) == 2 else capacity + 1
                pair = max((a + longest(room - a, sizes, (n, a)) for a in sizes if a < room and longest(room - a, sizes, (n, a))), default=0)
                if pair <= mate:
                    chosen = (n, mate)
                elif third and least > room:
                    chosen = (n, mate, third)
                else:
                    break
            else:
                break
            times = min(counts[k] // chosen.count(k) for k in set(chosen))
            if len(chosen) > 2 or (len(chosen) == 2 and mate != room):
                times = max(1, min(times, min((counts[k] - 4) // chosen.count(k) for k in set(chosen))))  # the argument holds while the same few pieces are open
            fixed.append((chosen, times))
            for k in chosen:
                counts[k] -= times
            for k in set(chosen):
                if not counts[k]:
                    del counts[k]
    return fixed, counts


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: sequences of equal content are packed together."""
    rooms: list[int] = []
    open_: dict[int, list[list]] = {}

    def put(room: int, content: tuple[int, ...], times: int) -> None:
        if times:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append([content, times])

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = bisect.bisect_left(rooms, n)
            room = rooms[at] if at < len(rooms) else capacity
            each = room // n
            content, times = open_[room].pop() if at < len(rooms) else ((), -(-left // each))
            if at < len(rooms) and not open_[room]:
                del open_[room], rooms[at]
            full = min(times, left // each)
            put(room - each * n, content + (n,) * each, full)
            left -= full * each
            times -= full
            if times and left:  # the last one takes what is left
                put(room - left * n, content + (n,) * left, 1)
                left, times = 0, times - 1
            if content:
                put(room, content, times)
    return [(content, times) for room in rooms for content, times in open_[room]]


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, rest = reduce_dominated(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Of each length, rows (first rank, ranks in each sequence, first sequence, offset) by first rank."""
    slots: dict[int, list] = {}
    used: dict[int, int] = {}
    base = 0
    for content, times in plan:
        at = 0
        for n in dict.fromkeys(content):
            m = content.count(n)
            slots.setdefault(n, []).append((used.get(n, 0), m, base, at))
            used[n] = used.get(n, 0) + m * times
            at += m * n
        base += times
    return {n: np.array(v, np.int64) for n, v in slots.items()}


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset added.

    Sequences are numbered from 0 and filled gaplessly from offset 0. Pieces longer than capacity are refused;
    repeated rows are packed as often as they occur. An empty table gives no rows. The histogram (at most capacity
    rows) and the plan are on the driver; the pieces never are.
    """
    keys = ["doc_id", "piece"]
    n = pieces.count()
    cells = int(min(max(64, n // 250), 65536))
    salted = pieces.withColumn("_cell", F.pmod(F.xxhash64(*keys, "start"), F.lit(cells)).cast("int"))
    by_cell = spool(salted.groupBy("length", "_cell").agg(F.count("*").alias("_n")), "cells")
    counts = {r["length"]: r["n"] for r in by_cell.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    if counts and max(counts) > capacity:
        raise ValueError(f"a piece of {max(counts)} ids doesn't fit into {capacity}")
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(plan_sequences(counts, capacity)))
    before = by_cell.withColumn("_before", F.sum("_n").over(W.partitionBy("length").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)))
    rank = F.row_number().over(W.partitionBy("length", "_cell").orderBy(*keys, "start"))
    ranked = salted.withColumn("_rank", rank).join(before.select("length", "_cell", "_before"), ["length", "_cell"])
    ranked = ranked.select(*pieces.columns, (F.coalesce("_before", F.lit(0)) + F.col("_rank") - 1).alias("_rank"))

    def place(batches):
        import pyarrow as pa

        for b in batches:
            length, at = b.column(lengths).to_numpy(zero_copy_only=False), b.column(ranks).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for n in np.unique(length):
                rows, s = np.flatnonzero(length == n), slots.value[int(n)]
                k = np.searchsorted(s[:, 0], at[rows], "right") - 1
                inner = at[rows] - s[k, 0]
                sequence[rows] = s[k, 2] + inner // s[k, 1]
                offset[rows] = s[k, 3] + inner % s[k, 1] * n
            kept = [c for i, c in enumerate(b.columns) if i != ranks]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*[x for x in b.schema.names if x != "_rank"], "sequence_id", "offset"])

    lengths, ranks = ranked.columns.index("length"), ranked.columns.index("_rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Whole texts -> packed pieces: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack(spool(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces"), capacity)
