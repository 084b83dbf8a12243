"""Which points lie in which intervals, as an equi-join: intervals fall into cells of a binary grid, points name theirs.

An interval [start, end) is the union of at most two cells of each size 1, 2, 4 ... (the nodes of a segment tree); a point lies
in one cell of each size. They meet in exactly one cell if the point is in the interval, and in none if not, so no candidate
is ever formed in vain. Rows of one document are dealt over its cells, so a long document is not one key.

A point is named once for each size that intervals have. With `leaf` above 0 no cell is smaller than 2 ** leaf positions: a
leaf that an interval covers in part is a cell of its own kind (PART), where the bounds are compared, so points are named
less often. An interval then also meets points in vain, those in the rest of the two leaves at its ends: of 2 ** (leaf + 1)
positions at most, whatever the document. A leaf of about the usual interval is cheapest; where very many points share a
position leave it 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

LEVELS = 40  # cells of up to 2 ** 39 leaves; longer intervals take more of the largest
PART = -1  # the size of a leaf that is covered in part


def cells(start: Column, end: Column) -> Column:
    """array<struct<size, cell>> of [start, end), which must not begin below 0; none of an empty interval. The cells are disjoint."""
    start, end = start.cast("long"), end.cast("long")

    def of(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        first, last = F.call_function("div", start + size - 1, size), F.call_function("div", end, size)
        left = F.when((first < last) & (first % 2 == 1), F.array(F.struct(k.alias("size"), first.alias("cell"))))
        right = F.when((first < last) & (last % 2 == 1), F.array(F.struct(k.alias("size"), (last - 1).alias("cell"))))
        none = F.array().cast("array<struct<size:int,cell:bigint>>")
        return F.concat(F.coalesce(left, none), F.coalesce(right, none))

    top = F.lit(1).cast("long") * (1 << (LEVELS - 1))
    first, last = F.call_function("div", start + top - 1, top), F.call_function("div", end, top)
    most = F.when(first < last, F.transform(F.sequence(first, F.greatest(first, last - 1)), lambda c: F.struct(F.lit(LEVELS - 1).alias("size"), c.alias("cell"))))
    small = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 2)), of))
    return F.when((start >= 0) & (start < end), F.concat(small, F.coalesce(most, F.array().cast("array<struct<size:int,cell:bigint>>"))))


def _celled(intervals: DataFrame, doc: str, start: str, end: str, leaf: int = 0) -> DataFrame:
    first, last = F.col(start).cast("long"), F.col(end).cast("long")
    if leaf:
        size = F.lit(1 << leaf).cast("long")
        number = lambda x: F.call_function("div", x, size)
        part = F.array_compact(F.array(*[F.when(x % size != 0, number(x)) for x in (first, last)]))
        parts = F.transform(F.array_distinct(part), lambda c: F.struct(F.lit(PART).alias("size"), c.alias("cell")))
        none = F.array().cast("array<struct<size:int,cell:bigint>>")
        own = F.when((first >= 0) & (first < last), F.concat(F.coalesce(cells(number(first + size - 1), number(last)), none), parts))
    else:
        own = cells(first, last)
    return intervals.withColumn("_cell", F.explode(own)).withColumns({"_doc": F.col(doc), "_size": F.col("_cell.size"), "_at": F.col("_cell.cell")}).drop("_cell")


def top(counts: dict[int, int], most: int = 10) -> int:
    """The size that larger cells are split into, by the cells of each size: the smallest for which that at most doubles them, none into more than 2 ** most.

    A few long intervals would else have every point named by their sizes too.
    """
    whole = {k: n for k, n in counts.items() if k != PART}
    fits = [t for t in range(max(whole, default=0)) if max(whole) - t <= most and sum(n << (k - t) for k, n in whole.items() if k > t) <= sum(counts.values())]
    return min(fits, default=max(whole, default=0))


def _split(own: DataFrame) -> tuple[DataFrame, list[int]]:
    """Cells none of which is above `top`, and the sizes that are left; the counts by size, LEVELS + 1 at most, come to the driver."""
    counts = {r["_size"]: r["count"] for r in own.groupBy("_size").count().collect()}
    t = top(counts)
    if t == max(counts, default=t):
        return own, sorted(counts)
    shift = lambda x: F.call_function("shiftleft", x, F.col("_size") - t)
    small = F.when(F.col("_size") > t, F.sequence(shift(F.col("_at")), shift(F.col("_at") + 1) - 1)).otherwise(F.array("_at"))
    return own.withColumn("_at", F.explode(small)).withColumn("_size", F.least("_size", F.lit(t))), sorted({min(k, t) for k in counts})


def _named(points: DataFrame, sizes: DataFrame | list[int], doc: str, at: str, leaf: int = 0) -> DataFrame:
    """Each point with its cell of each size that intervals have: LEVELS sizes and PART at most."""
    known = sizes if isinstance(sizes, list) else [r["_size"] for r in sizes.select("_size").distinct().collect()]
    each = points.withColumn("_size", F.explode(F.array(*[F.lit(k).cast("int") for k in sorted(known)]) if known else F.array().cast("array<int>")))
    cell = F.call_function("div", F.col(at).cast("long"), F.expr(f"shiftleft(1L, greatest(_size, 0) + {leaf})"))
    return each.withColumns({"_doc": F.col(doc), "_at": cell}).filter(F.col(at) >= 0)


def holding(points: DataFrame, intervals: DataFrame, doc: str = "doc", at: str = "at", start: str = "start", end: str = "end", leaf: int = 0) -> DataFrame:
    """Every pair of a point and an interval of its document with start <= at < end: the points' columns and the intervals' but for doc.

    Columns other than doc must have different names. Intervals that are empty, begin below 0 or have a null bound hold
    nothing; a null doc is no document. Repeated points and intervals each make pairs of their own.
    """
    own, sizes = _split(_celled(intervals, doc, start, end, leaf).drop(doc))
    met = _named(points, sizes, doc, at, leaf).join(own, ["_doc", "_size", "_at"])
    if leaf:
        met = met.filter((F.col("_size") != PART) | ((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))))
    return met.drop("_doc", "_size", "_at")


def covered(points: DataFrame, intervals: DataFrame, doc: str = "doc", at: str = "at", start: str = "start", end: str = "end", leaf: int = 0) -> DataFrame:
    """points with covered: whether some interval of the document holds the point, however many do."""
    bound = lambda c: F.when(F.col("_size") == PART, F.col(c))
    own, sizes = _split(_celled(intervals.select(doc, start, end), doc, start, end, leaf))
    own = own.select("_doc", "_size", "_at", bound(start).alias("_start"), bound(end).alias("_end")).distinct()
    named = _named(points.select(doc, at).distinct(), sizes, doc, at, leaf).alias("p")
    same = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in ("_doc", "_size", "_at")]
    if leaf:
        same.append((F.col("p._size") != PART) | ((F.col(f"p.{at}") >= F.col("i._start")) & (F.col(f"p.{at}") < F.col("i._end"))))
    inside = named.join(own.alias("i"), same, "left_semi").select(F.col("_doc").alias(doc), at).distinct()
    return points.join(inside.withColumn("covered", F.lit(True)), [doc, at], "left").withColumn("covered", F.coalesce("covered", F.lit(False))).select(*points.columns, "covered")


def widest(intervals: DataFrame, doc: str = "doc", start: str = "start", end: str = "end", stays: Column | None = None) -> DataFrame:
    """Intervals without those that the last one kept before them covers, in order of start, the longer first; rows with `stays` are kept though covered, if they begin later.

    What is kept and not covered ends behind all before it, so the last one kept without `stays` is the one with the greatest
    end so far: a running maximum says it. Rows equal in start and end stay once, but for those with `stays`.
    """
    order = W.partitionBy(doc).orderBy(F.col(start), F.col(end).desc()).rowsBetween(W.unboundedPreceding, -1)
    before = F.max(F.struct(F.col(end).alias("end"), (-F.col(start)).alias("start"))).over(order)
    out = intervals.withColumn("_last", before)
    hidden = F.col("_last").isNotNull() & (F.col(end) <= F.col("_last.end"))
    if stays is not None:
        hidden = hidden & ~(F.coalesce(stays, F.lit(False)) & (F.col(start) > -F.col("_last.start")))
    return out.filter(~hidden).drop("_last")
