"""Count-based sliding windows over the blocks of a document, in closed form: no join of positions with windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _clamped(size: int, stride: int) -> tuple[int, int]:
    return max(1, size), max(1, stride)


def _window_count(n, size: int, stride: int):
    """Windows start at 0, stride, ...; the first that reaches the end is the last, and none starts beyond it."""
    over = F.greatest(n - size, F.lit(0))
    return F.when(n > 0, 1 + F.least(F.ceil(over / stride), F.floor((n - 1) / stride))).otherwise(0).cast("int")


def _identified(df: DataFrame) -> DataFrame:
    return df.withColumn("window_id", F.format_string("w%04d", "window_index"))


def windows(stream: DataFrame, size: int = 5, stride: int = 3) -> DataFrame:
    """stream (doc, pos) -> doc, window_index, window_id, start_index, end_index (exclusive), window_size."""
    size, stride = _clamped(size, stride)
    n = stream.groupBy("doc").agg(F.count("*").cast("int").alias("n"))
    out = n.select("doc", "n", F.explode(F.sequence(F.lit(0), _window_count(F.col("n"), size, stride) - 1)).alias("window_index"))
    start = F.col("window_index") * stride
    end = F.least(start + size, F.col("n"))
    return _identified(out.select("doc", "window_index", start.alias("start_index"), end.alias("end_index"), (end - start).alias("window_size")))


def membership(stream: DataFrame, size: int = 5, stride: int = 3) -> DataFrame:
    """Each block once for each window that holds it: stream's columns, window_index, window_id, pos_in_window."""
    size, stride = _clamped(size, stride)
    n = F.count("*").over(W.partitionBy("doc"))
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - size + 1) / stride)).cast("int")
    last = F.least(F.floor(F.col("pos") / stride).cast("int"), _window_count(n, size, stride) - 1)
    numbered = stream.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    out = numbered.withColumn("window_index", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    return _identified(out.withColumn("pos_in_window", F.col("pos") - F.col("window_index") * stride))


def expand(windows_: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Windows grown to `size` blocks, evenly to both sides; what a document's edge cuts off is made up first to the left, then to the right. counts: doc, n."""
    df = windows_.join(counts, "doc")
    s, e, n = F.col("start_index"), F.col("end_index"), F.col("n")
    extra = F.greatest(F.lit(size) - (e - s), F.lit(0))
    left = F.floor(extra / 2)
    s1, e1 = F.greatest(F.lit(0), s - left), F.least(n, e + extra - left)
    lack = F.greatest(F.least(F.lit(size), n) - (e1 - s1), F.lit(0))
    s2 = s1 - F.least(s1, lack)
    e2 = F.least(n, e1 + lack - (s1 - s2))
    return df.select("doc", "window_index", "window_id", s2.cast("int").alias("start_index"), e2.cast("int").alias("end_index"), (e2 - s2).cast("int").alias("window_size"))
