"""Structured Streaming: blocks as documents arrive, and back-off levels kept for each key."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pressure import STEPS, cooldown

if TYPE_CHECKING:
    import pandas as pd


def arriving(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).parquet(folder)


def ingest(stream: DataFrame, path: str, checkpoint: str):
    """Append what has arrived and stop; what is done is in the checkpoint, so a second run takes only what is new."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def levels(events: DataFrame) -> DataFrame:
    """A stream (key string, seq long, delta int) -> key, seq, level, cooldown. The state of a key is its level; within a batch events count in order of seq."""
    import pandas as pd

    top = len(STEPS) - 1

    def fold(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        level = state.get[0] if state.exists else 0
        pdf = pd.concat(list(batches)).sort_values("seq")  # one key's events of one micro-batch
        out = []
        for d in pdf["delta"]:
            level = min(max(level + int(d), 0), top)
            out.append(level)
        state.update((level,))
        yield pd.DataFrame({"key": pdf["key"], "seq": pdf["seq"], "level": pd.array(out, "int32")})

    kept = events.groupBy("key").applyInPandasWithState(fold, "key string, seq long, level int", "level int", "append", "NoTimeout")
    return kept.withColumn("cooldown", cooldown(F.col("level")))


class _Timed:
    """Levels and cooldowns of the keys of a bucket by event time. Events wait until the watermark has passed them, so that they count in order; a repeated one takes the place of the first, or is late.

    The state of a bucket goes to Python and back with its events, once a batch; its timer stands at what comes first, a
    waiting event or the end of a cooldown of one of its keys.
    """

    state = "keys array<string>, levels array<int>, untils array<long>, waiting binary"
    event = [("key", "<i4"), ("at", "<i8"), ("seq", "<i8"), ("delta", "<i4")]  # key: its place in keys

    def __init__(self, seconds: float):
        self.seconds = seconds

    def __call__(self, bucket, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        import numpy as np
        import pandas as pd

        keys, levels, untils, waiting = state.get if state.exists else ((), (), (), b"")
        places = {k: i for i, k in enumerate(keys)}
        waiting = [np.frombuffer(waiting, self.event)]
        for pdf in batches:
            came = np.empty(len(pdf), self.event)
            came["key"] = [places.setdefault(k, len(places)) for k in pdf["key"]]
            for name, c in zip(("at", "seq", "delta"), ("micros", "seq", "delta"), strict=True):
                came[name] = pdf[c].to_numpy()
            waiting.append(came)
        waiting = np.concatenate(waiting)
        waiting = waiting[np.lexsort((waiting["seq"], waiting["at"], waiting["key"]))]  # stable: of repeated ones the last stays
        last = np.ones(len(waiting), bool)
        for i, name in enumerate(("key", "at", "seq")):
            differs = waiting[name][1:] != waiting[name][:-1]
            last[:-1] = differs if i == 0 else last[:-1] | differs
        waiting = waiting[last]
        watermark = state.getCurrentWatermarkMs()
        due = waiting["at"] <= watermark * 1000
        keys, levels, untils = list(places), [*levels, *[0] * (len(places) - len(levels))], [*untils, *[None] * (len(places) - len(untils))]
        out = self.fold(levels, untils, waiting[due].tolist(), watermark * 1000)
        waiting = waiting[~due]
        first = [u for u in untils if u is not None] + ([int(waiting["at"].min())] if len(waiting) else [])
        if first:
            state.setTimeoutTimestamp(max(-(-min(first) // 1000) - 1, watermark + 1))  # fires when the watermark is beyond
        state.update((keys, levels, untils, waiting.tobytes()))
        if out:
            key, seq, micros, kind, level, until = zip(*out, strict=True)
            yield pd.DataFrame({"key": [keys[k] for k in key], "seq": pd.array(seq, "Int64"), "micros": micros, "kind": kind, "level": pd.array(level, "int32"), "until": pd.array(until, "Int64")})

    def fold(self, levels: list, untils: list, due: list, passed: int) -> list:
        """The rows of the events (key, at, seq, delta) that are due, each key's in order, and of the cooldowns that have run out; levels and untils are what holds then."""
        out = []
        for k, at, seq, delta in due:
            if untils[k] is not None and untils[k] <= at:
                out.append((k, None, untils[k], "expired", levels[k], None))
                untils[k] = None
            levels[k] = min(max(levels[k] + delta, 0), len(STEPS) - 1)
            if delta > 0 and STEPS[levels[k]]:
                untils[k] = at + int(STEPS[levels[k]] * self.seconds * 1_000_000)
            out.append((k, seq, at, "event", levels[k], untils[k]))
        for k, until in enumerate(untils):
            if until is not None and until <= passed:
                out.append((k, None, until, "expired", levels[k], None))
                untils[k] = None
        return out


def timed(events: DataFrame, seconds: float = 1.0, late: str = "1 hour", buckets: int = 1024) -> DataFrame:
    """A stream of (key string, seq long, at timestamp, delta int) -> key, seq, at, kind, level, until, as pressure.deadlines gives them.

    Levels, cooldowns and waiting events are kept by key, the keys in so many `buckets`; a bucket is what goes to Python at
    once, 24 bytes for each event that waits, and the number can't change for a checkpoint. A cooldown that runs out gives its
    row when the watermark has passed its end, also if no further event of the key ever comes. Events may come `late` by so
    much, in any order and repeatedly; those that are later still, and those without a key, a time or a number, are left
    out. State that outgrows memory asks for the RocksDB state store (state_store()).
    """
    own = events.select("key", "seq", "at", F.unix_micros("at").alias("micros"), F.coalesce("delta", F.lit(0)).alias("delta"), F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    own = own.dropna(subset=["key", "seq", "at"]).withWatermark("at", late)
    kept = own.groupBy("bucket").applyInPandasWithState(_Timed(seconds), "key string, seq long, micros long, kind string, level int, until long", _Timed.state, "append", "EventTimeTimeout")
    return kept.select("key", "seq", F.timestamp_micros("micros").alias("at"), "kind", "level", F.timestamp_micros("until").alias("until"))


def state_store(spark: SparkSession) -> None:
    """The state store that keeps states on disk, for queries started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
