"""Levels and cooldowns by event time: batch against a plain fold, stream against batch."""

import random
import time
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioframe.operators import pressure
from folioframe.session import ship
from folioframe.streaming import backoff

START = datetime(2024, 1, 1)
SCHEMA = "key string, seq long, at timestamp, delta int"


def made(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice("abc"), k, START + timedelta(seconds=rng.choice([0, 1, 5, 10, 20, 300]) + 15 * (k // 3), microseconds=rng.choice([0, 1, 999_999])), rng.choice([1, 1, -1, 0, None])) for k in range(n)]


def folded(events):
    out, state = [], {}
    for key, at, seq, delta in sorted({(k, t, s, d or 0) for k, s, t, d in events if None not in (k, s, t)}):
        level, until = state.get(key, (0, None))
        if until is not None and until <= at:
            out.append((key, None, until, "expired", level, None))
            until = None
        level = min(max(level + delta, 0), 5)
        if delta > 0:
            until = at + timedelta(seconds=pressure.STEPS[level])
        out.append((key, seq, at, "event", level, until))
        state[key] = level, until
    out += [(k, None, until, "expired", level, None) for k, (level, until) in state.items() if until is not None]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("key", "seq", "at", "kind", "level", "until").collect()), key=repr)


def table(spark, events):
    plain = [(k, s, None if t is None else int(t.replace(tzinfo=UTC).timestamp()) * 1_000_000 + t.microsecond, d) for k, s, t, d in events]
    return spark.createDataFrame(plain, "key string, seq long, micros long, delta int").select("key", "seq", F.timestamp_micros("micros").alias("at"), "delta")


ODD = [(None, 1, START, 1), ("a", None, START, 1), ("a", 7000, None, 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_equals_a_fold(spark, seed):
    events = made(seed)
    assert rows(pressure.deadlines(table(spark, events + events[::7] + ODD))) == folded(events)
    assert rows(pressure.deadlines(table(spark, []))) == []


@pytest.fixture()
def stream(spark, tmp_path):
    ship(spark)
    backoff.state_store(spark)

    def run(*files, late="200 seconds"):
        for k, events in enumerate(files):
            table(spark, events).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
            arriving = spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in")
            started = backoff.timed(arriving, late=late).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/log").start()
            try:
                started.processAllAvailable()  # each file by a run of its own, which goes on from the state of the one before
            finally:
                started.stop()
        return rows(spark.read.parquet(f"file://{tmp_path}/out").filter("key <> '~'"))

    return run


def test_stream_equals_batch(stream):
    """Out of order, repeated, over restarts; the last event lets the watermark pass all."""
    events = made(4, 120)
    random.Random(9).shuffle(events)
    events.sort(key=lambda e: (e[2] - START).seconds // 150)
    files = [events[:60] + ODD, events[50:90] + events[80:85], events[90:], [("~", 0, START + timedelta(days=9), 0)]]
    assert stream(*files, late="600 seconds") == folded(events)


def test_cooldowns_run_out_and_late_events_are_left_out(stream):
    """A cooldown gives its row as soon as the watermark has passed it, though its key never comes again; what is later than the watermark doesn't count, nor does a repeated event."""
    at = lambda s: START + timedelta(seconds=s)
    first = [("a", 1, at(0), 1), ("b", 2, at(100), 1), ("~", 3, at(300), 0)]
    got = stream(first, late="10 seconds")
    assert got == sorted([("a", 1, at(0), "event", 1, at(5)), ("a", None, at(5), "expired", 1, None), ("b", 2, at(100), "event", 1, at(105)), ("b", None, at(105), "expired", 1, None)], key=repr)
    more = stream([("a", 1, at(0), 1), ("a", 9, at(50), 1), ("b", 4, at(295), 1), ("~", 5, at(400), 0)], late="10 seconds")
    assert sorted(set(more) - set(got), key=repr) == sorted([("b", 4, at(295), "event", 2, at(305)), ("b", None, at(305), "expired", 2, None)], key=repr) and len(more) == len(got) + 2


def test_many_events_go_to_the_state_at_once(spark, stream):
    """30,000 events, of keys with one and with thousands, in two files: what a batch brings is no call to the state for each event."""
    rng = random.Random(6)
    events = [(rng.choice("abc") if k % 3 else f"k{k}", k, START + timedelta(seconds=k // 10, microseconds=k % 7), rng.choice([1, -1, 0])) for k in range(30_000)]
    before = time.monotonic()
    got = stream(events[:20_000], events[18_000:] + [("~", 0, START + timedelta(days=9), 0)], late="1 hour")
    assert time.monotonic() - before < 60
    assert got == folded(events)
