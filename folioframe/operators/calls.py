"""A provider's calls as a table that survives: what was answered is never asked again.

A call is (request, attempt); request is the digest of the document, the window's id and the whole prompt, so that a text
that changed is asked anew. A round asks, for one attempt, for the windows that have no valid answer yet and no recorded call
of that attempt, and appends its answers to a table before the next round begins.

Within a round each task keeps a journal in the shared folder: after every `chunk` calls, and when one fails, what was
answered is written there, by the first digits of the request. A task that runs again, after a failure, on another machine or
in another session, reads the journal of its requests first. What can be lost, and asked twice, is only the calls that were
under way in the moment a worker died: `chunk` at most in a task. Speculative execution must be off, as it runs tasks twice.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import put, store
from .labels import parse_response, validation_error
from .prompt import PREDICTION, SYSTEM

CALLS = "request string, attempt int, raw string"
DIGITS = 3  # of a request: which part of the journal holds it


def request_id(system: str) -> Column:
    return F.sha2(F.to_json(F.struct("doc", "window_id", F.lit(system).alias("system"), "user")), 256)


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    """request, attempt, raw: every recorded call, once."""
    table = spark.read.schema(CALLS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files, at = store(f"{folder}/calls")
    if files.get_file_info(at).type.name == "NotFound":
        return spark.createDataFrame([], CALLS)
    return table.parquet(f"{folder}/calls").dropDuplicates(["request", "attempt"])


def _journal(folder: str, attempt: int, part: str) -> dict[str, str | None]:
    """request -> answer, of a part of the journal."""
    from pyarrow import fs

    files, at = store(f"{folder}/journal/attempt={attempt}/{part}")
    out = {}
    for info in files.get_file_info(fs.FileSelector(at, allow_not_found=True)):
        if info.path.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                out |= dict(json.loads(f.read()))
    return out


def _answers(folder: str, attempt: int, system: str, call: Callable[[str, str, int], str], at_once: int, chunk: int):
    """A function over Arrow batches (request, part, user), sorted by part."""

    def run(batches):
        import uuid

        import pyarrow as pa

        part, known, todo = None, {}, []

        def ask() -> list[tuple[str, str | None]]:
            got, failed, by_part = [], None, defaultdict(list)
            with ThreadPoolExecutor(at_once) as pool:
                for own, request, future in [(p, r, pool.submit(call, system, user, attempt)) for p, r, user in todo]:
                    try:
                        got.append((request, future.result()))
                        by_part[own].append(got[-1])
                    except Exception as e:  # what else was answered is written first
                        failed = failed or e
            for own, answers in by_part.items():
                put(f"{folder}/journal/attempt={attempt}/{own}/{uuid.uuid4().hex}.json", json.dumps(answers).encode())
            todo.clear()
            if failed:
                raise failed
            return got

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.string()), pa.array([attempt] * len(rows), pa.int32()), pa.array([a for _, a in rows], pa.string())], ["request", "attempt", "raw"])

        for b in batches:
            for request, own, user in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != part:
                    part, known = own, _journal(folder, attempt, own)
                if request in known:
                    yield out([(request, known[request])])
                else:
                    todo.append((own, request, user))
                    if len(todo) >= chunk:
                        yield out(ask())
        if todo:
            yield out(ask())

    return run


def judged(windows: DataFrame, calls: DataFrame, system: str = SYSTEM) -> DataFrame:
    """The calls of windows, with what their answers are worth: windows' columns, request, attempt, raw, parsed, fault (null if the answer is valid)."""
    rows = windows.withColumn("request", request_id(system)).join(calls, "request")
    rows = rows.withColumn("parsed", parse_response(F.col("raw"), PREDICTION))
    return rows.withColumn("fault", F.when(F.col("parsed").isNull(), "not_an_object").otherwise(validation_error(F.col("parsed"), F.col("window_id"), F.col("refs"))))


def ask(windows: DataFrame, call: Callable[[str, str, int], str], folder: str, attempts: int = 2, at_once: int = 4, chunk: int = 32, system: str = SYSTEM) -> DataFrame:
    """Ask for every window that needs it, up to `attempts` times, and record each call below folder, which driver and executors share: recorded().

    windows: as prompts() gives them (doc, window_index, window_id, refs, user); rows that repeat are asked once. At most
    `at_once` calls are under way in a task. An error of the call ends the job; the next ask() goes on where it was.
    """
    spark = windows.sparkSession
    own = windows.withColumn("request", request_id(system)).dropDuplicates(["request"])
    for attempt in range(1, max(1, attempts) + 1):
        calls = recorded(spark, folder)
        before = judged(windows, calls, system).filter(F.col("attempt") < attempt)
        valid = before.filter("fault is null").select("request")
        todo = own.join(calls.filter(F.col("attempt") == attempt), "request", "left_anti").join(valid, "request", "left_anti")
        todo = todo.select("request", F.substring("request", 1, DIGITS).alias("part"), "user").repartition("part").sortWithinPartitions("part", "request")
        todo.mapInArrow(_answers(folder, attempt, system, call, at_once, chunk), CALLS).write.mode("append").parquet(f"{folder}/calls/attempt={attempt}")
        files, at = store(f"{folder}/journal/attempt={attempt}")
        if files.get_file_info(at).type.name != "NotFound":
            files.delete_dir(at)  # the table has it now
    return recorded(spark, folder)


def predictions(windows: DataFrame, calls: DataFrame, attempts: int = 2, system: str = SYSTEM) -> DataFrame:
    """windows' columns and what prompt.predict gives: prediction (of the first valid answer), error (the last one, null if there is a valid one), tries (attempt, ok, error, raw) in order. Windows without any call have no tries."""
    rows = judged(windows.dropDuplicates(["doc", "window_index"]), calls.filter(F.col("attempt") <= attempts), system)
    ok = F.col("fault").isNull()
    tries = F.array_sort(F.collect_list(F.struct("attempt", ok.alias("ok"), F.col("fault").alias("error"), "raw")))
    found = rows.groupBy("doc", "window_index").agg(F.min_by("parsed", F.when(ok, F.col("attempt"))).alias("prediction"), F.max_by("fault", "attempt").alias("last"), F.max(ok).alias("any"), tries.alias("tries"))
    empty = F.array().cast(found.schema["tries"].dataType)
    out = windows.join(found, ["doc", "window_index"], "left")
    return out.select(*windows.columns, "prediction", F.when(~F.coalesce("any", F.lit(False)), F.col("last")).alias("error"), F.coalesce("tries", empty).alias("tries"))


def records(predicted: DataFrame, system: str = SYSTEM) -> DataFrame:
    """What is kept of each window's calls: doc, window_id, window_size, system, user, attempts, prediction (JSON)."""
    return predicted.select("doc", "window_id", F.size("refs").alias("window_size"), F.lit(system).alias("system"), "user", F.col("tries").alias("attempts"), F.to_json("prediction").alias("prediction"))
