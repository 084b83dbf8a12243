"""Calls of a provider are made once, whatever fails in between."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioframe.operators import calls, prompt
from folioframe.session import ship


def answering(folder, broken=()):
    """A provider that leaves a file for each call; it answers at the second attempt of every third window, and fails where it is told."""

    def call(system, user, attempt):
        import uuid

        window = json.loads(user.split("\n", 1)[1])
        name = f"{window['window_id']}-{attempt}"
        if name in broken and not os.path.exists(f"{folder}/mended"):
            raise RuntimeError("no connection")
        with open(f"{folder}/{name}-{uuid.uuid4().hex}", "w"):
            pass
        k = int(window["window_id"][1:])
        refs = [b["block_ref"] for b in window["blocks"]]
        if k % 3 == 2 and attempt == 1:
            return None if k % 2 else "not json"
        return json.dumps({"schema": prompt.PREDICTION_SCHEMA, "window_id": window["window_id"], "roles": [{"block_ref": r, "role": "PROBLEM_START"} for r in refs], "boundaries": [{"left_ref": a, "right_ref": b, "relation": "NEW_PROBLEM"} for a, b in zip(refs, refs[1:], strict=False)], "splits": [], "uncertain": []})

    return call


@pytest.fixture(scope="module")
def windows(spark):
    ship(spark)
    rows = [("d", i, f"w{i:04d}", 2 * i + p, f"b{2 * i + p}", "text", f"content {p}") for i in range(40) for p in range(2)]
    return prompt.prompts(spark.createDataFrame(rows, "doc string, window_index int, window_id string, pos int, block_ref string, label string, content string")).cache()


def made(folder):
    return Counter("-".join(f.split("-")[:2]) for f in os.listdir(folder) if f.startswith("w"))


def expected(most=2):
    return {f"w{i:04d}-{a}" for i in range(40) for a in range(1, most + 1) if a == 1 or i % 3 == 2}


def test_no_call_is_made_twice(spark, windows, tmp_path):
    """A call fails in the first round, another in the second; each run goes on where the one before was."""
    seen, folder = tmp_path / "seen", f"file://{tmp_path}/calls"
    seen.mkdir()
    for k, broken in enumerate([("w0007-1",), ("w0005-2", "w0020-2"), ()]):
        call = answering(str(seen), broken)
        if broken:
            with pytest.raises(Exception, match="no connection"):
                calls.ask(windows, call, folder, chunk=4, at_once=2)
            if k == 0:
                assert made(seen) and not os.path.exists(f"{tmp_path}/calls/calls/attempt=1/_SUCCESS")  # nothing is in the table yet, only in the journal
        else:
            got = calls.ask(windows, call, folder, chunk=4, at_once=2)
    assert set(made(seen)) == expected() and set(made(seen).values()) == {1}
    assert got.count() == len(expected()) and not os.path.exists(f"{tmp_path}/calls/journal/attempt=1")
    calls.ask(windows, answering(str(seen)), folder)
    assert sum(made(seen).values()) == len(expected())
    predicted = calls.predictions(windows, got)
    direct = prompt.predict(windows, prompt.provider(answering(str(seen))))
    kept = ["doc", "window_index", "prediction", "error", "tries"]
    assert sorted(map(repr, predicted.select(kept).collect())) == sorted(map(repr, direct.select(kept).collect()))
    record = {r.window_id: r for r in calls.records(predicted).collect()}
    assert len(record) == 40 and [t.ok for t in record["w0005"].attempts] == [False, True] and json.loads(record["w0005"].prediction)["window_id"] == "w0005"


def test_changed_texts_and_further_attempts_are_asked(spark, windows, tmp_path):
    seen, folder = tmp_path / "seen", f"file://{tmp_path}/calls"
    seen.mkdir()
    call = answering(str(seen))
    assert calls.ask(windows, call, folder, attempts=1).count() == 40
    one = calls.predictions(windows, calls.recorded(spark, folder), attempts=1)
    assert one.filter("prediction is null").count() == 13 and {r.error for r in one.filter("prediction is null").select("error").collect()} == {"not_an_object"}
    calls.ask(windows.unionByName(windows), call, folder)  # repeated rows are asked once
    assert set(made(seen)) == expected() and set(made(seen).values()) == {1}
    changed = windows.withColumn("user", F.when(F.col("window_index") == 4, F.concat("user", F.lit(" "))).otherwise(F.col("user")))
    calls.ask(changed, call, folder)
    assert made(seen)["w0004-1"] == 2 and sum(made(seen).values()) == len(expected()) + 1
    empty = windows.limit(0)
    assert calls.predictions(empty, calls.ask(empty, call, f"file://{tmp_path}/none")).collect() == []
    assert [r.tries for r in calls.predictions(windows, calls.recorded(spark, f"file://{tmp_path}/other")).filter("window_index < 2").collect()] == [[], []]
