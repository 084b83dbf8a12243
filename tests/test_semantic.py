"""Windows, splits and assembly against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import assemble, audit, evidence, gates, labels, pressure, reconcile, structure, windows


def stream(spark, sizes):
    return spark.createDataFrame([(d, p) for d, n in sizes.items() for p in range(n)], "doc long, pos int")


@pytest.mark.parametrize(("size", "stride"), [(5, 3), (1, 1), (3, 5), (8, 2), (0, 0)])
def test_windows(spark, size, stride):
    sizes = {n: n for n in range(1, 24)}
    got = {(r.doc, r.window_index): (r.start_index, r.end_index) for r in windows.windows(stream(spark, sizes), size, stride).collect()}
    size, stride, want = max(1, size), max(1, stride), {}
    for n in sizes:
        k = 0
        while k * stride < n:
            want[n, k] = (k * stride, min(n, k * stride + size))
            if k * stride + size >= n:
                break
            k += 1
    assert got == want
    held = {(r.doc, r.window_index, r.pos) for r in windows.membership(stream(spark, sizes), size, stride).collect()}
    assert held == {(d, k, p) for (d, k), (a, b) in want.items() for p in range(a, b)}


def test_expand(spark):
    s = stream(spark, {20: 20, 3: 3})
    n = s.groupBy("doc").agg(F.count("*").cast("int").alias("n"))
    got = {(r.doc, r.window_index): (r.start_index, r.end_index) for r in windows.expand(windows.windows(s), n, 9).collect()}
    assert got[20, 2] == (4, 13) and got[20, 0] == (0, 9) and got[20, 5] == (11, 20) and got[3, 0] == (0, 3)


def fold(blocks, splits):
    """The same by a loop: candidates in order of creation as lists of (ref, start, end)."""
    out, shared, excluded, said, current = [], [], [], [], None
    for ref, role, text in blocks:
        span = (ref, 0, len(text))
        if role == "SHARED_CONTEXT":
            shared.append(ref)
        elif role == "PROBLEM_START":
            current = {"statement": [span], "solution": [], "shared": shared}
            shared = []
            out.append(current)
        elif role in ("PROBLEM_CONTINUATION", "SOLUTION_START", "SOLUTION_CONTINUATION"):
            if current is None:
                said.append(ref)
            else:
                current["statement" if role == "PROBLEM_CONTINUATION" else "solution"].append(span)
        else:
            excluded.append(ref)
    for ref, at in splits:
        for c in list(out):
            for k, (r, a, b) in enumerate(c["statement"]):
                if r == ref and a == 0 and at:
                    out.append({"statement": [(r, at, b), *c["statement"][k + 1 :]], "solution": list(c["solution"]), "shared": []})
                    c["statement"] = [*c["statement"][:k], (r, 0, at)]
                    break
    return out, excluded + shared, said


def test_assembly_equals_the_fold(spark):
    rng, rows, cuts, want = random.Random(5), [], [], {}
    for doc in range(60):
        own = [(f"b{k}", rng.choice(labels.ROLES), "x" * rng.randint(1, 9)) for k in range(rng.randint(1, 12))]
        splits = [(r, rng.randint(1, len(t))) for r, _, t in own if rng.random() < 0.3]
        rng.shuffle(splits)
        want[doc] = fold(own, splits)
        rows += [(doc, k, r, role, t) for k, (r, role, t) in enumerate(own)]
        cuts += [(doc, r, k, 0, ("resolved", at, at + 1)) for k, (r, at) in enumerate(splits)]
    blocks = spark.createDataFrame(rows, "doc int, pos int, block_ref string, role string, content string")
    split = spark.createDataFrame(cuts, "doc int, block_ref string, window_index int, split_pos int, split struct<status:string,start:int,end:int>")
    own = assemble.assigned(blocks)
    refs = assemble.candidate_refs(own, split)
    got: dict = {}
    for r in refs.collect():
        got.setdefault((r.doc, r.candidate_number), {"statement": [], "solution": [], "shared": []})[r.kind].append((r.pos, r.block_ref, r.start, r.end))
    for doc, (out, excluded, said) in want.items():
        for k, c in enumerate(out, 1):
            g = got.get((doc, k), {"statement": [], "solution": [], "shared": []})
            assert [x[1:] for x in sorted(g["statement"])] == c["statement"], (doc, k)
            assert [x[1:] for x in sorted(g["solution"])] == c["solution"]
            assert [x[1] for x in sorted(g["shared"])] == c["shared"]
        assert sorted(r.block_ref for r in assemble.excluded(own).filter(F.col("doc") == doc).collect()) == sorted(excluded) if doc < 5 else True
    lost = gates.silent_loss(blocks, refs, assemble.excluded(own), assemble.diagnostics(own))
    assert lost.count() == 0
    assert gates.silent_loss(blocks, assemble.candidate_refs(assemble.assigned(blocks, compat=True)), assemble.excluded(assemble.assigned(blocks, compat=True)), assemble.diagnostics(own)).count() > 0


def test_split_resolution(spark):
    rows = [("abcabc", "abc"), ("abc", "c"), ("abc", "x"), ("abc", ""), ("aaa", "aa"), (None, "a")]
    got = spark.createDataFrame(rows, "t string, a string").select(assemble.resolve_split(F.col("t"), F.col("a")).alias("s")).collect()
    assert [tuple(r.s) for r in got] == [("ambiguous", None, None), ("resolved", 2, 3), ("not_found", None, None), ("missing_anchor", None, None), ("ambiguous", None, None), ("not_found", None, None)]


def test_question_numbers(spark):
    rows = [("12. x", "12"), (" 3、y", "3"), ("十二、z", "十二"), ("1234. x", None), ("x 1.", None), (None, None)]
    got = spark.createDataFrame(rows, "t string, w string").select(assemble.question_number(F.col("t"))["number"].alias("n"), "w").collect()
    assert all(r.n == r.w for r in got)


def test_conflicts_are_uncertain(spark):
    df = spark.createDataFrame([(1, "a", "X"), (1, "a", "Y"), (1, "b", "X"), (1, "b", "X")], "doc int, block_ref string, role string")
    assert {r.block_ref: (r.role, r.found) for r in reconcile.roles(df).collect()} == {"a": ("UNCERTAIN", "X|Y"), "b": ("X", "X")}


def test_pressure(spark):
    rows = [("队列已满", "queue_full"), ("HTTP_429", "http_429"), ("status=504", "http_503"), ("5030 x", "other"), ("今日提交任务已达上限", "quota_exhausted"), ("", "other"), (None, "other"), ("Rate Limit", "rate_limit")]
    got = spark.createDataFrame(rows, "t string, w string").select(pressure.classify(F.col("t"))["reason"].alias("r"), "w").collect()
    assert [r.r for r in got] == [r.w for r in got]
    assert [r[0] for r in spark.range(7).select(pressure.cooldown(F.col("id").cast("int"))).collect()] == [0, 5, 10, 20, 40, 60, 60]


def test_simulation(spark):
    jobs = spark.createDataFrame([(1, 1, 2.0, True), (1, 2, 2.0, False), (1, 3, 1.0, False)], "schedule int, job int, duration double, pressure boolean")
    got = {r.job: (r.launched, r.level) for r in pressure.simulate(jobs, workers=1).collect()}
    assert got == {1: (0.0, 0), 2: (7.0, 1), 3: (9.0, 0)}


def test_structure():
    value = {"a": {"token": "x", "b": [{"c": 1}, 2]}, "u": "https://x.y", "s": "aB3" * 15}
    assert structure.key_paths(value) == ["a", "a.token", "a.b", "a.b[].c", "u", "s"]
    deep = {"k": [[{"[]": {"": {"z": 1}}}], 2], "n": None}
    assert structure.key_paths(deep) == ["k", "k[][].[]", "k[][].[].", "k[][].[]..z", "n"] and structure.key_paths(deep, 0) == ["k", "n"] and structure.key_paths(7) == []
    assert structure.structure({"k": ["ab", 3], "n": 1.5}, items=0) == {"__type__": "object", "__keys__": ["k", "n"], "k": {"__type__": "array", "__len__": 2, "__item__": {"__type__": "str", "__chars__": 2}}}
    assert structure.structure([[1]], depth=0) == {"__type__": "array", "__len__": 1, "__item__": {"__type__": "array", "__truncated__": "depth"}}
    clean = structure.scrub(value)
    assert clean["a"]["token"] == "<<redacted>>" and clean["s"] == "<<redacted:opaque>>"
    assert dict(structure.secrets(value)) == {"$.a.token": "sensitive_key", "$.u": "resource", "$.s": "secret_value"}
    assert structure.block_list({"x": [{"blocks": [1]}]}) == [1]


def test_distance(spark):
    rows = [("abc", "abd", 2), ("", "ab", 2), ("ab", "ab", 0), ("ab", "abcd", 2), ("", "", 0)]
    got = spark.createDataFrame(rows, "a string, b string, w int").select(audit.distance(F.col("a"), F.col("b")).alias("d"), "w").collect()
    assert [r.d for r in got] == [r.w for r in got]


def test_evidence_is_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    evidence.write(df, str(tmp_path / "e"))
    with pytest.raises(Exception, match="(?i)exists"):
        evidence.write(df, str(tmp_path / "e"))
    evidence.write(df, str(tmp_path / "e"), overwrite=True)


def test_levels_of_odd_keys(spark):
    """Null and NaN keys are keys like others, large numbers stay as they are, a null delta changes nothing."""
    big = (1 << 60) + 1
    rows = [(k, s, d) for k in (None, big, big + 1) for s, d in enumerate((1, 1, None, 1, -1))]
    got = sorted((r.key or 0, r.seq, r.level) for r in pressure.levels(spark.createDataFrame(rows, "key long, seq int, delta int")).collect())
    assert got == [(k, s, n) for k in (0, big, big + 1) for s, n in enumerate((1, 2, 2, 3, 2))]
    rows = [(float("nan"), s, 1) for s in range(3)] + [(None, s, 1) for s in range(3)]
    assert sorted(r.level for r in pressure.levels(spark.createDataFrame(rows, "key double, seq int, delta int")).collect()) == [1, 1, 2, 2, 3, 3]
    jobs = spark.createDataFrame([(None, 1, 5.0, False), (None, 2, None, None), (None, 3, 1.0, False), (big, 1, 2.0, True)], "schedule long, job long, duration double, pressure boolean")
    got = sorted((r.schedule or 0, r.job, r.launched, r.finished) for r in pressure.simulate(jobs).collect())
    assert got == [(0, 1, 0.0, 5.0), (0, 2, 0.0, 0.0), (0, 3, 0.0, 1.0), (big, 1, 0.0, 2.0)]
