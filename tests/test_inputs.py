"""What is asked for against brute force over a tree of real files; places of artifacts; odd names."""

import fnmatch
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.sources import inputs

NAMES = ["a/x.pdf", "a/X.PDF", "a/y.md", "a/y.revised.md", "a/b/z.pdf", "a/b/note.txt", "c/only.txt", "deep/er/f.md", "p[1].pdf", "é .pdf"]


def brute(root, asked, suffixes, skip=None):
    """[(place, path)], [(place, name, problem)] by walking the folders."""
    got, seen, bad = [], set(), []
    for place, name in sorted((a for a in asked if a[1] is not None), key=lambda a: a[0]):
        at = name.rstrip("/")
        if os.path.isdir(at):
            found = sorted(f"{at}/{n}" for n in os.listdir(at) if os.path.isfile(f"{at}/{n}") and os.path.splitext(n)[1].lower() in suffixes and not (skip and os.path.splitext(n)[0].endswith(skip)))
            if not found:
                bad.append((place, name, "no_files"))
        elif os.path.isfile(at):
            found = [at] if os.path.splitext(at)[1].lower() in suffixes else []
            if not found:
                bad.append((place, name, "other_suffix"))
        else:
            found = []
            bad.append((place, name, "absent"))
        for f in found:
            if f.lower() not in seen:
                seen.add(f.lower())
                got.append((place, f))
    return sorted(got), sorted(bad)


def test_like_a_walk_over_the_folders(spark, tmp_path):
    for n in NAMES:
        at = tmp_path / n
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(n)
    root = str(tmp_path)
    files = inputs.listed(spark, [root])
    assert sorted(r.path for r in files.collect()) == sorted(f"{root}/{n}" for n in NAMES)
    asked = [(0, f"{root}/a/b/"), (1, f"{root}/a"), (2, f"{root}/a/x.pdf"), (3, f"{root}/a/y.revised.md"), (4, f"{root}/c"), (5, f"{root}/deep"), (6, f"{root}/none.pdf"), (7, f"{root}/c/only.txt"), (8, None), (9, root), (10, f"{root}/a/"), (11, f"{root}/a/b/z.pdf"), (13, f"{root}/none.pdf")]
    table = spark.createDataFrame(asked, "place int, name string")
    for suffixes, skip in ((inputs.PDF, None), (inputs.MARKDOWN, None), (inputs.BOTH, ".revised")):
        want, bad = brute(root, asked, suffixes, skip)
        match = skip and skip.replace(".", r"\.") + "$"
        assert sorted(map(tuple, inputs.collected(table, files, suffixes, match).collect())) == want
        assert sorted(map(tuple, inputs.problems(table, files, suffixes, match).collect())) == bad


def test_nothing_asked_nothing_there(spark):
    none = spark.createDataFrame([], "path string")
    asked = spark.createDataFrame([(0, "a"), (0, "a"), (1, None)], "place int, name string")
    assert inputs.collected(asked, none).count() == 0
    assert [r.problem for r in inputs.problems(asked, none).collect()] == ["absent"] * 2
    some = spark.createDataFrame([("a/b.pdf",), ("a/b.pdf",), (None,), (".pdf",), ("b.",)], "path string")
    assert [tuple(r) for r in inputs.collected(asked, some).collect()] == [(0, "a/b.pdf")]
    assert inputs.collected(asked.limit(0), some).count() == 0
    here = spark.createDataFrame([(0, "."), (1, ".pdf"), (2, "b."), (3, "")], "place int, name string")
    assert sorted((r.place, r.problem) for r in inputs.problems(here, some).collect()) == [(0, "no_files"), (1, "other_suffix"), (2, "other_suffix"), (3, "no_files")]


def test_a_folder_that_all_ask_for_is_looked_up_once(spark):
    asked = spark.range(2000).select(F.col("id").alias("place"), F.lit("a").alias("name"))
    files = spark.range(2000).select(F.format_string("a/%05d.pdf", "id").alias("path"))
    assert inputs.collected(asked, files).groupBy("place").count().collect() == [(0, 2000)]
    assert inputs.problems(asked, files).count() == 0 and inputs.problems(asked, files, (".md",)).count() == 2000


@settings(max_examples=150, deadline=None)
@given(st.text("ab[]!-*?.^&\\", max_size=8), st.text("ab[]!-*?.^&\\", min_size=1, max_size=6))
def test_patterns_of_names(pattern, name):
    import re

    try:
        own = re.compile(inputs.glob(pattern).replace("(?s)", ""), re.S)
    except re.error:  # a set such as [b-a], which no name can be in
        return
    if "[^" in pattern or "&&" in pattern or "--" in pattern or re.search(r"\[[^]]*-[^]]*\]", pattern):
        return  # where libraries differ
    assert bool(own.search(name)) == fnmatch.fnmatchcase(name, pattern)


def test_targets_and_limit(spark):
    files = spark.createDataFrame([(p,) for p in ("d/b.pdf", "d/a.pdf", "d/a.PDF", "d/e/c.pdf", "d/p1.md", "d/p[1].pdf")], "path string")
    paths = lambda *a: [r.path for r in inputs.targets(files, *a).collect()]
    assert paths("d/") == ["d/a.pdf", "d/b.pdf", "d/p[1].pdf"] and paths("d", "*.pdf", 2) == ["d/a.pdf", "d/b.pdf"]
    assert paths("d", "[!b]*.pdf") == ["d/a.pdf", "d/p[1].pdf"] and paths("d", "p[[]1].pdf") == ["d/p[1].pdf"] and paths("none") == []


def test_places_of_artifacts(spark):
    paths = ["in/a_prework/evidence.json", "a_prework/evidence.json", "in/a.evidence.json", "a.evidence.json", "in/a/evidence.json", None]
    own = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [tuple(r) for r in own.select(*[inputs.beside(F.col("path"), k) for k in ("view", "raw", "semantic", "diagnostics")], inputs.prework(F.col("path"))).collect()]
    assert got == [
        ("in/a_prework/normalized-view.json", "in/a_prework/raw", "in/a_prework/semantic", "in/a_prework/diagnostics", "in/a_prework"),
        ("a_prework/normalized-view.json", "a_prework/raw", "a_prework/semantic", "a_prework/diagnostics", "a_prework"),
        ("in/a.normalized.json", "in/a_raw", "in", "in", None),
        ("a.normalized.json", "a_raw", ".", ".", None),
        ("in/a/evidence.json", "in/a/evidence.json_raw", "in/a", "in/a", None),
        (None, None, None, None, None),
    ]
