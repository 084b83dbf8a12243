"""Containment of many probes: all that is there, and few pairs that aren't."""

import random

import pytest

from folioframe.operators import align


def brute(questions, blocks):
    def squeeze(t):
        return "".join(str(t or "").translate(str.maketrans("，。：；（）", ",.:;()")).split())

    return sorted((q, r, d, p) for q, s in questions for r, n in enumerate(align.PROBES) if len(probe := squeeze(s)[:n]) >= align.GRAM for d, p, c in blocks if probe in squeeze(c))


@pytest.mark.parametrize("seed", [1, 2])
def test_all_that_is_contained(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    blocks = [(d, p, " ".join(word(rng.randint(1, 9)) for _ in range(rng.randint(0, 30)))) for d in range(4) for p in range(25)] + [(9, 0, None), (9, 1, ""), (9, 2, "short")]
    questions = [(f"q{k}", (t := rng.choice(blocks)[2] or "")[(i := rng.randint(0, 30)) : i + rng.choice([5, 6, 8, 11, 12, 14, 30, 60])]) for k in range(60)] + [("none", None), ("far", "zzzzzzzzzzzzzzzzzzzz")]
    got = align.contained(align.probes(spark.createDataFrame(questions, "question string, statement string")), spark.createDataFrame(blocks, "doc int, pos int, content string"))
    assert sorted(map(tuple, got.collect())) == brute(questions, blocks)


def test_shared_beginnings_join_little(spark):
    """300 statements begin with the same words as 2,000 blocks, and differ behind them: pairs are of the order of what is found, not of the product."""
    head = "Find the smallest one "
    blocks = [("d", k, head + f"of set {k * 7919:08d} and show it") for k in range(2000)]
    questions = [(f"q{k}", head + f"of set {k * 7919:08d} and") for k in range(300)]
    asked = align.probes(spark.createDataFrame(questions, "question string, statement string"))
    longest = asked.filter("rank = 0").select("probe").distinct()
    own = align._squeezed(spark.createDataFrame(blocks, "doc string, pos int, content string"))
    pairs = align.candidates(longest, own, align.STRIDE)
    assert longest.count() == 300 and 300 <= pairs.count() <= 10 * 300 < 300 * 2000 / 100
    found = pairs.join(own, ["doc", "pos"]).filter("contains(squeezed, probe)")
    assert found.count() == 300


def test_failures_by_later_parts(spark):
    """Windows of 60, 40 and 24 characters, whatever their place among the windows; blocks of a document without a number count."""
    word = lambda k, n: "".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=n))
    texts = {1: word(1, 150), 2: word(2, 90), 3: word(3, 150), 4: " ", 5: word(5, 30), 6: None}
    blocks = [("d", 0, "x" + texts[1][24:48] + "x"), ("d", 1, "x" + texts[2][12:36]), (None, 0, texts[3][96:120] + "x"), ("d", 2, texts[3][20:43] + "x"), ("d", 3, texts[5][13:])]
    questions, own = spark.createDataFrame(list(texts.items()), "question int, statement string"), spark.createDataFrame(blocks, "doc string, pos int, content string")
    got = dict(map(tuple, align.failures(questions, align.starts(questions, own), own).collect()))
    assert got == {1: "OCR_CONTENT_VARIATION", 2: "OCR_CONTENT_VARIATION", 3: "OCR_CONTENT_VARIATION", 4: "SOLUTION_BLEED", 5: "ALIGNMENT_ALGORITHM_LIMIT", 6: "SOLUTION_BLEED"}
