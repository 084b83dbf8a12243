"""Lines that differ by one word, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from folioframe.llm import line_dedup


def one_word(a: list[str], b: list[str]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("partitions", [1, 5])
def test_one_word(spark, partitions):
    rng = random.Random(5)
    vocabulary = ["it", "an", "the", "ou", "remarkable", "", "日本", "é", "seventeen", "x"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 12))] for _ in range(12)]
    docs = []
    for d in range(60):
        own = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                k, what = rng.randrange(len(w)), rng.randrange(3)
                w[k : k + (what != 0)] = [] if what == 2 and len(w) > 2 else [rng.choice(vocabulary)]
            own.append(" ".join(w))
        docs.append((d if d % 9 else None, "\n".join([*own, "short", ""])))
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions), words=True).collect()
    texts = {r.doc_id: r.text for r in got if r.doc_id is not None}
    nobody = [b.strip(" \t\r") for d, t in docs if d is None for b in t.split("\n")]
    seen, nulls, dropped = [], {b for b in nobody if len(b) >= 12}, 0
    equal = set(nulls)
    for d, text in docs:
        if d is None:
            continue
        left = []
        for line in text.split("\n"):
            bare = line.strip(" \t\r")
            if len(bare) >= 12 and bare in equal:
                continue
            words = bare.split(" ")
            near = len(bare) >= 24 and any(len(o) >= 24 and edits(o, bare) <= 1 for o in seen)
            near = near or len(bare) >= 24 and len(words) >= 5 and any(len(o) >= 24 and o.count(" ") >= 4 and one_word(o.split(" "), words) for o in [*seen, *nulls])
            if len(bare) >= 12:
                equal.add(bare)
                seen.append(bare)
            if near:
                dropped += 1
            else:
                left.append(line)
        assert texts[d] == "\n".join(left), d
    assert dropped > 10
    assert sorted(r.text for r in got if r.doc_id is None) == sorted(t for d, t in docs if d is None)


def test_lines_of_one_beginning_make_few_pairs(spark, monkeypatch):
    """40 lines with one beginning and the same letters behind it, shuffled: 780 pairs share a segment and their letters, none is within the edits; two that are stay found."""
    rng, met, spool = random.Random(3), [], line_dedup.spool
    letters = "abcdefghijklmnopqrstuvwxyz" * 2 + "etaneta"
    texts = ["one beginning of thirty letters" + "".join(rng.sample(letters, len(letters))) for _ in range(40)]
    texts.append(texts[0][:60] + "#" + texts[0][61:])

    def counted(df, label):
        out = spool(df, label)
        met.extend([out.count()] if label == "met" else [])
        return out

    monkeypatch.setattr(line_dedup, "spool", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_near for r in line_dedup.dedup_lines(docs).collect() if r.n_near} == {40: 1}
    assert len(met) == 1 and met[0] <= 20


def test_ends_alike_loses_nothing(spark):
    """What the ends rule out is farther apart than allowed, in short and long lines; most of what is farther apart goes."""
    rng, pairs = random.Random(4), []
    for k in range(400):
        a = "".join(rng.choice("abcdé ") for _ in range(rng.choice([24, 47, 48, 63, 64, 65, 66, 130])))
        b = list(a)
        for _ in range(edits := k % 3):
            at = rng.choice([0, 1, 62, 63, 64, len(b) - 1, rng.randrange(len(b))]) % len(b)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
        pairs.append((edits, a, "".join(b)))
        pairs.append((99, a, "".join(rng.sample(a, len(a)))))
    alike = line_dedup.ends_alike(F.col("a"), F.col("b"), F.greatest(F.lit(1), F.when(F.col("edits") < 9, F.col("edits")).otherwise(2)), 2)
    got = spark.createDataFrame(pairs, "edits int, a string, b string").select("edits", alike.alias("alike")).collect()
    assert all(r.alike for r in got if r.edits < 9)
    assert not any(r.alike for r in got if r.edits == 99)


def test_pieces_shuffle_narrow_and_few_pairs_are_verified(spark, monkeypatch):
    """Where ids are the rows' numbers a piece has its number once; pairs whose ends are unlike aren't verified character by character."""
    seen, spool, middles = {}, line_dedup.spool, line_dedup._middles

    def spooled(df, label):
        seen.setdefault(label, df.columns)
        return spool(df, label)

    def cut(pairs, a, b):
        seen["verified"] = pairs.count()
        return middles(pairs, a, b)

    monkeypatch.setattr(line_dedup, "spool", spooled)
    monkeypatch.setattr(line_dedup, "_middles", cut)
    rng = random.Random(8)
    texts = ["one beginning of thirty letters" + "".join(rng.sample("etan" * 3 + "bcdf" * 3, 24)) for _ in range(8)]
    texts.append(texts[0][:-2] + "#" + texts[0][-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_near for r in line_dedup.dedup_lines(docs).collect() if r.n_near} == {8: 1}
    assert sorted(seen["segments"]) == ["h", "letters", "pos", "row"]
    assert seen["verified"] == 1
