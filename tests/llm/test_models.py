"""Direct definitions and hard inputs: Kneser-Ney probabilities, chains of links, lines by length, repeated ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.llm import decontaminate, line_dedup, toxicity
from folioframe.llm.common import connected_components


@pytest.mark.parametrize("order", ["down", "up", "mixed"])
def test_chains(spark, order):
    n = 1000
    ids = list(range(n))
    if order == "down":
        ids = [0, *range(n, 1, -1)]
    elif order == "mixed":
        random.Random(4).shuffle(ids)
    links = list(zip(ids, ids[1:], strict=False)) + [(5000 + k, 9000) for k in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == min(ids) for k in ids) and len(got) == len(ids) + 51
    assert {got[k] for k in (*range(5000, 5050), 9000)} == {5000}


def kneser_ney(classes, order):
    """Probability of a byte after a context, by the definition: classes are two dicts of words with weights."""
    grams = [[{} for _ in range(order + 1)] for _ in classes]
    for own, words in zip(grams, classes, strict=True):
        for w, n in words.items():
            s = b" " + w + b" "
            for end in range(1, len(s)):
                for k in range(min(order, end) + 1):
                    g = s[end - k : end + 1]
                    own[k][g] = own[k].get(g, 0) + n

    def count(c, g):
        k = len(g) - 1
        if k <= toxicity.SHARED and k < order:
            return sum(plain(x, g) for x in range(2))
        return plain(c, g)

    def plain(c, g):
        k = len(g) - 1
        if g not in grams[c][k]:
            return 0
        if k == order or g[0] == 32 and k > 0:
            return grams[c][k][g]
        return max(1, sum(x[1:] == g for x in grams[c][k + 1]))

    def taken(n):
        return min(n, toxicity.DISCOUNTS[0] if n < 2 else toxicity.DISCOUNTS[1] if n < 3 else toxicity.DISCOUNTS[2])

    known = [set().union(*(own[k] for own in grams)) for k in range(order + 1)]

    def p(c, context, byte):
        out = 1 / 256
        for k in range(min(order, len(context)) + 1):
            h = context[len(context) - k :]
            ns = [count(c, g) for g in known[k] if g[:-1] == h]
            if sum(ns):
                n = count(c, h + byte) if h + byte in known[k] else 0
                out = (n - taken(n)) / sum(ns) + sum(map(taken, ns)) / sum(ns) * out
        return out

    return p


@pytest.mark.parametrize("order", [2, 4, 7])
def test_kneser_ney(spark, order):
    rng = random.Random(order)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
    texts = [(" ".join(word() for _ in range(rng.randint(1, 12))) + rng.choice(["", "!", " 7"]), k % 2) for k in range(24)]
    model = toxicity.KneserNey(toxicity.count_strings(spark.createDataFrame(texts, "text string, class int").repartition(3), order, each=True), order)
    classes = [{}, {}]
    for t, c in texts:
        for w in {x for x in "".join(y if y.isalpha() else " " for y in t).split(" ") if x}:
            classes[c][w.encode()] = classes[c].get(w.encode(), 0) + 1
    p = kneser_ney(classes, order)
    words = [word().encode() for _ in range(12)] + [b"zzz", *list(classes[0])[:4], *list(classes[1])[:4]]
    got, number = model.probabilities(words)
    want = []
    for w in words:
        s = b" " + w + b" "
        want += [[p(c, s[max(0, e - order) : e], s[e : e + 1]) for c in (0, 1)] for e in range(1, len(s))]
    assert np.allclose(got, want, rtol=1e-9)
    ratio = model.ratio(words)
    for k in range(len(words)):
        some = np.array(want)[number == k]
        assert np.isclose(ratio[k], np.log(some[:, 1] / some[:, 0]).sum())


def test_labelled_texts_are_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    drawn = toxicity.labelled_texts(docs, labels.union(labels), sample=100)
    counts = {r.toxic: r["count"] for r in drawn.groupBy("toxic").count().collect()}
    assert 60 < counts[0] < 140 and 60 < counts[1] < 140
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_toxicity_odd(spark):
    docs = [(k, f"ordinary words number{k % 5}" + (" vileword" if k % 3 == 0 else "")) for k in range(200)] + [(None, "vileword here"), (3, "again vileword"), (3, None), (500, ""), (501, "word " * 50000), (502, "99 !!")]
    labels = [(k, int(k % 3 == 0)) for k in range(200)] + [(7, None), (None, 1), (8, 5), (12, 0)]
    got = toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.predicted)
    assert by[0] == [1] and by[1] == [0] and by[None] == [1] and by[501] == [0] and by[500] == [0] and by[502] == [0]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits, hot", [(line_dedup.EDITS, 50), (((24, 1), (30, 3), (40, 4)), 50), (((24, 1), (30, 3), (40, 4)), 0)])
def test_lines_by_length(spark, monkeypatch, edits, hot):
    """Edits that grow with the length, around the lengths where they change, with ids that repeat and are null; all lines hot or none."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = random.Random(17)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(n)).strip().ljust(n, "z") for n in (23, 24, 25, 29, 30, 31, 39, 40, 41, 46, 47, 48, 49, 50, 60)]
    docs = []
    for d in range(70):
        own = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                k, what = rng.randrange(len(line)), rng.randrange(3)
                line[k : k + (what != 0)] = [] if what == 2 else [rng.choice("xyz")]
            own.append("".join(line))
        docs.append((None if d < 4 else d // 2 if d > 50 else d, f"{d}", "\n".join([*own, "x", ""])))
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, name string, text string").coalesce(1), edits=edits).collect()
    got = {r.row.name: r for r in out}
    assert len(got) == len(docs) == len(out)
    allowed = lambda n: max([0] + [e for least, e in edits if n >= least])
    seen = []
    for d, name, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, int(r[1]))):
        left = []
        for line in text.split("\n"):
            bare = line.strip(" \t\r")
            if len(bare) >= 12 and bare in seen:
                continue
            near = any(min(len(o), len(bare)) >= 24 and distance(o, bare) <= allowed(min(len(o), len(bare))) for o in seen)
            if len(bare) >= 12:
                seen.append(bare)
            if not near:
                left.append(line)
        assert got[name].text == (text if d is None else "\n".join(left)), (d, name)


def test_leaks_of_null_and_repeated_ids(spark):
    item = "a passage of the benchmark that has more than enough words to be found again somewhere"
    docs = [(1, f"before {item} after"), (None, item), (1, "nothing of the kind at all here today"), (2, None), (3, "")]
    bench = spark.createDataFrame([("q-1", item), ("q-2", "another item that stands nowhere else at all in any text"), (None, "x")], "item_id string, text string")
    got = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), bench, limit=40).collect()
    assert sorted((repr(r.doc_id), [f.item_id for f in r.found]) for r in got) == sorted([("1", ["q-1"]), ("None", ["q-1"]), ("1", []), ("2", []), ("3", [])])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_texts_without_words_are_not_toxic(spark, sf):
    """Whatever the training set, at more than one size: no word is no evidence, and the stage keeps such documents."""
    documents, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    judge = toxicity.train(toxicity.labelled_texts(documents, labels))
    odd = spark.createDataFrame([(-1, ""), (-2, None), (-3, "   "), (-4, "12345 678"), (-5, "!?\n--")], "doc_id long, text string")
    assert {(r.score, r.predicted) for r in toxicity.score(odd, judge).collect()} == {(0.0, 0)}
    assert toxicity.clean(odd, judge).count() == 5
