"""Points in intervals against all pairs; covered spans against a sweep; names against a loop."""

import random

import pytest
from pyspark.sql import functions as F

from folioframe.functions import udfs
from folioframe.operators import intervals
from folioframe.sources import sinks


def made(seed):
    rng = random.Random(seed)
    far = [0, 1, 2, 5, 63, 64, 65, 100, 1000, 2**20, 2**39 - 1, 2**39, 2**40 + 3]
    spans = [(rng.choice(["a", "b", None]), k, (s := rng.choice([rng.randint(0, 200), rng.choice(far)])), s + rng.choice([0, 1, 2, 3, 17, 64, 300, 2**21, -5])) for k in range(120)]
    spans += [("a", 900, None, 5), ("a", 901, 5, None), ("a", 902, -3, 50), ("b", 903, 0, 2**41), ("c", 904, 7, 9), ("c", 904, 7, 9)]
    points = [(rng.choice(["a", "b", "c", None]), k, rng.choice([rng.randint(-2, 260), rng.choice(far)])) for k in range(200)] + [("c", 999, 8), ("c", 999, 8), ("a", 998, None)]
    return spans, points


def inside(p, s):
    return p[0] is not None and p[0] == s[0] and None not in (p[2], s[2], s[3]) and 0 <= s[2] <= p[2] < s[3]


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_all_pairs(spark, seed):
    spans, points = made(seed)
    left = spark.createDataFrame(points, "doc string, p long, at long")
    right = spark.createDataFrame(spans, "doc string, s long, start long, end long")
    pairs = intervals.holding(left, right)
    assert pairs.columns == ["doc", "p", "at", "s", "start", "end"]
    assert sorted((r.p, r.s) for r in pairs.collect()) == sorted((p[1], s[1]) for p in points for s in spans if inside(p, s))
    got = intervals.covered(left, right).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((*p, any(inside(p, s) for s in spans)) for p in points), key=repr)
    for leaf in (1, 6, 20):
        pairs = intervals.holding(left, right, leaf=leaf)
        assert pairs.columns == ["doc", "p", "at", "s", "start", "end"]
        assert sorted((r.p, r.s) for r in pairs.collect()) == sorted((p[1], s[1]) for p in points for s in spans if inside(p, s))
        assert sorted(map(tuple, intervals.covered(left, right, leaf=leaf).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    none = right.limit(0)
    assert intervals.holding(left, none).collect() == [] and {r.covered for r in intervals.covered(left, none).collect()} == {False}


def test_cells_are_the_interval(spark):
    rows = spark.range(0, 70).crossJoin(spark.range(0, 70).withColumnRenamed("id", "stop")).withColumn("c", intervals.cells(F.col("id"), F.col("stop"))).collect()  # a fixed small grid
    for r in rows:
        held = [x for c in r.c or () for x in range(c.cell << c.size, (c.cell + 1) << c.size)]
        assert sorted(held) == list(range(r.id, r.stop)) and len(r.c or ()) <= 14


def test_no_candidate_is_formed_in_vain(spark):
    """Rows that the join makes are the pairs, and a long document is many keys."""
    points = spark.range(20000).select(F.lit("d").alias("doc"), F.col("id").alias("at"))
    spans = spark.range(0, 20000, 10).select(F.lit("d").alias("doc"), F.col("id").alias("start"), (F.col("id") + 25).alias("end"))
    own = intervals._celled(spans, "doc", "start", "end")
    keys = own.groupBy("_doc", "_size", "_at").count()
    assert keys.agg(F.max("count")).first()[0] <= 6 and keys.count() > 3000
    assert intervals.holding(points, spans).count() == sum(min(25, 20000 - s) for s in range(0, 20000, 10))


def test_what_leaves_meet_in_vain(spark):
    """With leaves the rows that meet are the pairs and what stands in the rest of the leaves at the ends."""
    points = spark.range(20000).select(F.lit("d").alias("doc"), F.col("id").alias("at"))
    spans = spark.range(0, 20000, 10).select(F.lit("d").alias("doc"), F.col("id").alias("start"), (F.col("id") + 300).alias("end"))
    own = intervals._celled(spans, "doc", "start", "end", 6)
    met = intervals._named(points, own, "doc", "at", 6).join(own.drop("doc"), ["_doc", "_size", "_at"]).count()
    pairs = intervals.holding(points, spans, leaf=6).count()
    assert pairs == sum(min(300, 20000 - s) for s in range(0, 20000, 10)) and pairs < met <= pairs + 2000 * 2 * 63
    assert own.select("_size").distinct().count() <= 5 < intervals._celled(spans, "doc", "start", "end").select("_size").distinct().count()


def test_long_intervals_are_split(spark):
    """A few long intervals add no size to the points; what they are split into at most doubles the cells."""
    assert intervals.top({}) == 0 and intervals.top({intervals.PART: 9}) == 0 and intervals.top({3: 1}) == 3 and intervals.top({0: 100, 5: 1, 6: 1}) == 0 and intervals.top({0: 10, 5: 1}) == 2
    assert intervals.top({0: 1 << 50, 39: 1}) == 29
    spans = spark.range(0, 5000).select(F.lit("d").alias("doc"), (F.col("id") * 7).alias("start"), (F.col("id") * 7 + F.when(F.col("id") == 9, 20000).otherwise(5)).alias("end"))
    whole = intervals._celled(spans, "doc", "start", "end")
    own, sizes = intervals._split(whole)
    assert sizes == own.select("_size").distinct().orderBy("_size").toPandas()["_size"].tolist() and len(sizes) < whole.select("_size").distinct().count()
    assert own.count() <= 2 * whole.count()
    points = spark.range(0, 35000, 3).select(F.lit("d").alias("doc"), F.col("id").alias("at"))
    want = sum(1 for k in range(5000) for p in range(-(-7 * k // 3) * 3, min(7 * k + (20000 if k == 9 else 5), 35000), 3))
    for leaf in (0, 3):
        assert intervals.holding(points, spans, leaf=leaf).count() == want


def test_places_in_texts(spark):
    texts = ["", "one, two\n\n" + "t" * 11 + " " + "f" * 12 + "\n", "é" * 9 + " 𝒳" + "x" * 9, None, "a\rb\n,"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(udfs.line_places(F.col("t")).alias("l"), udfs.word_places(F.col("t"), 9).alias("w")).collect()
    assert [r.l and [tuple(x) for x in r.l] for r in got] == [[(0, 0, 0, -1)], [(0, 0, 8, 3), (1, 9, 0, -1), (2, 10, 24, -1), (3, 35, 0, -1)], [(0, 0, 20, -1)], None, [(0, 0, 3, -1), (1, 4, 1, 0)]]
    assert [r.w and [tuple(x) for x in r.w] for r in got] == [[], [(10, "t" * 11), (22, "f" * 12)], [(0, "é" * 9), (10, "𝒳" + "x" * 9)], None, []]


def swept(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (s[0], -s[1])):
        last = next((k for k in reversed(kept) if not k[3]), None)
        hidden = last is not None and s[1] <= last[1]
        if hidden and not (s[2] and s[0] > last[0]):
            continue
        kept.append((*s, hidden))
    return sorted(k[:3] for k in kept)


def test_widest(spark):
    rng = random.Random(5)
    for _ in range(4):
        spans = sorted({(s := rng.randint(0, 60), s + rng.randint(1, 15), rng.random() < 0.3) for _ in range(40)})
        spans = list({s[:2]: s for s in spans}.values())
        df = spark.createDataFrame([("d", *s) for s in spans], "doc string, start long, end long, stay boolean")
        assert sorted(tuple(r)[1:] for r in intervals.widest(df, stays=F.col("stay")).collect()) == swept(spans)
        assert sorted(tuple(r)[1:3] for r in intervals.widest(df).collect()) == [s[:2] for s in swept([(a, b, False) for a, b, _ in spans])]


def loop(wanted, taken):
    out, used, rest = [], set(taken) | set(wanted), []
    seen = set(taken)
    for n in wanted:
        (rest if n in seen else out).append((n, n))
        seen.add(n)
    for n, _ in rest:
        stem, dot, suffix = n.rpartition(".") if "." in n else (n, "", "")
        k = 2
        while f"{stem}-{k}{dot}{suffix}" in used:
            k += 1
        used.add(f"{stem}-{k}{dot}{suffix}")
        out.append((n, f"{stem}-{k}{dot}{suffix}"))
    return sorted(out)


@pytest.mark.parametrize("seed", range(5))
def test_free_names_are_free(spark, seed):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(["a", "b-2", "a-2", "a-02", "a-2-2", "c.d"]) + rng.choice(["", "-2", "-3", "-5", "-0"]) + rng.choice([".md", ""]) for _ in range(n)]
    wanted, taken = some(60), some(25)
    if seed == 0:
        wanted, taken = ["a.md", "a-2.md"], []
    df = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    got = sorted(tuple(r) for r in sinks.free_names(df(wanted), df(taken)).collect())
    assert len({f for _, f in got}) == len(wanted) and not {f for _, f in got} & set(taken)
    assert got == loop(wanted, taken)
