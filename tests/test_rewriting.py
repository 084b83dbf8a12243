"""Sources of image tags rewritten, against a substitution by a pattern."""

import random
import re

from pyspark.sql import functions as F

from folioframe.operators import evidence

TAG = re.compile(r'(<img[^>]*?src=")([^"]+)(")')


def test_rewritten(spark):
    rng = random.Random(3)
    sources = ["a.png", "b.png", "c.png", "x y", "$1", "\\"]
    maps = {d: {s: rng.choice([*sources, "new/" + s]) for s in sources if rng.random() < 0.6} for d in range(40)}  # also in a ring: a to b, b to a
    parts = ['<img src="{}">', '<img alt="q" src="{}" >', '<a src="{}">', "text {}", '<img\nsrc="{}"/>', '<img src="">', "<img>", "é\n\n"]
    texts = {d: "".join(rng.choice(parts).format(rng.choice(sources)) for _ in range(rng.randint(0, 12))) for d in maps} | {90: None, 91: ""}
    want = {d: None if t is None else TAG.sub(lambda m, d=d: m[1] + maps.get(d, {}).get(m[2], m[2]) + m[3], t) for d, t in texts.items()}
    table = spark.createDataFrame(list(texts.items()), "doc long, content string").withColumn("k", F.lit("clash"))
    mapping = spark.createDataFrame([(d, s, f) for d, m in maps.items() for s, f in m.items()], "doc long, src string, file string")
    got = evidence.rewritten(table, mapping)
    assert got.columns == table.columns and {r.doc: r.content for r in got.collect()} == want
    by_map = mapping.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("src", "file"))).alias("m"))
    assert {r.doc: r.new for r in table.join(by_map, "doc").select("doc", evidence.rewrite_images(F.col("content"), F.col("m")).alias("new")).collect()} == {d: want[d] for d in want if maps.get(d)}
    assert {r.doc: r.content for r in evidence.rewritten(table, mapping.limit(0)).collect()} == texts
    assert evidence.rewritten(table.limit(0), mapping).collect() == []
    nameless = spark.createDataFrame([(None, '<img src="a.png">')], "doc long, content string")
    assert [r.content for r in evidence.rewritten(nameless, mapping).collect()] == ['<img src="a.png">']
