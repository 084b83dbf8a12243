"""Column functions of text against Python's."""

from pyspark.sql import functions as F

from folioframe.functions import text as T


def test_fold_every_character(spark):
    known = T.character_map()
    texts = [f"a{k}b{k}{k}" for k in known] + ["".join(known), "plain", "", "……", None, "日本 ﬁ ĲＡ……‼"]
    got = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", "t", T.fold_characters(F.col("t")).alias("folded")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.folded == (None if r.t is None else r.t.replace("……", "…").translate(str.maketrans(known))), r.t[:9]
