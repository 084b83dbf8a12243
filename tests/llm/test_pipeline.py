"""The pipeline's stages on a small table: decisions take effect, clean documents stay, columns stay."""

import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-stage{k}-{os.getpid()}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns
            assert docs.select("doc_id").distinct().count() == docs.count()
        seen.append(docs.count())
    assert seen[0] >= seen[1] == seen[2] >= seen[3] >= seen[4] > 0.5 * seen[0]
    rows = docs.collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024


def _held() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="no figures of memory")
def test_freed_memory_goes_back():
    from folioframe.llm.common import give_back

    kept, start = [], _held()
    blocks = []
    for _ in range(2000):
        blocks.append(bytearray(100_000))
        kept.append(bytearray(1000))  # so that the heap can't shrink from its end
    full = _held()
    assert full - start > 150
    del blocks
    give_back()
    assert _held() - start < 50


def test_model_is_gone_after_its_stage(spark, monkeypatch):
    """The driver gives the memory of the toxicity model back before the next stage: nothing holds the model then."""
    import weakref

    from folioframe.llm import toxicity

    seen, dead = [], []

    class Judge:
        pass

    def train(_):
        judge = Judge()
        seen.append(weakref.ref(judge))
        return judge

    monkeypatch.setattr(toxicity, "train", train)
    monkeypatch.setattr(toxicity, "labelled_texts", lambda *_: None)
    monkeypatch.setattr(toxicity, "clean", lambda docs, judge: docs)
    monkeypatch.setattr(corpus_pipeline, "_table", lambda *_: None)
    monkeypatch.setattr(corpus_pipeline, "give_back", lambda: dead.append(seen[0]() is None), raising=False)
    docs = spark.range(3)
    assert corpus_pipeline.toxic(spark, docs, "") is docs
    assert dead == [True]
