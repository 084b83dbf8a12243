"""Fill-in-the-middle, importance resampling and the word transducer against brute force and the tokenizers library; odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.llm import fim, lexicon, resampling
from folioframe.llm.common import spool
from folioframe.llm.tokens import default_tokenizer

ODD = [
    (1, "the quick brown fox jumps over the lazy dog"), (2, "the quick brown fox jumps over the lazy dog"), (3, None), (4, ""), (5, " \n\t "), (6, "word " * 3000), (7, "é ü ñ 日本"), (7, "é ü ñ 日本"),
    (None, "nobody knows this one at all"), (8, "12 34 !!"), (-9, "a\nb\nthe same long line"), (10, "x" * 9000), (11, "cut <M> here"), (12, "\0 zero <|endoftext|> end"), (13, " <P"), (14, "S> <S"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    return spool(rows.withColumns({n: F.lit("x") for n in ("n", "row", "words", "form", "bucket", "ids", "score", "first")}), "odd")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# ---- 11


def cut(i, t, rate=50):
    t = t or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    n, d = len(tokens), hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not t or any(m in t for m in fim.MARKERS) or h[2] % 100 >= rate:
        return i, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    return (i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else (i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["a", "é", "日", "<", "P", ">", "<P>" if k % 5 == 0 else "S", "M", " ", "\n", "\x0b", "\xa0", "xyz "]) for _ in range(rng.randint(0, 60))) for k in range(n)]


def test_scan_finds_every_end():
    for t in texts(1, 200):
        data = t.encode()
        scan = fim.Scan(data)
        for state in range(4):  # every entry, by walking
            at, ends, marks = state, [], 0
            for i, b in enumerate(data):
                kind = fim._KIND[b]
                if fim._ENDS[at, kind]:
                    ends.append(i)
                marks += fim._MARKS[at, kind]
                at = fim._NEXT[at, kind]
            assert (scan.next[state], scan.ends[state], scan.marks[state]) == (at, len(ends), marks)
            assert [scan.select(state, k + 1) for k in range(len(ends))] == ends


@pytest.mark.parametrize(("chunk", "fan", "rate"), [(7, 2, 100), (16, 3, 50), (fim.CHUNK, fim.FAN, 100)])
def test_cuts_equal_brute_force(spark, odd, chunk, fan, rate):
    """Texts of many chunks, and groups of groups of them, give what one pass gives; the text comes back from output and form alone."""
    data = [(k, t) for k, t in enumerate(texts(2, 150))] + ODD[:5] + [(6, "word  " * 90)] + ODD[6:]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = fim.transform(df, rate=rate, chunk=chunk, fan=fan).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((cut(*x, rate) for x in data), key=repr)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in data)


def test_odd_rows_are_transformed(odd, none):
    got = fim.transform(odd, chunk=4000).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((cut(*x) for x in ODD), key=repr)
    assert fim.transform(none).collect() == []


# ---- 12


def features(t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def resampled(docs, bench, percent=5):
    def buckets(rows):
        return Counter(zlib.crc32(f.encode()) % 10000 for _, x in rows for f in features(x)[1])

    s, t = buckets(docs), buckets(bench)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)}
    out = []
    for i, x in docs:
        words, fs = features(x)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((o for o in out if o[5] >= 20), key=lambda o: (-o[3], o[0] is not None, o[0]))
    for k, o in enumerate(fit[: percent * len(fit) // 100]):
        o[4] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize(("parts", "size"), [(3, 10**6), (1, 500), (40, 61)])
def test_resampling_equals_brute_force(spark, parts, size):
    """Blocks of many documents, and documents of many blocks, whose features go on from one to the next."""
    rng = random.Random(5)
    data = [(k, " ".join(rng.choice(["a", "A", "b", "é", "ÉÉ", "x1", "the", "_", "1", "-"]) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    data += [(200 + k, t) for k, t in ODD if k] + [(900, " ab cd" * 400)]
    bench = [(1, "a b é the 1"), (2, None), (3, "quick brown fox")]
    df = spool(spark.createDataFrame(data, "doc_id long, text string").repartition(2), "docs")
    got = resampling.resample(df, spark.createDataFrame(bench, "item_id long, text string"), percent=30, parts=parts, block_bytes=size)
    assert sorted(map(tuple, got.collect()), key=repr) == resampled(data, bench, 30)


def test_odd_rows_are_weighed(spark, odd, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = resampling.resample(odd, bench, percent=60).collect()
    assert sorted(map(tuple, got), key=repr) == resampled(ODD, [], 60)
    assert resampling.resample(none, bench).collect() == []


def test_other_rows_when_read_again_end_the_job(spark):
    rows = spool(spark.createDataFrame([(1, "one two three")], "doc_id long, text string"), "docs")
    path = resampling._hashed(rows, 4, frozenset(), 100)
    other = spool(spark.createDataFrame([(1, "one two three four")], "doc_id long, text string"), "docs")
    with pytest.raises(Exception, match="not the same"):
        resampling._weights(other, path, 4, frozenset(), 100, np.zeros(10000, np.int64)).collect()


def test_hot_words_are_spread():
    """A word that begins nearly all features doesn't name their part alone."""
    f = resampling.Features([b" ".join(b"hot w%d" % k for k in range(3000))], 0)
    for hot, most in ((frozenset(), 6000), (frozenset([b"hot"]), 1200)):
        sizes = Counter()
        for part, data in f.sent(16, hot):
            sizes[part] += len(resampling.received(data)[0])
        assert sum(sizes.values()) == sum(f.sizes)
        assert max(sizes.values()) < most or not hot
    strings = Counter(s for _, d in f.sent(16, frozenset([b"hot"])) for s in resampling.received(d)[0].to_pylist())
    assert set(strings.values()) == {1}


def test_features_are_hashed_together(monkeypatch):
    """All short strings at once, without a call for each; the long ones alone."""
    import zlib

    import pyarrow as pa

    rng = np.random.default_rng(5)
    made = [rng.bytes(int(n)) for n in rng.choice([0, 1, 2, 3, 9, 63, 64, 65, 66, 400], 40_000)]
    wanted = [zlib.crc32(x) for x in made]
    calls, crc32 = [], zlib.crc32
    monkeypatch.setattr(resampling.zlib, "crc32", lambda x: calls.append(len(x)) or crc32(x))
    strings = pa.array(made, pa.large_binary())
    assert resampling._crcs(strings).tolist() == wanted
    assert min(calls) > resampling.SHORT and len(calls) == sum(len(x) > resampling.SHORT for x in made)
    for at, n in ((7, 33_000), (39_999, 1), (40_000, 0)):
        assert resampling._crcs(strings.slice(at, n)).tolist() == wanted[at : at + n]
    calls.clear()
    sum(1 for _ in resampling.Features([b" ".join(b"w%d" % k for k in range(3000))], 0).sent(16))
    assert not calls


def test_hot_words_need_no_longer_features():
    """Blocks of words alone have the words, counts and tails of whole blocks, also where a text goes on."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 50, int(n))) for n in (0, 1, 2, 30, 900, 3)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])]
    whole, words = list(resampling.blocks(batches, 200)), list(resampling.blocks(batches, 200, words_only=True))
    assert len(whole) == len(words) > 5
    for a, b in zip(whole, words, strict=True):
        assert (a.keys, a.goes_on, a.features.tail, a.features.words.to_pylist()) == (b.keys, b.goes_on, b.features.tail, b.features.words.to_pylist())
        assert a.features.counts[0].tolist() == b.features.counts[0].tolist()
        assert len(b.features.sizes) == 1


def test_buckets_packed():
    for n in (0, 1, 2, 3, 1000):
        x = np.random.default_rng(n).integers(0, 10000, n)
        assert resampling.unpack(resampling.pack(x), n).tolist() == x.tolist()


# ---- 13


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def strings(seed, n):
    rng = random.Random(seed)
    parts = ["a", "  ", "\n", "<|endoftext|>", "é", "日本", "1", "\0", "'s", " the", "x" * 40, " ", "\xa0", "🎉", "‍", "ﬀ", " \t", "\r\n", "\0" + "5\0", "İ", "!!", "_", "٣", "Ⅷ", "²", "ing", " walking", "<|endof"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_merges_equal_the_library(library):
    merges, rng = lexicon.Merges(default_tokenizer()), random.Random(4)
    for word in ["a", "aaaaaaaaaaaaa", "thethethe", "x" * 3000, *("".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 30))) for _ in range(500))]:
        assert merges.encode(word.encode()) == [t.id for t in library.model.tokenize(word)]


def test_transducer_is_minimal_and_exact():
    """Accepts its words and no others, with their ids; no two states do the same; endings are shared."""
    rng = random.Random(6)
    for _ in range(60):
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))): tuple(rng.randint(0, 3) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 40))}
        arrays = lexicon.compile_words(words)
        run = lexicon.Transducer(lexicon.to_bytes(arrays)).run
        asked = [*words, *(bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 7))) for _ in range(100))]
        accepted, ids, at = run(asked)
        for k, w in enumerate(asked):
            assert accepted[k] == (w in words)
            assert tuple(ids[at[k] : at[k + 1]]) == words.get(w, ())
        n, starts = len(arrays["accepts"]), arrays["starts"]
        out = [tuple(arrays["ids"][starts[e] : starts[e + 1]]) for e in range(len(starts) - 1)]
        does = [(arrays["accepts"][s], out[len(arrays["keys"]) + s], tuple((k & 255, arrays["targets"][e], out[e]) for e, k in enumerate(arrays["keys"]) if k >> 8 == s)) for s in range(n)]
        assert len(set(does)) == n
    endings = lexicon.compile_words({a + b"ing": (k,) for k, a in enumerate([b"walk", b"talk", b"sing", b"go"])})
    assert len(endings["accepts"]) < len(b"walkingtalkingsinginggoing") - 2 * len(b"ing")


@pytest.mark.parametrize("words", [0, 5, 100_000])
def test_ids_and_texts_equal_the_library(spark, odd, library, words):
    data = [(k, t) for k, t in enumerate(strings(7, 300))] + ODD
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)

    def want(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return i, ids, library.decode(ids, skip_special_tokens=False)

    expected = [want(*x) for x in data]
    encoded = lexicon.encode(df, words=words)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=repr) == sorted(((i, ids) for i, ids, _ in expected), key=repr)
    assert sorted(((r.doc_id, r.text) for r in lexicon.decode(encoded).collect()), key=repr) == sorted(((i, t) for i, _, t in expected), key=repr)
    digest = [(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, ids, t in expected]
    assert sorted(map(tuple, lexicon.digests(df, words=words).collect()), key=repr) == sorted(digest, key=repr)


def test_long_texts_in_slices(library):
    code = lexicon.Encoder(default_tokenizer(), None)
    for t in strings(8, 60):
        long_ = t * 30
        parts = list(lexicon.slices(long_, 50))
        assert "".join(parts) == long_
        ids, _ = code.encode(parts)
        assert ids.tolist() == library.encode(long_, add_special_tokens=False).ids


def test_odd_rows_are_encoded(odd, none, library):
    got = lexicon.encode(odd).collect()
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in ODD), key=repr)
    assert lexicon.encode(none).collect() == []
    assert lexicon.digests(none).collect() == []


def test_decode_of_any_ids(spark, library):
    ids = [[200, 50256], [], None, [128, 129, 130], [-1, 60000, 11]]
    got = {r.doc_id: r.text for r in lexicon.decode(spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>")).collect()}
    assert got == {0: library.decode([200, 50256], skip_special_tokens=False), 1: "", 2: None, 3: library.decode([128, 129, 130], skip_special_tokens=False), 4: library.decode([11])}
