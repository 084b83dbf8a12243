"""The ten operators against brute force, round trips and held-out labels; odd inputs for each."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.llm import decontaminate, exact_dedup, langid, line_dedup, minhash, packing, sstable, toxicity, url_filter, warc
from folioframe.llm.common import connected_components
from folioframe.llm.tokens import Encoder, default_tokenizer

#: Nulls, empty and blank texts, a very long text, ties, rows that repeat, and columns whose names operators use.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "en", 1), (2, "the quick brown fox jumps over the lazy dog", None, 2), (3, None, "en", None), (4, "", "en", 3), (5, " \n\t ", "de", 4),
    (6, "word " * 30000, "en", 5), (7, "é ü ñ 日本", "de", 6), (7, "é ü ñ 日本", "de", 6), (None, "nobody knows this one at all", "en", 7), (8, "12 34 !!", None, 8), (-9, "a\nb\nthe same long line stands here\nthe same long line stands here", "en", 9),
]
SCHEMA = "doc_id long, text string, lang string, kept int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).withColumn("sequence_id", F.lit("x")).withColumn("component_id", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    for df in (
        packing.pack_documents(none), line_dedup.dedup_lines(none), exact_dedup.exact_dedup(none), warc.round_trip(pages), decontaminate.leaks(none, bench), toxicity.classify(none, labels), langid.identify(none),
        minhash.near_components(none, 3, 85), url_filter.url_filter(pages, rules), sstable.round_trip(none),
        toxicity.clean(none, None), line_dedup.clean(none), minhash.clean(none), decontaminate.clean(none, bench),
    ):
        assert df.collect() == []


# ---- 1


def optimum(items, capacity):
    best = [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in {x: i for i, x in enumerate(bins)}.values():
            if bins[b] + items[k] <= capacity:
                go(k + 1, [x + items[k] if i == b else x for i, x in enumerate(bins)])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(3)
    for _ in range(400):
        capacity = rng.choice([10, 16, 20])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        fixed, rest = packing.reduce_dominated(dict(Counter(items)), capacity)
        left = [n for n, c in rest.items() for _ in range(c)]
        assert sum(k for _, k in fixed) + (optimum(left, capacity) if left else 0) == optimum(items, capacity)
        plan = packing.plan_sequences(dict(Counter(items)), capacity)
        held = Counter()
        for content, times in plan:
            assert sum(content) <= capacity
            for n in content:
                held[n] += times
        assert held == Counter(items)


def check_packing(rows, texts, capacity=1024):
    encoder = Encoder(default_tokenizer())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
    for doc, text, copies in texts:
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[doc], key=lambda r: (r.piece, r.start))
        assert sum(r.length for r in own) == copies * len(ids)
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            assert r.length == capacity or r.piece == 0


def test_packing(odd):
    check_packing(packing.pack_documents(odd).collect(), [(k, t, 2 if k == 7 else 1) for k, t, *_ in ODD])


def test_encoder_equals_the_library():
    e = Encoder(default_tokenizer(), cache=50)
    texts = ["", " ", "a  b", " a", "a ", "it's the <|endoftext|> x's\n\n\nFoo \n bar", "x y z² 12½", "\n\nA b\n", "don't stop. 'tis", "a\t b", "³ a 日本 語", "\x1c a\x1cb c", "Über*** den%%% 12.5,", "a\nb", "é" * 50]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab é1.,'\n \t<日²") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    ids, at = e.encode(texts)
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


# ---- 2


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(spark, edits):
    rng, pairs = random.Random(edits), []
    for _ in range(150):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 1)):
            if rng.random() < 0.5 and b:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.choice("abé"))
        pairs.append((a, "".join(b)))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), edits).alias("d")).collect()
    for r in got:
        d = levenshtein(r.a, r.b)
        assert r.d == (d if d <= edits else None), (r, d)


@pytest.mark.parametrize("edits", [1, 2])
def test_line_dedup(spark, edits):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 40))).strip() for _ in range(12)]
    docs = []
    for d in range(40):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                line[rng.randrange(len(line))] = rng.choice("abcxyz")
            own.append("".join(line))
        docs.append((d, "\n".join([*own, "x", ""])))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), edits=edits).collect()}
    seen, kept_once = [], set()
    for d, text in docs:
        left = []
        for line in text.split("\n"):
            bare = line.strip(" \t\r")
            if len(bare) >= 12 and bare in kept_once:
                continue
            near = len(bare) >= 24 and any(len(o) >= 24 and abs(len(o) - len(bare)) <= edits and levenshtein(o, bare) <= edits for o in seen)
            if len(bare) >= 12:
                kept_once.add(bare)
                seen.append(bare)
            if not near:
                left.append(line)
        assert got[d].text == "\n".join(left), d


def test_line_dedup_odd(odd):
    got = line_dedup.clean(odd)
    assert got.columns == odd.columns and got.count() == len(ODD)
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[-9] == "a\nb\nthe same long line stands here" and texts[3] is None and texts[4] == "" and texts[1] == ODD[0][1] and texts[2] == ""
    assert texts[None] == "nobody knows this one at all"


# ---- 3


@pytest.mark.parametrize("cells", [1 << 28, 1 << 15])
def test_exact_dedup(spark, odd, cells):
    rows = [(k, t) for k, t, *_ in ODD] + [(100 + k, f"text {k % 7}" if k % 3 else "hot") for k in range(300)] + [(1000 + k, f"only {k}") for k in range(500)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), max_cells=cells).collect()
    groups: dict = {}
    for k, t in rows:
        groups.setdefault(t or "", []).append(k)
    want = sorted((repr(k), repr(max((x for x in ks if x is not None), default=None)), len(ks)) for ks in groups.values() for k in ks)
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id is not None)


# ---- 4


def test_warc(spark):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a.b/", big), (2, None, big), (3, "http://c\r\nX: y", "small"), (4, "u", "small"), (5, "u", None), (6, "u", "\r\n\r\n" * 800), (7, "u", ""), (8, "u", "x" * 300_000)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert len(got) == len(rows)
    assert (got[1].record_type, got[1].refers_to) == ("revisit", 2) and got[2].record_type == "response" and got[3].record_type == got[4].record_type == "response"
    assert got[1].payload_bytes == len(big.encode()) and got[5].payload_bytes == 0 and got[8].payload_bytes == 300_000


def test_warc_reader_is_strict():
    import hashlib

    digest = hashlib.sha1(b"hello").hexdigest()
    good = warc.member(1, "u", b"hello", digest, "response", None)
    file = io.BytesIO(good + warc.member(2, "u", b"hello", digest, "revisit", 1))
    assert [r["headers"]["warc-type"] for r in warc.records(file, 7)] == ["response", "revisit"]
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(good[:-9]), 7))
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(warc.member(1, "u", b"hullo", digest, "response", None))))


# ---- 5


def test_decontamination(spark, odd):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(rng.randint(12, 40)))) for k in range(30)] + [(30, "two words"), (31, None), (32, "")]
    filler = lambda n: " ".join(word() for _ in range(n))
    docs = []
    for d in range(60):
        own = items[d % 30][1].split()
        if d % 4 == 1:
            own[len(own) // 2] = "changed"
        if d % 4 == 2:
            own = own[1:]
        docs.append((d, f"{filler(20)} {' '.join(own).upper() if d % 2 else ' '.join(own)} {filler(20)}"))
    docs += [(100, "it has two words in it"), (101, items[0][1][:60]), (102, None), (103, "")]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}

    def bag(w):
        return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()

    want = {}
    for d, text in docs:
        w = (text or "").lower().split()
        for i, item in items:
            own = (item or "").lower().split()
            best = 0
            for p in range(max(1, len(w) - len(own) + 1)) if own and w else ():
                a, b = bag(w[p : p + len(own)]), bag(own)
                common = sum((a & b).values())
                best = max(best, common / (sum(a.values()) + sum(b.values()) - common))
            if best >= 0.8:
                want[d, i] = best
    assert got == pytest.approx(want)
    assert (100, 30) in got
    left = decontaminate.clean(odd, spark.createDataFrame([(1, ODD[0][1])], "item_id long, text string"))
    assert left.columns == odd.columns and sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(k) for k, *_ in ODD if k not in (1, 2))


@pytest.mark.parametrize("expand", [True, False])
def test_hamming_blocks_find_all(expand):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 40, dtype=np.uint64)
    index = decontaminate.Index([(k, Counter(), int(p)) for k, p in enumerate(prints)], 19, 4, expand)
    probe = prints.repeat(20).copy()
    for k in range(len(probe)):
        for b in rng.choice(64, rng.integers(0, 24), replace=False):
            probe[k] ^= np.uint64(1) << np.uint64(b)
    place, item = index.within(probe)
    want = {(p, i) for p in range(len(probe)) for i in range(len(prints)) if int(probe[p] ^ prints[i]).bit_count() <= 19}
    assert set(zip(place.tolist(), item.tolist(), strict=True)) == want


# ---- 6 and 7


def test_toxicity(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["der", "wind", "geht", "still", "und", "fern", "haus", "berg"]) + rng.choice(["", "en", "er"])
    docs, labels = [], []
    for d in range(900):
        bad = d % 4 == 0
        text = [word() for _ in range(rng.randint(5, 60))]
        for _ in range(3 if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["blarg", "snork"]) + rng.choice(["", "ix", "um"]))
        docs.append((d, " ".join(text)))
        labels.append((d, int(bad)))
    docs += [(2000, None), (2001, ""), (2002, "?!")]
    got = {r.doc_id: r for r in toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [d for d, _ in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d].held_out for d in held)
    assert sum(got[d].predicted == dict(labels)[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= got[d].score <= 1 for d in got) and got[2000].score == got[2001].score


def test_language(spark):
    rng = random.Random(4)
    parts = {"aa": ["tion", "the", "ing", "wh"], "bb": ["sch", "ung", "der", "ö"], "cc": ["eau", "que", "ré", "oi"]}
    docs = [(d, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 40))), lang) for d in range(600) for lang in [rng.choice(list(parts))]]
    docs += [(1000, None, "aa"), (1001, "12 .", None), (1002, "тест", None)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    held = [(d, lang) for d, _, lang in docs[:600] if zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(got[d].lang_pred == lang for d, lang in held) >= 0.98 * len(held)
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1002].lang_pred != "und"


def test_code_lengths_are_exact():
    """Against the definition, byte by byte."""
    words = [["abab", "abc"], ["ba", "bé"]]
    grams: dict = {}
    for lang, own in enumerate(words):
        for w in own:
            raw = b" " + w.encode() + b" "
            for i in range(1, len(raw)):
                for k in range(min(i, 4) + 1):
                    grams[lang, k, raw[i - k : i + 1]] = grams.get((lang, k, raw[i - k : i + 1]), 0) + 1
    columns = zip(*[(lang, k, int.from_bytes(g, "big"), n) for (lang, k, g), n in grams.items()], strict=True)
    model = langid.Model(tuple(np.array(c) for c in columns), ["x", "y"], 4)
    tests = ["abab", "ba", "zz", "é", "abcab"]
    got = model.bits([t.encode() for t in tests])
    for t, row in zip(tests, got, strict=True):
        raw = b" " + t.encode() + b" "
        for lang in (0, 1):
            bits = 0.0
            for i in range(1, len(raw)):
                for k in range(min(i, 4), -1, -1):
                    context = raw[i - k : i]
                    follow = {g[-1]: n for (v, j, g), n in grams.items() if v == lang and j == k and g[:-1] == context}
                    if not follow:
                        continue
                    whole = sum(follow.values()) + len(follow)
                    if raw[i] in follow:
                        bits -= np.log2(follow[raw[i]] / whole)
                        break
                    bits -= np.log2(len(follow) / whole)
                else:
                    bits += 8
            assert row[lang] == pytest.approx(bits)


# ---- 8


def brute_components(rows, width, percent):
    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()

    own = {k: shingles(t) for k, t in rows if k is not None}
    up = {k: k for k in own}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in own:
        for b in own:
            if a < b and own[a] and own[b] and 100 * len(own[a] & own[b]) >= percent * len(own[a] | own[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {k: (len(own[k]), top(k)) for k in own}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_components(spark, odd, width, percent):
    rng = random.Random(width)
    rows = [(k, t) for k, t, *_ in ODD]
    for g in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([4, 30, 80]))]
        for _ in range(30):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(own))] = f"z{rng.randint(0, 400)}"
            rows.append((100 + len(rows), " ".join(own)))
    got = minhash.near_components(spark.createDataFrame(rows, "doc_id long, text string"), width, percent).collect()
    want = brute_components(rows, width, percent)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    left = minhash.clean(odd)
    assert left.columns == odd.columns and sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(k) for k in {k for k, *_ in ODD} - {2})


def test_sketch_agrees_as_often_as_the_sets():
    rng = np.random.default_rng(3)
    for size in (1, 5, 400):
        shares = []
        for _ in range(40):
            both = rng.integers(0, 2**63, size, dtype=np.uint64)
            a, b = (np.unique(np.concatenate((both, rng.integers(0, 2**63, size, dtype=np.uint64)))) for _ in "ab")
            x, y = minhash.sketch(a, 240), minhash.sketch(b, 240)
            assert x.max() < 2**63 and y.max() < 2**63
            shares.append((x == y).mean())
        assert np.mean(shares) == pytest.approx(1 / 3, abs=0.05)


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {100: 100, 101: 100}


# ---- 9


def test_url_filter(spark):
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("Example.NET", "/de/8", "block"), (None, "/", "block"), ("org", None, "block"), ("org", "", "allow")]
    urls = ["http://www.Example.com/en/71?x", "https://a.com/en/7", "http://com/en/", "http://xcom/en/", "ftp://b.net/de/", "http://example.net/de/8#f", None, "", "no scheme", "http://", "http://a.org", "http://a.org?q=/en/"]
    pages = spark.createDataFrame([(k, u, 1) for k, u in enumerate([*urls, urls[0]])] + [(0, urls[0], 1)], "page_id long, url string, rule int")
    got = url_filter.url_filter(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    by = {r.page_id: (r.rule, r.verdict) for r in got}
    assert len(got) == len(urls) + 2
    assert [by[k] for k in range(len(urls))] == [
        ("example.com/en/7", "allow"), ("com/en/", "block"), ("com/en/", "block"), (None, "allow"), ("net/de/", "block"), ("example.net/de/8", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        ("org", "block"), ("org", "block"),
    ]


# ---- 10


def test_tables(spark, odd):
    manifest = sstable.write_tables(odd, sstable.fresh_path(spark, "sst"))
    got = sorted(sstable.read_tables(manifest).collect(), key=lambda r: r.start)
    encoder, at = Encoder(default_tokenizer()), 0
    order = sorted(((k, t) for k, t, *_ in ODD), key=lambda x: (x[0] is not None, x[0] or 0))
    for r, (k, t) in zip(got, order, strict=True):
        ids = np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert [len(sstable.lookup(manifest, k)) for k in (-9, 1, 7, 12345)] == [1, 1, 2, 0]


def test_table_format():
    out = io.BytesIO()
    writer = sstable.Writer(out, 2)
    rng = random.Random(1)
    rows = [(k * 3 - 5000, np.array([rng.randint(0, 50000) for _ in range(rng.randint(0, 400))])) for k in range(3000)]
    for k, v in rows:
        writer.add(sstable.key_of(k), v)
    writer.close()
    raw = out.getvalue()
    reader = sstable.Reader(io.BytesIO(raw), len(raw))
    assert len(reader.blocks) > 3
    assert [(sstable.id_of(k), v.tolist()) for k, v in reader.entries()] == [(k, v.tolist()) for k, v in rows]
    assert all(reader.get(k)[0].tolist() == v.tolist() for k, v in rows[::97]) and reader.get(5) == [] and sum(reader.may_hold(sstable.key_of(k)) for k in range(10**6, 10**6 + 2000)) < 60
    broken = bytearray(raw)
    broken[5] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(sstable.Reader(io.BytesIO(bytes(broken)), len(raw)).entries())
    with pytest.raises(ValueError, match="cut short|no footer"):
        sstable.Reader(io.BytesIO(raw[:-1]), len(raw) - 1)
