"""URL filters, exact search, token counts and the SentencePiece codec."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import sentencepiece_codec, token_counts, topk, url_filter
from ledgerlens.llm.queries import MODEL
from ledgerlens.llm.vocabulary import load_pieces

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "https://example.com/en/", "https://example.com/en", "https://a.b.example.com/fr/",
    "http://badexample.com/en/1", "http://x.net/es/1", "http://net/es/", "http://x.net/essay", "http://x.net", "ftp://x.org/a/login?x", "http://ads.foo.org/",
    "http://pre://second.com/", "http://x.org/archive.zip", "http://x.org:80/cart/", "http://x.org/cartoon", "http://x.net/fr/#a", "http://x.com", "http://x.com?q=/",
]


def verdict(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    hits = [(r.is_host, len(r.name), r.name, r.action) for r in rules if url is not None and re.search(r.regex, host + path)]
    best = max(hits) if hits else (False, 0, None, "allow")
    return host, path, best[2] if best[0] else None, best[3]


def test_urls(spark):
    rows = [(i if i % 5 else None, u, "clash") for i, u in enumerate(URLS + URLS[4:6])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = url_filter.HOST_RULES + url_filter.PATTERNS + (url_filter.pattern_rule("block", "a rule without a token", r"^second\."),)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(((i, *verdict(u, rules)) for i, u, _ in rows), key=key)


def test_rules_from_a_table(spark):
    """50,000 host rules; the plan holds none of them as a literal."""
    many = spark.range(50_000).select(
        F.concat(F.lit("site"), "id", F.lit(".org/")).alias("name"), F.when(F.col("id") % 2 == 0, "block").otherwise("allow").alias("action"),
        F.concat(F.lit(r"^(?:[^/]*\.)?site"), "id", F.lit(r"\.org/")).alias("regex"),
        F.array(F.concat(F.lit("site"), "id"), F.lit("org")).alias("tokens"), F.lit(True).alias("is_host"),
    )
    free = url_filter.pattern_rule("block", "a rule without a token", r"^second\.")
    rules = many.union(spark.range(1).select(F.inline(url_filter.rule_array((free, url_filter.PATTERNS[0])))))
    urls = [f"http://{'www.' if i % 3 else ''}site{i}.org/{'x' * (i % 5)}" for i in range(0, 60_000, 500)] + ["http://second.org/", "http://ads.x.org/", None]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_filter.judge_urls(df, rules)
    got = {r.page_id: (r.rule, r.verdict, r.pattern) for r in out.collect()}
    n = len(urls) - 3
    for i in range(n):
        k = i * 500
        want = (f"site{k}.org/", "block", None) if k < 50_000 else (None, "allow", None)
        assert got[i] == want
    assert [got[n + j] for j in range(3)] == [(None, "block", "a rule without a token"), (None, "block", "ad host"), (None, "allow", None)]
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    with pytest.raises(ValueError):
        url_filter.judge_urls(df, many.withColumn("tokens", F.array().cast("array<string>")))


def test_urls_without_rules(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(df, url_filter.PATTERNS[:1]).collect()] == ["allow"]


def test_tokens_are_in_every_match():
    assert url_filter.host_rule("block", "example.com/en/").tokens == ("example", "com", "en")
    assert url_filter.host_rule("block", "example.com/en").tokens == ("example", "com")


def best(rows, k, scale=64):
    valid = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in dict.fromkeys((i, tuple(v)) for i, v in valid if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("chunk, block", [(topk.CHUNK, topk.QUERY_BLOCK), (5, 3)])
def test_top_k(spark, chunk, block):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)] + [rows[7]] * 30 + [(400, [0.1]), (420, []), (440, None), (None, [1.0] * 6), (460, [None] * 6), (480, [float("nan")] * 6), (500, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, x string").repartition(3)
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, chunk=chunk, query_block=block)
    assert sorted(map(tuple, got.collect())) == best(f32, 20)


@pytest.mark.parametrize("size", [10.0, 1e6, 1e12 / 64])
def test_top_k_wide_components(spark, size, monkeypatch):
    """Components of two, four and eight bytes; a block's visits in several tasks."""
    monkeypatch.setattr(topk, "SPREAD", 3)
    monkeypatch.setattr(topk, "SLICE", 4)
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-size, size) if i % 7 else size / (1 + i % 3)] * (1 + i % 2) + [rnd.uniform(-1, 1)]) for i in range(400)]
    rows = [(i, [x if size < 1e9 else x / 1e3 for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, chunk=7, query_block=6)
    assert sorted(map(tuple, got.collect())) == best(padded(rows), 20)


def padded(rows):
    width = max(len(v) for _, v in rows)
    return [(i, v + [0.0] * (width - len(v))) for i, v in rows]


def test_top_k_scores_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e12, 1e9]), (1, [1e8, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        topk.top_k(df, F.col("vec_id") % 20 == 0)


def test_top_k_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0]), (3, [0.5])], "vec_id long, embedding array<double>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (20, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0).collect())) == best(rows, 20)


# token counts


def greedy(word, begin, go_on):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (go_on if at else begin)), None)
        if end is None:
            return None
        n, at = n + 1, end
    return n


def test_automaton_is_greedy_longest_match():
    rnd = random.Random(6)
    begin = ("a", "ab", "abcd", "b", "bcx", "c")
    go_on = ("a", "b", "bc", "c", "cab", "d", "bcdab")
    auto = token_counts.Automaton(begin, go_on)
    for _ in range(4000):
        w = "".join(rnd.choice("abcdx") for _ in range(rnd.randint(1, 12)))
        want = greedy(w, set(begin), set(go_on))
        assert auto.count(w) == (token_counts.UNKNOWN + 1 if want is None else want), w


def test_token_counts(spark):
    begin, go_on = token_counts.split_vocabulary(MODEL)
    b, g = set(begin), set(go_on)
    texts = [None, "", " \n", "hello world", "unbelievable tokenization!", "字 é ▁ 𝄞𝄞", "a" * 3000, "x y  z\u000bq"]
    df = spark.createDataFrame([(i if i else None, t, "clash") for i, t in enumerate([*texts, "hello"])], "doc_id long, text string, n string")
    for i, n_words, n_tokens, n_unknown in token_counts.token_counts(df, MODEL).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", ([*texts, "hello"][i or 0]) or "")
        counts = [greedy(w, b, g) for w in words]
        assert (n_words, n_tokens, n_unknown) == (len(words), sum(1 if c is None else c for c in counts), counts.count(None))


# SentencePiece

TEXTS = ["", " ", "  a", "▁", "a▁ b", "\x00 é字𝄞\n\n  x ", "▁▁ ▁", "internationalization " * 30, "a" * 500, "-" * 300, " " * 200, "the cat  sat ▁ on é字𝄞 " * 40, "x y " * 100]


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(load_pieces(MODEL))


def test_round_trip(codec):
    for t in TEXTS:
        assert codec.decode(codec.encode(t).tolist()) == t


def test_best_segmentation(codec):
    """All segmentations of short texts, scored."""

    def every(s, at=0):
        if at == len(s):
            yield 0
        for length, score, _ in codec.matches(s, at) if at < len(s) else ():
            for rest in every(s, at + length):
                yield score + rest

    rnd = random.Random(8)
    scores = dict(zip(codec.pieces.id, codec.pieces.score))
    for _ in range(200):
        t = "".join(rnd.choice("the ain字") for _ in range(rnd.randint(1, 9)))
        ids = codec.encode(t).tolist()
        got, at = 0, 0
        while at < len(ids):
            if ids[at] in scores:
                got, at = got + scores[ids[at]], at + 1
            else:  # the bytes of one character
                lead = codec.pieces.byte.index(ids[at])
                got, at = got + codec.unknown_score, at + (1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4)
        assert got == max(every(codec.escape(t)))


def test_matrix_product_is_associative():
    rnd = np.random.default_rng(1)
    a, b, c = rnd.integers(-50, 0, (3, 1, 5, 5))
    p = sentencepiece_codec.product
    assert (p(p(a, b), c) == p(a, p(b, c))).all()
    m = rnd.integers(-50, 0, (7, 5, 5))
    whole = m[:1]
    for i in range(1, 7):
        whole = p(whole, m[i : i + 1])
        assert (sentencepiece_codec.prefix_products(m)[i] == whole[0]).all()


@pytest.mark.parametrize("chunk", [17, 40])
def test_chunks_equal_one_pass(spark, codec, chunk):
    rows = [(i, t) for i, t in enumerate([*TEXTS, TEXTS[7], None])] + [(None, TEXTS[8])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    out = sentencepiece_codec.encode(df, codec.pieces, chunk=chunk)
    out = out.withColumn("back", sentencepiece_codec.text_column(F.col("ids"), codec.pieces)).collect()
    assert len(out) == len(rows)
    for r in out:
        t = r.row.text
        assert r.back == t
        assert r.ids == (None if t is None else codec.encode(t).tolist())
        assert r.decoded_sha256 == (None if t is None else hashlib.sha256(t.encode()).hexdigest())


@pytest.mark.parametrize("chunk", [17, 23, 64, 300])
def test_chunks_by_matrices(codec, chunk):
    """The scan without Spark, over texts with few and many unit ends."""
    rnd = random.Random(chunk)
    for _ in range(60):
        t = "".join(rnd.choice("the ain-字▁ \n") if rnd.random() < 0.9 else "a" * rnd.randint(1, 90) for _ in range(rnd.randint(chunk, 400)))
        places = sentencepiece_codec.split_places(len(t), chunk, codec.longest)
        parts = [sentencepiece_codec._chunk(codec, t[a : b + codec.longest], i, b - a) for i, (a, b) in enumerate(places)]
        m = np.stack([codec.transfer(*p) for p in parts])
        first = np.full((1, codec.longest), sentencepiece_codec.NEVER, np.int64)
        first[0, 0] = 0
        v = np.concatenate([first, sentencepiece_codec.prefix_products(m)[:-1, 0, :]])
        state, ids = 0, []
        for p, start in reversed(list(zip(parts, v.tolist()))):
            ids.insert(0, codec.chunk_ids(*p, start, state).tolist())
            state = codec.entries(*p, start)[state]
        assert state == 0
        whole = codec.escape(t)
        one_pass = codec.trace(whole, codec.forward(whole, len(whole), [0]), len(whole))[1].tolist()
        assert sum(ids, []) == codec.encode(t).tolist() == one_pass
