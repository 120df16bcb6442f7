"""The whole pipeline against a brute-force version of its stages."""

from collections import Counter

import numpy as np
from test_llm_documents import counts, groups, ring_key, spans, words

import corpus_pipeline
from ledgerlens.llm import mixing, quality_rules, secret_scan, sentencepiece_codec
from ledgerlens.llm.vocabulary import load_pieces

SF = "/root/testdata/sf0.01"


def masked(text):
    out, at = "", 0
    for a, _, b, _ in spans(text)[1]:
        if a >= at:
            out += text[at:a] + secret_scan.MASK
        at = max(at, b)
    return out + text[at:]


def mixed(rows):
    """(doc_id, text) as often as the mix takes it; rows: doc_id, source, text."""
    size = Counter()
    for _, source, text in rows:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, total = {}, 1.5 * sum(size.values())
    while True:
        rest = {s for s in order if s not in target}
        level = (total - sum(target.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * level > 2 * size[s]]
        if not over:
            target |= {s: weight[s] * level for s in rest}
            break
        target |= {s: 2.0 * size[s] for s in over}
    out = []
    for s in order:
        taken = int(target[s])
        ring = sorted((ring_key(d, t), d, t) for d, source, t in rows if source == s)
        at = 0
        for _, d, t in ring:
            n = len(words(t))
            part = max(0, min(n, taken % size[s] - at))
            out += [(d, t)] * (taken // size[s] + (0 < part == n))
            if 0 < part < n:
                out.append((d, " ".join(words(t)[:part])))
            at += n
    return out


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "lang", "source", "text").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality_rules.quality_rules(docs, labels).collect()
    # with this few labels no cutoff can be guaranteed: the base rules decide
    kept = {r.doc_id for r in judged if r.kept}
    assert kept == {d for d, _, _, t in rows if not counts(t)[-1]}
    rows = [(d, s, t) for d, _, s, t in rows if d in kept]
    least = {c for _, _, c in groups([(d, t) for d, _, t in rows])}
    assert len(least) < len(rows)
    rows = [(d, s, masked(t)) for d, s, t in rows if d in least]
    assert any(secret_scan.MASK in t for _, _, t in rows)
    want = mixed(rows)
    codec = sentencepiece_codec.Codec(load_pieces(corpus_pipeline.MODEL))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, codec.decode(r.ids)) for r in got) == sorted(want)
    ids = dict(zip(want, codec.encode_many([t for _, t in want])))
    assert all(np.array_equal(r.ids, ids[r.doc_id, codec.decode(r.ids)]) and r.n_tokens == len(r.ids) for r in got)
