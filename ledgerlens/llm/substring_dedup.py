"""Removal of repeated passages by super-k-mer partitioning (operator 2).

A window is ``WINDOW`` consecutive words of one document.  A word goes if some
window over it also starts in a document with a smaller doc_id, word for word.
Windows are judged on the input, not on what is left.

A window's minimiser is the smallest hash among its runs of ``MER`` words, so
equal windows have equal minimisers, and consecutive windows mostly share one.
Consecutive windows that share it travel as one packed string, the words from
the first window's start to the last one's end, to the bucket of the
minimiser.  In the bucket the windows are cut out again and sorted, and a run
of equal windows gives the smallest doc_id that holds them.

Only strings that can matter travel.  A first pass over the texts lists the
super-k-mers by minimiser and the 128 bits of their string's digest, and those
whose minimiser is in a single document are dropped.  Of the rest, equal
strings are merged by a partial aggregate to the smallest doc_id that holds
them.  A string in any other document goes as a whole, without a look into it.
In that first document it can only meet other strings of its minimiser, and
only if one of them has another first document: these strings alone are packed
and shuffled, once each, however many copies the corpus has and however often
the document itself repeats them; what a string loses is then joined back to all
its places in that document.  The documents are shuffled once by id; packing and
the final removal both read that exchange.

Buckets are bounded.  A minimiser with more than ``HOT`` different strings (a
passage in a large share of all documents, each time among other words) is
never gathered: its windows are counted one by one by their 128-bit digest, as
a partial aggregate, so equal windows meet as one row per task and different
ones spread over all tasks.

Defined results: null, empty and wordless texts have no words and an empty
kept text; texts shorter than a window lose nothing; rows with a null doc_id
neither take nor lose words; repeated rows, and rows with one doc_id and
different texts, are each judged by their own text and never against the same
doc_id; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import durable_table, ship, text_of
from ledgerlens.llm.pywords import word_blocks

WINDOW = 50
MER = 8
HOT = 4096
LONGEST = 64  # windows in one packed string
CACHE = 1 << 18  # word hashes kept by a task


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def minimisers(hashes: np.ndarray, window: int, mer: int) -> np.ndarray:
    """The minimiser of each window of word hashes."""
    n = len(hashes) - mer + 1
    runs = np.zeros(n, np.uint64)
    for i in range(mer):
        runs = _mixed(runs + hashes[i : i + n])
    # sliding minimum over `span` runs by doubling
    span, have = window - mer + 1, 1
    while have < span:
        step = min(have, span - have)
        runs = np.minimum(runs[: len(runs) - step], runs[step:])
        have += step
    return runs


def super_kmers(text: str | None, known: _Hashes, window: int, mer: int) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """(minimiser, first window, windows, the words from the first on) of each super-k-mer."""
    base, tail = 0, []
    for block in word_blocks((text or "").encode()):
        w = tail + block
        if len(w) >= window:
            least = minimisers(np.fromiter(map(known.__getitem__, w), np.uint64, len(w)), window, mer).view(np.int64)
            cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
            starts = [0, *cuts.tolist(), len(least)]
            for a, b in zip(starts, starts[1:]):
                for at in range(a, b, LONGEST):
                    yield int(least[at]), base + at, min(LONGEST, b - at), w[at : at + min(LONGEST, b - at) + window - 1]
            keep = window - 1
        else:
            keep = len(w)
        base += len(w) - keep
        tail = w[len(w) - keep :]


def _minimiser_rows(window: int, mer: int):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for batch in batches:
            found = [
                (m, *struct.unpack("<qq", xxhash.xxh3_128_digest(b" ".join(w))), d, h, s << 8 | n)
                for d, h, t in zip(batch.doc_id, batch.th, batch.text)
                for m, s, n, w in super_kmers(t, known, window, mer)
            ]
            for at in range(0, len(found), 1 << 16):
                yield pd.DataFrame(found[at : at + (1 << 16)], columns=["mh", "h1", "h2", "doc_id", "th", "at"])

    return rows


def _spans(batch: pd.DataFrame) -> Iterator[tuple[int, int, bytes, list[tuple[int, int, int]]]]:
    for d, h, t, spans in zip(batch.doc_id, batch.th, batch.text, batch.spans):
        yield d, h, t.encode().split(), sorted((s["start"], s["n"], s["mh"]) for s in spans)


def _packed_rows(window: int):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, h, w, spans in _spans(batch):
                out += [(mh, d, h, s, b" ".join(w[s : s + n + window - 1])) for s, n, mh in spans]
                if len(out) > 1 << 14:
                    yield pd.DataFrame(out, columns=["mh", "doc_id", "th", "start", "packed"])
                    out = []
            yield pd.DataFrame(out, columns=["mh", "doc_id", "th", "start", "packed"])

    return rows


def _digest_rows(window: int):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, h, w, spans in _spans(batch):
                for s, n, _ in spans:
                    out += [(xxhash.xxh3_128_digest(b" ".join(w[i : i + window])), d, h, s, i - s) for i in range(s, s + n)]
                if len(out) > 1 << 14:
                    yield pd.DataFrame(out, columns=["digest", "doc_id", "th", "start", "a"])
                    out = []
            yield pd.DataFrame(out, columns=["digest", "doc_id", "th", "start", "a"])

    return rows


def _bucket(rows: list[tuple[int, int, int, bytes]], window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Of the packed strings of one minimiser: the strings and the word spans in them to remove."""
    if min(r[0] for r in rows) == max(r[0] for r in rows):
        return
    windows = []
    for row, (doc, _, _, packed) in enumerate(rows):
        ends = [i for i, c in enumerate(packed) if c == 32] + [len(packed)]
        at = 0
        for i in range(len(ends) - window + 1):
            windows.append((packed[at : ends[i + window - 1]], doc, row, i))
            at = ends[i] + 1
    windows.sort()
    hits: dict[int, list[int]] = {}
    last, first = None, 0
    for w, doc, row, i in windows:
        if w != last:
            last, first = w, doc
        elif doc > first:
            hits.setdefault(row, []).append(i)
    for row, found in hits.items():
        doc, th, start, _ = rows[row]
        found.sort()
        a = b = found[0]
        for i in found[1:]:
            if i > b + 1:
                yield doc, th, start, a, b + window
                a = i
            b = i
        yield doc, th, start, a, b + window


def _bucket_rows(window: int):
    """Over partitions sorted by minimiser: one bucket at a time."""

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for batch in batches:
            out = []
            for mh, *row in zip(batch.mh, batch.doc_id, batch.th, batch.start, batch.packed):
                if mh != key:
                    if held:
                        out += _bucket(held, window)
                    key, held = mh, []
                held.append(tuple(row))
            yield pd.DataFrame(out, columns=["doc_id", "th", "start", "a", "b"])
        if held:
            yield pd.DataFrame(list(_bucket(held, window)), columns=["doc_id", "th", "start", "a", "b"])

    return rows


def repeated_spans(docs: DataFrame, window: int = WINDOW, mer: int = MER, hot: int = HOT) -> DataFrame:
    """Word spans (doc_id, th, start, end) to remove from ``docs`` (doc_id, text, th)."""
    # `at` holds the first window's place and, in its last 8 bits, how many there are
    found = durable_table(
        docs.mapInPandas(_minimiser_rows(window, mer), "mh long, h1 long, h2 long, doc_id long, th long, at long")
    )
    several = found.groupBy("mh").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("mh")
    found = durable_table(found.join(several, "mh", "left_semi"))
    string = ["mh", "h1", "h2"]
    first = found.groupBy(*string).agg(F.min("doc_id").alias("lo"))
    shared = first.groupBy("mh").agg(F.min("lo").alias("a"), F.max("lo").alias("b"), F.count(F.lit(1)).alias("strings"))
    first = first.join(shared.where("a < b").select("mh", "strings"), "mh", "left")
    met = found.join(first, string).where("doc_id > lo OR strings IS NOT NULL")
    start, n = F.expr("cast(shiftright(at, 8) AS int)").alias("start"), F.expr("cast(at & 255 AS int)").alias("n")
    met = durable_table(met.select(*string, "doc_id", "th", start, n, "lo", "strings"))
    whole = met.where("doc_id > lo").select("doc_id", "th", "start", (F.col("start") + F.col("n") + (window - 1)).alias("end"))
    # one place of each string in its first document stands for all
    places = met.where("doc_id = lo")
    one = places.groupBy(*string).agg(F.min(F.struct("th", "start", "n")).alias("one"), F.min("doc_id").alias("doc_id"), F.max("strings").alias("strings"))
    one = durable_table(one.select(*string, "doc_id", "one.th", "one.start", "one.n", "strings"))
    spans = one.groupBy("doc_id", "th", (F.col("strings") > hot).alias("hot"))
    spans = durable_table(spans.agg(F.collect_list(F.struct("start", "n", "mh")).alias("spans")))
    usual = docs.join(spans.where("NOT hot"), ["doc_id", "th"])
    packed = usual.mapInPandas(_packed_rows(window), "mh long, doc_id long, th long, start int, packed binary")
    lost = packed.repartition("mh").sortWithinPartitions("mh").mapInPandas(_bucket_rows(window), "doc_id long, th long, start int, a int, b int")
    if not spans.where("hot").isEmpty():
        crowded = docs.join(spans.where("hot"), ["doc_id", "th"])
        # not cut off from the plan, so that it reads the same exchange of the texts
        each = crowded.mapInPandas(_digest_rows(window), "digest binary, doc_id long, th long, start int, a int")
        least = each.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("digest", "lo")
        more = each.join(least, "digest").where("doc_id > lo").select("doc_id", "th", "start", "a", (F.col("a") + window).alias("b"))
        lost = lost.union(more)
    back = one.select(*string, F.col("doc_id").alias("d"), F.col("th").alias("h"), F.col("start").alias("at"))
    lost = lost.join(back, (F.col("doc_id") == F.col("d")) & (F.col("th") == F.col("h")) & (F.col("start") == F.col("at"))).select(*string, "a", "b")
    out = places.join(lost, string).select("doc_id", "th", (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b")).alias("end"))
    return out.union(whole)


def _removed_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for d, t, spans in zip(batch.doc_id, batch.text, batch.spans):
            w = (t or "").encode().split()
            kept, at = [], 0
            for s, e in sorted((s["start"], s["end"]) for s in (spans if spans is not None else ())):
                kept += w[at:s]
                at = max(at, e)
            kept += w[at:]
            out.append((d, len(w), len(w) - len(kept), b" ".join(kept).decode()))
        yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"})


def substring_dedup(docs: DataFrame, window: int = WINDOW, mer: int = MER, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept, the
    words left, joined by one space."""
    if mer >= window:
        raise ValueError("the minimiser's run must be shorter than the window")
    ship(docs.sparkSession)
    every = docs.select("doc_id", text_of("text").alias("text"), F.xxhash64("text").alias("th"))
    known = every.where("doc_id IS NOT NULL")
    spans = repeated_spans(known, window, mer, hot)
    spans = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    none = F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans")
    rows = known.join(spans, ["doc_id", "th"], "left").select("doc_id", "text", "spans")
    rows = rows.union(every.where("doc_id IS NULL").select("doc_id", "text", none))
    return rows.mapInPandas(_removed_rows, "doc_id long, n_words long, n_removed long, kept string")
