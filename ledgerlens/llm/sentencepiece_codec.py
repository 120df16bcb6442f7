"""SentencePiece encoding and decoding by a max-plus parallel scan (operator 9).

A text is encoded as the sequence of vocabulary pieces with the largest sum of
scores; among equal sums, the one whose last piece is longest, then the one
before it, and so on.  Characters no piece covers become byte pieces.  Spaces
are written as the pieces write them, with one in front of the text, so that
decoding the ids gives back the text exactly.

No piece goes on behind a space sign, so the best segmentation of a text is
that of its units (spaces and the word after them) side by side.  A task
remembers the ids of units; new ones are done in sorted order, where each goes
on from the prefix it shares with the one before.

Documents longer than ``CHUNK`` characters are split into chunks at fixed
places, which may lie inside a piece.  The state at a chunk's border is how
far the piece that crosses it reaches beyond, less than the longest piece's
length.  A chunk's transfer matrix holds the best sum from each state at its
start to each state at its end; matrices multiply in max-plus algebra, which
is associative, so their prefix products (by doubling) give every chunk the
best sums at its start.  With those each chunk finds by itself, for each end
state, the start state its best path comes from; following these maps from the
document's end fixes every chunk's end state, and each chunk is traced back on
its own.  The result is that of one pass over the whole document, ties
included.  Giant documents are handled once per different text.

Defined results: a null text has null ids; an empty text has none; texts with
the space sign itself keep it, through byte pieces; repeated rows and null ids
keep their rows; an empty table gives an empty result.  All columns of the
input, or those asked for, are kept in the struct ``row``.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ledgerlens.llm.common import durable, durable_table, ship
from ledgerlens.llm.vocabulary import SPACE, Pieces

CHUNK = 65_536
CACHE = 1 << 18  # units whose ids a task keeps
NEVER = -(1 << 61)
# Stands for the space sign in a text; no text from Spark holds a lone surrogate.
SIGN = "\udc00"


class Codec:
    def __init__(self, pieces: Pieces) -> None:
        if len(pieces.byte) != 256:
            raise ValueError("the vocabulary has no byte pieces: a text could not be given back")
        self.pieces = pieces
        self.longest = max(map(len, pieces.text))
        self.unknown_score = min(pieces.score) - 10
        self.trie: dict = {}
        self.ends: dict = {}  # the same with the pieces read backwards
        for p, score, i in zip(pieces.text, pieces.score, pieces.id):
            for node, chars in ((self.trie, p), (self.ends, reversed(p))):
                for c in chars:
                    node = node.setdefault(c, {})
                node[""] = (score, i)
        if any(SPACE in p.lstrip(SPACE) for p in pieces.text):
            raise ValueError("a piece goes on behind a space sign")
        self.bytes_of = {i: p.replace(SPACE, " ").encode() for p, i in zip(pieces.text, pieces.id)}
        self.singles = {p for p in pieces.text if len(p) == 1}
        self.bytes_of |= {i: bytes([b]) for b, i in enumerate(pieces.byte)}
        self.known: dict[str, bytes] = {}

    @staticmethod
    def escape(text: str, first: bool = True) -> str:
        return SPACE * first + text.replace(SPACE, SIGN).replace(" ", SPACE)

    def matches(self, s: str, at: int) -> list[tuple[int, int, int]]:
        """(length, score, id) of the pieces at a place, shortest first; id -1
        for a character that is no piece."""
        out, node, n = [], self.trie, 0
        for c in s[at : at + self.longest]:
            node = node.get(c)
            if node is None:
                break
            n += 1
            if "" in node:
                out.append((n, *node[""]))
        if not out or out[0][0] != 1:
            out.insert(0, (1, self.unknown_score, -1))
        return out

    def forward(self, s: str, n: int, entry: list[int]) -> list[tuple[int, int, int]]:
        """Best (sum, start, id) to reach each place by pieces that start before
        ``n``; ``entry`` has the sums with which the first places are entered."""
        best = [(NEVER, -1, -1)] * (max(n, len(entry)) + self.longest)
        for i, v in enumerate(entry):
            best[i] = (v, -1, -1)
        for at in range(n):
            here = best[at][0]
            if here > NEVER // 2:
                for length, score, i in self.matches(s, at):
                    # a start further left was there first and stays on a tie
                    if here + score > best[at + length][0]:
                        best[at + length] = (here + score, at, i)
        return best

    def trace(self, s: str, best: list[tuple[int, int, int]], at: int) -> tuple[int, array]:
        """The place where the best path to ``at`` enters, and its ids."""
        back = []
        while best[at][1] >= 0:
            _, start, i = best[at]
            if i >= 0:
                back.append((i,))
            else:
                back.append([self.pieces.byte[b] for b in s[start].replace(SIGN, SPACE).encode()])
            at = start
        ids = array("i")
        for part in reversed(back):
            ids.extend(part)
        return at, ids

    def segment(self, units: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """(unit, score, ids as bytes) of sorted units."""
        best, start, piece, last = [0], [0], [0], ""
        for unit in units:
            same, least = 0, min(len(last), len(unit))
            while same < least and last[same] == unit[same]:
                same += 1
            del best[same + 1 :], start[same + 1 :], piece[same + 1 :]
            for end in range(same + 1, len(unit) + 1):
                # of the pieces that end here; a start further left wins a tie
                top, at, of, node, i = best[end - 1] + self.unknown_score, end - 1, -1, self.ends, end
                if unit[end - 1] in self.singles:
                    top = NEVER
                while i:
                    node = node.get(unit[i - 1])
                    if node is None:
                        break
                    i -= 1
                    found = node.get("")
                    if found is not None:
                        score = best[i] + found[0]
                        if score >= top:
                            top, at, of = score, i, found[1]
                best.append(top)
                start.append(at)
                piece.append(of)
            out, at = array("i"), len(unit)
            while at:
                if piece[at] >= 0:
                    out.append(piece[at])
                else:
                    out.extend(self.pieces.byte[b] for b in reversed(unit[start[at]].replace(SIGN, SPACE).encode()))
                at = start[at]
            out.reverse()
            yield unit, best[-1], out.tobytes()
            last = unit

    UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def encode_escaped(self, texts: list[str]) -> Iterator[bytes]:
        """The ids, as bytes, of texts that begin and end with whole units."""
        for at in range(0, len(texts), 256):
            units = [self.UNITS.findall(t) for t in texts[at : at + 256]]
            wanted = set().union(*units)
            if len(self.known) + len(wanted) > CACHE:
                self.known.clear()
            self.known.update((u, ids) for u, _, ids in self.segment(sorted(u for u in wanted if u not in self.known)))
            for u in units:
                yield b"".join(map(self.known.__getitem__, u))
            if max(map(len, wanted), default=0) > 64:
                for u in wanted:
                    if len(u) > 64:
                        del self.known[u]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, np.int32) for ids in self.encode_escaped([self.escape(t) if t else "" for t in texts])]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()[1:]

    # Chunks.  Every segmentation breaks where a unit ends, so a chunk with
    # such places is its head, whole units and its tail; only head and tail
    # depend on the states.

    def _borders(self, s: str, n: int) -> tuple[int, int]:
        """The first and the last place where a unit ends, 0 if there is none."""
        ends = re.finditer(f"(?<=[^{SPACE}]){SPACE}", s[:n])
        first = last = 0
        for m in ends:
            first, last = first or m.start(), m.start()
        return first, last

    def _matrix(self, s: str, n: int) -> np.ndarray:
        """Best sums from each of the first places to each place from ``n`` on."""
        size = self.longest
        best = np.full((n + size, size), NEVER, np.int64)
        entries = np.arange(min(size, n + size))
        best[entries, entries] = 0
        for at in range(n):
            for length, score, _ in self.matches(s, at):
                np.maximum(best[at + length], best[at] + score, out=best[at + length])
        return np.maximum(best[n:].T, NEVER)

    def transfer(self, s: str, n: int) -> np.ndarray:
        """The max-plus matrix of a chunk of ``n`` places (``s`` goes on beyond)."""
        first, last = self._borders(s, n)
        if not first:
            return self._matrix(s, n)
        head = self._matrix(s[:first], first)[:, 0]
        body = self.UNITS.findall(s[first:last])
        scores = {u: score for u, score, _ in self.segment(sorted(set(body)))}
        tail = self.forward(s[last:], n - last, [0])
        tail = np.array([tail[n - last + j][0] for j in range(self.longest)], np.int64)
        return np.maximum(head[:, None] + sum(map(scores.__getitem__, body)) + tail[None, :], NEVER)

    def entries(self, s: str, n: int, v: list[int]) -> list[int]:
        """For each end state the start state its best path comes from."""
        first, _ = self._borders(s, n)
        if first:
            came = self.trace(s, self.forward(s[:first], first, v[: first + 1]), first)[0]
            return [came] * self.longest
        best = self.forward(s, n, v)
        return [self.trace(s, best, n + j)[0] if best[n + j][0] > NEVER // 2 else -1 for j in range(self.longest)]

    def chunk_ids(self, s: str, n: int, v: list[int], state: int) -> np.ndarray:
        """The ids of the pieces that start in the chunk, given its end state."""
        first, last = self._borders(s, n)
        if not first:
            return np.asarray(self.trace(s, self.forward(s, n, v), n + state)[1])
        head = self.trace(s, self.forward(s[:first], first, v[: first + 1]), first)[1]
        body = b"".join(self.encode_escaped([s[first:last]]))
        tail = self.trace(s[last:], self.forward(s[last:], n - last, [0]), n - last + state)[1]
        return np.frombuffer(head.tobytes() + body + tail.tobytes(), np.int32)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of stacks of matrices."""
    out = np.full(a.shape, NEVER, np.int64)
    for k in range(a.shape[-1]):
        np.maximum(out, a[..., :, k, None] + b[..., k, None, :], out=out)
    return out


def prefix_products(m: np.ndarray) -> np.ndarray:
    """Of a stack of matrices, by doubling."""
    m, step = m.copy(), 1
    while step < len(m):
        m[step:] = product(m[:-step], m[step:])
        step *= 2
    return m


def split_places(n: int, size: int, least: int) -> list[tuple[int, int]]:
    """Chunks of ``size`` characters, the last between ``least`` and ``size + least``."""
    starts = list(range(0, n, size))
    if len(starts) > 1 and n - starts[-1] < least:
        starts.pop()
    return list(zip(starts, [*starts[1:], n]))


@lru_cache(maxsize=2)
def codec(pieces: Pieces) -> Codec:
    """Built once in a worker process."""
    return Codec(pieces)


IDS = pa.list_(pa.field("element", pa.int32(), True))


def _coded(pieces: Pieces, size: int = 256):
    """Rows (row, text) to (row, ids, decoded_sha256), a few at a time, so that
    a task holds one batch of texts and the ids of a small part of it."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(pieces)
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                texts = part.column("text").to_pylist()
                ids = c.encode_many([t or "" for t in texts])
                back = [None if t is None else hashlib.sha256(c.decode(i.tolist()).encode()).hexdigest() for t, i in zip(texts, ids)]
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                none = pa.array([t is None for t in texts])
                listed = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32()), type=IDS, mask=none)
                yield pa.RecordBatch.from_arrays([part.column("row"), listed, pa.array(back, pa.string())], ["row", "ids", "decoded_sha256"])

    return rows


def text_column(ids: Column, pieces: Pieces) -> Column:
    """The text that the ids encode."""

    def decode(rows: pd.Series) -> pd.Series:
        c = codec(pieces)
        return pd.Series([None if r is None else c.decode(r.tolist()) for r in rows], dtype=object)

    decode.__annotations__ = {"rows": pd.Series, "return": pd.Series}
    return F.pandas_udf(decode, "string")(ids)


_CHUNK = "key string, c int, n int, s string"


def _split(pieces: Pieces, size: int):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longest = codec(pieces).longest
        for b in batches:
            for key, text in zip(b.key, b.text):
                for i, (lo, hi) in enumerate(split_places(len(text), size, longest)):
                    yield pd.DataFrame([(key, i, hi - lo, text[lo : hi + longest])], columns=["key", "c", "n", "s"])

    return rows


def _chunk(c: Codec, s: str, i: int, n: int) -> tuple[str, int]:
    """A chunk's escaped characters and its number of places: the first has
    the space in front of the text as well."""
    return c.escape(s, i == 0), n + (i == 0)


def _transfers(pieces: Pieces):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(pieces)
        for b in batches:
            yield pd.DataFrame({"key": b.key, "c": b.c, "m": [c.transfer(*_chunk(c, s, i, n)).tobytes() for s, i, n in zip(b.s, b.c, b.n)]})

    return rows


def _starts(pieces: Pieces):
    """Of all matrices of a text: the best sums at each chunk's start."""

    def rows(group: pd.DataFrame) -> pd.DataFrame:
        size, group = codec(pieces).longest, group.sort_values("c")
        m = np.frombuffer(b"".join(group.m), np.int64).reshape(-1, size, size)
        first = np.full((1, size), NEVER, np.int64)
        first[0, 0] = 0
        v = np.concatenate([first, prefix_products(m)[:-1, 0, :]])
        return pd.DataFrame({"key": group.key, "c": group.c, "v": [r.tolist() for r in v]})

    return rows


def _entries(pieces: Pieces):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(pieces)
        for b in batches:
            came = [c.entries(*_chunk(c, s, i, n), list(map(int, v))) for s, i, n, v in zip(b.s, b.c, b.n, b.v)]
            yield pd.DataFrame({"key": b.key, "c": b.c, "came": came})

    return rows


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """Follow the maps from the text's end: each chunk's end state."""
    group = group.sort_values("c", ascending=False)
    state, out = 0, []
    for came in group.came:
        out.append(state)
        state = int(came[state])
    return pd.DataFrame({"key": group.key, "c": group.c, "state": out})


def _traces(pieces: Pieces):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(pieces)
        for b in batches:
            ids = []
            for s, i, n, v, state in zip(b.s, b.c, b.n, b.v, b.state):
                ids.append(c.chunk_ids(*_chunk(c, s, i, n), list(map(int, v)), state))
            yield pd.DataFrame({"key": b.key, "c": b.c, "ids": ids})

    return rows


def giant_ids(texts: DataFrame, pieces: Pieces, chunk: int = CHUNK) -> DataFrame:
    """key, ids of texts (key, text), by the scan over chunks."""
    if chunk <= max(map(len, pieces.text)):
        raise ValueError("a chunk must be longer than the longest piece")
    parts = durable_table(texts.mapInPandas(_split(pieces, chunk), _CHUNK).repartition("key", "c"))
    m = parts.mapInPandas(_transfers(pieces), "key string, c int, m binary")
    v = durable(m.groupBy("key").applyInPandas(_starts(pieces), "key string, c int, v array<long>"))
    known = parts.join(v, ["key", "c"])
    came = known.mapInPandas(_entries(pieces), "key string, c int, came array<int>")
    state = came.groupBy("key").applyInPandas(_ends, "key string, c int, state int")
    ids = known.join(state, ["key", "c"]).mapInPandas(_traces(pieces), "key string, c int, ids array<int>")
    return ids.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("c", "ids"))).alias("p")).select("key", F.flatten("p.ids").alias("ids"))


def encode(docs: DataFrame, pieces: Pieces, chunk: int = CHUNK, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``carry``, default: all), ``ids`` and
    ``decoded_sha256``, the digest of the text decoded from the ids again."""
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*(docs.columns if carry is None else carry)).alias("row"), "text")
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    schema = StructType([rows.schema["row"], StructField("ids", ArrayType(IntegerType())), StructField("decoded_sha256", StringType())])
    short = rows.where(~giant).mapInArrow(_coded(pieces), schema)
    long = rows.where(giant).withColumn("key", F.sha2("text", 256))
    coded = giant_ids(long.select("key", "text").dropDuplicates(["key"]), pieces, chunk)
    coded = coded.select("key", "ids", F.sha2(text_column(F.col("ids"), pieces), 256).alias("decoded_sha256"))
    return short.union(long.join(coded, "key").select("row", "ids", "decoded_sha256"))
