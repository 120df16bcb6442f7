"""Greedy word-piece lengths by a linear longest-match automaton (operator 6).

The vocabulary is a trie with two roots, one for pieces that begin a word and
one for pieces that continue it.  Every node has a failure link and the number
of pieces popped on taking it: if the node's string cannot be extended by the
next character, its longest-match pieces are already known, so they are counted
and matching goes on at the node of what is left.  A word is read once, each
character and each link in constant time, and only counts are kept: no piece
is ever built.  A word that the vocabulary cannot cover is one unknown token.

Words are the runs between white space, taken unchanged.  The pieces come from
a SentencePiece file: those with a leading space sign begin a word, the others
continue one.

Defined results: null, empty and wordless texts have no tokens; very long
words are counted like any other; repeated rows and null ids keep their rows;
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship
from ledgerlens.llm.pywords import word_blocks
from ledgerlens.llm.vocabulary import SPACE, load_pieces

BEGIN, CONTINUE = 0, 1  # the roots
CACHE = 1 << 18  # words whose counts a task keeps
UNKNOWN = 1 << 40  # added to a count of one for a word that cannot be covered


class Automaton:
    """``count(word)``: the number of greedy longest-match pieces."""

    def __init__(self, begin: tuple[str, ...], go_on: tuple[str, ...]) -> None:
        self.next: list[dict[str, int]] = [{}, {}]
        ends: set[int] = set()
        for root, pieces in ((BEGIN, begin), (CONTINUE, go_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                    node = self.next[node][c]
                if node != root:
                    ends.add(node)
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        # by depth: links lead to shorter strings
        todo = deque([BEGIN, CONTINUE])
        while todo:
            node = todo.popleft()
            for c, child in self.next[node].items():
                todo.append(child)
                if child in ends:
                    self.fail[child], self.popped[child] = CONTINUE, 1
                    continue
                count, left = self.popped[node], self.fail[node]
                while left != -1 and c not in self.next[left]:
                    count += self.popped[left]
                    left = self.fail[left]
                if left != -1:
                    self.fail[child], self.popped[child] = self.next[left][c], count

    def count(self, word: str) -> int:
        node, count = BEGIN, 0
        for c in word:
            while c not in self.next[node]:
                if self.fail[node] == -1:
                    return UNKNOWN + 1
                count += self.popped[node]
                node = self.fail[node]
            node = self.next[node][c]
        while node != CONTINUE:
            if self.fail[node] == -1:
                return UNKNOWN + 1
            count += self.popped[node]
            node = self.fail[node]
        return count


class _Counts(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word.decode())
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = n
        return n


@lru_cache(maxsize=2)
def _counts(begin: tuple[str, ...], go_on: tuple[str, ...]) -> _Counts:
    """Built once in a worker process."""
    return _Counts(Automaton(begin, go_on))


def split_vocabulary(path: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The pieces of a SentencePiece file that begin and that continue a word."""
    pieces = load_pieces(path).text
    begin = tuple(p[1:] for p in pieces if p.startswith(SPACE) and SPACE not in p[1:] and len(p) > 1)
    return begin, tuple(p for p in pieces if SPACE not in p)


def counts_column(text: Column, begin: tuple[str, ...], go_on: tuple[str, ...]) -> Column:
    """A struct: n_words, n_tokens, n_unknown."""

    def count(texts: pd.Series) -> pd.DataFrame:
        known, out = _counts(begin, go_on), []
        for t in texts:
            words = total = 0
            for block in word_blocks((t or "").encode()):
                words += len(block)
                total += sum(map(known.__getitem__, block))
            out.append((words, total % UNKNOWN, total // UNKNOWN))
        return pd.DataFrame(out, columns=["n_words", "n_tokens", "n_unknown"], dtype="int64")

    count.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(count, "n_words long, n_tokens long, n_unknown long")(text)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens, n_unknown."""
    ship(docs.sparkSession)
    n = counts_column(F.col("text"), *split_vocabulary(path)).alias("n")
    return docs.select("doc_id", n).select("doc_id", "n.n_words", "n.n_tokens", "n.n_unknown")
