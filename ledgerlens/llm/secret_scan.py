"""Secret scans by patterns and sliding-window entropy (operator 5, native).

Base spans come from three patterns (assignments, access keys, hex strings).
The method adds entropy spans: a candidate is a long run of one character
class; a window of ``WIDTH`` characters slides over it while the counts of the
characters in the window are kept up to date, one character entering and one
leaving, and with them the sum of c * log2(c) over the counts c.  The window's
Shannon entropy is log2(WIDTH) - sum / WIDTH; where it reaches the class's
threshold the window is part of a secret, and overlapping windows join into
one span.  The sum is kept in whole millionths, so it never drifts and the
result does not depend on the order of additions.  Candidates that match an
anchored pattern of the allow list as a whole give no entropy spans.  Of a
candidate that holds one of the list's words only the parts with the word go,
parts being what lies between delimiters; the stretches left are candidates of
their own.  Base spans always stay.

Positions are code points, ends exclusive.  A pattern's matches are taken
together with the gap before each (``\\G(gap)(match)``, anchored at the last
match's end, so a text is read once), and positions are running sums of their
lengths.  Everything happens within the row: no shuffle, no Python.

Defined results: a null text is scanned as empty (and stays null when secrets
are masked); empty texts have no spans; a very long text is scanned and masked whole,
in time that grows with its length and its matches; repeated rows and null ids each keep
their row; an empty table gives an empty result.  Other columns are ignored
when scanning and kept when masking.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_of

WIDTH = 20
MASK = "[SECRET]"
BLOCK = 1024  # characters


class Pattern(NamedTuple):
    kind: str
    regex: str
    measured: int  # the group (0: all) whose length counts
    least: int


# Fixed values of the query's contract.
BASE = (
    Pattern("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Pattern("access", r"AKIA[A-Z0-9]+", 0, 18),
    Pattern("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16),  # a run of 16 or more begins where the run begins
)


class CharClass(NamedTuple):
    kind: str
    alphabet: str
    bits: float  # entropy from which a window counts


DIGITS = "0123456789"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", DIGITS + "ABCDEFabcdef", 3.05),
    CharClass("entropy_base64", LETTERS + DIGITS + "+/_=-", 3.64),  # 99 % of random strings of 20 letters and digits reach it
)
DELIMITERS = "+/_=-"
# Anchored patterns allow a whole candidate, the others the part that holds them.
ALLOWED = (
    r"^[0-9]+$",  # numbers
    r"^[a-z]+$",  # a word
    r"^[A-Z]?[a-z]+(?:[-/_][A-Za-z]?[a-z]+)*$",  # words joined by hyphens, slashes or underscores
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # a UUID
    r"(?i)example|sample|placeholder|changeme|dummy",
    r"ABCDEFGHIJ|abcdefghij|0123456789",  # alphabets
)

_SPANS = "array<struct<start:int,end:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, zero: Column, combine: Callable[[Column, Column], Column], chunk: int = 256) -> Column:
    """For each number of an array the combination of all before it.  Arrays
    grow only within chunks and over one number per chunk."""

    def grown(numbers: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda a, x: F.struct(combine(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(numbers, start, step, lambda a: a["out"])

    def joined_up(chunks: Column) -> Column:
        before = grown(F.transform(chunks, lambda c: F.aggregate(c, zero, combine)), zero)
        return _let(before, lambda b: F.flatten(F.transform(chunks, lambda c, j: grown(c, F.get(b, j)))))

    each = F.sequence(F.lit(0), ((F.greatest(F.size(values), F.lit(1)) - 1) / chunk).cast("int"))
    return _let(F.transform(each, lambda j: F.slice(values, j * chunk + 1, F.lit(chunk))), joined_up)


def _sums(lengths: Column) -> Column:
    return running(lengths, F.lit(0), lambda a, x: a + x)


def _found(text: str, regex: str, measured: int, least: int) -> Column:
    """The spans of a pattern's matches with their strings: start, end, hit."""
    pattern = rf"\G(?s:(.*?))({regex})"
    part = lambda i: F.regexp_extract_all(text, F.lit(pattern), i)
    rows = F.transform(
        F.arrays_zip(part(1).alias("gap"), part(2).alias("hit"), part(measured + 2).alias("measure")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), x["hit"].alias("hit"), F.length(x["hit"]).alias("long"), (F.length(x["measure"]) >= least).alias("ok")),
    )

    def spans(rows: Column) -> Column:
        placed = lambda before: F.transform(
            rows,
            lambda x, i: F.struct(
                (F.get(before, i) + x["gap"]).alias("start"), (F.get(before, i) + x["gap"] + x["long"]).alias("end"), x["hit"].alias("hit"), x["ok"].alias("ok")
            ),
        )
        every = _let(_sums(F.transform(rows, lambda x: x["gap"] + x["long"])), placed)
        return F.transform(F.filter(every, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit")))

    return F.when(F.col(text).rlike(regex), _let(rows, spans)).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def _parts(width: int) -> list[int]:
    """c * log2(c) in whole millionths, for counts c up to the width."""
    return [0, *(round(c * math.log2(c) * 1e6) for c in range(1, width + 1))]


def sum_limit(bits: float, width: int) -> int:
    """The largest sum of c * log2(c) at which a window has ``bits`` of entropy."""
    return math.floor(width * (math.log2(width) - bits) * 1e6)


def _entropy_fold(chars: Column, cls: CharClass, width: int) -> Column:
    """The spans covered by windows of high entropy, of an array of characters."""
    parts = F.array(*map(F.lit, _parts(width)))
    index = lambda i: F.instr(F.lit(cls.alphabet), F.get(chars, i)) - 1
    start = F.struct(
        F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(-1).alias("a"),
        F.lit(-1).alias("b"),
        F.array().cast(_SPANS).alias("out"),
    )

    def slide(state: Column, i: Column) -> Column:
        """The counts and their sum after one character enters and one leaves."""
        new, old = index(i), F.when(i >= width, index(i - width)).otherwise(F.lit(-1))
        more, less = F.get(state["counts"], new), F.get(state["counts"], old)
        gained = F.get(parts, more + 1) - F.get(parts, more)
        lost = F.when(old >= 0, F.get(parts, less) - F.get(parts, less - 1)).otherwise(0)
        entered = F.concat(F.slice(state["counts"], F.lit(1), new), F.array(more + 1), F.slice(state["counts"], new + 2, F.lit(len(cls.alphabet))))
        counts = F.when(old < 0, entered).otherwise(F.concat(F.slice(entered, F.lit(1), old), F.array(less - 1), F.slice(entered, old + 2, F.lit(len(cls.alphabet)))))
        return F.struct(
            F.when(new == old, state["counts"]).otherwise(counts).alias("counts"),
            F.when(new == old, state["sum"]).otherwise(state["sum"] + gained - lost).cast("long").alias("sum"),
            state["a"].alias("a"),
            state["b"].alias("b"),
            state["out"].alias("out"),
        )

    def mark(s: Column, i: Column) -> Column:
        """The open span (a, b) and the closed ones after the window that ends at i."""
        first, hit = i - width + 1, (i >= width - 1) & (s["sum"] <= sum_limit(cls.bits, width))
        fresh = hit & ((s["a"] < 0) | (first > s["b"]))
        closed = F.concat(s["out"], F.array(F.struct(s["a"].alias("start"), s["b"].alias("end"))))
        return F.struct(
            s["counts"].alias("counts"),
            s["sum"].alias("sum"),
            F.when(fresh, first).otherwise(s["a"]).alias("a"),
            F.when(hit, i + 1).otherwise(s["b"]).alias("b"),
            F.when(fresh & (s["a"] >= 0), closed).otherwise(s["out"]).alias("out"),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.size(chars) - 1),
        start,
        lambda state, i: F.transform(F.array(slide(state, i)), lambda s: mark(s, i))[0],
        lambda s: F.when(s["a"] >= 0, F.concat(s["out"], F.array(F.struct(s["a"].alias("start"), s["b"].alias("end"))))).otherwise(s["out"]),
    )


def entropy_spans(candidate: Column, cls: CharClass, width: int) -> Column:
    """The spans of a candidate string covered by windows of high entropy."""
    # a lambda variable holds the characters, so they are split only once
    return F.transform(F.array(F.split(candidate, "")), lambda chars: _entropy_fold(chars, cls, width))[0]


def _stretches(run: Column, words: str) -> Column:
    """What is left of a candidate (start, end, hit) without the parts that hold a word."""
    parts = F.transform(F.split(run["hit"], f"(?<=[{DELIMITERS}])"), lambda p: F.struct(F.length(p).alias("long"), p.rlike(words).alias("bad")))

    def between(bad: Column) -> Column:
        """From each bad part's end to the next one's start, from 0 to the run's end."""
        at = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(bad, i - 1)["end"])
        until = lambda i: F.coalesce(F.get(bad, i)["start"], F.length(run["hit"]))
        return F.transform(F.sequence(F.lit(0), F.size(bad)), lambda i: F.struct(at(i).alias("start"), until(i).alias("end")))

    def left(parts: Column) -> Column:
        placed = lambda before: F.transform(
            parts, lambda p, i: F.struct(F.get(before, i).alias("start"), (F.get(before, i) + p["long"]).alias("end"), p["bad"].alias("bad"))
        )
        every = _let(_sums(F.transform(parts, lambda p: p["long"])), placed)
        return _let(F.filter(every, lambda p: p["bad"]), between)

    return F.transform(
        F.filter(_let(parts, left), lambda x: x["end"] > x["start"]),
        lambda x: F.struct(
            (run["start"] + x["start"]).alias("start"),
            (run["start"] + x["end"]).alias("end"),
            F.substring(run["hit"], x["start"] + 1, x["end"] - x["start"]).alias("hit"),
        ),
    )


def _candidates(runs: Column, width: int, allowed: tuple[str, ...]) -> Column:
    """The runs, and stretches of runs, that the allow list lets through."""
    wholes, words = "|".join(a for a in allowed if a.startswith("^")) or "(?!)", "|".join(a for a in allowed if not a.startswith("^")) or "(?!)"
    runs = F.filter(runs, lambda x: ~x["hit"].rlike(wholes))
    stretches = lambda x: F.filter(
        _stretches(x, words), lambda y: (F.length(y["hit"]) >= width) & ~F.btrim(y["hit"], F.lit(DELIMITERS)).rlike(wholes)
    )
    return F.flatten(F.transform(runs, lambda x: F.when(x["hit"].rlike(words), stretches(x)).otherwise(F.array(x))))


def scan(docs: DataFrame, width: int = WIDTH, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` plus ``base`` and ``spans``: arrays of (start, k, end, kind)
    sorted by start, then kind (k) as listed.  The input's columns come back
    in the struct ``row``."""
    df = docs.select(F.struct("*").alias("row"), text_of(docs["text"]).alias("t"))
    spans = lambda name, k, kind: F.transform(
        name, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"), F.lit(kind).alias("kind"))
    )
    for k, p in enumerate(BASE):
        df = df.withColumn(f"found{k}", _found("t", p.regex, p.measured, p.least))
    for k, c in enumerate(classes, len(BASE)):
        one = f"[{c.alphabet.replace('-', '')}{'-' if '-' in c.alphabet else ''}]"
        df = df.withColumn(f"run{k}", _candidates(_found("t", rf"(?<!{one}){one}{{{width},}}", 0, width), width, allowed))
        df = df.withColumn(
            f"found{k}",
            F.flatten(
                F.transform(
                    f"run{k}",
                    lambda x: F.transform(
                        entropy_spans(x["hit"], c, width),
                        lambda s: F.struct((x["start"] + s["start"]).alias("start"), (x["start"] + s["end"]).alias("end")),
                    ),
                )
            ),
        )
    kinds = [p.kind for p in BASE] + [c.kind for c in classes]
    every = [spans(f"found{k}", k, kind) for k, kind in enumerate(kinds)]
    return df.select(
        "row",
        "t",
        *(F.size(f"found{k}").cast("long").alias(f"n_{p.kind}") for k, p in enumerate(BASE)),
        F.sort_array(F.concat(*every[: len(BASE)])).alias("base"),
        F.sort_array(F.concat(*every)).alias("spans"),
    )


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _how_many(sorted_spans: Column, holds: Callable[[Column], Column]) -> Column:
    """How many spans from the first on hold a condition that later ones do not, by halving."""

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        yes = (s["lo"] < s["hi"]) & holds(F.get(sorted_spans, mid))
        return F.struct(F.when(yes, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(yes | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(sorted_spans).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(sorted_spans).cast("long")))), start, halve, lambda s: s["lo"])


def _disjoint(spans: Column) -> Column:
    """Sorted spans with overlapping ones joined."""
    ends = running(F.transform(spans, lambda x: x["end"]), F.lit(0), lambda a, x: F.greatest(a, x))

    def joined_up(before: Column) -> Column:
        fresh = F.transform(spans, lambda x, i: F.struct(x["start"].alias("start"), F.get(before, i).alias("before"), ((i == 0) | (x["start"] >= F.get(before, i))).alias("fresh")))
        last = F.array_max(F.transform(spans, lambda x: x["end"]))
        # a span ends where the furthest one before the next begins
        closed = lambda new: F.transform(new, lambda x, i: F.struct(x["start"].alias("start"), F.coalesce(F.get(new, i + 1)["before"], last).alias("end")))
        return _let(F.filter(fresh, lambda x: x["fresh"]), closed)

    return _let(ends, joined_up)


def _masked(text: Column, spans: Column, by: str) -> Column:
    """The text with each of the sorted, disjoint spans replaced, block by block."""

    def block(piece: Column, j: Column) -> Column:
        first = j * BLOCK
        end = first + F.length(piece)
        gone = _how_many(spans, lambda x: x["end"] <= first)
        met = F.slice(spans, gone + 1, F.greatest(_how_many(spans, lambda x: x["start"] < end) - gone, F.lit(0)))
        kept = lambda a, until: F.substring(piece, a - first + 1, F.greatest(until - a, F.lit(0)))
        return F.aggregate(
            met,
            F.struct(first.alias("at"), F.lit("").alias("out")),
            lambda a, x: F.struct(
                x["end"].alias("at"),
                # a span is replaced in the block in which it begins
                F.concat(a["out"], kept(a["at"], x["start"]), F.when(x["start"] >= first, F.lit(by)).otherwise("")).alias("out"),
            ),
            lambda a: F.concat(a["out"], kept(a["at"], end)),
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), block), "")


def mask(docs: DataFrame, by: str = MASK) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``by``, overlapping
    spans as one; ``n_chars``, if there, follows the new text."""
    found = scan(docs)
    replaced = _let(_disjoint(F.col("spans")), lambda spans: _masked(F.col("t"), spans, by))
    found = found.withColumn("new", F.when(F.size("spans") > 0, replaced).otherwise(F.col("row.text")))
    new = {"text": F.col("new"), "n_chars": F.when(F.size("spans") > 0, F.length("new")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("new")}
    return found.select(*(new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns))
