"""Main text of web pages by two-pass block rules (operator 13).

A page is cut into blocks at its block elements.  The first pass decides the
clear blocks: those in elements for menus, footers, sidebars, forms, notices,
adverts or comments, and those made of links, are bad; long enough ones with
the stop-word density of prose are good.  Ambiguous ones, mostly short, then
inherit the label of the nearest decided neighbour, a neighbour in the same
element (no advert between) before any other.  Where a page marks its main part (``article``,
``main``) and good text is found in it, nothing outside is taken, and ambiguous
blocks inside with no decided neighbour there are good.

Each page is one row's work, in Arrow batches of the partition, so nothing is
exchanged; time and memory are linear in the page.

Defined results: a null or empty page has the empty text; unclosed tags,
comments and scripts run to the end of the page, as browsers read them; a page
without a block that reads like prose has the text of its marked main part, or
none; repeated rows, null ids and null urls stay as they are; an empty table
gives an empty result; other columns are carried along if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import ship
from ledgerlens.llm.html_blocks import HEADINGS, Block, blocks

# Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    # English
    "the of and to in a is that it was for on with as are by this be from or an which at not have but they his her were "
    # German
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es werden aus er hat dass sie nach wird bei "
    # French
    "le la les de et des un une en du est que pour qui dans sur par au pas ne se ce il elle avec plus sont aux "
    # Spanish
    "el los las del y se por con para su al lo como más pero sus o este ha entre cuando muy sin sobre también".split()
)
PUNCTUATION = ".,;:!?\"'()[]«»“”„’…¿¡"
DENSE = 0.2  # stop words per word, in prose
SPARSE = 0.05
SENTENCE = 10  # words
LONG = 25
LINKED = 0.5  # characters in links

GOOD, BAD = True, False


def stop_density(words: list[str]) -> float:
    return sum(w.strip(PUNCTUATION).lower() in STOP_WORDS for w in words) / len(words)


def decide(block: Block) -> bool | None:
    """The first pass: GOOD, BAD or None, from the block alone."""
    if block.aside:
        return BAD
    words = block.text.split(" ")
    density = stop_density(words)
    if block.linked > LINKED * len(block.text):
        # in an article a linked sentence is a sentence, a list of links is not
        if not block.article or block.kind == "li":
            return BAD
        return GOOD if len(words) >= LONG and density >= DENSE else None
    if len(words) >= SENTENCE and density >= DENSE:
        return GOOD
    if len(words) >= LONG and density < SPARSE and not block.article:
        return BAD
    return None


def _nearest(labels: list[bool | None], keys: list[int]) -> list[tuple[int, bool] | None]:
    """For each block the last decided one of the same key up to it."""
    seen: dict[int, tuple[int, bool]] = {}
    out = []
    for i, (label, key) in enumerate(zip(labels, keys)):
        if label is not None:
            seen[key] = (i, label)
        out.append(seen.get(key))
    return out


def inherit(page: list[Block], labels: list[bool | None]) -> list[bool]:
    """The second pass: labels for all blocks."""
    n = len(page)

    def both(keys: list[int]) -> list[tuple[tuple[int, bool] | None, tuple[int, bool] | None]]:
        after = _nearest(labels[::-1], keys[::-1])[::-1]
        return list(zip(_nearest(labels, keys), [None if a is None else (n - 1 - a[0], a[1]) for a in after]))

    within = both([-1 if b.aside else b.parent for b in page])
    # inside an article only its own blocks count, and never those of an aside
    places = both([-1 if b.aside and b.article else int(b.article) for b in page])
    out = []
    for i, (block, label) in enumerate(zip(page, labels)):
        if label is None:
            label = _inherited(i, block, *within[i])
        if label is None:
            label = _inherited(i, block, *places[i])
        out.append(block.article if label is None else label)
    return out


def _inherited(i: int, block: Block, before: tuple[int, bool] | None, after: tuple[int, bool] | None) -> bool | None:
    if before is None or after is None:
        one = before or after
        return None if one is None else one[1]
    if before[1] == after[1]:
        return before[1]
    if block.kind in HEADINGS:  # belongs to what follows
        return after[1]
    near = i - before[0], after[0] - i
    return GOOD if near[0] == near[1] else (before if near[0] < near[1] else after)[1]


def main_text(html: str | None) -> str:
    page = blocks(html or "")
    labels = inherit(page, [decide(b) for b in page])
    if any(good and b.article for good, b in zip(labels, page)):
        labels = [good and b.article for good, b in zip(labels, page)]
    return "\n\n".join(b.text for good, b in zip(labels, page) if good)


def extract(pages: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``pages``: the struct ``row`` of the columns ``carry``
    (default: all), text and n_chars."""
    ship(pages.sparkSession)
    held = pages.select(F.struct(*(pages.columns if carry is None else carry)).alias("row"), F.col("html").cast("string").alias("html"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(html.as_py()) for html in batch.column("html")]
            values = [batch.column("row"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(values, ["row", "text", "n_chars"])

    schema = T.StructType([held.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return held.mapInArrow(texts, schema)
