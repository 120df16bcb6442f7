"""Quality rules with risk-controlled thresholds (operator 1, native).

Each rule gives a document a badness score, an integer from 0 to 1000.  A rule
rejects a document whose score is above the cutoff of the document's stratum
(its language).  The cutoffs come from labelled holdout documents.  One path of
joint cutoffs, fixed in advance, tightens all rules together; its steps are
tested from the most lenient to the strictest: "at this step the rules together
reject at least a share ``alpha`` of the good documents" is refuted when the
exact binomial probability of seeing as few rejected good documents as there
are is at most ``delta / strata`` (Bonferroni over strata; along the path the
tests run in a fixed order and stop at the first that is not refuted, which
needs no further correction).  So with probability ``1 - delta`` the rules
together reject less than ``alpha`` of good documents in every stratum.  Among
the steps that pass, the one that rejects most labelled bad documents is taken,
the most lenient of equals.  Each rule's cutoff is then loosened as far as the
rule still rejects the same labelled bad documents, which rejects no document
more; a rule that rejects none of them is off.  A stratum with fewer good texts
than ``log(delta / strata) / log(1 - alpha)`` passes no test (217 for 4 strata).

Copies of a text are one trial, not many: the holdout counts each text of a
stratum once (as bad if any copy is labelled bad).  Documents that the base
rules drop are no trials.

Defined results: a null text has no words and fails the base rules; a null
language is a stratum of its own; several labels of a document count as bad if
one is 0; null labels and labels of no document are ignored; repeated rows get
the same verdict; an empty table gives an empty result; without labels no
cutoff is set and the base rules decide alone.  Other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE, durable, durable_table, small, text_of, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RULES = ("symbols", "capitals", "repeats", "lines")
ALPHA = 0.02  # false rejections of good documents per stratum, all rules together
DELTA = 0.05  # probability that any of the guarantees fails
GRID = tuple(range(1000, 0, -10))  # steps of the path, most lenient first
# The cutoff of each rule at a step.  Prose has next to no symbols and few
# capitals, so these tighten faster; repeats and lines are coarse shares.
PATH = {"symbols": lambda t: t**3 // 10**6, "capitals": lambda t: t**2 // 10**3, "repeats": lambda t: t, "lines": lambda t: t}


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _windows(key) -> Column:
    """One value per window of WINDOW words of the column ``w``."""
    return F.when(
        F.size("w") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("w") - WINDOW + 1), lambda i: key(i, F.slice("w", i, WINDOW))),
    )


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus a struct column ``q`` with the counts and scores.

    The input's columns come back in the struct ``row``, so that no name of
    theirs can clash.  No shuffle: every count is made within the row.
    """
    df = docs.select(F.struct("*").alias("row"), text_of(docs[text]).alias("t"))
    df = df.select("row", "t", words(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    # Equal windows have equal hashes, so only texts with a repeated hash are
    # looked at more closely, by the windows' words themselves.
    df = df.withColumn("h", _windows(lambda i, w: F.xxhash64(w)))
    df = df.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(_windows(lambda i, w: F.struct(F.array_join(w, " ").alias("k"), i.alias("i")))),
        ),
    )
    twice = F.filter("s", lambda x, j: (x["k"] == F.get("s", j - 1)["k"]) | (x["k"] == F.get("s", j + 1)["k"]))
    df = df.withColumn("p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "p",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
        lambda a: a["n"],
    )
    df = df.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.length(_without(F.col("t"), SPACE)).cast("long").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.xxhash64("t").alias("text_hash"),
    )
    score = lambda part, whole: F.coalesce(F.expr(f"1000 * {part} div nullif({whole}, 0)"), F.lit(0).cast("long"))
    return df.select(
        "row",
        F.struct(
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text_hash",
            ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
            score("n_symbols", "word_chars").alias("symbols"),
            score("n_capitals", "word_chars").alias("capitals"),
            score("n_repeat_words", "n_words").alias("repeats"),
            score("n_dup_lines", "n_lines").alias("lines"),
        ).alias("q"),
    )


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exactly summed term by term for k < n * p; 1.0 above,
    where it cannot be small."""
    first = n * F.log(F.lit(1.0 - p))
    step = F.log(F.lit(p / (1.0 - p)))
    total = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("log"), F.exp(first).alias("sum")),
        lambda a, i: F.struct(
            (a["log"] + F.log((n - i + 1) / i) + step).alias("log"),
            (a["sum"] + F.exp(a["log"] + F.log((n - i + 1) / i) + step)).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k < n * p, total).otherwise(F.lit(1.0))


def holdout(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per stratum and text of the labelled documents that pass the
    base rules: stratum, good, and a score for each rule."""
    label = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = scored.where("NOT q.base_failed").select("doc_id", "stratum", "q.text_hash", *(f"q.{r}" for r in RULES))
    joined = rows.join(label, "doc_id")
    return joined.groupBy("stratum", "text_hash").agg((F.min("quality") > 0).alias("good"), *(F.max(r).alias(r) for r in RULES))


def cutoffs(trials: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff for each rule, null where it is off.

    The trials shrink to counts per stratum, rule and step before the only
    shuffle; what follows is as many rows as strata, rules and steps.
    """
    step = GRID[0] - GRID[1]
    path = {r: F.array(*(F.lit(PATH[r](t)) for t in reversed(GRID))) for r in RULES}
    # A score above the cutoff of one step is above those of all stricter
    # ones: it counts from the most lenient such step (0: none) downwards.
    first = lambda r: step * F.size(F.filter(path[r], lambda c: c < F.col(r)))
    placed = trials.select("stratum", "good", *(first(r).alias(r) for r in RULES))
    below = {**{r: F.col(r) for r in RULES}, "any": F.greatest(*RULES)}
    long = placed.select("stratum", "good", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), b.alias("below")) for r, b in below.items()))).alias("x"))
    counts = durable(
        long.groupBy("stratum", "x.rule", "x.below").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    grid = F.explode(F.array(*(F.lit(c) for c in GRID))).alias("step")
    per = counts.where("rule = 'any'").groupBy("stratum").agg(
        F.sum("good").alias("n"), F.collect_list(F.struct("below", "good", "bad")).alias("bins")
    )  # at most len(GRID) + 1 bins
    above = lambda what: F.aggregate(
        "bins", F.lit(0).cast("long"), lambda a, b: a + F.when(b["below"] >= F.col("step"), b[what]).otherwise(0)
    )
    tested = per.select("stratum", "n", "bins", grid).select("stratum", "n", "step", above("good").alias("k"), above("bad").alias("bad"))
    level = delta / max(1, counts.select("stratum").distinct().count())
    # The count of rejected good documents grows along the path, and the
    # probability with it: the first test that fails is the last that passes
    # plus one, so keeping all that pass is the fixed-order test.
    passed = tested.where(binomial_tail(F.col("n"), F.col("k"), alpha) <= level)
    best = passed.where("bad > 0").groupBy(F.col("stratum").alias("best_stratum")).agg(F.max(F.struct("bad", "step"))["step"].alias("step"))
    caught = counts.where("bad > 0").join(best, F.col("stratum").eqNullSafe(F.col("best_stratum"))).where("below >= step")
    loosest = lambda r: F.min(F.when(F.col("rule") == r, F.col("below")))
    return caught.groupBy("stratum").agg(*(F.get(path[r], (loosest(r) / step).cast("int") - 1).alias(r) for r in RULES))


def judge(scored: DataFrame, cuts: DataFrame, stratum: Column) -> DataFrame:
    """``scored`` (with ``q``) plus ``kept``."""
    cuts = small(durable(cuts))
    cuts = cuts.select(F.col("stratum").alias("cut_stratum"), *(F.col(r).alias(f"cut_{r}") for r in RULES))
    rejected = F.lit(False)
    for r in RULES:
        rejected |= F.coalesce(F.col(f"q.{r}") > F.col(f"cut_{r}"), F.lit(False))
    out = scored.join(cuts, stratum.eqNullSafe(F.col("cut_stratum")), "left")
    return out.withColumn("kept", ~F.col("q.base_failed") & ~rejected).drop("cut_stratum", *(f"cut_{r}" for r in RULES))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: doc_id, stratum, ``q`` (counts, scores,
    base_failed) and kept.  Texts are read once; the counts are written to the
    checkpoint folder, and calibration and verdicts work on those."""
    light = features(docs).select(F.col("row.doc_id").alias("doc_id"), F.col("row.lang").alias("stratum"), "q")
    light = durable(light)
    return judge(light, cutoffs(holdout(light, labels), alpha, delta), F.col("stratum"))


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns.  The counts are made
    once and written with their rows; calibration reads the counts alone, and
    the cutoffs are broadcast behind a size check, so no text is shuffled."""
    full = durable_table(features(docs))
    light = full.select(F.col("row.doc_id").alias("doc_id"), F.col("row.lang").alias("stratum"), "q")
    cuts = cutoffs(holdout(light, labels), alpha, delta)
    return judge(full, cuts, F.col("row.lang")).where("kept").select("row.*")
