"""Quality rules with risk-controlled thresholds, in native DataFrame operations.

Base figures come from column functions over one row's own text.  On top of the base rule,
a few score rules (larger is worse) get their cutoffs from labelled documents: for every
stratum (language), rule and cutoff of a fixed grid, the good labelled documents that pass
the base rule and would be rejected are counted, and the exact binomial tail
``P(Bin(n, alpha) <= rejected)`` tests "this cutoff rejects more than a share alpha of the good
documents".  A cutoff is valid if its tail is at most ``delta`` over the number of tests
(Bonferroni over strata, rules and grid); each stratum takes the strictest valid cutoff of
each rule, or none.  With probability 1 - delta no chosen cutoff rejects more than alpha.

All labelled rows are counted, with partial sums before the shuffle; a stratum's row of
counts is one row however many documents it has.

Defined results: a null text has no words (all figures 0, ``base_failed`` true); a null stratum
is a stratum of its own; documents without labels are judged, never counted; a document
labelled several times counts once per label; equal rows get equal verdicts; with no labels
no rule gets a cutoff; further columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import SPACE, stash

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
WHITE = "\x20\t\n\x0b\x0c\r"
ALPHA, DELTA = 0.005, 0.05     # false rejections of one rule in a stratum; risk of any breach

# The cutoffs that are tested, strictest first.
GRID: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5),
    "repeat_share": (0.02, 0.05, 0.1, 0.15),
    "word_length": (7.0, 8.0, 10.0, 12.0, 15.0),
    "shortness": (0.05, 0.04, 0.03, 0.02),
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def repeat_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words inside windows that occur twice or more in the row, the first ones included."""
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)),
                           lambda i: F.xxhash64(*[F.element_at(w, i + j) for j in range(window)]))

    def places(h: Column) -> Column:       # begins of repeated windows, in order
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def same(j: Column, k: Column) -> Column:
                return F.get(s, j)["h"] == F.get(s, k)["h"]

            picked = F.filter(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda j: F.coalesce(same(j, j - 1), F.lit(False))
                | F.coalesce(same(j, j + 1), F.lit(False)))
            return F.sort_array(F.transform(picked, lambda j: F.get(s, j)["i"]))

        return let(by_hash, repeated)

    def covered(p: Column) -> Column:      # each window adds what the next one leaves of it
        steps = F.transform(F.sequence(F.lit(1), F.size(p) - 1),
                            lambda k: F.least(F.get(p, k) - F.get(p, k - 1), F.lit(window)))
        return F.aggregate(steps, F.lit(window), lambda a, x: a + x)

    def figure(h: Column) -> Column:
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                .otherwise(let(places(h), covered)))

    return F.when(F.size(words) < window, F.lit(0)).otherwise(
        let(words, lambda w: let(windows(w), figure)))


def figures(docs: DataFrame, key: str = "doc_id", text: str = "text",
            stratum: str | None = "lang") -> DataFrame:
    """One narrow row per document: the base figures and the scores of the rules."""
    t = F.coalesce(F.col(text), F.lit(""))
    has_word = f"[^{SPACE}]"
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.col(stratum) if stratum else F.lit(None)).cast("string").alias("stratum"),
        t.alias("text"),
        F.regexp_extract_all(t, F.lit(f"[^{SPACE}]+"), F.lit(0)).alias("words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(has_word)).alias("lines"))
    rows = rows.select(
        "doc_id", "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(without(F.col("text"), WHITE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"))
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        *rows.columns,
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        .alias("base_failed"),
        (F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / n).alias("repeat_share"),
        (F.col("word_chars") / n).alias("word_length"),
        (F.lit(1.0) / n).alias("shortness"))


def log_binomial_tail(n: Column, r: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= r), for r < n p; 0 (certain) beyond, where the tail is over a half."""
    odds, none = math.log(p) - math.log1p(-p), math.log1p(-p)

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] + F.log((n - k + 1) / k) + F.lit(odds)
        top = F.greatest(acc["sum"], term)
        return F.struct(term.alias("term"), (
            top + F.log1p(F.exp(-F.abs(acc["sum"] - term)))).alias("sum"))

    first = n.cast("double") * F.lit(none)
    terms = F.when(r > 0, F.sequence(F.lit(1).cast("long"), r)).otherwise(
        F.array().cast("array<bigint>"))
    tail = F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), add,
                       lambda acc: acc["sum"])
    return F.when(r < n * p, tail).otherwise(F.lit(0.0))


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
            grid: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """(stratum, one column per rule: the strictest valid cutoff or null) from good labelled
    rows that carry the scores; one row per stratum."""
    grid = grid or GRID
    tests = [(rule, k, c) for rule, cs in grid.items() for k, c in enumerate(cs)]
    counts = labelled.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(rule) > c).alias(f"{rule}_{k}") for rule, k, c in tests])
    counts = stash(counts, "quality-counts")
    bound = math.log(delta / max(1, counts.count() * len(tests)))
    return counts.select("stratum", "n", *[
        F.coalesce(*[F.when(log_binomial_tail(F.col("n"), F.col(f"{rule}_{k}"), alpha) <= bound,
                            F.lit(c)) for r, k, c in tests if r == rule]).alias(f"{rule}_cut")
        for rule in grid])


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          stratum: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept) for every row of ``docs``; ``labels`` has (doc_id, quality, toxic)."""
    rows = stash(figures(docs, key, text, stratum), "quality-figures")
    good = (labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
            .select(F.col(key).alias("doc_id")))
    chosen = stash(cutoffs(rows.filter(~F.col("base_failed")).join(good, "doc_id"),
                           alpha, delta), "quality-cutoffs")
    # one row per stratum: both sides are plain scans, so a large one is joined with skew
    # splits and a small one is broadcast by its measured size
    out = rows.join(chosen.drop("n").withColumnRenamed("stratum", "s"),
                    F.col("stratum").eqNullSafe(F.col("s")), "left")
    rejected = F.lit(False)
    for rule in GRID:
        rejected = rejected | F.coalesce(F.col(rule) > F.col(f"{rule}_cut"), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~rejected).alias("kept"))
