"""Quality rules: weak supervision instead of all-must-pass filtering.

Method.  Every rule looks at a few counts of a document and votes good (1),
bad (-1) or abstains (0).  Nobody knows how reliable the rules are;
expectation-maximisation estimates it from their agreement: given the
posterior quality of each vote pattern, the rate of each vote among good and
among bad documents; given the rates, the posterior.  A document is kept if
its posterior reaches ``threshold`` (and the base test did not fail).

Scale.  One scan of the texts; the counts are array and string functions of
one row.  The documents with equal votes are pre-aggregated to at most
``3 ** len(RULES)`` patterns before the iteration, so an EM step is an
aggregate over a small local table whatever the corpus size.

Defined cases: a null or empty text has no words, so it fails the base test;
repeated rows are scored alike; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import query, table, words, write_table

PRIOR_GOOD = 0.9       # share of good documents that EM starts from
ACCURACY = 0.9         # accuracy of each rule that EM starts from
SMOOTHING = 10.0       # votes at that accuracy added to each rule's own
ITERATIONS = 40        # EM steps at most
TOLERANCE = 1e-5       # a step that changes no accuracy by more ends it


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once (a lambda variable is not inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in ``w``."""
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - 2),
                          lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1),
                                               F.element_at(w, i + 2)))

    def covered(h: Column) -> Column:
        # windows sorted by content; equal neighbours repeat
        by_content = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(by_content, lambda s: let(
            F.sort_array(F.filter(F.transform(s, lambda e, k: F.when(
                e["h"].eqNullSafe(F.get(s, k - 1)["h"]) | e["h"].eqNullSafe(F.get(s, k + 1)["h"]),
                e["i"])), lambda p: p.isNotNull())),
            # a window covers its three words up to the next repeated window
            lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(
                F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x)), F.lit(0), lambda a, b: a + b)))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measured = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        F.size(F.filter(w, lambda x: x.rlike(r"^[\p{L}\p{N}'’-]++[.,;:!?)\"]?$"))).cast("long")
        .alias("n_plain")))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return docs.select(
        "doc_id", measured.alias("m"), line_counts.alias("l"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"\P{Lu}++", "")).cast("long").alias("n_upper"),
    ).select("doc_id", "m.*", "l.*", "n_symbols", "n_upper")


def _vote(bad: Column, good: Column | None = None) -> Column:
    v = F.when(bad, F.lit(-1))
    return (v.when(good, F.lit(1)) if good is not None else v).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """name -> vote; shares are compared as products, so no word is no division.

    Most rules know one kind of bad document and abstain on the others."""
    n, c = F.col("n_words"), F.col
    return {
        "length": _vote((n < 50) | (n > 100_000)),
        "word_length": _vote((c("word_chars") < 3 * n) | (c("word_chars") > 12 * n)),
        "symbols": _vote(c("n_symbols") * 10 > n),
        "plain_words": _vote(c("n_plain") * 10 < n * 7, (n > 0) & (c("n_plain") * 10 >= n * 9)),
        "capitals": _vote(c("n_upper") * 10 > c("word_chars") * 3),
        "repeats": _vote(c("n_repeat_words") * 10 > n * 3),
        "distinct_words": _vote((n >= 50) & (c("n_distinct") * 10 < n * 2)),
        "repeated_lines": _vote((c("n_lines") >= 3) & (c("n_dup_lines") * 10 > c("n_lines") * 3)),
    }


RULES = ("length", "word_length", "symbols", "plain_words", "capitals", "repeats",
         "distinct_words", "repeated_lines")


def _log_odds(accuracy: dict[str, float], prior: float) -> list[float]:
    """Log odds of good that a good vote of each rule brings, then the prior's."""
    return [math.log(x / (1 - x)) for x in (*(accuracy[r] for r in RULES), prior)]


def posterior(votes: Column, odds: Column) -> Column:
    """P(good | votes), the votes independent given the class; abstaining says
    nothing.  ``votes``: array in rule order; ``odds``: see ``_log_odds``."""
    given = F.transform(votes, lambda v, j: F.get(odds, j) * v)
    total = F.aggregate(given, F.element_at(odds, -1), lambda a, x: a + x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def estimate(votes: DataFrame, accuracy: float = ACCURACY, prior: float = PRIOR_GOOD,
             smoothing: float = SMOOTHING, iterations: int = ITERATIONS,
             tolerance: float = TOLERANCE) -> tuple[dict[str, float], float]:
    """EM over the vote patterns: each rule's accuracy (share of its votes that
    are right) and the share of good documents."""
    spark = votes.sparkSession
    rows = votes.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).collect()  # <= 3 ** rules
    rows = [(list(r[:-1]), float(r[-1])) for r in sorted(map(tuple, rows))]
    total = sum(n for _, n in rows)
    rates = dict.fromkeys(RULES, accuracy)
    sums = [F.sum(F.col("n") * F.col("p")).alias("good")]
    for i in range(len(RULES)):
        v = F.get("votes", F.lit(i))
        sums += [F.sum(F.when(v == 1, F.col("n") * F.col("p"))
                       .when(v == -1, F.col("n") * (F.lit(1.0) - F.col("p"))).otherwise(F.lit(0.0))),
                 F.sum(F.when(v == 0, F.lit(0.0)).otherwise(F.col("n")))]
    for _ in range(iterations if total else 0):
        odds = _log_odds(rates, prior)
        # the odds travel as data, so every step runs the same compiled plan
        step = spark.createDataFrame([(v, n, odds) for v, n in rows],
                                     "votes array<int>, n double, odds array<double>").coalesce(1)
        good, *got = step.withColumn("p", posterior(F.col("votes"), F.col("odds"))).agg(*sums).first()
        prior = min(max(good / total, 0.5), 0.999)
        new = {}
        for r, right, cast in zip(RULES, got[::2], got[1::2]):
            x = (right + smoothing * accuracy) / (cast + smoothing)
            new[r] = min(max(x, 0.5), 0.99)  # no rule is worse than chance, none is beyond doubt
        moved = max(abs(new[r] - rates[r]) for r in RULES)
        rates = new
        if moved <= tolerance:
            break
    return rates, prior


def score(docs: DataFrame, threshold: float = 0.5, **em) -> DataFrame:
    """doc_id, the counts, each rule's vote, the posterior, base_failed, kept."""
    f = features(docs)
    f = write_table(f.select("*", *[v.alias(r) for r, v in rules().items()]), "quality-features")
    rates, prior = estimate(f, **em)
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    odds = F.array(*[F.lit(x) for x in _log_odds(rates, prior)])
    return (f.withColumn("quality", posterior(F.array(*RULES), odds)).withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


@query("op1_quality_rules")
def op1(spark, sf_dir):
    """Counts, votes' posterior and verdict of all ``documents``."""
    s = score(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept", "quality")
