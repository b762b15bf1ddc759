"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good, bad, or abstains, from counts over the whole text. What
the rules' votes are worth is estimated from the votes alone: expectation
maximisation over the table of vote patterns (at most 3 ** rules rows, so it
may reach the driver) gives every rule's vote distribution for good and for
bad texts and the share of good texts. A document's posterior probability of
being good is then a plain column expression, and replaces the demand that
every rule passes.

Defined results: a null or empty text has no words, fails the base rules and
is not kept; repeated rows are scored alike and each counts as a row; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import quoted

GOOD, BAD, ABSTAIN = "g", "b", "-"
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ROUNDS, SMOOTHING = 200, 1.0


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def count_words(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The kept columns and the counts the rules look at, all long: ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``n_lines``, ``n_upper``, ``n_symbol_runs``, ``n_marks`` (digits and
    punctuation), ``n_distinct``, ``n_stops`` (lines that end a sentence)."""
    row = F.struct(*[F.col(quoted(c)) for c in keep]).alias("row")
    t = docs.select(row, F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("t"))
    t = t.select("row", "t", _trimmed(F.col("t")).alias("core"))
    words = F.when(F.col("core") == "", F.array().cast("array<string>")) \
        .otherwise(F.split("core", r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split("t", "\n"), lambda x: _trimmed(x) != "")
    t = t.select("row", "t", words.alias("w"), lines.alias("lines"))
    three = F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(1), F.size("w") - 2),
        lambda i: F.xxhash64(F.get("w", i - 1), F.get("w", i), F.get("w", i + 1)))) \
        .otherwise(F.array().cast("array<bigint>"))
    t = t.select(
        "row", three.alias("three"), F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("t") - F.length(F.translate("t", UPPER, ""))).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit("[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        (F.length("t") - F.length(F.translate("t", MARKS, ""))).cast("long").alias("n_marks"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).rlike(r"[.!?:;\"')]$"))).cast("long").alias("n_stops"))
    # only a text in which some window repeats has its windows sorted
    ordered = F.when(F.size(F.array_distinct("three")) < F.size("three"), F.array_sort(
        F.transform("three", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))) \
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    counts = [c for c in t.columns if c not in ("row", "three")]
    t = t.select("row", *counts, ordered.alias("o"))
    same = F.filter("o", lambda x, j: ((j > 0) & (F.get("o", j - 1)["h"] == x["h"]))
                    | F.coalesce(F.get("o", j + 1)["h"] == x["h"], F.lit(False)))
    t = t.select("row", *counts, same.alias("same"))
    covered = F.array_distinct(F.flatten(F.transform(
        "same", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return t.select("row", *counts, F.size(covered).cast("long").alias("n_repeat_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """The rules: each a column of votes over the counts."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    size = F.col("word_chars") / n
    symbols, repeats = F.col("n_symbols") / n, F.col("n_repeat_words") / n
    runs = F.col("n_symbol_runs") / n
    marks = F.col("n_marks") / F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    upper = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    distinct, stops = F.col("n_distinct") / n, F.col("n_stops") / lines
    long_enough = F.col("n_words") >= MIN_WORDS
    return {
        "length": _vote(~long_enough, F.col("n_words") >= 2 * MIN_WORDS),
        "word_size": _vote((size < 2.5) | (size > 12), size.between(3.5, 8)),
        "symbols": _vote(symbols > 0.1, symbols < 0.01),
        "symbol_runs": _vote(runs > 0.08, runs < 0.01),
        "letters": _vote(marks > 0.15, marks < 0.06),
        "dup_lines": _vote((F.col("n_dup_lines") > 1) & (F.col("n_dup_lines") > 0.3 * lines),
                           (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 1)),
        "repeats": _vote(repeats > 0.3, (repeats < 0.05) & long_enough),
        "upper": _vote(upper > 0.4, upper < 0.1),
        "variety": _vote((distinct < 0.15) & long_enough, (distinct > 0.3) & long_enough),
        "sentences": _vote((stops < 0.1) & (F.col("n_lines") > 2), stops > 0.6),
    }


def estimate(patterns: dict[str, int], n_rules: int, rounds: int = ROUNDS) -> tuple[float, list[dict]]:
    """Expectation maximisation over vote patterns (text of one letter a rule
    -> rows): the share of good texts, and for each rule the logarithm of
    P(vote | good) / P(vote | bad). It starts from texts with two bad votes
    (besides the length) as bad, so that the classes are named."""
    total = sum(patterns.values())
    if not total:
        return 0.5, [dict.fromkeys((GOOD, BAD, ABSTAIN), 0.0)] * n_rules
    good = {p: (0.95, 0.6, 0.05)[min(p[1:].count(BAD), 2)] for p in patterns}
    share, odds = 0.5, []
    for _ in range(rounds):
        weight = sum(n * good[p] for p, n in patterns.items())
        share = min(max(weight / total, 1e-6), 1 - 1e-6)
        odds = []
        for r in range(n_rules):
            seen = {v: [SMOOTHING, SMOOTHING] for v in (GOOD, BAD, ABSTAIN)}
            for p, n in patterns.items():
                seen[p[r]][0] += n * good[p]
                seen[p[r]][1] += n * (1 - good[p])
            a, b = (sum(x[k] for x in seen.values()) for k in (0, 1))
            odds.append({v: math.log(x[0] / a) - math.log(x[1] / b) for v, x in seen.items()})
        base, moved = math.log(share / (1 - share)), 0.0
        for p in patterns:
            z = base + sum(odds[r][v] for r, v in enumerate(p))
            new = 1 / (1 + math.exp(-min(max(z, -500), 500)))
            moved, good[p] = max(moved, abs(new - good[p])), new
        if moved < 1e-9:
            break
    return share, odds


def judge(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), threshold: float = 0.2) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed``, ``votes``,
    ``quality`` (posterior probability of a good text) and ``kept``: only a
    text that is clearly bad goes."""
    counted = count_words(docs, text, keep)
    own = rules()
    counted = cut_lineage(counted.withColumn("votes", F.concat(*own.values())))
    patterns = {r["votes"]: r["count"] for r in counted.groupBy("votes").count().collect()}
    share, odds = estimate(patterns, len(own))
    z = F.lit(math.log(share / (1 - share)))
    for r, rule in enumerate(odds):
        vote = F.substring("votes", r + 1, 1)
        z = z + F.when(vote == GOOD, F.lit(rule[GOOD])).when(vote == BAD, F.lit(rule[BAD])) \
            .otherwise(F.lit(rule[ABSTAIN]))
    failed = (F.col("n_words") < MIN_WORDS) \
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = counted.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-z)))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "votes", "quality"]
    return scored.select(*[F.col("row").getField(c).alias(c) for c in keep if c not in (*added, "kept")], *added,
                         (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"))


def rules_report(docs: DataFrame) -> DataFrame:
    """The columns of ``op9_quality_rules``."""
    return judge(docs, keep=["doc_id"])
