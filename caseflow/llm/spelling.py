"""Spelling variants of a corpus: words one edit apart, by permuterm rotations.

A word and an end mark are rotated to every place. A replaced character leaves
the rotation that begins behind it and ends before it unchanged, and so does a
left-out one: the words near ``X c Y`` are those whose rotations begin with
``Y $ X``, followed by any one character or by none. So every word sends out

* for each character, the rotation that ends with it, split into the prefix
  ``Y $ X`` and the character, and
* for each gap, the whole rotation ``Y $ X`` with no character after it.

Sorted by prefix, the rows of a group are near words. A group has at most one
row without a character and one for each character of the alphabet, so it is
bounded, and figures of the group (how many, the most frequent) replace its
pairs. Of a run of equal characters only the first stands for an insertion or
deletion, so every two near words meet in exactly one group.

Counts come from all texts, partly summed before the shuffle. A word's form is
its most frequent near word, if that is ``FACTOR`` times as frequent; so a
chain of forms has at most log(n) / log(``FACTOR``) links and a few rounds of
doubled steps reach its end.

Defined results: null and empty texts have no words; a null id counts as an
empty text in the hash; repeated rows count again; an empty table gives an
empty result; a very long text is one array of its words in a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow import quoted

LETTERS = "a-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, FACTOR, DELETE_EVERY = 7, 2, 10, 31
#: Ends a word in its rotations; no letter.
END = "$"


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", at_least: int = 1) -> DataFrame:
    """(id, run): every maximal run of letters, A-Z as a-z."""
    low = F.translate(F.col(quoted(text)).cast("string"), UPPER, LOWER)
    return docs.select(F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(low, f"[^{LETTERS}]+")).alias("run")) \
        .where(F.length("run") >= at_least)


def with_deletions(found: DataFrame, every: int = DELETE_EVERY) -> DataFrame:
    """(word): a run whose hash with its document's id is divisible by ``every``
    has lost one character."""
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= min_count)


def _rotated(i: Column, before: Column) -> Column:
    """What stands behind place ``i``, the end mark, and the first ``before`` characters."""
    return F.concat(F.substring("word", i + 1, F.length("word")), F.lit(END), F.substring("word", F.lit(1), before))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, char, first, n): ``char`` is null for a whole rotation; ``first``
    says that the character before it in the word is another one."""
    size = F.length("word")
    ends = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(
        _rotated(i, i - 1).alias("prefix"), F.substring("word", i, F.lit(1)).alias("char"),
        ((i == 1) | (F.substring("word", i, F.lit(1)) != F.substring("word", i - 1, F.lit(1)))).alias("first")))
    gaps = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        _rotated(i, i).alias("prefix"), F.lit(None).cast("string").alias("char"), F.lit(False).alias("first")))
    return words.select("n", F.explode(F.concat(ends, gaps)).alias("r")).select("r.*", "n")


def _restored(char: Column) -> Column:
    """The word of a rotation: X, the character, Y from ``Y $ X``."""
    return F.concat(F.substring_index("prefix", END, -1), char, F.substring_index("prefix", END, 1))


def neighbours(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n_near, form, form_n) of every word with a near word."""
    group = Window.partitionBy("prefix")
    whole, is_char = F.col("char").isNull(), F.col("char").isNotNull()
    # frequency first, then the smaller character, in one number
    rank = F.col("n") * 65536 + (65535 - F.ascii("char"))
    t = rotations(words).select(
        "*", F.sum(is_char.cast("int")).over(group).alias("chars"), F.sum(F.col("first").cast("int")).over(group).alias("firsts"),
        F.max(F.when(whole, F.col("n"))).over(group).alias("whole_n"),
        F.max(F.when(is_char, rank)).over(group).alias("top"), F.max(F.when(F.col("first"), rank)).over(group).alias("top_first"))
    near = F.when(whole, F.col("firsts")).otherwise(
        F.col("chars") - 1 + (F.col("first") & F.col("whole_n").isNotNull()).cast("int"))
    t = t.withColumn("near", near).where(F.col("near") > 0)
    # a group's most frequent word is the only one of it that can be a form; it never is its own
    best = F.when(whole, F.col("top_first")).otherwise(F.col("top"))
    best_n = F.floor(best / 65536)
    form = F.struct((-best_n).alias("n"), _restored(F.char(65535 - best % 65536)).alias("word"))
    short = F.struct((-F.col("whole_n")).alias("n"), _restored(F.lit("")).alias("word"))
    enough = lambda n: n >= factor * F.col("n")
    both = F.array_min(F.filter(F.array(
        F.when(enough(best_n), form), F.when(F.col("first") & enough(F.col("whole_n")), short)), lambda x: x.isNotNull()))
    t = t.select(_restored(F.coalesce("char", F.lit(""))).alias("word"), "near", both.alias("form"))
    found = t.groupBy("word").agg(F.sum("near").cast("long").alias("n_near"), F.min("form").alias("form"))
    return found.select("word", "n_near", F.col("form.word").alias("form"), (-F.col("form.n")).alias("form_n"))


def roots(forms: DataFrame, largest: int, factor: int = FACTOR) -> DataFrame:
    """(word, root) of every word that has a form. Every round doubles the steps
    that a word has taken; ``largest`` count bounds the chain."""
    links = max(1, math.floor(math.log(max(largest, 1)) / math.log(factor)) + 1)
    table = cut_lineage(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(links))):
        ahead = table.select(F.col("word").alias("root"), F.col("root").alias("far"))
        table = cut_lineage(table.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root")))
    return table


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Groups a vocabulary (word, n): every word with ``form``, ``root``, ``n``,
    ``n_near`` and ``form_n``."""
    words = cut_lineage(words)
    found = cut_lineage(neighbours(words, factor))
    largest = words.agg(F.max("n")).first()[0] or 0
    ends = roots(found.where(F.col("form").isNotNull()), largest, factor)
    return words.join(found, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))


def spelling_report(docs: DataFrame) -> DataFrame:
    """The columns of ``op13_spelling_variants``."""
    return variants(vocabulary(with_deletions(runs(docs, at_least=MIN_LENGTH))))
