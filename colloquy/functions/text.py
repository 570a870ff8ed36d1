"""Column helpers over text: everything stays a JVM expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at both ends, in the Unicode sense; Spark's trim strips spaces only.
ENDS = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, ENDS, "")


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?U)\A\s*\z")


def collapse(c: Column) -> Column:
    """Runs of white space become one space; both ends are stripped."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    """Words between white space; an empty text has none."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def alnum_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def alpha_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]", ""))


def let(value: Column, of) -> Column:
    """of(value) with value computed once for each row, however often it is used."""
    return F.transform(F.array(value), of)[0]


def ngrams(w: Column, n: int) -> Column:
    """All runs of n words, joined by a space."""

    def over(x: Column) -> Column:
        size = F.size(x)
        at = F.when(size >= n, F.sequence(F.lit(1), size - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.array_join(F.slice(x, i, n), " "))

    return let(w, over)


def most_frequent(values: Column, k: int) -> Column:
    """times and pos (from 1) of the k most frequent values of an array; ties: first seen.

    Values are sorted beside their places, so that equal ones form runs.
    """

    def runs(s: Column) -> Column:
        marked = F.transform(s, lambda e, j: F.struct(e.pos.alias("pos"), j.alias("j"), F.get(s, j - 1).v.eqNullSafe(e.v).alias("again")))
        return let(F.filter(marked, lambda e: ~e.again), lambda heads: F.transform(heads, lambda e, j: F.struct((e.j - F.coalesce(F.get(heads, j + 1).j, F.size(s))).alias("n"), e.pos.alias("pos"))))

    placed = F.transform(values, lambda v, i: F.struct(v.alias("v"), (i + 1).alias("pos")))
    best = F.slice(F.array_sort(let(F.array_sort(placed), runs)), 1, k)
    return F.transform(best, lambda e: F.struct((-e.n).alias("times"), e.pos.alias("pos")))


def top_grams(parts: Column, n: int, k: int, step: int = 1) -> Column:
    """times and gram of the k most frequent runs of n parts (words, characters) of a text, compared by hash."""

    def over(x: Column) -> Column:
        last = F.size(x) - (n - 1)
        at = F.when(last >= 1, F.sequence(F.lit(1), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
        best = most_frequent(F.transform(at, lambda i: F.xxhash64(F.slice(x, i, n))), k)
        return F.transform(best, lambda e: F.struct(e.times.alias("times"), F.slice(x, (e.pos - 1) * step + 1, n).alias("gram")))

    return let(parts, over)


def repetition_ratio(c: Column, n: int = 3, least: int = 20) -> Column:
    """Share of n-grams that repeat an earlier one; 0 below ``least`` words."""

    def over(w: Column) -> Column:
        share = let(ngrams(w, n), lambda g: 1 - F.size(F.array_distinct(g)) / F.size(g))
        return F.when(F.size(w) < least, F.lit(0.0)).otherwise(share)

    return let(words(c), over)


def after_think(c: Column) -> Column:
    """What follows the last closing think tag; the whole text if there is none."""
    return F.substring_index(c, "</think>", -1)


def clean(c: Column) -> Column:
    """One line, single spaces, without the classifier's label marker."""
    return F.replace(collapse(c), F.lit("__label__"), F.lit(""))


def template_key(c: Column) -> Column:
    """First four words of the first 70 characters, digits and markup as #."""
    head = F.regexp_replace(F.substring(c, 1, 70), r"[\d$\\]+", "#")
    return F.array_join(F.slice(words(head), 1, 4), " ")


def word_set(c: Column, least: int = 4) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(rf"[\p{{L}}]{{{least},}}"), F.lit(0)))


def char_run(c: Column, least: int) -> Column:
    """Whether some letter stands ``least`` times in a row."""
    return c.rlike(rf"([\p{{L}}\p{{Nl}}\p{{No}}])\1{{{least - 1},}}")


def word_loop(c: Column, least: int) -> Column:
    """Whether some word stands ``least`` times in a row, whatever its case."""
    return c.rlike(rf"(?iU)\b(\w+)(?:\s+\1\b){{{least - 1},}}")
