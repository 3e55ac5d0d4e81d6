"""Column functions on texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as in Python: the JVM's Unicode class and four separators.
SPACE = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def one_line(c: Column) -> Column:
    """Lower case, each run of white space one blank, trimmed; null becomes empty."""
    return strip(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), rf"(?U){SPACE}+", " "))


def words(c: Column) -> Column:
    return F.filter(F.split(one_line(c), " "), lambda x: x != "")


def ngrams(tokens: Column, n: Column | int) -> Column:
    """The overlapping n-grams of an array of words, joined by a blank; empty for fewer than n words."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def preview(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def collapse(c: Column) -> Column:
    """Runs of blanks to one, three and more line feeds to two, every line stripped."""
    tidy = F.regexp_replace(F.regexp_replace(c, " +", " "), "\n{3,}", "\n\n")
    return F.array_join(F.transform(F.split(tidy, "\n", -1), strip), "\n")


def long_paragraphs(c: Column, least: int = 50) -> Column:
    """The paragraphs, parted by an empty line, whose stripped length reaches the least."""
    return F.array_join(F.filter(F.split(c, "\n\n", -1), lambda p: F.length(strip(p)) >= least), "\n\n")


def reduction(before: Column, after: Column) -> Column:
    return F.round((1 - after / F.greatest(before, F.lit(1))) * 100, 2)
