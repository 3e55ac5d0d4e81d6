"""Word and n-gram frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessaloom.functions.text import ngrams, words
from tessaloom.session import small_side


def word_counts(df: DataFrame, text: str = "Text") -> DataFrame:
    """(phrase, frequency) of every word; counts are summed map-side before the shuffle."""
    return df.where(F.col(text).isNotNull()).select(F.explode_outer(words(F.col(text))).alias("phrase")).where(F.col("phrase").isNotNull()).groupBy("phrase").agg(F.count(F.lit(1)).alias("frequency"))


def ngram_counts(df: DataFrame, first: int, last: int | None = None, text: str = "Text") -> DataFrame:
    """(n, phrase, frequency) for all n from first to last in one pass over the texts."""
    tokens = df.where(F.col(text).isNotNull()).select(words(F.col(text)).alias("w"))
    per_n = tokens.select("w", F.explode(F.lit(list(range(first, (last or first) + 1)))).alias("n"))
    grams = per_n.select("n", F.explode_outer(ngrams(F.col("w"), F.col("n"))).alias("phrase")).where(F.col("phrase").isNotNull())
    return grams.groupBy("n", "phrase").agg(F.count(F.lit(1)).alias("frequency"))


def frequent_ngrams(df: DataFrame, first: int, last: int, least: int, text: str = "Text") -> DataFrame:
    """(n, phrase, frequency) of the n-grams, n from first to last, that occur at least `least` times: ngram_counts without the rare ones.

    A longer n-gram can be that frequent only if all the n-grams of the first
    size inside of it are. So only those are counted for every text, as
    hashes; longer ones are built only where frequent ones follow one another
    without a gap, which few places do. Texts are known by their hash, copies
    have the same places.
    """
    texts = df.where(F.col(text).isNotNull()).select(F.col(text).alias("_t"))
    hashed = lambda w: F.when(F.size(w) >= first, F.transform(F.sequence(F.lit(1), F.size(w) - first + 1), lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(w, i, first)).alias("gram"))))
    at = texts.select(F.xxhash64("_t").alias("_id"), words(F.col("_t")).alias("w")).select("_id", F.explode_outer(hashed(F.col("w"))).alias("x")).where(F.col("x").isNotNull()).select("_id", "x.*")
    frequent = small_side(at.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("gram"))
    places = at.join(frequent, "gram", "left_semi").groupBy("_id").agg(F.array_sort(F.collect_set("at")).alias("places"))  # of one text
    # a run of places: its first, and its words beyond the first n-gram
    starts = F.filter("places", lambda p, i: (i == 0) | (F.get("places", i - 1) != p - 1))
    ends = F.filter("places", lambda p, i: F.coalesce(F.get("places", i + 1) != p + 1, F.lit(True)))
    runs = small_side(places.select("_id", F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + first).alias("size"))).alias("runs")))
    parts = texts.select(F.xxhash64("_t").alias("_id"), "_t").join(runs, "_id").select(words(F.col("_t")).alias("w"), "runs")
    parts = parts.select(F.explode(F.transform("runs", lambda r: F.slice("w", r["start"], r["size"]))).alias("w"))
    per_n = parts.select("w", F.explode(F.lit(list(range(first, last + 1)))).alias("n")).where(F.size("w") >= F.col("n"))
    grams = per_n.select("n", F.explode_outer(ngrams(F.col("w"), F.col("n"))).alias("phrase"))
    return grams.groupBy("n", "phrase").agg(F.count(F.lit(1)).alias("frequency")).where(F.col("frequency") >= least)


def top(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent phrases; ties in order of the phrase."""
    return counts.orderBy(F.desc("frequency"), "phrase").limit(n)


def report(counts: DataFrame, most: int, kind: str = "n") -> DataFrame:
    """(rank, phrase, frequency, type): the most frequent of each kind with their rank."""
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(kind).orderBy(F.desc("frequency"), "phrase")))
    return ranked.where(F.col("rank") <= most).select("rank", "phrase", "frequency", F.when(F.col(kind) == 1, "word").otherwise(F.concat(F.col(kind), F.lit("-gram"))).alias("type"))


def distinct_ngrams(df: DataFrame, n: int, text: str = "Text") -> DataFrame:
    """Exact number of distinct n-grams."""
    return ngram_counts(df, n, text=text).agg(F.count(F.lit(1)).alias("distinct_ngrams"), F.sum("frequency").alias("ngrams"))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same for the same seed: the least by hash."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
