"""Recurring phrases sorted into categories of boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaloom.functions.text import strip

# What makes a phrase one of a category. Keywords are searched anywhere in the lower-case phrase.
FORMATTING = (r"^[.\-–—•]+$", r"^[0-9\s]+$", r"^[–\-\s]+$", r"^[•\s]+$", r"^[·\s]+$")
KEYWORDS = {
    "administrative": ("status:", "priority:", "target date:", "quarter", "thousand", "dollars", "budget", "expenditure", "appropriation", "adjustment", "recosting", "financial resources", "post resources", "board's recommendation", "agreed with", "enquiry", "informed that"),
    "procedural": ("official records", "report of the secretary", "general assembly", "economic and social council", "resolution", "session", "committee", "upon enquiry", "by the general assembly in"),
    "ceremonial": ("his excellency", "her excellency", "on behalf of", "i would like to", "allow me to", "congratulate", "thank", "honour", "privilege"),
    "entity_names": ("united kingdom of great britain", "latin america and the caribbean", "least developed countries", "small island developing", "landlocked developing countries", "office of the united nations", "department of", "high commissioner for"),
}
METADATA = (r"volume [ivx]+", r"page \d+", r"paragraph \d+", r"section [a-z0-9]+", r"annex [ivx]+", r"appendix [a-z]+")
CATEGORIES = ("formatting", "administrative", "procedural", "ceremonial", "entity_names", "metadata")


def has_keyword(phrase: Column, category: str) -> Column:
    return F.lower(phrase).rlike("|".join(rf"\Q{k}\E" for k in KEYWORDS[category]))


def is_formatting(phrase: Column) -> Column:
    few_letters = phrase.rlike(r"(?U)^[a-z\s]+$") & (F.length(F.replace(phrase, F.lit(" "), F.lit(""))) <= 3)
    return phrase.rlike("(?U)" + "|".join(FORMATTING)) | few_letters


def is_metadata(phrase: Column) -> Column:
    return F.lower(phrase).rlike("(?U)" + "|".join(METADATA))


def category(phrase: Column) -> Column:
    """The first category that matches, null for none."""
    tests = {"formatting": is_formatting(phrase), **{k: has_keyword(phrase, k) for k in KEYWORDS}, "metadata": is_metadata(phrase)}
    out = F.lit(None).cast("string")
    for name in reversed(CATEGORIES):
        out = F.when(tests[name], name).otherwise(out)
    return out


def extract(frequencies: DataFrame, least: int = 50) -> DataFrame:
    """(category, phrase, frequency, ngram_size) of the phrases that reach the least frequency; category null if none matches."""
    kept = frequencies.where(F.col("frequency") >= least).withColumn("phrase", strip(F.col("phrase")))
    return kept.select(category(F.col("phrase")).alias("category"), "phrase", "frequency", F.col("n").cast("string").alias("ngram_size"))


def category_counts(extracted: DataFrame) -> DataFrame:
    """(category, phrases): one row a category, 'skipped' for none and 'total' for all categorised."""
    named = extracted.select(F.coalesce("category", F.lit("skipped")).alias("category"))
    per = named.groupBy("category").agg(F.count(F.lit(1)).alias("phrases"))
    return per.unionByName(extracted.where("category IS NOT NULL").agg(F.count(F.lit(1)).alias("phrases")).select(F.lit("total").alias("category"), "phrases"))


def removal_list(extracted: DataFrame, categories: list[str] | None = None, least: int = 100, most: int | None = None) -> DataFrame:
    """The distinct phrases of the categories (all by default), longest first; ties in order of the phrase."""
    rows = extracted.where(F.col("category").isin(categories or list(CATEGORIES)) & (F.col("frequency") >= least)).select("phrase").distinct()
    ordered = rows.select("phrase", F.length("phrase").alias("chars")).orderBy(F.desc("chars"), "phrase")
    return ordered.limit(most) if most else ordered


def dictionary(extracted: DataFrame) -> DataFrame:
    """(category, entries): the phrases of a category as one JSON array, most frequent first. Categories hold boilerplate only, which is short."""
    rows = extracted.where("category IS NOT NULL").groupBy("category").agg(F.array_sort(F.collect_list(F.struct((-F.col("frequency")).alias("o"), "phrase", "frequency", "ngram_size"))).alias("e"))
    return rows.select("category", F.to_json(F.transform("e", lambda x: F.struct(x["phrase"].alias("phrase"), x["frequency"].alias("frequency"), x["ngram_size"].alias("ngram_size")))).alias("entries"))
