"""Cleaning: exact phrases and ordered rules removed, white space and short paragraphs tidied, with statistics."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaloom.functions.repair import repaired
from tessaloom.functions.rules import DEFAULT_RULES, java
from tessaloom.functions.text import collapse, long_paragraphs, reduction, strip

#: Categories of phrases that are removed unless others are named; ceremonial ones stay.
PHRASE_CATEGORIES = ("formatting", "administrative", "procedural", "metadata", "entity_names")


@dataclass(frozen=True)
class Options:
    """rules: (category, pattern) in order; phrases: category -> phrases; the rest as in a rule file."""

    rules: tuple[tuple[str, str], ...] = tuple((c, p) for c, on, patterns in DEFAULT_RULES if on for p in patterns)
    phrases: dict[str, list[str]] = field(default_factory=dict)
    tidy: bool = True
    least_paragraph: int = 50
    use_phrases: bool = True
    use_rules: bool = True
    repair: bool = True


def valid_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> tuple[tuple[str, str], ...]:
    """The rules whose patterns the JVM compiles, in order; others are left out, as a bad rule must not end a job."""
    compiles = spark.sparkContext._jvm.java.util.regex.Pattern.compile

    def good(pattern: str) -> bool:
        try:
            compiles(java(pattern))
        except Exception:  # noqa: BLE001
            return False
        return True

    return tuple((c, p) for c, p in rules if good(p))


def read_options(spark: SparkSession, path: str, **more: object) -> Options:
    """Options from a rule file in JSON (boilerplate_patterns, text_cleaning, output_options). A missing or broken file raises."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    rules = [(c, p) for c, rule in found["boilerplate_patterns"].items() if rule.get("enabled", True) for p in rule.get("patterns", [])]
    return Options(valid_rules(spark, rules), tidy=found["text_cleaning"].get("remove_extra_whitespace", True), least_paragraph=found["output_options"].get("min_paragraph_length", 50), **more)


def read_phrases(path: str) -> dict[str, list[str]]:
    """category -> phrases, longest first and else in the file's order; an absent or unreadable file gives none."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        return {c: sorted((e["phrase"] for e in entries), key=len, reverse=True) for c, entries in found.items() if entries}
    except (OSError, ValueError, AttributeError, KeyError, TypeError):
        return {}


def without_phrases(c: Column, phrases: dict[str, list[str]], categories: tuple[str, ...] = PHRASE_CATEGORIES) -> Column:
    """struct<x, n map>: the text with the phrases replaced by a blank, one after the other, and how many of each category.

    A fold over one array: each phrase sees what those before it left. Texts
    without a phrase aren't rewritten.
    """
    listed = [(k, p) for k in categories for p in phrases.get(k, []) if p]
    start = F.struct(c.alias("x"), F.array().cast("array<string>").alias("hits"))
    if not listed:
        return F.struct(c.alias("x"), F.create_map().cast("map<string,int>").alias("n"))
    array = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in listed))

    def step(a: Column, e: Column) -> Column:
        count = ((F.length(a["x"]) - F.length(F.replace(a["x"], e["p"], F.lit("")))) / F.length(e["p"])).cast("int")
        return F.when(F.contains(a["x"], e["p"]), F.struct(F.replace(a["x"], e["p"], F.lit(" ")).alias("x"), F.concat(a["hits"], F.array_repeat(e["k"], count)).alias("hits"))).otherwise(a)

    def finish(a: Column) -> Column:
        names = F.array_distinct(a["hits"])
        return F.struct(a["x"].alias("x"), F.map_from_arrays(names, F.transform(names, lambda k: F.size(F.filter(a["hits"], lambda h: h == k)))).alias("n"))

    return F.aggregate(array, start, step, finish)


def without_matches(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """struct<x, counts>: the text after all rules in order and the matches of each rule, in the order of the rules."""
    start = F.struct(c.alias("x"), F.array().cast("array<int>").alias("counts"))
    if not rules:
        return start

    # most rules match nothing: those read the text, and compile the pattern, once
    def step(a: Column, p: Column) -> Column:
        done = F.struct(F.regexp_replace(a["x"], p, F.lit("")).alias("x"), F.concat(a["counts"], F.array(F.regexp_count(a["x"], p))).alias("counts"))
        return F.when(F.rlike(a["x"], p), done).otherwise(F.struct(a["x"].alias("x"), F.concat(a["counts"], F.array(F.lit(0))).alias("counts")))

    return F.aggregate(F.array(*(F.lit(java(p)) for _, p in rules)), start, step)


def rule_counts(counts: Column, rules: tuple[tuple[str, str], ...], last_only: bool = True) -> Column:
    """Matches by category, only categories that matched. last_only: of each category the last rule that matched, as reports have always shown; else their sum."""
    pairs = []
    for category in dict.fromkeys(c for c, _ in rules):
        own = [counts[i] for i, (c, _) in enumerate(rules) if c == category]
        value = F.coalesce(*(F.when(x > 0, x) for x in reversed(own)), F.lit(0)) if last_only else sum(own[1:], own[0])
        pairs += [F.lit(category), value]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v > 0) if pairs else F.create_map().cast("map<string,int>")


def cleaned(df: DataFrame, text: str, options: Options = Options(), into: str = "cleaned", last_only: bool = True) -> DataFrame:
    """df with the cleaned text and original_length, fixes, phrases_removed, rules_removed, cleaned_length, reduction_percent.

    Null texts give an empty text of length 0. cleaned_length is taken before
    the outer white space of the result is stripped. Columns of these names
    must not be there.
    """
    made = (into, "original_length", "fixes", "phrases_removed", "rules_removed", "cleaned_length", "reduction_percent")
    if set(made) & set(df.columns):
        raise ValueError(f"a column is there already: {set(made) & set(df.columns)}")
    rows = df.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    rows = repaired(rows, "_t", "_r", "_fixes") if options.repair else rows.withColumn("_r", F.col("_t")).withColumn("_fixes", F.create_map().cast("map<string,int>"))
    rows = rows.withColumn("_p", without_phrases(F.col("_r"), options.phrases if options.use_phrases else {}))
    rows = rows.withColumn("_m", without_matches(F.col("_p.x"), options.rules if options.use_rules else ()))
    rows = rows.withColumn("_w", collapse(F.col("_m.x")) if options.tidy else F.col("_m.x")).withColumn("_c", long_paragraphs(F.col("_w"), options.least_paragraph))
    before, after = F.length("_t"), F.length("_c")
    values = (strip(F.col("_c")), before, F.col("_fixes"), F.col("_p.n"), rule_counts(F.col("_m.counts"), options.rules if options.use_rules else (), last_only), after, reduction(before, after))
    return rows.select(*df.columns, F.inline_outer(F.array(F.struct(*(v.alias(n) for v, n in zip(values, made))))))


def gated(df: DataFrame, text: str, options: Options = Options(), flag: str | None = None, valid: int = 1, into: str = "cleaned") -> DataFrame:
    """cleaned, with flag_cleaned: rows whose flag is null or not the valid value keep their text (null: empty) and are skipped_invalid.

    Then texts that are null are skipped_empty, the others cleaned. Without the
    flag's column there is no gate.
    """
    rows = cleaned(df, text, options, into="_done")
    gate = F.lit(False) if flag is None or flag not in df.columns else F.col(flag).isNull() | (F.col(flag).cast("int") != valid)
    status = F.when(gate, "skipped_invalid").when(F.col(text).isNull(), "skipped_empty").otherwise("cleaned")
    return rows.withColumn("flag_cleaned", status).withColumn(into, F.when(F.col("flag_cleaned") == "cleaned", F.col("_done")).otherwise(F.coalesce(F.col(text), F.lit("")))).drop("_done")


def corpus_stats(rows: DataFrame) -> DataFrame:
    """One row of totals over gated rows; averages are of the rounded values of rows, 0 without any."""
    done = F.col("flag_cleaned") == "cleaned"
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0), lambda a, x: a + x)
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("flag_cleaned") == "skipped_invalid").alias("skipped_invalid"),
        F.coalesce(F.sum(F.when(done, F.col("original_length"))), F.lit(0)).alias("total_original_chars"), F.coalesce(F.sum(F.when(done, F.col("cleaned_length"))), F.lit(0)).alias("total_cleaned_chars"),
        F.count_if(done & (F.size("fixes") > 0)).alias("fixed_rows"), F.coalesce(F.sum(F.when(done, total("phrases_removed"))), F.lit(0)).alias("phrases_removed"), F.coalesce(F.sum(F.when(done, total("rules_removed"))), F.lit(0)).alias("rule_matches_removed"),
        F.coalesce(F.round(F.avg(F.when(done, F.col("reduction_percent"))), 2), F.lit(0.0)).alias("avg_reduction_percent"),
    )


def reduction_summary(rows: DataFrame, column: str = "reduction_percent") -> DataFrame:
    return rows.agg(F.avg(column).alias("mean"), F.median(column).alias("median"), F.min(column).alias("least"), F.max(column).alias("most"))


def reduction_histogram(rows: DataFrame, column: str = "reduction_percent") -> DataFrame:
    """(bucket, rows, percent) for <10, 10-25, 25-50, 50-75 and >=75; all buckets come out."""
    c = F.col(column)
    edges = (("<10", c < 10), ("10-25", (c >= 10) & (c < 25)), ("25-50", (c >= 25) & (c < 50)), ("50-75", (c >= 50) & (c < 75)), (">=75", c >= 75))
    one = rows.agg(F.array(*(F.struct(F.lit(name).alias("bucket"), F.count_if(test).alias("rows")) for name, test in edges)).alias("b"), F.count(F.lit(1)).alias("all"))
    return one.select("all", F.inline("b")).select("bucket", "rows", F.when(F.col("all") > 0, F.round(100 * F.col("rows") / F.col("all"), 2)).otherwise(0.0).alias("percent"))


def weighted_reduction(rows: DataFrame) -> DataFrame:
    return rows.agg(F.round((1 - F.sum("cleaned_length") / F.sum("original_length")) * 100, 2).alias("weighted_reduction"))


def band_sample(rows: DataFrame, key: str, column: str = "reduction_percent", seed: int = 42) -> DataFrame:
    """One row of each band (<10, 25-50, >=50, any) that has one: the least by hash."""
    c = F.col(column)
    bands = F.filter(F.array(F.when(c < 10, "low"), F.when((c >= 25) & (c < 50), "medium"), F.when(c >= 50, "high"), F.lit("any")), lambda b: b.isNotNull())
    first = rows.select(F.explode(bands).alias("band"), F.struct(F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.col(key), c.alias("reduction")).alias("r")).groupBy("band").agg(F.min("r").alias("r"))
    return first.select("band", F.col(f"r.{key}").alias(key), F.col("r.reduction").alias("reduction_percent"))
