"""Repair of encoding and scanning damage by fixed rules, with counts of what was done."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

CONTROLS = "[�\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]"
# Garbled pairs in the order in which they are replaced.
GARBLED = (
    ("â€™", "’"), ("â€œ", "“"), ("â€\x9d", "”"), ('â€"', "—"), ("Ã©", "é"), ("Ã¨", "è"), ("Ã ", "à"), ("Ã¯", "ï"), ("Ã®", "î"), ("Ã´", "ô"), ("Ã»", "û"), ("Ã§", "ç"),
)
SIGN_IN_WORD = r"(?U)\b\w+[~*]\w+\b"
DIGIT_IN_WORD = r"[a-z](?U)\d[a-z]"


@F.pandas_udf(StringType())
def nfc(texts):  # type: ignore[no-untyped-def]
    return texts.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFC", t))


def without_controls(c: Column) -> Column:
    return F.regexp_replace(c, CONTROLS, "")


def ungarbled(c: Column) -> Column:
    for bad, good in GARBLED:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def signs_mended(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)(\b\w+)[~](\w+\b)", "$1o$2"), r"(?U)(\b\w+)[*](\w+\b)", "$1r$2")


def digits_mended(c: Column) -> Column:
    for pattern, by in ((r"([a-z])6([ea])", "$1é$2"), (r"([a-z])0([a-z])", "$1o$2"), (r"([a-z])1([a-z])", "$1l$2")):
        c = F.regexp_replace(c, pattern, by)
    return c


def runs_collapsed(c: Column) -> Column:
    return F.regexp_replace(c, r"([^\x00-\x7F])\1{3,}", "$1")


def words_parted(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<=[a-z]{3})(?=[A-Z][a-z]{2})", " ")


def repaired(df: DataFrame, text: str, into: str = "repaired", fixes: str = "fixes") -> DataFrame:
    """df with the repaired text and a map of the numbers of fixes by kind, only kinds that occurred; null texts give null."""
    t = F.col(text)
    steps = df.withColumn("_1", nfc(t)).withColumn("_2", without_controls(F.col("_1")))
    acc = F.struct(F.col("_2").alias("x"), F.lit(0).alias("n"))
    pairs = F.array(*(F.struct(F.lit(bad).alias("bad"), F.lit(good).alias("good")) for bad, good in GARBLED))
    fold = F.aggregate(pairs, acc, lambda a, p: F.when(F.contains(a["x"], p["bad"]), F.struct(F.replace(a["x"], p["bad"], p["good"]).alias("x"), (a["n"] + ((F.length(a["x"]) - F.length(F.replace(a["x"], p["bad"], F.lit("")))) / F.length(p["bad"])).cast("int")).alias("n"))).otherwise(a))
    steps = steps.withColumn("_3", fold).withColumn("_4", F.col("_3.x"))
    steps = steps.withColumn("_signs", F.regexp_count("_4", F.lit(SIGN_IN_WORD))).withColumn("_5", F.when(F.col("_signs") > 0, signs_mended(F.col("_4"))).otherwise(F.col("_4")))
    steps = steps.withColumn("_digits", F.regexp_count("_5", F.lit(DIGIT_IN_WORD))).withColumn("_6", F.when(F.col("_digits") > 0, digits_mended(F.col("_5"))).otherwise(F.col("_5")))
    steps = steps.withColumn("_7", runs_collapsed(F.col("_6")))
    counts = {
        "unicode_normalized": (F.col("_1") != t).cast("int"), "replacement_chars_removed": F.length("_1") - F.length("_2"), "mojibake_fixed": F.col("_3.n"),
        "ocr_symbol_fixed": F.col("_signs"), "ocr_digit_letter_fixed": F.col("_digits"), "repeated_nonascii_collapsed": F.length("_6") - F.length("_7"),
    }
    made = F.map_filter(F.create_map(*(x for k, v in counts.items() for x in (F.lit(k), v.cast("int")))), lambda k, v: v > 0)
    # as one generated row, so later filters don't copy the steps
    return steps.select(*df.columns, F.inline_outer(F.array(F.struct(words_parted(F.col("_7")).alias(into), F.when(t.isNotNull(), made).alias(fixes)))))
