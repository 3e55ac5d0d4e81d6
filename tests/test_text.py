import random
import re

from pyspark.sql import functions as F

from tessaloom.functions import repair, text
from tessaloom.functions.rules import DEFAULT_RULES, java, survivable


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*columns).first()


def test_words_and_ngrams(spark):
    r = one(spark, "  A b C\nd ", text.words(F.col("t")), text.ngrams(text.words(F.col("t")), 3), text.ngrams(text.words(F.col("t")), 5))
    assert r[0] == ["a", "b", "c", "d"] and r[1] == ["a b c", "b c d"] and r[2] == []
    assert one(spark, None, text.words(F.col("t")))[0] == [] and one(spark, "", text.words(F.col("t")))[0] == []


def test_tidy(spark):
    assert one(spark, "a   b \n\n\n\n c \n \n \n d", text.collapse(F.col("t")))[0] == "a b\n\nc\n\n\nd"
    assert one(spark, "short\n\n" + "x" * 50, text.long_paragraphs(F.col("t")))[0] == "x" * 50
    assert one(spark, "", text.long_paragraphs(F.col("t")))[0] == ""


def test_repair_step_by_step(spark):
    given = {
        "a0b0c": ("aob0c", {"ocr_digit_letter_fixed": 1}),  # the b between two zeros is taken by the first
        "rea1ly adress6e": ("really adressée", {"ocr_digit_letter_fixed": 2}),
        "Pr~fessor f*om": ("Professor from", {"ocr_symbol_fixed": 2}),
        "a~b~c": ("aob~c", {"ocr_symbol_fixed": 1}),
        "abcDefgHij xyZab": ("abc Defg Hij xyZab", {}),
        "ééééé x ééé": ("é x ééé", {"repeated_nonascii_collapsed": 4}),
        "\x01\ufffdend\ttab": ("end\ttab", {"replacement_chars_removed": 2}),
        "dâ€™un Ã©t": ("d’un ét", {"mojibake_fixed": 2}),
        "e\u0301te": ("éte", {"unicode_normalized": 1}),
        "plain 2001": ("plain 2001", {}), "": ("", {}),
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(given)] + [(99, None)], "row_idx bigint, Text string")
    got = {r["Text"]: (r["repaired"], r["fixes"]) for r in repair.repaired(rows, "Text").collect()}
    assert got.pop(None) == (None, None) and got == given


def test_rules_survive_and_agree(spark):
    rng = random.Random(3)
    rules = [p for c, _, patterns in DEFAULT_RULES for p in patterns if c == "formatting_artifacts"]
    texts = ["".join(rng.choice([". ", "- ", "– ", "1 ", "a ", "b ", "and, ", "and ", "x", " ", "• ", "—  "]) for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    flags = re.MULTILINE | re.DOTALL | re.IGNORECASE
    for p in rules:
        got = [r[0] for r in df.select(F.regexp_replace("t", java(p), "#")).collect()]
        assert got == [re.sub(p, "#", t, flags=flags) for t in texts], p
        assert re.sub(survivable(p), "#", ". " * 9 + ".", flags=flags) is not None
    assert one(spark, ". " * 50_000 + ".", F.regexp_replace("t", java(rules[0]), ""))[0] == ""
