"""Problem 2: text garbled by decoding with the wrong character encoding.

The garbled forms of every distinct clean word of the corpus under all chains
are generated and documents' words are hash-joined against them. Words that
only occur garbled, or that hold other noise too, are joined by their runs of
characters beyond ASCII, whose garbled forms stand in the same table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessaloom.llm import charsets
from tessaloom.session import durable, small_side

#: Everything of ASCII but letters, digits, apostrophe and hyphen parts words.
BREAK = r"[\x00-\x26\x28-\x2c\x2e\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
BEYOND = r"[^\x00-\x7f]"
#: Traces that no clean word has: a lost character or a control character of the upper range.
#: A form of a run shows garbling in itself if two characters are beyond ASCII, or one of an East Asian script or lost.
TELLING = r"[^\x00-\x7f]{2}|[�\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"
TRACE = r"[�\x80-\x84\x86-\x9f]"
FORMS = "form string, original string, level string, by_byte boolean, seen bigint"


def words(text: Column) -> Column:
    """The distinct words of a text that have a character beyond ASCII."""
    return F.array_distinct(F.filter(F.split(text, BREAK), lambda x: x.rlike(BEYOND)))


def _units(word: str) -> set[str]:
    """Runs beyond ASCII, alone and with the next character: some sets of two bytes swallow it."""
    return {x for m in charsets.RUN.finditer(word) for x in (m.group(), word[m.start() : m.end() + 1])}


def _write_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        units: dict[str, int] = {}
        for word, seen in zip(batch["word"].to_pylist(), batch["seen"].to_pylist()):
            if charsets.restored(word) is not None:
                continue  # itself garbled
            out += [(form, word, "word", charsets.by_byte(chain), seen) for chain, form in charsets.garbled(word)]
            for unit in {*_units(word), *charsets.NON_ASCII.findall(word)}:
                units[unit] = units.get(unit, 0) + seen
        for unit, seen in units.items():
            out += [(form, unit, "unit", False, seen) for chain, form in charsets.garbled(unit) if not charsets.by_byte(chain)]
        form, original, level, one, seen = zip(*out) if out else ([],) * 5
        yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()), pa.array(original, pa.string()), pa.array(level, pa.string()), pa.array(one, pa.bool_()), pa.array(seen, pa.int64())], ["form", "original", "level", "by_byte", "seen"])


def _write_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(word, unit) for word in batch["word"].to_pylist() for unit in _units(word)]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], ["word", "unit"])


def garbled_forms(vocabulary: DataFrame) -> DataFrame:
    """(form, level, original, by_byte, seen) for the clean words of a vocabulary (word, seen).

    Of several originals of one form the one seen in most documents is kept,
    of equal ones the first in order.
    """
    clean = vocabulary.where(~F.col("word").rlike(TRACE))
    written = clean.mapInArrow(_write_forms, FORMS).where((F.col("form") != F.col("original")) & (F.when(F.col("level") == "unit", F.col("form").rlike(TELLING)).otherwise(~F.col("by_byte") | F.col("form").rlike(r"\p{L}"))))
    # a unit is counted by batches of words: its sum first, so that nothing depends on how words fall into batches
    summed = written.groupBy("form", "level", "original", "by_byte").agg(F.sum("seen").alias("seen"))
    return summed.groupBy("form", "level").agg(F.max(F.struct("seen", F.col("by_byte").alias("by_byte"), "original")).alias("best"), F.min("by_byte").alias("by_byte")).select("form", "level", F.col("best.original").alias("original"), "by_byte", F.col("best.seen").alias("seen"))


def _pure(word: Column) -> Column:
    """Letters of one script other than Latin and nothing else: no garbling shows in the word itself."""
    return word.rlike(r"^(?:[\p{IsCyrillic}]+|[\p{IsGreek}]+|[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]+|[\p{IsHangul}]+)$")


def garbled_words(vocabulary: DataFrame) -> DataFrame:
    """(word, original, certain): the words of a vocabulary (word, seen) that are garbled.

    original is null where it can't be had. certain is false for words that
    would be proper words of another script: they count only beside others.
    """
    forms = durable(garbled_forms(vocabulary))
    whole = forms.where("level = 'word'").select(F.col("form").alias("word"), "original", "by_byte", F.col("seen").alias("original_seen"))
    by_word = vocabulary.join(whole, "word").where(~F.col("by_byte") | (F.col("original_seen") > F.col("seen"))).select("word", "original", F.lit(True).alias("hit"))
    units = vocabulary.mapInArrow(_write_units, "word string, unit string")
    by_unit = units.join(forms.where("level = 'unit'").select(F.col("form").alias("unit")), "unit", "left_semi").select("word", F.lit(None).cast("string").alias("original"), F.lit(True).alias("hit"))
    traces = vocabulary.where(F.col("word").rlike(TRACE)).select("word", F.lit(None).cast("string").alias("original"), F.lit(True).alias("hit"))
    found = by_word.unionByName(by_unit).unionByName(traces).groupBy("word").agg(F.max("original").alias("original"))
    return found.select("word", F.coalesce("original", _restored(F.col("word"))).alias("original"), (~_pure(F.col("word"))).alias("certain"))


@F.pandas_udf(StringType())
def _restored(word):  # type: ignore[no-untyped-def]
    return word.map(charsets.restored)


def _vocabulary(rows: DataFrame, extra: DataFrame | None) -> DataFrame:
    counted = rows.groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
    if extra is not None:
        more = extra.select(F.explode(words(F.col(extra.columns[0]))).alias("word"))
        counted = counted.unionByName(more.groupBy("word").agg(F.count(F.lit(1)).alias("seen"))).groupBy("word").agg(F.sum("seen").alias("seen"))
    return durable(counted)


def garbled_rows(df: DataFrame, key: str, text: str, extra: DataFrame | None = None) -> DataFrame:
    """(key, words): the rows whose text holds a garbled word, with array<struct<word, original>>.

    extra: one column of further clean texts (a list of names, say) whose words
    count as corpus words. Null and blank texts are never found; repeated rows
    are found each; an empty table gives an empty result.
    """
    rows = df.where(F.col(text).rlike(BEYOND)).select(F.col(key).alias("_key"), F.explode_outer(words(F.col(text))).alias("word")).where(F.col("word").isNotNull())
    bad = small_side(garbled_words(_vocabulary(rows, extra)))
    hits = rows.join(bad, "word").groupBy("_key").agg(F.max("certain").alias("certain"), F.collect_list(F.struct("word", "original")).alias("words"))
    return hits.where("certain").select(F.col("_key").alias(key), "words")


def restored_texts(df: DataFrame, key: str, text: str, extra: DataFrame | None = None) -> DataFrame:
    """(key, text, restored, lost): the rows of garbled_rows with the verified originals put in place.

    The text is parted into words as they were looked up, and each is replaced
    as a whole, never a part of another. A word that would be a proper word of
    another script is replaced only if the text has no other word of pure
    foreign letters, as such a text may be in that script. A word without an
    original stays as it is; lost counts those and the ones left for that
    reason. What stands between words isn't changed.
    """
    found = garbled_rows(df, key, text, extra).withColumnRenamed("words", "_words")
    both = df.select(key, text).join(found, key)
    known = F.transform("_words", lambda x: x["word"])
    foreign = F.exists(words(F.col(text)), lambda w: _pure(w) & ~F.array_contains(known, w))
    put = F.filter("_words", lambda x: x["original"].isNotNull() & (~_pure(x["word"]) | ~F.col("_foreign")))
    both = both.withColumn("_foreign", foreign).withColumn("_put", F.map_from_entries(F.transform(put, lambda x: F.struct(x["word"], x["original"]))))
    tokens = F.regexp_extract_all(text, F.lit(rf"{BREAK}|[^{BREAK[1:-2]}]+"), F.lit(0))
    restored = F.array_join(F.transform(tokens, lambda w: F.coalesce(F.element_at("_put", w), w)), "")
    return both.select(key, text, restored.alias("restored"), (F.size("_words") - F.size("_put")).cast("bigint").alias("lost"))
