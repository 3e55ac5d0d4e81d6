"""The whole pipeline: frequent phrases, categories, cleaning, chunks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from tessaloom.operators import chunk, clean, frequency, phrases


def mined_phrases(df: DataFrame, text: str = "Text", first: int = 4, last: int = 10, top: int = 500, least: int = 15) -> dict[str, list[str]]:
    """category -> phrases, longest first, from the most frequent n-grams; at most `top` for each n go to the driver as parameters of the cleaning expression, none is cut."""
    ranked = frequency.report(frequency.frequent_ngrams(df, first, last, least, text), top).selectExpr("CAST(split(type, '-')[0] AS INT) AS n", "phrase", "frequency")
    found = phrases.extract(ranked, least).where("category IS NOT NULL").select("category", "phrase").distinct().collect()
    out: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (-len(r["phrase"]), r["phrase"])):
        out.setdefault(row["category"], []).append(row["phrase"])
    return out


def run(df: DataFrame, text: str, dimension: DataFrame, flag: str | None = None, options: clean.Options = clean.Options(), **mining: int) -> DataFrame:
    """The chunk table of a corpus, from raw texts."""
    done = clean.gated(df, text, replace(options, phrases=mined_phrases(df, text, **mining)), flag).withColumnRenamed("flag_cleaned", "Flag_Cleaned")
    return chunk.chunk_table(done, "cleaned", dimension)
