"""Problem 1: statistics of a document's words, signs and lines, and rules that tell speeches from lists, tables and junk."""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



#: Words that stand in most documents of the corpus count as common, so many of them.
COMMON_WORDS = 100
#: Shares of short words under these make a line sparse.
SPARSE, SPARSER = 0.24, 0.12
#: Tokens in one block of those whose different ones are counted.
BLOCK = 40
MARK = r"^\s*(?:[(\[]?\p{N}{1,4}[.):\]]|[(\[]?\p{L}\)|\p{N}{1,4}\s{2,}|[-–—•·*+>o]\s|\p{L}{2,12}\s\p{N}{1,4}\s?[.:)–—-]|\p{L}{1,3}\.(?:\p{L}\.)?\s\p{Lu}|\S*\p{N}\S*\s?[=:\t]\s?\S)"
SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*\s*$"
SEPARATOR = r"[|¦\t;]|\S,(?=\S)|,\s?(?=[,\p{N}-])|\s{3,}"
#: Words of one to three letters, which any language with blanks between its words has among longer ones; languages without blanks have their own letters.
SHORT_WORD = r"(?<![^\s(\[\"'“«¿¡])\p{L}{1,3}(?=[,;:]?(?:\s|$))|[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}]{2,6}"
#: The figures that rules are induced from; none of them is bound to a language.
FIGURES = ("words", "word_length", "symbol_share", "digit_share", "end_share", "short_share", "lines", "line_length", "marked_share", "table_share", "bare_share", "run_share", "sparse_share", "sparser_share", "open_share", "different_share")


def _let(value: Column, use) -> Column:  # type: ignore[no-untyped-def]
    """use(value) with the value computed once: inside of functions of arrays Spark shares no common expressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _without(text: Column, pattern: str) -> Column:
    """The number of characters in what matches: runs are taken out at once, not counted one by one."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


#: What a figure needs of a line.
NEEDS = {"words": "w", "word_length": "w letters", "end_share": "end", "short_share": "w c", "marked_share": "mark end", "table_share": "table", "bare_share": "letters", "run_share": "run", "sparse_share": "w c", "sparser_share": "w c", "open_share": "end"}


def _lines(text: Column, needed: set[str]) -> Column:
    """array<struct> of the lines that have a character: its length, words, short words and looks, as far as needed."""

    def look(line: Column) -> Column:
        looks = {
            "w": F.size(F.filter(F.split(line, " "), lambda w: w != "")),
            "c": F.regexp_count(line, F.lit(SHORT_WORD)),
            "letters": _without(line, r"[\p{L}\p{M}]+"),
            "run": _without(line, r"\S{26,}"),
            "end": F.right(line, F.lit(8)).rlike(SENTENCE_END),
            "mark": line.rlike(MARK),
            "table": (F.regexp_count(line, F.lit(SEPARATOR)) * 25 >= F.length(line)) | line.rlike(r"^[\s|+=_-]{6,}$|(?:\. ?){4,}\s*\p{N}{1,4}\s*$"),
        }
        looks["ends"] = looks["end"].cast("int")
        return F.struct(F.length(line).alias("n"), *(c.alias(k) for k, c in looks.items() if k in needed or k == "ends" and "end" in needed))

    return F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), look)


def different_share(text: Column) -> Column:
    """Different tokens in blocks of BLOCK as a share of all; 1 without any token."""

    def of(t: Column) -> Column:
        different = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1)), F.lit(BLOCK)), F.lit(0), lambda acc, i: acc + F.size(F.array_distinct(F.slice(t, i, F.lit(BLOCK)))))
        return F.when(F.size(t) > 0, different / F.size(t)).otherwise(1.0)

    return _let(F.filter(F.split(F.lower(F.translate(text, "\n\t", "  ")), " "), lambda w: w != ""), of)


def figures(df: DataFrame, text: str = "Text", only: tuple[str, ...] = FIGURES) -> DataFrame:
    """df with one column for each figure of FIGURES, or of `only`; all null where the text is null, 0 (different_share: 1) where it is blank.

    words, word_length, symbol_share, digit_share, end_share (lines that end as
    a sentence), short_share (words of up to three letters) and different_share
    are over the whole text; the others are shares of characters in lines of
    one kind each: marked as an item, parted into columns, mostly without
    letters, of long runs without a blank, with few short words, without the end
    of a sentence. A line's short words and ends are taken with its two neighbours', so a short line of broken prose
    isn't judged by itself. Extra columns stay; a column of such a name raises.
    """
    if set(FIGURES) & set(df.columns):
        raise ValueError("a column has the name of a figure")
    t = F.col(text)
    needed = {k for name in only for k in NEEDS.get(name, "").split()}
    rows = df.withColumn("_lines", _lines(t, needed))
    lines = F.col("_lines")

    def near(at: Column, field: str) -> Column:
        return F.aggregate(F.slice(lines, F.greatest(at, F.lit(1)), F.when(at < 1, 2).otherwise(3)), F.lit(0), lambda acc, x: acc + x[field])

    def marks(x: Column, i: Column) -> Column:
        made = {"s": lambda: F.when(near(i, "w") > 0, near(i, "c") / near(i, "w")).otherwise(0.0), "mark": lambda: x["mark"] & ~x["end"], "table": lambda: x["table"], "bare": lambda: x["letters"] * 2 < x["n"], "run": lambda: x["run"] * 3 > x["n"], "open": lambda: near(i, "ends") == 0}
        of = {"s": {"w", "c"}, "mark": {"mark", "end"}, "table": {"table"}, "bare": {"letters"}, "run": {"run"}, "open": {"end"}}
        return F.struct(x["n"].alias("n"), *(f().alias(k) for k, f in made.items() if of[k] <= needed))

    rows = rows.withColumn("_near", F.transform(lines, marks))

    def sum_of(field: str) -> Column:
        return F.aggregate(lines, F.lit(0), lambda acc, x: acc + x[field])

    def of(kind) -> Column:  # type: ignore[no-untyped-def]
        return F.when(total > 0, F.aggregate("_near", F.lit(0), lambda acc, x: acc + F.when(kind(x), x["n"]).otherwise(0)) / total).otherwise(0.0)

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    total, words, letters = sum_of("n"), lambda: sum_of("w"), lambda: sum_of("letters")
    made = {
        "words": lambda: words().cast("double"),
        "word_length": lambda: ratio(letters(), words()),
        "symbol_share": lambda: ratio(_without(t, r"[^\p{L}\p{M}\p{N}\s]+"), F.length(t)),
        "digit_share": lambda: ratio(_without(t, r"\p{N}+"), F.length(t)),
        "end_share": lambda: ratio(F.size(F.filter(lines, lambda x: x["end"])), F.size(lines)),
        "short_share": lambda: ratio(sum_of("c"), words()),
        "lines": lambda: F.size(lines).cast("double"),
        "line_length": lambda: ratio(total, F.size(lines)),
        "marked_share": lambda: of(lambda x: x["mark"]),
        "table_share": lambda: of(lambda x: x["table"]),
        "bare_share": lambda: of(lambda x: x["bare"]),
        "run_share": lambda: of(lambda x: x["run"]),
        "sparse_share": lambda: of(lambda x: x["s"] < SPARSE),
        "sparser_share": lambda: of(lambda x: x["s"] < SPARSER),
        "open_share": lambda: of(lambda x: x["open"]),
        "different_share": lambda: different_share(t),
    }
    # as one generated row: a later filter on a figure isn't pushed down, which would copy the whole expression into it
    return rows.select(*df.columns, F.inline_outer(F.array(F.struct(*(F.when(t.isNotNull(), c.cast("double")).alias(name) for name, c in ((name, made[name]()) for name in only))))))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), lambda w: w != "")


def common_words(df: DataFrame, text: str = "Text", most: int = COMMON_WORDS) -> list[str]:
    """The words that stand in most documents of the corpus itself, ties in their order; at most `most` go to the driver."""
    seen = df.where(F.col(text).isNotNull()).select(F.explode_outer(F.array_distinct(_tokens(F.col(text)))).alias("word")).where(F.col("word").isNotNull())
    return [r["word"] for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(most).select("word").collect()]


def common_share(text: Column, common: list[str]) -> Column:
    """The share of a text's words that are common in the corpus; 0 without words, null for null."""
    return _let(_tokens(text), lambda t: F.when(F.size(t) > 0, F.size(F.filter(t, lambda w: w.isin(common))) / F.size(t)).when(text.isNotNull(), 0.0))


def rules() -> list[dict]:
    """The rules induced by train_prose, in order: the first whose conditions all hold decides; prose if none does."""
    return json.loads(resources.files("tessaloom.llm").joinpath("prose_rules.json").read_text())


def needed_figures(ordered: list[dict] | None = None) -> tuple[str, ...]:
    """words and the figures that the rules ask for; others needn't be computed to apply them."""
    asked = {name for rule in (rules() if ordered is None else ordered) for name, _, _ in rule["if"]}
    return tuple(name for name in FIGURES if name in asked | {"words"})


def is_prose(ordered: list[dict] | None = None) -> Column:
    """The rules as one SQL CASE over the figures; null where the text is null."""
    branches = " ".join(f"WHEN {' AND '.join(f'{name} {sign} {threshold!r}D' for name, sign, threshold in rule['if'])} THEN {str(rule['prose']).lower()}" for rule in (rules() if ordered is None else ordered))
    return F.expr(f"CASE WHEN words IS NULL THEN NULL {branches} ELSE true END")


def not_prose(df: DataFrame, key: str = "row_idx", text: str = "Text") -> DataFrame:
    """(key) of the rows whose text is a list, a table or junk. Null and blank texts are none of these."""
    rows = df.select(key, text).where(F.col(text).rlike(r"(?U)[^\s\x1c-\x1f]"))
    return figures(rows, text, needed_figures()).where(~is_prose()).select(key)
