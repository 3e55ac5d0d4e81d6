"""Problem 3: noise in text from scanned pages, found and repaired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessaloom.llm.prose import _let
from tessaloom.session import durable, small_side

#: A word that another with its skeleton outnumbers so many times is a misreading of it.
OUTNUMBERED = 20
LETTER = r"[\p{L}\p{M}]"
#: A word broken at the end of a line: hyphen, not sign or soft hyphen, also garbled.
BROKEN = rf"(?U)({LETTER})(?:[-¬­]|Â[­¬]|┬[¡¡¬]|¬¨|�{{1,2}})[^\S\n]*\n\s*({LETTER})"
#: Signs that stand for a letter inside a word.
MISREAD_SIGN = r"[0-9@*~]"
# Signs with the letters they are read for, and glyphs that scanning confuses as the strokes they consist of; those of equal strokes are confused, also in pairs (rn m, ii u, li h, cl d, vv w).
SIGNS = ("0@*~165", "oaroles")
STROKES = {"j": "i", "l": "i", "u": "ii", "n": "ii", "h": "ii", "b": "ii", "d": "ci", "e": "c", "m": "rii", "w": "vv", "t": "f", "q": "g"}
#: Words of fewer characters are misreadings only with a sign, of a word as long that outnumbers them SHORT_OUTNUMBERED times: too many real ones (if, it; bas, has) differ in a confused glyph.
SHORT, SHORT_OUTNUMBERED = 4, 400
#: A line is a running header if its form breaks into so many different sentences, and does so in at least this share of its places.
LEAST_BREAKS, LEAST_BREAK_SHARE = 3, 0.25
MOST_HEADER = 100
SYMBOL = r"\b\p{Lu}(?:/[\p{Lu}\p{N}.]+)+\b"


def glyph_skeleton(word: Column) -> Column:
    """A word with every confusable glyph replaced by its strokes; misreadings keep their word's skeleton."""
    one = F.translate(word, *SIGNS)
    for glyph, strokes in STROKES.items():
        one = F.replace(one, F.lit(glyph), F.lit(strokes))
    return one


def _words(text: Column) -> Column:
    """Distinct words in lower case with signs inside; document symbols and addresses are no words."""
    plain = F.lower(F.regexp_replace(text, SYMBOL, " "))
    return F.array_distinct(F.filter(F.split(plain, r"(?U)[^\p{L}\p{M}0-9@*~]+"), lambda w: (F.length(w) >= 2) & w.rlike(LETTER)))


def _signed(word: Column) -> Column:
    """A word with a sign beside or between letters, not an ordinal or a number with a unit."""
    return word.rlike(rf"{LETTER}{MISREAD_SIGN}+{LETTER}|^{MISREAD_SIGN}+{LETTER}{{2}}|{LETTER}{{2}}{MISREAD_SIGN}+$") & ~word.rlike(r"^\p{N}+\p{L}{1,2}$|^\*+\p{L}+\**$|^\p{L}+\*+$")


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, seen, skeleton) from (key, word) rows, one for each distinct word of a record."""
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("seen")).withColumn("skeleton", glyph_skeleton(F.col("word")))


def misreadings(counted: DataFrame) -> DataFrame:
    """(word, original, signed) from word_counts.

    Words are grouped by glyph skeleton in one aggregation: the group's most
    frequent clean form is kept with its count, not the group. A word is a
    misreading of it if it has a sign among its letters, or if it is
    outnumbered OUTNUMBERED times; short words have a rule of their own.
    """
    clean = counted.where(~F.col("word").rlike(MISREAD_SIGN)).groupBy("skeleton").agg(F.max(F.struct("seen", "word")).alias("best"))
    both = counted.join(clean, "skeleton").where(F.col("word") != F.col("best.word"))
    signed = _signed(F.col("word")) & (F.col("best.seen") > F.col("seen"))
    short = F.length("word") < SHORT
    alike = (F.length("word") == F.length("best.word")) & (F.col("best.seen") >= SHORT_OUTNUMBERED * F.col("seen"))
    return both.where(F.when(short, signed & alike).otherwise(signed | (F.col("best.seen") >= OUTNUMBERED * F.col("seen")))).select("word", F.col("best.word").alias("original"), signed.alias("signed"))


WORD_PARTS = r"[^\p{L}\p{M}0-9@*~]+"


def _places(text: Column) -> Column:
    """array<struct<at, word, before, behind>> of the words of a text in order; before and behind are hashes of the skeletons of the words there, which may be misread too."""
    words = lambda t: F.filter(F.split(t, WORD_PARTS), lambda w: w != "")
    # strokes are letters like their glyphs, so a text's skeleton has its words in the same places
    both = F.struct(words(F.lower(text)).alias("words"), words(glyph_skeleton(F.lower(text))).alias("skeletons"))

    def of(both: Column) -> Column:
        def beside(side: str, i: Column) -> Column:
            other = F.get(both["skeletons"], i)
            return F.when(other.isNotNull(), F.xxhash64(F.lit(side), other))

        return F.transform(both["words"], lambda w, i: F.struct(i.alias("at"), w.alias("word"), beside("before", i - 1).alias("before"), beside("behind", i + 1).alias("behind")))

    return _let(both, of)


def corrections(flows: DataFrame, texts: DataFrame, counted: DataFrame) -> DataFrame:
    """(_key, at, right): the misread words of (_key, _flow) by their place, from the texts (_text) and word counts of the whole corpus.

    All clean forms of a skeleton that outnumber the word compete at each
    place by how often they stand beside the word before and the word behind
    anywhere in the corpus; ties go to the more frequent. A word without a sign may
    be a rare word: it is replaced only by a form that stands beside both of
    its neighbours, and more often than the word itself does. A word with a
    sign takes the best form, supported or not.
    """
    wrong = misreadings(counted)
    clean = counted.where(~F.col("word").rlike(MISREAD_SIGN)).select("skeleton", F.col("word").alias("form"), F.col("seen").alias("form_seen"))
    candidates = counted.join(wrong.select("word", "signed"), "word").join(clean, "skeleton").where((F.col("form") != F.col("word")) & (F.col("form_seen") > F.col("seen"))).select("word", "signed", "form", "form_seen")
    candidates = small_side(candidates)
    at = durable(flows.select("_key", F.explode_outer(_places(F.col("_flow"))).alias("p")).select("_key", "p.*").join(small_side(candidates.select("word").distinct()), "word", "left_semi"))
    tried = at.join(candidates, "word").select("_key", "at", "word", "signed", "form", "form_seen", "before", "behind")
    both_sides = lambda df, form: df.select(F.col(form).alias("form"), F.explode(F.array("before", "behind")).alias("place")).where(F.col("place").isNotNull())
    asked = small_side(both_sides(tried, "form").unionByName(both_sides(at, "word")).distinct())
    near = both_sides(texts.select(F.explode_outer(_places(F.col("_text"))).alias("p")).select("p.*"), "word")
    support = small_side(near.join(asked, ["form", "place"]).groupBy("form", "place").agg(F.count(F.lit(1)).alias("n")))

    def count(df: DataFrame, form: str, side: str, into: str) -> DataFrame:
        right = support.select(F.col("form").alias(form), F.col("place").alias(side), F.col("n").alias(into))
        return df.join(right, [form, side], "left").na.fill(0, [into])

    scored = count(count(count(count(tried, "form", "before", "b"), "form", "behind", "h"), "word", "before", "own_b"), "word", "behind", "own_h")
    supported = ((F.col("b") > 0) | F.col("before").isNull()) & ((F.col("h") > 0) | F.col("behind").isNull()) & (F.col("b") + F.col("h") > F.col("own_b") + F.col("own_h"))
    best = scored.where(F.col("signed") | supported).groupBy("_key", "at").agg(F.max(F.struct(F.col("b") + F.col("h"), "form_seen", "form")).alias("best"))
    return best.select("_key", "at", F.col("best.form").alias("right"))


def _header_shape(bare: Column) -> Column:
    """Page numbers, document symbols alone, and short lines that end or begin in a number without being a sentence.

    It decides only where a sentence goes on behind the line and its form is too rare to be told by repetition.
    """
    number = bare.rlike(r"(?iU)^\W*(?:p|pp|pag|page|pg|pág|página|seite|s)?[.\s]*\p{N}{1,4}(?:\s*(?:of|de|/)\s*\p{N}{1,4})?[^\p{L}\p{N}]*$") & ~bare.rlike(r"^\p{N}+\.$")
    symbol = bare.rlike(rf"^{SYMBOL[2:]}$") | (bare.rlike(rf"(?U)^[^.!?:;]{{0,40}}(?:[^.!?:;]{{0,6}}\.?)?[^.!?:;]{{0,30}}[,\s]\s*{SYMBOL}$") & bare.rlike(rf"(?U)\s{{2,}}{SYMBOL}$|^\p{{Lu}}\p{{Ll}}+[.,]? [^.]{{0,14}}\.? ?[^.]{{0,4}},? ?{SYMBOL}$"))
    running = bare.rlike(r"(?U)^[\p{Lu}][^.!?;:]{2,48}(?:\s{3,}|\s+[-–—]\s+|/)\p{N}{1,4}$|^\p{N}{1,4}(?:\s{3,}|\s+[-–—]\s+|/)\p{Lu}[^.!?;:]{2,48}$")
    dated = bare.rlike(r"(?U)^\p{Lu}[^.!?;:]{2,48}\s+[-–—]\s+\p{N}{1,2}\.?\s\p{L}{3,10}$|^\p{N}{1,4}\p{L}{0,3}\.?\s\p{L}{3,12}\s{2,}\p{Lu}[^.!?;:]{2,48}$")
    return (F.length(bare) > 0) & (F.length(bare) <= 70) & (number | symbol | running | dated)


def _tidy_lines(text: Column) -> Column:
    return F.transform(F.split(text, "[\n\f]"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))


def _may_be_header(line: Column) -> Column:
    """Lines of up to MOST_HEADER characters that have a number and don't begin in a small letter, or only in one short word before the number, or that begin in a capital and don't end as a sentence or its part."""
    return (F.length(line) > 0) & (F.length(line) <= MOST_HEADER) & line.rlike(r"^(?:[^\p{Ll}]|\p{Ll}{1,8}\.?\s?\p{N}.{0,12}$)") & (line.rlike(r"\p{N}") | (line.rlike(r"^\p{Lu}..") & ~line.rlike(r"[-–—,;:.!?]$")))


def _form(line: Column) -> Column:
    """Hash of a tidied line with digits masked."""
    return F.xxhash64(F.regexp_replace(line, r"\p{N}+", "#"))


def _lines_between(text: Column) -> Column:
    """array<struct<form, after, breaks, shaped>> of a text's lines that may be headers; after is the form of the line before, breaks tells whether the sentence before goes on behind, shaped whether a line with the look of a header has a sentence going on behind it."""

    def of(all_lines: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before, behind = F.get(all_lines, i - 1), F.get(all_lines, i + 1)
            goes_on = F.coalesce(behind.rlike(r"^\p{Ll}"), F.lit(False))
            breaks = F.coalesce(goes_on & ~F.right(before, F.lit(6)).rlike(r"[.!?:;…][\"'”’»)]*$"), F.lit(False))
            return F.when(_may_be_header(x), F.struct(_form(x).alias("form"), F.when(breaks, _form(before)).alias("after"), breaks.alias("breaks"), F.when(goes_on, _header_shape(x)).otherwise(False).alias("shaped")))

        return F.filter(F.transform(all_lines, one), lambda x: x.isNotNull())

    return _let(F.filter(_tidy_lines(text), lambda x: x != ""), of)


def running_forms(between: DataFrame) -> DataFrame:
    """(form) of the page headers and page numbers among (form, after, breaks, shaped) rows.

    Lines with their digits masked are counted over all documents: a header
    recurs and breaks different sentences. Copies of a text break the same
    sentence and count once. Of forms that break too few sentences those are
    taken that look like a header.
    """
    each = between.groupBy("form").agg(F.count(F.lit(1)).alias("n"), F.count_if("breaks").alias("broken"), F.count_distinct("after").alias("sentences"), F.bool_or("shaped").alias("shaped"))
    repeated = (F.col("sentences") >= LEAST_BREAKS) & (F.col("broken") >= LEAST_BREAK_SHARE * F.col("n"))
    return each.where(repeated | F.col("shaped")).select("form")


def noisy_rows(df: DataFrame, key: str = "row_idx", text: str = "Text") -> DataFrame:
    """(key, broken, headers, misread) of the rows with any noise of scanned pages.

    broken and headers are numbers of broken words and header lines, misread
    the number of distinct misread words. Null and blank texts have none; each
    of repeated rows comes out.
    """
    t = F.col(text)
    rows = df.where(t.rlike(LETTER)).select(F.col(key).alias("_key"), t.alias("_text"))
    # texts are read and matched once; what is counted and joined comes from here
    read = durable(rows.select("_key", F.regexp_count("_text", F.lit(BROKEN)).cast("bigint").alias("broken"), F.col("_text").contains("\f").alias("paged"), _words(F.col("_text")).alias("words"), _lines_between(F.col("_text")).alias("between")))
    between = read.select("_key", F.explode("between").alias("b")).select("_key", "b.*")
    headers = between.join(small_side(running_forms(between)), "form", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).cast("bigint").alias("headers"))
    words = read.select("_key", F.explode_outer("words").alias("word")).where(F.col("word").isNotNull())
    wrong = small_side(misreadings(durable(word_counts(words))))
    misread = words.join(wrong, "word").groupBy("_key").agg(F.count(F.lit(1)).cast("bigint").alias("misread"), F.count_if("signed").alias("signed"))
    both = read.drop("words", "between").join(headers, "_key", "left").join(misread, "_key", "left").na.fill(0, ["headers", "misread", "signed"])
    return both.where((F.col("broken") > 0) | (F.col("headers") > 0) | F.col("paged") | (F.col("signed") > 0) | (F.col("misread") > 1)).select(F.col("_key").alias(key), "broken", "headers", "misread", "signed")


def repaired_rows(df: DataFrame, key: str = "row_idx", text: str = "Text") -> DataFrame:
    """(key, repaired) of the rows that noisy_rows finds: continuous paragraphs without headers, page numbers and broken or misread words.

    Lines are joined with SQL windows over each text's own lines: a header
    goes, and with it the empty lines around it if the sentence before it goes
    on; an empty line else ends a paragraph; a line that ends in a broken word
    is joined to the next without a blank. key must be unique.
    """
    noisy = small_side(noisy_rows(df, key, text).select(key))
    rows = df.join(noisy, key, "left_semi").select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    between = df.where(F.col(text).rlike(LETTER)).select(F.inline(_lines_between(F.col(text))))
    running = small_side(running_forms(between).withColumn("_runs", F.lit(True)))
    lines = rows.select("_key", F.posexplode_outer(_tidy_lines(F.col("_text"))).alias("no", "line")).withColumn("form", F.when(_may_be_header(F.col("line")), _form(F.col("line"))))
    lines = lines.join(running, "form", "left").withColumn("header", F.coalesce("_runs", F.lit(False))).drop("form", "_runs")
    order = Window.partitionBy("_key").orderBy("no")
    empty = F.col("line") == ""
    last = F.last(F.when(~F.col("header") & ~empty, F.col("line")), True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    near = order.rowsBetween(-3, 3)
    paged = F.max(F.col("header")).over(near)
    goes_on = last.isNotNull() & ~last.rlike(r"[.!?:;…][\"'”’»)]*$")
    lines = lines.withColumn("_break", empty & ~(paged & goes_on))
    kept = lines.withColumn("_paragraph", F.sum(F.col("_break").cast("int")).over(order)).where(~F.col("header") & ~empty)
    within = Window.partitionBy("_key", "_paragraph").orderBy("no")
    broken = rf"(?U)({LETTER})(?:[-¬­]|Â[­¬]|┬[¡¬])$"
    glued = F.col("line").rlike(broken) & F.lead("line").over(within).rlike(rf"(?U)^{LETTER}")
    kept = kept.withColumn("_piece", F.when(glued, F.regexp_replace("line", broken, "$1")).when(F.lead("line").over(within).isNull(), F.col("line")).otherwise(F.concat("line", F.lit(" "))))
    paragraphs = kept.groupBy("_key", "_paragraph").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "_piece"))), lambda x: x["_piece"]), "").alias("p"))
    flowing = paragraphs.groupBy("_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_paragraph", "p"))), lambda x: x["p"]), "\n\n").alias("_flow"))
    # misread words, known from the whole corpus, are put right where they stand
    flowing = durable(flowing)
    texts = df.where(F.col(text).rlike(LETTER)).select(F.col(text).alias("_text"))
    every = texts.select(F.explode_outer(_words(F.col("_text"))).alias("word")).where(F.col("word").isNotNull())
    right = corrections(flowing, texts, durable(word_counts(every))).groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("at", "right"))).alias("_right"))
    tokens = F.regexp_extract_all("_flow", F.lit(r"([\p{L}\p{M}0-9@*~]+|[^\p{L}\p{M}0-9@*~]+)"), F.lit(1))
    # words and what parts them take turns
    odd = F.when(F.col("_flow").rlike(r"^[\p{L}\p{M}0-9@*~]"), 0).otherwise(1)

    def put(token: Column, i: Column) -> Column:
        best = F.element_at("_right", F.floor((i - odd) / 2).cast("int"))
        shaped = F.when(token.rlike(r"^\p{Lu}\p{Lu}"), F.upper(best)).when(token.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(best, 1, 1)), F.substring(best, 2, 1_000_000))).otherwise(best)
        return F.when((i - odd) % 2 == 0, F.coalesce(shaped, token)).otherwise(token)

    done = flowing.join(right, "_key", "left")
    return done.select(F.col("_key").alias(key), F.when(F.col("_right").isNull(), F.col("_flow")).otherwise(F.array_join(F.transform(tokens, put), "")).alias("repaired"))
