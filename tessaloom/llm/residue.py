"""Problem 10: template residue, filler text and messages of the publishing system.

No wording is listed. Records are aligned with one another: fragments of a text
as a wrapper around a name, lines of a form as a label before a value, and pages
by the word pairs that stand on pages of one template and hardly anywhere else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaloom.llm.prose import _let
from tessaloom.session import durable, small_side

#: A name is a slot's variable if it fills the slot of so many wrappers, a wrapper is a slot's if so many names fill it.
LEAST_WRAPPERS, LEAST_NAMES = 3, 3
#: Templates of pages are learned from texts of up to so many characters. They are then found in texts of any length.
PAGE_CHARS = 600
#: A word pair is fixed in a template if it stands on pages of so many titles, and in at least this share of its records on such a page.
LEAST_TITLES, LEAST_SHARE = 3, 0.5
#: A segment of so many pairs or more is of a template if this share of them is fixed; of filler if this share of its words is.
LEAST_PAIRS, SEGMENT_SHARE, FILLER_SHARE = 3, 0.6, 0.8
#: A text of so many tokens or more repeats itself if blocks of so many tokens have no more than this share of different ones.
LEAST_TOKENS, BLOCK, MOST_DIFFERENT = 12, 40, 0.55
#: A label is one of a form if so many records leave it blank; what follows so many such labels is a default.
LEAST_BLANKS, LEAST_LABELS = 2, 3
SLOT = "□"
#: Delimiters that no language but a template's uses, around an identifier: a slot even if it stands alone.
TEMPLATE_SYNTAX = r"\{\{\s*[\p{L}_][\p{L}\p{N}_.]*\s*\}\}|<%=?\s*[\p{L}_][\p{L}\p{N}_.]*\s*%>|[$#]\{[\p{L}_][\p{L}\p{N}_.]*\}|\{%\s*[\p{L}_][\p{L}\p{N}_.]*\s*%\}|%%[\p{L}_][\p{L}\p{N}_.]*%%|@@[\p{L}_][\p{L}\p{N}_.]*@@"
FRAGMENT = rf"({TEMPLATE_SYNTAX}|\{{[^{{}}\n]{{1,60}}\}}\}}?|\[\[?[^\[\]\n]{{1,60}}\]\]?|<<?[^<>\n]{{1,60}}>>?|%%[\p{{L}}_.]{{1,40}}%%|@@[\p{{L}}_.]{{1,40}}@@|\([^()\n]{{1,60}}\)|\bXX [\p{{L}} _.]{{1,40}} XX\b)"
#: A line of a form that is short and ends in signs that hold the place of a value: its label, and the signs.
BLANK_LINE = r"(?U)^\s*([^\n;_?…\[\]]{0,60}?[\p{L}.]?)\s*:?\s*(_{4,}|_{2,}(?:/_{2,})+|\[\s*\]|\.{6,}|…{2,}|\?{4,})\s*[.;]?\s*$"
FORM_LINE = r"(?U)^\s*(\p{L}[^\n;:]{0,60}?)\s*:?\s+(\S{1,20}?)\s*[.;]?\s*$"


def segments(text: Column) -> Column:
    """Sentences and lines, outer white space off, empty ones left out."""
    parts = F.split(text, r"(?<=[.!?…])\s+|\n")
    return F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))), lambda x: x != "")


def token_segments(text: Column) -> Column:
    """array<array<string>>: the lower-case words of each segment, a number as #; segments without a word left out."""
    plain = F.regexp_replace(F.lower(text), r"\p{N}+", " # ")
    tokens = F.transform(F.split(plain, r"(?<=[.!?…])\s+|\n"), lambda s: F.filter(F.split(s, r"[^\p{L}\p{M}#'’]+"), lambda w: w != ""))
    return F.filter(tokens, lambda s: F.size(s) > 0)


def _pairs(segment: Column) -> Column:
    """The hashes of a segment's neighbouring words, its ends included."""
    return F.transform(F.concat(F.array(F.lit("^")), segment), lambda w, i: F.xxhash64(w, F.coalesce(F.get(segment, i), F.lit("$"))))


def _words(segment: Column) -> Column:
    return F.transform(segment, lambda w: F.xxhash64(F.lit("word"), w))


def repeats_itself(text: Column) -> Column:
    """0 to 2: whether blocks of a text's tokens have few different ones, and whether whole segments recur besides. Numbers count as they are, so tables of figures don't."""
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}'’]+"), lambda w: w != "")

    def of(t: Column) -> Column:
        different = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1)), F.lit(BLOCK)), F.lit(0), lambda acc, i: acc + F.size(F.array_distinct(F.slice(t, i, F.lit(BLOCK)))))
        return (F.size(t) >= LEAST_TOKENS) & (different <= MOST_DIFFERENT * F.greatest(F.size(t), F.lit(1)))

    again = _let(segments(text), lambda s: F.size(F.array_distinct(s)) * 2 <= F.size(s))
    return F.when(~_let(tokens, of), 0).when(again, 2).otherwise(1)


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every way to read a fragment as a wrapper around one or two words."""
    for batch in batches:
        out = []
        for fragment in batch["fragment"].to_pylist():
            masked = re.sub(r"\d+", "#", fragment)
            words = [m.span() for m in re.finditer(r"[^\W\d]+(?:\.[^\W\d]+)*", masked)]
            for i in range(len(words)):
                for j in (i, i + 1):
                    if j < len(words) and masked[words[i][1] : words[j][0]] in ("", " ") or i == j:
                        start, end = words[i][0], words[j][1]
                        out.append((fragment, masked[:start] + SLOT + masked[end:], masked[start:end]))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in range(3)], ["fragment", "wrapper", "name"])


def slots(fragments: DataFrame) -> DataFrame:
    """(fragment) of the distinct fragments that are slots still holding a variable's name.

    Fragments are aligned as wrapper and name. Names that fill several
    wrappers and wrappers that take several such names confirm each other. In
    the delimiters of a template language an identifier needs no confirmation.
    """
    distinct = durable(fragments.select("fragment").distinct())
    named = distinct.where(~F.col("fragment").rlike(r"\p{N}[^\n]*/|/[^\n]*\p{N}"))  # references to documents are no slots
    pairs = durable(named.mapInArrow(_fill, "fragment string, wrapper string, name string"))
    names = pairs.groupBy("name").agg(F.count_distinct("wrapper").alias("n")).where(F.col("n") >= LEAST_WRAPPERS).select("name")
    confirmed = durable(pairs.join(names, "name", "left_semi"))
    wrappers = confirmed.groupBy("wrapper").agg(F.count_distinct("name").alias("n")).where(F.col("n") >= LEAST_NAMES).select("wrapper")
    return confirmed.join(wrappers, "wrapper", "left_semi").select("fragment").unionByName(distinct.where(F.col("fragment").rlike(TEMPLATE_SYNTAX))).distinct()


def blank_fields(rows: DataFrame) -> DataFrame:
    """(_key) of the records of (_key, _text) with a form's line left blank or holding a default.

    Lines are aligned as label and value. A value of signs only is blank. A
    word is a default if it stands after several labels that other records
    leave blank.
    """
    may = rows.where(F.col("_text").rlike(r"_{2}|\[\s*\]|\.{6}|…{2}|\?{4}"))
    lines = may.select("_key", F.explode_outer(F.split(F.translate("_text", ";", "\n"), "\n")).alias("line")).where(F.col("line").rlike(BLANK_LINE))
    blank = durable(lines.select("_key", F.lower(F.regexp_extract("line", BLANK_LINE, 1)).alias("label")))
    labels = small_side(blank.where("label <> ''").groupBy("label").agg(F.count_distinct("_key").alias("n")).where(F.col("n") >= LEAST_BLANKS).select("label"))
    # a label stands at the head of a line, so lines of other first words aren't read
    heads = small_side(labels.select(F.regexp_extract("label", r"^\S+", 0).alias("head")).distinct())
    short = rows.select("_key", F.explode_outer(F.filter(F.split(F.translate("_text", ";", "\n"), "\n"), lambda x: F.length(x) <= 90)).alias("line")).where(F.col("line").isNotNull())
    short = short.withColumn("head", F.lower(F.regexp_extract(F.trim("line"), r"^[^\s:]+", 0))).join(heads, "head", "left_semi")
    filled = short.select("_key", F.lower(F.regexp_extract("line", FORM_LINE, 1)).alias("label"), F.regexp_extract("line", FORM_LINE, 2).alias("value")).where("value <> ''").join(labels, "label", "left_semi")
    filled = durable(filled)
    defaults = small_side(filled.groupBy("value").agg(F.count_distinct("label").alias("n")).where(F.col("n") >= LEAST_LABELS).select("value"))
    return blank.select("_key").unionByName(filled.join(defaults, "value", "left_semi").select("_key")).distinct()


def template_rows(rows: DataFrame) -> DataFrame:
    """(_key, kind) of the records of (_key, _title, _text) that hold a segment of a page template (page) or of filler (filler).

    Short texts are read as pages. Texts that repeat their words are read as
    filler, and are filler if they repeat whole segments.
    A word pair is fixed in a template if it stands on pages under several
    titles, and in most of its records on a page: pairs of ordinary sentences
    stand in longer texts too, and copies of a document have one title. What
    varies between the fixed pairs are slots. Words of filler are found alike.
    A segment whose pairs are mostly fixed, or whose words are mostly those of
    filler, is residue wherever it stands, in texts of any length.
    """
    page, filler = F.length("_text") <= PAGE_CHARS, repeats_itself(F.col("_text"))
    seeds = durable(rows.select("*", page.alias("_page"), F.explode_outer(F.array(filler)).alias("_repeats")).withColumn("_filler", F.col("_repeats") > 0).where("_page OR _filler"))
    found_filler = seeds.where("_repeats = 2").select("_key", F.lit("filler").alias("kind")).distinct()
    each = F.flatten(F.transform("s", lambda x: F.concat(F.when(F.col("_page"), _pairs(x)).otherwise(F.array().cast("array<bigint>")), F.when(F.col("_filler"), _words(x)).otherwise(F.array().cast("array<bigint>")))))
    seen = seeds.select("_title", "_page", "_filler", token_segments(F.col("_text")).alias("s")).select("_title", F.explode_outer(F.array_distinct(each)).alias("h")).where(F.col("h").isNotNull())
    known = seen.groupBy("h").agg(F.count_distinct("_title").alias("titles"), F.count(F.lit(1)).alias("here")).where(F.col("titles") >= LEAST_TITLES).select("h", "here")
    known = small_side(known)
    all_of = lambda s: F.array_distinct(F.flatten(F.transform(s, lambda x: F.concat(_pairs(x), _words(x)))))
    everywhere = rows.select(F.explode_outer(all_of(token_segments(F.col("_text")))).alias("h")).join(known, "h").groupBy("h", "here").agg(F.count(F.lit(1)).alias("n"))
    fixed = small_side(everywhere.where(F.col("here") > LEAST_SHARE * F.col("n")).select("h"))
    # of a segment with so large a share of fixed pairs or filler words one stands among its first, so only those are looked up; then whole segments of the records that are left
    most = lambda n, share: F.floor(n * (1 - share) + 1e-9).cast("int") + 1
    first = F.transform(token_segments(F.col("_text")), lambda x: F.concat(F.slice(_pairs(x), F.lit(1), most(F.size(x) + 1, SEGMENT_SHARE)), F.slice(_words(x), F.lit(1), most(F.size(x), FILLER_SHARE))))
    near = rows.select("_key", F.explode_outer(F.flatten(first)).alias("h")).join(fixed, "h", "left_semi").select("_key").distinct()
    cut = rows.join(small_side(near), "_key", "left_semi").select("_key", F.posexplode_outer(token_segments(F.col("_text"))).alias("no", "s")).where(F.col("s").isNotNull())
    of_both = F.concat(F.transform(_pairs(F.col("s")), lambda h: F.struct(h.alias("h"), F.lit(False).alias("word"))), F.transform(_words(F.col("s")), lambda h: F.struct(h.alias("h"), F.lit(True).alias("word"))))
    hits = cut.select("_key", "no", F.size("s").alias("n"), F.explode_outer(of_both).alias("x")).select("_key", "no", "n", "x.*").join(fixed, "h", "left_semi")
    per = hits.groupBy("_key", "no", "n").agg(F.count_if(~F.col("word")).alias("pairs"), F.count_if("word").alias("words"))
    kind = F.when((F.col("n") + 1 >= LEAST_PAIRS) & (F.col("pairs") >= SEGMENT_SHARE * (F.col("n") + 1)), "page").when((F.col("n") >= LEAST_PAIRS) & (F.col("words") >= FILLER_SHARE * F.col("n")), "filler")
    return found_filler.unionByName(per.select("_key", kind.alias("kind")).where("kind IS NOT NULL")).distinct()


def residue_rows(df: DataFrame, key: str = "doc_id", text: str = "text", title: str = "title") -> DataFrame:
    """(key, kinds) of the records whose text holds residue: field, filler, page or slot (array, in order).

    Null and blank texts have none; repeated rows come out each (key may
    repeat: rows of one key count as one record). A record without a title, or
    a table without the title's column, stands for itself: its text counts as
    its title, so copies never make a template.
    """
    named = F.xxhash64(F.col(title) if title in df.columns else F.lit(None).cast("string"), F.when((F.col(title) if title in df.columns else F.lit(None).cast("string")).isNull(), F.col(text)))
    rows = df.where(F.col(text).rlike(r"(?U)\S")).select(F.col(key).alias("_key"), F.col(text).alias("_text"), named.alias("_title"))
    fragments = rows.where(F.col("_text").rlike(FRAGMENT)).select("_key", F.explode_outer(F.array_distinct(F.regexp_extract_all("_text", F.lit(FRAGMENT), F.lit(1)))).alias("fragment")).where(F.col("fragment").isNotNull())
    fragments = durable(fragments)
    slotted = fragments.join(small_side(slots(fragments)), "fragment", "left_semi").select("_key", F.lit("slot").alias("kind"))
    blank = blank_fields(rows).select("_key", F.lit("field").alias("kind"))
    found = template_rows(rows).unionByName(slotted).unionByName(blank)
    return found.groupBy(F.col("_key").alias(key)).agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def without_residue(df: DataFrame, key: str = "doc_id", text: str = "text", title: str = "title") -> DataFrame:
    """The records that hold none, all columns kept."""
    return df.join(residue_rows(df, key, text, title).select(key), key, "left_anti")
