"""Problem 4: free-entered values mapped to a canonical list by a prefix-filtered set-similarity join."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaloom.llm import charsets, lookalike
from tessaloom.session import blank, durable, small_side

#: Least Jaccard similarity of the pairs of letters of two keys.
LEAST_SIMILARITY = 0.3
#: Edits allowed between two similar keys, relative to the longer one. Word by word two edits are allowed at any length.
MOST_EDITS = 1 / 3
#: Words around a name ("Delegation of ...", "..., Republic of") count as decoration if they stand around so many entries.
LEAST_ENTRIES = 3
NO_ENTRY = "NONE"
# Letters without a decomposition and their usual spelling.
LETTERS = str.maketrans({"ø": "o", "ł": "l", "ı": "i", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ß": "ss", "đ": "d", "ħ": "h"})
LOST = "?"


def fold(text: str) -> str:
    """Lower case without accents, words parted by one blank; runs of lost characters become one ?."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold().translate(LETTERS))
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(f"{charsets.LOST}+", LOST, text.replace(LOST, " "))
    return " ".join(re.sub(rf"[^\w{LOST}]|_", " ", text).split())


def _mended(value: str) -> str:
    whole = charsets.restored(value)
    return whole if whole is not None else re.sub(r"\S*[^\x00-\x7f]\S*", lambda m: charsets.restored(m.group()) or m.group(), value)


def keys(value: str) -> list[str]:
    """The keys under which a value is looked up: of its usual form, mended, and of its Latin reading."""
    seen = lookalike.usual_form(_mended(value))
    found = [fold(seen), fold(lookalike.latin_reading(seen) or "")]
    return [k for k in dict.fromkeys(found) if k]


def _value_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(v, k) for v in batch["value"].to_pylist() for k in keys(v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["value", "key"])


def _windows(longest: int):  # type: ignore[no-untyped-def]
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key in batch["key"].to_pylist():
                words = key.split(" ")
                out += [(key, " ".join(words[:i]), " ".join(words[i:j]), " ".join(words[j:])) for i in range(len(words)) for j in range(i + 1, min(len(words), i + longest) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(4)], ["key", "before", "core", "after"])

    return write


def pairs_of_letters(key: str) -> list[str]:
    """The pairs of neighbouring letters of a key, its ends included; the n-th of equal pairs is its own token."""
    ended, seen, out = f"^{key}$", {}, []
    for pair in map("".join, zip(ended, ended[1:])):
        seen[pair] = seen.get(pair, 0) + 1
        out.append(f"{pair}{seen[pair]}")
    return out


def _write_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = [pairs_of_letters(k) for k in batch["key"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["key"], batch["is_left"], pa.array(tokens, pa.list_(pa.string()))], ["key", "is_left", "t"])


def similar(left: DataFrame, right: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(key, entry_key, similarity) of all pairs of distinct keys of the two sides with at least this Jaccard similarity.

    Tokens are ordered by their rarity over both sides. Only the prefixes that
    two similar keys must share a token of are joined; lengths and positions
    are checked next and the Jaccard similarity is verified exactly.
    """
    both = left.select("key", F.lit(True).alias("is_left")).unionByName(right.select(F.col("entry_key").alias("key"), F.lit(False).alias("is_left"))).distinct()
    token = durable(both.mapInArrow(_write_tokens, "key string, is_left boolean, t array<string>")).select("key", "is_left", F.explode_outer("t").alias("token"))
    rarity = token.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    ordered = token.join(rarity, "token").groupBy("key", "is_left").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("t")).select("key", "is_left", F.col("t.token").alias("tokens"), F.size("t").alias("n"))
    ordered = durable(ordered)
    prefix = ordered.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1)).alias("at", "token"))
    a = prefix.where("is_left").select("key", F.col("n").alias("n"), F.col("at"), "token")
    b = prefix.where("NOT is_left").select(F.col("key").alias("entry_key"), F.col("n").alias("m"), F.col("at").alias("entry_at"), "token")
    needed = F.ceil((F.col("n") + F.col("m")) * (least / (1 + least)) - 1e-9)
    near = a.join(b, "token").where((F.col("m") >= least * F.col("n")) & (F.col("n") >= least * F.col("m")) & (F.least(F.col("n") - F.col("at"), F.col("m") - F.col("entry_at")) >= needed))
    pairs = near.select("key", "entry_key").distinct()
    sides = [ordered.where("is_left").select("key", F.col("tokens").alias("x")), ordered.where("NOT is_left").select(F.col("key").alias("entry_key"), F.col("tokens").alias("y"))]
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(sides[0], "key").join(sides[1], "entry_key").select("key", "entry_key", (common / (F.size("x") + F.size("y") - common)).alias("similarity")).where(F.col("similarity") >= least)


def _word_by_word(a: Column, b: Column) -> Column:
    """Whether each word of two keys of as many words is near its fellow or an abbreviation of it."""
    x, y = F.split(a, " "), F.split(b, " ")
    near = F.zip_with(x, y, lambda p, q: q.startswith(p) | (F.levenshtein(p, q) <= F.greatest(F.lit(2), F.greatest(F.length(p), F.length(q)) * MOST_EDITS + 1e-9)))
    return (F.size(x) != F.size(y)) | F.forall(near, lambda ok: ok)


def map_values(values: DataFrame, entries: DataFrame, least: float = LEAST_SIMILARITY, least_entries: int = LEAST_ENTRIES) -> DataFrame:
    """(value, entry, how, similarity) for the distinct non-blank values of a column `value`.

    entries: (name, entry, is_code, is_name): the names of each entry; codes count only
    where they stand alone in capitals, or after a name of the same entry.
    how is exact, code, decorated, similar, ambiguous or none; entry is NONE for
    the last two. A key that several entries share is that of the one that has it as
    its name; if none or several have, what matches it is ambiguous.
    Similar keys must also be within MOST_EDITS edits of each other.
    Of several candidates the exact one is taken, then the one with the
    longest name, then the most similar, then the one of fewest edits, then the
    first in order, so the result doesn't depend on the order of rows.
    """
    values = durable(values.select("value").distinct().mapInArrow(_value_keys, "value string, key string"))
    named = entries.where(~F.col("is_code")).select(F.col("name").alias("value"), "entry", (~F.col("is_name")).alias("other")).distinct()
    of_key = named.join(named.select("value").distinct().mapInArrow(_value_keys, "value string, key string"), "value").groupBy(F.col("key").alias("entry_key"), "other").agg(F.min("entry").alias("least"), F.max("entry").alias("most"))
    first = of_key.groupBy("entry_key").agg(F.min(F.struct("other", "least", "most")).alias("f"))
    known = durable(first.select("entry_key", F.when(F.col("f.least") == F.col("f.most"), F.col("f.least")).otherwise(NO_ENTRY).alias("entry")))
    codes = entries.where("is_code").select(F.col("name").alias("code"), "entry")
    exact = values.join(known, values["key"] == known["entry_key"]).select("value", "key", "entry", F.lit("exact").alias("how"), F.lit(4).alias("rank"), F.length("key").alias("size"), F.lit(1.0).alias("similarity"), F.lit(0).alias("edits"))
    coded = values.join(codes, F.trim(F.col("value")) == codes["code"]).select("value", "key", "entry", F.lit("code").alias("how"), F.lit(3).alias("rank"), F.length("key").alias("size"), F.lit(1.0).alias("similarity"), F.lit(0).alias("edits"))
    done = durable(exact.unionByName(coded))
    left = values.join(done.select("value").distinct(), "value", "left_anti")
    # names inside values, and the words that stand around many of them
    longest = 1 + (known.agg(F.max(F.size(F.split("entry_key", " ")))).first()[0] or 1)
    windows = durable(left.select("key").distinct().mapInArrow(_windows(longest), "key string, before string, core string, after string"))
    inside = windows.join(known, windows["core"] == known["entry_key"]).select("key", "before", "core", "after", "entry")
    around = durable(inside.groupBy("before", "after").agg(F.count_distinct("entry").alias("entries")).where(F.col("entries") >= least_entries).select("before", "after"))
    own_code = inside.join(codes, "entry").where((F.col("before") == "") & (F.col("after") == F.lower("code"))).select("key", "core", "entry")
    decorated = inside.join(around, ["before", "after"], "left_semi").select("key", "core", "entry").unionByName(own_code)
    decorated = left.join(decorated, "key").select("value", "key", "entry", F.lit("decorated").alias("how"), F.lit(2).alias("rank"), F.length("core").alias("size"), F.lit(1.0).alias("similarity"), F.lit(0).alias("edits"))
    decorated = durable(decorated)
    rest = left.join(decorated.select("value").distinct(), "value", "left_anti")
    # the rest by similarity, whole and without decoration
    cores = rest.join(windows.join(around, ["before", "after"], "left_semi").select("key", "core"), "key").select("value", F.col("core").alias("key"))
    tried = durable(rest.unionByName(cores).distinct())
    alike = tried.join(similar(tried.select("key").distinct(), known.select("entry_key"), least), "key").join(known, "entry_key")
    alike = alike.select("value", "key", "entry", F.lit("similar").alias("how"), F.lit(1).alias("rank"), F.lit(0).alias("size"), "similarity", F.levenshtein("key", "entry_key").alias("edits"), F.greatest(F.length("key"), F.length("entry_key")).alias("longer"))
    alike = alike.where((F.col("edits") <= F.col("longer") * MOST_EDITS + 1e-9) & _word_by_word(F.col("key"), F.col("entry_key"))).drop("longer")
    candidates = done.unionByName(decorated).unionByName(alike)
    best = candidates.groupBy("value").agg(F.min(F.struct(-F.col("rank"), -F.col("size"), -F.col("similarity"), "edits", "entry", "how", "similarity")).alias("b"))
    mapped = best.select("value", F.col("b.entry").alias("entry"), F.when(F.col("b.entry") == NO_ENTRY, "ambiguous").otherwise(F.col("b.how")).alias("how"), F.col("b.similarity").alias("similarity"))
    mapped = durable(mapped)
    none = values.select("value").distinct().join(mapped, "value", "left_anti").select("value", F.lit(NO_ENTRY).alias("entry"), F.lit("none").alias("how"), F.lit(None).cast("double").alias("similarity"))
    return mapped.unionByName(none)


def canonical_rows(df: DataFrame, key: str, column: str, names: DataFrame, others: DataFrame, codes: DataFrame) -> DataFrame:
    """(key, value, entry, how, similarity) of the rows whose value isn't exactly, character for character, a name.

    names, others and codes: (name, entry). Null and blank values come out in
    no row; values of signs only are NONE. Only distinct values are compared,
    so a value that a third of the rows share costs as much as any other; rows
    are joined by value with the mapping, broadcast if it is small and else by
    a shuffle in which hot values are split.
    """
    kind = lambda df, code, name: df.withColumns({"is_code": F.lit(code), "is_name": F.lit(name)})
    entries = durable(kind(names, False, True).unionByName(kind(others, False, False)).unionByName(kind(codes, True, False)))
    rows = df.where(~blank(column)).select(F.col(key), F.col(column).alias("value")).join(small_side(names.select(F.col("name").alias("value"))), "value", "left_anti")
    distinct = durable(rows.select("value").distinct())
    mapped = map_values(distinct, entries)
    whole = distinct.join(mapped, "value", "left").select("value", F.coalesce("entry", F.lit(NO_ENTRY)).alias("entry"), F.coalesce("how", F.lit("none")).alias("how"), "similarity")
    return rows.join(small_side(whole), "value").select(key, "value", "entry", "how", "similarity")
