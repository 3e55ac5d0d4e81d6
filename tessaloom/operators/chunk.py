"""Cleaned documents cut into chunks for embedding, with the attributes of their country."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tessaloom.functions.text import strip
from tessaloom.session import small_side

MOST, LEAST = 1500, 50
METADATA = ("Date", "Year", "Title", "Country", "Forum", "Submission_Type", "Actor_Type", "Attribution", "Session", "Cluster")
GROUPS = ("p5", "de_facto_nuclear", "nato", "nam", "nac", "tpnw_parties", "att_parties", "major_exporters", "major_importers", "gulf_states", "eu", "brics")


def _packed(parts: Column, most: int) -> Column:
    """Parts joined by a blank, as many as fit; a part that doesn't fit begins the next."""
    start = F.struct(F.array().cast("array<string>").alias("c"), F.lit("").alias("b"))

    def step(a: Column, s: Column) -> Column:
        full = (a["b"] != "") & (F.length(a["b"]) + F.length(s) + 1 > most)
        return F.when(full, F.struct(F.concat(a["c"], F.array(strip(a["b"]))).alias("c"), s.alias("b"))).otherwise(F.struct(a["c"].alias("c"), F.when(a["b"] != "", strip(F.concat(a["b"], F.lit(" "), s))).otherwise(s).alias("b")))

    return F.aggregate(parts, start, step, lambda a: F.when(strip(a["b"]) != "", F.concat(a["c"], F.array(strip(a["b"])))).otherwise(a["c"]))


def sentence_chunks(text: Column, most: int = MOST, least: int = LEAST) -> Column:
    """Sentences packed; packs still too long are cut at commas and packed again; chunks under the least are dropped. One sentence stays whole."""
    sentences = F.split(text, r"(?U)(?<=[.!?])[\s\x1c-\x1f]+", -1)
    packed = F.flatten(F.transform(_packed(sentences, most), lambda c: F.when(F.length(c) <= most, F.array(c)).otherwise(_packed(F.split(c, r"(?U)(?<=[,;])[\s\x1c-\x1f]+", -1), most))))
    return F.when(F.size(sentences) <= 1, F.filter(F.array(text), lambda c: F.length(c) >= least)).otherwise(F.filter(packed, lambda c: F.length(c) >= least))


def chunked(df: DataFrame, text: str, into: str = "chunks", most: int = MOST, least: int = LEAST) -> DataFrame:
    """df with array<struct<chunk_text, split_method>>; blank texts give an empty array, null texts too.

    Short texts are one chunk, of any length. Else paragraphs of the least
    length, if more than one; too long ones by sentences. Else sentences, if
    they give more than one chunk. Else the whole text, even over the limit.
    """
    as_chunks = lambda a, method: F.transform(a, lambda c: F.struct(c.alias("chunk_text"), F.lit(method).alias("split_method")))
    rows = df.withColumn("_t", strip(F.coalesce(F.col(text), F.lit("")))).withColumn("_long", F.length("_t") > most)
    paragraphs = F.filter(F.transform(F.split("_t", "\n\n", -1), strip), lambda p: F.length(p) >= least)
    rows = rows.withColumn("_p", F.when(F.col("_long") & F.contains("_t", F.lit("\n\n")), paragraphs).otherwise(F.array().cast("array<string>"))).withColumn("_many", F.size("_p") > 1)
    rows = rows.withColumn("_pc", F.when(F.col("_many"), F.flatten(F.transform("_p", lambda p: F.when(F.length(p) > most, sentence_chunks(p, most, least)).otherwise(F.array(p))))))
    rows = rows.withColumn("_sc", F.when(F.col("_long") & ~F.col("_many"), sentence_chunks(F.col("_t"), most, least)))
    whole = as_chunks(F.array("_t"), "no_split")
    made = F.when(F.col("_t") == "", F.slice(whole, 1, 0)).when(~F.col("_long"), whole).when(F.size("_pc") > 0, as_chunks(F.col("_pc"), "paragraph")).when(F.size("_sc") > 1, as_chunks(F.col("_sc"), "sentence")).otherwise(whole)
    return rows.select(*df.columns, F.inline_outer(F.array(F.struct(made.alias(into)))))


@F.pandas_udf(StringType())
def _ascii(names):  # type: ignore[no-untyped-def]
    return names.map(lambda n: None if n is None else unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode())


def country_key(name: Column) -> Column:
    return F.replace(F.lower(strip(name)), F.lit("�"), F.lit(""))


def country_dimension(reference: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, iso3, groups...): names and, where no name has the key, aliases. Aliases give no groups of their own: those of their entry."""
    names = reference.select(country_key(F.col("name")).alias("key"), "iso3", *GROUPS)
    more = aliases.select(country_key(F.col("alias")).alias("key"), "iso3").join(names.select("key"), "key", "left_anti").dropDuplicates(["key"])
    return names.unionByName(more.join(reference.select("iso3", *GROUPS), "iso3"))


def resolved(df: DataFrame, column: str, dimension: DataFrame) -> DataFrame:
    """df with country_iso3 and the groups; null or blank names give null and false.

    A name is looked up by its key, else by its key in ASCII. Groups come only
    from the first lookup, so names found through ASCII alone have none. Only
    distinct names go through Python, and a hot name costs no more than others.
    """
    keyed = df.withColumn("_key", country_key(F.col(column)))
    distinct = keyed.where("_key <> ''").select("_key").distinct().withColumn("_plain", strip(_ascii(F.col("_key"))))
    dim = small_side(dimension)
    by_key = dim.withColumnRenamed("key", "_key").withColumnRenamed("iso3", "_iso3")
    by_plain = dim.select(F.col("key").alias("_plain"), F.col("iso3").alias("_iso3_plain"))
    looked = distinct.join(by_key, "_key", "left").join(by_plain, "_plain", "left").select("_key", F.coalesce("_iso3", "_iso3_plain").alias("country_iso3"), *GROUPS)
    return keyed.join(small_side(looked), "_key", "left").drop("_key").na.fill(False, list(GROUPS))


def chunk_table(df: DataFrame, text: str, dimension: DataFrame, row_key: str = "row_idx") -> DataFrame:
    """One row a chunk of the rows that are flagged cleaned and have a text, with id, attributes and country.

    chunk_id is {doc_id}_r{row_key}_chunk{number of three digits or more}.
    Metadata columns that are missing come out null.
    """
    rows = df.where((F.col("Flag_Cleaned") == "cleaned") & F.col(text).isNotNull() & (F.length(strip(F.col(text))) > 0))
    carried = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in METADATA]
    cut = chunked(rows, text, "_chunks").select("doc_id", row_key, *carried, F.size("_chunks").alias("chunk_total"), F.posexplode("_chunks").alias("chunk_index", "_chunk"))
    ids = cut.select(F.format_string("%s_r%d_chunk%03d", F.col("doc_id").cast("string"), row_key, "chunk_index").alias("chunk_id"), "doc_id", row_key, "chunk_index", "chunk_total", F.col("_chunk.chunk_text").alias("chunk_text"), F.col("_chunk.split_method").alias("split_method"), *METADATA)
    return resolved(ids, "Country", dimension)


def method_shares(chunks: DataFrame) -> DataFrame:
    per = chunks.groupBy("split_method").agg(F.count(F.lit(1)).alias("chunks"))
    return per.select("split_method", "chunks", F.round(100 * F.col("chunks") / F.sum("chunks").over(Window.partitionBy()), 2).alias("percent"))  # a row for each method


def coverage(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("country_iso3").alias("resolved"), F.count(F.lit(1)).alias("chunks"), F.round(100 * F.count("country_iso3") / F.count(F.lit(1)), 2).alias("percent"))


def group_counts(chunks: DataFrame) -> DataFrame:
    one = chunks.agg(F.array(*(F.struct(F.lit(g).alias("country_group"), F.count_if(g).alias("chunks")) for g in GROUPS)).alias("g"), F.count(F.lit(1)).alias("n"))
    return one.select("n", F.inline("g")).select("country_group", "chunks", F.when(F.col("n") > 0, F.round(100 * F.col("chunks") / F.col("n"), 2)).otherwise(0.0).alias("percent"))


def unmapped(chunks: DataFrame, most: int = 10, row_key: str = "row_idx") -> DataFrame:
    """(name, documents): the most frequent names without an entry, once for each document with a chunk."""
    once = chunks.where((F.col("chunk_index") == 0) & F.col("country_iso3").isNull()).select(strip(F.col("Country")).alias("name")).where("name <> ''")
    return once.groupBy("name").agg(F.count(F.lit(1)).alias("documents")).orderBy(F.desc("documents"), "name").limit(most)


def per_document(documents: DataFrame, chunks: DataFrame, row_key: str = "row_idx") -> DataFrame:
    """Documents put in, those without a chunk, chunks, and chunks for each document put in."""
    put = documents.agg(F.count(F.lit(1)).alias("documents"))
    out = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("chunk_index") == 0).alias("with_chunks"))
    return put.crossJoin(out).select("documents", (F.col("documents") - F.col("with_chunks")).alias("skipped"), "chunks", F.round(F.col("chunks") / F.greatest("documents", F.lit(1)), 2).alias("chunks_per_document"))  # one row each
