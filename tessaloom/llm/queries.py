"""Queries of the problems on training text and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaloom.llm import canonical, encoding, look, mixing, packing, prose, residue, scans, site_lines, split, tokens
from tessaloom import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.spread(session.table(spark, sf_dir, name))


GATE, CLEANED = "gate_mwe", "lawsec_v1_18i_cluster_cleaned"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, aliases = table(spark, sf_dir, "country_reference"), table(spark, sf_dir, "country_aliases")
    return reference.select("name").unionByName(aliases.select(F.col("alias").alias("name")))


def _garbled_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.garbled_rows(table(spark, sf_dir, CLEANED), "row_idx", "Country", _names(spark, sf_dir))


def p1_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of every text, its share of the words common in the corpus, and whether the rules take it for prose."""
    rows = table(spark, sf_dir, GATE).select("row_idx", "Text")
    common = prose.common_words(rows)
    return prose.figures(rows).withColumns({"common_share": prose.common_share(F.col("Text"), common), "is_prose": prose.is_prose()}).drop("Text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prose.not_prose(table(spark, sf_dir, GATE))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = encoding.garbled_rows(table(spark, sf_dir, GATE), "row_idx", "Text")
    return texts.select(F.lit(GATE).alias("table_name"), "row_idx").unionByName(_garbled_countries(spark, sf_dir).select(F.lit(CLEANED).alias("table_name"), "row_idx"))


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = encoding.restored_texts(table(spark, sf_dir, GATE), "row_idx", "Text").withColumnRenamed("Text", "garbled")
    countries = encoding.restored_texts(table(spark, sf_dir, CLEANED), "row_idx", "Country", _names(spark, sf_dir)).withColumnRenamed("Country", "garbled")
    return texts.withColumn("table_name", F.lit(GATE)).unionByName(countries.withColumn("table_name", F.lit(CLEANED)))


def _speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and text of the rows that p1_found doesn't have."""
    rows = table(spark, sf_dir, GATE).select("row_idx", "Text").where(F.col("Text").rlike(r"(?U)[^\s\x1c-\x1f]"))
    return prose.figures(rows, only=prose.needed_figures()).where(prose.is_prose()).select("row_idx", "Text")


def p3_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.noisy_rows(_speeches(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_noise(spark, sf_dir).select("row_idx")


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired_rows(_speeches(spark, sf_dir))


def p4_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every free-typed Country with the entry meant, how it was found and how similar it is."""
    names = session.table(spark, sf_dir, "country_reference").select("name", F.col("iso3").alias("entry"))
    others = session.table(spark, sf_dir, "country_aliases").select(F.col("alias").alias("name"), F.col("iso3").alias("entry"))
    codes = names.select(F.col("entry").alias("name"), "entry")
    return canonical.canonical_rows(session.table(spark, sf_dir, CLEANED), "row_idx", "Country", names, others, codes)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_mapped(spark, sf_dir).select("row_idx", F.col("entry").alias("iso3"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.occurrences(table(spark, sf_dir, GATE))


def p5_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.without_excessive_lines(table(spark, sf_dir, GATE), date="Date").select("row_idx", "text_kept")


def p5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The excessive lines with their documents, clusters of documents and publication dates."""
    return site_lines.line_counts(table(spark, sf_dir, GATE))


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every chunk over the limit of its profile."""
    chunks = table(spark, sf_dir, "lawsec_v1_18i_chunked").select("chunk_id", "Text_cleaned_ngram", "split_profile")
    limited = chunks.join(session.table(spark, sf_dir, "chunk_profiles"), "split_profile")
    return split.split_oversized(limited, "chunk_id", "Text_cleaned_ngram", "max_chars", "overlap_chars")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_pieces(spark, sf_dir).where("piece_no = 0").select("chunk_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    unusual = look.unusual_rows(table(spark, sf_dir, CLEANED), "row_idx", "Country").select("row_idx")
    return unusual.join(_garbled_countries(spark, sf_dir).select("row_idx"), "row_idx", "left_anti")


def p7_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look.in_one_form(table(spark, sf_dir, CLEANED).select("row_idx", "Country"), "Country")


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in containers of every kind."""
    sizes = tokens.sized(table(spark, sf_dir, "documents"), ["doc_id"])
    return packing.pack_all(spark, sizes, "doc_id", session.table(spark, sf_dir, "pack_containers"))


def p8_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    capacities = session.table(spark, sf_dir, "pack_containers")
    filled = p8_packed(spark, sf_dir).where("container_no IS NOT NULL").groupBy("container", "container_no").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    return filled.join(capacities, "container").groupBy("container", "capacity_tokens").agg(F.count(F.lit(1)).alias("containers"), F.max("tokens").alias("fullest"), (F.sum("tokens") / (F.count(F.lit(1)) * F.col("capacity_tokens"))).alias("filled"))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.sized(table(spark, sf_dir, "documents"), ["doc_id", "source"])


def p9_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sources(spark, sf_dir), "doc_id", session.table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, targets = session.durable(_sources(spark, sf_dir)), session.table(spark, sf_dir, "mix_targets")
    sources = sizes.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("tokens"))
    return mixing.shares(mixing.mix(sizes, "doc_id", targets), mixing.schedules(targets, sources))


def p10_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = residue.residue_rows(table(spark, sf_dir, "documents"))
    return kinds.select("doc_id", F.array_join("kinds", ",").alias("kinds"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_residue(spark, sf_dir).select("doc_id")


def p10_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.without_residue(table(spark, sf_dir, "documents")).select("doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_figures, p2_found, p2_restored, p3_found, p3_noise, p3_repaired, p4_found, p4_mapped, p5_found, p5_lines, p5_kept, p6_found, p6_pieces, p7_found, p7_forms, p8_packed, p8_room, p9_mixed, p9_shares, p10_found, p10_residue, p10_kept)}


FORM = r"regexp_replace(lower(regexp_replace(regexp_replace({x}, '^[\s\v\x1c-\x1f\x85\p{{Z}}]+|[\s\v\x1c-\x1f\x85\p{{Z}}]+$', '', 'g'), '[\s\v\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')), '\p{{Nd}}+', '#', 'g')"
P5 = f"""
WITH lines AS (
  SELECT row_idx, doc_id, Forum, unnest(string_split(Text, chr(10))) AS line, generate_subscripts(string_split(Text, chr(10)), 1) AS line_no
  FROM gate_mwe WHERE Forum IS NOT NULL AND Text IS NOT NULL),
forms AS (SELECT row_idx, doc_id, Forum, line_no, {FORM.format(x="line")} AS form FROM lines),
long_forms AS (SELECT * FROM forms WHERE length(form) >= 12),
sizes AS (SELECT Forum, count(DISTINCT doc_id) AS n FROM gate_mwe WHERE Forum IS NOT NULL AND Text IS NOT NULL GROUP BY Forum),
excessive AS (
  SELECT f.Forum, form FROM long_forms f JOIN sizes s USING (Forum) GROUP BY f.Forum, form, s.n
  HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) * 50 >= s.n)
SELECT row_idx, CAST(line_no AS BIGINT) AS line_no FROM long_forms SEMI JOIN excessive USING (Forum, form)
"""


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5, "p6_found": "SELECT chunk_id FROM lawsec_v1_18i_chunked JOIN chunk_profiles USING (split_profile) WHERE length(Text_cleaned_ngram) > max_chars"}
