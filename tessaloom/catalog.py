"""The core's queries by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaloom import oracle
from tessaloom.functions import repair, text
from tessaloom.functions.rules import DEFAULT_RULES
from tessaloom.operators import chunk, clean, frequency, membership, phrases
from tessaloom.plans import pipeline
from tessaloom.session import spread, table
from tessaloom.sources import files

GATE, CLEANED, DOCUMENTS = "gate_mwe", "lawsec_v1_18i_cluster_cleaned", "documents"
RULES_BY_CATEGORY = {c: tuple((c, p) for p in patterns) for c, on, patterns in DEFAULT_RULES if on}
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, DOCUMENTS).select("doc_id", "text"))


def _injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what gives every rule work put around their texts."""
    t = F.col("text")
    made = F.when(F.col("doc_id") % 12 == 0, F.replace(t, F.lit(".\n"), F.lit(".\n\n")))
    for r, (before, after) in oracle.AROUND.items():
        made = made.when(F.col("doc_id") % 12 == r, F.concat(F.lit(before), t, F.lit(after)))
    return _documents(spark, sf_dir).select("doc_id", made.otherwise(t).alias("text"))


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, GATE))


@query
def word_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.top(frequency.word_counts(_documents(spark, sf_dir), "text"), 100)


@query
def ngram4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.top(frequency.ngram_counts(_documents(spark, sf_dir), 4, text="text").select("phrase", "frequency"), 50)


@query
def ngram_multi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.report(frequency.ngram_counts(_documents(spark, sf_dir), 4, 10, "text"), 20)


@query
def frequency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = frequency.word_counts(_gate(spark, sf_dir)).withColumn("n", F.lit(1))
    return frequency.report(words, 500)


@query
def ngram_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.distinct_ngrams(_documents(spark, sf_dir), 4, "text")


@query
def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.sample(_documents(spark, sf_dir).select("doc_id"), "doc_id", 100)


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, GATE).agg(F.count(F.lit(1)).alias("rows"), F.count("Text").alias("texts"))


@query
def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.schema_of(table(spark, sf_dir, GATE))


@query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, DOCUMENTS).select("doc_id", text.preview(F.col("text"), 300).alias("preview"))


def _fourgrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.ngram_counts(_documents(spark, sf_dir), 4, text="text")


@query
def classify_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("phrase")
    tests = {"formatting": phrases.is_formatting(p), **{k: phrases.has_keyword(p, k) for k in phrases.KEYWORDS}, "metadata": phrases.is_metadata(p)}
    return _fourgrams(spark, sf_dir).select("phrase", *(t.alias(k) for k, t in tests.items()))


@query
def categorize_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.extract(_fourgrams(spark, sf_dir), 5)


@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.category_counts(phrases.extract(_fourgrams(spark, sf_dir), 5))


@query
def removal_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.removal_list(phrases.extract(_fourgrams(spark, sf_dir), 5), least=10)


@query
def phrase_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.dictionary(phrases.extract(_fourgrams(spark, sf_dir), 20))


def _mended(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf_dir: _gate(spark, sf_dir).select("row_idx", step(F.col("Text")).alias("mended"))


QUERIES |= {
    "ocr_nfc": _mended(repair.nfc), "ocr_control": _mended(repair.without_controls), "ocr_mojibake": _mended(repair.ungarbled), "ocr_symbols": _mended(repair.signs_mended),
    "ocr_digits": _mended(repair.digits_mended), "ocr_repeat": _mended(repair.runs_collapsed), "ocr_camel": _mended(repair.words_parted),
    "whitespace_norm": lambda spark, sf_dir: _injected(spark, sf_dir).select("doc_id", text.collapse(F.col("text")).alias("tidy")),
    "paragraph_filter": lambda spark, sf_dir: _injected(spark, sf_dir).select("doc_id", text.long_paragraphs(F.col("text"), 150).alias("kept")),
}


@query
def ocr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(_gate(spark, sf_dir).select("row_idx", "Text"), "Text").select("row_idx", "repaired", F.to_json("fixes").alias("fixes"))


@query
def phrase_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = clean.without_phrases(F.col("text"), oracle.PHRASES)
    rows = _injected(spark, sf_dir).select("doc_id", removed.alias("r"))
    count = lambda k: F.coalesce(F.element_at("r.n", F.lit(k)), F.lit(0)).alias(k)
    return rows.select("doc_id", F.col("r.x").alias("kept"), *(count(k) for k in oracle.PHRASES))


def _rules(category: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        done = clean.without_matches(F.col("text"), RULES_BY_CATEGORY[category])
        rows = _injected(spark, sf_dir).select("doc_id", done.alias("r"))
        return rows.select("doc_id", F.col("r.x").alias("kept"), F.aggregate("r.counts", F.lit(0), lambda a, x: a + x).alias("matches"))

    return run


QUERIES |= {f"regex_{c}": _rules(c) for c in RULES_BY_CATEGORY}
BASE = clean.Options(repair=False, use_phrases=False)


@query
def clean_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, white space and paragraphs, without repair and phrases."""
    return clean.cleaned(_injected(spark, sf_dir), "text", BASE).select("doc_id", "cleaned", "original_length", "cleaned_length")


@query
def clean_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair, mined phrases, rules, white space and paragraphs."""
    corpus = _gate(spark, sf_dir).select("row_idx", "Text")
    done = clean.cleaned(corpus, "Text", clean.Options(phrases=pipeline.mined_phrases(corpus)))
    return done.select("row_idx", "cleaned", "original_length", "cleaned_length", "reduction_percent", F.to_json("fixes").alias("fixes"), F.to_json("phrases_removed").alias("phrases_removed"), F.to_json("rules_removed").alias("rules_removed"))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, CLEANED).select("row_idx", "Text_cleaned_ngram", "Flag_Valid"))
    return clean.gated(rows, "Text_cleaned_ngram", BASE, "Flag_Valid")


@query
def clean_flag_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("row_idx", "flag_cleaned", "cleaned")


@query
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.corpus_stats(_gated(spark, sf_dir))


def _reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.cleaned(_injected(spark, sf_dir), "text", BASE)


@query
def reduction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.reduction_summary(_reduced(spark, sf_dir))


@query
def reduction_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.reduction_histogram(_reduced(spark, sf_dir)).select("bucket", "rows")


@query
def reduction_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.weighted_reduction(_reduced(spark, sf_dir))


@query
def band_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.band_sample(_reduced(spark, sf_dir), "doc_id")


@query
def bloc_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = membership.memberships(_gate(spark, sf_dir), "row_idx")
    return found.select("row_idx", "country", F.array_join(F.array_sort(F.map_keys("organizations")), ",").alias("organizations"))


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.country_dimension(table(spark, sf_dir, "country_reference"), table(spark, sf_dir, "country_aliases"))


@query
def country_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, CLEANED).select("row_idx", "Country")
    return chunk.resolved(rows, "Country", _dimension(spark, sf_dir)).select("row_idx", "country_iso3", *chunk.GROUPS)


@query
def chunk_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk_table(spread(table(spark, sf_dir, CLEANED)), "Text_cleaned_ngram", _dimension(spark, sf_dir))


@query
def chunk_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of the documents, without attributes."""
    cut = chunk.chunked(_documents(spark, sf_dir), "text")
    return cut.select("doc_id", F.posexplode("chunks").alias("chunk_index", "c")).select("doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "c.chunk_text", "c.split_method")


@query
def chunk_method_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.method_shares(chunk_full(spark, sf_dir))


@query
def chunk_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.coverage(chunk_full(spark, sf_dir))


@query
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.group_counts(chunk_full(spark, sf_dir))


@query
def unmapped_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.unmapped(chunk_full(spark, sf_dir))


@query
def chunks_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.per_document(table(spark, sf_dir, CLEANED).where("Flag_Cleaned = 'cleaned' AND Text_cleaned_ngram IS NOT NULL"), chunk_full(spark, sf_dir))


@query
def pipeline_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mining, cleaning and chunking from raw texts."""
    return pipeline.run(_gate(spark, sf_dir), "Text", _dimension(spark, sf_dir), "Flag_Valid")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
