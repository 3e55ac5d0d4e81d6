"""SQL for DuckDB that gives the results of the core's queries by another engine."""

from __future__ import annotations

import re
import unicodedata

from tessaloom.functions import repair
from tessaloom.functions.rules import DEFAULT_RULES
from tessaloom.operators import chunk, phrases

#: Phrases of the removal query, in the order in which they are removed.
PHRASES = {"formatting": ["- - - -"], "administrative": ["the budget outline", "agreed with"], "procedural": ["since the last session", "this Committee"], "entity_names": ["department of"]}
WHITE = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


# What is put before and after the text of documents, by the remainder of doc_id / 12, so that every rule has work to do.
AROUND = {
    1: ("The President: welcome to the meeting.\n", ""),
    2: ("Mr. Smith (France):\n", ""),
    3: ("", " . . . . . . and 1 2 3 4 5 a b c d e f end and, and, and, and, – – – – – so - - - - -"),
    4: ("", " (A/70/L.1) [A/C.1/69/PV.13] (see para. 4 above) (spoke in French) (see annex II) [a document of today] (paras. 4 and 5) A/RES70/1"),
    5: ("official records of the general assembly, thirty-first session and report of the secretary-general on the work of the organization agreed with the budget outline ", " department of this Committee - - - -"),
    6: ("", " Pr~fessor f*om c0ntent rea1ly adress6e"),
    7: ("", " espÃ©rons dâ€™un \ufffd\x01 end"),
    8: ("", " ééééé reportOfficer wordsJoined"),
    9: ("", "   \n \n \n more   text\n\n\n\nand a paragraph of more than fifty characters after many line feeds"),
    10: ("", " expenditure appropriation adjustments as at 3 may 2001 (thousands of united states dollars) status: in progress priority: high target date: third quarter and agreed with the board's recommendation that it goes. *** stars ***"),
}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


INJECTED = "SELECT doc_id, CASE doc_id % 12 WHEN 0 THEN replace(text, '.' || chr(10), '.' || chr(10) || chr(10)) " + " ".join(f"WHEN {r} THEN {q(a)} || text || {q(b)}" for r, (a, b) in AROUND.items()) + " ELSE text END AS text FROM documents"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WHITE}+|{WHITE}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split({strip(f"regexp_replace(lower(coalesce({x}, '')), '{WHITE}+', ' ', 'g')")}, ' '), lambda w: w <> '')"


def fourgrams(table: str = "documents", column: str = "text", n: str = "4") -> str:
    return f"SELECT unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))) AS phrase FROM (SELECT {words(column)} AS w FROM {table} WHERE {column} IS NOT NULL)"


GRAMS = f"SELECT phrase, count(*) AS frequency FROM ({fourgrams()}) GROUP BY phrase"
MULTI = " UNION ALL ".join(f"SELECT {n} AS n, phrase, count(*) AS frequency FROM ({fourgrams(n=str(n))}) GROUP BY phrase" for n in range(4, 11))


def keyword(category: str, x: str = "phrase") -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(k)})" for k in phrases.KEYWORDS[category]) + ")"


FORMATTING = "(" + " OR ".join(f"regexp_matches(phrase, {q(p.replace(chr(92) + 's', WHITE[1:-1]))})" for p in phrases.FORMATTING) + f" OR (regexp_matches(phrase, {q('^[a-z' + WHITE[1:-1] + ']+$')}) AND length(replace(phrase, ' ', '')) <= 3))"
METADATA = "(" + " OR ".join(f"regexp_matches(lower(phrase), {q(p)})" for p in phrases.METADATA) + ")"
TESTS = {"formatting": FORMATTING, **{k: keyword(k) for k in phrases.KEYWORDS}, "metadata": METADATA}
CATEGORY = "CASE " + " ".join(f"WHEN {TESTS[c]} THEN {q(c)}" for c in phrases.CATEGORIES) + " END"
EXTRACTED = f"SELECT {CATEGORY} AS category, {strip('phrase')} AS phrase, frequency, '4' AS ngram_size FROM ({GRAMS}) WHERE frequency >= "


def garbled(x: str) -> str:
    for bad, good in repair.GARBLED:
        x = f"replace({x}, {q(bad)}, {q(good)})"
    return x


def digits(x: str) -> str:
    for pattern, by in (("([a-z])6([ea])", r"\1é\2"), ("([a-z])0([a-z])", r"\1o\2"), ("([a-z])1([a-z])", r"\1l\2")):
        x = f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"
    return x


def collapse(x: str) -> str:
    tidy = f"regexp_replace(regexp_replace({x}, ' +', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"array_to_string(list_transform(string_split({tidy}, chr(10)), lambda l: {strip('l')}), chr(10))"


def paragraphs(x: str, least: int) -> str:
    return f"coalesce(array_to_string(list_filter(string_split({x}, chr(10) || chr(10)), lambda p: length({strip('p')}) >= {least}), chr(10) || chr(10)), '')"


def rule(pattern: str) -> tuple[str, str]:
    """The rule and its replacement: what a look-ahead saw is captured and put back."""
    m = re.fullmatch(r"(.*)\(\?=(.+)\)", pattern)
    body, by = (f"{m[1]}({m[2].replace('|', '|')})", r"\1") if m else (pattern, "")
    return "(?ims)" + body.replace(r"\/", "/"), by


def stages(category: str | None, table: str = f"({INJECTED})", key: str = "doc_id", column: str = "text") -> tuple[str, int]:
    """WITH stages s0..sn that run the rules in order; t is the text, m the matches so far."""
    rules = [p for c, on, patterns in DEFAULT_RULES if on and category in (None, c) for p in patterns]
    ctes = [f"s0 AS MATERIALIZED (SELECT {key}, {column} AS t, 0 AS m FROM {table})"]
    for i, p in enumerate(rules, 1):
        body, by = rule(p)
        ctes.append(f"s{i} AS MATERIALIZED (SELECT {key}, regexp_replace(t, {q(body)}, {q(by)}, 'g') AS t, m + len(regexp_extract_all(t, {q(body)})) AS m FROM s{i - 1})")
    return "WITH " + ",\n".join(ctes), len(rules)


def shown(key: str = "row_idx") -> str:
    """CTE shown(key, shown): of each category the matches of the last rule that matched, added up."""
    at, terms = 0, []
    for category, on, patterns in DEFAULT_RULES:
        if on:
            own = [f"nullif(s{at + i}.m - s{at + i - 1}.m, 0)" for i in range(1, len(patterns) + 1)]
            at += len(patterns)
            terms.append(f"coalesce({', '.join(reversed(own))}, 0)")
    return f"shown AS (SELECT s0.{key}, {' + '.join(terms)} AS shown FROM s0 {' '.join(f'JOIN s{i} USING ({key})' for i in range(1, at + 1))})"


def base(select: str, table: str = f"({INJECTED})", key: str = "doc_id", column: str = "text", more: str = "") -> str:
    """`select` over d(key, before, after, kept, reduction) of cleaning by rules only."""
    with_, n = stages(None, f"(SELECT {key}, coalesce({column}, '') AS {column} FROM {table})", key, column)
    return f"""{with_},
w AS (SELECT {key}, {collapse('t')} AS t FROM s{n}),
c AS (SELECT {key}, {paragraphs('t', 50)} AS t FROM w),
d AS (SELECT c.{key}, length(s0.t) AS before, length(c.t) AS after, {strip('c.t')} AS kept, round((1 - length(c.t)::DOUBLE / greatest(length(s0.t), 1)) * 100, 2) AS reduction FROM c JOIN s0 USING ({key})){"," + chr(10) + more if more else ""}
{select}"""


MARK = "chr(1)"


def packed(parts: str, most: int) -> str:
    """Chunks of a list of parts: a fold whose state is a struct of chunks done and the one being filled."""
    states = f"list_transform({parts}, lambda s: {{'c': []::VARCHAR[], 'b': s}})"
    step = f"CASE WHEN a.b <> '' AND length(a.b) + length(e.b) + 1 > {most} THEN {{'c': list_append(a.c, {strip('a.b')}), 'b': e.b}} WHEN a.b <> '' THEN {{'c': a.c, 'b': {strip("a.b || ' ' || e.b")}}} ELSE {{'c': a.c, 'b': e.b}} END"
    return f"list_transform([list_reduce({states}, lambda a, e: {step})], lambda r: CASE WHEN {strip('r.b')} <> '' THEN list_append(r.c, {strip('r.b')}) ELSE r.c END)[1]"


def cut_behind(x: str, signs: str) -> str:
    return f"string_split(regexp_replace({x}, '([{signs}]){WHITE}+', '\\1' || {MARK}, 'g'), {MARK})"


def sentence_chunks(x: str, most: int = chunk.MOST, least: int = chunk.LEAST) -> str:
    clauses = packed(cut_behind("p", ",;"), most)
    long = f"flatten(list_transform({packed(cut_behind(x, '.!?'), most)}, lambda p: CASE WHEN length(p) <= {most} THEN [p] ELSE {clauses} END))"
    return f"list_filter(CASE WHEN len({cut_behind(x, '.!?')}) <= 1 THEN [{x}] ELSE {long} END, lambda p: length(p) >= {least})"


def chunks(table: str, keys: str, column: str) -> str:
    """(keys, chunk_index, chunk_total, chunk_text, split_method) of a table's texts."""
    most, least = chunk.MOST, chunk.LEAST
    return f"""(
WITH t AS (SELECT {keys}, {strip(f"coalesce({column}, '')")} AS t FROM {table}),
p AS (SELECT *, CASE WHEN length(t) > {most} AND contains(t, chr(10) || chr(10)) THEN list_filter(list_transform(string_split(t, chr(10) || chr(10)), lambda x: {strip('x')}), lambda x: length(x) >= {least}) ELSE []::VARCHAR[] END AS ps FROM t),
m AS (SELECT *, CASE WHEN len(ps) > 1 THEN flatten(list_transform(ps, lambda x: CASE WHEN length(x) > {most} THEN {sentence_chunks('x')} ELSE [x] END)) END AS pc, CASE WHEN length(t) > {most} AND len(ps) <= 1 THEN {sentence_chunks('t')} END AS sc FROM p),
c AS (SELECT *, CASE WHEN t = '' THEN []::VARCHAR[] WHEN length(t) <= {most} THEN [t] WHEN len(pc) > 0 THEN pc WHEN len(sc) > 1 THEN sc ELSE [t] END AS cs, CASE WHEN length(t) <= {most} THEN 'no_split' WHEN len(pc) > 0 THEN 'paragraph' WHEN len(sc) > 1 THEN 'sentence' ELSE 'no_split' END AS split_method FROM m)
SELECT {keys}, unnest(cs) AS chunk_text, CAST(generate_subscripts(cs, 1) - 1 AS INTEGER) AS chunk_index, CAST(len(cs) AS INTEGER) AS chunk_total, split_method FROM c)"""


def _plain_letters() -> tuple[str, str]:
    """Characters whose compatible decomposition is one letter of ASCII besides marks, and those letters."""
    pairs = [(chr(c), plain) for c in range(0x80, 0x20000) if len(plain := unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def country_key(x: str) -> str:
    return f"replace(lower({strip(x)}), chr(65533), '')"


def countries(select: str, rest: str = "") -> str:
    """`select` over d(row_idx, Country, country_iso3, groups...): names by key and else, without groups, by key in ASCII."""
    groups = ", ".join(chunk.GROUPS)
    plain = "regexp_replace(translate(k, {}, {}), '[^\\x00-\\x7f]', '', 'g')".format(*map(q, _plain_letters()))
    return f"""
WITH names AS (SELECT {country_key('name')} AS key, iso3, {groups} FROM country_reference),
dim AS (SELECT * FROM names UNION ALL SELECT a.key, a.iso3, {groups} FROM (SELECT {country_key('alias')} AS key, min(iso3) AS iso3 FROM country_aliases GROUP BY 1) a JOIN country_reference USING (iso3) WHERE a.key NOT IN (SELECT key FROM names)),
keyed AS (SELECT *, {country_key('Country')} AS k FROM lawsec_v1_18i_cluster_cleaned),
looked AS (SELECT k, {strip(plain)} AS plain FROM (SELECT DISTINCT k FROM keyed WHERE k <> '')),
found AS (SELECT k, coalesce(d1.iso3, d2.iso3) AS country_iso3, {', '.join('d1.' + g for g in chunk.GROUPS)} FROM looked LEFT JOIN dim d1 ON d1.key = looked.k LEFT JOIN dim d2 ON d2.key = looked.plain),
d AS (SELECT keyed.* EXCLUDE (k), country_iso3, {', '.join(f'coalesce({g}, false) AS {g}' for g in chunk.GROUPS)} FROM keyed LEFT JOIN found ON keyed.k = found.k){rest}
{select}"""


def chunk_table(select: str) -> str:
    """`select` over f, the chunk table."""
    meta = ", ".join(chunk.METADATA)
    flagged = f"(SELECT * FROM d WHERE Flag_Cleaned = 'cleaned' AND Text_cleaned_ngram IS NOT NULL AND length({strip('Text_cleaned_ngram')}) > 0)"
    rest = f""",
f AS (SELECT format('{{}}_r{{}}_chunk{{:03d}}', doc_id, row_idx, chunk_index) AS chunk_id, doc_id, row_idx, chunk_index, chunk_total, chunk_text, split_method, {meta}, country_iso3, {', '.join(chunk.GROUPS)} FROM {chunks('flagged', '*', 'Text_cleaned_ngram')})"""
    return countries(select, f",\nflagged AS {flagged}" + rest)


def oracle_sql() -> dict[str, str]:
    sql = {
        "word_topk": f"SELECT phrase, count(*) AS frequency FROM (SELECT unnest({words('text')}) AS phrase FROM documents WHERE text IS NOT NULL) GROUP BY phrase ORDER BY frequency DESC, phrase LIMIT 100",
        "ngram4_topk": f"{GRAMS} ORDER BY frequency DESC, phrase LIMIT 50",
        "ngram_multi_topk": f"SELECT CAST(r AS INTEGER) AS rank, phrase, frequency, n || '-gram' AS type FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY frequency DESC, phrase) AS r FROM ({MULTI})) WHERE r <= 20",
        "frequency_report": f"SELECT CAST(row_number() OVER (ORDER BY frequency DESC, phrase) AS INTEGER) AS rank, phrase, frequency, 'word' AS type FROM (SELECT phrase, count(*) AS frequency FROM (SELECT unnest({words('Text')}) AS phrase FROM gate_mwe WHERE Text IS NOT NULL) GROUP BY phrase) ORDER BY frequency DESC, phrase LIMIT 500",
        "ngram_distinct": f"SELECT count(*) AS distinct_ngrams, CAST(sum(frequency) AS BIGINT) AS ngrams FROM ({GRAMS})",
        "row_count": "SELECT count(*) AS rows, count(Text) AS texts FROM gate_mwe",
        "preview": "SELECT doc_id, CASE WHEN length(text) > 300 THEN substring(text, 1, 300) || '...' ELSE text END AS preview FROM documents",
        "classify_phrases": f"SELECT phrase, {', '.join(f'{t} AS {k}' for k, t in TESTS.items())} FROM (SELECT DISTINCT phrase FROM ({fourgrams()}))",
        "categorize_phrases": EXTRACTED + "5",
        "category_counts": f"WITH e AS ({EXTRACTED}5) SELECT coalesce(category, 'skipped') AS category, count(*) AS phrases FROM e GROUP BY 1 UNION ALL SELECT 'total', count(category) FROM e",
        "removal_list": f"SELECT DISTINCT phrase, CAST(length(phrase) AS INTEGER) AS chars FROM ({EXTRACTED}5) WHERE category IS NOT NULL AND frequency >= 10",
        "ocr_nfc": "SELECT row_idx, nfc_normalize(Text) AS mended FROM gate_mwe",
        "ocr_control": r"SELECT row_idx, regexp_replace(Text, '[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS mended FROM gate_mwe",
        "ocr_mojibake": f"SELECT row_idx, {garbled('Text')} AS mended FROM gate_mwe",
        "ocr_digits": f"SELECT row_idx, {digits('Text')} AS mended FROM gate_mwe",
        "ocr_camel": r"SELECT row_idx, regexp_replace(regexp_replace(Text, '([a-z]{3})([A-Z][a-z]{2})', '\1 \2', 'g'), '([a-z]{3})([A-Z][a-z]{2})', '\1 \2', 'g') AS mended FROM gate_mwe",
        "whitespace_norm": f"SELECT doc_id, {collapse('text')} AS tidy FROM ({INJECTED})",
        "paragraph_filter": f"SELECT doc_id, {paragraphs('text', 150)} AS kept FROM ({INJECTED})",
        "bloc_map": "WITH m AS (UNPIVOT (SELECT row_idx, Country, BLOC_HarbourCompact AS HarbourCompact, BLOC_SouthernIsles AS SouthernIsles, BLOC_LandlockedGroup AS LandlockedGroup, BLOC_RiverPact AS RiverPact FROM gate_mwe) ON HarbourCompact, SouthernIsles, LandlockedGroup, RiverPact INTO NAME org VALUE v) SELECT row_idx, Country AS country, string_agg(org, ',' ORDER BY org) AS organizations FROM m WHERE v <> 0 AND NOT isnan(v) GROUP BY row_idx, Country",
    }
    x, counts, kept = "text", [], "text"
    for category, listed in PHRASES.items():
        terms = []
        for p in listed:
            terms.append(f"(length({kept}) - length(replace({kept}, {q(p)}, ''))) // {len(p)}")
            kept = f"replace({kept}, {q(p)}, ' ')"
        counts.append(f"CAST({' + '.join(terms)} AS INTEGER) AS {category}")
    sql["phrase_removal"] = f"SELECT doc_id, {kept} AS kept, {', '.join(counts)} FROM (SELECT doc_id, {x} FROM ({INJECTED}))"
    for category, on, _ in DEFAULT_RULES:
        if on:
            with_, n = stages(category)
            sql[f"regex_{category}"] = f"{with_} SELECT doc_id, t AS kept, CAST(m AS INTEGER) AS matches FROM s{n}"
    sql["clean_base"] = base("SELECT doc_id, kept AS cleaned, CAST(before AS INTEGER) AS original_length, CAST(after AS INTEGER) AS cleaned_length FROM d")
    sql["reduction_summary"] = base("SELECT avg(reduction) AS mean, median(reduction) AS median, min(reduction) AS least, max(reduction) AS most FROM d")
    sql["reduction_histogram"] = base("SELECT bucket, count(reduction) AS rows FROM (VALUES ('<10', -1e9, 10), ('10-25', 10, 25), ('25-50', 25, 50), ('50-75', 50, 75), ('>=75', 75, 1e9)) AS b(bucket, low, high) LEFT JOIN d ON reduction >= low AND reduction < high GROUP BY bucket")
    sql["reduction_weighted"] = base("SELECT round((1 - sum(after)::DOUBLE / sum(before)) * 100, 2) AS weighted_reduction FROM d")
    sql["clean_flag_gate"] = base(
        "SELECT row_idx, CASE WHEN Flag_Valid IS NULL OR Flag_Valid <> 1 THEN 'skipped_invalid' WHEN x.Text_cleaned_ngram IS NULL THEN 'skipped_empty' ELSE 'cleaned' END AS flag_cleaned, CASE WHEN Flag_Valid = 1 AND x.Text_cleaned_ngram IS NOT NULL THEN kept ELSE coalesce(x.Text_cleaned_ngram, '') END AS cleaned FROM d JOIN lawsec_v1_18i_cluster_cleaned x USING (row_idx)",
        "lawsec_v1_18i_cluster_cleaned", "row_idx", "Text_cleaned_ngram",
    )
    sql |= {
        "chunk_pieces": f"SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index, chunk_text, split_method FROM {chunks('documents', 'doc_id', 'text')}",
        "country_resolve": countries(f"SELECT row_idx, country_iso3, {', '.join(chunk.GROUPS)} FROM d"),
        "chunk_full": chunk_table("SELECT * FROM f"),
        "chunk_method_dist": chunk_table("SELECT split_method, count(*) AS chunks, round(100 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM f GROUP BY split_method"),
        "chunk_coverage": chunk_table("SELECT count(country_iso3) AS resolved, count(*) AS chunks, round(100 * count(country_iso3) / count(*), 2) AS percent FROM f"),
        "group_counts": chunk_table(" UNION ALL ".join(f"SELECT '{g}' AS country_group, CAST(count_if({g}) AS BIGINT) AS chunks, round(100 * count_if({g}) / count(*), 2) AS percent FROM f" for g in chunk.GROUPS)),
        "unmapped_topk": chunk_table(f"SELECT {strip('Country')} AS name, count(*) AS documents FROM f WHERE chunk_index = 0 AND country_iso3 IS NULL AND {strip('Country')} <> '' GROUP BY 1 ORDER BY documents DESC, name LIMIT 10"),
        "chunks_per_document": chunk_table("SELECT documents, documents - with_chunks AS skipped, chunks, round(chunks / greatest(documents, 1), 2) AS chunks_per_document FROM (SELECT count(*) AS documents FROM lawsec_v1_18i_cluster_cleaned WHERE Flag_Cleaned = 'cleaned' AND Text_cleaned_ngram IS NOT NULL), (SELECT count(*) AS chunks, CAST(count_if(chunk_index = 0) AS BIGINT) AS with_chunks FROM f)"),
        "phrase_dictionary": f"SELECT category, CAST(to_json(list({{'phrase': phrase, 'frequency': frequency, 'ngram_size': ngram_size}} ORDER BY frequency DESC, phrase)) AS VARCHAR) AS entries FROM ({EXTRACTED}20) WHERE category IS NOT NULL GROUP BY category",
        "schema_listing": "SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type FROM (DESCRIBE gate_mwe)",
        "ocr_symbols": r"SELECT row_idx, regexp_replace(regexp_replace(Text, '([\p{L}\p{M}\p{Nd}\p{Pc}])~([\p{L}\p{M}\p{Nd}\p{Pc}])', '\1o\2', 'g'), '([\p{L}\p{M}\p{Nd}\p{Pc}])[*]([\p{L}\p{M}\p{Nd}\p{Pc}])', '\1r\2', 'g') AS mended FROM gate_mwe".replace("\\\\", "\\"),
        "corpus_stats": base(
            "SELECT count(*) AS total_rows, CAST(count_if(NOT ok) AS BIGINT) AS skipped_invalid, CAST(sum(CASE WHEN done THEN before ELSE 0 END) AS BIGINT) AS total_original_chars, CAST(sum(CASE WHEN done THEN after ELSE 0 END) AS BIGINT) AS total_cleaned_chars, CAST(0 AS BIGINT) AS fixed_rows, CAST(0 AS BIGINT) AS phrases_removed, CAST(sum(CASE WHEN done THEN shown ELSE 0 END) AS BIGINT) AS rule_matches_removed, round(avg(reduction) FILTER (done), 2) AS avg_reduction_percent"
            " FROM (SELECT d.*, Flag_Valid IS NOT NULL AND Flag_Valid = 1 AS ok, ok AND x.Text_cleaned_ngram IS NOT NULL AS done, shown FROM d JOIN lawsec_v1_18i_cluster_cleaned x USING (row_idx) JOIN shown USING (row_idx))",
            "lawsec_v1_18i_cluster_cleaned", "row_idx", "Text_cleaned_ngram", shown(),
        ),
    }
    return sql
