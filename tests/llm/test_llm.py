import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessaloom.llm import canonical, charsets, copies, encoding, look, lookalike, mixing, packing, prose, queries, residue, rules, running, scans, site_lines, split, tokens

PROSE = "The committee has taken note of the report on the harbour and will return to it in the next session. We thank the members for their work."


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_runs(name, spark, data):
    rows = queries.queries()[name](spark, data)
    columns = {"p2_found": "table_name string, row_idx bigint", "p4_found": "row_idx bigint, iso3 string", "p10_found": "doc_id bigint"}.get(name, "row_idx bigint")
    if name.endswith("_found"):
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) == columns
    found = rows.toPandas()
    assert len(found) or name == "p5_lines"
    assert not name.endswith("_found") or not found.duplicated().any()


def test_queries_hold_what_they_promise(spark, data):
    """Pieces put together give the text, containers hold no more than they may and every document once, shares are within a document."""
    run = lambda name: queries.queries()[name](spark, data).toPandas()
    read = lambda name: spark.read.parquet(f"{data}/{name}.parquet").toPandas()
    chunks = read("lawsec_v1_18i_chunked").merge(read("chunk_profiles"), on="split_profile").set_index("chunk_id")
    for key, pieces in run("p6_pieces").sort_values("piece_no").groupby("chunk_id"):
        text = chunks.loc[key, "Text_cleaned_ngram"]
        assert all(text[a : a + len(p)] == p and len(p) <= chunks.loc[key, "max_chars"] for a, p in zip(pieces["start"], pieces["piece"]))
        ends = [a + len(p) for a, p in zip(pieces["start"], pieces["piece"])]
        assert pieces["start"].iloc[0] == 0 and ends[-1] == len(text) and all(e - a == chunks.loc[key, "overlap_chars"] for e, a in zip(ends, list(pieces["start"])[1:]))
    packed, documents = run("p8_packed"), read("documents")
    for row in read("pack_containers").itertuples():
        own = packed[packed["container"] == row.container]
        assert own.groupby("container_no")["tokens"].sum().max() <= row.capacity_tokens and set(own["doc_id"]) == set(documents["doc_id"])
        assert not own.duplicated(["doc_id", "piece_no"]).any() and (own.groupby("doc_id")["tokens"].sum()[own.groupby("doc_id").size() > 1] > row.capacity_tokens).all()
    sizes = packed[packed["container"] == packed["container"].iloc[0]].groupby("doc_id")["tokens"].sum()
    targets = read("mix_targets").set_index(["mix_name", "source"])
    for key, own in run("p9_mixed").groupby(["mix_name", "source"]):
        assert (own.groupby("doc_id").size() <= targets.loc[key, "max_repeats"]).all() and (own["tokens"] == own["doc_id"].map(sizes)).all()
    kept, found = run("p10_kept"), run("p10_found")
    assert sorted([*kept["doc_id"], *found["doc_id"]]) == sorted(documents["doc_id"])


def gate(spark, texts, schema="row_idx bigint, Text string"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], schema)


def ids(df, key="row_idx"):
    return sorted(r[key] for r in df.collect())


def test_prose_and_the_rest(spark):
    table = "\n".join(f"Member{i} | {i * 7} | {i}.5 | -" for i in range(20))
    listed = "\n".join(f"({i}) maritime map" for i in range(20))
    given = [PROSE, PROSE.upper(), PROSE.lower().replace(".", ""), table, listed, "asdkjh qwkejh zmxncb\n" * 9, None, "", "  \n", PROSE + "\n(1) map\n(2) rule", PROSE + "\n" + table, table, "x" * 300_000]
    assert ids(prose.not_prose(gate(spark, given))) == [3, 4, 5, 10, 11, 12]
    figures = {r["row_idx"]: r for r in prose.figures(gate(spark, given)).collect()}
    assert figures[6]["words"] is None and figures[7]["words"] == 0 and figures[0]["end_share"] == 1.0
    assert prose.not_prose(gate(spark, given).limit(0)).count() == 0
    with pytest.raises(ValueError):
        prose.figures(gate(spark, given).withColumn("words", F.lit(1)))


def test_induced_rules_separate_and_refuse_too_many():
    rng = np.random.default_rng(1)
    x = rng.random((400, 3))
    y = (x[:, 1] > 0.6) | ((x[:, 0] > 0.7) & (x[:, 2] < 0.4))
    found = rules.induce(x[:300], y[:300])
    guess = np.zeros(100, bool)
    for rule in found:
        guess |= rules._covered(rule, x[300:])
    assert (guess == y[300:]).mean() > 0.9
    with pytest.raises(ValueError):
        rules.induce(np.zeros((rules.MOST_ROWS + 1, 1)), np.zeros(rules.MOST_ROWS + 1))
    assert rules.induce(x, np.zeros(400, bool)) == []


def test_garbled_words_found_and_restored(spark):
    words = ["région", "délégation", "formación", "não", "l’accord", "Łodzavia", "МИР", "и", "½", "Á", "ação"]
    chains = dict(charsets.garbled("délégation de la région"))
    given = [" ".join(words), "la région et la délégation", *(chains[c] for c in ("utf8>cp1252", "utf8>latin-1", "utf8>mac_roman", "utf8>cp437", "utf8>cp850", "utf8>gbk", "utf8>cp1252>utf8>cp1252", "cp1252>cp1251", "utf8>ascii", "cp1252>utf8")), None, "", "plain words", "fee is £23 or ½ of it", "МИР", "región", chains["utf8>cp1252"]]
    df = gate(spark, given).withColumn("word", F.lit("clash"))
    assert ids(encoding.garbled_rows(df, "row_idx", "Text")) == [*range(2, 12), 18]
    restored = {r["row_idx"]: r for r in encoding.restored_texts(df, "row_idx", "Text").collect()}
    for i in [*range(2, 12), 18]:
        assert restored[i]["restored"] == "délégation de la région" and restored[i]["lost"] == 0, given[i]
    assert encoding.garbled_rows(df.limit(0), "row_idx", "Text").count() == 0


def test_garbled_word_seen_nowhere_clean(spark):
    assert ids(encoding.garbled_rows(gate(spark, ["été", "le mÃ©cauisme"]), "row_idx", "Text")) == [1]


def test_restoring_keeps_proper_words(spark):
    chains = dict(charsets.garbled("délégation"))
    given = ["à la région", "délégation", f"{chains['utf8>cp1252']} : Наша страна, а также Россия", f"{chains['utf8>cp1252']} а la région", "à la délégation", "à la région", "à la région"]
    got = {r["row_idx"]: (r["restored"], r["lost"]) for r in encoding.restored_texts(gate(spark, given), "row_idx", "Text").collect()}
    assert got[2] == ("délégation : Наша страна, а также Россия", 1) and got[3] == ("délégation à la région", 0) and set(got) == {2, 3}


def test_scan_noise(spark):
    clean = [PROSE.replace(" the ", "\nthe "), PROSE.upper(), "It took place on the 4th of May at 12:30 in room 7.", None, ""]
    noisy = [PROSE.replace("committee", "com-\nmittee"), PROSE.replace("report", "rep0rt"), PROSE + "\n— 40 —\nand so on", PROSE + "\nVerbatim, vol. II, M/AS/47/L.73\nand so on", PROSE.replace("committee", "com­\nmittee")]
    df = gate(spark, clean + [PROSE] * 30 + noisy)
    assert ids(scans.noisy_rows(df)) == [35, 36, 37, 38, 39]
    assert scans.noisy_rows(df.limit(0)).count() == 0


def test_scanned_pages_repaired(spark):
    page = "The com-\nmittee has taken\nnote of the rep0rt\n— 40 —\non the harbour.\n\nWe thank the members."
    df = gate(spark, [PROSE] * 30 + [page])
    got = {r["row_idx"]: r["repaired"] for r in scans.repaired_rows(df).collect()}
    assert got == {30: "The committee has taken note of the report on the harbour.\n\nWe thank the members."}


def test_running_headers_found_by_repetition(spark):
    header = "Forum on the Harbours and Coasts of the Northern Sea and of its Islands, Second Part"
    page = "We thank the {0}\n" + header + "\nfor the work on the {0} report."
    copied = "The delegation of the\nNorthern Coast Harbour Authority\nhas left the room."
    df = gate(spark, [page.format(w) for w in ("members", "chair", "staff")] + [copied] * 4 + [f"Opening of part {i}.\n{PROSE}" for i in range(4)])
    assert ids(scans.noisy_rows(df)) == [0, 1, 2]
    assert {r["repaired"] for r in scans.repaired_rows(df).collect()} == {f"We thank the {w} for the work on the {w} report." for w in ("members", "chair", "staff")}


def test_misreadings_put_right_by_their_context(spark):
    # beat, heat and beaf have one skeleton
    given = ["The drums beat on through long nights."] * 60 + ["Summer heat was strong in those valleys."] * 30
    page = "Summer he@t was strong in tho-\nse valleys."
    rare = "A quiet beaf opens onto every sheltered co-\nast."  # beside no word that stands beside the others: a word of its own
    df = gate(spark, [*given, page, rare])
    got = {r["row_idx"]: r["repaired"] for r in scans.repaired_rows(df).collect()}
    assert got == {90: "Summer heat was strong in those valleys.", 91: "A quiet beaf opens onto every sheltered coast."}


def test_words_of_their_own_context_stay(spark):
    seen = ["They live in the east of the province and go east in the summer."] * 45
    page = "The votes cast in the com-\nmittee were counted. They live in the e@st of the province."
    df = gate(spark, [*seen, page])
    assert {r["repaired"] for r in scans.repaired_rows(df).collect()} == {"The votes cast in the committee were counted. They live in the east of the province."}


def test_headers_without_numbers(spark):
    pages = [f"We thank the {w} for\nHarbour Forum of the Northern Sea\nthe work on the {w} report." for w in ("members", "chair", "staff", "hosts")]
    clean = [f"{PROSE}\nHarbour treaty of part {chr(97 + i)}\n{PROSE}" for i in range(6)]
    assert ids(scans.noisy_rows(gate(spark, pages + clean))) == [0, 1, 2, 3]


def test_confused_glyphs_have_equal_skeletons(spark):
    alike = [("perlod", "period"), ("wlthout", "without"), ("commlttee", "committee"), ("notif1cation", "notification"), ("maiim", "maum"), ("pcriod", "period"), ("panei", "panel"), ("govemment", "government"), ("rehef", "relief"), ("dedined", "declined"), ("vvith", "with"), ("gouveruement", "gouvernement"), ("tbe", "the"), ("mect", "meet"), ("cjaim", "claim"), ("o1d", "old")]
    apart = [("paid", "panel"), ("of", "off"), ("the", "tree")]
    same = lambda pairs: [r["s"] for r in spark.createDataFrame(pairs, "a string, b string").select((scans.glyph_skeleton(F.col("a")) == scans.glyph_skeleton(F.col("b"))).alias("s")).collect()]
    assert all(same(alike)) and not any(same(apart))
    df = gate(spark, [PROSE] * 30 + [PROSE.replace("committee", "commlttee").replace("return", "retum")])
    assert ids(scans.noisy_rows(df)) == [30]
    many = spark.createDataFrame([(i, "the") for i in range(500)] + [(500, "tbe"), (501, "t@e"), (502, "ths")] + [(i, "las") for i in range(500)] + [(503, "l@s")], "key bigint, word string")
    assert sorted((r["word"], r["original"]) for r in scans.misreadings(scans.word_counts(many)).collect()) == [("l@s", "las")]


def test_site_lines(spark):
    same = "Check against delivery, room 12"
    rows = [(i, i if i != 5 else 4, "A" if i < 8 else None, f"{same.replace('12', str(i))}\nown line number {chr(97 + i) * 12}\nshort") for i in range(10)] + [(10, 20, "B", same), (11, 21, "A", None), (12, 22, "A", "  CHECK  against delivery, room 9 ")]
    df = spark.createDataFrame(rows, "row_idx bigint, doc_id bigint, Forum string, Text string").withColumn("source", F.lit(1))
    got = {(r["row_idx"], r["line_no"]) for r in site_lines.occurrences(df).collect()}
    assert got == {*((i, 1) for i in range(8)), (12, 1)}
    kept = {r["row_idx"]: r["text_kept"] for r in site_lines.without_excessive_lines(df).collect()}
    assert kept[0] == "own line number aaaaaaaaaaaa\nshort" and kept[10] == same and kept[11] is None and kept[12] == ""
    assert site_lines.occurrences(df.limit(0)).count() == 0
    lines = site_lines.excessive_lines(df.withColumn("Date", F.lit("2001")), date="Date").collect()
    assert [(r["source"], r["documents"], r["dates"]) for r in lines] == [("A", 8, 1)]  # the document delivered twice counts once


def test_republished_articles_are_no_site_lines(spark):
    article = "\n".join(f"Paragraph {w} of the article speaks at length about the {w} of the harbour." for w in ("history", "trade", "winter", "ships"))
    notice = "All rights of this site are reserved."
    rows = [(i, i, "A", f"200{i}-01-01", f"{article}\nposted by {n}") for i, n in enumerate(("Ann", "Bo", "Cy"))]
    rows += [(i, i, "A", f"199{i}-01-01", f"A text about subject {chr(97 + i) * 9}.\n{notice}") for i in range(3, 7)]
    rows += [(i, i, "B", "2001-01-01", f"One day only, topic {chr(97 + i) * 9}.\n{notice}") for i in range(10, 14)]
    df = spark.createDataFrame(rows, "row_idx bigint, doc_id bigint, Forum string, Date string, Text string")
    kept = {r["row_idx"]: r["text_kept"] for r in site_lines.without_excessive_lines(df, date="Date").collect()}
    assert all(kept[i] == rows[i][4] for i in range(3)) and all(notice not in kept[i] for i in range(3, 7)) and all(notice in kept[i] for i in range(10, 14))
    lines = {(r["source"], r["line"]): (r["documents"], r["clusters"], r["dates"]) for r in site_lines.line_counts(df).collect()}
    assert lines["A", notice.lower()] == (4, 4, 4) and lines["B", notice.lower()] == (4, None, None) and len(lines) == 6


def test_copies_edited_in_a_longest_line_are_no_site_lines(spark):
    words = ("history", "trade", "winter", "ships")
    article = "\n".join(f"Paragraph {w} of the article speaks at length about the {w} of the harbour." for w in words)
    notice = "All rights of this site are reserved."
    rows = [(i, i, "A", f"200{i}-01-01", article.replace(f"{w} of the harbour", f"{w} of our harbour")) for i, w in enumerate(words)]
    # tables of other numbers are other documents, a corrected delivery is the same one
    rows += [(i, i, "B", f"199{i}-01-01", "\n".join(f"{i}{n}1 {i}{n}2 {i}{n}3 {i}{n}4 {i}{n}5" for n in range(5)) + f"\n{notice}") for i in range(4, 7)]
    rows += [(i, 10 + i // 9, "C", f"199{i}-01-01", f"A text about subject {chr(97 + i) * 9}.\n{notice}") for i in range(7, 10)]
    df = spark.createDataFrame(rows, "row_idx bigint, doc_id bigint, Forum string, Date string, Text string")
    kept = {r["row_idx"]: r["text_kept"] for r in site_lines.without_excessive_lines(df, date="Date").collect()}
    assert all(kept[r[0]] == r[4] for r in rows if r[2] != "B") and all(notice not in kept[i] for i in range(4, 7))
    # p5_found's definition counts documents, whatever they say
    assert {r["row_idx"] for r in site_lines.occurrences(df).collect()} == set(range(7))


def test_copies_are_those_that_share_their_shingles(spark):
    """Against a comparison of all pairs, over copies with ever more words exchanged, each made from the one before."""
    rows = [(f"{d}{n}", "S", " ".join("new" + w if i % 40 < n else w for i, w in enumerate(f"{d}{x}" for x in range(160)))) for d in "abc" for n in range(12)] + [("z", "S", " "), ("y", "S", None), ("a9x", "T", "a1 a2 a3")]
    df = spark.createDataFrame(rows, "document string, source string, text string")
    got = {r["document"]: r["cluster"] for r in copies.copies(df).collect()}
    runs = {r["document"]: set(r["s"] or ()) for r in df.where("source = 'S'").select("document", copies.shingles(F.col("text")).alias("s")).collect()}
    cluster = {d: d for d in runs}
    for _ in runs:
        for a, b in ((a, b) for a in runs for b in runs if runs[a] and len(runs[a] & runs[b]) >= copies.LEAST_ALIKE * len(runs[a] | runs[b])):
            cluster[a] = cluster[b] = min(cluster[a], cluster[b])
    assert {d: c for d, c in cluster.items() if d in got} == got and {d for d, c in cluster.items() if c != d} <= set(got) and len(got) == 36


def test_one_day_in_several_notations_is_one_date(spark):
    dates = ["2003-07-01", "01/07/2003", "1 July 2003", "2003", "2003-07-01 10:00:00", " ", None, "summer"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, date string")
    assert [r["d"] for r in df.orderBy("i").select(site_lines.published(F.col("date")).alias("d")).collect()] == [*["2003-07-01"] * 3, "2003-??", "2003-07-01", None, None, "summer"]
    notice = "All rights of this site are reserved."
    rows = [(i, i, f, d, f"A text about subject {chr(97 + i) * 9}.\n{notice}") for i, (f, d) in enumerate([*(("A", d) for d in dates[:5]), *(("B", d) for d in ("2003", "2004", "2004-05-01"))])]
    lines = site_lines.excessive_lines(spark.createDataFrame(rows, "row_idx bigint, doc_id bigint, Forum string, Date string, Text string"), date="Date", clusters=True).collect()
    assert [(r["source"], r["documents"], r["dates"]) for r in lines] == [("B", 3, 2)]


def test_rows_without_document_do_not_count(spark):
    rows = [(i, d, "A", f"Check against delivery, room {i}\nown words {chr(97 + i) * 9}") for i, d in enumerate((1, 2, None))]
    schema = "row_idx bigint, doc_id bigint, Forum string, Text string"
    assert site_lines.occurrences(spark.createDataFrame(rows, schema)).count() == 0  # count(DISTINCT doc_id) is 2
    assert site_lines.occurrences(spark.createDataFrame([*rows, (3, 3, "A", "Check against delivery, room 3")], schema)).count() == 4


def test_looks(spark):
    values = ["Aldermark", "Аldermark", "Ａldermark", "Al​dermark", "South Dravena", "South  Dravena\t", "Келмара", "СОСО", "COCO", "РОР", None, "", " ", "​", "C\u030cestrova"]
    df = gate(spark, values, "row_idx bigint, Country string").withColumn("value", F.lit(1))
    # РОР has no Latin fellow and stays; a value of invisible characters only has no usual form to show
    assert ids(look.unusual_rows(df.drop("value"), "row_idx", "Country")) == [1, 2, 3, 7, 14]
    forms = {r["row_idx"]: r for r in look.in_one_form(df.drop("value"), "Country").collect()}
    assert forms[1]["usual_form"] == forms[0]["usual_form"] == "Aldermark" and forms[1]["skeleton"] == forms[0]["skeleton"] and forms[10]["usual_form"] is None
    assert look.unusual_rows(df.drop("value").limit(0), "row_idx", "Country").count() == 0
    with pytest.raises(ValueError):
        look.in_one_form(df.withColumn("skeleton", F.lit(1)), "Country")


def test_looks_of_further_scripts(spark):
    values = ["Aldermark", "ᎪldermaRk", "ꓮldermark", "AldermarⲢ", "COPA", "ꓚꓳꓑꓮ", "ᏟOPA", "ⲤⲞⲢⲀ", "Corvia", "C0rvia", "Corv1a", "A4", "Işıkeli", "Işikeli", "No10"]
    df = gate(spark, values, "row_idx bigint, Country string")
    # Corv1a reads as Corvla, which nobody is called; words wholly in another script follow a Latin fellow
    assert ids(look.unusual_rows(df, "row_idx", "Country")) == [1, 2, 3, 5, 6, 7, 9]
    forms = {values[r["row_idx"]]: r for r in look.in_one_form(df, "Country").collect()}
    assert forms["ꓮldermark"]["usual_form"] == "Aldermark" and forms["C0rvia"]["usual_form"] == "Corvia" and forms["ⲤⲞⲢⲀ"]["usual_form"] == "COPA"
    assert forms["Işıkeli"]["skeleton"] == forms["Işikeli"]["skeleton"] and forms["Işıkeli"]["usual_form"] == "Işıkeli"


def test_ambiguous_keys_are_told(spark):
    make = lambda rows: spark.createDataFrame(rows, "name string, entry string")
    rows = gate(spark, ["the coast", "corvia", "Corvia"], "row_idx bigint, Country string")
    got = canonical.canonical_rows(rows, "row_idx", "Country", make([("Corvia", "COV"), ("Élan", "ELA")]), make([("The Coast", "COV"), ("The Coast", "ELA"), ("CORVIA", "ELA")]), make([("COV", "COV")])).collect()
    assert {r["row_idx"]: (r["entry"], r["how"]) for r in got} == {0: ("NONE", "ambiguous"), 1: ("COV", "exact")}


def test_boundaries_are_least_by_brute_force():
    from itertools import combinations

    rng = np.random.default_rng(3)
    for _ in range(30):
        h = rng.integers(0, 5, 12)
        h[0] = 0
        sizes = np.flatnonzero(h)
        if not len(sizes):
            continue
        k = int(rng.integers(1, 5))
        pad = lambda b: sum(int(h[s]) * (min(x for x in b if x >= s) - int(s)) for s in sizes)
        got = packing.boundaries(h, k)
        best = min(pad((*c, int(sizes[-1]))) for n in range(k) for c in combinations([int(s) for s in sizes[:-1]], n))
        assert len(got) <= max(k, 1) and pad(got) == best, (h, k, got)


def test_plan_places_all_within_capacity():
    rng = random.Random(2)
    for _ in range(50):
        capacity = rng.randint(5, 60)
        counts = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(8)}
        batches = packing.plan(counts, capacity)
        assert all(sum(b * n for b, n in mix) <= capacity for _, mix in batches)
        assert {b: sum(t * n for t, mix in batches for x, n in mix if x == b) for b in counts} == counts


def test_packing(spark):
    rng = random.Random(4)
    sizes = [(i, rng.choice([1, 2, 3, 40, 100, 101, 250, 99, 64])) for i in range(500)] + [(500, 0), (501, None), (1, 7)]
    df = spark.createDataFrame(sizes, "doc_id bigint, tokens bigint")
    rows = packing.pack(spark, df, "doc_id", 100, buckets=4).collect()
    assert sorted(r["doc_id"] for r in rows if r["container_no"] is None) == [500, 501]
    filled = {}
    for r in rows:
        if r["container_no"] is not None:
            filled[r["container_no"]] = filled.get(r["container_no"], 0) + r["tokens"]
    assert max(filled.values()) <= 100 and sum(filled.values()) == sum(s or 0 for _, s in sizes)
    cut = [r for r in rows if r["piece_no"] > 0]
    assert {s for i, s in sizes if i in {r["doc_id"] for r in cut}} == {101, 250}
    assert packing.pack(spark, df.limit(0), "doc_id", 100).count() == 0
    with pytest.raises(ValueError):
        packing.pack_all(spark, df, "doc_id", spark.createDataFrame([("c", 0)], "container string, capacity_tokens int"))


def test_running_sums_in_parts(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("g"), (F.col("id") % 7).alias("w"))
    whole = {r["id"]: r["_at"] for r in running.running(df, "g", ["id"], F.col("w"), part_rows=50).collect()}
    for g in (0, 1):
        own = sorted((at, i % 7) for i, at in whole.items() if (i % 3 == 0) == bool(g))
        total = 0
        for at, w in own:
            assert at == total or w == 0 and at <= total
            total = max(total, at + w)


def test_mixing(spark):
    rng = random.Random(6)
    sizes = [(i, "big" if i % 3 else "small", rng.randint(5, 50)) for i in range(900)] + [(900, None, 9), (901, "big", 0), (902, "big", None)]
    df = spark.createDataFrame(sizes, "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("m", 1.0, "big", 0.5, 2), ("m", 1.0, "small", 0.4, 2), ("m", 1.0, "none", 0.1, 3), ("n", 0.2, "small", 1.0, 1)], "mix_name string, budget_share double, source string, target_share double, max_repeats int")
    rows = mixing.mix(df, "doc_id", targets).collect()
    total = sum(s[2] or 0 for s in sizes if s[1])
    for mix, source, share, budget in (("m", "big", 0.5, 1.0), ("m", "small", 0.4, 1.0), ("n", "small", 1.0, 0.2)):
        own = [r for r in rows if r["mix_name"] == mix and r["source"] == source]
        assert abs(sum(r["tokens"] for r in own) - share * budget * total) <= 50
        assert len({(r["doc_id"], r["repeat_no"]) for r in own}) == len(own) and max(r["repeat_no"] for r in own) <= 1
    m = [r for r in rows if r["mix_name"] == "m"]
    assert [r["position"] for r in m] == sorted(r["position"] for r in m)
    early = [r["source"] for r in m[: len(m) // 4]]
    late = [r["source"] for r in m[-len(m) // 4 :]]
    assert early.count("big") / len(early) > late.count("big") / len(late)  # the curriculum moves to the small source
    reached = {(r["mix_name"], r["source"]): r for r in mixing.shares(mixing.mix(df, "doc_id", targets), targets).collect()}
    assert reached["m", "none"]["tokens"] == 0 and abs(sum(r["actual_share"] for k, r in reached.items() if k[0] == "m") - 1) < 1e-9
    assert mixing.mix(df.limit(0), "doc_id", targets).count() == 0


def test_tokens_of_long_texts_are_those_of_the_whole(spark):
    long = ("word and more 123 " * 9000).strip()
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, long), (5, "x" * 120_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["tokens"] for r in tokens.sized(df, ["doc_id"]).collect()}
    whole = tokens._encoding(tokens.VOCABULARY, tokens.PATTERN)
    assert got[2] is None and got[3] == 0
    assert got[1] == len(whole.encode_ordinary("Hello world")) and got[4] == len(whole.encode_ordinary(long)) and got[5] == len(whole.encode_ordinary("x" * 120_000))


def documents(spark, texts, titles=None):
    return spark.createDataFrame([(i, t, titles[i] if titles else f"title {i}") for i, t in enumerate(texts)], "doc_id bigint, text string, title string")


def speech(i):
    """A text of its own: no two share a sentence."""
    pick = lambda words, k: words[(i // k) % len(words)]
    a, b, c = ("harbour", "river", "border", "coast", "island"), ("report", "treaty", "survey", "audit"), ("members", "observers", "ministers")
    return f"The committee on the {pick(a, 1)} has taken note of the {pick(b, 5)} and will return to it with the {pick(c, 20)} in part {i}. We thank all of the {pick(c, 1)} for the {pick(b, 3)} of the {pick(a, 4)} and hope that the work will go on. The access of the public to the record was denied to nobody, and the page of the minutes that was found to be missing has been put back by the {pick(c, 7)} without delay. It was said in the debate that the session on the {pick(a, 2)} expired before the vote could be held, which nobody of the {pick(c, 3)} has forgotten since. The text of the {pick(b, 2)} remains open until the next {pick(b, 4)} of the {pick(a, 3)} has been read, and the members have been asked to send their remarks on it."


def test_residue_slots_and_blanks(spark):
    slots = [f"{speech(k)} Statement by {w.format(n)} at the Forum." for k, (w, n) in enumerate((w, n) for w in ("[insert {} here]", "<{} goes here>", "({} TO BE CONFIRMED)") for n in ("speaker", "country", "title"))]
    alone = [f"{speech(20)} Signed by {{{{speaker_name}}}}.", "Forum: %%forum_id%%", f"We thank ${{chair}} and {speech(21)}"]
    blanks = ["Capital: ____\nSignature ????", "Capital ......\nSignature: [  ]", "Date: ____; Seat no. ????", "Date [ ]\nSeat no.: ____", "Capital TBD\nDate: TBD\nSignature TBD"]
    fine = [speech(22), speech(23) + " The text [both options] in paragraph 2 remains open (see annex 3).", speech(24) + " We insert [see M/RS/69/CRP.14], and we did so.", "", "  ", "Capital: Jasabury\nDate: 3 May"]
    given = slots + alone + blanks + fine
    df = documents(spark, given).withColumn("kind", F.lit(1))
    df = df.unionByName(spark.createDataFrame([(99, None, None, 1), (99, None, None, 1)], df.schema))
    assert ids(residue.residue_rows(df), "doc_id") == [*range(len(slots + alone + blanks))]
    assert ids(residue.without_residue(df), "doc_id") == [*range(len(slots + alone + blanks), len(given)), 99, 99]
    assert residue.residue_rows(df.limit(0)).count() == 0


def test_pages_of_a_template_are_aligned(spark):
    noun = ("page", "file", "record", "transcript", "statement")
    pages = [f"Error {400 + i}. The {n} you asked for could not be shown." for i, n in enumerate(noun)] + [f"Beitrag {i} wurde zurückgezogen.\nBitte wenden Sie sich an das Archiv." for i in range(4)]
    inline = [speech(40) + " Error 503. The lecture you asked for could not be shown."]
    texts = [speech(i) for i in range(40)]
    said = "Access was denied to 5 inspectors at the northern gate."
    plain = ["We listened with attention to your address, Madam President.", "The record of the vote could not be found in the annex.", "Please wait for the interpretation before you take the floor.", "Developing countries need stronger support.", "Wealthy donors promised additional funding yesterday."]
    fine = [f"{t} {said}" for t in texts[:9]] + [f"{t} {x}" for t, x in zip(texts[9:], plain * 4)] + texts[29:] + plain
    given = pages + inline + fine
    df = documents(spark, given)
    assert ids(residue.residue_rows(df), "doc_id") == [*range(len(pages + inline))]
    # copies of a short text have one title, or none: no template
    copied = documents(spark, ["A short note on the tides."] * 9 + texts, ["one"] * 5 + [None] * 4 + [str(i) for i in range(40)])
    assert residue.residue_rows(copied).count() == 0
    # a page that a third of all records show
    hot = documents(spark, pages[:1] * 25 + texts)
    assert ids(residue.residue_rows(hot), "doc_id") == [*range(25)]
    assert ids(residue.residue_rows(df.drop("title")), "doc_id") == [*range(len(pages + inline))]


def test_filler(spark):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit") for b in ("em", "um", "ar", "ent", "is")]
    lorem = [" ".join(" ".join(rng.choice(vocabulary) for _ in range(8)).capitalize() + "." for _ in range(9)) for _ in range(5)]
    short = [" ".join(vocabulary[:4]).capitalize() + "."]
    again = ["Write your answer here. " * 6, "Heading two. Sample paragraph.\n" * 5]
    table = "\n".join(f"member {i} | {i * 7} | {i * 3}" for i in range(30))
    given = [*lorem, *short, *again, table, "No. No. No.", *(speech(i) for i in range(30))]
    assert ids(residue.residue_rows(documents(spark, given)), "doc_id") == [*range(8)]


def test_speeches_in_other_languages_stay(spark):
    german = "Herr Präsident, wir danken dem Ausschuss für die Arbeit an dem Bericht und für die Geduld der letzten Wochen. Unsere Delegation unterstützt den Entwurf, weil er die Sicherheit der Häfen stärkt. Die Verhandlungen waren lang, aber sie haben sich gelohnt."
    russian = "Господин Председатель, мы благодарим комитет за работу над докладом и за терпение. Наша делегация поддерживает проект, потому что он укрепляет безопасность портов. Переговоры были долгими, но они того стоили."
    italian = "Signor Presidente, ringraziamo il comitato per il lavoro sul rapporto e per la pazienza. La nostra delegazione sostiene il progetto perché rafforza la sicurezza dei porti. I negoziati sono stati lunghi, ma ne è valsa la pena."
    chinese = "主席先生，我们感谢委员会就报告所做的工作，也感谢大家的耐心。我们代表团支持该草案，因为它加强了港口的安全。"
    assert ids(prose.not_prose(gate(spark, [german, russian, italian, chinese, german.upper(), german.replace(". ", ".\n")]))) == []
    figures = prose.figures(gate(spark, [german]), only=("words", "end_share")).first()
    assert figures["words"] == 40 and figures["end_share"] == 1.0 and "short_share" not in figures
    assert prose.common_words(gate(spark, ["a b b", "b c", None]), most=2) == ["b", "a"]
    assert gate(spark, ["a b x y", "", None]).select(prose.common_share(F.col("Text"), ["b", "a"]).alias("c")).toPandas()["c"].fillna(-1).tolist() == [0.5, 0.0, -1.0]


def test_stored_rules_are_rules():
    assert json.dumps(prose.rules()) and all(name in prose.FIGURES for rule in prose.rules() for name, _, _ in rule["if"])


def canonical_of(spark, values, extra=False):
    names = spark.createDataFrame([("North Dravena", "NOT"), ("South Dravena", "SOT"), ("Corvia", "COV"), ("Corvina", "COI"), ("Łodzavia", "ODA"), ("Quorrala", "QUR"), ("Elavaux", "ELV")], "name string, entry string")
    others = spark.createDataFrame([("Kingdom of Quorrala", "QUR"), ("Келмара", "COV")], "name string, entry string")
    codes = names.select(F.col("entry").alias("name"), "entry")
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_idx bigint, Country string")
    rows = rows.withColumn("value", F.lit("clash")).withColumn("entry", F.lit(1)) if extra else rows
    return {values[r["row_idx"]]: r["entry"] for r in canonical.canonical_rows(rows, "row_idx", "Country", names, others, codes).collect()}


def test_canonical_values(spark):
    decorated = {f"Delegation of {n}": e for n, e in (("North Dravena", "NOT"), ("Corvia", "COV"), ("Corvina", "COI"), ("Quorrala", "QUR"))}
    given = {"corvia": "COV", "CORVINA ": "COI", "Corvna": "COI", "Lodzavia": "ODA", "≈Åodzavia": "ODA", "Łоdzaviа": "ODA", "QUR": "QUR", "Quorala": "QUR", "S. Dravena": "SOT", "кelmapa": "NONE", "Келмара": "COV", "Quorrala (QUR)": "QUR", "�lavaux": "ELV", "University of X": "NONE", "--": "NONE", "x" * 5000: "NONE", "item 12": "NONE", "Kingdom of Quorrala": "QUR", **decorated}
    assert canonical_of(spark, [*given, None, "", "  ", "Corvia"], extra=True) == given
    assert canonical_of(spark, ["Corvia", None]) == {}


def test_similarity_join_is_as_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 9))).strip() or "a"
    left, right = {word() for _ in range(120)}, {word() for _ in range(80)}

    def tokens(k):
        seen, out = {}, set()
        for p in zip(f"^{k}$", f"^{k}$"[1:]):
            seen[p] = seen.get(p, 0) + 1
            out.add((p, seen[p]))
        return out

    got = canonical.similar(spark.createDataFrame([(k,) for k in left], "key string"), spark.createDataFrame([(k,) for k in right], "entry_key string"), 0.4)
    want = {(a, b) for a in left for b in right if len(tokens(a) & tokens(b)) / len(tokens(a) | tokens(b)) >= 0.4}
    assert {(r["key"], r["entry_key"]) for r in got.collect()} == want


def test_cuts_hold_their_promises():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["word", " ", ". ", "\n\n", ", ", "é", "é", "x" * 30, "\n"]) for _ in range(rng.randint(0, 200)))
        most = rng.randint(1, 60)
        overlap = rng.randint(0, 70)
        pieces = split.cuts(text, most, overlap)
        o = min(overlap, most - 1)
        assert all(b - a <= most for a, b in pieces) or len(text) <= most
        assert all(x[1] - y[0] == o for x, y in zip(pieces, pieces[1:])) and pieces[0][0] == 0 and pieces[-1][1] == len(text)
        assert all(y[1] > x[1] for x, y in zip(pieces, pieces[1:]))
    assert split.cuts("One two. Three four five", 14, 0) == [(0, 9), (9, 20), (20, 24)]  # the sentence's end, then the last blank
    assert split.cuts("aaaa bbbb cccc", 10, 0) == [(0, 10), (10, 14)]  # of equal ones the right


def test_range_maximum_is_as_brute_force():
    import numpy as np

    values = np.array([random.Random(4).randint(0, 4) for _ in range(120)])
    index = split.RangeMaximum(values, 40)
    for a in range(120):
        for b in range(a, min(120, a + 40)):
            assert index.best(a, b) == max(range(a, b + 1), key=lambda i: (values[i], i))


def test_split_edge_cases(spark):
    rows = spark.createDataFrame([("a", "x" * 25, 10, 3), ("b", None, 10, 3), ("c", "short", 10, 3), ("d", "y" * 5, None, 3), ("e", "z" * 5, 0, 3), ("f", "w" * 25, 10, None), ("a", "x" * 25, 10, 3)], "k string, t string, m int, o int").withColumn("piece", F.lit("clash"))
    got = split.split_oversized(rows, "k", "t", "m", "o").collect()
    assert {r["k"] for r in got} == {"a", "f"} and sum(r["k"] == "a" for r in got) == 8
    assert "".join(r["piece"] for r in sorted((r for r in got if r["k"] == "f"), key=lambda r: r["piece_no"])) == "w" * 25
    assert split.split_oversized(rows.limit(0), "k", "t", "m", "o").count() == 0


def test_usual_forms():
    usual = lookalike.usual_form
    assert usual("Аӏԁеrmаrk") == "Aldermark" and usual("Ｑｕｏ​ｒ") == "Quor" and usual("South Dravena") == "South Dravena"
    assert usual("Čestrova") == "Čestrova" and usual("") == "" and usual("Łodzavia") == "Łodzavia"
    assert usual("Зеленова") == "Зеленова" and usual("Зеленoва") == "Зеленова"  # a Latin o inside a Cyrillic word
    assert usual("नूराबंद") == "नूराबंद" and usual("Işıkeli") == "Işıkeli"
    assert lookalike.skeleton("Аӏԁеrmаrk") == lookalike.skeleton("Aldermark") and lookalike.latin_reading("СОРА") == "COPA"


def test_chains_round_trip():
    for word in ("été", "Жамбелія", "l’accord", "Łodzavia", "«la»"):
        for chain, form in charsets.garbled(word):
            assert form != word
            if chain in ("utf8>cp1252", "utf8>latin-1", "utf8>mac_roman", "utf8>cp437", "utf8>cp850", "utf8>cp1252>utf8>cp1252"):
                assert charsets.restored(form) == word, (chain, form)
    assert charsets.garbled("plain") == [] and charsets.restored("plain") is None and charsets.restored("d’élargir") is None
