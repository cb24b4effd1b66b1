"""Operators: order, merging, hot keys, idempotence, engines."""

from pyspark.sql import functions as F

from gleanery.operators import dedupe, files, pages, record, refresh, signals, summary, versions
from gleanery.operators.labels import add_download_name, add_resource_label
from gleanery.schemas import TABLES, empty_tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_first_wins_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("o"), "id")
    want = rows(dedupe.first_wins(df, ["k"], ["o"]))
    for n in (1, 3, 16):
        assert rows(dedupe.first_wins(df.repartition(n), ["k"], ["o"])) == want
    assert len(want) == 7


def test_first_wins_reduces_before_the_shuffle(spark):
    """A key with a third of all rows is cut down by the map side."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    plan = dedupe.first_wins(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_merge_picks_fields_independently(spark):
    df = spark.createDataFrame(
        [(1, 2, "b", "", None, 5), (1, 1, "", "x", False, None), (1, 3, "c", "y", True, 6), (2, 1, "", "", None, None)],
        "k int, o int, t string, u string, f boolean, n int")
    got = dedupe.merge_duplicates(df, ["k"], ["o"], ["t", "u"], ["f"], ["n"])
    assert rows(got.drop("first_order"), "k") == [(1, "b", "x", 5, True, 3), (2, None, None, None, None, 1)]


def hits(spark, pages_of_ids, total):
    data = [("t", i * 20, p, s, total) for i, page in enumerate(pages_of_ids) for p, s in enumerate(page)]
    return spark.createDataFrame(data, "term string, start bigint, pos bigint, id string, total bigint")


def guard(df):
    return dedupe.page_guards(df, ["term"], "start", "pos", ["id"], "total", 20).first()


def test_guard_stops_at_a_repeated_page(spark):
    got = guard(hits(spark, [["a", "b"], ["c"], ["a", "b"], ["z"]], 99))
    assert (got.guard_triggered, got.guard_start, got.guard_reason) == (True, 40, "repeated_page_signature")


def test_guard_stops_without_new_studies(spark):
    got = guard(hits(spark, [["a", "b"], ["b", "a"], ["z"]], 99))
    assert (got.guard_start, got.guard_reason) == (20, "page_contains_zero_new_studies")


def test_paging_ends_when_all_reported_are_read(spark):
    df = hits(spark, [["a", "b"], ["c"], ["a", "b"]], 3)
    got = guard(df)
    assert (got.guard_triggered, got.stop_start) == (False, 40)
    kept = dedupe.keep_until_stop(df, dedupe.page_guards(
        df, ["term"], "start", "pos", ["id"], "total", 20), ["term"], "start")
    assert kept.count() == 3


def test_no_stop_keeps_everything(spark):
    df = hits(spark, [["a"], ["b"]], 0)
    got = dedupe.search_summary(df, ["term"], "start", "pos", ["id"], "total", 20).first()
    assert (got.total_studies, got.studies_extracted, got.pages_fetched, got.guard_triggered) == (2, 2, 2, False)


def test_running_total_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "PAGES_PER_BLOCK", 2)
    df = hits(spark, [[f"s{i}"] for i in range(9)], 6)
    got = guard(df)
    assert (got.stop_start, got.guard_triggered, got.reported_total) == (120, False, 6)
    got = dedupe.search_summary(df, ["term"], "start", "pos", ["id"], "total", 20).first()
    assert (got.studies_extracted, got.pages_fetched, got.total_studies) == (6, 6, 6)


def test_guards_scan_once_and_shuffle_little(spark):
    pages = dedupe.search_pages(hits(spark, [["a"], ["b"]], 9), ["term"], "start", "pos", ["id"], "total")
    pages.collect()
    plan = pages._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") <= 6 and "Python" not in plan
    guards = dedupe.guard_pages(dedupe.cut_lineage(pages), ["term"], "start", 20)
    plan = guards._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6


def test_row_numbers_are_dense_and_stable(spark):
    df = spark.range(1000).select((F.col("id") * 7919).alias("k"))
    one = {r.k: r.id for r in dedupe.row_numbers(df, ["k"], 16).collect()}
    two = {r.k: r.id for r in dedupe.row_numbers(df.repartition(5), ["k"], 16).collect()}
    assert one == two and sorted(one.values()) == list(range(1, 1001))


def test_description_signal_engines_agree(spark):
    texts = ["In-depth INTERVIEW study", "particle", "nothing", "", None, "cc by-sa atlas.ti"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    terms = ["interview", "in-depth interview", "PAR", "CC BY", "CC BY-SA", "ATLAS.ti", "PAR"]
    fast = signals.description_signal(df, "t", terms)
    slow = signals.description_signal(df, "t", terms, engine="builtin")
    assert rows(fast, "i") == rows(slow, "i")
    got = {r.i: r for r in fast.collect()}
    assert got[0].description_terms == ["in-depth interview", "interview"]
    assert got[1].description_terms == ["PAR"]
    assert got[3].description_reason == got[4].description_reason == "Description missing"
    assert got[2].description_reason == "No qualitative keywords found in description"
    assert got[5].description_terms == ["ATLAS.ti", "CC BY", "CC BY-SA"]


def test_reason_names_ten_terms_and_the_list_all(spark):
    df = spark.createDataFrame([(" ".join(f"w{i:02d}" for i in range(14)),)], "t string")
    got = signals.description_signal(df, "t", [f"w{i:02d}" for i in range(14)]).first()
    assert got.description_reason.endswith("w08, w09") and len(got.description_terms) == 14


def test_word_signal_needs_whole_words(spark):
    df = spark.createDataFrame([("a part",), ("on par, so",)], "t string")
    assert [r.description_signal for r in signals.word_signal(df, "t", ["PAR"]).collect()] == [False, True]


def test_file_words_may_be_many(spark):
    df = spark.createDataFrame([(1, f"w{i:03d}.e{i:03d}") for i in range(0, 200, 7)], "p int, file_name string")
    got = signals.file_signals(df, ["p"], extensions=[f"e{i:03d}" for i in range(200)],
                               words=[f"w{i:03d}" for i in range(200)]).first()
    want = range(0, 200, 7)
    assert got.filename_terms == [f"w{i:03d}" for i in want] and got.extensions == [f"e{i:03d}" for i in want]


def test_file_signal(spark):
    df = spark.createDataFrame(
        [(1, "Interview_1.mp3"), (1, "x.qdpx"), (2, "a.xyz"), (3, "nvivo.bin"), (3, None)], "p int, file_name string")
    fast = signals.file_signals(df, ["p"])
    got = {r.p: r for r in fast.collect()}
    assert got[1].file_reason == "Matched extension(s): mp3, qdpx; matched filename keyword(s): interview"
    assert got[2].file_reason == "No qualitative file signal found"
    assert got[3].file_reason == "Matched filename keyword(s): NVivo" and got[3].file_count == 2


def test_phrase_signals(spark):
    df = spark.createDataFrame(
        [(1, "Open ended responses", "", ["audio"], ["x"]), (2, "", "", ["Narrative-text"], []),
         (3, "", "", [], ["Oral Histories"]), (4, "Focus groups", "focus GROUP", [], [])],
        "i int, s string, a string, k array<string>, m array<string>")
    got = {r.i: r for r in signals.phrase_signals(df, "s", "a", "k", "m").collect()}
    assert got[1].decision_reason == "no_enabled_signal_matched:summary+kind+collection"
    assert got[2].decision_reason == "kind_signal_pass" and got[2].kind_matches == ["text", "narrative text"]
    assert got[3].decision_reason == "collection_signal_pass"
    assert got[4].decision_reason == "summary_signal_pass" and got[4].summary_text == "Focus groups"
    off = signals.phrase_signals(df, "s", "a", "k", "m", use_kind=False, use_mode=False)
    assert {r.i: r.decision_reason for r in off.collect()}[2] == "no_enabled_signal_matched:summary"


def test_latest_version_takes_fields_from_different_rows(spark):
    df = spark.createDataFrame(
        [(1, 1, "2020", "V1", "f1"), (1, 2, "2021", "", "f2"), (1, 3, "2022", "V3", None), (2, 4, None, "", None)],
        "p int, k int, d string, version string, download_version_folder string")
    got = versions.latest_version_info(df, "p", "d", "k")
    assert rows(got, "p") == [(1, "V3", "f2"), (2, None, None)]


def test_labels(spark):
    df = spark.createDataFrame([("Documentation [PDF] Report &amp; more",), ("SPSS Setup",), ("metrics",), ("R",)], "l string")
    got = {r.raw_label: r for r in add_resource_label(df, "l").collect()}
    assert got["Documentation [PDF] Report & more"].file_name == "Report_more.pdf"
    assert got["SPSS Setup"].file_category == "setup" and got["SPSS Setup"].file_extension == "sps"
    assert got["metrics"].file_category == "other" and got["R"].file_category == "data"
    assert add_download_name(df, "l", "n").first().n == "Report__amp__more.pdf"


def test_final_status_ranking(spark):
    df = spark.createDataFrame([(1, "FAILED_TOO_LARGE"), (1, "FAILED_LOGIN_REQUIRED"), (2, "SUCCEEDED"), (2, "x"), (3, "x")],
                               "p int, status string")
    assert rows(summary.final_status(df, ["p"]).drop("file_rows"), "p") == [
        (1, "FAILED_LOGIN_REQUIRED"), (2, "SUCCEEDED"), (3, "FAILED_SERVER_UNRESPONSIVE")]


def test_refresh_is_idempotent_and_deletes(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (3, "c")], "project_key long, v string")
    seen = spark.createDataFrame([(2,), (3,)], "project_key long")
    new = spark.createDataFrame([(3, "n")], "project_key long, v string")
    once = refresh.refresh(stored, seen, new)
    assert rows(once) == [(1, "a"), (3, "n")]
    assert rows(refresh.refresh(once, seen, new)) == rows(once)


def test_stored_refresh_empties_a_bucket(spark, tmp_path):
    schema = TABLES["keywords"]
    path = str(tmp_path / "keywords")
    data = [(i, i, f"k{i}") for i in range(1, 30)]
    refresh.create_table(spark.createDataFrame(data, schema), path, 4)
    seen = spark.createDataFrame([(i,) for i in range(1, 30)], "project_key long")
    new = spark.createDataFrame([(7, 7, "new")], schema)
    for _ in range(2):
        refresh.refresh_path(spark, path, schema, seen, new, 4)
        assert rows(refresh.read_table(spark, path, schema)) == [(7, 7, "new")]


def test_empty_tables_have_the_stored_schemas(spark):
    tables = empty_tables(spark)
    assert len(tables) == 7 and all(t.schema.names == TABLES[n].names for n, t in tables.items())


def test_tree_survives_bad_nesting(spark):
    html = "<div id=a><p>one<p>two<b>x</div></b>tail<br><script>var a='</p>';</script></p>"
    tree = pages.parse_pages(spark.createDataFrame([(1, html)], "page_id int, html string"))
    row = tree.first()
    assert row.texts == ["one", "two", "x", "tail"] and row.scripts == ["var a='</p>';"]
    assert [e.tag for e in row.elems] == ["div", "p", "p", "b", "br", "script"]
    got = tree.select(F.transform(pages.by_tag("div"), pages.inner_text).alias("t")).first().t
    assert got == ["one two x"]


def test_null_page(spark):
    tree = pages.parse_pages(spark.createDataFrame([(1, None)], "page_id int, html string"))
    assert tree.first().elems == []


def test_script_assignments(spark):
    js = "var a = {\"k\": \"x;y\", \"l\": [1,2]}; variables.b = 'it\\'s; ok'; var c = f(1; 2)\nvar a = 3;"
    html = f"<script>{js}</script>"
    tree = pages.parse_pages(spark.createDataFrame([(1, html)], "page_id int, html string"))
    got = {r.name: r.value for r in pages.script_variables(tree, "page_id").collect()}
    assert got["a"] == "3" and got["b"] == "'it\\'s; ok'" and got["c"].startswith("f(1; 2)")


def test_package_formats(value):
    assert value(files.package_formats(F.array(F.lit("SAS"), F.lit("X"))))[:3] == ["SAS", "X", "Qualitative Data"]


def test_compact_document_and_defaults(spark):
    df = spark.createDataFrame([("", "x", [], False, 0)], "a string, b string, c array<string>, d boolean, e int")
    assert df.select(record.compact_document(df).alias("j")).first().j == '{"b":"x","d":false,"e":0}'
    assert record.with_defaults(df, {"b": "no", "z": "1"}).first().asDict()["z"] == "1"


def test_scalars_follow_precedence(spark):
    facts = spark.createDataFrame([
        ("1", 0, "page", "title", 0, "Page"), ("1", 1, "meta", "og:title", 0, "Og"),
        ("1", 2, "variable", "title", 0, "Second"), ("1", 1, "variable", "title", 0, "First"),
        ("1", 0, "jsonld", "name", 0, "  "), ("2", 0, "page", "title", 0, "Only"),
        ("1", 0, "section", "Topic", 1, "b"), ("1", 0, "inline", "topic", 0, "a"), ("1", 1, "section", "Topic", 0, "a"),
    ], "study_id string, page_ord long, source string, name string, place long, value string")
    got = {r.study_id: r for r in record.resolve_scalars(facts, "icpsr").collect()}
    assert got["1"].title == "Second" and got["2"].title == "Only" and got["2"].doi == ""
    topics = record.resolve_lists(facts, "icpsr").filter("field = 'topics'").orderBy("order")
    assert [r.value for r in topics.collect()] == ["a", "b"]


def test_folder_profile_splits_and_maps(spark):
    facts = spark.createDataFrame([
        ("1", 0, "panel", "Scope of Project/Subject Terms", 0, "b; a"), ("1", 0, "meta", "DC.publisher", 0, "icpsr"),
        ("1", 0, "panel", "Scope of Project/Time Period(s)", 0, "3/2001 - 4/2002"),
    ], "study_id string, page_ord long, source string, name string, place long, value string")
    got = {(r.field, r.value) for r in record.resolve_lists(facts, "datalumos").collect()}
    assert {("subjects", "a"), ("keywords", "b"), ("temporal_coverage", "2001-03 -- 2002-04"),
            ("distributors", "Inter-university Consortium for Political and Social Research (ICPSR)")} <= got


def folder_page(spark, n):
    rows = "".join(f'<tr><td><a href="?path=/d/f{i}.txt">F{i}</a></td><td>x</td><td>{i} B</td><td>2024</td></tr>'
                   for i in range(n))
    html = f'<html><body><table class="table"><tbody>{rows}</tbody></table></body></html>'
    df = spark.createDataFrame([(1, "https://h/p", html)], "page_id int, url string, html string")
    return pages.parse_pages(df)


def test_a_folder_listing_costs_as_much_as_it_is_long(spark):
    import time

    taken = {}
    for n in (20, 500, 2000):
        start = time.perf_counter()
        assert pages.folder_table(folder_page(spark, n), "page_id").count() == n
        taken[n] = time.perf_counter() - start
    assert taken[2000] < 8 * taken[500] + 2


def test_sections_end_at_the_next_heading_of_their_parent(spark):
    html = ("<div><h3>A</h3><p>one</p><div><h3>inner</h3><p>deep</p></div><p>two</p><h3>B</h3><p>three</p></div>"
            "<h3>C</h3><p>four</p>")
    tree = pages.parse_pages(spark.createDataFrame([(1, html)], "page_id int, html string"))
    got = {(r.label, r.value) for r in pages.nearby_sections(tree, "page_id").collect()}
    assert got == {("A", "one"), ("A", "inner deep"), ("A", "two"), ("inner", "deep"), ("B", "three"), ("C", "four")}


def test_a_dictionary_table_finds_what_the_automaton_finds(spark):
    import random

    from pyspark.sql import functions as F

    from gleanery.operators import signals

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé İ") for _ in range(n))
    texts = [(i, " ".join(word(rng.randint(1, 9)) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    texts += [(500, None), (501, ""), (502, "ABCA bca \U0001F600x")]
    terms = sorted({word(rng.randint(1, 7)).strip() for _ in range(300)} | {"", "bca \U0001F600", "x", "not there at all"})
    docs = spark.createDataFrame(texts, "id int, text string").repartition(5)
    table = spark.createDataFrame([(t,) for t in [*terms, "x"]], "t string")
    got = sorted((r.id, r.term) for r in signals.dictionary_hits(docs, ["id"], "text", table, "t").collect())
    low = {r.id: r.low for r in docs.select("id", F.lower("text").alias("low")).collect()}
    folded = {r.t: r.low for r in table.select("t", F.lower("t").alias("low")).collect()}
    assert got == sorted((i, t) for i, text in low.items() for t in terms if t and text is not None and folded[t] in text)
    assert signals.dictionary_hits(docs, ["id"], "text", table.limit(0), "t").collect() == []
