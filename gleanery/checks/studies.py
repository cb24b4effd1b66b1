"""Queries over whole studies: several pages each, from capture to stored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.checks import query
from gleanery.checks.documents import RUN
from gleanery.checks.pages import folder_page, search_page, study_page
from gleanery.fixtures import spread, table, view, with_views
from gleanery.functions import codes, text
from gleanery.operators import entries, pages, people, quality, record, summary, versions
from gleanery.plans import page_run

K = "CAST(c_custkey AS VARCHAR)"


def surveys(spark, d):
    """Study pages, every second one of a qualitative kind, with a citation and a second page."""
    odd = F.col("page_id") % 2 == 1
    k = F.col("page_id").cast("string")
    head = F.concat(
        F.lit('<div id="box"><h3 class="metadata-field">Subject Terms</h3><p>s1</p><p>s2</p>'),
        F.when(odd, F.lit('<h3 class="metadata-field">Kind of Data</h3><p>Transcript</p>')).otherwise(""))
    first = study_page(spark, d).select(
        F.concat(F.lit(vocab.STUDY_URL), k).alias("url"), F.lit(0).alias("page_ord"),
        F.replace(F.replace("html", F.lit('<div id="box">'), head), F.lit("<script>var"), F.concat(
            F.lit('<meta name="citation" content="A. B. Archive '), k,
            F.lit(' [distributor], 2024"><script>var'))).alias("html"))
    second = spread(table(spark, d, "customer"), "c_custkey").select(
        F.concat(F.lit(vocab.STUDY_URL), F.col("c_custkey").cast("string"), F.lit("/summary")).alias("url"),
        F.lit(1).alias("page_ord"),
        F.lit('<html><title>t</title><div><h3 class="metadata-field">Subject Terms</h3><p>s2</p><p>s3</p>'
              '<h3 class="metadata-field">Universe</h3><p>None of it</p></div></html>').alias("html"))
    return page_run.route(first.unionByName(second))


def run_of(spark, d):
    return page_run.evaluate(surveys(spark, d), "icpsr", 15, "studies", RUN, "*")


@query("study_merged_lists", f"""
    SELECT {K} AS study_id, field, place, value FROM customer, LATERAL (
        SELECT unnest(['subjects', 'subjects', 'subjects', 'distributors']) AS field,
               CAST(unnest([1, 2, 3, 1]) AS BIGINT) AS place,
               unnest(['s1', 's2', 's3', 'Archive ' || {K}]) AS value)""")
def _(spark, d):
    """Sections of several pages join in first-seen order; a citation names a distributor."""
    from pyspark.sql import Window

    lists = record.resolve_lists(page_run.page_facts(surveys(spark, d), "icpsr"), "icpsr")
    rank = F.row_number().over(Window.partitionBy("study_id", "field").orderBy("order"))
    return lists.filter("field IN ('subjects', 'distributors')").select(
        "study_id", "field", rank.cast("bigint").alias("place"), "value")


@query("study_whole_records", f"""
    SELECT {K} AS study_id, c_name AS title, 'V' || CAST(c_custkey % 4 AS VARCHAR) AS version,
           'https://doi.org/10.3886/S' || {K} AS doi, 'bare ' || {K} AS abstract, 'bare ' || {K} AS summary,
           '2024-01-01' AS published_date, '' AS modified_date, '' AS created_date, 'ICPSR' AS publisher,
           'A. B. Archive ' || {K} || ' [distributor], 2024' AS citation, '' AS purpose,
           '' AS study_design, '' AS sample, 'All' AS universe, '' AS restrictions,
           '{vocab.STUDY_URL}' || {K} || '/terms' AS license, 'Study ' || {K} AS page_title
    FROM customer""")
def _(spark, d):
    """Every single-valued field of a study, its second page read after the first."""
    facts = page_run.page_facts(surveys(spark, d), "icpsr")
    return record.resolve_scalars(facts, "icpsr")


@query("study_funding", f"""
    SELECT {K} AS study_id, funder_name, identifier, grant_number, display, url FROM customer, LATERAL (
        SELECT unnest(['F1', 'F2']) AS funder_name, unnest([{K}, '']) AS identifier,
               unnest([{K}, '']) AS grant_number, unnest(['Inline', '']) AS display,
               unnest(['', '']) AS url)""")
def _(spark, d):
    """Funding read from the JSON-LD and from the inline data of the pages."""
    tree = page_run.page_trees(surveys(spark, d), "icpsr")
    return page_run.study_funding(tree, "icpsr")


@query("page_summary", """
    SELECT count(*) AS total_projects, count(*) AS projects_with_files, CAST(0 AS BIGINT) AS projects_with_no_files,
           count(*) FILTER (c_custkey % 2 = 1) AS identified_qualitative_projects,
           count(*) FILTER (c_custkey % 2 = 1) AS identified_qualitative_with_files,
           CAST(0 AS BIGINT) AS identified_qualitative_with_no_files,
           count(*) FILTER (c_custkey % 2 = 0) AS identified_non_qualitative_projects,
           count(*) FILTER (c_custkey % 2 = 0) AS identified_non_qualitative_with_files,
           CAST(0 AS BIGINT) AS identified_non_qualitative_with_no_files
    FROM customer""")
def _(spark, d):
    return summary.run_counts(run_of(spark, d)["projects"])


def saved(spark, d):
    fetched = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("study_id"), F.lit("Report.pdf").alias("file_name"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt")).withColumn(
        "status", F.when(F.col("attempt") == 2, "SUCCEEDED").otherwise("FAILED_TOO_LARGE"))
    return page_run.catalogue(run_of(spark, d), fetched, RUN, {"files": 500})[1]


_KEPT = f"(SELECT CAST('151' || {K} AS BIGINT) AS project_key, * FROM customer WHERE c_custkey % 2 = 1)"


@query("page_saved_versions", f"""
    SELECT project_key, c_custkey % 4 AS version_id, CAST(c_custkey % 4 AS VARCHAR) || '.0' AS version,
           'RELEASED' AS version_state, '2024-01-01' AS publication_date, '{RUN}' AS download_date,
           'V' || CAST(c_custkey % 4 AS VARCHAR) || '.0' AS download_version_folder
    FROM {_KEPT}""")
def _(spark, d):
    """A study that lists no version has one row, the current one."""
    return saved(spark, d)["project_versions"].select(
        "project_key", "version_id", "version", "version_state", "publication_date", "download_date",
        "download_version_folder")


@query("page_saved_files", f"""
    SELECT project_key, file_name, file_type, status, project_key AS version_project FROM {_KEPT}, (
        SELECT unnest(['Report.pdf', 'Stata.stata']) AS file_name, unnest(['pdf', 'stata']) AS file_type,
               unnest(['SUCCEEDED', 'FAILED_SERVER_UNRESPONSIVE']) AS status)""")
def _(spark, d):
    rows = saved(spark, d)
    owners = rows["project_versions"].select("version_key", F.col("project_key").alias("version_project"))
    return rows["files"].join(owners, "version_key").select(
        "project_key", "file_name", "file_type", "status", "version_project")


@query("page_saved_people", f"""
    SELECT project_key, unnest([c_name, 'Second']) AS name, 'AUTHOR' AS role FROM {_KEPT}""")
def _(spark, d):
    return saved(spark, d)["person_role"].select("project_key", "name", "role")


@query("page_saved_children", f"""
    SELECT project_key, 'keyword' AS kind, unnest(['a', 'b']) AS value FROM {_KEPT}
    UNION ALL SELECT project_key, 'license', '{vocab.STUDY_URL}' || {K} || '/terms' FROM {_KEPT}
    UNION ALL SELECT project_key, 'title', c_name FROM {_KEPT}""")
def _(spark, d):
    rows = saved(spark, d)
    parts = [rows[name].select("project_key", F.lit(kind).alias("kind"), F.col(column).alias("value"))
             for name, kind, column in (("keywords", "keyword", "keyword"),
                                        ("licenses", "license", "license"), ("projects", "title", "title"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def listing(spark, d):
    """Project folder pages under the address of their repository."""
    k = F.col("page_id").cast("string")
    return page_run.route(folder_page(spark, d).select(
        F.concat(F.lit("https://www.datalumos.org/datalumos/project/"), k, F.lit("/version/V1/view"))
        .alias("url"), F.lit(0).alias("page_ord"), "html"))


@query("folder_records", f"""
    SELECT {K} AS study_id, 'Study ' || {K} AS title, 'V2' AS version, '2024-03-09' AS published_date,
           'DataLumos' AS publisher, 'Cite: ' || {K} AS citation, 'Terms CC ' || {K} AS restrictions
    FROM customer""")
def _(spark, d):
    facts = page_run.page_facts(listing(spark, d), "datalumos")
    return record.resolve_scalars(facts, "datalumos").select(
        "study_id", "title", "version", "published_date", "publisher", "citation", "restrictions")


@query("folder_lists", f"""
    SELECT {K} AS study_id, field, value FROM customer, LATERAL (
        SELECT unnest(['authors', 'authors', 'keywords', 'keywords', 'keywords', 'subjects', 'subjects',
                       'subjects']) AS field,
               unnest([c_name, 'Other', 'a', 'b', {K}, 'a', 'b', {K}]) AS value)""")
def _(spark, d):
    facts = page_run.page_facts(listing(spark, d), "datalumos")
    return record.resolve_lists(facts, "datalumos").select("study_id", "field", "value")


@query("folder_files", f"""
    SELECT {K} AS study_id, 'Codebook ' || {K} || '.pdf' AS file_name, 'pdf' AS file_type,
           'documentation' AS file_category FROM customer""")
def _(spark, d):
    found = page_run.page_files(page_run.page_trees(listing(spark, d), "datalumos"), "datalumos")
    return found.drop("uri")


@query("folder_versions", f"""
    SELECT {K} AS study_id, version, publication_date, is_current FROM customer, (
        SELECT unnest(['1.0', '1.0']) AS version, unnest(['2024-03-09', 'none']) AS publication_date,
               unnest([true, false]) AS is_current)""")
def _(spark, d):
    tree = page_run.page_trees(listing(spark, d), "datalumos")
    known = tree.select("study_id", F.lit("V9").alias("project_version"),
                        F.lit("").alias("project_date")).distinct()
    stated = versions.with_unlisted(page_run.listed_versions(tree, "datalumos"), known, "study_id", "place")
    return versions.version_rows(stated, "study_id", "place").select(
        "study_id", "version", "publication_date", "is_current")


@query("open_project_records", f"""
    SELECT {K} AS study_id, c_name AS title, 'V' || CAST(c_custkey % 4 AS VARCHAR) AS version,
           'openICPSR' AS publisher, 'bare ' || {K} AS abstract, 'All' AS universe,
           'r' || {K} || '.pdf' AS file_name FROM customer""")
def _(spark, d):
    """The same pages under the profile of open projects."""
    k = F.col("page_id").cast("string")
    routed = page_run.route(study_page(spark, d).select(
        F.concat(F.lit("https://www.openicpsr.org/openicpsr/project/"), k, F.lit("/version/V1/view"))
        .alias("url"), F.lit(0).alias("page_ord"),
        F.regexp_replace("html", "<h3 class=\"metadata-field x\">Summary View help for it</h3> bare (\\d+)",
                         "<h3>Summary</h3><p>bare $1</p>").alias("html")))
    tree = page_run.page_trees(routed, "openicpsr")
    scalars = record.resolve_scalars(page_run.page_facts(routed, "openicpsr", tree), "openicpsr")
    files = page_run.page_files(tree, "openicpsr").select("study_id", "file_name")
    return scalars.join(files, "study_id").select(
        "study_id", "title", "version", "publisher", "abstract", "universe", "file_name")


def searched(spark, d):
    """Search pages with a payload, with links, or with neither."""
    blank = F.col("page_id") % 7 == 0
    return search_page(spark, d).withColumn(
        "html", F.when(blank, F.lit("<html><body><a href='/about'>About</a></body></html>"))
        .otherwise(F.col("html")))


@query("search_cascade", f"""
    SELECT c_custkey AS page_id, CASE i WHEN 0 THEN {K} ELSE 'z' END AS study_id,
           CASE i WHEN 0 THEN 'Study ' || {K} ELSE '' END AS title,
           CASE i WHEN 0 THEN '{vocab.STUDY_URL}' || {K} ELSE 'https://h/z' END AS url,
           'payload' AS parse_mode
    FROM customer, (SELECT unnest([0, 1]) AS i) WHERE c_custkey % 3 <> 2 AND c_custkey % 7 <> 0
    UNION ALL SELECT c_custkey, {K}, 'Link study', 'https://h/web/ICPSR/studies/' || {K} || '/summary',
           'html_link_fallback' FROM customer WHERE c_custkey % 3 = 2 AND c_custkey % 7 <> 0""")
def _(spark, d):
    return pages.search_cascade(searched(spark, d), "page_id")[0].drop("pos")


@query("search_errors", """
    SELECT c_custkey AS page_id, 'Could not extract search results JSON or fallback study links.' AS reason
    FROM customer WHERE c_custkey % 7 = 0""")
def _(spark, d):
    return pages.search_cascade(searched(spark, d), "page_id")[1]


@query("capture_states", """
    SELECT c_custkey AS page_id, kind = 0 AS search_page, kind = 2 AS degraded, kind = 3 AS inventory,
           kind = 4 AS terms_page, kind = 5 AS login_page, kind = 0 AS usable,
           CASE kind WHEN 6 THEN 'DDI 2.5|DCAT-US 1.1 (beta)' WHEN 7 THEN 'Dublin Core' ELSE '' END AS formats,
           kind = 7 AS analyze_online
    FROM (SELECT *, c_custkey % 8 AS kind FROM customer)""")
def _(spark, d):
    """Every kind of captured page, a positive row for each."""
    kind = F.col("kind")
    body = (
        F.when(kind == 0, F.concat(F.lit("<html><title>t</title>"), F.lit(vocab.SEARCH_MARKERS[1]), F.repeat(F.lit("x "), 800)))
        .when(kind == 1, F.lit(f"<p>{vocab.SEARCH_MARKERS[1]}</p>"))
        .when(kind == 2, F.lit("<p>Error loading remote resources</p>"))
        .when(kind == 3, F.lit('<table id="data-doc"></table>'))
        .when(kind == 4, F.lit("<p>Terms of Use</p>"))
        .when(kind == 6, F.lit('<a title="dcat-us">x</a><p>As DDI 2.5 file</p>'))
        .when(kind == 7, F.lit('<button data-format="oai_dc">Analyze Online</button>'))
        .otherwise(F.lit("<p>plain</p>")))
    captured = table(spark, d, "customer").select(
        F.col("c_custkey").alias("page_id"), (F.col("c_custkey") % 8).alias("kind")).select(
        "page_id", body.alias("html"),
        F.when(kind == 5, F.lit("https://h/login?x")).otherwise(F.lit("https://h/p")).alias("url"))
    states = pages.page_states(captured).select(
        "page_id", "search_page", "degraded", "inventory", "terms_page", "login_page", "usable")
    tree = pages.parse_pages(captured)
    formats = tree.select("page_id", F.array_join(pages.page_export_formats(tree), "|").alias("formats"))
    acts = pages.action_signals(tree, "page_id").select("page_id", "analyze_online")
    return states.join(formats, "page_id").join(acts, "page_id")


@query("stripped_fragments", """
    SELECT doc_id, source || ' x & ' || lang AS bare FROM documents""")
def _(spark, d):
    fragment = F.concat(F.lit("<p>"), F.col("source"), F.lit("<br>x &amp; <b>"), F.col("lang"),
                        F.lit("</b></p><script>if (a < b) no()</script><!-- c > d -->"))
    return table(spark, d, "documents").select("doc_id", text.strip_tags(fragment).alias("bare"))


@query("formats_of_types", """
    SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip' ELSE '' END AS file_format
    FROM part""")
def _(spark, d):
    kind = F.col("p_partkey") % 3
    extension = F.when(kind == 1, F.lit(" ZIP ")).otherwise(F.lit(""))
    mime = F.when(kind < 2, F.lit("application/pdf")).otherwise(F.lit("none/such"))
    return table(spark, d, "part").select(
        "p_partkey", codes.format_of(extension, mime, "datalumos").alias("file_format"))


@query("author_contributors", """
    SELECT c_custkey, c_nationkey AS place, c_name AS name, 'Creator' AS role,
           CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS affiliation FROM customer""")
def _(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("place"), F.concat(F.lit(" "), "c_name").alias("who"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("where_from"))
    return people.author_contributors(rows, "c_custkey", "place", "who", "where_from")


@query("counter_violations", """
    SELECT c_custkey, 'files.summary.raw_entry_count=' || CAST(c_custkey % 4 AS VARCHAR)
               || ' but len(files.raw_files)=2.' AS message
    FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 4 <> 2
    UNION ALL SELECT c_custkey, 'files.summary.data_file_count=3 but len(files.data_files)=1.' FROM customer""")
def _(spark, d):
    declared = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") % 4).alias("raw"),
        F.lit(3).alias("data"), F.lit(2).alias("raw_size"), F.lit(1).alias("data_size"))
    rules = quality.counter_rules(
        {"raw_entry_count": "raw", "data_file_count": "data"},
        {"raw_entry_count": ("raw_files", "raw_size"), "data_file_count": ("data_files", "data_size")})
    return quality.violations(quality.validate(declared, {}, rules), "c_custkey").drop("level")


@query("nested_required", with_views("fx_records", """
    SELECT record_id, field FROM fx_records, LATERAL (SELECT unnest([
        CASE WHEN record_id % 2 = 0 THEN 'identifiers.study_id' END,
        CASE WHEN record_id % 3 = 0 THEN 'provenance.repository' END]) AS field) WHERE field IS NOT NULL"""))
def _(spark, d):
    """Nested fields are checked on their own, whatever the top level holds."""
    n = F.col("record_id")
    filled = {column: F.lit("x") for column in page_run.REQUIRED.values()}
    rows = view(spark, d, "fx_records").select("record_id").withColumns(filled).withColumns({
        "nested_study_id": F.when(n % 2 == 0, F.lit(" ")).otherwise("y"),
        "provenance_repository": F.when(n % 3 != 0, F.lit("z"))})
    checked = quality.validate(rows, page_run.REQUIRED, [])
    return checked.select("record_id", F.explode("missing_required_fields").alias("field"))


@query("entry_identifiers", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'DOI' ELSE 'ark' END AS type,
           CASE WHEN o_orderkey % 2 = 0 THEN 'https://doi.org/10.1234/' || CAST(o_orderkey AS VARCHAR)
                ELSE '10.1234/' || CAST(o_orderkey AS VARCHAR) END AS value,
           CASE WHEN o_orderkey % 2 = 0 THEN 'https://doi.org/10.1234/' || CAST(o_orderkey AS VARCHAR) END AS url
    FROM orders""")
def _(spark, d):
    k = F.col("o_orderkey").cast("string")
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.lit(" DOI ")).otherwise("ark").alias("type"),
        F.concat(F.lit("10.1234/"), k).alias("value"), F.lit(" ").alias("url"))
    return entries.identifiers(rows)


@query("entry_people_and_papers", """
    SELECT c_custkey, c_name AS name, CAST(NULL AS VARCHAR) AS role, 'https://h/x' AS person_url,
           'Paper ' || CAST(c_custkey AS VARCHAR) AS title, 'https://doi.org/10.1234/p' AS doi,
           'A|B' AS authors, CAST(c_custkey AS VARCHAR) AS grant_number FROM customer""")
def _(spark, d):
    k, blank = F.col("c_custkey").cast("string"), F.lit(" ")
    rows = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("  "), "c_name").alias("n"))
    who = entries.contributors(rows.select(
        "c_custkey", F.col("n").alias("name"), blank.alias("role"), blank.alias("affiliation"),
        blank.alias("orcid"), F.lit("HTTPS://h/x#y").alias("url")))
    papers = entries.publications(rows.select(
        "c_custkey", F.concat(F.lit("Paper  "), k).alias("title"), F.lit("10.1234/p").alias("doi"),
        blank.alias("journal"), blank.alias("year"), F.array(F.lit("A "), F.lit(""), F.lit("B"), F.lit("A"))
        .alias("authors"), blank.alias("url"), blank.alias("citation")))
    paid = entries.funding(rows.select(
        "c_custkey", blank.alias("funder_name"), k.alias("identifier"), blank.alias("grant_number"),
        blank.alias("display"), blank.alias("url")))
    return (
        who.select("c_custkey", "name", "role", F.col("url").alias("person_url"))
        .join(papers.select("c_custkey", "title", "doi", F.array_join("authors", "|").alias("authors")), "c_custkey")
        .join(paid.select("c_custkey", "grant_number"), "c_custkey"))


@query("entry_files", with_views("fx_files", """
    SELECT project_id, dataset_number, part_no, uri_no, trim(regexp_replace(file_name, '\\s+', ' ', 'g')) AS file_name,
           'https://h/f' AS uri, CASE part_no % 3 WHEN 0 THEN true WHEN 1 THEN false END AS public,
           0 AS bundles, 1 AS terms FROM fx_files""".replace("\\\\", "\\")))
def _(spark, d):
    part = F.col("part_no") % 3
    rows = view(spark, d, "fx_files").select(
        "project_id", "dataset_number", "part_no", "uri_no",
        F.concat(F.lit(" "), "file_name").alias("file_name"), F.lit("https://h/f#x").alias("uri"),
        F.when(part == 0, F.lit("yes")).when(part == 1, F.lit("0")).otherwise("?").alias("public"),
        F.array(F.lit("hide"), F.lit(" t "), F.lit("t")).alias("terms_of_use"))
    return entries.files(rows).select(
        "project_id", "dataset_number", "part_no", "uri_no", "file_name", "uri", "public",
        F.size("include_in_bundle").alias("bundles"), F.size("terms_of_use").alias("terms"))


@query("listed_page_versions", """
    SELECT c_custkey AS study, CASE WHEN c_custkey % 2 = 0 THEN 'V1' ELSE 'V3' END AS version,
           CASE WHEN c_custkey % 2 = 0 THEN '2024-03-09' ELSE '' END AS published_date,
           'https://h/p/' || CAST(c_custkey AS VARCHAR) AS url, true AS is_current
    FROM customer WHERE c_custkey % 5 <> 1 OR c_custkey % 2 = 0""")
def _(spark, d):
    """Studies without a listed version get their current one, blank URLs their page's."""
    who = table(spark, d, "customer").select(
        F.col("c_custkey").alias("study"), F.concat(F.lit("https://h/p/"), F.col("c_custkey").cast("string"))
        .alias("page_url"), F.when((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 5 != 1), F.lit("V3"))
        .otherwise(" ").alias("current_version"))
    listed = who.filter("study % 2 = 0").select(
        "study", F.lit(0).cast("bigint").alias("place"), F.lit("V1").alias("version"),
        F.lit("3/9/2024").alias("published_date"), F.lit("").alias("url"), "current_version")
    return versions.page_versions(listed, "study", "place", who).drop("place")


