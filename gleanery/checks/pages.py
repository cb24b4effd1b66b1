"""Queries over captured pages: the given ones, and pages Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.checks import query
from gleanery.checks.scalars import SPACES
from gleanery.fixtures import spread, table
from gleanery.operators import pages


def captured(spark, d):
    return spread(table(spark, d, "pages"), "page_id")


def parsed(spark, d):
    return pages.parse_pages(captured(spark, d))


_DECODED = ("replace(replace(replace(replace({c}, '&quot;', '\"'), '&copy;', '©'), "
            "'&middot;', '·'), '&amp;', '&')")
_VISIBLE = ("regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), "
            "'(?is)<(?:script|style)>.*?</(?:script|style)>', ' ', 'g'), '(?s)<[/!a-zA-Z][^>]*>', ' ', 'g')")
VISIBLE = f"trim(regexp_replace({_DECODED.format(c=_VISIBLE)}, '{SPACES}', ' ', 'g'))"
_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"


@query("visible_text", f"""
    SELECT page_id, md5({VISIBLE}) AS digest,
           trim(regexp_replace({_DECODED.format(c=_TITLE)}, '{SPACES}', ' ', 'g')) AS title
    FROM pages""")
def _(spark, d):
    from gleanery.functions.text import visible_text

    return captured(spark, d).select(
        "page_id", F.md5(visible_text("html")).alias("digest"),
        pages.page_title("html").alias("title"))


@query("page_states", f"""
    SELECT page_id, length(html) >= 1500 AND contains(lower(html), '<html')
               AND contains(lower(html), '<title') AS usable,
           false AS search_page, false AS degraded, false AS inventory,
           contains(lower(url), '/terms') OR regexp_matches(lower({VISIBLE}),
               'terms of use|if you agree to them|by clicking on the|you agree to the following conditions|disagree')
               AS terms_page,
           regexp_matches(lower(url), 'login|signin|sign-in|openid-connect|oauth') AS login_page
    FROM pages""")
def _(spark, d):
    return pages.page_states(captured(spark, d)).drop("url", "html")


@query("page_links", r"""
    SELECT page_id, href, regexp_extract(url, '^[^/]*//[^/?#]*') || href AS absolute,
           count(*) AS n
    FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href
          FROM pages) GROUP BY ALL""")
def _(spark, d):
    found = pages.links(parsed(spark, d), "page_id")
    return found.groupBy("page_id", "href", "absolute").agg(F.count(F.lit(1)).alias("n"))


@query("page_actions", f"""
    SELECT page_id, contains(lower(v), 'documentation only') AS documentation_only_download,
           contains(lower(v), 'access restricted data') AS access_restricted_data_button,
           regexp_matches(lower(v), '\\banalyze online\\b') AS analyze_online,
           len(regexp_extract_all(html, '<a href=')) AS controls
    FROM (SELECT page_id, html, {VISIBLE} AS v FROM pages)""".replace("\\\\", "\\"))
def _(spark, d):
    return pages.action_signals(parsed(spark, d), "page_id")


# ---------------------------------------------------------------- pages written from tables

def _html(spark, d, *parts):
    """One page per customer: the parts are expressions over c_custkey, c_name, c_mktsegment."""
    rows = table(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    body = F.concat(F.lit("<html><head><title>Study "), k, F.lit("</title>"),
                    *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("</body></html>"))
    return spread(rows, "c_custkey").select(
        F.col("c_custkey").alias("page_id"),
        F.concat(F.lit("https://repo.example.org/datalumos/project/"), k,
                 F.lit("/version/V1/view?path=/d&type=folder")).alias("url"), body.alias("html"))


def study_page(spark, d):
    k, name = F.col("c_custkey").cast("string"), F.col("c_name")
    odd = F.col("c_custkey") % 2 == 1
    return _html(
        spark, d,
        '<meta name="DC.title" content="Meta ', k, '"><meta content="x&amp;y" property=\'og:title\'>',
        '<meta name="DC.title" content=" Meta  ', k, '"><meta http-equiv=refresh content=5>',
        '<script type="application/ld+json">{"@type":"Other"}</script>',
        '<script type="application/ld+json">', F.when(odd, F.lit("[")).otherwise(F.lit("")),
        '{"@type":"Dataset","name":"', name, '","version":"V', (F.col("c_custkey") % 4).cast("string"),
        '","creator":[{"name":"', name, '","affiliation":{"name":"U1"}},',
        '{"name":"Second","affiliation":["U2","U1"]}],"identifier":{"url":"10.3886/S', k, '"},',
        '"funding":[{"funder":{"name":"F1"},"identifier":"', k, '","display":"D"}],',
        '"distribution":[{"fileFormat":"SAS","contentURL":"u","encodingFormat":"zip"},{"fileFormat":""}],',
        '"keywords":["a","b","a"],"datePublished":"2024-01-01"}',
        F.when(odd, F.lit("]")).otherwise(F.lit("")), '</script>',
        '<script>var metadata = {"title":"Inline; ', k, '","fundingSources":[{"funderName":"F1","grantNo":"',
        k, '","display":"Inline"},{"funderName":"F2"}]}; variables.studyId = ', k,
        '; var hits = {"response":{"numFound":', k, ',"docs":[{"TITLE":"Paper ', k,
        '","DOI":"10.1/p"},{"YEAR_PUB":"2001"}]}}; var text = "a;b";</script></head><body>',
        '<div id="box"><h3 class="metadata-field x">Summary View help for it</h3> bare ', k,
        '<p>Para <b>', F.col("c_mktsegment"), '</b></p><span>hide</span>',
        '<h3 class="metadata-field">Universe</h3><p>All</p><p>All</p></div>',
        '<h2>Notes</h2><p>n1</p><p>n2</p><p>n3</p><p>n4</p><p>n5</p><p>n6</p><p>n7</p><h4>End</h4>',
        '<div class="menu"><a id="summaryLink" href="summary?x=1">Summary tab</a>',
        F.when(odd, F.lit('<button title="Go">Access Restricted Data</button>')).otherwise(
            F.lit('<input value="Documentation Only" type=submit>')),
        '<a href="/files/r', k, '.pdf">Report</a><a href="/files/r', k, '.pdf">Again</a>',
        '<a href="/x/cite">Cite download</a></div>',
        '<div id="quickDownload"><a>SAS</a><a>Stata</a></div>',
        '<table id="data-doc"><tbody><tr class="row dataset-2"><td>DS2 Data ', k, '</td><td>1 MB</td>',
        '<td><ul class="dropdown-menu"><li><a>Documentation [PDF] Report</a></li></ul></td>',
        '<td><ul class="dropdown-menu"><li><a>Documentation [PDF] Report</a></li>',
        '<li><a>Stata</a></li><li><a>Download</a></li></ul></td></tr></tbody></table>')


def study(spark, d):
    return pages.parse_pages(study_page(spark, d))


@query("meta_tags", """
    SELECT c_custkey AS page_id, name, value, place FROM customer, (SELECT
        unnest(['DC.title', 'og:title', 'refresh']) AS name, unnest([0, 1, 2]) AS i,
        CAST(unnest([0, 1, 3]) AS BIGINT) AS place),
        LATERAL (SELECT CASE i WHEN 0 THEN 'Meta ' || CAST(c_custkey AS VARCHAR) WHEN 1 THEN 'x&y'
                        ELSE '5' END AS value)""")
def _(spark, d):
    return pages.meta_tags(study_page(spark, d), "page_id")


@query("json_ld", """
    SELECT c_custkey AS page_id, c_name AS name, 'V' || CAST(c_custkey % 4 AS VARCHAR) AS version,
           '10.3886/S' || CAST(c_custkey AS VARCHAR) AS identifier, CAST(2 AS BIGINT) AS creators
    FROM customer""")
def _(spark, d):
    get = lambda p: F.try_variant_get("v", p, "string")
    return study_page(spark, d).withColumn("v", pages.json_ld("html")).select(
        "page_id", get("$.name").alias("name"), get("$.version").alias("version"),
        get("$.identifier.url").alias("identifier"),
        F.size(F.try_variant_get("v", "$.creator", "array<variant>")).cast("bigint")
        .alias("creators"))


@query("headed_sections", """
    SELECT c_custkey AS page_id, label, place, CASE label WHEN 'Universe' THEN 'All' ELSE
        CASE place WHEN 0 THEN 'bare ' || CAST(c_custkey AS VARCHAR)
             ELSE 'Para ' || c_mktsegment END END AS value
    FROM customer, (SELECT unnest(['Summary', 'Summary', 'Universe']) AS label,
                           CAST(unnest([0, 1, 0]) AS BIGINT) AS place)""")
def _(spark, d):
    return pages.headed_sections(study(spark, d), "page_id")


@query("nearby_sections", """
    SELECT c_custkey AS page_id, label, place, value
    FROM customer, (SELECT 'Notes' AS label, CAST(unnest([0, 1, 2, 3, 4, 5]) AS BIGINT) AS place,
                           unnest(['n1', 'n2', 'n3', 'n4', 'n5', 'n6']) AS value)""")
def _(spark, d):
    return pages.nearby_sections(study(spark, d), "page_id").filter("label = 'Notes'")


@query("study_actions", """
    SELECT c_custkey AS page_id, c_custkey % 2 = 0 AS documentation_only_download,
           c_custkey % 2 = 1 AS access_restricted_data_button, false AS analyze_online,
           CAST(7 AS BIGINT) + 4 AS controls FROM customer""")
def _(spark, d):
    return pages.action_signals(study(spark, d), "page_id", study_rules=True)


@query("action_texts", """
    SELECT c_custkey AS page_id, label FROM customer, (SELECT unnest(['Summary tab', 'Report', 'Again',
        'Cite download', 'SAS', 'Stata', 'Documentation [PDF] Report', 'Download']) AS label)
    UNION ALL SELECT c_custkey, CASE c_custkey % 2 WHEN 1 THEN 'Access Restricted Data'
                                ELSE 'Documentation Only' END FROM customer""")
def _(spark, d):
    return pages.action_texts(study(spark, d), "page_id").select("page_id", "label")


@query("tab_urls", """
    SELECT c_custkey AS page_id, 'summary' AS page_name,
           'https://repo.example.org/datalumos/project/' || CAST(c_custkey AS VARCHAR)
               || '/version/V1/summary?x=1' AS page_url FROM customer""")
def _(spark, d):
    return pages.tab_urls(pages.links(study(spark, d), "page_id"), "page_id")


@query("visible_file_links", """
    SELECT c_custkey AS page_id, 'https://repo.example.org/files/r' || k || '.pdf' AS uri,
           'Report' AS title, 'r' || k || '.pdf' AS file_name, 'pdf' AS file_format,
           'Documentation' AS file_content, 'documentation' AS file_category,
           'application/pdf' AS mime_type, '' AS display_size, '' AS last_modified
    FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS k FROM customer)""")
def _(spark, d):
    found = pages.file_links(pages.links(study(spark, d), "page_id"), "page_id")
    return found.drop("place", "context")


@query("dataset_menus", """
    SELECT c_custkey AS page_id, CAST(1 AS BIGINT) AS row_no, CAST(2 AS BIGINT) AS dataset_number,
           'DS2' AS dataset_identifier, 'Data ' || CAST(c_custkey AS VARCHAR) AS dataset_title,
           identity_key, previewable, true AS downloadable, file_name, file_category
    FROM customer, (SELECT unnest(['report|pdf|documentation', 'stata|stata|stata']) AS identity_key,
        unnest([true, false]) AS previewable, unnest(['Report.pdf', 'Stata.stata']) AS file_name,
        unnest(['documentation', 'data']) AS file_category)""")
def _(spark, d):
    merged = pages.merge_menus(pages.dataset_menus(study(spark, d), "page_id"), "page_id")
    return merged.select("page_id", "row_no", "dataset_number", "dataset_identifier",
                         "dataset_title", "identity_key", "previewable", "downloadable",
                         "file_name", "file_category")


@query("download_options", """
    SELECT c_custkey AS page_id, label, source, download_url, 'zip' AS file_type
    FROM customer, (SELECT unnest(['SAS', 'Stata']) AS label,
        unnest(['page_jsonld', 'page_menu_only']) AS source, unnest(['u', '']) AS download_url)""")
def _(spark, d):
    tree = study(spark, d).withColumn("jsonld", pages.json_ld("html"))
    return pages.download_options(tree, "page_id").select(
        "page_id", "label", "source", "download_url", "file_type")


@query("script_variables", """
    SELECT c_custkey AS page_id, name, CASE name WHEN 'studyId' THEN k WHEN 'text' THEN '"a;b"'
               WHEN 'metadata' THEN 'Inline; ' || k ELSE k END AS value
    FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS k FROM customer),
         (SELECT unnest(['metadata', 'studyId', 'hits', 'text']) AS name)""")
def _(spark, d):
    found = pages.script_variables(study(spark, d), "page_id")
    get = lambda p: F.try_variant_get("json", p, "string")
    return found.select("page_id", "name", F.coalesce(
        F.when(F.col("name") == "metadata", get("$.title")),
        F.when(F.col("name") == "hits", get("$.response.numFound")), "value").alias("value"))


@query("variable_counts", "SELECT c_custkey AS page_id, c_custkey AS variable_count FROM customer")
def _(spark, d):
    return study(spark, d).select("page_id", pages.variable_count().alias("variable_count"))


@query("payload_publications", """
    SELECT c_custkey AS page_id, 'Paper ' || CAST(c_custkey AS VARCHAR) AS title,
           '10.1/p' AS doi FROM customer""")
def _(spark, d):
    found = pages.payload_publications(pages.script_variables(study(spark, d), "page_id"), "page_id")
    return found.select("page_id", "title", "doi")


def folder_page(spark, d):
    k = F.col("c_custkey").cast("string")
    even = F.col("c_custkey") % 2 == 0
    return _html(
        spark, d, '</head><body><p><strong>Principal Investigator(s):</strong> ', F.col("c_name"),
        '; Other View help for PI</p><p><strong>Version:</strong> V2</p>',
        '<div class="panel-title">Scope of Project</div>',
        '<div class="panel panel-heading"><strong>Subject Terms:</strong>'
        '<a data-helplink="1">View help for Subject Terms</a> a; b; ', k, '</div>',
        '<div class="panel-title">Methodology</div><div class="panel-heading">'
        '<strong>Related Publications:</strong> ',
        F.when(even, F.concat(F.lit("Paper ("), F.lit("2001"), F.lit(") 10.1234/"), k)).otherwise(
            F.lit("No related publications for this project")), '</div>',
        '<div id="projectCitation">Cite:  ', k, '</div>',
        '<div class="well wide"><span>Terms <b id="projectLicense">CC ', k, '</b></span></div>',
        '<fieldset><h2>Published  Versions</h2><a href="/datalumos/project/1/version/V1/view?s=1">'
        'V1 [3/9/2024]</a><a href="/datalumos/project/1/version/V1/view?s=2">v1 [none]</a>'
        '<a href="/x">Latest</a></fieldset>',
        '<table class="table striped"><tbody><tr><td><a href="?path=/d/sub&type=folder">sub</a></td>'
        '<td></td><td></td><td>2024</td></tr><tr><td><a href="?path=/d/Codebook%20', k,
        '.pdf&type=file&jsessionid=1">Codebook</a></td><td>x</td><td>2 MB</td><td>2024-02-03</td></tr>'
        '<tr><td><a href="?path=/q">short</a></td></tr></tbody></table>',
        '<ul class="pager"><li><a href="?pageSelected=1&path=/d">next</a></li></ul>',
        '<select id="pageIdOptions"><option value="">-</option><option value="3">3</option></select>')


def folder(spark, d):
    return pages.parse_pages(folder_page(spark, d))


BASE = "'https://repo.example.org/datalumos/project/' || CAST(c_custkey AS VARCHAR) || '/version/V1/view'"


@query("header_values", """
    SELECT c_custkey AS page_id, c_name || '; Other' AS principal_investigators, 'V2' AS version
    FROM customer""")
def _(spark, d):
    return pages.header_values(folder(spark, d), "page_id")


@query("panels", """
    SELECT c_custkey AS page_id, 'Scope of Project' AS section, 'Subject Terms' AS label,
           'a; b; ' || CAST(c_custkey AS VARCHAR) AS value FROM customer
    UNION ALL SELECT c_custkey, 'Methodology', 'Related Publications', CASE c_custkey % 2 WHEN 0 THEN
        'Paper (2001) 10.1234/' || CAST(c_custkey AS VARCHAR)
        ELSE 'No related publications for this project' END FROM customer""")
def _(spark, d):
    return pages.panels(folder(spark, d), "page_id").drop("place")


@query("related_publications", """
    SELECT c_custkey AS page_id, 'Paper (2001) 10.1234/' || CAST(c_custkey AS VARCHAR) AS title,
           '2001' AS year, 'https://doi.org/10.1234/' || CAST(c_custkey AS VARCHAR) AS doi
    FROM customer WHERE c_custkey % 2 = 0""")
def _(spark, d):
    return pages.related_publications(folder(spark, d), "page_id").drop("place")


@query("page_blocks", """
    SELECT c_custkey AS page_id, 'Cite: ' || CAST(c_custkey AS VARCHAR) AS citation,
           'Terms CC ' || CAST(c_custkey AS VARCHAR) AS disclaimer, '' AS formats FROM customer""")
def _(spark, d):
    tree = folder(spark, d)
    return tree.select("page_id", pages.project_citation(tree).alias("citation"),
                       pages.access_disclaimer(tree).alias("disclaimer"),
                       F.array_join(pages.page_export_formats(tree), "|").alias("formats"))


@query("published_versions", """
    SELECT c_custkey AS page_id, version, published_date,
           'https://repo.example.org/datalumos/project/1/version/V1/view' AS url
    FROM customer, (SELECT unnest(['V1', 'v1']) AS version,
                           unnest(['2024-03-09', 'none']) AS published_date)""")
def _(spark, d):
    return pages.published_versions(folder(spark, d), "page_id").drop("place")


@query("folder_table", f"""
    SELECT c_custkey AS page_id, is_folder, title, {BASE} || CASE WHEN is_folder THEN
               '?path=%2Fd%2Fsub&type=folder' ELSE '?path=%2Fd%2FCodebook+' ||
               CAST(c_custkey AS VARCHAR) || '.pdf&type=file' END AS uri,
           CASE WHEN is_folder THEN 'sub' ELSE 'Codebook ' || CAST(c_custkey AS VARCHAR) || '.pdf' END
               AS file_name,
           CASE WHEN is_folder THEN 'Other' ELSE 'Codebook' END AS file_content,
           CASE WHEN is_folder THEN 'other' ELSE 'documentation' END AS file_category,
           CASE WHEN is_folder THEN '' ELSE '2 MB' END AS display_size,
           CASE WHEN is_folder THEN '2024' ELSE '2024-02-03' END AS last_modified
    FROM customer, (SELECT unnest([true, false]) AS is_folder, unnest(['sub', 'Codebook']) AS title)""")
def _(spark, d):
    return pages.folder_table(folder(spark, d), "page_id").select(
        "page_id", "is_folder", "title", "uri", "file_name", "file_content", "file_category",
        "display_size", "last_modified")


@query("pager_urls", f"""
    SELECT c_custkey AS page_id, {BASE} || query AS page_url
    FROM customer, (SELECT unnest(['?pageSelected=1&path=%2Fd' , '?pageSelected=3&pageSize=10&path=%2Fd&type=folder'])
                    AS query)""")
def _(spark, d):
    return pages.pager_urls(folder(spark, d), "page_id")


def search_page(spark, d):
    """Search pages with a payload object, a payload list or only links."""
    k = F.col("c_custkey").cast("string")
    doc = F.concat(F.lit('{"ID":'), k, F.lit(',"TITLE":" Study  '), k,
                   F.lit('","AUTHOR":["A","B","A"],"DOI":"10.1/x","URL":""}'))
    two = F.concat(doc, F.lit(',{"ID":"z","AUTHOR_SPLIT":["C"],"URL":"https://h/z"}'))
    kind = F.col("c_custkey") % 3
    script = (
        F.when(kind == 0, F.concat(F.lit("<script>app({searchResults : {\"response\":{\"numFound\":77,\"docs\":["),
                                   two, F.lit("]}}, x: 1})</script>")))
        .when(kind == 1, F.concat(F.lit("<script>window.searchResults = ["), two,
                                  F.lit("]; var y;</script>")))
        .otherwise(F.concat(F.lit('<a href="https://h/web/ICPSR/studies/'), k,
                            F.lit('/summary">Link  study</a><a href="/web/ICPSR/studies/1"></a>'))))
    return _html(spark, d, "</head><body>", script)


@query("search_documents", """
    SELECT c_custkey AS page_id, CASE c_custkey % 3 WHEN 0 THEN CAST(77 AS BIGINT) ELSE 2 END
               AS reported_total, pos,
           CASE pos WHEN 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'z' END AS study_id,
           CASE pos WHEN 0 THEN 'Study ' || CAST(c_custkey AS VARCHAR) ELSE '' END AS title,
           CASE pos WHEN 0 THEN 'A|B' ELSE 'C' END AS author,
           CASE pos WHEN 0 THEN 'https://www.icpsr.umich.edu/web/ICPSR/studies/'
               || CAST(c_custkey AS VARCHAR) ELSE 'https://h/z' END AS url,
           CASE pos WHEN 0 THEN '10.1/x' ELSE '' END AS doi
    FROM customer, (SELECT CAST(unnest([0, 1]) AS BIGINT) AS pos) WHERE c_custkey % 3 <> 2""")
def _(spark, d):
    found = pages.search_documents(search_page(spark, d), ["page_id"])
    return found.withColumn("author", F.array_join("author", "|")).drop(
        "dateupdated", "owner", "archive", "publish_status")


@query("search_link_fallback", """
    SELECT c_custkey AS page_id, CAST(c_custkey AS VARCHAR) AS study_id, 'Link study' AS title,
           'https://h/web/ICPSR/studies/' || CAST(c_custkey AS VARCHAR) || '/summary' AS url
    FROM customer WHERE c_custkey % 3 = 2""")
def _(spark, d):
    tree = pages.parse_pages(search_page(spark, d))
    return pages.study_links(pages.links(tree, "page_id"), "page_id").drop("place")


@query("merged_signals", """
    SELECT study, bool_or(c_custkey % 2 = 0) AS documentation_only_download,
           bool_or(c_custkey % 2 = 1) AS access_restricted_data_button, false AS analyze_online,
           max(c_custkey) AS variable_count
    FROM (SELECT *, c_custkey % 50 AS study FROM customer) GROUP BY study""")
def _(spark, d):
    tree = study(spark, d)
    by_page = lambda df: df.withColumn("study", F.col("page_id") % 50)
    found = pages.action_signals(tree, "page_id", study_rules=True, variable_count=pages.variable_count())
    return pages.merge_page_signals(by_page(found.drop("controls")), "study", "page_id")


@query("search_results", """
    SELECT c_custkey AS page_id, pos, CASE pos WHEN 0 THEN 'https://h/' || CAST(c_custkey AS VARCHAR)
        ELSE c_name END AS study_url
    FROM customer, (SELECT CAST(unnest([0, 1]) AS BIGINT) AS pos)
    WHERE pos = 0 OR c_custkey % 3 = 2""")
def _(spark, d):
    k, name = F.col("c_custkey").cast("string"), F.col("c_name")
    shape = F.col("c_custkey") % 3
    body = (
        F.when(shape == 0, F.concat(F.lit('["https://h/'), k, F.lit('"," "]')))
        .when(shape == 1, F.concat(F.lit('{"items":[],"studies":[{"url":" https://h/'), k,
                                   F.lit('","study_url":""},{"title":"x"},7]}')))
        .otherwise(F.concat(F.lit('[{"persistent_url":"https://h/'), k, F.lit('"},{"project_url":"'),
                            name, F.lit('","url":"u"}]'))))
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("page_id"), F.try_parse_json(body).alias("result"))
    return pages.search_results(rows, ["page_id"])
