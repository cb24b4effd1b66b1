"""Page extraction: one parse per page, everything else as expressions on its tree.

`parse_pages` adds the tree; the functions below read it inside the row, so a
page is never split over rows until its facts are exploded, and nothing is
shuffled. Flat constructs (title, meta tags, JSON-LD) are read from the markup
with patterns and need no parse at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery import schemas, vocab
from gleanery.functions import codes, labels, urls, workers
from gleanery.functions.lists import clean_list
from gleanery.functions.text import (
    as_col, clean_markup_text, collapse_wide, first_non_blank, is_noise, label_text,
    text_or_null, visible_text,
)


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add the columns elems, texts, owners, scripts of each page."""
    parsed = pages.withColumn("_tree", workers.page_tree(html))
    return parsed.select(*pages.columns, "_tree.*")


# ---------------------------------------------------------------- tree expressions

def inner_text(e: Column) -> Column:
    """Text of an element and everything in it."""
    parts = F.slice(F.col("texts"), e["t0"] + 1, e["t1"] - e["t0"])
    return collapse_wide(F.array_join(parts, " "))


def by_tag(*tags: str) -> Column:
    return F.filter("elems", lambda e: e["tag"].isin(list(tags)))


def has_class(e: Column, name: str) -> Column:
    padded = F.concat(F.lit(" "), F.coalesce(attr(e, "class"), F.lit("")), F.lit(" "))
    return F.regexp_replace(padded, r"\s+", " ").contains(f" {name} ")


def attr(e: Column, name: str) -> Column:
    return F.try_element_at(e["attrs"], F.lit(name))


def inside(e: Column, outer: Column) -> Column:
    return (e["ord"] > outer["ord"]) & (e["ord"] <= outer["last"])


def between(first: Column, last: Column) -> Column:
    """Elements `first` to `last` in document order; `ord` is the place in the array."""
    return F.slice(F.col("elems"), first + 1, F.greatest(last - first + 1, F.lit(0)))


def below(outer: Column, test) -> Column:
    """Elements inside another one that pass a test, without a look at any other element."""
    return F.filter(between(outer["ord"] + 1, outer["last"]), test)


def nearest(e: Column, tags: list[str]) -> Column:
    """Closest enclosing element of one of the tags, NULL if there is none."""
    around = F.filter(F.transform(e["up"], lambda i: F.get(F.col("elems"), i)),
                      lambda o: o["tag"].isin(tags))
    return F.get(around, F.size(around) - 1)


# ---------------------------------------------------------------- flat constructs

def page_title(html) -> Column:
    return clean_markup_text(F.regexp_extract(as_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def looks_usable(html) -> Column:
    """A whole page: has a root, a title and at least 1500 characters."""
    low = F.lower(as_col(html))
    return low.contains("<html") & low.contains("<title") & (F.length(as_col(html)) >= 1500)


def _any_of(hay: Column, words: list[str]) -> Column:
    return hay.rlike("|".join("\\Q" + w.lower() + "\\E" for w in words))


def page_states(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Add what kind of page was captured: usable, search, degraded, inventory, terms, login."""
    low, text = F.lower(html), F.lower(visible_text(html))
    search = _any_of(low, vocab.SEARCH_MARKERS) | low.rlike(r"<a\b[^>]*/web/icpsr/studies/\d")
    return (
        pages.withColumn("_low", low).withColumn("_text", text)
        .withColumn("usable", looks_usable(html))
        .withColumn("search_page", (F.length(html) >= 1000) & search)
        .withColumn("degraded", _any_of(F.col("_low"), vocab.DEGRADED_MARKERS))
        .withColumn("inventory", _any_of(F.col("_low"), vocab.INVENTORY_MARKERS)
                    | _any_of(F.col("_text"), vocab.INVENTORY_MARKERS))
        .withColumn("terms_page", F.lower(url).contains("/terms")
                    | _any_of(F.col("_text"), vocab.TERMS_MARKERS))
        .withColumn("login_page", _any_of(F.lower(url), vocab.LOGIN_MARKERS))
        .drop("_low", "_text")
    )


def json_ld(html) -> Column:
    """First JSON-LD object of type Dataset, alone or in a list, as a variant."""
    bodies = F.regexp_extract_all(
        as_col(html),
        F.lit(r"(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    parsed = F.transform(bodies, lambda b: F.try_parse_json(F.trim(b)))
    listed = F.flatten(F.transform(parsed, lambda v: F.coalesce(
        F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    kind = lambda v: F.try_variant_get(v, "$['@type']", "string")
    return F.get(F.filter(listed, lambda v: kind(v) == "Dataset"), F.lit(0))


def meta_markup(html) -> Column:
    """The meta tags of a page as a list of their markup."""
    return F.regexp_extract_all(as_col(html), F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))


def meta_tags(pages: DataFrame, key: str, html: str = "html", markup: str | None = None) -> DataFrame:
    """Meta values as rows key, name, value in first-seen order, each value once per name.

    `markup` is a column that holds the tags already (`meta_markup`).
    """
    tags = F.col(markup) if markup else meta_markup(html)
    rows = pages.select(key, F.posexplode(tags).alias("_p", "_t"))

    def read(name):
        quoted = rf"(?is)[\s\"']{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
        return F.nullif(F.concat(*[F.regexp_extract("_t", quoted, g) for g in (1, 2, 3)]),
                        F.lit(""))

    return (
        rows.withColumn("name", F.coalesce(read("name"), read("property"), read("http-equiv")))
        .withColumn("_v", read("content"))
        .filter(F.col("name").isNotNull() & F.col("_v").isNotNull())
        .withColumn("value", clean_markup_text("_v")).filter(F.col("value") != "")
        .groupBy(key, "name", "value").agg(F.min("_p").cast("bigint").alias("place"))
    )


# ---------------------------------------------------------------- controls and links

CONTROL_ATTRIBUTES = ["value", "aria-label", "title", "href", "id", "class", "data-title"]


def controls(tree: DataFrame, key: str) -> DataFrame:
    """Links, buttons and inputs, one row each, with all text that describes them."""
    one = lambda e: F.struct(
        e["ord"].alias("ord"), e["tag"].alias("tag"), inner_text(e).alias("text"),
        *[attr(e, a).alias(a.replace("-", "_")) for a in CONTROL_ATTRIBUTES])
    rows = tree.select(key, F.explode(
        F.transform(by_tag("a", "button", "input"), one)).alias("c")).select(key, "c.*")
    parts = [text_or_null(c) for c in (
        "text", "value", "aria_label", "title", "href", "id", "class", "data_title")]
    return (
        rows.withColumn("combined", F.concat_ws(" | ", *parts))
        .filter(F.col("combined") != "")
        .withColumn("label", first_non_blank("text", "value", "aria_label", "title", "id", "href"))
    )


def action_signals(tree: DataFrame, key: str, study_rules: bool = False, **more: Column) -> DataFrame:
    """Three access signals of each page, from its controls and its visible text.

    Study pages also take a restricted-data control that is clearly a control.
    All is read inside the row: no shuffle, and the page is parsed once; `more`
    are further columns of the same row.
    """
    described = F.transform(by_tag("a", "button", "input"), lambda e: F.lower(F.concat_ws(
        " | ", F.nullif(inner_text(e), F.lit("")),
        *[F.nullif(F.trim(attr(e, a)), F.lit("")) for a in CONTROL_ATTRIBUTES])))
    rows = (
        tree.withColumn("_c", F.filter(described, lambda c: c != ""))
        .withColumn("_v", F.lower(visible_text("html")))
    )
    found = lambda pattern: F.exists("_c", lambda c: c.rlike(pattern))
    restricted = found(r"\baccess restricted data\b")
    if study_rules:
        restricted |= F.exists("_c", lambda c: c.rlike(r"\brestricted data\b") & c.rlike(
            "button|btn|link|href|access"))
    return rows.select(
        key,
        (found(r"\bdocumentation only\b") | F.col("_v").contains("documentation only"))
        .alias("documentation_only_download"),
        (restricted | F.col("_v").contains("access restricted data"))
        .alias("access_restricted_data_button"),
        (found(r"\banalyze online\b") | F.col("_v").rlike(r"\banalyze online\b"))
        .alias("analyze_online"),
        F.size("_c").cast("bigint").alias("controls"), *[c.alias(n) for n, c in more.items()])


def merge_page_signals(signals: DataFrame, study: str, page: str) -> DataFrame:
    """Signals and counts of all pages of a study: any page's signal, the largest count.

    `signals` has one row per page, its counts beside its signals; a study
    without any count keeps NULL.
    """
    names = ["documentation_only_download", "access_restricted_data_button", "analyze_online"]
    return signals.groupBy(study).agg(
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in names],
        *[F.max(c).alias(c) for c in signals.columns if c not in (study, page, *names)])


def search_results(found: DataFrame, keep: list[str], result: str = "result") -> DataFrame:
    """Search output of any known shape (variant) to rows with a study URL.

    A list of URLs, a list of objects, or an object that holds such a list under
    items, results, studies or data; an object's URL is the first of six fields.
    """
    paths = ["$", "$.items", "$.results", "$.studies", "$.data"]
    lists = [F.try_variant_get(result, p, "array<variant>") for p in paths]
    chosen = F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])
    fields = ["study_url", "project_url", "url", "source_url", "final_url", "persistent_url"]
    texts = [text_or_null(F.try_variant_get(F.col("v"), f"$.{f}", "string")) for f in fields]
    plain = F.when(F.schema_of_variant(F.col("v")) == "STRING",
                   text_or_null(F.try_variant_get(F.col("v"), "$", "string")))
    return (
        found.select(*keep, F.posexplode(chosen).alias("pos", "v"))
        .select(*keep, F.col("pos").cast("bigint").alias("pos"),
                F.coalesce(plain, *texts).alias("study_url"))
        .filter("study_url IS NOT NULL")
    )


def action_texts(tree: DataFrame, key: str) -> DataFrame:
    """Labels of the controls, each once per page, in order of appearance."""
    return controls(tree, key).groupBy(key, "label").agg(
        F.min("ord").cast("bigint").alias("place"))


def page_export_formats(tree: DataFrame) -> Column:
    """Export formats named in the text or in descriptive attributes of common tags."""
    named = F.transform(by_tag("a", "button", "li", "div", "span"), lambda e: F.concat_ws(
        " \n ", *[attr(e, a) for a in ("href", "title", "aria-label", "data-format", "id", "class")]))
    return labels.export_formats(F.concat_ws(
        " \n ", F.array_join("texts", " "), F.array_join(named, " \n ")))


def links(tree: DataFrame, key: str, url: str = "url") -> DataFrame:
    """All links of a page with their absolute URL, text and enclosing row or block."""
    one = lambda e: F.struct(
        e["ord"].alias("ord"), attr(e, "href").alias("href"), attr(e, "id").alias("id"),
        inner_text(e).alias("title"),
        F.coalesce(nearest(e, ["tr"]), nearest(e, ["div", "li", "section", "article"]))
        .alias("_row"))
    anchors = F.filter(by_tag("a"), lambda e: attr(e, "href").isNotNull())
    rows = tree.withColumn("_l", F.transform(anchors, one))
    described = F.transform("_l", lambda r: F.struct(
        r["ord"].alias("ord"), r["href"].alias("href"), r["id"].alias("id"),
        r["title"].alias("title"),
        collapse_wide(F.array_join(F.transform(
            F.slice(F.col("texts"), r["_row"]["t0"] + 1, r["_row"]["t1"] - r["_row"]["t0"]),
            F.trim), " | ")).alias("context")))
    return (
        rows.select(key, F.col(url).alias("_url"), F.explode(described).alias("l"))
        .select(key, "_url", "l.*")
        .withColumn("absolute", urls.resolve("_url", F.trim("href"))).drop("_url")
    )


TAB_IDS = {
    "summaryLink": "summary", "datadocumentationLink": "datadocumentation",
    "variablesLink": "variables", "publicationsLink": "publications", "exportLink": "export",
}


def tab_urls(page_links: DataFrame, key: str) -> DataFrame:
    """Sub-page URLs by the ids of the tab links; a repeated id keeps the last link."""
    return (
        page_links.filter(F.col("id").isin(list(TAB_IDS)))
        .withColumn("page_name", codes.lookup(TAB_IDS, F.col("id")))
        .groupBy(key, "page_name").agg(F.max_by("absolute", "ord").alias("page_url"))
    )


def file_links(page_links: DataFrame, key: str) -> DataFrame:
    """Links that stand for files, each absolute URL once per page, with what surrounds them."""
    hay = F.lower(F.concat_ws(" ", "href", "title"))
    chosen = (
        page_links.withColumn("_h", hay)
        .filter(~_any_of(F.col("_h"), vocab.FILE_LINK_SKIP)
                & F.col("_h").rlike(vocab.FILE_LINK_ACCEPT))
        .groupBy(key, F.col("absolute").alias("uri"))
        .agg(F.min_by(F.struct("title", "context"), "ord").alias("_l"),
             F.min("ord").cast("bigint").alias("place"))
        .select(key, "uri", "place", "_l.*")
    )
    kind = r"(?i)\b(pdf|docx?|zip|csv|txt|xlsx?|sav|dta|rda|sas|sps|dct|do)\b"
    date = r"(?i)\b(\d{4}-\d{2}-\d{2}|\w+\s+\d{1,2},\s+\d{4}|\d{1,2}/\d{1,2}/\d{2,4})\b"
    return (
        chosen.withColumn("file_name", urls.url_file_name("uri"))
        .withColumn("_e", urls.name_extension(F.col("file_name")))
        .withColumn("file_format", F.when(F.col("_e") != "", F.col("_e")).otherwise(
            F.lower(F.regexp_extract("context", kind, 1))))
        .withColumn("title", F.when(F.col("title") != "", F.col("title"))
                    .otherwise(F.col("file_name")))
        .withColumn("file_content",
                    labels.open_file_content("title", "uri", "context", F.col("_e")))
        .withColumn("file_category",
                    labels.file_category("file_content", "file_format", "openicpsr"))
        .withColumn("mime_type", codes.mime_type("_e", "openicpsr", declared="file_format"))
        .withColumn("display_size", F.regexp_extract(
            "context", r"(?i)\b\d+(?:\.\d+)?\s*(?:KB|MB|GB|bytes?)\b", 0))
        .withColumn("last_modified", F.regexp_extract("context", date, 1))
        .drop("_e")
    )


def study_links(page_links: DataFrame, key: str) -> DataFrame:
    """Study links of a search page that carries no payload: id, title and URL, each once."""
    ident = F.regexp_extract("absolute", r"/web/ICPSR/studies/(\d+)", 1)
    return (
        page_links.withColumn("study_id", ident)
        .filter((F.col("study_id") != "") & (F.col("title") != ""))
        .groupBy(key, "study_id", "title")
        .agg(F.min_by("absolute", "ord").alias("url"), F.min("ord").cast("bigint").alias("place"))
    )


# ---------------------------------------------------------------- sections, panels, tables

def headed_sections(tree: DataFrame, key: str) -> DataFrame:
    """Values under each `metadata-field` heading, up to the next one: rows label, value, place.

    A value is a sibling: a bare text or the whole text of an element.
    """
    heads = F.filter("elems", lambda e: (e["tag"] == "h3") & has_class(e, "metadata-field"))
    step = tree.withColumn("_heads", heads)

    def values(h, place):
        next_head = _next_sibling("_heads", h, place)
        parent = F.get(F.col("elems"), F.when(h["parent"] >= 0, h["parent"]))
        stop = F.coalesce(next_head["t0"], parent["t1"], F.size("texts"))
        end = F.coalesce(next_head["ord"] - 1, parent["last"], F.size("elems") - 1)
        tags = F.transform(
            F.filter(between(h["last"] + 1, end),
                     lambda e: (e["parent"] == h["parent"]) & (e["t0"] >= h["t1"])
                     & (e["t0"] < stop) & (e["t1"] > e["t0"])),
            lambda e: F.struct(e["t0"].alias("t"), inner_text(e).alias("v")))
        bare = F.filter(
            F.transform(F.sequence(h["t1"], F.greatest(h["t1"], stop - 1)), lambda i: F.struct(
                i.alias("t"), F.when((i < stop) & (F.get(F.col("owners"), i) == h["parent"]),
                                     collapse_wide(F.get(F.col("texts"), i))).alias("v"))),
            lambda s: s["v"].isNotNull())
        ordered = F.sort_array(F.concat(tags, bare))
        return F.struct(label_text(inner_text(h)).alias("label"),
                        clean_list(F.filter(F.transform(ordered, lambda s: s["v"]),
                                            lambda v: ~is_noise(v)), drop=True).alias("values"))

    return _section_rows(step.select(key, F.explode(F.transform("_heads", values)).alias("s")), key)


def nearby_sections(tree: DataFrame, key: str, hops: int = 6) -> DataFrame:
    """Values under any h2 to h4: up to six following sibling elements, to the next heading."""
    heading = lambda e: e["tag"].isin("h2", "h3", "h4")
    step = tree.withColumn("_heads", F.filter("elems", heading))

    def values(h, place):
        parent = F.get(F.col("elems"), F.when(h["parent"] >= 0, h["parent"]))
        end = F.coalesce(_next_sibling("_heads", h, place)["ord"] - 1, parent["last"],
                         F.size("elems") - 1)
        after = F.slice(F.filter(between(h["last"] + 1, end),
                                 lambda e: e["parent"] == h["parent"]), 1, hops)
        texts = F.transform(after, inner_text)
        return F.struct(label_text(inner_text(h)).alias("label"),
                        clean_list(F.filter(texts, lambda v: ~is_noise(v)), drop=True)
                        .alias("values"))

    return _section_rows(step.select(key, F.explode(F.transform("_heads", values)).alias("s")), key)


def _next_sibling(heads: str, h: Column, place: Column) -> Column:
    """The next of the headings (an array in document order) that has the same parent."""
    later = F.filter(F.slice(F.col(heads), place + 2, F.size(heads)),
                     lambda o: (o["parent"] == h["parent"]) & (o["ord"] > h["last"]))
    return F.get(later, F.lit(0))


def _section_rows(found: DataFrame, key: str) -> DataFrame:
    return (
        found.filter(F.col("s.label") != "")
        .select(key, F.col("s.label").alias("label"),
                F.posexplode("s.values").alias("place", "value"))
        .withColumn("place", F.col("place").cast("bigint"))
    )


def header_values(tree: DataFrame, key: str) -> DataFrame:
    """Principal investigators and version from the paragraphs with a bold label."""
    def value(p):
        bold = F.get(below(p, lambda e: e["tag"] == "strong"), F.lit(0))
        text = F.regexp_replace(inner_text(p), r"View help for [^.]+", "")
        return F.struct(
            F.rtrim(F.lower(inner_text(bold)), F.lit(":")).alias("name"),
            F.when(F.instr(text, ":") > 0, F.trim(F.regexp_replace(text, r"^[^:]*:", "")))
            .otherwise(F.lit("")).alias("value"), p["ord"].alias("ord"))

    rows = tree.select(key, F.explode(F.transform(by_tag("p"), value)).alias("p")).select(key, "p.*")
    pick = lambda n: F.max_by("value", F.when(F.col("name") == n, F.col("ord")))
    return rows.filter("name IS NOT NULL").groupBy(key).agg(
        F.coalesce(pick("principal investigator(s)"), F.lit("")).alias("principal_investigators"),
        F.coalesce(pick("version"), F.lit("")).alias("version"))


def panels(tree: DataFrame, key: str, *flags: str) -> DataFrame:
    """Panel entries: rows section, label, value, place; help links are no part of a value.

    `flags` are boolean columns of the page that its entries carry along.
    """
    titles = F.filter("elems", lambda e: (e["tag"] == "div") & has_class(e, "panel-title")
                      & (inner_text(e) != ""))
    step = tree.withColumn("_titles", titles)

    def entry(e):
        before = F.filter("_titles", lambda t: t["ord"] < e["ord"])
        bold = F.get(below(e, lambda s: s["tag"] == "strong"), F.lit(0))
        helps = below(e, lambda s: attr(s, "data-helplink").isNotNull())
        kept = F.filter(
            F.sequence(e["t0"], F.greatest(e["t0"], e["t1"] - 1)),
            lambda i: (i < e["t1"]) & ~F.exists(helps, lambda s: (s["t0"] <= i) & (i < s["t1"])))
        text = collapse_wide(F.array_join(F.transform(kept, lambda i: F.get(F.col("texts"), i)), " "))
        value = F.when(F.instr(text, ":") > 0,
                       F.trim(F.regexp_replace(text, r"^[^:]*:", ""))).otherwise(text)
        return F.struct(
            inner_text(F.get(before, F.size(before) - 1)).alias("section"),
            F.rtrim(inner_text(bold), F.lit(":")).alias("label"), value.alias("value"),
            e["ord"].alias("ord"))

    heads = F.filter("elems", lambda e: (e["tag"] == "div") & has_class(e, "panel-heading")
                     & ~has_class(e, "panel-title"))
    rows = step.select(key, *flags, F.explode(F.transform(heads, entry)).alias("p")).select(key, *flags, "p.*")
    return (
        rows.filter("section IS NOT NULL AND label <> '' AND value <> ''")
        .groupBy(key, "section", "label", "value").agg(
            F.min("ord").cast("bigint").alias("place"), *[F.bool_or(c).alias(c) for c in flags])
    )


def project_citation(tree: DataFrame) -> Column:
    """Citation block by id, else the block around a bold `project citation`."""
    block = F.get(F.filter("elems", lambda e: attr(e, "id") == "projectCitation"), F.lit(0))
    bold = F.filter("elems", lambda e: (e["tag"] == "strong")
                    & F.lower(inner_text(e)).contains("project citation"))
    above = F.get(bold, F.lit(0))["parent"]
    parent = F.get(F.col("elems"), F.when(above >= 0, above))
    return F.coalesce(inner_text(block), F.nullif(inner_text(parent), F.lit("")), F.lit(""))


def access_disclaimer(tree: DataFrame) -> Column:
    """Text of the box that holds the licence block."""
    block = F.get(F.filter("elems", lambda e: attr(e, "id") == "projectLicense"), F.lit(0))
    wells = F.filter(F.transform(block["up"], lambda i: F.get(F.col("elems"), i)),
                     lambda e: has_class(e, "well"))
    return F.coalesce(inner_text(F.get(wells, F.size(wells) - 1)), F.lit(""))


def published_versions(tree: DataFrame, key: str, url: str = "url") -> DataFrame:
    """Entries `V.. [date]` of the published-versions block, each once."""
    heads = F.filter("elems", lambda e: (e["tag"] == "h2")
                     & (F.lower(inner_text(e)) == "published versions"))
    step = tree.withColumn("_blocks", F.transform(heads, lambda h: nearest(h, ["fieldset", "div"])))
    anchors = F.filter("elems", lambda e: (e["tag"] == "a") & attr(e, "href").isNotNull()
                       & F.exists("_blocks", lambda b: inside(e, b)))
    rows = step.select(key, F.col(url).alias("_url"), F.explode(F.transform(
        anchors, lambda e: F.struct(e["ord"].alias("ord"), inner_text(e).alias("text"),
                                    attr(e, "href").alias("href")))).alias("a"))
    shape = r"(?i)^(V[^ ]+)\s*\[([^\]]+)\]"
    return (
        rows.filter(F.col("a.text").rlike(shape))
        .select(key, F.regexp_extract("a.text", shape, 1).alias("version"),
                codes.iso_date(F.regexp_extract("a.text", shape, 2)).alias("published_date"),
                urls.url_identity(urls.resolve("_url", F.col("a.href")), "version").alias("url"),
                F.col("a.ord").alias("ord"))
        .groupBy(key, "version", "published_date", "url")
        .agg(F.min("ord").cast("bigint").alias("place"))
    )


def related_publications(tree: DataFrame, key: str) -> DataFrame:
    """Publication lines of the panels; pages that say there are none have no rows.

    What a page says travels with its panels: a filter on the tree would be a second parse.
    """
    none = F.array_join("texts", " ").contains("No related publications for this project")
    denied = F.bool_or(F.lower("value").contains("no related publications")).over(Window.partitionBy(key))
    return (
        panels(tree.withColumn("_none", none), key, "_none")
        .filter(~F.col("_none") & (F.col("section") == "Methodology") & F.lower("label").contains("related publication"))
        .withColumn("_d", denied).filter("NOT _d")
        .withColumn("p", codes.publication_parts("value"))
        .select(key, "place", "p.title", "p.year", "p.doi")
    )


def folder_table(tree: DataFrame, key: str, url: str = "url") -> DataFrame:
    """Rows of the file table, files and folders, with the fields of a file entry."""
    table = F.get(F.filter("elems", lambda e: (e["tag"] == "table") & has_class(e, "table")), F.lit(0))
    step = tree.withColumn("_t", table)
    body = below(F.col("_t"), lambda e: e["tag"] == "tbody")
    step = step.withColumn("_b", body)
    rows = below(F.col("_t"), lambda e: (e["tag"] == "tr") & F.exists(
        "_b", lambda b: inside(e, b)))

    def one(r):
        cells = below(r, lambda e: e["tag"] == "td")
        link = F.get(below(r, lambda e: (e["tag"] == "a") & attr(e, "href").isNotNull()), F.lit(0))
        icon = F.size(below(r, lambda e: (e["tag"] == "i") & F.contains(
            F.coalesce(attr(e, "class"), F.lit("")), F.lit("glyphicon-folder-open")))) > 0
        return F.struct(
            r["ord"].alias("ord"), F.size(cells).alias("cells"), attr(link, "href").alias("href"),
            inner_text(link).alias("title"), icon.alias("icon"),
            inner_text(F.get(cells, F.lit(2))).alias("display_size"),
            inner_text(F.get(cells, F.lit(3))).alias("last_modified"))

    found = (
        step.select(key, F.col(url).alias("_url"), F.explode(F.transform(rows, one)).alias("r"))
        .select(key, "_url", "r.*").filter("cells >= 4 AND href IS NOT NULL")
        .withColumn("href", urls.url_identity(urls.resolve("_url", F.trim("href")), "page"))
    )
    return (
        found.withColumn("is_folder", F.col("href").contains("type=folder") | F.col("icon"))
        .withColumn("folder_path", urls.percent_decode(urls.query_value("href", "path")))
        .withColumn("file_name", urls.resource_file_name("href"))
        .withColumn("file_extension", urls.name_extension(F.col("file_name")))
        .withColumn("title", F.when(F.col("title") != "", F.col("title"))
                    .otherwise(F.col("file_name")))
        .withColumn("mime_type", codes.mime_type("file_extension", "datalumos"))
        .withColumn("file_content", labels.folder_file_content(
            "title", "file_name", "href", "folder_path", F.col("file_extension")))
        .withColumn("file_category", labels.file_category(
            "file_content", "file_extension", "datalumos"))
        .withColumn("uri", urls.url_identity("href", "file"))
        .groupBy(key, "href", "is_folder", "title", "folder_path", "file_name", "file_extension",
                 "mime_type", "file_content", "file_category", "uri", "display_size",
                 "last_modified")
        .agg(F.min("ord").cast("bigint").alias("place"))
    )


def pager_urls(tree: DataFrame, key: str, url: str = "url") -> DataFrame:
    """Further pages of a listing: pager links and the options of the page selector."""
    lists = F.filter("elems", lambda e: (e["tag"] == "ul") & has_class(e, "pager"))
    anchors = F.filter("elems", lambda e: (e["tag"] == "a") & attr(e, "href").isNotNull()
                       & F.exists(lists, lambda u: inside(e, u)))
    selector = F.get(F.filter("elems", lambda e: (e["tag"] == "select")
                              & (attr(e, "id") == "pageIdOptions")), F.lit(0))
    options = below(selector, lambda e: (e["tag"] == "option") & (F.trim(F.coalesce(attr(e, "value"), F.lit(""))) != ""))
    step = tree.withColumn("_a", anchors).withColumn("_o", options)
    by_link = step.select(key, F.col(url).alias("_url"), F.explode(
        F.transform("_a", lambda e: attr(e, "href"))).alias("_h")).select(
        key, urls.resolve("_url", "_h").alias("page_url"))
    chosen = step.select(key, F.col(url).alias("_url"),
                         F.explode(F.transform("_o", lambda e: F.trim(attr(e, "value")))).alias("_v"))
    plain = F.regexp_replace(F.regexp_replace("_url", r"#.*$", ""),
                             r"([?&])pageSelected=[^&]*&?", "$1")
    size = F.when(F.col("_url").rlike(r"[?&]pageSize="), F.lit("")).otherwise(F.lit("&pageSize=10"))
    mark = F.when(F.instr(plain, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    by_option = chosen.select(key, F.concat(
        plain, mark, F.lit("pageSelected="), urls.form_encode("_v"), size).alias("page_url"))
    return (
        by_link.unionByName(by_option)
        .select(key, urls.url_identity("page_url", "page").alias("page_url")).distinct()
    )


def dataset_menus(tree: DataFrame, key: str) -> DataFrame:
    """Menu labels of the dataset table: rows dataset, mode (preview, download), label.

    A cell offers the links of its menu, or the menu items when it has no links.
    """
    table = F.get(F.filter("elems", lambda e: (e["tag"] == "table")
                           & (attr(e, "id") == "data-doc")), F.lit(0))
    step = tree.withColumn("_t", table)
    step = step.withColumn("_r", below(F.col("_t"), lambda e: e["tag"] == "tr"))
    in_body = lambda r: F.get(F.col("elems"), r["parent"])["tag"] == "tbody"
    body_rows = F.filter("_r", in_body)
    rows = F.when(F.size(body_rows) > 0, body_rows).otherwise(F.col("_r"))

    def offered(cell):
        menus = below(cell, lambda e: (e["tag"] == "ul") & has_class(e, "dropdown-menu"))
        in_menu = lambda e: F.exists(menus, lambda m: inside(e, m))
        by_link = F.transform(below(cell, lambda e: (e["tag"] == "a") & (
            in_menu(e) | has_class(e, "dropdown-item"))), inner_text)
        by_item = F.transform(below(cell, lambda e: (e["tag"] == "li") & in_menu(e)), inner_text)
        keep = lambda t: (t != "") & ~F.lower(t).isin("preview", "download")
        first, second = F.filter(by_link, keep), F.filter(by_item, keep)
        return F.array_distinct(F.when(F.size(first) > 0, first).otherwise(second))

    def one(r):
        cells = below(r, lambda e: (e["tag"] == "td") & (e["parent"] == r["ord"]))
        cell = lambda i: F.get(cells, F.lit(i))
        return F.struct(
            F.size(cells).alias("cells"), attr(r, "class").alias("css"),
            inner_text(cell(0)).alias("name"), inner_text(cell(1)).alias("display_size"),
            offered(cell(2)).alias("preview"), offered(cell(3)).alias("download"))

    found = (
        step.select(key, F.posexplode(F.transform(rows, one)).alias("row_no", "r"))
        .select(key, (F.col("row_no") + 1).cast("bigint").alias("row_no"), "r.*")
        .filter("cells >= 4")
        .withColumn("d", labels.dataset_row("name", F.coalesce("css", F.lit(""))))
        .select(key, "row_no", "d.*", "display_size", "preview", "download")
    )
    modes = F.explode(F.array(
        F.struct(F.lit("preview").alias("mode"), F.col("preview").alias("items")),
        F.struct(F.lit("download").alias("mode"), F.col("download").alias("items"))))
    return (
        found.withColumn("m", modes)
        .select(*[c for c in found.columns if c not in ("preview", "download")],
                F.col("m.mode").alias("mode"), F.posexplode("m.items").alias("place", "label"))
        .withColumn("place", F.col("place").cast("bigint"))
    )


def merge_menus(menus: DataFrame, key: str) -> DataFrame:
    """Files of the dataset table: labels that mean the same file become one row."""
    from gleanery.operators.labels import add_resource_label

    first_mode = F.struct(F.col("mode") == "download", F.col("place"))
    return add_resource_label(menus, "label").groupBy(
        key, "row_no", "dataset_number", "dataset_identifier", "dataset_title", "identity_key"
    ).agg(
        F.bool_or(F.col("mode") == "preview").alias("previewable"),
        F.bool_or(F.col("mode") == "download").alias("downloadable"),
        F.min_by(F.struct("raw_label", "content_label", "display_name", "file_extension",
                          "file_category", "file_name"), first_mode).alias("_f"),
        F.min(first_mode).alias("item_order"),
    ).select("*", "_f.*").drop("_f")


def download_options(tree: DataFrame, key: str, ld: str = "jsonld") -> DataFrame:
    """Package formats of a study: the JSON-LD distributions, then menu labels not among them."""
    listed = F.coalesce(F.try_variant_get(F.col(ld), "$.distribution", "array<variant>"),
                        F.array().cast("array<variant>"))
    get = lambda v, k: F.coalesce(F.try_variant_get(v, f"$.{k}", "string"), F.lit(""))
    from_data = tree.select(key, F.posexplode(listed).alias("place", "v")).select(
        key, "place", clean_markup_text(get(F.col("v"), "fileFormat")).alias("label"),
        get(F.col("v"), "contentURL").alias("download_url"),
        get(F.col("v"), "encodingFormat").alias("encoding_format"),
        F.lit("page_jsonld").alias("source")).filter("label <> ''")
    box = F.get(F.filter("elems", lambda e: (e["tag"] == "div")
                         & (attr(e, "id") == "quickDownload")), F.lit(0))
    step = tree.withColumn("_b", box)
    anchors = below(F.col("_b"), lambda e: e["tag"] == "a")
    from_menu = step.select(key, F.posexplode(F.array_distinct(
        F.transform(anchors, inner_text))).alias("place", "label")).filter("label <> ''")
    more = from_menu.join(from_data.select(key, "label").distinct(), [key, "label"], "left_anti")
    return from_data.unionByName(more.select(
        key, "place", "label", F.lit("").alias("download_url"),
        F.lit("").alias("encoding_format"), F.lit("page_menu_only").alias("source"))
    ).withColumn("place", F.col("place").cast("bigint")).withColumn("file_type", F.lit("zip"))


# ---------------------------------------------------------------- script variables

def script_variables(tree: DataFrame, key: str) -> DataFrame:
    """Inline script assignments as rows name, value (text), json (variant, NULL if it is none).

    A tree that holds its `assigned` values needs no second look at the scripts.
    """
    assigned = F.col("assigned") if "assigned" in tree.columns else workers.assignments("scripts")
    return tree.select(key, F.explode(assigned).alias("name", "value")
                       ).withColumn("json", F.try_parse_json("value"))


def search_payload(html) -> Column:
    """Search results embedded in a page, from the first marker that leads to JSON.

    The JSON reader stops at the end of the value that starts behind the marker,
    so no bracket counting is needed. A bare list counts as the document list.
    """
    html = as_col(html)
    shape = schemas.SEARCH_PAYLOAD

    def behind(marker):
        rest = F.ltrim(F.substr(html, F.instr(html, marker) + F.lit(len(marker))))
        docs = F.from_json(rest, "array<variant>")
        as_list = F.when(F.startswith(rest, F.lit("[")) & docs.isNotNull(), F.struct(
            F.struct(F.size(docs).cast("bigint").alias("numFound"), docs.alias("docs"))
            .alias("response"),
            F.lit(None).cast(shape["pagination"].dataType).alias("pagination"),
            F.lit(None).cast(shape["meta"].dataType).alias("meta"),
            F.lit(None).cast("bigint").alias("total")))
        as_object = F.when(F.startswith(rest, F.lit("{")), F.from_json(rest, shape))
        return F.when(F.instr(html, marker) > 0, F.coalesce(as_object, as_list))

    return F.coalesce(*[behind(m) for m in vocab.SEARCH_MARKERS])


def payload_total(payload: Column) -> Column:
    return F.coalesce(payload["response"]["numFound"], payload["pagination"]["numFound"],
                      payload["meta"]["total"], payload["total"], F.lit(0).cast("bigint"))


def search_documents(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Search pages with a payload to one study row per document, in page order."""
    rows = (
        pages.withColumn("_p", search_payload(html))
        .withColumn("reported_total", payload_total(F.col("_p")))
        .select(*keep, "reported_total", F.posexplode("_p.response.docs").alias("pos", "v"))
    )
    get = lambda k: F.try_variant_get(F.col("v"), f"$.{k}", "string")
    people = F.coalesce(
        F.try_variant_get(F.col("v"), "$.AUTHOR", "array<string>"),
        F.when(get("AUTHOR").isNotNull(), F.array(get("AUTHOR"))),
        F.try_variant_get(F.col("v"), "$.AUTHOR_SPLIT", "array<string>"))
    text = lambda k: F.coalesce(collapse_wide(get(k)), F.lit(""))
    return rows.select(
        *keep, "reported_total", F.col("pos").cast("bigint").alias("pos"),
        get("ID").alias("study_id"), text("TITLE").alias("title"), clean_list(people).alias("author"),
        text("DATEUPDATED").alias("dateupdated"), text("OWNER").alias("owner"),
        urls.result_url(get("URL"), get("ID")).alias("url"), text("DOI").alias("doi"),
        text("ARCHIVE").alias("archive"), text("PUBLISH_STATUS").alias("publish_status"),
    ).filter(F.col("url") != "")


def search_cascade(pages: DataFrame, key: str, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Studies of search pages, and the pages that gave none: (studies, errors).

    A page's payload is read first, its visible study links where there is no
    payload; `parse_mode` says which. A page with neither is an error row. Which
    way a page goes depends on its content alone.
    """
    marked = pages.withColumn("_has", search_payload(html).isNotNull())
    by_payload = search_documents(marked.filter("_has"), [key], html).select(
        key, "pos", "study_id", "title", "url", F.lit("payload").alias("parse_mode"))
    rest = marked.filter("NOT _has").drop("_has")
    found = study_links(links(parse_pages(rest, html), key), key)
    by_link = found.select(key, F.col("place").alias("pos"), "study_id", "title", "url",
                           F.lit("html_link_fallback").alias("parse_mode"))
    errors = rest.join(found.select(key).distinct(), key, "left_anti").select(
        key, F.lit("Could not extract search results JSON or fallback study links.")
        .alias("reason"))
    return by_payload.unionByName(by_link), errors


def variable_count(assigned: Column | None = None) -> Column:
    """Variables a page reports: payload count, else `a to b of c`, else 0 where it says none.

    Read inside the row of a tree, from its assignments (`assigned`, else its scripts) and its
    texts; of several payloads the one of the first name counts.
    """
    assigned = workers.assignments("scripts") if assigned is None else assigned
    counts = F.transform(F.map_entries(assigned), lambda e: F.struct(e["key"].alias("name"), F.try_variant_get(
        F.try_parse_json(e["value"]), "$.response.numFound", "bigint").alias("n")))
    first = F.get(F.sort_array(F.filter(counts, lambda c: c["n"].isNotNull())), F.lit(0))["n"]
    shown = F.array_join("texts", " ")
    return F.coalesce(
        first,
        F.nullif(F.regexp_extract(shown, r"(\d+)\s+to\s+(\d+)\s+of\s+(\d+)", 3), F.lit("")).try_cast("bigint"),
        F.when(F.lower(shown).contains("no search results found"), F.lit(0)),
    ).cast("bigint")


def payload_publications(variables: DataFrame, key: str) -> DataFrame:
    """Publications in script payloads, one row per distinct titled document."""
    docs = variables.select(key, F.explode(F.try_variant_get(
        "json", "$.response.docs", "array<variant>")).alias("v"))
    get = lambda *ks: F.coalesce(*[
        F.nullif(collapse_wide(F.try_variant_get(F.col("v"), f"$.{k}", "string")), F.lit(""))
        for k in ks])
    return docs.select(
        key, get("TITLE", "title").alias("title"),
        urls.canonical_doi(get("DOI", "doi")).alias("doi"), get("JOURNAL", "journal").alias("journal"),
        get("YEAR_PUB", "year").alias("year"), get("URL", "URL_ABS", "url").alias("url"),
        get("citation").alias("citation")).filter("title IS NOT NULL").distinct()

