"""Unified records from page facts, by declared precedence.

Whatever an extractor finds becomes a fact: study, page order, source, name,
place, value. A precedence table per profile says which facts may fill which
field, best first. Filling all fields of all studies is then one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import codes
from gleanery.functions.lists import clean_list
from gleanery.functions.text import (
    clean_markup_text, clean_text, first_non_blank, first_number, safe_file, safe_folder,
    text_or_null,
)
from gleanery.functions.urls import canonical_doi, canonical_url

FACT = ["study_id", "page_ord", "source", "name", "place", "value"]

_CITATION = [("meta", "DC.bibliographicCitation"), ("meta", "citation_reference"),
             ("meta", "citation")]
_META_TITLE = [("meta", "DC.title"), ("meta", "og:title"), ("meta", "twitter:title")]
_META_TEXT = [("meta", "description"), ("meta", "og:description"), ("meta", "twitter:description")]

# Single-valued fields, sources in order of precedence.
SCALARS = {
    "icpsr": {
        "page_title": [("page", "title")],
        "title": [("jsonld", "name"), ("variable", "title"), ("inline", "title"), *_META_TITLE,
                  ("page", "title")],
        "abstract": [("jsonld", "description"), ("inline", "description"), ("section", "Summary")],
        "doi": [("jsonld", "identifier"), ("meta", "DC.identifier")],
        "version": [("jsonld", "version"), ("variable", "versionLabel"),
                    ("inline", "versionLabel"), ("variable", "versionNumber"),
                    ("inline", "versionNumber")],
        "published_date": [("jsonld", "datePublished"), ("inline", "created"), ("meta", "DC.date")],
        "modified_date": [("jsonld", "dateModified")],
        "created_date": [("inline", "created")],
        "publisher": [("jsonld", "publisher"), ("jsonld", "catalog"), ("meta", "DC.publisher"),
                      ("constant", "repository")],
        "citation": _CITATION,
        "purpose": [("inline", "purpose"), ("section", "Purpose"), ("section", "Study Purpose")],
        "study_design": [("inline", "studyDesign"), ("section", "Study Design")],
        "sample": [("inline", "sampProc"), ("section", "Sample")],
        "universe": [("inline", "universe"), ("section", "Universe")],
        "license": [("jsonld", "license"), ("constant", "terms_url")],
        "restrictions": [("jsonld", "conditionsOfAccess"), ("inline", "accessRights"),
                         ("section", "Restrictions")],
    },
    "openicpsr": {
        "page_title": [("page", "title")],
        "title": [("jsonld", "name"), *_META_TITLE, ("page", "title")],
        "abstract": [("jsonld", "description"), *_META_TEXT, ("section", "Summary")],
        "doi": [("jsonld", "identifier"), ("meta", "DC.identifier")],
        "version": [("jsonld", "version"), ("page", "url_version")],
        "published_date": [("jsonld", "datePublished"), ("meta", "DC.date")],
        "modified_date": [("jsonld", "dateModified")],
        "publisher": [("jsonld", "catalog"), ("jsonld", "publisher"), ("meta", "DC.publisher"),
                      ("constant", "repository")],
        "citation": _CITATION,
        "purpose": [("section", "Purpose")],
        "study_design": [("section", "Study Design")],
        "sample": [("section", "Sample")],
        "universe": [("section", "Universe")],
        "license": [("jsonld", "license"), ("meta", "DC.license")],
        "restrictions": [("jsonld", "conditionsOfAccess"), ("section", "Restrictions")],
    },
    "datalumos": {
        "page_title": [("page", "title")],
        "title": [("jsonld", "name"), ("meta", "DC.title"), ("page", "title")],
        "abstract": [("jsonld", "description"), ("panel", "Project Description/Summary")],
        "doi": [("jsonld", "identifier"), ("citation", "doi"), ("meta", "DC.identifier")],
        "version": [("header", "version"), ("jsonld", "version"), ("page", "url_version")],
        "published_date": [("jsonld", "datePublished"), ("meta", "DC.date"),
                           ("citation", "published_date"), ("version", "published_date")],
        "modified_date": [("jsonld", "dateModified")],
        "publisher": [("jsonld", "catalog"), ("constant", "repository")],
        "citation": [("citation", "text")],
        "purpose": [("panel", "Project Description/Purpose"), ("panel", "Methodology/Purpose")],
        "study_design": [("panel", "Methodology/Study Design")],
        "sample": [("panel", "Methodology/Sampling")],
        "universe": [("panel", "Scope of Project/Universe"), ("panel", "Methodology/Universe")],
        "license": [("jsonld", "license")],
        "restrictions": [("disclaimer", "text")],
    },
}

# List fields, sources in the order their entries are joined.
LISTS = {
    "icpsr": {
        "authors": [("jsonld", "creator"), ("inline", "creator")],
        "author_affiliations": [("jsonld", "affiliation"), ("inline", "affiliation")],
        "distributors": [("inline", "distributor"), ("section", "Distributor(s)"),
                         ("citation", "distributor")],
        "language": [("jsonld", "inLanguage"), ("inline", "language")],
        "keywords": [("jsonld", "keywords"), ("inline", "keyword")],
        "subjects": [("inline", "subject"), ("section", "Subject Terms")],
        "topics": [("inline", "topic"), ("section", "Topic")],
        "series": [("inline", "series"), ("section", "Series")],
        "collections": [("inline", "collection")],
        "related_datasets": [("inline", "relatedStudies")],
        "time_method": [("inline", "timeMeth"), ("section", "Time Method")],
        "collection_dates": [("inline", "collectionDates")],
        "temporal_coverage": [("jsonld", "temporalCoverage"), ("inline", "timePeriods")],
        "geographic_coverage": [("jsonld", "spatialCoverage"), ("inline", "location"),
                                ("section", "Geographic Coverage")],
        "analysis_units": [("inline", "analysisUnit"), ("section", "Unit(s) of Observation")],
        "kind_of_data": [("inline", "kindOfData"), ("section", "Data Type(s)"),
                         ("section", "Kind of Data")],
        "collection_mode": [("inline", "collectionMode"), ("section", "Mode of Data Collection")],
        "sampling_procedure": [("inline", "sampProc"), ("section", "Sampling")],
        "collection_notes": [("inline", "collectionNotes")],
        "collection_changes": [("inline", "collectionChanges")],
    },
    "openicpsr": {
        "authors": [("jsonld", "creator")],
        "author_affiliations": [("jsonld", "affiliation")],
        "distributors": [("section", "Distributor(s)"), ("citation", "distributor")],
        "language": [("jsonld", "inLanguage")],
        "keywords": [("jsonld", "keywords")],
        "subjects": [("section", "Subject Terms")],
        "topics": [("section", "Topic")],
        "series": [("section", "Series")],
        "collections": [("section", "Collection")],
        "related_datasets": [("section", "Related Projects")],
        "time_method": [("section", "Time Method")],
        "collection_dates": [("section", "Collection Dates")],
        "temporal_coverage": [("jsonld", "temporalCoverage")],
        "geographic_coverage": [("jsonld", "spatialCoverage"), ("section", "Geographic Coverage")],
        "analysis_units": [("section", "Unit(s) of Observation")],
        "kind_of_data": [("section", "Data Type(s)"), ("section", "Kind of Data")],
        "collection_mode": [("section", "Mode of Data Collection")],
        "sampling_procedure": [("section", "Sampling")],
        "collection_notes": [("section", "Collection Notes")],
        "collection_changes": [("section", "Collection Changes")],
    },
    "datalumos": {
        "authors": [("jsonld", "creator"), ("header", "principal_investigators")],
        "author_affiliations": [("jsonld", "affiliation")],
        "distributors": [("citation", "distributor"), ("meta", "DC.publisher")],
        "language": [("jsonld", "inLanguage")],
        "keywords": [("jsonld", "keywords"), ("panel", "Scope of Project/Subject Terms")],
        "subjects": [("panel", "Scope of Project/Subject Terms")],
        "topics": [("panel", "Scope of Project/Topic")],
        "time_method": [("panel", "Methodology/Time Method"),
                        ("panel", "Scope of Project/Time Method")],
        "collection_dates": [("panel", "Scope of Project/Time Period(s)")],
        "temporal_coverage": [("jsonld", "temporalCoverage"),
                              ("panel", "Scope of Project/Time Period(s)")],
        "geographic_coverage": [("jsonld", "spatialCoverage"),
                                ("panel", "Scope of Project/Geographic Coverage")],
        "analysis_units": [("panel", "Methodology/Unit(s) of Observation"),
                           ("panel", "Methodology/Analysis Unit(s)")],
        "kind_of_data": [("panel", "Scope of Project/Data Type(s)")],
        "collection_mode": [("panel", "Methodology/Collection Mode(s)")],
        "sampling_procedure": [("panel", "Methodology/Sampling")],
        "collection_notes": [("panel", "Scope of Project/Collection Notes")],
        "collection_changes": [("panel", "Scope of Project/Collection Changes")],
    },
}
# List fields of the folder profile whose entries are split on `;`,
# and the ones whose entries get another form.
SPLIT_FIELDS = ["authors", "keywords", "subjects", "topics", "time_method", "analysis_units",
                "kind_of_data", "collection_mode"]


def _uses(table: dict[str, list]) -> Column:
    """Map from source and name to the fields a fact may fill, each with its rank."""
    uses: dict[str, list] = {}
    for field, sources in table.items():
        for rank, (source, name) in enumerate(sources):
            uses.setdefault(f"{source}:{name}", []).append((field, rank))
    return F.create_map(*[x for place, fields in uses.items() for x in (
        F.lit(place), F.array(*[F.struct(F.lit(f).alias("field"), F.lit(r).alias("rank"))
                                for f, r in fields]))])


def _candidates(facts: DataFrame, table: dict[str, list]) -> DataFrame:
    """Facts that may fill a field, with field and rank; blanks never do."""
    fields = F.try_element_at(_uses(table), F.concat_ws(":", "source", "name"))
    # a script variable of a later page replaces an earlier one
    order = F.when(F.col("source") == "variable", -F.col("page_ord")).otherwise(F.col("page_ord"))
    # most facts fill no field: they are left before any text is cleaned
    return (
        facts.filter(fields.isNotNull())
        .withColumn("value", clean_markup_text("value")).filter(F.col("value") != "")
        .select("study_id", "value", order.alias("page_ord"), "place", F.explode(fields).alias("u"))
        .select("study_id", "value", "page_ord", "place", "u.field", "u.rank")
    )


def resolve_scalars(facts: DataFrame, profile: str) -> DataFrame:
    """One row per study: each field from its best-ranked fact, empty text where none is."""
    table = SCALARS[profile]
    place = F.struct("rank", "page_ord", "place")
    picks = []
    for field in table:
        here = F.col("field") == field
        picks.append(F.coalesce(F.min_by(F.when(here, F.col("value")), F.when(here, place)),
                                F.lit("")).alias(field))
    rows = _candidates(facts, table).groupBy("study_id").agg(*picks)
    rows = (rows.withColumn("summary", F.col("abstract"))
            .withColumn("doi", canonical_doi("doi")))
    if profile == "datalumos":
        for field in ("published_date", "modified_date"):
            rows = rows.withColumn(field, codes.iso_date(field))
        rows = rows.withColumn("publisher", codes.organisation("publisher"))
    return rows


def resolve_lists(facts: DataFrame, profile: str) -> DataFrame:
    """List fields in long form: study_id, field, value and the place that sorts the values."""
    rows = _candidates(facts, LISTS[profile])
    if profile == "datalumos":
        split = F.when(F.col("field").isin(SPLIT_FIELDS), F.split("value", ";")).otherwise(
            F.array("value"))
        rows = (
            rows.select("study_id", "field", "rank", "page_ord", "place",
                        F.posexplode(split).alias("part", "value"))
            .withColumn("value", F.when(F.col("field") == "distributors", codes.organisation("value"))
                        .when(F.col("field") == "temporal_coverage", codes.period("value"))
                        .otherwise(clean_text("value")))
        )
    else:
        rows = rows.withColumn("part", F.lit(0))
    rows = rows.filter(~F.lower("value").isin(vocab.DROPPED_VALUES))
    return rows.groupBy("study_id", "field", "value").agg(
        F.min(F.struct("rank", "page_ord", "place", "part")).alias("order"))


def merge_funding(listed: DataFrame, inline: DataFrame) -> DataFrame:
    """Funding of a study from two sources, matched by funder and identifier.

    Of entries with the same key the last one counts. The inline source overlays
    the display text; the URL comes from the listed source.
    """
    key = ["study_id", "funder_name", "identifier"]

    def clean(df):
        texts = [c for c in df.columns if c not in ("study_id", "place")]
        return df.select("study_id", "place", *[
            F.coalesce(clean_markup_text(c), F.lit("")).alias(c) for c in texts])

    left = clean(listed).groupBy(*key).agg(
        F.max_by(F.struct("display", "url"), "place").alias("_l")
    ).select(*key, F.col("_l.display").alias("_display"), F.col("_l.url").alias("url"))
    said = F.when(F.col("display") != "", F.col("place"))
    right = clean(inline).groupBy(*key).agg(F.max_by("display", said).alias("_inline"))
    return (
        left.join(right, key, "full")
        .select(*key, F.col("identifier").alias("grant_number"),
                F.coalesce(F.nullif("_inline", F.lit("")), "_display", F.lit("")).alias("display"),
                F.coalesce("url", F.lit("")).alias("url"))
        .filter("funder_name <> '' OR identifier <> '' OR display <> '' OR url <> ''")
    )


def json_ld_funding(pages: DataFrame, ld: str = "jsonld") -> DataFrame:
    """Funding entries of the first JSON-LD object of each study, as `merge_funding` takes them."""
    first = pages.filter(F.col(ld).isNotNull()).groupBy("study_id").agg(
        F.min_by(F.to_json(ld), "page_ord").alias("_j"))
    items = F.coalesce(
        F.try_variant_get(F.parse_json("_j"), "$.funding", "array<variant>"),
        F.array(F.try_variant_get(F.parse_json("_j"), "$.funding", "variant")))
    get = lambda p: F.try_variant_get("v", p, "string")
    return (
        first.select("study_id", F.posexplode(items).alias("place", "v"))
        .filter(F.schema_of_variant("v").startswith("OBJECT"))
        .select("study_id", "place",
                F.coalesce(get("$.funder.name"), get("$.funder")).alias("funder_name"),
                get("$.identifier").alias("identifier"), get("$.display").alias("display"),
                get("$.url").alias("url")))


def inline_funding(variables: DataFrame) -> DataFrame:
    """Funding entries of the inline `metadata` of each study's first page that has them."""
    held = variables.filter("name = 'metadata'").select(
        "study_id", "page_ord", F.try_variant_get("json", "$.fundingSources", "array<variant>")
        .alias("items")).filter("size(items) > 0")
    first = held.groupBy("study_id").agg(
        F.min_by(F.transform("items", lambda v: F.to_json(v)), "page_ord").alias("items"))
    get = lambda p: F.try_variant_get("v", p, "string")
    return (
        first.select("study_id", F.posexplode("items").alias("place", "j"))
        .withColumn("v", F.parse_json("j")).filter(F.schema_of_variant("v").startswith("OBJECT"))
        .select("study_id", "place", get("$.funderName").alias("funder_name"),
                get("$.grantNo").alias("identifier"), get("$.display").alias("display")))


def json_ld_facts(pages: DataFrame, ld: str = "jsonld") -> DataFrame:
    """Facts of the first JSON-LD object of each study; needs study_id, page_ord and the object."""
    first = pages.filter(F.col(ld).isNotNull()).groupBy("study_id").agg(
        F.min_by(F.to_json(ld), "page_ord").alias("_j")).withColumn("_v", F.parse_json("_j"))
    v = F.col("_v")
    get = lambda p: F.try_variant_get(v, p, "string")
    many = lambda p: F.coalesce(F.try_variant_get(v, p, "array<variant>"),
                                F.array(F.try_variant_get(v, p, "variant")))
    text = lambda p: F.transform(many(p), lambda x: F.coalesce(
        F.try_variant_get(x, "$.name", "string"), F.try_variant_get(x, "$", "string")))
    people = many("$.creator")
    affiliation = F.flatten(F.transform(people, lambda c: F.transform(
        F.coalesce(F.try_variant_get(c, "$.affiliation", "array<variant>"),
                   F.array(F.try_variant_get(c, "$.affiliation", "variant"))),
        lambda a: F.coalesce(F.try_variant_get(a, "$.name", "string"),
                             F.try_variant_get(a, "$", "string")))))
    plain = F.when(F.lower(get("$.identifier")).contains("doi.org"), get("$.identifier"))
    doi = F.coalesce(get("$.identifier.url"), get("$.identifier['@id']"),
                     get("$.identifier.value"), plain)
    single = {n: F.array(get(f"$.{n}")) for n in (
        "name", "description", "version", "datePublished", "dateModified", "license",
        "conditionsOfAccess")}
    named = {
        **single, "identifier": F.array(doi), "publisher": F.array(get("$.publisher.name")),
        "catalog": F.array(get("$.includedInDataCatalog.name")), "affiliation": affiliation,
        "creator": F.transform(people, lambda c: F.try_variant_get(c, "$.name", "string")),
        **{n: text(f"$.{n}") for n in ("inLanguage", "keywords", "temporalCoverage",
                                       "spatialCoverage")},
    }
    entries = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("values"))
                                  for n, c in named.items()]))
    return (
        first.select("study_id", entries.alias("e"))
        .select("study_id", F.col("e.name").alias("name"),
                F.posexplode("e.values").alias("place", "value"))
        .filter("value IS NOT NULL")
        .select("study_id", F.lit(0).alias("page_ord"), F.lit("jsonld").alias("source"), "name",
                F.col("place").cast("bigint").alias("place"), "value")
    )


def _reader(fields: list[str] | None):
    """Text of a variant: itself, or the first of some of its fields."""
    paths = [f"$.{f}" for f in fields] if fields else ["$"]
    return lambda x: F.coalesce(*[F.try_variant_get(x, p, "string") for p in paths])


def inline_facts(variables: DataFrame) -> DataFrame:
    """Facts of inline script data: keys of `metadata`, and the named variables.

    Needs study_id, page_ord, name, value, json.
    """
    named = variables.filter(F.col("name").isin("versionLabel", "title", "versionNumber")).select(
        "study_id", "page_ord", F.lit("variable").alias("source"), "name",
        F.lit(0).cast("bigint").alias("place"),
        F.coalesce(F.try_variant_get("json", "$", "string"), "value").alias("value"))
    keys = sorted({n for table in (SCALARS["icpsr"], LISTS["icpsr"]) for sources in table.values()
                   for s, n in sources if s == "inline"})
    entries = []
    for name in keys:
        path = {"affiliation": "creator"}.get(name, name)
        items = F.coalesce(F.try_variant_get("json", f"$.{path}", "array<variant>"),
                           F.array(F.try_variant_get("json", f"$.{path}", "variant")))
        field = {"creator": ["personName", "display", "orgName"],
                 "affiliation": ["affiliationsDisplay", "personOrgName", "orgName"]}.get(name)
        entries.append(F.struct(F.lit(name).alias("name"),
                                F.transform(items, _reader(field)).alias("values")))
    listed = (
        variables.filter("name = 'metadata'")
        .select("study_id", "page_ord", F.explode(F.array(*entries)).alias("e"))
        .select("study_id", "page_ord", F.col("e.name").alias("name"),
                F.posexplode("e.values").alias("place", "value"))
        .filter("value IS NOT NULL")
        .select("study_id", "page_ord", F.lit("inline").alias("source"), "name",
                F.col("place").cast("bigint").alias("place"), "value")
    )
    return named.unionByName(listed)


def citation_facts(facts: DataFrame) -> DataFrame:
    """Distributors named in citation-like meta tags, as further facts."""
    wanted = facts.filter((F.col("source") == "meta") & F.col("name").isin(
        [n for _, n in _CITATION]))
    names = F.regexp_extract_all("value", F.lit(r"(?i)([^.;]+?)\s*\[distributor\]"), F.lit(1))
    return wanted.select("study_id", "page_ord", F.lit("citation").alias("source"),
                         F.lit("distributor").alias("name"), "place", F.explode(names).alias("value"))


def normalise_record(df: DataFrame) -> DataFrame:
    """Clean a flat record frame: text, URLs, DOI, and back-fill between levels.

    Works on the columns that are there: identifiers from the top level, dates
    both ways, licence texts from each other.
    """
    have = set(df.columns)
    out = df
    for c in ("title", "subtitle", "study_id", "summary", "abstract", "published_date",
              "modified_date", "nested_study_id", "nested_published_date"):
        if c in have:
            out = out.withColumn(c, F.coalesce(clean_markup_text(c), F.lit("")))
    for c in ("source_url", "final_url", "repository_url"):
        if c in have:
            out = out.withColumn(c, canonical_url(c))
    if "doi" in have:
        out = out.withColumn("doi", F.coalesce(canonical_doi("doi"), F.lit("")))
    if {"doi", "nested_doi"} <= have:
        out = out.withColumn("nested_doi", F.coalesce(
            canonical_doi(F.coalesce(F.nullif("nested_doi", F.lit("")), "doi")), F.lit("")))
    if {"study_id", "nested_study_id"} <= have:
        out = out.withColumn("nested_study_id", F.coalesce(
            F.nullif("nested_study_id", F.lit("")), "study_id"))
    if {"published_date", "nested_published_date"} <= have:
        out = (out.withColumn("nested_published_date", F.coalesce(
                   F.nullif("nested_published_date", F.lit("")), "published_date"))
               .withColumn("published_date", F.coalesce(
                   F.nullif("published_date", F.lit("")), "nested_published_date")))
    return out


def access_texts(df: DataFrame) -> DataFrame:
    """Licence, its URL and the terms URL fill each other where one is missing."""
    filled = df.withColumn("terms_url", first_non_blank("terms_url", "license_url", F.lit("")))
    return (
        filled.withColumn("license_url", first_non_blank("license_url", "terms_url", F.lit("")))
        .withColumn("license", first_non_blank("license", "license_url", "terms_url", F.lit("")))
    )


def completeness_warnings(profile: str) -> Column:
    """Warnings about what extraction did not find."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    rules = [(empty("author_count"), "No authors were extracted."),
             (text_or_null("publisher").isNull(), "No publisher was extracted.")]
    if profile == "icpsr":
        rules.append((empty("file_count"), "No page-visible file rows were extracted from the "
                                           "Data & Documentation page."))
    elif profile == "openicpsr":
        rules += [(empty("export_count"), "No export formats were detected on the page; review "
                                          "export link parsing for this project."),
                  (empty("file_count"), "No files were detected on the page; review the project "
                                        "file-row parser for this project.")]
    else:
        rules = [(empty("version_count"), "No published versions block was parsed."),
                 (empty("file_count"), "No file entries were extracted from crawled pages."),
                 *rules, (empty("export_count"), "No export formats were detected on crawled pages; "
                                                 "review export link parsing for this project.")]
    return F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in rules]))


def project_rows(
    records: DataFrame, repository_id: int, repository_url: str, folder: str, method: str,
    run_time: str,
) -> DataFrame:
    """Records to stored project rows; a record without a numeric id has a NULL key."""
    number = first_number("study_id")
    return records.select(
        codes.project_key(F.lit(repository_id), number, "page_type").alias("project_key"),
        number.alias("project_id"), "query_string",
        F.lit(repository_id).cast("bigint").alias("repository_id"),
        F.lit(repository_url).alias("repository_url"),
        first_non_blank("final_url", "source_url", F.lit("")).alias("project_url"),
        clean_text("title").alias("title"), clean_text("summary_text").alias("description"),
        F.array_join(clean_list("language"), "; ").alias("language"),
        first_non_blank("doi", F.lit("")).alias("doi"),
        first_non_blank("published_date", F.lit("")).alias("upload_date"),
        F.lit(run_time).alias("download_date"), F.lit(folder).alias("download_repository_folder"),
        safe_folder(F.concat_ws("_", first_non_blank("study_id", F.lit("unknown")),
                                first_non_blank("page_type", F.lit("study"))))
        .alias("download_project_folder"), F.lit(method).alias("download_method"))


def file_stem_of(df: DataFrame) -> Column:
    """File stem a record is saved under: DOI, else study id, else title."""
    return safe_file(first_non_blank("doi", "study_id", "title", F.lit("metadata")), "record")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add the columns a frame lacks; columns that are there stay as they are."""
    return df.select("*", *[F.lit(v).alias(c) for c, v in defaults.items() if c not in df.columns])


def compact_document(df: DataFrame) -> Column:
    """A record as JSON without empty texts and lists; false, zero and maps stay."""
    kept = []
    for field in df.schema:
        column, kind = F.col(field.name), field.dataType.simpleString()
        if kind == "string":
            column = F.nullif(column, F.lit(""))
        elif kind.startswith("array"):
            column = F.when(F.size(column) > 0, column)
        kept.append(column.alias(field.name))
    return F.to_json(F.struct(*kept), {"ignoreNullFields": "true"})
