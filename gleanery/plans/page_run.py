"""The page pipeline: captured pages to records, validation, catalogue rows.

Routing is by URL: each page type has its own profile of extraction and
precedence; everything behind the facts is common.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery import schemas, vocab
from gleanery.functions import codes, urls, workers
from gleanery.functions.text import first_number
from gleanery.operators import files as file_ops
from gleanery.operators import pages as P
from gleanery.operators import dedupe, quality, record, signals, versions
from gleanery.schemas import TABLES
from gleanery.session import cut_lineage


def route(captured: DataFrame) -> DataFrame:
    """Add page_type and study_id; pages of unknown type stay for the failures table."""
    ident = F.coalesce(F.nullif(urls.study_id("url"), F.lit("")), urls.project_id("url"))
    return captured.withColumn("page_type", urls.page_type("url")).withColumn("study_id", ident)


def unsupported(routed: DataFrame, run_time: str) -> DataFrame:
    """Pages no profile can read, as failure rows."""
    return routed.filter("page_type = 'unknown' OR study_id = ''").select(
        F.lit(None).cast("bigint").alias("project_key"),
        F.concat(F.lit("Unsupported study URL for metadata extraction: "), "url").alias("reason"),
        F.lit(run_time).alias("timestamp"))


def _facts(df: DataFrame, source: str, name, place, value) -> DataFrame:
    return df.select(
        "study_id", "page_ord", F.lit(source).alias("source"), name.alias("name"),
        place.cast("bigint").alias("place"), value.alias("value"))


def page_trees(routed: DataFrame, profile: str) -> DataFrame:
    """The parsed pages of one profile, keyed by page_id, written once without their markup.

    Beside the tree stands what is read from the markup itself or by Python: JSON-LD, title, meta
    tags and assignments of scripts. So no output looks at a page again.
    """
    mine = (
        routed.filter(F.col("page_type") == profile).select("study_id", "page_ord", "url", "html")
        .withColumn("page_id", F.struct("study_id", "page_ord")))
    tree = P.parse_pages(mine.withColumns({
        "jsonld": F.to_json(P.json_ld("html")), "page_title": P.page_title("html"),
        "metas": P.meta_markup("html")})).drop("html").withColumn("assigned", workers.assignments("scripts"))
    return cut_lineage(tree, "pages").withColumn("jsonld", F.parse_json("jsonld"))


def page_files(tree: DataFrame, profile: str) -> DataFrame:
    """Files that the pages of a profile show, each once per study: by URI where pages have one,
    so that equal names in two folders stay two files, else by name and type."""
    if profile == "icpsr":
        found = P.merge_menus(P.dataset_menus(tree, "page_id"), "page_id").select(
            "page_id.study_id", "file_name", F.col("file_extension").alias("file_type"),
            "file_category", F.lit("").alias("uri"))
    elif profile == "openicpsr":
        found = P.file_links(P.links(tree, "page_id"), "page_id").select(
            "page_id.study_id", "file_name", F.col("file_format").alias("file_type"),
            "file_category", "uri")
    else:
        found = P.folder_table(tree, "page_id").filter("NOT is_folder").select(
            "page_id.study_id", "file_name", F.col("file_extension").alias("file_type"),
            "file_category", "uri")
    return found.filter("file_name <> ''").groupBy("study_id", "file_name", "file_type", "uri").agg(
        F.min("file_category").alias("file_category"))


def listed_versions(tree: DataFrame, profile: str) -> DataFrame:
    """Versions that the pages of a study list, in the order of pages and places."""
    if profile != "datalumos":
        return tree.sparkSession.createDataFrame(
            [], "study_id string, place bigint, version string, published_date string, "
                "is_current boolean")
    rows = P.published_versions(tree, "page_id")
    # pages in the upper half, places on a page in the lower one
    place = F.shiftleft(F.col("page_id.page_ord").cast("bigint"), 32) + F.col("place")
    return rows.groupBy("page_id.study_id", "version", "published_date").agg(
        F.min(place).alias("place")).select(
        "study_id", "place", "version", "published_date",
        F.lit(None).cast("boolean").alias("is_current"))


def study_funding(tree: DataFrame, profile: str) -> DataFrame:
    """Funding of each study: inline entries over those of the JSON-LD."""
    listed = record.json_ld_funding(tree.select("study_id", "page_ord", "jsonld"))
    if profile == "icpsr":
        inline = record.inline_funding(P.script_variables(tree, "page_id").select("*", "page_id.*"))
    else:  # these pages have no inline data
        inline = tree.sparkSession.createDataFrame(
            [], "study_id string, place int, funder_name string, identifier string, display string")
    return record.merge_funding(listed, inline)


def page_facts(routed: DataFrame, profile: str, tree: DataFrame | None = None) -> DataFrame:
    """All facts of the pages of one profile.

    Needs study_id, page_ord, url, html. The parsed tree feeds many outputs, so
    it is written once (`page_trees`), without the markup, and read back: the
    Python stage runs a single time, and so does the search of the markup.
    """
    tree = page_trees(routed, profile) if tree is None else tree
    with_page = lambda df: df.select("*", "page_id.*")
    zero = F.lit(0)
    base = tree.select("study_id", "page_ord", F.col("page_title").alias("title"),
                       urls.url_version("url").alias("url_version"), "jsonld")
    main = base.groupBy("study_id").agg(F.min_by(F.struct("title", "url_version"), "page_ord")
                                        .alias("m")).withColumn("page_ord", zero)
    parts = [
        record.json_ld_facts(base),
        _facts(main, "page", F.lit("title"), zero, F.col("m.title")),
        _facts(main, "page", F.lit("url_version"), zero, F.col("m.url_version")),
        _facts(main, "constant", F.lit("repository"), zero,
               F.lit(vocab.REPOSITORY_NAME[profile])),
        _facts(with_page(P.meta_tags(tree, "page_id", markup="metas")), "meta", F.col("name"), F.col("place"),
               F.col("value")),
    ]
    if profile == "datalumos":
        panel = with_page(P.panels(tree, "page_id"))
        head = with_page(P.header_values(tree, "page_id"))
        blocks = tree.select("study_id", "page_ord", P.project_citation(tree).alias("citation"),
                             P.access_disclaimer(tree).alias("disclaimer"))
        cited = blocks.filter("citation <> ''").groupBy("study_id").agg(
            F.min_by("citation", "page_ord").alias("citation")).withColumn(
            "page_ord", zero).withColumn("c", codes.citation_parts("citation"))
        listed = with_page(P.published_versions(tree, "page_id"))
        parts += [
            _facts(panel, "panel", F.concat_ws("/", "section", "label"), F.col("place"),
                   F.col("value")),
            _facts(head, "header", F.lit("principal_investigators"), zero,
                   F.col("principal_investigators")),
            _facts(head, "header", F.lit("version"), zero, F.col("version")),
            _facts(cited, "citation", F.lit("text"), zero, F.col("citation")),
            _facts(blocks, "disclaimer", F.lit("text"), zero, F.col("disclaimer")),
            _facts(listed, "version", F.lit("published_date"), F.col("place"),
                   F.col("published_date")),
            *[_facts(cited, "citation", F.lit(n), zero, F.col(f"c.{n}"))
              for n in ("doi", "published_date", "distributor")],
        ]
    else:
        sections = P.headed_sections if profile == "icpsr" else P.nearby_sections
        parts.append(_facts(with_page(sections(tree, "page_id")), "section", F.col("label"),
                            F.col("place"), F.col("value")))
        parts.append(record.citation_facts(parts[4]))
    if profile == "icpsr":
        parts.append(record.inline_facts(with_page(P.script_variables(tree, "page_id"))))
        parts.append(_facts(main, "constant", F.lit("terms_url"), zero,
                            F.concat(F.lit(vocab.STUDY_URL), "study_id", F.lit("/terms"))))
    facts = parts[0].withColumn("page_ord", F.col("page_ord").cast("bigint"))
    for part in parts[1:]:
        facts = facts.unionByName(part.withColumn("page_ord", F.col("page_ord").cast("bigint")))
    # scalars and lists are both resolved from the facts, which are far smaller than the pages
    return cut_lineage(facts.filter("value IS NOT NULL"), "facts")


def study_records(
    routed: DataFrame, facts: DataFrame, profile: str, run_time: str
) -> tuple[DataFrame, DataFrame]:
    """Records of one profile with their lists for the signals, and all lists in long form."""
    scalars = record.resolve_scalars(facts, profile)
    lists = record.resolve_lists(facts, profile)
    main = routed.filter(F.col("page_type") == profile).groupBy("study_id").agg(
        F.min_by("url", "page_ord").alias("source_url"))
    # the three lists the decision reads are short fields of one study, gathered in order
    gathered = lists.filter(F.col("field").isin("language", "kind_of_data", "collection_mode"))
    arrays = gathered.groupBy("study_id").pivot(
        "field", ["language", "kind_of_data", "collection_mode"]).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("order", "value"))), lambda s: s["value"]))
    records = (
        scalars.join(main, "study_id").join(arrays, "study_id", "left")
        .withColumn("page_type", F.lit(profile))
        .withColumn("repository", F.lit(vocab.REPOSITORY_NAME[profile]))
        .withColumn("repository_url", F.lit(vocab.REPOSITORY_URL[profile]))
        .withColumn("schema_version", F.lit(vocab.SCHEMA_VERSION))
        .withColumn("generated_at_utc", F.lit(run_time))
        .withColumn("final_url", F.col("source_url"))
        .withColumn("nested_study_id", F.col("study_id"))
    )
    records = records.withColumns({f"provenance_{c}": F.col(c) for c in (
        "repository", "repository_url", "page_type", "schema_version")})
    return record.normalise_record(records), lists


# which column holds a required field: nested ones have columns of their own
REQUIRED = {name: "nested_study_id" if name == "identifiers.study_id" else name.replace(".", "_")
            for name in schemas.REQUIRED}


def evaluate(
    routed: DataFrame, profile: str, repository_id: int, folder: str, run_time: str, query: str
) -> dict[str, DataFrame]:
    """Everything a run knows of the studies of one profile.

    `projects` are the stored rows with `qualitative`, `has_files`, version and
    licence; `versions`, `files`, `people`, `keywords` and `funding` are their
    children, `failures` the records that are not valid.
    """
    tree = page_trees(routed, profile)
    facts = page_facts(routed, profile, tree)
    records, lists = study_records(routed, facts, profile, run_time)
    checked = cut_lineage(checked_records(records), "records")
    files = cut_lineage(page_files(tree, profile), "files")
    options = P.download_options(tree, "page_id").select("page_id.study_id")
    offered = files.select("study_id").unionByName(options).distinct().withColumn(
        "has_files", F.lit(True))
    rows = project_rows(checked, repository_id, vocab.REPOSITORY_URL[profile], folder, run_time,
                        query)
    facts_of = checked.filter("valid").select(
        "study_id", "qualitative", F.col("version").alias("project_version"),
        F.col("published_date").alias("project_date"),
        codes.license_name("license").alias("license"))
    projects = rows.withColumn("study_id", F.col("project_id").cast("string")).join(
        facts_of, "study_id").join(offered, "study_id", "left").withColumn(
        "has_files", F.coalesce("has_files", F.lit(False)))
    projects = cut_lineage(projects, "projects")
    keys = projects.select("study_id", "project_key")
    stated = versions.with_unlisted(
        listed_versions(tree, profile), projects.select("study_id", "project_version",
                                                        "project_date"), "study_id", "place")
    people = lists.filter(F.col("field").isin("authors", "contributors")).select(
        "study_id", F.when(F.col("field") == "authors", F.lit("AUTHOR"))
        .otherwise(F.lit("CONTRIBUTOR")).alias("role"), F.col("value").alias("name"))
    return {
        "projects": projects,
        "versions": versions.version_rows(stated, "study_id", "place").join(keys, "study_id"),
        "files": files.join(keys, "study_id"),
        "people": people.distinct().join(keys, "study_id"),
        "keywords": lists.filter("field = 'keywords'").select(
            "study_id", F.col("value").alias("keyword")).distinct().join(keys, "study_id"),
        "funding": study_funding(tree, profile).join(keys, "study_id"),
        "failures": quality.split_valid(checked, codes.project_key(
            F.lit(repository_id), first_number("study_id"), "page_type"), run_time)[1],
    }


def catalogue(
    run: dict[str, DataFrame], fetched: DataFrame, run_time: str,
    after: dict[str, int] | None = None, more_failures: DataFrame | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Seen project keys, and the new rows of every stored table for the kept projects.

    A project is kept when it qualifies. `fetched` has study_id, file_name and
    status of the downloads, and uri where it tells files of one name apart; of
    several attempts the last one counts, and a file without one as
    unresponsive. `after` has the largest stored ids (`api_run.last_ids`),
    `more_failures` failure rows of the run beside those of records, such as
    `unsupported` pages.
    """
    after = after or {}
    kept = run["projects"].filter("qualitative")
    keys = kept.select("project_key")
    mine = lambda name: run[name].join(keys, "project_key", "left_semi")
    number = lambda table, df, *by: dedupe.row_numbers(
        df, list(by), after=after.get(table, 0))
    stored = cut_lineage(number(
        "project_versions", mine("versions").withColumn("release_time", F.lit(""))
        .withColumn("download_date", F.lit(run_time)), "project_key", "place")
        .withColumnRenamed("id", "version_key"), "versions")
    chosen = stored.groupBy("project_key").agg(
        F.min_by("version_key", F.struct(~F.col("is_current"), F.col("place"))).alias("version_key"))
    named = ["study_id", "file_name", *(["uri"] if "uri" in fetched.columns else [])]
    failures = run["failures"] if more_failures is None else run["failures"].unionByName(more_failures)
    files = (
        mine("files").join(chosen, "project_key")
        .join(file_ops.last_states(fetched, named), named, "left")
        .withColumn("file_type", codes.row_type("file_name", F.col("file_type")))
        .withColumn("status", codes.file_status(F.coalesce("status", F.lit("")))))
    new = {
        "projects": kept, "project_versions": stored,
        "files": number("files", files, "project_key", "file_name", "file_type", "uri"),
        "keywords": number("keywords", mine("keywords"), "project_key", "keyword"),
        "person_role": number("person_role", mine("people"), "project_key", "role", "name"),
        "licenses": number("licenses", kept.filter("license <> ''").select(
            "project_key", "license"), "project_key"),
        "failures": number("failures", failures, "project_key", "reason"),
    }
    return run["projects"].select("project_key"), {
        name: df.select(*TABLES[name].names) for name, df in new.items()}


def checked_records(records: DataFrame) -> DataFrame:
    """Records with validation columns and the qualitative decision."""
    checked = quality.validate(records, REQUIRED, quality.doi_rules("doi"))
    return signals.phrase_signals(checked, "summary", "abstract", "kind_of_data",
                                  "collection_mode")


def project_rows(checked: DataFrame, repository_id: int, repository_url: str, folder: str,
                 run_time: str, query: str) -> DataFrame:
    """Stored project rows of the valid records."""
    return record.project_rows(
        checked.filter("valid").withColumn("query_string", F.lit(query)), repository_id,
        repository_url, folder, "SCRAPING", run_time)


