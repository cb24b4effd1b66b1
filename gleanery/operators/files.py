"""File operators: merge, summarise, flag, match with downloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import codes
from gleanery.functions.text import (
    clean_text, first_non_blank, first_number, safe_file, text_or_null,
)
from gleanery.functions.urls import url_identity
from gleanery.operators.dedupe import first_wins, merge_duplicates
from gleanery.operators.labels import add_download_name
from gleanery.operators.summary import final_status

CATEGORIES = ["documentation", "data", "setup", "other"]


def add_file_key(files: DataFrame, profile: str) -> DataFrame:
    """Add the identity of a file: uuid, else id, else URI, else a composite of names.

    Study pages use dataset, name and content as the composite, project pages
    name and title; folder pages compare URIs by their identifying parameters.
    The URI form is a column of its own, so that it is worked out once.
    """
    uri = url_identity("uri", "file") if profile == "datalumos" else clean_text("uri")
    if profile == "icpsr":
        parts = ["dataset_identifier", "file_name", "file_content"]
    else:
        parts = ["file_name", "title"]
    composite = F.concat_ws("|", *[F.coalesce(clean_text(p), F.lit("")) for p in parts])
    return (
        files.withColumn("_uri", uri)
        .withColumn("file_key", F.coalesce(
            text_or_null("resource_uuid"), text_or_null(F.col("file_id").cast("string")),
            F.when(F.col("_uri") != "", F.col("_uri")), composite))
        .drop("_uri")
    )


def merge_files(
    files: DataFrame, study: list[str], order: list[str], profile: str, texts: list[str],
    flags: list[str] = (), values: list[str] = (),
) -> DataFrame:
    """Unique files of each study, every field from the first row that fills it."""
    keyed = add_file_key(files, profile)
    return merge_duplicates(keyed, study + ["file_key"], order, texts, flags, values)


def file_counters(raw: DataFrame, unique: DataFrame, study: list[str]) -> DataFrame:
    """The fifteen counters of a study, from its raw and its unique rows."""
    def is_true(c):
        return F.col(c).eqNullSafe(F.lit(True))

    def is_false(c):
        return F.col(c).eqNullSafe(F.lit(False))

    category = F.col("file_category")
    listed = raw.groupBy(*study).agg(
        F.count(F.lit(1)).alias("raw_entry_count"),
        F.count_if(is_true("public")).alias("raw_public_entries"),
        F.count_if(is_false("public")).alias("raw_restricted_or_nonpublic_entries"),
        F.count_if(is_true("downloadable")).alias("raw_downloadable_entries"),
    )
    distinct = unique.groupBy(*study).agg(
        F.count(F.lit(1)).alias("unique_file_count"),
        F.count_if(is_true("public")).alias("unique_public_files"),
        F.count_if(is_false("public")).alias("unique_restricted_or_nonpublic_files"),
        F.count_if(is_true("downloadable")).alias("unique_downloadable_files"),
        F.count_if(is_true("downloadable") & is_true("public")).alias("downloadable_public_files"),
        F.count_if(is_true("downloadable") & (category == "documentation"))
        .alias("downloadable_documentation_files"),
        F.count_if(is_true("downloadable") & (category == "data")).alias("downloadable_data_files"),
        *[F.count_if(category == c).alias(f"{c}_file_count") for c in CATEGORIES],
    )
    return listed.join(distinct, study)


def file_histograms(
    raw: DataFrame, unique: DataFrame, study: list[str], fields=("file_format", "file_content")
) -> DataFrame:
    """How often each format and content label occurs, raw and unique; blanks are skipped.

    One row per study, grain, field and value: the number of values is open, so
    they are rows and not entries of one map.
    """
    out = None
    for grain, df in (("raw", raw), ("unique", unique)):
        pairs = F.explode(F.array(*[
            F.struct(F.lit(f).alias("field"), clean_text(f).alias("value")) for f in fields]))
        part = (
            df.select(*study, pairs.alias("p")).select(*study, "p.*")
            .filter(F.col("value") != "")
            .groupBy(*study, "field", "value").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("grain", F.lit(grain))
        )
        out = part if out is None else out.unionByName(part)
    return out


def access_flags(
    unique: DataFrame, study: list[str], page_facts: DataFrame, profile: str
) -> DataFrame:
    """Access flags of every study in `page_facts` from its unique files and its pages.

    `page_facts` holds one row per study with restricted_type, restricted_button
    and download_options. The three profiles follow different rules; an
    undecided flag is NULL.
    """
    per_study = unique.groupBy(*study).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("public").eqNullSafe(F.lit(True))).alias("_public"),
        F.count_if(F.col("public").eqNullSafe(F.lit(False))).alias("_closed"),
        F.count_if(F.col("downloadable").eqNullSafe(F.lit(True))).alias("_down"),
    )
    df = page_facts.join(per_study, study, "left").na.fill(
        0, ["_n", "_public", "_closed", "_down"])
    marked = F.col("restricted_type") | F.col("restricted_button")
    any_public, any_closed, any_file = F.col("_public") > 0, F.col("_closed") > 0, F.col("_n") > 0
    options = F.col("download_options") > 0
    true, false = F.lit(True), F.lit(False)
    if profile == "icpsr":
        restricted = marked
        downloadable = (F.col("_down") > 0) | options
        public = F.when(any_public, true).when(any_closed, false)
        opened = F.when(restricted, false).when(any_file | options, true)
    else:
        restricted = any_closed | marked
        downloadable = F.col("_down") > 0
        public = F.when(any_public, true)
        if profile == "datalumos":
            public = public.when(any_file, false)
        opened = F.when(any_file & (F.col("_public") == F.col("_n")), true).when(any_closed, false)
    return df.select(
        *study, downloadable.alias("has_downloadable_files"),
        restricted.alias("has_restricted_files"), public.alias("has_public_files"),
        opened.alias("open_access"), F.when(restricted, true).alias("authentication_required"),
    )


def count_mismatches(declared: DataFrame, files: DataFrame, study: list[str]) -> DataFrame:
    """Declared file counters that differ from the rows, one row per difference."""
    actual = files.groupBy(*study).agg(
        F.count(F.lit(1)).alias("unique_file_count"),
        *[F.count_if(F.col("file_category") == c).alias(f"{c}_file_count") for c in CATEGORIES])
    names = ["unique_file_count", *[f"{c}_file_count" for c in CATEGORIES]]
    renamed = actual.select(*study, *[F.col(n).alias(f"_{n}") for n in names])
    checks = F.explode(F.array(*[
        F.struct(F.lit(n).alias("counter"), F.col(n).alias("declared"),
                 F.coalesce(F.col(f"_{n}"), F.lit(0)).cast("bigint").alias("actual"))
        for n in names]))
    return (
        declared.join(renamed, study, "left").select(*study, checks.alias("c"))
        .select(*study, "c.*")
        .filter(F.col("declared").isNotNull() & (F.col("declared") != F.col("actual")))
    )


def fallback_candidates(
    menu: DataFrame, files: DataFrame, study: list[str], order: list[str], file_order: list[str]
) -> DataFrame:
    """Files to try one by one: each menu label with what is known of its file.

    The last file of a description describes the label; unknown labels are
    guessed from their own text. Sort by the last three columns to try them.
    """
    known = (
        files.withColumn("label", clean_text("file_description")).filter(F.col("label") != "")
        .groupBy(*study, "label")
        .agg(F.max_by(F.struct("file_name", "file_extension", "file_category"),
                      F.struct(*file_order)).alias("_f"))
    )
    wanted = menu.withColumn("label", clean_text("label")).filter(F.col("label") != "")
    wanted = first_wins(
        wanted.select(*study, "dataset_identifier", "label", "dataset_number", *order),
        study + ["dataset_identifier", "label"], order)
    category = F.coalesce(F.nullif(F.lower(clean_text("_f.file_category")), F.lit("")),
                          F.lit("other"))
    return (
        add_download_name(wanted, "label", "_guess").join(known, study + ["label"], "left")
        .withColumn("file_name", F.coalesce(text_or_null("_f.file_name"), F.col("_guess")))
        .withColumn("file_type", codes.row_type("file_name", F.col("_f.file_extension")))
        .withColumn("file_category", category)
        .withColumn("sort_dataset", F.coalesce(
            first_number(F.col("dataset_number").cast("string")), F.lit(999999)))
        .withColumn("sort_priority", F.coalesce(
            codes.lookup(vocab.CATEGORY_PRIORITY, F.col("file_category")), F.lit(9)).cast("bigint"))
        .withColumn("sort_label", F.lower("label"))
        .select(*study, "dataset_identifier", "label", "file_name", "file_type", "file_category",
                "sort_dataset", "sort_priority", "sort_label")
    )


def download_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Stored file rows: cleaned, blank names out, states coerced, copies removed."""
    return (
        rows.select(
            *keys, clean_text("file_name").alias("file_name"),
            codes.row_type("file_name", F.col("file_type")).alias("file_type"),
            codes.file_status("status").alias("status"))
        .filter(F.col("file_name") != "").distinct()
    )


def last_states(log: DataFrame, keys: list[str], state: str = "status") -> DataFrame:
    """One row for each key of a fetch log: the state of its last attempt.

    The column `attempt` orders the attempts; where a log has none, a success
    counts over a failure.
    """
    known = F.col(state)
    if "attempt" in log.columns:
        last = F.max_by(known, F.struct("attempt", known))
    else:
        last = F.max_by(known, F.struct(F.coalesce(known.cast("string").isin("SUCCEEDED", "200"), F.lit(False)), known))
    return log.groupBy(*keys).agg(last.alias(state))


def file_states(files: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """State of every file from the fetch log, matched by place and safe name.

    Of several attempts the last one counts. A file the log does not know was
    never fetched and counts as unresponsive.
    """
    name = safe_file(F.coalesce(F.nullif(F.col("file_name"), F.lit("")), F.lit("download.bin")))
    left = files.withColumn("safe_name", name)
    return (
        left.join(last_states(log, [*keys, "safe_name"]), [*keys, "safe_name"], "left")
        .withColumn("status", codes.file_status(F.coalesce("status", F.lit(""))))
    )


def download_results(
    log: DataFrame, keys: list[str], study: str = "study_id", version: str = "version"
) -> DataFrame:
    """Outcome of each study version's download from its fetch log, placeholder row included.

    Page types without a public download count as login required, unknown ones
    as unresponsive; a study without a success gets one placeholder file row,
    named after the study id and version of the log.
    """
    kind = F.lower(clean_text("page_type"))
    state = (
        F.when(kind.isin("openicpsr", "datalumos"), F.lit("FAILED_LOGIN_REQUIRED"))
        .when(kind != "icpsr", F.lit(vocab.UNRESPONSIVE))
        .otherwise(codes.http_status_code("http_status", "size_bytes"))
    )
    rows = log.withColumn("status", state)
    done = final_status(rows, [*keys, "page_type", study, version])
    failed = F.col("final_status") != "SUCCEEDED"
    return done.withColumn(
        "placeholder", F.when(failed, codes.package_name("page_type", study, version)))


def download_frontier(projects: DataFrame, key: str, study: str, version: str) -> DataFrame:
    """Request rows of the projects to download: public page types with a positive signal.

    Needs description_signal and page_type; a blank version asks for 1.0.
    """
    wanted = F.coalesce("description_signal", F.lit(False)) & F.col("page_type").isin(
        list(vocab.PAGE_TYPES))
    return projects.filter(wanted).select(
        key, "page_type", F.col(study).cast("string").alias("study_id"),
        first_non_blank(version, F.lit("1.0")).alias("version"))


def package_formats(offered) -> Column:
    """Formats to try: the ones a study offers first, then the defaults."""
    from gleanery.functions.lists import clean_list, union_lists

    return union_lists(clean_list(offered), F.array(*map(F.lit, vocab.PACKAGE_FORMATS)))
