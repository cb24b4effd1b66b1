"""First-wins and merging de-duplication.

Everything is an aggregation with map-side combine: a key that holds a third
of the rows is reduced to one candidate per map task before it is shuffled. A
window would bring the whole key into one task; the few windows here run over
pages, blocks or buckets whose size is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

PAGES_PER_BLOCK = 1024


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    `order` has to tell the rows of a key apart; the result then does not
    depend on partitioning.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def distinct_studies(df: DataFrame, order: list[str], scope: list[str]) -> DataFrame:
    """Studies that differ in id, URL or title within a scope, first one kept."""
    return first_wins(df, scope + ["study_id", "url", "title"], order)


def merge_duplicates(
    df: DataFrame, keys: list[str], order: list[str], texts: list[str], flags: list[str] = (),
    values: list[str] = (),
) -> DataFrame:
    """One row per key that takes each field from the first row where it is filled.

    Fields are chosen independently of each other. Flags are true if any row
    says so and NULL if none says anything. `raw_occurrence_count` counts rows,
    `first_order` is the place of the earliest one.
    """
    place = F.struct(*order)
    picks = [F.min_by(F.when(F.col(c) != "", F.col(c)),
                      F.when(F.col(c) != "", place)).alias(c) for c in texts]
    picks += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in values]
    picks += [F.bool_or(c).alias(c) for c in flags]
    return df.groupBy(*keys).agg(
        *picks, F.count(F.lit(1)).alias("raw_occurrence_count"), F.min(place).alias("first_order")
    )


def merge_list_values(
    df: DataFrame, keys: list[str], order: list[str], column: str
) -> DataFrame:
    """Ordered union of a list field, as one row per distinct entry.

    The long form stays distributed however many entries a key has; `place`
    sorts the entries by first appearance.
    """
    entries = df.select(*keys, F.struct(*order).alias("_o"),
                        F.posexplode(column).alias("_p", column))
    return entries.groupBy(*keys, column).agg(F.min(F.struct("_o", "_p")).alias("place"))


def new_and_duplicate_counts(
    df: DataFrame, scope: list[str], page: str, identity: list[str]
) -> DataFrame:
    """Per page: entries, and entries whose study no earlier page of the scope had.

    A study repeated on the very page that introduces it counts as new each time.
    """
    per_page = df.groupBy(*scope, *identity, page).agg(F.count(F.lit(1)).alias("_n"))
    first = per_page.groupBy(*scope, *identity).agg(
        F.min(F.struct(F.col(page), F.col("_n"))).alias("_f"))
    new = first.groupBy(*scope, F.col(f"_f.{page}").alias(page)).agg(
        F.sum("_f._n").alias("new_entries"))
    total = per_page.groupBy(*scope, page).agg(F.sum("_n").alias("entries"))
    joined = total.join(new, [*scope, page], "left")
    return joined.withColumn("new_entries", F.coalesce("new_entries", F.lit(0).cast("bigint")))


def search_pages(
    hits: DataFrame, scope: list[str], page: str, pos: str, identity: list[str], total: str,
) -> DataFrame:
    """One row per page of search hits: its size, what is new on it, and its digest.

    `new_entries` are the entries of studies that no earlier page had,
    `new_studies` counts those studies once. Two 64-bit digests over place and
    identity tell equal pages; they merge across partitions, so no page is ever
    collected. One scan and three shuffles, each behind a map-side combination.
    """
    ident = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity])
    none = F.lit(0).cast("bigint")
    entries = hits.groupBy(*scope, page, *identity).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(F.col(pos), ident)).alias("_d1"),
        F.bit_xor(F.xxhash64(ident, F.col(pos), F.lit(1))).alias("_d2"),
        F.first(total, ignorenulls=True).alias("_total"))
    first = entries.groupBy(*scope, *identity).agg(
        F.min(F.struct(F.col(page), F.col("_n"))).alias("_f"))
    rows = entries.select(
        *scope, page, "_n", "_d1", "_d2", "_total", none.alias("_new"), none.alias("_studies"),
    ).unionByName(first.select(
        *scope, F.col(f"_f.{page}").alias(page), none.alias("_n"), none.alias("_d1"),
        none.alias("_d2"), F.lit(None).cast(hits.schema[total].dataType).alias("_total"),
        F.col("_f._n").alias("_new"), F.lit(1).cast("bigint").alias("_studies")))
    return rows.groupBy(*scope, page).agg(
        F.sum("_n").alias("entries"), F.sum("_new").alias("new_entries"),
        F.sum("_studies").alias("new_studies"), F.bit_xor("_d1").alias("_d1"),
        F.bit_xor("_d2").alias("_d2"), F.first("_total", ignorenulls=True).alias("_total"))


def guard_pages(pages: DataFrame, scope: list[str], page: str, rows: int) -> DataFrame:
    """Where paging of each scope ends, and why, from one row per page.

    Paging stops at the first page that repeats an earlier page exactly, or
    (past the start) brings no new study, or comes after the reported total was
    reached. Running totals use two levels: windows hold the pages of a block,
    or the blocks of a scope.
    """
    blocked = pages.withColumn(
        "_b", F.floor(F.col(page) / F.lit(rows * PAGES_PER_BLOCK)).cast("bigint"))
    inside = Window.partitionBy(*scope, "_b").orderBy(page).rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = Window.partitionBy(*scope).orderBy("_b")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = blocked.groupBy(*scope, "_b").agg(
        F.sum("new_entries").alias("_s"), F.min_by("_total", page).alias("_t")).select(
        *scope, "_b", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_offset"),
        F.first("_t").over(whole).alias("reported_total"))
    same = Window.partitionBy(*scope, "_d1", "_d2", "entries")
    placed = (
        blocked.withColumn("_inside", F.coalesce(F.sum("new_entries").over(inside), F.lit(0)))
        .join(offsets, [*scope, "_b"]).withColumn("_first", F.min(page).over(same)))
    repeated = F.col(page) > F.col("_first")
    stale = (F.col(page) > 0) & (F.col("new_entries") == 0)
    before = F.col("_offset") + F.col("_inside")
    complete = (F.col("reported_total") > 0) & (before >= F.col("reported_total"))
    stops = placed.groupBy(*scope, "reported_total").agg(
        F.min(F.when(repeated, F.col(page))).alias("_repeat"),
        F.min(F.when(stale, F.col(page))).alias("_stale"),
        F.min(F.when(complete, F.col(page))).alias("_complete"),
    )
    guard = F.least("_repeat", "_stale")
    hit = guard.isNotNull() & (F.col("_complete").isNull() | (guard < F.col("_complete")))
    return stops.select(
        *scope, "reported_total", F.least("_repeat", "_stale", "_complete").alias("stop_start"),
        F.coalesce(hit, F.lit(False)).alias("guard_triggered"),
        F.when(hit, guard).alias("guard_start"),
        F.when(hit & (F.col("_repeat") == guard), F.lit("repeated_page_signature"))
        .when(hit, F.lit("page_contains_zero_new_studies")).otherwise(F.lit(""))
        .alias("guard_reason"),
    )


def page_guards(
    hits: DataFrame, scope: list[str], page: str, pos: str, identity: list[str], total: str,
    rows: int,
) -> DataFrame:
    """`guard_pages` of search hits; the small frame of pages is written once in between."""
    pages = cut_lineage(search_pages(hits, scope, page, pos, identity, total), "pages")
    return guard_pages(pages, scope, page, rows)


def keep_until_stop(hits: DataFrame, guards: DataFrame, scope: list[str], page: str) -> DataFrame:
    """Hits on the pages before the stop of their scope."""
    stops = guards.select(*scope, "stop_start")
    return (
        hits.join(stops, scope)
        .filter(F.col("stop_start").isNull() | (F.col(page) < F.col("stop_start")))
        .drop("stop_start")
    )


def search_summary(
    hits: DataFrame, scope: list[str], page: str, pos: str, identity: list[str], total: str,
    rows: int,
) -> DataFrame:
    """Totals of each search: reported, extracted, pages read, and the guard's state.

    A study is extracted when the first page that has it was read, so all
    totals come from the frame of pages. A search that stops at once has no row.
    """
    pages = cut_lineage(search_pages(hits, scope, page, pos, identity, total), "pages")
    guards = guard_pages(pages, scope, page, rows)
    read = keep_until_stop(pages.select(*scope, page, "new_studies"), guards, scope, page)
    totals = read.groupBy(*scope).agg(
        F.sum("new_studies").alias("studies_extracted"), F.count(F.lit(1)).alias("pages_fetched"))
    return (
        guards.join(totals, scope)
        .select(*scope,
                F.when(F.col("reported_total") > 0, F.col("reported_total"))
                .otherwise(F.col("studies_extracted")).alias("total_studies"),
                "studies_extracted", "pages_fetched", "guard_triggered", "guard_reason",
                "guard_start")
    )


def first_titles(
    hits: DataFrame, scope: list[str], pos: str, title: str, limit: int = 3
) -> DataFrame:
    """The first few non-blank titles of each page, one row per title.

    The rank filter is applied before the shuffle as well (window group limit),
    so a page sends at most `limit` rows per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*scope).orderBy(pos))
    return (
        hits.filter(F.col(title) != "").select(*scope, pos, title)
        .withColumn("place", rank).filter(F.col("place") <= limit)
        .select(*scope, F.col("place").cast("bigint").alias("place"), title)
    )


def remaining(candidates: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose key is not in `done` (frontier minus visited)."""
    return candidates.join(done.select(*keys).distinct(), keys, "left_anti")


def row_numbers(
    df: DataFrame, keys: list[str], buckets: int = 65_536, after: int = 0
) -> DataFrame:
    """Dense ids after+1..after+n as column `id`, the same on every run.

    `after` is the largest id a stored table already holds, so that ids stay
    unique over all runs.

    Rows are spread over hash buckets by their natural key, numbered inside a
    bucket, and shifted by the sizes of the buckets before it. No sort sees more
    than one bucket, a 65536th of the rows. `keys` has to be unique.
    """
    spread = df.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    sizes = spread.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket: this unpartitioned window never sees more than `buckets` rows
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_b").orderBy(*keys)
    return (
        spread.join(offsets, "_b")
        .withColumn("id", F.lit(after) + F.col("_offset") + F.row_number().over(inside))
        .drop("_b", "_offset")
    )

