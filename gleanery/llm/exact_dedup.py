"""Exact dedup by content sort: range-partitioned, externally sorted, neighbours compared.

Only DataFrame functions. Rows are dealt by sampled splitters over a short key
(the first characters and a digest of the text), sorted there by the whole
text, and each run of equal whole texts is one group. A text that holds more
than 1/HOT_SHARE of all rows is cut into salted runs; what its whole group is
has been aggregated before the shuffle, with at most HOT_SHARE result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions

#: At most this many texts hold more than 1/HOT_SHARE of all rows: the bound of the broadcasts.
HOT_SHARE = 2048
#: Characters of the text in a splitter; a digest breaks ties of longer common beginnings.
SPLITTER_CHARS = 24


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id",
                 normalise=lambda c: c) -> DataFrame:
    """(row, keep_id, group_size, kept, text_sha256): one row per input row.

    `row` is the whole input row as a struct, so extra columns of any name
    pass through. Texts are equal when `normalise(text)` is identical; a null
    text counts as empty. The largest key of a group stays; a null key stays
    only where the group has no other, and of repeated rows with the largest
    key one stays. An empty table gives no rows.
    """
    spark = docs.sparkSession
    content: Column = F.coalesce(normalise(F.col(f"row.`{text}`")), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col(f"row.`{key}`").cast("long").alias("k"), F.xxhash64(content).alias("h"))
    total = rows.count()
    counted = rows.groupBy("h").agg(F.count("*").alias("n"))
    hot = counted.filter(F.col("n") * HOT_SHARE > total).select("h", "n")
    # whole groups of the hot texts, combined before the shuffle and compared by whole text
    whole = (rows.join(F.broadcast(hot), "h").groupBy("h", content.alias("t"))
             .agg(F.max("k").alias("hot_keep"), F.count("*").alias("hot_size"))
             .select("h", F.sha2("t", 256).alias("sha"), "hot_keep", "hot_size"))
    dealt = (rows.withColumn("sha", F.sha2(content, 256))
             .join(F.broadcast(whole), ["h", "sha"], "left")
             .withColumn("salt", F.when(F.col("hot_size").isNotNull(), F.pmod(
                 F.xxhash64("k"), F.ceil(F.col("hot_size") * HOT_SHARE / F.lit(max(total, 1)))))
                 .otherwise(F.lit(0)).cast("long"))
             .withColumn("head", F.substring(content, 1, SPLITTER_CHARS)))
    dealt = dealt.repartitionByRange(partitions(spark), "head", "h", "salt")
    # the range partitioning covers the window's keys, so nothing is shuffled again
    run = (Window.partitionBy("head", "h", "salt", content)
           .orderBy(F.col("k").desc_nulls_last()))
    all_rows = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = (dealt.withColumn("run_keep", F.first("k").over(all_rows))
             .withColumn("run_size", F.count("*").over(all_rows))
             .withColumn("place", F.row_number().over(run)))
    keep = F.when(F.col("hot_size").isNotNull(), F.col("hot_keep")).otherwise(F.col("run_keep"))
    size = F.coalesce("hot_size", "run_size")
    # a null largest key means a group of null keys only; its salted run is one run
    return found.select(
        "row", keep.alias("keep_id"), size.alias("group_size"),
        ((F.col("place") == 1) & F.col("k").eqNullSafe(keep)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id",
                normalise=lambda c: c) -> DataFrame:
    """The rows that stay, with the columns of `docs`."""
    return exact_groups(docs, text, key, normalise).filter("kept").select("row.*")
