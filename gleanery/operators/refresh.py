"""Keyed refresh of the stored tables.

All rows of every project a run has seen are replaced by what the run kept: a
project that no longer qualifies disappears, an unseen one stays. Applying the
same batch twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.session import work_folder

KEY = "project_key"
BUCKETS = 256


def refresh(stored: DataFrame, seen: DataFrame, new: DataFrame, key: str = KEY) -> DataFrame:
    """Stored rows of unseen projects plus the new rows."""
    kept = stored.join(seen.select(key).distinct(), key, "left_anti").select(*stored.columns)
    return kept.unionByName(new.select(*stored.columns))


def refresh_tables(
    stored: dict[str, DataFrame], seen: DataFrame, new: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Refresh every stored table; tables without new rows lose the seen projects."""
    return {
        name: refresh(table, seen, new[name]) if name in new
        else table.join(seen.select(KEY).distinct(), KEY, "left_anti").select(*table.columns)
        for name, table in stored.items()
    }


def stale_paths(projects: DataFrame, stored: DataFrame, root: str) -> DataFrame:
    """Folders to remove before a project's files are put in place: own and former one."""
    former = stored.select(KEY, F.nullif("download_project_folder", F.lit("")).alias("_former"))
    both = F.array_compact(F.array("download_project_folder", "_former"))
    return (
        projects.join(former, KEY, "left")
        .select(KEY, F.explode(F.array_distinct(both)).alias("folder"))
        .select(KEY, F.concat(F.lit(f"{root}/"), "folder").alias("path"))
    )


def with_existing_folder(projects: DataFrame, stored: DataFrame) -> DataFrame:
    """Add the folder a project had at the last run, NULL for new projects."""
    former = stored.select(
        KEY, F.nullif("download_project_folder", F.lit("")).alias("existing_folder"))
    return projects.join(former, KEY, "left")


# ---------------------------------------------------------------- stored tables on disk

def bucket(buckets: int, key: str = KEY):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_buckets(seen: DataFrame, buckets: int) -> list[int]:
    """Buckets the seen projects are in; at most `buckets` numbers reach the driver."""
    return [r[0] for r in seen.select(bucket(buckets).alias("b")).distinct().collect()]


def create_table(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write a table partitioned by key bucket, so that a refresh touches few partitions.

    Choose the number of buckets so that one holds some gigabytes; it stays
    the same for the life of the table.
    """
    _write(df, path, buckets)


def read_table(
    spark: SparkSession, path: str, schema, buckets: list[int] | None = None
) -> DataFrame:
    """A stored table, or some of its buckets, without bucket column and markers."""
    stored = T.StructType([*schema.fields, T.StructField("_marker", T.BooleanType()),
                           T.StructField("key_bucket", T.IntegerType())])
    df = spark.read.schema(stored).parquet(path)
    if buckets is not None:
        df = df.filter(F.col("key_bucket").isin(buckets))
    return df.filter(F.col("_marker").isNull()).select(*schema.names)


def refresh_path(
    spark: SparkSession, path: str, schema, seen: DataFrame, new: DataFrame,
    buckets: int = BUCKETS,
) -> None:
    """Refresh a stored table in place, rewriting only the buckets of the seen projects.

    The new content of these buckets is staged in the shared folder first, so a
    lost executor or a failed job leaves the table as it was, and running the
    batch again gives the same result. Every touched bucket also gets a marker
    row: a bucket whose projects are all gone is overwritten as well.
    """
    ids = touched_buckets(seen, buckets)
    if not ids:
        return
    touched = spark.createDataFrame([(i,) for i in ids], "key_bucket int")
    # the filter is on the partition column: only touched buckets are read
    current = read_table(spark, path, schema, ids)
    result = refresh(current, seen, new)
    staged = work_folder(spark, "refresh")
    _write(result, staged, buckets, markers=touched)
    (spark.read.parquet(staged).hint("rebalance", "key_bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("key_bucket").parquet(path))


def _write(
    df: DataFrame, path: str, buckets: int, markers: DataFrame | None = None
) -> None:
    rows = df.withColumn("key_bucket", bucket(buckets)).withColumn(
        "_marker", F.lit(None).cast("boolean"))
    if markers is not None:
        rows = rows.unionByName(
            markers.withColumn("_marker", F.lit(True)), allowMissingColumns=True)
    # rebalancing gives each task few buckets, and splits a bucket that one project fills
    rows.hint("rebalance", "key_bucket").write.mode("overwrite").partitionBy(
        "key_bucket").parquet(path)
