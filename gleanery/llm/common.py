"""What the operators share: words, small batches, salting of hot keys, components."""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

#: A word: a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

#: Every key is cut into buckets of at most 1/HOT_PARTS of all rows (or one).
HOT_PARTS = 4096


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, for explicit range partitioning."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unsent(rows: DataFrame) -> DataFrame:
    """Rows of cells, many for each text: the join above them is a sort-merge join, never a broadcast.

    Spark sizes rows that an explode has multiplied as if there were one for each input row, and
    files by their compressed bytes; a side it takes for small is built in the driver.
    """
    return rows.hint("merge")


#: Calls that drop what a Python worker keeps from one task for the next.
KEPT: list[Callable[[], None]] = []


def forget() -> None:
    """Drop what other operators' tasks have kept in this worker."""
    for drop in KEPT:
        drop()


def give_back() -> None:
    """Return freed memory to the system: Spark keeps workers, and both libraries what they freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(code: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that holds nothing of operators before it and leaves
    no freed memory in the worker, which idles beside the stages that follow."""

    @functools.wraps(code)
    def run(batches: Iterator) -> Iterator:
        forget()
        try:
            yield from code(batches)
        finally:
            give_back()

    return run


def runs_of(texts: Sequence[str], most_chars: int = 1_500_000) -> Iterator[slice]:
    """Slices of a batch whose texts together hold about `most_chars`; a longer text is alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most_chars:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def coded_words(texts: Sequence[str], find=WORD_RE.findall):
    """Words of all texts as (code of each word, distinct words, ends of the texts)."""
    found = [find(t) for t in texts]
    ends = np.cumsum([len(w) for w in found]) if found else np.zeros(0, dtype=np.int64)
    if any("\0" in t for t in texts):  # factorize ends a string there
        number: dict[str, int] = {}
        codes = np.array([number.setdefault(w, len(number)) for words in found for w in words],
                         dtype=np.int64)
        return codes, list(number), ends
    flat = np.fromiter(chain.from_iterable(found), dtype=object, count=int(ends[-1]) if found else 0)
    codes, distinct = pd.factorize(flat)
    return codes, distinct, ends


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def bucket_of(rows: Column, total: int, *identity: Column) -> Column:
    """A bucket number that cuts a key of `rows` rows into parts of about total/HOT_PARTS rows.

    All keys together have at most HOT_PARTS buckets besides one for each key.
    """
    parts = F.ceil(rows * F.lit(HOT_PARTS) / F.lit(max(total, 1))).cast("long")
    return F.pmod(F.xxhash64(*identity), F.greatest(parts, F.lit(1).cast("long")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b) that is not the smallest of its component.

    Alternating large-star and small-star steps: each step is two aggregations
    with map-side combination and two joins on a node, and its result is
    written to the shared folder, so that a lost executor re-reads files. The
    loop ends when a step changes nothing; links stay distributed throughout.
    """
    edges = cut_lineage(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lower, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lower.withColumnRenamed("m", "v")).distinct())
        edges = cut_lineage(small, "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.bit_xor(F.xxhash64("v", "u", F.lit(1))).alias("y")).first()
    return row.n, row.x, row.y
