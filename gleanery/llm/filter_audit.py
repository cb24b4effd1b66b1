"""How a row of filters act on one another: what each removes, first or alone, in every order.

The filters of a document are bits of a mask. All but one look at the document
alone and are column expressions. The last asks whether a smaller key has an
identical text anywhere. A counting Bloom sketch answers it for most documents
without moving any text: every task adds the hashes of its texts to two bit
planes (counted once, counted again), the planes of all tasks are merged, and a
text with a counter that was not counted again is unique for certain. Only the
texts that may repeat are shuffled, grouped by their whole content for their
smallest key, and marked.

What the orders need is additive: the numbers of documents of each mask. They
are counted per part before anything else is shuffled, and the figures of all
orders and steps are differences of sums over sub-masks, computed from at most
2**filters counts a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from gleanery.session import cut_lineage

from .common import WORD, partitions

#: Counters for each document, and the bound of all (16 MB of bits): beyond about 2**24
#: documents more unique texts count as possible repeats, and the result stays the same.
COUNTERS_EACH = 16
MOST_COUNTERS = 1 << 27
#: Counters of one segment, the unit in which planes are merged.
SEGMENT = 1 << 20
#: A probe is the upper bits of the hash times one of these (odd, so nothing is lost).
PROBES = (np.uint64(1), np.uint64(0x9E3779B97F4A7C15))


def local_filters(content: Column) -> list[Column]:
    """Whether a document fails: too short (A), too repetitive (B), too many capitals (C),
    odd characters (D). `content` is a text without nulls."""
    words = F.regexp_extract_all(content, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(content, "[^A-Z]+", ""))
    return [n < 200, F.lit(100) * distinct < F.lit(50) * n,
            F.lit(100) * capitals > F.lit(2) * F.length(content), content.rlike("[#$%&*|]")]


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The counters of each hash, one array for each probe."""
    return [((hashes.view(np.uint64) * m) >> np.uint64(64 - bits)).astype(np.int64) for m in PROBES]


def _counted(planes: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, bits: int) -> None:
    """Adds hashes to the planes (counted, counted again), one byte a counter."""
    once, again = planes
    for place in _places(hashes, bits):
        found, times = np.unique(place, return_counts=True)
        again[found] |= (times > 1) | once[found]
        once[found] = True


def sketch(hashes: DataFrame, most_counters: int = MOST_COUNTERS) -> tuple[np.ndarray, int]:
    """(the plane of counters that were counted again, packed; the number of bits of a counter's
    place) for the column `h` of a frame: at most most_counters / 8 bytes."""
    n = hashes.count()
    wanted = max(min(n * COUNTERS_EACH, most_counters), 1 << 10)
    bits = int(wanted - 1).bit_length()
    bits -= (1 << bits) > max(most_counters, 1 << 10)
    size = 1 << bits
    part = min(size, SEGMENT)
    shape = "segment int, once binary, again binary"

    def rows(segments, once, again):
        return pa.RecordBatch.from_arrays(
            [pa.array(segments, pa.int32()), pa.array(once, pa.binary()), pa.array(again, pa.binary())],
            names=["segment", "once", "again"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            if planes is None:
                planes = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
            _counted(planes, batch.column("h").to_numpy(), bits)
        for s in range(size // part if planes is not None else 0):
            mine = slice(s * part, (s + 1) * part)
            if planes[0][mine].any():
                yield rows([s], *([np.packbits(p[mine]).tobytes()] for p in planes))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for s, *both in zip(*(c.to_pylist() for c in batch.columns)):
                once, again = (np.frombuffer(b, np.uint8) for b in both)
                if s in held:
                    held[s][1] |= again | (held[s][0] & once)
                    held[s][0] |= once
                else:
                    held[s] = [once.copy(), again.copy()]
        for s, (once, again) in held.items():
            yield rows([s], [once.tobytes()], [again.tobytes()])

    # planes of tasks meet in two steps, so that no task reads those of all tasks
    width = partitions(hashes.sparkSession)
    counted = hashes.select("h").mapInArrow(count, shape)
    halfway = (counted.withColumn("deal", F.pmod(F.spark_partition_id(), F.lit(64)))
               .repartition(width, "segment", "deal").select("segment", "once", "again")
               .mapInArrow(merge, shape))
    merged = halfway.repartition(width, "segment").mapInArrow(merge, shape)
    plane = np.zeros(size // 8, dtype=np.uint8)
    for row in merged.select("segment", "again").collect():  # size / 8 bytes
        at = row.segment * part // 8
        plane[at:at + part // 8] = np.frombuffer(row.again, np.uint8)
    return plane, bits


def may_repeat(plane: np.ndarray, bits: int, spark):
    """An expression over a hash column: could another row have the same hash?"""
    sent = spark.sparkContext.broadcast(plane)

    @F.arrow_udf(BooleanType())
    def probe(hashes: pa.Array) -> pa.Array:
        found = np.ones(len(hashes), dtype=bool)
        for place in _places(hashes.to_numpy(zero_copy_only=False), bits):
            found &= (sent.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        return pa.array(found)

    return probe


def masks(docs: DataFrame, filters=local_filters, text: str = "text", key: str = "doc_id",
          part: str = "source", most_counters: int = MOST_COUNTERS) -> DataFrame:
    """(k, part, mask, n): how many rows of a key and part fail which filters, bit i for filter i
    and the last bit for a text that a smaller key has too.

    A null text is empty, and so is a null part. A null key is neither smaller
    nor larger than another. Rows that repeat a key count each.
    """
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"),
                       F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       content.alias("t"), F.xxhash64(content).alias("h"),
                       F.xxhash64(F.lit(1), content).alias("h2"))
    local = filters(F.col("t"))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(local)), F.lit(0)).cast("int")
    seen = cut_lineage(rows.select("k", "part", "h", "h2", mask.alias("mask")), "flags")
    probe = may_repeat(*sketch(seen, most_counters), docs.sparkSession)
    unique = seen.filter(~probe("h")).select("k", "part", "mask")
    # texts are compared whole; what comes back is known by both hashes of the text
    least = cut_lineage(rows.filter(probe("h")).groupBy("h", "h2", "t")
                        .agg(F.min("k").alias("least"), F.max("k").alias("most"))
                        .filter("least < most").select("h", "h2", "least"), "repeats")
    marked = seen.filter(probe("h")).join(least, ["h", "h2"], "left").select("k", "part", (
        F.col("mask") + F.when(F.col("k") > F.col("least"), 1 << len(local)).otherwise(0)).alias("mask"))
    return unique.unionByName(marked).groupBy("k", "part", "mask").agg(F.count("*").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE", filters=local_filters,
          text: str = "text", key: str = "doc_id", part: str = "source",
          most_counters: int = MOST_COUNTERS) -> DataFrame:
    """One row for each part, order of the filters and step, with counts of documents.

    kept: after the step. removed: by it. redundant: fails its filter but is
    removed earlier. unique_fails: fails its filter only. good_lost, toxic_lost:
    removed by it and labelled so (any row of `labels`: quality = 1, toxic = 1).
    shapley: what its filter removes, summed over all orders. No documents give
    no rows. `filters` gives all filters but the last letter's, the repeated text.
    """
    if len(letters) != len(filters(F.lit(""))) + 1 or len(letters) > 6:
        raise ValueError("a letter for each filter and one for repeated texts, at most six")
    whole, size = (1 << len(letters)) - 1, 1 << len(letters)
    marks = labels.groupBy(F.col(f"`{key}`").cast("long").alias("k")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    of_rows = masks(docs, filters, text, key, part, most_counters)
    held = of_rows.join(marks, "k", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    # below[m]: documents whose failures all lie in m; alone[m]: whose failures are m
    below = lambda c: F.array(*[
        F.sum(F.when(F.col("mask").bitwiseAND(F.lit(whole ^ m)) == 0, F.col(c)).otherwise(0))
        for m in range(size)])
    alone = F.array(*[F.sum(F.when(F.col("mask") == m, F.col("n")).otherwise(0)) for m in range(size)])
    parts = held.groupBy("part").agg(below("n").alias("below"), below("good").alias("good"),
                                     below("toxic").alias("toxic"), alone.alias("alone"))
    orders = list(permutations(letters))
    steps = F.array(*[F.struct(F.lit("".join(o)).alias("filter_order"), F.array(*[
        F.lit(1 << letters.index(x)) for x in o]).alias("bits")) for o in orders])
    # of the orders, the share in which a filter comes first of those that a document fails
    shares = {m: len(orders) // bin(m).count("1") for m in range(1, size)}
    first = F.array(*[sum((F.col("alone")[m] * n for m, n in shares.items() if m >> i & 1), F.lit(0))
                      for i in range(len(letters))])
    turns = (parts.withColumn("first", first).withColumn("o", F.explode(steps))
             .select("*", F.posexplode("o.bits").alias("at", "bit"))
             .withColumn("prior", F.aggregate(F.slice("o.bits", 1, F.col("at")), F.lit(0),
                                              lambda a, x: a + x)))
    rest = F.lit(whole) - F.col("prior")
    at = lambda c, m: F.get(F.col(c), m)
    removed = at("below", rest) - at("below", rest - F.col("bit"))
    fails = at("below", F.lit(whole)) - at("below", F.lit(whole) - F.col("bit"))
    return turns.select(
        "part", "o.filter_order", (F.col("at") + 1).cast("int").alias("step"),
        at("below", rest - F.col("bit")).alias("kept"), removed.alias("removed"),
        (fails - removed).alias("redundant"), at("alone", F.col("bit")).alias("unique_fails"),
        (at("good", rest) - at("good", rest - F.col("bit"))).alias("good_lost"),
        (at("toxic", rest) - at("toxic", rest - F.col("bit"))).alias("toxic_lost"),
        at("first", F.log2(F.col("bit")).cast("int")).alias("shapley"))
