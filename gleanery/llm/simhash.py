"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint of 64 bits is cut into 32 segments of two bits, and embedded as
the vector of the segments' bit counts. The Manhattan distance of two vectors
never exceeds the number of differing bits, so it bounds the search from below.
The grid over this space has cells of width one; as a whole vector is too fine
a cell, the segments are put in groups, and a cell holds the counts of some
groups: vectors within `bits` differ in at most so many groups, and for every
such choice of groups there is a cell that holds none of them. Pairs in a cell pass the Manhattan bound and are then verified exactly.

A cell may hold many fingerprints of one large group of near copies. Not all
their pairs are formed: first each fingerprint is linked with the smallest one
of its cells, and components are taken; then only pairs of different components
are examined, a cell's most frequent component being on one side only. Every
link between different components is found, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

from .common import WORD_RE, components, partitions, unsent

SEED = 42
BITS = 4
GROUPS = 11
#: The low bit of every two-bit segment (fixed value).
LOW = 0x5555555555555555
_UPPER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def fingerprint(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """The SimHash of one text: a bit is set if it is in over half of the shingle hashes.

    Only A-Z are lower-cased. Shingles count as often as they occur; fewer words
    than a shingle has are one shingle; no words (or null) give zero.
    """
    words = WORD_RE.findall(text or "")
    if not words:
        return 0
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    line = b" ".join(raw).translate(_UPPER)
    ends = np.cumsum([len(w) + 1 for w in raw]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[shingle - 1:] if len(raw) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    set_bits, n = np.zeros(64, dtype=np.int64), len(last)
    # blocks bound the memory of a very long text
    for a in range(0, n, 50_000):
        hashes = np.array([digest(line[i:j], seed) for i, j in
                           zip(starts[a:a + 50_000].tolist(), last[a:a + 50_000].tolist())],
                          dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def of_hashes(hashes: np.ndarray) -> int:
    """The SimHash of 64-bit hashes, signed: a bit is set if it is in over half of them."""
    set_bits = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), 50_000):
        block = hashes[a:a + 50_000].astype(">i8")
        set_bits += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number. No shuffle."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()],
                              dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)],
                                             names=["doc_id", "fp"])

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        code, "doc_id long, fp long")


def embedding(fp: Column) -> Column:
    """The bit counts 0, 1, 2 of the 32 segments, written as 00, 01, 11: the Manhattan
    distance of two vectors is the number of differing bits of this code."""
    low, next_bit = F.lit(LOW), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(next_bit).bitwiseAND(low).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(next_bit).bitwiseAND(low), 1))


def steiner_blocks() -> list[frozenset]:
    """The 66 blocks of five points out of eleven that hold each four points exactly once.

    The squares modulo 11 and infinity, moved by x + 1, 3x and -1/x, give the
    132 blocks of six points on twelve; those with infinity, without it, are
    the blocks here.
    """
    far = 11
    moves = [lambda x: x if x == far else (x + 1) % 11, lambda x: x if x == far else 3 * x % 11,
             lambda x: {far: 0, 0: far}.get(x, -pow(x, -1, 11) % 11 if x % far else 0)]
    start = frozenset([far, *(x * x % 11 for x in range(1, 11))])
    blocks, work = {start}, [start]
    while work:
        block = work.pop()
        for move in moves:
            moved = frozenset(map(move, block))
            if moved not in blocks:
                blocks.add(moved)
                work.append(moved)
    return sorted((b - {far} for b in blocks if far in b), key=sorted)


def cell_masks(bits: int, groups: int) -> list[int]:
    """Which bits of the embedding make a cell: for any `bits` groups one holds none of them.

    Four of eleven groups always lie in a block of five of the design above:
    66 cells hold the other six groups each. Otherwise a cell is any choice of
    groups - bits groups.
    """
    segments = np.array_split(np.arange(32), groups)
    parts = [sum(3 << (2 * int(s)) for s in part) for part in segments]
    if (bits, groups) == (4, 11):
        chosen = [[g for g in range(11) if g not in block] for block in steiner_blocks()]
    else:
        chosen = [list(c) for c in combinations(range(groups), groups - bits)]
    masks = [sum(parts[g] for g in some) for some in chosen]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spread(prints: DataFrame) -> DataFrame:
    """The fingerprints, which become many rows each, dealt to as many tasks as a shuffle has.

    A hash of the key deals them: Spark leaves out a repartition by the key itself where an
    aggregation has dealt by it before, and puts what that left, a few bytes, into a task or two.
    """
    return prints.select("fp").repartition(partitions(prints.sparkSession), F.xxhash64("fp"))


def links(prints: DataFrame, bits: int = BITS, groups: int = GROUPS) -> DataFrame:
    """(node, root) of the components of distinct fingerprints `fp` that differ in at most
    `bits` bits; fingerprints that are the smallest of their component have no row."""
    if not 0 <= bits < groups <= 32:
        raise ValueError("there must be more groups than bits, and at most 32")
    vector = embedding(F.col("fp"))
    cells = spread(prints).select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), vector.bitwiseAND(F.lit(m)).alias("counts"))
        for i, m in enumerate(cell_masks(bits, groups))])).alias("cell"))
    cells = cells.select("cell.part", "cell.counts", "fp")
    shared = (cells.groupBy("part", "counts").agg(F.min("fp").alias("first"), F.max("fp").alias("l"))
              .filter("first <> l").drop("l"))
    members = cut_lineage(unsent(cells).join(shared, ["part", "counts"]), "cells")

    def near(a: Column, b: Column) -> Column:
        return ((F.bit_count(embedding(a).bitwiseXOR(embedding(b))) <= bits)
                & (F.bit_count(a.bitwiseXOR(b)) <= bits))

    star = components(members.filter(near(F.col("fp"), F.col("first")))
                      .select(F.col("fp").alias("a"), F.col("first").alias("b")))
    named = cut_lineage(members.join(star.withColumnRenamed("node", "fp"), "fp", "left").select(
        "part", "counts", "fp", F.coalesce("root", "fp").alias("root")), "cells")
    # the most frequent component of every cell that has several
    held = named.groupBy("part", "counts", "root").agg(F.count("*").alias("n"))
    usual = (held.groupBy("part", "counts").agg(
        F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("several"))
        .filter("several > 1").select("part", "counts", F.col("top.root").alias("usual")))
    mixed = unsent(named).join(usual, ["part", "counts"])
    fewer = mixed.filter("root <> usual").select(
        "part", "counts", F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    more = mixed.select("part", "counts", "fp", "root")
    across = (unsent(fewer).join(more, ["part", "counts"])
              .filter((F.col("root") != F.col("root2")) & near(F.col("fp"), F.col("fp2")))
              .select(F.col("root").alias("a"), F.col("root2").alias("b")).distinct())
    joined = components(across)
    renamed = star.join(joined.select(F.col("node").alias("root"), F.col("root").alias("higher")),
                        "root", "left")
    return renamed.select("node", F.coalesce("higher", "root").alias("root")).unionByName(joined)


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = BITS, groups: int = GROUPS,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id): one row per input row.

    component_id is the smallest key of all documents that links of at most
    `bits` differing bits reach. Rows of equal fingerprint are one node, so
    copies cost nothing more. Texts without words share the fingerprint zero.
    A null key has a row and links others, but names no component unless all
    its keys are null. An empty table gives no rows.
    """
    prints = cut_lineage(fingerprints(docs, shingle, text, key), "fingerprints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = links(nodes.select("fp"), bits, groups)
    # each node with its root; a root that links others stands for itself
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = placed.join(named, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """A signed 64-bit number as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                         **options) -> DataFrame:
    """The rows of `docs` that stay: of each component the document with the smallest key.

    Rows without a key stay. Rows that repeat that smallest key all stay.
    """
    found = near_duplicates(docs, text=text, key=key, **options)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("row")).withColumn(
        "doc_id", F.col(f"row.`{key}`").cast("long"))
    return rows.join(gone, "doc_id", "left_anti").select("row.*")
