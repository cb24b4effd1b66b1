"""Near-dedup by SimHash links, checked and completed by the Jaccard similarity of word shingles.

Each text has the fingerprint that the operator `simhash` gives its shingles (repeats
count, no words give zero), and that operator links fingerprints of few differing bits
into components. Every text of a component is
checked against its first one on the whole sets of shingles; links that pass stand.
The exact step below then compares only texts that these links leave apart: two texts
that are alike may differ in more bits, and none of them is missed.

Texts are alike when their sets of `shingle`-word shingles have a similarity of
at least `similarity`. All sets are sorted in one common order; two sets that
are alike then share one of their first n - ceil(similarity * n) + 1 shingles
(n is the size of the set), so only those become cells. Of the shared shingles
one is the first in both sets: nothing they share lies before it. A pair is
therefore formed in a cell only where the shingles from the cell's onwards, in
the shorter of the two remainders, are enough for the similarity; every pair
that is alike is formed so. A pair then goes through a bound on its parity bitmaps (how
many of a set's shingles fall on each of BITS places, odd or even: sets differ in
at least as many shingles as their bitmaps in bits) and is verified on the whole
sets. The order puts
shingles that a sample shows to be frequent last: it decides how many
pairs are formed, never which are found. A text with many shingles of its own
has these first, so that the shingles it shares with a large group come too late
for a pair.

Pairs inside a large group are not all formed. What SimHash has not linked yet is linked with
the text of each of its cells that has the fewest shingles before the cell's
(the one with the fewest of its own), then again with the best such text of
another component; both rounds are linear in the cells. Only pairs of different
components are left, with a cell's most frequent component on one side.

A text is known by the 64-bit hash of its bytes, a shingle by that of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import cut_lineage, drop_work

from . import simhash
from .common import WORD_RE, components, lean, ragged, runs_of, unsent

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
#: The sample that shows frequent shingles: a share of all texts, of few texts more; and the bound
#: of the list of them (eight bytes each).
SAMPLE_SHARE = 1 / 4
SAMPLE_ROWS = 2_000
MOST_FREQUENT = 1 << 19
#: Up to so many texts are looked up by a broadcast of their hashes, more by a shuffle.
MOST_SENT = 250_000
#: Places of the parity bitmap of a set.
BITS = 1024
#: Rounding may only let more pairs meet.
SLACK = 1e-6
_NO_WORDS = np.array([xxhash.xxh64_intdigest(b"", SEED)], dtype=np.uint64).view(np.int64)
_UPPER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def all_shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's shingles, repeats included.

    Only A-Z are lower-cased. Fewer words than a shingle has are one shingle.
    """
    raw = [w.encode("utf-8", "surrogatepass") for w in WORD_RE.findall(text or "")]
    if not raw:
        return np.empty(0, dtype=np.int64)
    line = b" ".join(raw).translate(_UPPER)
    ends = np.cumsum([len(w) + 1 for w in raw], dtype=np.int64) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    last = ends[shingle - 1:] if len(raw) >= shingle else np.array([len(line)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts.tolist(), last.tolist())),
                         dtype=np.uint64)
    return hashes.view(np.int64)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The set of a text's shingles, sorted; that of a text without words is one shingle."""
    return np.unique(hashes) if len(hashes) else _NO_WORDS


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; no words (or null) are one shingle."""
    return distinct(all_shingles(text, shingle))


def _texts(docs: DataFrame, text: str, *others: Column) -> DataFrame:
    words = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(words).alias("node"), words.alias("text"), *others)


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, held): all shingles of each of the texts (node, text)."""

    @lean
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in runs_of(texts):
                held = [shingles(t, shingle) for t in texts[part]]
                ends = np.cumsum([0, *map(len, held)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(part.start, len(held)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held)))],
                    names=["node", "held"])

    return texts.mapInArrow(code, "node long, held array<long>")


def frequent(texts: DataFrame, shingle: int) -> np.ndarray:
    """Shingles that several texts of a sample hold, the least frequent first, at most MOST_FREQUENT.

    A shingle that stays out of the list is in few of the sample's texts, or less
    frequent than all that are in it; that bounds how crowded its cell is.
    """
    n = texts.count()
    share = int(min(1.0, max(SAMPLE_SHARE, SAMPLE_ROWS / max(n, 1))) * (1 << 30))
    sample = (texts.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) <= share)
              .dropDuplicates(["node"]))
    often = (shingle_sets(sample, shingle).select(F.explode("held").alias("shingle"))
             .groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 2")
             .orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle").toPandas())
    return often["shingle"].to_numpy(np.int64)[::-1].copy()


def parities(held: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set of hashes as 64-bit numbers."""
    odd = np.bincount(held & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def cells(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(shingle, node, n, pos, bits, fp): the first shingles of each text with their places in the
    common order, the size of the text's whole set, and with the first of them its bitmap and SimHash."""
    often = frequent(texts, shingle)
    order = np.argsort(often, kind="stable")
    known = texts.sparkSession.sparkContext.broadcast((often[order], order))

    @lean
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ranks = known.value
        for batch in batches:
            for some in (batch.slice(a, 200) for a in range(0, batch.num_rows, 200)):
                parts, sizes, bits, prints = [], [], [], []
                for text in some.column("text"):
                    hashes = all_shingles(text.as_py(), shingle)
                    held = distinct(hashes)
                    rank = np.full(len(held), -1)
                    if len(names):
                        at = np.minimum(np.searchsorted(names, held), len(names) - 1)
                        rank = np.where(names[at] == held, ranks[at], -1)
                    first = len(held) - int(np.ceil(similarity * len(held) - SLACK)) + 1
                    parts.append(held[np.lexsort((held, rank))[:first]])
                    sizes.append(len(held))
                    bits.append(parities(held))
                    prints.append(simhash.of_hashes(hashes))
                counts = [len(p) for p in parts]
                pos = ragged(np.zeros(len(counts), dtype=np.int64), np.array(counts))
                ends = np.cumsum(np.where(pos == 0, BITS // 64, 0))
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(parts)),
                    pa.array(np.repeat(some.column("node").to_numpy(), counts)),
                    pa.array(np.repeat(np.array(sizes, dtype=np.int32), counts)),
                    pa.array(pos.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(bits))),
                    pa.array(np.repeat(np.array(prints, dtype=np.int64), counts), mask=pos != 0)],
                    names=["shingle", "node", "n", "pos", "bits", "fp"])

    return texts.mapInArrow(code, "shingle long, node long, n int, pos int, bits array<long>, fp long")


def links(texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of the components of texts (node, text) that are alike; texts that are the
    smallest node of their component have no row."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be over 0 and at most 1")
    found = cut_lineage(cells(texts, shingle, similarity), "cells")
    shared = (found.groupBy("shingle").agg(F.min("node").alias("first"), F.max("node").alias("last"))
              .filter("first <> last").select("shingle"))
    # copies of a text are one member
    members = cut_lineage(unsent(found.drop("bits", "fp")).join(cut_lineage(shared, "shared"), "shingle").distinct(), "cells")
    marks = cut_lineage(found.filter("pos = 0").dropDuplicates(["node"]).select("node", "n", "bits", "fp"), "marks")
    drop_work(found)

    def alike(pairs: DataFrame, star: DataFrame | None = None) -> DataFrame:
        """The distinct pairs (a, b) that are alike, of rows with both members' n and pos; pairs
        that the components `star` hold together are left out."""
        pairs = pairs.filter(_enough("n", "pos", "n2", "pos2", similarity)).select("a", "b").distinct()
        if star is not None:
            root = lambda c: star.select(F.col("node").alias(c), F.col("root").alias(f"r_{c}"))
            pairs = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left").filter(
                F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select("a", "b")
        of = lambda c: marks.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                                    F.col("bits").alias(f"bits_{c}"))
        differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                             F.lit(0), lambda s, x: s + x)
        most = (1 - similarity) / (1 + similarity) * (F.col("n_a") + F.col("n_b")) + SLACK
        pairs = cut_lineage(pairs.join(of("a"), "a").join(of("b"), "b").filter(differ <= most).select("a", "b"), "pairs")
        wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
        few = F.broadcast(wanted) if wanted.count() <= MOST_SENT else wanted
        held = cut_lineage(shingle_sets(texts.join(few, "node", "left_semi").dropDuplicates(["node"]),
                                        shingle), "sets")
        sets = (pairs.join(held.select(F.col("node").alias("a"), F.col("held").alias("held_a")), "a")
                .join(held.select(F.col("node").alias("b"), F.col("held").alias("held_b")), "b"))
        both = F.size(F.array_intersect("held_a", "held_b"))
        found = cut_lineage(sets.filter(
            both / (F.size("held_a") + F.size("held_b") - both) >= similarity).select("a", "b"), "alike")
        drop_work(pairs, wanted, held)
        return found

    # texts that SimHash links, each with the first of its component
    roots = simhash.links(marks.select("fp").distinct()).withColumnRenamed("node", "fp")
    placed = cut_lineage(marks.join(roots, "fp", "left").select(
        "node", "n", F.coalesce("root", "fp").alias("root")), "nodes")
    firsts = placed.groupBy("root").agg(F.min(F.struct("node", "n")).alias("first"))
    near = placed.join(firsts, "root").filter("node <> first.node").select(
        F.col("node").alias("a"), F.col("first.node").alias("b"), "n", F.lit(0).alias("pos"),
        F.col("first.n").alias("n2"), F.lit(0).alias("pos2"))
    star = components(alike(near))

    head = lambda c: F.min(F.struct("pos", "node", "n")).alias(c)
    heads = cut_lineage(members.groupBy("shingle").agg(head("head")), "heads")
    to_head = unsent(members).join(heads, "shingle").filter("node <> head.node").select(
        F.col("node").alias("a"), F.col("head.node").alias("b"), "n", "pos",
        F.col("head.n").alias("n2"), F.col("head.pos").alias("pos2"))
    star = cut_lineage(_contracted(star, alike(to_head, star)), "links")

    def mixed_cells() -> tuple[DataFrame, DataFrame]:
        """The members of cells of several components, with their root and the cell's usual one,
        and what holds them."""
        named = cut_lineage(members.join(star, "node", "left").withColumn(
            "root", F.coalesce("root", "node")), "cells")
        counted = named.groupBy("shingle", "root").agg(F.count("*").alias("rows"), head("head"))
        several = counted.groupBy("shingle").agg(
            F.max(F.struct("rows", "root", "head")).alias("top"), F.count("*").alias("several"))
        usual = cut_lineage(several.filter("several > 1").select(
            "shingle", F.col("top.root").alias("usual"), F.col("top.head").alias("usual_head")), "usual")
        return unsent(named).join(usual, "shingle"), named

    # members of the usual component with the best one of the others, these with the best usual one
    mixed, named = mixed_cells()
    strangers = cut_lineage(mixed.filter("root <> usual").groupBy("shingle").agg(head("other")), "heads")
    other = F.when(F.col("root") == F.col("usual"), F.col("other")).otherwise(F.col("usual_head"))
    again = alike(unsent(mixed).join(strangers, "shingle").withColumn("other", other).select(
        F.col("node").alias("a"), F.col("other.node").alias("b"), "n", "pos",
        F.col("other.n").alias("n2"), F.col("other.pos").alias("pos2")))
    star = cut_lineage(_contracted(star, again), "links")
    drop_work(named)

    mixed, _ = mixed_cells()
    fewer = mixed.filter("root <> usual").select(
        F.col("shingle").alias("cell"), F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"),
        F.col("root").alias("root2"), "usual")
    across = unsent(fewer).join(mixed.select("shingle", "node", "n", "pos", "root"), (
        F.col("cell") == F.col("shingle")) & (F.col("root") != F.col("root2"))
        & ((F.col("root") == F.col("usual")) | (F.col("node") < F.col("node2")))
        & _enough("n", "pos", "n2", "pos2", similarity)).select(
            F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"), "n", "pos", "n2", "pos2")
    return _contracted(star, alike(across))


def _enough(n: str, pos: str, n2: str, pos2: str, similarity: float) -> Column:
    """Can two sets of n and n2 shingles be alike if nothing they share lies before pos and pos2?"""
    left = F.least(F.col(n) - F.col(pos), F.col(n2) - F.col(pos2))
    return ((F.least(n, n2) >= similarity * F.greatest(n, n2) - SLACK)
            & (left >= similarity / (1 + similarity) * (F.col(n) + F.col(n2)) - SLACK))


def _contracted(star: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (node, root) of components `star` after more links (a, b)."""
    roots = star.select("node", "root")
    verified = (pairs.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
                .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
                .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct())
    joined = components(verified)
    renamed = star.join(joined.select(F.col("node").alias("root"), F.col("root").alias("higher")),
                        "root", "left")
    return renamed.select("node", F.coalesce("higher", "root").alias("root")).unionByName(joined)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, component_id): one row per input row.

    component_id is the smallest key of all documents that links of texts alike
    reach. Texts without words are alike. A null key has a row and links
    others, but names no component unless all its keys are null.
    """
    texts = _texts(docs, text)
    rows = cut_lineage(_texts(docs, text, F.col(f"`{key}`").cast("long").alias("doc_id"))
                       .select("node", "doc_id"), "nodes")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = cut_lineage(nodes.join(links(texts, shingle, similarity), "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")), "nodes")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = placed.join(named, "root").select("node", "component_id")
    return rows.join(of_node, "node").select("doc_id", "component_id")


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
