"""Substring dedup: seeds at winnowed anchors, extended both ways to maximal repeats.

Every window of `window` words has one anchor: the k-gram with the least hash in
it. Equal windows have equal anchors at equal offsets, so a window can only
repeat where its anchor does: anchors that occur once end the search for all
windows they govern. A repeated anchor is extended both ways as far as any of
its windows reaches (window - k words to each side). Where the whole extension
occurs again, so does every window in it: one comparison settles a copy.
Anchors of one hash with several extensions (the borders of passages, near
copies) are extended to every window that they govern, and the windows are
compared. Runs of repeated windows are the maximal repeats; their words go.

Occurrences are aggregated by hash with map-side combination; pairs of
occurrences are never formed, so a line that a third of all documents share
costs as much as its occurrences. Extensions and windows are compared by two
independent 64-bit hashes (of the anchor, and of the whole).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

from .common import WORD_RE, coded_words, ragged, runs_of

#: Words in an anchor.
ANCHOR = 8
#: Odd multipliers of the rolling sums, one for anchors and one for windows (fixed values).
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
ANCHORS = "id long, row long, low int, high int, anchor long, reach long"


def _word_hashes(distinct, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w.encode("utf-8", "surrogatepass"), seed) for w in distinct],
                    dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64),
                               np.cumprod(np.full(max(n - 1, 0), base, np.uint64))])[:n]


class Rolling:
    """Hashes of any runs of consecutive words, from prefix sums modulo 2^64."""

    def __init__(self, hashes: np.ndarray, base: int):
        n = len(hashes)
        with np.errstate(over="ignore"):
            self.powers = _powers(base, n + 1)
            self.back = _powers(pow(base, -1, 1 << 64), n + 1)
            self.sums = np.concatenate([np.zeros(1, np.uint64),
                                        np.cumsum(hashes * self.powers[:n], dtype=np.uint64)])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """One hash for each [start, stop), its length mixed in."""
        with np.errstate(over="ignore"):
            x = (self.sums[stop] - self.sums[start]) * self.back[start]
            x += (stop - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
            return x ^ (x >> np.uint64(29))


def _anchors(words: np.ndarray, anchors: Rolling, window: int, k: int):
    """Of one document's words [a, b): positions of the anchors, and the first and last start
    of the windows each governs. `words` is (a, b) in the rolling sums."""
    a, b = words
    grams = np.arange(a, b - k + 1)
    hashes = anchors.of(grams, grams + k)
    # the least hash in each run of window - k + 1 grams, the leftmost of equals, by doubling
    span, width = window - k + 1, 1
    least, at = hashes.copy(), np.arange(len(grams))
    while width < span:
        step = min(width, span - width)
        right = least[step:]
        take = right < least[:len(right)]
        at = np.where(take, at[step:], at[:len(right)])
        least = np.where(take, right, least[:len(right)])
        width += step
    change = np.flatnonzero(np.diff(at)) + 1
    low = np.concatenate([[0], change])
    high = np.concatenate([change - 1, [len(at) - 1]])
    return at[low], low, high, hashes[at[low]]


def find_anchors(docs: DataFrame, window: int = 35, k: int = ANCHOR) -> DataFrame:
    """(id, row, low, high, anchor, reach) of (id, row, text), one row for each anchor.

    `low` to `high` are the starts of the windows it governs, `reach` is the
    hash of its whole extension (`window - k` words to each side, as far as the
    document goes) and of the anchor's place in it.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part in runs_of(texts):
                codes, distinct, ends = coded_words(texts[part])
                if not len(codes):
                    continue
                anchors = Rolling(_word_hashes(distinct, 1)[codes], BASES[0])
                whole = Rolling(_word_hashes(distinct, 2)[codes], BASES[1])
                out, a = [], 0
                for i, b in enumerate(ends.tolist()):
                    if b - a >= window:
                        pos, low, high, hashes = _anchors((a, b), anchors, window, k)
                        left = np.maximum(pos + a + k - window, a)
                        reach = whole.of(left, np.minimum(pos + a + window, b))
                        with np.errstate(over="ignore"):
                            reach += (pos + a - left).astype(np.uint64) * np.uint64(BASES[0])
                        out.append((np.full(len(pos), i + part.start), low, high, hashes, reach))
                    a = b
                if not out:
                    continue
                row, low, high, anchor, reach = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(x).take(pa.array(row)) for x in ("id", "row")]
                    + [pa.array(x.astype(np.int32)) for x in (low, high)]
                    + [pa.array(x.view(np.int64)) for x in (anchor, reach)],
                    names=["id", "row", "low", "high", "anchor", "reach"])

    return docs.mapInArrow(scan, ANCHORS)


def _govern(docs: DataFrame, open_anchors: DataFrame, window: int) -> DataFrame:
    """(anchor, whole, id, row, start): the windows that open anchors govern."""
    wanted = open_anchors.groupBy("id", "row").agg(
        F.collect_list(F.struct("low", "high", "anchor")).alias("seeds"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            seeds = batch.column("seeds")
            for part in runs_of(texts):
                codes, distinct, ends = coded_words(texts[part])
                whole = Rolling(_word_hashes(distinct, 2)[codes], BASES[1])
                mine = seeds.slice(part.start, part.stop - part.start)
                of_row = np.repeat(np.arange(len(mine)), np.diff(mine.offsets.to_numpy()))
                flat = mine.flatten()
                low, high, anchor = (flat.field(x).to_numpy() for x in ("low", "high", "anchor"))
                count = (high - low + 1).astype(np.int64)
                start = ragged(low.astype(np.int64), count)
                row = np.repeat(of_row, count)
                begin = np.concatenate([[0], ends[:-1]])[row] + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(anchor, count)),
                     pa.array(whole.of(begin, begin + window).view(np.int64)),
                     batch.column("id").take(pa.array(row + part.start)),
                     batch.column("row").take(pa.array(row + part.start)),
                     pa.array(start.astype(np.int32))],
                    names=["anchor", "whole", "id", "row", "start"])

    return docs.join(wanted, ["id", "row"]).select("id", "row", "text", "seeds").mapInArrow(
        extend, "anchor long, whole long, id long, row long, start int")


def repeats(docs: DataFrame, window: int = 35, k: int = ANCHOR) -> DataFrame:
    """(id, row, low, high): runs of starts of windows that occur more than once.

    `docs` is (id, row, text); id and row together tell rows apart, neither null.
    """
    if not 0 < k <= window:
        raise ValueError("an anchor is no longer than a window")
    anchors = cut_lineage(find_anchors(docs, window, k), "anchors")
    # anchors that occur once are no seeds. Counts are written before they are joined: next to
    # a plain shuffle the join can split an anchor that a third of all documents share
    more = cut_lineage(anchors.groupBy("anchor").agg(F.count("*").alias("n"))
                       .filter("n > 1").drop("n"), "repeated")
    seeds = cut_lineage(anchors.join(more, "anchor", "left_semi"), "seeds")
    here = F.xxhash64("id", "row")
    reached = cut_lineage(seeds.groupBy("anchor", "reach").agg(
        F.count("*").alias("n"), F.min(here).alias("first")), "reached")
    several = cut_lineage(reached.groupBy("anchor").agg(F.count("*").alias("n"))
                          .filter("n > 1").drop("n"), "several")
    seeded = seeds.join(reached, ["anchor", "reach"])
    settled = seeded.filter("n > 1").select("id", "row", "low", "high")
    # of a settled extension one document stands for all
    unsettled = (seeded.filter((F.col("n") == 1) | (here == F.col("first")))
                 .join(several, "anchor", "left_semi").select("id", "row", "low", "high", "anchor"))
    windows = cut_lineage(_govern(docs, unsettled, window), "windows")
    again = cut_lineage(windows.groupBy("anchor", "whole").agg(F.count("*").alias("n"))
                        .filter("n > 1").drop("n"), "again")
    found = windows.join(again, ["anchor", "whole"], "left_semi").select(
        "id", "row", F.col("start").alias("low"), F.col("start").alias("high"))
    return settled.unionByName(found)


def remove_repeats(docs: DataFrame, window: int = 35, k: int = ANCHOR, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed): one row per input row.

    `kept` is the words that no repeated window covers, joined by one space;
    `removed` is the maximal repeats as array<struct<start, end>> in words.
    A null text has no words; a text under `window` words is left alone. Rows
    that repeat a longer text lose it all, all of them; rows that repeat a key,
    and rows without one, are told apart by their texts. No rows give no rows.
    """
    named = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    rows = named.select("doc_id", F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"),
                        F.xxhash64("text", F.col("doc_id").isNull()).alias("row"), "text")
    runs = (repeats(rows.select("id", "row", "text"), window, k).groupBy("id", "row")
            .agg(F.collect_set(F.struct("low", "high")).alias("runs")))
    joined = rows.join(runs, ["id", "row"], "left").select("doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept, removed = [], [], [], []
            for words, runs in zip(batch.column("text").to_pylist(),
                                   batch.column("runs").to_pylist()):
                words, spans = WORD_RE.findall(words or ""), []
                for low, high in sorted((r["low"], r["high"] + window) for r in runs or ()):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                left, at = [], 0
                for low, high in spans:
                    left += words[at:low]
                    at = high
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(" ".join(left))
                removed.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int32()),
                                                       ("end", pa.int32())])))],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"])

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string, "
                                  "removed array<struct<start:int,end:int>>")
