"""Best-fit packing of documents into sequences, after a dominance reduction.

How pieces are packed depends on their lengths alone, and lengths are at most
the capacity: the packing problem is a histogram of at most `capacity` counts,
solved on the driver at a cost that the number of documents does not change.
The reduction fixes, largest length first, sets of at most three pieces that
provably dominate every other way to fill a sequence with that length; what
remains is packed best-fit, longest first. The result, patterns with
multiplicities, is spread over the pieces by their rank among equal lengths.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

from .common import bucket_of, ragged
from .tokens import encoded_runs

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
               text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the token pieces of each document.

    Only a document longer than `capacity` is cut, its first piece being what
    is over beside whole ones. A null text is an empty document: one end id.
    Repeated rows give repeated pieces; a null key stays null.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part, ids, ends in encoded_runs(tokenizer, texts, end_id):
                begins = np.concatenate([[0], ends[:-1]])
                size = ends - begins
                many = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), many)
                piece = ragged(np.zeros_like(many), many)
                # the first piece is what is over beside whole ones
                spare = (many * capacity - size)[row]
                start = np.maximum(piece * capacity - spare, 0)
                length = (piece + 1) * capacity - spare - start
                raw, at = memoryview(ids).cast("B"), (begins[row] + start) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row + part.start)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(pieces, PIECES)


def reduce_instance(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Takes dominating sets out of `counts`; gives them as (lengths, how often).

    For the longest piece j: where nothing fits beside it, it is alone. Where
    any partner fits but no two, or where a partner fills the room exactly, the
    longest that fits dominates. Where two fit but no three, the longest
    partner dominates if it is as long as any two together; it does so with its
    own longest companion if no two pieces fit of which the shorter one is
    longer than that. The lengths are examined from the longest down, once;
    fixing a set takes pieces away and so keeps later proofs true.
    """
    fixed = []
    for j in sorted(counts, reverse=True):
        while counts[j] > 0:
            room = capacity - j
            counts[j] -= 1
            small = sorted(x for x in counts if 0 < x <= room and counts[x] > 0)
            counts[j] += 1
            if not small:
                chosen: tuple[int, ...] = (j,)
            else:
                least = [x for x in small[:3] for _ in range(min(3, counts[x] - (x == j)))][:3]
                best = small[-1]
                if len(least) < 2 or least[0] + least[1] > room:
                    chosen = (j, best)
                elif best == room:
                    chosen = (j, best)  # a perfect fit dominates every set
                elif len(least) < 3 or sum(least) > room:
                    spare = {x: counts[x] - (x == j) for x in small}
                    most, shorter = _pairs(small, spare, room)
                    mate = next((x for x in reversed(small) if best + x <= room
                                 and spare[x] > (x == best)), 0)
                    if best >= most:
                        chosen = (j, best)
                    elif mate and mate >= shorter:
                        chosen = (j, best, mate)
                    else:
                        break
                else:
                    break
            need = Counter(chosen)
            times = min(counts[x] // n for x, n in need.items())
            for x, n in need.items():
                counts[x] -= n * times
            fixed.append((chosen, times))
    return fixed


def _pairs(small: list[int], spare: dict[int, int], room: int) -> tuple[int, int]:
    """Of the pairs that fit: the largest sum, and the longest that the shorter piece can be."""
    most, shorter, low, high = 0, 0, 0, len(small) - 1
    while low <= high:
        a, b = small[low], small[high]
        if a + b > room:
            high -= 1
            continue
        if a != b or spare[a] > 1:
            most, shorter = max(most, a + b), max(shorter, a)
        low += 1
    return most, shorter


def best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: (lengths, how often) patterns.

    Open sequences with equal contents are one group, so a step places many
    pieces of a length at once, each into the fullest sequence it fits.
    """
    groups: dict[int, Counter] = {}  # room left -> contents -> how many
    for length in sorted((x for x in counts if counts[x] > 0), reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in groups if r >= length), default=None)
            if room is None:
                # as many into each new sequence as fit: best-fit would do the same
                each = min(left, capacity // length)
                times = left // each
                groups.setdefault(capacity - each * length, Counter())[(length,) * each] += times
                left -= times * each
                continue
            held = groups[room]
            contents, many = next(iter(held.items()))
            # the fullest sequence stays the fullest until it is full
            each = min(left, room // length)
            times = min(many, left // each)
            held[contents] -= times
            if not held[contents]:
                del held[contents]
            if not held:
                del groups[room]
            groups.setdefault(room - each * length, Counter())[contents + (length,) * each] += times
            left -= times * each
    return [(contents, n) for held in groups.values() for contents, n in held.items()]


def solve(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, how often) that use each piece of the histogram once."""
    counts = Counter({k: v for k, v in histogram.items() if v > 0})
    fixed = reduce_instance(counts, capacity)
    return fixed + best_fit(counts, capacity)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """For runs of ranks of a length: which sequences and offsets they get."""
    rows, used, base = [], Counter(), 0
    for contents, times in patterns:
        offset = 0
        for length in dict.fromkeys(contents):
            each = contents.count(length)
            rows.append((length, used[length], base, offset, each))
            used[length] += each * times
            offset += each * length
        base += times
    frame = pd.DataFrame(rows, columns=["length", "rank", "base", "offset", "each"], dtype="int64")
    return frame.sort_values(["length", "rank"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """The pieces with sequence_id and offset, in as few sequences as the method finds.

    `pieces` has doc_id, piece, length (1 to capacity) and any other columns
    but sequence_id and offset. Null keys and repeated rows are packed like any.
    No pieces give no rows.
    """
    spark = pieces.sparkSession
    held = pieces.groupBy("length").agg(F.count("*").alias("n"))
    # at most `capacity` rows
    histogram = {r.length: r.n for r in held.collect()}
    if any(not 0 < x <= capacity for x in histogram):
        raise ValueError("a piece is empty or longer than the capacity")
    total = sum(histogram.values())
    table = slots(solve(histogram, capacity))
    counted = spark.createDataFrame(list(histogram.items()) or [(1, 0)], "length long, many long")
    identity = [F.col("doc_id"), F.col("piece")]
    dealt = (pieces.join(F.broadcast(counted), "length")
             .withColumn("bucket", bucket_of(F.col("many"), total, *identity)).drop("many"))
    # at most HOT_PARTS + capacity rows
    sizes = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
             .orderBy("length", "bucket").toPandas())
    sizes["before"] = sizes.groupby("length")["n"].cumsum() - sizes["n"]
    before = spark.createDataFrame(
        list(sizes[["length", "bucket", "before"]].astype("int64").itertuples(index=False, name=None))
        or [(1, 0, 0)], "length long, bucket long, before long")
    turn = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(
        *identity, *[F.col(c) for c in ("ids_crc32",) if c in pieces.columns]))
    ranked = (dealt.withColumn("turn", turn).join(F.broadcast(before), ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("turn") - 1))
    arrays = {c: table[c].to_numpy() for c in table}
    first = dict(zip(*np.unique(arrays["length"], return_index=True))) if len(table) else {}

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, at = length.to_numpy(), rank.to_numpy()
        row = np.empty(len(size), dtype=np.int64)
        for value in np.unique(size):
            mine, begin = size == value, int(first[value])
            end = int(np.searchsorted(arrays["length"], value, "right"))
            row[mine] = begin - 1 + np.searchsorted(arrays["rank"][begin:end], at[mine], "right")
        into, each = at - arrays["rank"][row], arrays["each"][row]
        return pd.DataFrame({"sequence_id": arrays["base"][row] + into // each,
                             "offset": arrays["offset"][row] + size * (into % each)})

    return ranked.withColumn("place", place("length", "rank")).select(
        *pieces.columns, "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                   text: str = "text", key: str = "doc_id") -> DataFrame:
    """Cuts and packs documents; the pieces, without texts, are written once in between."""
    return pack(cut_lineage(cut_pieces(docs, tokenizer, capacity, end_id, text, key), "pieces"),
                capacity)
