"""Product codes of vectors: Lloyd's rounds over cover trees.

A vector becomes integers, is cut into `parts` equal parts, and each part is
replaced by the nearest entry of its position's codebook. Rows are taken in
blocks where they lie; for each block and part position the distinct points are
put into a cover tree once: every level halves the scale, its centres lie
farther apart than the scale, and each centre lies within the scale above of
its parent. A node knows its radius and, summed over all below it, its points
and their number.

A round walks the trees from the top. By the triangle inequality an entry is
out for a whole subtree if it is farther from the centre than the nearest one
by over twice the radius. Where one entry is left the subtree goes to it with
its sums; only the others are descended, and below the last level points are
compared exactly, in integers, with the entries that are left.

Trees are written once to the shared folder and read by every round. What a
round gathers is a sum and a count for each entry.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from gleanery.session import cut_lineage

#: Rows of a block, and about how many distinct points share a leaf.
BLOCK = 4096
LEAF = 8
#: Squared distances of larger components leave 64 bits.
MOST = 1 << 26
#: Rounding may only keep more entries in question.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Neither null nor with null, NaN or infinite components."""
    number = lambda x: x.cast("double")
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        (F.abs(number(x)) < F.lit(float("inf"))) & ~F.isnan(number(x)), F.lit(False)))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    found = np.floor(np.asarray(values, dtype=np.float64) * scale)
    if found.size and np.abs(found).max() >= MOST:
        raise ValueError(f"a component times {scale} is {MOST} or more")
    return found.astype(np.int64)


def in_parts(rows: np.ndarray, parts: int) -> np.ndarray:
    """(row, part, position): equal parts, a length that can't be divided being filled with zeros."""
    width = -(-rows.shape[1] // parts)
    filled = np.zeros((len(rows), parts * width), dtype=np.int64)
    filled[:, :rows.shape[1]] = rows
    return filled.reshape(len(rows), parts, width)


def _apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre).astype(np.float64) ** 2).sum(axis=1))


class CoverTree:
    """A cover tree over points with weights.

    `centres` are indices of points in the order in which they became centres:
    the first sizes[l] are the centres of level l. `parents[l]` gives, for those
    of level l + 1, their parents in level l. `leaf` is each point's centre in
    the last level.
    """

    def __init__(self, points, weights, centres, sizes, parents, leaf):
        self.points, self.weights, self.leaf = points, weights, leaf
        self.centres, self.sizes, self.parents = centres, sizes, parents
        # the ancestor of every leaf in each level, and what lies below it
        self.above = [np.arange(len(centres))]
        for up in reversed(parents):
            self.above.insert(0, up[self.above[0]])
        self.radius, self.sums, self.counts = [], [], []
        for size, above in zip(sizes, self.above):
            node = above[leaf]
            radius, counts = np.zeros(size), np.zeros(size, dtype=np.int64)
            sums = np.zeros((size, points.shape[1]), dtype=np.int64)
            np.maximum.at(radius, node, _apart(points, points[centres[node]]))
            np.add.at(counts, node, weights)
            np.add.at(sums, node, points * weights[:, None])
            self.radius.append(radius)
            self.counts.append(counts)
            self.sums.append(sums)

    @classmethod
    def build(cls, points: np.ndarray, weights: np.ndarray, leaf: int = LEAF) -> CoverTree:
        """Farthest points first: whatever is not covered at a scale becomes a centre of it."""
        n = len(points)
        near, owner = _apart(points, points[0]), np.zeros(n, dtype=np.int64)
        centres, sizes, parents = [0], [1], []
        scale = near.max()
        while near.max() > 0 and len(centres) * leaf < n:
            scale, before = scale / 2, owner.copy()
            up = list(range(len(centres)))
            while near.max() > scale and len(centres) * leaf < n:
                new = int(near.argmax())
                up.append(before[new])
                centres.append(new)
                apart = _apart(points, points[new])
                closer = apart < near
                near[closer], owner[closer] = apart[closer], len(centres) - 1
            if len(centres) > sizes[-1]:
                sizes.append(len(centres))
                parents.append(np.array(up))
        return cls(points, weights, np.array(centres), sizes, parents, owner)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the nearest entry of each point, the lowest of equally near ones; sums and counts
        of the points of each entry)."""
        k = len(entries)
        sums, counts = np.zeros_like(entries), np.zeros(k, dtype=np.int64)
        of_leaf = np.full(len(self.centres), -1)
        nodes, open_for = np.zeros(1, dtype=np.int64), np.ones((1, k), dtype=bool)
        for level, size in enumerate(self.sizes):
            apart = np.sqrt(((self.points[self.centres[nodes]][:, None, :] - entries[None]).astype(
                np.float64) ** 2).sum(axis=2))
            apart[~open_for] = np.inf
            reach = apart.min(axis=1) + 2 * self.radius[level][nodes]
            open_for = apart <= (reach * (1 + SLACK) + SLACK)[:, None]
            decided = open_for.sum(axis=1) == 1
            took, entry = nodes[decided], open_for[decided].argmax(axis=1)
            np.add.at(sums, entry, self.sums[level][took])
            np.add.at(counts, entry, self.counts[level][took])
            to = np.full(size, -1)
            to[took] = entry
            of_leaf = np.maximum(of_leaf, to[self.above[level]])
            nodes, open_for = nodes[~decided], open_for[~decided]
            if not len(nodes) or level + 1 == len(self.sizes):
                break
            place = np.full(size, -1)
            place[nodes] = np.arange(len(nodes))
            parent = place[self.parents[level]]
            nodes = np.flatnonzero(parent >= 0)
            open_for = open_for[parent[nodes]]
        code = of_leaf[self.leaf]
        rest = np.flatnonzero(code < 0)
        if len(rest):
            place = np.full(len(self.centres), -1)
            place[nodes] = np.arange(len(nodes))
            far = squared(self.points[rest], entries)
            far[~open_for[place[self.leaf[rest]]]] = np.iinfo(np.int64).max
            code[rest] = far.argmin(axis=1)
            np.add.at(counts, code[rest], self.weights[rest])
            np.add.at(sums, code[rest], self.points[rest] * self.weights[rest][:, None])
        return code, sums, counts

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}points": self.points, f"{name}weights": self.weights, f"{name}leaf": self.leaf,
                f"{name}centres": self.centres, f"{name}sizes": np.array(self.sizes),
                f"{name}parents": np.concatenate([*self.parents, np.zeros(0)]).astype(np.int64)}

    @classmethod
    def of_arrays(cls, held, name: str) -> CoverTree:
        sizes = held[f"{name}sizes"].tolist()
        parents = np.split(held[f"{name}parents"], np.cumsum(sizes[1:])[:-1]) if len(sizes) > 1 else []
        return cls(held[f"{name}points"], held[f"{name}weights"], held[f"{name}centres"], sizes, parents,
                   held[f"{name}leaf"])


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (point, entry), a component at a time."""
    far = np.zeros((len(points), len(entries)), dtype=np.int64)
    for i in range(points.shape[1]):
        far += (points[:, i, None] - entries[None, :, i]) ** 2
    return far


def _forest(rows: np.ndarray) -> bytes:
    """The trees of all part positions of a block (row, part, position), and each row's points."""
    held = {}
    for p in range(rows.shape[1]):
        points, of_row, weights = np.unique(rows[:, p], axis=0, return_inverse=True, return_counts=True)
        held |= CoverTree.build(points, weights).arrays(f"{p}.")
        held[f"{p}.rows"] = of_row.reshape(-1)
    out = io.BytesIO()
    np.savez(out, **held)
    return out.getvalue()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            some = batch.slice(start, BLOCK)
            if n and n + some.num_rows > BLOCK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
            held.append(some)
            n += some.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def forests(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """(rows, trees): one row for each block of rows (row, v), all `v` of one length."""
    shape = StructType([StructField("rows", ArrayType(vectors.schema["row"].dataType)),
                        StructField("trees", BinaryType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            values, rows = (block.column(c).combine_chunks() for c in ("v", "row"))
            values = values.flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, -1)
            rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                 pa.array([_forest(in_parts(whole_numbers(values, scale), parts))], pa.binary())],
                names=["rows", "trees"])

    return vectors.select("row", "v").mapInArrow(code, shape)


def totals(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(part, entry, n, sums): what one round gathers, one row for each used entry."""
    sent = trees.sparkSession.sparkContext.broadcast(codebooks)
    width = codebooks.shape[2]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            for blob in batch.column("trees"):
                held = np.load(io.BytesIO(blob.as_py()))
                for p in range(len(books)):
                    _, s, c = CoverTree.of_arrays(held, f"{p}.").assign(books[p])
                    sums[p] += s
                    counts[p] += c
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = trees.select("trees").mapInArrow(code, "part int, entry int, n long, sums array<long>")
    return found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", i)) for i in range(width)]).alias("sums"))


def lloyd(trees: DataFrame, codebooks: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after `rounds` rounds; an entry no part is nearest to stays as it is."""
    for _ in range(rounds):
        codebooks = codebooks.copy()
        for row in totals(trees, codebooks).collect():  # at most one row for each entry
            codebooks[row.part, row.entry] = [s // row.n for s in row.sums]
    return codebooks


def codes(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(row, code, error) of every row: two hex digits for each part, and the squared distance."""
    sent = trees.sparkSession.sparkContext.broadcast(codebooks)
    row = trees.schema["rows"].dataType.elementType
    shape = StructType([StructField("row", row), StructField("code", StringType()),
                        StructField("error", LongType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        digits = np.array([f"{i:02x}" for i in range(256)])
        for batch in batches:
            for i in range(batch.num_rows):
                held = np.load(io.BytesIO(batch.column("trees")[i].as_py()))
                text, error = [], 0
                for p, entries in enumerate(books):
                    tree, rows = CoverTree.of_arrays(held, f"{p}."), held[f"{p}.rows"]
                    near, _, _ = tree.assign(entries)
                    far = ((tree.points - entries[near]) ** 2).sum(axis=1)
                    text.append(digits[near[rows]])
                    error = error + far[rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rows").slice(i, 1).flatten(),
                     pa.array(["".join(line) for line in np.stack(text, axis=1).tolist()]),
                     pa.array(error, pa.int64())], names=["row", "code", "error"])

    return trees.mapInArrow(code, shape)


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
             vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(row, code, error, codebooks_sha256): one row for each usable vector.

    `row` holds the other columns of the input, whatever their names; `code` two
    hex digits for each part. The first entries are the parts of the vectors
    with the smallest keys (null keys last, then by the vector itself).
    Repeated rows are vectors each. Vectors of several lengths have codebooks
    for each length; a length that `parts` doesn't divide is filled up with
    zeros. Components must stay under 2**26 when multiplied by `scale`. No
    usable vector gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry must fit in two hex digits")
    spark = vectors.sparkSession
    others = [F.col(f"`{c}`") for c in vectors.columns if c != vector]
    kept = vectors.filter(usable(F.col(f"`{vector}`"))).select(
        F.struct(*others).alias("row"), F.col(f"`{vector}`").alias("v"))
    lengths = sorted(r.n for r in kept.select(F.size("v").alias("n")).distinct().collect())
    out = []
    for n in lengths:
        mine = kept.filter(F.size("v") == n)
        first = (mine.orderBy(F.col(f"row.`{key}`").asc_nulls_last(), "v").limit(entries)
                 .select("v").collect())
        books = in_parts(whole_numbers(np.array([r.v for r in first], dtype=np.float64).reshape(
            len(first), n), scale), parts).transpose(1, 0, 2).copy()
        trees = cut_lineage(forests(mine, parts, scale), "trees")
        books = lloyd(trees, books, rounds)
        out.append(codes(trees, books).withColumn("codebooks_sha256", F.lit(digest(books))))
    if not out:
        shape = StructType([StructField("row", kept.schema["row"].dataType), StructField("code", StringType()),
                            StructField("error", LongType()), StructField("codebooks_sha256", StringType())])
        return spark.createDataFrame([], shape)
    whole = out[0]
    for one in out[1:]:
        whole = whole.unionByName(one)
    return whole


def with_group_error(coded: DataFrame, group: str) -> DataFrame:
    """`coded` with label_error: its error summed over all rows of an equal row.`group`, nulls together."""
    coded = cut_lineage(coded.withColumn("g", F.col(f"row.`{group}`")), "codes")
    sums = cut_lineage(coded.groupBy("g").agg(F.sum("error").alias("label_error")), "sums")
    return coded.join(sums.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2"))).drop("g", "g2")
