"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample: clusters by k-means, a cluster that
holds too much of the sample is cut in two until the lists are balanced. Every
vector goes to the list of its nearest centroid; a vector near a boundary is
replicated to further lists whose centroid is about as near. Nearest centroids are found on an in-memory neighbour graph by beam search, many
vectors at a time. A query reads the lists whose centroid is within a ratio of
its nearest centroid's distance, and the distances there are exact. The first
few lists give each query a bound, the distance of its k-th nearest there; the
others only answer with what is within it.

The ratio misses neighbours where a query lies close to its centroid and its
neighbours don't. So every run measures itself: a bounded sample of the queries
meets all rows, and where the lists read hold less than ENOUGH of their true
nearest, all queries read further lists. The k-th distance d found so far and the
radius r of a list (its own vectors lie within r of the centroid) say which: at u = 1
the rule `distance of the centroid <= d + u * r` misses nothing, and the sample
gives the u that it needs.

The index is bounded: at most MOST_LISTS centroids. Posting lists are data of
any size; a long one is cut into shards, and the queries of a list that many read
into blocks: a task meets one shard with one block.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

#: Vectors a list holds on average, as far as MOST_LISTS allows.
LIST_ROWS = 128
#: The bound of the index that driver and workers hold.
MOST_LISTS = 4096
#: The bound of the sample that the index is fitted on.
SAMPLE_ROWS = 32_768
#: Rows in a shard of a posting list, and queries in a block that meets it, about.
SHARD_ROWS = 256
QUERY_ROWS = 4096
#: Queries that measure a run, the share of nearest vectors they must find, and the share that
#: the further lists are chosen for where they don't.
MEASURED = 128
ENOUGH = 0.96
WANTED = 0.98


@dataclass
class Settings:
    replicas: int = 3
    boundary: float = 1.05  # replicate to lists at most this much further than the nearest
    prune: float = 1.17  # read lists at most this much further than the nearest
    degree: int = 24
    beam: int = 512
    first: int = 4  # lists that are read before a query has a bound


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b, for ranking."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _means(points: np.ndarray, k: int, rounds: int, rng) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        of = np.concatenate([distances(points[i:i + 4096], centres).argmin(1)
                             for i in range(0, len(points), 4096)])
        counts = np.bincount(of, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, points)
        there = counts > 0
        centres[there] = sums[there] / counts[there, None]
    of = np.concatenate([distances(points[i:i + 4096], centres).argmin(1)
                         for i in range(0, len(points), 4096)])
    return centres, of


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of about `lists` clusters, none with over twice the mean share of the sample
    (equal points cannot be cut)."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    # far from zero, squares would cancel out what tells vectors apart
    middle = sample.mean(0)
    sample = sample - middle
    centres, of = _means(sample, lists, 8, rng)
    limit, done, work = 2 * len(sample) / lists, [], []
    for i in range(lists):
        work.append(sample[of == i])
    while work:
        points = work.pop()
        if len(points) > limit and (points != points[0]).any():
            _, half = _means(points, 2, 4, rng)
            if 0 < half.sum() < len(half):
                work += [points[half == 0], points[half == 1]]
                continue
        if len(points):
            done.append(points.mean(0))
    return np.array(done)[:MOST_LISTS] + middle


class CentroidGraph:
    """Nearest centroids by beam search on their neighbour graph."""

    def __init__(self, centres: np.ndarray, degree: int):
        self.centres, n = centres, len(centres)
        self.middle = centres.mean(0)
        degree = min(degree, max(n - 1, 1))
        near = np.empty((n, degree), dtype=np.int64)
        for i in range(0, n, 1024):
            gaps = self.all_gaps(centres[i:i + 1024])
            gaps[np.arange(len(gaps)), np.arange(i, i + len(gaps))] = np.inf
            near[i:i + 1024] = np.argsort(gaps, axis=1, kind="stable")[:, :degree]
        # half of the edges lead to nearest neighbours, half far away, so that no part is cut off
        rng = np.random.default_rng(1)
        far = rng.integers(0, n, size=(n, max(2, degree // 3)))
        self.edges = np.concatenate([near, far], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64))

    def all_gaps(self, points: np.ndarray) -> np.ndarray:
        """The distances of all points to all centroids."""
        return distances(points - self.middle, self.centres - self.middle)

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) for each point, nearest first; at most `beam`, -1 and inf behind."""
        q, n = len(points), len(self.centres)
        beam = min(beam, n)
        step = -(-beam // 16)  # centroids whose neighbours are looked at together
        seen = np.zeros((q, n), dtype=bool)
        ids = np.full((q, beam), -1, dtype=np.int64)
        gaps = np.full((q, beam), np.inf)
        opened = np.ones((q, beam), dtype=bool)
        fresh = np.tile(self.entries, (q, 1))
        rows = np.arange(q)
        while len(rows):
            new = ~seen[rows[:, None], fresh]
            seen[rows[:, None], fresh] = True
            # the same centroid may come twice in one step: keep its first place
            order = np.argsort(fresh, axis=1, kind="stable")
            sorted_ids = np.take_along_axis(fresh, order, 1)
            twice = np.zeros_like(new)
            np.put_along_axis(twice, order[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
            new &= ~twice
            gap = np.linalg.norm(self.centres[fresh] - points[rows][:, None, :], axis=2)
            gap[~new] = np.inf
            all_ids = np.concatenate([ids[rows], np.where(new, fresh, -1)], axis=1)
            all_gaps = np.concatenate([gaps[rows], gap], axis=1)
            all_open = np.concatenate([opened[rows], ~new], axis=1)
            best = np.argsort(all_gaps, axis=1, kind="stable")[:, :beam]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            gaps[rows] = np.take_along_axis(all_gaps, best, 1)
            opened[rows] = np.take_along_axis(all_open, best, 1) | (ids[rows] < 0)
            rows = rows[~opened[rows].all(axis=1)]
            if len(rows):
                nearest = np.argsort(opened[rows], axis=1, kind="stable")[:, :step]
                opened[rows[:, None], nearest] = True
                fresh = self.edges[ids[rows[:, None], nearest]].reshape(len(rows), -1)
        return ids, gaps


@dataclass
class Index:
    graph: CentroidGraph
    settings: Settings
    #: Vectors whose nearest centroid is this one, and all postings, by list.
    primary: np.ndarray | None = None
    postings: np.ndarray | None = None
    #: The largest distance of a list's own vectors from its centroid.
    radius: np.ndarray | None = None

    def assign(self, points: np.ndarray) -> list[list[int]]:
        """The lists of each vector, its own first."""
        set_ = self.settings
        ids, gaps = self.graph.search(points, 4 * set_.replicas)
        keep = (ids >= 0) & (gaps <= set_.boundary * gaps[:, :1])
        keep[:, 0] = True
        return [row[near][:set_.replicas].tolist() for row, near in zip(ids, keep)]

    def lists_for(self, points: np.ndarray, k: int) -> list[list[int]]:
        """The lists that a query reads; at least as many as hold k vectors besides it."""
        out: list[list[int]] = [[] for _ in range(len(points))]
        beam, rows = self.settings.beam, np.arange(len(points))
        while len(rows):
            ids, gaps = self.graph.search(points[rows], beam)
            # the beam widens until the farthest centroid found is beyond the ratio
            far = np.where(ids >= 0, gaps, -np.inf).max(axis=1)
            wider = (far <= self.settings.prune * gaps[:, 0]) & (beam < len(self.primary))
            for at, row, gap in zip(rows[~wider].tolist(), ids[~wider], gaps[~wider]):
                there = row >= 0
                keep = there & (gap <= self.settings.prune * gap[0])
                held = np.cumsum(np.where(there, self.primary[row], 0))
                keep |= there & (np.concatenate([[0], held[:-1]]) < k + 1)
                out[at] = list(range(len(self.primary))) if held[-1] < k + 1 else row[keep].tolist()
            rows, beam = rows[wider], 2 * beam
        return out

    def further(self, points: np.ndarray, bounds: np.ndarray, share: float) -> np.ndarray:
        """Which lists each query reads beyond the ratio, by its k-th distance and the radii."""
        reach = (bounds[:, None] + share * self.radius[None, :]) * (1 + 1e-9)
        return (self.graph.all_gaps(points) <= reach) & (self.postings > 0)

    def share_needed(self, points: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The share of its list's radius at which each query reads the list `own`."""
        rest = self.graph.all_gaps(points)[np.arange(len(points)), own] - bounds
        radius = self.radius[own]
        return np.clip(np.where(radius > 0, rest / np.where(radius > 0, radius, 1), 0), 0, 1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def search(vectors: DataFrame, is_query, k: int = 10, key: str = "vec_id",
           vector: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first.

    Queries are the rows where `is_query(vec_id)` holds, candidates all rows of
    another id. Rows without an id, null and zero vectors, and vectors with null
    or non-finite components take no part. Vectors of several lengths are several
    searches, as there is no distance between them. Rows that repeat an id count
    once in a search, with the nearer vector. Equal distances are in order of
    vec_id. With k candidates or fewer a query gets them all; without usable
    rows there is no result.
    """
    rows = usable(vectors, key, vector)
    lengths = sorted((r.dim, r.n) for r in rows.groupBy(F.size("vec").alias("dim")).agg(
        F.count("*").alias("n")).collect())
    found = [_search(rows.filter(F.size("vec") == dim), n, is_query, k, settings or Settings())
             for dim, n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _search(all_rows: DataFrame, n: int, is_query, k: int, set_: Settings) -> DataFrame:
    """`search` among `n` vectors of one length."""
    spark = all_rows.sparkSession
    # a bounded sample in the order of a hash, the same at every run
    share = int(min(1.0, 1.2 * SAMPLE_ROWS / n) * (1 << 30))
    sample = (all_rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) <= share)
              .limit(SAMPLE_ROWS).toPandas())
    sample = sample.sort_values("vec_id", kind="stable")
    lists = min(MOST_LISTS // 2, -(-n // LIST_ROWS))
    index = Index(CentroidGraph(balanced_centroids(stack(sample["vec"]), lists), set_.degree), set_)
    known = spark.sparkContext.broadcast(index)

    @F.pandas_udf("lists array<int>, gap double")
    def lists_of(vec: pd.Series) -> pd.DataFrame:
        index, lists, gaps = known.value, [], [np.zeros(0)]
        for i in range(0, len(vec), 512):
            points = stack(vec.iloc[i:i + 512])
            lists += index.assign(points)
            own = [x[0] for x in lists[i:]]
            gaps.append(np.linalg.norm(points - index.graph.centres[own], axis=1))
        return pd.DataFrame({"lists": lists, "gap": np.concatenate(gaps)})

    assigned = cut_lineage(all_rows.withColumn("of", lists_of("vec")).select("vec_id", "vec", "of.*"), "assigned")
    # at most MOST_LISTS rows
    own = F.col("place") == 0
    sizes = (assigned.select("gap", F.posexplode("lists").alias("place", "list")).groupBy("list")
             .agg(F.count("*").alias("n"), F.sum(own.cast("int")).alias("own"),
                  F.coalesce(F.max(F.when(own, F.col("gap"))), F.lit(0.0)).alias("radius"))
             .toPandas())
    index.primary, index.postings = (np.zeros(len(index.graph.centres), np.int64) for _ in "12")
    index.radius = np.zeros(len(index.graph.centres))
    index.radius[sizes["list"]] = sizes["radius"]
    index.primary[sizes["list"]], index.postings[sizes["list"]] = sizes["own"], sizes["n"]
    filled = spark.sparkContext.broadcast(index)

    def shards_of(index: Index) -> np.ndarray:
        return np.maximum(1, -(-index.postings // SHARD_ROWS))

    @F.pandas_udf("array<struct<list:int,shards:int>>")
    def read_by(vec: pd.Series) -> pd.Series:
        index, shards = filled.value, shards_of(filled.value)
        return pd.Series([[{"list": x, "shards": int(shards[x])} for x in chosen]
                          for i in range(0, len(vec), 512)
                          for chosen in index.lists_for(stack(vec.iloc[i:i + 512]), k)])

    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / SHARD_ROWS)).cast("int")
    counted = spark.createDataFrame(sizes[["list", "n"]].astype("int64"), "list long, n long")
    postings = (assigned.select("vec_id", "vec", F.explode(F.col("lists").cast("array<long>")).alias("list"))
                .join(F.broadcast(counted), "list")
                .withColumn("shard", F.pmod(F.xxhash64("vec_id"), shards).cast("int")).drop("n"))
    routed = cut_lineage(all_rows.filter(is_query(F.col("vec_id"))).select(
        F.col("vec_id").alias("query_id"), F.col("vec").alias("asked"),
        read_by("vec").alias("read")), "queries")

    def nearest(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        points, names = stack(held["vec"]), held["vec_id"].to_numpy(np.int64)
        out = []
        for query, vec, bound in zip(queries["query_id"], queries["asked"], queries["bound"]):
            # exact, in double precision
            gap = np.sqrt(((points - np.asarray(vec, dtype=np.float64)) ** 2).sum(1))
            within = np.flatnonzero((names != query) & (gap <= bound))
            # the copies of an id may not crowd others out
            order = within[np.lexsort((names[within], gap[within]))]
            _, first = np.unique(names[order], return_index=True)
            best = order[np.sort(first)[:k]]
            out.append(pd.DataFrame({"query_id": query, "vec_id": names[best], "score": gap[best]}))
        return pd.concat(out, ignore_index=True)

    def read(queries: DataFrame, some) -> DataFrame:
        """What the queries (query_id, asked, read, bound) find in some of their lists."""
        asked = (queries.select("query_id", "asked", "bound", F.posexplode("read").alias("place", "r"))
                 .filter(some(F.col("place")))
                 .select("query_id", "asked", "bound", F.col("r.list").cast("long").alias("list"),
                         F.explode(F.sequence(F.lit(0), F.col("r.shards") - 1)).alias("shard")))
        # the queries of a list come in blocks, each of which meets the list's shards; one row a list
        many = F.broadcast(asked.filter("shard = 0").groupBy("list").agg(
            F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("blocks")))
        asked = asked.join(many, "list").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")))
        held = postings.join(many, "list").withColumn("block", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
        place = ["list", "shard", "block"]
        return asked.drop("blocks").groupBy(*place).cogroup(held.drop("blocks").groupBy(*place)).applyInPandas(
            nearest, "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
                .withColumn("rank", F.row_number().over(
                    Window.partitionBy("query_id").orderBy("score", "vec_id")))
                .filter(F.col("rank") <= k))

    nothing = F.lit(float("inf"))
    near = cut_lineage(best(read(routed.withColumn("bound", nothing), lambda i: i < set_.first))
                       .drop("rank"), "nearest")
    bounds = near.groupBy("query_id").agg(F.when(F.count("*") == k, F.max("score"))
                                          .otherwise(nothing).alias("bound"))
    others = routed.join(bounds, "query_id", "left").withColumn(
        "bound", F.coalesce("bound", nothing))
    near = cut_lineage(best(near.unionByName(read(others, lambda i: i >= set_.first)))
                       .drop("rank"), "nearest")
    bounds = cut_lineage(near.groupBy("query_id").agg(
        F.when(F.count("*") == k, F.max("score")).otherwise(nothing).alias("bound")), "bounds")
    others = routed.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", nothing))
    share = _share(others, near, assigned, index, k)
    if share is not None:

        @F.pandas_udf("array<struct<list:int,shards:int>>")
        def further(vec: pd.Series, bound: pd.Series, read: pd.Series) -> pd.Series:
            index, shards = filled.value, shards_of(filled.value)
            out = []
            for i in range(0, len(vec), 512):
                some = index.further(stack(vec.iloc[i:i + 512]), bound.iloc[i:i + 512].to_numpy(), share)
                for row, done in zip(some, read.iloc[i:i + 512]):
                    row[[r["list"] for r in done]] = False
                    out.append([{"list": int(x), "shards": int(shards[x])} for x in np.flatnonzero(row)])
            return pd.Series(out)

        more = cut_lineage(others.withColumn("read", further("asked", "bound", "read")), "queries")
        near = near.unionByName(read(more, lambda i: i >= 0))
    return best(near).select("query_id", "rank", "vec_id", "score")


def _share(queries: DataFrame, near: DataFrame, assigned: DataFrame, index: Index, k: int) -> float | None:
    """The share of the lists' radii that finds WANTED of the nearest vectors of measured queries
    (query_id, asked, bound), None where `near` holds ENOUGH of them."""
    measured = (queries.select("query_id", "asked", "bound").dropDuplicates(["query_id"])
                .orderBy(F.xxhash64("query_id"), "query_id").limit(MEASURED).toPandas())
    if not len(measured):
        return None
    names, bounds = measured["query_id"].to_numpy(np.int64), measured["bound"].to_numpy(np.float64)
    asked = stack(measured["asked"])

    def within(batches):
        for batch in batches:
            points, ids = stack(batch["vec"]), batch["vec_id"].to_numpy(np.int64)
            for i, (name, vec, bound) in enumerate(zip(names, asked, bounds)):
                gap = np.sqrt(((points - vec) ** 2).sum(1))
                held = np.flatnonzero((ids != name) & (gap <= bound))
                order = held[np.lexsort((ids[held], gap[held]))]
                _, first = np.unique(ids[order], return_index=True)
                best = order[np.sort(first)[:k]]
                yield pd.DataFrame({"query": i, "vec_id": ids[best], "score": gap[best],
                                    "own": batch["lists"].iloc[best].map(lambda x: x[0])})

    truly = (assigned.select("vec_id", "vec", "lists")
             .mapInPandas(within, "query int, vec_id long, score double, own int")
             .groupBy("query", "vec_id").agg(F.min_by("own", "score").alias("own"), F.min("score").alias("score"))
             .withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")))
             .filter(F.col("rank") <= k).toPandas())
    some = near.join(F.broadcast(near.sparkSession.createDataFrame(
        [(int(x),) for x in names], "query_id long")), "query_id").select("query_id", "vec_id").collect()
    found = {(r.query_id, r.vec_id) for r in some}
    at = truly["query"].to_numpy(np.int64)
    missed = np.array([x not in found for x in zip(names[at].tolist(), truly["vec_id"].tolist())], dtype=bool)
    if missed.sum() <= (1 - ENOUGH) * len(missed):
        return None
    lost = truly[missed]
    at = lost["query"].to_numpy(np.int64)
    needed = np.sort(index.share_needed(asked[at], bounds[at], lost["own"].to_numpy(np.int64)))
    return float(needed[len(needed) - 1 - int((1 - WANTED) * len(missed))])
