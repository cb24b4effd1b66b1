"""Product codes against Lloyd's rounds spelled out."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import code_compression as cc

VECTORS = "vec_id long, embedding array<double>, label string"


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    """(vec_id, code, error, label_error, sha) by full comparisons, for vectors of one length."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(kept[0][1])
    width = -(-n // parts)
    cut = [[([math.floor(x * scale) for x in r[1]] + [0] * (parts * width - n))[p * width:(p + 1) * width]
            for p in range(parts)] for r in kept]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for row in cut:
                of.setdefault(nearest(p, row[p])[1], []).append(row[p])
            for e, xs in of.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(p, row[p]) for p in range(parts)] for row in cut]
    errors = [sum(far for far, _ in one) for one in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in one), error, by_label[r[2]], sha)
                   for r, one, error in zip(kept, found, errors)), key=str)


def got(spark, rows, **options):
    frame = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("own")).withColumn("row", F.lit(1))
    out = cc.with_group_error(cc.compress(frame.repartition(3), **options), "label")
    return sorted(((r.row.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()),
                  key=str)


def clusters(n, dim, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, dim))
    return [(int(i), (middle[rng.integers(5)] + rng.normal(scale=.2, size=dim)).tolist(),
             [None, "a", "b"][int(rng.integers(3))]) for i in rng.permutation(n)]


def test_rounds_equal_full_comparison(spark):
    rows = clusters(700, 32, 1)
    rows += [(1000 + i, rows[7][1], "hot") for i in range(300)]  # a third are one vector
    rows += [(7, rows[3][1], "a"), (None, rows[4][1], "b"), (None, rows[4][1], "b")]
    rows += [(-1, None, "a"), (-2, [0.1] * 31 + [None], "a"), (-3, [math.nan] * 32, "b"), (-4, [math.inf] * 32, None)]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("n,dim,parts", [(3, 16, 16), (90, 20, 16), (40, 5, 3), (5, 1, 2)])
def test_few_rows_and_odd_lengths(spark, n, dim, parts):
    rows = clusters(n, dim, n)
    assert got(spark, rows, parts=parts) == plain(rows, parts=parts)


def test_ties_take_the_lower_entry(spark):
    rows = [(i, [float(i % 3), 0.0], "a") for i in range(9)] + [(20 + i, [0.5, 0.0], None) for i in range(4)]
    assert got(spark, rows, parts=2, entries=5, scale=2) == plain(rows, parts=2, entries=5, scale=2)


def test_lengths_have_their_own_codebooks(spark):
    short, long = clusters(30, 16, 5), clusters(40, 48, 6)
    long = [(100 + i, v, "long") for i, v, _ in long]
    short = [(i, v, "short") for i, v, _ in short]
    nothing = [(500, [], None), (501, [], None)]
    want = sorted([*plain(short), *plain(long)], key=str)
    found = got(spark, short + long + nothing)
    assert [r for r in found if r[0] < 500] == want
    assert [r[1:4] for r in found if r[0] >= 500] == [("00" * 16, 0, 0)] * 2


def test_no_usable_vectors(spark):
    assert got(spark, [(1, None, "a"), (2, [math.nan], None)]) == []
    with pytest.raises(Exception, match="or more"):
        got(spark, [(1, [1e300], "a")])


@pytest.mark.parametrize("seed", range(6))
def test_tree_covers_and_assigns(seed):
    rng = np.random.default_rng(seed)
    points = np.unique(rng.integers(-20, 20 * (seed + 1), (600, 3)) // (1 + seed % 3), axis=0)
    weights = rng.integers(1, 9, len(points))
    tree = cc.CoverTree.build(points, weights)
    near = cc.squared(points, points[tree.centres])
    scale = math.sqrt(near[:, 0].max())
    for level, size in enumerate(tree.sizes):
        centres = points[tree.centres[:size]]
        reach = math.sqrt(near[:, :size].min(axis=1).max())
        apart = cc.squared(centres, centres) + np.eye(size, dtype=int) * 10 ** 9
        assert math.sqrt(apart.min()) > reach - 1e-9  # farther apart than what they cover
        if level:
            up = points[tree.centres[tree.parents[level - 1]]]
            assert np.sqrt(((centres - up) ** 2).sum(axis=1)).max() <= scale + 1e-9
        scale = reach
        assert tree.counts[level].sum() == weights.sum()
        assert (tree.sums[level].sum(axis=0) == (points * weights[:, None]).sum(axis=0)).all()
    entries = points[rng.integers(0, len(points), 20)] + rng.integers(-1, 2, (20, 3))
    code, sums, counts = tree.assign(entries)
    want = cc.squared(points, entries).argmin(axis=1)
    assert (code == want).all() and (counts == np.bincount(want, weights, 20)).all()
    for e in range(20):
        assert (sums[e] == (points * weights[:, None])[want == e].sum(axis=0)).all()
