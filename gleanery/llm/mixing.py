"""Mixing sources to target weights by subset-sum budget fitting.

Targets are filled like vessels: weights share the budget, a source stops at
`most_epochs` times its size, and the excess is shared anew. A source's target
is some whole epochs plus a remaining budget; the remaining budget is fitted on
the histogram of exact lengths, first in proportion, then by a bounded-knapsack
program for what is left. Documents of each length are taken in seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import cut_lineage

from .common import HOT_PARTS, WORD, bucket_of

WEIGHTS = (5, 2, 1)


def words_in(column) -> F.Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of `counts[i]` items of `lengths[i]` to take so that the sum comes nearest
    below `budget`.

    Most of the budget is spread over all lengths in proportion, so that the
    choice is no biased sample. The rest is filled exactly if any subset of the
    others can: reachable sums are the bits of one integer, a count is split
    into powers of two.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total <= 0:
        return taken
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    order = np.argsort(lengths, kind="stable")
    longest = int(lengths.max())
    # spread evenly: along the sorted lengths the running count is never off by more
    # than one, so the sum is off by the longest length at most
    spread = max(0, budget - longest) / total
    running = np.floor(np.cumsum(counts[order] * spread) + 0.5).astype(np.int64)
    taken[order] = np.diff(running, prepend=0)
    taken = np.where(lengths > 0, np.clip(taken, 0, counts), 0)
    rest = budget - int((lengths * taken).sum())
    for i in order[::-1]:
        if rest >= 0:
            break
        less = min(int(taken[i]), -(rest // int(lengths[i]))) if lengths[i] > 0 else 0
        taken[i] -= less
        rest += less * int(lengths[i])
    # bounded knapsack over the rest, a few times the longest length
    mask, reach, steps = (1 << (rest + 1)) - 1, 1, []
    for i in order:
        if lengths[i] <= 0:
            continue
        free, part = min(int(counts[i] - taken[i]), rest // int(lengths[i])), 1
        while free > 0:
            part = min(part, free)
            steps.append((i, part, reach))
            reach |= (reach << (int(lengths[i]) * part)) & mask
            free -= part
            part *= 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += part
            at -= int(lengths[i]) * part
    return taken


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5,
            most_epochs: float = 2.0) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row per source.

    Weights repeat over the sources by code point, null last. Only sums reach
    the driver, in as many rounds as sources reach their stop at different levels.
    """
    spark = sizes.sparkSession
    order = sizes.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    ranked = spark.createDataFrame(
        order.map(lambda x: (x[0].source, x[0].source_size, x[1])),
        "source string, source_size long, rank long")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("weight", weight), "weights")
    stop = F.col("source_size") * F.lit(float(most_epochs))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, budget = 0.0, share * total
    while True:
        # a source is full when the level would pass its stop
        full = F.lit(level) * F.col("weight") >= stop
        held = ranked.agg(F.sum(F.when(full, stop)).alias("full"),
                          F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not held.open:
            break
        higher = (budget - (held.full or 0.0)) / held.open
        if higher <= level:
            break
        level = higher
    target = F.least(F.lit(level) * F.col("weight"), stop)
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, size, weights: Sequence[float] = WEIGHTS, share: float = 1.5,
        most_epochs: float = 2.0, seed: int = 0, key: str = "doc_id",
        source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): one row per input row.

    `size` is the length of a row (a column expression, words_in(text) say).
    `copies` is how often the mix takes the row. Rows of equal key, source and
    size are ranked arbitrarily but equal, so the result is the same at every
    run. A row of size 0 takes no budget and is taken once per whole epoch.
    Sources may be null; an empty table gives no rows.
    """
    sized = cut_lineage(docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        size.cast("long").alias("size")), "sizes")
    total = sized.count()
    counted = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                   weights, share, most_epochs)
    # at most HOT_PARTS (source, size) pairs hold more than 1/HOT_PARTS of the rows
    of = [F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("s")]
    pair = F.struct(*of, "size")
    hot = counted.filter(F.col("n") * HOT_PARTS > total).select(
        pair.alias("pair"), F.col("n").alias("hot_n"))
    dealt = (sized.withColumn("pair", pair).join(F.broadcast(hot), "pair", "left")
             .withColumn("bucket", F.when(F.col("hot_n").isNull(), F.lit(0)).otherwise(
                 bucket_of(F.col("hot_n"), total, F.lit(seed), F.col("doc_id"))).cast("long"))
             .drop("hot_n"))
    parts = dealt.groupBy("pair", "bucket").agg(F.count("*").alias("n"))
    goals = goal.select(F.struct(*of).alias("of"), "source_size", "target")

    def fit_source(frame: pd.DataFrame) -> pd.DataFrame:
        # a histogram of one source: its distinct lengths, and at most HOT_PARTS buckets
        frame = frame.sort_values(["size", "bucket"], ignore_index=True)
        by_size = frame.groupby("size", sort=True)["n"].sum()
        lengths = by_size.index.to_numpy(np.int64)
        counts = by_size.to_numpy(np.int64)
        held, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
        epochs = int(target // held) if held else 1
        extra = fit(lengths, counts, int(target - epochs * held)) if held else counts * 0
        want = dict(zip(lengths.tolist(), extra.tolist()))
        before = frame.groupby("size")["n"].cumsum() - frame["n"]
        left = frame["size"].map(want) - before
        frame["more"] = np.clip(left, 0, frame["n"]).astype("int64")
        frame["epochs"] = epochs
        return frame[["none", "s", "size", "bucket", "source_size", "target", "epochs", "more"]]

    flat = (parts.withColumn("of", F.col("pair").dropFields("size")).join(goals, "of")
            .select("of.none", "of.s", "pair.size", "bucket", "n", "source_size", "target"))
    plan = flat.groupBy("none", "s").applyInPandas(
        fit_source, "none boolean, s string, size long, bucket long, source_size long, "
                    "target double, epochs long, more long")
    plan = plan.select(F.struct("none", "s", "size").alias("pair"), "bucket", "source_size",
                       "target", "epochs", "more")
    turn = F.row_number().over(Window.partitionBy("pair", "bucket").orderBy(
        F.xxhash64(F.lit(seed), "doc_id"), "doc_id"))
    return (dealt.join(plan, ["pair", "bucket"]).withColumn("turn", turn)
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("epochs") + (F.col("turn") <= F.col("more")).cast("long"))
                    .alias("copies")))


def mixed_rows(docs: DataFrame, size, key: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that the mix takes, repeated as often as it takes them.

    Keys are expected to be distinct here; rows of a repeated key share the
    largest number of copies. A row with a null key is never left out.
    """
    copies = (mix(docs, size, key=key, **options).filter("doc_id is not null")
              .groupBy("doc_id").agg(F.max("copies").alias("copies")))
    rows = docs.select(F.struct("*").alias("row")).withColumn(
        "doc_id", F.col(f"row.`{key}`").cast("long"))
    again = F.array_repeat(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))
    return rows.join(copies, "doc_id", "left").select(
        "row", F.explode(again).alias("again")).select("row.*")
