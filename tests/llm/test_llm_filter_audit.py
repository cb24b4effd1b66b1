"""The filter audit against a plain recount of every order."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, source string, text string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """For each row the letters of the filters it fails."""
    out = []
    for key, _, text in rows:
        text = text or ""
        words = WORD.findall(text)
        same = [k for k, _, t in rows if (t or "") == text and k is not None]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)),
                 "E": key is not None and any(k < key for k in same)}
        out.append({x for x in fails if fails[x]})
    return out


def recount(rows, labels):
    failed = failures(rows)
    good, toxic = ({k for k, *marks in labels if k is not None and marks[i] == 1} for i in (0, 1))
    out = {}
    for part in {s or "" for _, s, _ in rows}:
        mine = [(k, f) for (k, s, _), f in zip(rows, failed) if (s or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [k for k, f in left if x in f]
                left = [(k, f) for k, f in left if x not in f]
                total[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                    sum(f == {x} for _, f in mine), sum(k in good for k in gone), sum(k in toxic for k in gone)]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def figures(df):
    return {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in df.collect()}


def odd_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    long_text = " ".join(words)
    rows = [(0, None, None), (1, "", ""), (2, "x", " \t\n"), (3, "x", long_text), (4, "y", long_text),
            (4, "y", long_text), (4, "y", "another text of key four"), (None, "y", long_text),
            (None, None, "no key"), (5, "y", "no key"), (6, "x", "A B C"), (7, "x", "é" * 500 + " $"),
            (8, "x", "same " * 300), (-9, "z", "same " * 300), (9, "y", long_text + " x y | Z"),
            (10, "x", "word " * 300_000)]
    for i in range(60):
        text = " ".join(rng.choices(words, k=rng.choice([5, 150, 250, 900])))
        rows.append((20 + i, rng.choice(["x", "y", None]), text + rng.choice(["", " #", " AAAAAAA" * 9])))
    rows += [(200 + i, "hot", rows[20][2]) for i in range(40)]
    labels = [(3, 1, 0), (3, 0, None), (4, None, 1), (None, 1, 1), (8, 1, 1), (205, 1, 0), (999, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("counters", [filter_audit.MOST_COUNTERS, 1 << 10])
def test_all_orders(spark, counters):
    rows, labels = odd_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("mask", F.lit("own")).withColumn("k", F.lit(1))
    got = figures(filter_audit.audit(docs.repartition(7), spark.createDataFrame(labels, LABELS),
                                     most_counters=counters))
    assert got == recount(rows, labels)


def test_no_rows(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).collect() == []
    some = spark.createDataFrame([(1, "a", "x")], DOCS)
    assert filter_audit.audit(some, labels).count() == 600


@pytest.mark.parametrize("counters", [1 << 10, 1 << 20])
def test_sketch_never_clears_a_repeat(spark, counters):
    rng = np.random.default_rng(5)
    hashes = rng.integers(-2 ** 63, 2 ** 63 - 1, 3000)
    hashes[1000:1400] = hashes[:400]
    frame = spark.createDataFrame([(int(h),) for h in hashes], "h long").repartition(11)
    plane, bits = filter_audit.sketch(frame, counters)
    assert len(plane) * 8 == 1 << bits <= counters
    probe = filter_audit.may_repeat(plane, bits, spark)
    found = {r.h for r in frame.filter(probe("h")).collect()}
    assert set(hashes[:400].tolist()) <= found
    if counters > 1 << 16:
        assert len(found) < 500
