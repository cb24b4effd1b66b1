"""Token counts of texts by two look-ups on the map side, without token ids.

A byte-level tokenizer splits a text into pre-tokens and encodes each by itself,
so the count of a text is the sum of its pre-tokens' lengths in tokens. First
tier: the frequent pre-tokens of the whole corpus, found by mergeable
frequent-items sketches (each task keeps one of bounded size, and only sketches
are merged), are encoded once and their lengths broadcast as one hash table.
Second tier: a cache in every worker; what neither holds is encoded there.
Documents are never shuffled, nor are pre-tokens.

The table decides how often a worker must encode, not what is counted.
Tokenizers of another kind (without a byte-level splitter, or a sentencepiece
model) count whole texts by their library.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_words, runs_of
from .tokens import _split

#: Bounds of the broadcast: so many pre-tokens of so many characters; a sketch tracks SKETCH items.
MOST_FREQUENT = 32_768
MOST_CHARS = 32
SKETCH = 65_536
#: Sketches of tasks are merged in so many groups, and then those of the groups.
MERGES = 1024
#: Pre-tokens that a worker remembers; then it starts anew.
MOST_CACHED = 400_000
#: A text is split into pre-tokens in blocks of about so many characters.
BLOCK_CHARS = 1_000_000

#: The splitting pattern of byte-level BPE, as the library's (a fixed value).
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: One space between two characters that are none: a pre-token always begins here.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """The text in blocks that no pre-token crosses; without a safe place a block is longer."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


class PieceCounter:
    """Counts the tokens of texts; `frequent` holds the lengths of known pre-tokens."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None, most_cached: int = MOST_CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.frequent, self.cache, self.most_cached = frequent or {}, {}, most_cached
        self.special = None
        self.by_piece = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._lengths = lambda texts: [
            len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        settings = json.loads(tokenizer.to_str())
        splitter, added = settings["pre_tokenizer"] or {}, settings["added_tokens"]
        self.by_piece = (
            settings["normalizer"] is None and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex") is True and not splitter.get("add_prefix_space")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added))
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        if contents:
            self.special = re.compile(f"({'|'.join(map(re.escape, contents))})")

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens; an added token's string is a piece of its own, which the library knows."""
        found: list[str] = []
        for block in _blocks(text):
            parts = self.special.split(block) if self.special and self.special.search(block) else (block,)
            for i, part in enumerate(parts):
                found.extend((part,) if i % 2 else _split(part))
        return found

    def lengths(self, pieces: Sequence[str]) -> np.ndarray:
        """The number of tokens of each of the distinct pieces."""
        found = np.fromiter(map(self.frequent.get, pieces, repeat(-1)), np.int64, len(pieces))
        missed = np.flatnonzero(found < 0)
        if len(missed):
            names = [pieces[i] for i in missed.tolist()]
            new = [p for p in names if p not in self.cache]
            if len(self.cache) + len(new) > self.most_cached:
                self.cache = {}
                new = names
            for start in range(0, len(new), 10_000):
                some = new[start:start + 10_000]
                self.cache.update(zip(some, self._lengths(some)))
            found[missed] = [self.cache[p] for p in names]
        return found

    def counts(self, texts: Sequence[str | None]) -> np.ndarray:
        texts = [t if isinstance(t, str) else "" for t in texts]
        out = np.zeros(len(texts), dtype=np.int64)
        for part in runs_of(texts):
            if self.by_piece:
                codes, distinct, ends = coded_words(texts[part], self.pieces)
                if len(codes):
                    upto = np.concatenate([[0], np.cumsum(self.lengths(distinct)[codes])])
                    out[part] = np.diff(upto[np.concatenate([[0], ends])])
            else:
                out[part] = self._lengths(texts[part])
        return out


def frequent_pieces(docs: DataFrame, text: str = "text", most: int = MOST_FREQUENT,
                    tracked: int = SKETCH) -> list[str]:
    """The most frequent pre-tokens of all texts, at most `most` of at most MOST_CHARS characters."""
    pieces = docs.select(F.explode(F.regexp_extract_all(
        F.col(f"`{text}`").cast("string"), F.lit(PIECES), F.lit(0))).alias("piece")).filter(
        F.length("piece") <= MOST_CHARS)
    sketches = pieces.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("merge")).agg(
        F.expr(f"approx_top_k_accumulate(piece, {tracked})").alias("sketch"))
    # grouped, as without any sketch there is nothing to combine
    merged = sketches.withColumn("all", F.lit(0)).groupBy("all").agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top")).first()
    return [r.item for r in found.top] if found else []


#: One counter for each broadcast and Python worker.
_COUNTERS: dict = {}


def _counter(path: str, sent, run: str) -> PieceCounter:
    if (path, run) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path, run] = PieceCounter(path, sent.value)
    return _COUNTERS[path, run]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """(row, n_bytes, n_tokens, over_limit): one row per input row, `row` being the whole input row.

    Strings of special tokens inside a text count as the library takes them by
    default; no tokens are added, cut or padded. A null text is empty.
    Repeated rows are counted each. An empty table gives no rows.
    """
    first = PieceCounter(tokenizer)
    known: dict[str, int] = {}
    if first.by_piece:
        names = frequent_pieces(docs, text)
        known = dict(zip(names, first.lengths(names).tolist()))
    # at most MOST_FREQUENT strings of MOST_CHARS characters
    sent, run = docs.sparkSession.sparkContext.broadcast(known), uuid.uuid4().hex

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_counter(tokenizer, sent, run).counts(batch.tolist()))

    content = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))
    counted = docs.select(F.struct("*").alias("row")).select(
        "row", F.octet_length(content).cast("long").alias("n_bytes"), n_tokens(content).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
