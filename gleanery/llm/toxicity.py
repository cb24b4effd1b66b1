"""Toxicity: a linear-chain conditional random field over the words of a text.

The field tags each word as clean (0) or toxic (1). Labels are of documents, so
the words to learn from are labelled first: in a toxic training document, a
word is labelled where its form, beginning or ending occurs in toxic documents
significantly and many times more often than in clean ones. The field is fitted
to these tags on the driver, on a sample of labelled rows with a documented
bound. Forward-backward marginals of the words give a document's score, through
a logistic curve fitted on the same sample, and the offending offsets.

Forward and backward messages of two tags are one ratio each, and a step is a
fractional linear map of it; maps compose, so all texts of a batch run as one
chain, cut into columns that numpy steps through together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_RE, coded_words, lean, runs_of

#: Buckets of the hashed word features.
BUCKETS = 1 << 20
#: Beginnings and endings of a word that are features beside the whole word.
HEADS, TAILS = (3, 4, 5, 6), (4,)
PER_WORD = 1 + len(HEADS) + len(TAILS)
#: Bounds of the training sample: labelled documents of each class, words that the field sees.
MOST_TOXIC, MOST_CLEAN, MOST_WORDS = 1500, 6000, 400_000
#: The bound of the sample's texts together, in characters.
MOST_CHARS = 40_000_000
#: A feature tells toxic words from others by at least this odds ratio and G statistic.
ODDS, EVIDENCE = 20.0, 24.0
EDGE = ".,;:!?\"'()[]{}<>*_-|/\\"
#: Marginals below this are no sign of a toxic word.
FLOOR = 0.1


def features(words: Sequence[str]) -> np.ndarray:
    """Feature buckets of each word, PER_WORD columns; a word too short for one repeats its form."""
    digest, table = xxhash.xxh32_intdigest, np.empty((len(words), PER_WORD), dtype=np.int32)
    for start in range(0, len(words), 20_000):
        out = []
        for word in words[start:start + 20_000]:
            core = word.lower().strip(EDGE) or word
            whole = digest("=" + core)
            out.append(whole)
            for n in HEADS:
                out.append(digest("^" + core[:n], n) if len(core) > n else whole)
            for n in TAILS:
                out.append(digest("$" + core[-n:], n) if len(core) > n else whole)
        table[start:start + 20_000] = (np.array(out, dtype=np.int64) & (BUCKETS - 1)).reshape(
            -1, PER_WORD)
    return table


def run_chain(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[t] = (a x[t-1] + b) / (c x[t-1] + d) for all t; the first step must not need x[-1].

    The chain is cut into about sqrt(n) runs; the maps of all runs are composed
    side by side, the values at the cuts follow, then all runs are stepped through.
    """
    n = len(a)
    length = max(1, int(np.ceil(np.sqrt(n))))
    runs = -(-n // length)
    parts = []
    for values, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)):
        whole = np.full(runs * length, fill)
        whole[:n] = values
        parts.append(np.ascontiguousarray(whole.reshape(runs, length).T))
    pa_, pb, pc, pd_ = np.ones(runs), np.zeros(runs), np.zeros(runs), np.ones(runs)
    for a1, b1, c1, d1 in zip(*parts):
        pa_, pb, pc, pd_ = a1 * pa_ + b1 * pc, a1 * pb + b1 * pd_, c1 * pa_ + d1 * pc, c1 * pb + d1 * pd_
        scale = 1.0 / (pa_ + pb + pc + pd_)
        pa_, pb, pc, pd_ = pa_ * scale, pb * scale, pc * scale, pd_ * scale
    x, at = np.ones(runs), 1.0
    for i in range(runs):
        x[i] = at
        at = (pa_[i] * at + pb[i]) / (pc[i] * at + pd_[i])
    out = np.empty((length, runs))
    for j, (a1, b1, c1, d1) in enumerate(zip(*parts)):
        x = (a1 * x + b1) / (c1 * x + d1)
        out[j] = x
    return out.T.reshape(-1)[:n]


@dataclass
class Field:
    """Weights of the features, of the tag pairs (clean-clean is 0) and of a toxic first word."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = -4.0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def emission(self, codes_features: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[codes_features].sum(axis=1)

    def messages(self, score: np.ndarray, ends: np.ndarray):
        """(forward, backward, potentials) as ratios of toxic to clean."""
        e = np.exp(np.clip(score, -30, 30))
        t = np.exp(self.pairs)
        first, last = np.zeros(len(e), bool), np.zeros(len(e), bool)
        stops = np.unique(ends[ends > 0])
        last[stops - 1] = True
        first[0] = True
        first[stops[:-1]] = True
        forward = run_chain(np.where(first, 0, e * t[1, 1]),
                            np.where(first, e * np.exp(self.start), e * t[0, 1]),
                            np.where(first, 0, t[1, 0]), np.where(first, 1, t[0, 0]))
        after = np.concatenate([e[1:], [1.0]])
        backward = run_chain(*(np.where(last, reset, step)[::-1] for reset, step in (
            (0, after * t[1, 1]), (1, t[1, 0]), (0, after * t[0, 1]), (1, t[0, 0]))))[::-1]
        return forward, backward, e, last

    def marginals(self, score: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The probability that each word is toxic, given its whole text."""
        if not len(score):
            return np.zeros(0)
        forward, backward, _, _ = self.messages(score, ends)
        both = forward * backward
        return both / (1 + both)


def fit_field(codes: np.ndarray, word_features: np.ndarray, ends: np.ndarray, tags: np.ndarray,
              rounds: int = 50) -> Field:
    """Maximum likelihood with a small ridge, by Adam over the whole sample."""
    crf, n = Field(), len(codes)
    if not n:
        return crf
    flat = word_features.ravel()
    used, place = np.unique(flat, return_inverse=True)
    place = place.reshape(word_features.shape)
    theta = np.zeros(len(used) + 5)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    theta[-5] = crf.bias
    scale = 1.0 / (1 + tags.sum())
    stops = np.unique(ends[ends > 0])
    starts = np.concatenate([[0], stops[:-1]])
    inner = np.ones(n, bool)
    inner[stops - 1] = False
    inner = np.flatnonzero(inner)
    seen = {(i, j): int(((tags[inner] == i) & (tags[inner + 1] == j)).sum())
            for i, j in ((0, 1), (1, 0), (1, 1))}
    for step in range(1, rounds + 1):
        crf.bias, crf.start = float(theta[-5]), float(theta[-4])
        crf.pairs = np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]])
        word_score = crf.bias + theta[:-5][place].sum(axis=1)
        forward, backward, e, _ = crf.messages(word_score[codes], ends)
        p = forward * backward / (1 + forward * backward)
        gap = p - tags
        by_word = np.bincount(codes, weights=gap, minlength=len(word_features))
        grad = np.empty_like(theta)
        grad[:-5] = np.bincount(place.ravel(), weights=np.repeat(by_word, PER_WORD),
                                minlength=len(used))
        grad[-5], grad[-4] = gap.sum(), gap[starts].sum()
        f, behind, t = forward[inner], e[inner + 1] * backward[inner + 1], np.exp(crf.pairs)
        joint = {(0, 1): t[0, 1] * behind, (1, 0): f * t[1, 0], (1, 1): f * t[1, 1] * behind}
        whole = 1.0 + sum(joint.values())
        for k, pair in zip((-3, -2, -1), joint):
            grad[k] = (joint[pair] / whole).sum() - seen[pair]
        grad = grad * scale + 1e-4 * theta
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        theta -= 0.3 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        theta[-4:] = np.clip(theta[-4:], -4, 4)
    crf.weights[used] = theta[:-5]
    return crf


@dataclass
class Model:
    crf: Field
    #: Logistic curve over (1, log of summed marginals).
    curve: np.ndarray
    known: dict = field(default_factory=dict)

    def score(self, texts: Sequence[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Scores, and the offending spans (start, end, marginal) in characters."""
        scores, spans = [], []
        for part in runs_of(texts):
            codes, distinct, ends = coded_words(texts[part])
            if len(self.known) > 200_000:  # a bound of memory, not of results
                self.known.clear()
            new = [w for w in distinct if w not in self.known]
            if new:
                self.known.update(zip(new, self.crf.emission(features(new)).tolist()))
            emission = np.array([self.known[w] for w in distinct])
            p = self.crf.marginals(emission[codes] if len(codes) else np.zeros(0), ends)
            signs = document_signs(p, ends)
            scores.append(1 / (1 + np.exp(-np.clip(signs @ self.curve, -30, 30))))
            start = 0
            for text, end in zip(texts[part], ends.tolist()):
                marks = p[start:end]
                if end > start and (marks >= 0.5).any():
                    places = [m.span() for m in WORD_RE.finditer(text)]
                    spans.append([(*places[i], float(marks[i]))
                                  for i in np.flatnonzero(marks >= 0.5)])
                else:
                    spans.append([])
                start = end
        return np.concatenate(scores) if scores else np.zeros(0), spans


def document_signs(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(1, log of the summed marginals above the floor) of each text."""
    n = len(ends)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if n else ends
    total = np.zeros(n)
    there = np.flatnonzero(ends > starts)
    if len(there):
        total[there] = np.add.reduceat(np.where(p >= FLOOR, p, 0.0), starts[there])
    return np.column_stack([np.ones(n), np.log(1e-2 + total)])


def _curve(signs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method."""
    beta = np.zeros(signs.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(signs @ beta, -30, 30)))
        grad = signs.T @ (p - labels) + 0.05 * beta
        hess = (signs * (p * (1 - p))[:, None]).T @ signs + 0.05 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def telling(df_toxic: np.ndarray, df_clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Which feature buckets tell toxic documents: odds ratio and G statistic both high."""
    often = np.flatnonzero(df_toxic > 2)
    df_toxic, df_clean, out = df_toxic[often], df_clean[often], np.zeros(len(df_toxic), dtype=bool)
    rate1, rate0 = (df_toxic + 0.5) / (n_toxic + 1), (df_clean + 0.5) / (n_clean + 1)
    both = (df_toxic + df_clean) / max(n_toxic + n_clean, 1)
    g = np.zeros(len(df_toxic))
    for seen, n in ((df_toxic, n_toxic), (df_clean, n_clean)):
        for count, share in ((seen, both), (n - seen, 1 - both)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g += np.where(count > 0, 2 * count * np.log(count / (n * share)), 0.0)
    out[often] = (rate1 / rate0 >= ODDS) & (g >= EVIDENCE)
    return out


def within(sizes: np.ndarray, labels: np.ndarray, most: int) -> np.ndarray:
    """Which documents are taken: in order, each that fits in what is left of `most`.

    One that does not fit is passed over. A class of which none fits is there
    with its shortest document, the only case in which there is more.
    """
    chosen, left = np.zeros(len(sizes), dtype=bool), most
    for i, n in enumerate(sizes.tolist()):
        if n <= left:
            chosen[i], left = True, left - n
    for of in (labels == 1, labels == 0):
        if of.any() and not chosen[of].any():
            chosen[np.flatnonzero(of)[sizes[of].argmin()]] = True
    return np.flatnonzero(chosen)


def fit(texts: Sequence[str], labels: Sequence[int]) -> Model | None:
    """The model of labelled texts, whole texts in an order that does not follow the labels.

    Copies of a text count once as evidence. None without texts of both classes.
    """
    texts, labels = [t or "" for t in texts], np.asarray(labels, dtype=np.int64)
    if not 0 < labels.sum() < len(labels):
        return None
    df, count, known = np.zeros((2, BUCKETS)), [0, 0], set()
    size = np.zeros(len(texts), dtype=np.int64)
    for part in runs_of(texts):
        codes, distinct, ends = coded_words(texts[part])
        table, start = features(distinct), 0
        # near copies share the first words of a random order of all words
        order = table[:, 0].astype(np.int64) * 0x9E3779B1 & 0xFFFFFFFF
        for i, end in enumerate(ends.tolist(), part.start):
            words = np.unique(codes[start:end])
            size[i], start = end - start, end
            mark = (labels[i], *np.sort(order[words])[:4].tolist())
            if mark not in known:
                known.add(mark)
                count[labels[i]] += 1
                df[labels[i]][np.unique(table[words])] += 1
    tells = telling(df[1], df[0], count[1], count[0])
    # the field sees whole documents of both classes in turn, up to the bound of words
    turn = np.argsort(np.concatenate([np.arange((labels == 1).sum()), np.arange((labels == 0).sum())]),
                      kind="stable")
    mixed = np.concatenate([np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)])[turn]
    chosen = mixed[within(size[mixed], labels[mixed], MOST_WORDS)]
    codes, distinct, ends = coded_words([texts[i] for i in chosen])
    table, toxic = features(distinct), np.repeat(labels[chosen], size[chosen])
    crf = fit_field(codes, table, ends, (toxic & tells[table].any(axis=1)[codes]).astype(np.float64))
    signs = []
    for part in runs_of(texts):
        codes, distinct, ends = coded_words(texts[part])
        emission = crf.emission(features(distinct))
        signs.append(document_signs(crf.marginals(
            emission[codes] if len(codes) else np.zeros(0), ends), ends))
    return Model(crf, _curve(np.concatenate(signs), labels))


def held_out(key) -> F.Column:
    """Whether a document's labels are kept from training: crc32 of its id's text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
          label: str = "toxic") -> Model | None:
    """Fits the model on at most MOST_TOXIC and MOST_CLEAN labelled documents.

    The sample is in the order of a hash of the id, the same at every run; it has
    one text for each id (the shortest, where rows repeat an id), and texts of
    at most MOST_CHARS characters in all: one that does not fit in what is left
    is passed over. Held out documents, null ids and null labels are left out; a
    document labelled more than once is toxic if any label says so.
    """
    known = (labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                           F.col(f"`{label}`").cast("int").alias("toxic"))
             .filter("doc_id is not null and toxic is not null").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    hashed = known.withColumn("turn", F.xxhash64("doc_id", F.lit(10)))
    sample = None
    for condition, most in (("toxic > 0", MOST_TOXIC), ("toxic <= 0", MOST_CLEAN)):
        some = hashed.filter(condition).orderBy("turn", "doc_id").limit(most)
        sample = some if sample is None else sample.unionByName(some)
    # at most MOST_TOXIC + MOST_CLEAN ids
    told = texts.join(F.broadcast(sample), "doc_id").withColumn("text", F.coalesce("text", F.lit(""))).withColumn(
        "form", F.struct(F.length("text").alias("n"), F.xxhash64("text").alias("h")))
    sizes = told.groupBy("turn", "doc_id", "toxic").agg(F.min("form").alias("form")).orderBy("turn", "doc_id").collect()
    fits = within(np.array([r.form.n for r in sizes], dtype=np.int64),
                  np.array([int(r.toxic > 0) for r in sizes], dtype=np.int64), MOST_CHARS)
    picked = docs.sparkSession.createDataFrame(
        [(sizes[i].doc_id, sizes[i].form.n, sizes[i].form.h) for i in fits.tolist()], "doc_id long, n int, h long")
    # at most MOST_CHARS characters
    rows = (told.join(F.broadcast(picked.select("doc_id", F.struct("n", "h").alias("form"))), ["doc_id", "form"])
            .dropDuplicates(["doc_id"]).orderBy("turn", "doc_id").collect())
    return fit([r.text for r in rows], [int(r.toxic > 0) for r in rows])


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """(row, score, predicted, spans): one row per input row, without a shuffle.

    `row` is the whole input row. `spans` are the offending words as
    array<struct<start, end, marginal>>, offsets in characters. A null or empty
    text has the score of no toxic word. Without a model (no labelled rows of
    both classes) every score is 0.
    """
    rows = docs.select(F.struct("*").alias("row"))
    kind = "struct<score:double,spans:array<struct<start:int,end:int,marginal:double>>>"
    if model is None:
        none = F.array().cast("array<struct<start:int,end:int,marginal:double>>")
        return rows.select("row", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                           none.alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.crf.weights.astype(np.float32), model.crf.bias, model.crf.pairs, model.crf.start,
         model.curve))

    @F.arrow_udf(kind)
    @lean
    def tag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias, pairs, start, curve = shared.value
        tagger = Model(Field(weights, bias, pairs, start), curve)
        for column in batches:
            scores, spans = tagger.score([t or "" for t in column.to_pylist()])
            marks = [[{"start": a, "end": b, "marginal": m} for a, b, m in s] for s in spans]
            kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                        ("marginal", pa.float64())]))
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()),
                                              pa.array(marks, kinds)], names=["score", "spans"])

    tagged = rows.withColumn("tagged", tag(F.col(f"row.`{text}`").cast("string")))
    return tagged.select("row", F.col("tagged.score").alias("score"),
                         (F.col("tagged.score") >= 0.5).cast("int").alias("predicted"),
                         F.col("tagged.spans").alias("spans"))
