"""Toxicity by maximum-scoring segments.

Tokens get log-odds of toxic against clean text under Dirichlet priors; words that share a beginning lend each other
evidence, so that an unseen form of a known toxic stem counts too. A linear scan over a text's token scores finds all maximal
segments, and extreme-value statistics of such segments in clean text say which are significant. Their weight, calibrated on
labelled rows, is the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class to learn from: a bound on the sample, and by its words on the model, not on the rows scored.
SAMPLE_PER_CLASS = 8000
#: Texts that the prior lends a token, least z-score of a token that counts, least forms of a stem; letters of a stem, of
#: which the longest known counts.
PRIOR, LEAST_Z, FORMS = 1.0, 3.0, 3
STEMS = (8, 7, 6, 5, 4)
#: What a token without evidence costs a segment.
DRIFT = -1.0
SIGNIFICANT, THRESHOLD = 0.01, 0.3
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, stop, score), by the linear scan of Ruzzo and Tompa."""
    kept: list[tuple[float, float, int, int]] = []  # sum before, sum after, start, stop
    before: list[int] = []  # for each kept segment, the nearest earlier one whose sum before is less
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        left, right, start = total, total + s, i
        total = right
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= left:
                j = before[j]
            if j < 0 or kept[j][1] >= right:
                kept.append((left, right, start, i + 1))
                before.append(j)
                break
            left, start = kept[j][0], kept[j][2]
            del kept[j:], before[j:]
    return [(a, b, r - x) for x, r, a, b in kept]


@dataclass(frozen=True)
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 1.0
    weights: tuple[float, float, float] = (-4.0, 0.0, 0.0)


class _Scores(dict):
    """Scores of words as they come; forgotten when they get many."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        m = self.model
        value = m.words.get(word)
        if value is None:
            value = next((m.stems[word[:n]] for n in STEMS if len(word) > n and word[:n] in m.stems), DRIFT)
        self[word] = value
        return value


def weighed(text: str | None, model: Model, scores: _Scores | None = None) -> list[tuple[int, int, float]]:
    """All maximal segments (first word, stop, bits): how many bits each lies above the best that clean text of as many words
    is to be expected to hold."""
    scores = scores if scores is not None else _Scores(model)
    values = list(map(scores.__getitem__, tokens(text)))
    if not any(v > 0 for v in values):
        return []
    chance = math.log(max(model.scale * len(values), 1e-9))
    return [(a, b, (model.decay * s - chance) / math.log(2)) for a, b, s in segments(values)]


def significant(found: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    return [x for x in found if x[2] > -math.log2(SIGNIFICANT)]


def signals(found: list[tuple[int, int, float]]) -> tuple[float, float]:
    """What the calibration weighs: the strongest segment, and the sum over all that are above chance."""
    bits = [b for *_, b in found if b > 0]
    return (math.log1p(max(bits)), math.log1p(sum(bits))) if bits else (0.0, 0.0)


def probability(x: tuple[float, float], weights: tuple[float, float, float]) -> float:
    return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, weights[0] + weights[1] * x[0] + weights[2] * x[1]))))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, text, toxic of at most ``per_class`` labelled rows a class, by a hash of doc_id; rows held out are never read."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * per_class ids
    return docs.select("doc_id", F.col("text").cast("string")).join(chosen, "doc_id")


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold a word: a word said over and over counts once a text."""
    for batch in batches:
        texts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            texts[toxic].update(set(tokens(text)))
        words = list(texts[0].keys() | texts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([texts[c][w] for w in words], pa.int64()) for c in (0, 1))], names=["word", "clean", "toxic"])


def log_odds(toxic: float, clean: float, all_toxic: float, all_clean: float, n_words: int, prior: float = PRIOR) -> tuple[float, float]:
    """Log of the ratio of a word's odds in toxic and in clean text, and its z-score. Both classes have Dirichlet priors that
    lend each of ``n_words`` words ``prior`` texts, dealt between the classes by their share of all."""
    share = all_toxic / (all_toxic + all_clean)
    lent = (prior * share, prior * (1 - share))
    odds = lambda count, total, own: math.log((count + own) / (total + own * n_words - count - own))
    value = odds(toxic, all_toxic, lent[0]) - odds(clean, all_clean, lent[1])
    return value, value / math.sqrt(1 / (toxic + lent[0]) + 1 / (clean + lent[1]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from the labelled rows that aren't held out. Without toxic or without clean rows the model scores all low."""
    every = training_rows(docs, labels, per_class)
    # One row in three calibrates what the others teach, else chance finds would look certain.
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)) == 0
    counts = every.where(~apart).select("text", "toxic").mapInArrow(_counted, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.persist()
    try:
        size = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
        if not size.clean or not size.toxic:
            return Model()
        # Words that toxic texts of the sample hold more often: no more than the sample has.
        leaning = lambda d: d.where("toxic >= 2 and toxic * {:f} > clean * {:f}".format(size.clean, size.toxic)).collect()
        words = {r.word: log_odds(r.toxic, r.clean, size.toxic, size.clean, size.n) for r in leaning(counts)}
        cut = F.explode(F.filter(F.array(*map(F.lit, STEMS)), lambda n: F.length("word") > n))
        stems = counts.select("*", cut.alias("letters")).groupBy(F.expr("substring(word, 1, letters)").alias("word")).agg(*(F.sum(c).alias(c) for c in ("clean", "toxic")), F.count_if(F.col("toxic") > 0).alias("forms"))
        beginnings = {r.word: log_odds(r.toxic, r.clean, size.toxic, size.clean, size.n) for r in leaning(stems.where(F.col("forms") >= FORMS))}
    finally:
        counts.unpersist()
    good = lambda d: {w: min(v, 12.0) for w, (v, z) in d.items() if z >= LEAST_Z and v > 2.0}
    model = Model(words=good(words), stems=good(beginnings))
    rows = every.where(apart)
    sampled = rows.select("text", "toxic").mapInArrow(_peaks(model), "toxic int, words long, peak double")
    peaks = sampled.collect()  # 2 * per_class rows of three numbers
    model = _with_extremes(model, [(r.words, r.peak) for r in peaks if r.toxic == 0])
    found = rows.select("text", "toxic").mapInArrow(_signals(model), "toxic int, first double, second double").collect()
    return Model(model.words, model.stems, model.decay, model.scale, _logistic([((r.first, r.second), r.toxic) for r in found]))


def _peaks(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model)
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                values = list(map(scores.__getitem__, tokens(text)))
                out.append((toxic, len(values), max((s for *_, s in segments(values)), default=0.0)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.float64())], names=["toxic", "words", "peak"])

    return run


def _signals(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model)
        for batch in batches:
            x = [signals(weighed(t, model, scores)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("toxic").to_pylist(), pa.int32()), pa.array([a for a, _ in x], pa.float64()), pa.array([b for _, b in x], pa.float64())], names=["toxic", "first", "second"])

    return run


def _with_extremes(model: Model, clean: list[tuple[int, float]]) -> Model:
    """Decay and scale of the tail P(peak >= s) = 1 - exp(-scale * words * exp(-decay * s)) in clean texts. Where clean
    texts have no positive tokens, the decay is 1 (natural for log-odds) and half an event over all their words stands in."""
    words = sum(n for n, _ in clean) or 1
    tops = [s for _, s in clean if s > 0]
    if len(tops) < 5:
        least = min([*model.words.values(), *model.stems.values()], default=1.0)
        return Model(model.words, model.stems, 1.0, max(len(tops), 0.5) / words * math.exp(least), model.weights)
    least = min(tops)
    decay = min(max(len(tops) / max(sum(tops) - len(tops) * least, 1e-6), 0.2), 1.0)
    return Model(model.words, model.stems, decay, len(tops) / words * math.exp(decay * least), model.weights)


def _logistic(rows: list[tuple[tuple[float, float], int]], ridge: float = 0.5) -> tuple[float, float, float]:
    """Logistic regression on the two signals by Newton's steps; signals never lower a score."""
    if not rows or len({y for _, y in rows}) < 2:
        return (-4.0, 0.0, 0.0)
    x = np.array([(1.0, *f) for f, _ in rows])
    y = np.array([t for _, t in rows], float)
    penalty = np.diag([0.0, ridge, ridge])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(3), x.T @ (p - y) + penalty @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0)), float(max(w[2], 0.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, score (0 to 1), passages (first word, stop, bits), a row for each row of ``docs``.

    Null and empty texts have no passage and the lowest score. Whole texts are scanned in one pass; repeated rows score
    alike; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model)
        names = ("start", "stop", "bits")
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("bits", pa.float64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values, found = [], []
                for text in part.column("text").to_pylist():
                    every = weighed(text, model, scores)
                    values.append(probability(signals(every), model.weights))
                    found.append([dict(zip(names, s, strict=True)) for s in significant(every)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.float64()), pa.array(found, kind)], names=["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, passages array<struct<start:int,stop:int,bits:double>>")
