"""Toxic passages by maximum-scoring segment search.

Words are scored by the log-odds of toxic against other labelled texts under a Dirichlet prior. Every
maximal scoring segment of a text is found in time linear in its words, and its chance in clean text
of that length follows the extreme-value law ``E = K n exp(-lambda S)``. A text's evidence is the sum
of ``-ln E`` over its significant segments; a logistic curve turns it into a probability.

In fitting, occurrences are counted once per pair of neighbouring words, so copies of a passage
count once, and so does a word said many times in a row. A word also stands for its first 4, 5 and 6
letters: inflections and compounds of a toxic stem share them. A word takes the best score among
itself and its stems.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, cut, texts

# The model is fitted on at most this many labelled texts of each class, those of smallest id hash.
SAMPLE_PER_CLASS = 10_000
# The lexicon keeps at most this many tokens, the most significant.
LEXICON = 100_000
STEMS = (4, 5, 6)
PRIOR = 0.5
LEAST_Z = 3.0
LEAST_PENALTY = 0.05
SIGNIFICANT = 0.05

_WORDS = re.compile(r"\w+").findall


@dataclass(frozen=True)
class ToxicityModel:
    """Token scores (stems end in ``*``), the penalty of all other words and the calibrations."""

    scores: dict[str, float]
    penalty: float
    decay: float = 1.0
    scale: float = 1.0
    intercept: float = -3.0
    slope: float = 1.0

    def word_score(self, word: str) -> float:
        """The best score of a word or its stems; 0 if it is in no lexicon."""
        get = self.scores.get
        best = get(word, 0.0)
        for k in STEMS:
            if len(word) > k:
                best = max(best, get(word[:k] + "*", 0.0))
        return best

    def hits(self, text: str, known: dict[str, float]) -> tuple[int, list[int], list[float]]:
        """Number of words, and places and scores of those with a score; ``known`` keeps words seen before."""
        words = _WORDS(text.lower())
        places, scores = [], []
        for i, w in enumerate(words):
            s = known.get(w)
            if s is None:
                if len(known) > 200_000:
                    known.clear()
                s = known[w] = self.word_score(w)
            if s:
                places.append(i)
                scores.append(s)
        return len(words), places, scores

    def segments(self, places: list[int], scores: list[float]) -> list[tuple[int, int, float]]:
        """All maximal scoring segments (first word, last word, score), left to right.

        Each scored word enters as a segment with the running totals before and after it. It is
        joined to the nearest earlier segment that begins lower as long as that one ends lower too;
        each segment is looked at a bounded number of times, so the time is linear.
        """
        stack: list[list] = []  # first, last, total before, total after, place of the nearest lower begin
        total, end = 0.0, -1
        for place, score in zip(places, scores, strict=True):
            total -= self.penalty * (place - end - 1)
            new = [place, place, total, total + score, -1]
            total, end = total + score, place
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= new[2]:
                    j = stack[j][4]
                if j < 0 or stack[j][3] >= new[3]:
                    new[4] = j
                    stack.append(new)
                    break
                new[0], new[2] = stack[j][0], stack[j][2]
                del stack[j:]
        return [(a, b, after - before) for a, b, before, after, _ in stack]

    def passages(self, words: int, places: list[int], scores: list[float]) -> list[tuple[int, int, float, float]]:
        """Significant segments with their expected number in clean text of this length."""
        found = [(a, b, s, self.scale * words * math.exp(-self.decay * s)) for a, b, s in self.segments(places, scores)]
        return [f for f in found if f[3] < SIGNIFICANT]

    def probability(self, passages: list[tuple[int, int, float, float]]) -> float:
        evidence = sum(-math.log(max(p[3], 1e-300)) for p in passages)
        return 1 / (1 + math.exp(-(self.intercept + self.slope * math.log1p(evidence))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of a bounded sample, and the number of labelled ids per class.

    An id with several labels has the largest; null labels are no labels. Of each class the ids of
    smallest hash are taken, so the ids to look up number at most twice ``per_class`` and their size
    bounds the broadcast. Rows of ``docs`` with a repeated id all come along.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    ids = cut(ids, "labels")
    sizes = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = [ids.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(taken[0].unionByName(taken[1])), "doc_id")
    return cut(sample, "labelled"), sizes


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            words = _WORDS(text.lower())
            if not words:
                continue
            words = [w for w, before in zip(words, [None, *words[:-1]], strict=True) if w != before]
            around = [a + " " + b for a, b in zip(["", *words[:-1]], [*words[1:], ""], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(around), pa.array([label] * len(words), pa.int32())], names=["token", "around", "label"]
            )


def _log_odds(sample: DataFrame) -> tuple[dict[str, float], float]:
    seen = sample.select("text", "label").mapInArrow(_occurrences, "token string, around string, label int")
    once = seen.select("token", "label", F.xxhash64("around").alias("around")).distinct()
    count = lambda c: F.sum(F.when(F.col("label") == c, 1).otherwise(0))
    words = cut(once.groupBy("token").agg(count(1).alias("toxic"), count(0).alias("other")), "word-counts")
    total = words.agg(F.sum("toxic").cast("double"), F.sum("other").cast("double")).first()
    if not total[0] or not total[1]:
        return {}, LEAST_PENALTY
    stems = words.withColumn("k", F.explode(F.array(*map(F.lit, STEMS)))).where(F.length("token") > F.col("k"))
    stems = stems.groupBy(F.concat(F.expr("left(token, k)"), F.lit("*")).alias("token")).agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    odds = lambda c, n: F.log((F.col(c) + PRIOR) / (n + PRIOR - F.col(c)))
    spread = F.sqrt(1 / (F.col("toxic") + PRIOR) + 1 / (F.col("other") + PRIOR))
    tokens = (
        words.unionByName(stems)
        .withColumn("delta", odds("toxic", total[0]) - odds("other", total[1]))
        .withColumn("z", F.col("delta") / spread)
        .where(F.col("z") >= LEAST_Z)
        .select("token", "z", (F.col("delta") - 1.96 * spread).alias("score"))
        .where("score > 0")
    )
    found = tokens.orderBy(F.col("z").desc(), "token").limit(LEXICON).toArrow().to_pydict()
    return dict(zip(found["token"], found["score"], strict=True)), LEAST_PENALTY


def _decay(steps: list[tuple[float, float]]) -> float:
    """The positive root of sum(p exp(lambda s)) = 1 over (score, probability)."""
    value = lambda x: sum(p * math.exp(min(x * s, 700.0)) for s, p in steps) - 1
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic regression with a slight ridge, by Newton steps."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * beta
        curve = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(beta[0]), float(beta[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Fit the lexicon and the calibrations on labelled texts (see ``labelled_sample``).

    What reaches the driver is bounded: the lexicon by ``LEXICON``, word scores of clean texts by
    rounding, and one row of three numbers per sampled text for the logistic curve. Without texts of
    both classes every text scores the same, low value.
    """
    sample, sizes = labelled_sample(docs, labels, label, per_class)
    scores, penalty = _log_odds(sample)
    if not scores:
        return ToxicityModel({}, penalty)
    raw = ToxicityModel(scores, penalty)

    def find(model: ToxicityModel, columns: str, row):
        known: dict[str, float] = {}

        def compute(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {}
            for text in texts(batch.column("text")):
                for name, value in row(model, *model.hits(text, known)).items():
                    out.setdefault(name, []).append(value)
            return out or {c.split()[0]: [] for c in columns.split(", ")}

        return arrow_rows(sample, compute, columns, ["label"])

    hits = cut(find(raw, "words long, hits array<double>, best double", lambda m, n, p, s: {"words": n, "hits": s, "best": max((x[2] for x in m.segments(p, s)), default=0.0)}), "toxic-hits").where("label = 0")
    words, texts_n = hits.agg(F.sum("words"), F.count("*")).first()
    found = hits.select(F.explode("hits").alias("s")).groupBy(F.round("s", 1).alias("s")).count().collect()
    counted = [(r["s"], r["count"]) for r in found] or [(sum(scores.values()) / len(scores), 0.5)]
    number = sum(c for _, c in counted)
    words = max(words or 0, number + 1)
    decay = _decay([(-penalty, (words - number) / words), *((s, c / words) for s, c in counted)])
    # Given lambda, the likeliest K of the law of the best segment.
    mass = hits.agg(F.sum(F.col("words") * F.exp(-decay * F.col("best")))).first()[0]
    scale = (texts_n or 1) / mass if mass else 1.0
    model = ToxicityModel(scores, penalty, decay, min(scale, 1.0))

    rows = find(model, "evidence double", lambda m, n, p, s: {"evidence": sum(-math.log(max(x[3], 1e-300)) for x in m.passages(n, p, s))})
    pairs = rows.toArrow()
    y, evidence = np.asarray(pairs["label"], float), np.asarray(pairs["evidence"], float)
    weight = np.where(y == 1, sizes.get(1, 0) / max(y.sum(), 1), sizes.get(0, 0) / max((1 - y).sum(), 1))
    weight = weight / weight.mean()
    intercept, slope = _logistic(np.log1p(evidence), y, weight)
    return ToxicityModel(scores, penalty, decay, min(scale, 1.0), intercept, max(slope, 0.0))


def score_toxicity(
    df: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None, threshold: float = 0.3, passages: bool = False
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (score >= ``threshold``) to every row, and ``passages`` if asked for.

    The whole text is scored; null and empty texts have no passage and get the score of such texts.
    ``passages`` lists the significant segments as (first and last word counted from 0, score,
    expected number in clean text). Rows stay where they are; repeated rows and other columns (but
    for earlier ones of the new names, which are replaced) need no rule.
    """
    known: dict[str, float] = {}

    def compute(batch: pa.RecordBatch) -> dict:
        found = [model.passages(*model.hits(t, known)) for t in texts(batch.column(text))]
        scores = [model.probability(f) for f in found]
        out = {"score": scores, "predicted": [int(s >= threshold) for s in scores]}
        if passages:
            out["passages"] = [[dict(zip(("first", "last", "score", "expected"), p, strict=True)) for p in f] for f in found]
        return out

    columns = "score double, predicted int"
    if passages:
        columns += ", passages array<struct<first: int, last: int, score: double, expected: double>>"
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("score", "predicted", "passages")]
    return arrow_rows(df.select(*dict.fromkeys([*keep, text])), compute, columns, keep)
