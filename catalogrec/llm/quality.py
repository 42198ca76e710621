"""Document quality from a linear-chain conditional random field over lines.

Each line of a text is good or bad. Its features are shares of sign classes, repetition of words and
lines, and lengths, cut at fixed thresholds, of the line itself and of the lines before and after
it; neighbouring labels are linked. Forward and backward sums give each line's probability of being
good, whose mean weighted by line length says how good the text is. A logistic curve over its
log-odds makes the final score.

Only texts are labelled, so in fitting every line has the label of its text.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, texts
from .toxicity import labelled_sample

# The model is fitted on at most this many labelled texts of each class (those of smallest id hash)
# and on those of them with at most this many lines.
SAMPLE_PER_CLASS = 2000
FIT_LINES = 400
STEPS = 120
RIDGE = 1e-3

_THRESHOLDS = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7], np.float32)
_SHARES = 16
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _BAR, _BANG, _OTHER = range(8)
_classes: np.ndarray | None = None


def _class_table() -> np.ndarray:
    """Class of every code point."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, _OTHER, np.uint8)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))
            if kind[0] == "L" or kind[0] == "M":
                table[i] = _UPPER if kind in ("Lu", "Lt") else _LOWER
            elif kind == "Nd":
                table[i] = _DIGIT
            elif chr(i).isspace():
                table[i] = _SPACE
        table[[ord(c) for c in ".,;:'\"()-?"]] = _STOP
        table[ord("|")], table[ord("!")] = _BAR, _BANG
        _classes = table
    return _classes


def line_shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x 16 numbers from 0 to 1, characters of each line) of a whole text."""
    lines = text.split("\n")
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    points = np.frombuffer((text + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _class_table()[points]
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    counts = np.stack([np.add.reduceat((kinds == k).astype(np.int32), starts) for k in range(8)], axis=1).astype(np.float32)
    counts[:, _SPACE] -= 1  # the line feed
    n = np.maximum(lengths, 1).astype(np.float32)
    out = np.zeros((len(lines), _SHARES), np.float32)
    letters = np.maximum(counts[:, _LOWER] + counts[:, _UPPER], 1)
    out[:, 0] = counts[:, _UPPER] / letters
    for at, kind in ((1, _DIGIT), (2, _SPACE), (3, _STOP), (4, _BAR), (5, _BANG), (6, _OTHER)):
        out[:, at] = counts[:, kind] / n
    out[:, 7] = np.minimum(np.log1p(lengths) / 10, 1)
    seen = Counter(lines)
    before = None
    for i, line in enumerate(lines):
        words = line.split()
        if words:
            w = len(words)
            same = sum(map(str.__eq__, words[1:], words)) if w > 1 else 0
            out[i, 8] = 1 - len(set(words)) / w
            out[i, 9] = same / w
            out[i, 10] = min(lengths[i] / w / 40, 1)
            out[i, 11] = sum(len(x) < 4 for x in words) / w
        out[i, 12] = float(line == before)
        out[i, 13] = (seen[line] - 1) / len(lines)
        out[i, 14] = float(line.endswith((".", "?", ":", '"')))
        out[i, 15] = float(bool(line) and line[0].isupper())
        before = line
    return out, lengths


def _features(shares: np.ndarray) -> np.ndarray:
    """Indicators of shares above each threshold, for the line and both neighbours, and a constant."""
    own = (shares[:, :, None] > _THRESHOLDS).reshape(len(shares), -1).astype(np.float32)
    none = np.zeros((1, own.shape[1]), np.float32)
    edge = np.zeros((len(own), 3), np.float32)
    edge[:, 0], edge[0, 1], edge[-1, 2] = 1, 1, 1
    return np.concatenate([own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none]), edge], axis=1)


def _chain(scores: np.ndarray, link: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of good, expected label pairs and the log normaliser of many chains at once.

    ``scores`` are the log-odds of good of all lines of all texts, longest text first, and ``link`` the
    2 x 2 scores of neighbouring labels. The recursions run over line positions, for all texts that
    are long enough together.
    """
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    longest = int(sizes[0])
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t lines
    potential = np.stack([np.zeros_like(scores), scores], axis=1)
    forward, backward = np.empty_like(potential), np.zeros_like(potential)
    forward[starts] = potential[starts]
    for t in range(1, longest):
        at = starts[: alive[t]] + t
        forward[at] = potential[at] + np.logaddexp(forward[at - 1, :1] + link[0], forward[at - 1, 1:] + link[1])
    for t in range(longest - 2, -1, -1):
        at = starts[: alive[t + 1]] + t
        ahead = potential[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(link[:, 0] + ahead[:, :1], link[:, 1] + ahead[:, 1:])
    ends = starts + sizes - 1
    total = np.logaddexp(forward[ends, 0], forward[ends, 1])
    each = np.repeat(total, sizes)
    marginal = np.exp(forward[:, 1] + backward[:, 1] - each)
    inner = np.ones(len(scores), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    ahead = potential[at] + backward[at]
    pairs = np.exp(forward[at - 1][:, :, None] + link[None] + ahead[:, None, :] - each[at, None, None]).sum(0) if len(at) else np.zeros((2, 2))
    return marginal, pairs, float(total.sum())


@dataclass(frozen=True)
class QualityModel:
    """Weights of the line features, of neighbouring labels, and the final logistic curve."""

    weights: np.ndarray
    link: np.ndarray
    intercept: float = 0.0
    slope: float = 1.0

    def log_odds(self, shares: np.ndarray, lengths: np.ndarray) -> float:
        """Log-odds of the length-weighted mean of the lines' marginals."""
        marginal, _, _ = _chain((_features(shares) @ self.weights.astype(np.float32)).astype(np.float64), self.link, np.array([len(shares)]))
        mean = float(np.average(marginal, weights=lengths + 1))
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(mean / (1 - mean)))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-(self.intercept + self.slope * self.log_odds(*line_shares(text))))))


def _fit_chain(shares: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights by gradient ascent on the likelihood, each text counting once whatever its lines."""
    order = np.argsort([-len(s) for s in shares], kind="stable")
    sizes = np.array([len(shares[i]) for i in order])
    features = np.concatenate([_features(shares[i]) for i in order])
    good = np.repeat(labels[order], sizes).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    inner = np.ones(len(good), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[at - 1].astype(int), good[at].astype(int)), 1)
    weights, link = np.zeros(features.shape[1]), np.zeros((2, 2))
    state = [np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)]
    # Long chains of one label would make neighbours agree whatever the lines say; links are damped.
    for step in range(1, STEPS + 1):
        marginal, pairs, _ = _chain((features @ weights.astype(np.float32)).astype(np.float64), link, sizes)
        slope = np.concatenate([features.T @ (good - marginal).astype(np.float32), (seen - pairs).ravel()]) / len(good)
        slope -= np.concatenate([RIDGE * weights, 20 * RIDGE * link.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights = weights + move[:-4]
        link = link + move[-4:].reshape(2, 2)
    return weights, link


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Fit the field and the final curve on a bounded sample of labelled texts (see ``labelled_sample``).

    At most ``2 x per_class x FIT_LINES`` lines of 16 numbers reach the driver. Without texts of both classes every
    text scores one half.
    """
    from .toxicity import _logistic

    sample, sizes = labelled_sample(docs, labels, label, per_class)

    def compute(batch: pa.RecordBatch) -> dict:
        found = [line_shares(t) for t in texts(batch.column("text"))]
        fits = [len(n) <= FIT_LINES for _, n in found]
        return {
            "shares": [s.astype("<f4").tobytes() if f else None for (s, _), f in zip(found, fits, strict=True)],
            "lengths": [n.astype("<i8").tobytes() if f else None for (_, n), f in zip(found, fits, strict=True)],
        }

    rows = arrow_rows(sample, compute, "shares binary, lengths binary", ["doc_id", "label"]).where("shares is not null")
    rows = rows.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    labels_found = rows["label"].to_numpy(np.int64)
    if len(set(labels_found)) < 2:
        return QualityModel(np.zeros(3 * _SHARES * len(_THRESHOLDS) + 3), np.zeros((2, 2)))
    shares = [np.frombuffer(b, "<f4").reshape(-1, _SHARES) for b in rows["shares"]]
    lengths = [np.frombuffer(b, "<i8") for b in rows["lengths"]]
    model = QualityModel(*_fit_chain(shares, labels_found))
    x = np.array([model.log_odds(s, n) for s, n in zip(shares, lengths, strict=True)])
    weight = np.where(labels_found == 1, sizes[1] / (labels_found == 1).sum(), sizes[0] / (labels_found == 0).sum())
    intercept, slope = _logistic(x, labels_found.astype(float), weight / weight.mean())
    return QualityModel(model.weights, model.link, intercept, max(slope, 0.0))


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1, higher: better) and ``predicted`` (score >= ``threshold``) to every row.

    The whole text is scored; null and empty texts count as one empty line. Rows stay where they
    are; repeated rows and other columns (but for earlier ones of the new names, which are replaced)
    need no rule.
    """

    def compute(batch: pa.RecordBatch) -> dict:
        scores = [model.score(t) for t in texts(batch.column(text))]
        return {"score": scores, "predicted": [int(s >= threshold) for s in scores]}

    keep = [c for c in (df.columns if keep is None else keep) if c not in ("score", "predicted")]
    return arrow_rows(df.select(*dict.fromkeys([*keep, text])), compute, "score double, predicted int", keep)
