"""Personal data in texts by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans come from one pattern per kind (email, ip, card, phone), leftmost and non-overlapping,
kept when the kind's test passes (parts of an ip at most 255, 13 to 19 card digits passing Luhn,
9 to 15 phone digits); a failing match is dropped and not retried. Base spans always stay.

The method adds spans. Broader candidate patterns (written-out ``at``/``dot`` addresses, national
phone numbers, cards with dots, every base match including failing ones) give candidates, and
labelers vote on each (+1 personal, -1 not, 0 abstain):

- ``regex``: the base pattern and test of the kind (+1 passes, -1 fails, 0 no base match);
- ``checksum``: the kind's structure alone (Luhn, octets, digit count, top-level domain shape);
- ``gazetteer``: fixed public lists (top-level domains, calling codes, card issuer prefixes);
- ``context``: words of the kind in the 40 signs before the span (+1), or of ids and versions (-1);
- ``shape``: separators used alike throughout the span (+1) or mixed (-1).

Expectation-maximisation (a two-coin model per labeler and kind, abstentions ignored) estimates each
labeler's reliability from the vote patterns of all candidates; its posteriors are the soft labels of
a logistic span classifier over the votes and bucketed span features (length, digits, separators,
signs beside the span). A span against which the regex or checksum labeler votes is never added:
a kind whose candidates are all positive in a corpus gives the classifier no contrast. Both fits read only the table of (kind, pattern, features) -> count,
summed by Spark over all documents: its size is bounded by the product of the feature ranges
(``PATTERN_BOUND``), not by the corpus. A candidate the classifier gives at least ``ACCEPT`` is
added unless it overlaps a base span (of any kind: digits of an address are no phone number) or an
earlier added span of its kind.

Rows keep their place: one row out per row in. A null text is empty (no spans, sha256 of the empty
text). Spans are in code points, end exclusive, ordered by kind as listed, then start.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, texts

KINDS = ("email", "ip", "card", "phone")
# The base pattern of each kind, as the contract states them.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# A broad candidate stands alone: no digit, letter or joining sign right before or after it.
_ALONE, _ENDS = r"(?<![0-9A-Za-z.+-])", r"(?![0-9A-Za-z]|[.-][0-9])"
# Broader candidates the method adds to the base matches of the same kind.
BROAD = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]+\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]+(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[A-Za-z0-9-]+)+"
        r"|[A-Za-z0-9._%+-]+\sat\s[A-Za-z0-9-]+(?:\sdot\s[A-Za-z0-9-]+)+"
    ),
    "ip": re.compile(_ALONE + r"[0-9]{1,3}(?:\s?\[?\.\]?\s?[0-9]{1,3}){3}" + _ENDS),
    "card": re.compile(_ALONE + r"[0-9](?:[\x20.-]?[0-9]){12,18}" + _ENDS),
    "phone": re.compile(_ALONE + r"\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,5}" + _ENDS),
}
LABELERS = ("regex", "checksum", "gazetteer", "context", "shape")
# Public lists of the gazetteer labeler.
TOP_LEVEL = {"com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "uk", "de", "fr",
             "es", "it", "nl", "be", "ch", "at", "se", "no", "dk", "fi", "pl", "pt", "ru", "cn", "jp", "in",
             "br", "au", "ca", "us", "mx", "ar", "za", "kr", "tw", "eu", "me", "tv", "ai", "app", "dev"}
CALLING_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45",
                 "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63",
                 "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"}
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "30", "38", "2")
CONTEXT = {
    "email": ("mail", "contact", "write", "address", "reach"),
    "ip": ("ip", "server", "host", "address", "network", "connect"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp", "contact", "dial"),
}
NOT_PERSONAL = ("isbn", "version", "serial", "order", "invoice", "ref", "page", "doi", "issn", "v.")
CONTEXT_SIGNS = 40
ACCEPT = 0.5
EM_ROUNDS = 100
# Ranges of the classifier's features; their product bounds the rows of the summed table.
LENGTH_BUCKETS, DIGIT_BUCKETS, SIDE_CLASSES = 4, 4, 3
PATTERN_BOUND = len(KINDS) * 3 ** len(LABELERS) * LENGTH_BUCKETS * DIGIT_BUCKETS * 3 * SIDE_CLASSES**2

PII_COLUMNS = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if place % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def passes(kind: str, span: str) -> bool:
    """The contract's test of a base match."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(part) <= 255 for part in span.split("."))
    if kind == "card":
        d = _digits(span)
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(_digits(span)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end), by kind as listed, then start."""
    return [(kind, m.start(), m.end()) for kind in KINDS for m in BASE[kind].finditer(text) if passes(kind, m.group())]


def _structure(kind: str, span: str) -> int:
    d = _digits(span)
    if kind == "email":
        last = re.split(r"\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\s?\{dot\}\s?|\sdot\s", span)[-1]
        return 1 if last.isalpha() and 2 <= len(last) <= 6 else -1
    if kind == "ip":
        parts = re.findall(r"[0-9]+", span)
        return 1 if len(parts) == 4 and all(int(p) <= 255 for p in parts) else -1
    if kind == "card":
        return 1 if 13 <= len(d) <= 19 and luhn(d) else -1
    return 1 if 9 <= len(d) <= 15 else -1


def _gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        last = re.split(r"[.\s\])}]", span.strip())[-1].lower()
        return 1 if last in TOP_LEVEL else 0
    if kind == "phone":
        code = re.match(r"\+([0-9]{1,3})", span)
        return 1 if code and any(code.group(1).startswith(c) for c in CALLING_CODES) else 0
    if kind == "card":
        return 1 if _digits(span).startswith(CARD_PREFIXES) else 0
    first = re.match(r"[0-9]+", span)
    return 1 if first and 1 <= int(first.group()) <= 223 else -1


def _context(kind: str, before: str) -> int:
    window = before.lower()
    if any(word in window for word in NOT_PERSONAL):
        return -1
    return 1 if any(word in window for word in CONTEXT[kind]) else 0


def _shape(kind: str, span: str) -> int:
    seps = set(re.findall(r"[^0-9A-Za-z]", span)) - {"@", "%", "_", "+"}
    if kind == "email":
        return 0
    if kind == "card":
        groups = re.split(r"[\x20.-]", span)
        return 1 if len(seps) <= 1 and (len(groups) == 1 or all(len(g) == 4 for g in groups[:-1])) else -1
    return 1 if len(seps - {"(", ")"}) <= 1 else -1


def _side(sign: str) -> int:
    if not sign or sign.isspace():
        return 0
    return 1 if sign.isalnum() else 2


_DIGIT = re.compile(r"[0-9]")
_SPELLED_AT = re.compile(r"\(at\)|\[at\]|\{at\}|\sat\s[A-Za-z0-9-]+\sdot\s")


def _may_match(kind: str, base: bool, text: str, digits: bool) -> bool:
    """False only where the pattern cannot match: every match holds these signs."""
    if kind == "email":
        return "@" in text if base else _SPELLED_AT.search(text) is not None
    if not digits:
        return False
    if kind == "phone" and base:
        return "+" in text
    if kind == "ip":
        return "." in text
    return True


def candidates(text: str) -> Iterator[tuple[str, int, int, bool, tuple[int, ...]]]:
    """Every candidate span: (kind, start, end, is a base span, votes and features)."""
    digits = _DIGIT.search(text) is not None
    for kind in KINDS:
        seen = set()
        for pattern in (BASE[kind], BROAD[kind]):
            if not _may_match(kind, pattern is BASE[kind], text, digits):
                continue
            for m in pattern.finditer(text):
                start, end = m.span()
                if (start, end) in seen:
                    continue
                seen.add((start, end))
                span = m.group()
                exact = BASE[kind].fullmatch(span) is not None
                base = pattern is BASE[kind] and passes(kind, span)
                regex = (1 if base else -1) if pattern is BASE[kind] else (0 if not exact else (1 if passes(kind, span) else -1))
                votes = (regex, _structure(kind, span), _gazetteer(kind, span), _context(kind, text[max(0, start - CONTEXT_SIGNS):start]), _shape(kind, span))
                features = (
                    min(LENGTH_BUCKETS - 1, (end - start) // 8),
                    min(DIGIT_BUCKETS - 1, len(_digits(span)) // 5),
                    min(2, len(set(re.findall(r"[\x20.()-]", span)))),
                    _side(text[start - 1] if start else ""),
                    _side(text[end] if end < len(text) else ""),
                )
                yield kind, start, end, base, votes + features


def pattern_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(kind, pattern, n): candidates of every document summed per pattern; summed in the task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for text in texts(batch.column(text_column)):
                counted.update((kind, ",".join(map(str, pattern))) for kind, _, _, _, pattern in candidates(text))
        items = list(counted.items())
        yield pa.RecordBatch.from_pydict({
            "kind": [k for (k, _), _ in items], "pattern": [p for (_, p), _ in items], "n": [n for _, n in items]
        }, schema=pa.schema([("kind", pa.string()), ("pattern", pa.string()), ("n", pa.int64())]))

    local = docs.select(text_column).mapInArrow(count, "kind string, pattern string, n long")
    return local.groupBy("kind", "pattern").agg(F.sum("n").alias("n"))


def expectation_maximisation(votes: np.ndarray, weight: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of 'personal' per row of votes (+1/-1/0 per labeler), and each labeler's accuracies.

    Two coins per labeler: a = P(+1 | personal, voted), b = P(-1 | not personal, voted).
    """
    m = votes.shape[1]
    a, b, prior = np.full(m, 0.7), np.full(m, 0.7), 0.5
    post = np.full(len(votes), 0.5)
    for _ in range(rounds):
        yes = np.log(prior) + np.sum(np.where(votes > 0, np.log(a), np.where(votes < 0, np.log1p(-a), 0.0)), axis=1)
        no = np.log1p(-prior) + np.sum(np.where(votes < 0, np.log(b), np.where(votes > 0, np.log1p(-b), 0.0)), axis=1)
        post = 1.0 / (1.0 + np.exp(no - yes))
        wy, wn = weight * post, weight * (1 - post)
        prior = np.clip(wy.sum() / max(weight.sum(), 1e-12), 1e-4, 1 - 1e-4)
        a = np.clip(((votes > 0) * wy[:, None]).sum(0) / np.maximum(((votes != 0) * wy[:, None]).sum(0), 1e-12), 0.05, 0.995)
        b = np.clip(((votes < 0) * wn[:, None]).sum(0) / np.maximum(((votes != 0) * wn[:, None]).sum(0), 1e-12), 0.05, 0.995)
        # Labelers that never vote keep the neutral 0.5 of an unknown coin.
        silent = (np.abs(votes) * weight[:, None]).sum(0) == 0
        a[silent], b[silent] = 0.5, 0.5
    return post, np.stack([a, b])


def _design(rows: np.ndarray) -> np.ndarray:
    """One-hot columns of every vote and feature, and a constant."""
    columns = [np.ones((len(rows), 1))]
    for c in range(rows.shape[1]):
        values = rows[:, c]
        columns.append(np.stack([values == v for v in range(-1, 4)], axis=1).astype(float))
    return np.hstack(columns)


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weighted logistic regression on soft targets by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-(x @ w)))
        grad = x.T @ (weight * (p - target)) + l2 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + l2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class PiiModel:
    """Labeler reliabilities and the span classifier, per kind."""

    def __init__(self, weights: dict[str, np.ndarray], reliability: dict[str, np.ndarray]) -> None:
        self.weights, self.reliability = weights, reliability
        self._known: dict[tuple, float] = {}

    def probability(self, kind: str, pattern: tuple[int, ...]) -> float:
        w = self.weights.get(kind)
        if w is None:
            return 0.0
        key = (kind, pattern)
        if key not in self._known:
            self._known[key] = float(1.0 / (1.0 + np.exp(-(_design(np.array([pattern])) @ w)[0])))
        return self._known[key]

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans and all spans, each by kind as listed, then start."""
        base = base_spans(text)
        taken = {kind: [(s, e) for k, s, e in base if k == kind] for kind in KINDS}
        added = []
        for kind, start, end, is_base, pattern in sorted(candidates(text), key=lambda c: (KINDS.index(c[0]), c[1], -c[2])):
            if is_base or any(s < end and start < e for s, e in taken[kind]) or any(s < end and start < e for _, s, e in base):
                continue
            # A span whose own structure fails its kind's test is never added.
            if pattern[1] >= 0 and pattern[0] >= 0 and self.probability(kind, pattern) >= ACCEPT:
                taken[kind].append((start, end))
                added.append((kind, start, end))
        every = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        return base, every


def fit_pii(docs: DataFrame, text_column: str = "text") -> PiiModel:
    """Estimate reliabilities and the classifier from the candidates of all documents."""
    counts = pattern_counts(docs, text_column)
    rows = counts.limit(PATTERN_BOUND + 1).collect()  # bounded by the feature ranges, not the corpus
    weights, reliability = {}, {}
    for kind in KINDS:
        mine = [r for r in rows if r["kind"] == kind]
        if not mine:
            continue
        pattern = np.array([[int(v) for v in r["pattern"].split(",")] for r in mine])
        n = np.array([r["n"] for r in mine], dtype=float)
        post, reliability[kind] = expectation_maximisation(pattern[:, : len(LABELERS)], n)
        weights[kind] = fit_logistic(_design(pattern), post, n)
    return PiiModel(weights, reliability)


def find_pii(docs: DataFrame, model: PiiModel, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``PII_COLUMNS`` to every row; no shuffle, rows keep their place."""
    keep = [c for c in docs.columns if c != text_column] if keep is None else keep
    clash = [c for c in keep if c in {f.split()[0] for f in PII_COLUMNS.split(", ")}]
    if clash:
        raise ValueError(f"kept columns clash with the output columns: {clash}")

    def joined(spans: list[tuple[str, int, int]]) -> str:
        return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)

    def compute(batch: pa.RecordBatch) -> dict:
        out = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
        for text in texts(batch.column(text_column)):
            base, every = model.spans(text)
            kinds = Counter(k for k, _, _ in base)
            for kind in KINDS:
                out[f"n_{kind}"].append(kinds[kind])
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(every))
            out["n_added"].append(len(every) - len(base))
        return out

    source = docs.select(*dict.fromkeys([*keep, text_column]))
    return arrow_rows(source, compute, PII_COLUMNS, keep)

