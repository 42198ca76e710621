"""Periodic runs of words: difference-cover LCE queries over a harmonic grid of positions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``max(MIN_LENGTH, 2q)`` words long, that no neighbouring word extends keeping period q.

Longest common extensions (LCE) answer "for how many words do the suffixes at i and j agree". They
come from a difference cover D modulo v: for every two positions i, j there is a k < v with i+k and
j+k both in the sample {i : i mod v in D}. Only sampled suffixes are sorted (prefix doubling over
the sample, whose members stay sampled when moved by multiples of v), neighbours in that order get
their common prefix length, and a sparse table answers range minima over it. A query compares at
most k words directly, then asks the table about the two synchronised samples.

Every run of period p holds two grid points jp and jp+p. For every p, the forward LCE of (jp, jp+p)
and the backward one (on the reversed words) give the maximal stretch of period p through them; it
is a run if it is long enough. Over all p there are about n ln n grid points. A stretch found for
several periods keeps the smallest one: its smallest period divides the others (Fine and Wilf),
and it is maximal for that one too.

Rows keep their place: one row out per row in, repeated rows too. A null or empty text has no
words (n=0): no runs, four nulls, sha256 of the empty text twice. A null doc_id is never rewritten.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 12
# Modulus of the difference cover: a query compares at most this many words directly.
COVER_MODULUS = 13
# Grid points answered at once; bounds the memory of a very long text.
GRID_BLOCK = 1 << 20

RUN_COLUMNS = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string, n_words long"
)


@functools.lru_cache(maxsize=8)
def difference_cover(v: int) -> np.ndarray:
    """The smallest D in [0, v) whose differences modulo v give every residue (first found)."""
    for size in range(1, v + 1):
        for rest in itertools.combinations(range(1, v), size - 1):
            cover = (0, *rest)
            if len({(a - b) % v for a in cover for b in cover}) == v:
                return np.array(cover, dtype=np.int64)
    raise ValueError(v)


@functools.lru_cache(maxsize=8)
def cover_tables(v: int) -> tuple[np.ndarray, np.ndarray]:
    """Membership of each residue in the cover, and step[a, b]: the smallest k with a+k, b+k sampled."""
    in_cover = np.zeros(v, dtype=bool)
    in_cover[difference_cover(v)] = True
    ks = np.arange(v)
    step = np.array([[ks[in_cover[(a + ks) % v] & in_cover[(b + ks) % v]][0] for b in range(v)] for a in range(v)])
    return in_cover, step


class CoverLCE:
    """Longest common extensions of one sequence of integer symbols."""

    def __init__(self, symbols: np.ndarray, v: int = COVER_MODULUS) -> None:
        n = len(symbols)
        self.n, self.v = n, v
        # Past the end every position holds its own symbol, so no extension runs over the end.
        self.s = np.concatenate([symbols.astype(np.int64), -1 - np.arange(v + 1, dtype=np.int64)])
        in_cover, self.step = cover_tables(v)
        sample = np.flatnonzero(in_cover[np.arange(n) % v])
        self.sample = sample
        index = np.full(n + 2 * v + 1, -1, dtype=np.int64)
        index[sample] = np.arange(len(sample))
        self.index = index
        self.rank, lcp = self._sort(sample)
        self.table = _sparse_table(lcp)

    def _sort(self, sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the sampled suffixes and the common prefix lengths of neighbours in that order."""
        v, n, m = self.v, self.n, len(sample)
        window = self.s[np.minimum(sample[:, None] + np.arange(v), n + v)]
        # Round 0 orders by the first v symbols; round r by the first v * 2**r.
        order = np.lexsort(window.T[::-1])
        fresh = np.ones(m, dtype=bool)
        fresh[1:] = np.any(window[order[1:]] != window[order[:-1]], axis=1)
        rank = np.empty(m, dtype=np.int64)
        rank[order] = np.cumsum(fresh) - 1
        ranks, width = [rank], v
        while rank.max(initial=-1) < m - 1 and width < n + v:
            ahead = self.index[np.minimum(sample + width, n + v)]
            second = np.where(ahead >= 0, rank[np.maximum(ahead, 0)] + 1, 0)
            second[sample + width >= n] = 0
            order = np.lexsort((second, rank))
            first, nxt = rank[order], second[order]
            fresh[1:] = (first[1:] != first[:-1]) | (nxt[1:] != nxt[:-1])
            rank = np.empty(m, dtype=np.int64)
            rank[order] = np.cumsum(fresh) - 1
            ranks.append(rank)
            width *= 2
        order = np.argsort(rank, kind="stable")
        # Common prefixes of neighbours by lifting over the ranks of every round, then v direct steps.
        a, b = sample[order[:-1]], sample[order[1:]]
        common = np.zeros(len(a), dtype=np.int64)
        for r in range(len(ranks) - 1, -1, -1):
            span = v << r
            ia, ib = self.index[np.minimum(a + common, n + v)], self.index[np.minimum(b + common, n + v)]
            live = (ia >= 0) & (ib >= 0) & (a + common < n) & (b + common < n)
            same = np.zeros(len(a), dtype=bool)
            same[live] = ranks[r][ia[live]] == ranks[r][ib[live]]
            common[same] += span
        common += self._agree(a + common, b + common, v)
        place = np.empty(m, dtype=np.int64)
        place[order] = np.arange(m)
        return place, common

    def _agree(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """Number of leading words, up to ``most``, on which the suffixes at i and j agree."""
        last = self.n + self.v
        steps = np.arange(most)
        differ = self.s[np.minimum(i[:, None] + steps, last)] != self.s[np.minimum(j[:, None] + steps, last)]
        # A position past the end holds its own symbol, so (for i != j) no row agrees past it.
        differ[:, -1] |= ~differ.any(axis=1) & (np.maximum(i, j) + most > self.n)
        return np.where(differ.any(axis=1), differ.argmax(axis=1), most)

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """LCE of the suffixes at i and j (arrays, i != j, both < n)."""
        v, n = self.v, self.n
        k = self.step[i % v, j % v]
        out = np.minimum(self._agree(i, j, v), k)
        todo = out == k
        a, b = i[todo] + k[todo], j[todo] + k[todo]
        over = (a >= n) | (b >= n)
        got = np.zeros(len(a), dtype=np.int64)
        inner = ~over
        ra, rb = self.rank[self.index[a[inner]]], self.rank[self.index[b[inner]]]
        got[inner] = _range_min(self.table, np.minimum(ra, rb), np.maximum(ra, rb) - 1)
        out[todo] = k[todo] + got
        return out


def _sparse_table(values: np.ndarray) -> list[np.ndarray]:
    levels = [values]
    width = 1
    while 2 * width <= len(values):
        last = levels[-1]
        levels.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    return levels


def _range_min(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo..hi] (inclusive, lo <= hi)."""
    if not len(lo):
        return np.zeros(0, dtype=np.int64)
    level = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
    out = np.empty(len(lo), dtype=np.int64)
    for r in np.unique(level):
        pick = level == r
        out[pick] = np.minimum(table[r][lo[pick]], table[r][hi[pick] - (1 << r) + 1])
    return out


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), ordered by start, then period.

    Only grid points (i, i+p) whose words agree at i and at one neighbour (i+1 or i-1) are asked:
    a run of period p holds a grid pair inside it that passes both tests (it is at least 12 words
    and 2p long), so no run is missed. The LCE structures are built when the first point passes.
    """
    n = len(symbols)
    if n < max(min_length, 2):
        return []
    s = symbols.astype(np.int64)
    lce = {}
    hits = []
    periods = np.arange(1, n // 2 + 1, dtype=np.int64)
    counts = (n - 1) // periods  # grid points jp with jp + p < n
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(periods):
        base = int(ends[begin - 1]) if begin else 0
        stop = max(int(np.searchsorted(ends, base + GRID_BLOCK, side="right")), begin + 1)
        p = np.repeat(periods[begin:stop], counts[begin:stop])
        first = np.repeat(ends[begin:stop] - counts[begin:stop], counts[begin:stop])
        i = (np.arange(len(p)) + base - first) * p
        begin = stop
        pick = s[i] == s[i + p]
        after = i + p + 1 < n
        near = np.zeros(len(i), dtype=bool)
        near[after] = s[i[after] + 1] == s[i[after] + p[after] + 1]
        inner = i > 0
        near[inner] |= s[i[inner] - 1] == s[i[inner] + p[inner] - 1]
        pick &= near
        if not pick.any():
            continue
        i, p = i[pick], p[pick]
        if not lce:
            lce["forward"], lce["backward"] = CoverLCE(s), CoverLCE(s[::-1].copy())
        ahead = lce["forward"].extend(i, i + p)
        behind = np.zeros(len(i), dtype=np.int64)
        inner = i > 0
        # Backward: words i-1-t and i+p-1-t, at reversed positions n-i+t and n-i-p+t.
        behind[inner] = lce["backward"].extend(n - i[inner], n - i[inner] - p[inner])
        length = behind + ahead + p
        keep = length >= np.maximum(min_length, 2 * p)
        hits.append(_smallest_period((i - behind)[keep], length[keep], p[keep]))
    if not hits:
        return []
    start, length, period = _smallest_period(*(np.concatenate(parts) for parts in zip(*hits)))
    order = np.lexsort((period, start))
    return list(zip(start[order].tolist(), length[order].tolist(), period[order].tolist()))


def _smallest_period(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row per stretch (start, length), with the smallest period it was found for."""
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[first], length[first], period[first]


def plant(doc_id: int | None, words: list[str]) -> list[str]:
    """The contract's rewrite: some documents repeat a stretch of their own words from a on."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def describe_runs(doc_id: int | None, text: str | None) -> dict:
    """All columns of one text."""
    words = plant(doc_id, WORD.findall(text or ""))
    symbols = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) if words else np.zeros(0, dtype=np.int64)
    runs = find_runs(symbols)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for s, ln, q in runs:
        dropped[s + q] += 1
        dropped[s + ln] -= 1
    kept = np.cumsum(dropped[:-1]) == 0
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return {
        "n_runs": len(runs),
        "start": best[0] if best else None,
        "length": best[1] if best else None,
        "period": best[2] if best else None,
        "exponent_milli": (1000 * best[1]) // best[2] if best else None,
        "runs_sha256": hashlib.sha256("".join(f"{s},{ln},{q}\n" for s, ln, q in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(itertools.compress(words, kept.tolist())).encode()).hexdigest(),
        "n_words": len(words),
    }


def detect_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the run columns (``RUN_COLUMNS``) to every row; no shuffle, rows keep their place."""
    keep = list(docs.columns) if keep is None else keep

    def compute(batch: pa.RecordBatch) -> dict:
        found = [describe_runs(d, t) for d, t in zip(batch.column(id_column).to_pylist(), batch.column(text_column).to_pylist())]
        return {name: [f[name] for f in found] for name in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")}

    clash = [c for c in keep if c in {f.split()[0] for f in RUN_COLUMNS.split(", ")}]
    if clash:
        raise ValueError(f"kept columns clash with the run columns: {clash}")
    source = docs.select(*dict.fromkeys([*keep, id_column, text_column]))
    return arrow_rows(source, compute, RUN_COLUMNS, keep)
