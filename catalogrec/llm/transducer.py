"""Token counts by a deterministic finite-state transducer compiled from a BPE vocabulary.

The BPE encoding of a prefix ends with one token, and a sequence of tokens is an encoding exactly if
every two neighbours are (if the pair's joint text encodes to that pair). So reading a sign more needs
only the open positions: those from which the signs up to here begin a token, each with the token
that ends there and the count of tokens up to there. These make up a state; a transition is
annotated with the number of tokens by which the count of the prefix changes, and the count of a text
is the sum over its path. States and transitions are compiled when they are first met and kept.

No token runs across the border from another sign to a space, nor across a sign that is no token, so
behind such a border every state is the start state. A text is cut into chunks there. The state map
of a chunk (from the state before it to the state behind it and its count) is then constant, the
composition of neighbouring maps adds their counts, and the parallel prefix scan over all chunks of
a batch is a cumulative sum, read off at the ends of the texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, texts

SPACE = "▁"
# Chunks whose counts a worker keeps, and compiled transitions; beyond that they are made anew.
KEPT_CHUNKS = 250_000
KEPT_TRANSITIONS = 550_000


class Transducer:
    """The compiled automaton of one vocabulary; one per Python worker."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        # Merges are taken by score, not by id.
        self._score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self._score):
            raise ValueError("a token holds a space behind another sign")
        self._child: dict[tuple[int, str], int] = {}
        self._token: list[str | None] = [None]
        self._inner = {0}
        for piece in self._score:
            node = 0
            for sign in piece:
                following = self._child.get((node, sign))
                if following is None:
                    following = self._child[node, sign] = len(self._token)
                    self._token.append(None)
                self._inner.add(node)
                node = following
            self._token[node] = piece
        self._signs = {p for p in self._score if len(p) == 1}
        self._follows: dict[tuple[str | None, str], bool] = {}
        self._counts: dict[str, int] = {}
        borders = "\\n" if "\n" not in self._signs else ""
        self._chunks = re.compile(f"{SPACE}+[^{SPACE}{borders}]*|[^{SPACE}{borders}]+" + (f"|{borders}+" if borders else "")).findall
        self._forget()

    def _forget(self) -> None:
        start = ((0, None, 0),)
        self._states: dict[tuple, int] = {start: 0}
        self._open = [start]
        self._next: list[dict[str, tuple[int, int]]] = [{}]
        self._transitions = 0

    def merge(self, text: str) -> list[str]:
        """The tokens of a short text by the rule itself: the best-scored pair first, then the leftmost."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                score = self._score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _may_follow(self, token: str | None, then: str) -> bool:
        key = (token, then)
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) > 2 * KEPT_TRANSITIONS:
                self._follows.clear()
            known = self._follows[key] = self.merge((token or "") + then) == ([token, then] if token else [then])
        return known

    def _compile(self, state: int, sign: str) -> tuple[int, int]:
        """The transition of a state for a sign: next state and change of the count."""
        if sign not in self._signs:
            step = (0, len(sign.encode()))
        else:
            moved, ended, emitted = [], None, 0
            for node, token, behind in self._open[state]:
                child = self._child.get((node, sign))
                if child is None:
                    continue
                whole = self._token[child]
                if ended is None and whole is not None and self._may_follow(token, whole):
                    ended, emitted = whole, behind + 1
                if child in self._inner:
                    moved.append((child, token, behind))
            opened = (*((c, t, b - emitted) for c, t, b in moved), (0, ended, 0))
            number = self._states.get(opened)
            if number is None:
                number = self._states[opened] = len(self._open)
                self._open.append(opened)
                self._next.append({})
            step = (number, emitted)
        self._next[state][sign] = step
        self._transitions += 1
        return step

    def run(self, chunk: str) -> int:
        """Tokens of a chunk, from the start state."""
        if self._transitions > KEPT_TRANSITIONS:
            self._forget()
        state = count = 0
        following = self._next
        for sign in chunk:
            step = following[state].get(sign)
            if step is None:
                step = self._compile(state, sign)
            state = step[0]
            count += step[1]
        return count

    def count(self, values: list[str]) -> np.ndarray:
        """Tokens of each text."""
        chunked = [self._chunks(SPACE + v.replace(" ", SPACE)) if v else [] for v in values]
        if len(self._counts) > KEPT_CHUNKS:
            self._counts.clear()
        for chunk in set().union(*chunked).difference(self._counts):
            self._counts[chunk] = self.run(chunk)
        get = self._counts.__getitem__
        sizes = [len(c) for c in chunked]
        steps = np.fromiter((get(c) for chunks in chunked for c in chunks), np.int64, sum(sizes))
        scanned = np.concatenate(([0], np.cumsum(steps)))
        ends = np.cumsum([0, *sizes])
        return scanned[ends[1:]] - scanned[ends[:-1]]


_transducers: dict[str, Transducer] = {}


def count_tokens(df: DataFrame, model_file: str, text: str = "text", keep: list[str] | None = None, limit: int = 4096) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to every row.

    The whole text is read; null counts as the empty text, which has no tokens. Special strings in a
    text are ordinary text, spaces are kept and a space is put before the text, signs outside the vocabulary
    count one token per byte. ``model_file`` is readable by every executor. Rows stay where they
    are; repeated rows and other columns (but for earlier ones of the new names, which are replaced) need no
    rule.
    """

    def compute(batch: pa.RecordBatch) -> dict:
        transducer = _transducers.get(model_file)
        if transducer is None:
            transducer = _transducers[model_file] = Transducer(model_file)
        values = texts(batch.column(text))
        counts: list[int] = []
        begin = 0
        while begin < len(values):  # some million signs at a time
            end, size = begin, 0
            while end < len(values) and (end == begin or size + len(values[end]) <= 4_000_000):
                size += len(values[end])
                end += 1
            counts += transducer.count(values[begin:end]).tolist()
            begin = end
        return {
            "n_bytes": [len(v.encode()) for v in values],
            "n_tokens": counts,
            "over_limit": [c > limit for c in counts],
        }

    keep = [c for c in (df.columns if keep is None else keep) if c not in ("n_bytes", "n_tokens", "over_limit")]
    return arrow_rows(df.select(*dict.fromkeys([*keep, text])), compute, "n_bytes long, n_tokens long, over_limit boolean", keep)
