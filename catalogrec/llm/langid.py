"""Language identification with hyperdimensional profiles.

Every letter owns a random bipolar vector. A trigram is bound from its letters: the first vector
rotated twice, the second rotated once and the third, multiplied coordinate by coordinate. A text is
the bundle (sum) of its trigrams, a language the bundle of the texts known to be written in it, and
a text gets the language whose bundle is nearest by cosine.

Bits stand for the signs, so binding is an exclusive or and a bundle is twice the bit counts less
the number of trigrams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, mix64, texts

WIDTH = 1024
_WORDS = WIDTH // 64
_SPACE = 32
_CACHED = 16_384
TEMPERATURE = 0.05
UNKNOWN = "und"
MAX_LANGUAGES = 4096

_is_letter: np.ndarray | None = None


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; every run of other signs is one space, none at the ends."""
    global _is_letter
    if _is_letter is None:
        _is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter[points]
    starts = np.ones(len(points), bool)
    starts[1:] = letter[:-1]
    points = np.where(letter, points, _SPACE)[letter | starts]
    low = int(len(points) > 0 and points[0] == _SPACE)
    high = len(points) - int(len(points) > low and points[-1] == _SPACE)
    return points[low:high].astype(np.uint64)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of the padded text, three code points in a 63-bit integer, and their counts."""
    points = _letters(text)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    padded = np.concatenate(([_SPACE], points, [_SPACE])).astype(np.uint64)
    keys = (padded[:-2] << np.uint64(42)) | (padded[1:-1] << np.uint64(21)) | padded[2:]
    return np.unique(keys, return_counts=True)


def _letter_vectors(points: np.ndarray) -> np.ndarray:
    lanes = np.arange(1, _WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(mix64(points[:, None] + np.uint64(1)) + lanes[None, :])


def trigram_bits(keys: np.ndarray) -> np.ndarray:
    """The bound vectors of trigrams, one row of ``WIDTH`` zeros and ones each."""
    mask = np.uint64((1 << 21) - 1)
    first, second, third = (_letter_vectors((keys >> np.uint64(s)) & mask) for s in (42, 21, 0))
    bound = np.roll(first, 2, axis=1) ^ np.roll(second, 1, axis=1) ^ third
    return np.unpackbits(bound.view(np.uint8).reshape(len(keys), -1), axis=1)


class Bundler:
    """Bundles of texts; bound trigrams are kept, up to a fixed number, between texts."""

    def __init__(self) -> None:
        self._rows: dict[int, int] = {}
        self._bits = np.zeros((_CACHED, WIDTH), np.float32)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(WIDTH, np.float64)
        for start in range(0, len(keys), _CACHED // 2):
            part = slice(start, start + _CACHED // 2)
            total += counts[part].astype(np.float32) @ self._bits[self._at(keys[part])]
        return 2 * total - counts.sum()

    def _at(self, keys: np.ndarray) -> np.ndarray:
        listed = keys.tolist()
        new = [k for k in listed if k not in self._rows]
        if len(self._rows) + len(new) > _CACHED:
            self._rows.clear()
            new = listed
        if new:
            begin = len(self._rows)
            self._bits[begin : begin + len(new)] = trigram_bits(np.array(new, np.uint64))
            self._rows.update(zip(new, range(begin, begin + len(new)), strict=True))
        return np.fromiter(map(self._rows.__getitem__, listed), np.int64, len(listed))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gathered: dict[str, list] = {}
        for text, lang in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            keys, counts = trigrams(text)
            gathered.setdefault(lang, []).append((keys, counts))
        for lang, parts in gathered.items():
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([c for _, c in parts]), len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "trigram", "n"],
            )


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        keys = np.asarray(batch.column(1)).astype(np.uint64)
        counts = np.asarray(batch.column(2)).astype(np.int64)
        for start in range(0, len(keys), 4096):
            part = slice(start, start + 4096)
            signs = trigram_bits(keys[part]).astype(np.int64) * 2 - 1
            for lang in set(langs[part]):
                own = langs[part] == lang
                sums[lang] = sums.get(lang, 0) + counts[part][own] @ signs[own]
    for lang, vector in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * WIDTH), pa.array(range(WIDTH), pa.int32()), pa.array(vector)],
            names=["lang", "place", "value"],
        )


def language_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The bundle of every language in ``lang`` over all texts of ``labelled``; rows without one are left out.

    Trigram counts are summed by Spark, bundled per partition, and the bundles are summed per
    language and coordinate, so ``languages x WIDTH`` numbers reach the driver. All sums are of
    integers and do not depend on the order of the rows. More than ``MAX_LANGUAGES`` values mean that
    the column holds no languages: an error.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null")
    counts = rows.mapInArrow(_counted, "lang string, trigram long, n long").groupBy("lang", "trigram")
    bundles = (
        counts.agg(F.sum("n").alias("n"))
        .mapInArrow(_bundled, "lang string, place int, value long")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
    )
    found = bundles.limit(MAX_LANGUAGES * WIDTH + 1).toArrow().to_pydict()
    if len(found["lang"]) > MAX_LANGUAGES * WIDTH:
        raise ValueError(f"column {lang} has more than {MAX_LANGUAGES} values")
    profiles: dict[str, np.ndarray] = {}
    for name, place, value in zip(found["lang"], found["place"], found["value"], strict=True):
        profiles.setdefault(name, np.zeros(WIDTH))[place] = value
    return {name: profiles[name] for name in sorted(profiles) if profiles[name].any()}


def identify_language(
    df: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row; ``keep`` names the columns passed on (default all).

    Each whole text is bundled and compared with all profiles by cosine; ``score`` is the share of
    the best profile in a softmax over the cosines. Ties go to the first language by name. A text
    that is null, empty or without a letter, and any text when no profile exists, is ``und`` with
    score 0. Row count, repeated rows and other columns do not matter.
    """
    names = list(profiles)
    matrix = np.array([profiles[n] / np.linalg.norm(profiles[n]) for n in names]).reshape(len(names), WIDTH)
    state: dict[str, Bundler] = {}

    def compute(batch: pa.RecordBatch) -> dict:
        bundler = state.setdefault("bundler", Bundler())
        predicted, scores = [], []
        for value in texts(batch.column(text)):
            keys, counts = trigrams(value)
            vector = bundler.bundle(keys, counts) if len(keys) and names else np.zeros(WIDTH)
            length = np.linalg.norm(vector)
            if not length:
                predicted.append(UNKNOWN)
                scores.append(0.0)
                continue
            cosines = matrix @ (vector / length)
            best = int(np.argmax(cosines))
            predicted.append(names[best])
            scores.append(float(1 / np.exp((cosines - cosines[best]) / TEMPERATURE).sum()))
        return {"lang_pred": predicted, "score": scores}

    keep = df.columns if keep is None else keep
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    return arrow_rows(df.select(*dict.fromkeys([*keep, text])), compute, "lang_pred string, score double", keep)
