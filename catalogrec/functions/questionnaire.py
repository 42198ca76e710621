"""Questionnaire rules: query text, Likert checks, profiles, generated-text parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_RUN, _col, is_blank, lookup_key, strip, word_count

# Descriptor of each Likert score 1..5.
LIKERT_DESCRIPTORS = {
    "intensity_action": ["calme", "paisible", "modéré", "intense", "très intense"],
    "intensity_romance": [
        "sans romance",
        "romance légère",
        "romance présente",
        "romance importante",
        "histoire d'amour centrale",
    ],
    "intensity_learning": [
        "divertissement pur",
        "un peu éducatif",
        "instructif",
        "très éducatif",
        "essai pédagogique",
    ],
    "complexity": ["très simple", "accessible", "standard", "complexe", "très complexe"],
}
# Profile axis -> questionnaire column, and axis -> anchor sentence.
AXIS_LIKERT = {
    "action": "intensity_action",
    "romance": "intensity_romance",
    "learning": "intensity_learning",
    "complexity": "complexity",
}
AXIS_SENTENCES = {
    "action": "intensité d'action et de suspense très intense",
    "romance": "histoire d'amour centrale et romance passionnée",
    "learning": "essai pédagogique très éducatif et instructif",
    "complexity": "récit littéraire très complexe et sophistiqué",
}
# Texts that must match word for word.
FAVOURITES_INTRO = "Livres similaires à : "
SHORT_TEXT_SUFFIX = ". Recherche de livre avec ambiance immersive et intrigue captivante."
SHORT_TEXT_WORDS = 5
DEFAULT_LIKERT = 3
SUGGESTION_MARKER = r"(?idU)LIVRES_SIMILAIRES\s*:\s*(.+)"

LIKERT_COLUMNS = list(LIKERT_DESCRIPTORS)


def query_text(description: Column | str, favourites: Column | str, likert: dict[str, Column] | None = None) -> Column:
    """Description, favourites sentence and the four descriptors, joined by ``". "``."""
    likert = likert or {name: F.col(name) for name in LIKERT_COLUMNS}
    descriptors = [
        F.get(
            F.array(*[F.lit(d) for d in words]),
            F.coalesce(likert[name].cast("int"), F.lit(DEFAULT_LIKERT)) - 1,
        )
        for name, words in LIKERT_DESCRIPTORS.items()
    ]
    described = F.nullif(_col(description), F.lit(""))
    liked = F.concat(F.lit(FAVOURITES_INTRO), F.nullif(_col(favourites), F.lit("")))
    return F.concat_ws(". ", described, liked, *descriptors)


def enrich_short(text: Column | str) -> Column:
    """Append the fixed sentence to text of fewer than five words."""
    short = word_count(text) < SHORT_TEXT_WORDS
    return F.when(short, F.concat(_col(text), F.lit(SHORT_TEXT_SUFFIX))).otherwise(_col(text))


def likert_value(c: Column | str) -> Column:
    """The score as INT when it is a whole number 1..5, else null."""
    value = strip(_col(c).cast("string")).try_cast("int")
    return F.when(value.between(1, 5), value)


def likert_mean(columns: list[str] | None = None) -> Column:
    """Mean of the four scores divided by 5; a missing score counts as 3."""
    names = columns or LIKERT_COLUMNS
    total = sum(
        (F.coalesce(F.col(n).cast("double"), F.lit(float(DEFAULT_LIKERT))) for n in names),
        F.lit(0.0),
    )
    return total / len(names) / 5.0


def user_profile() -> Column:
    """Wanted level of each axis on a 0-100 scale."""
    return F.struct(
        *[(F.col(c) / F.lit(5.0) * 100).alias(axis) for axis, c in AXIS_LIKERT.items()]
    )


def favourite_keys(c: Column | str) -> Column:
    """Distinct lookup keys of a comma-separated list of titles."""
    keys = F.transform(F.split(F.coalesce(_col(c), F.lit("")), ","), lambda t: lookup_key(t))
    return F.array_distinct(F.filter(keys, lambda t: t != ""))


def read_keys(title: Column | str) -> Column:
    """Every favourite that would mark this title as already read.

    A favourite matches when it is the whole title, or the part before optional whitespace and
    one of ``( : , -`` with no line break after it. Listing those prefixes turns the
    "starts with" test into an equality test on keys.
    """
    key = F.coalesce(lookup_key(title), F.lit("nan"))
    cuts = F.filter(
        F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1))),
        lambda p: F.substring(key, p, F.lit(1)).isin("(", ":", ",", "-")
        & ~F.contains(F.substring(key, p, F.length(key)), F.lit("\n")),
    )
    prefixes = F.transform(
        cuts, lambda p: F.regexp_replace(F.substring(key, F.lit(1), p - 1), f"{WHITESPACE_RUN}\\z", "")
    )
    return F.filter(F.array_distinct(F.concat(F.array(key), prefixes)), lambda t: t != "")


def is_usable_summary(c: Column | str) -> Column:
    """False for missing, empty or error texts (those start with ``[``)."""
    return F.coalesce((_col(c) != "") & ~_col(c).startswith("["), F.lit(False))


def suggestion_text(c: Column | str) -> Column:
    """Generated text before the suggestion line, stripped."""
    start = F.regexp_instr(_col(c), F.lit(SUGGESTION_MARKER))
    before = F.when(start > 0, F.substring(_col(c), F.lit(1), start - 1)).otherwise(_col(c))
    return strip(before)


def suggested_titles(c: Column | str) -> Column:
    """Titles of the suggestion line, stripped, empty ones dropped."""
    line = F.regexp_extract(_col(c), SUGGESTION_MARKER, 1)
    titles = F.transform(F.split(line, r"\|"), lambda t: strip(t))
    return F.filter(titles, lambda t: ~is_blank(t))
