"""Pieces of the comparison SQL that several queries share."""

from __future__ import annotations

from ..functions.labels import CATEGORY_GENRES
from ..functions.text import HTML_ENTITIES

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def repaired(x: str) -> str:
    out = x
    for entity, plain in HTML_ENTITIES.items():
        out = f"replace({out}, {quoted(entity)}, {quoted(plain)})"
    return f"(CASE WHEN contains({x}, '&') AND NOT contains({x}, '<') THEN {out} ELSE {x} END)"


def clean(x: str) -> str:
    return f"coalesce({squeeze(f'lower({repaired(x)})')}, '')"


def split_words(x: str) -> str:
    return f"string_split_regex({strip(x)}, '{WS}')"


def truncated(x: str, n: int) -> str:
    w = split_words(x)
    return f"(CASE WHEN len({w}) > {n} THEN array_to_string(list_slice({w}, 1, {n}), ' ') || '...' ELSE coalesce({x}, '') END)"


def word_count(x: str) -> str:
    return f"len([w for w in {split_words(x)} if w <> ''])"


def title_key(x: str) -> str:
    return f"coalesce({squeeze(f'lower({x})')}, '')"


def author_key(x: str) -> str:
    return f"nullif(split_part(lower({strip(x)}), ',', 1), '')"


def clean_authors(x: str) -> str:
    name = f"regexp_replace({strip(repaired(x))}, '^by ', '', 'i')"
    name = squeeze(f"regexp_replace({name}, '\\([^)]*\\)', '', 'g')")
    return f"coalesce({strip(f'''regexp_replace({name}, '^,+|,+$', '', 'g')''')}, '')"


def genre(x: str) -> str:
    """Macro genre by a lookup in the literal category list."""
    key = f"lower({strip(f'split_part({x}, {quoted(chr(44))}, 1)')})"
    pairs = ", ".join(f"{quoted(c)}: {quoted(g)}" for c, g in CATEGORY_GENRES.items())
    return (
        f"(CASE WHEN {x} IS NULL OR {strip(x)} = '' THEN 'unknown' "
        f"ELSE coalesce(element_at(MAP {{{pairs}}}, {key})[1], 'other') END)"
    )


def period(year: str) -> str:
    y = f"CAST(trunc({year}) AS BIGINT)"
    return (
        f"(CASE WHEN {year} IS NULL THEN 'Inconnue' WHEN {y} < 1900 THEN 'Avant 1900' "
        f"ELSE CAST(({y} // 10) * 10 AS VARCHAR) || 's' END)"
    )


def format_number(x: str) -> str:
    return (
        f"(CASE WHEN {x} IS NULL THEN 'N/A' WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
        f"ELSE CAST(CAST({x} AS DOUBLE) AS VARCHAR) END)"
    )


def format_text(x: str) -> str:
    t = strip(x)
    return f"(CASE WHEN {t} IS NULL OR {t} = '' OR lower({t}) = 'nan' THEN 'N/A' ELSE {t} END)"


def format_genre(x: str) -> str:
    word = "upper(substr(w, 1, 1)) || lower(substr(w, 2))"
    title = f"array_to_string([{word} for w in string_split({x}, '_')], ' ')"
    return f"(CASE WHEN {x} IS NULL OR {x} IN ('', 'unknown', 'other') THEN 'Genre non classé' ELSE {title} END)"


def cosine(a: str, b: str) -> str:
    norms = f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
    return f"(CASE WHEN {norms} = 0 THEN 0.0 ELSE list_dot_product({a}, {b}) / {norms} END)"


def keywords(source: str, id_col: str, text: str, stop: list[str], top_n: int = 5, max_terms: int = 5000) -> str:
    """CTEs ``terms, vocab, weights``: the top terms of each row of ``source``."""
    return f"""
    tokens AS (
      SELECT {id_col}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term
      FROM {source} WHERE {strip(text)} <> ''),
    tf AS (
      SELECT {id_col}, term, count(*) AS tf FROM tokens
      WHERE NOT list_contains({listed(stop)}, term) GROUP BY ALL),
    vocab AS (
      SELECT term, sum(tf) AS cf, count(*) AS df FROM tf GROUP BY term ORDER BY cf DESC, term LIMIT {max_terms}),
    total AS (SELECT count(*) AS n FROM {source} WHERE {strip(text)} <> ''),
    weights AS (
      SELECT {id_col}, term, round(tf * (ln((1.0 + n) / (1.0 + df)) + 1), 6) AS weight
      FROM tf JOIN vocab USING (term) CROSS JOIN total),
    best AS (
      SELECT *, row_number() OVER (PARTITION BY {id_col} ORDER BY weight DESC, term) AS rank FROM weights
      QUALIFY rank <= {top_n})"""
