"""Scalar text rules as Column expressions (no Python on executors)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unicode whitespace plus the four separators U+001C..U+001F.
_WS = r"[\s\x{1c}-\x{1f}]"
WHITESPACE_RUN = f"(?U){_WS}+"
_LEADING_WHITESPACE = rf"(?U)\A{_WS}+"
_OUTER_WHITESPACE = rf"{_LEADING_WHITESPACE}|{_WS}+\z"

# Ordinary text: printable ASCII without "&", tab, line feed and the Latin-1 letters. It needs no
# repair and its whitespace is plain. Listed one by one, the class is a single table lookup per
# character, several times faster than ranges or Unicode classes.
_ORDINARY = [0x09, 0x0A, *(c for c in range(0x20, 0x7F) if c != 0x26), *range(0xC0, 0x100)]
_UNUSUAL = "[^" + "".join(f"\\x{c:02x}" for c in _ORDINARY) + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` knows spaces only)."""
    return F.regexp_replace(_col(c), _OUTER_WHITESPACE, "")


def _none_of(allowed) -> str:
    """A class of all characters but some of Latin-1, as one table lookup per character (see ``_ORDINARY``)."""
    return "[^" + "".join(f"\\x{c:02x}" for c in allowed) + "]"


_BEYOND_LATIN = _none_of(range(0x100))
# What may be whitespace other than space, tab and line feed: the odd kinds of Latin-1 and all beyond it.
_MAYBE_ODD_SPACE = _none_of(c for c in range(0x100) if c not in {0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0})


def squeeze(c: Column | str) -> Column:
    """Strip and turn every whitespace run into one space.

    Text whose whitespace is plain takes a way without a replacement per space.
    """

    def squeezed(t: Column) -> Column:
        odd = F.trim(F.regexp_replace(t, WHITESPACE_RUN, " "))
        return F.when(t.rlike(_MAYBE_ODD_SPACE), odd).otherwise(_squeeze_ordinary(t))

    return _let(_col(c), squeezed)


def _is_ordinary(c: Column) -> Column:
    return ~c.rlike(_UNUSUAL)


def _squeeze_ordinary(c: Column) -> Column:
    """``squeeze`` of ordinary text without a regular expression unless spaces repeat."""
    spaced = F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    repeated = lambda t: F.contains(t, F.lit("  "))
    return F.trim(_let(spaced, lambda t: F.when(repeated(t), F.regexp_replace(t, " {2,}", " ")).otherwise(t)))


def is_blank(c: Column | str) -> Column:
    """True for null and for text made of whitespace only."""
    return F.coalesce(~_col(c).rlike(r"(?U)[^\s\x{1c}-\x{1f}]"), F.lit(True))


def words(c: Column | str) -> Column:
    """Whitespace-separated words; an empty array for blank or null text."""
    parts = F.split(squeeze(F.coalesce(_col(c), F.lit(""))), " ")
    return F.filter(parts, lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """Number of words: the spaces of the squeezed text plus one."""
    text = F.coalesce(_col(c), F.lit(""))
    line = F.when(_is_ordinary(text), _squeeze_ordinary(text)).otherwise(squeeze(text))

    def count(t: Column) -> Column:
        spaces = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit("")))
        return F.when(t == "", F.lit(0)).otherwise(spaces + 1)

    return _let(line, count)


# --- encoding repair -------------------------------------------------------------------------

# The HTML entities undone in text that holds no tag.
HTML_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}

# Typographic quotes and Latin ligatures with their plain forms.
CURLY_QUOTES = {
    "‘": "'",
    "’": "'",
    "‚": "'",
    "‛": "'",
    "“": '"',
    "”": '"',
    "„": '"',
    "‟": '"',
}
LIGATURES = {
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "ſt",
    "ﬆ": "st",
}

_CONTROL_CHARS = r"[\x{00}-\x{08}\x{0b}\x{0e}-\x{1f}\x{7f}\x{feff}\x{fff9}-\x{fffb}]"
# What may be a control character or a line end other than the line feed: those of Latin-1 and all beyond it.
_MAYBE_CONTROL = _none_of(c for c in range(0x100) if c in (0x09, 0x0A, 0x0C) or 0x20 <= c != 0x7F and c != 0x85)


def _cp1252_tables() -> tuple[str, str]:
    """Characters windows-1252 puts on bytes 0x80-0x9F, and the C1 characters of those bytes."""
    visible, raw = [], []
    for byte in range(0x80, 0xA0):
        try:
            visible.append(bytes([byte]).decode("cp1252"))
            raw.append(chr(byte))
        except UnicodeDecodeError:
            continue
    return "".join(visible), "".join(raw)


# Text damaged more than once (UTF-8 read as Latin-1, written, read so again) is decoded again
# while a round lowers the count of damage signs, for at most this many rounds.
MOJIBAKE_ROUNDS = 3
# Terminal control sequences: CSI (colours, cursor), OSC (titles, links) and two-sign escapes.
_TERMINAL_CODES = r"\x{1b}(\[[0-?]*[ -/]*[@-~]|\][^\x{07}\x{1b}]*(\x{07}|\x{1b}\\)?|[@-Z\\-_])"
# A character reference: named, decimal or hexadecimal, ended by a semicolon.
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_COMBINING = r"\p{M}"


def _listed(first: int, last: int) -> str:
    """The characters of a range one by one, for a regular expression's class (see ``_ORDINARY``)."""
    return "".join(f"\\x{c:02x}" for c in range(first, last + 1))


_LEAD, _TRAIL = f"[{_listed(0xC2, 0xF4)}]", _listed(0x80, 0xBF)


def _damage_sign() -> str:
    """A lead byte's letter before a trail byte's: UTF-8 read as Latin-1 or windows-1252."""
    visible, _ = _cp1252_tables()
    return f"{_LEAD}[{_TRAIL}{visible}]"


def _damage(t: Column) -> Column:
    """Number of damage signs."""
    return F.regexp_count(t, F.lit(_damage_sign()))


def repair_mojibake_rounds(c: Column | str, rounds: int = MOJIBAKE_ROUNDS) -> Column:
    """``repair_mojibake`` again and again while it lowers the damage signs; each round is kept
    only if it does, so sound text and text that only looks damaged stay as they are."""
    def better(b: Column) -> Column:
        return F.when(_damage(b[1]) < _damage(b[0]), b[1]).otherwise(b[0])

    def one_round(t: Column) -> Column:
        # The pair (before, after) in one array: no lambda refers to the variable of another.
        # Text without a sign cannot get fewer; text that a round left alone is left alone again.
        decoded = _let(F.array(t, repair_mojibake(t)), lambda b: F.when(b[0] == b[1], b[0]).otherwise(better(b)))
        return F.when(t.rlike(_damage_sign()), decoded).otherwise(t)

    out = _col(c)
    for _ in range(rounds):
        out = _let(out, lambda t: one_round(t))
    return out


@F.pandas_udf(StringType())
def _unescape_references(s: pd.Series) -> pd.Series:
    """Every character reference of the HTML table (named, decimal, hexadecimal) that ends in ``;``;
    text with markup (``<``) is left alone."""
    import html
    import re

    pattern = re.compile(_REFERENCE)
    return s.map(lambda t: t if t is None or "<" in t else pattern.sub(lambda m: html.unescape(m.group()), t))


def unescape_all_entities(c: Column | str) -> Column:
    """Every character reference of the HTML table, through Python; text with markup (``<``) is left
    alone, as by ``unescape_entities``. Not part of ``repair_text``: Spark evaluates no Python
    function inside the conditional branches that keep ordinary text on the fast path, so this is
    a column of its own, for a select."""
    return _unescape_references(unescape_entities(c))


def compose(c: Column | str) -> Column:
    """Canonical composition (NFC) through Python; a column of its own, like ``unescape_all_entities``."""
    return normalize_nfc(_col(c))


def repair_mojibake(c: Column | str) -> Column:
    """UTF-8 that was read as Latin-1 or windows-1252, decoded again; other text unchanged."""
    visible, raw = _cp1252_tables()

    def decode(as_bytes: Column) -> Column:
        damaged = as_bytes.rlike(f"{_LEAD}[{_TRAIL}]") & ~as_bytes.rlike(_BEYOND_LATIN)
        return F.when(damaged, F.try_validate_utf8(F.encode(as_bytes, "ISO-8859-1").cast("string")))

    # Text within Latin-1 is its bytes already, and its damage signs are signs of bytes.
    translated = _let(F.translate(_col(c), visible, raw), decode)
    plain = F.try_validate_utf8(F.encode(_col(c), "ISO-8859-1").cast("string"))
    read = F.when(_col(c).rlike(_BEYOND_LATIN), translated).otherwise(plain)
    decoded = F.when(_col(c).rlike(_damage_sign()), read)
    return F.coalesce(decoded, _col(c))


def unescape_entities(c: Column | str) -> Column:
    out = _col(c)
    for entity, plain in HTML_ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(plain))
    touched = _col(c).contains("&") & ~_col(c).contains("<")
    return F.when(touched, out).otherwise(_col(c))


def repair_text(c: Column | str) -> Column:
    """Terminal codes, listed entities, mojibake (also damaged two or three times), ligatures,
    full-width forms, curly quotes, line ends, control chars.

    Ordinary text is recognised by one scan and left as it is.
    """
    return F.when(_is_ordinary(_col(c)), _col(c)).otherwise(_let(_col(c), _repair_unusual))


def _repair_unusual(text: Column) -> Column:
    wide = "".join(chr(p) for p in range(0xFF01, 0xFF5F)) + "\u3000"
    narrow = "".join(chr(p - 0xFEE0) for p in range(0xFF01, 0xFF5F)) + " "

    def plain_forms(t: Column) -> Column:
        for ligature, plain in LIGATURES.items():
            t = F.replace(t, F.lit(ligature), F.lit(plain))
        return F.translate(t, wide + "".join(CURLY_QUOTES), narrow + "".join(CURLY_QUOTES.values()))

    def with_plain_forms(t: Column) -> Column:
        special = t.rlike(r"[\x{2018}-\x{201f}\x{3000}\x{fb00}-\x{fb06}\x{ff01}-\x{ff5e}]")
        return F.when(t.rlike(_BEYOND_LATIN) & special, plain_forms(t)).otherwise(t)

    def without_controls(t: Column) -> Column:
        lines = F.regexp_replace(t, r"\r\n|[\r\x{85}\x{2028}\x{2029}]", "\n")
        return F.when(t.rlike(_MAYBE_CONTROL), F.regexp_replace(lines, _CONTROL_CHARS, "")).otherwise(t)

    out = F.when(F.contains(text, F.lit("\x1b")), F.regexp_replace(text, _TERMINAL_CODES, "")).otherwise(text)
    out = _let(out, unescape_entities)
    out = _let(_let(out, lambda t: repair_mojibake_rounds(t)), with_plain_forms)
    return _let(out, without_controls)


@F.pandas_udf(StringType())
def normalize_nfc(s: pd.Series) -> pd.Series:
    """Optional Unicode composition; there is no built-in SQL function for it."""
    return s.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


# --- cleaning --------------------------------------------------------------------------------


def clean_text(c: Column | str, nfc: bool = False) -> Column:
    """Repair, lower-case and squeeze; null becomes the empty text."""
    text = _col(c)
    if nfc:
        return F.coalesce(squeeze(F.lower(normalize_nfc(repair_text(text)))), F.lit(""))
    quick = F.when(_is_ordinary(text), _squeeze_ordinary(F.lower(text)))
    return F.coalesce(quick.otherwise(squeeze(F.lower(_let(text, _repair_unusual)))), F.lit(""))


def clean_authors(c: Column | str) -> Column:
    """Drop a leading ``By``, bracketed roles and outer commas; case is kept."""
    name = strip(repair_text(c))
    name = F.regexp_replace(name, r"(?i)\Aby ", "")
    name = squeeze(F.regexp_replace(name, r"\([^)]*\)", ""))
    return F.coalesce(strip(F.regexp_replace(name, r"\A,+|,+\z", "")), F.lit(""))


def title_key(c: Column | str) -> Column:
    """Grouping key of a title: squeezed and lower-cased, null as the empty text."""
    return F.coalesce(squeeze(F.lower(_col(c))), F.lit(""))


def lookup_key(c: Column | str) -> Column:
    """Exact-match key of a title: stripped and lower-cased, inner whitespace kept."""
    return F.lower(strip(c))


def first_segment(c: Column | str) -> Column:
    """Text before the first comma."""
    return F.split(_col(c), ",", 2)[0]


def author_key(c: Column | str) -> Column:
    """First comma segment of the stripped, lower-cased author; blank becomes null."""
    return F.nullif(first_segment(F.lower(strip(c))), F.lit(""))


def truncate_words(c: Column | str, max_words: int) -> Column:
    """First ``max_words`` words followed by ``...``; shorter text is returned unchanged."""
    text = F.coalesce(_col(c), F.lit(""))
    parts = F.split(F.regexp_replace(text, _LEADING_WHITESPACE, ""), WHITESPACE_RUN, max_words + 1)

    def shortened(p: Column) -> Column:
        # The last part is the unsplit rest; it is empty when only whitespace follows.
        longer = (F.size(p) > max_words) & (F.get(p, max_words) != "")
        return F.when(longer, F.concat(F.array_join(F.slice(p, 1, max_words), " "), F.lit("...")))

    return F.coalesce(_let(parts, shortened), text)


# --- values out of free text -----------------------------------------------------------------


def extract_year(c: Column | str) -> Column:
    """First four-digit year 1500-2099 anywhere in the text."""
    # Fixed value: the pattern of a year.
    found = F.regexp_extract(_col(c), r"(1[5-9]\d{2}|20\d{2})", 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def extract_number(c: Column | str) -> Column:
    """First run of digits in the text."""
    return F.nullif(F.regexp_extract(_col(c), r"\d+", 0), F.lit("")).try_cast("double")


def to_number(c: Column | str) -> Column:
    """Numeric value, null where the text is not a number; NaN is null too."""
    value = strip(_col(c).cast("string")).try_cast("double")
    return F.when(~F.isnan(value), value)


def list_items(c: Column | str) -> Column:
    """Items of a list written as text (``['a', "b", None]``); null when empty or malformed.

    Items are quoted texts with backslash escapes, or bare words and numbers, which stand for
    themselves. The whole text must be one list: anything before or behind it makes it malformed.
    """
    return _let(strip(c), _parsed_list)


# A quoted text in either kind of quotes, or a bare word.
_LIST_ITEM = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^\s,'"\[\]{}()]+"""


def _parsed_list(text: Column) -> Column:
    well_formed = text.rlike(rf"(?s)\A\[\s*(?:{_LIST_ITEM})(?:\s*,\s*(?:{_LIST_ITEM}))*\s*,?\s*\]\z")
    items = F.regexp_extract_all(text, F.lit(f"(?s){_LIST_ITEM}"), F.lit(0))

    def as_json(item: Column) -> Column:
        quoted = item.rlike(r"\A['\"]")
        inner = F.when(quoted, F.substring(item, F.lit(2), F.length(item) - 2)).otherwise(item)
        inner = F.regexp_replace(inner, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
        inner = F.regexp_replace(inner, r"(?<!\\)((?:\\\\)*)\\'", "$1'")
        inner = F.regexp_replace(inner, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')
        inner = F.regexp_replace(inner, r"\n", r"\\n")
        return F.concat(F.lit('"'), F.regexp_replace(inner, r"\t", r"\\t"), F.lit('"'))

    joined = F.concat(F.lit("["), F.array_join(F.transform(items, as_json), ","), F.lit("]"))
    parsed = F.from_json(joined, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    return F.when(well_formed & (F.size(parsed) > 0), parsed)


def list_text(c: Column | str) -> Column:
    """Comma list of a list written as text; any other text is passed through stripped."""
    text = strip(c)
    return F.when(text.startswith("["), F.array_join(list_items(c), ", ")).otherwise(text)


def first_list_item(c: Column | str) -> Column:
    return F.get(list_items(c), 0)


def contains_ci(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test, false for null."""
    return F.coalesce(F.contains(F.lower(_col(c)), F.lit(needle.lower())), F.lit(False))


def text_prefix(c: Column | str, n_chars: int) -> Column:
    return F.substring(_col(c), 1, n_chars)
