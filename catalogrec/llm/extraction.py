"""Main text of web pages by two-pass block rules.

The markup is cut into blocks, the runs of text between block-level tags. The first pass classifies
each block by stop-word density, length and link density: good, bad, or short or middling ones that
are left open. The second pass lets open blocks inherit the label of the nearest decided neighbours
before and after. Blocks inside elements that never hold the article (navigation, headers, footers,
forms, reader comments and the like, by element or by class, id or role) are bad from the start, and
decided neighbours are not sought across the border of an article or main element.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, texts

# A block with at most this many characters decides nothing by itself; from LONG on, stop words do.
SHORT = 70
LONG = 200
FEW_STOP_WORDS = 0.20
MANY_STOP_WORDS = 0.32
MOST_LINKS = 0.33

# Frequent words that carry no topic (fixed values; any list can be passed).
STOP_WORDS = {
    "en": "the of and to in a is that it for was on as with be by at this are from or an not but they which you were "
    "his her we have has had he she their there been one all would will more if who when what so out up about into than",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la avec son ou "
    "mais comme on nous vous sa ses aux leur elle été cette ces être fait si tout même entre dont sans",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya o este sí porque "
    "esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante",
}

# Elements of HTML by their role for blocks (fixed values).
_BREAKING = set(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
_NO_TEXT = set("script style noscript template svg math iframe object textarea title canvas".split())
_BOILERPLATE = set("nav header footer aside form menu dialog button select fieldset".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BODY = {"article", "main"}
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|sidebar|side-?bar|"
    r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|comments?|comment-?list|disqus|replies|cookies?|consent|"
    r"gdpr|notice|popup|modal|newsletter|subscribe|signup|login|social|share|sharing|related|recommended|widget|toolbar|"
    r"pagination|pager|copyright|legal|complementary|contentinfo|search|form)(?:$|[\s_-])",
    re.IGNORECASE,
)
# An article is boilerplate only by a name that begins with one of these: comments, advertisements, teasers.
_ITEM = re.compile(
    r"(?:^|\s)(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|comments?|comment-?list|"
    r"disqus|replies|related|recommended|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(" + _ATTRIBUTES + ")>")
# A tag, or else a comment or declaration, which has no name.
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|" + _TAG.pattern, re.DOTALL)
# Elements whose content is not markup: only their own end tag ends them.
_RAW = set("script style textarea title iframe".split())
_SAME = {name: re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in _RAW}
_ENDED = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in _RAW}
# Drawings and formulas may close themselves, and end before these elements unless inside the others.
_FOREIGN = {"svg", "math"}
_BREAKOUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var article aside footer header main nav section".split()
)
_HOLDS_HTML = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
# A slash behind an unquoted value belongs to the value.
_CLOSES_ITSELF = re.compile(r"(?:^|[\s\"'])/\Z|(?:^|\s)[^\s=\"']+/\Z")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
# Chinese, Japanese and Korean characters.
_WIDE = re.compile("[\u2e80-\ud7ff\uf900-\ufaff\U00020000-\U0003ffff]")


def _raw_end(html: str, name: str, at: int, closes_itself: bool, absent: set[str]) -> int | None:
    """Where an element without markup ends, None if its end tag is missing; ``absent`` keeps names without end tags."""
    if closes_itself:
        same = _SAME[name].search(html, at)
        return same.end() if same and same[1] else None
    ended = None if name in absent else _ENDED[name].search(html, at)
    if ended is None:
        absent.add(name)
    return ended and ended.end()


def _hidden_end(html: str, tag: re.Match, outside: Counter, absent: set[str]) -> int:
    """Where an element of ``_NO_TEXT`` ends: at its end tag, or else at the border of the element around it."""
    name, at, itself = tag[2].lower(), tag.end(), bool(_CLOSES_ITSELF.search(tag[3]))
    if name in _FOREIGN and itself:
        return at
    if name in _RAW and (end := _raw_end(html, name, at, itself, absent)) is not None:
        return end
    inside: list[str] = []
    while mark := _MARK.search(html, at):
        at = mark.end()
        if mark[2] is None:
            continue
        inner = mark[2].lower()
        if mark[1]:
            if inner in inside:
                while inside.pop() != inner:
                    pass
            elif inner == name and name not in _RAW:
                return at
            elif outside[inner] > 0:
                return mark.start()
            continue
        if inner == "body" or (name in _FOREIGN and inner in _BREAKOUT and not _HOLDS_HTML.intersection(inside)):
            return mark.start()
        foreign = name in _FOREIGN or inner in _FOREIGN or not _FOREIGN.isdisjoint(inside)
        itself = bool(_CLOSES_ITSELF.search(mark[3]))
        if inner in _VOID or (foreign and itself):
            continue
        if inner in _RAW and not foreign and (end := _raw_end(html, inner, at, itself, absent)) is not None:
            at = end
        else:
            inside.append(inner)
    return len(html)


def _visible(html: str) -> str:
    """The page without comments, declarations and the elements of ``_NO_TEXT``."""
    kept, begin, at = [], 0, 0
    outside: Counter[str] = Counter()
    absent: set[str] = set()
    while mark := _MARK.search(html, at):
        at = mark.end()
        name = mark[2] and mark[2].lower()
        if name is None or (name in _NO_TEXT and not mark[1]):
            kept.append(html[begin : mark.start()])
            begin = at = at if name is None else _hidden_end(html, mark, outside, absent)
        elif not mark[1]:
            outside[name] += name not in _VOID
        elif outside[name]:
            outside[name] -= 1
    return "".join([*kept, html[begin:]])


class _Block:
    __slots__ = ("bad", "chars", "linked", "region", "text")

    def __init__(self, text: str, linked: int, bad: bool, region: int) -> None:
        self.text, self.linked, self.bad, self.region = text, linked, bad, region
        self.chars = len(text)


def _has_name(names: re.Pattern, attributes: str) -> bool:
    return bool(attributes) and any(names.search(a or b or c) for a, b, c in _NAMES.findall(attributes))


def _is_item(attributes: str) -> bool:
    return _has_name(_ITEM, attributes)


def _holders(tags: list[re.Match]) -> set[int]:
    """Places of the tags whose elements hold an article or main element of the page.

    Comments and teasers are no articles of the page, by their name or because an article is around them.
    """
    holders: set[int] = set()
    if not any(tag[2].lower() in _BODY for tag in tags):
        return holders
    open_elements: list[tuple[str, int, bool]] = []
    articles = 0
    for k, tag in enumerate(tags):
        name = tag[2].lower()
        if name not in _BREAKING or name in _VOID:
            continue
        if not tag[1]:
            own = name == "main" or (name == "article" and not _is_item(tag[3]))
            if name == "main" or (own and not articles):
                for _, i, _ in reversed(open_elements):
                    if i in holders:
                        break
                    holders.add(i)
            counts = name == "article"
            articles += counts
            open_elements.append((name, k, counts))
        elif any(name == o for o, _, _ in open_elements):
            while True:
                ended, _, counts = open_elements.pop()
                articles -= counts
                if ended == name:
                    break
    return holders


def blocks(html: str) -> list[_Block]:
    """Text blocks in page order, with the characters inside links and whether boilerplate encloses them."""
    html = _visible(html)
    found: list[_Block] = []
    text: list[str] = []
    linked = 0
    open_elements: list[tuple[str, bool, int]] = []
    in_link = False
    bad = 0
    region = regions = 0

    def close() -> None:
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", unescape("".join(text))).strip()
            if whole:
                found.append(_Block(whole, linked, bad > 0, region))
            text.clear()
        linked = 0

    tags = list(_TAG.finditer(html))
    holders = _holders(tags)
    at = 0
    for k, tag in enumerate(tags):
        if tag.start() > at:
            part = html[at : tag.start()]
            text.append(part)
            if in_link:
                linked += len(part.strip())
        at = tag.end()
        name = tag[2].lower()
        if name == "a":
            in_link = not tag[1]
            continue
        if name not in _BREAKING:
            continue
        close()
        if name in _VOID:
            continue
        if not tag[1]:
            named = name in _BOILERPLATE and not (name == "form" and k in holders)
            if name == "article":
                named = _is_item(tag[3])
            elif not named and k not in holders and name not in ("body", "html", "main"):
                named = _has_name(_NAMED, tag[3])
            if name == "header" and region:  # an article's own header holds its title
                named = False
            open_elements.append((name, named, region))
            bad += named
            if name in _BODY and not bad:
                regions += 1
                region = regions
        elif any(name == o for o, _, _ in open_elements):
            # The end tag also ends what was left open inside it.
            while True:
                ended, named, region = open_elements.pop()
                bad -= named
                if ended == name:
                    break
            in_link = False
    if at < len(html):
        rest = html[at:]
        cut = rest.rfind("<")
        text.append(rest[:cut] if cut >= 0 and re.match(r"</?[a-zA-Z][^>]*\Z", rest[cut:]) else rest)
    close()
    return found


def _links_lead(block: _Block) -> bool:
    return block.linked > MOST_LINKS * block.chars or (block.chars <= SHORT and block.linked > 0)


def _size(text: str) -> int:
    """Characters, those of scripts that write a syllable or word with one of them counted as three."""
    return len(text) + 2 * len(_WIDE.findall(text))


def _first_pass(block: _Block, density: float) -> str:
    if block.bad:
        return "bad"
    if _links_lead(block):
        return "linked" if block.region else "bad"
    if block.chars <= SHORT:
        return "short"
    if density >= MANY_STOP_WORDS:
        return "good" if block.chars > LONG else "near"
    if density >= FEW_STOP_WORDS:
        return "near"
    return "short" if block.region else "bad"


def _by_length(found: list[_Block]) -> list[str]:
    """Labels by length and link density alone; middling blocks in a row count together."""
    labels = []
    for b in found:
        size = 0 if b.bad or _links_lead(b) else _size(b.text)
        labels.append("good" if size > LONG else "near" if size > SHORT else "short" if size else _first_pass(b, 0.0))
    run: list[int] = []
    for i in range(len(found) + 1):
        if i < len(found) and labels[i] in ("near", "short", "good") and (not run or found[i].region == found[run[-1]].region):
            run.append(i)
            continue
        near = [k for k in run if labels[k] == "near"]
        if sum(_size(found[k].text) for k in near) > LONG:
            for k in near:
                labels[k] = "good"
        run = [i] if i < len(found) and labels[i] in ("near", "short", "good") else []
    return labels


def _first_labels(found: list[_Block], stop: frozenset[str]) -> list[str]:
    """Labels by stop words, or by length where the page holds hardly any known ones."""
    words = [[] if b.bad or _links_lead(b) or _size(b.text) <= SHORT else _WORD.findall(b.text.lower()) for b in found]
    known = [sum(w in stop for w in ws) for ws in words]
    labels = [_first_pass(b, k / len(ws) if ws else 0.0) for b, k, ws in zip(found, known, words, strict=True)]
    share = sum(known) / max(1, sum(map(len, words)))
    if share < FEW_STOP_WORDS / 2 or (share < MANY_STOP_WORDS and "good" not in labels):
        return _by_length(found)
    return labels


def main_text(html: str, stop: frozenset[str]) -> str:
    """Good blocks joined by line feeds."""
    found = blocks(html)
    # Where the page marks its article, nothing outside it belongs to it.
    if any(b.region for b in found):
        for b in found:
            b.bad = b.bad or not b.region
    labels = _first_labels(found, stop)
    decided = [label if label in ("good", "bad") else None for label in labels]
    before, after = _sides(found, decided)
    for i, b in enumerate(found):
        label = labels[i]
        if label in ("near", "short"):
            # Outside an article the edge of the page counts as a bad neighbour of a short first or
            # last block (footers, bylines).
            edge = label == "short" and not b.region
            sides = {"bad" if edge and i == 0 else before[i], "bad" if edge and i == len(found) - 1 else after[i]}
            if "good" in sides:
                # Middling text goes with a good neighbour, short text with two unless it stands in the article.
                label = "good" if label == "near" or b.region or "bad" not in sides else "bad"
            elif sides == {None}:
                label = "good" if b.region or label == "near" else "bad"
            else:
                label = "good" if b.region else "bad"
            decided[i] = label
    # Links in the article go with the text before or behind them.
    before, after = _sides(found, decided)
    return "\n".join(
        b.text
        for i, b in enumerate(found)
        if decided[i] == "good" or (labels[i] == "linked" and ("good" in (before[i], after[i]) or before[i] is after[i] is None))
    )


def _sides(found: list[_Block], decided: list[str | None]) -> tuple[list[str | None], list[str | None]]:
    """The labels decided nearest before and after each block (or at it), not across the border of an article."""
    before, after = [None] * len(found), [None] * len(found)
    for out, places in ((before, range(len(found))), (after, range(len(found) - 1, -1, -1))):
        last, region = None, None
        for i in places:
            if found[i].region != region:
                last, region = None, found[i].region
            if decided[i]:
                last = decided[i]
            out[i] = last
    return before, after


def extract_main_text(
    df: DataFrame, html: str = "html", keep: list[str] | None = None, stop_words: dict[str, str] | None = None
) -> DataFrame:
    """Add ``text`` and ``n_chars`` (its code points) to every row; ``keep`` names the columns passed on.

    Null or empty markup, and pages without a good block, give the empty text. Character references
    are decoded, white space inside a block is one space, blocks are joined by one line feed; nothing
    else is dropped or capped. Rows stay where they are; repeated rows and other columns (but for an
    earlier ``text`` or ``n_chars``, which are replaced) need no rule.
    """
    stop = frozenset(w for words in (stop_words or STOP_WORDS).values() for w in words.split())

    def compute(batch: pa.RecordBatch) -> dict:
        found = [main_text(h, stop) for h in texts(batch.column(html))]
        return {"text": found, "n_chars": [len(t) for t in found]}

    keep = [c for c in (df.columns if keep is None else keep) if c not in ("text", "n_chars")]
    return arrow_rows(df.select(*dict.fromkeys([*keep, html])), compute, "text string, n_chars long", keep)
