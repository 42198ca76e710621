"""Text operators against brute force, the reference libraries and held-out accuracy."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from catalogrec.llm.bpe import bpe_encode
from catalogrec.llm.extraction import STOP_WORDS, extract_main_text, main_text
from catalogrec.llm.common import may_hold, sieve
from catalogrec.llm.jaccard import jaccard_classes
from catalogrec.llm.langid import identify_language, language_profiles
from catalogrec.llm.mixing import mix
from catalogrec.llm.quality import _chain, fit_quality, score_quality
from catalogrec.llm.toxicity import ToxicityModel, fit_toxicity, score_toxicity
from catalogrec.llm.transducer import Transducer, count_tokens

tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n_tokens string"
ODD = ["", None, "   ", "\n\n\t x  ", "a", "a" * 5000, "ab" * 400, "  two  spaces ", "日本語テキスト漢字" * 30, "😀 é́ ½²_'s", "<s> </s> <|endoftext|>", "▁a ▁▁"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 0, "x", "y") for i, t, lang, source in rows], SCHEMA)


def sampled(n=200, seed=1):
    rng = random.Random(seed)
    signs = "ab the inｱ漢🙂é\n zqx'1. "
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 200))) for _ in range(n)]


def test_bpe_equals_the_library_and_round_trips(spark):
    import tiktoken

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    values = sampled()
    table = docs(spark, [(i, v, None, None) for i, v in enumerate(values)])
    got = {r["doc_id"]: r for r in bpe_encode(table, path, tokenizers.PATTERN, ids=True).collect()}
    for i, v in enumerate(values):
        ids = library.encode_ordinary(v or "")
        assert got[i]["token_ids"] == ids and got[i]["n_tokens"] == len(ids), v
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((v or "").encode()).hexdigest()
    assert bpe_encode(table.limit(0), path, tokenizers.PATTERN).count() == 0


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(2)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    values = sampled() + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(400)] + ["word " * 5000]
    table = docs(spark, [(i, v, None, None) for i, v in enumerate(values)])
    for r in count_tokens(table, path).collect():
        text = values[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 4096), text[:80]
    assert count_tokens(table.limit(0), path).count() == 0


def test_bpe_keeps_and_forgets_pieces_across_batches(monkeypatch):
    import tiktoken

    import catalogrec.llm.bpe as module

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(module, "KEPT_CHUNK_BYTES", 300)
    monkeypatch.setattr(module, "KEPT_PIECE_BYTES", 300)
    encoder = module.Encoder(path, tokenizers.PATTERN)
    values = [v or "" for v in sampled(120, seed=7)]
    for start in range(0, len(values), 10):  # several batches: pieces come back, generations turn over
        batch = values[start : start + 10] + values[:5]
        got = encoder.encode(batch)
        assert got == [",".join(map(str, library.encode_ordinary(v))) for v in batch]
    assert encoder.merged_before or encoder.merged_late


def test_bpe_short_pieces_take_the_plain_steps(monkeypatch):
    import tiktoken

    import catalogrec.llm.bpe as module

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(module, "STEP_ROWS", 1)  # eight steps a query: unfinished pieces go on
    encoder = module.Encoder(path, tokenizers.PATTERN)
    asked = []

    class Spy:
        def __init__(self, db):
            self.db = db

        def __getattr__(self, name):
            return (lambda q: asked.append(q) or self.db.sql(q)) if name == "sql" else getattr(self.db, name)

    encoder.db = Spy(encoder.db)
    rng = random.Random(5)
    short = ["".join(rng.choice("aabxé") for _ in range(rng.randint(2, 16))) for _ in range(200)]
    odd = ["a\tb \t", "a\tb  c", "a\n", "\na", "a \n b", "x\u00a0y z", "\x1ca b", " ", "a\n\nb", "q\u2003 r"]
    for batch in (short, odd):
        assert encoder.encode(batch) == [",".join(map(str, library.encode_ordinary(v))) for v in batch]
    assert asked and not any(" over (" in q for q in asked)
    long = ["a" * n for n in (31, 32, 33, 64, 200)] + ["".join(rng.choice("abé") for _ in range(150)) for _ in range(20)]
    assert encoder.encode(long + short) == [",".join(map(str, library.encode_ordinary(v))) for v in long + short]
    assert any(" over (" in q for q in asked)


def test_transducer_forgets_and_goes_on(monkeypatch):
    import catalogrec.llm.transducer as module

    monkeypatch.setattr(module, "KEPT_TRANSITIONS", 50)
    monkeypatch.setattr(module, "KEPT_CHUNKS", 5)
    small = Transducer(tokenizers.path("piece_bpe_32k.model"))
    values = [v or "" for v in sampled(40)]
    monkeypatch.undo()
    assert small.count(values).tolist() == Transducer(tokenizers.path("piece_bpe_32k.model")).count(values).tolist()


def brute_classes(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    for _ in range(len(sets)):
        before = dict(label)
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_copies(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 5, 8, 40, 120]))]
        if rng.random() < 0.5:
            base += passage
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    values = [" ".join(t) for t in texts] + ["", None, "  \t", "one", "ONE", "One two", "one  two", passage_text := " ".join(passage), passage_text.upper()]
    return list(enumerate(values))


@pytest.mark.parametrize("tile", [2048, 6])
def test_jaccard_matches_brute_force(spark, monkeypatch, tile):
    import catalogrec.llm.jaccard as module

    monkeypatch.setattr(module, "TILE_SETS", tile)
    rows = near_copies()
    table = docs(spark, [(i, t, None, None) for i, t in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_classes(table).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("tile", [2048, 6])
def test_jaccard_counts_every_link(spark, monkeypatch, tile):
    import catalogrec.llm.jaccard as module

    monkeypatch.setattr(module, "TILE_SETS", tile)
    monkeypatch.setattr(module, "_GATHERED", 500)
    base = [f"w{i}" for i in range(150)]
    group = [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in range(0, 150, 4)]  # all near each other
    rows = list(enumerate([*(t for _, t in near_copies()), *group, group[0], group[0]]))
    words = {i: (t or "").lower().split() for i, t in rows}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    want = {i: sum(i != j and bool(a and b) and 100 * len(a & b) >= 80 * len(a | b) for j, b in sets.items()) for i, a in sets.items()}
    table = docs(spark, [(i, t, None, None) for i, t in rows])
    got = {r["doc_id"]: r["n_links"] for r in jaccard_classes(table).collect()}
    assert got == want and max(want.values()) >= len(group) + 1


def test_jaccard_looks_for_candidates_in_rounds(spark, monkeypatch):
    """The shingles of a round are a part of all (their shuffle files are released), and no link is lost between rounds."""
    import catalogrec.llm.jaccard as module

    monkeypatch.setattr(module, "ROUND_SHINGLES", 300)
    shared, written = module._shared_tokens, []
    monkeypatch.setattr(module, "_shared_tokens", lambda tokens: written.append((tokens.count(), tokens.select("token").distinct())) or shared(tokens))
    rows = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_classes(docs(spark, [(i, t, None, None) for i, t in rows])).collect()}
    assert got == brute_classes(rows)
    counts = [n for n, _ in written]
    assert len(counts) > 2 and max(counts) < sum(counts) / 2


def test_sieve_never_loses_a_key(spark):
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id) AS doc_id", "xxhash64(id) AS text_hash")
    keys = rows.where("text_hash % 50 = 0 OR doc_id IS NULL")
    words = sieve(keys, "doc_id", "text_hash")
    told = may_hold(rows, words, "doc_id", "text_hash")
    assert told.columns == ["doc_id", "text_hash", "may_hold"] and told.count() == 20_000
    assert told.where("(text_hash % 50 = 0 OR doc_id IS NULL) AND NOT may_hold").count() == 0
    assert told.where("may_hold").count() <= keys.count() + 20
    assert may_hold(rows, sieve(keys.limit(0), "doc_id", "text_hash"), "doc_id", "text_hash").where("may_hold").count() == 0


def test_jaccard_null_and_repeated_ids(spark):
    table = docs(spark, [(None, "a b c d e f", None, None), (4, "a b c d e f", None, None), (4, "x y z", None, None), (4, "x y z", None, None), (None, "q", None, None)])
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_classes(table).collect())
    assert got == Counter({(None, 2, 4): 1, (4, 2, 4): 1, (4, 1, 4): 2, (None, 1, None): 1})
    assert jaccard_classes(table.limit(0)).count() == 0


def test_mix_reaches_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 900)), None, rng.choice(["b", "b", "b", "a", "c", None])) for i in range(400)]
    rows += [(None, "three words here", None, "b"), (7, "again a row of seven", None, "b"), (8, None, None, "empty"), (9, "", None, "empty")]
    got = mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by_source = defaultdict(list)
    for r in got:
        by_source[r["source"]].append(r)
    for r in by_source.values():
        assert abs(sum(x["taken"] for x in r) - r[0]["target"]) <= 1
        assert r[0]["source_size"] == sum(x["size"] for x in r)
    total = sum(r["size"] for r in got)
    assert abs(sum(r[0]["target"] for r in by_source.values()) - 1.5 * total) < 1e-6 * total
    again = mix(docs(spark, rows[::-1])).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert mix(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mix(docs(spark, [(1, "", None, "a"), (2, None, None, None)])).collect()] == [0, 0]


def test_languages(spark):
    words = {"en": "the of and with house water tree", "de": "der und nicht größe schön wasser haus", "fr": "le été où garçon leçon être eau"}
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(words[lang].split()) for _ in range(30)), lang, None) for i in range(60) for lang in [sorted(words)[i % 3]]]
    table = docs(spark, rows)
    profiles = language_profiles(table.where("doc_id < 30"))
    assert sorted(profiles) == ["de", "en", "fr"]
    odd = docs(spark, [(100, None, "en", None), (101, "", None, None), (102, "12 34 !?", "de", None), (103, "Wasser", None, None)])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_language(table.union(odd), profiles).collect()}
    assert all(got[i][0] == lang for i, _, lang, _ in rows)
    assert all(got[i] == ("und", 0.0) for i in (100, 101, 102)) and got[103][0] == "de"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language_profiles(table.limit(0)) == {}
    assert {r["lang_pred"] for r in identify_language(table, {}).collect()} == {"und"}


def labelled(spark, seed=6):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, toxic = [], []
    for i in range(300):
        words = [word() for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(5):
                words[rng.randrange(60)] = rng.choice(["vileone", "vilest", "nasty"])
        rows.append((i, " ".join(words), None, None))
        toxic.append((i, int(bad), int(not bad)))
    return docs(spark, rows), spark.createDataFrame([*toxic, (3, None, None), (None, 1, 0), (5, 0, 1)], "doc_id long, toxic int, quality int")


def test_toxicity_on_held_out_texts(spark):
    table, labels = labelled(spark)
    model = fit_toxicity(table, labels.where("doc_id is null or doc_id % 3 <> 0"))
    assert {"vileo*", "nasty"} <= set(model.scores)
    odd = docs(spark, [(900, None, None, None), (901, "", None, None), (902, "vilely " * 4000, None, None)])
    got = {r["doc_id"]: r for r in score_toxicity(table.union(odd), model, passages=True).collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(0, 300, 3))
    assert got[900]["score"] == got[901]["score"] < 0.3 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(p["expected"] < 0.05 for r in got.values() for p in r["passages"])
    empty = fit_toxicity(table.limit(0), labels.limit(0))
    assert score_toxicity(table, empty).where("predicted = 1").count() == 0


def test_segments_match_brute_force():
    """Maximal scoring segments by the recursive definition: the best segment, then left and right of it."""

    def recursive(values, begin, end):
        best, at = 0.0, None
        for i in range(begin, end):
            total = 0.0
            for j in range(i, end):
                total += values[j]
                if total > best + 1e-12:
                    best, at = total, (i, j)
        if at is None:
            return []
        return recursive(values, begin, at[0]) + [at] + recursive(values, at[1] + 1, end)

    rng = random.Random(7)
    for _ in range(200):
        scores = [rng.choice([0, 0, 0, rng.uniform(0.5, 2.5)]) for _ in range(25)]
        model = ToxicityModel({}, 0.45)
        places = [i for i, s in enumerate(scores) if s]
        found = model.segments(places, [scores[i] for i in places])
        values = [s if s else -0.45 for s in scores]
        assert [(a, b) for a, b, _ in found] == recursive(values, 0, 25)


def test_chain_sums_match_enumeration():
    import itertools

    rng = np.random.default_rng(8)
    sizes, scores, link = np.array([4, 2, 1]), rng.normal(size=7), rng.normal(size=(2, 2))
    marginal, pairs, total = _chain(scores, link, sizes)
    want, want_pairs, want_total, at = np.zeros(7), np.zeros((2, 2)), 0.0, 0
    for n in sizes:
        mass, good, linked = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(scores[at + i] * y for i, y in enumerate(labels)) + sum(link[a, b] for a, b in itertools.pairwise(labels)))
            mass += w
            good += w * np.array(labels)
            for a, b in itertools.pairwise(labels):
                linked[a, b] += w
        want[at : at + n], at = good / mass, at + n
        want_pairs += linked / mass
        want_total += np.log(mass)
    assert np.allclose(marginal, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_quality_on_held_out_texts(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(200):
        bad = i % 3 == 0
        line = lambda: " ".join("".join(rng.choice("abcde") for _ in range(4)) + ("### " if bad else "") for _ in range(12)) + "."
        rows.append((i, "\n".join(line() for _ in range(rng.randint(1, 5))), None, None))
        labels.append((i, int(not bad)))
    table = docs(spark, rows)
    model = fit_quality(table, spark.createDataFrame(labels, "doc_id long, quality int").where("doc_id % 5 <> 0"))
    odd = docs(spark, [(900, None, None, None), (901, "", None, None), (902, "good words here.\n" * 3000, None, None)])
    got = {r["doc_id"]: r for r in score_quality(table.union(odd), model).collect()}
    assert all(got[i]["predicted"] == int(i % 3 != 0) for i in range(0, 200, 5))
    assert got[900]["score"] == got[901]["score"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert score_quality(table.limit(0), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<div id="cookie-notice">We use cookies on this site and you agree to that by using it.</div>
<header><h2>The Site</h2></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">All of the news</a></li></ul></nav>
<article><h1>The  title &amp;
more</h1><p>It was <b>the</b> first of many days &lt;here&gt; and all of them were good for us,
as they had been for the others who came before us to this place with what they had.<br>Short.</p>
<div class="ad">Buy the best of it now and for all time with us at the shop of the year.</div>
<p>1 &lt; 2&nbsp;&eacute;</p><section class="comments"><p>I think that this is the best of all that I have read on it.</p></section></article>
<aside><p>What others have read about it and what they had to say of the matter.</p></aside>
<form><p>Sign up for the news that we have for you and all of your friends.</p></form><footer>&copy; all of us</footer>"""
PLAIN = """<body><div><a href="x">One</a> <a href="y">Two</a> <a href="z">Three</a></div>
<div><p>This is the text of a page that has no article and that is as long as it has to be for the rules to see
that it is text and not a list of links, which is what they look for in all that they are given to read.</p>
<p>And so on.</p><p>It is the same for this one, which is the second of the two that are on this page and which has
to be long enough as well, or else it would not be seen as the text that it is by those who look at it.</p></div>
<div>Copyright 2020</div></body>"""


def test_extraction(spark):
    rows = [(1, "u", PAGE), (2, "u", PLAIN), (3, None, None), (4, "u", ""), (5, "u", "<p>unclosed <b>tag <a href='q"), (5, "u", "no tags")]
    table = spark.createDataFrame([(*r, "old", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in extract_main_text(table).orderBy("page_id").collect()]
    article = got[0][1].split("\n")
    assert article == [
        "The title & more",
        "It was the first of many days <here> and all of them were good for us, as they had been for the others who came "
        "before us to this place with what they had.",
        "Short.",
        "1 < 2 é",
    ]
    assert len(got[1][1].split("\n")) == 3 and "And so on." in got[1][1] and "One" not in got[1][1] and "Copyright" not in got[1][1]
    assert [g[1] for g in got[2:4]] == ["", ""] and all(n == len(t) for _, t, n in got)
    assert extract_main_text(table.limit(0)).count() == 0


def text_of(html):
    return main_text(html, frozenset(w for words in STOP_WORDS.values() for w in words.split()))


@pytest.mark.parametrize("name", ["svg", "math"])
def test_extraction_goes_on_behind_an_icon(name):
    for tag in (f'<{name} class="i"/>', f"<{name}/>", f"<{name} hidden/>", f"<{name} class=i />", f"<{name}><g/><g>x</{name}>", f"<{name}>"):
        assert text_of(f"<article><p>a</p>{tag}<p>rest</p></article>") == "a\nrest"
    assert text_of(f"<article><p>a<{name}><{name}>x</{name}>y</{name}>b</p></article>") == "ab"


@pytest.mark.parametrize("name", ["script", "style", "noscript", "template", "iframe", "object", "textarea", "title", "canvas"])
def test_extraction_ends_open_elements_at_the_border_around_them(name):
    for tag in (f"<{name}>", f"<{name}/>", f'<{name} src="x"/>'):
        assert text_of(f"<article><div><p>a</p>{tag}<b>x</b> y</div><p>rest</p></article>") == "a\nrest"
        assert text_of(f"<article><p>a</p>{tag}x</{name}><p>rest</p></article>") == "a\nrest"
    assert text_of(f"<article><div>a<{name}/></div><p>rest</p><{name}>x</{name}></article>") == "a\nrest"


@pytest.mark.parametrize("body", ["article", "main"])
def test_extraction_finds_articles_inside_named_wrappers(body):
    inner = f'<{body}><p>text</p><div class="ad">buy</div><section class="comments"><article>said</article></section></{body}>'
    if body == "main":
        inner = "<main><p>text</p><form>search</form></main>"
    for wrapper in ("form", 'div class="layout with-sidebar"', 'div id="no-sidebar"', 'section class="has-related"', 'div role="search"'):
        page = f'<body><{wrapper}><div class="sidebar">aside</div>{inner}</{wrapper.split()[0]}></body>'
        assert text_of(page) == "text"
    assert text_of(f'<form class="notice"><div class="header-top"><{body} class="with-sidebar">text</{body}></div></form>') == "text"
    assert text_of(f'<{body}>text</{body}><div class="comments"><article class="comment">said</article></div>') == "text"


ITALIAN = (
    "Il treno partì dalla stazione poco prima dell'alba e attraversò campagne ancora coperte di nebbia, mentre i viaggiatori dormivano "
    "appoggiati ai finestrini freddi. Nessuno parlava, e soltanto ogni tanto si sentiva passare il controllore nel corridoio.",
    "Quando arrivarono al mare era già mattina piena, e tutti scesero insieme verso le spiagge portando ceste, ombrelli e bambini.",
)
FINNISH = ("Juna lähti asemalta juuri ennen aamunkoittoa ja kulki sumuisten peltojen halki, kun matkustajat vielä nukkuivat. " * 3).strip()
CHINESE = "火车在黎明前离开车站,穿过仍被雾气笼罩的田野,旅客们靠着冰冷的车窗睡着了。没有人说话,只有列车员偶尔从走廊经过。早晨他们终于到了海边,大家提着篮子走向沙滩。"


def test_extraction_of_languages_without_known_stop_words():
    menu = '<ul><li><a href="/">Uno</a></li><li><a href="/b">Due</a></li></ul>'
    for paragraphs in (ITALIAN, (FINNISH,), (CHINESE,), ITALIAN[1:] * 3):
        page = f"<body>{menu}<div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"</div>{menu}</body>"
        assert text_of(page) == "\n".join(paragraphs)


def test_extraction_keeps_linked_text_of_an_article():
    page = '<article><h1><a href="/">Title</a></h1><p>Text here.</p><p>See <a href="/r">the report</a>.</p><p><a href="/q">A long link that fills the block from its beginning to its end, and more of it.</a></p><p>End.</p></article>'
    assert len(text_of(page).split("\n")) == 5
    assert text_of('<main><div class="ad">buy</div><p><a href="/q">link</a></p><div class="ad">buy</div></main>') == ""
