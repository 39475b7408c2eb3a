"""Personal data, page texts, benchmark passages, toxicity."""

import random
import re

import numpy as np
import pytest

from evlake.llm import decontaminate, toxicity
from evlake.llm.decontaminate import align, leaks, without_leaks
from evlake.llm.html_text import extracted, main_text
from evlake.llm.pii import luhn, masked, mod97, personal_data, spans
from evlake.llm.toxicity import fit, scores, without_toxic
from tests.llm.conftest import AWKWARD

# -- personal data ------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_spans_against_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@+- (0)9%_é") for _ in range(rng.randrange(40)))
        assert [str(s) for s in spans(text) if s.kind != "iban"] == brute_spans(text)
    card = "card 4111 1111 1111 1111, 4111-1111-1111-1112"
    assert [str(s) for s in spans(card)] == brute_spans(card) == ["card:5:24"]


def test_checks_and_context():
    assert luhn("79927398713") and not luhn("79927398710")
    assert mod97("GB82WEST12345698765432") and not mod97("GB83WEST12345698765432")
    text = "iban GB82 WEST 1234 5698 7654 32 and GB83 WEST 1234 5698 7654 32"
    assert [str(s) for s in spans(text) if s.kind == "iban"] == ["iban:5:32"]
    near, far = spans("call +1 (456) 555-2186")[0], spans("x +1 (456) 555-2186")[0]
    assert near.score > far.score
    assert masked("write to a.b@c.de now") == "write to [EMAIL] now"


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82WEST12345698765432"])
@pytest.mark.parametrize("after", ["", " BIC COBADEFF", " BIC COBADEFFXXX", " 2024 x", " on", " Next", ", 12", " 1234567890 1234567890 1234567890"])
@pytest.mark.parametrize("before", ["", "to ", "AB12 "])
def test_what_surrounds_an_iban(before, iban, after):
    found = [(s.start, s.end) for s in spans(before + iban + after) if s.kind == "iban"]
    assert found == [(len(before), len(before + iban))]
    assert not [s for s in spans(f"{iban}X") + spans(f"x{iban}") if s.kind == "iban"]


def test_personal_data_of_awkward_rows(awkward, nothing):
    got = personal_data(awkward).collect()
    assert len(got) == len(AWKWARD) and personal_data(nothing).count() == 0
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert all(r.base_sha256 == empty and r.spans == "" for r in got if r.doc_id in (2, 3))


# -- pages --------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>home</a></ul></nav>
<div class="cookie-notice">We use cookies, and more, for all of you, always.</div>
<div id=content><h1>Title &amp; more</h1><p>First  paragraph,\nwith <b>bold, and a <a href=x>link</a>, of some length.
<p>Second paragraph, which ends here.<br>After a break.<ul><li>one point<li>another</ul></div>
<form><p>Write us, a long text, with commas, in a form, really.</p></form>
<div class=comments><p>Reader says, this is long, with commas, and so on.</p></div>
<aside>Read also, this and that, and more of it here.</aside><footer>&copy; someone, somewhere, some time</footer>"""


def test_page():
    assert main_text(PAGE).split("\n") == [
        "Title & more", "First paragraph, with bold, and a link, of some length.",
        "Second paragraph, which ends here. After a break.", "one point", "another",
    ]
    article = "<nav>menu, menu, menu, menu, menu</nav><article><h2>A</h2><section><p>b c.</p></section><p>D&eacute;</article>"
    assert main_text(article) == "A\nb c.\nDé"


@pytest.mark.parametrize("page", ["", "<", "<p", "<!-- x", "<script>", "</p></div>", "<a href='", "&am", "<b><p></b>x"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(main_text(page), str)


def test_pages(spark):
    rows = [(1, "u", PAGE, 5), (2, None, None, 5), (3, "u", "", 5), (3, "u", "", 5), (4, "u", "plain  text", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id, r.url, r.n_chars) for r in extracted(pages).collect() if r.page_id != 1)
    assert got == [(2, None, 0), (3, "u", 0), (3, "u", 0), (4, "u", 10)]
    assert extracted(pages.limit(0)).count() == 0
    assert main_text("<div>" * 50_000 + "deep" + "</div>" * 50_000) == "deep"


LONG = "Some words, of an article, with commas. " * 3


def in_article(inner):
    return f"<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}</p>{inner}</article><footer>F</footer></body>"


@pytest.mark.parametrize(
    "inner, text",
    [
        ('<p class="share-price">It rose.</p>', "It rose."),
        ('<p class="related-work">Others.</p>', "Others."),
        ('<p class="menu">Soup.</p>', "Soup."),
        ('<p class="notice">Read this.</p>', "Read this."),
        ('<section id="search-algorithms"><p>Bisect.</p></section>', "Bisect."),
        ("<p>If <math><mi>x</mi><mo>&lt;</mo><mn>1</mn></math> holds</p>", "If x<1 holds"),
        ("<select><option>one<p>After it.", "After it."),
        ("<svg><text>drawn</text></svg><p>Seen.</p>", "Seen."),
        ("<object>unclosed<p>Kept.</p>", "unclosed\nKept."),
        ('<div class="social-share">Share</div><div class="related-posts">More</div><p class="ad">Buy</p>', ""),
        ('<div class="cookie-notice">We use cookies</div><ol id="comments"><li>First!</li></ol><form>Name</form>', ""),
        ('<article class="comment">Nice.</article><aside>By the way</aside><div class="sidebar left">Left</div>', ""),
    ],
)
def test_article_text_stays_and_the_rest_goes(inner, text):
    lines = main_text(in_article(inner)).split("\n")
    assert lines[:2] == ["T", LONG.strip()] and "\n".join(lines[2:]) == text


def test_several_articles():
    parts = [f"<article><p>{LONG} {n}</p></article>" for n in ("one", "two")]
    page = f"<body>{parts[0]}<article class=teaser>Short</article><div>{parts[1]}</div></body>"
    assert main_text(page).split("\n") == [f"{LONG}one", f"{LONG}two"]


@pytest.mark.parametrize(
    "piece", ["<div>", "<!", "<p>", "<!--", "<select>", '<a "', '<a x="', "<li>", "<p><button><div>", "<b>", "</b>", "<td><p>", "<option>"]
)
def test_time_grows_with_the_page(piece):
    import time

    start = time.perf_counter()
    main_text("<p>text " + piece * (500_000 // len(piece)) + "end>")
    assert time.perf_counter() - start < 10



# -- benchmark passages -------------------------------------------------------


def least_edits(passage, text):
    """Edits to the best piece of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        last, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        rng.choice((lambda: chars.pop(at), lambda: chars.insert(at, "z"), lambda: chars.__setitem__(at, "q")))()
    return "".join(chars)


def test_no_occurrence_is_missed(spark, documents):
    rng = random.Random(6)
    vocabulary = ["the", "of", "tion", "ing", "er", "and", "ou"]
    made = lambda n: " ".join("".join(rng.choices(vocabulary, k=2)) for _ in range(n))
    items = [(i, made(12 + 4 * i)) for i in range(5)]
    texts = []
    for n in range(60):
        passage = items[n % 5][1]
        k = len(passage) * decontaminate.EDIT_PERCENT // 100
        inside = edited(rng, passage, rng.randrange(0, 2 * k)) if n % 3 else made(15)
        texts.append((n, f"{made(10)} {inside.upper() if n % 2 else inside} {made(10)}"))
    benchmark = spark.createDataFrame([*items, (9, None), (10, "short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks(documents(texts), benchmark).collect()}
    for i, text in texts:
        for j, passage in items:
            fewest = least_edits(passage, " ".join(text.lower().split()))
            budget = min(len(passage) * 10 // 100, (len(passage) - 8) // 8)
            assert ((i, j) in got) == (fewest <= budget), (i, j, fewest, budget)
            if (i, j) in got:
                r = got[i, j]
                assert fewest <= r.edits <= budget
                assert least_edits(passage, text[r.start : r.end].lower()) <= r.edits
    clean = without_leaks(documents(texts), benchmark)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in texts} - {i for i, _ in got}
    assert clean.columns == documents(texts).columns


def test_align():
    def codes(s):
        return np.frombuffer(s.encode("utf-32-le"), np.uint32)

    assert align(codes("abcdef"), codes("xxabXdefyy"), -3, 9) == (1, 8)
    assert align(codes("abc"), codes(""), -2, 2)[0] >= 3


def test_leaks_of_awkward_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "One two  three four five six"), (2, "One two  three four five six")], "item_id long, text string")
    got = leaks(awkward, benchmark).collect()
    # Four rows, under each of the passage's ids.
    assert len(got) == 8 and {r.edits for r in got} == {0} and {(r.start, r.end) for r in got} == {(0, 27)}
    assert leaks(nothing, benchmark).count() == 0 and leaks(awkward, benchmark.limit(0)).count() == 0
    assert without_leaks(awkward, benchmark.limit(0)).count() == len(AWKWARD)


# -- toxicity -----------------------------------------------------------------


def labelled(rng, n):
    common = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(n):
        toxic = i % 10 == 0
        words = rng.choices(common, k=40) + (rng.sample(["Vilex", "vilein!", "vileo", "badum"], 2) if toxic else [])
        rng.shuffle(words)
        texts.append((i, " ".join(words)))
        labels.append((i, 1 if toxic else rng.randrange(2), int(toxic)))
    return texts, labels


def test_held_out_accuracy(spark, documents):
    texts, labels = labelled(random.Random(8), 900)
    docs = documents(texts)
    known = spark.createDataFrame(labels[:600] + [(None, 1, 1), (99_999, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    chain = fit(docs, known, ["quality", "toxic"])
    got = {r.doc_id: r.rejected for r in scores(docs, chain).collect()}
    assert all(got[i] == bool(toxic) for i, _, toxic in labels[600:])
    kept = without_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r}


def test_a_rare_language_is_not_displaced(spark, documents):
    rng = random.Random(12)
    # Many strong words of quality and many inflections of one toxic stem.
    good, stem, rare = [f"fine{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"], [f"vile{a}" for a in "abcdefghij"], ["zorak"]
    texts, labels = [], []
    for i in range(900):
        toxic, quality = i % 6 == 0, i % 2
        said = rng.choices([f"word{a}" for a in "abcdefghijklmn"], k=20) + rng.sample(good, 40 * quality)
        said += (rare if i % 36 == 0 else rng.sample(stem, 4)) if toxic else []
        texts.append((i, " ".join(said)))
        labels.append((i, quality, int(toxic)))
    chain = fit(documents(texts), spark.createDataFrame(labels[:600], "doc_id long, quality int, toxic int"), ["quality", "toxic"])
    got = {r.doc_id: r.rejected for r in scores(documents(texts), chain).collect()}
    assert all(got[i] == bool(toxic) for i, _, toxic in labels[600:])


def test_a_repeated_document_takes_one_place(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 400)
    texts, labels = labelled(random.Random(13), 300)
    # Copies come first; labels of ids without a document are many, and some contradict.
    docs = documents([texts[1]] * 2000 + texts)
    unknown = [(10_000 + i, 1, 1) for i in range(3000)]
    known = spark.createDataFrame([(i, 0, 0) for i, _, _ in labels] + labels + unknown, "doc_id long, quality int, toxic int")
    chain = fit(docs, known, ["quality", "toxic"])
    got = {r.doc_id: r.rejected for r in scores(docs, chain).collect()}
    assert all(got[i] == bool(toxic) for i, _, toxic in labels)
    again = fit(docs.repartition(7), known.repartition(5), ["quality", "toxic"])
    assert (again.words.tolist(), again.threshold) == (chain.words.tolist(), chain.threshold)


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = fit(awkward, labels, ["quality", "toxic"])
    assert not any(r.rejected for r in scores(awkward, chain).collect())
    assert scores(nothing, fit(nothing, labels, ["toxic"])).count() == 0
    assert without_toxic(awkward, chain).count() == len(AWKWARD)
