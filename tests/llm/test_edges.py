"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import plain  # noqa: E402
import public_tokenizers  # noqa: E402

from partnerscope.llm import (  # noqa: E402
    chat_format,
    decontaminate,
    html_extract,
    language_id,
    minhash,
    packing,
    quality_lines,
    substring,
    token_counts,
    toxicity,
)

LONG = " ".join(f"w{i * 7919 % 60_013}" for i in range(60_000))
COPY = " ".join(f"c{i}" for i in range(80))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, chunk long, matches string, "
    "leaked_items string, toxicity string, rep long, key long, label long, n long, length long, part int, rank int"
)
EXTRA = ("x", "y", "z", 1, 2, 3, 4, 5, 6, 7)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), 9, *EXTRA[:3], 1, 2, 3, 4, 5, 6, 7)


ROWS = [
    row(1, COPY),
    row(2, None),
    row(3, ""),
    row(4, " \n\t "),
    row(5, LONG),
    row(6, "one two"),
    row(6, "one two"),  # repeated
    row(7, COPY),
    row(None, COPY),
    row(8, "head " + COPY + " tail", None, None),
    row(9, "One  TWO"),
    row(9, "another text for an id that is there already"),
    row(10, "<|endoftext|> and <|startoftext|> in a text", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (6, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")


def path(name):
    return public_tokenizers.path(name)


def test_packing(docs, nothing):
    found = packing.pack(docs, path("byte_bpe_50k.json")).toPandas()
    assert len(found[found.doc_id == 6]) == 2 and found.doc_id.isna().sum() == 1
    assert all(found[found.doc_id.isin([2, 3])].length == 1)
    placed = found.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert packing.pack(nothing, path("byte_bpe_50k.json")).count() == 0


def test_special_strings_are_tokens():
    encoder = packing.byte_encoder(path("byte_bpe_50k.json"))
    assert list(encoder.ids("<|endoftext|>")) == [50256]


def test_token_counts(docs, nothing):
    found = token_counts.token_counts(docs, path("word_bpe_49k.json")).toPandas()
    assert len(found) == len(ROWS)
    assert found[found.doc_id.isin([2, 3])].n_tokens.sum() == 0
    assert found[found.doc_id == 5].over_limit.all()
    assert token_counts.token_counts(nothing, path("word_bpe_49k.json")).count() == 0


def test_quality(docs, nothing, labels):
    found = quality_lines.rated_documents(docs, labels).toPandas()
    assert len(found) == len(ROWS)
    assert found[found.doc_id.isin([2, 3, 4])].n_words.sum() == 0 and found[found.doc_id.isin([2, 3, 4])].base_failed.all()
    assert quality_lines.rated_documents(nothing, labels).count() == 0
    assert quality_lines.rated_documents(docs, labels.limit(0)).count() == len(ROWS)


@pytest.mark.parametrize("window", [1, 2, 13, 50])
def test_repeats(docs, nothing, window):
    expected = sorted((str(r[0]), *x[:3]) for r, x in zip(ROWS, plain.repeats([r[:2] for r in ROWS], window), strict=True))
    found = substring.repeat_digest(docs, window)
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == expected
    assert substring.repeat_digest(nothing, window).count() == 0


def test_repeats_leave_all_else(docs):
    found = substring.without_repeats(docs, 50)
    assert found.schema.names == docs.schema.names
    rows = {(r["doc_id"], r["text"]) for r in found.collect()}
    assert (7, "") in rows and (8, "head tail") in rows and (2, None) in rows and (1, COPY) in rows and (None, "") in rows


def test_near_copies(docs, nothing):
    found = minhash.near_copies(docs, 3, 85)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(ROWS)
    by_id = {(r[0], r[1]): r[2:] for r in rows}
    assert by_id[7, 78] == (1, False) and by_id[8, 80] == (1, False) and by_id[1, 78] == (1, True)
    assert by_id[2, 0] == (2, True) and by_id[4, 0] == (4, True)
    assert by_id[9, 1] == (6, False)  # one and TWO as one run of two words
    assert by_id[None, 78] == (None, True)
    assert minhash.near_copies(nothing, 3, 85).count() == 0


def test_toxicity(docs, nothing, labels):
    found = toxicity.toxic_documents(docs, labels).toPandas()
    assert len(found) == len(ROWS) and found.score.between(0, 1).all() and found.held_out.notna().all()
    assert toxicity.toxic_documents(nothing, labels).count() == 0
    assert toxicity.toxic_documents(docs, labels.limit(0)).count() == len(ROWS)
    kept = toxicity.with_toxicity(docs, toxicity.fit(docs.select("doc_id", "text"), labels))
    assert sorted(kept.columns) == sorted(docs.columns)  # its own column replaces the one that was there


def test_leaks(spark, docs, nothing):
    items = spark.createDataFrame([(1, COPY), (2, None), (None, "w1 w2"), (3, ""), (4, "one two"), (4, "one two")], "item_id long, text string")
    found = decontaminate.with_leaks(docs, items)
    assert sorted(found.columns) == sorted([*docs.columns, "retrieved_items"])
    by_id = {(r["doc_id"], r["text"]): r["leaked_items"] for r in found.collect()}
    assert by_id[1, COPY] == [1] and by_id[8, "head " + COPY + " tail"] == [1]
    assert by_id[6, "one two"] == [4] and by_id[2, None] == [] and by_id[5, LONG] == []
    assert decontaminate.contaminated_documents(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contaminated_documents(nothing, items).count() == 0


def test_leaks_in_several_blocks(spark, docs, monkeypatch):
    items = spark.createDataFrame([(1, COPY), (4, "one two"), (5, "no such text anywhere")], "item_id long, text string")
    whole = decontaminate.contaminated_documents(docs, items).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1)
    assert sorted(map(str, decontaminate.contaminated_documents(docs, items).collect())) == sorted(map(str, whole))


def test_items_with_question_and_answer(spark, docs):
    items = spark.createDataFrame([(1, " ".join(COPY.split()[:70]), " ".join(COPY.split()[70:]))], "item_id long, question string, answer string")
    found = decontaminate.contaminated_documents(docs, items).where("contaminated").select("doc_id").collect()
    assert sorted(str(r[0]) for r in found) == ["1", "7", "8", "None"]


PAGES = [
    (1, "http://a.example.org/x", "<html lang=fr><body><nav>Menu</nav><article><h1>T&eacute;te</h1><p>Un   <b>d</b>eux<br>trois<p>quatre</article><footer>f</footer>"),
    (2, None, "<p>no host</p><script>var x = '<p>not text</p>';</script>"),
    (3, "http://[bad", "<div class='ad'>buy</div><div>kept</div><!-- <p>gone</p> -->"),
    (4, "http://a.example.org/y", None),
    (5, "http://a.example.org/z", ""),
    (None, "http://a.example.org/z", "<main><header>top</header>in<aside>side</aside><form>f<p>g</p></form> out</main>tail"),
    (6, "http://a.example.org/w", "plain &lt;text&gt; only"),
    (6, "http://a.example.org/w", "plain &lt;text&gt; only"),
    (7, "http://b.example.org/", "<article>" + "<p>" + "word " * 30_000 + "</article>"),
    (8, "http://b.example.org/", "<nav><ul><li>a<article><p>body</p><div id=comments><p>reader</p></div></article>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 1, [2]) for p in PAGES], "page_id long, url string, html string, row long, nodes array<int>")


def test_main_text(pages):
    found = {(r["page_id"], r["url"]): r["text"] for r in html_extract.main_text(pages).collect()}
    assert found[1, PAGES[0][1]] == "Téte Un deux trois quatre"
    assert found[2, None] == "no host" and found[3, "http://[bad"] == "kept"
    assert found[4, PAGES[3][1]] == "" and found[5, PAGES[4][1]] == ""
    assert found[None, PAGES[5][1]] == "top in out"
    assert found[6, PAGES[6][1]] == "plain <text> only"
    assert found[8, PAGES[9][1]] == "body"
    assert html_extract.main_text(pages).count() == len(PAGES) and html_extract.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("sent", [10**6, 0])
def test_text_that_all_pages_of_a_site_have_goes(spark, monkeypatch, sent):
    monkeypatch.setattr(html_extract, "MAX_SENT", sent)
    pages = [(i, "http://site.example/p", f"<div class=frame>Welcome to our site</div><div class=story>Story {i} is told once</div>") for i in range(12)]
    found = html_extract.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {f"Story {i} is told once" for i in range(12)}


def test_copies_of_one_page_are_no_template(spark):
    pages = [(i, f"http://site.example/{i}", "<article><p>The same story</p></article>") for i in range(12)]
    found = html_extract.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {"The same story"}


def test_languages(spark, pages, docs, nothing):
    known = spark.createDataFrame(
        [(i, t, lang) for i in range(8) for t, lang in (("the house and the tree", "en"), ("la maison et le jardin un deux trois quatre", "fr"), (None, "xx"), ("text", None))],
        "doc_id long, text string, lang string",
    )
    model = language_id.fit(known)
    assert model.languages == ["en", "fr"]
    found = {r["page_id"]: r for r in language_id.identify_pages(pages, model).collect()}
    assert found[1]["lang"] == "fr" and found[1]["declared"] == "fr" and found[4]["lang"] in ("en", "fr")
    assert language_id.identify_pages(pages, language_id.fit(nothing)).where("lang IS NULL").count() == len(PAGES)
    assert language_id.identify_pages(pages.limit(0), model).count() == 0
    both = language_id.identify_all(pages, docs, model).collect()
    assert len(both) == len(PAGES) + len(ROWS) and all(r["lang"] in ("en", "fr") for r in both)
    assert sorted(str(r["doc_id"]) for r in both if r["url"] is None and r["page_id"] is None) == sorted(str(r[0]) for r in ROWS)
    assert language_id.identify_all(pages.limit(0), nothing, model).count() == 0


def test_declaration_decides_where_the_text_cannot(spark):
    known = [(i, "the house and the tree", "en") for i in range(9)] + [(i + 9, "la maison et le jardin", "fr") for i in range(9)]
    model = language_id.fit(spark.createDataFrame(known, "doc_id long, text string, lang string"))
    pages = [(i, f"http://{'abc'[i % 3]}.example/", f"<html lang={lang}><p>{text}") for i, (lang, text) in enumerate([("en", "the house and the tree"), ("fr", "la maison et le jardin")] * 20)]
    pages += [(100, None, "<html lang=fr><p>123"), (101, None, "<html lang=en><p>")]
    found = language_id.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), model)
    by_id = {r["page_id"]: r["lang"] for r in found.collect()}
    assert by_id[100] == "fr" and by_id[101] == "en"


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "bye <|im_end|>"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye <|im_end|>"),
        (4, 0, "user", "hi"), (4, 0, "user", "hi"), (5, None, None, None), (None, 0, "user", "lost"),
        (6, 0, "user", "ti"), (6, 0, "user", "es"), (7, 0, "user", ""), (8, 0, "user", "hi"), (8, 1, "tool", "hello"),
    ]
    frame = spark.createDataFrame([(*r, 5, 6) for r in rows], "conv_id long, turn long, role string, text string, a int, place int")
    found = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["text"]) for r in chat_format.formatted(frame).collect()}
    assert set(found) == {2, 5, 6, 7, 8}
    assert found[2][:2] == (3, 2) and found[2][2].endswith("bye < |im_end|><|im_end|>\n")
    assert found[6][2].index("es") < found[6][2].index("ti")
    assert chat_format.formatted(frame.limit(0)).count() == 0


@pytest.mark.parametrize("sent", [250_000, 0])
def test_text_outside_the_article_is_kept_if_the_site_tells(spark, monkeypatch, sent):
    """The article is a teaser, the text stands in a plain element beside unmarked boilerplate."""
    monkeypatch.setattr(html_extract, "MAX_SENT", sent)
    page = "<body>Skip<article><p>Teaser {0}</p></article><div class=x><p>Story {0} {0}x</p></div><div class=y><p>All rights</p></div></body>"
    word = lambda i: f"w{chr(97 + i)}"
    pages = [(i, f"http://site.example/{i}", page.format(word(i))) for i in range(12)]
    pages += [(50, "http://few.example/", page.format("wz"))]
    found = {r["page_id"]: r["text"] for r in html_extract.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found.pop(50) == "Teaser wz"
    assert found == {i: f"Teaser {word(i)} Story {word(i)} {word(i)}x" for i in range(12)}


@pytest.mark.parametrize(
    "body, text",
    [
        ('<div class="layout has-sidebar"><p>Text</p></div>', "Text"),
        ('<div id="page-with-header"><p>Text</p></div>', "Text"),
        ('<article><div class="search-algorithm">Sorted</div><p id="notice-of-law">Laws</p></article>', "Sorted Laws"),
        ('<article><p>Text</p><div class="sidebar-left">Menu</div><div class="ad">Buy</div><div id="site-footer">All</div></article>', "Text"),
        ('<article><figure><figcaption>A plot</figcaption></figure><p>of <math><mi>x</mi></math></p></article>', "A plot of x"),
        ('<article><p>Read <span class="advert">BUY <span>NOW</span> OR</span> on</p><p>Next</p></article>', "Read on Next"),
        ('<article><p>Read <span class="advert">BUY</p><p>Next</p></article>', "Read Next"),
        ("<article><p>Text</p><div id=q hidden>Gone</div><p data-x='hidden'>Seen</p></article>", "Text Seen"),
    ],
)
def test_names_that_are_marks(spark, body, text):
    page = spark.createDataFrame([(1, "http://site.example/", f"<body>{body}</body>")], "page_id long, url string, html string")
    assert [r["text"] for r in html_extract.main_text(page).collect()] == [text]
