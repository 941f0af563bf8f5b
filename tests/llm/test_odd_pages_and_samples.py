"""Pages that once lost text or took hours, comments and notices by contract, and samples of languages with shared ids."""

import time

from sigloom.llm import language, main_text
from sigloom.llm.main_text import Page


def text_of(html):
    page = Page(html)
    return page.text(page.best())


def test_characters_that_grow_in_lower_case_lose_nothing():
    for n in (9, 12, 60):
        page = f"<article><p>{'İ' * n}</p><script>var x=1;</SCRIPT><p>First paragraph.</p><style>p</Style ><p>Second paragraph.</p></article>"
        assert text_of(page) == "İ" * n + "\n\nFirst paragraph.\n\nSecond paragraph."


def test_pages_without_ends_take_linear_time():
    start = time.process_time()
    for part in ("<a ", '<a "', "<a x='", "<!", "<!--", "<p class=" + "x" * 50 + " ", "a" * 40 + "=<", "</x>"):
        Page("<article><p>Text stays.</p>" + part * (1_000_000 // len(part)))
    Page("<p " + "a" * 1_000_000 + ">x</p>")
    assert time.process_time() - start < 25
    assert text_of("<article><p>Text stays.</p><p>And this.</p>" + "<a " * 1000).startswith("Text stays.\n\nAnd this.")


def test_deeply_nested_pages_stay_small():
    start = time.process_time()
    page = Page("<div class='deep'>" * 50_000 + "<p>the innermost text</p>" + "</div>" * 50_000)
    assert sum(map(len, page.paths)) < 20_000_000 and time.process_time() - start < 20
    assert page.text(page.best()) == "the innermost text"


def test_quoted_brackets_in_attributes():
    assert text_of('<article><p title="a > b < c">One <a href="x>y">two</a>.</p><p data-x=\'<b>\'>Three.</p></article>') == "One two.\n\nThree."


def test_comments_and_notices_inside_an_article():
    body = "<p>The article itself has some words.</p><p>And some more of them here.</p>"
    want = "The article itself has some words.\n\nAnd some more of them here."
    for extra in (
        '<section id="comments"><p>First! What a long comment of a reader this is.</p></section>',
        '<ol id="commentlist"><li>Reader one</li></ol>',
        '<div id="disqus_thread">Comments load here</div>',
        '<div class="notice">This site moves on Monday.</div>',
        '<div class="alert alert-info">We use a new design.</div>',
    ):
        assert text_of(f"<html><body><article>{body}{extra}</article></body></html>") == want
        assert text_of(f"<html><body><main><div class='post'>{body}</div>{extra * 3}</main></body></html>") == want
    # headings and sections of an article may be about the same words
    kept = text_of(f'<article>{body}<h2 id="comments">Comments on method</h2><section id="notice-periods"><p>They are long.</p></section></article>')
    assert kept == want + "\n\nComments on method\n\nThey are long."


def test_blocks_of_the_hosts_path_stay_beside_the_pages_own(spark):
    long = "A sentence of the article that is long enough to count. " * 4
    usual = "<html><body><div class='story'><p>" + long + "</p></div></body></html>"
    odd = "<html><body><div class='story'><p>The opening paragraph of this page.</p></div><div class='text'><p>" + long + "</p><p>" + long + "</p></div></body></html>"
    rows = [(i, f"http://h/{i}", usual) for i in range(6)] + [(9, "http://h/9", odd)]
    got = {r["page_id"]: r["text"] for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9].startswith("The opening paragraph of this page.\n\n") and got[9].count("\n\n") == 2


def test_languages_with_one_doc_id_are_all_learned(spark):
    words = {"en": "the house and the garden are green", "de": "das haus und der garten sind heute", "fr": "la maison et le jardin sont verts"}
    rows = [(7, f"{w} {i}", lang) for lang, w in words.items() for i in range(400)]
    rows += [(7, "the same row again and again", "en")] * 3000 + [(8, "ein text", "nl")] * 2000
    made = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert set(made) == {"de", "en", "fr", "nl"} and made["nl"] == b"ein text"
    assert all(len(made[x].splitlines()) == language.SAMPLE for x in words)
    named = language.identify(spark.createDataFrame([(1, "der garten und das haus"), (2, "le jardin et la maison"), (3, "the garden and the house")], "doc_id long, text string"), made)
    assert {r["doc_id"]: r["lang_pred"] for r in named.collect()} == {1: "de", 2: "fr", 3: "en"}


def test_language_choice_equals_a_plain_chooser(spark, sf):
    """The smallest sum of compressed pieces wins, ties go to the first name."""
    import zstandard

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    made = language.learn(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, made).collect()}
    for r in docs.limit(60).collect():
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert got[r["doc_id"]] == "und"
            continue
        raw = r["text"].lower().encode()
        sizes = {}
        for lang, content in made.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(c.compress(raw[i : i + language.PIECE])) for i in range(0, len(raw), language.PIECE))
        assert got[r["doc_id"]] == min(sorted(sizes), key=sizes.get)
