"""Main text that must not be lost: slugs as ids, formulas."""

import pytest

from sigloom.llm import main_text

SLUGS = ["discussion", "related-work", "social-impact", "search-results", "side-effects", "share", "comments-on-method", "header-files"]


def texts(table, rows, **options):
    return {x.page_id: x.text for x in main_text.extract(table(rows, "page_id long, url string, html string"), **options).collect()}


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div>%s</div></main>", '<div class="post-content">%s</div>', "%s"])
def test_slugs_are_no_marks(table, around):
    parts = "".join(f'<section id="{s}"><h2 id="{s}">Title {s}</h2><p>Text of {s}, of some length.</p></section>' for s in SLUGS)
    page = f"<html><body><nav>Home</nav>{around % ('<p>First words of the article, rather long so that it counts.</p>' + parts)}<footer>c</footer></body></html>"
    expected = ["First words of the article, rather long so that it counts."] + [x for s in SLUGS for x in (f"Title {s}", f"Text of {s}, of some length.")]
    assert texts(table, [(1, "http://a.example/1", page)])[1] == "\n\n".join(expected)


def test_known_parts_stay_out_and_formulas_stay_in(table):
    apart = '<div class="related-posts">r</div><ul class="share-buttons"><li>s</ul><div class="ad-slot">d</div><div role="navigation">n</div>'
    page = f'<html><body><div id="sidebar">side</div><article><h2 class="side-effects">Effects</h2><p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>{apart}</article></body></html>'
    assert texts(table, [(1, "http://a.example/1", page)])[1] == "Effects\n\nWhere x=2 holds."


def test_an_article_that_goes_on_beside_the_winning_container(table):
    usual = "<html><body><div class=wrap><div class=lead><p>Usual article %d with enough words to win the vote of its host.</p></div></div></body></html>"
    first, rest = "The lead of a long article, which is most of its text here.", "What follows it beside the first one."
    page = f"<html><body><div class=wrap><div class=lead><p>{first}</p></div><div class=more><p>{rest}</p><p><a href=x>Other page</a></p></div></div></body></html>"
    # the other layout has the winning path too, with more than half as much text as its own article
    both = f"<html><body><div class=wrap><div class=lead><p>{first}</p></div></div><article><p>{rest}</p></article></body></html>"
    rows = [(i, "http://a.example/%d" % i, usual % i) for i in range(20)] + [(20, "http://a.example/20", page), (21, "http://a.example/21", both)]
    got = texts(table, rows)
    assert got == texts(table, rows, large_host=5)
    assert got[3] == "Usual article 3 with enough words to win the vote of its host."
    assert got[20] == got[21] == f"{first}\n\n{rest}"
