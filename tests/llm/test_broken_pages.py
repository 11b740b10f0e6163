"""Pages with furniture inside the article, broken markup, and vectors of extreme sizes."""

import time

import numpy as np
import pytest

from stratamart.llm import extraction, neighbours

TEXT = " ".join(f"sentence {i} of the article says something of its own, in full." for i in range(8))
PAGE = "<html><body><article><h1>Title</h1><p>%s</p>{}<p>closing words</p></article></body></html>" % TEXT
KEPT = f"Title {TEXT} closing words"
CUT = ["comments-section", "comment-list", "commentlist", "comments-area", "related-posts", "ad-container", "ad-slot", "share-buttons",
       "newsletter-signup", "sidebar-right", "promo-box", "comments"]


@pytest.mark.parametrize("name", CUT)
@pytest.mark.parametrize("key", ["class", "id"])
def test_parts_named_furniture_leave_an_article(name, key):
    assert extraction.main_text(PAGE.format(f'<div {key}="x1 {name}"><p>not of the article</p><ul><li>nor this</li></ul></div>')) == KEPT


@pytest.mark.parametrize("attributes", ['style="color:red; display: none"', "style='visibility:hidden'", 'aria-hidden="true"', "hidden", 'role="complementary"'])
def test_hidden_parts_leave(attributes):
    assert extraction.main_text(PAGE.format(f"<div {attributes}>not to be seen</div>")) == KEPT


@pytest.mark.parametrize("name", ["with-sidebar", "page-header-content", "no-comments", "article-comments-on", "ad-free-story", "header-less"])
def test_names_that_only_hold_such_a_word_stay(name):
    inside = f"<div class='{name}'><p>This paragraph belongs to the article.</p></div>"
    assert extraction.main_text(PAGE.format(inside)) == KEPT.replace(" closing", " This paragraph belongs to the article. closing")
    wrapped = f"<html><body><div class='{name}'><p>{TEXT}</p><p>{TEXT}</p></div></body></html>"
    assert extraction.main_text(wrapped) == f"{TEXT} {TEXT}"


def test_an_article_in_a_banner_wrapper_stays():
    page = f"<html><body><main><div class='banner-wrapper'><p>{TEXT}</p></div><p>more</p></main></body></html>"
    assert extraction.main_text(page) == f"{TEXT} more"


def test_articles_of_comments_leave():
    comment = f"<article class='comment-body'><p>{TEXT}</p></article>"
    page = f"<html><body><div><article><p>{TEXT}</p></article>{comment}{comment}</div></body></html>"
    assert extraction.main_text(page) == TEXT
    assert extraction.main_text(PAGE.format(f"<section class='comments-area'>{comment * 3}</section>")) == KEPT


def test_unclosed_quotes_and_tags_put_no_markup_into_the_text():
    for broken in ('<a href="x>', "<a href='x>", '<b class="y>'):
        assert extraction.main_text(f"<body><p>before {broken}inside</p><p>after</p></body>") == "before inside after"
    assert extraction.main_text("<p>1 < 2 and 3 > 2 <") == "1 < 2 and 3 > 2 <"
    assert extraction.main_text("<p>words</p><a href=") == "words"
    assert extraction.main_text('<p>a <i title="x > y">b</i> c</p>') == "a b c"


@pytest.mark.parametrize("unit, more", [("<b>", "</p>"), ("<span>", "<p>x"), ("<a ", ""), ('<a "', ""), ("<a '\"", ">"), ("<td>", "</tr>"), ("<p><div>", "</p>"),
                                        ("<!", ""), ("<li>", "</ul>"), ("<script>", "</script "), ("<div aaaa", "")])
def test_broken_pages_take_time_in_proportion(unit, more):
    def seconds(n):
        page = "<body><p>start " + unit * n + more * n
        start = time.process_time()
        extraction.main_text(page)
        return time.process_time() - start

    seconds(1_000)
    assert seconds(32_000) < 24 * max(seconds(4_000), 0.02)  # eight times the page


def test_long_attributes_take_time_in_proportion():
    for page in ("<a " + "a" * 400_000 + ">x", "<a " + "a=" * 200_000 + ">x", "<a " + "a " * 200_000 + ">x"):
        start = time.process_time()
        assert extraction.main_text(page) == "x"
        assert time.process_time() - start < 3


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e300, 5e-320, 1.0])
def test_vectors_of_any_size_link_by_their_cosine(spark, size):
    angles = [0.0, np.arccos(0.9456), np.arccos(0.9501) * -1, np.pi]
    rows = [(i, [float(np.cos(a) * size), float(np.sin(a) * size), 0.0]) for i, a in enumerate(angles)] + [(9, [1.0, 0.0, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95).collect()}
    assert got == {0: (2, 0), 1: (0, 1), 2: (2, 0), 3: (0, 3), 9: (2, 0)}


@pytest.mark.parametrize("polytopes", [2, 3, 4])
def test_planted_pairs_are_found_with_any_number_of_polytopes(spark, polytopes):
    """Pairs at the least cosine, hashed as larger tables are."""
    random = np.random.default_rng(polytopes)
    a = random.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = random.normal(size=a.shape)
    b -= (b * a).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    pairs = 0.951 * a + np.sqrt(1 - 0.951**2) * b
    rows = [(2 * i + j, v.tolist()) for i, both in enumerate(zip(a, pairs)) for j, v in enumerate(both)]
    classes = neighbours.classes_of(spark.createDataFrame(rows, "_vec long, embedding array<double>"))
    first = {r["cls"]: r["first"] for r in classes.select("cls", "first").collect()}
    found = {tuple(sorted((first[r["a"]], first[r["b"]]))) for r in neighbours.links(classes, 0.95, polytopes=polytopes).collect()}
    assert sum((2 * i, 2 * i + 1) in found for i in range(400)) >= 396
