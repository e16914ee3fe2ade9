import html
import re
import time

from tests.conftest import SF_SMALL
from touchpath.llm.html_extraction import extract, main_text


def expected(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    out = main_text(pages, keep=["page_id", "url", "html"]).collect()
    assert len(out) == pages.count()
    for r in out:
        assert r.text == expected(r.html) and r.n_chars == len(r.text)


PARAGRAPH = "<p>" + "some words of the article " * 8 + "</p>"


def test_boilerplate_goes_and_text_stays():
    page = (f"<html><head><title>T</title></head><body><nav><a href=x>menu</a></nav><div class='cookie-notice'>cookies!</div><article><h1>Head &amp; line</h1>"
            f"{PARAGRAPH}<div class=ad>buy</div><form><input>name</form><ul><li>first<li>second</ul>{PARAGRAPH}<p>end</p></article>"
            f"<section id=comments><p>{'nice post ' * 90}</p></section><aside>more</aside><footer>&copy;</footer></body></html>")
    line = " ".join("some words of the article".split() * 8)
    assert extract(page) == f"Head & line\n{line}\nfirst\nsecond\n{line}\nend"


def test_without_semantic_tags():
    page = f"<body><div><a href=1>one</a> <a href=2>two</a></div><div id=x>{PARAGRAPH * 3}</div><div>tiny</div></body>"
    assert extract(page).split("\n") == [" ".join("some words of the article".split() * 8)] * 3


def test_white_space_and_references():
    assert extract("<div><p> a\n\t b&nbsp;<i>c</i>d<br>e &lt;x&gt; &#233;</p></div>") == "a b cd e <x> é"


def test_broken_markup_and_edges(spark):
    assert [extract(x) for x in ("", "   ", "<", "<!-- open", "<script>var a='<p>'")] == ["", "", "<", "", ""]
    assert extract("plain text\n only") == "plain text only"
    assert extract("<div>" * 20_000 + "deep") == "deep"
    assert len(extract('<p "' * 20_000)) > 0 and extract("<b>" * 30_000 + "x" + "</i>" * 30_000) == "x"
    data = [(1, None, None, "a"), (2, "u", "", "b"), (3, "u", "<p>x</p>", "c"), (3, "u", "<p>x</p>", "c"), (None, "u", "<p>" + "y " * 100_000 + "</p>", "d")]
    out = main_text(spark.createDataFrame(data, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 199_999), (1, 0), (2, 0), (3, 1), (3, 1)]
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_deeply_nested_pages_take_time_in_proportion():
    def seconds(n):
        page = "<div>" * n + "<header>" * n + "<h2>deep</h2>" * n + "words of the text " * 20
        start = time.perf_counter()
        extract(page)
        return time.perf_counter() - start

    seconds(500)
    assert seconds(20_000) < 40 * max(seconds(2_000), 0.02)
    assert extract("<article><header><h1>Head</h1></header><p>" + "text " * 50 + "</p></article>").startswith("Head\n")


def test_classes_that_start_like_boilerplate_and_wrappers():
    line = " ".join("some words of the article".split() * 8)
    assert extract(f"<body><div class='commentlist'><p>{'hi all ' * 99}</p></div><article>{PARAGRAPH}</article></body>") == line
    assert extract(f"<body><div class='page has-sidebar'><article>{PARAGRAPH}</article><nav>menu</nav></div></body>") == line


def test_wrappers_with_a_boilerplate_word_keep_their_article():
    line = " ".join("some words of the article".split() * 8)
    skip, copyright = "<a href=#c>Skip to content</a>", "<div>Copyright Example</div>"
    for wrapper in ("class='content has-sidebar'", "class='post no-comments'", "class='layout-with-menu'", "class=commentary", "id=related-research"):
        menu = "<div class=menu><a href=1>one</a></div><div class=sidebar>about us</div>"
        assert extract(f"<body>{skip}<div {wrapper}>{menu}<article>{PARAGRAPH * 2}</article></div>{copyright}</body>") == f"{line}\n{line}"
        assert extract(f"<body>{skip}<div {wrapper}>{menu}<div>{PARAGRAPH * 2}</div></div>{copyright}</body>") == f"{line}\n{line}"
        assert extract(f"<body>{skip}<div {wrapper}><main>{PARAGRAPH}</main></div><article>{PARAGRAPH}</article></body>").endswith(f"{line}\n{line}")
    halves = f"<div class=with-menu>{PARAGRAPH}</div><div class=no-sidebar>{PARAGRAPH}</div>"
    assert line in extract(f"<body>{skip}{halves}{copyright}</body>")
    assert extract(f"<body><article>{PARAGRAPH}</article><ol class=comment-list><li><article class=comment><p>{'nice ' * 99}</p></article></ol></body>") == line
