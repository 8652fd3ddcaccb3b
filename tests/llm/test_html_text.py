"""Main text of small pages written out, and of whole tables."""

import html
import re

from pyspark.sql import functions as F

from tallyline.llm.html_text import extract_text, main_text
from tallyline.llm.queries import op8_html_text

PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><!-- <p>no</p> -->
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, ok. Please, accept.</div>
<div id="content"><h2>T &amp; t</h2><p>Hello, a<br>b \xa0 c.
 This is a longer <b>para</b>graph, with text.<ul><li>one<li>two</ul>
<div class="ad-slot">Buy, now!</div><script>var t="</p>";</script><p>End <a href=x>link</a>s &lt;x&gt; a < b</p>
<section id="comments"><p>I, too, comment.</p></section></div>
<aside>side</aside><form><p>x</p></form><footer>&copy; f</footer></body></html>"""


def test_a_page_with_everything():
    assert main_text(PAGE) == (
        "T & t\nHello, a b c. This is a longer paragraph, with text.\none\ntwo\nEnd links <x> a < b"
    )


def test_pages_without_structure():
    assert main_text("just text") == "just text"
    assert main_text("<p>Open, end. <p>Next one.") == "Open, end.\nNext one."
    assert main_text("<div><div><p>Unclosed, here.</span></div>") == "Unclosed, here."
    assert main_text("<nav>menu</nav>") == main_text("") == main_text(None) == main_text("<p>  </p>") == ""
    assert main_text("<p>before</p><script>never closed") == "before"
    assert main_text("a <! b> &#x41;&nbsp;&unknown;") == "a A &unknown;"


def test_article_wins_over_loose_text():
    page = "<div>Loose, text. Here, it is.</div><article><h1>T</h1><p>Short.</p></article>"
    assert main_text(page) == "T\nShort."


def test_lists_and_headings_beside_paragraphs_stay():
    paragraph, item = "Some words, here. " * 33, "A short item of a list in the article"
    page = "<article>" + f"<p>{paragraph}</p>" * 10 + "<ul>" + f"<li>{item}</li>" * 30 + "</ul></article>"
    assert main_text(page).count(item) == 30
    for tag in ("article", "div", "body"):
        page = f"<{tag}><h1>Title</h1><h2>Part</h2><p>" + "Many words, in all. " * 100 + f"</p></{tag}>"
        assert main_text(page).startswith("Title\nPart\nMany words")


def test_containers_are_sections_that_hold_most_of_the_text():
    body = "<h1>Title</h1>" + "<p>A long paragraph, with text. And more, of it.</p>" * 20
    page = f'<body><p class="post-date">By A, today.</p><div class="story-link">See, also.</div><div>{body}</div></body>'
    assert main_text(page).startswith("By A") or main_text(page).startswith("Title")
    assert main_text(page).count("A long paragraph") == 20
    assert main_text(f"<article>A card.</article><div>{body}</div>").count("A long paragraph") == 20
    assert main_text(f"<div><div>Home</div><div>{body}</div><div>Imprint</div></div>").startswith("Title")


def test_very_long_and_deep_pages():
    page = "<article>" + "<p>Word, word.</p>" * 20000 + "</article>"
    assert main_text(page).count("\n") == 19999
    assert main_text("<div>" * 3000 + "<p>Deep, down.</p>") == "Deep, down."


def test_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "<p>A, b.</p>", "y"), (2, "<p>A, b.</p>", "y")], "k int, html string, text string")
    assert [r["text"] for r in extract_text(df).orderBy("k").collect()] == ["", "A, b.", "A, b."]
    assert extract_text(df.limit(0)).count() == 0


def test_query_gives_each_article_whole(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op8_html_text(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
    assert op8_html_text(spark, sf_dir).where(F.col("url").isNull()).count() == 0
