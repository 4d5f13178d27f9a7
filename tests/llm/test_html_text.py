import html
import re

from fareflow.llm.html_text import extract, main_text
from tests.llm.conftest import SMALL

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header class="site"><a href=/>Home</a> My Site</header>
<div id="cookie-notice">We use cookies to make the site better for you and all of our users.</div>
<div class="sidebar"><p>This is the sidebar and it has a lot of the words that are in the text of an article.</p></div>
<div class="wrap"><h2>The title</h2>
<p>This is the first paragraph of the article &amp; it is long enough to be judged by the density of its stop words.</p>
<p>Short
  one.</p><p>Here is <b>another</b> paragraph, which is long and has all the words that one would need in order to be taken as content.</p>
<p><a href=x>Read more about this</a></p></div>
<div class="comments"><p>I think that this is the best article that I have read in a long time, and I will be back.</p></div>
<form><input><p>Subscribe to our newsletter</p></form><footer>&copy; 2024</footer><script>var a="<p>x</p>"</script></body></html>"""


def test_page_without_article_element():
    assert main_text(PAGE) == (
        "The title\nThis is the first paragraph of the article & it is long enough to be judged by the density of its stop words.\n"
        "Short one.\nHere is another paragraph, which is long and has all the words that one would need in order to be taken as content.")


def test_article_keeps_its_short_blocks():
    page = ("<nav><a>x</a></nav><div class=ad>Buy the best of the best now</div><article><header><h1>Über &lt;T&gt;</h1></header><p>Kurz.<p>a<br>b"
            "<aside>See also</aside><ul><li>one<li>two</ul></article><div>Some line</div>")
    assert main_text(page) == "Über <T>\nKurz.\na\nb\none\ntwo"


def test_broken_markup_and_empty_pages():
    for page in (None, "", "<", "<p", "<script>", "<!-- x", "<a href='", "</p></div>", "a < b", "<p>&#x;&bogus;"):
        assert main_text(page) == ""
    assert main_text("<article><p>1 < 2 &amp;amp; 3&nbsp;4 &#233;") == "1 < 2 &amp; 3 4 é"
    assert len(main_text("<article>" + "<p>word " * 50_000)) == 50_000 * 5 - 1


def test_links_are_measured_as_they_read():
    link = "".join(f"&#{ord(c)};" for c in "привет")
    words = "это первый абзац статьи и он достаточно длинный чтобы остаться в тексте страницы"
    assert main_text(f"<article><p>{words} <a href=x>{link} {link}</a> {words}</p></article>") == f"{words} привет привет {words}"
    wrapped = "<a href=x>one" + "\n" + " " * 200 + "two</a>"
    assert main_text(f"<article><p>{words} {wrapped}</p></article>") == f"{words} one two"
    assert main_text(f"<article><p>{words}</p><p>x <a href=x>{link}</a></p></article>") == words


def test_articles_of_the_pages_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    wanted = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)[^>]*>", article)]
        wanted[r.page_id] = "\n".join(b for b in blocks if b)
    out = extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.text for r in out.collect()} == wanted


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "x", 3), (1, PAGE, "y", 4)], "page_id long, html string, Text string, other int")
    out = extract(df)
    assert out.columns == ["page_id", "other", "text", "n_chars"]
    assert sorted((r.other, r.n_chars) for r in out.collect())[0] == (3, 0)
    assert extract(df.limit(0)).count() == 0
