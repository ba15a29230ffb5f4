from __future__ import annotations

import html
import re

from pyspark.sql import functions as F

from ledgerloom.llm import extraction


def plain(page):
    """What the article of a generated page holds, read with expressions of its own."""
    part = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    cut = re.split(r"</?(?:p|h1)>", part)
    said = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in cut]
    return "\n".join(x for x in said if x)


def test_equals_plain_reading(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf.replace('0.001', '0.01')}/pages.parquet").collect()}
    rows = extraction.op6_html_extraction(spark, sf.replace("0.001", "0.01")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id].html), r.page_id
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<html><head><title>T</title></head><body><header><h2>Site</h2></header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div>
<div id=content><h1>{h}</h1><p>First &amp; {a}<br>line</p><p>Second&nbsp;{b}</div><p class=sign>Sent from our site</p><form><input><label>mail</label></form>
<div class="comments"><p>a reader says</p></div><aside>side {h}</aside><footer>&copy;</footer><script>var x = "<p>no</p>"</script></body></html>"""


def test_wrapper_induction(table):
    rows = [(i, f"http://a.example/{i}", PAGE.format(h=f"Title {i}", a=f"x{i}", b=f"y{i}"), 0) for i in range(8)]
    rows += [(20, "http://b.example/", PAGE.format(h="Only", a="p", b="q"), 0), (21, None, "<p>no host", 1), (22, "x", None, 1), (23, "http://c.example", "", None), (None, "http://c.example", "plain < text", None)]
    rows += [(30 + i, "http://d.example/", PAGE.format(h="Same", a="same", b="same"), 0) for i in range(9)]
    pages = table(rows, "page_id long, url string, html string, text int", "pages")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i] == f"Title {i}\nFirst & x{i} line\nSecond y{i}"  # the signature is on every page of the host
    assert got[20] == "Only\nFirst & p line\nSecond q\nSent from our site"
    assert got[30] == "Same\nFirst & same line\nSecond same\nSent from our site"  # copies prove no template
    assert (got[21], got[22], got[23], got[None]) == ("no host", "", "", "plain < text")
    assert extraction.extract(pages.limit(0)).count() == 0


def test_wrappers_take_templates_of_the_given_pages(spark, sf):
    """On the given pages alignment alone finds what lies beside the articles, and takes nothing of them."""
    pages = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/pages.parquet").withColumn("url", F.concat(F.lit("http://h"), F.col("page_id") % 20, F.lit(".example/")))
    told = {r.page_id: (r.text, r.n_template) for r in extraction.extract(pages).collect()}
    off = {r.page_id: (r.text, r.n_template) for r in extraction.extract(pages, induce=False).collect()}
    assert {i: t for i, (t, _) in told.items()} == {i: t for i, (t, _) in off.items()}
    assert sum(n for _, n in off.values()) == 0 and sum(n > 0 for _, n in told.values()) > 0.95 * len(told)


FIXED = """<html><body><div>Our site</div><article><h1>T {i}</h1><h2>Summary</h2><p>Long running text of page {i}, which goes on for a while.</p><h2>References</h2><p>No known side effects.</p>
<div class="menu"><p>Soup of the day</p></div><div class="banner">A banner was hung</div><p class="comment">On the name</p><div class="menu"><a href=x>Home</a> <a href=y>Shop</a></div><div class="comment">a reader</div></article><div>Contact us</div></body></html>"""


def test_what_never_changes_within_a_told_article_stays(table):
    pages = table([(i, f"http://a.example/{i}", FIXED.format(i=i)) for i in range(9)], "page_id long, url string, html string", "pages")
    for r in extraction.extract(pages).collect():
        assert r.text == f"T {r.page_id}\nSummary\nLong running text of page {r.page_id}, which goes on for a while.\nReferences\nNo known side effects.\nSoup of the day\nA banner was hung\nOn the name"
        assert r.n_template >= 2


SECOND = """<html><body><div class=top><a href=a>Home</a></div><div class=c1><h1>T {i}</h1><p>{long}</p></div><div class=c2><p>Second part {i} short.</p></div><div class=end>Imprint {i}</div></body></html>"""


def test_a_short_second_block_of_paragraphs_stays(table):
    pages = table([(i, f"http://a.example/{i}", SECOND.format(i=i, long=f"words {i} " * 40)) for i in range(9)], "page_id long, url string, html string", "pages")
    for r in extraction.extract(pages).collect():
        assert r.text == f"T {r.page_id}\n{('words %d ' % r.page_id * 40).strip()}\nSecond part {r.page_id} short."


def untold(page):
    """A page without the kinds and classes that tell its article from the rest."""
    return re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(?:article|nav|footer|aside|header|main)\b", r"<\1div", page))


def test_induction_finds_articles_that_no_kind_tells(spark, sf):
    rows = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/pages.parquet")
    want = {r.page_id: plain(r.html) for r in rows.collect()}
    pages = rows.withColumn("html", F.udf(untold)("html")).withColumn("url", F.concat(F.lit("http://h"), F.col("page_id") % 20, F.lit(".example/")))
    told = {r.page_id: (r.text, r.n_template) for r in extraction.extract(pages).collect()}
    off = {r.page_id: r.text for r in extraction.extract(pages, induce=False).collect()}
    right = sum(told[i][0] == want[i] for i in want) / len(want)
    assert right > 0.95 and sum(off[i] == want[i] for i in want) == 0 and min(n for _, n in told.values()) >= 0
    assert sum(n for _, n in told.values()) > 3 * len(want)


def test_pages_of_any_shape_take_time_in_proportion():
    import time

    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert extraction._text(deep) == extraction._text("<span>" * 5000 + "deep") == "deep"
    assert extraction._text("<main>" * 5000 + "deep") == "deep"
    for part in ("<a ", "<a '>", "<script ", "</script ", "<p><span>", "<article>", "</x><div>", '<div class="ad">', "<!--", "<b><i></b>", "&amp", "<div>x</div><ul><li>y</li></ul>"):
        page = part * (1_000_000 // len(part))
        began = time.perf_counter()
        extraction.Page(page)
        assert time.perf_counter() - began < 20, part
    many = extraction.Page("<body>" + "<div>x</div><ul><li>y</li></ul>" * 20_000)
    began = time.perf_counter()
    assert extraction._aligned(many.outline, many.outline) and time.perf_counter() - began < 20


def test_alignment_by_rank_keeps_order_of_kinds():
    a = extraction.Page("<body>" + "".join(f"<h2>t{i}</h2><p>x{i}</p>" for i in range(300)))
    exact = extraction.match(a.outline, a.outline, [10**9])
    quick = extraction.match(a.outline, a.outline, [0])
    assert exact[0] == quick[0] and [x[0][0] for x in quick[1]].count("h2 ") == 300


def test_every_article_and_plain_words_stay():
    page = '<article><p>one</p><table class="share-price-table"><tr><td>two</table></article><article><h2 class="related-work">three</h2><p class="alert-level">four</p><div class="search-algorithms">five</div></article>'
    assert extraction._text(page) == "one\ntwo\nthree\nfour\nfive"
