import pytest

from tertulia.operators import bronze, pages
from tertulia.plans.bronze import articles_from_html

HOST = "https://news.example"
LISTING = """
<html><body><!-- x --><script>var a = "<article data-post-id='9'>";</script>
<article data-post-id="1" class="post tag-paz-total tag-ley">
  <h2 class="entry-title"><a href=" https://news.example/a ">Una <b>nota</b> &amp; m&aacute;s</a></h2>
  <span class="author vcard"><a href="/x">Ana</a></span><time class="entry-date" datetime="2026-04-26T21:47:13-05:00">abril</time>
  <div class="entry-wrapper"><p>%s</p><p>otro</p></div>
</article>
<article data-post-id="2"><h2 class="entry-title">sin enlace</h2></article>
<article data-post-id="3" class="x"><h2 class="entry-title"><a href="https://news.example/a">Repetida</a></h2>
  <span class="vcard author"><a>Beto</a></span><time class="entry-date"> mayo </time></article>
<article data-post-id="4"><h2 class="entry-title"><a href="https://news.example/b"> </a></h2></article>
<article data-post-id="5"><h2 class="entry-title"><a href="https://news.example/b">Tarde</a></h2></article>
<article data-post-id="6"><h2 class="entry-title"><a href="https://news.example/c">Ce</a></h2><div class="entry-wrapper">
  <p>uno<p>dos</div></article>
<article><h2 class="entry-title"><a href="https://news.example/d">sin id</a></h2></article>
<div class="nav-links"><a class="next page-numbers" href="/2">&raquo;</a></div></body></html>
""" % ("e" * 350)
DETAIL = """<article><div class="post entry-content"><p> Uno <i>dos</i></p><style>p{}</style>tres<br>cuatro
<div>cinco</div></div><a rel="tag">Paz</a><a rel="nofollow tag"> Ley </a><a rel="tag">Paz</a><a rel="tag"></a></article>"""


def table(spark, *html):
    return spark.createDataFrame([(n, h) for n, h in enumerate(html, 1)], "page int, html string")


def test_listing(spark):
    rows = pages.extract_listing(table(spark, LISTING), keep=["page"]).collect()
    assert [(r.item_pos, r.url[-1], r.title) for r in rows] == [
        (0, "a", "Unanota& más"), (2, "a", "Repetida"), (3, "b", ""), (4, "b", "Tarde"), (5, "c", "Ce")]
    first, third, last = rows[0], rows[1], rows[4]
    assert (first.author, first.date, first.excerpt, first.tags) == (
        "Ana", "2026-04-26T21:47:13-05:00", "e" * 300, "paz total, ley")
    assert (third.author, third.date, third.excerpt, third.tags) == ("", "mayo", "", "")
    assert last.excerpt == "uno"


def test_first_seen_over_pages(spark):
    cards = pages.extract_listing(table(spark, LISTING, LISTING), keep=["page"])
    got = bronze.first_seen_url(cards, ["page", "item_pos"]).collect()
    assert sorted((r.page, r.title) for r in got) == [(1, "Ce"), (1, "Unanota& más")]


def test_detail(spark):
    rows = pages.extract_detail(table(spark, DETAIL, "<p>nada</p>", None)).collect()
    assert [(r.body, r.tags) for r in rows] == [("Uno dos tres cuatro cinco", "Paz, Ley"), ("", ""), ("", "")]


def test_body_and_tag_fallbacks(spark):
    long = "palabra " * 20
    html = [
        f'<div class="post-content">corto</div><div class="entry-content">{long}</div><a rel="tag">x</a><a rel="tag">x</a>',
        f'<article><p>{long}</p><p>fin</p></article><span class="tags-links"><a rel="tag">a</a><a rel="tag">a</a></span>',
        f'<div class="story-body-text">{long}</div>',
        "<article>corto</article>",
    ]
    rows = pages.article_fields(table(spark, *html)).collect()
    assert [r.body for r in rows] == [long.strip(), long.strip() + "\n\nfin", long.strip(), ""]
    assert [r.tags for r in rows] == ["x", "a, a", "", ""]


def test_cards_by_alternatives(spark):
    html = [
        '<article><h3>T1</h3><a href="/u1">m</a><p>corto</p><div class="excerpt">un resumen de mas de veinte</div>'
        '<div class="byline">Ana</div><time datetime="">hoy</time></article>'
        '<article><h2></h2><h3>oculto</h3></article>',
        '<div class="card"><div class="title">T2</div></div><div class="news-article-x"><h1>T3</h1><a href="http://x">y</a></div>',
        '<h3><a href="http://y">T5</a></h3><h2><a href="/u4">T4</a></h2><h2><a href="/u6"></a></h2>',
    ]
    rows = pages.extract_cards(table(spark, *html), host=HOST, keep=["page"]).collect()
    assert [(r.page, r.title, r.author, r.date, r.url, r.excerpt) for r in rows] == [
        (1, "T1", "Ana", "hoy", HOST + "/u1", "un resumen de mas de veinte"),
        (2, "T2", "", "", "", ""), (2, "T3", "", "", "http://x", ""),
        (3, "T5", "", "", "http://y", ""), (3, "T4", "", "", HOST + "/u4", "")]


def test_next_page(spark):
    html = [LISTING, '<nav class="pagination"><a class="next">x</a></nav>', '<a class="page-numbers">2</a>',
            '<a rel="next" href="/siguiente">x</a>']
    rows = pages.next_page(table(spark, *html), HOST + "/opinion/", host=HOST).collect()
    assert [(r.has_next, r.next_url) for r in rows] == [
        (True, HOST + "/opinion/page/2/"), (True, HOST + "/opinion/page/3/"), (False, HOST + "/opinion/page/4/"),
        (False, HOST + "/siguiente")]


def test_unsupported_selector(spark):
    from tertulia.functions.html import html_fields

    with pytest.raises(ValueError):
        html_fields("html", {"x": ((), {"y": [("a > b", "text")]})})


def test_articles_from_html(spark):
    details = spark.createDataFrame([("https://news.example/a", DETAIL)], "url string, html string")
    rows = articles_from_html(table(spark, LISTING), details, "news", "20260101_000000", ["page"]).orderBy("url").collect()
    assert [(r.titulo, r.etiquetas, r.contenido, r.extracto[:3]) for r in rows] == [
        ("Unanota& más", "Paz, Ley", "Uno dos tres cuatro cinco", "eee"), ("Ce", "", "", "uno")]


def test_pages_are_sent_to_python_few_at_a_time(spark):
    """Thousands of long pages in one batch would be held at once, with all their fields."""
    key, df = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.createDataFrame([(1, "<p>x</p>")], "page int, html string")
    before = spark.conf.get(key)
    try:
        for read in (pages.extract_listing, pages.extract_cards, pages.page_errors, pages.article_fields, lambda p: pages.next_page(p, "/x/")):
            spark.conf.set(key, "10000")
            read(df)
            assert int(spark.conf.get(key)) == 256
        spark.conf.set(key, "7")  # what the session has smaller stays
        pages.extract_listing(df)
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.set(key, before)
