import pytest

from lamina.llm import html

STORY = "It was said, on that day, that the river had risen again. Nobody knew why, or when it would fall. "


@pytest.fixture(scope="module")
def field(spark):
    return html.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def text(field, page):
    found = html.blocks(page)
    return [t for (t, _), s in zip(found, field.decode(found), strict=True) if s]


def test_pages_against_their_markup(spark, field):
    """The given pages mark their article; the field must find exactly that."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html.extract(pages, field).collect()}
    for r in pages.collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        want = "\n\n".join(t for t, _ in html.blocks(inner))
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize("around", [
    '<div class="cookie-notice"><p>{0}</p></div>', '<div id="comments"><h3>Comments</h3><div class="comment"><p>{0}</p></div></div>',
    "<aside><p>{0}</p></aside>", '<form class="signup"><p>Subscribe</p><label>Mail</label></form>', "<header><p>The Daily</p></header>",
    '<div class="sidebar"><ul><li><a href="#">One</a></li><li><a href="#">Two</a></li></ul></div>',
    '<div class="advert">{0}</div>', "<footer>&copy; The Daily</footer>", '<section class="related-links"><p>More</p></section>'])
@pytest.mark.parametrize("holder", ["<article>{}</article>", '<div class="content">{}</div>', "<main>{}</main>"])
def test_other_templates(field, around, holder):
    other = around.format(STORY)
    body = f"<h1>The river</h1><p>{STORY}</p><p>{STORY * 2}</p><p>{STORY}</p>"
    want = ["The river", STORY.strip(), (STORY * 2).strip(), STORY.strip()]
    assert text(field, f"<body><nav><a href='/'>Home</a></nav>{holder.format(body)}{other}</body>") == want


HEAD = "<html><head><title>News</title><meta charset=utf-8><script>x < y</script>"


@pytest.mark.parametrize("page", [
    HEAD + "<body><p>one<p>two", HEAD + "<p>one<p>two", HEAD + "</head><body><p>one<p>two", "<head><body><p>one<p>two",
    HEAD + "<style>p{}</style><link rel=x><noscript><img src=x></noscript><body><p>one</p><p>two</p></body></html>",
    HEAD + "<template><p>not this</p></template><body><p>one<p>two", HEAD + "<div><p>one</p><b>two</b></div>"])
def test_a_head_without_an_end(page):
    assert [t for t, _ in html.blocks(page)] == ["one", "two"]


def test_an_article_behind_an_open_head(field):
    body = f"<h1>The river</h1><p>{STORY}</p><p>{STORY * 2}</p>"
    want = text(field, f"{HEAD}</head><body><article>{body}</article></body>")
    assert want and text(field, f"{HEAD}<body><article>{body}</article></body>") == want
    assert text(field, f"{HEAD}<article>{body}</article>")


def test_edge_pages(spark, field):
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", "<html></html>", 5), (4, "u", "no markup here", 5), (5, "u", "<p>" * 3000 + "x", 5),
            (6, "u", "<article><p>" + "Long text, and so on. " * 20_000, 5), (6, "u", "<div><", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html.extract(df, field).collect()]
    assert len(got) == 7 and all(n == len(t) for *_, t, n in got)
    assert {t for i, _, t, _ in got if i <= 3} == {""}
    assert max(n for i, *_, n in got if i == 6) == len("Long text, and so on. " * 20_000) - 1
    assert html.extract(df.limit(0), html.train(df.limit(0))).count() == 0
