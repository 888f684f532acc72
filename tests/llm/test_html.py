from pyspark.sql import functions as F

from msalake.llm import html

PAGE = ('<!DOCTYPE html><html lang="fr"><head><meta charset="utf-8"><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";track(0);</script></head>'
        '<body><nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad 0 --><div class="ad">Buy.</div><article><h1>Head  &amp; line </h1><p><b>One\n two.<br>'
        'three<p>Four&nbsp;&#x41;.</p><div class="share-box">share</div><p>a &lt; b</p><section id="comments"><p>first!</p></section></article>'
        '<footer>&copy; me</footer></body></html>')


def text(page):
    article, other, _ = html.parse(page)
    return "\n\n".join(article if article is not None else [t for _, t in other])


def test_article():
    assert text(PAGE) == "Head & line\n\nOne two. three\n\nFour A.\n\na < b"
    assert text(PAGE.replace("</body></html>", "")) == text(PAGE)
    assert text("<main><header><h1>T</h1></header><form>f</form><aside>x</aside><p title='a>b'>in <i>line</i></p><table><tr><td>1<td>2<tr><td>3</table></main><p>out") == "T\n\nin line\n\n1 2\n\n3"
    assert text("<div class=article-body><p>a<!-- unclosed") == "a" and text("plain &eacute; text") == "plain é text"
    assert text("<article>x<script>never closed <p>y") == "x" and text("") == "" and text("<p></p><br>") == ""
    assert text("<article><ul><li>a<li>b <b>c</b></ul></article>") == "a\n\nb c"
    assert text("<div>" * 5000 + "deep" + "</div>" * 10) == "deep" and text("<<>< a <3 b") == "<<>< a <3 b"


def test_style_tree(spark):
    """Without a marked article the host's tree decides; a host of few pages keeps what does not name itself as noise."""
    def page(i, host):
        return (i, f"http://{host}/{i}", f'<body><div class="top">Same words everywhere</div><div class="txt"><p>Story {host} {i}</p><p>More of {i}</p></div>'
                                       f'<div class="low">Rights {i % 2}</div><div class="menu">m</div></body>')
    rows = [page(i, "a.org") for i in range(40)] + [page(100, "b.org"), page(7, "a.org"), (200, None, None), (201, "x", ""), (None, "http://a.org/n", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1)).repartition(3)
    got = html.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert all(by[i] == f"Story a.org {i}\n\nMore of {i}" for i in range(40))
    assert by[100] == "Same words everywhere\n\nStory b.org 100\n\nMore of 100\n\nRights 0"
    assert by[200] == "" and by[201] == "" and by[None].startswith("Head & line")
    assert html.extract(df.limit(0)).count() == 0


def test_style_tree_judges_pages_that_mark_their_article(spark):
    """A box that reads the same in all articles of a host goes; a shared heading stays, and so do the articles of a host of copies."""
    def page(i):
        return (i, f"http://a.org/{i}", f'<body><article><h1>Same title</h1><p>Story {i}</p><div class="end"><p>Read on in our shop.</p></div><h2>Sources</h2><p>Book {i}</p></article></body>')
    copies = [(100 + i, f"http://c.org/{i}", page(0)[2]) for i in range(30)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame([page(i) for i in range(20)] + copies, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(got[i] == f"Same title\n\nStory {i}\n\nSources\n\nBook {i}" for i in range(20))
    assert all(got[100 + i] == "Same title\n\nStory 0\n\nRead on in our shop.\n\nSources\n\nBook 0" for i in range(30))
