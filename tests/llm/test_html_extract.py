"""Main-text extraction on hand-made pages."""
import random
from collections import Counter

import pytest

from forgeline.llm import common
from forgeline.llm.html_extract import DOUBT, Page, extract

ARTICLE = "<article><h1>T &amp; U</h1><p>One <b>two</b>th ree&nbsp;four.<p>Five &lt; six <a href=x>seven</a>, eight nine ten.<ul><li>a b<li>c d</ul></article>"
TEXT = "T & U One twoth ree four. Five < six seven, eight nine ten. a b c d"
NOISE = """<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>{}<aside>side</aside><div id="sidebar">more</div>
<section id="comments"><p>A long reader comment that goes on and on and on and on.</p></section><form>Name <input></form><footer>&copy; me</footer>"""


def best(source):
    page = Page(source)
    scores = page.scores()
    return page.text(max(scores, key=scores.get, default=None))


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain words", "plain words"), ("<p>a<br>b<p>c", "a b c"), (f"<html><body>{ARTICLE}</body></html>", TEXT),
    (f"<body class='has-sidebar'>{NOISE.format(ARTICLE)}</body>", TEXT),
    (f"<BODY>{NOISE.format(ARTICLE.replace('article', 'DIV'))}", TEXT),
    ("<div class=post><div class=ad-box>Buy</div><p>x <!-- no --> y</p><script>if(a<b)'</p>'</script><style>p{}</style><p>z</div>", "x y z"),
    ("<article><header><h2>Head</h2><span>by me</span></header><section><p>one two three</section><section><p>four five six</section><p>end</article>", "Head one two three four five six end"),
    ("<p title='a>b'>in</p><p title=\"unclosed>out</p><p>more", "in out more"), ("<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p>yes", "yes"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<!-- never closed <p>x", ""), ("a &#8364; &notit; &eacute;", "a € ¬it; é"),
])
def test_pages(source, text):
    assert best(source) == text


@pytest.mark.parametrize("source, text", [
    ("<div class='text share-text'>the whole long article</div><p>tail</p>", "the whole long article tail"),
    ("<div class='text share-text'>buttons</div><p>the whole long article</p>", "the whole long article"),
    ("<article><h1 class=banner-title>Head</h1><p>body</p></article>", "Head body"),
    ("<p>short</p><div class='content comments'>a very long exchange of comments</div>", "short"),
    ("<div class='post promo'><nav>menu menu menu menu</nav>article text <div class=share>x</div></div><div class='post ad'>advert</div>", "article text"),
])
def test_class_words_and_what_an_element_holds(source, text):
    assert Page(source).text(None) == text


def test_a_large_host_and_copies_are_dealt_by_row(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    rows = [(i, f"http://{'big' if i % 3 else i}.example/", ARTICLE) for i in range(40)]
    assert {(r["page_id"], r["text"]) for r in extract(pages(spark, rows)).collect()} == {(i, TEXT) for i in range(40)}


@pytest.mark.parametrize("hot", [2, 100_000])
def test_votes_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    draw = random.Random(9)
    words = lambda n: " ".join(draw.choice(["red", "tide", "warm", "sea"]) for _ in range(n))
    rows = []
    for i in range(90):
        blocks = [f"<div class='{draw.choice(['a', 'b', 'c', f'x{i}', f'{chr(97 + i % 26)}q'])}'><p>{words(draw.randrange(1, 40))}</p></div>" for _ in range(draw.randrange(5))]
        rows.append((i, f"http://{draw.choice(['h', 'h', 'k', f'n{i}'])}.example/{i}", f"<body>{''.join(blocks)}</body>"))
    rows += [(100 + i, rows[4][1], rows[4][2]) for i in range(20)]
    total, n = Counter(), Counter()
    for _i, url, source in rows:
        for path, share in Page(source).shares().items():
            total[url.split("/")[2], path] += share
            n[url.split("/")[2], path] += 1
    got = {r["page_id"]: (r["path"], r["text"]) for r in extract(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, url, source in rows:
        host, page = url.split("/")[2], Page(source)
        means = {p: total[host, p] / (n[host, p] + DOUBT) for p in page.shares()}
        path, text = got[i]
        assert text == page.text(path)
        assert (path is None) == (not means)
        assert not means or means[path] == pytest.approx(max(means.values()), rel=1e-9)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_hosts_agree_on_a_path(spark, clashing):
    body = "word " * 60
    good = [(i, f"https://h.example/{i}", f"<body><div class='main-{i}'><p>{body}{i}</p></div><div class='box'><p>short note {i}</p></div></body>") for i in range(12)]
    odd = (50, "https://h.example/odd", f"<body><div class='main-50'><p>brief but main</p></div><div class='box'><p>{'noise ' * 8}</p></div></body>")
    got = {r["page_id"]: r["text"] for r in extract(clashing(pages(spark, [*good, odd]))).collect()}
    assert got[3] == (body + "3").strip() and got[50] == "brief but main"
    alone = extract(pages(spark, [odd])).first()["text"]
    assert alone.startswith("noise")  # without the host's votes the page's own best container wins


@pytest.mark.parametrize("source, text", [
    ("<body><article><h1>T</h1><div class=wrap><div class=content><p>{}</p></div></div><p>End</article><div>other</div>", "T {} End"),
    ("<body><main><h1>T</h1><p>Lead<div class=content><p>{}</p></div></main><div>other</div>", "T Lead {}"),
    ("<body><div class=page><div class=post><h1>T</h1><p>Lead</p><div class=content><p>{}</p></div></div><div class=list><a href=x>link</a></div></div>", "T Lead {}"),
    ("<body><article><h1>T</h1><div class=content><p>{}</p></div><div class=related>no</div></article><article class=teaser><p>teaser</p></article>", "T {}"),
])
def test_text_outside_inner_wrappers_is_kept(spark, source, text):
    body = "word " * 200 + "end"
    rows = [(i, f"http://h.example/{i}", source.format(body)) for i in range(4)]
    assert {r["text"] for r in extract(pages(spark, rows)).collect()} == {text.format(body)}


def test_nulls_repeats_long_pages_and_empty_table(spark):
    long = "<article>" + "<p>long text here</p>" * 20000 + "</article>"
    rows = [(1, None, None), (2, "no url", ""), (3, "http://[bad/", "<p>x</p>"), (4, "http://u:p@H.example:80/a", ARTICLE), (4, "http://u:p@H.example:80/a", ARTICLE), (None, "http://h.example/", long), (6, "http://h.example/", "<div>" * 3000 + "deep")]
    got = sorted((str(r["page_id"]), len(r["text"])) for r in extract(pages(spark, rows)).collect())
    assert got == sorted([("1", 0), ("2", 0), ("3", 1), ("4", len(TEXT)), ("4", len(TEXT)), ("None", 15 * 20000 - 1), ("6", 4)])
    assert extract(pages(spark, [])).count() == 0
