import html as entities
import os
import random
import re
from collections import Counter

import pytest

from pairloom.llm import html_text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div class="x">a<b>b</b>c<br>d</div><div class=menu>zz</div>', "abc d"),
        ("plain &amp; text", "plain & text"),
        ("", ""),
        ("<!-- a", ""),
        ('<p title="a>b">q</p>', "q"),
        ("a < b <3", "a < b <3"),
        ('<article><p>x</p><section class="comments"><p>no</p></section>y</article>tail', "x y"),
        ('<article><p>a<span class="ad">no</span>b</p></article>', "a b"),
        ("<main><h1>T</h1><p>x \n\t y</p><aside>no</aside></main><footer>no</footer>", "T x y"),
        ('<header>no</header><div>yes yes</div><form>no</form><div role="navigation">no</div>', "yes yes"),
        ('<article><p>One <script>var a="<p>x</p>"</script>two<style>p{}</style><p>three</article>', "One two three"),
        ("<article><p>&lt;b&gt; &#65;&#x42;&eacute;</p><ul><li>i<li>j</ul></article>", "<b> ABé i j"),
        ("<body><article><p>unclosed <b>bold<p>next", "unclosed bold next"),
        ('<nav><ul><li>m</li></ul></nav><main><article>a</article><article class="comment">c</article></main>', "a"),
    ],
)
def test_main_text(page, text):
    assert html_text.Page(page).main_text() == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<body><h1>Title</h1><div class="content"><p>more than it</p></div></body>', "Title more than it"),
        ("<main>body text <article>teaser</article> end</main>", "body text teaser end"),
        ("<article>one</article>tail<main>two</main>", "one two"),
    ],
)
def test_all_slots_in_page_order(page, text):
    assert html_text.Page(page).main_text() == text


def test_every_slot_of_a_template(spark):
    page = lambda k: f'<body><div class="top">All pages say this</div><div class="lead">Lead {k}</div><div class="body"><p>Body {k} is longer</p></div></body>'
    got = html_text.main_texts(pages(spark, [(k, f"http://h.example/{k}", page(k)) for k in range(6)])).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: f"Lead {k} Body {k} is longer" for k in range(6)}


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")


def test_template_without_an_article(spark):
    page = lambda k: f'<html><body><div class="top"><p>Our site has the very same long words on all of its pages, again and again</p></div><div class="body"><p>Page {k} says this</p><p>and more {k}</p></div></body></html>'
    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(6)] + [(9, "http://other.example/", page(9))]
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(pages(spark, rows)).collect()}
    assert {got[k] for k in range(6)} == {f"Page {k} says this and more {k}" for k in range(6)}
    assert got[9].startswith("Our site")  # a lone page has no template


def test_copies_of_an_article_stay_whole(spark):
    rows = [(k, f"http://h.example/{k}", "<body><nav>m</nav><article><p>The same article</p></article></body>") for k in range(10)]
    assert {r["text"] for r in html_text.main_texts(pages(spark, rows)).collect()} == {"The same article"}


def test_templates_find_the_text_without_article_tags(spark):
    """The same text on every page whether its element is called article or div, and against a plain deduction."""
    rnd = random.Random(3)
    some = lambda n: " ".join("".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(n))
    rows = []
    for k in range(40):
        nav, body = "".join(f"<li>{some(1)}</li>" for _ in range(4)), "".join(f"<p>{some(rnd.randint(5, 40))}</p>" for _ in range(rnd.randint(1, 6)))
        rows.append((k, f"http://h{k % 3}.example/{k}", f"<html><body><nav><ul>{nav}</ul></nav><div class=slogan>We say the same on all pages</div><article><h1>{some(4)}</h1>{body}</article><div class=about>Written by us all</div><footer>{some(3)}</footer></body></html>"))
    rows += [(100 + k, "http://h0.example/copy", rows[0][2]) for k in range(5)]
    renamed = [(i, u, h.replace("<article>", "<div>").replace("</article>", "</div>")) for i, u, h in rows]
    one = {r["page_id"]: r["text"] for r in html_text.main_texts(pages(spark, rows)).collect()}
    two = {r["page_id"]: (r["text"], r["template_tokens"]) for r in html_text.main_texts(pages(spark, renamed)).collect()}
    assert one == {i: t for i, (t, _) in two.items()}
    assert one == {i: " ".join(re.sub("<[^>]*>", " ", re.search("<article>(.*)</article>", h)[1]).split()) for i, _, h in rows}
    for host in range(3):  # classes by their definition: equal counts on every page
        own = [html_text.Page(h) for i, u, h in renamed if u.startswith(f"http://h{host}.")]
        count = Counter()
        vectors = {}
        for at, page in enumerate(own):
            for token, n in [(html_text.PAGE, 1), *page.elements.items(), *Counter(html_text.text_token(e.node, t) for e, t in page.blocks).items()]:
                vectors.setdefault(token, {})[at] = n
        for v in vectors.values():
            count[tuple(sorted(v.items()))] += 1
        size = sum(n for v, n in count.items() if len(v) >= html_text.SUPPORT and n >= html_text.CLASS_SIZE)
        assert {two[i][1] for i, u, _ in renamed if u.startswith(f"http://h{host}.")} == {size}


def test_repeated_rows_cancel_nothing(spark):
    """A token on pages 0, 0 and 2 and one on 1, 1 and 2 are of different classes, though each is on three rows."""
    texts = [("x",), ("y",), ("x", "y")]
    page = lambda k: "<body>" + "".join(f"<p>{t} is here</p>" for t in texts[k]) + f"<p>{k} of its own, and longer than that by far</p></body>"
    rows = [(k, "http://h.example/", page(k)) for k in (0, 0, 1, 1, 2)]
    # both texts are on three of five rows: of one class they would be fixed text
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(pages(spark, rows)).collect()}
    assert got[0].startswith("x is here") and got[1].startswith("y is here")


@pytest.mark.parametrize(
    "html",
    [
        '<article class="post type-post comments-open"><p>Long body text</p></article>',
        '<article class="tag-search category-form"><p>Long body text</p></article>',
        '<div class="has-sidebar content"><p>Long body text</p></div>',
        '<p>Long <a class="search-link" href="/s">body</a> text</p>',
        '<p>Long body text</p><div class="cookie-banner">x</div><div id="comments" class="comments-area"><article class="comment">y</article></div>',
    ],
)
def test_names_of_the_surroundings_reject_nothing(spark, html):
    assert html_text.main_texts(pages(spark, [(1, "http://h.example/", f"<body>{html}</body>")])).first()["text"] == "Long body text"


def test_articles_come_through_the_slot(spark):
    """Fixed text within articles goes, and a byline of each page stays; other slots outside the article don't."""
    page = lambda k: f"<body><p>Tip {k} of the day</p><article><h2>By author {k}</h2><div class=text><p>Body {k}, {'very ' * 200}long and different {k}</p></div><p>Follow us all</p></article></body>"
    rows = [(k, "http://h.example/", page(k)) for k in range(8)]
    for r in html_text.main_texts(pages(spark, rows)).collect():
        k = r["page_id"]
        assert r["text"] == f"By author {k} Body {k}, {'very ' * 200}long and different {k}"


def test_large_sets_of_hosts_and_text_outside_the_slot(spark, monkeypatch):
    page = lambda k: f'<body><div class="top">All pages say this</div><div class="text"><p>Body {k} is very much longer than what stands above it, on every page of this host {k}</p></div></body>'
    rows = [(k, f"http://h{k % 2}.example/{k}", page(k)) for k in range(8)]
    few = {r["page_id"]: r["text"] for r in html_text.main_texts(pages(spark, rows)).collect()}
    assert all(t.startswith("Body") for t in few.values())
    monkeypatch.setattr(html_text, "BROADCAST_HOSTS", 0)
    assert {r["page_id"]: r["text"] for r in html_text.main_texts(pages(spark, rows)).collect()} == few


def test_deep_pages(spark):
    html = "<div>" * 20000 + "deep" + "</div>" * 20000
    got = html_text.main_texts(pages(spark, [(k, "http://d.example/", html + f"<p>{k}</p>") for k in range(4)])).collect()
    assert {r["text"] for r in got} == {str(k) for k in range(4)}  # what stands on all pages is the template's


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", "<article>" + "word " * 50000), (4, "http://a/", "<p>a"), (4, "http://a/", "<p>a"), (None, None, "<" * 20000), (5, "http://a/", "<div " * 5000), (6, "http://a/", '<a href="' * 3000)]
    got = html_text.main_texts(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert (by[1]["text"], by[1]["n_chars"], by[2]["text"], by[4]["text"]) == ("", 0, "", "a")
    assert by[3]["n_chars"] == 50000 * 5 - 1
    assert html_text.main_texts(pages(spark, rows).limit(0)).count() == 0


def test_query(spark):
    from .conftest import DATA

    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in html_text.op2_html_text(spark, DATA).collect():
        body = re.search("<article>(.*?)(</article>|$)", source[r["page_id"]], re.S)[1]
        blocks = (" ".join(entities.unescape(b).split()) for b in re.split(r"</?(?:p|h1|br|b)>", body))
        assert r["text"] == " ".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
