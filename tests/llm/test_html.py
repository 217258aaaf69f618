from __future__ import annotations

import random
import re
import time

import pytest

from tidebook.llm import html_main as h

ARTICLE = (
    "<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>"
    "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "<div id=wrap><article class='post-{n}'><h2>Head &amp; more</h2><p>First\n   paragraph with <b>bold</b>text.<br>Next"
    "<p>Second &lt;one&gt; {body}</p><ul><li>item one<li>item two</ul><form>name</form></article>"
    "<aside>Related things</aside><div class=\"comments\"><p>A reader says a long thing, longer than anything else.</p></div></div>"
    "<script>var a = '</p><p>no</p>';</script><footer>&copy; us</footer></body></html>"
)


def page(n: int, body: str = "and its words") -> str:
    return ARTICLE.replace("{n}", str(n)).replace("{body}", body)


MAIN = "Head & more\n\nFirst paragraph with boldtext. Next\n\nSecond <one> and its words\n\nitem one\n\nitem two"


def table(spark, rows):
    schema = "page_id long, url string, html string, host string, path string, main_text string"
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)


def found(spark, rows):
    frame = h.extract(table(spark, rows))
    assert {"host", "path", "html"} <= set(frame.columns)
    return {r.page_id: r.main_text for r in frame.collect()}


def test_article_of_a_host(spark):
    rows = [(i, f"https://www.News.example:80/{i}?q", page(i)) for i in range(8)]
    rows.append((50, "http://user@news.example/x", page(9, "")))
    rows.append((51, "http://news.example/e", "<body><div class=ad>An advert of more than twenty letters.</div><article></article></body>"))
    rows.append((52, "http://news.example/odd", "<body><div><p>A page of another kind, without the container of others.</p></div></body>"))
    rows += [(60, None, None), (61, "http://news.example/n", ""), (62, "not a url", "just text"), (63, "http://other/", "<p>x</p")]
    got = found(spark, rows)
    assert all(got[i] == MAIN for i in range(8))
    assert got[50] == MAIN.replace(" and its words", "")
    assert got[51] == ""
    assert got[52] == "A page of another kind, without the container of others."
    assert got[60] == got[61] == ""
    assert got[62] == "just text"


def test_consensus_outvotes_one_page(spark):
    usual = "<body><div class=main-3><p>{}</p></div><div class=extra><p>Short note of the site itself.</p></div></body>"
    rows = [(i, "http://a/", usual.format("Some main text of this page, long enough. " * 4)) for i in range(5)]
    rows.append((9, "http://a/", usual.format("Brief main text, yes.").replace("site itself.", "site itself. " * 20)))
    assert found(spark, rows)[9] == "Brief main text, yes."


def test_empty_table_and_hot_host(spark):
    assert found(spark, []) == {}
    rows = [(i, "http://hot/" if i % 3 else f"http://h{i}/", page(i)) for i in range(150)]
    assert set(found(spark, rows).values()) == {MAIN}


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p>a<p>b", "a\n\nb"),
        ("<div title='x>y'>a</div>b", "a\n\nb"),
        ("a<!-- c <p> -->b<!-- open", "ab"),
        ("<script>x", ""),
        ("<p>1 < 2 &#233; &unknown; &nbsp;z</p>", "1 < 2 é &unknown; z"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("</p></div>a<b>b</i>c</b>", "abc"),
        ("<DIV CLASS=\"Sidebar2\">no</DIV><P>yes</P>", "yes"),
        ("<div" + " x='" * 3000, ""),
    ],
)
def test_markup(source, text):
    page_ = h.Page(source)
    assert "\n\n".join(t for _, t, _ in page_.blocks) == text


def test_deep_and_long_pages_end():
    assert h.main_text("<div>" * 3000 + "text " * 100_000, None).count("text") == 100_000
    assert h.main_text("<p><span>a " * 50_000, None).count("a") == 50_000
    assert h.main_text("<div class='x'><span>a " * 50_000, None).count("a") == 50_000


def test_article_classes_that_differ_on_a_host(spark):
    usual = "<body><article class='post {}'><h1>Title</h1><p>{}</p></article></body>"
    body = "The text of this page, which is long enough to count."
    rows = [(i, "http://c/", usual.format("category-news", body)) for i in range(5)]
    rows.append((6, "http://c/", usual.format("category-sport format-video", body)))
    rows.append((7, "http://c/", f"<body class=x><!-- <article> --><div><p>{body}</p></div></body>"))
    rows.append((8, "http://c/", f"<body><article class='post category-news'></article><div><p>{body}</p></div></body>"))
    got = found(spark, rows)
    assert got[0] == got[6] == f"Title\n\n{body}"
    assert got[7] == body
    assert got[8] == ""


P, LI = "<p>" + "paragraph " * 40 + "</p>", "".join(f"<li>item {i} of a list with some words</li>" for i in range(40))


@pytest.mark.parametrize(
    "inner",
    [
        f"<h1>Head</h1>{P}<ul>{LI}</ul>",
        f"<h1>Head</h1>{P}<blockquote>{P * 4}</blockquote><p>Last words.</p>",
        f"<h1>Head</h1>{P}<table>{''.join(f'<tr><td>cell {i} of the table, and more</td></tr>' for i in range(50))}</table>",
        f"<section class=lead>{P}</section><section class=body><h2>Next</h2>{P * 3}</section>",
        f"<h1>Head</h1><div class=body>{P * 3}</div>",
        "".join(f"<div class='part{chr(97 + i)}'>{P}</div>" for i in range(9)),
    ],
)
@pytest.mark.parametrize("outer", ["article", "div"])
def test_no_part_of_the_container_wins_over_it(inner, outer):
    source = f"<body><nav>Menu</nav><div class=wrap><{outer}>{inner}</{outer}></div><footer>Foot</footer></body>"
    whole = "\n\n".join(t for _, t, _ in h.Page(source).blocks)
    assert h.main_text(source, None) == whole
    shares = h.Page(source).shares()
    assert h.main_text(source, max(shares, key=shares.get)) == whole
    other = source.replace(inner, f"<h1>Other</h1>{P}<ul><li>one</ul>")
    if outer == "article":
        assert h.main_text(other, max(shares, key=shares.get)).startswith("Other")


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ("<h2 id='related-work'>a</h2><h2 id=legal>b</h2><p id='search'>c</p>", "a\n\nb\n\nc"),
        ("<section id='legal-history'><p>a</p></section><p class='notice-period'>b</p>", "a\n\nb"),
        ("<div id='search-results-we-found'>a</div><div class='content-with-sidebar'>b</div>", "a\n\nb"),
        ("<div class='share-buttons'>a</div><div id=related>b</div><div class='ad-300x250 big'>c</div>d", "d"),
        ("<div role='navigation'>a</div><div class='post-comments'>b</div><div id='skip-link'>c</div>d", "d"),
        ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p>", "a x=1 b"),
        ("<object data=x><param name=y>a</object><canvas>b</canvas>", "ab"),
        ("<div><svg><path d='M0'/><text>no</text></svg>a</div>b", "a\n\nb"),
        ("<div><svg><path d='M0'>no</div><p>a</p>", "a"),
        ("<svg><g><text>no<p>a</p><math><mi>x<p>b</p>", "a\n\nx\n\nb"),
        ("<svg><foreignObject><div>no</div></foreignObject></svg>a", "a"),
        ("<object><p>a</p></div><canvas><div>b</div>c", "a\n\nb\n\nc"),
    ],
)
def test_only_named_parts_are_left_out(inner, text):
    page_ = h.Page(f"<body><article>{inner}</article></body>")
    assert "\n\n".join(t for _, t, _ in page_.blocks) == text


@pytest.mark.parametrize("tag", ["div", "blockquote", "span"])
@pytest.mark.parametrize("n", [150, 250, 3000])
def test_end_tags_match_at_any_depth(tag, n):
    nested = f"<{tag}>" * n + "deep<div class=ad>advert</div><!-- c -->words" + f"</{tag}>" * n
    article = f"<article><div class=body><p>First paragraph of it.</p>{nested}<p>After that it goes on.</p></div></article>"
    page_ = h.Page(f"<body><div>{article}</div><footer>no</footer></body>")
    text = "\n\n".join(t for _, t, _ in page_.blocks)
    assert text == "First paragraph of it.\n\ndeep\n\nwords\n\nAfter that it goes on."
    assert page_.text_of("page>body>div>article") == text


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 100_000 + "</section>a" * 50_000,
        "<b><div>" + "<x>" * 100_000 + "</b>a<hr>" * 50_000,
        "<li>" + "<x>" * 100_000 + "a<hr>" * 50_000,
        "<div class='x'>a" * 100_000 + "</div>" * 100_000,
        "<svg>" * 100_000 + "<p>a" * 50_000,
    ],
)
def test_deep_markup_takes_no_square_time(source):
    started = time.process_time()
    assert h.main_text(source, None).count("a") >= 50_000
    assert time.process_time() - started < 20


LEFT = "Words that are not of the article, though they are many of them. "


@pytest.mark.parametrize(
    "outside",
    [
        "<div class='user-comments'>{}</div>", "<section class='reader-comments'><p>{}</p></section>",
        "<div class='comment-thread'>{}</div>", "<ol class='commentlist'><li>{}</ol>", "<div class='commentList'>{}</div>",
        "<div class='sponsored-content'>{}</div>", "<div class='adsbygoogle'>{}</div>", "<div class='x dfp-ad'>{}</div>",
        "<div class='cookie-policy-banner'>{}</div>", "<div class='related-content'>{}</div>",
        "<div class='social-media'>{}</div>", "<div class='share-this'>{}</div>", "<div class='adSlot-3'>{}</div>",
        "<p class='advertisement'>{}</p>", "<div class='relatedPosts'>{}</div>", "<div id='disqus_thread'>{}</div>",
    ],
)
@pytest.mark.parametrize("where", ["inside", "beside"])
def test_parts_beside_the_article(outside, where):
    body = "<h1>Title</h1>" + "".join(f"<p>Paragraph {i} of the article, with its words.</p>" for i in range(6))
    part = outside.format(LEFT)
    if where == "beside" and "disqus" not in outside:
        source = f"<body><div class='wrap'><article>{body}</article>{part}</div></body>"
    else:
        source = f"<body><article>{body.replace('</h1>', '</h1>' + part) if 'disqus' not in outside else body}</article></body>"
    text = h.main_text(source, None)
    assert "not of the article" not in text and text.startswith("Title") and text.endswith("5 of the article, with its words.")


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<div class='post'><div class='article-header'><h1>T</h1></div><div class='body'><p>{}</p></div></div>", "T\n\n{}"),
        ("<div class='post'><div class='post-header'><h1>T</h1></div><p>{}</p></div>", "T\n\n{}"),
        ("<div><header class='entry-header'><h1>T</h1></header><p>{}</p></div>", "T\n\n{}"),
        ("<header class='site-header'><h1>No</h1></header><div><p>{}</p></div>", "{}"),
        ("<article><p class='promo'>a</p><h2 class='banner'>b</h2><p class='legal'>c</p><p>{}</p></article>", "a\n\nb\n\nc\n\n{}"),
        ("<article><p>{}</p><label>d</label><fieldset><p>e</p></fieldset></article>", "{}\n\nd\n\ne"),
        ("<article><p>{}</p><form><label>no</label></form></article>", "{}"),
        ("<article><section class='social-history'><p>{}</p></section></article>", "{}"),
        ("<article><div class='share-price-table'><p>{}</p></div></article>", "{}"),
    ],
)
def test_parts_of_the_article(source, text):
    words = "The words of the article, which are long enough to count as such."
    assert h.main_text(f"<body>{source.format(words)}</body>", None) == text.format(words)


def test_paths_with_equal_votes_go_by_name(spark):
    body = "The same number of words stands in both of these containers here."
    for first, second in (("aa", "bb"), ("bb", "aa")):
        inner = "<div class='{}'><div class='in'><p>{}</p></div></div>"
        source = f"<body>{inner.format(first, body)}{inner.format(second, body[::-1])}</body>"
        shares = h.Page(source).shares()
        best = sorted(p for p in shares if shares[p] == max(shares.values()))
        assert best[0].endswith("div.aa>div.in") and best[1].endswith("div.bb>div.in")
        rows = [(i, "http://tie/", source) for i in range(4)]
        assert set(found(spark, rows).values()) == {body if first == "aa" else body[::-1]}


def test_a_container_far_down_can_win(spark):
    def deep(i):
        noise = f"<div class='n'><p>{'Something that stands further up. ' * 4}</p></div>"
        inner = f"<div class='story'><p>Page {i} has its text down here. {'It is long. ' * 30}</p></div>"
        return "<body>" + noise + "<div class='very-long-name-of-a-wrapper'>" * 300 + inner + noise + "</div>" * 300 + "</body>"

    got = found(spark, [(i, "http://deep/", deep(i)) for i in range(4)])
    assert all(text.startswith(f"Page {i} has") and "further up" not in text for i, text in got.items())


class Templates:
    """Hosts with templates of their own; each page is made together with its main text."""

    CONTAINERS = ["<article{c}>", "<main{c}>", "<div class='story{c2}'>", "<div class='entry-content'>", "<section class='post-body'>"]
    AROUND = ["<nav><ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul></nav>", "<header class='masthead'><h1>Name of the site</h1></header>",
              "<div class='sidebar'><p>{t}</p></div>", "<aside><p>{t}</p></aside>", "<div class='newsletter-signup'><p>{t}</p></div>",
              "<div class='cookie-banner'>{t}</div>", "<div class='ad-slot'>{t}</div>", "<form><label>Name</label><input></form>",
              "<script>var a='<p>{t}</p>'</script>", "<!-- {t} -->", "<ul class='breadcrumbs'><li>{t}</ul>"]
    AFTER = ["<div class='comments'><h3>Comments</h3><p>{t}</p><p>{t}</p></div>", "<section id='comments'><p>{t}</p></section>",
             "<div class='related-articles'><p>{t}</p></div>", "<div class='social-share'><p>{t}</p></div>", "<footer><p>{t}</p></footer>"]

    def __init__(self, seed):
        self.rng = random.Random(seed)
        self.container = self.rng.choice(self.CONTAINERS)
        self.before = self.rng.sample(self.AROUND, 4)
        self.after = self.rng.sample(self.AFTER, 3)
        self.inside = self.rng.sample(self.AROUND[5:7] + self.AFTER[2:4], 1)
        self.wrap = self.rng.choice(["", "<div class='wrap'>", "<div id='page'><div class='col-{n}'>"])

    def words(self, n):
        return " ".join(self.rng.choice("river stone paper cloud garden winter letter window music table".split()) for _ in range(n))

    def page(self, n):
        rng, parts, blocks = self.rng, [], []

        def block(markup, text):
            parts.append(markup)
            blocks.append(text)

        title = self.words(5)
        block(f"<h1>{title}</h1>", title)
        for _ in range(rng.randint(4, 9)):
            kind, text = rng.random(), self.words(rng.randint(12, 60))
            if kind < 0.6:
                block(f"<p>{text} &amp; <b>bold</b> <a href='/x'>link</a></p>", f"{text} & bold link")
            elif kind < 0.7:
                block(f"<h2 id='related-{n}'>{text[:30].strip()}</h2>", " ".join(text[:30].split()))
            elif kind < 0.85:
                block(f"<ul><li>{text}</li>", text)
                parts.append("</ul>")
            else:
                block(f"<blockquote><p>{text}</p></blockquote>", text)
        parts.insert(rng.randint(2, len(parts)), self.inside[0].format(t=self.words(15)))
        opened = self.container.format(c=f" class='post-{n}'", c2=f" s{n}")
        closed = f"</{re.match('<([a-z]+)', opened)[1]}>"
        wrap = self.wrap.format(n=n)
        around = [x.format(t=self.words(20)) for x in self.before]
        after = [x.format(t=self.words(25)) for x in self.after]
        source = f"<html><head><title>{title}</title></head><body>{''.join(around)}{wrap}{opened}{''.join(parts)}{closed}{''.join(after)}{'</div>' * wrap.count('<div')}</body></html>"
        return source, "\n\n".join(blocks)


def test_generated_sites_give_exactly_their_main_texts(spark):
    rows, wanted = [], {}
    for host in range(40):
        site = Templates(host)
        for n in range(8):
            source, text = site.page(n)
            wanted[100 * host + n] = text
            rows.append((100 * host + n, f"http://site{host}.example/{n}", source))
    got = found(spark, rows)
    wrong = [i for i, text in wanted.items() if got[i] != text]
    assert not wrong, (len(wrong), wrong[:5], got[wrong[0]], wanted[wrong[0]])
