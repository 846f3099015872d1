import random
from html.parser import HTMLParser

import pytest

from prepframe.llm import html as H
from prepframe.llm.html import best_path, extract, extract_pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p><article>no</article>";</script></head>
<body><header class=top>Site</header><nav><ul><li><a href=/a>A</a></li></ul></nav><!-- <p>gone</p> -->
<div class="cookie-notice"><p>We use cookies a lot and more than that.</p></div>
<div id="wrap"><div class="story-12"><h1>Ti&amp;tle</h1><p><b>First</b>  part<br>second&nbsp;line<p>Third &#233; a &lt; b.
<form><label>Mail</label><input name=x></form><div class="ad box">Buy now</div><blockquote>quoted</blockquote></div>
<aside>Side text</aside><section id="comments"><p>First! A comment of a reader that goes on for quite some time.</p></section></div>
<footer>&copy; foot</footer></body></html>"""
TEXT = "Ti&tle First part second line Third é a < b. quoted"


def test_main_text_without_boilerplate():
    path, share = best_path(PAGE)
    assert path.endswith("div.story") and share > 0
    assert extract(PAGE, path) == TEXT
    assert extract(PAGE, "/no/such") == TEXT
    assert extract(PAGE, None) == TEXT


def test_broken_pages():
    assert extract("", None) == "" and extract("   ", "/article") == ""
    assert extract("plain  text", None) == "plain text"
    assert extract("<article><p>a</i></span><p>b</article></div></p><p>c", "/article") == "a b"
    assert extract("<article>one <b>two</article><footer>x", "/article") == "one two"
    assert extract("<article>one <a href='x>two</article>", "/article").startswith("one")
    assert extract("<article>one <di", "/article") == "one"
    assert extract("<script>only", None) == ""
    assert extract("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>", "/article") == "deep"


def test_host_consensus_overrules_a_page(spark):
    good = "<body><div class='post-{0}'><p>{1}</p></div><div class='extra'><p>{2}</p></div></body>"
    rows = [(i, f"http://h.org/{i}", good.format(i, "main text " * 9, "other"), "x") for i in range(9)]
    rows += [(50, "https://user@H.org:80/x?y", good.format(50, "short main", "a longer box beside it " * 9), "x")]
    rows += [(60, None, None, None), (61, "nonsense", "<p>alone</p>", None), (62, "http://empty.org/", "", None), (62, "http://empty.org/", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(4)
    got = {r["page_id"]: r for r in extract_pages(df).collect()}
    assert len(got) == 13 and got[3]["text"] == ("main text " * 9).strip()
    assert got[50]["text"] == "short main" and got[50]["n_chars"] == 10
    assert got[60]["text"] == "" and got[61]["text"] == "alone" and got[62]["n_chars"] == 0
    assert extract_pages(df.limit(0)).collect() == []
    # Too many paths to broadcast: pages are salted, the rows are the same.
    assert sorted(map(str, extract_pages(df, max_broadcast=-1).collect())) == sorted(map(str, extract_pages(df).collect()))


def test_html_is_not_shuffled(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "<p>x</p>")], "page_id long, url string, html string")
    plan = extract_pages(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert "SortMergeJoin" in extract_pages(df, max_broadcast=-1)._jdf.queryExecution().executedPlan().toString()


LONG = "A sentence of the article itself, which is long enough. " * 12


def test_compound_names_do_not_lose_the_page():
    for wrap in (
        "<div class='content has-sidebar'>{}</div>", "<div id='page' class='no-sidebar'>{}</div>", "<section class='post comments-open'>{}</section>",
        "<form id=aspnetForm action=x>{}</form>", "<div class='layout side-by-side'><div class=body>{}</div></div>", "<div class=widget>{}</div>",
    ):
        page = "<body><nav>Menu</nav><div class='related box'><p>Other news</p></div>" + wrap.format(f"<h1>Title</h1><p>{LONG}</p>") + "</body>"
        if "widget" in wrap:
            page = f"<body><div class=widget><h1>Title</h1><p>{LONG}</p></div></body>"
        path, _ = best_path(page)
        for p in (path, None, "/no/such"):
            assert extract(page, p) == "Title " + LONG.strip(), (wrap, p)
    # All words are boilerplate words: skipped however long.
    page = f"<body><div class=story><p>Short story.</p></div><div id=comments class=comments><p>{LONG}</p></div></body>"
    assert extract(page, best_path(page)[0]) == "Short story."
    # Minor on this page, but on the way to the host's path.
    page = f"<body><div class='post comments-open'><p>Short.</p></div><div class=extra><p>{LONG}</p></div></body>"
    assert extract(page, "/section.x") == LONG.strip() and extract(page, "/div.comments.open.post") == "Short."


def test_title_and_lead_beside_the_body():
    for inner, want in (
        (f"<h1>Title</h1><p>Lead</p><div class=body><p>{LONG}</p></div>", "Title Lead " + LONG.strip()),
        (f"<div class=top><h1>Title</h1></div><div class=body><p>{LONG}</p></div>", "Title " + LONG.strip()),
        (f"<p>Lead</p><ul><li>{LONG}</li></ul><p>End</p>", "Lead " + LONG.strip() + " End"),
        (f"<h2>One</h2><section class=part><p>{LONG}</p></section><h2>Two</h2><section class=part><p>{LONG}</p></section>", f"One {LONG.strip()} Two {LONG.strip()}"),
    ):
        page = f"<body><nav>Menu</nav><div class=post>{inner}</div><div class=crumbs><a href=/>Home</a></div></body>"
        assert extract(page, best_path(page)[0]) == want, inner
    page = f"<body><div class=post><div class=links><a href=/>Home</a> <a href=/x>X</a></div><div class=body><p>{LONG}</p></div></div></body>"
    assert best_path(page)[0].endswith("div.body")


@pytest.mark.parametrize("name", ["comment-list", "comments-area", "user-comments", "disqus_thread", "site-footer", "cookie-bar", "newsletter-box", "commentlist"])
def test_boxes_named_after_boilerplate_go_whatever_their_size(name):
    article = "<h1>Title</h1>" + "".join(f"<p>Sentence {k} of the article itself.</p>" for k in range(9))
    chatter = "".join(f"<p>Reader {k} says a lot about all this and more.</p>" for k in range(40))
    want = "Title " + " ".join(f"Sentence {k} of the article itself." for k in range(9))
    for page in (
        f"<body><article>{article}</article><div class='{name}'>{chatter}</div></body>",
        f"<body><article>{article}<div class='{name}'>{chatter}</div></article></body>",
        f"<body><main>{article}<section id='{name}'>{chatter}</section></main></body>",
    ):
        assert extract(page, best_path(page)[0]) == want and extract(page, None) == want


def test_time_is_linear_in_any_page():
    import time

    for page in ("<p>x</p>" + "<a href='" * 80_000, "a <b c " * 80_000, "<a 'x>' " * 80_000, "<div>" * 30_000 + "</p>" * 30_000, "<" * 200_000):
        began = time.process_time()
        H.parse(page)
        assert time.process_time() - began < 5


def test_tags_without_an_end():
    assert H.parse("a <b c").items and not [x for x in H.parse("x <i 'y>z").items if not isinstance(x, str) and x.tag == "i"]
    root = H.parse("<p title='a > b'>one</p><a 'x>two")
    assert [x.tag for x in root.items if not isinstance(x, str)] == ["p"]


class Walker(HTMLParser):
    """Slow twin for well-formed pages: text of the one <article>, without what is boilerplate by tag or class."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks = [], [""]

    def handle_starttag(self, tag, attrs):
        self.stack.append((tag, dict(attrs).get("class", "")))
        if tag not in ("b", "a"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        assert self.stack.pop()[0] == tag
        if tag not in ("b", "a"):
            self.blocks.append("")

    def handle_data(self, data):
        tags = [t for t, _ in self.stack]
        if "article" in tags and not {"nav", "aside", "script", "footer"} & set(tags) and "comments" not in [c for _, c in self.stack]:
            self.blocks[-1] += data

    def text(self):
        return " ".join(w for b in self.blocks if (w := " ".join(b.split())))


def test_random_pages_against_a_slow_walker():
    r = random.Random(5)

    def words(n):
        return " ".join(r.choice(["alpha", "b&amp;c", "d&#233;", "e  f", "g\n\th", "&lt;i&gt;", "<b>bold</b>", "x<a href='/q?a>b'>y</a>z"]) for _ in range(n))

    for _ in range(200):
        inner = []
        for _ in range(r.randint(1, 7)):
            kind = r.choice(["p", "h2", "div", "aside", "nav", "script", "comments", "list"])
            if kind == "comments":
                inner.append(f"<div class='comments'><p>{words(r.randint(1, 9))}</p></div>")
            elif kind == "script":
                inner.append("<script>if (a < b) c();</script>")
            elif kind == "list":
                inner.append(f"<ul><li>{words(3)}</li><li>{words(2)}</li></ul>")
            else:
                inner.append(f"<{kind}>{words(r.randint(1, 9))}</{kind}>")
        page = f"<html><body><nav><a href='/'>Home</a></nav><article><p>{words(40)}</p>{''.join(inner)}</article><footer>{words(5)}</footer></body></html>"
        slow = Walker()
        slow.feed(page)
        assert extract(page, "/article") == slow.text(), page
