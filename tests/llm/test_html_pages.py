"""The page parser against pages whose blocks are known because they are drawn, and against markup that is deep, unclosed or endless."""

import random
import time
import tracemalloc

import pytest

from tapeline.llm import html

FRAMES = [("nav", ""), ("aside", ""), ("button", ""), ("dialog", ""), ("form", ""), ("span", ' class="advert"'), ("a", ' class="share"'), ("div", ' id="cookie-notice"'), ("p", ' role="search"'), ("b", " class='x promo-box'")]
BLOCK, INLINE = ["div", "p", "section", "blockquote", "li", "h2"], ["b", "i", "span", "a", "em"]


def draw(rnd, depth, site, lines):
    """Markup of a few children; what is read is added to lines: (site or not, text), and None where a block ends."""
    out = []
    for _ in range(rnd.randint(1, 4)):
        kind = rnd.choice("ttbif") if depth else "t"
        if kind == "t":
            text = rnd.choice([" one", "two ", "\n three ", "f&amp;r", "x &lt; y", "é"])
            lines.append((site, text.replace("&amp;", "&").replace("&lt;", "<")))
            out.append(text)
        elif kind == "i":
            name = rnd.choice(INLINE)
            out.append(f"<{name} title='a > b'>" + draw(rnd, depth - 1, site, lines) + f"</{name}>")
        else:
            name, attributes = rnd.choice(FRAMES) if kind == "f" else (rnd.choice(BLOCK), rnd.choice(["", ' class="lead ad-free"']))
            if kind == "b" or not site or name in html.BLOCKS:
                lines.append(None)
            if name in ("p", "li"):  # an end tag that the next start implies would change what is drawn
                out.append("<div>")
            out.append(f"<{name}{attributes}>" + draw(rnd, depth - 1, site or kind == "f", lines) + f"</{name}>" + "</div>" * (name in ("p", "li")))
            if kind == "b" or not site or name in html.BLOCKS:
                lines.append(None)
    return "".join(out)


def read(lines):
    found, now = [], ""
    for line in [*lines, None]:
        if line is None:
            if now.split():
                found.append((site, " ".join(now.split())))  # noqa: F821
            now = ""
        else:
            site, now = line[0], now + line[1]
    return found


@pytest.mark.parametrize("seed", range(200))
def test_drawn_articles(seed):
    lines: list = []
    rnd = random.Random(seed)
    page = "<html><body><article>" + draw(rnd, 4, False, lines) + "</article></body></html>"
    want = read(lines)
    assert [(role != html.KEPT, text) for role, text in html.blocks(page)] == want
    assert html.main_text(html.blocks(page), ()) == " ".join(t for site, t in want if not site)


@pytest.mark.parametrize(
    "page",
    ["<div>" * 200_000 + "x", "<div>" * 90_000 + "x" + "</div>" * 90_000, "<a " * 350_000, "<a \">\" " * 140_000, "<a \"" * 250_001 + ">", "<svg>" * 200_000, "<i><div>" + "<b>" * 140_000 + "</i>" * 140_000]
    + ["<p>x" * 250_000, '<p class="' + "a-b " * 250_000 + '">x', "<!-" * 330_000, "</div>" * 160_000, "<!--" * 250_000, "<" * 1_000_000, "<span class='ad'>x" * 60_000],
)
def test_a_megabyte_of_any_markup_takes_seconds(page):
    began = time.process_time()
    html.blocks(page)
    assert time.process_time() - began < 10


def test_names_of_furniture():
    text = lambda page: html.main_text(html.blocks(page), ())
    assert text('<article><p class="related-work">a</p><p class="ad-free">b</p><p class="ad-slot">c</p><p class="cookie-notice">d</p></article>') == "a b"
    assert text('<div class="search-results"><p>hit</p></div><div class="post-header"><h1>Title</h1></div><div class="post-comments">no</div>') == "hit Title"
    assert text("a < b <b>and</b> a<b") == "a < b and a<b"


def test_pages_among_many_copies(spark):
    """Copies on both sides, more than a page looks at in the first round: the search goes on to a page that differs, over rows of copies, to the end of the host."""
    from test_odd_rows import brute_texts

    def page(body):
        return f"<div>Home of the site</div><div>{body}</div><div>All rights are with the site</div>"

    rows = [(k, f"http://h.org/a/{k:03}", page("the same long story about the very same things, told anew, number %d" % (k % 2))) for k in range(30)]
    rows += [(100 + k, f"http://h.org/b/{k:03}", page(f"something else {k * 7919} entirely that no other page has {k * k}")) for k in range(2)]
    rows += [(200 + k, f"http://copies.org/{k:03}", page("nothing but copies here, one after the other, all of them alike to the letter")) for k in range(25)]
    rows += [(300 + k, f"http://rows.org/{k // 12}/{k:03}", page(f"row of copies {'abc'[k // 12] * 40} with a long story of its own that fills the page, {k}")) for k in range(36)]
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("Home" not in got[k] for k in (*range(30), 100, 101, *range(300, 336)))
    assert all("Home" in got[k] for k in range(200, 225))
    want = brute_texts(rows)
    assert {k: got[k] for k in (*range(30), *range(200, 225))} == {k: want[k] for k in (*range(30), *range(200, 225))}


def test_lines_that_the_articles_of_a_site_share(spark):
    """Articles are differenced too: what most articles of a host share goes, what some quote stays, and copies of an article tell nothing."""

    def page(k, *lines):
        return f"<nav>menu {k}</nav><article><h1>title {k}</h1>" + "".join(f"<p>{x}</p>" for x in lines) + f"</article><footer>foot {k}</footer>"

    share, quote, story = "Share this story with all of your friends", "a passage that some quote", [f"line {n} of the same long story that is told again" for n in range(10)]
    own = lambda k: f"what only page {k} has to tell, some {k * 7919} words of it"
    body, pages = {}, []

    def add(url, *lines, title=None):
        k = len(pages)
        body[k] = [f"title {k}" if title is None else title, *lines]
        pages.append((k, url, page(k, *lines).replace(f"title {k}", body[k][0])))

    for k in range(24):  # one page hasn't the site's line, and the page behind is aligned with it
        add(f"http://site.org/{k:02}", own(k), *[quote] * (k % 3 == 0), *[share] * (k != 6), f"end {k}")
    for k in range(9):  # too few to tell
        add(f"http://small.org/{k}", own(k), share)
    for k in range(12):
        add(f"http://copies.org/{k:02}", *story, title="the story")
    for k in range(11):
        add(f"http://near.org/{k:02}", *story, quote, f"end {k}", title="the story")
    add("http://near.org/99", own(99), quote)
    far = len(pages)
    for k in range(10):
        add(f"http://far.org/a/{k}", own(k), share)
    for k in range(14):  # more copies than a page looks at in the first round
        add(f"http://far.org/b/{k:02}", *story, share, title="the story")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = {k: " ".join(x for x in lines if x != share or k == 7 or 24 <= k < far) for k, lines in body.items()}
    assert got == want


def test_alignment_of_long_pages_takes_little_memory():
    rnd = random.Random(5)
    a, b = ([rnd.randint(0, 5) for _ in range(12_000)] for _ in range(2))
    tracemalloc.start()
    shared = html.common_lines(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    it = iter(b)
    assert peak < 8e6 and shared.sum() > 6_000 and all(x in it for x, s in zip(a, shared) if s)
