"""Main text of pages."""

import pytest

from llm.edge import bag
from tablelift.llm import htmltext

FILLER = "This is a long enough sentence of the article, with words and words and more words. "


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain &eacute; &lt;b&gt;", "plain é <b>"), ("<div>a<br>b</div>", "a b"),
        ("<p>a<p>b <script>var t='</p>'</script> c", "a\n\nb c"), ("<article>x<nav>n</nav>y</article>", "x\n\ny"),
        ("<!-- c --><p>a &am", "a &am"), ("<p>a&nbsp;\n\t b</p>", "a b"), ("<style>p{}</style><p>t</p>", "t"),
        ("<p>one <b>two <i>three</p><p>four</b></p>", "one two three\n\nfour"),
    ],
)
def test_small_pages(html, text):
    assert htmltext.extract(html) == text


def page(body, tail=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>x('</div>')</script></head><body>"
        "<header class=site><h1>Site</h1><p>Slogan of the site that is quite long indeed</p></header><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        f"<div class='notice'><p>{FILLER}We use cookies.</p></div><aside><p>{FILLER}Side.</p></aside>{body}"
        f"<section id=comments><p>{FILLER}I liked it.</p></section><form><label>Mail</label><input><button>Go</button></form>"
        f"<div class='ad-banner'>{FILLER}Buy!</div><footer><p>Imprint</p></footer>{tail}</body></html>"
    )


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=content>", "</div>"), ("<div id='post-12'><div>", "</div></div>")])
def test_article_without_the_rest(open_, close):
    parts = [FILLER.strip(), "Short.", FILLER.strip() + " Two &amp; three.", "End."]
    body = open_ + "<h1>Headline</h1>" + "".join(f"<p>{p}</p>" for p in parts) + "<div class=share><a>Share</a></div>" + close
    want = "\n\n".join(["Headline", *parts]).replace("&amp;", "&")
    assert htmltext.extract(page(body)) == want


@pytest.mark.parametrize(
    "open_, close",
    [
        ("<div class='layout with-sidebar'>", "</div>"), ("<div class='no-sidebar'><article>", "</article></div>"), ("<div class='widget'><main>", "</main></div>"),
        ("<form action='./page.aspx'><div>", "</div></form>"), ("<div class='page-widget'><div>", "</div></div>"),
    ],
)
def test_wrappers_do_not_hide_the_article(open_, close):
    body = open_ + "".join(f"<p>{FILLER}Part {i}.</p>" for i in range(12)) + close
    want = "\n\n".join(f"{FILLER}Part {i}." for i in range(12))
    assert htmltext.extract(page(body)) == want


def test_blocks_of_a_page_builder():
    body = "".join(f"<div class='elementor-element elementor-widget'><p>{FILLER}Part {i}.</p></div>" for i in range(12))
    share = "<div class='elementor-widget elementor-widget-share'><p>Share</p></div>"
    want = "\n\n".join(f"{FILLER}Part {i}." for i in range(12))
    assert htmltext.extract(page(f"<div>{body}{share}</div>")) == want


def test_long_comments_do_not_outweigh_the_article():
    comments = "<div id='comments'>" + f"<article class='comment'><p>{FILLER}</p></article>" * 20 + "</div>"
    assert htmltext.extract(page(f"<article><p>{FILLER}One.</p><p>{FILLER}Two.</p></article>{comments}")) == f"{FILLER}One.\n\n{FILLER}Two."


def test_smoothing_and_threshold():
    assert htmltext.smoothed([3.0, 3.0, 3.0]) == pytest.approx([3.0] * 3)
    values = htmltext.smoothed([0, 0, 0, 100, 90, 0, 80, 0, 0, 0])
    assert values[4] == max(values) and values[0] < values[2] < values[3]
    cut = htmltext.threshold([1, 2, 1, 50, 60, 55])
    assert 2 < cut < 50
    assert htmltext.threshold([5.0]) < 5.0 or htmltext.threshold([5.0]) == 5.0


def test_rows(spark):
    rows = [(1, "u", "<p>é漢</p>"), (1, "u", "<p>é漢</p>"), (None, None, None), (2, None, "<p>" + FILLER * 20_000 + "</p>"), (3, "v", "<" * 2000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = htmltext.main_text(df).collect()
    assert bag((r.page_id, r.url, r.n_chars) for r in got if r.page_id != 3) == bag(
        [(1, "u", 2), (1, "u", 2), (None, None, 0), (2, None, len((FILLER * 20_000).strip()))]
    )
    assert all(len(r.text) == r.n_chars for r in got)
    assert htmltext.main_text(df.where("false")).count() == 0


THREE = "<p>The same paragraph of a page that is long enough to be read.</p>" * 3
THREE_TEXT = "\n\n".join(["The same paragraph of a page that is long enough to be read."] * 3)


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<body><form>{THREE}</form></body>", THREE_TEXT), ("<body><form><p>One paragraph.</p></form></body>", "One paragraph."),
        (f"<div class='elementor-widget'>{THREE}</div>", THREE_TEXT), (f"<div class='share-page'>{THREE}</div>", THREE_TEXT),
        (f"<div role=main class=social>{THREE}</div>", THREE_TEXT),
        (f"<article><p>{FILLER * 4}</p></article><article><p>Short one.</p><p>Shorter.</p></article>", f"{(FILLER * 4).strip()}\n\nShort one.\n\nShorter."),
        (f"<div><div class='elementor-widget'><p>{FILLER * 5}</p></div><div class='elementor-widget'><p>{FILLER}</p></div></div>", f"{(FILLER * 5).strip()}\n\n{FILLER.strip()}"),
        (f"<nav><a>x</a></nav>{THREE}<footer>f</footer>", THREE_TEXT),
    ],
)
def test_content_of_equal_or_several_parts(html, text):
    assert htmltext.extract(html) == text


@pytest.mark.parametrize("html", [
    "<div>" * 20_000 + "deep", "<div class=widget>" * 20_000 + "deep", '<a href="' * 20_000, "<!--" * 20_000, "</" * 20_000, "<b>" * 20_000 + "</i>" * 20_000 + "x",
    "<b>" * 20_000 + "<p>x" * 2_000, "<div><p>t</p>" * 20_000, "<article class=comment><p>t</p>" * 10_000, "<!x " * 20_000, "<? " * 20_000,
])
def test_broken_and_deep_pages_cost_little(html):
    import time
    import tracemalloc

    start = time.process_time()
    htmltext.extract(html)
    assert time.process_time() - start < 8  # a second on a machine that is not busy
    tracemalloc.start()
    htmltext.extract(html[: len(html) // 4])
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def slow_lines(tree):
    """Text of a tree of (tag, children) without any markup that names a part: every block is a line."""
    out = [[]]

    def walk(node):
        if isinstance(node, str):
            out[-1].append(node)
            return
        tag, children = node
        block = tag in htmltext.BLOCKS
        if block:
            out.append([])
        for child in children if tag not in htmltext.NEVER else ():
            walk(child)
        if block:
            out.append([])

    walk(tree)
    return [t for t in (" ".join("".join(x).split()) for x in out) if t]


def test_random_trees_keep_every_line():
    """Against a plain walk over trees of blocks and inline tags in one article, menus and forms inside left out."""
    import random

    r = random.Random(8)

    def tree(depth):
        children = []
        for _ in range(r.randint(1, 4)):
            if depth == 0 or r.random() < 0.4:
                children.append(f"w{r.randint(0, 99)} " * r.randint(1, 30))
            else:
                children.append((r.choice(["div", "section", "b", "i", "span", "ul", "blockquote", "nav", "script"]), tree(depth - 1)))
        return children

    def html(node):
        return node if isinstance(node, str) else f"<{node[0]}>" + "".join(map(html, node[1])) + f"</{node[0]}>"

    def fits(node, inline=False):
        """No blocks inside inline tags: there the end tags of the page decide."""
        if isinstance(node, str):
            return True
        own = node[0] in ("b", "i", "span")
        return not (inline and not own) and all(fits(c, inline or own) for c in node[1]) and not (node[0] == "script" and any(not isinstance(c, str) for c in node[1]))

    seen = 0
    while seen < 150:
        node = ("article", tree(4))
        if fits(node):
            seen += 1
            assert htmltext.extract("<body>" + html(node) + "</body>") == "\n\n".join(slow_lines(node))
