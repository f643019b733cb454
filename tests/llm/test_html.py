from __future__ import annotations

import html
import re

import pytest

from quayside.llm.html import extract_text, main_text

ARTICLE = "<article><h1>A short title</h1><p>First paragraph, with some text. And more of it; really.</p><p>Second.</p></article>"
TEXT = "A short title First paragraph, with some text. And more of it; really. Second."


@pytest.mark.parametrize(
    "around",
    [
        "{}",
        "<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=/x>Menu entry, one.</a></ul></nav>{}<footer>All rights, reserved.</footer>",
        "<body><header><h1>Site name, and slogan.</h1></header>{}<aside>Aside, with long text, long text, long text.</aside></body>",
        "<body><div class='cookie-notice'>We use cookies, a lot of them, here.</div>{}</body>",
        "<body>{}<div id=comments><article><p>Reader, who says a lot about it, at length. Yes.</p></article></div></body>",
        "<body><form><p>Your name, please.</p><textarea>Text</textarea><button>Go</button></form>{}</body>",
        "<body><script>var a = '<article><p>no</p></article>';</script>{}<!-- <p>comment</p> -->",
        "<body><div class=\"ad\">Buy this, buy that, buy all of it. Now!</div>{}<div role=complementary>More.</div><div hidden>Hidden, text.</div>",
    ],
)
def test_boilerplate_goes(around):
    assert main_text(around.format(ARTICLE)) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("<nav>menu</nav>", ""), ("plain text", "plain text"),
        ("<p>a&nbsp;&amp;&lt;b&gt; &eacute;&#233;&#xe9;", "a &<b> ééé"), ("<p>&amp;amp;", "&amp;"),
        ("<p>one<br>two<p>three <b>bo</b>ld", "one two three bold"),
        ("<article><p><b>open bold.<br><p>Next</p></article><footer>f</footer>", "open bold. Next"),
        ("<article><header><h1>Title</h1></header><p>Text, of it.</p></article>", "Title Text, of it."),
        ("<article><p>Text, of it.</p><div class='comments'><p>Comment, by one.</p></div><p>End.</p></article>", "Text, of it. End."),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p title='a > b'>x</p>", "x"), ('<p title="broken>x</p><p>y</p>', "x y"),
        ("<p>unclosed <!-- comment <p>x", "unclosed"), ("a < b and c > d", "a < b and c > d"), ("<p>x</p><script>var a", "x"),
        ("<main><h2>Head</h2><p>Body, body.</p></main><p>Other, less.</p>", "Head Body, body."),
        ("<DIV><P>Upper, case.</P></DIV>", "Upper, case."),
    ],
)
def test_cases(page, text):
    assert main_text(page) == text


def test_without_an_article_element():
    page = (
        "<body><div class=top><a href=/>Home</a> <a href=/b>Blog</a></div><div><h1>Title</h1>"
        + "".join(f"<p>Paragraph {k}, with words; and words, and a sentence. Then one more sentence.</p>" for k in range(8))
        + "<p>Short.</p></div><div><ul><li>Link</li><li>Link</li></ul></div></body>"
    )
    text = main_text(page)
    assert text.startswith("Title Paragraph 0,") and text.endswith("Short.") and "Home" not in text and "Link" not in text


def test_very_long_page_is_whole():
    body = " ".join(f"w{k}." for k in range(200_000))
    assert main_text(f"<body><nav>x</nav><article><p>{body}</p></article>") == body


def test_pages_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = extract_text(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        inside = re.sub(r"</?(p|h1|br)>", " ", inside)
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", "", inside)).split())
        assert r.text == want and r.n_chars == len(want)


def test_frame_cases(spark):
    schema = "page_id long, url string, html string, Text string"
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", ARTICLE, "x"), (2, "u", ARTICLE, "x"), (2, "u", ARTICLE, "x")], schema)
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted(((r.page_id, r.text, r.n_chars) for r in got.collect()), key=repr) == sorted([(1, "", 0), (None, TEXT, len(TEXT)), (2, TEXT, len(TEXT)), (2, TEXT, len(TEXT))], key=repr)
    assert extract_text(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        '<p>Text, with <a href="/the-hidden-cost">a link</a>, of it.</p>', '<p title="A hidden gem">Text, with a link, of it.</p>',
        '<p>Text, with <a href="/post?id=comment-3">a link</a>, of it.</p>', '<p data-id="search">Text, with a link, of it.</p>',
        "<article class='post comments-open'><p>Text, with a link, of it.</p></article>", '<div class="content has-sidebar"><p>Text, with a link, of it.</p></div>',
        "<p data-hidden=x aria-label='role=dialog' data-class=ad>Text, with a link, of it.</p>",
        "<p>Text, with a link, of it.</p><div class='site-footer'>Rights.</div><div id='comment-3'>A comment, here.</div><div CLASS=x HIDDEN>No.</div>",
    ],
)
def test_names_of_attributes_and_classes(page):
    assert main_text(f"<body>{page}</body>") == "Text, with a link, of it."


def test_weak_names_follow_their_paths():
    long = "".join(f"<p>Paragraph {k}, with words; and words, and a sentence. Then one more sentence.</p>" for k in range(8))
    page = f"<article class='post comments-open'><h1>Title</h1>{long}<div class='menu-of-day'><ul><li>Go</li><li>Up</li></ul></div></article>"
    text = main_text(page)
    assert text.startswith("Title Paragraph 0,") and text.endswith("sentence.") and "Paragraph 7" in text


READERS = "<p>A reader, who writes long sentences; many of them, at length. And yet another one, with marks, and more.</p>" * 3
LONG = "".join(f"<p>Paragraph {k}, with words; and words, and a sentence. Then one more sentence.</p>" for k in range(8))
LONG_TEXT = " ".join(re.findall("<p>(.*?)</p>", LONG))


@pytest.mark.parametrize(
    "name",
    [
        "user-comments", "reader-comments", "fb-comments", "comments-thread", "comment-content", "commentsArea", "usercomments",
        "user_reviews", "discussion", "cookie-law-info-bar", "right-rail", "advert-slot-3", "Comments", "post newsletterSignup",
    ],
)
@pytest.mark.parametrize("wrap", ["<article>{}{}</article>", "<article>{}</article>{}", "<div class=text>{}</div>{}", "<main>{}{}</main>"])
def test_readers_and_notices_go(name, wrap):
    assert main_text("<body>" + wrap.format(LONG, f'<div class="{name}">{READERS}</div>') + "</body>") == LONG_TEXT
    assert main_text("<body>" + wrap.format(LONG, f"<section id='{name.split()[-1]}'>{READERS}</section>") + "</body>") == LONG_TEXT


@pytest.mark.parametrize("name", ["has-comments", "comments-open", "content with-sidebar", "no-comments", "commentary", "newsroom", "review-text"])
def test_names_that_tell_a_state_stay(name):
    assert main_text(f'<body><div class="{name}">{LONG}</div></body>') == LONG_TEXT
    assert main_text(f'<body><article class="{name}">{LONG}</article></body>') == LONG_TEXT


@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div><h1>Paragraph 0</h1>{}</div>", "<div>{}</div>"])
def test_a_form_around_the_page_is_no_form(inner):
    login = "<form class=login><p>Your name, please.</p><input name=a></form><div><label>Search</label><select><option>x</select></div>"
    page = f"<body><form id='aspnetForm' action=/x><nav><a href=/>Home</a></nav>{inner.format(LONG)}<button>Go</button></form></body>"
    assert main_text(page).endswith(LONG_TEXT) and "Home" not in main_text(page)
    assert main_text(f"<body>{LONG}<form><p>Write to us, with your name, and your question.</p></form>{login}</body>") == LONG_TEXT


def test_teasers_and_link_lists_go():
    teaser = "<article><h2>Another story</h2><p>It begins, so; and goes on.</p></article>"
    menu = "<ul>" + "".join(f"<li><a href=/{k}>A story, number {k}.</a></li>" for k in range(5)) + "</ul>"
    for order in ("<main>{0}{1}{2}</main>", "<main>{1}{0}{2}</main>", "<main>{2}{0}{1}</main>"):
        assert main_text("<body>" + order.format(f"<article>{LONG}</article>", teaser, menu) + "</body>") == LONG_TEXT
    assert main_text(f"<article>{LONG}{menu}</article>") == LONG_TEXT
    steps = "<ul><li>First, <a href=/x>open</a> it.</li><li><a href=/y>Two</a></li><li>Three.</li></ul>"
    assert main_text(f"<article>{LONG}{steps}</article>") == LONG_TEXT + " First, open it. Two Three."
    equal = f"<main><article>{LONG}</article><article>{LONG}</article></main>"
    assert main_text(equal) == f"{LONG_TEXT} {LONG_TEXT}"


def test_path_scores_by_hand():
    """The thresholded paths, computed again from their definition by loops over all pairs."""
    import random

    from quayside.llm.html import blocks, content_paths

    for seed in range(40):
        rnd = random.Random(seed)
        tags = ["p", "div", "h2", "section", "blockquote"]
        page = "<body>"
        for _ in range(rnd.randrange(3, 40)):
            path = [rnd.choice(tags) for _ in range(rnd.randrange(1, 4))]
            words = " ".join(rnd.choice(["word", "more,", "end.", "x", "why?"]) for _ in range(rnd.randrange(1, 40)))
            page += "".join(f"<{t}>" for t in path) + words + "".join(f"</{t}>" for t in path[::-1])
        found = blocks(page)
        paths = [e.path for e, _ in found]
        ratio, marks = [], []
        for path in paths:
            own = [t for (e, t) in found if e.path == path]
            ratio.append(sum(len(t) for t in own) / len(own))
            marks.append((1 + sum(t.count(c) for t in own for c in ".,;:!?")) / len(own))
        kernel = {-2: 0.0545, -1: 0.2442, 0: 0.4026, 1: 0.2442, 2: 0.0545}

        def smooth(values, i):
            near = {k: w for k, w in kernel.items() if 0 <= i + k < len(values)}
            return sum(w * values[i + k] for k, w in near.items()) / sum(near.values())

        fused = [smooth(ratio, i) * smooth(marks, i) for i in range(len(paths))]
        mean = sum(fused) / len(fused)
        limit = (sum((x - mean) ** 2 for x in fused) / len(fused)) ** 0.5 / 2
        want = {p for p in paths if sum(x for x, q in zip(fused, paths) if q == p) / paths.count(p) >= limit}
        assert content_paths(found) == want
