import itertools
import random

import pytest

from tierline.llm import html_main as H

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>
<header><a href="/">Site name</a></header><nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, accept them all</div>
<main><article><header><h1>Title &amp; more</h1></header>
<p>First  para with <a href="x">link</a> and<br>a break &lt;here&gt;.
<div class="ad">Buy now, this thing is great for you all</div>
<p>ok</p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>
<form><label>Email</label><button>Go</button></form><pre>code  x</pre>
<script>var t = "</p>"; if (a<b) {}</script><!-- note </article> --></article>
<section id="comments"><p>I disagree with the whole of this article, really very much so.</p></section></main>
<aside>Related stories of interest</aside><footer>&copy; us</footer></body></html>"""


def test_article_only():
    assert H.main_text(PAGE) == "\n\n".join(
        ["Title & more", "First para with link and a break <here>.", "ok", "one", "two", "c1", "c2", "code x"])


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<div ", ""), ("plain words without any markup", "plain words without any markup"),
    ("<p>open <b>bold <i>x", "open bold x"), ("a<script>unclosed <p>x", "a"), ("<p>1 < 2 and 3 > 2 are so</p>", "1 < 2 and 3 > 2 are so"),
    ("<p hidden>secret words of a page</p><p>seen words of a page</p>", "seen words of a page"),
    ("<p>one</p>\n\n<p>a&nbsp;b\t c</p>", "one\n\na b c"), ("<p title='a>b'>text of a page</p>", "text of a page"),
    ("<P CLASS=x>Upper Case tags here</P>", "Upper Case tags here"), ("<p>" * 3000 + "deep", "deep"),
    ("<p>" + "word " * 50_000, ("word " * 50_000).strip())])
def test_small_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize("script", [
    "<script>for(i=0;i<n;i++){s++}</script>", "<script>if (a<b && c>d) x='<!--'</script >", "<script><!-- no end</script>",
    "<script>t = a<b ? \"it's : 0</script>", "<style>p:before{content:'<b'}</STYLE>", "<textarea>a<b \" </textarea x='>'>",
    "<script>'</scripted>' <a</script/>"])
def test_text_after_raw_elements(script):
    page = f"<p>words before the raw text</p>{script}<p>words after the raw text, \"quoted\" and it's whole</p>"
    assert H.main_text(page) == "words before the raw text\n\nwords after the raw text, \"quoted\" and it's whole"


BODY = [f"Sentence {i} of the body has quite a few words to read in it." for i in range(6)]
PARTS = "".join(f"<p>{x}</p>" for x in BODY)
SIDE = "<nav><a href=1>Home</a></nav>{}<div id=comments class=comment-list><p>I disagree with all of this.</p></div>" \
       "<div class=ad>Buy this now, it is so good</div><footer>we are us</footer>"


@pytest.mark.parametrize("wrapper", [
    '<div class="layout has-sidebar">{}</div>', '<article class="post comments-open">{}</article>',
    '<div id="page-with-menu">{}</div>', '<div class="has-sidebar"><div id="with-menu"><main>{}</main></div></div>',
    '<div class="sidebar">{}</div>', '<div role="banner" class="notice"><article>{}</article></div>',
    '<div class="page-header-fixed">{}</div>'])
def test_wrappers_with_penalty_words(wrapper):
    body = "\n\n".join(BODY)
    for page in (wrapper.format(PARTS), wrapper.format(SIDE.format(PARTS)), SIDE.format(wrapper.format(PARTS))):
        assert H.main_text(f"<html><body>{page}</body></html>") == body


def test_penalty_words_beside_the_article():
    for side in ("<div class=related><article>A teaser of another story of today</article></div>",
                 f"<section id=comments>{PARTS.replace('Sentence', 'Comment') * 4}</section>",
                 "<div class='site-notice'>Our offices are closed for all of today</div>"):
        for page in (f"<article>{PARTS}</article>{side}", f"<main>{PARTS}{side}</main>", f"{side}<div>{PARTS}</div>",
                     f"<div class='wrap has-sidebar'>{PARTS}{side}</div>"):
            assert H.main_text(page) == "\n\n".join(BODY)


def test_listed_articles_with_states():
    page = "".join(f'<article class="post {c}">{PARTS}</article>' for c in ("", "comments-open", "has-share"))
    assert H.main_text(page) == "\n\n".join(BODY * 3)


def cost(scores, edges, labels):
    return sum(s if s > 0 and not k else -s if s < 0 and k else 0 for s, k in zip(scores, labels)) \
        + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 9)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        best = min(cost(scores, edges, k) for k in itertools.product([False, True], repeat=n))
        assert abs(cost(scores, edges, H.min_cut(scores, edges)) - best) < 1e-6


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "<p>some text here</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = H.op7_html_main(spark, df).collect()
    assert len(out) == 4 and all(r.n_chars == len(r.text) for r in out)
    assert sorted(str(r.page_id) for r in out if not r.text) == ["2"]
    assert H.op7_html_main(spark, df.limit(0)).count() == 0


STORY = "<h1>A title</h1>" + "".join(f"<p>Paragraph {i} of the story says something of some length, with care.</p>"
                                    for i in range(8))
STORY_TEXT = ["A title"] + [f"Paragraph {i} of the story says something of some length, with care." for i in range(8)]
STORY_MENU = "<nav><a href=1>Home</a> <a href=2>News</a></nav>"
SMALL_FORM = "<form><label>Your mail address for our letter</label><input><button>Send</button></form>"


@pytest.mark.parametrize("page", [
    f"<form method=post>{STORY_MENU}<article>{STORY}</article><footer>All rights reserved</footer></form>",
    f"<form method=post>{STORY_MENU}<div id=content>{STORY}</div><footer>All rights reserved</footer></form>",
    f"<form>{STORY_MENU}<div>{STORY}</div></form>",
    f"<header>Site</header><form id=aspnetForm><fieldset><main>{STORY}</main></fieldset></form>",
    f"<noscript><article>{STORY}</article></noscript>",
    f"<form>{STORY_MENU}<article>{STORY}</article>{SMALL_FORM}</form>",
    f"{STORY_MENU}<article>{STORY}{SMALL_FORM}</article>", f"{STORY_MENU}<div>{STORY}</div>{SMALL_FORM}",
    f"{STORY_MENU}<article>{STORY}</article><noscript>Please turn on scripts to see all of this page</noscript>"])
def test_forms_are_judged_by_their_share_of_the_text(page):
    assert H.main_text(f"<html><body>{page}</body></html>") == "\n\n".join(STORY_TEXT)
