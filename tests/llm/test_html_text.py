import pytest

from gridpanel.llm.html_text import extract, main_text

PARA = "A long enough paragraph of the article, with several words in it. " * 3


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<article><h1>T</h1><p>a &amp; b&nbsp;c<br>d<p>e</article>", "T\na & b c d\ne"),
    ("<body><nav><ul><li>Menu</li></ul></nav><article><p><b>x.<br><p>y</p><p>Be.</p></article><footer>f</footer>", "x.\ny\nBe."),
    (f"<div class='ad'>{PARA}</div><main><p>Short.</p></main>", "Short."),
    (f"<article><p>One.</p><script>var a='</p>'</script><style>p{{}}</style><p>Two.</p><!-- no --></article>", "One.\nTwo."),
    (f"<article><p>Body.</p><section id='userComments'><p>{PARA}</p></section><p>End.</p></article>", "Body.\nEnd."),
    ("<article><header><h1>Head</h1></header><p>x</p></article><header>site</header>", "Head\nx"),
    ("<article><p>x <span class='ad-label'>buy</span> y</p><form><input><button>Send</button></form></article>", "x y"),
    ("<div class='has-sidebar'><article><p>In.</p></article><aside>out</aside></div>", "In."),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\ntwo\nc1\nc2"),
    ("<article><p>&#233;&eacute;&#x1F600;&lt;b&gt;</p></article>", "éé😀<b>"),
    ("<article><p>cut off", "cut off"),
    (f"<div>{PARA}</div><div role='navigation'>{PARA}</div><div style='display: none'>z</div>", " ".join(PARA.split())),
])
def test_extract(html, text):
    assert extract(html) == text


def test_threshold_drops_link_lists_of_a_page_without_article():
    links = "".join(f"<li><a href='/{i}'>go</a></li>" for i in range(30))
    body = "".join(f"<p>{PARA}{i}</p>" for i in range(8))
    got = extract(f"<body><div><ul>{links}</ul></div><div>{body}</div></body>")
    assert "go" not in got.split() and got.count("\n") == 7


def test_short_blocks_of_an_article_in_parts_of_their_own():
    body = "".join(f"<p>{PARA}{i}</p>" for i in range(5))
    got = extract(f"<article><div><h1>Title</h1></div>{body}<table><tr><td>c1<td>c22</table>"
                  f"<blockquote><p>A short quote.</p></blockquote></article>").split("\n")
    assert got[0] == "Title" and got[6:] == ["c1", "c22", "A short quote."] and len(got) == 9


@pytest.mark.parametrize("html, text", [
    ("<article><p>a</p><section id='discussion'><p>b</p></section></article>", "a\nb"),
    ("<article><section id='market-share'><h2 id='related-work'>Related</h2><p>c</p></section></article>", "Related\nc"),
    ("<p>out</p><article class='post category-social'><p>d</p></article>", "d"),
    ("<main id='social'><div class='notice'>Mind.</div><pre><span class='token comment'># x</span> y</pre></main>", "Mind.\n# x y"),
    ("<article><p>e</p><div class='share-buttons'>s</div><ol class='comment-list'><li>r</ol><div class='related'>t</div>"
     "<div id='cookie-notice'>n</div></article>", "e"),
])
def test_content_of_an_article_with_a_boilerplate_word_in_its_name(html, text):
    assert extract(html) == text


def test_frame(spark):
    rows = [(1, None, "<article><p>x</article>", "t"), (1, None, "<article><p>x</article>", "t"), (None, "u", None, "t"),
            (2, "u", "<article>" + "<p>word &amp; more</p>" * 20_000 + "</article>", "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {(r.page_id, r.n_chars) for r in main_text(df).collect()}
    assert got == {(1, 1), (None, 0), (2, 20_000 * 12 - 1)} and main_text(df).count() == 4
    assert main_text(df).columns == ["page_id", "url", "text", "n_chars"]
    assert main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("part", [
    "<div class='newsletter-box-v2'><p>{}</p></div>", "<div class='promo-unit'>{}</div>", "<div id='ad_300x250'>{}</div>",
    "<div class='js-ad-slot'><p>{}</p></div>", "<section class='article-comments-v2'><p>{}</p></section>",
    "<div id='respond'><p>{}</p></div>", "<header class='site-header'><p>{}</p></header>"])
@pytest.mark.parametrize("words", ["Short.", PARA])
def test_boilerplate_within_an_article(part, words):
    html = f"<article><h1>Title</h1><p>{PARA}</p>{part.format(words)}<p>End.</p></article>"
    assert extract(html) == f"Title\n{PARA.strip()}\nEnd."


@pytest.mark.parametrize("html, text", [
    (f"<article><p>Own.</p></article><article class='comment'><p>{PARA}</p></article>", "Own."),
    (f"<main><h1>T</h1><p>Own.</p><article class='teaser related'><p>{PARA}</p></article></main>", "T\nOwn."),
    ("<article class='comment'><p>All there is.</p></article>", "All there is."),
    # the ratio decides about a part that is named in a doubtful way
    (f"<article><p>{PARA}</p><div class='market-share'><p>{PARA}</p><p>So.</p></div></article>", "\n".join([PARA.strip()] * 2 + ["So."])),
    (f"<article><p>{PARA}</p><div class='tip-share'><ul><li><a>go</a></li><li><a>to</a></li></ul></div></article>", PARA.strip()),
])
def test_regions_of_a_page_with_an_article(html, text):
    assert extract(html) == text


def test_planted_pages():
    """Pages put together at random from parts whose text is or is not the article's."""
    import random

    r = random.Random(11)

    def words(n):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(n)).capitalize() + "."

    def block():
        kind, t = r.randrange(6), words(r.choice([1, 4, 30, 90]))
        if kind == 0:
            return f"<h2>{t}</h2>", [t]
        if kind == 1:
            u = words(3)
            return f"<ul><li>{t}<li>{u}</ul>", [t, u]
        if kind == 2:
            return f"<div><section><blockquote><p>{t}</p></blockquote></section></div>", [t]
        if kind == 3:
            return f"<table><tr><td>{t}<td>x</table>", [t, "x"]
        return f"<p>{t[:-1]} <b>&amp;</b> <a href='#'>more</a>.", [f"{t[:-1]} & more."]

    names = ["class='share-buttons'", "id='comments'", "class='ad-slot'", "class='related-posts'", "role='complementary'", "hidden"]
    for _ in range(150):
        want, body = [], ""
        for _ in range(r.randint(1, 12)):
            html, text = block()
            body, want = body + html, want + text
            if r.random() < 0.3:
                body += f"<div {r.choice(names)}><p>{words(r.choice([2, 60]))}</p></div>"
        tag = r.choice(["article", "main", "main><article"])
        end = "</article></main>" if "><" in tag else f"</{tag}>"
        around = f"<div class='ad'>{words(9)}</div><div><p>{words(40)}</p></div>"
        page = f"<body><header>{words(5)}</header><nav><a>{words(1)}</a></nav>{around}<{tag}>{body}{end}<footer>{words(30)}</footer>"
        assert extract(page).split("\n") == want
