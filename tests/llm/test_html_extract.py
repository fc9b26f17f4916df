import pytest

from orderdw.llm.html_extract import extract, main_text

LONG = "A sentence that goes on, with commas, for long enough to be the text of an article. " * 3


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; simple", "plain & simple"),
    ("<script>var t='</p>';</script><style>p{}</style>", ""),
    ("<body><nav><a href=x>Menu</a></nav><article><h1>Title</h1><p><b>Some  text<br>more"
     "<p>next &copy; &#8364;</article><footer>foot</footer>", "Title\n\nSome text more\n\nnext © €"),
    ("<!-- c --><header>top</header><main><p>one<p>two</main><aside>side</aside>", "one\n\ntwo"),
    ("<article><p>x</p><section class='comments'><p>reader</p></section></article>", "x"),
    ("<article><div class='cookie-notice'>ok?</div><form>name<input></form><p>x</p></article>", "x"),
    ("<p>unclosed <b>bold <i>both</p><p>next", "unclosed bold both\n\nnext"),
    ("<ul><li>a<li>b</ul>", "a\n\nb"),
    ("<body class='single comments-open'><div class='wrap has-sidebar'><div class='post-content'>"
     "<p>x</p><div class='article-footer'>y</div></div><div id=main-sidebar>z</div>", "x"),
    ("<article><p>x</p><article class=comment><p>c</p></article></article>", "x"),
    ("<div class=post><div class=entry-header><h1>T</h1></div><p>x</p></div>"
     "<div class=site-header>s</div>", "T\n\nx"),
    ("<article><p>x<p hidden>h<p>y<div role=alert>a</div><p class='ad'>ad</p></article>", "x\n\ny"),
    ("<article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
])
def test_small_pages(html, want):
    assert main_text(html) == want


def test_without_article_element():
    page = (f"<body><div class='top menu'><ul><li><a href=1>Home</a><li><a href=2>News</a><li>"
            f"<a href=3>About</a></ul></div><div id=wrap><div class='post'><h2>Short title</h2>"
            f"<p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div class='right-sidebar'><p>{LONG}</p>"
            f"</div><div class='box'><ul><li><a href=4>More news</a><li><a href=5>Other</a><li>"
            f"<a href=6>Third</a></ul></div></div><div id='footer'>(c) us</div>")
    text = LONG.strip()
    assert main_text(page) == f"Short title\n\n{text}\n\nYes.\n\n{text}"


LONGER = LONG * 4
NEUTRAL = (f"<body><div id=a1><div class='c2'><h2>Short title</h2><p>{LONGER}</p><p>Yes.</p>"
           f"<ul><li>one<li>two</ul><p>{LONGER}</p><div class='k1'><h3>More</h3>"
           + "".join(f"<div><a href={i}>Story {i}</a> read</div>" for i in range(6))
           + f"</div><p>{LONGER}</p></div>"
           f"<div class='z9'><div>Kiosk 12</div><div>Map</div></div></div>")


def test_ratios_choose_the_blocks_where_no_name_tells_them(monkeypatch):
    from orderdw.llm import html_extract
    text = LONGER.strip()
    want = f"Short title\n\n{text}\n\nYes.\n\none\n\ntwo\n\n{text}\n\n{text}"
    assert main_text(NEUTRAL) == want
    monkeypatch.setattr(html_extract, "content_paths", lambda blocks: {p for p, _ in blocks})
    assert main_text(NEUTRAL) != want


def plain_ratios(blocks):
    """The content paths by the definition, with nothing shared between blocks."""
    def ratio(path, of):
        mine = [t for p, t in blocks if p == path]
        return sum(map(of, mine)) / len(mine)

    marks = set(".,;:!?…。，、；：！？।؟،")
    raw = [[ratio(p, of) for p, _ in blocks] for of in (len, lambda t: sum(c in marks for c in t))]
    smooth = [[0.25 * r[max(0, i - 1)] + 0.5 * r[i] + 0.25 * r[min(len(r) - 1, i + 1)]
               for i in range(len(r))] for r in raw]
    fused = [(c * (1 + m)) ** 0.5 for c, m in zip(*smooth)]
    mean = sum(fused) / len(fused)
    paths = {p for p, _ in blocks}
    return {p for p in paths if sum(f for f, (q, _) in zip(fused, blocks) if q == p)
            / sum(q == p for q, _ in blocks) >= 0.4 * mean - 1e-12}


def test_ratios_like_their_definition():
    import random

    from orderdw.llm.html_extract import content_paths
    rng = random.Random(2)
    for _ in range(200):
        blocks = [(rng.randrange(6), "".join(rng.choice("abc .,;!") for _ in range(rng.choice(
            [1, 5, 80])))) for _ in range(rng.randint(1, 25))]
        assert content_paths(blocks) == plain_ratios(blocks)


@pytest.mark.parametrize("html", [
    "<a " * 350_000, "<p>x</p>" + "<!-- " * 200_000, "<div>" * 8000 + "</b>" * 8000 + "x",
    "<center>" * 8000 + "x", "<div>" * 8000 + "</span></i>" * 8000, "&" * 500_000, "<" * 500_000,
    "<p" * 300_000 + ">x"])
def test_broken_markup_takes_no_longer_than_its_length(html):
    import time
    began = time.process_time()
    main_text(html)
    assert time.process_time() - began < 5


def test_frame(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "u", "<p>a", 9), (1, "u", "<p>a", 9), (2, None, None, 9), (None, "v", deep, 9),
            (3, "w", "<p>" + "word " * 200_000, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    want = [(1, "u", "a", 1)] * 2 + [(2, None, "", 0), (None, "v", "deep", 4),
                                     (3, "w", ("word " * 200_000).strip(), 999_999)]
    assert got == sorted(want, key=str)
    assert extract(pages.limit(0)).count() == 0
