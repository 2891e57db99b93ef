import itertools
import random

from shelfscope.llm import htmltext as h

PAGES = "page_id long, url string, html string, text int, blocks string"
SENTENCE = "This sentence has a good number of words and ends with a mark."


def test_min_cut_is_minimal():
    rnd = random.Random(6)
    for _ in range(300):
        n = rnd.randrange(1, 8)
        cost = [rnd.choice([-3, -1, -.5, 0, .5, 1, 3]) * rnd.random() for _ in range(n)]
        edges = {(a, b): rnd.random() * 1.5 for a, b in itertools.combinations(range(n), 2) if rnd.random() < .5}

        def value(side):
            cut = sum(c for c, s in zip(cost, side) if c > 0 and not s) + sum(-c for c, s in zip(cost, side) if c < 0 and s)
            return cut + sum(w for (a, b), w in edges.items() if side[a] != side[b])
        best = min(value(s) for s in itertools.product([False, True], repeat=n))
        assert abs(value(h.min_cut(cost, edges)) - best) < 1e-9


def test_article_without_its_surroundings():
    page = f"""<!doctype html><html><head><title>t</title><style>p{{}}</style><script>if (a < b) x("</p>")</script></head><body>
      <header><h1>Site name</h1></header><div id="cookie-notice">We use cookies. {SENTENCE}</div><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
      <div class="sidebar"><p>{SENTENCE}</p></div><!-- <p>hidden</p> -->
      <article><header><h1>Head &amp; line</h1></header><p>First&nbsp;<b>bold</b>ed\n  text: {SENTENCE}<br>After break.</p><p>Short.</p>
      <div class="ad">Buy now! {SENTENCE}</div><ul><li>Item one of the list.</li><li>Item two</li></ul><p title="a > b">{SENTENCE}
      <p>Unclosed {SENTENCE}</p><form><p>Your mail {SENTENCE}</p><input></form></article>
      <section id="comments"><p>I am a reader and I say: {SENTENCE}</p></section><aside><p>{SENTENCE}</p></aside>
      <noscript>Enable scripts. {SENTENCE}</noscript><footer>&copy; 2024 {SENTENCE}</footer></body></html>"""
    assert h.extract(page).split("\n") == ["Head & line", f"First bolded text: {SENTENCE} After break.", "Short.", "Item one of the list.",
                                           "Item two", SENTENCE, f"Unclosed {SENTENCE}"]


def test_pages_without_an_article_element():
    body = "".join(f"<div><p>{SENTENCE} Number {i}.</p></div>" for i in range(5))
    menu = "<div class=menu><a href=x>Home</a> <a href=y>About</a></div>"
    links = "<ul>" + "".join(f"<li><a href=/{i}>link number {i}</a></li>" for i in range(9)) + "</ul>"
    got = h.extract(f"<html><body>{menu}{links}<div>{body}</div>{links}</body></html>").split("\n")
    assert got == [f"{SENTENCE} Number {i}." for i in range(5)]


def test_odd_markup():
    assert h.extract(None) == h.extract("") == h.extract("<p></p><!-- x") == h.extract("<script>x") == h.extract("<nav>a b c</nav>") == ""
    assert h.extract(f"<article>{SENTENCE}<p>{SENTENCE}") == f"{SENTENCE}\n{SENTENCE}"
    assert h.extract(f'<article><p class="unclosed>{SENTENCE}</p><p>{SENTENCE}</p></article>').endswith(SENTENCE)
    assert h.extract(f"<article><p>1 < 2 &lt;b&gt; &#233; &unknown; {SENTENCE}</p></article>") == f"1 < 2 <b> é &unknown; {SENTENCE}"
    deep = "<div>" * 3000 + f"<article><p>{SENTENCE}</p></article>"
    assert h.extract(deep) == SENTENCE
    long = "<article>" + f"<p>{SENTENCE}</p>" * 5000 + "</article>"
    assert h.extract(long).count("\n") == 4999


def test_attribute_values_of_any_length():
    for n in (10, 9_999, 10_001, 300_000):
        for inside in ("<nav> > ", "<script> > ", " class='ad' id='ad' > "):
            value = inside + "x" * n + inside
            page = f'<article data-a="{value}"><p srcdoc="{value}">{SENTENCE}</p><p data-b = "{value}" title=it\'s>{SENTENCE}</p></article>'
            assert h.extract(page) == f"{SENTENCE}\n{SENTENCE}"
        # a quote without its close, and quotes that open no value, are ordinary characters
        assert h.extract(f'<article><p title="a > b" class="{"x" * n}>{SENTENCE}</p><p>{SENTENCE}</p></article>') == f"{SENTENCE}\n{SENTENCE}"
        assert h.extract(f"<article><p title=don't>{SENTENCE}</p><p>{'word ' * n}isn't it.</p></article>").startswith(f"{SENTENCE}\nword word")
    assert h.extract("<p a='" * 100_000 + "<p a=\"" * 100_001 + f"><article><p>{SENTENCE}</p></article>") == SENTENCE


def test_certain_boilerplate_of_any_length():
    around = f"<p>{SENTENCE}</p>" * 3
    for words in (15, 47, 48, 50, 500, 5_000, 200_000):
        text = "Buy " + "it now " * (words // 2) + "at once."
        for a, b in (("<div class=ad>", "</div>"), ("<div class='notice'><p>", "</p></div>"), ("<section id=comments><article><p>", "</p></article></section>"),
                     ("<aside><p>", "</p></aside>"), ("<div role=complementary><blockquote>", "</blockquote></div>"), ("<p hidden>", "</p>"),
                     ("<div style='display: none'><p>", "</p></div>"), ("<form><p>", "</p></form>")):
            for doc in ("<article>{}</article>", "<main>{}</main>", "<body><div>{}</div></body>"):
                assert h.extract(doc.format(around + a + text + b + around)).split("\n") == [SENTENCE] * 6, (words, a, doc)


def test_names_of_the_layout_around_the_article():
    for words in (5, 30, 100, 5_000):
        text = "word " * (words - 1) + "end."
        inner = f"<p>{text}</p><div class=ad>Buy. {text}</div><section class=comments><p>{text}</p></section><p>{text}</p>"
        side = f"<div class=sidebar><p>{text}</p></div><div class=ad-container><p>{text}</p></div><div id=comment-list><p>{text}</p></div>"
        side += f"<section class=related-posts><article><p>{text}</p></article></section>"
        for name in ("content-sidebar-wrap", "has-sidebar", "page with-comments", "overflow-hidden", "comments-open", "page-with-sidebar", "no-ads", "contentSidebarWrap",
                     "sidebar", "search-results", "sidebar-wrap", "paywall"):
            for kind in (f"class='{name}'", f"id='{name}'"):
                for a, b in (("<article>", "</article>"), ("<main>", "</main>"), ("<div role=main>", "</div>")):
                    assert h.extract(f"<body><div {kind}>{a}{inner}{b}{side}</div></body>") == f"{text}\n{text}", (words, name, a)
        for name in ("content-sidebar-wrap", "has-sidebar", "page with-comments"):  # no article element
            assert h.extract(f"<div class='{name}'><div class=content>{inner * 3}</div>{side}</div>").split("\n") == [text] * 6, (words, name)
    for name in ("ad", "ad-container", "top-ad", "comments", "comment-body", "related-posts", "sidebarLeft", "post-share-buttons", "cookie_notice", "div-comment-5"):
        assert h.name_kind(name), name
    # comments and teasers written as articles stay out, also where the text has no article element
    for a, b in (("<article>", "</article>"), ("<div>", "</div>")):
        page = f"{a}{f'<p>{SENTENCE}</p>' * 3}{b}<div id=comments><article><p>{SENTENCE}</p></article></div><div class=related><article><p>{SENTENCE}</p></article></div>"
        assert h.extract(page).split("\n") == [SENTENCE] * 3


def test_buttons_and_media_without_a_close_or_nested():
    good = f"<p>{SENTENCE}</p>"
    for tag in ("button", "select", "object", "canvas", "svg", "math", "audio", "video", "template"):
        o, c = f"<{tag} class=x>", f"</{tag}>"
        assert h.extract(f"<body>{o}<article>{good}{good}</article></body>").split("\n") == [SENTENCE] * 2, tag
        assert h.extract(f"<article>{good}{o}Share {good}<div>{o}Share</div>{good}</article>{good}").split("\n")[:3] == [SENTENCE] * 3, tag
        assert h.extract(f"<article><p>{SENTENCE} <b>{o}no</b> {SENTENCE}</p>{good}</article>") == f"{SENTENCE} {SENTENCE}\n{SENTENCE}", tag
        assert h.extract(f"<article>{good}<div>{o}no</div>{good}{o}no {c}{good}</article>").split("\n") == [SENTENCE] * 3, tag
        # closed: all of it is left out, nested ones too; the paragraph around it stays one
        nested = f"{o}no {o}no <g>no</g>{c} outer rest {SENTENCE}{c}"
        assert h.extract(f"<article>{good}{nested}{good}<p>{SENTENCE}{nested} {SENTENCE}</p></article>") == f"{SENTENCE}\n{SENTENCE}\n{SENTENCE} {SENTENCE}", tag
        assert h.extract(f"<article>{good}{o}<div>{good}</div>{c}{good}</article>") == f"{SENTENCE}\n{SENTENCE}", tag
        assert h.extract(f"<article>{good}<script>'{o}'</script><!--{o}-->{good}</article>") == f"{SENTENCE}\n{SENTENCE}", tag
        assert h.extract(o * 50_000 + f"<article>{good}</article>") == SENTENCE
        assert h.extract(o * 50_000 + c * 50_000 + f"<article>{good}</article>") == SENTENCE
    assert h.extract(f"<article>{good}<select><option>One<optgroup><option>Two</optgroup>{good}</article>") == f"{SENTENCE}\n{SENTENCE}"
    for tag in ("script", "style", "textarea", "title"):
        assert h.extract(f"<article>{good}<{tag}>{good}</article>") == SENTENCE


def test_query_rows(spark):
    rows = [(1, "u", f"<article><p>é {SENTENCE}</p></article>"), (1, "u", f"<article><p>é {SENTENCE}</p></article>"), (2, None, None), (None, "", ""), (3, "x", "<br>")]
    got = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in h.query(spark.createDataFrame([(*r, 1, "b") for r in rows], PAGES)).collect())
    assert got == sorted((str(i), str(u), h.extract(x), len(h.extract(x))) for i, u, x in rows)
    assert h.query(spark.createDataFrame([], PAGES)).count() == 0
