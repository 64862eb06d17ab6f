import time

from wattframe.llm.extraction import main_text, main_texts

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><a href=/>Home</a><p>Site, name, motto</p></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div id="cookie-notice">We use cookies, ok, yes?</div>
<div class="layout"><div class="sidebar"><p>Side, text, here, and, more.</p></div>
<div class="post-content"><h2>Title &amp; more</h2><p>One, two<br>three &lt;b&gt; <b>bold</b>.</p><ul><li>a<li>b</ul>
<!-- <p>hidden</p> --><div class="ad">Buy, now</div><p>Another  paragraph,
 with lines.<form><input><p>mail, me, please</p></form></div>
<div class="related"><a>x</a><a>y</a><a>z</a></div>
<section id="comments"><p>nice, post, a long reader comment, really, so long, and, more</p></section></div>
<footer>&copy; all</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == "Title & more\nOne, two three <b> bold.\na\nb\nAnother paragraph, with lines."


def test_odd_markup():
    assert main_text("<p>one<p>two") == "one\ntwo"
    assert main_text("just text, no tags") == "just text, no tags"
    assert main_text("<article><p>a < b & c<b>d</article>") == "a < b & cd"
    assert main_text("<article><p>body</article><article class=comment><p>no</article>") == "body"
    assert main_text("<p>cut off <a href='x") == "cut off"
    assert main_text(None) == main_text("") == main_text("<nav><p>only menu</nav>") == ""
    assert main_text("<div>" * 5000 + "deep") == "deep"


def test_long_page_is_read_whole():
    words = " ".join(["word, and"] * 50_000)
    assert main_text(f"<body><article><p>{words}</p><p>end</p></article>") == f"{words}\nend"


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (2, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = main_texts(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, found.collect()), key=repr)
    text = main_text(PAGE)
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert main_texts(pages.limit(0)).collect() == []


def test_a_noise_word_in_a_wrapper_drops_no_article():
    for wrapper in (
        '<div class="content-sidebar-wrap"><main>{}</main></div>',
        '<div class="content-sidebar-wrap"><article>{}</article></div>',
        '<div id="content" class="has-sidebar">{}</div>',
        '<article class="post comments-open">{}</article>',
        '<div class="post-with-comments">{}</div>',
    ):
        page = wrapper.format("<p>One, two, <b>three</b>.</p><p>Four, five.</p>")
        assert main_text(f"<body>{page}<div class=sidebar><p>side</div></body>") == "One, two, three.\nFour, five.", wrapper
    comments = "<div class=comment-list><article class=comment-body><p>No, no, no, no, no, no, no.</p></article></div>"
    assert main_text(f"<body><article><p>Yes, yes.</p></article>{comments}</body>") == "Yes, yes."
    assert main_text("<article><p>Yes, yes.</p><div class=share-this><p>No.</p></div></article>") == "Yes, yes."


def test_what_stands_beside_the_container_stays():
    story = "".join(f"<p>Long paragraph {i}, with commas, and more words, {'so on, ' * 20}end.</p>" for i in range(3))
    page = (
        f"<body><ul><li><a>Home</a><li><a>News</a><li><a>More</a></ul><div id=story>{story}</div><ul><li>fact one<li>fact two</ul>"
        "<table><tr><td>1<td>2</table>loose <b>text</b><dl><dt>term<dd>meaning</dl><figure><figcaption>Picture</figure>"
        "<section><h2>Second</h2><p>Short.</section><div class=sidebar><p>Side</div><p>Short end.</p>"
        "<ul><li><a>Terms</a><li><a>Press</a><li><a>Jobs</a></ul></body>"
    )
    lines = main_text(page).split("\n")
    assert [line.split()[0] for line in lines[:3]] == ["Long"] * 3
    assert lines[3:] == [
        "fact one", "fact two", "1 2", "loose text", "term", "meaning", "Picture", "Second", "Short.", "Short end."
    ]


def test_links_of_an_article_stay():
    page = (
        "<article><p>One, two, three.</p><h2>References</h2><ul><li><a>A, 2001</a><li><a>B, 2002</a><li><a>C, 2003</a></ul>"
        "<p><a>First source</a>, <a>second source</a>, <a>third source</a></p>"
        "<ol><li><a>A long title of a paper on rivers</a><li><a>Another title of a paper on lakes</a><li><a>The third title of a paper on seas</a></ol>"
        "<ul><li><a>Home</a><li><a>News</a><li><a>More</a></ul></article>"
    )
    assert main_text(page).split("\n") == [
        "One, two, three.", "References", "A, 2001", "B, 2002", "C, 2003", "First source, second source, third source",
        "A long title of a paper on rivers", "Another title of a paper on lakes", "The third title of a paper on seas",
    ]


def test_a_quote_within_a_tag_ends_with_the_tag():
    assert main_text("<article><p it's>one</p><p>two</p><p it's>three</p></article>") == "one\ntwo\nthree"
    assert main_text("<article><p title='a > b' lang=\"x>y\">one</p><p a=\"b>two</p></article>") == "one\ntwo"


def test_nested_articles_and_what_follows_one():
    nested = "<article><p>Opening, words.</p><article><p>Inner, {}</p></article><p>Closing.</p></article>"
    inner = "many, words, " * 30
    assert main_text(nested.format(inner)) == f"Opening, words.\nInner, {inner.strip()}\nClosing."
    page = "<main><article><p>Story, one.</p></article><div><p>Outro.</p></div><article><h3><a>Other story</a></h3></article></main>"
    assert main_text(page) == "Story, one.\nOutro."


def test_class_words_that_articles_use():
    page = "<article><p>One, two.</p>{}<p>End.</p></article>"
    for own in ("<p class=social-history>Own.</p>", "<section class=alert-systems><p>Own.</p></section>", "<p class=share-prices>Own.</p>"):
        assert main_text(page.format(own)) == "One, two.\nOwn.\nEnd.", own
    for noise in ("<p class=social>No.</p>", "<div class=alert-box><p>No.</p></div>", "<div class=share-this><p>No.</p></div>"):
        assert main_text(page.format(noise)) == "One, two.\nEnd.", noise


def test_deep_and_broken_pages_in_linear_time():
    start = time.process_time()
    deep = 100_000
    assert main_text("<article>" + "<div>" * deep + "deep") == "deep"
    assert main_text("<p><table><tr><td>" + "<div>" * 30_000 + "deep").endswith("deep")
    assert main_text("<article><li><ul>" + "<div>" * 30_000 + "<li>x</li>" * 30_000).count("x") == 30_000
    assert main_text("<article><p>a" + "<b x='" * 30_000).startswith("a")
    assert time.process_time() - start < 30
