import pytest

from eventlens.llm import html_text as h

TREE = h.train_tree()
LONG = "Words of the main text go on for a while so that this block is long enough to count, and then some more of them"


def test_tree_fits_its_table():
    assert all(h.decide(TREE, r) == r[-1] for r in h.LABELLED)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""),
    ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a href=x>Home</a></nav>"
     "<div class='ad'>Buy</div><article><h1>Head &am</h1><p><b>One  two.<br><p>Three &lt;b&gt; &eacute;\n four</p><p>x</p></article>"
     "<footer>&copy; me</footer>", "Head &am\nOne two.\nThree <b> é four\nx"),
    ("<main><p>Text</p><aside>side</aside><form><p>Name</p><input></form><div id=\"user-comments\"><p>nice</p></div>"
     "<div class=\"cookie-notice\"><div>ok</div></div><p>End</p></main>", "Text\nEnd"),
    (f"<body><div><a href=a>Home</a> <a href=b>News</a></div><p>{LONG}</p><p>{LONG}</p><div>(c) x</div></body>", f"{LONG}\n{LONG}"),
    ("<article><p>kept <!-- not --> this<p>1 < 2 and a<b>c</b>d</article><p>after</p>", "kept this\n1 < 2 and acd"),
    ("<article><p>cut <a href='x", "cut"), ("<article><p>q</p><script>never closed <p>z</p>", "q"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ('<article><p title="a > b">in</p></article>', "in"),
])
def test_pages(page, text):
    assert h.main_text(page or "", TREE) == text


@pytest.mark.parametrize("box", [
    "<div class='comments'><article class='comment'><p>Nice</p></article><article class='comment'><p>Not so nice</p></article></div>",
    "<aside><article><p>A teaser with a few words</p></article></aside>",
    "<div class='related'><main><p>A teaser</p></main></div>",
])
def test_an_article_in_a_box_is_no_main_container(box):
    for page in (f"<body><div><p>{LONG}</p><p>{LONG}</p></div>{box}</body>", f"<body>{box}<div><p>{LONG}</p><p>{LONG}</p></div></body>"):
        assert h.main_text(page, TREE) == f"{LONG}\n{LONG}"


def test_one_card_does_not_turn_off_the_text_beside_it():
    more = " ".join([LONG, LONG])
    page = f"<article><p>A card</p></article><div><p>{more}</p><p>{more}</p><p><a href=x>{more}</a></p><p>short</p></div>"
    assert h.main_text(page, TREE) == f"A card\n{more}\n{more}"


def test_long_malformed_page_is_linear():
    assert h.main_text("<article><p>" + "<a b='" * 3000 + "x " * 100_000, TREE) is not None


def test_query_rows(spark):
    rows = [(1, "u", "<article><p>é x</p></article>", 5), (1, "u", "<article><p>é x</p></article>", 5), (None, None, None, None)]
    out = h.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert sorted(map(tuple, out), key=repr) == sorted([(1, "u", "é x", 3)] * 2 + [(None, None, "", 0)], key=repr)
    assert h.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
