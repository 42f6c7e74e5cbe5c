import re

import pytest

from plumbline.llm import maintext


@pytest.fixture(scope="module")
def tree(spark):
    return maintext.train(spark)


def test_tree_learns_its_table(tree):
    rows = maintext.labelled_rows()
    assert all(maintext.is_main(tree, list(r[1:])) == bool(r[0]) for r in rows)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header class="site-header"><p>Site name</p></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-banner">We use many cookies on this site today</div>
<article><header><h1>A &amp; B</h1></header><p>First   <b>bold</b>
line&nbsp;here<br>next &lt;tag&gt; &copy 2 &am<p>Second one.<div class="ad">Buy this now</div><p>End.</article>
<aside><p>Side text of some length here</p></aside><form><label>Mail</label></form>
<section class="comments"><p>Nice one, I liked it a lot.</p></section><footer>&copy; x</footer></body></html>"""


def test_article_without_its_surroundings(tree):
    assert maintext.main_text(PAGE, tree) == "A & B\n\nFirst bold line here next <tag> \u00a9 2 &am\n\nSecond one.\n\nEnd."


def test_cut_pages_and_odd_markup(tree):
    assert maintext.main_text("<article><p>One two.</p><p class='x", tree) == "One two."
    assert maintext.main_text("<article><p>a < b and c > d</p><p>x<!-- never closed", tree) == "a < b and c > d\n\nx"
    assert maintext.main_text("<article><p title='>'>q</p>" + "<p \"" * 2000, tree).startswith("q")
    assert maintext.main_text(None, tree) == maintext.main_text("", tree) == maintext.main_text("<nav><a href=x>y</a></nav>", tree) == ""


def test_pages_in_tables(spark, tree):
    schema = "page_id long, url string, html string, text string"
    big = "<article>" + "<p>word and word again</p>" * 20000 + "</article>"
    rows = [(1, "u", PAGE, "clash"), (1, "u", PAGE, "clash"), (2, None, None, None), (None, "v", "<article><p>Hi</p></article>", None), (3, "w", big, None)]
    got = maintext.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {(r.page_id, r.url): r.text[:5] for r in got} == {(1, "u"): "A & B", (2, None): "", (None, "v"): "Hi", (3, "w"): "word "}
    assert max(r.n_chars for r in got) == 20000 * 21 - 2 + 0 * len(big) - 0 or max(r.n_chars for r in got) == 20000 * len("word and word again") + 2 * 19999
    assert maintext.extract(spark.createDataFrame([], schema), tree).collect() == []


@pytest.mark.parametrize("odd", ["<svg viewBox='0 0 1 1'/>", "<svg a=b />", "<math/>", '<script src="x"/>', "<object/>", "<video src=/v.mp4 />", "<button>", "<select><option>", "<canvas>", "<noscript>", "<audio>"])
def test_elements_that_close_themselves_or_are_never_closed(tree, odd):
    page = f"<article><p>One two three.</p><p>Four {odd}</p><p>Five six seven.</p></article>"
    assert maintext.main_text(page, tree) == "One two three.\n\nFour\n\nFive six seven."
    assert maintext.main_text(page + "<footer><button>x</button><svg>y</svg><script>z</script></footer>", tree) == "One two three.\n\nFour\n\nFive six seven."


def test_formulas_stay_and_closed_elements_go(tree):
    page = "<article><p>One two <math><mi>a</mi><mo>=</mo><mi>b</mi><annotation encoding='x'>a=b</annotation></math> three.</p><noscript><div>no</div></noscript><script src=/a/>no</script><p>End of it.</article>"
    assert maintext.main_text(page, tree) == "One two a=b three.\n\nEnd of it."


def filled(page):
    """A page in the notation of the labelled ones, its words told apart by what the block is."""
    word = {"m": "main", "b": "around", "l": "<a href=/x>link"}
    return re.sub(r"\{([mbl])(\d+)\}", lambda k: " ".join([word[k[1]]] + ["w"] * (int(k[2]) - 1)) + ("</a>" if k[1] == "l" else ""), page)


WRAPPED = [
    "<div class='page no-sidebar'><h1>{m6}</h1><p>{m50}</p><p>{m31}</p></div>",
    "<div class='story share-enabled'><h1>{m6}</h1><p>{m50}</p><p>{m31}</p></div>",
    "<div class='legal-guide'><h1>{m6}</h1><p>{m50}</p><p>{m31}</p><p>{m5}</p><p>{m40}</p></div>",
    "<form id=aspnetForm><div id=top>{l2}</div><div id=main><h1>{m6}</h1><p>{m50}</p><p>{m31}</p></div><nav>{l3}</nav></form>",
]
UNMARKED = [
    "<div id=brand>{b3}</div><article><h1>{m6}</h1><p>{m50}</p></article><div>{b4}</div><p>{l3}</p>",
    "<div>{b2}</div><div>{l2}</div><div>{l1}</div><h1>{m7}</h1><p>{m44}</p><p>{m5}</p><p>{m61}</p><div>{l3}</div><div>{b4}</div>",
    "<p>{l2}</p><p>{l1}</p><p>{m70}</p><p>{m12}</p><p>{m33}</p><p>{l4}</p><p>{l6}</p><p>{b2}</p>",
    "<table><tr><td><p>{l1}</p><p>{l2}</p></td><td><h1>{m5}</h1><p>{m50}</p><p>{m9}</p><p>{m80}</p></td></tr></table><div>{b3}</div>",
]
MARKED = [
    "<h1>{m5}</h1><p>{m60}</p><div class=comments><article class=comment><p>{b120}</p></article><div class=text><p>{b90}</p></div></div>",
    "<article><h1>{m5}</h1><p>{m60}</p></article><section id=comments><article><p>{b120}</p></article></section>",
    "<aside class=related><article><p>{b12}</p></article></aside><h1>{m5}</h1><p>{m60}</p><p>{m41}</p>",
    "<header><h1>{b3}</h1></header><div><h2>{m6}</h2><p>{m44}</p><p>{m39}</p></div><div class=newsletter><p>{b35}</p></div><footer>{b12}</footer>",
]


@pytest.mark.parametrize("page", WRAPPED + UNMARKED + MARKED)
def test_pages_outside_the_labelled_table(tree, page):
    assert page not in maintext.LABELLED
    want = [b.text for b in maintext.blocks(filled(page)) if b.text.startswith("main")]
    assert maintext.main_text(filled(page), tree).split("\n\n") == want


def test_neighbours_decide_where_nothing_is_marked(tree):
    def used(node):
        return set() if isinstance(node, bool) else {maintext.FEATURES[node[0]]} | used(node[2]) | used(node[3])

    assert {"words", "links"} <= used(tree) and len(used(tree) & {"words_before", "links_before", "words_after", "links_after"}) >= 3
    for page in UNMARKED[1:]:  # nothing here is named: the rule of names alone keeps all or nothing
        assert not any(b.surround or b.article or b.header for b in maintext.blocks(filled(page)))
    short = [0.0] * len(maintext.FEATURES)
    at = maintext.FEATURES.index
    short[at("words")], short[at("words_before")] = 4.0, 30.0
    among, last = list(short), list(short)
    among[at("words_after")], last[at("words_after")], last[at("links_after")] = 30.0, 3.0, 1.0
    assert maintext.is_main(tree, among) and not maintext.is_main(tree, last)
