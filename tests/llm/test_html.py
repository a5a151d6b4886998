import pytest
from hypothesis import given
from hypothesis import strategies as st

from termweave.llm import html as H

LONG = "A paragraph with a good many words in it, so that its weight is that of running text."
CASES = {
    "marks": (
        "<html><head><title>t</title><style>p>a{}</style></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<article><header><h1>Head</h1><p>By me</p></header><p>One &amp; two<p>Three<br>four <b>bold</b>"
        "<aside>no</aside><ul><li>i<li>j</ul><form><label>Mail</label><input></form>"
        "<section class='comments'><p>no</p></section></article><footer>no</footer>",
        "Head\nOne & two\nThree four bold\ni\nj",
    ),
    "no marks": (
        f"<div id=menu><a href=/>Home</a> <a href=/a>About</a></div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
        f"<div class='sidebar'><p>{LONG}</p></div><div class=cookie-notice>{LONG}</div><p>&copy; 2020 me</p>",
        f"Title\n{LONG}\nShort.\n{LONG}",
    ),
    "surge and dive": (
        "".join(f"<div><a href=/{k}>Link number {k} of a long list</a></div>" for k in range(9)) + f"<p>{LONG}</p><p>x</p>"
        + "".join(f"<div><a href=/{k}>Another link {k}</a></div>" for k in range(9)),
        f"{LONG}\nx",
    ),
    "adverts": ("<article><p>a</p><div class='ad'><div>Buy</div>now</div><p class='promo'>no</p><p>b</p><article class=comment>no</article></article>", "a\nb"),
    "layout": ("<body class='has-sidebar'><div class='no-ads'><p>text</p></div>", "text"),
    "hidden": ("<p>a</p><p hidden>b</p><p style='display: none'>c</p><div aria-hidden=true>d</div>", "a"),
    "references": ("<p>&lt;p&gt; &#233;&nbsp;&eacute;  \n x &amp &copy;</p>", "<p> é é x & ©"),
    "attributes": ("<p title='a>b' class=\"x\">1 < 2</p><script>if (a<b) { w('</p><p>no') }</script><!-- <p>no</p> -->", "1 < 2"),
    "broken": ("<article><p>Open <b>bold <i>text<p>Next<div class=ad>no<div>no</div></div>tail</article><footer>no", "Open bold text\nNext\ntail"),
    "cut off": ("<article><p>one</p><p>two <a href='x", "one\ntwo"),
    "comment open": ("<p>a</p><!-- no end <p>b</p>", "a"),
    "table": ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    "links inside": (
        f"<article><h1><a href=/>Head</a></h1><p>{LONG}</p><p>See <a href=/x>this</a>.</p><p><a href=/y>One link</a></p><p>Short.</p>"
        "<h3>Read on</h3><ul>" + "".join(f"<li><a href=/{k}>Another story {k}</a></li>" for k in range(5)) + "</ul>"
        f"<p>{LONG}</p><div>" + "".join(f"<div><a href=/{k}>Buy {k}</a> |</div>" for k in range(5)) + "</div></article>",
        f"Head\n{LONG}\nSee this.\nOne link\nShort.\n{LONG}",
    ),
    "teaser": (
        f"<div><h1>Title</h1>{f'<p>{LONG}</p>' * 5}</div><article><h2><a href=/t>Teaser</a></h2></article>"
        "<article><p>Another story.</p></article>",
        "Title\n" + "\n".join([LONG] * 5) + "\nTeaser\nAnother story.",
    ),
    "all links": ("<article><p><a href=/a>one</a></p><p><a href=/b>two</a></p></article>", "one\ntwo"),
    "anchors": (f"<article><a name=top><p>{LONG}</p><p>b</p><a href=/x>open<p>{LONG}</p></article>", f"{LONG}\nb\nopen\n{LONG}"),
    "header names": (
        f"<article><div class='entry-header'><div><h1>Head</h1></div><span>By me</span></div><p>{LONG}</p></article>"
        "<div class='page-header'><h2>Site</h2></div>",
        f"Head\n{LONG}",
    ),
    "header without marks": (f"<div class='article-header'><h1>Head</h1><p>{LONG}</p></div><p>{LONG}</p>", f"Head\n{LONG}"),
    "names as evidence": (
        f"<article><section class='social-history'><h2 id=search>Search</h2><p>{LONG}</p><p>{LONG}</p></section>"
        f"<section id=form><p>{LONG}</p><p>{LONG}</p></section><div class='market-share'><p>{LONG}</p><p>{LONG}</p></div>"
        "<div class='social-media'><p>Follow us there.</p></div><div class='contact-form'><p>Your name.</p></div>"
        f"<div class='ad-box-2'><p>{LONG}</p><p>{LONG}</p></div><div id=comments><p>{LONG}</p><p>{LONG}</p></div></article>",
        "\n".join(["Search"] + [LONG] * 6),
    ),
    "short sentence": (
        f"<article><p>{LONG}</p>" + "<ul><li><a href=/a>a</a><li><a href=/b>b</a><li><a href=/c>c</a><li><a href=/d>d</a></ul>"
        "<p>Yes.</p>" + "<ul><li><a href=/a>a</a><li><a href=/b>b</a><li><a href=/c>c</a><li><a href=/d>d</a></ul></article>",
        f"{LONG}\nYes.",
    ),
    "plain": ("just text", "just text"),
    "nothing": ("<html><body></body></html>", ""),
    "empty": ("", ""),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, text = CASES[name]
    assert H.main_text(page) == text


def plainly(weights, least):
    """Lines that a surge reaches: forwards while sums last, backwards while weights do."""
    sums = [sum(weights[k : k + H.WINDOW]) for k in range(len(weights))]
    surge = min(least, max(sums, default=0) / 2)
    surges = [k for k, x in enumerate(sums) if x and x >= surge and weights[k]]
    return [
        any(all(sums[i : j + 1]) if i <= j else all(weights[j:i]) for i in surges) for j in range(len(weights))
    ]


@given(st.lists(st.sampled_from([0, 0, 0, 3, 15, 30, 90, 200]), max_size=30), st.sampled_from([H.SURGE, H.SURGE_INSIDE]))
def test_surge_and_dive_by_brute_force(weights, least):
    assert H.kept_lines(weights, least) == plainly(weights, least)


@given(st.lists(st.tuples(st.booleans(), st.sampled_from([3, 15, 30, 90, 200])), max_size=25))
def test_pages_without_marks_by_brute_force(blocks):
    page = "".join(f"<div><a href=/>{'l' * n}</a></div>" if link else f"<p>{'p' * n}</p>" for link, n in blocks)
    keep = plainly([0 if link else n for link, n in blocks], H.SURGE)
    assert H.main_text(page) == "\n".join(("l" if link else "p") * n for (link, n), k in zip(blocks, keep, strict=True) if k)


def test_long_pages_stay_whole():
    page = "<article>" + "".join(f"<p>{LONG} {k}</p>" for k in range(5000)) + "</article>"
    assert H.main_text(page).count("\n") == 4999


def test_rows(spark):
    rows = [(1, "u", CASES["marks"][0], "x"), (1, "u", CASES["marks"][0], "x"), (None, None, None, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extracted(pages).collect()
    assert [(x["page_id"], x["url"], x["text"], x["n_chars"]) for x in got] == [
        (1, "u", CASES["marks"][1], len(CASES["marks"][1])),
        (1, "u", CASES["marks"][1], len(CASES["marks"][1])),
        (None, None, "", 0),
    ]
    assert H.extracted(pages.limit(0)).collect() == []
