import html
import re
import time
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from pairscore.llm.html_extract import extract_pages, main_text

PARA = "This is a paragraph that goes on for quite a while, as those of an article do."
PAGE = f"""<html><head><title>t</title><style>p{{}}</style><script>var x = "<p>no</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li><a>Home</a><li><a>More</a></ul></nav>
<div class="cookie-notice">We use cookies to make this better for all of you who come here.</div>
<article><h1>A &amp; B</h1><p><b>{PARA}<br><p>Second   one\n here.</p><ul><li>item</ul><div class="ad">Buy this now, it is very good and not at all dear, they say.</div></article>
<aside>{PARA}</aside><form><label>Mail</label><input></form><div id="comments"><p>{PARA} says a reader.</p></div><footer>&copy; x</footer>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == f"A & B\n{PARA}\nSecond one here.\nitem"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p> &nbsp; </p>") == main_text("<script>x</script>") == ""
    assert main_text("just text") == "just text"
    assert main_text(f"<![if !IE]><p>{PARA}</p><![endif]>") == PARA
    assert main_text(f"<div><p>{PARA}</p><p>{PARA}</p></div>") == f"{PARA}\n{PARA}"
    assert main_text(f"<nav><a>x</a><article><p>{PARA}</p></article>") == PARA  # a menu left open
    assert main_text("<p>" * 3000 + "deep") == "deep"
    assert len(main_text("<article><p>" + "word " * 200_000 + "</p></article>")) == 999_999


def test_class_names():
    inside = f'<div class="content sidebar-right"><div class="main-nav"><p>{PARA}</p></div><p>{PARA}</p><div class="article-comments"><p>{PARA}</p></div></div>'
    assert main_text(inside) == PARA
    assert main_text(f'<div class="wrap with-sidebar"><p>{PARA}</p></div><div class="sidebar"><p>{PARA}</p></div>') == PARA
    assert main_text(f'<div id="main-header"><p>Name of the site</p></div><main><header><h1>T</h1></header><p>{PARA}</p></main><div role="alert">{PARA}</div>') == f"T\n{PARA}"


def test_query_keeps_rows(spark):
    rows = [(1, "u", f"<p>{PARA}</p>"), (1, "u", f"<p>{PARA}</p>"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = extract_pages(pages).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", PARA, len(PARA))] * 2 + [(None, None, "", 0)], key=str)
    assert extract_pages(pages.limit(0)).collect() == []


def test_links_and_names_inside_an_article():
    """What a page marks as its article is taken whole, but for parts that are named for something else only."""
    linked = f'<p><a href="/x">{PARA}</a></p><ul><li><a href="/s">The source of it</a></li><li>own</li></ul>'
    assert main_text(f"<article><p>{PARA}</p>{linked}</article>") == f"{PARA}\n{PARA}\nThe source of it\nown"
    own = f'<section id="discussion"><p>{PARA} 1</p></section><blockquote class="reply">{PARA} 2</blockquote><div class="legal-notice-of-ruling">{PARA} 3</div>'
    assert main_text(f"<article><p>{PARA}</p>{own}</article>") == "\n".join([PARA, *(f"{PARA} {i}" for i in (1, 2, 3))])
    foreign = f'<div class="related-links"><a>{PARA}</a></div><div id="comments"><p>{PARA}</p></div><div class="newsletter-box">{PARA}</div><p class="ad">{PARA}</p><aside>{PARA}</aside>'
    assert main_text(f"<article><p>{PARA}</p>{foreign}<p>end</p></article>") == f"{PARA}\nend"


def flat(lines):
    return np.ones(len(lines))


def test_ratios_decide_where_a_page_names_nothing():
    links = "".join(f'<div><span><a href="/{i}">Place {i}</a></span></div>' for i in range(8))
    page = f"<body><div><div>{links}</div><div><div><b>Some</b> <i>words</i> <u>here</u></div></div><div><h2>Head</h2><p>{PARA}</p><p>{PARA} <a>more</a></p><p>{PARA}</p></div><div>{links}</div></div></body>"
    assert main_text(page) == f"Head\n{PARA}\n{PARA} more\n{PARA}"
    assert main_text(page, flat) != main_text(page)
    within = f"<div><p>{PARA}</p><p>{PARA}</p><p><a>A linked line</a></p><p>{PARA}</p>" + "".join(f"<p><a>Other page {i}</a></p>" for i in range(6)) + "</div>"
    assert main_text(within) == f"{PARA}\n{PARA}\nA linked line\n{PARA}"  # one within the text is lifted by its neighbours, a list is not


def truth(page):
    """The article of a page of the tables by what is known of their form: one article of headings and paragraphs."""
    article = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", article))
    return [t for t in (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in blocks) if t]


def pages_of_tables():
    return [r["html"] for sf in ("sf0.001", "sf0.01") for r in pq.read_table(f"/root/testdata/{sf}/pages.parquet", columns=["html"]).to_pylist() if r["html"]]


def test_pages_of_the_tables():
    assert all(main_text(p).split("\n") == truth(p) for p in pages_of_tables())


def measured(pages, ratios_of=None):
    """Precision and recall by characters of whole lines, and the share of pages that are right."""
    hit = extra = missed = exact = 0
    for page, want in pages:
        got, want = Counter(filter(None, main_text(page, **({"ratios_of": ratios_of} if ratios_of else {})).split("\n"))), Counter(want)
        size = lambda c: sum(len(k) * n for k, n in c.items())
        hit, extra, missed, exact = hit + size(got & want), extra + size(got - want), missed + size(want - got), exact + (got == want)
    return hit / (hit + extra), hit / (hit + missed), exact / len(pages)


def test_precision_and_recall_without_names():
    """Pages of the tables with all names taken away, against their articles."""
    bare = lambda page: re.sub(r'<div class="[^"]*"', "<div", re.sub(r"<(/?)(article|nav|footer|header|aside|main|section)\b", r"<\1div", page))
    pages = [(bare(p), truth(p)) for p in pages_of_tables()]
    precision, recall, exact = measured(pages)
    assert precision > 0.998 and recall > 0.998 and exact > 0.96
    assert measured(pages, flat)[2] < exact


def prose(n, seed=0):
    return " ".join(f"word{(seed * 31 + i * 7) % 97}" for i in range(n)) + "."


LINKS = "".join(f'<li><a href="/{i}">Place {i}</a></li>' for i in range(7))
#: Pages written by hand, and the lines that a reader would call their text.
LABELLED = [
    (f"<body><nav><ul>{LINKS}</ul></nav><article><p>Short news.</p></article><div><p>{prose(80)}</p><p>{prose(60, 1)}</p></div></body>", ["Short news."]),
    (f"<main><article><h2>One</h2><p>{prose(9)}</p></article><article><h2>Two</h2><p>{prose(70, 2)}</p></article></main><footer>x</footer>", ["One", prose(9), "Two", prose(70, 2)]),
    (f'<article><h1>On finding</h1><p>{prose(30)}</p><section id="search"><h2>Search</h2><p>{prose(40, 3)}</p></section><section id="trending"><p>{prose(25, 4)}</p></section></article>', ["On finding", prose(30), "Search", prose(40, 3), prose(25, 4)]),
    (f'<article><p>{prose(30)}</p><section class="form"><p>{prose(35, 5)}</p></section><div class="search"><input><label>Find</label> <a href="/">Go</a></div></article>', [prose(30), prose(35, 5)]),
    (f'<article><p>{prose(30)}</p><section id="comments"><p>{prose(30, 6)}</p></section><section id="cookies"><h2>Cookies</h2><p>{prose(20, 7)}</p></section><div class="cookies">{prose(12, 8)}</div></article>', [prose(30), "Cookies", prose(20, 7)]),
    (f"<body><div>Home | About us | Contact</div><h1>Head</h1><p>{prose(60)}</p><p>{prose(50, 1)}</p><p>Short end.</p><div>© 2024 Some Company</div></body>", ["Head", prose(60), prose(50, 1), "Short end."]),
    (f"<body><div><p>Home · News · Sport</p><p>{prose(60)}</p><p>{prose(50, 1)}</p><p>Copyright 2024 by us. All rights reserved.</p></div></body>", [prose(60), prose(50, 1)]),
    (f"<body><table><tr><td><ul>{LINKS}</ul></td><td><h2>Told</h2><p>{prose(60)}</p><p>Yes.</p><p>{prose(40, 9)}</p></td></tr></table><ul>{LINKS}</ul></body>", ["Told", prose(60), "Yes.", prose(40, 9)]),
    (f"<body><div><div><b>Some</b> <i>short</i> <u>bits</u></div><div>{'<span><a>x y</a></span>' * 9}</div></div><div><p>{prose(45)}</p><ul><li>{prose(12, 1)}</li><li>{prose(14, 2)}</li></ul><p>{prose(35, 3)}</p></div></body>", [prose(45), prose(12, 1), prose(14, 2), prose(35, 3)]),
    (f"<main><h1>Only main</h1><p>{prose(20)}</p><aside><p>{prose(50, 1)}</p></aside></main><div><p>{prose(90, 2)}</p></div>", ["Only main", prose(20)]),
    (f'<body><article class="comment"><p>{prose(40)}</p></article><article><p>{prose(15, 1)}</p></article><aside><article><p>{prose(30, 2)}</p></article></aside></body>', [prose(15, 1)]),
    (f"<body><div>{''.join(f'<p>{prose(40, i)}</p>' for i in range(4))}</div><div>{''.join(f'<p><a href=/{i}>Another page {i}</a></p>' for i in range(9))}</div></body>", [prose(40, i) for i in range(4)]),
]


def test_labelled_pages():
    for page, want in LABELLED:
        assert main_text(page).split("\n") == want
    assert measured(LABELLED) == (1.0, 1.0, 1.0)
    precision, recall, exact = measured(LABELLED, flat)  # the ratios matter
    assert precision < 1 and exact < 1


def test_deep_and_broken_nesting_takes_linear_time():
    def seconds(page):
        began = time.process_time()
        main_text(page)
        return time.process_time() - began

    for part in ("<div>x", "<section>x</div>", "<p><b>x", "<nav><article>x", "<table><tr><td>x"):
        assert seconds(part * 20_000) < 40 * seconds(part * 2_000) + 0.5, part
