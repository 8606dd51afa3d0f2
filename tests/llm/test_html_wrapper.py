"""Operator 9: what the pages of a host tell about each other."""

import pytest

from starledger.llm import html_extract


def texts(lspark, pages):
    rows = lspark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(pages)], "page_id long, url string, html string")
    small, large = (sorted((r.page_id, r.text) for r in html_extract.extract(rows, broadcast_bytes=n).collect()) for n in (1 << 20, 0))
    assert small == large
    return [t for _, t in small]


def story(i):
    return f"Story {i} tells of {i * 7919} things that no other page of the host has."


def test_wrapper_decides(lspark):
    line = "<p>Read more on our site</p>"
    page = lambda i: f"<body><article><h1>Title {i}</h1><p>{story(i)}</p>{line}</article></body>"
    want = [f"Title {i}\n{story(i)}" for i in range(4)]
    more = "\nRead more on our site"
    # a line of the article is its text, on however many pages it stands
    got = texts(lspark, [("http://a/%d" % i, page(i)) for i in range(4)] + [("http://b/", page(0))] + [("http://c/%d" % i, page(0) + f"<p>{i}") for i in range(4)]
                + [("http://d/%d" % i, page(i).replace(line, line if i else "")) for i in range(4)])
    assert got[:4] == [w + more for w in want] and got[4] == want[0] + more and got[5:9] == [want[0] + more] * 4
    assert got[9:] == [want[0]] + [w + more for w in want[1:]]
    # outside an article a region of its own is the host's template where the pages differ, and text on one page alone
    bare = lambda i: f"<body><div><h1>Title {i}</h1><p>{story(i)}</p>{line}</div><div class='bottom'>{line}</div></body>"
    got = texts(lspark, [("http://a/%d" % i, bare(i)) for i in range(4)] + [("http://b/", bare(0))])
    assert got == [w + more for w in want] + [want[0] + more + more]


@pytest.mark.parametrize("tag", ["article", "div"])
def test_headings_that_every_article_has(lspark, tag):
    page = lambda i: (f"<body><{tag}><h1>Title {i}</h1><h2>Abstract</h2><p>{story(i)}</p><h2>Results</h2><p>{story(i + 1)}</p></{tag}>"  # noqa: E731
                      "<nav>Home</nav><div class='bottom'><p>All rights reserved by us</p></div></body>")
    want = lambda i: f"Title {i}\nAbstract\n{story(i)}\nResults\n{story(i + 1)}"
    for n in (1, 2, 3, 600):
        got = texts(lspark, [(f"http://host{n}/{i}", page(i)) for i in range(n)])
        tail = "\nAll rights reserved by us" if tag == "div" and n < 3 else ""
        assert got == [want(i) + tail for i in range(n)]


def test_main_region_by_variation(lspark):
    page = lambda i: f'<body><div class="top">All our pages</div><div class="legal news"><p>{story(i)}</p></div><div class="ad">Buy {i}</div></body>'
    cards = lambda i: f"<body><div><p>{story(i)} {story(i + 1)}</p></div><article>Card {i}</article></body>"
    got = texts(lspark, [("http://a/%d" % i, page(i)) for i in range(4)] + [("http://b/%d" % i, cards(i)) for i in range(4)])
    assert got == [story(i) for i in range(4)] + [f"{story(i)} {story(i + 1)}\nCard {i}" for i in range(4)]


def test_strings_without_a_place():
    x, y = "p=" + "0" * 16, "p=" + "1" * 16
    _, found, moved = html_extract.template_of([f"{x}\na#\n{y}", f"{x}\n{y}\na#\nb#"])
    assert found == [x, y] and len(moved) == 1 and html_extract.template_of([f"{x}\na#", f"{x}\nb#"])[2] == []


def test_words_inside_an_article(lspark):
    body = ('<article><h2 id="related-work">Related work</h2><p>One.</p><section id="discussion"><h2 id="search"><a href="#search">Search</a></h2><p class="promotion">Two <math><mi>x</mi>'
            '<annotation>\\x</annotation></math>.</p></section><div class="post social-science">Three.</div><div class="legal news">Four <a href="/">here</a>, at some length.</div>'
            '<div class="related"><a href="/1">Next story</a></div><div class="newsletter">Mail <input name="m"><button>Go</button></div><div class="ad">Buy</div>'
            '<section id="comments"><p>nice!</p></section></article>')
    want = "Related work\nOne.\nSearch\nTwo x.\nThree.\nFour here, at some length."
    bare = '<body><div class="post social-science">Five.</div><div class="cookie-banner"><a href="/">why</a></div></body>'
    got = texts(lspark, [("http://a/", body), ("http://b/", bare), ("http://c/", "No <b>element</b> at all")])
    assert got == [want, "Five.", "No element at all"]
