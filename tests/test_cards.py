import random

import pytest

from textlake.functions import cards as C
from textlake.sources import events as S

PAGE = """<!doctype html><html><body><div class='card big' data-x=1><h2 class="t"><a title="no" href="/a?x=1&amp;y=2">One &amp; only</a></h2>
<div class="card"><h2><a HREF=/inner>Inner<br>more</a></h2></div><span class="date">  1 May </span></div>
<ul><li>first<li>second <b>bold</b><ul><li>deep</ul><li id=last>third</ul>
<div class="cards">none</div><div class="card"><p>open <p>again<img src=x></div><script>var a = "<div class='card'>";</script>
<table><tr><td>1<td>2<tr><td>3</table></body>"""


def got(card, *fields):
    return C.read(PAGE, card, fields)


def test_nested_cards_unclosed_tags_and_attributes_in_any_order():
    assert got("div.card", "h2 > a::attr(href)", "h2 a::text", "span.date::text", "p::text") == [["/a?x=1&y=2", "One & only", "1 May", None], ["/inner", "Inner", None, None], [None, None, None, "open"]]
    assert got("ul > li", "li::text", "b::text") == [["first", None], ["second", "bold"], ["deep", None], ["third", None]]
    assert got("li#last", "*::text") == [["third"]]
    assert got("tr", "td::text") == [["1"], ["3"]] and len(got("td", "td::text")) == 3
    assert got("div[data-x]", "a[title=no]::attr(title)", "a[href^='/a']::attr(href)", "a[href$=2]::attr(href)", "a[href*=inner]::attr(href)", "[class~=t] a::text") == [["no", "/a?x=1&y=2", "/a?x=1&y=2", "/inner", "One & only"]]
    assert got("div.card div.card", "a::text") == [["Inner"]] and got("body > .card > .card", "a::text") == [["Inner"]]
    assert got("img", "img::attr(src)") == [["x"]] and got("p", "p::text") == [["open"], ["again"]]
    assert got(".card", "body a::text") == [[None]] * 3  # selectors of fields are within the card


def test_bad_selectors_are_told():
    for bad in ("", "  ", "a >", "a::text b", "a:hover", "a[b"):
        with pytest.raises(ValueError):
            C.selector(bad)
    with pytest.raises(ValueError, match="::text"):
        C.wanted("a", ("b",))


def test_well_formed_pages_against_a_tree():
    """Against ElementTree on pages that are well-formed."""
    import xml.etree.ElementTree as E

    rng = random.Random(3)

    def build(depth):
        tag = rng.choice(["div", "span", "b", "section"])
        inner = "".join(rng.choice(["text%d " % rng.randint(0, 9), build(depth + 1) if depth < 5 else "leaf "]) for _ in range(rng.randint(0, 3)))
        return f'<{tag} class="{rng.choice(["x", "y"])}" n="{rng.randint(0, 99)}">{inner}</{tag}>'

    for _ in range(200):
        page = f"<main>{build(0)}{build(0)}</main>"
        want = [[next((x.get("n") for x in e.iter("b")), None), next((t for x in e.iter("span") for t in [x.text, *[y.tail for y in x]] if t and t.strip()), None)] for e in E.fromstring(page).iter("div") if e.get("class") == "x"]
        # text nodes of several spans come in the order of the page
        have = C.read(page, "div.x", ("b::attr(n)", "span::text"))
        assert [h[0] for h in have] == [w[0] for w in want]
        assert [h[1] is None for h in have] == [w[1] is None for w in want]


def test_broken_pages_never_raise():
    rng = random.Random(4)
    bits = ["<div", " class=card", ">", "</div>", "<a href='", "'", "text", "<", "&amp", "&#x0;", "<!--", "-->", "<![CDATA[", "]]>", "</", "<br/>", "<p>", "\x00", "<!x", "<?y", "<script>", "</script>"]
    for _ in range(3000):
        C.read("".join(rng.choice(bits) for _ in range(rng.randint(0, 25))), "div.card", ("a::attr(href)", "p::text"))
    deep = "<div class=card>" * 800 + "x" + "</div>" * 800
    assert len(C.read(deep, "div.card > div.card", ("div::text",))) == 799


def test_rows(spark):
    df = spark.createDataFrame([(1, PAGE, "k"), (1, PAGE, "k"), (2, None, None), (3, "", "e")], "p int, html string, title string")
    out = S.select_cards(df, "html", "li", text="li::text", href="a::attr(href)")
    assert out.columns == ["p", "title", "text", "href"]
    assert sorted((r.p, r.text) for r in out.collect()) == sorted([(1, t) for t in ("first", "second", "deep", "third")] * 2)
    assert S.select_cards(df.limit(0), "html", "li", text="li::text").count() == 0
