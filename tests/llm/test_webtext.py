import re

import pytest

from deidflow.llm import webtext as web

HOST = re.compile(r"\w+://(?:[^@/]*@)?([^/?#:]*)")
PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header class="site"><h1>Site</h1></header><nav><ul><li>Home<li>More</ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<article><h1>Title &amp; more</h1><p>First   <b>bold</b>
text<br>next<p>Second &eacute;&#233;<p>{fixed}</p></article><aside>Side</aside><form><label>Mail</label><input></form>
<div id="comments"><article><p>First!</p></article></div><div class="ad">Buy</div><footer>&copy; all</footer></body></html>"""


def test_article_without_its_surroundings():
    assert web.article(PAGE) == ["Title & more", "First bold text next", "Second éé", "{fixed}"]


@pytest.mark.parametrize(
    ("html", "want"),
    [(None, []), ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p>cut &am", ["cut &am"]), ("<div>x<nav>y</nav>z</div>", ["x", "z"]), ("<p>1 < 2</p>", ["1 < 2"]), ("<main><p>m</p></main><p>n</p>", ["m"]),
     ("<div class='post'><p>p</p></div><p>q</p>", ["p"]), ("<p hidden>h</p><p style='display: none'>i</p><div hidden><p>j</p></div><p>k", ["h", "i", "k"]), ("<p>a</p", ["a"]), ("<article><header><h1>H</h1></header><p>b</article>", ["H", "b"])],
)
def test_markup(html, want):
    assert web.article(html) == want


SCHEMA = "page_id long, url string, html string, text string, host string, section string, _host string, who string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "h", "s", "o", "w") for r in rows], SCHEMA)


def test_fixed_slots_go_and_the_rest_stays(spark):
    notice = PAGE.replace("<p>{fixed}</p>", "<p class=x>Read our newsletter</p>")
    rows = [(k, f"http://h.example/{k}", notice.replace("Second", f"Second {k}").replace("Title", f"Title {k}")) for k in range(12)]
    rows += [(100 + k, "http://small.example/x", notice.replace("Second", f"Second {k}").replace("Title", f"Title {k}")) for k in range(2)]
    rows += [(200 + k, "http://copies.example/", PAGE) for k in range(8)] + [(300, None, None), (301, "no url", PAGE), (302, "http://one.example/", PAGE)]
    got = {r.page_id: r.text.split("\n\n") for r in web.extract(table(spark, rows)).collect()}
    # "First bold ..." stands on every page too, but where other pages have other text.
    assert got[3] == ["Title 3 & more", "First bold text next", "Second 3 éé"]
    assert got[101] == ["Title 1 & more", "First bold text next", "Second 1 éé"]  # two pages are enough
    assert got[205] == ["Title & more", "First bold text next", "Second éé", "{fixed}"] == got[301] == got[302] and got[300] == [""] and len(got) == 25
    assert {r.host for r in web.templates(table(spark, rows)).collect()} == {"h.example", "small.example", "copies.example"}


PLAIN = """<html><body><div><a href=/>Home</a> <a href=/n>News {k}</a></div><div><h2>Headline {k}</h2><p>Story {k} begins here and goes on for a while, {k} times.</p><p>It
ends &amp; stops {k}.</p>{more}</div><div><p>About this site and its owners</p></div><div><p>Teaser {k}</p></div></body></html>"""


def neutral(n, host="http://plain.example"):
    return [(k, f"{host}/{k}", PLAIN.format(k=k, more="<p>extra</p>" * (k % 3))) for k in range(n)]


@pytest.mark.parametrize("n", [2, 5, 30])
def test_the_template_decides_where_markup_says_nothing(spark, n):
    rows = neutral(n)
    got = {r.page_id: r.text for r in web.extract(table(spark, rows)).collect()}
    for k, _, html in rows:
        want = [f"Headline {k}", f"Story {k} begins here and goes on for a while, {k} times.", f"It ends & stops {k}.", *["extra"] * (k % 3)]
        assert got[k] == "\n\n".join(want) and web.article(html) != want


def deduce(rows):
    """host -> (article section, fixed slots) from full occurrence vectors, by hand."""
    hosts = {}
    for i, url, html in rows:
        if m := HOST.match(url or ""):
            hosts.setdefault(m[1].lower(), []).append(web.read_page(html or ""))
    out = {}
    for host, pages in hosts.items():
        if len(pages) < 2:
            continue
        vectors, texts, sections = {}, {}, {}
        for p in pages:
            sections |= p.sections
            texts |= {b.token: b for b in p.blocks}
        for t in {t for p in pages for t in p.tokens}:
            vectors.setdefault(tuple(p.tokens.count(t) for p in pages), []).append(t)
        valid = {t for v, ts in vectors.items() if sum(x > 0 for x in v) >= max(2, web.SUPPORT * len(pages)) and len(ts) > 1 and any(t not in texts for t in ts) for t in ts}
        weight, slots = {}, {}
        for p in pages:
            for b in p.blocks:
                slots.setdefault(b.slot, set()).add(b.token)
                if b.token not in valid and not b.boilerplate and not b.link:
                    for s in {0, *b.sections}:
                        weight[s] = weight.get(s, 0) + len(b.text)
        chain = sorted((sections[t][0], t) for t in valid if t in sections and weight.get(t, 0) >= web.MOST * weight.get(0, 0) > 0)
        main = [t for d, t in chain if sections[t][1] == 2]
        out[host] = (main[0] if main else chain[-1][1] if chain else None, {s for s, ts in slots.items() if ts <= valid})
    return out


def test_deduction_equals_brute_force(spark):
    mask = (1 << 64) - 1
    rows = neutral(9) + neutral(2, "https://u@Two.example:80") + [(50 + k, f"http://h.example/{k % 5}", PAGE.replace("Title", f"T{k // 2}").replace("Second", f"S{k}")) for k in range(7)]
    rows += [(70 + k % 2, "http://h.example/r", PAGE) for k in range(4)] + [(80, "http://solo.example", PAGE)] + [(90 + k, "http://flat.example", f"<p>one {k}</p><p>same</p>") for k in range(4)]
    rows += [(95, "http://long.example", "<div>" * 300 + "<p>deep words</p>" * 3000), (96, "http://long.example", "<p>" + "word " * 200_000), (97, "http://empty.example", ""), (98, "http://empty.example", None)]
    want = deduce(rows)
    got = {r.host: (None if r.section is None else r.section & mask, {x & mask for x in r.fixed or []}) for r in web.templates(table(spark, rows)).collect()}
    assert got == want and sum(s is not None for s, _ in want.values()) >= 3
    texts = {(r.page_id, r.url): r.text for r in web.extract(table(spark, rows)).collect()}
    for i, url, html in rows:
        host = HOST.match(url)[1].lower()
        assert texts[i, url] == "\n\n".join(web.article(html, *want.get(host, (None, set()))))


def test_templates_of_any_size_are_joined(spark):
    rows, most = neutral(12), web.MAX_BROADCAST_BYTES
    small = sorted(web.extract(table(spark, rows)).collect())
    try:
        web.MAX_BROADCAST_BYTES = 0
        assert sorted(web.extract(table(spark, rows)).collect()) == small
    finally:
        web.MAX_BROADCAST_BYTES = most


def test_empty_table(spark):
    assert web.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_repeated_and_very_long_pages(spark):
    rows = neutral(6)
    once = {r.page_id: r.text for r in web.extract(table(spark, rows)).collect()}
    twice = web.extract(table(spark, rows * 2)).collect()
    assert len(twice) == 12 and all(r.text == once[r.page_id] for r in twice)  # vectors are sums, so even numbers do not cancel
    story = " ".join(f"word{k}" for k in range(200_000))
    long = [(9, "http://plain.example/9", PLAIN.format(k=9, more=f"<p>{story}</p>"))]
    got = {r.page_id: r.text for r in web.extract(table(spark, rows + long)).collect()}
    assert got[9].endswith(story) and {k: v for k, v in got.items() if k != 9} == once
