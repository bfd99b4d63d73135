import time
from collections import defaultdict

import pytest

from corvane.llm.main_text import Repeats, blocks, main_text

PAGE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T &amp; t</title><style>p{margin:0}</style>
<script>var t="</p>";track(0);</script></head><body class="sidebar"><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- ad > 1 --><div class="ad">Buy</div>
<article><header><h1>Head&shy;line &amp;amp; more</h1></header><p><b>First
 &nbsp; part.<br><p>Second<i> p</i>art 1 < 2 &lt;b&gt;<p class="share-buttons">Share me</p><aside>Side</aside>
<div id="comments"><p>A comment</div><form><input name="q"><p>Form</form><div hidden>unseen</div><p>Last.</article><footer>&copy; foot</footer></body></html>"""


def text_of(page):
    found = list(blocks(page))
    return " ".join(t for t, p in found if p == 0)


def test_article():
    assert text_of(PAGE) == "Head\xadline &amp; more First part. Second part 1 < 2 <b> Last."


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article>a<br>b</article>", "a b"),
        ("<article><p>a<p>b", "a b"),
        ("<article><ul><li>a<li>b</ul>c</article>d", "a b c"),
        ("<main><div role='navigation'>n</div><table><tr><td>x<td>y</table></main>", "x y"),
        ("<article>x<script>if (a</b>1) '</article>'</script>y</article>", "x y"),
        ("<article>&am &amp &#x41;&#66; &notit; &unknown;</article>", "&am & AB ¬it; &unknown;"),
        ("<article>cut <p>off <b", "cut off <b"),
        ("<article><img alt='a > b'>pic</article>", "pic"),
        ("</p></div><article></nav>t</article>", "t"),
        ("<article><section><nav>n<p>m</nav>s</section></article>", "s"),
        ("<article>caf<em>é</em>s</article>", "cafés"),
    ],
)
def test_small_pages(page, want):
    assert text_of(page) == want


def brute(pages, rule=Repeats()):
    """Texts of (page_id, host, open blocks): every substring of min_tokens tokens, by page."""
    pages = [(i, h, tuple(b)) for i, h, b in pages]
    where = defaultdict(set)
    k = rule.min_tokens

    def substrings(tokens):
        return [(at, tuple(tokens[at : at + k])) for at in range(max(1, len(tokens) - k + 1))]

    for page in pages:
        for block in page[2]:
            for _, s in substrings(block.split(" ")):
                where[page[1], s].add(page)
    out = []
    for page in pages:
        kept = []
        for block in page[2]:
            tokens = block.split(" ")
            hit = {j for at, s in substrings(tokens) if len(where[page[1], s]) >= rule.min_pages for j in range(at, min(at + k, len(tokens)))}
            if 100 * len(hit) <= rule.covered * len(tokens):
                kept.append(block)
        out.append((page[0], " ".join(kept)))
    return sorted(out, key=str)


def test_open_pages_by_repeats(spark):
    menu, notice = "Home News About", "We use data about you to make this site work as it should"
    rows, plain = [], []
    for i in range(12):
        parts = [menu, f"Story number {i} is about {'x' * (i + 1)} and nothing else at all.", f"{notice} in {i}", f"{notice} " + " ".join(f"w{i}{j}" for j in range(40)), "Same"]
        host = ["http://a.example/", "https://www.a.example:8080/x", "http://b.example/", "ftp://c.example/"][i % 4]
        rows.append((i, host + str(i), "<body>" + "".join(f"<div>{p}</div>" for p in parts)))
        plain.append((i, ["a.example", "a.example", "b.example", "c.example"][i % 4], parts))
    rows += [(50, None, None), (51, "x", ""), (52, None, "<p>only</p>"), (3, rows[3][1], rows[3][2]), (60, "http://a.example/z", PAGE)]
    plain += [(50, "", []), (51, "", []), (52, "", ["only"]), plain[3]]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = {(r.page_id, r.url): r.text for r in main_text(df).collect()}
    assert out.pop((60, "http://a.example/z")) == text_of(PAGE)
    got = sorted(((i, t) for (i, _), t in out.items()), key=str)
    assert got == sorted(set(brute(plain)), key=str)
    assert menu not in out[0, "http://a.example/0"] and "Story number 0" in out[0, "http://a.example/0"]
    assert main_text(df).count() == len(rows)


def test_copied_articles_stay(spark):
    rows = [(i, "http://h.example/", f"<nav>Menu</nav><article><p>{'One text on all pages of the host. ' * 9}</p></article>") for i in range(9)]
    out = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in out} == {" ".join(["One text on all pages of the host."] * 9)} and len(out) == 9


def test_empty_table(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_repeats_inside_articles(spark):
    notice = "Subscribe to our weekly letter and get all the stories of the week in your inbox before anybody else does."
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, "http://h.example/", f"<article><p>{own(i, 40)}</p><p class='x'>{notice}</p><p>{own(i + 100, 9)}</p></article>") for i in range(4)]
    # Two of them elsewhere: not enough.
    rows += [(10 + i, "http://other.example/", f"<article><p>{own(i + 200, 40)}</p><p>{notice}</p></article>") for i in range(2)]
    # A copy with changes stays whole.
    rows += [(20 + i, "http://copies.example/", f"<article><p>{own(300, 60)}</p><p>{own(301, 60)} changed{i}</p></article>") for i in range(5)]
    out = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"{own(i, 40)} {own(i + 100, 9)}" for i in range(4))
    assert all(out[10 + i] == f"{own(i + 200, 40)} {notice}" for i in range(2))
    assert all(out[20 + i] == f"{own(300, 60)} {own(301, 60)} changed{i}" for i in range(5))


def test_main_text_beside_a_teaser(spark):
    rows = [(i, "http://h.example/", f"<article>Teaser {i}</article><div>Long story {i} in a plain element.</div><div>Menu of the site</div>") for i in range(3)]
    out = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"Teaser {i} Long story {i} in a plain element." for i in range(3)}


def test_article_blocks_stay_however_often_they_are_repeated(spark):
    quote = "A sentence of many words that several stories of one host quote in full, each of them in a paragraph of its own."
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, "http://h.example/", f"<article><h1 class='t'>The same headline for all</h1><p>{own(i, 30)}</p><p>{quote}</p></article>") for i in range(5)]
    # Most of the article under a class, changed from page to page.
    rows += [(10 + i, "http://h.example/", f"<article><p class='b'>{own(500, 40)}</p><p class='b'>changed{i}</p></article>") for i in range(4)]
    # Links that all pages have, and links of a page's own.
    links = "<p><a href='/1'>First story of the day</a> <a href='/2'>and the second one</a></p>"
    rows += [(20 + i, "http://h.example/", f"<article><p>{own(i + 600, 30)}</p>{links}<p><a href='#'>own{i} link{i}</a></p></article>") for i in range(4)]
    out = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert out[i] == f"The same headline for all {own(i, 30)} {quote}"
    for i in range(4):
        assert out[10 + i] == f"{own(500, 40)} changed{i}"
        assert out[20 + i] == f"{own(i + 600, 30)} own{i} link{i}"


@pytest.mark.parametrize(
    "piece",
    ["<a ", '<a "', "<a 'x\"", "<a", "</p", "<div>x", "<div class=a>x</p>", "<!-", "<script></script", "<script>", "</script", "&#1", "9", "&", "a ", "=", "<p a", "'\"", "<h1>", "</"],
)
def test_time_is_linear(piece):
    for before in ("", "<article>", "<div ", "&#"):
        started = time.perf_counter()
        list(blocks(before + piece * (1_000_000 // len(piece)) + ">"))
        assert time.perf_counter() - started < 5


def test_long_references():
    assert list(blocks(f"<article>&#{'9' * 5000}; &#{'0' * 5000}65;</article>")) == [("� A", 0)]
