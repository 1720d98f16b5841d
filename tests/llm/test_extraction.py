import html
import re

import numpy as np

from propensight.llm import equivalence as Q, extraction as X
from propensight.llm.common import table

SCHEMA = "page_id long, url string, html string, host string"


def texts(spark, rows):
    return {r.page_id: r.text for r in X.extract(spark.createDataFrame([(*r, "h") for r in rows], SCHEMA)).collect()}


def test_articles_of_the_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in X.op1_extract(spark, sf).collect()}
    rows = table(spark, sf, "pages").collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|br|h1)>", " ", inner))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url
    assert len(got) == len(rows)


def test_roles(spark):
    page = """<html><body class="no-sidebar"><header>Site</header><div class="cookie-notice">We use cookies</div><form>Search <input></form>
      <main><article><header><h1>Title &amp; more</h1><span>By me</span></header><p>One<b>two</b> <a href=x>three</a><br>four
      <div class="ad-box">Buy</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><script>var x = "</p>";</script>
      <aside>Side</aside><pre>e
        f</pre></article><section id="comments"><article class="comment"><p>Nice</p></article></section></main><footer>&copy; me</footer>"""
    got = texts(spark, [(1, "http://a/1", page), (2, "http://a/2", None), (3, None, "plain &lt;text&gt; \xa0 here"), (4, "http://a/4", ""),
                        (5, "http://a/5", "<article>a<script>never closed"), (6, "http://a/6", "a < b <p title='x>y'>c")])
    assert got == {1: "Title & more Onetwo three four a b c d e f", 2: "", 3: "plain <text> here", 4: "", 5: "a", 6: "a < b c"}


def test_template_of_a_host_without_names(spark):
    page = lambda i: (f"<body><div><div>Welcome to our site</div><div>Read on</div></div><div><h2>Story {i}</h2><p>{'words %d ' % i * 30}</p>"  # noqa: E731
                      f"<p>Shared line</p></div><div>All rights reserved</div></body>")
    rows = [(i, f"http://same.example/{i}", page(i)) for i in range(12)] + [(50, "http://other.example/1", page(50))]
    got = texts(spark, rows)
    for i in range(12):
        assert got[i] == f"Story {i} " + ("words %d " % i * 30).strip()
    assert got[50].startswith("Welcome to our site")  # one page has no template


def test_copies_do_not_make_a_template(spark):
    page = "<body><article><h1>Same</h1><p>Everywhere</p></article><footer>x</footer></body>"
    assert set(texts(spark, [(i, f"http://c.example/{i}", page) for i in range(30)]).values()) == {"Same Everywhere"}


def test_shared_passages_in_articles_stay(spark):
    rows = [(i, f"http://p.example/{i}", f"<article><p>{'Shared passage.' if i % 10 else 'Own.'}</p><p>Text {i}</p></article>") for i in range(30)]
    got = texts(spark, rows)
    assert got[1] == "Shared passage. Text 1" and got[10] == "Own. Text 10"


def test_empty_table(spark):
    assert X.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_layout_words_do_not_lose_the_article(spark):
    text = "This is the text of the page and it is long enough."
    pages = [f"<body><nav>Menu</nav><article class='post has-sidebar'><p>{text}</p></article><footer>x</footer></body>",
             f"<body><nav>Menu</nav><div class='content with-sidebar'><p>{text}</p></div><div class='sidebar'>Side</div></body>",
             f"<body><p>Home</p><article class='has-sidebar'><p>{text}</p></article></body>",
             f"<body><p>Home</p><div class='with-sidebar'><div><p>{text}</p></div></div></body>",
             f"<body><div class='content'><p>{text}</p></div><div class='comments'><p class='text'>{text * 3}</p></div></body>"]
    got = texts(spark, [(i, f"http://l{i}.example/", p) for i, p in enumerate(pages)])
    assert [got[0], got[1], got[2], got[4]] == [text] * 4 and text in got[3]


def test_all_content_elements_of_a_page(spark):
    texts_ = [f"Paragraph {k} of the page." for k in range(20)]
    pages = ["<body><div>" + "".join(f"<p class='text'>{t}</p>" for t in texts_) + "</div><div class='sidebar'>Side</div></body>",
             "<body><div>" + "".join(f"<div class='entry'><p>{t}</p></div>" for t in texts_) + "</div><footer>x</footer></body>"]
    assert texts(spark, [(i, f"http://c{i}.example/", p) for i, p in enumerate(pages)]) == {i: " ".join(texts_) for i in range(2)}


def test_shared_passages_in_content_elements_stay(spark):
    page = lambda i: (f"<body><div>Our site</div><div class='content'><p>{'Shared passage.' if i % 2 else 'Own.'}</p>"  # noqa: E731
                      f"<p>{'Text %d ' % i * 9}</p></div></body>")
    got = texts(spark, [(i, f"http://q.example/{i}", page(i)) for i in range(30)])
    assert got[1] == "Shared passage. " + ("Text 1 " * 9).strip() and got[2] == "Own. " + ("Text 2 " * 9).strip()


def test_shared_passages_without_names_stay(spark):
    page = lambda i: (f"<body><div>Our site</div><section><p>{'Shared passage.' if i % 2 else 'Own.'}</p>"  # noqa: E731
                      f"<p>{'Text %d ' % i * 30}</p></section><div>Rights</div></body>")
    got = texts(spark, [(i, f"http://r.example/{i}", page(i)) for i in range(30)])
    assert got[1] == "Shared passage. " + ("Text 1 " * 30).strip() and got[2] == "Own. " + ("Text 2 " * 30).strip()


def test_pages_alone(spark):
    pages = {"<main><h1>T</h1><p>Body text one.</p></main><article>teaser</article>": "T Body text one.",
             "<article><div class='entry-header'><h1>Title</h1></div><p>body</p></article>": "Title body",
             "<article><p class='social-policy'>a</p><section id='related-work'><h2>b</h2><p>c</p></section><div class='widget-tutorial'>d</div>"
             "<h2 id='notices'>e</h2><div class='share-buttons'>Share</div></article>": "a b c d e",
             "<article><p>The market <span class='share'>share</span> rose</p></article>": "The market share rose",
             "<main><article><p>Text</p></article><div class='user-responses'>Nice</div></main>": "Text",
             "<div>" * 3000 + "deep" + "</div>" * 3000: "deep"}
    got = texts(spark, [(i, f"http://s{i}.example/", p) for i, p in enumerate(pages)])
    assert got == dict(enumerate(pages.values()))


def nameless(i):
    items = "".join(f"<li>Link {k}</li>" for k in range(3 + i % 2))
    extra = f"<div>Only here {i}</div>" if i % 5 == 0 else ""
    parts = "".join(f"<p>{'part %d of %d ' % (k, i) * 6}</p>" for k in range(2 + i % 4))
    return (f"<body><div><ul>{items}</ul></div><div>{extra}<div>Our site</div><section><div>Story number {i}</div><div>{parts}</div></section></div>"
            f"<div><div>Seen by {i * 7} people</div><div>All rights</div></div></body>")


def test_slots_of_pages_without_any_name(spark):
    got = texts(spark, [(i, f"http://plain.example/{i}", nameless(i)) for i in range(24)])
    for i in range(24):
        parts = " ".join(("part %d of %d " % (k, i) * 6).strip() for k in range(2 + i % 4))
        assert got[i] == f"Story number {i} {parts}"


def brute_classes(streams):
    """Vectors, classes and their order by plain counting, over token lists of one host."""
    roots = None
    for _ in range(2):
        named = [Q.roles(np.array(t), np.array(r), np.array(sorted(roots or ()), np.int64)).tolist() for t, r in streams]
        every = set().union(*named)
        vector = {t: tuple(n.count(t) for n in named) for t in every}
        groups = {}
        for t, v in vector.items():
            if sum(c > 0 for c in v) >= max(X.MIN_PAGES, len(streams) * X.SUPPORT):
                groups.setdefault(v, set()).add(t)
        groups = {v: g for v, g in groups.items() if len(g) >= Q.LARGE}
        if roots is None:
            one = groups[(1,) * len(streams)]
            orders = {tuple(t for t in n if t in one) for n in named}
            roots = frozenset(one) if len(orders) == 1 else frozenset()

    def spans(n, g):
        at = [j for j, t in enumerate(n) if t in g]
        return [at[j:j + len(g)] for j in range(0, len(at), len(g))]

    ordered = {}
    for v, g in groups.items():
        ways = {tuple(n[j] for j in s) for n in named for s in spans(n, g)}
        if len(ways) == 1 and len(set(next(iter(ways)))) == len(g):
            ordered[v] = g
    return roots, named, groups, ordered


def test_classes_are_those_of_plain_counting(spark):
    rows = [(i, f"http://plain.example/{i}", nameless(i), "h") for i in range(24)]
    streams = X.streams(spark.createDataFrame(rows, SCHEMA)).cache()
    roots, members = Q.deduce(streams, X.SUPPORT, X.MIN_PAGES, X.FULL_PAGES)
    pages = [(list(r.token), list(r.rank)) for r in streams.collect()]
    want_roots, named, groups, ordered = brute_classes(pages)
    assert set(roots.first().roots) == want_roots and len(want_roots) > 10
    got = {}
    for m in members.first().members:
        got.setdefault(m["class"], set()).add(m.token)
    found = {frozenset(g) for g in got.values()}
    assert found and all(g in {frozenset(x) for x in ordered.values()} or len(g) == 2 and {~t for t in g} == g for g in found)
    whole = next(g for v, g in ordered.items() if set(v) == {1})
    assert frozenset(whole) in found and len(whole) > len(want_roots)
    for n in named:  # nested: between the tokens of one occurrence no other class is cut in two
        walked, broken = Q.Template([m.asDict() for m in members.first().members]).walk(n)
        assert not broken and len(walked) == len(n)


def test_template_table_edges(spark):
    rows = [(i, f"http://e.example/{i}", h) for i, h in enumerate([None, "", "<p>", "x" * 200_000, nameless(1), nameless(1)])]
    rows += [(None, None, None), (9, None, nameless(2)), (9, None, nameless(2)), (10, "no scheme", nameless(3))]
    got = X.extract(spark.createDataFrame([(*r, "h") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[0].text == by[1].text == by[2].text == "" and by[3].n_chars == 200_000 and by[4].text == by[5].text


def test_templates_too_large_to_broadcast_are_joined(spark, monkeypatch):
    rows = [(i, f"http://plain.example/{i}", nameless(i)) for i in range(24)] + [(99, "http://alone.example/", nameless(99))]
    wide = texts(spark, rows)
    monkeypatch.setattr(Q, "TEMPLATE_BYTES", -1)
    assert texts(spark, rows) == wide and wide[3].startswith("Story number 3 part 0 of 3")
