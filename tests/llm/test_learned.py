"""Toxicity and HTML extraction."""

import random

from mixwright.llm import html_text, queries, toxicity
from mixwright.llm.common import table
from tests.llm.helpers import docs


def test_segments_are_all_maximal():
    rng = random.Random(2)
    for _ in range(300):
        s = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randrange(0, 12))]
        want = []

        def split(a, b, s=s, want=want):
            best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0, 0))
            if best[0] > 0:
                split(a, best[3])
                want.append((best[3], best[4], best[0]))
                split(best[4], b)

        split(0, len(s))
        got = toxicity.segments([float(x) for x in s])
        assert sum(x for *_, x in got) == sum(x for *_, x in want) and [x for *_, x in got] == [x for *_, x in want]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op6_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").select("toxic", "score", "predicted").collect()
    hits = sum(r.toxic == 1 and r.predicted == 1 for r in out)
    assert hits >= 0.9 * sum(r.toxic == 1 for r in out)
    assert hits >= 0.9 * sum(r.predicted == 1 for r in out)
    assert all(0 <= r.score <= 1 for r in out)


def test_toxic_passage_is_placed(spark):
    rows = [(i, "it is a fine day in the park with " + ("vile foul wretch " if i % 2 else "good kind folk ") + f"and so on w{i}") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    d = docs(spark, [*rows, (900, None), (901, ""), (None, "vile foul wretch"), (902, "x " * 30000 + "vile foul wretch")])
    model = toxicity.fit(d, labels)
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    assert got[1].passages[0].start == 9 and got[1].passages[0].stop == 12 and got[1].score > 0.9 > 0.3 > got[0].score
    assert got[900].score == got[901].score < 0.3 and not got[900].passages and got[None].score > 0.9 and got[902].score > 0.3
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.score < 0.3 for r in toxicity.score(d, toxicity.fit(d, empty)).collect())
    assert toxicity.score(docs(spark, []), model).count() == 0


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, text string")


PAGE = """<!DOCTYPE html><html lang=en><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/a">Home</a></ul></nav>
<!-- note --><div class="ad">Buy</div><div id=cookie-notice>We use cookies</div><article><h1>Head&amp;am</h1><p><b>One
 two&nbsp;&lt;3<br>four<p>Fi<i>ve</i> six<form>name <input></form><div class="comments"><p>me too</p></div><aside>side</aside></article><footer>&copy; us</footer>"""


def test_marked_article(spark):
    got = {r.page_id: r for r in html_text.extract(_pages(spark, [(1, "http://a.b/c", PAGE), (2, None, None), (3, "http://a.b/d", ""), (4, "u", "<p>bare &lt;text"), (5, "u", "no tags &am"), (1, "http://a.b/c", PAGE)])).collect()}
    assert got[1].text == "Head&am One two <3 four Five six" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text) == ("", 0, "")
    assert (got[4].text, got[5].text) == ("bare <text", "no tags &am")
    assert html_text.extract(_pages(spark, [])).count() == 0


def test_template_of_a_host_is_removed(spark):
    page = lambda i, host="h.org": (i, f"http://{host}/{i}", f"<html><body><div class=x><p>Welcome to the site</p></div><div><p>Story {i} begins</p><p>and ends {i}.</p></div><div>All rights <b>kept</b></div></body></html>")
    rows = [page(i) for i in range(40)] + [page(100, "other.org")]
    got = {r.page_id: r.text for r in html_text.extract(_pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i} begins and ends {i}." for i in range(40))
    assert got[100] == "Welcome to the site Story 100 begins and ends 100. All rights kept"


def test_article_text_that_recurs_stays(spark):
    rows = [(i, f"http://h.org/{i}", f"<body><div>menu of all</div><article><p>The same licence text.</p><p>No {i}</p></article></body>") for i in range(20)]
    assert {r.text for r in html_text.extract(_pages(spark, rows)).collect()} == {f"The same licence text. No {i}" for i in range(20)}


def test_boxes_that_recur_in_articles_go(spark):
    page = lambda i, story: (i, f"http://h.org/{i}", f"<body><article><div class=c><p>{story}</p><p>Shared licence.</p><div class=k1>Join <b>our</b> list</div></div><section class=k2><p>Open all week</p></section></article></body>")
    copies = [(100 + i, f"http://copies.org/{i}", "<body><article><div class=c>Copy</div></article></body>") for i in range(20)]
    rare = [(200 + i, f"http://rare.org/{i}", f"<body><article><p>No {i}</p>{'<div>Box of some</div>' if i < 6 else ''}</article></body>") for i in range(20)]
    got = {r.page_id: r.text for r in html_text.extract(_pages(spark, [page(i, f"Story {i}") for i in range(20)] + copies + rare)).collect()}
    assert all(got[i] == f"Story {i} Shared licence." for i in range(20))
    assert all(got[100 + i] == "Copy" for i in range(20))
    assert all(got[200 + i] == f"No {i}" + (" Box of some" if i < 6 else "") for i in range(20))


def test_wrappers_of_an_article_are_no_noise(spark):
    article = '<article><p>Main text</p><div class="share">Tell all</div></article>'
    wraps = ['<div class="site has-sidebar">{}</div>', '<main><h1>Top</h1><div class="layout-sidebar-right">{}</div></main>', "<form>{}</form>", '<div id="search-page"><div class="single header-fixed">{}</div></div>']
    others = '<div class="comments"><article>me too</article></div><aside><article>teaser</article></aside><div class="related-posts"><article>more</article></div>'
    rows = [(i, f"http://h{i}.org/", f"<body>{w.format(article + others)}</body>") for i, w in enumerate(wraps)]
    got = {r.page_id: r.text for r in html_text.extract(_pages(spark, rows)).collect()}
    assert got == {0: "Main text", 1: "Top Main text", 2: "Main text", 3: "Main text"}


def test_deep_nesting_takes_linear_time():
    import time

    start = time.perf_counter()
    n = 100_000
    for page in ("<div>x" * n, "<div>x" * n + "</span>" * n, "<b>x" * n + "</i>" * n, "<p>x" * n, "<ul><li>x" * n, "<a <b" * n, "<article>" + "<div>x" * n):
        html_text.blocks(page)
    assert time.perf_counter() - start < 60


def test_templates_match_a_plain_count(spark):
    """Pages without a marked article: the text is what stands in no subtree that enough pages of the host hold."""
    rng = random.Random(6)
    rows, want = [], {}
    for h in range(3):
        shared = [f"<div><p>Shared {h} {k}</p></div>" for k in range(6)]
        chosen = [[k for k in range(6) if rng.random() < (0.05, 0.08, 0.2, 0.4, 0.6, 0.9)[k]] for _ in range(40)]
        count = [sum(k in c for c in chosen) for k in range(6)]
        for i, own in enumerate(chosen):
            parts = [(f"Shared {h} {k}", shared[k], count[k]) for k in own] + [(f"Own {h} {i}", f"<section><p>Own {h} {i}</p></section>", 1)]
            rng.shuffle(parts)
            rows.append((len(rows), f"http://h{h}.org/{i}", "<html><body>" + "".join(p for _, p, _ in parts) + "</body></html>"))
            want[rows[-1][0]] = " ".join(t for t, _, n in parts if n < max(html_text.LEAST_PAGES, html_text.LEAST_SHARE * 40))
    got = {r.page_id: r.text for r in html_text.extract(_pages(spark, rows)).collect()}
    assert got == want and any("Shared" in t for t in want.values())


def test_query_takes_the_article_of_every_page(spark, sf_dir):
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    got = {r.page_id: r.text for r in queries.op10_html_text(spark, sf_dir).collect()}
    for i, page in pages.items():
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        plain = unescape(re.sub(r"<[^>]*>", lambda m: "" if m[0].strip("</>") == "b" else " ", inner))
        assert got[i] == " ".join(plain.split())


def test_repeated_documents_score_alike(spark):
    rows = [(i, "fine day in the park " + ("vile foul wretch" if i % 2 else "good kind folk")) for i in range(60)] * 2
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    d = docs(spark, rows)
    got = toxicity.score(d, toxicity.fit(d, labels)).collect()
    assert len(got) == len(rows) and len({(r.doc_id, r.score) for r in got}) == 60


def test_log_odds_have_one_prior():
    value, z = toxicity.log_odds(5, 5, 1000, 1000, 500)
    assert abs(value) < 1e-12 and abs(z) < 1e-12
    assert toxicity.log_odds(0, 0, 1000, 10_000, 500)[0] < 0.2
    rare, common = toxicity.log_odds(2, 0, 1000, 10_000, 500), toxicity.log_odds(50, 0, 1000, 10_000, 500)
    assert 0 < rare[1] < common[1] and rare[0] < common[0]
