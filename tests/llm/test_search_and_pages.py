from pathlib import Path

import numpy as np
import pytest

from bindery.llm.ann import nearest
from bindery.llm.html_text import Page, common, extract, lines, main_text, shared_path


def brute(rows, queries, k):
    fine = {}
    for i, v in rows:
        if i is None or v is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        fine[i] = min(fine.get(i, v), v)
    out = {}
    for q in {i for i, _ in queries if i in fine}:
        scored = sorted((-float(np.dot(np.array(fine[q]), np.array(v))), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(20)]
    rows += [(20, rows[0][1]), (21, rows[0][1]), (22, None), (23, [0.0] * 4), (24, [float("nan"), 1.0, 1.0, 1.0]), (25, [None, 1.0, 1.0, 1.0]), (26, [1.0, 2.0]), (27, [2.0, 1.0]), (None, rows[1][1]), rows[5], (28, [])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, shard string")
    as32 = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = {}
    for r in nearest(df, df.where("vec_id % 2 = 0"), k=6, shard=9).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {q: x for q, x in brute(as32, [r for r in as32 if r[0] is not None and r[0] % 2 == 0], 6).items() if x}
    assert got.keys() == want.keys()
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
    assert nearest(df.limit(0), df.limit(0)).count() == 0


def test_recall_with_many_equal_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = np.r_[centres[rng.integers(0, 12, 2600)] + rng.normal(scale=0.3, size=(2600, 16)), np.tile(centres[0], (700, 1))].astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = nearest(df, df.where("vec_id % 60 = 0"), shard=1024).toPandas()
    assert recall(x, got) >= 0.9


def recall(x, got):
    """Share of answers as near as the 20th nearest, by brute force; every query has 20."""
    s = x.astype(float) @ x.astype(float).T
    hit = 0
    for q, g in got.groupby("query_id"):
        score = s[q].copy()
        score[q] = -np.inf
        least = np.sort(score)[-20]
        hit += (s[q][g.vec_id] >= least - 1e-9).sum()
    assert (got.groupby("query_id").size() == 20).all()
    return hit / (20 * got.query_id.nunique())


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").is_dir(), reason="needs the generated tables")
@pytest.mark.parametrize("shard", [256, 2048])
def test_recall_on_the_table_over_many_shards(spark, shard):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("vec_id < 4000")
    x = np.array(df.orderBy("vec_id").toPandas()["embedding"].tolist())
    got = nearest(df, df.where("vec_id % 40 = 0"), shard=shard).toPandas()
    assert got.query_id.nunique() == -(-len(x) // 40) and recall(x, got) >= 0.9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/x">menu</a></li></ul></nav><div class="ad">buy &amp; sell</div><!-- <p>no</p> -->
<article><h1>Ti&eacute;tle {n}</h1><p>One <b>bold
  text</b> &lt;here&gt; {n}<p>Two<br>lines</p><div class="share-bar">share</div><form><p>sign up</p></form><section class="comments"><p>nice</p></section></article>
<aside>side</aside><footer>foot</footer></body></html>"""


def test_declared_articles(spark):
    assert [x.text for x in lines(PAGE.replace("{n}", "1")) if x.article and not x.furniture and not x.hinted] == ["Tiétle 1", "One bold text <here> 1", "Two lines"]
    rows = [(1, "http://a.b/x/1", PAGE.replace("{n}", "1"), "p"), (2, "http://a.b/x/2", PAGE.replace("{n}", "2"), "p"), (3, None, None, "p"), (4, "http://a.b/x/2", PAGE.replace("{n}", "2"), "p"), (5, "", "", "p"), (6, "u", "plain  text", "p"), (None, "u", "<p>x", "p")]
    got = {(r.page_id): r for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")).collect()}
    assert len(got) == 7
    for i in (1, 2, 4):
        assert got[i].text == f"Tiétle {min(i, 2)}\nOne bold text <here> {min(i, 2)}\nTwo lines" and got[i].n_chars == len(got[i].text)
    assert got[3].text == got[5].text == "" and got[6].text == "plain text" and got[None].text == "x"
    assert extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_differencing_without_an_article(spark):
    page = lambda k: f"<body><div>Welcome to our site</div><div>Body text number {k}</div><p>More of {k}</p><div>All rights reserved</div></body>"
    rows = [(k, f"http://h.org/news/{k}", page(k)) for k in range(30)] + [(99, "http://other.org/news/1", page(99))]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == f"Body text number {k}\nMore of {k}" for k in range(30))
    assert got[99] == "Welcome to our site\nBody text number 99\nMore of 99\nAll rights reserved"


def test_common_is_a_longest_subsequence():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = ([str(x) for x in rng.integers(0, 5, rng.integers(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = [a[i] for i in sorted(common(a, b))]
        it = iter(b)
        assert len(got) == best[-1][-1] and all(x in it for x in got)


def test_class_names_alone_drop_nothing_of_an_article(spark):
    names = ("search-results", "share", "notice", "menu", "ad", "promo", "related work")
    page = lambda k: f"<article><h1>Title {k}</h1>" + "".join(f'<p class="{n}">{n} says {k}</p>' for n in names) + '<div class="share">Share this</div><p>The same sentence.</p></article>'
    rows = [(k, f"http://h.org/a/{k}", page(k)) for k in range(3)]
    got = {r.page_id: r for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(3):
        assert got[k].text == f"Title {k}\n" + "".join(f"{n} says {k}\n" for n in names) + "The same sentence."
        assert got[k].n_shared == 1  # "Share this", which only its neighbour proves to be furniture


def test_menus_of_links(spark):
    menu = "".join(f"<li><a href=/{k}>go {k}</a></li>" for k in range(4))
    rows = [(1, "http://a.org/", f"<body><ul>{menu}</ul><div>Text with <a href=/>a link</a></div><div><a href=/>more</a></div></body>")]
    assert extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).first().text == "Text with a link\nmore"


def brute_texts(rows):
    """Nearest neighbour by path among all pages of a host, without ranges."""
    import re

    split = lambda u: (re.match(r"https?://([^/]*)(.*)", u)[1], re.match(r"https?://([^/]*)([^?#]*)", u)[2])
    order = sorted(rows, key=lambda r: (*split(r[1]), r[1], r[0]))
    pages = [Page(*split(u), [x.text for x in lines(h)], [x.flags for x in lines(h)]) for _, u, h in order]
    return {r[0]: main_text(p, pages[k - 1] if k else None, pages[k + 1] if k + 1 < len(pages) else None)[0] for k, (r, p) in enumerate(zip(order, pages, strict=True))}


def test_ranges_do_not_show(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(300):
        host = "hot.org" if k % 3 else f"h{k % 40}.org"
        body = "".join(f"<div>{w}</div>" for w in (f"head {k % 4}", f"text {k}", f"side {k % 5}", f"more {k}", "foot"))
        rows.append((k, f"http://{host}/{rng.integers(0, 9)}/{k}", f"<body>{body}</body>"))
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = brute_texts(rows)
    total = sum(len(r[2]) for r in rows)
    for ranges in (1, 7, 64, 290):
        got = {r.page_id: r.text for r in extract(df.repartition(5), range_bytes=-(-total // ranges)).collect()}
        assert got == want, ranges


def test_long_pages_in_linear_memory():
    a = [str(k % 997) for k in range(100_000)]
    b = [str(k % 991) for k in range(100_000)]
    n = len(common(a, b))
    assert n > 10_000
    x = [str(k) for k in range(50_000)]
    assert len(common(["p", *x, "q"], ["r", *x[:20_000], "z", *x[20_000:], "s"])) == 50_000


def test_linear_space_alignment_is_a_longest_one():
    rng = np.random.default_rng(6)
    for _ in range(6):
        a, b = ([str(x) for x in rng.integers(0, 40, rng.integers(80, 260))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        got = [a[i] for i in sorted(common(a, b))]
        it = iter(b)
        assert len(got) == best[-1, -1] and all(x in it for x in got)


def test_shared_path():
    p = lambda host, path: Page(host, path, [], [])
    assert shared_path(p("a", "/x/1"), p("a", "/x/2")) == 3 and shared_path(p("a", "/"), p("b", "/")) == -1 == shared_path(p("a", "/"), None)


def test_attributes_as_browsers_read_them():
    say = lambda h: [(x.text, x.furniture) for x in lines(h)]
    assert say("<article><p title=it's>one</p><p>two</p></article>") == [("one", False), ("two", False)]
    assert say("<p><a href=/x/>link</a> and text") == [("link and text", False)]
    assert say("<p class=x/>gone? <b>no</b></p>") == [("gone? no", False)]
    assert say('<p title="a > b">x</p><p data-a=\'"\'>y</p>') == [("x", False), ("y", False)]
    assert say("<div hidden>no</div><div title='hidden'>yes</div>") == [("no", True), ("yes", False)]
    assert say("a < b and <3 and </ > c") == [("a < b and <3 and </ > c", False)]
    assert say("x<!-- - > <p>no --><br>y<p title=\"open>no") == [("x y", False)]
    assert [x.text for x in lines("<script>if (a<b) '</scripty>'</SCRIPT >in")] == ["in"]


@pytest.mark.parametrize("unit", ["<a ", "<p title=it's>w</p>", "<a href=/x/>w</a>", "</b>", "<b><p></p>", '<p title="x', "< ", "<!-- ", "<script>", "<a = ", "<div>"])
def test_broken_pages_take_linear_time(unit):
    import time

    took = []
    for size in (300_000, 3_000_000):
        began = time.process_time()
        lines(unit * (size // len(unit)))
        took.append(time.process_time() - began)
    assert took[1] < max(3.0, 25 * took[0])


def test_names_that_only_hold_a_hint_drop_nothing(spark):
    body = "".join(f'<div class="{c}">{c} stays</div>' for c in ("notice-of-change", "comment-free", "ad-hoc", "related-work-in-physics"))
    gone = "".join(f'<div class="{c}">{c} goes</div>' for c in ("notice", "comments-list", "ad-slot", "cookie-banner", "newsletter-signup-box"))
    papers = "".join(f"<li><a href=/{k}>A paper of many words, number {k}</a></li>" for k in range(3))
    rows = [(1, "http://a.org/1", f"<article><p>Text</p>{body}{gone}</article>"), (2, "http://b.org/1", '<body><div class="widget">main body</div></body>'), (3, "http://c.org/1", f"<body><p>Intro</p><ul>{papers}</ul><p>End</p></body>")]
    menu = "".join(f"<li><a href=/{k}>go {k}</a></li>" for k in range(4))
    rows += [(10 + k, f"http://d.org/x/{k}", f"<body><ul>{menu}</ul><ul><li><a>one {k}</a></li><li><a>two {k}</a></li><li><a>three {k}</a></li></ul><p>Text {k}</p></body>") for k in range(3)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1] == "Text\n" + "\n".join(f"{c} stays" for c in ("notice-of-change", "comment-free", "ad-hoc", "related-work-in-physics"))
    assert got[2] == "main body"
    assert got[3] == "Intro\n" + "\n".join(f"A paper of many words, number {k}" for k in range(3)) + "\nEnd"
    # With a partner, what is shared decides, and nothing else.
    assert all(got[10 + k] == f"one {k}\ntwo {k}\nthree {k}\nText {k}" for k in range(3))


def test_invented_pages_against_their_own_parts(spark):
    """Pages put together from parts of which it is known whether they belong to the text."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(2, 8)))
    rows, want = [], {}
    for k in range(50):
        site, article = k % 5, k % 2
        own = [" ".join([f"p{k}", *(word() for _ in range(rng.integers(1, 12)))]) for _ in range(rng.integers(1, 9))]
        middle = "".join(f"<p id=x{j}>{t.replace(' ', rng.choice([' ', chr(10), ' <i>']), 1)}" if j % 2 else f"<div>{t}</div>" for j, t in enumerate(own))
        junk = '<div class="share">Share</div><section class="comments"><p>reader %d</p></section>' % k
        middle = f"<article>{middle}{junk}</article>" if article else f"<main>{middle}</main>"
        html = f"<html><head><title>t{k}</title></head><body><header>Site {site}<nav><a href=/>Home</a></nav></header><div class='ad'>buy {k}</div><form>mail me</form>{middle}<footer>(c) site {site}</footer><script>var x='<p>no';</script></body></html>"
        rows.append((k, f"http://s{site}.org/{'ab'[k % 2]}/{k}", html))
        want[k] = "\n".join(own)
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)).collect()}
    assert got == want
