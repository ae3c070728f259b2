"""Main texts: markup cues on made pages, whole articles on the given ones, shared runs on pages without cues."""

import html
import re

import numpy as np

from lakewright.llm import boilerplate
from tests.conftest import DATA


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, text string")
    return [r["text"] for r in boilerplate.main_texts(df).orderBy("page_id").collect()]


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in boilerplate.main_texts(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*)</article>", row["html"], re.S)[1]
        article = re.sub("</?(p|h1|br)>", "\n", article)
        wanted = " ".join(html.unescape(re.sub("<[^>]+>", "", article)).split())
        assert got[row["page_id"]] == (wanted, len(wanted))


def test_markup_cues():
    page = """<html><head><title>T</title><style>x</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>
    <div class="cookie-notice">We use <b>cookies</b></div><main><div id=sidebar>Side</div><article class="post"><header><h1>Ti&amp;tle</h1></header>
    <p>One&nbsp;<b>wo</b>rd &lt;b&gt; a < b <!-- <p>no</p> --><br>two<script>if (a < b) "<p>x</p>"</script></p><div class="ad-slot">Buy</div>
    <form><input name=a>Send</form><p title="a > b">Last &#233;<p>Open<section id="comments"><article class="comment">Nice!</article></section></article></main>
    <aside>More</aside><footer>&copy; Us</footer></body></html>"""
    assert [t for z, _, t in boilerplate.blocks(page) if z == boilerplate.MAIN_ZONE] == ["Ti&tle", "One word <b> a < b", "two", "Last é", "Open"]
    assert boilerplate.blocks("") == [] and boilerplate.blocks("<") == [(1, 0, "<")]
    assert [t for _, _, t in boilerplate.blocks("<nav>never closed<p>text</p><div hidden>no</div><p>&am &amp")] == ["never closed", "text", "&am &"]


def test_hints_in_names_of_parts():
    left_out = "post-comments article-comments entry-comments post-ad content-sidebar article-related post-share page-footer is-sponsored section-menu"
    for name in left_out.split():
        for kind in ("class", "id"):
            page = f"<article><p>Text</p><div {kind}='{name}'>Other</div></article>"
            assert [t for _, _, t in boilerplate.blocks(page)] == ["Text"], name
    for name in "entry-header post-footer page-header title-header has-sidebar no-comments comments-open".split():
        assert [t for _, _, t in boilerplate.blocks(f"<article><div class={name}>Text</div></article>")] == ["Text"], name
    for name in ("post comments-open", "promo", "related sidebar", "post no-comments"):
        assert [t for _, _, t in boilerplate.blocks(f"<article class='{name}'>Text<div role=article class='comment'>Nice</div></article>")] == ["Text"], name
    assert boilerplate.blocks("<article>Text<article class='comment-body'>Nice</article></article>") == [(0, 0, "Text")]


def test_shared_runs_are_removed_where_no_cue_helps(spark):
    menu, foot = "<div>Home News Sport Weather Contact Terms</div>", "<div>All rights reserved by the example press of the world</div>"
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(30)) + "."
    rows = [("http://h.example/a", f"<body>{menu}<div>{body(i)}</div>{foot}</body>") for i in range(12)]
    rows += [("http://other.example/", f"<body>{menu}<div>{body(99)}</div></body>"), ("http://h.example/b", None), (None, ""), ("http://c.example", "<p>")]
    got = texts(spark, rows)
    assert got[:12] == [body(i) for i in range(12)]
    assert got[12] == "Home News Sport Weather Contact Terms " + body(99)  # on one page of its host only
    assert got[13:] == ["", "", ""]
    copies = [("http://h.example/", f"<div>Menu one two three four</div><p>{body(1)}</p>")] * 6
    assert texts(spark, copies) == [body(1)] * 6
    assert texts(spark, []) == []


def test_teasers_are_no_main_text(spark):
    """Articles beside a story of their page's own are teasers, those beside a notice that all pages have are not."""
    story = lambda i: " ".join(f"w{i}x{k}" for k in range(40)) + "."
    teaser = "<article class=teaser><p>Short teaser text one.</p></article>"
    rows = [("http://h.example/", f"<body><div id=content><h1>Title {i}</h1><p>{story(i)}</p></div>{teaser}</body>") for i in range(5)]
    notice = " ".join(f"shared{k}" for k in range(60)) + "."
    rows += [("http://n.example/", f"<body><div>{notice}</div><article><p>A short story of number {i}.</p></article></body>") for i in range(5)]
    rows += [("http://one.example/", f"<body><p>{story(77)}</p>{teaser}</body>"), ("http://two.example/", f"<body><article><p>{story(78)}</p></article><p>{story(79)}</p></body>")]
    wanted = [f"Title {i} {story(i)}" for i in range(5)] + [f"A short story of number {i}." for i in range(5)] + [story(77), story(78)]
    assert texts(spark, rows) == wanted


def test_very_long_and_odd_pages(spark):
    """A page of two million words, one of nothing but markup, and nulls in every column."""
    long = "word " * 2_000_000
    rows = [("http://h.example/", f"<article><p>{long}</p></article>"), ("http://h.example/", f"<p>{long.strip()}.</p>"), ("http://h.example/", "<div>" * 50_000), (None, None)]
    got = texts(spark, rows)
    assert got[0] == long.strip() and got[2:] == ["", ""] and got[1].count("word") == 2_000_000


def test_shared_runs_are_cut_out_on_hosts_of_all_sizes(spark):
    """A notice on 4 of 400 pages, and inside a block of unique words; copies with headings and list items."""
    notice = "This notice stands on a few pages of the section and on no others"
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(14)) + "."
    rows = [("http://h.example/", f"<div>{body(i)}</div>" + (f"<div>{notice}</div>" if i < 2 else f"<div>unique {i} {notice} end {i}</div>" if i < 4 else "")) for i in range(400)]
    copy = f"<h1>A heading</h1><div>{body(999)}</div><ul><li>first item<li>second item</ul>"
    rows += [("http://h.example/", copy)] * 5
    wanted = [body(i) + (f" unique {i} end {i}" if 2 <= i < 4 else "") for i in range(400)] + [f"A heading {body(999)} first item second item"] * 5
    assert texts(spark, rows) == wanted
    menu = "<ul><li>Home<li>News<li>Sport<li>Weather<li>Contact<li>Terms</ul>"
    assert texts(spark, [("http://m.example/", f"{menu}<p>{body(i)}</p>") for i in range(3)]) == [body(i) for i in range(3)]
    assert boilerplate.kept_blocks(["no prose", "here"], [0, 0], [], only=True) == ["no prose", "here"]


def test_runs_by_suffix_array_equal_runs_by_search():
    import numpy as np

    rng = np.random.default_rng(1)
    tokens, sizes = rng.integers(0, 3, 400).astype(np.uint64), [50, 0, 3, 147, 200]
    ends = np.repeat(np.cumsum(sizes), sizes)
    groups = boilerplate.suffix_groups(tokens, ends, 5)
    wanted = [tuple(tokens[i : i + 5]) if i + 5 <= ends[i] else None for i in range(400)]
    names = {}
    for g, w in zip(groups, wanted, strict=True):
        assert (g == -1) == (w is None)
        if w:
            assert names.setdefault(w, g) == g
    assert len(set(names.values())) == len(names)


def shared_by_brute_force(pages):
    """Words outside of articles that three distinct pages of a host have in runs of ten words, or as whole blocks of five."""
    by_host = {}
    for page_id, url, page in pages:
        found = boilerplate.all_blocks(page)
        stream = [t.split(" ") for z, _, t in found if z != boilerplate.MAIN_ZONE]
        by_host.setdefault(boilerplate.host_of(url), []).append((page_id, tuple(t for _, _, t in found), stream))
    out = {}
    for rows in by_host.values():
        seen, runs = {}, {}
        for page_id, whole, stream in rows:
            words = [w for t in stream for w in t]
            own = [((10, *words[i : i + 10]), i, 10) for i in range(len(words) - 9)]
            for first in range(len(stream)):
                last, size = first, 0
                while size < 5 and last < len(stream):
                    size, last = size + len(stream[last]), last + 1
                if size >= 5:
                    own.append((("blocks", *map(tuple, stream[first:last])), sum(map(len, stream[:first])), size))
            runs[page_id] = own
            for run, _, _ in own:
                seen.setdefault(run, set()).add(whole)
        for page_id, own in runs.items():
            out[page_id] = len({p for run, i, n in own if len(seen[run]) >= 3 for p in range(i, i + n)})
    return out


def test_suffix_arrays_find_the_furniture_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r["n_shared"] for r in boilerplate.main_texts(pages).collect()}
    wanted = shared_by_brute_force([(r["page_id"], r["url"], r["html"]) for r in pages.collect()])
    assert got == wanted and any(got.values())


def test_shared_furniture_goes_without_any_cue(spark):
    words = lambda k: " ".join(f"own{k}word{i}" for i in range(12))
    page = lambda k: f"<div>Home News About Contact Search</div><div>{words(k)}</div><div>All rights reserved by the one and only great company of this site</div>"
    rows = [("http://a.example/x", page(k)) for k in range(3)] + [("http://b.example/x", page(9))]
    assert texts(spark, rows) == [*map(words, range(3)), "Home News About Contact Search " + words(9) + " All rights reserved by the one and only great company of this site"]


def test_suffix_array_sorts_all_suffixes():
    rng = np.random.default_rng(3)
    sizes = [7, 1, 40, 13]
    tokens, ends = rng.integers(0, 3, sum(sizes)).astype(np.uint64), np.repeat(np.cumsum(sizes), sizes)
    suffix = lambda i: tokens[i : ends[i]].tolist()
    assert boilerplate.suffix_array(tokens, ends).tolist() == sorted(range(len(tokens)), key=lambda i: (suffix(i), i))


def test_runs_that_most_articles_of_a_host_share_are_cut_out(spark):
    """A notice in all articles goes, a passage that some of them quote stays, and so do articles that are copies but for a few words."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n)) + "."
    notice, quote = words("notice", 15), words("quote", 15)
    rows = [("http://h.example/", f"<article><h1>Title {i}</h1><p>{words(i, 40)}</p>" + (f"<p>{quote}</p>" if i < 4 else "") + f"<p>{notice}</p></article>") for i in range(8)]
    rows += [("http://copies.example/", f"<article><p>{words('same', 40)} end {i}</p></article>") for i in range(6)]
    wanted = [f"Title {i} {words(i, 40)}" + (f" {quote}" if i < 4 else "") for i in range(8)]
    assert texts(spark, rows) == wanted + [f"{words('same', 40)} end {i}" for i in range(6)]


def test_article_candidates_over_chunks():
    """Between the first and the last host the runs that most articles have; at the ends, which go on in other chunks, those of a quarter."""
    words = lambda *kinds: np.concatenate([100 * k + np.arange(10) for k in kinds]).astype(np.int32)
    streams = [("a", words(90, 0)), ("a", words(1)), ("a", words(2))] + [("b", words(*[10 + i] + [91] * (i < 4) + [91] * (i < 1))) for i in range(7)] + [("c", words(20)), ("d", words(21))]
    got = boilerplate.article_candidates(streams)
    counts = {(h, int(n), int(of)) for h, n, of in zip(got["host"], got["has"], got["of"], strict=True)}
    assert counts == {("a", 1, 3), ("b", 4, 7), ("d", 1, 1)} and (got["host"] == "b").sum() == 1
