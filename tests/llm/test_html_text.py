"""Main text of pages: repeated runs against brute force, markup cases, whole pages against the article they hold."""

from __future__ import annotations

import html
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from meterlake.llm import html_text

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=30), min_size=1, max_size=8), st.lists(st.integers(0, 3), min_size=8, max_size=8), st.integers(1, 5))
def test_repeated_runs_against_all_windows(streams, groups, run):
    groups = np.unique(groups[: len(streams)], return_inverse=True)[1]
    weak, strong = html_text.repeated_runs([np.array(s, dtype=np.int64) for s in streams], groups, run, 2, 3)
    where: dict[tuple, set] = {}
    for s, g in zip(streams, groups):
        for i in range(len(s) - run + 1):
            where.setdefault(tuple(s[i:i + run]), set()).add(g)
    half = max(3, (len(set(groups)) + 1) // 2)
    for s, w, t in zip(streams, weak, strong):
        for mask, least in ((w, 2), (t, half)):
            hit = [i for i in range(len(s) - run + 1) if len(where[tuple(s[i:i + run])]) >= least]
            assert mask.tolist() == [any(i <= p < i + run for i in hit) for p in range(len(s))]


def text_of(*pages: str) -> list[str]:
    return [t for t, _ in html_text.main_texts([html_text.page_blocks(p) for p in pages])]


def test_query_gives_the_articles(spark):
    got = {r["page_id"]: r for r in html_text.op13_html_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        parts = [" ".join(html.unescape(p).split()) for p in parts]
        text = "\n\n".join(p for p in parts if p)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (text, len(text), r["url"])


def test_markup():
    page = """<!DOCTYPE html><HTML><Head><title>No</title><style>p{}</style><meta name=x><body class="has-sidebar">
      <header><a href="/">Site</a></header><div id="cookieNotice">Cookies!</div><NAV><ul><li>a<li>b</ul></NAV>
      <main><article class="post"><header><h1>Head &amp;amp; <b>tail</b></h1></header><p>One&nbsp;two<br>three &lt;p&gt; 1 < 2
      <p title="a > b">Four <i>fi</i>ve<script>var x = "</p>";</script> six<!-- not > this --><div class="ad-slot">Buy</div>
      <ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table><form>Mail <input></form><p>In <span class="share">Share</span> line</p>
      <blockquote>Said <article>quoted</article></blockquote><div hidden>no</div><p style="display: none">no</p>
      <section class="comments"><p>Nice</p></section><footer>by me</footer><p>End &#233; &copy</p></article>
      <article>Second</article></main><aside>more</aside><p>outside</p><footer>&copy; x</footer>"""
    assert text_of(page) == ["\n\n".join([
        "Head &amp; tail", "One two three <p> 1 < 2", "Four five six", "x", "y", "c1", "c2", "In line", "Said", "End é ©", "Second",
    ])]


def test_cut_and_broken_pages():
    assert text_of("", "<p", "<", "plain text", "<article>open <b>end", "<p>a</div></b>b", "<script>x", "<!-- x", "<article></article><p>x</p>", "<p>a <i class=ad>b") == [
        "", "", "<", "plain text", "open end", "ab", "", "", "x", "a"]
    deep = "<div>" * 50_000 + "deep" + "</div>" * 50_000 + "<b>" * 50_000 + "</i>" * 50_000
    assert text_of(deep) == ["deep"]
    assert text_of("<p>" + "word " * 200_000 + "</p>") == [("word " * 200_000).strip()]


def test_unmarked_boilerplate_is_found_by_its_repetition():
    menu = "<div class=x1>Home and News and Sport and Weather and Contact</div>"
    tail = "<div class=x9>All rights reserved by the owner of this fine site</div>"
    own = [" ".join(f"w{k}{i}" for i in range(20)) for k in range(6)]
    pages = [f"{menu}<div><p>{t}</p><p>short {k}</p></div>{tail}" for k, t in enumerate(own)]
    assert text_of(*pages) == [f"{t}\n\nshort {k}" for k, t in enumerate(own)]
    # Copies of one page are one page: nothing is left out because of them.
    copy = f"<div><p>{own[0]} {own[1]}</p><p>{own[2]}</p></div>"
    assert text_of(*[copy] * 9) == [f"{own[0]} {own[1]}\n\n{own[2]}"] * 9


def test_in_an_article_only_what_most_pages_hold_goes():
    own = [" ".join(f"w{k}{i}" for i in range(30)) for k in range(8)]
    call = "Please tell all your friends about the pages of this site today"
    shared = "A passage that three of the pages quote at length from some book"
    pages = [f"<article><p>{t}</p>{f'<p>{shared}</p>' if k < 3 else ''}<p>{call}</p></article>" for k, t in enumerate(own)]
    assert text_of(*pages) == [t + (f"\n\n{shared}" if k < 3 else "") for k, t in enumerate(own)]
    near = [f"<article><p>{own[0]} {k}</p><p>{own[1]} {k}</p></article>" for k in range(8)]
    assert text_of(*near) == [f"{own[0]} {k}\n\n{own[1]} {k}" for k in range(8)]


def test_edges_and_split_hosts(spark):
    body = "<article><p>text {}</p></article>"
    rows = [(i, f"HTTP://Big.example/{i}", body.format(i)) for i in range(60)] + [(60, None, body.format(60)), (61, "no url", None), (61, "no url", None), (None, "", ""), (62, "http://[bad", "<p>x")]
    frame = spark.createDataFrame([(*r, "h", 5, "t") for r in rows], "page_id long, url string, html string, host string, part int, text string")
    for part_bytes in (8_000_000, 500):
        got = [tuple(r) for r in html_text.main_text(frame, part_bytes=part_bytes).select("page_id", "url", "text").collect()]
        want = [(i, u, f"text {i}" if i is not None and i <= 60 else {62: "x"}.get(i, "")) for i, u, _ in rows]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert html_text.main_text(frame.where("false")).count() == 0


def test_results_do_not_depend_on_the_size_of_a_host(spark):
    """Runs on few pages of a host, in copies, and on half of all, whatever parts the pages fall into."""
    from collections import defaultdict

    def words(*key) -> str:
        return " ".join(f"w{'x'.join(map(str, key))}x{i}" for i in range(12))

    rows = []
    for k in range(40):
        own = f"<p>{words('own', k)} {words('more', k)}</p>"
        menu, rare = f"<div>{words('menu')}</div>", f"<p>{words('rare')}</p>" if k in (3, 17, 31) else f"<p>{words('twice')}</p>" if k in (5, 22) else ""
        rows.append((k, f"http://free.example/{k}", menu + own + rare))
        call = f"<p>{words('call')}</p>" if k % 20 < 10 else f"<p>{words('less')}</p>" if k < 19 else ""
        rows.append((100 + k, f"http://article.example/{k}", f"<article>{own}{call}{rare}</article>"))
        # Copies of four pages, each with a line that three of the four have.
        line = f"<p>{words('line')}</p>" if k % 4 else ""
        rows.append((200 + k, f"http://copies.example/{k}", f"<div><p>{words('a', k % 4)} {words('b', k % 4)}</p>{line}<p>{words('only')} {k}</p></div>" if k < 36 else f"<main><p>{words('m', k)} {words('n', k)}</p>{line}</main>"))
        rows.append((300 + k, f"http://mixed.example/{k}", menu + own if k % 5 == 0 else f"<article>{own}<p>{words('menu')}</p></article>"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    hosts = defaultdict(list)
    for i, u, page in rows:
        hosts[u.split("/")[2]].append((i, html_text.page_blocks(page)))
    want = {i: got for members in hosts.values() for (i, _), got in zip(members, html_text.main_texts([b for _, b in members]))}
    assert {n for _, n in want.values()} > {0, 1}
    for part_bytes in (8_000_000, 6_000, 700):
        found = {r["page_id"]: (r["text"], r["n_repeated"]) for r in html_text.main_text(frame, part_bytes=part_bytes).collect()}
        assert found == want
