"""Operator 7: suffix array against brute force, template pages, broken markup, edge rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

from quire.llm import html_extract as he
from quire.llm.queries import op7_html_extract

RNG = random.Random(3)


def prose(n):
    return " ".join("".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 8))) for _ in range(n))


def test_suffix_array_orders_suffixes():
    codes = np.array([RNG.randrange(3) for _ in range(300)], np.uint64)
    order, rank = he.suffix_array(codes, 8)
    starts = [tuple(codes[i:i + 8].tolist()) for i in range(300)]
    assert [starts[i] for i in order] == sorted(starts)
    for i in range(300):
        for j in range(0, 300, 7):
            assert (rank[i] == rank[j]) == (starts[i] == starts[j])


def test_page_counts_against_brute_force():
    streams = [[RNG.choice("ab") for _ in range(RNG.randint(0, 60))] for _ in range(9)] + [list("abababababab")] * 3
    found = defaultdict(set)
    for p, s in enumerate(streams):
        for i in range(len(s) - he.LONG + 1):
            found[tuple(s[i:i + he.LONG])].add(p)
    for s, got in zip(streams, he.page_counts(streams)):
        expected = [0] * len(s)
        for i in range(len(s) - he.LONG + 1):
            n = len(found[tuple(s[i:i + he.LONG])])
            for k in range(i, i + he.LONG):
                expected[k] = max(expected[k], n if n > 1 else 0)
        assert got.tolist() == expected


def test_repeated_runs_go_and_unique_runs_stay():
    terms = "All rights reserved by the owners of this fine place since long ago"
    bodies = [prose(60) for _ in range(30)]
    pages = [f"<html><body><div><p>{b}</p></div><div>{terms}</div></body></html>" for b in bodies]
    assert he.main_texts(pages) == bodies
    # inside an article it takes most pages of the host
    pages = [f"<article><p>{b}</p><p>{terms}</p></article>" for b in bodies]
    assert he.main_texts(pages) == bodies
    quoted = [f"<article><p>{b}</p>{f'<p>{terms}</p>' if i < 10 else ''}</article>" for i, b in enumerate(bodies)]
    assert he.main_texts(quoted) == [f"{b} {terms}" if i < 10 else b for i, b in enumerate(bodies)]
    assert he.main_texts([f"<article>{bodies[0]}</article>"] * 3) == [bodies[0]] * 3  # mirrors


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a &amp; b&nbsp;c &lt;x&gt; &eacute; &#233; &#x41;</p>", "a & b c <x> é é A"),
    ("<article><h1>T</h1><p>o<b>n</b>e<br>two<p>three", "T one two three"),
    ("<nav>menu</nav><main>text<footer>no</footer></main><footer>foot</footer>", "text"),
    ("<script>var t='</p>';</script><style>p{}</style><p>x</p><script>cut", "x"),
    ("<div class='ad'>buy<div>more</div></div><p>x</p><div class=\"side-bar comments\">c</div>", "x"),
    ("<article>a<aside>s</aside><div class=comments><p>c</p></div>b</article>after", "a b"),
    ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no</p>", "yes"),
    ("<p title='a>b'>ok</p><p", "ok"),
    ("<article><p>x &am</p></article>", "x &am"),
    ("a < b and c > d", "a < b and c > d"),
    ("<div class='cookie-notice'>c</div><form><input>f</form><header>h</header><p>t</p>", "t"),
])
def test_markup(page, text):
    assert he.main_texts([page]) == [text]


def test_table_with_hot_host_and_edge_rows(rows, monkeypatch):
    monkeypatch.setattr(he, "BLOCK_PAGES", 20)
    bodies = {i: prose(30) for i in range(100)}
    page = "<html><body><nav><a>x</a></nav><article><p>{}</p></article></body></html>"
    data = [(i, f"http://{'hot' if i % 3 else 'h' + str(i)}.com/{i}", page.format(b), "x", 1) for i, b in bodies.items()]
    data += [(200, None, page.format("no url"), "x", 1), (201, "http://hot.com/", None, "x", 1),
             (202, "HTTP://HOT.com", "", "x", 1), (None, "bad", page.format("b " * 50000), "x", 1),
             (203, "http://hot.com/z", page.format("z"), "x", 1), (203, "http://hot.com/z", page.format("z"), "x", 1)]
    schema = "page_id long, url string, html string, text string, host int"
    out = he.extract_main_text(rows(data, schema)).collect()
    assert len(out) == len(data)
    by = {r.page_id: r for r in out}
    assert all(by[i].text == b for i, b in bodies.items())
    assert by[200].text == "no url" and by[201].text == by[202].text == "" and by[201].n_chars == 0
    assert by[None].text == " ".join(["b"] * 50000) and by[None].n_chars == 99999
    assert he.extract_main_text(rows([], schema)).collect() == []


def test_whole_table(spark):
    out = op7_html_extract(spark, "/root/testdata/sf0.01")
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 250
    assert out.filter("n_chars <> length(text) or n_chars = 0").count() == 0


def test_article_text_that_odd_markup_must_not_cost():
    """Names that begin like raw elements, closed svg, stray quotes, side words as parts of other words."""
    for page, want in {
        "<article><svg-icon a=1></svg-icon><p>real text here</p></article>": "real text here",
        "<article><title-bar>x</title-bar><p>real text here</p></article>": "x real text here",
        "<article><svg class=\"i\"/><p>real text here</p></article>": "real text here",
        "<article><svg/><p>real text here</p></article>": "real text here",
        "<article><svg a='/>'><path d='M0'/>gone</svg><p>real text here</p></article>": "real text here",
        "<p class=x\">hello world</p><p>say \"hi\" ok</p>": "hello world say \"hi\" ok",
        "<p title=\"a > b\" class='c > d'>one</p><p>two</p>": "one two",
        "<article><div class=\"ad-free reading\">body text</div><p class=\"share-price\">up</p>"
        "<section class=\"related-work\">prior art</section></article>": "body text up prior art",
        "<article><p>kept</p><div class=\"ad\">buy</div><div class='share-buttons x'>tell</div></article>": "kept",
    }.items():
        assert he.main_texts([page]) == [want], page


def test_very_long_page():
    page = "<article><p>" + "many words here <b>and</b> there " * 100_000 + "</p><p class=x" + "\"" * 50_000 + ">end</p></article>"
    (text,) = he.main_texts([page])
    assert text.startswith("many words here and there") and text.endswith("there end") and len(text) > 2_500_000


def test_boilerplate_is_counted_over_the_host(rows, monkeypatch):
    """A large host gives the texts that one block of all its pages gives, at shares near the bounds."""
    rng = random.Random(7)
    lines = {i: f"line {i} " + prose(12) for i in range(40)}
    data = []
    for i in range(240):
        shared = [lines[j] for j in range(40) if rng.random() < (0.1 + j / 200 if j < 30 else 0.4 + j / 200)]
        body = "".join(f"<p>{x}</p>" for x in [prose(5), *shared])
        data.append((i, f"http://one.com/{i}", f"<article>{body}</article>" if i % 2 else f"<div>{body}</div>"))
    data += [data[0]] * 3 + [(1000, "http://one.com/x", None), (1001, "http://two.com/", "<p>alone</p>")]
    want = sorted(zip([d[0] for d in data[:-1]], he.main_texts([d[2] or "" for d in data[:-1]]))) + [(1001, "alone")]
    table = rows(data, "page_id long, url string, html string")
    plain = "".join(t for _, t in want)
    assert any(x in plain for x in lines.values()) and not all(x in plain for x in lines.values())
    for pages in (256, 60, 13, 3):
        monkeypatch.setattr(he, "BLOCK_PAGES", pages)
        assert sorted((r.page_id, r.text) for r in he.extract_main_text(table).collect()) == want, pages


def test_runs_cover_the_same_tokens_by_hash_and_by_suffix():
    streams = [[RNG.choice("ab") for _ in range(RNG.randint(0, 60))] for _ in range(12)] + [[], list("abababab")]
    hashes, offset = he.coded(streams)
    at, page = he.places(offset)
    runs = he.run_hashes(hashes, at)
    pages = {r: len(set(page[runs == r])) for r in runs}
    three = np.array([r for r, n in pages.items() if n >= 3], np.uint64)
    (got,) = he.frequent_in_pages(streams, three)
    assert [g.tolist() for g in got] == [(c >= 3).tolist() for c in he.page_counts(streams)]


def test_codes_are_unpacked():
    for n in range(20):
        codes = np.array([RNG.randrange(16) for _ in range(n)], np.uint8)
        assert he.unpacked(he.packed(codes)).tolist() == codes.tolist()
