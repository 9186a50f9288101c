"""Main text: reading of blocks, importance against a recursive version, sites with and without telling names."""

import math
import random

import pytest

from contigframe.llm import dom
from contigframe.llm import html_extract as X
from contigframe.llm import util


def blocks(source):
    page = dom.read(source)
    return [(page.tags[b[0]], b[1]) for b in page.blocks]


def alone(source, url="no address"):
    page, shown, keep = X._read(source)
    return X.main_text(page, shown, keep, set(), X.host_key(url))


def test_reading():
    assert blocks("") == blocks(" \n ") == []
    assert blocks("a < b &amp; c &lt;d&gt; &#233;&nbsp;\n e&copy") == [("#page", "a < b & c <d> é e©")]
    assert blocks("<p>one<p>two <b>bold<br>line<p>three</b></div></p>") == [("p", "one"), ("p", "two bold line"), ("p", "three")]
    assert blocks('<script>var t="</p>"; if (a<b) x("<p>no</p>")</script><p title="a>b" data-x=\'<p>\'>yes<!-- <p>no</p> --></p>') == [("p", "yes")]
    assert blocks("<ul><li>a<ul><li>b</ul><li>c</ul>d") == [("li", "a"), ("li", "b"), ("li", "c"), ("#page", "d")]
    assert blocks("<table><tr><td>1<td>2<tr><th>3</table>x<h1>t<h2>u</h2>v") == [("td", "1"), ("td", "2"), ("th", "3"), ("#page", "x"), ("h1", "t"), ("h2", "u"), ("#page", "v")]
    assert blocks("<html><head><title>no</title><meta x><body>yes<p>cut <a href='x") == [("body", "yes"), ("p", "cut")]
    assert blocks("un<i>bro</i>ken<span hidden>no</span> word<!DOCTYPE x><!-- open") == [("#page", "unbroken word")]
    assert blocks("<div>" * 3000 + "deep" + "</div>" * 2000 + "<p>x")[:2] == [("div", "deep"), ("p", "x")]


def test_what_is_aside():
    page = """<body class="has-sidebar"><header><h1>Site</h1></header><nav>n</nav><div id="cookie-notice">c</div><div class="layout with-sidebar"><div class=adBox>ad</div>
      <form id=aspnet><main><article><header><h1>Title</h1></header><p>First <span class="ad">buy</span>part.</p><form><input>mail <button>go</button></form><div style="display: none">h</div>
      <ul><li><a href=x>one</a><li><a href=y>two</a><li><a href=z>three</a></ul><pre>x = 1 <span class="comment"># kept</span></pre><footer>tags</footer></article>
      <section class="comments"><article>I disagree</article></section></main></form></div><aside>s</aside><div role=complementary>r</div><p>outside</p><footer>© us</footer>"""
    assert alone(page) == "Title\nFirst part.\none\ntwo\nthree\nx = 1 # kept"
    soup = "<div><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>Us</a></ul></div><div class=text><h1>T</h1><p>A long enough paragraph of the text.</p></div><div>© 2020 Us</div>"
    assert alone(soup) == "T\nA long enough paragraph of the text."
    assert alone("just words") == "just words" and alone("<nav>n</nav>") == ""


def site(n, seed, words=200):
    """Pages of a host whose names tell nothing: the same menu, notice and legal lines round texts of their own."""
    r = random.Random(seed)
    text = lambda k: " ".join(f"w{r.randrange(words)}" for _ in range(k))
    out = []
    for i in range(n):
        ps = [text(30) for _ in range(1 + r.randrange(4))]
        body = "".join(f"<p>{p}</p>" for p in ps)
        out.append((f"<html><body><div class=q1><p>Home News Shop</p></div><div class=q2>All about it {i % 2}</div><div class=q3><h2>T{i} {ps[0].split()[0]}</h2>{body}</div><div class=q4><p>We use bits of you.</p><p>Rights here.</p></div></body></html>", "\n".join([f"T{i} {ps[0].split()[0]}", *ps])))
    return out


def brute(pages):
    """{key: (pages, importance)} by walking the merged tree of one host from its root."""
    out = {}

    def kinds(page, shown, i):
        size, got = page.sums(shown), []
        for c in page.children[i]:
            if shown[~c] if c < 0 else size[c]:
                name = page.labels[c] if c >= 0 else "#text"
                if not got or got[-1][0] != name:
                    got.append((name, []))
                got[-1][1].append(c)
        return got

    def entropy(counts, m):
        total = sum(counts)
        return -sum(c / total * math.log(c / total, m) for c in counts)

    def walk(path, places):  # places: (page number, elements at this place)
        m = len(places)
        if path[-1] == "#text":
            per = {}
            for k, cs in places:
                for c in cs:
                    per.setdefault(pages[k][0].blocks[~c][1], {}).setdefault(k, 0)
                    per[pages[k][0].blocks[~c][1]][k] += 1
            value = 1 - min(1, sum(entropy(d.values(), m) for d in per.values()) / len(per)) if m > 1 else 1.0
        else:
            styles = {}
            for k, es in places:
                for e in es:
                    row = kinds(*pages[k], e)
                    styles.setdefault(tuple(n for n, _ in row), []).append((k, [c for _, c in row]))
            total = sum(map(len, styles.values()))
            held = 0
            for names, uses in styles.items():
                parts = []
                for at, name in enumerate(names):
                    merged = {}
                    for k, cs in uses:
                        merged.setdefault(k, []).extend(cs[at])
                    parts.append(walk((*path, names, at, name), sorted(merged.items())))
                held += len(uses) / total * sum(parts) / len(parts)
            own = min(1, max(0, entropy([len(u) for u in styles.values()], m))) if m > 1 else 1.0
            left = X.DECAY ** len(styles)
            value = (1 - left) * own + left * held if m > 1 else 1.0
        out[path] = (m, value)
        return value

    walk(("#page",), [(k, [0]) for k in range(len(pages))])
    return out


def key_of(path, host):
    key = host
    for names, at, name in zip(path[1::3], path[2::3], path[3::3]):
        key = X._hash(f"{at} {name}", X._hash("\0".join(names), key))
    return X._signed(key)


SCHEMA = "page_id long, url string, html string, text string, host int"


def test_importance_against_recursion(spark):
    sources = [s for s, _ in site(9, 3)] + ["<p>odd<p>page", "<div class=q1><p>Home News Shop</p></div>", "<div class=q1><p>Home News Shop</p><p>twice</p></div>"]
    df = spark.createDataFrame([(i, "http://a.example/" + str(i), s, "x", 1) for i, s in enumerate([*sources, sources[0]])], SCHEMA)
    with util.Scratch(spark) as tmp:
        got = {r["key"]: (r["m"], r["importance"]) for r in X.importance(X.style_tree(df, tmp), tmp).collect()}
    host = X.host_key("http://A.example:80/x")
    want = {key_of(p, host): v for p, v in brute([X._read(s)[:2] for s in sources]).items()}
    several = {k: v for k, v in want.items() if v[0] > 1}
    assert set(got) == set(several) and len(got) > 10
    assert all(got[k][0] == m and math.isclose(got[k][1], v, abs_tol=1e-9) for k, (m, v) in several.items())


@pytest.mark.parametrize("few", [X.FEW_KEYS, 0])
def test_sites_tell_what_names_dont(spark, few):
    pages = [(f"https://u@Site{k}.example.org:8080/{i}", s, want) for k in range(3) for i, (s, want) in enumerate(site(12, k))]
    df = spark.createDataFrame([(i, u, s, "x", 1) for i, (u, s, _) in enumerate(pages)], SCHEMA).repartition(5)
    got = {r["page_id"]: (r["text"], r["n_chars"], r["url"]) for r in X.extract(df, few=few).collect()}
    assert got == {i: (want, len(want), u) for i, (u, _, want) in enumerate(pages)}


def test_copies_of_an_article_stay(spark):
    r = random.Random(1)
    page = lambda i, words: f"<body><nav>n{i}</nav><article><h1>Title</h1><p>{' '.join(words[:40])}</p><p>{' '.join(words[40:])}</p></article><footer>f</footer>"
    words = [f"w{r.randrange(500)}" for _ in range(80)]
    sources = [page(i, words) for i in range(20)]
    for i in range(20):  # near copies: other words here and there
        words[r.randrange(80)] = f"v{i}"
        sources.append(page(i, words))
    df = spark.createDataFrame([(i, "http://h/", s, "x", 1) for i, s in enumerate(sources)], SCHEMA)
    assert all(r["text"].startswith("Title\nw") and r["text"].count("\n") == 2 for r in X.extract(df).collect())


def test_odd_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 20_000
    rows = [(1, None, None), (1, "http://a/", ""), (None, "http://a/", "<p>x"), (2, "not an address", "<p>x"), (3, "http://a/", long), (3, "http://a/", long)]
    got = sorted((r["page_id"] or 0, r["url"] or "", r["n_chars"]) for r in X.extract(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect())
    assert got == [(0, "http://a/", 1), (1, "", 0), (1, "http://a/", 0), (2, "not an address", 1), *[(3, "http://a/", 20_000 * 12 - 1)] * 2]
    assert X.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark):
    """The table's articles, read another way."""
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in X.op13_main_text(spark, "/root/testdata/sf0.01").collect()}
    for r in rows:
        article = r["html"].split("<article>")[1].split("</article>")[0].replace("<b>", "")
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"</?p>|</?h1>|<br>", article)]
        assert got[r["page_id"]] == "\n".join(x for x in parts if x)
