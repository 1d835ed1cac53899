import math

import pytest

from aurum.llm import html_extract, url_filter
from aurum.llm.html_blocks import read

PAGES = "page_id long, url string, html string, host string, texts string"
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, rest[end:].split("?")[0].split("#")[0]


def plain_rule(host, path):
    fits = [(len(t), t, v) for v, t in RULES for h, p in [(t.split("/", 1)[0], "/" + t.split("/", 1)[1])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "https://b.www.example.com/en/1", "http://x.net/es/",
        "http://x.net/esx", "http://xnet/es/", "http://q.net?x=/es/", "http://com", "http://com/", "ftp://É.Com/ü", "nohost",
        None, "", "x://y://z/w", "http://ab.org/#/en/", "http://example.com/EN/"]


def test_hosts_paths_and_rules(spark):
    df = pages(spark, [(i, u, "cheap words and win") for i, u in enumerate(URLS)])
    for r in url_filter.verdicts(df, RULES).collect():
        host, path = plain_host_path(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == (verdict or ("block" if r.log_odds > 0 else "allow"))


def test_viterbi_is_the_best_split():
    counts = {"cheap": 50, "pills": 20, "che": 3, "ap": 5, "pill": 30, "s": 90, "a": 400}
    total = sum(counts.values())

    def splits(name):
        yield from ([[name]] if name else [[]])
        for i in range(1, len(name)):
            for rest in splits(name[i:]):
                yield [name[:i], *rest]

    def worth(words):
        return round(sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)
                         for w in words), 6), -len(words)

    for name in ("cheappills", "apills", "xyz", "acheap", "pillspill"):
        assert worth(url_filter.viterbi(name, counts, total)) == max(worth(s) for s in splits(name))


def test_log_odds_are_those_of_a_plain_naive_bayes(spark):
    hosts = ["news.site.org"] * 30 + ["casinowin.site.org"] * 6 + ["blog.other.org"] * 20 + ["win.other.org"] * 2
    rows = [(i, f"http://{h}/en/{i % 7}", "news site org casino win blog other " * 20) for i, h in enumerate(hosts)]
    got = {r.page_id: r for r in url_filter.verdicts(pages(spark, rows), ()).collect()}
    split = {"casinowin": ["casino", "win"]}
    tokens = [[w for part in h.split(".") for w in split.get(part, [part])] + ["en", "0"] for h in hosts]
    bad = ["casino" in t for t in tokens]
    n, b = {}, {}
    for t, x in zip(tokens, bad, strict=True):
        for w in t:
            n[w] = n.get(w, 0) + 1
            b[w] = b.get(w, 0) + x
    total, blocked, m = sum(n.values()), sum(b.values()), url_filter.SMOOTHING
    prior = round(1e6 * math.log((sum(bad) + .5) / (len(bad) - sum(bad) + .5)))
    for i, t in enumerate(tokens):
        odds = sum(round(1e6 * (math.log((b[w] + m * n[w] / total) / (blocked + m))
                                - math.log((n[w] - b[w] + m * n[w] / total) / (total - blocked + m)))) for w in t)
        assert abs(got[i].log_odds - prior - odds) <= len(t)
    assert {got[i].verdict for i, x in enumerate(bad) if x} == {"block"}
    assert {got[i].verdict for i, h in enumerate(hosts) if h.startswith(("news", "blog"))} == {"allow"}


def test_no_pages(spark):
    empty = pages(spark, [])
    assert url_filter.verdicts(empty, RULES).count() == 0 and html_extract.extract(empty).count() == 0


@pytest.mark.parametrize("source, blocks", [
    (None, []), ("", []), ("plain &amp; text", ["plain & text"]),
    ("<p>a <b>b</b>c<br>d\n\t e</p>", ["a bc d e"]),
    ("<p>one<p>two<li>3<li>4", ["one", "two", "3", "4"]),
    ("<p>x</p><script>var t='<p>no</p>';</script><style>p{}</style><p>y", ["x", "y"]),
    ("<div title='a>b'>kept</div><!-- <p>no</p> --><p>z", ["kept", "z"]),
    ("<nav>menu</nav><header>top</header><aside>s</aside><footer>f</footer><form>q</form><p>body", ["body"]),
    ("<div class='cookie-notice'>c</div><div id=sidebar>s</div><ul class=\"comments\"><li>r</ul><p>body", ["body"]),
    ("<p>a<span class=ad>buy</span>b</p>", ["a", "b"]), ("<p hidden>h</p><p>v</p><foot", ["v"]),
    ("<head><title>t</title></head><p>after", ["after"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("<p>5 < 6 &lt; 7&nbsp;8", ["5 < 6 < 7 8"]), ("<article><header><h1>T</h1></header><p>x", ["T", "x"]),
    ("<p>" + "word " * 100_000, [("word " * 100_000).strip()])])
def test_blocks_of_a_page(source, blocks):
    assert [b[1] for b in read(source).blocks] == blocks


def site(host, n, body):
    top = "<html><body><div class=x><p>Welcome to the site</p></div><nav><a>Home</a></nav>"
    return [(i, f"http://{host}/{i}", f"{top}{body(i)}<p>All rights reserved by us</p><footer>f{i}</footer></body></html>")
            for i in range(n)]


def test_template_text_drops_out_and_slots_stay(spark):
    plain = site("plain.org", 12, lambda i: f"<div class=story><h2>Title {i}</h2><p>Own text {i} of {i * i}</p></div>")
    marked = [(100 + i, u.replace("plain", "marked"), h) for i, u, h in site(
        "plain.org", 8, lambda i: f"<article><h1>Head {i}</h1><p>Para {i}</p></article>")]
    few = [(200, "http://few.org/1", "<p>Only page</p>"), (201, None, None), (202, "http://few.org/2", "")]
    got = {r.page_id: r for r in html_extract.extract(pages(spark, plain + marked + few)).collect()}
    assert [got[i].text for i in range(12)] == [f"Title {i}\nOwn text {i} of {i * i}" for i in range(12)]
    assert [got[100 + i].text for i in range(8)] == [f"Head {i}\nPara {i}" for i in range(8)]
    assert (got[200].text, got[201].text, got[202].text) == ("Only page", "", "")
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_every_slot_with_own_text_stays_on_pages_without_a_region(spark):
    """A heading beside the body, lists and sections: siblings of the slot that holds most text."""
    top = "<html><body><div class=x><p>Welcome to the site</p></div><nav><a>Home</a></nav>"
    bodies = {"head.org": lambda i: (f"<div class=post><h1>Title {i}</h1><div class=body><p>Long own text {i} of {i * i}</p>"
                                     f"<p>More {i}</p></div></div>"),
              "list.org": lambda i: f"<div><p>Intro {i}</p><ul><li>First point {i}<li>Second point {i}</ul><p>End {i}</p></div>",
              "parts.org": lambda i: "".join(f"<section class=s{'abc'[k]}><h2>H{k} {i}</h2><p>Part {k} of {i}</p></section>"
                                             for k in range(3))}
    own = {"head.org": lambda i: [f"Title {i}", f"Long own text {i} of {i * i}", f"More {i}"],
           "list.org": lambda i: [f"Intro {i}", f"First point {i}", f"Second point {i}", f"End {i}"],
           "parts.org": lambda i: [t for k in range(3) for t in (f"H{k} {i}", f"Part {k} of {i}")]}
    rows = [(100 * h + i, f"http://{host}/{i}", f"{top}{body(i)}<p>All rights reserved by us</p></body></html>")
            for h, (host, body) in enumerate(bodies.items()) for i in range(6)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert got == {100 * h + i: "\n".join(own[host](i)) for h, host in enumerate(bodies) for i in range(6)}


def test_articles_copied_inside_a_host_are_no_template(spark):
    def page(host, i, date, story, mark=""):
        inner = "".join(f"<p>{p}</p>" for p in story)
        return (i, f"http://{host}/{i}", f"<html><body><div class=x><p>Welcome to the site</p></div><p>Day {date}</p>"
                f"<div class=story>{mark and f'<{mark}>'}{inner}{mark and f'</{mark}>'}</div><p>All rights reserved by us</p></body></html>")

    story = [f"Paragraph {k} of the story that was copied" for k in range(4)]
    other = [[f"Other text {i} number {k}" for k in range(4)] for i in range(20)]
    rows = [page("copies.org", i, 1, story if i < 6 else other[i]) for i in range(10)]  # equal pages
    rows += [page("near.org", 100 + i, i, story if i < 5 else other[i]) for i in range(8)]  # equal but for the day
    rows += [page("marked.org", 200 + i, i, story if i < 5 else other[i], "article") for i in range(8)]
    rows += [page("long.org", 300 + i, 1, story if i < 3 else other[i]) for i in range(5)]  # three distinct pages only
    got = {r.page_id: r.text.split("\n") for r in html_extract.extract(pages(spark, rows)).collect()}
    assert all(got[i] == (story if i < 6 else other[i]) for i in range(10))
    assert all(got[100 + i] == [f"Day {i}", *(story if i < 5 else other[i])] for i in range(8))
    assert all(got[200 + i] == (story if i < 5 else other[i]) for i in range(8))
    assert all(set(story if i < 3 else other[i]) <= set(got[300 + i]) for i in range(5))


LONG = "The article's own text, a good deal longer than all that stands around it on the page."


@pytest.mark.parametrize("source, text", [
    *[(f"<div class='{c}'><div><p>{LONG}</p></div></div><p>x</p>", f"{LONG}\nx") for c in (
        "wrap has-sidebar", "no-sidebar", "comments-open", "social-share-enabled", "search-results", "related")],
    *[(f"<nav>n</nav><{e} class='{c}'><p>{LONG}</p></{e}><p>x</p>", LONG) for e in ("article", "main") for c in (
        "has-sidebar", "comments-open", "search", "related")],
    (f"<form id=f><div class=menu><article><p>{LONG}</p><div class=share-buttons>Share</div></article></div></form>", LONG),
    (f"<article><p>{LONG[:40]}</p></article><div class=comments><article>{LONG}</article></div>", LONG[:40]),
    (f"<main><article>{LONG[:40]}</article><div id=comments><p>{LONG}</p></div></main>", LONG[:40]),
    (f"<main><div class=related><p>{LONG}</p></div></main>", LONG),
    (f"<p>{LONG}</p><div class=comments><article>First!</article></div>", f"{LONG}\nFirst!"),
    (f"<nav>{LONG}</nav><p>short</p><div class='left-sidebar'>s</div><div class='ad-300x250'>a</div>", "short"),
    (f"<header><h1>site</h1></header><header><article>{LONG}</article></header>", LONG)])
def test_an_element_that_holds_the_article_is_not_left_out(source, text):
    assert html_extract.main_text(read(source), frozenset()) == text
