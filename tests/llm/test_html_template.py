"""Template deduction: nested classes, their slots, marked articles, and a plain version over whole hosts."""

import random
from collections import Counter, defaultdict

import xxhash

from aurum.llm import html_extract as H
from aurum.llm.html_blocks import read

PAGES = "page_id long, url string, html string, HOST string, classes string, slot int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)


def texts(spark, rows):
    return {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}


def plain_texts(htmls):
    """The texts of one host's pages, from occurrence vectors, intervals and places written out in full."""
    read_pages = [read(h) for h in htmls]
    lists = []
    for page in read_pages:
        row, done = [], 0
        for path, text, region, at in page.blocks:
            row += [("e", p) for p in page.elements[done:at]] + [("t", path, text, region and page.has_region)]
            done = at
        lists.append(row + [("e", p) for p in page.elements[done:]])
    one = {tuple(t[2] for t in row if t[0] == "t"): (row, H.page_tokens(p)[0]) for row, p in zip(lists, read_pages, strict=True)}
    found = list(one.values())
    template = set()
    if len(found) >= H.MIN_PAGES:
        vectors = {t: tuple(row.count(t) for row, _ in found) for row, _ in found for t in row}
        n_marked = sum(any(t[0] == "t" and t[3] for t in row) for row, _ in found)

        def frequent(t, n):
            inside = t[0] == "t" and t[3]
            return n >= H.MIN_SHARE * len(found) and (not inside or (n == n_marked and n >= H.MIN_PAGES))

        groups = defaultdict(list)
        for t, v in vectors.items():
            if frequent(t, sum(map(bool, v))):
                groups[v].append(t)

        def rank(v):
            value = 0
            for n, (_, content) in zip(v, found, strict=True):
                value ^= xxhash.xxh64_intdigest(f"{content}:{n}") if n else 0
            return -sum(map(bool, v)), -len(groups[v]), value - (1 << 64) if value >> 63 else value

        classes = [groups[v] for v in sorted((v for v in groups if len(groups[v]) >= H.MIN_TOKENS), key=rank)]
        of = {t: c for c, members in enumerate(classes) for t in members}
        seen, rest, all_own = defaultdict(Counter), Counter(), Counter()
        for row, _ in found:
            at = {c: [i for i, t in enumerate(row) if of.get(t) == c] for c in set(of.values())}
            for i, t in enumerate(row):
                if t in of:
                    c = of[t]
                    around = [b for b, x in at.items() if x and b < c and x[0] < i < x[-1]]
                    b = max(around, key=lambda b: at[b][0], default=-1)
                    slot = (sum(x < i for x in at[b]) - 1) % len(classes[b]) if around else -1
                    seen[t][at[c].index(i) % len(classes[c]), b, slot] += 1
            own = sum(len(t[2]) for t in row if t[0] == "t" and t not in of)
            for c, x in at.items():
                if x:
                    rest[c] += own
                    all_own[c] += 1
        for c, members in enumerate(classes):
            stay = [t for t in members if max(seen[t].values()) >= H.MIN_KEPT * sum(seen[t].values())]
            chars = [sum(len(t[2]) * sum(seen[t].values()) for t in members if t[0] == "t" and t[3] == inside)
                     for inside in (False, True)]
            if len(stay) >= H.MIN_TOKENS and not (all_own[c] < len(found) and chars[0] > rest[c]):
                template |= {t for t in stay if not (t[0] == "t" and t[3] and chars[1] > rest[c])}
    return ["\n".join(t[2] for t in row if t[0] == "t" and t not in template and (t[3] or not page.has_region))
            for row, page in zip(lists, read_pages, strict=True)], template


def random_host(seed):
    """Pages with optional and repeated parts, marked articles on some hosts, moved parts and copies."""
    rng = random.Random(seed)
    mark = rng.choice(["", "article", "main"])
    out = []
    for i in range(rng.choice([4, 8, 14])):
        own = [f"<p>Own {seed} {i} {k} {'word ' * rng.randrange(6)}</p>" for k in range(rng.randrange(1, 5))]
        share = "<p>Share this on X</p><ul class=tags><li>More like this</ul>"
        if rng.random() < .4:
            own.insert(rng.randrange(len(own) + 1), "<p>A passage that many of the pages have</p>")
        rows = "".join(f"<section class=row><h3>Offer</h3><p>item {rng.randrange(9)} of {i}</p><b>Buy now</b></section>"
                       for _ in range(rng.randrange(3)))
        banner = ("<div class=t><h4>Sale</h4><p>Now on</p></div>", "<div class=u><p>Sale ends</p></div>") \
            if rng.random() < .7 else ("", "")
        parts = ["<div class=x><h2>Welcome</h2><p>The site</p></div>", banner[0], rows, banner[1], "<p>All rights reserved</p>"]
        if rng.random() < .08:
            rng.shuffle(parts)
        body = "".join([share if seed % 2 else "", *own, "" if seed % 3 else share])
        parts.insert(3, f"<{mark}>{body}</{mark}>" if mark else f"<div class=story>{body}</div>")
        out.append(f"<html><body>{''.join(parts)}</body></html>")
    return out + rng.choices(out, k=2)


def test_texts_are_those_of_a_plain_deduction(spark):
    hosts = {s: random_host(s) for s in range(24)}
    rows = [(1000 * s + i, f"http://h{s}.org/{i}", h) for s, htmls in hosts.items() for i, h in enumerate(htmls)]
    got, changed, inside = texts(spark, rows), 0, 0
    for s, htmls in hosts.items():
        want, template = plain_texts(htmls)
        assert [got[1000 * s + i] for i in range(len(htmls))] == want, s
        changed += any(t[0] == "t" for t in template)
        inside += any(t[0] == "t" and t[3] for t in template)
    assert changed > 8 and inside > 2  # the template takes part, in marked articles as well


def article(i, extra="", tail=""):
    return f"<html><body><nav>menu</nav><main><h1>Head {i}</h1>{extra}<p>Own text {i} of {i * i}</p>{tail}</main></body></html>"


def test_a_template_line_in_a_marked_article_goes_with_its_host(spark):
    share = "<p>Share this on X</p>"
    every = [(i, f"http://every.org/{i}", article(i, tail=share)) for i in range(8)]
    some = [(100 + i, f"http://some.org/{i}", article(i, tail=share if i < 6 else "")) for i in range(8)]
    few = [(200 + i, f"http://few.org/{i}", article(i, tail=share)) for i in range(4)]
    got = texts(spark, every + some + few)
    assert all(got[i] == f"Head {i}\nOwn text {i} of {i * i}" for i in range(8))
    # not on every page with an article, or on too few pages: the article's own
    assert all(got[100 + i].endswith("Share this on X") == (i < 6) for i in range(8))
    assert all(got[200 + i].endswith("Share this on X") for i in range(4))


def test_near_copies_of_an_article_on_one_host_keep_it(spark):
    story = "".join(f"<p>Paragraph {k} of a story that all pages of the host carry</p>" for k in range(5))
    rows = [(i, f"http://near.org/{i}", article(i, extra=story)) for i in range(9)]
    assert all(t.count("Paragraph") == 5 for t in texts(spark, rows).values())


def nested(i, moved=False):
    rows = "".join(f"<section class=r><h3>Offer</h3><p>item {i} {k}</p><h4>Buy now</h4></section>" for k in range(i % 3 + 1))
    top, end = "<div class=a><p>Welcome</p></div>", "<div class=z><p>All rights reserved</p></div>"
    return f"<html><body>{end if moved else top}<h1>Title {i}</h1>{rows}{top if moved else end}</body></html>"


def test_classes_nest_and_slots_are_told_apart(spark):
    df = pages(spark, [(i, f"http://nested.org/{i}", nested(i)) for i in range(9)])
    parts = sorted(H.templates(df).collect(), key=lambda r: r["class"])
    assert [(r["class"], r.parent) for r in parts] == [(0, -1), (1, 0)]
    outer, inner = parts
    before = outer.tokens[inner.slot]  # the rows lie behind the heading's element
    assert before == H._hash("/html/body/h1") and len(inner.tokens) == 6
    assert outer.tokens[-1] == H._text_token("/html/body/div.z/p", "All rights reserved")
    got = {r.page_id: r for r in H.extract(df, with_slots=True).collect()}
    for i in range(9):
        items = [f"item {i} {k}" for k in range(i % 3 + 1)]
        assert [s.text for s in got[i].slots] == [f"Title {i}", *items] == got[i].text.split("\n")
        heading, *others = [(s.part, s.slot) for s in got[i].slots]
        assert heading == (0, inner.slot) and set(others) == {(1, inner.tokens.index(H._hash("/html/body/section.r/p")))}


def test_a_page_in_another_order_does_not_void_the_template(spark):
    rows = [(i, f"http://moved.org/{i}", nested(i, moved=i == 3)) for i in range(24)]
    assert all(t.split("\n") == [f"Title {i}", *(f"item {i} {k}" for k in range(i % 3 + 1))]
               for i, t in texts(spark, rows).items())
    # where half of the pages have them in another order, they are no template
    rows = [(i, f"http://moved.org/{i}", nested(i, moved=i % 2 == 0)) for i in range(24)]
    assert all({"Welcome", "All rights reserved"} <= set(t.split("\n")) for t in texts(spark, rows).values())


def test_a_class_over_several_slots_is_divided(spark):
    def page(i):
        top, end = ("<div class=t><h4>Sale</h4></div>", "<div class=u><h4>Sale ends</h4></div>") if i % 4 else ("", "")
        return (f"<html><body><h2>Site</h2>{top}<div class=s><p>Own {i} and more of it, {i} times</p></div>{end}"
                f"<h5>Rights</h5></body></html>")

    df = pages(spark, [(i, f"http://sale.org/{i}", page(i)) for i in range(12)])
    parts = [r for r in H.templates(df).collect() if r["class"] == 1]
    assert len(parts) == 2 and len({r.slot for r in parts}) == 2 and {r.parent for r in parts} == {0}
    assert {r.text for r in H.extract(df).collect()} == {f"Own {i} and more of it, {i} times" for i in range(12)}
