"""Template deduction: the classes decide, slowly deduced templates agree, hostile pages stay cheap."""

import json
import time
import tracemalloc
from collections import Counter

import pytest

from tideline.llm import html

SCHEMA = "page_id long, url string, html string, text string"
LONG = "Some words of the story that go on and on, page {k} part {j}, until it is told. " * 6


def frame(spark, sources, host="a.example.org"):
    return spark.createDataFrame([(k, f"https://{host}/{k}", s, "x") for k, s in enumerate(sources)], SCHEMA)


def texts(spark, sources):
    return [r["text"] for r in html.main_text(frame(spark, sources)).orderBy("page_id").collect()]


def page(k, notice="", lead=True):
    body = f'<h1>Title {k}</h1><p class="lead">The lead of page {k}, short but there, it says what is to come next.</p>'
    body += '<div class="text">' + "".join(f"<p>{LONG.format(k=k, j=j)}</p>" for j in range(2 + k % 2)) + "</div>"
    want = [f"Title {k}", f"The lead of page {k}, short but there, it says what is to come next."]
    want += [LONG.format(k=k, j=j).strip() for j in range(2 + k % 2)]
    return f'<body><div id="top">Home - About</div>{notice}<div class="content">{body}</div><div id="end">All rights</div></body>', "\n".join(want)


def test_heading_and_lead_belong_to_the_article(spark):
    pages, want = zip(*(page(k) for k in range(6)))
    assert texts(spark, pages) == list(want)


@pytest.mark.parametrize("copies", [3, 5, 40])
def test_copies_of_one_page_are_one_page(spark, copies):
    """However many copies a host has, its only page has no template and keeps its text."""
    source, want = page(1)
    got = set(texts(spark, [source] * copies))
    assert len(got) == 1 and want in got.pop()


def test_copies_among_other_pages(spark):
    pages, want = zip(*(page(k) for k in [0, 0, 0, 0, 0, 0, 1, 2, 3]))
    assert texts(spark, pages) == list(want)


def test_notice_inside_main_is_template(spark):
    """Boilerplate without a telling name, inside the article element, goes by its class alone."""
    notice = '<div class="x1">Read our terms before you go on.</div>'
    pages = [f"<main>{notice}<p>{LONG.format(k=k, j=0)}</p><p>{LONG.format(k=k, j=1)}</p></main>" for k in range(6)]
    assert texts(spark, pages) == [f"{LONG.format(k=k, j=0).strip()}\n{LONG.format(k=k, j=1).strip()}" for k in range(6)]


def test_without_classes_the_result_is_another(spark, monkeypatch):
    pages, want = zip(*(page(k, '<div class="x9">Nothing tells that this is no story.</div>' if k % 2 else "") for k in range(8)))
    assert texts(spark, pages) == list(want)
    monkeypatch.setattr(html, "SUPPORT", 2.0)  # no class is frequent
    assert texts(spark, pages) != list(want)


def test_telling_names_do_not_bar_the_whole_page(spark):
    story = LONG.format(k=0, j=0).strip()
    got = texts(spark, [f'<body><div class="company-related"><p>{story}</p><div class="related"><p>See also</p></div></div></body>'])
    assert got == [story]


def test_comments_longer_than_the_article_go(spark):
    story = LONG.format(k=0, j=0).strip()
    comments = "".join(f"<p>{LONG.format(k=k, j=9)}</p>" for k in range(2))
    pages = [f'<body><article><p>{story} {k}</p></article><section class="comments">{comments}{k}</section></body>' for k in range(4)]
    assert texts(spark, pages) == [f"{story} {k}" for k in range(4)]


def test_variants_of_one_page_keep_their_text(spark):
    """Pages that differ in a word share all other text, which is not boilerplate for that."""
    story = "".join(f"<p>{LONG.format(k=0, j=j)}</p>" for j in range(4))
    pages = [f"<body><div class='c'>{story}<p>Version {k}</p></div></body>" for k in range(5)]
    for k, got in enumerate(texts(spark, pages)):
        assert got.count("until it is told") == 24 and f"Version {k}" in got


# ---- slow deduction ----


def slow_template(sources):
    """Explicit occurrence vectors over the distinct pages; classes valid by recursion on what is around them."""
    pages = [html.Page(s) for s in sorted(set(sources))]
    counts, tag, around, chars = [], {}, {}, Counter()
    for p in pages:
        own, good = Counter(), p.counting()
        below, scale = Counter(), max(sum(len(t) for k, t in p.blocks if good[k]), 1)
        for k, t in p.blocks:
            up = k
            while good[k] and up >= 0:
                below[up] += len(t)
                up = p.parent[up]
        for k in range(len(p.parent)):
            token = ("e", p.place[k])
            own[token] += 1
            tag[token], around[token] = p.tag[k], ("e", p.place[p.parent[k]]) if k else None
            chars[token] += below[k] / scale
        for k, t in p.blocks:
            if good[k]:
                token = ("t", html.text_token(p.place[k], t))
                own[token] += 1
                tag[token], around[token] = None, ("e", p.place[k])
                chars[token] += len(t) / scale
        counts.append(own)
    vector = {t: tuple(c[t] for c in counts) for t in tag}
    frequent = {t for t, v in vector.items() if sum(map(bool, v)) >= max(2, 0.5 * len(pages))}
    members = {}
    for t in frequent:
        members.setdefault(vector[t], set()).add(t)

    def valid(v, seen=()):
        outer = set()
        for t in members[v]:
            a = around[t]
            if a is None:
                outer.add("top")
            elif a not in frequent:
                return False
            elif vector[a] != v:
                outer.add(vector[a])
        if len(outer) != 1 or v in seen:
            return False
        (o,) = outer
        return o == "top" or valid(o, (*seen, v))

    template = {t for v, ts in members.items() if valid(v) for t in ts}
    whole = chars["e", 0] if ("e", 0) in template else 0
    fixed = {t for t in template if t[0] == "t" and sum(map(bool, vector[t])) >= 4}
    if sum(chars[t] for t in fixed) > 0.2 * whole:
        fixed = set()
    return {t[1] for t in template if t[0] == "e"}, sorted(t[1] for t in fixed)


def hosts():
    yield [page(k)[0] for k in range(6)]
    yield [page(k, '<div class="x9">Now and then.</div>' if k % 3 else "")[0] for k in range(9)]
    yield [f"<div><ul>{'<li>a' * (k % 3)}</ul><p>{k}</p><p>same</p></div>" for k in range(7)]
    yield ["<p>x</p>", "<p>x</p><p>y</p>", "<div><p>x</p></div>", "<b>z</b>", "<p>x</p>"]
    yield [f"<div class=a><div class=b>{'<i>t</i>' * k}</div></div><div class=a>{k}</div>" for k in range(5)]


@pytest.mark.parametrize("sources", list(hosts()))
def test_templates_equal_slow_deduction(spark, sources):
    pages = frame(spark, [*sources, sources[0], None, ""])
    elements, fixed = slow_template(sources)
    (row,) = html.templates(pages).collect()
    found = json.loads(row["template"])
    assert found["texts"] == fixed and (found["region"] == 0 or found["region"] in elements)


# ---- hostile pages ----

HOSTILE = {
    "unclosed inline": "<font color=red>" * 62_000, "nested": "<div>" * 200_000, "open tag": "<a " * 333_000, "open quote": "<p a='" * 166_000,
    "signs": "<" * 1_000_000, "wrong ends": "<div>" * 50_000 + "</span>" * 100_000, "odd quotes": "<a \"'>" * 160_000,
    "items": "<p><font>" * 50_000 + "<li>" * 100_000, "list": "<ul>" + "<li><span>x" * 80_000, "comments": "<!--" * 250_000, "text": "word " * 200_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_are_cheap(name):
    tracemalloc.start()
    begun = time.process_time()
    html.main_blocks(HOSTILE[name])
    seconds, (_, most) = time.process_time() - begun, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 200 << 20 and seconds < 20  # tracing memory slows it by a factor of five or so
