"""Main text by scores: pages without article elements, stray quotes, reader comments, linear passes, a brute-force scorer."""

import random
import time

import pytest

from talweg.llm import extract as x

PROSE = "The river rose in the night, the bridge was closed, and by noon, as the mayor said, half of the town had moved uphill. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"


MENU = "<ul>" + "".join(f"<li><a href=/{i}>Section {i} of the paper</a></li>" for i in range(9)) + "</ul>"
COLUMNS = page(
    f"<div>{MENU}</div><div id=wrap><div class=col><h2>Flood</h2><p>{PROSE}</p><p>{PROSE}{PROSE}</p></div>"
    f"<div class=col><p>{PROSE}Second column.</p><p>{PROSE}</p></div><div><a href=/a>{PROSE}</a></div>"
    f"<div class=comments><p>{PROSE}{PROSE}First!</p><p>{PROSE}</p></div></div><div>Imprint</div>"
)
SECTIONS = page(f"<div>{MENU}</div><section>" + "".join(f"<div><h3>Part {i}</h3><p>{PROSE}</p></div>" for i in range(6)) + "</section><p>Short line</p>")
BARE = page(f"{MENU}<p>{PROSE}</p><p>{PROSE}</p><h2>Later</h2><p>{PROSE}</p>")
COMMENTED = page(
    f"<article><h1>Flood</h1><p>{PROSE}</p></article><article class='comment'><p>{PROSE * 5}</p></article>"
    f"<article id=reader-comments><p>{PROSE * 3}</p></article>"
)
SIDE = page(f"<main><h1>Flood</h1><div><p>{PROSE}</p><p>{PROSE}</p></div><div><p>{PROSE}</p></div>{MENU}</main><div><p>{PROSE}</p></div>")


def lines(*parts):
    return "\n".join(" ".join(p.split()) for p in parts)


def test_pages_without_an_article():
    assert x.extract(COLUMNS) == lines("Flood", PROSE, PROSE * 2, PROSE + "Second column.", PROSE)
    assert x.extract(SECTIONS) == lines(*[t for i in range(6) for t in (f"Part {i}", PROSE)])
    assert x.extract(BARE) == lines(PROSE, PROSE, "Later", PROSE)
    assert x.extract(COMMENTED) == lines("Flood", PROSE)
    assert x.extract(SIDE) == lines("Flood", PROSE, PROSE, PROSE)


def test_the_result_follows_the_score(monkeypatch):
    """With the order of the containers turned around, other text comes out."""
    pages = [COLUMNS, SECTIONS, BARE, SIDE]
    good = [x.extract(p) for p in pages]
    rank = x._rank
    monkeypatch.setattr(x, "_rank", lambda n: -rank(n) if n.chars else float("-inf"))
    assert all(a != b for a, b in zip(good, [x.extract(p) for p in pages]))


def brute_points(nodes, blocks):
    """Every block's points to every ancestor, one by one."""
    points = {id(n): 0.0 for n in nodes}
    chars, linked_chars = dict.fromkeys(points, 0), dict.fromkeys(points, 0)
    for owner, text, linked in blocks:
        gain = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        n = owner.parent if owner.tag in x._INNER and owner.parent else owner
        while n is not None:
            points[id(n)] += gain
            gain, n = gain * x.PASSED, n.parent
        n = owner
        while n is not None:
            chars[id(n)] += len(text)
            linked_chars[id(n)] += linked
            n = n.parent
    return points, chars, linked_chars


def random_page(rng, depth=0):
    tags = ["div", "p", "section", "ul", "li", "a", "b", "article", "blockquote", "td", "tr", "table", "h2", "span"]
    out = []
    for _ in range(rng.randrange(1, 5)):
        if depth > 5 or rng.random() < 0.35:
            out.append(rng.choice(["one, two", PROSE, "x", " "]))
        else:
            tag = rng.choice(tags)
            out.append(f"<{tag}>{random_page(rng, depth + 1)}" + (f"</{rng.choice([tag, tag, tag, 'div', 'b'])}>" if rng.random() < 0.9 else ""))
    return "".join(out)


def test_scores_equal_a_brute_force_scorer():
    rng = random.Random(5)
    for _ in range(200):
        html = random_page(rng)
        nodes, blocks = x._read(html)
        x._score(nodes, blocks)
        points, chars, linked = brute_points(nodes, blocks)
        for n in nodes:
            assert n.points == pytest.approx(points[id(n)]) and (n.chars, n.linked) == (chars[id(n)], linked[id(n)])
        if blocks:
            text = x.extract(html)
            wanted = [b[1] for b in blocks]
            assert all(line in wanted for line in text.split("\n") if line)


def test_stray_quotes_lose_and_leak_nothing():
    assert x.extract("<p title=it's>Long text …, and we don't lose it</p><p>Second, part</p>") == "Long text …, and we don't lose it\nSecond, part"
    assert x.extract('<p class="x>First, one of these</p><p>two</p>') == "First, one of these\ntwo"
    assert x.extract('<p data-a="1 > 0" title=\'a>b\'>kept</p>') == "kept"
    assert x.extract("<p title = \"it's\">we don't</p>") == "we don't"
    assert x.extract('<p a=b"c>kept "quoted" text</p>') == 'kept "quoted" text'
    assert x.extract("<p x=>kept</p>") == "kept"


def test_passes_are_linear():
    took = []
    for n in (4000, 16000):
        html = "<div>" * n + "".join(f"<p>Some text, {i}</p></div>" for i in range(n))
        start = time.process_time()
        assert x.extract(html)
        took.append(time.process_time() - start)
    assert took[1] < 12 * max(took[0], 0.05)
    start = time.process_time()
    x.extract("<span>" * 8000 + "</b>" * 8000 + "word, " * 10)
    assert time.process_time() - start < 1.0


def test_narrow_ids(spark):
    rows = spark.createDataFrame([(1, "u", "<p>é</p>")], "page_id int, url string, html string")
    assert [tuple(r) for r in x.extract_pages(rows).collect()] == [(1, "u", "é", 1)]
