import random
import time
import xml.etree.ElementTree as ET

import pytest

from tidemark.llm.html_text import _Tree, main_text, scores

ART = (
    "<h1>Head</h1><p>Some text, with commas, and enough letters to count as text of the page.</p>"
    "<p>More of it, here, and here, to the end.</p>"
)
LINES = "Head\nSome text, with commas, and enough letters to count as text of the page.\nMore of it, here, and here, to the end."


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="layout has-sidebar">{ART}<div class="sidebar"><a>x</a><p>Side text.</p></div></div>',
        f'<div class="ad-free content">{ART}</div>',
        f'<div class="article related-content">{ART}</div>',
        f'<form id="aspnetForm">{ART}<form class="search"><p>Find, what, you, like.</p></form></form>',
        f'<div class="related">{ART}</div><div class="comments">{"<p>I, too, think so, and more, more, more.</p>" * 20}</div>',
        f"<header><p>Our site.</p></header><div>{ART}</div><footer><p>{'Rights, all, of us. ' * 40}</p></footer>",
        f'<div class="cookie"><p>{"We use, and use, cookies. " * 30}</p></div><div>{ART}</div>',
    ],
)
def test_articles_stay_whatever_their_holders_are_called(page):
    assert main_text(page) == LINES


def test_short_siblings_stay():
    assert main_text(f"<div><div>{ART}</div><div><p>Short end.</p></div></div>") == f"{LINES}\nShort end."
    assert main_text(f"<div><div>{ART}</div><p>Now see <a>it</a> there.</p></div>") == f"{LINES}\nNow see it there."
    assert main_text(f"<div><div>{ART}</div><p><a>All links</a></p><div>&copy; us</div></div>") == LINES


def test_equal_containers_and_repeats():
    half = "<div><p>Equal, equal, equal parts of one page here.</p></div>"
    assert main_text(f"<body>{half}{half}</body>").count("\n") == 1


@pytest.mark.parametrize(
    "page", ["<div>x, y" * 100_000, "<div>" + "</b>" * 100_000 + "x", "<b>" * 100_000 + "</i>" * 100_000, "<p>" + "<span>" * 50_000 + "<h2>" * 50_000]
)
def test_deep_and_stray_tags_take_linear_time(page):
    begun = time.process_time()
    main_text(page)
    assert time.process_time() - begun < 10


def test_scores_are_those_of_every_paragraph_taken_alone():
    rng = random.Random(4)

    def grow(level):
        if level == 5 or rng.random() < 0.3:
            text = ", ".join("word" * rng.randint(1, 9) for _ in range(rng.randint(1, 6)))
            return f"<p>{text}</p>" if rng.random() < 0.7 else f"<p>{text} <a>to, there</a></p>"
        inside = "".join(grow(level + 1) for _ in range(rng.randint(1, 3)))
        return f"<section>{inside}</section>" if rng.random() < 0.5 else f"<div>{inside}</div>"

    for _ in range(30):
        page = f"<body>{grow(0)}{grow(0)}</body>"
        root = ET.fromstring(page)
        parents = {child: e for e in root.iter() for child in e}
        points = {e: 0.0 for e in root.iter()}
        for p in root.iter("p"):
            pieces = [t.strip() for t in p.itertext()]
            size = sum(map(len, pieces))
            given, share, up = min(size / 100, 3) + sum(t.count(",") for t in pieces) + (size >= 25), 1.0, parents[p]
            while up is not None:
                points[up] += given * share
                share, up = share / (2 if share == 1 else 3), parents.get(up)
        tree = _Tree(page)
        got = scores(tree, tree.outside())
        order = [e for e in root.iter()]
        for k, e in enumerate(order, 1):
            total = sum(len(t.strip()) for t in e.itertext())
            linked = sum(len(t.strip()) for a in e.iter("a") for t in a.itertext())
            expected = points[e] * (1 - linked / total) if e.tag not in ("p", "a") else 0
            assert got[k] == pytest.approx(expected)
