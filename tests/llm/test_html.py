"""The main text of pages: chosen by path scores, against a slow version written apart, on labelled pages without telling names, and in linear time."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest

from corpuskit.llm import html_text
from tests.llm.test_brute_force import VOCABULARY

DATA = Path("/root/testdata/sf0.001")


def sentence(rng, low=6, high=16):
    words = [rng.choice(VOCABULARY) for _ in range(rng.randint(low, high))]
    for k in range(3, len(words) - 1, 6):
        words[k] += ","
    return " ".join(words).capitalize() + "."


def labelled(rng, named=False):
    """(page, its article). Without ``named`` all boxes are <div> without class or id."""
    box = lambda name, inside: f'<div class="{name}">{inside}</div>' if named else f"<div>{inside}</div>"
    want, inside = [], ""

    def add(tag, text, inner=None):
        nonlocal inside
        want.append(text)
        inside += f"<{tag}>{inner or text}</{tag}>"

    add("h1", sentence(rng, 4, 8)[:-1])
    for _ in range(rng.randint(3, 9)):
        kind = rng.random()
        if kind < 0.12:
            add("h2", sentence(rng, 2, 5)[:-1])
        if kind > 0.9:
            inside += "<ul>"
            for _ in range(3):
                add("li", sentence(rng, 3, 7))
            inside += "</ul>"
        if 0.8 < kind < 0.87:
            inside += "<blockquote>"
            add("p", " ".join(sentence(rng) for _ in range(2)))
            inside += "</blockquote>"
        text = " ".join(sentence(rng) for _ in range(rng.randint(3, 7)))
        first, rest = text.split(" ", 1)
        add("p", text, f"<a href=/x>{first}</a> {rest}" if rng.random() < 0.3 else None)
    menu = "<ul>" + "".join(f"<li><a href=/{k}>{rng.choice(VOCABULARY)}</a></li>" for k in range(rng.randint(4, 9))) + "</ul>"
    teasers = "".join(f"<p><a href=/t{k}>{sentence(rng, 3, 6)}</a></p>" for k in range(rng.randint(2, 5)))
    comments = "".join(box("comment", f"<b>{rng.choice(VOCABULARY)}</b><p>{sentence(rng, 4, 9)}</p>") for _ in range(rng.randint(0, 3)))
    page = box("nav", menu) + box("notice", sentence(rng, 4, 8))
    main = box("main", inside) + box("sidebar", "<h3>More</h3>" + teasers)
    page += box("wrapper", main + box("comments", comments)) + box("footer", f"<p>&copy; {sentence(rng, 3, 6)}</p>" + menu)
    return f"<!doctype html><html><head><title>T</title></head><body>{page}<script>var x='<p>no</p>'</script></body></html>", want


def words_f1(got, want):
    a, b = Counter(got.split()), Counter(want.split())
    common = sum((a & b).values())
    return 2 * common / max(1, sum(a.values()) + sum(b.values()))


@pytest.mark.parametrize("named", [False, True])
def test_labelled_pages(named):
    rng = random.Random(17)
    scores = []
    for _ in range(150):
        page, want = labelled(rng, named)
        scores.append(words_f1(html_text.main_text(page), " ".join(want)))
    assert sum(scores) / len(scores) >= 0.95 and sorted(scores)[len(scores) // 20] >= 0.8


def test_scores_choose_the_text(monkeypatch):
    rng = random.Random(18)
    pages = [labelled(rng, k % 2 == 0)[0] for k in range(40)]
    if DATA.exists():
        import pandas as pd

        pages += pd.read_parquet(DATA / "pages.parquet").html.tolist()
    kept = [html_text.main_text(p) for p in pages]
    score = html_text.path_scores
    for other in (lambda n, b: [1.0] * len(n.leaf), lambda n, b: [1 / (x + 1e-3) for x in score(n, b)], lambda n, b: score(n, b)[::-1]):
        monkeypatch.setattr(html_text, "path_scores", other)
        assert sum(html_text.main_text(p) != k for p, k in zip(pages, kept)) > 0.8 * len(pages)
    monkeypatch.setattr(html_text, "path_scores", score)
    plain = [re.sub(r"<(/?)article>", r"<\1div>", p) for p in pages]
    assert [html_text.main_text(p) for p in plain] == kept


def slow_scores(elements, blocks):
    """Score of each block, every sum made anew from the blocks."""

    def chain(e):
        out = []
        while e.parent:
            out.append(e)
            e = e.parent
        return out[::-1]

    def within(e):
        return [b for b in blocks if e in chain(b.element)]

    def free(some):
        return sum(len(b.text) - b.linked for b in some)

    def feature(e):
        f = 1.0
        for x in chain(e):
            if x.mark and not (0 < free(within(x)) >= x.mark * free(blocks)):
                f *= x.factor
        return f

    def own_feature(e):
        return feature(e.parent.parent) if e.tag in html_text.HEADINGS and e.parent.tag == "header" and feature(e) < 1 else feature(e)

    def steps(e):
        """The containers' names from the root on, and the rest of the path."""
        boxes, rest = [], ""
        for x in chain(e):
            if x.tag in html_text.CONTAINERS and x.holds:
                name = rest + "/" + x.label
                if x.tag in html_text.NAMELESS and not x.named:
                    like = [y for y in elements if y.parent is x.parent and y.tag in html_text.NAMELESS and not y.named and y.holds]
                    name += f"[{1 + like.index(x)}]"
                boxes, rest = [*boxes, name], ""
            elif x.tag in html_text.BLOCK:
                rest += "/" + x.label
        return tuple(boxes), rest

    where = [steps(b.element) for b in blocks]
    paths = [(*w, own_feature(b.element)) for w, b in zip(where, blocks)]
    leaf = ["" if b.element.holds else b.element.tag for b in blocks]
    alone = [x in html_text.CONTAINERS for x in leaf]
    of = lambda p: [b for b, q in zip(blocks, paths) if q == p]

    def neighbours(boxes):
        """Text of each thing that lies straight within a container."""
        out = {"running": free([b for b, (x, _), a in zip(blocks, where, alone) if x == boxes and not a])}
        for b, (x, _), a, p in zip(blocks, where, alone, paths):
            if x == boxes and a:
                out[p] = free(of(p))
            elif x[: len(boxes)] == boxes and len(x) > len(boxes):
                inner = x[: len(boxes) + 1]
                out[inner] = free([c for c, (y, _) in zip(blocks, where) if y[: len(inner)] == inner])
        return out

    def part(boxes, what):
        near = neighbours(boxes)
        return math.sqrt(near[what] / (max(near.values()) or 1))

    def level(boxes):
        return min([1.0, *[part(boxes[:k], boxes[: k + 1]) for k in range(len(boxes))]])

    def own(k):
        some = of(paths[k])
        punctuation = sum(len(re.findall(r"[.,;:!?…¡¿。，！？、]", b.text)) for b in some) / len(some)
        share = min(level(where[k][0]), part(where[k][0], paths[k] if alone[k] else "running"))
        return share * math.log(1 + free(some) / len(some)) * (0.3 + math.log(1 + punctuation))

    values = [own(k) for k in range(len(blocks))]

    def smoothed(k):
        near = [(0.7, k)] + [(0.15, j) for j in (k - 1, k + 1) if 0 <= j < len(blocks)]
        return sum(w * values[j] for w, j in near) / sum(w for w, _ in near)

    def judged(k):
        same = [j for j in range(len(blocks)) if paths[j] == paths[k]]
        return paths[k][2] * sum(smoothed(j) for j in same) / len(same)

    out = []
    for k in range(len(blocks)):
        base = best = judged(k)
        boxes, f = where[k][0], paths[k][2]
        page = all(re.fullmatch(r"/(html|body)[^/]*", x) for x in boxes)
        if not alone[k] or (not page and level(boxes) > 0.99):
            best = max([best, *[f * judged(j) for j in range(len(blocks)) if where[j][0] == boxes]])
        if leaf[k] in html_text.HEADINGS:
            for j in (j for j in range(len(blocks)) if paths[j] == paths[k]):
                after = next((i for i in range(j + 1, len(blocks)) if leaf[i] not in html_text.HEADINGS), None)
                if after is not None:
                    best = max(best, f * judged(after))
        some = of(paths[k])
        out.append(min(1.0, 1.6 * free(some) / sum(len(b.text) for b in some)) * (base + best) / 2)
    return out


def test_scores_agree_with_a_slow_version():
    rng = random.Random(19)
    pages = [labelled(rng, k % 2 == 0)[0] for k in range(12)]
    tags = ["<div>", "</div>", "<p>", "</p>", "<div class='ad x'>", "<section>", "</section>", "<nav>", "</nav>", "<h1>", "<h2>", "</h2>", "<ul><li>", "</ul>", "<a href=1>", "</a>", "<header>", "</header>", "<article>", "</article>", "<td>", "<table>", "</table>", "<span hidden>", "</span>"]
    for _ in range(60):
        pages.append("".join(rng.choice([rng.choice(tags), sentence(rng, 1, 9)]) for _ in range(rng.randint(1, 40))))
    for page in pages:
        elements, blocks = html_text.blocks_of(page)
        if not blocks:
            assert html_text.main_text(page) == ""
            continue
        nodes = html_text.nodes_of(elements, blocks)
        scores = html_text.path_scores(nodes, blocks)
        assert [scores[p] for p in nodes.path] == pytest.approx(slow_scores(elements, blocks)), page


def test_odd_markup():
    tail = "<p>A second sentence, which is longer than the first, and ends here.</p>"
    said = "A second sentence, which is longer than the first, and ends here."
    for mark, text in (("</3", ""), ("</>", ""), ("</ div>", ""), ("<!bogus>", ""), ("<?php x?>", ""), ("<![CDATA[no]]>", ""), ("<!---->", ""), ("<!-->", ""), ("<!-- x --!>", ""), ("<3", "<3"), ("a < b", "a < b"), ("&lt;p&gt;", "<p>")):
        close = ">" if mark in ("</3",) else ""
        page = f"<article><p>I {mark}{close} you, and that is so, as was said.</p>{tail}</article>"
        assert html_text.main_text(page) == " ".join(f"I {text} you, and that is so, as was said.".split()) + "\n\n" + said, mark
    quoted = f"<article><p title=it's data-x=\"a > b\">It's said, and it's so, one way or another.</p>{tail}</article>"
    assert html_text.main_text(quoted) == "It's said, and it's so, one way or another.\n\n" + said
    deep = "<div>" * 3000 + "<div class=sidebar><p>Aside, and of no use.</p></div>" + tail * 3 + "</div>" * 3000
    assert html_text.main_text(deep) == "\n\n".join([said] * 3)


def test_time_is_linear():
    def took(page):
        at = time.process_time()
        html_text.main_text(page)
        return time.process_time() - at

    makers = (
        lambda n: "<body><article>" + "".join(f"<p>Text {k}, with <a href=/x>a link</a>.</p>" for k in range(n)) + "</article>",
        lambda n: "<article>" + "".join(f"<p><a href=/{k}>link {k}</a></p>" for k in range(n)) + "</article>",
        lambda n: "<div>" * n + "<p>One, two.</p>" + "</div>" * n,
        lambda n: "<b>" * n + "<p>One, two.</p>" + "</i>" * n,
        lambda n: "<ul>" + "<li>item" * n,
        lambda n: "<p title='" * n,
    )
    for make in makers:
        took(make(2000))
        assert took(make(40000)) < 40 * max(took(make(4000)), 0.02)
