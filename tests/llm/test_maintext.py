"""Tag-path ratios: held against a version of their own on html.parser, and on pages without telling names."""

from __future__ import annotations

import random
import re
from fractions import Fraction
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, strategies as st

from motionweave.llm import maintext

WORDS = "river stone light over under carries slowly morning window between".split()


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(words)).capitalize() + "."


def neutral_page(seed: int) -> tuple[str, str]:
    """(page, article) of divisions whose classes say nothing."""
    rng = random.Random(seed)
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(WORDS, 5))
    title = sentence(rng, 5)
    paras = [" ".join(sentence(rng, rng.randint(6, 14)) for _ in range(rng.randint(3, 6))) for _ in range(rng.randint(4, 8))]
    page = (f'<html><body><div class="k1"><ul>{menu}</ul></div><div class="k2"><div class="k3"><h1>{title}</h1>'
            + "".join(f"<p>{x}</p>" for x in paras)
            + f'</div></div><div class="k4">{sentence(rng, 6)}</div><div class="k5">&copy; {sentence(rng, 3)}</div></body></html>')
    return page, "\n\n".join([title, *paras])


@pytest.mark.parametrize("seed", range(25))
def test_pages_without_telling_names(seed):
    page, article = neutral_page(seed)
    assert maintext.main_text(page)[0] == article


def test_thresholds_decide(monkeypatch):
    page, article = neutral_page(3)
    short, middling = "See this. And that.", " ".join(sentence(random.Random(k), 12) for k in range(2))
    page = page.replace('<div class="k4">', f'<div class="k6"><h4>{short}</h4><p>{middling}</p></div><div class="k4">')
    assert maintext.main_text(page)[0] == article
    monkeypatch.setattr(maintext, "APART", 0.0)
    assert maintext.main_text(page)[0].startswith(article + "\n\n")
    assert middling in maintext.main_text(page)[0]
    monkeypatch.setattr(maintext, "SHARE", 0.0)
    assert sentence_count(maintext.main_text(page)[0]) > sentence_count(article) + 3


def sentence_count(text: str) -> int:
    return text.count(".")


def test_prose_in_a_second_division_stays():
    page, article = neutral_page(5)
    tail = " ".join(sentence(random.Random(k), 12) for k in range(6))
    page = page.replace('<div class="k4">', f'<div class="k2"><div class="k3"><p>{tail}</p></div></div><div class="k4">')
    assert maintext.main_text(page)[0] == article + "\n\n" + tail


class Paths(HTMLParser):
    """(path, parent element, text) of each text node of a page of closed block elements."""

    def __init__(self):
        super().__init__()
        self.stack, self.made, self.found = [("", 0)], 0, []

    def handle_starttag(self, tag, attrs):
        label = tag + "".join("." + v for k, v in attrs if k == "class")
        self.made += 1
        self.stack.append((self.stack[-1][0] + "/" + label, self.made))

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        text = " ".join(data.split())
        if text:
            self.found.append((self.stack[-1][0], self.stack[-2][1], text))


def plain_levels(page: str) -> dict[str, float]:
    reader = Paths()
    reader.feed(page)
    nodes = reader.found
    by_path: dict[str, list[str]] = {}
    for path, _, text in nodes:
        by_path.setdefault(path, []).append(text)

    def marks(text):
        return sum(c in ".,;:!?" and (k + 1 == len(text) or text[k + 1] == " ") for k, c in enumerate(text))

    size = {p: Fraction(sum(map(len, t)), len(t)) for p, t in by_path.items()}
    points = {p: (sum(map(marks, t)) + Fraction(1, 10)) / len(t) for p, t in by_path.items()}

    def smooth(ratio, i):
        near = [j if 0 <= j < len(nodes) and nodes[j][1] == nodes[i][1] else i for j in (i - 1, i + 1)]
        return ratio[nodes[i][0]] / 2 + sum(ratio[nodes[j][0]] for j in near) / 4

    fused: dict[str, Fraction] = {}
    for i, (path, _, _) in enumerate(nodes):
        fused[path] = max(fused.get(path, Fraction(0)), smooth(size, i) * smooth(points, i))
    top = max(fused.values())
    return {p: float(f / top) ** 0.5 for p, f in fused.items()}


TEXTS = st.lists(st.sampled_from([*WORDS, "stone.", "light,", "over;", "v1.2", "site.example.org"]), min_size=1, max_size=30).map(" ".join)
LEAF = st.tuples(st.sampled_from(["p", "h2", "blockquote", "pre"]), st.sampled_from(["", "a1", "b2"]), TEXTS)
TREE = st.recursive(LEAF, lambda kids: st.tuples(st.just("div"), st.sampled_from(["", "c3", "d4"]), st.lists(kids, min_size=1, max_size=4)), max_leaves=14)


def markup(node) -> str:
    tag, name, inside = node
    mark = f' class="{name}"' if name else ""
    return f"<{tag}{mark}>{inside if isinstance(inside, str) else ''.join(map(markup, inside))}</{tag}>"


@given(st.lists(TREE, min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_levels_against_fractions(trees):
    page = "<html><body>" + "".join(map(markup, trees)) + "</body></html>"
    blocks, texts = maintext._readable(maintext.blocks_of(page))
    got = {re.sub(r"^#?/?", "/", p): f for p, f in maintext.path_levels(blocks, texts).items()}
    want = plain_levels(page)
    assert got.keys() == want.keys()
    for p, f in want.items():
        assert got[p] == pytest.approx(f, rel=1e-9)


def test_long_and_empty_pages():
    assert maintext.main_text("") == ("", [])
    assert maintext.main_text("<div>" * 3 + "</div>" * 3) == ("", [])
    assert maintext.path_levels([], []) == {}
    body = "<p>" + "word, " * 200_000 + "</p>"
    assert len(maintext.main_text(f"<html><body>{body}</body></html>")[0]) == 6 * 200_000 - 1
    assert maintext.main_text("<p>same.</p><p>same.</p>")[0] == "same.\n\nsame."
