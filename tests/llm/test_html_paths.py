"""Main text by tag-path ratios: what decides inside and outside articles, odd pages, and scores against the plain definition."""

import random
import time

import pytest

from telescry.llm import html

_ONE = "It rained all day in the hills, and the river rose by a metre before the evening came."


@pytest.mark.parametrize("sentences", [1, 2, 3, 6, 20, 200])
def test_long_paragraphs_delete_no_others(sentences):
    long = " ".join([_ONE] * sentences)
    page = f"<body><article><p>{long}</p><div><p>{_ONE} Then it stopped.</p></div><section><h2>After</h2><div><p>The river fell.</p></div></section></article></body>"
    for tag in ("article", "main"):
        assert html.main_text(page.replace("article>", f"{tag}>")) == f"{long}\n{_ONE} Then it stopped.\nAfter\nThe river fell."


def test_names_with_other_words_are_judged_by_score():
    for attributes in ("class=search-results-article", "class='no-sidebar has-comments'", "id=related-work", "class='col restaurant-menu'"):
        assert html.main_text(f"<body><div {attributes}><h1>Head</h1><p>{_ONE}</p><p>{_ONE}</p></div></body>") == f"Head\n{_ONE}\n{_ONE}"
    story = f"<p>{_ONE}</p>" * 3
    related = "<section id=related-work><h2>Related</h2><p>{}</p></section>"
    assert html.main_text(f"<article>{story}{related.format(_ONE)}</article>") == "\n".join([_ONE] * 3 + ["Related", _ONE])
    assert html.main_text(f"<article>{story}{related.format('<a href=x>Floods of 1953</a>')}</article>") == "\n".join([_ONE] * 3)
    assert html.main_text(f"<article>{story}<h2 id=comments-on-method>Method</h2><p>Yes.</p></article>") == "\n".join([_ONE] * 3 + ["Method", "Yes."])


@pytest.mark.parametrize("attributes", ["class=post-comments", "id=comments", "class='box ad-banner'", "class=siteFooter", "class=related-posts", "role=search", "id=cookie-notice", "hidden", "class=share-buttons", "style='display: none'"])
def test_names_that_say_nothing_else_are_left_out(attributes):
    story = f"<h1>Head</h1><p>{_ONE}</p><p>Short.</p>"
    for tag in ("article", "div"):
        for other in ("div", "section", "article"):
            assert html.main_text(f"<body><{tag}>{story}<{other} {attributes}><p>{_ONE} {_ONE}</p></{other}></{tag}></body>") == f"Head\n{_ONE}\nShort."


def test_scores_tell_the_story_from_its_surroundings():
    story = f"<p>{_ONE}</p><ul><li>first</li><li><a href=x>second</a></li></ul><p>{_ONE}</p>"
    wanted = f"{_ONE}\nfirst\nsecond\n{_ONE}"
    for noise in ("<div class=q1><span>Only today</span></div>", "<div><div>See it now</div></div>", "<div><a href=a>One</a> <a href=b>Two</a></div>", "<table><tr><td><a href=a>A</a></td><td><a href=b>B</a></td><td><a href=c>C</a></td></tr></table>"):
        assert html.main_text(f"<body>{noise}<div>{story}</div></body>") == wanted
        assert html.main_text(f"<body>{noise}<article>{story}</article>{noise}</body>") == wanted
    assert html.main_text(f"<body><div><p>{_ONE}</p></div><article><p>{_ONE}</p><p>Last.</p></article></body>") == f"{_ONE}\nLast."
    cards = "".join(f"<article><a href={k}>Teaser {k}</a></article>" for k in range(5))
    assert html.main_text(f"<body><div><p>{_ONE}</p></div>{cards}</body>") == _ONE


def test_deep_and_varied_pages_take_linear_time():
    pages = ["".join(f"<div>text {k}, here it is." for k in range(5000)), "".join(f"<x{k}>text {k}, here it is.</x{k}>" for k in range(5000)),
             "".join(f"<div><h2>Head {k}</h2><p>text {k}, here it is.</p>" for k in range(5000)), "<div>" * 5000 + "</i></x>" * 5000 + "deep, text."]
    for page in pages:
        html.main_text(page[:2000])
        start = time.perf_counter()
        text = html.main_text(page)
        assert time.perf_counter() - start < 3
        assert text.count("\n") == {0: 4999, 1: 4999, 2: 9999, 3: 0}[pages.index(page)]


def _plain_scores(found, elements):
    """The definition, over all pairs of paths."""
    def tags(i):
        return tags(elements[i].up) + ((elements[i].tag, elements[i].doubted),) if i else ()

    def is_near(p, q):
        return (abs(len(p) - len(q)) == 1 and min(p, q, key=len) == max(p, q, key=len)[:-1]) or (len(p) == len(q) and p and p[:-1] == q[:-1])

    groups = {}
    for b in found:
        groups.setdefault(tags(b.at), []).append(b)
    ratio = {}
    for p, bs in groups.items():
        chars = sum(len(b.text) - b.link for b in bs) / len(bs)
        marks = sum(sum(c in ".,;:!?" for c in b.text) for b in bs if b.link < len(b.text)) / len(bs)
        ratio[p] = chars / (chars + 40) * (0.5 + marks) / (1 + marks)
    scores = {}
    for p, r in ratio.items():
        others = [ratio[q] for q in ratio if q != p and is_near(p, q)]
        smooth = (r + 0.6 * sum(others)) / (1 + 0.6 * len(others))
        scores[p] = r**0.75 * smooth**0.25 * (2 if any(t in ("article", "main") for t, _ in p) else 1) * (0.7 if any(d for _, d in p) else 1)
    return {b.at: scores[tags(b.at)] for b in found}


@pytest.mark.parametrize("seed", range(20))
def test_scores_equal_the_plain_definition(seed):
    rng = random.Random(seed)

    def page(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            tag = rng.choice(["div", "section", "p", "article", "div class=related-work", "ul"])
            text = " ".join(rng.choice(["rain", "hills, and", "it fell.", "why?"]) for _ in range(rng.randint(1, 12)))
            out.append(f"<{tag}>{text}{page(depth - 1) if depth and rng.random() < 0.7 else ''}</{tag.split()[0]}>")
        return "".join(out)

    found, elements, above = html.blocks(html.parse(page(4)))
    scores, plain = html.path_scores(found, elements, above), _plain_scores(found, elements)
    for b in found:
        assert scores[elements[b.at].path] == pytest.approx(plain[b.at])
