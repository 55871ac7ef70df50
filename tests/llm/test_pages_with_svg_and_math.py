"""Pages whose articles hold svg and MathML."""

from __future__ import annotations

import pytest

from stayscope.llm import pages


@pytest.mark.parametrize(
    "inside, want",
    [
        ('<svg class="i"/>', "a b c"),
        ("<svg><path d='M0'/></svg>", "a b c"),
        ("<svg><svg><text>no</text></svg><text>no</text></svg>", "a b c"),
        ("<svg><style/><title/><text>no</text></svg>", "a b c"),
        ("<svg><path d='M0'>", "a c"),
        ("<svg><foreignObject><div>no</div></foreignObject></svg>", "a b c"),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "a x=2 b c"),
        ("<math/>", "a b c"),
    ],
)
def test_only_the_svg_itself_is_left_out(inside, want):
    found = pages.parse(f"<article><p>a {inside} b</p><p>c</p></article>")
    assert pages.joined(found, [True] * len(found.nodes)) == want


def test_digits_of_a_long_run_count_whole():
    runs = {}
    for text in ("7" * 2000, "x" * 2000, "x" * 1000 + "7" * 1000, "é" + "x" * 999 + "7" * 1000):
        found = pages.parse(f"<p>{text}</p>")
        runs[text] = pages.features(found)[-1, 4]
    assert list(runs.values()) == [1.0, 0.0, 0.5, 0.5]
