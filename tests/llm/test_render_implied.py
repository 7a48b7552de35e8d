"""Pages that leave out tags, and text in svg and math."""

import pytest

from corpweave.llm.render import render


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>T</title><p>Hello", "Hello"),
        ("<html><head><meta charset=x><title>T</title>Hello <b>you</b>", "Hello you"),
        ("<head><title>T</title><style>p {}</style>\n<link rel=x><div>a</div><p>b", "a\n\nb"),
        ("<head><title>T</title></head><body><p>a", "a"),
        ("a <svg/> b <math/> c", "a b c"),
        ("<p>a<svg width=1 />b</p>c", "ab\n\nc"),
        ("<svg><title>no</title><text>seen</text><path d='x'/></svg> after", "seen after"),
        ("<svg><style>no</style><defs><text>no</text></defs><text>x</text></svg>y", "xy"),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> so", "x=2 so"),
        ("<svg><text>a<p>b", "a\n\nb"),
    ],
)
def test_visible_text(html, text):
    assert render(html) == text
