"""Text that a browser shows and an extraction may lose."""

import pytest

from rankforge.llm import html

CASES = [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='t'>no</annotation></math> b", "a x=2 b"),
    ("a <svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text>label</text></svg> b", "a label b"),
    ("<div>a <svg/> b <math /> c</div>", "a b c"),
    ("<svg><path d='M0'/><g><text>in</text></g></svg> out", "in out"),
    ("<svg><style>no</style><script>no</script><text>in</text></svg>", "in"),
    ("<svg><title/><text>in</text></svg>", "in"),
    ("<head><title>t</title>text", "text"),
    ("<html><head><title>t</title> <meta x>\n text <b>more</b></head>", "text more"),
    ("<title>t</title>text", "text"),
    ("<head><style>x</style></head> y", "y"),
    ("a<div style='visibility:hidden'>no<p style='visibility: visible'>yes</p>no</div>b", "a\n\nyes\n\nb"),
    ("<div style='display:none'><p style='visibility:visible'>no</p></div>b", "b"),
    ("<div style='visibility:hidden'><img alt=no><input value=no>no</div>b", "b"),
]


@pytest.mark.parametrize("source, text", CASES)
def test_visible(source, text):
    assert html.render(source) == text


SPANS = [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tr><td>a<td rowspan=0>b<tr><td>c<tr><td>d</table>", "a | b\nc |\nd |"),
    ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c</table>", "a   | b\n |  | c"),
]


@pytest.mark.parametrize("source, text", SPANS)
def test_row_spans(source, text):
    assert html.render(source) == text
