"""Markup that goes wrong: no text is lost behind it, and time grows with the page."""

import time

import pytest

from tagloom.llm import html_text


def blocks(source):
    """Text of the blocks of a page, in order."""
    out, held = [], []
    for node, chunk in [*html_text.parse(source)[1], (-1, "")]:
        if node >= 0:
            held.append(chunk)
        elif "".join(held).strip():
            out.append(" ".join("".join(held).split()))
            held = []
    return out


@pytest.mark.parametrize(("source", "want"), [
    ("<p>a</p><svg/><p>b</p>", ["a", "b"]),
    ("<p>a</p><svg><title>x</title></svg><p>b</p>", ["a", "b"]),
    ("<p>a</p><noscript><p>b</p>", ["a", "b"]),
    ("<p>a</p><noscript><p>no</p></noscript><p>b</p>", ["a", "b"]),
    ("<p>a<select><option>x<p>b", ["ax", "b"]),
    ("<p>a</p><template/><p>b</p>", ["a", "b"]),
    ("<p>a</p><script>if (1 < 2) '<p>no</p>'</script><p>b</p>", ["a", "b"]),
    ("<p>a</p><script>never ends <p>no</p>", ["a"]),
    ("<p>a</p><!-- <p>no</p> --><p>b</p><!-- never ends <p>no", ["a", "b"]),
    ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"]),
    ('<p title="a > b">c</p>', ["c"]),
    ('<p title="never ends>a</p><p>b</p>', ["a", "b"]),
    ("<p>a</i></b></div></p><p>b", ["a", "b"]),
    ("<b><div>a</b> b</div>c", ["a b", "c"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("text <", ["text <"]),
    ("text <p", ["text"]),
    ("", []),
])
def test_blocks(source, want):
    assert blocks(source) == want


@pytest.mark.parametrize("source", [
    '<a "' * 250_000, "<p>x" * 60_000 + "<i>" * 100_000 + "</b>" * 100_000, "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000,
    "<i>" * 100_000 + "<hr>" * 100_000, "<div>" * 80_000 + "<dt></dt>" * 80_000, "<svg>" * 200_000 + "x", "<select>x" * 100_000,
    '<a href="' * 100_000 + ">" * 100_000, "<" * 1_000_000, "<!--" * 250_000, "<a b='" * 150_000 + ">", "<noscript><p>x" * 70_000,
])
def test_a_megabyte_takes_seconds(source):
    began = time.process_time()
    nodes, pieces = html_text.parse(source)
    html_text.measure(nodes[:1], []) if len(nodes) > 20_000 else html_text.measure(nodes, pieces)
    assert time.process_time() - began < 20


def test_siblings_are_counted_beyond_fifty():
    """The last of 200 paragraphs stands at the end of the page, and all 200 are alike."""
    page = "<div>" + "".join(f"<p>{'word ' * 10}</p>" for _ in range(200)) + "</div>"
    nodes, pieces = html_text.parse(page)
    x = html_text.measure(nodes, pieces)
    rest = 2 * (len(html_text.TAG_GROUPS) + len(html_text.ATTRIBUTE_GROUPS))
    alike, place = x[2:, rest + 11], x[2:, rest + 12]
    assert (alike == 200).all() and place[0] == 0 and place[-1] == pytest.approx(199 / 200)
