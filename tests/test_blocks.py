"""Nested blocks against a stack machine that reads the page's tokens one by one."""

from __future__ import annotations

import random
import re

import pytest

from clausemill.operators.blocks import HIDDEN, TOKEN, html_blocks, page_blocks

BOX, PLAIN = ("div", "blockquote", "table"), ("p", "h1", "h2", "h3", "h4", "h5", "h6")


def brute(html):
    """(start, tag, depth, parent, in_table, text) of a page, by the rules of ``block_intervals``."""
    if html is None:
        return []
    html = re.sub(HIDDEN, "", html)
    tokens = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(TOKEN, html)]
    tags = [(re.match(r"</?(\w+)", t).group(1), not t.startswith("</")) for _, _, t in tokens]
    after = [html[b : tokens[i + 1][0] if i + 1 < len(tokens) else len(html)] for i, (_, b, _) in enumerate(tokens)]
    n, found = len(tokens), []
    for i, (tag, opens) in enumerate(tags):
        if not opens or tag in ("ul", "ol"):
            continue
        end, depth = n, 0
        for j in range(i + 1, n):
            other, up = tags[j]
            if tag in PLAIN:
                end = j
                break
            if tag == "li":
                if depth == 0 and (other == "li" or (other in ("ul", "ol") and not up)):
                    end = j
                    break
                depth += (1 if up else -1) if other in ("ul", "ol") else 0
            elif other == tag:
                depth += 1 if up else -1
                if depth < 0:
                    end = j
                    break
        found.append((i, end, tag))
    out = []
    for start, end, tag in found:
        around = [(s, t) for s, e, t in found if s < start < e]
        text = re.sub(r"[ \t\n\r\f\x0b]+", " ", re.sub("<[^>]+>", " ", " ".join(after[start:end]))).strip(" ")
        out.append((start, tag, len(around), max((s for s, _ in around), default=None), any(t == "table" for _, t in around), text))
    return out


def pages():
    r = random.Random(3)
    bits = ["<p>", "</p>", "<div class='x'>", "</div>", "<DIV>", "<li>", "</li>", "<ul>", "</ul>", "<ol>", "</ol>", "<blockquote>", "</blockquote>", "<table>", "</table>", "<tr><td>", "<h2>", "</h2>", "<b>", "</b>", " some ", "text", "\n", "<!-- <p> -->", "<script>var a = '<div>';</script>", "<pre>", "<link>"]
    out = [None, "", "no tags", "<p>a<p>b", "<div>a<div>b</div>c</div>d", "</div><div>x</div>", "<ul><li>a<li>b<ul><li>c</ul></ul>", "<table><tr><td><p>in</p></td></tr></table><p>out</p>"]
    return [*out, *("".join(r.choice(bits) for _ in range(r.randint(1, 40))) for _ in range(120))]


@pytest.fixture(scope="module")
def found(spark):
    return html_blocks(spark.createDataFrame(list(enumerate(pages())), "doc_id long, html string")).cache()


def test_blocks_equal_the_stack_machine(found):
    got = sorted(tuple(x) for x in found.collect())
    assert got == sorted((i, *b) for i, html in enumerate(pages()) for b in brute(html))


def test_page_blocks_are_outside_tables(found):
    want = [(i, k, s, t, x) for i, html in enumerate(pages()) for k, (s, t, x) in enumerate(((s, t, x) for s, t, _, _, inside, x in brute(html) if t != "table" and not inside and x), 1)]
    assert sorted(tuple(x) for x in page_blocks(found).collect()) == want
