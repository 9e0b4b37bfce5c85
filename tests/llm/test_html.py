import html as entities
import random
import re
from pathlib import Path

import pytest

from streamfuse.llm import html

SCHEMA = "page_id long, url string, html string"


def sentence(draw, n=12):
    return " ".join(draw.choice(["alpha", "béta", "gamma", "x &lt; y", "R&amp;D", "tea"]) for _ in range(n)) + "."


def plain_text(markup):
    """Text of the article's own markup, all tags being block boundaries but b, em and a."""
    inline = re.sub(r"</?(b|em|a)\b[^>]*>", "", markup)
    return " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inline)).split())


def article_of(draw):
    parts = [f"<h1>{sentence(draw, 5)}</h1>"]
    for _ in range(draw.randrange(1, 6)):
        kind = draw.randrange(5)
        if kind == 0:
            parts.append("<ul>" + "".join(f"<li>{sentence(draw, 4)}" for _ in range(3)) + "</ul>")
        elif kind == 1:
            parts.append(f"<h2>{sentence(draw, 3)}</h2>\n<p>{sentence(draw)}</p>")
        elif kind == 2:
            parts.append(f"<blockquote><p>{sentence(draw)}</p></blockquote>")
        elif kind == 3:
            parts.append(f"<p>{sentence(draw)} <a href='/x'>{sentence(draw, 2)}</a><br>so<b>me</b>")
        else:
            parts.append(f"<p>{sentence(draw)}\n   {sentence(draw)}")
    return "\n".join(parts)


def links(draw, n=4):
    return "".join(f"<li><a href='/{i}'>{sentence(draw, 2)}</a></li>" for i in range(n))


def semantic(draw, body):
    comments = "".join(f"<article class=comment><p>{sentence(draw)}</p></article>" for _ in range(3))
    return (
        f"<!DOCTYPE html><html><head><title>t</title><script>var x='</article><p>no</p>';</script></head><body class='page menu'>"
        f"<header><p>Site</p></header><nav><ul>{links(draw)}</ul></nav><div class='cookie-notice'>We use cookies</div>"
        f"<main><article>{body}<aside>{sentence(draw)}</aside><form><p>Your name</p><input></form></article>"
        f"<section id=comments><h2>3 Comments</h2>{comments}</section></main><footer>&copy; {sentence(draw)}</footer></body></html>"
    )


def classes(draw, body):
    """No article or main: the text is where most of the host's text is."""
    return (
        f"<html><body><div id='Header'>Name of site</div><div class='navBar'><ul>{links(draw)}</ul></div><!-- <p>no</p> -->"
        f"<div class=wrap><div class='content-{draw.randrange(999)}'>{body}</div><div class=sidebar><p>{sentence(draw)}</p></div>"
        f"<div><ul>{links(draw, 6)}</ul></div><p>Printed on recycled paper</p></div><div class='ad-slot'>{sentence(draw)}</div>"
        f"<style>p {{}}</style><div class=footer>end"
    )


def broken(draw, body):
    return f"<html><body><nav><ul>{links(draw)}<article>{body}</article><footer>x</footer><!-- open {body}"


TEMPLATES = {"https://semantic.example/a": semantic, "http://classes.example:80/b": classes, "https://BROKEN.example": broken}


def pages(seed, n):
    draw = random.Random(seed)
    rows, want = [], {}
    for i in range(n):
        for k, (url, template) in enumerate(TEMPLATES.items()):
            body = article_of(draw)
            rows.append((10 * i + k, f"{url}?{i}" if k else f"{url}/{i}", template(draw, body)))
            want[10 * i + k] = plain_text(body)
    draw.shuffle(rows)
    return rows, want


def test_articles_of_three_templates(spark):
    rows, want = pages(1, 40)
    got = {r.page_id: (r.text, r.n_chars) for r in html.page_texts(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def whole_wrapper(rows, parts):
    made = []
    for k in range(parts):
        made.append(html.Item("html"))
        for i, (_, _, data) in enumerate(rows[k::parts]):
            made[-1].take(html.parse(data), i)
    first = made[0]
    for other in made[1:]:
        first.merge(html.Item.unpacked(other.packed()))
    return first


def test_rules_depend_neither_on_order_nor_on_parts():
    rows, _ = pages(2, 30)
    for url in TEMPLATES:
        own = [r for r in rows if r[1].startswith(url)]
        found = {html.rules_of(whole_wrapper(own, p)).packed() for p in (1, 3, 7)}
        random.Random(5).shuffle(own)
        found |= {html.rules_of(whole_wrapper(own, p)).packed() for p in (1, 4)}
        assert len(found) == 1


def test_a_wrapper_is_an_expression():
    texts = ["<ul><li>a</li><li>b</li></ul><p>same</p>", "<ul><li>c</li></ul><table><tr><td>x</td></tr></table><p>same</p>"]
    wrapper = html.Item("html")
    for i, data in enumerate(texts):
        wrapper.take(html.parse(data), i)
    assert wrapper.pattern() == "<html><ul>(<li>#</>)+</>(<table><tr><td>fixed</></></>)?<p>fixed</></>"
    pairs = html.Item("html")
    pairs.take(html.parse("<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>"), 0)
    assert pairs.pattern() == "<html><dl>(<dt>#</><dd>#</>)+</></>"


def test_wrappers_stay_small_however_odd_the_classes_are():
    wrapper = html.Item("html")
    draw = random.Random(3)
    for i in range(300):
        names = "".join(draw.choice("abcdefgh") for _ in range(12))
        wrapper.take(html.parse(f"<div class={names}><p class={names[::-1]}>text {i}</p></div>"), i)
    assert wrapper.size() < 100


@pytest.mark.parametrize("heading", ["Comments", "12 comments", "Reader comments:", "Kommentare (3)", "Commentaires", "Leave a reply"])
def test_sections_of_comments_are_known_by_their_heading(heading):
    page = f"<main><p>Text.</p><div><h3>{heading}</h3><p>first!</p></div><div><h3>Comments on law</h3><p>More.</p></div></main>"
    assert html.main_text(html.parse(page), html.Rules()) == "Text. Comments on law More."


def test_awkward_pages(spark):
    deep = "<div>" * 5_000 + "deep" + "</div>" * 5_000
    rows = [
        (1, None, None), (2, None, ""), (None, "https://a.example/", "<p>no number"), (3, "no url", "plain text &am &amp; more"),
        (4, "https://a.example/", "<p>one</p><p>two"), (4, "https://a.example/", "<p>one</p><p>two"), (5, "https://a.example/", "<p"),
        (6, "https://b.example/", deep), (7, "https://c.example/", "<article>" + "<p>long</p>" * 50_000 + "</article>"),
        (8, "https://d.example/", "<script>never closed <p>x</p>"), (9, "https://d.example/", "a < b <b>bo</b>ld &nbsp; c\t\nd"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("text", "rules", "_host", "host", "c0", "wrapper", "part"):
        frame = frame.withColumn(name, frame["url"])
    out = html.extract(frame)
    assert sorted(out.columns) == sorted(frame.columns)
    got = sorted(((r.page_id, r.text) for r in out.collect()), key=str)
    assert got == sorted(
        [(1, ""), (2, ""), (None, "no number"), (3, "plain text &am & more"), (4, "one two"), (4, "one two"), (5, ""), (6, "deep"),
         (7, " ".join(["long"] * 50_000)), (8, ""), (9, "a < b bold c d")], key=str,
    )
    assert html.page_texts(frame.limit(0)).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="test tables are not here")
def test_given_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in table.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.DOTALL)[1]
        want[r.page_id] = plain_text(body)
    assert {r.page_id: r.text for r in html.page_texts(table).collect()} == want
