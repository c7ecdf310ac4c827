"""The site style tree against a plain version, and pages that only it can tell apart."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dwellgrid.llm import sitestyle

PAGES = "page_id long, url string, html string"
WORDS = [f"word{i}" for i in range(400)]


def said(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def made(host, n, seed, neutral=True):
    """Pages with menu, advert, main part and footer whose words differ from page to page, and the main text."""
    rng = random.Random(seed)
    names = ("a1", "b", "c", "d") if neutral else ("menu", "advert", "content", "footer")
    rows, texts = [], []
    for i in range(n):
        paragraphs = [said(rng, rng.randint(5, 40)) for _ in range(rng.randint(2, 9))]
        menu = "".join(f"<li><a href='/{rng.choice(WORDS)}'>{rng.choice(WORDS)}</a></li>" for _ in range(5))
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        html = (
            f"<html><body><div class={names[0]}><ul>{menu}</ul></div><div class={names[1]}>{said(rng, 6)}</div>"
            f"<div class={names[2]}><h2>{said(rng, 4)}</h2>{body}</div>"
            f"<div class={names[3]}>About us. {said(rng, 3)}</div></body></html>"
        )
        rows.append((i, f"http://{host}/{i}", html))
        texts.append("\n".join([html.split("<h2>")[1].split("</h2>")[0], *paragraphs]))
    return rows, texts


def tree_by_hand(rows):
    features, chars, noise = Counter(), Counter(), {}
    for host, html in rows:
        for path, up, loud, kind, f, n in sitestyle.Page(html).features():
            features[host, path, up, kind, f] += 1
            chars[host, path, up] += n
            noise[host, path, up] = loud
    nodes = defaultdict(lambda: ([], []))
    for (host, path, up, kind, _), n in features.items():
        nodes[host, path, up][kind].append(n)
    out = {}
    for k, (layouts, blocks) in nodes.items():
        m = sum(layouts)
        base = math.log(max(m, 2))
        presentation = -sum(n / m * math.log(n / m) for n in layouts) / base
        content = 1 - (sum(math.log(n) for n in blocks) / len(blocks) / base if blocks else 1)
        out[k] = m, presentation, content
    found = {}
    for (host, path, up), (m, a, b) in out.items():
        others = [
            (chars[k], sum(out[k][1:]) / 2, out[k][0])
            for k in out
            if up is not None and k[0] == host and k[2] == up and not noise[k]
        ]
        top = max(others, default=None)
        stands = top and top[2] * 2 >= m and top[0] >= 2 * chars[host, path, up]
        found[host, path] = m, a, b, top[1] if stands else None
    return found


def test_tree_equals_the_plain_version(spark):
    rows = [(u.split("/")[2], h) for x, s in (("one", 1), ("two", 2)) for _, u, h in made(x, 9, s, s == 1)[0]]
    rows += [("three", "<p>x</p>"), ("three", "<article><div>a</div><div class=b>c</div></article>"), ("three", "")]
    pages = spark.createDataFrame([*rows, ("three", None)], "host string, html string").repartition(3)
    pages = pages.withColumn("site", F.xxhash64("host"))
    hosts = {r["site"]: r["host"] for r in pages.select("site", "host").distinct().collect()}
    want = tree_by_hand(rows)
    found = {(hosts[r["site"]], r["path"]): r for r in sitestyle.style_tree(pages).collect()}
    assert set(found) == set(want)
    for k, (m, a, b, best) in want.items():
        r = found[k]
        assert r["pages"] == m and abs(r["presentation"] - a) < 1e-9 and abs(r["content"] - b) < 1e-9
        assert abs(r["importance"] - (a + b) / 2) < 1e-9
        assert (r["best"] is None) == (best is None) and abs((r["best"] or 0) - (best or 0)) < 1e-9


@pytest.mark.parametrize("neutral", [True, False])
def test_the_tree_alone_finds_the_text(spark, neutral):
    """No tag, role or class name says what a branch is: the menu, advert and footer go by their layout."""
    rows, texts = made("plain.example.com", 40, 7, neutral)
    pages = spark.createDataFrame(rows, PAGES)
    for most in (sitestyle.BROADCAST_NODES, 0):  # broadcast nodes, joined nodes
        found = sitestyle.extract(pages, most).collect()
        assert {r["page_id"]: r["text"] for r in found} == dict(enumerate(texts))
    few = sitestyle.extract(spark.createDataFrame(rows[:3], PAGES)).collect()
    assert all((r["text"] == texts[r["page_id"]]) == (not neutral) for r in few)


def test_parts_of_an_article_are_no_rivals(spark):
    """A short part with one layout beside a long one that varies stays, for both are the article."""
    rng = random.Random(3)
    rows, texts = [], []
    for i in range(20):
        lead, rest = said(rng, 5), [said(rng, 20) for _ in range(rng.randint(1, 8))]
        body = "".join(f"<p>{p}</p>" for p in rest)
        rows.append((i, f"http://h/{i}", f"<article><div class=x><p>{lead}</p></div><div class=y>{body}</div></article>"))
        texts.append("\n".join([lead, *rest]))
    found = sitestyle.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["page_id"]: r["text"] for r in found} == dict(enumerate(texts))


def test_pages_of_one_layout_keep_their_text(spark):
    """Where all branches look the same everywhere, none is more important and only names remove."""
    rng = random.Random(5)
    rows = [
        (i, f"http://h/{i}", f"<div class=nav>{said(rng, 3)}</div><div class=story><p>{said(rng, 30)}</p></div>")
        for i in range(12)
    ]
    found = sitestyle.extract(spark.createDataFrame(rows, PAGES)).collect()
    want = {i: h.split("<p>")[1].split("</p>")[0] for i, _, h in rows}
    assert {r["page_id"]: r["text"] for r in found} == want
