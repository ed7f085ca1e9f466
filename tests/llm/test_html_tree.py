"""The style tree: importances against brute force, what it decides alone, and broken pages in linear time."""

import math
import os
import time
from collections import defaultdict

import pytest

from graphloom.llm import html_extract

SF = "/root/testdata/sf0.01"


def pages(n):
    for i in range(n):
        story = "".join(f"<p>Part {k} of story {i} tells of {i * 7 + k}.</p>" for k in range(2 + i % 3))
        yield (f'<body><div class="top">Our site since 1999</div><div class="side x{i % 2}"><a>item {i % 4}</a></div>'
               f'<div class="story">{story}{"<h2>More</h2>" if i % 5 == 0 else ""}</div><div class="tail">Call now</div></body>')


def test_importances_equal_a_plain_computation(spark):
    sources = list(pages(14))
    table = spark.createDataFrame([("a.example", s) for s in [*sources, sources[3]]] + [("b.example", sources[0])], "host string, html string")
    got = {(r["host"], r["path"]): r for r in html_extract.style_tree(table).collect()}
    seen, texts, styles, chars = defaultdict(set), defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set)), defaultdict(int)
    for i, source in enumerate(sources):
        blocks, children, _ = html_extract.parse(source)
        for b in blocks:
            seen[b.path].add(i)
            texts[b.path][b.text].add(i)
            chars[b.path] += len(b.text)
        for path, style in children.items():
            seen[path].add(i)
            styles[path][style].add(i)
    assert {p for h, p in got if h == "a.example"} == set(texts)
    for path, found in texts.items():
        row, m = got["a.example", path], len(seen[path])
        content = 1 - sum(math.log(len(x)) for x in found.values()) / len(found) / math.log(m) if m > 1 else 1.0
        shares = [len(x) / sum(map(len, styles[path].values())) for x in styles[path].values()]
        spread = -sum(p * math.log(p) for p in shares) / math.log(m) if shares and m > 1 else content
        assert row["pages"] == m and abs(row["chars"] - chars[path] / m) < 1e-9
        assert abs(row["importance"] - (0.1 * spread + 0.9 * content)) < 1e-9
    assert all(r["importance"] == 1 for (h, _), r in got.items() if h == "b.example")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_the_tree_alone_finds_most_articles(spark):
    import re

    table = spark.read.parquet(f"{SF}/pages.parquet").withColumn("host", html_extract._host())
    sites = defaultdict(dict)
    for r in html_extract.style_tree(table.select("host", "html")).filter("pages > 1").collect():
        sites[r["host"]][r["path"]] = (r["importance"], r["chars"])
    alone = usual = total = 0
    for r in table.collect():
        article = re.search(r"<article>.*</article>", r["html"], re.S)
        want = "\n".join(b.text for b in html_extract.parse(article[0])[0] if not b.silent and not b.named)
        total += 1
        alone += html_extract.main_text(r["html"], sites[r["host"]], tree_alone=True) == want
        usual += html_extract.main_text(r["html"], sites[r["host"]]) == want
    assert alone >= 0.9 * total and usual >= 0.98 * total


def test_names_weigh_and_do_not_decide():
    assert html_extract.main_text('<main><section class="promo-code-guide"><p>How promo codes work.') == "How promo codes work."
    assert html_extract.main_text('<div class="post-share-of-voice"><p>Long article text') == "Long article text"
    comments = "<p>reader says</p>" * 60
    assert html_extract.main_text(f'<article><p>{"News of the day. " * 9}</p><div class="comments">{comments}</div></article>') == ("News of the day. " * 9).strip()
    # a short article beside a long list of links
    assert html_extract.main_text(f'<body><div class="links">{"<a>other page</a> " * 20}</div><article><p>Short news.</p></article>') == "Short news."


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<a " * 150_000 + "'", "<b>" * 80_000 + "</b>" * 80_000, "<p><table><td>" + "<div>" * 60_000,
                                  "<ul>" + "<li>" * 80_000, "<!--" * 100_000, '<p class="' + "a " * 100_000 + '">x', "<" * 200_000, "&" * 200_000])
def test_broken_pages_take_linear_time(page):
    start = time.perf_counter()
    html_extract.main_text(page)
    assert time.perf_counter() - start < 15
