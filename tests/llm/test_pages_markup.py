"""Pages with broken or very long markup, and the registered query against a plain parser."""

import time
from html.parser import HTMLParser

import pytest

from lakequality.llm import pages, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "piece", ["<b ", "<script ", "<a<a>", "<!-", "<p class='", '<b a="', "</ ", "<x class= ", "&", "<b></i>", "<!--", "<b a=\"'>"]
)
def test_time_is_linear(piece):
    started = time.perf_counter()
    pages.blocks(piece * (1_000_000 // len(piece)) + '"')
    assert time.perf_counter() - started < 20


def test_names_that_mean_something_else_keep_their_text():
    page = (
        '<article><div class="share-price">A</div><section class="related-work">B</section><p id="search">C</p>'
        '<h2 id="comments">D</h2><div class="share-buttons">x</div><div class="ad-box">y</div><p>1 < 2 <3</p></article>'
    )
    assert pages.blocks(page) == (["A", "B", "C", "D", "1 < 2 <3"], [True] * 5)
    # Comments, declarations and scripts join what stands around them; an unclosed tag ends the page.
    assert pages.blocks("<p>a<!-- > -->b<script>1<2</p></script>c<?x?></p><p>d</p><a href='x>e</p>")[0] == ["abc", "d"]


def test_alignment_of_long_lists():
    a, b = list(range(3000)) * 2, list(range(0, 6000, 2)) + list(range(1, 3000, 2))
    used = pages.shared(a, b)
    it = iter(b)
    assert all(a[i] in it for i in used) and used == sorted(set(used)) and len(used) == 3000


def test_paths_are_compared_whole(spark):
    """Beyond a long common start the nearer page is the one whose path goes on alike."""
    deep = "http://h.org/" + "d" * 5000
    text = "<body><p>{0}</p><p>own {1}</p><p>more {1}</p><p>end {1}</p>"
    rows = [(0, f"{deep}/a/1", text.format("left", 0)), (1, f"{deep}/b/1", text.format("right", 1)), (2, f"{deep}/b/2", text.format("right", 2))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got[1] == "own 1\nmore 1\nend 1" and got[2] == "own 2\nmore 2\nend 2" and got[0].startswith("left")


class Plain(HTMLParser):
    """Text of the article of a well-formed page, a block for each paragraph or heading."""

    def __init__(self):
        super().__init__()
        self.stack, self.found = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in ("br", "img", "meta", "link", "input", "hr"):
            off = tag in ("nav", "aside", "footer", "form", "script", "style") or dict(attrs).get("class") == "ad"
            self.stack.append((tag, off))
        if tag in ("p", "h1", "h2", "h3", "div", "li", "section", "article"):
            self.found.append("")

    def handle_endtag(self, tag):
        while self.stack and tag in (t for t, _ in self.stack):
            if self.stack.pop()[0] == tag:
                break
        if tag in ("p", "h1", "h2", "h3", "div", "li", "section", "article"):
            self.found.append("")

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.stack) and not any(off for _, off in self.stack):
            self.found[-1] += data


def test_query_equals_a_plain_parser(spark):
    want = {}
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        plain = Plain()
        plain.feed(row.html or "")
        plain.close()
        said = [" ".join(block.split()) for block in plain.found]
        want[row.page_id] = "\n".join(block for block in said if block)
    rows = queries.op6_html_text(spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
