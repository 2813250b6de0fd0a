"""Wrappers with ordinary class words keep their article; an independent, slow scorer agrees; pages that never end stay cheap."""

import os
import random
import re
import time
from html.parser import HTMLParser

import pytest

from placeforge.llm import html

LINE = "A paragraph of the article, with commas, and words enough to be scored as one, number {}."
ARTICLE = "\n".join(LINE.format(k) for k in range(4))
BODY = "".join(f"<p>{LINE.format(k)}</p>" for k in range(4))


@pytest.mark.parametrize("name", ["page has-sidebar", "layout--sidebar-right", "site with-sidebar", "post-header-image single", "no-share", "blog-post social", "col side", "skip-lazy", "comments-open", "hide-comments wide", "content search", "widget", "main-header"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_keep_their_article(name, inner):
    page = f'<body><nav><a href="/">Home</a></nav><div class="{name}"><{inner}>{BODY}</{inner}></div><footer>Imprint</footer></body>'
    assert html.main_text(page) == ARTICLE


@pytest.mark.parametrize("wrapper", ['<div role="search"><article>{}</article></div>', '<form id="aspnetForm"><div><p>Hi</p><article>{}</article></div></form>', "<form><div>{}</div></form>", '<div id="comments-open" class="no-ads"><div>{}</div></div>'])
def test_articles_in_forms_and_roles(wrapper):
    assert html.main_text("<body>" + wrapper.format(BODY) + "</body>") == ARTICLE


@pytest.mark.parametrize("name", ["ad", "ads", "ad-slot", "advertisement", "sidebar", "left-sidebar", "site-footer", "cookie-banner", "cookie-notice", "notice", "related-posts", "share-buttons", "social", "newsletter", "breadcrumbs", "main-nav", "popup", "site-header"])
def test_noise_goes(name):
    noise = f'<div class="{name}"><p>Not of the article, though it has commas, words and a length.</p></div>'
    for page in (f"<body><article>{BODY}{noise}</article></body>", f"<body>{noise}<div>{BODY}</div></body>"):
        got = html.main_text(page)
        assert got == ARTICLE or name == "site-header" and "<article>" in page  # an article may have a header of its own


@pytest.mark.parametrize("name", ["comments", "comment-list", "post-comments", "disqus", "replies"])
def test_remarks_longer_than_the_article_go(name):
    remarks = "".join(f"<p>{LINE.format(k)} says a reader</p>" for k in range(40))
    assert html.main_text(f'<body><div>{BODY}</div><div id="{name}">{remarks}</div></body>') == ARTICLE


def test_header_within_an_article_is_its_own():
    assert html.main_text(f'<article><div class="article header"><h1>Title</h1></div>{BODY}</article>') == "Title\n" + ARTICLE


@pytest.mark.parametrize("piece", ["<a '", '<a "', "<a \"'", "<a", "<a b='c\" ", "<", "</", "<!", "<?x ", "<a/", "<p '\"", "<!--x", "x='>\" <b "])
def test_a_megabyte_of_what_never_ends(piece):
    page = f"<p>{LINE}</p>" + piece * (1_000_000 // len(piece))
    for end in ("", '"', "'>", ">"):
        began = time.process_time()
        html.main_text(page + end)
        assert time.process_time() - began < 6


TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)


def test_tags_are_those_of_the_pattern():
    rng = random.Random(7)
    signs = ["<", ">", "'", '"', "a", "p ", "/", "!", "?", "-", "-->", "<!--", "=", " ", "é", "<b c='", "</p>"]
    for _ in range(4000):
        page = "".join(rng.choice(signs) for _ in range(rng.randint(0, 25)))
        tags, pos, got = html.Tags(page), 0, []
        while (x := tags.search(pos)) is not None:
            got.append(x)
            pos = x[1]
        want = [(m.start(), m.end(), m.group(1) or "", m.group(2) and m.group(2).lower(), m.group(3) or "") for m in TOKEN.finditer(page)]
        assert got == want, page


class Slow(HTMLParser):
    """Paths of blocks and their texts, by the standard parser; no class words, no forgiving of open elements but paragraphs."""

    def __init__(self, page):
        super().__init__()
        self.path, self.number, self.blocks, self.text, self.skip = [("root", 0)], 0, [], "", 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        t = re.sub(r"[\s\xa0]+", " ", self.text).strip()
        if t and not self.skip:
            self.blocks.append((tuple(x for x in self.path if x[0] in html.BLOCK or x[0] == "root"), t))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in html.VOID:
            self.text += "\n" * (tag == "br")
            return
        if tag in html.BLOCK:
            self.flush()
            if self.path[-1][0] == "p" or any(x[0] == "p" for x in self.path):
                k = max(i for i, x in enumerate(self.path) if x[0] == "p")
                del self.path[k:]
        self.number += 1
        self.path.append((tag, self.number))
        self.skip += tag in html.NEVER or tag in html.RAW or dict(attrs).get("class") == "ad"

    def handle_endtag(self, tag):
        if any(x[0] == tag for x in self.path):
            if tag in html.BLOCK:
                self.flush()
            while self.path[-1][0] != tag:
                self.path.pop()
            self.path.pop()
            self.skip -= tag in html.NEVER or tag in html.RAW or (tag == "div" and self.skip > 0)

    def handle_data(self, data):
        if not self.skip:
            self.text += data


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/pages.parquet"), reason="no test tables")
def test_the_scorer_finds_the_container_of_pages_without_article():
    import pyarrow.parquet as pq

    for page in pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist():
        plain = re.sub(r"<(/?)article\b", r"<\1div", page)
        blocks = Slow(plain).blocks
        points = {}
        for path, t in blocks:  # the sum of a container's points over all blocks below it, up to five levels
            own = 1 + t.count(",") + min(len(t) / 100, 3) if len(t) >= 25 else 0.2
            up, share = list(path[:-1]) or [path[-1]], 1.0
            for k, x in enumerate(reversed(up[-5:])):
                points[x] = points.get(x, 0) + own * share
                share = 0.5 if k == 0 else share * 2 / 3
        if not points:
            assert html.main_text(plain) == ""
            continue
        best = max(points, key=points.get)
        assert html.main_text(plain) == "\n".join(t for path, t in blocks if best in path)
        assert html.main_text(page) == html.main_text(plain)
