"""Main text of web pages: containers are scored by the paragraphs below them, as a tree."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = re.compile(r"[\s\xa0]+")

# Element names of HTML by their role.
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
FOREIGN = frozenset("svg math".split())
NEVER = FOREIGN | frozenset("template head nav footer aside button select option menu dialog object canvas audio video".split())
CLOSES_P = BLOCK - frozenset(["body", "html"])
SAME = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}
# Words in class, id or role that mark what is not the article: whole names, the last part of a name (`site-footer`) or, of the
# second list, its first part (`ad-slot`). Parts before and after which a word says nothing of the element itself (`has-sidebar`, `comments-open`).
WORD = r"ads?|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer\w*|header|masthead|comments?|commentlist|disqus|respond|repl(?:y|ies)|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|widget\w*|toolbar|pagination|pager|legal|copyright|disclaimer|skip|search|hidden"
FIRST = r"ads?|advert\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|footer\w*|comments?|disqus|cookies?|gdpr|popup|newsletter|share|sharing|social|related|recommended|pagination"
BEFORE = frozenset("no not has have with without is hide hides hidden show shows page layout site-has uses".split())
AFTER = frozenset("open opened closed enabled disabled on off none lazy hidden left-open content body text".split())
#: Of these, words that wrappers of whole pages carry as well, readers' remarks, and heads, which an article may have itself.
WRAPPERS = r"sidebar\w*|side|share|sharing|social|search|skip|widget\w*|header|masthead|overlay|modal|toolbar|legal|notices?|alert|subscribe|login|signup|related|recommended|hidden"
NOISE, NOISE_FIRST, WRAPPER, REMARKS, HEADS = (re.compile(rf"(?:{w})\Z", re.I) for w in (WORD, FIRST, WRAPPERS, r"comments?|commentlist|disqus|respond|repl(?:y|ies)", r"header|masthead"))
#: Shares of a page's plain text.
HALF, NEARLY_ALL, MORE_THAN_ALL = 0.5, 0.95, 2.0
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.I)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Node:
    tag: str
    parent: Node | None = None
    children: list = field(default_factory=list)  # nodes and texts, in page order
    noise: bool = False
    doubt: float = 0.0  # above 0: noise unless it holds an article or that share of the page's plain text
    points: float = 0.0
    chars: int = 0
    linked: int = 0


def doubtful(names: str, within: bool) -> float:
    """The share of the page's plain text from which on words in class, id or role don't make an element noise; 0: they say nothing.

    Wrappers of whole pages hold half of it or more. Readers' remarks may be longer than the article, so they are kept only where there is
    hardly anything else; adverts, menus and the like never are. within: in an article.
    """
    share = 0.0
    for name in names.split():
        parts = [x for x in re.split(r"[-_]+", name.lower()) if x]
        if not parts or len(parts) > 1 and (parts[0] in BEFORE or parts[-1] in AFTER):
            continue
        word = parts[-1] if NOISE.match(parts[-1]) else parts[0] if NOISE_FIRST.match(parts[0]) else ""
        if word and not (within and HEADS.match(word)):
            share = max(share, NEARLY_ALL if REMARKS.match(word) else HALF if WRAPPER.match(word) else MORE_THAN_ALL)
    return share


class Tags:
    """Comments, declarations and tags of a page, from left to right. An attribute's quotes may hold `>`; where they never close, the `<` is text.

    What a failed attempt has learned is kept (where the next sign is, which quotes never close, from where no end is reached), so that
    the work grows with the page and not with its square.
    """

    NAME_END, SIGN = re.compile(r"[\s/>]"), re.compile(r"[>\"']")

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.ahead: dict[re.Pattern, tuple[int, int]] = {}
        self.unclosed: dict[str, int] = {}
        self.dead: set[int] = set()

    def _next(self, kind: re.Pattern, pos: int) -> int:
        asked, found = self.ahead.get(kind, (0, -1))
        if not asked <= pos <= found:
            m = kind.search(self.html, pos)
            asked, found = self.ahead[kind] = pos, m.start() if m else len(self.html)
        return found

    def _close(self, pos: int) -> int:
        """The place of the `>` that ends a tag, or -1."""
        path = []
        while pos <= self.last:
            at = self._next(self.SIGN, pos)
            if at >= len(self.html) or at in self.dead:
                break
            sign = self.html[at]
            if sign == ">":
                return at
            path.append(at)
            if at >= self.unclosed.get(sign, len(self.html)):
                break
            end = self.html.find(sign, at + 1)
            if end < 0:
                self.unclosed[sign] = at
                break
            pos = end + 1
        self.dead.update(path)
        return -1

    def search(self, pos: int) -> tuple[int, int, str, str | None, str] | None:
        """(start, end, slash, name, attributes) of the next one; the name is None but for tags."""
        html = self.html
        while (at := html.find("<", pos)) >= 0:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return at, len(html) if end < 0 else end + 3, "", None, ""
            head = html[at + 1 : at + 3]
            if head[:1] in ("!", "?") and head:
                end = html.find(">", at) if at < self.last else -1
                if end >= 0:
                    return at, end + 1, "", None, ""
            slash = "/" if head[:1] == "/" else ""
            first = head[len(slash) : len(slash) + 1]
            if first.isascii() and first.isalpha():
                begin = at + 1 + len(slash)
                behind = self._next(self.NAME_END, begin)
                end = self._close(behind)
                if end >= 0:
                    return at, end + 1, slash, html[begin:behind].lower(), html[behind:end]
            pos = at + 1
        return None


def hidden(attributes: str) -> bool:
    """Whether an element is hidden: by its attribute `hidden`, by aria-hidden=true or by its style. The first of equal names counts."""
    low = attributes.lower()
    if "hidden" not in low and "display" not in low:
        return False
    own: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        own.setdefault(name.lower(), a or b or c)
    return "hidden" in own or own.get("aria-hidden", "").strip().lower() == "true" or bool(UNSEEN.search(unescape(own.get("style", ""))))


def parse(html: str) -> Node:
    """A forgiving tree: unknown ends are passed over, open paragraphs and items end where the next begins, drawings where a block begins.

    Scripts and styles without an end reach to the end of the page; other elements of plain text without an end are passed over.
    """
    root = at = Node("root")
    pos, depth, endless = 0, Counter(), set()

    def leave(x: Node, upto: Node) -> Node:
        """The parent of upto, which is x or above it; all in between are closed."""
        while True:
            depth[x.tag] -= 1
            if x is upto:
                return x.parent
            x = x.parent

    tags = Tags(html)
    for start, behind, end, tag, attributes in iter(lambda: tags.search(pos), None):
        if start > pos:
            at.children.append(html[pos:start])
        pos = behind
        if tag is None:
            continue
        if end:
            x = at if depth[tag] else root
            while x is not root and x.tag != tag and not (tag not in BLOCK and x.tag in BLOCK):
                x = x.parent
            if x is not root and x.tag == tag:
                at = leave(at, x)
            continue
        if tag in RAW:  # its text is no text of the page
            close = None if tag in endless else RAW_ENDS[tag].search(html, pos)
            if close:
                pos = close.end()
            else:
                endless.add(tag)
                pos = len(html) if tag in ("script", "style") else pos
            continue
        if tag == "br":
            at.children.append("\n")
        if tag in VOID and tag != "hr":
            continue
        if tag in BLOCK and any(depth[f] for f in FOREIGN):
            x = at
            while x.tag not in FOREIGN:
                x = x.parent
            at = leave(at, x)
        if tag in CLOSES_P:
            x = at
            while x is not root and x.tag not in BLOCK:
                x = x.parent
            if x.tag == "p":
                at = leave(at, x)
        if tag in SAME and depth[tag]:
            x, stop = at, SAME[tag].split()
            while x is not root and x.tag != tag and x.tag not in stop and x.tag not in ("td", "th", "table"):
                x = x.parent
            if x.tag == tag:
                at = leave(at, x)
        names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
        within = bool(depth["article"] or depth["main"])
        doubt = doubtful(names, within) if names and tag not in ("body", "html", "article", "main") else 0.0
        new = Node(tag, at, noise=tag in NEVER or tag == "header" and not within or hidden(attributes), doubt=max(doubt, HALF * (tag == "form")))
        at.children.append(new)
        if tag != "hr" and not (attributes.endswith("/") and (tag not in BLOCK or tag in FOREIGN)):
            at = new
            depth[tag] += 1
    if pos < len(html):
        at.children.append(html[pos:])
    return root


def _decide(root: Node) -> None:
    """Doubtful elements become noise unless they hold an article or main or, where the page has none, their share of its text outside links and surer noise."""
    order, todo = [], [(root, False)]
    plain: dict[int, int] = {}
    holds: dict[int, bool] = {}
    while todo:
        x, link = todo.pop()
        if x.noise:
            continue
        order.append(x)
        plain[id(x)] = 0 if link else sum(len(c.strip()) for c in x.children if isinstance(c, str))
        holds[id(x)] = x.tag in ("article", "main")
        todo.extend((c, link or c.tag == "a") for c in x.children if isinstance(c, Node))
    for x in reversed(order):
        if x.parent is not None:
            plain[id(x.parent)] += plain[id(x)]
            holds[id(x.parent)] |= holds[id(x)]
    for x in order:
        if x.doubt:
            x.noise = not holds[id(x)] and (holds[id(root)] or plain[id(x)] < x.doubt * plain[id(root)])


def _up(x: Node | None) -> Iterator[Node]:
    while x is not None:
        yield x
        x = x.parent


def _blocks(top: Node, live: Node | None = None) -> Iterator[tuple[Node, str, int]]:
    """(element, its own text, characters in links) of each stretch of text between block borders, in page order."""
    text: list[str] = []
    linked = 0
    stack: list = [(top, iter(top.children), False)]
    owner, owners = top, [top]

    def flush():
        nonlocal text, linked
        joined, n = SPACE.sub(" ", unescape("".join(text))).strip(), linked
        text, linked = [], 0
        return (owner, joined, n) if joined else None

    while stack:
        node, rest, link = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if node.tag in BLOCK and node is not top:
                if out := flush():
                    yield out
                owners.pop()
                owner = owners[-1]
        elif isinstance(child, str):
            text.append(child)
            linked += len(child) if link else 0
        elif not child.noise:
            if child.tag in BLOCK:
                if out := flush():
                    yield out
                owner = child
                owners.append(child)
            stack.append((child, iter(child.children), link or child.tag == "a"))
    if out := flush():
        yield out


def main_text(html: str) -> str:
    """The article's blocks, joined by line ends; empty if the page has none.

    Each block gives its container points for length and commas, half of them the container above, a third the next, up to the fifth. A container's
    points are discounted by its share of text in links. The best one is kept with all its blocks, and siblings of it that score a
    fifth of that or hold plain text. What is no article by its element's name or is hidden goes before; a form, and what is none by words in its
    class, id or role, only if it holds no article and, on pages without one, not its share of the plain text (see `doubtful`).
    """
    root = parse(html)
    _decide(root)
    blocks = [(n, t, min(k, len(t))) for n, t, k in _blocks(root)]
    if not blocks:
        return ""
    scored: dict[int, Node] = {}
    for node, text, linked in blocks:
        node.chars += len(text)
        node.linked += linked
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo.extend(c for c in x.children if isinstance(c, Node))
    for x in reversed(order):  # what is below counts above
        if x.parent is not None:
            x.parent.chars += x.chars
            x.parent.linked += x.linked
    for node, text, _ in blocks:
        own = 1 + text.count(",") + min(len(text) / 100, 3) if len(text) >= 25 else 0.2
        holder = node.parent if node.tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "dd", "dt", "div") and node.parent is not None and node.parent.tag != "root" else node
        share = 1.0
        for depth, x in enumerate(_up(holder)):
            if depth > 4:
                break
            x.points += own * share
            scored[id(x)] = x
            share = 0.5 if depth == 0 else share * 2 / 3

    def final(x: Node) -> float:
        return x.points * (1 - x.linked / max(1, x.chars)) * (1.5 if x.tag in ("article", "main") else 1)

    best = max(scored.values(), key=final)
    for x in _up(best):  # an article keeps together what its inner containers share
        if x.tag in ("article", "main"):
            best = x
    keep, least = {id(best)}, max(2.0, final(best) / 5)
    if best.parent is not None and best.tag not in ("article", "main", "body"):
        for x in best.parent.children:
            if isinstance(x, Node) and not x.noise and x.chars and x.linked < x.chars / 4 and (final(x) >= least or x.tag in ("p", "h1", "h2", "h3") and (x.chars > 80 or x.tag != "p")):
                keep.add(id(x))
    for x in order:  # what is kept is kept with all below it
        if x.parent is not None and id(x.parent) in keep:
            keep.add(id(x))
    return "\n".join(t for n, t, _ in blocks if id(n) in keep)


def extract(pages: DataFrame, key_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The key columns, text and n_chars (code points) for every row; a null page counts as empty, and gives an empty text.

    Nothing is shuffled: a page is parsed where it lies. Repeated rows give repeated results, an empty table no row.
    """
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            texts = [main_text(h or "") for h in x.column(x.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(x.column(k) for k in range(x.num_columns - 1)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*key_cols, "text", "n_chars"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in key_cols) + ", text string, n_chars long"
    return pages.select(*key_cols, F.col(html_col)).mapInArrow(run, schema)
