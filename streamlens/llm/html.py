"""Main text of web pages by tree scoring.

Paragraphs give points for length and commas to their ancestors, the nearest
most; an ancestor's points are discounted by its link density.  The best
container is kept together with siblings that look like more of the same text.

Defined results: a null or empty page has the empty text; a page without any
paragraph gives the text of its article, main part or body; broken, unclosed
and cut-off markup is read as far as it goes; extra columns are ignored and
repeated rows give repeated rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p"
    " pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head script style template nav footer aside form button select option textarea input iframe"
    " svg canvas object embed applet menu dialog noscript title audio video map math".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar"
    " toolbar".split()
)
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of a class or id that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs footer masthead"
    " comment comments commentlist adsbygoogle disqus reply replies respond notice notices cookie cookies consent gdpr"
    " popup modal newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations widget widgets pagination pager toolbar alert".split()
)
# The same, unless a word of the article stands beside them ("article-header").
WEAK_BOILERPLATE = frozenset("header hidden overlay skip toc".split())
ARTICLE_WORDS = frozenset("article content main post entry story".split())
# Names of layouts that only have such a part ("with-sidebar").
LAYOUT_WORDS = frozenset("with without no has show hide not".split())

# A quote sign holds a value only behind "=" and if its partner ends the value; any other one is
# a character like others, so a tag with an odd quote sign ends at its ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')(?=[\s/>]|\Z)|[^>])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    """An element; ``items`` holds its texts and elements in page order."""

    __slots__ = ("name", "parent", "items", "dropped", "article", "points", "chars", "links")

    def __init__(self, name: str, parent: Node | None, dropped: bool, article: bool):
        self.name, self.parent, self.dropped, self.article = name, parent, dropped, article
        self.items: list[Node | str] = []
        self.points = 0.0
        self.chars = self.links = 0


def _is_boilerplate(name: str, raw: str, in_article: bool) -> bool:
    if name in DROPPED:
        return True
    if name == "header" and not in_article:
        return True
    if not raw or raw.isspace() or name in ("body", "html", "article", "main"):
        return False
    attrs = {k.lower(): (a or b or c) for k, a, b, c in _ATTR.findall(raw)}
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if attrs.get("role", "").lower() in DROPPED_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "").lower()):
        return True
    marked = False
    for name_of in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        words = {w.lower() for w in _CLASS_WORD.findall(name_of)}
        if words and words <= ARTICLE_WORDS | {"body", "text"}:
            return False
        if not words & LAYOUT_WORDS:
            weak = words & WEAK_BOILERPLATE and not words & ARTICLE_WORDS and not in_article
            marked = marked or bool(words & BOILERPLATE or weak)
    return marked


def parse(page: str) -> Node:
    """The element tree of a page; what a browser would close is closed."""
    root = here = Node("html", None, False, False)
    depth: dict[str, int] = {"html": 1}
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not here.dropped:
            here.items.append(page[at:stop])
        if not found:
            break
        at = found.end()
        name = found["name"]
        if not name:
            continue
        name = name.lower()
        if found["close"]:
            if depth.get(name) and name not in ("html", "body"):
                while here.name != name:
                    depth[here.name] -= 1
                    here = here.parent
                depth[name] -= 1
                here = here.parent or root
            continue
        if name == "html":
            continue
        if name in BLOCK and depth.get("p") and name != "p":
            here = _close(here, "p", depth)
        if name in CLOSED_BY_SAME:
            here = _close(here, name, depth)
            if name in ("dt", "dd"):
                here = _close(here, "dd" if name == "dt" else "dt", depth)
        article = here.article or name in ("article", "main")
        dropped = here.dropped or _is_boilerplate(name, found["attrs"], here.article)
        node = Node(name, here, dropped, article)
        if not here.dropped:
            here.items.append(node)
        if name in RAW and not found["attrs"].endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
        elif name not in VOID and not (found["attrs"].endswith("/") and name in ("svg", "path")):
            depth[name] = depth.get(name, 0) + 1
            here = node
    return root


# An open element is only closed implicitly up to one of these.
_SCOPES = frozenset("article aside blockquote body div dl html main ol section table ul".split())


def _close(here: Node, name: str, depth: dict[str, int]) -> Node:
    if not depth.get(name):
        return here
    node, limits = here, _SCOPES - ({"table"} if name in ("tr", "td", "th") else set())
    while node is not None and node.name != name:
        if node.name in limits or node.name == "table":
            return here
        node = node.parent
    if node is None:
        return here
    while here is not node.parent:
        depth[here.name] -= 1
        here = here.parent
    return here


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """Kept elements, each before (True) and after (False) what it holds."""
    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, enters = stack.pop()
        if node.dropped:
            continue
        yield node, enters
        if enters:
            stack.append((node, False))
            stack.extend((x, True) for x in reversed(node.items) if isinstance(x, Node))


MIN_PARAGRAPH = 25
SIBLING_SHARE = 0.2


def _paragraph_points(text: str) -> float:
    return 1.0 + text.count(",") + min(len(text) / 100.0, 3.0)


def score(root: Node) -> list[Node]:
    """Set points, text and link lengths of every element; return those with points."""
    own: dict[int, list[str]] = {}
    in_link = 0
    for node, enters in _walk(root):
        if enters:
            in_link += node.name == "a"
            texts = [x for x in node.items if isinstance(x, str)]
            node.chars = sum(len(" ".join(x.split())) for x in texts)
            node.links = node.chars if in_link else 0
            own[id(node)] = texts
            continue
        in_link -= node.name == "a"
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.links += node.links
            if node.name not in BLOCK:
                own[id(up)].extend(own.pop(id(node)))
                continue
        text = " ".join(html.unescape("".join(own.pop(id(node)))).split())
        if len(text) < MIN_PARAGRAPH or node.name in HEADINGS:
            continue
        points = _paragraph_points(text) * (1.0 - node.links / max(node.chars, 1))
        holder = node if node.name not in ("p", "pre", "li", "td", "blockquote") else up
        level = 0
        while holder is not None:
            holder.points += points / (1 if level == 0 else 2 * level)
            holder, level = holder.parent, level + 1
    return [n for n, enters in _walk(root) if enters and n.points > 0]


def _discounted(node: Node) -> float:
    return node.points * (1.0 - node.links / max(node.chars, 1))


def choose(root: Node) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    scored = [n for n in score(root) if n.name not in ("html",)]
    if not scored:
        return [_fallback(root)]
    best = max(scored, key=_discounted)
    # An article split into sections is one article.
    node: Node | None = best
    while node is not None and node.name not in ("article", "main"):
        node = node.parent
    if node is not None and not node.dropped:
        return [node]
    if best.parent is None:
        return [best]
    least = max(10.0, SIBLING_SHARE * _discounted(best))
    kept = []
    for other in best.parent.items:
        if not isinstance(other, Node) or other.dropped:
            continue
        density = other.links / max(other.chars, 1)
        if other is best or _discounted(other) >= least:
            kept.append(other)
        elif other.name in HEADINGS and density < 0.5:
            kept.append(other)
        elif other.name in ("p", "pre", "blockquote", "ul", "ol", "table", "figure") and density < 0.25:
            kept.append(other)
    return kept


def _fallback(root: Node) -> Node:
    body = root
    for node, enters in _walk(root):
        if enters and node.name in ("article", "main"):
            return node
        if enters and node.name == "body":
            body = node
    return body


def blocks(container: Node) -> list[str]:
    """Texts of the blocks below an element in page order, white space folded."""
    out: list[str] = []
    open_text: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(open_text)).split())
        open_text.clear()
        if text:
            out.append(text)

    stack: list[Node | str] = [container]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            open_text.append(item)
        elif item is _BREAK:
            flush()
        elif item.name in ("br", "wbr", "img", "hr") and not item.items:
            open_text.append("" if item.name == "wbr" else " ")
        elif not item.dropped:
            if item.name in BLOCK:
                flush()
                stack.append(_BREAK)
            stack.extend(reversed(item.items))
    flush()
    return out


_BREAK = Node("", None, False, False)


def main_text(page: str | None) -> str:
    """The article of one page; the empty string if there is none."""
    if not page:
        return ""
    return "\n\n".join(text for node in choose(parse(page)) for text in blocks(node))


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page: the columns page_id, url, text and n_chars (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
