"""HTML: main content, links, charset. The tree is built by the standard library's parser."""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

# Tags whose content is never text, tags that hold blocks, void tags.
DROPPED = frozenset("script style noscript iframe object embed form select option button textarea input head".split())
VOID = frozenset("br img hr meta link input area base col embed source track wbr".split())


class Node:
    __slots__ = ("tag", "path", "kids", "text", "link", "attrs")

    def __init__(self, tag: str, path: str, attrs: dict, link: bool):
        self.tag, self.path, self.kids, self.text, self.link, self.attrs = tag, path, [], "", link, attrs


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", "", {}, False)
        self.open = [self.root]
        self.title, self.in_title = "", False

    def handle_starttag(self, tag, attrs):
        at = self.open[-1]
        node = Node(tag, f"{at.path}/{tag}", {k: v or "" for k, v in attrs}, at.link or tag == "a")
        at.kids.append(node)
        self.in_title = tag == "title"
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        at = self.open[-1]
        if data.strip():
            leaf = Node("#text", f"{at.path}/#text", {}, at.link)
            leaf.text = data
            at.kids.append(leaf)


def parse(html: str) -> _Tree:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree


def _hidden(n: Node) -> bool:
    style = n.attrs.get("style", "").replace(" ", "").lower()
    return n.tag in DROPPED or "display:none" in style or "visibility:hidden" in style or "hidden" in n.attrs


def _prune(n: Node) -> bool:
    """Drop hidden and empty nodes; whether anything is left."""
    n.kids = [k for k in n.kids if not _hidden(k) and _prune(k)]
    return bool(n.kids or n.text.strip())


def perplexity(values) -> float:
    """Entropy of a sequence over that of one without repetition, 0 to 1."""
    count = Counter(values)
    n = sum(count.values())
    if n < 2:
        return 1.0
    return -sum(c / n * math.log(c / n) for c in count.values()) / math.log(n)


def _leaves(n: Node):
    if not n.kids:
        yield n
    for k in n.kids:
        yield from _leaves(k)


def _weight(n: Node) -> int:
    """Characters outside links."""
    return sum(len(x.text.strip()) for x in _leaves(n) if not x.link)


def main_content(html: str, node_limit: float = 0.2, char_limit: float = 0.2, few_chars: int = 50, dominant: float = 0.5) -> str:
    """Text of the page's main part.

    Hidden, droppable and empty nodes go; leaves of one path form a cluster, and clusters whose
    texts repeat (low perplexity over texts, or few characters of low perplexity) lose their
    text; from the root, the child with more than half of the characters outside links is
    followed while there is one.
    """
    root = parse(html).root
    _prune(root)
    clusters: dict[str, list[Node]] = {}
    for leaf in _leaves(root):
        clusters.setdefault(leaf.path, []).append(leaf)
    for nodes in clusters.values():
        chars = "".join(x.text for x in nodes)
        few = len(set(chars)) < few_chars and perplexity(chars) < char_limit
        if len(nodes) > 1 and (perplexity(x.text.strip() for x in nodes) < node_limit or few):
            for x in nodes:
                x.text = ""
    at = root
    while at.kids:
        total = _weight(at)
        best = max(at.kids, key=_weight)
        if not total or _weight(best) <= dominant * total:
            break
        at = best
    return "\n".join(x.text.strip() for x in _leaves(at) if x.text.strip())


def title(html: str) -> str:
    return " ".join(parse(html).title.split())


_BAD_LINK = re.compile(r"^(javascript:|mailto:|data:)|\.(exe|zip|rar|iso|apk)$", re.I)


def links(html: str | _Tree, base: str, kind: str = "a") -> list[str]:
    """Absolute links in document order, each once, without fragment and closing slash; kind: a, css or img."""
    tag, attribute = {"a": ("a", "href"), "css": ("link", "href"), "img": ("img", "src")}[kind]
    out: dict[str, None] = {}

    def walk(n: Node):
        if n.tag == tag and (kind != "css" or "stylesheet" in n.attrs.get("rel", "stylesheet").lower()):
            raw = n.attrs.get(attribute, "").strip()
            if raw and not _BAD_LINK.search(raw):
                try:
                    full = urljoin(base, raw)
                except ValueError:
                    full = ""
                full = full.split("#")[0].rstrip("/")
                if full.startswith(("http://", "https://")):
                    out.setdefault(full)
        for k in n.kids:
            walk(k)

    walk((html if isinstance(html, _Tree) else parse(html)).root)
    return list(out)


_META = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_-]+)", re.I)


def to_bytes(text: str, name: str | None) -> tuple[bytes, str | None]:
    """A text in the named charset and that name, where it gives the text back; else in UTF-8, which keeps a name that is no charset."""
    try:
        body = text.encode(name or "")
        if body.decode(name or "") == text:
            return body, name
    except LookupError:
        return text.encode(), name
    except ValueError:
        pass
    return text.encode(), "utf-8"


def to_text(body: bytes | None, declared: str | None, max_bad: float = 0.1) -> str | None:
    """A body as text: by the declared charset, else that of its meta tag, else UTF-8, else GB18030; None if over max_bad of it can't be decoded."""
    if body is None:
        return None
    meta = _META.search(body[:2048])
    for name in (declared, meta[1].decode() if meta else None, "utf-8", "gb18030"):
        if not name:
            continue
        try:
            text = body.decode(name, "replace")
        except LookupError:
            continue
        if text.count("�") <= max_bad * max(1, len(text)):
            return text
    return None
