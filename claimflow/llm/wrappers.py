"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of one host.

1. Each page becomes a stream of block tags and text slots. Blocks that repeat side by side are one repeated group, and
   only the distinct streams of a host are aligned, so a host with a third of all pages costs as many as it has.
2. Streams are aligned with the host's wrapper one after the other: equal tokens match, a repeated group matches any
   number of its blocks, and what has no partner becomes an optional group. Streams of a host are merged in portions,
   and the portions' wrappers in the same way, until one is left. Long streams are cut at tokens that both hold once.
3. Each page's stream is matched with its host's wrapper, which tells the slot of each of its texts. A slot, or a repeated
   group as a whole, that holds one and the same text on most pages of a host is template; what varies is content.
4. From the slots with content follows which container holds the main text: article or main where the host has them,
   else the smallest container with most of the slots, those in repeated groups counting more.
5. Pages are matched again and read: the content slots in the container in page order, without those in zones that are no
   main text by their element or name.
"""

from __future__ import annotations

import functools
import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.session import freeze

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|([^<]+)|(<)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Elements of HTML by what they do here.
RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "iframe", "noembed", "noframes"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSED_BY_BLOCK = {"p"}
CLOSES_SAME = {"li", "dt", "dd", "tr", "td", "th", "option"}
OUTSIDE = {
    "head", "script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "nav", "aside", "footer", "form",
    "button", "label", "select", "textarea", "dialog", "menu", "search", "title", "xmp", "noembed", "noframes", "audio", "video", "map",
}
CONTAINERS = {"article", "body", "center", "div", "main", "section", "table", "tbody", "td", "tr"}
# Words in class, id or role that mark a zone without main text.
ZONES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "captcha",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "dialog", "disqus", "footer", "form",
    "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager",
    "pagination", "paywall", "popup", "promo", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup",
    "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
# Words that say where a zone is or what it is made of; with a word of ZONES they make up the name of a zone.
PLACES = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "global", "inner", "item", "items", "left",
    "link", "links", "list", "main", "outer", "page", "primary", "right", "secondary", "section", "site", "slot", "top", "wrap",
    "wrapper",
}
ARTICLE_ZONES = {"comment", "comments", "reply", "related", "promo", "ad"}
MERGED = 16  # streams or wrappers of a host that one row aligns
CELLS = 1 << 18  # pairs of tokens that one alignment weighs at once
LEAST_PAGES = 3  # pages of different headings that tell a constant text from one that few pages share
HOST = -1  # stands for the page as a whole among the numbers of slots (from 0 on) and groups (below)


def names_zone(token: str, zones: set[str]) -> bool:
    """Whether a class, id or role as a whole is the name of a zone: "cookie-notice", but not "has-sidebar"."""
    words = [w for w in token.split("-") if w not in PLACES]
    return bool(words) and all(w in zones for w in words)


class Element:
    """An open element: its name, its label in a wrapper, and whether text in it is outside of the main text.

    `named` tells that its class, id or role names a zone; labels in `free` are none nevertheless.
    """

    __slots__ = ("name", "label", "outside", "in_article", "named")

    def __init__(self, name: str, attributes: str, parent: Element | None, free: frozenset[str] = frozenset()):
        self.name, words = name, []
        marks = ATTRIBUTE.findall(attributes) if attributes and "=" in attributes else ()
        for _, a, b, c in marks:
            words += ["-".join(w for w in re.split(r"[^a-z]+", token) if w) for token in (a or b or c).lower().split()]
        words = [w for w in words if w]
        self.label = ".".join([name, *words])
        self.in_article = name == "article" or bool(parent and parent.in_article)
        zone = name in OUTSIDE or (name == "header" and not self.in_article)
        if name == "article":
            zone = zone or any(names_zone(w, ARTICLE_ZONES) for w in words)
        zones = ZONES - {"header"} if self.in_article else ZONES
        self.named = not zone and name not in ("html", "body", "article", "main") and any(names_zone(w, zones) for w in words)
        self.outside = bool(parent and parent.outside) or zone or (self.named and self.label not in free)


def events(page: str, free: frozenset[str] = frozenset()) -> Iterator[tuple[str, list[Element], str]]:
    """("open" | "close" | "text" | "break", open elements, name or text) of a page, tolerant of missing end tags."""
    stack: list[Element] = []
    at = 0
    while match := TOKEN.match(page, at):
        at = match.end()
        text = match[7] or match[8]
        if text is not None:
            yield "text", stack, text
            continue
        name = match[2] or match[5]
        if name is None:
            continue
        name = name.lower()
        if match[1] or match[4]:
            if any(e.name == name for e in stack):
                while True:
                    last = stack.pop()
                    if last.name in BLOCK:
                        yield "close", stack, last.label
                    if last.name == name:
                        break
            elif name == "p":
                yield "break", stack, name
            continue
        if name in BLOCK:
            # a block ends an open paragraph, and an item the item before it
            i = len(stack) - 1
            while i >= 0 and stack[i].name not in BLOCK:
                i -= 1
            if i >= 0 and (stack[i].name in CLOSED_BY_BLOCK or (name in CLOSES_SAME and stack[i].name == name)):
                label = stack[i].label
                del stack[i:]
                yield "close", stack, label
        element = Element(name, match[3] or match[6] or "", stack[-1] if stack else None, free)
        if name in VOID:
            yield ("break" if name == "hr" else "text"), stack, " " if name != "hr" else name
            continue
        stack.append(element)
        if name in BLOCK:
            yield "open", stack, element.label
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            stack.pop()
    return


def collapsed(tokens: list) -> list:
    """The tokens with blocks that repeat side by side as ["+", block], shorter blocks first."""
    for period in range(1, 9):
        out, i = [], 0
        while i < len(tokens):
            block = tokens[i : i + period]
            n = 1
            while len(block) == period and tokens[i + n * period : i + (n + 1) * period] == block:
                n += 1
            if n > 1:
                out.append(["+", block] if not (period == 1 and isinstance(block[0], list)) else block[0])
                i += n * period
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


def tokens_of(page: str) -> tuple[list[str], list[list[str]], str]:
    """The page's block tags ("name.class", "/name.class") and text slots ("#"), the texts of each slot, and all its
    main headings; without one, its longest text."""
    out: list[str] = []
    texts: list[list[str]] = []
    headings = []
    for kind, stack, what in events(page):
        if kind == "open":
            out.append(what)
        elif kind == "close":
            out.append("/" + what)
        elif kind == "text" and what.strip():
            if not out or out[-1] != "#":
                out.append("#")
                texts.append([])
            texts[-1].append(what)
            if stack and not stack[-1].outside and any(e.name == "h1" for e in stack):
                headings.append(what)
    title = " ".join(headings) or max(("".join(t) for t in texts), key=len, default="")
    return out, texts, " ".join(title.split())


def stream_of(page: str) -> list:
    """The page's block tags and text slots, with blocks that repeat side by side as groups."""
    return collapsed(tokens_of(page)[0])


def bare(node) -> list:
    """What a node stands for at least once: its block, or itself."""
    return node[1] if isinstance(node, list) else [node]


def weight(nodes: list) -> int:
    return sum(weight(n[1]) if isinstance(n, list) else 1 for n in nodes)


def alike(a, b) -> bool:
    """Whether two nodes can be one node of a wrapper: equal tokens, or groups that begin and end alike."""
    if isinstance(a, list) and isinstance(b, list):
        return first(a) == first(b) and last(a) == last(b)
    return a == b


def first(node):
    return first(node[1][0]) if isinstance(node, list) else node


def last(node):
    return last(node[1][-1]) if isinstance(node, list) else node


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest selection of pairs, given by their first number, whose second numbers increase."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        place = bisect_left(ends, j)
        before.append(at[place - 1] if place else -1)
        ends[place : place + 1] = [j]
        at[place : place + 1] = [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def merge(a: list, b: list) -> list:
    """Align two token lists or wrappers into a wrapper of both.

    Beyond CELLS pairs, equal ends are taken off and the rest is cut at nodes that both hold once, in the same order;
    where there are none, at the middle of both. So memory grows with the length, not its square.
    """
    if len(a) * len(b) <= CELLS:
        return aligned(a, b)
    keys_a, keys_b = ([n if isinstance(n, str) else json.dumps(n) for n in side] for side in (a, b))
    head, least = 0, min(len(a), len(b))
    while head < least and keys_a[head] == keys_b[head]:
        head += 1
    tail = 0
    while tail < least - head and keys_a[-1 - tail] == keys_b[-1 - tail]:
        tail += 1
    if head + tail:
        return a[:head] + merge(a[head : len(a) - tail], b[head : len(b) - tail]) + a[len(a) - tail :]
    once_a, once_b = Counter(keys_a), Counter(keys_b)
    places = {key: j for j, key in enumerate(keys_b) if once_b[key] == 1}
    anchors = increasing([(i, places[key]) for i, key in enumerate(keys_a) if once_a[key] == 1 and key in places])
    if not anchors:
        i, j = len(a) // 2, len(b) // 2
        return merge(a[:i], b[:j]) + merge(a[i:], b[j:])
    out, i, j = [], 0, 0
    for x, y in anchors:
        out += merge(a[i:x], b[j:y]) + [a[x]]
        i, j = x + 1, y + 1
    return out + merge(a[i:], b[j:])


def aligned(a: list, b: list) -> list:
    """The wrapper of both by their best alignment."""
    n, m = len(a), len(b)
    score = [[0] * (m + 1) for _ in range(n + 1)]
    move: list[list] = [[None] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best, how = score[i + 1][j], "a"
            if score[i][j + 1] > best:
                best, how = score[i][j + 1], "b"
            x, y = a[i], b[j]
            if alike(x, y):
                gain = min(weight(bare(x)), weight(bare(y))) + score[i + 1][j + 1]
                if gain > best or (gain == best and how != "m"):
                    best, how = gain, "m"
            # a group against its block written out
            if isinstance(x, list) and not isinstance(y, list):
                k = len(x[1])
                if b[j : j + k] == x[1] and weight(x[1]) + score[i + 1][j + k] > best:
                    best, how = weight(x[1]) + score[i + 1][j + k], ("x", k)
            if isinstance(y, list) and not isinstance(x, list):
                k = len(y[1])
                if a[i : i + k] == y[1] and weight(y[1]) + score[i + k][j + 1] > best:
                    best, how = weight(y[1]) + score[i + k][j + 1], ("y", k)
            score[i][j], move[i][j] = best, how
    out, loose, i, j = [], ([], []), 0, 0

    def settle() -> None:
        """What has no partner is optional, each side's by itself."""
        for side in loose:
            if len(side) == 1 and isinstance(side[0], list):
                out.append(["*", side[0][1]])
            elif side:
                out.append(["?", list(side)])
            side.clear()

    while i < n or j < m:
        how = move[i][j] if i < n and j < m else ("a" if i < n else "b")
        if how in ("a", "b"):
            node = a[i] if how == "a" else b[j]
            if isinstance(node, list) and node[0] in "?*":
                settle()
                out.append(node)
            else:
                loose[how == "b"].append(node)
            i, j = (i + 1, j) if how == "a" else (i, j + 1)
            continue
        settle()
        if how == "m":
            x, y = a[i], b[j]
            if isinstance(x, list):
                kind = x[0] if x[0] == y[0] else "*"
                out.append([kind, x[1] if x[1] == y[1] else merge(x[1], y[1])])
            else:
                out.append(x)
            i, j = i + 1, j + 1
        elif how[0] == "x":
            out.append(a[i])
            i, j = i + 1, j + how[1]
        else:
            out.append(b[j])
            i, j = i + how[1], j + 1
    settle()
    return out


def expression(wrapper: list) -> str:
    """The wrapper as text: tokens, (group)+ once or more, (group)* any number, (group)? at most once."""
    return " ".join(f"({expression(n[1])}){n[0]}" if isinstance(n, list) else f"<{n}>" if n != "#" else n for n in wrapper)


class Matcher:
    """A wrapper as an automaton that tells which slot of the wrapper each text slot of a page is.

    Slots are numbered from 0 in the order of `slots`; `group` names the outermost repeated group of each, -2 and below,
    or is None. A step from one token to the next is worked out when a page first takes it.
    """

    def __init__(self, wrapper: list):
        self.code: list[tuple] = []  # ("#" or tag, number of the slot) | (None, next places in order of preference)
        self.group: list[int | None] = []
        self.groups = 0
        self.steps: dict[int, tuple[dict[str, list[int]], bool]] = {}
        self._add(wrapper, None)

    def _add(self, nodes: list, group: int | None) -> None:
        for node in nodes:
            if not isinstance(node, list):
                self.code.append((node, len(self.group) if node == "#" else None))
                if node == "#":
                    self.group.append(group)
                continue
            kind, inner = node
            own = group
            if own is None and kind in "+*":
                own = -2 - self.groups
                self.groups += 1
            start = len(self.code)
            if kind in "?*":
                self.code.append((None, ()))
            self._add(inner, own)
            if kind == "+":
                self.code.append((None, (start, len(self.code) + 1)))
            else:
                if kind == "*":
                    self.code.append((None, (start,)))
                self.code[start] = (None, (start + 1, len(self.code)))

    def _step(self, place: int) -> tuple[dict[str, list[int]], bool]:
        """From a place on: where each token may lead, and whether the page may end."""
        found = self.steps.get(place)
        if found is None:
            onward: dict[str, list[int]] = {}
            seen, stack, ends = set(), [place], False
            while stack:
                at = stack.pop()
                if at in seen:
                    continue
                seen.add(at)
                if at == len(self.code):
                    ends = True
                elif self.code[at][0] is None:
                    stack += reversed(self.code[at][1])
                else:
                    onward.setdefault(self.code[at][0], []).append(at)
            found = self.steps[place] = (onward, ends)
        return found

    def match(self, tokens: list[str]) -> list[int] | None:
        """The wrapper's slot of each text slot of a page; None for a page that the wrapper does not accept."""
        trail: list[dict[int, int]] = []
        active = [0]
        for token in tokens:
            reached: dict[int, int] = {}
            for place in active:
                for at in self._step(place)[0].get(token, ()):
                    reached.setdefault(at, place - 1)
            if not reached:
                return None
            trail.append(reached)
            active = [at + 1 for at in reached]
        place = next((p for p in active if self._step(p)[1]), None)
        if place is None:
            return None
        out, at = [], place - 1
        for reached in reversed(trail):
            if self.code[at][0] == "#":
                out.append(self.code[at][1])
            at = reached[at]
        return out[::-1]


@functools.lru_cache(maxsize=64)
def matcher(wrapper: str) -> Matcher:
    return Matcher(json.loads(wrapper))


def digest(data: str | bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def evidence(found: Matcher, tokens: list[str], digests: list[int]) -> dict[int, tuple[int, int]]:
    """Per slot and repeated group that a page has: least and greatest digest of its texts, a group's taken as one."""
    numbers = found.match(tokens)
    out: dict[int, tuple[int, int]] = {HOST: (0, 0)}
    whole: dict[int, list[int]] = {}
    for number, value in zip(numbers or (), digests):
        low, high = out.get(number, (value, value))
        out[number] = min(low, value), max(high, value)
        if found.group[number] is not None:
            whole.setdefault(found.group[number], []).append(value)
    for group, values in whole.items():
        value = digest(json.dumps(values))
        out[group] = value, value
    return out


def template_slots(wrapper: list, found: Matcher, constant: dict[int, int], free: frozenset[str]) -> frozenset[int]:
    """Slots whose text is part of the template: constant by themselves or as a group, on half of the host's pages or more.

    `constant` counts the pages (of different headings) of each constant slot and group, and of the host. Where no slot
    in any other than a zone is left, the pages are copies of each other, and none is template.
    """
    pages = constant.get(HOST, 0)
    fixed = {k for k, n in constant.items() if k != HOST and n >= LEAST_PAGES and 2 * n >= pages}
    out = frozenset(k for k, g in enumerate(found.group) if k in fixed or g in fixed)
    content = any(k not in out and not outside(labels, free) for k, (labels, _) in enumerate(slots(wrapper)))
    return out if content else frozenset()


def slots(wrapper: list) -> Iterator[tuple[tuple[str, ...], bool]]:
    """(labels of the open blocks, in a repeated group) of every text slot."""
    stack: list[str] = []

    def walk(nodes: list, repeated: bool) -> Iterator[tuple[tuple[str, ...], bool]]:
        for node in nodes:
            if isinstance(node, list):
                yield from walk(node[1], repeated or node[0] in "+*")
            elif node == "#":
                yield tuple(stack), repeated
            elif node.startswith("/"):
                if node[1:] in stack:
                    while stack.pop() != node[1:]:
                        pass
            else:
                stack.append(node)

    return walk(wrapper, False)


def elements(labels: tuple[str, ...], free: frozenset[str] = frozenset()) -> list[Element]:
    out: list[Element] = []
    for label in labels:
        name, *words = label.split(".")
        out.append(Element(name, f'class="{" ".join(words)}"' if words else "", out[-1] if out else None, free))
    return out


def outside(labels: tuple[str, ...], free: frozenset[str] = frozenset()) -> bool:
    inner = elements(labels, free)
    return bool(inner and inner[-1].outside)


def free_zones(wrapper: list) -> frozenset[str]:
    """Labels of blocks that are named like a zone and are none: those that hold more than half of the slots that are
    not outside by their elements, or that hold an article or main when all articles and mains are in such blocks."""
    weights: dict[str, int] = {}
    holders: set[str] = set()
    total, apart = 0, False
    for labels, repeated in slots(wrapper):
        if outside(labels, frozenset(labels)):
            continue
        inner = elements(labels)
        total += (w := 5 if repeated else 1)
        named = [e.label for e in inner if e.named]
        for label in set(named):
            weights[label] = weights.get(label, 0) + w
        at = next((i for i, e in enumerate(inner) if e.name in ("article", "main")), None)
        if at is not None:
            around = [e.label for e in inner[:at] if e.named]
            holders.update(around)
            apart = apart or not around
    return frozenset({label for label, w in weights.items() if 2 * w > total} | (set() if apart else holders))


def container_of(wrapper: list, free: frozenset[str] = frozenset(), template: Collection[int] = ()) -> str:
    """Label of the main container: "article" or "main" where slots lie in one, else of the smallest container with at
    least half of the weight of all slots that are in no other zone; "" for all of the page. Template slots do not count.
    Where articles lie beside main only, it is "main"."""
    inner = [
        (labels, 5 if repeated else 1) for k, (labels, repeated) in enumerate(slots(wrapper))
        if k not in template and not outside(labels, free)
    ]
    named = [{label.split(".")[0] for label in labels} & {"article", "main"} for labels, _ in inner]
    beside = {"main"} in named and {"article", "main"} not in named
    for name in ("main", "article") if beside else ("article", "main"):
        if any(label.split(".")[0] == name for labels, _ in inner for label in labels):
            return name
    if mains := [label for labels, _ in inner for label in labels if label.endswith((".main", "-main"))]:
        return mains[0]
    weights: dict[tuple[str, ...], int] = {}
    for labels, w in inner:
        for depth, label in enumerate(labels):
            if label.split(".")[0] in CONTAINERS:
                weights[labels[: depth + 1]] = weights.get(labels[: depth + 1], 0) + w
    total = sum(w for _, w in inner)
    fine = [path for path, w in weights.items() if 2 * w > total]
    best = max(fine, key=lambda path: (len(path), path), default=())
    return best[-1] if best and best[-1].split(".")[0] not in ("body", "html") else ""


def main_text(
    page: str, container: str, free: frozenset[str] = frozenset(), found: Matcher | None = None,
    template: Collection[int] = (),
) -> str:
    """The blocks of the container in page order, one to a line; of the whole page when it has no such container.

    With a matcher, texts in the wrapper's template slots are left out.
    """
    pieces, tokens = read_pieces(page, container, free)
    numbers = found.match(tokens) if found and template else None
    fixed = {k for k, number in enumerate(numbers or ()) if number in template}
    got = join_blocks(pieces, 1, fixed) if container else None
    if got is None and container != "article":
        got = join_blocks(pieces, 2, fixed)
    return "\n".join(join_blocks(pieces, 0, fixed) if got is None else got)


def read_pieces(page: str, container: str, free: frozenset[str]) -> tuple[list[tuple[str | None, int, int]], list[str]]:
    """Texts of a page as (text, its slot or -1, where it lies), and the page's tokens.

    A block's border has None for text. Where: -1 in a zone, else 1 in the container plus 2 in an article.
    """
    pieces: list[tuple[str | None, int, int]] = []
    tokens: list[str] = []
    slot, by_name = -1, container in ("article", "main")
    for kind, stack, what in events(page, free):
        if kind != "text":
            if kind != "break":
                tokens.append(what if kind == "open" else "/" + what)
            pieces.append((None, -1, -1))
            continue
        if what.strip() and (not tokens or tokens[-1] != "#"):
            tokens.append("#")
            slot += 1
        where = -1
        if not (stack and stack[-1].outside):
            inside = any((e.name if by_name else e.label) == container for e in stack)
            where = inside + 2 * any(e.name == "article" for e in stack)
        pieces.append((what, slot if tokens and tokens[-1] == "#" else -1, where))
    return pieces, tokens


def join_blocks(pieces: list[tuple[str | None, int, int]], wanted: int, fixed: Collection[int]) -> list[str] | None:
    """Text of the blocks that lie where `wanted` (0: anywhere); None when the page has no such place."""
    blocks, parts, seen = [], [], not wanted

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            blocks.append(text)
        parts.clear()

    for text, slot, where in pieces:
        if text is None:
            flush()
        elif where < 0:
            if not parts or parts[-1] != " ":
                parts.append(" ")
        elif where & wanted == wanted:
            seen = True
            parts.append(" " if slot in fixed else text)
    flush()
    return blocks if seen else None


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty for null and for texts without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1), F.lit("")))


def page_streams(pages: DataFrame) -> DataFrame:
    """(host, tokens, digests, heading) of (host, html): a page's tokens, and digests of its slots' texts and headings."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams, digests, headings = [], [], []
            for page in batch.column(1).to_pylist():
                tokens, texts, heading = tokens_of(page or "")
                streams.append(" ".join(tokens))
                digests.append([digest(" ".join("".join(t).split())) for t in texts])
                headings.append(digest(heading))
            columns = [batch.column(0), pa.array(streams, pa.string()), pa.array(digests, pa.list_(pa.int64())), pa.array(headings, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "tokens", "digests", "heading"])

    return pages.select("host", "html").mapInArrow(read, "host string, tokens string, digests array<bigint>, heading bigint")


def infer_wrappers(streams: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper per host of (host, tokens), as JSON.

    A page without tokens has the empty stream. An empty table gives no rows.
    """

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            different = set(zip(*(c.to_pylist() for c in batch.columns)))
            found = {(h, json.dumps(collapsed(tokens.split()))) for h, tokens in different}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], ["host", "wrapper"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, some in zip(*(c.to_pylist() for c in batch.columns)):
                some = sorted(some, key=lambda w: (-len(w), w))
                wrapper = json.loads(some[0])
                for other in some[1:]:
                    wrapper = merge(wrapper, json.loads(other))
                out.append((host, json.dumps(wrapper)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["host", "wrapper"])

    kind = "host string, wrapper string"
    left = freeze(streams.select("host", "tokens").mapInArrow(collapse, kind).distinct(), "streams")
    while True:
        counts = left.groupBy("host").agg(F.count("*").alias("n"))
        if counts.where("n > 1").isEmpty():
            return left
        portions = counts.select("host", F.ceil(F.col("n") / MERGED).alias("portions"))
        portion = F.pmod(F.xxhash64("wrapper"), F.col("portions"))
        grouped = left.join(portions, "host").groupBy("host", portion.alias("portion")).agg(
            F.collect_list("wrapper").alias("wrappers")
        )
        left = freeze(grouped.select("host", "wrappers").mapInArrow(align, kind), "wrappers")


def constant_slots(streams: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, constant): the slots and groups with one text on all pages that have them, and their pages by headings.

    The evidence of a host is counted per slot before it is sent, so that a host with many pages costs its slots alone.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, tuple[int, int]] = {}
            for host, tokens, digests, heading, wrapper in zip(*(c.to_pylist() for c in batch.columns)):
                for number, (low, high) in evidence(matcher(wrapper), tokens.split(), digests).items():
                    key = host, number, heading
                    before = seen.get(key, (low, high))
                    seen[key] = min(before[0], low), max(before[1], high)
            if seen:
                columns = list(zip(*[(*key, *ends) for key, ends in seen.items()]))
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "number", "heading", "low", "high"]
                )

    joined = streams.join(wrappers, "host").select("host", "tokens", "digests", "heading", "wrapper")
    seen = joined.mapInArrow(match, "host string, number int, heading bigint, low bigint, high bigint")
    per_heading = seen.groupBy("host", "number", "heading").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    per_slot = per_heading.groupBy("host", "number").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n")
    )
    fixed = per_slot.where("low = high").groupBy("host")
    return fixed.agg(F.collect_list(F.struct("number", "n")).alias("constant"))


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: (page_id, url, host, text, n_chars).

    Null and empty html give an empty text. Pages without a host in their URL are treated as of one host. Repeated
    rows are pages of their own, but copies of a page, and pages with the same headings, count once when constant texts
    are told. A page with much text is one row like any other. Other columns are not read. An empty table gives no rows.
    What is known of a host is joined to its pages; Spark broadcasts it while its stored size is below the threshold, and
    otherwise splits the pages of a hot host at run time.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
        F.col(html_col).alias("html"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, wrapper, constant in zip(*(c.to_pylist() for c in batch.columns)):
                tree, counts = json.loads(wrapper), {c["number"]: c["n"] for c in constant or ()}
                free = free_zones(tree)
                template = template_slots(tree, matcher(wrapper), counts, free)
                # only hosts with template slots need their wrapper again
                out.append((host, wrapper if template else None, container_of(tree, free, template), sorted(free), sorted(template)))
            if out:
                kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["host", "wrapper", "container", "free", "template"]
                )

    streams = freeze(page_streams(rows), "page-streams")
    wrappers = infer_wrappers(streams)
    judged = wrappers.join(constant_slots(streams, wrappers), "host", "left").select("host", "wrapper", "constant")
    known = freeze(
        judged.mapInArrow(judge, "host string, wrapper string, container string, free array<string>, template array<int>"), "hosts"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, wrapper, container, free, template in zip(*(c.to_pylist() for c in batch.columns[3:])):
                found = matcher(wrapper) if wrapper else None
                texts.append(main_text(page, container or "", frozenset(free or ()), found, set(template or ())) if page else "")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(texts, pa.string())], ["page_id", "url", "host", "text"]
            )

    joined = rows.join(known, "host", "left").select(
        "page_id", "url", "host", "html", "wrapper", "container", "free", "template"
    )
    kinds = dict(rows.dtypes)
    out = joined.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
