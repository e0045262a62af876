"""Candidate fields from HTML, one Arrow batch at a time.

Only the tag tree needs Python; choosing among candidates, trimming, cutting and
joining are Spark expressions on the result (see `operators.pages`).
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

Fields = Mapping[str, Sequence[tuple[str, str]]]

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))
_BLOCK = frozenset("address article aside blockquote div dl dd dt footer form h1 h2 h3 h4 h5 h6 "
                   "header li main nav ol p section table tr ul".split())
_STEP = re.compile(r"([a-z][a-z0-9]*)?((?:\.[\w-]+|\[[^\]]+\])*)$", re.I)
_TEST = re.compile(r"\.([\w-]+)|\[([\w-]+)(?:([~*]?=)['\"]?([^'\"\]]*)['\"]?)?\]")


class Node:
    __slots__ = ("tag", "attrs", "parent", "parts")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []

    def events(self, hidden: frozenset = frozenset()) -> Iterator[tuple[str, "Node | str"]]:
        """("text", string), ("open", node) and ("close", node) of all below, in page order.

        The walk keeps its own stack, so a page may nest as deep as it likes. Elements of
        the `hidden` tags are passed over with all they hold.
        """
        stack = [(self, iter(self.parts))]
        while stack:
            node, rest = stack[-1]
            for part in rest:
                if isinstance(part, str):
                    yield "text", part
                elif part.tag not in hidden:
                    yield "open", part
                    stack.append((part, iter(part.parts)))
                    break
            else:
                stack.pop()
                if stack:
                    yield "close", node

    def walk(self) -> Iterator["Node"]:
        return (part for kind, part in self.events() if kind == "open")

    def strings(self) -> Iterator[str]:
        return (part for kind, part in self.events(_HIDDEN) if kind == "text")

    def visible(self) -> Iterator[str]:
        """Text as a browser lays it out: collapsed spaces, line breaks around blocks."""
        for kind, part in self.events(_HIDDEN):
            if kind == "text":
                yield re.sub(r"[ \t\r\n\f]+", " ", part)
            elif part.tag == "br":
                yield "\n" if kind == "open" else ""
            else:
                yield "\n\n" if part.tag == "p" else "\n" if part.tag in _BLOCK else ""


class _Tree(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("", {}, None)
        self.open = Counter()
        self.feed(html)
        self.close()

    def parse_marked_section(self, i, report=1):
        """Declarations such as `<![if x]>` hold no text; the base class refuses unknown ones."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _close(self, tags, barrier=()):
        if not any(self.open[t] for t in tags):  # a stray end doesn't climb the whole tree
            return
        node = self.top
        while node.parent is not None and node.tag not in tags and node.tag not in barrier:
            node = node.parent
        if node.tag in tags:
            while self.top is not node.parent:
                self.open[self.top.tag] -= 1
                self.top = self.top.parent

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._close(("p",), _BLOCK - {"p"})
        if tag == "li":
            self._close(("li",), ("ul", "ol"))
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.top)
        self.top.parts.append(node)
        if tag not in _VOID:
            self.top = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.top = self.top.parent
            self.open[tag] -= 1

    def handle_endtag(self, tag):
        self._close((tag,))

    def handle_data(self, data):
        self.top.parts.append(data)


def _compile(selector: str):
    """`tag.class[attr=value] descendant, other` to alternatives of (tag, tests) steps."""
    alternatives = []
    for alternative in selector.split(","):
        steps = []
        for text in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", alternative):
            step = _STEP.match(text)
            if step is None:
                raise ValueError(f"unsupported selector: {selector}")
            tests = [("class", "~=", c) if c else (a, op, v) for c, a, op, v in _TEST.findall(step[2])]
            steps.append(((step[1] or "").lower(), tests))
        alternatives.append(steps)
    return alternatives


def _fits(node: Node, step) -> bool:
    tag, tests = step
    if tag and node.tag != tag:
        return False
    for attr, op, value in tests:
        held = node.attrs.get(attr)
        if held is None or (op == "=" and held != value) or (op == "*=" and value not in held) \
                or (op == "~=" and value not in held.split()):
            return False
    return True


def _under(node: Node, scope: Node, steps) -> bool:
    if not _fits(node, steps[-1]):
        return False
    up, left = node.parent, len(steps) - 2
    while left >= 0 and up is not None and up is not scope:
        if _fits(up, steps[left]):
            left -= 1
        up = up.parent
    return left < 0


def _select(scope: Node, alternatives) -> Iterator[Node]:
    return (n for n in scope.walk() if any(_under(n, scope, steps) for steps in alternatives))


def _read(node: Node, what: str):
    if what == "text":
        return "".join(filter(None, map(str.strip, node.strings())))
    if what == "spaced":
        return " ".join(filter(None, map(str.strip, node.strings())))
    if what == "visible":
        return re.sub(r" ?\n[ \n]*", lambda m: "\n\n" if m[0].count("\n") > 1 else "\n",
                      "".join(node.visible())).strip()
    return node.attrs.get(what)


def html_fields(html: Column | str, groups: Mapping[str, tuple[Sequence[str], Fields]]) -> Column:
    """`struct<group: array<struct<field: array<string>, …>>, …, error: string>` from one parse per page.

    A page that can't be read gives no items and says why in `error`, which is null for all others.

    A group is `(items, fields)`. `items` lists selectors of a repeated element; the
    first that occurs is used, and with none listed the page itself is the one item. A
    field is a list of candidates `(selector, what)`, and its array holds one value per
    candidate: null where no element fits, else what the first fitting element holds.
    `what` is `text`, `spaced` (text parts joined by a space), `visible` (text as laid
    out) or an attribute name. The selector `*selector` puts the values of all fitting
    elements in the array instead, and `.` is the item itself.
    """
    plan = {
        group: ([_compile(s) for s in items], {
            name: [(s.startswith("*"), None if s == "." else _compile(s.lstrip("*")), what) for s, what in candidates]
            for name, candidates in fields.items()
        })
        for group, (items, fields) in groups.items()
    }

    def values(item: Node, candidates) -> list:
        out = []
        for every, selector, what in candidates:
            nodes = iter((item,)) if selector is None else _select(item, selector)
            if every:
                out.extend(_read(n, what) for n in nodes)
            else:
                node = next(nodes, None)
                out.append(None if node is None else _read(node, what))
        return out

    def page(text: str | None) -> list:
        root = _Tree(text or "").root
        out = []
        for items, fields in plan.values():
            found = [root] if not items else next(filter(None, (list(_select(root, s)) for s in items)), [])
            out.append([{name: values(item, c) for name, c in fields.items()} for item in found])
        return out

    def safe(text: str | None) -> list:
        try:
            return [*page(text), None]
        except Exception as error:  # a page that can't be read costs its own fields only
            return [*([] for _ in plan), f"{type(error).__name__}: {error}"]

    def batch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([safe(t) for t in texts], columns=[*plan, "error"])

    schema = ", ".join(
        f"{group}: array<struct<" + ", ".join(f"{name}: array<string>" for name in fields) + ">>"
        for group, (_, fields) in groups.items()) + ", error: string"
    # Marked so that no filter inferred for a later explode parses every page a second time.
    return F.pandas_udf(batch, schema).asNondeterministic()(F.col(html) if isinstance(html, str) else html)


# Workers get this small module with the function, so it need not be installed on them.

cloudpickle.register_pickle_by_value(sys.modules[__name__])
