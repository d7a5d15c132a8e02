"""Blocks of a web page: the leaf sequence a labeller reads, with each block's tag path, words and text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Element names with a meaning of their own.
SILENT = {"script", "style", "noscript", "template", "svg", "head", "title", "textarea", "select", "option", "iframe",
          "object", "canvas", "annotation", "annotation-xml"}
#: What can stand in a head; any other start tag, and text, ends an open one.
HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title", "head"}
#: In these a closing slash ends an element, as in XML.
FOREIGN = {"svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "img", "br", "input",
          # formulas are read where they stand; their annotations are not shown
          "math", "maction", "menclose", "merror", "mfenced", "mfrac", "mglyph", "mi", "mlabeledtr", "mmultiscripts", "mn", "mo",
          "mover", "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup",
          "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover", "none", "semantics", "annotation", "annotation-xml"}
#: A tag of the first group ends an open one of the second, up to the nearest of the third.
ENDS = [({"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "nav", "aside",
          "header", "footer", "main", "form", "pre", "blockquote", "figure", "hr", "address", "fieldset", "details"},
         {"p"}, {"article", "section", "div", "td", "th", "li", "body", "aside", "nav", "main", "header", "footer",
                 "blockquote", "form", "button"}),
        ({"li"}, {"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
        ({"tr"}, {"tr", "td", "th"}, {"table"}), ({"td", "th"}, {"td", "th"}, {"tr", "table"})]

# Attributes end at the first angle bracket outside quotes; as in browsers, a quote opens a value only after ``=``. Tags
# whose quoted values hold no brackets are read by the pattern alone, others are carried on by ``_tag``.
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<![^<>]*+>|<\?[^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)"
                    r"((?:[^<>\"'=]++|=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+')|=(?!\s*[\"']))*+)(>)?", re.S)
OUTSIDE = re.compile(r"[^<>\"'=]*+(?:=\s*+)?+")
MARK = re.compile(r"\b(?:class|id|role)\s*=\s*\Z", re.I)
CUT_OFF = re.compile(r"<[/!a-zA-Z][^<>]*+\Z")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Attributes that end with an unquoted value; a slash at its end belongs to it.
UNQUOTED = re.compile(r"=\s*[^\s\"'=]*/\Z")
SPACE = re.compile(r"\s+")


@dataclass(slots=True, eq=False, repr=False)
class Step:
    """An open element as its name and marks, ``div.ad``, and the step around it: blocks share what is above them."""

    label: str
    above: Step | None
    depth: int


@dataclass(slots=True)
class Block:
    at: Step | None
    text: str
    links: float  # share of the text inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Labels of the open elements from the outside in."""
        labels, step = [], self.at
        while step:
            labels.append(step.label)
            step = step.above
        return tuple(reversed(labels))


class Open:
    """The open elements, with the places that are asked for, so that no question walks over all of them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Step | None]] = []
        self.places: dict[str, list[int]] = {}
        self.breaking: list[int] = []  # places of elements that are not inline
        self.silent: list[int] = []
        self.foreign = 0

    def __len__(self) -> int:
        return len(self.stack)

    @property
    def step(self) -> Step | None:
        return self.stack[-1][1] if self.stack else None

    def last(self, *names: str) -> int:
        """Place of the innermost element of these names, -1 if there is none."""
        return max((held[-1] for n in names if (held := self.places.get(n))), default=-1)

    def push(self, name: str, label: str) -> None:
        at, above = len(self.stack), self.step
        shown = name not in INLINE or name == "a"
        self.stack.append((name, Step(label, above, above.depth + 1 if above else 1) if shown else above))
        self.places.setdefault(name, []).append(at)
        if name not in INLINE:
            self.breaking.append(at)
        if name in SILENT:
            self.silent.append(at)
        self.foreign += name in FOREIGN

    def cut(self, to: int) -> None:
        for name, _ in self.stack[to:]:
            self.places[name].pop()
            self.foreign -= name in FOREIGN
        del self.stack[to:]
        for places in (self.breaking, self.silent):
            while places and places[-1] >= to:
                places.pop()


def _marks(attributes: str) -> str:
    names = [n for m in NAMED.finditer(attributes) for n in re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower()) if n]
    return "".join("." + n for n in names)


def _tag(page: str, start: int, at: int, lasts: dict[str, int], dead: set[int]) -> tuple[str, int] | None:
    """Attributes of a tag that is read up to ``at``, and the place after its ``>``; None if it is no tag.

    Quoted values with brackets are left out of the attributes unless they hold marks. ``lasts`` has the last place of
    each quote sign: a quote that nothing closes is a character like others. ``dead`` has the ends of quoted values from
    which no tag is completed, so that no part of a page is read more often than twice.
    """
    parts, ends = [page[start:at]], []
    while at not in dead:
        ahead = OUTSIDE.match(page, at)
        parts.append(ahead[0])
        at = ahead.end()
        sign = page[at:at + 1]
        if sign == ">":
            return "".join(parts), at + 1
        if sign in ("", "<"):
            break
        if sign in lasts and "=" in ahead[0] and at < lasts[sign]:
            close = page.index(sign, at + 1) + 1
            value = page[at:close]
            parts.append(value if "<" not in value and ">" not in value or MARK.search(parts[-2][-20:] + parts[-1]) else "''")
            at = close
            ends.append(at)
        elif sign in lasts:
            parts.append(sign)
            at += 1
    dead.update(ends)
    return None


def blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order. Elements left open end with their parents; stray closing tags are passed over."""
    found: list[Block] = []
    stack = Open()
    parts: list[str] = []
    linked = at = 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                found.append(Block(stack.step, text, min(1.0, linked / max(1, sum(map(len, parts))))))
            parts.clear()
            linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if stack and stack.stack[-1][0] == "head" and raw.strip():
            close(len(stack) - 1)
        if raw and not stack.silent:
            parts.append(raw)
            if stack.places.get("a"):
                linked += len(raw)

    def close(to: int) -> None:
        """Ends all elements from place ``to`` of the stack."""
        # What is inside a silent element breaks no block around it.
        shown = stack.silent[0] if stack.silent else len(stack)
        if any(name not in INLINE for name, _ in stack.stack[to:shown + 1]):
            flush()
        stack.cut(to)

    def end_head(name: str) -> None:
        """Ends an open head, unless the tag is inside a silent element of it; ``body`` ends it in any case."""
        place = stack.last("head")
        if place >= 0 and (name == "body" or stack.silent[-1] == place):
            close(place)

    lasts, dead = {sign: page.rfind(sign) for sign in "\"'"}, set()
    match = MARKUP.search(page)
    while match:
        name, attributes, end = (match[2] or "").lower(), match[3], match.end()
        if name and not match[4]:
            tag = _tag(page, match.start(3), end, lasts, dead)
            if tag is None:
                match = MARKUP.search(page, match.start() + 1)
                continue
            attributes, end = tag
        take(page[at:match.start()])
        at = end
        if name and match[1]:
            place = stack.last(name)
            if place >= 0 and (name in SILENT or name not in INLINE or not stack.breaking or stack.breaking[-1] < place):
                close(place)
            elif name == "p" or name not in INLINE:
                flush()
        elif name:
            if stack.silent and name not in HEAD:
                end_head(name)
            for starts, ended, walls in ENDS:
                if name in starts and (place := stack.last(*ended)) > stack.last(*walls):
                    close(place)
            if name not in INLINE and not stack.silent:
                flush()
            elif name == "br":
                take(" ")
            if (stack.foreign or name in FOREIGN) and attributes.endswith("/") and not UNQUOTED.search(attributes):
                pass
            elif name in ("script", "style", "textarea", "title"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif name not in VOID:  # as in browsers, a closing slash changes nothing elsewhere
                stack.push(name, name + _marks(attributes))
        match = MARKUP.search(page, at)
    take(CUT_OFF.sub("", page[at:]))  # a page can end inside a tag
    flush()
    return found
