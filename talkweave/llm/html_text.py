"""Layout-aware text of HTML pages.

A tokenizer feeds a tree builder, which opens and closes tags that authors may leave out (html, head, body, p, li, dt, dd,
option, table sections, rows and cells). A renderer walks the tree without recursion and emits the visible text: blocks stand
on lines of their own, paragraphs apart by an empty line, list items behind a bullet or number and indented, table
cells in aligned columns, preformatted text as it is, form fields as the text that they show. Invisible are head, scripts and the like, and elements that an
attribute, a style or a rule of a style sheet hides: of the rules for an element the one that browsers
prefer. Rules are known by tags, classes, ids and attributes, of the element, its parents and ancestors; others, of states or siblings, don't count. What is
hidden by display stays so with all that is in it; visibility can be given back inside. Rules in media blocks count where the block applies to a screen of 1280 x 800 pixels; blocks with a condition
that isn't known don't count. Of SVG the text elements and foreign objects are visible, of MathML all but annotations.

Elements may be nested to any depth, and the work is linear in a page's length. Only the layout is bounded: lists beyond INDENTS levels are not indented
further, of tables nested beyond NESTED levels the cells stand on lines of their own, and REACHING cells of several rows at a time shift the
columns of further rows; no text is lost.

Results for edge cases: null html, or html without visible text, gives an empty string. An unclosed comment or tag
at the end is dropped. Rows are independent, so rows that repeat get equal texts; an empty table gives an empty one; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, table

# Elements by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes title object canvas audio video datalist meta link base param source track area annotation annotation-xml mphantom".split())
# Where svg draws text and where it never does; HTML elements that end SVG and MathML, and where they may stand in them.
SVG_TEXT = frozenset("text foreignobject".split())
SVG_UNSEEN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
POINT = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
HEAD = frozenset("title meta link base style script noscript template".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu".split())
BLOCK = SPACED | frozenset("html body div article section nav aside header footer main address form li dt dd tr caption thead tbody tfoot figcaption details summary legend center dialog hgroup search option optgroup".split())
SECTION = frozenset(("thead", "tbody", "tfoot"))
CELL = frozenset(("td", "th"))
# Which open elements a start tag closes, and the elements that keep them from being seen.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table", *SECTION}),
    "thead": ({*SECTION, "tr", "td", "th", "caption"}, {"table"}), "tbody": ({*SECTION, "tr", "td", "th", "caption"}, {"table"}), "tfoot": ({*SECTION, "tr", "td", "th", "caption"}, {"table"}),
}
SCOPE = frozenset(("html", "table", "td", "th", "caption", "template", "object", "button"))

#: Levels of lists that are indented, and of tables whose cells are aligned.
INDENTS, NESTED = 32, 16
#: Cells that keep columns of further rows free at the same time.
REACHING = 1000
#: The largest spans of a cell, as in browsers.
SPANS = {"colspan": 1000, "rowspan": 65534}

# A tag as the standard's tokenizer reads it: names end at space, slash, > and =; a value is quoted, or goes to the next space or >.
_W, _VALUE = r"[ \t\n\f\r]", r"\"[^\"]*+\"|'[^']*+'|(?=>)|(?![\"'])[^ \t\n\f\r>]++"
TAG = re.compile(rf"<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:(?:{_W}|/)++|[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:{_W}*+={_W}*+(?:{_VALUE})|(?!{_W}*+=)))*+)>")
ATTRIBUTE = re.compile(rf"([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:{_W}*+={_W}*+({_VALUE}|$))?+")
END = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.I | re.A) for tag in RAW}
COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.S)
# Types of input that show no value of theirs.
BLANK = frozenset("hidden checkbox radio file image password color range".split())
SHEET = re.compile(r"\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|[{};]", re.S)
SHOWN = re.compile(r"\s*(display|visibility)\s*:\s*([a-z-]+(?:\s+[a-z-]+)*)\s*(!\s*important)?\s*", re.I)
COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[[^\]]*\])*)")
PIECE = re.compile(r"([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([\w-]+))\s*)?\]")
PART = re.compile(r">|(?:\[[^\]]*\]|[^\s>\[])+")
# A screen, for media blocks.
SIZES = {"width": 1280, "height": 800}
UNITS = {"px": 1, "em": 16, "rem": 16, "pt": 4 / 3, "": 1}
FEATURES = {"orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference"}
MEDIA = re.compile(r"(?:(not|only)\s+)?([a-z]+)", re.I)
BOUND = re.compile(r"(min|max)-(width|height)\s*:\s*([0-9]*\.?[0-9]+)\s*(px|em|rem|pt|)")
RANGE = re.compile(r"(width|height)\s*([<>]=?|=)\s*([0-9]*\.?[0-9]+)\s*(px|em|rem|pt|)")
SPACE = re.compile(r"[ \t\n\r\f]+")


def _feature(x: str) -> bool | None:
    """Whether a media condition holds on the screen; None if it isn't known."""
    x = x.strip().lower()
    if m := BOUND.fullmatch(x):
        size = float(m[3]) * UNITS[m[4]]
        return SIZES[m[2]] >= size if m[1] == "min" else SIZES[m[2]] <= size
    if m := RANGE.fullmatch(x):
        have, size = SIZES[m[1]], float(m[3]) * UNITS[m[4]]
        return {"<": have < size, "<=": have <= size, ">": have > size, ">=": have >= size, "=": have == size}[m[2]]
    name, _, value = map(str.strip, x.partition(":"))
    return FEATURES[name] == (value or FEATURES[name]) if name in FEATURES else None


class Compound:
    """What one element must be: keys (a tag, .class or #id) and attributes, each with a value or any."""

    def __init__(self, keys: list[str], attrs: list[tuple[str, str | None]], child: bool):
        self.keys, self.attrs, self.child = keys, attrs, child  # child: directly below the one before

    def fits(self, node: Node, keys: set[str]) -> bool:
        return keys.issuperset(self.keys) and all(k in node.attrs and v in (None, node.attrs[k]) for k, v in self.attrs)


def selector(text: str) -> list[Compound] | None:
    """The compounds of a selector, the element's own last; None if it isn't known."""
    out, child = [], False
    for part in PART.findall(text):
        if part == ">":
            if child or not out:
                return None
            child = True
            continue
        m = COMPOUND.fullmatch(part)
        pieces = list(PIECE.finditer(m[2])) if m else []
        if not m or "".join(x[0] for x in pieces) != m[2]:
            return None
        keys = [m[1].lower()] if m[1] and m[1] != "*" else []
        keys += [x[1] + x[2] for x in pieces if x[1]]
        out.append(Compound(keys, [(x[3].lower(), next((v for v in x.groups()[3:] if v is not None), None)) for x in pieces if x[3]], child))
        child = False
    return out if out and not child else None


def _keys(node: Node) -> set[str]:
    a = node.attrs
    return {node.tag, "#" + a.get("id", ""), *("." + c for c in a.get("class", "").split())}


class Path:
    """The open elements, the outermost first, and how many of them have each key."""

    def __init__(self) -> None:
        self.nodes: list[tuple[Node, set[str]]] = []
        self.count: Counter[str] = Counter()

    def enter(self, node: Node, keys: set[str]) -> None:
        self.nodes.append((node, keys))
        self.count.update(keys)

    def leave(self) -> None:
        self.count.subtract(self.nodes.pop()[1])

    def fits(self, parts: list[Compound], node: Node, keys: set[str]) -> bool:
        *above, own = parts
        if not own.fits(node, keys):
            return False
        if not above:
            return True
        if not all(self.count[k] > 0 for x in above for k in x.keys):
            return False
        if len(above) == 1 and not own.child and len(above[0].keys) == 1 and not above[0].attrs:
            return True
        ever, just = [False] * len(above), [False] * len(above)  # whether the parts up to each fit, ending anywhere above or right here
        for x, x_keys in self.nodes:
            just = [c.fits(x, x_keys) and (i == 0 or (just if c.child else ever)[i - 1]) for i, c in enumerate(above)]
            ever = [a or b for a, b in zip(ever, just)]
        return (just if own.child else ever)[-1]


def _without_comments(sheet: str) -> str:
    """An unclosed comment takes the rest."""
    out, at = [], 0
    while (begin := sheet.find("/*", at)) >= 0:
        out.append(sheet[at:begin])
        end = sheet.find("*/", begin + 2)
        at = end + 2 if end >= 0 else len(sheet)
    return "".join([*out, sheet[at:]])


def _on_screen(media: str) -> bool:
    """Whether a list of media queries applies to the screen."""
    for query in media.split(","):
        kind, *conditions = re.split(r"\s+and\b\s*", query.strip(), flags=re.I)
        negated, holds = False, True
        if m := MEDIA.fullmatch(kind):
            negated, holds = (m[1] or "").lower() == "not", m[2].lower() in ("screen", "all")
        elif kind[:3].lower() == "not" and not conditions:
            negated, conditions = True, [kind[3:].strip()]
        elif kind:
            conditions.insert(0, kind)
        known = [_feature(c[1:-1]) if c[:1] == "(" and c[-1:] == ")" else None for c in conditions]
        if None not in known and (holds and all(known)) != negated:
            return True
    return False


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def _attributes(text: str) -> dict[str, str]:
    if not text.strip(" \t\n\r\f/"):
        return {}
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return out


class Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.stack = [self.root]
        self.names = ["html"]
        self.places: dict[str, list[int]] = {}  # where the open elements of each name stand in the stack
        self.simple: dict[str, dict[str, Rule]] = {}  # of selectors of one key, by key and property the rule that wins
        self.rest: dict[str, list[tuple[list[Compound], str, Rule]]] = {}  # other selectors and rules, by a key of the element ("" if it has none)
        self.rules = 0

    def push(self, tag: str, attrs: dict[str, str] | None = None) -> None:
        node = Node(tag, attrs)
        self.stack[-1].kids.append(node)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)
        self.names.append(tag)

    def pop_to(self, at: int) -> None:
        for name in self.names[at:]:
            self.places[name].pop()
        del self.stack[at:], self.names[at:]

    def open(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def last(self, tags: Iterable[str]) -> int:
        """Where the innermost open element of these stands; 0 if none."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=0)

    def find(self, wanted: set[str] | frozenset[str], stop: set[str] | frozenset[str], outermost: bool = False) -> int:
        """Where the nearest (or outermost) open element of these stands above any of ``stop``; 0 if none."""
        least, found = self.last(stop), self.last(wanted)
        if found < least or not outermost:
            return found if found >= least else 0
        return min(at[bisect_right(at, least)] for t in wanted if (at := self.places.get(t)) and at[-1] > least)

    def body(self) -> None:
        if len(self.names) == 2 and self.names[1] == "head":
            self.pop_to(1)
        if len(self.names) == 1:
            self.push("body")

    def text(self, text: str) -> None:
        if len(self.names) < 3 and (len(self.names) == 1 or self.names[1] == "head"):
            if not text.strip():
                return
            self.body()
        if self.names[-1] in ("table", "tr", *SECTION) and not text.strip():
            return
        self.stack[-1].kids.append(html.unescape(text) if "&" in text else text)

    def start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        if tag == "html":
            self.root.attrs |= {k: v for k, v in attrs.items() if k not in self.root.attrs}
            return
        if tag == "body":
            self.body()
            if len(self.stack) > 1 and self.names[1] == "body":
                self.stack[1].attrs |= attrs
            return
        if len(self.names) == 1 or self.names == ["html", "head"]:
            if tag == "head":
                if len(self.names) == 1:
                    self.push("head", attrs)
                return
            if tag in HEAD:
                if len(self.names) == 1:
                    self.push("head")
            else:
                self.body()
        elif tag == "head":
            return
        if tag in BREAKOUT and (self.open("svg") or self.open("math")):
            while self.foreign():
                self.pop_to(len(self.stack) - 1)
        if tag in CLOSES:
            wanted, stop = CLOSES[tag]
            if at := self.find(wanted, stop, outermost=tag in ("tr", *SECTION)):
                self.pop_to(at)
        if tag in BLOCK and self.open("p") and (at := self.find({"p"}, SCOPE)):
            self.pop_to(at)
        if tag in CELL and self.names[-1] != "tr" and self.open("table"):
            self.start("tr", {}, False)
        if tag == "tr" and self.names[-1] == "table":
            self.push("tbody")
        if tag in VOID or closed and tag in ("svg", "math"):
            self.stack[-1].kids.append(Node(tag, attrs))
        else:
            self.push(tag, attrs)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.start("br", {}, False)
        elif tag == "p" and not self.open("p"):
            self.body()
            self.stack[-1].kids.append(Node("p"))
        elif self.open(tag):
            at = self.find({tag}, {"table"} if tag not in ("table", *SECTION) else frozenset())
            if at and self.names[at] == tag:
                self.pop_to(at)

    def foreign(self) -> bool:
        """Whether what comes next stands in SVG or MathML, where any tag can close itself."""
        return self.last(("svg", "math")) > self.last(POINT)

    def declare(self, selectors: list[list[Compound]], declaration: str) -> None:
        if m := SHOWN.fullmatch(declaration):
            name, hides = m[1].lower(), _hides(m[1], m[2])
            self.rules += 1
            for parts in selectors:
                keys = [k for c in parts for k in c.keys]
                weight = sum(k[0] == "#" for k in keys), sum(k[0] == "." for k in keys) + sum(len(c.attrs) for c in parts), sum(k[0] not in ".#" for k in keys)
                rule = (bool(m[3]), weight, self.rules, hides)
                if len(keys) == 1 == len(parts) and not parts[0].attrs:
                    won = self.simple.setdefault(keys[0], {})
                    won[name] = max(won.get(name, rule), rule, key=lambda r: r[:3])
                else:
                    self.rest.setdefault(max(parts[-1].keys, key=lambda k: (k[0] == "#", k[0] == "."), default=""), []).append((parts, name, rule))

    def styles(self, sheet: str, media: str) -> None:
        if not _on_screen(media):
            return
        sheet = _without_comments(sheet)
        blocks: list[list[list[Compound]] | None] = [None]  # the known selectors of each open block; None: a block of rules that count
        at = 0
        for m in SHEET.finditer(sheet):
            if m[0] not in "{};":
                continue
            part, at, inside = sheet[at : m.start()].strip(), m.end(), blocks[-1]
            if m[0] == "{":
                if part[:1] == "@":
                    name, rest = re.match(r"@([\w-]*)(.*)", part.lower(), re.S).groups()
                    counts = _on_screen(rest) if name == "media" else name == "layer" or name == "supports" and rest.split()[:1] != ["not"]
                    blocks.append(inside if counts else [])
                else:
                    blocks.append([x for x in map(selector, part.split(",")) if x] if inside is None else [])
                continue
            if inside:
                self.declare(inside, part)
            if m[0] == "}" and len(blocks) > 1:
                blocks.pop()
        if blocks[-1]:
            self.declare(blocks[-1], sheet[at:])


#: important, weight, place in the sheets, and whether it hides (None: as the parent is).
Rule = tuple[bool, tuple[int, int, int], int, bool | None]


def _hides(name: str, value: str) -> bool | None:
    value = value.lower()
    if name.lower() == "display":
        return value == "none"
    return True if value in ("hidden", "collapse") else False if value in ("visible", "initial") else None


def build(page: str) -> Builder:
    b = Builder()
    at, n = 0, len(page)
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            b.text(page[at:])
            break
        if begin > at:
            b.text(page[at:begin])
        after = page[begin + 1 : begin + 2]
        if after == "!" or after == "?":
            if page.startswith("<!--", begin):
                m = COMMENT.match(page, begin)
                at = m.end() if m else n
            else:
                end = page.find(">", begin)
                at = end + 1 if end >= 0 else n
            continue
        if m := TAG.match(page, begin):
            tag = m[2].lower()
            at = m.end()
            if m[1]:
                b.end(tag)
                continue
            attrs, closed = _attributes(m[3]), m[3].endswith("/")
            if closed and tag not in BREAKOUT and b.foreign():
                b.stack[-1].kids.append(Node(tag, attrs))
                continue
            b.start(tag, attrs, closed)
            if tag in RAW:
                end = m.start() if (m := END[tag].search(page, at)) else -1
                raw = page[at : end if end >= 0 else n]
                if tag == "style":
                    b.styles(raw, attrs.get("media", ""))
                elif tag == "textarea":
                    b.text(raw)
                b.end(tag)
                if end < 0:
                    break
                close = page.find(">", end)
                at = close + 1 if close >= 0 else n
            continue
        first = page[begin + 2 : begin + 3] if after == "/" else after
        if first.isascii() and first.isalpha():
            break  # an unclosed tag takes the rest
        if after == "/" and first:  # a comment
            end = page.find(">", begin)
            at = end + 1 if end >= 0 else n
        else:
            b.text("<")
            at = begin + 1
    return b


def _seen(node: Node, b: Builder, path: Path, keys: set[str], drawn: bool) -> tuple[bool, bool | None]:
    """Whether the element is there at all, and whether it is visible (None: as its parent is)."""
    a = node.attrs
    if node.tag in UNSEEN or node.tag == "dialog" and "open" not in a:
        return False, None
    won: dict[str, tuple] = {"display": (False, (-1,), 0, "hidden" in a or drawn and a.get("display") == "none"), "visibility": (False, (-1,), 0, _hides("", a["visibility"]) if drawn and "visibility" in a else None)}
    if b.rules:
        found = [x for k in keys if k in b.simple for x in b.simple[k].items()]
        if b.rest:
            found += [(name, rule) for k in ("", *keys) if k in b.rest for parts, name, rule in b.rest[k] if path.fits(parts, node, keys)]
        for name, rule in found:
            won[name] = max(won[name], rule, key=lambda r: r[:3])
    if "style" in a:
        for place, x in enumerate(_without_comments(a["style"]).split(";")):
            if m := SHOWN.fullmatch(x):
                name = m[1].lower()
                # before all sheets, but for what is important in them
                won[name] = max(won[name], (bool(m[3]), (1 << 30,), place, _hides(name, m[2])), key=lambda r: r[:3])
    hides = won["visibility"][3]
    return not won["display"][3], None if hides is None else not hides


class Out:
    """Text under way: lines, with empty lines between spaced blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.room = False  # a space is due before the next word
        self.gap = 0  # empty lines due before the next line
        self.lead: list[tuple[str, str]] = []  # (first, further) line starts of open list items
        self.fresh: list[bool] = []

    def inline(self, text: str) -> None:
        words = SPACE.sub(" ", text)
        if words[:1] == " ":
            self.room = bool(self.line)
            words = words[1:]
        if not words:
            return
        if self.room and self.line:
            self.line.append(" ")
        self.room = words[-1] == " "
        self.line.append(words[:-1] if self.room else words)

    def end_line(self, always: bool = False) -> None:
        if self.line or always:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            lead = ""
            for i, (first, further) in enumerate(self.lead[:INDENTS]):
                lead += first if self.fresh[i] else further
                self.fresh[i] = False
            self.lines.append((lead + "".join(self.line)).rstrip() if not always or self.line else "")
            self.line = []
        self.room = False

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.lines:
            self.gap = 1

    def whole(self, text: str) -> None:
        for x in text.split("\n"):
            self.line = [x] if x else []
            self.end_line(always=True)

    def value(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _table(rows: list[list[tuple[str, int, int]]]) -> str:
    """Cells as (text, colspan, rowspan), in columns two spaces apart."""
    placed: list[list[tuple[int, list[str]]]] = []
    wide: dict[int, int] = {}
    busy: list[tuple[int, int, int]] = []  # cells that reach further rows: first column, column after, row after
    for r, row in enumerate(rows):
        busy = [x for x in busy if x[2] > r]
        reach, line, c, k = [], [], 0, 0
        for text, cols, down in row:
            while k < len(busy) and busy[k][0] <= c:
                c = max(c, busy[k][1])
                k += 1
            lines = text.split("\n")
            line.append((c, lines))
            if cols == 1:
                wide[c] = max(wide.get(c, 0), *map(len, lines))
            after = min(r + down, len(rows))
            if after > r + 1:
                if reach and reach[-1][1:] == (c, after):
                    reach[-1] = reach[-1][0], c + cols, after
                else:
                    reach.append((c, c + cols, after))
            c += cols
        placed.append(line)
        if reach:
            busy = sorted(busy + reach)[:REACHING]
    used = sorted(c for c, n in wide.items() if n)
    starts = [0, *accumulate(wide[c] + 2 for c in used)]
    out = []
    for cells in placed:
        for k in range(max((len(x) for _, x in cells), default=0)):
            line, size = [], 0
            for c, lines in cells:
                if k < len(lines) and lines[k]:
                    start = starts[bisect_left(used, c)]
                    gap = 2 if size and size > start - 2 else start - size
                    line.append(" " * gap + lines[k])
                    size += gap + len(lines[k])
            out.append("".join(line).rstrip())
    return "\n".join(out)


def _span(node: Node, name: str) -> int:
    v = node.attrs.get(name, "1").strip()
    return min(max(int(v), 1), SPANS[name]) if v.isdecimal() and len(v) < 10 else 1


def render(b: Builder) -> str:
    outs = [Out()]
    tables: list[list[list[tuple[str, int, int]]]] = []
    lists: list[list] = []  # [ordered, next number]
    pre = deep = 0  # deep: open tables that are too deep to be laid out
    svg: list[bool] = []  # for each open svg and each text in it: whether text is drawn
    path = Path()
    todo: list[tuple[bool, Node | str, bool]] = [(True, b.root, True)]
    while todo:
        enter, node, visible = todo.pop()
        out = outs[-1]
        if isinstance(node, str):
            if svg and not svg[-1] or not visible:
                continue
            if pre:
                first, *more = node.split("\n")
                out.line.append(first)
                for x in more:
                    out.end_line(always=True)
                    out.line = [x] if x else []
            else:
                out.inline(node)
            continue
        tag = node.tag
        if enter:
            keys = _keys(node) if b.rules else set()
            there, own = _seen(node, b, path, keys, bool(svg))
            if not there or svg and tag in SVG_UNSEEN:
                continue
            visible = visible if own is None else own
            if tag == "svg" or svg and tag in SVG_TEXT:
                svg.append(tag != "svg")
                out.room = bool(out.line)
            if tag in VOID and not visible:
                continue
            if tag == "br":
                out.end_line(always=True)
                continue
            if tag == "input":
                if node.attrs.get("type", "").lower() not in BLANK and node.attrs.get("value"):
                    out.room = bool(out.line)
                    out.inline(node.attrs["value"])
                    out.room = True
                continue
            if tag == "hr":
                out.block(True)
                out.inline("---")
                out.block(True)
                continue
            if tag in VOID:
                continue
            if tag in BLOCK:
                out.block(tag in SPACED and not (lists and tag in ("ul", "ol")))
            if tag in ("ul", "ol", "menu"):
                start = node.attrs.get("start", "").strip()
                lists.append([tag == "ol", int(start) if start.isdecimal() and len(start) < 10 else 1])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0]:
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.lead.append((mark, " " * len(mark)))
                out.fresh.append(True)
            elif tag == "dd":
                out.lead.append(("  ", "  "))
                out.fresh.append(True)
            elif tag == "blockquote":
                out.lead.append(("> ", "> "))
                out.fresh.append(True)
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                deep += len(tables) >= NESTED
                if not deep:
                    tables.append([])
            elif deep and tag in CELL:
                out.block(False)
            elif deep and tag == "tr":
                pass
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in CELL and tables:
                outs.append(Out())
            todo.append((False, node, visible))
            if b.rest:
                path.enter(node, keys)
            kids = node.kids
            if tag == "details" and "open" not in node.attrs:
                kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
            elif svg and tag == "switch":
                kids = [k for k in kids if isinstance(k, Node)][:1]
            todo += ((True, k, visible) for k in reversed(kids))
            continue
        if b.rest:
            path.leave()
        if tag == "svg" or svg and tag in SVG_TEXT:
            svg.pop()
            out.room = bool(out.line)
        if tag in CELL and tables and len(outs) > 1 and not deep:
            outs.pop()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((out.value(), _span(node, "colspan"), _span(node, "rowspan")))
            continue
        if tag == "table" and deep:
            deep -= 1
        elif tag == "table":
            text = _table(tables.pop())
            out.end_line()
            if text.strip():
                out.whole(text)
        elif tag == "pre":
            pre -= 1
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
        if tag in BLOCK:
            out.block(tag in SPACED and not (lists and tag in ("ul", "ol")))
        if tag in ("li", "dd", "blockquote") and out.lead:
            out.lead.pop()
            out.fresh.pop()
    return outs[0].value()


def page_text(page: str | None) -> str:
    return render(build(page)) if page else ""


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) for every row."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(page_text, b.column(1).to_pylist()), pa.string())], ["id", "text"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, F.col(html_col).cast("string")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "text", F.length("text").alias("n_chars"))
