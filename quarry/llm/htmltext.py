"""Main text of web pages by the line-block distribution.

1. Strip markup. A page becomes lines: a paragraph, heading, list item or cell
   takes one, and each opening or closing of a container (div, section, ...)
   takes an empty one. Scripts, styles, menus, page headers, footers, sidebars,
   notices, adverts, forms and reader comments are told by their element, role
   or the words of their class and id; they take an empty line at each end,
   whatever is inside.
2. Sum the lengths of the text outside links over ``WINDOW`` lines, for every
   window. Where the sum rises from nothing is a surge, where it falls back to
   nothing a dive. A stretch between a surge and the next dive is kept if one of
   its windows reaches ``LEVEL`` characters (or half the page's highest sum,
   where that is less).
3. Where the page marks its text (article, main or their roles), the same sums
   over all its lines decide, but lines outside the mark count nothing, those
   inside count whole, links too, and containers inside take no line. So the
   surge is at the first line of the mark and the dive after its last, however
   short the paragraphs between are. Articles within a main go before the rest of it unless they hold less than
   half of its text; of several articles those go that hold less than a quarter
   of the longest (cards that point to other pages).

Reading is one pass and linear in the page's length. Character references are
decoded as browsers do; white space inside a block becomes one blank.

Defined cases: null and empty pages, and pages without text, give ""; tags may
be unclosed or nested wrongly; an unclosed comment or script hides the rest, as
in browsers; rows are taken one by one, so repeated pages give repeated rows;
an empty table gives no rows; other columns pass through."""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import free_name, slices, text_batches

WINDOW = 3
LEVEL = 86
#: Text below a class or form is taken after all where a page has no other text
#: and at least this many characters of it lie outside links.
RESCUE = 1_000

# Fixed values of HTML: elements whose content is no text of the page, whose
# content is raw, that have no end tag, that start a new line, and that contain
# other blocks.
_RAW = set("script style title textarea xmp iframe noembed noframes noscript".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_LINE = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption blockquote pre figure figcaption "
            "ul ol dl table thead tbody tfoot br hr address summary details legend option center "
            "hgroup".split())
_CONTAINER = set("html body div section article main aside nav header footer form fieldset dialog "
                 "menu select datalist button template svg math object canvas video audio "
                 "head label".split())
_HEADING = set("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = (_LINE - {"br"}) | _CONTAINER - {"button", "label", "object", "canvas", "video", "audio",
                                             "svg", "math", "select", "datalist", "template"}

# What is no main text: elements, roles and words of class or id.
_ASIDE = set("head nav aside footer header form fieldset dialog menu select datalist button "
             "template svg math object canvas video audio label".split())
_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog "
             "menu menubar toolbar".split())
_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
             "banner cookie cookies consent gdpr notice notices notification alert popup modal "
             "overlay newsletter subscribe subscription signup login sidebar sidenav nav navbar "
             "navigation menu submenu breadcrumb breadcrumbs pagination pager footer header masthead "
             "topbar comment comments commentlist disqus reply replies respond responses share "
             "sharing social related recommended widget widgets toolbar search copyright".split())
_NOT = {"no", "with", "has", "without"}
_OF_TEXT = set("article post entry story content section news blog".split())
_IN_HEAD = set("base link meta".split())
_COMMENTED = set("comment comments commentlist disqus reply replies respond responses".split())
_COMMENT_HEADING = re.compile(
    r"(?:\d+ )?(?:reader |reader's |readers' |user )?(?:comments?|kommentare?|commentaires?|comentarios?)"
    r"(?: ?\(?\d+\)?)?:?|leave a (?:comment|reply)|(?:\d+ )?(?:responses|replies)|join the discussion", re.I)

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+|=[^\s/>=]*+)"""
                        r"""(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)|(?=>)))?""")
_TAG_END = re.compile(r"[\s/]*+>")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}


class _Lines:
    """The lines of one page: text, length outside links, whether within the
    page's own mark of its text, and whether a class or form hides it."""

    def __init__(self):
        self.text: list[str] = []
        self.weight: list[int] = []
        self.marked: list[int] = []
        self.hidden: list[bool] = []
        self._piece: list[str] = []
        self._linked = 0
        self.has_mark = False

    def say(self, s: str, in_link: bool) -> None:
        self._piece.append(s)
        if in_link:
            self._linked += len("".join(s.split()))

    def end_line(self, marked: int, hidden: bool) -> str:
        """Close the open line; the text it had."""
        if not self._piece:
            return ""
        line = " ".join("".join(self._piece).split())
        linked, self._linked = self._linked, 0
        self._piece.clear()
        if line:
            self._add(line, 0 if 2 * linked > len(line) else len(line) - linked, marked, hidden)
        return line

    def _add(self, line: str, weight: int, marked: int, hidden: bool) -> None:
        self.text.append(line)
        self.weight.append(weight)
        self.marked.append(marked)
        self.hidden.append(hidden)

    def gap(self) -> None:
        """An empty line; more than a window of them in a row say nothing more."""
        tail = self.text[-WINDOW:]
        if len(tail) < WINDOW or any(tail):
            self._add("", 0, 0, False)


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes from ``at`` on, and the place after the tag (-1: the page
    ends within it)."""
    found: dict[str, str] = {}
    while True:
        if end := _TAG_END.match(page, at):
            return found, end.end()
        m = _ATTRIBUTE.match(page, at)
        if not m or m.end() == at:
            return found, -1
        at = m.end()
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), value)


def _named(attributes: dict[str, str]) -> set[str]:
    """Words of class and id that name something beside the main text; a header
    of the text itself (``post-header``) is "heading"."""
    told = set()
    for key in ("class", "id"):
        for name in attributes.get(key, "").split():
            words = [w.lower() for w in _WORD.findall(name)]
            if words and words[0] not in _NOT:
                these = _WORDS.intersection(words)
                if these == {"header"} and _OF_TEXT.intersection(words):
                    these = {"heading"}
                told |= these
    return told


class _Reader:
    """One pass over a page's tags. The stack holds the containers and lines
    that are open, each with what it did to the state: "mark" (the page's text
    begins), "heading" (only headings count), "aside" (never text), "hide" and
    "talk" (told by class, role or form; the latter reader comments)."""

    def __init__(self, page: str):
        self.page = page
        self.lines = _Lines()
        self.stack: list[tuple[str, str]] = []
        self.open: dict[str, int] = {}
        self.count = dict.fromkeys(("", "mark", "heading", "aside", "hide", "talk"), 0)
        self.before_mark: list[dict[str, int]] = []
        self.articles = self.open_articles = 0
        self.headings = 0
        self.link = False

    def hidden(self) -> bool:
        return bool(self.count["hide"] or self.count["talk"])

    def break_line(self) -> str:
        mark = self.articles if self.open_articles else -1 if self.count["mark"] else 0
        return self.lines.end_line(mark, self.hidden())

    def _deed(self, name: str, attributes: dict[str, str]) -> str:
        role = attributes.get("role", "").lower()
        told = _named(attributes)
        if name == "main" or role == "main":
            return "mark"
        if name == "article" or role == "article":
            beside = told & _COMMENTED or self.count["talk"] or self.open.get("aside")
            return "talk" if beside else "mark"
        if name in ("html", "body"):
            return ""
        if told & _COMMENTED:
            return "talk"
        if name in _HEADING:
            told -= {"header", "heading"}
        if name in ("form", "fieldset", "label") or told - {"heading"} - (
                {"header"} if self.count["mark"] else set()) or role in _ROLES:
            return "hide"
        if told or name == "header" and self.count["mark"]:
            return "heading"
        return "aside" if name in _ASIDE else ""

    def push(self, name: str, attributes: dict[str, str]) -> None:
        did = self._deed(name, attributes)
        if (did or name in _CONTAINER) and not self._beside():
            self.lines.gap()
        if did == "mark":
            self.before_mark.append(self.count)
            self.count = dict.fromkeys(self.count, 0) | {"mark": self.count["mark"]}
            self.lines.has_mark = True
            if name != "main":
                self.articles += not self.open_articles
                self.open_articles += 1
        self.count[did] += 1
        self.headings += name in _HEADING
        self.stack.append((name, did))
        self.open[name] = self.open.get(name, 0) + 1

    def _beside(self) -> bool:
        return bool(self.count["mark"] or self.count["aside"]) or self.hidden()

    def pop(self) -> None:
        name, did = self.stack.pop()
        self.open[name] -= 1
        self.headings -= name in _HEADING
        if did == "mark":
            self.count = self.before_mark.pop()
            self.open_articles -= name != "main"
        else:
            self.count[did] -= 1
        if (did or name in _CONTAINER) and not self._beside():
            self.lines.gap()

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if self.top() == "head" and name not in _IN_HEAD:
            self.pop()
        if name == "a":
            self.link = True
        elif name in _LINE or name in _CONTAINER:
            self.break_line()
            same = ({"dt", "dd", "td", "th"} if name in ("dt", "dd", "td", "th") else
                    _HEADING if name in _HEADING else {name} if name in ("li", "option", "tr") else set())
            if self.top() in same or self.top() == "p" and name in _CLOSES_P:
                self.pop()
            if name not in _VOID:
                self.push(name, attributes)
        elif name in ("span", "ins") and _named(attributes):
            self.break_line()
            self.push(name, attributes)

    def end(self, name: str) -> None:
        if name == "a":
            self.link = False
        elif name == "br":
            self.break_line()
        elif self.open.get(name):
            if name in ("span", "ins") and self.top() != name:
                return  # an inline element closes nothing around it
            line = self.break_line()
            last = ""
            while last != name:
                last = self.top()
                self.pop()
            if name in _HEADING and len(line) < 60 and _COMMENT_HEADING.fullmatch(line):
                self._comments_follow()

    def _comments_follow(self) -> None:
        """A heading announced reader comments: it and what follows in the
        element around it are hidden."""
        self.lines.hidden[-1] = True
        if not self.stack or self.stack[-1][1] == "mark":
            self.count["talk"] += 1  # to the end of the page, or of the mark
        elif self.stack[-1][1] in ("", "heading"):
            name, did = self.stack.pop()
            self.count[did] -= 1
            self.count["talk"] += 1
            self.stack.append((name, "talk"))

    def say(self, s: str) -> None:
        if s and not self.count["aside"] and (self.headings or not self.count["heading"]):
            self.lines.say(references.unescape(s) if "&" in s else s, self.link)

    def read(self) -> _Lines:
        page, at, size = self.page, 0, len(self.page)
        text_from = 0
        while True:
            lt = page.find("<", at)
            if lt < 0 or lt == size - 1:
                self.say(page[text_from:])
                break
            after = page[lt + 1]
            if after.isascii() and after.isalpha() or after == "/" and page[lt + 2:lt + 3].isalpha():
                closing = after == "/"
                m = _NAME.match(page, lt + 1 + closing)
                if not m:
                    at = lt + 1
                    continue
                self.say(page[text_from:lt])
                name = m[0].lower()
                attributes, at = _attributes(page, m.end())
                if at < 0:
                    break
                text_from = at
                if closing:
                    self.end(name)
                elif name in _RAW:
                    end = _RAW_END[name].search(page, at)
                    if not end:
                        break
                    at = text_from = end.start()
                else:
                    self.start(name, attributes)
            elif page.startswith("!--", lt + 1):
                self.say(page[text_from:lt])
                if page.startswith((">", "->"), lt + 4):
                    at = text_from = page.find(">", lt) + 1
                    continue
                end = page.find("-->", lt + 4)
                if end < 0:
                    break
                at = text_from = end + 3
            elif after in "!?/":
                self.say(page[text_from:lt])
                end = page.find(">", lt)
                if end < 0:
                    break
                at = text_from = end + 1
            else:
                at = lt + 1
        self.break_line()
        return self.lines


def block_sums(weights: list[int], window: int = WINDOW) -> list[int]:
    """Sum of each ``window`` consecutive lines, from those that start ``window``
    - 1 lines before the first to the one at the last line."""
    sums, total = [], 0
    for i in range(len(weights) + window - 1):
        total += weights[i] if i < len(weights) else 0
        total -= weights[i - window] if i >= window else 0
        sums.append(total)
    return sums


def stretches(weights: list[int], window: int = WINDOW, level: int = LEVEL) -> list[tuple[int, int]]:
    """First and last line of each stretch that is kept: from a surge to the
    dive after it, with a window of at least ``level`` characters."""
    sums = block_sums(weights, window)
    least = min(level, max(sums, default=0) / 2)
    kept, surge, peak = [], None, 0
    for i, s in enumerate(sums + [0]):
        if s and surge is None:
            surge, peak = i, s
        elif s:
            peak = max(peak, s)
        elif surge is not None:
            if peak >= least:
                kept.append((surge, i - window))
            surge = None
    return kept


def _of_mark(lines: _Lines) -> list[int]:
    """Numbers of the lines of the page's articles, or of its main."""
    at = [i for i, m in enumerate(lines.marked) if m and not lines.hidden[i]]
    size: dict[int, int] = {}
    for i in at:
        size[lines.marked[i]] = size.get(lines.marked[i], 0) + len(lines.text[i])
    rest = size.pop(-1, 0)
    if sum(size.values()) < rest:
        return at
    least = max(size.values(), default=0) / 4
    return [i for i in at if size.get(lines.marked[i], -1) >= least]


def _weights(lines: _Lines) -> tuple[list[int], list[int]]:
    """Numbers of the lines that the sums run over, and what each counts: the text
    outside links or, where the page marks its text, all of it within the mark."""
    at = [i for i, h in enumerate(lines.hidden) if not h]
    if not lines.has_mark:
        return at, [lines.weight[i] for i in at]
    marked = set(_of_mark(lines))
    return at, [len(lines.text[i]) if i in marked else 0 for i in at]


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    lines = _Reader(page).read()

    def between(at, weights):
        return " ".join(lines.text[at[i]] for first, last in stretches(weights)
                        for i in range(first, last + 1)
                        if lines.text[at[i]] and (weights[i] or not lines.has_mark))

    at, weights = _weights(lines)
    found = between(at, weights)
    if not found and not lines.has_mark and sum(lines.weight) >= RESCUE:
        found = between(range(len(lines.text)), lines.weight)
    return found


def extract(pages: DataFrame, html: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with the main text of each in a new column, and its name."""
    name = free_name(pages, "text")
    schema = T.StructType([f for f in pages.schema.fields if f.name != html]
                          + [T.StructField(name, T.StringType())])
    rest = [f.name for f in schema.fields[:-1]]

    def read(batches):
        for b in slices(batches):
            texts = [main_text(p) for p in b.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(texts, pa.string())],
                                             names=[*rest, name])

    return text_batches(pages.withColumn(html, F.col(html).cast("string"))).mapInArrow(read, schema), name
