"""Main text of web pages by wrappers inferred from the pages of a host.

A page is read as a balanced stream of block tags and texts; inline tags belong to their text. The wrapper of a host is a
regular expression without unions over such streams: elements with optional and repeated groups, and text slots. It is
inferred by aligning the pages one after another. Where a page's next element is not the wrapper's next one,
the mismatch is resolved: if the wrapper has the element further on, those in between are optional; if it has it further
back, the stretch from there is a repeated group; if it doesn't have it, it goes in as optional. Equal texts stay
fixed text, different ones make a text slot. Wrappers align with each other in the same way, so parts of a host's pages are
aligned where they lie and their wrappers are merged, in two steps for hosts with many. What is used of a wrapper does not depend
on the order of the pages.

The wrapper tells what the tags don't: where the text is on pages without an article element, which repeated groups are lists of
links, and which texts stand on every page. Menus, headers, footers, sidebars, notices, adverts, forms and comments are known by
their tags, roles and class names.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse.llm.common import neutral, original, written

# Elements nested more deeply belong to the one around them.
MAX_DEPTH = 100
# Sibling elements of one tag with more different classes than this are one element of the wrapper.
MAX_CLASSES = 32
# Elements of all wrappers that a task holds before it hands them on, and parts of a host that are merged first.
HELD_ITEMS = 100_000
PARTS = 64
# A text that stands on all of so many pages, or more, is the template's.
FIXED_PAGES = 8
# Share of linked characters that makes a list one of links, and share of a host's text that its main element has.
LINKED, MAIN = 0.8, 0.6

# HTML element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr main menu nav ol p pre section table ul".split()
)
AROUND_P = CLOSES_P - {"p"} | {"td", "th", "li", "dd", "button"}
# A start tag closes an open element of the named tags, unless one of the others is in between.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}
LEFT_OUT = frozenset(
    "head nav footer aside form button select datalist input textarea script style noscript template iframe object svg canvas"
    " audio video dialog menu title".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status".split())
LEFT_OUT_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos promotion"
    " nav navbar navigation menu menus submenu breadcrumb breadcrumbs footer masthead topbar sidebar sidebars aside widget widgets"
    " comment comments commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice notices alert alerts banner"
    " banners popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended"
    " recommendations pagination pager toolbar search searchbox form skip copyright legal disclaimer".split()
)
COMMENT_HEADING = re.compile(
    r"(\d+ )?((readers?|readers'|user) )?(comments?|replies|responses|(leser)?kommentare?|commentaires?|comentarios?)"
    r"( \(\d+\))?:?|leave a (comment|reply)",
    re.IGNORECASE,
)
LISTS = frozenset("ul ol dl div section table".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")


# Pages


class Element:
    """A block element; children are elements and texts, a text being (characters, of which linked)."""

    __slots__ = ("tag", "label", "out", "main", "header", "kids")

    def __init__(self, tag: str, label: str, out: bool, main: bool, header: bool = False):
        self.tag, self.label, self.out, self.main, self.header = tag, label, out, main, header
        self.kids: list = []


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(raw)}


def _element(tag: str, raw: str) -> Element:
    if not raw.strip(" \t\n\f\r/"):
        return Element(tag, tag, tag in LEFT_OUT, tag in ("article", "main"), tag == "header")
    had = _attributes(raw)
    names = f"{had.get('class', '')} {had.get('id', '')}".split()
    words = {w.lower() for n in names for w in WORD.findall(n)}
    hidden = "hidden" in had or had.get("aria-hidden") == "true" or "display:none" in had.get("style", "").replace(" ", "")
    out = tag in LEFT_OUT or hidden or had.get("role") in LEFT_OUT_ROLES or bool(words & LEFT_OUT_CLASSES)
    # An article or body may have any class: it is not a menu because its theme is called so.
    out = out and not (tag in ("article", "main", "body", "html") and not hidden and "comment" not in words)
    main = tag in ("article", "main") or had.get("role") in ("main", "article")
    label = ".".join([tag, *sorted({DIGITS.sub("0", n) for n in names})])
    return Element(tag, label, out, main, tag == "header" or "header" in words)


def parse(page: str) -> Element:
    """The page as a tree of block elements, with the end tags that HTML lets authors leave out."""
    root = Element("html", "html", False, False)
    stack, text, linked, link, at = [root], [], 0, False, 0

    def close_text() -> None:
        nonlocal linked
        if text:
            run = " ".join(entities.unescape("".join(text)).split())
            if run:
                stack[-1].kids.append((run, min(linked, len(run))))
            text.clear()
        linked = 0

    def pop_to(tags: tuple, stops: tuple | frozenset = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    for m in TOKEN.finditer(page):
        start, end = m.span()
        if start < at:
            continue  # inside a script or the like
        if start > at:
            text.append(page[at:start])
            linked += (start - at) if link else 0
        at = end
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                link = False
            if tag in INLINE and not any(e.tag == tag for e in stack[-3:]):
                continue
            close_text()
            pop_to((tag,))
            continue
        if tag in INLINE and not (tag not in VOID and m[3].strip() and _element(tag, m[3]).out):
            if tag == "a":
                link = True
            if tag == "br":
                text.append(" ")
            continue
        close_text()
        if tag in VOID or tag in ("html", "body"):
            pop_to(("head",) if tag == "body" else ())
            continue
        if tag in RAW:
            closing = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, end)
            at = closing.end() if closing else len(page)
            continue
        if tag in CLOSES_P:
            pop_to(("p",), AROUND_P)
        if tag in SIBLINGS:
            pop_to(*SIBLINGS[tag])
        if tag in ("article", "main"):
            # Nothing of this kind has an article inside, so it was not closed.
            pop_to(("nav", "footer", "header", "form", "head"), ("article", "main", "section", "aside"))
        if len(stack) > MAX_DEPTH:
            continue
        made = _element(tag, m[3])
        stack[-1].kids.append(made)
        stack.append(made)
    if at < len(page):
        text.append(page[at:])
    close_text()
    return root


# Wrappers


class Item:
    """An element of a wrapper, or with the label ``#`` the texts in it.

    ``seen`` counts its places on the pages, ``pages`` the pages themselves; ``low`` and ``high`` bound the hashes of its
    texts, so they are equal for a fixed text. ``spans`` are the repeated groups among its children, by first and last.
    """

    __slots__ = ("label", "optional", "many", "seen", "pages", "chars", "linked", "low", "high", "items", "spans", "loose", "last")

    def __init__(self, label: str):
        self.label, self.optional, self.many = label, False, False
        self.seen = self.pages = self.chars = self.linked = 0
        self.low = self.high = None
        self.items: dict[str, Item] = {}
        self.spans: set[tuple[str, str]] = set()
        self.loose: set[str] = set()  # tags whose classes are not told apart
        self.last = -1  # the last page that had it

    def place(self, label: str) -> str:
        """The name a child has here."""
        tag = label.split(".", 1)[0]
        return tag if tag in self.loose else label

    def loosen(self) -> None:
        """Make one of the children of each tag that has too many different classes."""
        if len(self.items) <= MAX_CLASSES and not self.loose:
            return
        tags: dict[str, int] = {}
        for label in self.items:
            tag = label.split(".", 1)[0]
            tags[tag] = tags.get(tag, 0) + 1
        for tag in [t for t, n in tags.items() if n > MAX_CLASSES] + list(self.loose):
            self.loose.add(tag)
            same = [k for k in self.items if k.split(".", 1)[0] == tag and k != tag]
            if not same:
                continue
            into = self.items.setdefault(tag, Item(tag))
            into.many = True
            for k in same:
                into.merge(self.items.pop(k))
            self.spans = {(self.place(a), self.place(b)) for a, b in self.spans}

    def _insert(self, made: Item, after: int) -> None:
        order = list(self.items.items())
        order.insert(after, (made.label, made))
        self.items = dict(order)

    def take(self, element: Element, page: int) -> None:
        """Align one place on a page with this element."""
        self.seen += 1
        if self.last != page:
            self.pages, self.last = self.pages + 1, page
        order = list(self.items)
        touched: set[str] = set()
        at = 0
        for kid in element.kids:
            label = "#" if isinstance(kid, tuple) else self.place(kid.label)
            found = self.items.get(label)
            if found is None:
                found = Item(label)
                found.optional = self.seen > 1
                self._insert(found, at)
                order.insert(at, label)
                at += 1
            else:
                k = order.index(label)
                if k < at and label in touched:  # the stretch from there on begins again
                    if k == at - 1:
                        found.many = True
                    else:
                        self.spans.add((label, order[at - 1]))
                at = k + 1
            touched.add(label)
            if isinstance(kid, tuple):
                run, linked = kid
                found.seen += 1
                if found.last != page:
                    found.pages, found.last = found.pages + 1, page
                found.chars, found.linked = found.chars + len(run), found.linked + linked
                key = xxhash.xxh64_intdigest(run)
                found.low = key if found.low is None else min(found.low, key)
                found.high = key if found.high is None else max(found.high, key)
            else:
                found.take(kid, page)
        for label in order:
            if label not in touched:
                self.items[label].optional = True
        self.loosen()

    def merge(self, other: Item) -> None:
        """Align another wrapper of the same element with this one; its own pages are others."""
        at = 0
        mine = set(self.items)
        self.loose |= other.loose
        self.loosen()
        for label, theirs in other.items.items():
            found = self.items.get(self.place(label))
            if found is None:
                theirs.optional = theirs.optional or self.seen > 0
                theirs.label = self.place(label)
                self._insert(theirs, at)
                at += 1
            else:
                at = list(self.items).index(found.label) + 1
                found.optional, found.many = found.optional or theirs.optional, found.many or theirs.many
                found.merge(theirs)
        for label in mine - {self.place(k) for k in other.items}:
            if label in self.items and other.seen:
                self.items[label].optional = True
        self.spans |= {(self.place(a), self.place(b)) for a, b in other.spans}
        self.seen, self.pages = self.seen + other.seen, self.pages + other.pages
        self.chars, self.linked = self.chars + other.chars, self.linked + other.linked
        lows = [x for x in (self.low, other.low) if x is not None]
        highs = [x for x in (self.high, other.high) if x is not None]
        self.low, self.high = min(lows, default=None), max(highs, default=None)
        self.loosen()

    def size(self) -> int:
        return 1 + sum(i.size() for i in self.items.values())

    def packed(self) -> list:
        return [
            self.label, int(self.optional), int(self.many), self.seen, self.pages, self.chars, self.linked, self.low, self.high,
            [i.packed() for i in self.items.values()], sorted(self.spans), sorted(self.loose),
        ]

    @staticmethod
    def unpacked(data: list) -> Item:
        made = Item(data[0])
        made.optional, made.many = bool(data[1]), bool(data[2])
        made.seen, made.pages, made.chars, made.linked, made.low, made.high = data[3:9]
        made.items = {i[0]: Item.unpacked(i) for i in data[9]}
        made.spans, made.loose = {tuple(s) for s in data[10]}, set(data[11])
        return made

    def pattern(self) -> str:
        """The wrapper as a regular expression; ``#`` is a text slot."""
        if self.label == "#":
            body = "#" if self.low != self.high else "fixed"
        else:
            names = list(self.items)
            parts = [self.items[n].pattern() for n in names]
            for first, last in sorted(self.spans):
                if first in names and last in names and first != last:
                    i, j = sorted((names.index(first), names.index(last)))
                    parts[i], parts[j] = "(" + parts[i], parts[j] + ")+"
            body = f"<{self.label}>{''.join(parts)}</>"
        many, optional = self.many, self.optional
        return f"({body}){'*' if many and optional else '+' if many else '?'}" if many or optional else body


class Rules:
    """What a page's extraction needs of its host's wrapper; paths are labels from the page's top."""

    def __init__(self, main: str = "", links: frozenset = frozenset(), fixed: frozenset = frozenset()):
        self.main, self.links, self.fixed = main, links, fixed

    def packed(self) -> str:
        if not (self.main or self.links or self.fixed):
            return ""
        return json.dumps([self.main, sorted(self.links), sorted(self.fixed)], separators=(",", ":"))

    @staticmethod
    def unpacked(data: str | None) -> Rules:
        if not data:
            return Rules()
        main, links, fixed = json.loads(data)
        return Rules(main, frozenset(links), frozenset(tuple(f) for f in fixed))


def _left_out(label: str) -> bool:
    tag, *names = label.split(".")
    words = {w.lower() for n in names for w in WORD.findall(n)}
    return tag in LEFT_OUT or bool(words & LEFT_OUT_CLASSES)


def rules_of(wrapper: Item) -> Rules:
    """The main element, the lists of links and the fixed texts of a host."""
    free: dict[int, int] = {}  # characters outside links, of what may be main text
    sums: dict[int, tuple[int, int]] = {}  # all and linked characters
    texts: list[tuple[str, Item]] = []
    lists: list[tuple[str, Item]] = []

    def visit(item: Item, path: str) -> None:
        chars = linked = own = 0
        for kid in item.items.values():
            if kid.label == "#":
                chars, linked, own = chars + kid.chars, linked + kid.linked, own + kid.chars - kid.linked
                texts.append((path, kid))
            elif not _left_out(kid.label):
                here = f"{path}/{kid.label}"
                visit(kid, here)
                more = sums[id(kid)]
                chars, linked, own = chars + more[0], linked + more[1], own + free[id(kid)]
                lists.append((here, kid))
        sums[id(item)], free[id(item)] = (chars, linked), own

    visit(wrapper, "")
    links = frozenset(
        path for path, item in lists
        if item.label.split(".")[0] in LISTS and sums[id(item)][0] and sums[id(item)][1] >= LINKED * sums[id(item)][0]
        and (item.spans or any(k.many for k in item.items.values()))
    )
    fixed = frozenset((path, item.low) for path, item in texts if item.pages >= FIXED_PAGES and item.pages == wrapper.pages
                      and item.low == item.high)
    # Down from the top as long as one child has most of the text.
    main, at, total = "", wrapper, free[id(wrapper)]
    while total:
        below = [k for k in at.items.values() if k.label != "#" and not _left_out(k.label) and free[id(k)] >= MAIN * total]
        if not below or below[0].label.split(".")[0] not in LISTS:
            break
        at = below[0]
        main = f"{main}/{at.label}"
    return Rules(main, links, fixed)


def main_text(page: Element, rules: Rules) -> str:
    """The text of the article elements, of the main element, of the host's main element, or of the page, in this order."""
    tops: dict[str, list] = {"article": [], "main": [], "host": []}
    waiting = [(page, "")]
    while waiting:
        element, path = waiting.pop()
        for kid in reversed(element.kids):
            if isinstance(kid, tuple) or kid.out:
                continue
            here = f"{path}/{kid.label}"
            if kid.main and kid.tag != "main" and "main" not in kid.label.split("."):
                tops["article"].append((kid, here))
                continue
            if kid.main:
                tops["main"].append((kid, here))
            elif here == rules.main:
                tops["host"].append((kid, here))
            waiting.append((kid, here))
    chosen = next((tops[k] for k in ("article", "main", "host") if tops[k]), [(page, "")])
    chosen = _in_page_order(page, chosen)
    runs: list[str] = []
    for top, path in chosen:
        _collect(top, path, rules, runs, whole=top is page or not top.main)
    return " ".join(runs)


def _in_page_order(page: Element, chosen: list[tuple]) -> list[tuple]:
    """The chosen elements as they stand on the page, without those inside another one."""
    wanted = {id(e): (e, p) for e, p in chosen}
    out, waiting = [], [page]
    while waiting:
        element = waiting.pop()
        if id(element) in wanted:
            out.append(wanted[id(element)])
            continue
        waiting.extend(k for k in reversed(element.kids) if not isinstance(k, tuple))
    return out


def _collect(top: Element, path: str, rules: Rules, runs: list[str], whole: bool) -> None:
    """Texts below an element in page order. Outside an article a header is the page's own."""
    waiting: list = [(top, path)]
    while waiting:
        item, path = waiting.pop()
        if isinstance(item, str):
            runs.append(item)
            continue
        for kid in reversed(item.kids):
            if isinstance(kid, tuple):
                if not rules.fixed or (path, xxhash.xxh64_intdigest(kid[0])) not in rules.fixed:
                    waiting.append((kid[0], ""))
                continue
            if kid.out or (whole and kid.header) or _of_comments(kid):
                continue
            here = f"{path}/{kid.label}"
            if here not in rules.links:
                waiting.append((kid, here))


def _of_comments(element: Element) -> bool:
    """Whether a section begins with a heading of readers' comments."""
    if element.tag not in ("section", "div") or not element.kids:
        return False
    first = element.kids[0]
    if isinstance(first, tuple) or first.tag not in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return False
    return bool(first.kids) and isinstance(first.kids[0], tuple) and bool(COMMENT_HEADING.fullmatch(first.kids[0][0]))


# Tables


def host_of(url: Column) -> Column:
    """The host in lower case; a missing or odd url has the empty one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _parts(pages: DataFrame) -> DataFrame:
    """(host, part, wrapper): wrappers of the pages that lie together."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Item] = {}
        number = items = 0

        def out() -> pa.RecordBatch:
            rows = [(h, number % PARTS, json.dumps(w.packed(), separators=(",", ":"))) for h, w in held.items()]
            columns = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "part", "wrapper"])

        for batch in batches:
            for host, data in zip(batch.column(0), batch.column(1), strict=True):
                host, data = host.as_py(), data.as_py()
                if not data:
                    continue
                wrapper = held.get(host)
                if wrapper is None:
                    wrapper = held[host] = Item("html")
                number += 1
                wrapper.take(parse(data), number)
            items = sum(w.size() for w in held.values())
            if items > HELD_ITEMS:
                yield out()
                held.clear()
        if held:
            yield out()

    return pages.select("host", "html").mapInArrow(of_partition, "host string, part int, wrapper string")


def _merged(table: pa.Table) -> pa.Table:
    wrapper: Item | None = None
    for data in table.column("wrapper"):
        other = Item.unpacked(json.loads(data.as_py()))
        if wrapper is None:
            wrapper = other
        else:
            wrapper.merge(other)
    one = table.slice(0, 1).select(["host", "part"])
    return one.append_column("wrapper", pa.array([json.dumps(wrapper.packed(), separators=(",", ":"))], pa.string()))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, n_pages, wrapper, rules): the wrapper of every host as an expression and what extraction takes from it.

    ``pages`` has url and html. All pages of a host are aligned; pages without html take no part.
    """
    schema = "host string, part int, wrapper string"
    parts = _parts(pages.select(host_of(F.col("url")).alias("host"), "html"))
    some = parts.groupBy("host", "part").applyInArrow(_merged, schema)
    merged = some.groupBy("host").applyInArrow(_merged, schema)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, data in zip(batch.column("host"), batch.column("wrapper"), strict=True):
                wrapper = Item.unpacked(json.loads(data.as_py()))
                rows.append((host.as_py(), wrapper.pages, wrapper.pattern(), rules_of(wrapper).packed()))
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["host", "n_pages", "wrapper", "rules"])

    return merged.mapInArrow(described, "host string, n_pages bigint, wrapper string, rules string")


def extract(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` and ``text``, the main text of the whole html; a column of that name is replaced.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space. A null or empty
    page, and one without main text, has an empty text. Text that stands in no element counts as a block. Pages with a null url
    are one host. Repeated pages are extracted each. An empty table gives an empty one.
    """
    told = written(wrappers(pages.select("url", "html")).select("host", "rules"), "html-rules")
    rows = neutral(pages, ["url", "html"]).withColumn("_host", host_of(F.col("url")))
    joined = rows.join(told.withColumnRenamed("host", "_host"), "_host", "left")

    def of_batches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known: dict[str | None, Rules] = {}
        for page, rules in batches:
            out = []
            for data, told_ in zip(page, rules, strict=True):
                data, told_ = data.as_py(), told_.as_py()
                if told_ not in known:
                    if len(known) > 1_000:
                        known.clear()
                    known[told_] = Rules.unpacked(told_)
                out.append(main_text(parse(data), known[told_]) if data else "")
            yield pa.array(out, pa.string())

    text = F.arrow_udf(of_batches, "string")(F.col("html"), F.col("rules"))
    own = [c for n, c in zip(pages.columns, original(pages), strict=True) if n != "text"]
    return joined.select(*own, text.alias("text"))


def page_texts(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )
