"""HTML extraction by union-free wrappers, inferred from pages of the same host.

A page is a stream of tags and texts.  A wrapper is a regular expression over such streams without unions: tags,
text slots, optional parts ``( )?`` and repeated parts ``( )+``.  A page's stream is the first wrapper; the next page is aligned
with it, and mismatches are resolved: a text that differs becomes a slot, a part that only one side has becomes optional, and
where an element comes again the stretch since its last coming becomes a repeated part.  So an element stands once among its siblings, which is
the anchor the next stream is aligned by, and a wrapper is as large as the markup of a host is varied, however many or long its pages are.
Every task folds its pages into one wrapper per host, and these are aligned in two levels.

The wrapper then says where the main text is: in the article (by its tag or name, else the part that holds most text outside of
links).  Of the article go menus, headers and footers of the page, sidebars, notices, adverts, forms, scripts, styles and reader
comments, by tag or by the whole name of a container (class, role or id); everything else stays, at any number of pages.  Where no element is named as
the article, slots that are mostly links on the host are menus.  A page that lacks the place is judged by its own stream.

Cases: NULL html counts as empty and gives an empty text; cut-off pages end where they are cut; unknown tags are blocks'
content; NULL urls share the empty host; repeated pages are one piece of evidence each; of two places with as much text the deeper and then the first one counts;
pages may be of any length and depth (nothing recurses); an empty table gives no rows; further columns are kept, but one named like the
result is replaced.  Nothing is capped.
"""

from __future__ import annotations

import functools
import html as htmllib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, freeze, others

_FAN = 64
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>?|<[!?][^>]*>?""", re.S)
NAME = re.compile(r"""(class|id|role)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))""", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img".split())
RAW = set("script style iframe textarea select title".split())
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
BAD_TAGS = set("nav footer aside form button dialog menu head".split())
#: Names of the parts that go: menus, footers, sidebars, notices, adverts, forms, comments.
BAD_NAMES = set(
    "menu nav navbar navigation breadcrumb breadcrumbs footer sidebar cookie cookies consent notice notices alert gdpr ad ads advert adverts "
    "advertisement advertising sponsor sponsored form newsletter subscribe signup login comment comments disqus".split()
)
#: What such names are joined with in a whole name, as in cookie-notice or ad-box.
NEUTRAL = set("bar block box container wrapper wrap area section list item slot top bottom left right inner outer main site page primary secondary banner".split())
#: Elements that are text of the article whatever their names.
TEXT_TAGS = set("h1 h2 h3 h4 h5 h6 p li dt dd blockquote pre td th caption figcaption address".split())
_APART = "-"  # name of a container that is no part of an article
HEAD_NAMES = {"header", "masthead", "topbar"}
GOOD_NAMES = set("article content post entry story main".split())
#: No place to look for an article in, where none is named.
ELSEWHERE = set("banner promo promotion share sharing social related recommended popup modal toolbar pagination pager widget skip".split())


def _apart(name: str) -> bool:
    """Whether a whole name is one of the parts that go."""
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    return any(x in BAD_NAMES for x in parts) and all(x in BAD_NAMES or x in NEUTRAL for x in parts)


@functools.lru_cache(maxsize=65536)
def _key(tag: str, attributes: str) -> str:
    """Key of an element: tag, name tokens without digits, ``_APART`` for one that is no part of an article."""
    tokens, apart = set(), False
    for name, *values in NAME.findall(attributes):
        value = "".join(values).lower()
        tokens.update(x for x in re.split(r"[^a-z]+", value) if x)
        whole = [value] if name.lower() == "id" else value.split()
        apart = apart or (tag not in TEXT_TAGS and any(map(_apart, whole)))
    return ".".join([tag, *sorted(tokens), *([_APART] if apart else [])])


def events(page: str | None) -> Iterator[tuple]:
    """("<", key) for an element that opens, (">", how many) for elements that close, ("#", text, characters in links) for a block of text."""
    open_: list[str] = []
    text: list[str] = []
    linked, in_link = 0, False
    at, page = 0, page or ""

    def take(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = htmllib.unescape(piece)
            text.append(piece)
            if in_link:
                linked += len(piece.strip())

    def flush():
        nonlocal linked
        whole = " ".join("".join(text).split())
        out = ("#", whole, min(linked, len(whole)))
        text.clear()
        linked = 0
        return [out] if whole else []

    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            take(page[at:])
            break
        take(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                in_link = not m[1]
            continue
        yield from flush()
        in_link = False
        if m[1]:
            if tag in open_:
                n = open_[::-1].index(tag) + 1
                del open_[-n:]
                yield ">", n
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        while open_ and open_[-1] in CLOSED_BY and (CLOSED_BY[open_[-1]] is None or tag in CLOSED_BY[open_[-1]]):
            open_.pop()
            yield ">", 1
        open_.append(tag)
        yield "<", _key(tag, m[3])
    yield from flush()


class Part:
    """A part of a wrapper: an element or, with the key ``#``, a text.

    Its children stand in a chain; ``label`` is a child's place in it, ``joined`` whether it is in one repeated stretch with the child before it.
    """

    __slots__ = ("key", "pages", "repeated", "joined", "label", "next", "first", "kids", "text", "chars", "linked")

    def __init__(self, key: str, text: str | None = None, chars: int = 0, linked: int = 0):
        self.key, self.pages, self.repeated, self.joined = key, 1, False, False
        self.label, self.next, self.first, self.kids = 0.0, None, None, {}
        self.text, self.chars, self.linked = text, chars, linked

    def __iter__(self) -> Iterator[Part]:
        kid = self.first
        while kid is not None:
            yield kid
            kid = kid.next

    def see(self, kid: Part, last: Part | None) -> Part:
        """The child that the next element of a stream, ``kid``, is, when ``last`` was the one before; a new one is chained behind that."""
        own = self.kids.get(kid.key)
        if own is None:
            own = self.kids[kid.key] = kid
            after = self.first if last is None else last.next
            own.next, own.joined = after, bool(last is not None and after is not None and after.joined)
            if last is None:
                self.first = own
            else:
                last.next = own
            before = last.label if last else (after.label - 2.0 if after else 0.0)
            own.label = before + 1.0 if after is None else (before + after.label) / 2
            if after is not None and not before < own.label < after.label:
                for n, x in enumerate(self):
                    x.label = float(n)
        elif last is not None and own.label <= last.label:
            own.repeated = own.repeated or own is last
            x = own
            while x is not last:
                x = x.next
                x.joined = True
        return own


def page_wrapper(page: str | None) -> Part:
    """The wrapper of one page: siblings that come again are folded while they pass."""
    root = Part("")
    stack: list[list] = [[root, None]]  # part, the child before
    for kind, what, *more in events(page):
        if kind == ">":
            del stack[-what:]
            continue
        top = stack[-1]
        new = Part("#", what, len(what), more[0]) if kind == "#" else Part(what)
        own = top[0].see(new, top[1])
        top[1] = own
        if kind == "<":
            stack.append([own, None])
        elif own is not new:
            own.text = own.text if own.text == what else None
            own.chars, own.linked = own.chars + len(what), own.linked + more[0]
    return root


def align(a: Part, b: Part) -> Part:
    """``a`` made the wrapper of everything that ``a`` or ``b`` fits; both have the same key."""
    todo = [(a, b)]
    while todo:
        a_, b_ = todo.pop()
        a_.pages, a_.repeated = a_.pages + b_.pages, a_.repeated or b_.repeated
        if a_.key == "#":
            a_.text = a_.text if a_.text == b_.text else None
            a_.chars, a_.linked = a_.chars + b_.chars, a_.linked + b_.linked
        last, run = None, None
        for kid in list(b_):
            joined = kid.joined
            if not joined and run is not None:  # the end of a repeated stretch of b: it may begin again
                last = a_.see(run, last) if run is not a_.kids[run.key] else last
            fresh = kid.key not in a_.kids
            own = a_.see(kid, last)
            if joined and last is not None and own.label > last.label:
                x = last
                while x is not own:
                    x = x.next
                    x.joined = True
            elif fresh:
                own.joined = own.joined and joined
            if not fresh:
                todo.append((own, kid))
            last, run = own, own
    return a


def flat(wrapper: Part) -> list[list]:
    """Parts in order, each with the number of the one it is in."""
    out, todo = [], [(wrapper, -1)]
    while todo:
        part, above = todo.pop()
        todo += [(kid, len(out)) for kid in reversed(list(part))]
        out.append([above, part.key, part.pages, int(part.repeated), int(part.joined), part.text, part.chars, part.linked])
    return out


def from_flat(rows: list[list]) -> Part:
    parts, last = [], {}
    for above, key, pages, repeated, joined, text, chars, linked in rows:
        part = Part(key, text, chars, linked)
        if above >= 0:
            parts[above].see(part, last.get(above))
            last[above] = part
        part.pages, part.repeated, part.joined = pages, bool(repeated), bool(joined)
        parts.append(part)
    return parts[0]


def expression(wrapper: Part) -> str:
    """The wrapper as a regular expression over tags and #text."""
    out: list[str] = []
    todo: list = [(wrapper, wrapper.pages)]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        part, pages = item
        mark = ("*" if part.pages < pages else "+") if part.repeated else "?" if part.pages < pages else ""
        after = [f"){mark}"] if mark else []
        if part.key == "#":
            inner: list = ["#" if part.text is None else repr(part.text)]
        else:
            inner, kids = [], list(part)
            for n, kid in enumerate(kids):
                ahead = n + 1 < len(kids) and kids[n + 1].joined
                inner += (["("] if ahead and not kid.joined else []) + [(kid, part.pages)] + ([")+"] if kid.joined and not ahead else [])
            if part.key:
                inner = [f"<{part.key}>", *inner, f"</{part.key.split('.')[0]}>"]
        todo += reversed([*(["("] if mark else []), *inner, *after])
    return " ".join(out)


def _bad(key: str, outside: bool) -> bool:
    """Whether an element is no article text; ``outside``: it is not in the article."""
    tag, *names = key.split(".")
    return tag in BAD_TAGS or _APART in names or (outside and (tag == "header" or not HEAD_NAMES.isdisjoint(names)))


def _tag(part: Part) -> str:
    return part.key.split(".")[0]


def _names(part: Part) -> list[str]:
    return part.key.split(".")[1:]


def main_place(wrapper: Part) -> dict:
    """What extraction needs: the keys down to the article, whether it is named, and (if not) the paths of link lists in it."""
    order: list[tuple[Part, int]] = []  # parts and the number of the part above
    todo = [(wrapper, -1, False, False)]
    good: list[bool] = []
    while todo:
        part, above, bad, within = todo.pop()
        within = within or _tag(part) in ("article", "main")
        bad = bad or _bad(part.key, not within)
        todo += [(kid, len(order), bad, within) for kid in reversed(list(part))]
        order.append((part, above))
        good.append(not bad)
    held, depth = [0.0] * len(order), [0] * len(order)
    for k, (part, above) in enumerate(order):
        depth[k] = depth[above] + 1 if above >= 0 else 0
        if part.key == "#" and good[k] and 2 * part.linked <= part.chars:
            held[k] = part.chars - part.linked
    for k in range(len(order) - 1, 0, -1):
        held[order[k][1]] += held[k]

    def best(fits) -> int | None:
        found = [k for k in range(1, len(order)) if order[k][0].key != "#" and held[k] and good[k] and fits(order[k][0])]
        if not found:
            return None
        top = max(found, key=lambda k: (held[k], depth[k], -k))
        last = top
        while last + 1 < len(order) and depth[last + 1] > depth[top]:
            last += 1
        deeper = [k for k in found if top <= k <= last and 2 * held[k] >= held[top]]
        return max(deeper, key=lambda k: (depth[k], -k))

    root = best(lambda x: _tag(x) in ("article", "main") or "main" in _names(x)) or best(lambda x: not GOOD_NAMES.isdisjoint(_names(x)))
    named = root is not None
    if root is None:
        below: dict[int, list[int]] = {}
        for k, (part, above) in enumerate(order):
            if part.key != "#" and _tag(part) not in ("p", "li", "h1") and ELSEWHERE.isdisjoint(_names(part)):
                below.setdefault(above, []).append(k)
        root = 0
        while below.get(root):
            top = max(below[root], key=lambda k: (held[k], -k))
            if held[top] == 0 or held[top] < 0.6 * held[root]:
                break
            root = top
    path, k = [], root
    while k > 0:
        path.append(order[k][0].key)
        k = order[k][1]
    links = [n for n, (part, _) in enumerate(order) if part.key == "#" and 2 * part.linked > part.chars] if not named else []
    out = []
    for n in links:
        keys, k = [], order[n][1]
        while k > 0:
            keys.append(order[k][0].key)
            k = order[k][1]
        out.append(keys[::-1])
    return {"root": path[::-1], "named": named, "links": out, "found": held[root] > 0}


def _text_at(page: str, place: dict) -> list[str]:
    root, out = place["root"], []
    links = {tuple(p) for p in place["links"]}
    path: list[str] = []
    match, spoiled = 0, None  # how much of the root the path agrees with, depth of the first element that is no article text
    for kind, what, *_ in events(page):
        if kind == "<":
            if match == len(path) and match < len(root) and root[match] == what:
                match += 1
            path.append(what)
            if spoiled is None and _bad(what, len(path) <= len(root)):
                spoiled = len(path)
        elif kind == ">":
            del path[-what:]
            match = min(match, len(path))
            spoiled = None if spoiled is not None and spoiled > len(path) else spoiled
        elif match == len(root) and spoiled is None and not (links and tuple(path) in links):
            out.append(what)
    return out


def main_text(page: str | None, place: dict | None) -> str:
    """The text at the host's place; where the page has none there, at its own."""
    if not page:
        return ""
    out = _text_at(page, place) if place else []
    return "\n".join(out or _text_at(page, main_place(page_wrapper(page))))


def host_places(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """One row per host: host, place (JSON), wrapper (its expression)."""

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Part] = {}
        for part in batches:
            for host, page in zip(part["host"], part["html"]):
                if page:
                    new = page_wrapper(page)
                    held[host] = align(held[host], new) if host in held else new
        task = TaskContext.get().partitionId()
        # a task without pages has nothing to say; an empty column of no type couldn't be sent either
        if held:
            yield pd.DataFrame({"host": list(held), "task": task, "wrapper": [json.dumps(flat(w)) for w in held.values()]})

    def level(group: pd.DataFrame) -> pd.DataFrame:
        merged = functools.reduce(align, (from_flat(json.loads(w)) for w in sorted(group["wrapper"])))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "task": [0], "wrapper": [json.dumps(flat(merged))]})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            trees = [from_flat(json.loads(w)) for w in part["wrapper"]]
            if trees:
                yield pd.DataFrame({"host": part["host"], "place": [json.dumps(main_place(w)) for w in trees], "wrapper": [expression(w) for w in trees]})

    kind = "host string, task int, wrapper string"
    rows = pages.select(F.col(host_col).alias("host"), F.col(html_col).alias("html"))
    rows = rows.mapInPandas(per_task, kind).groupBy("host", F.pmod("task", F.lit(_FAN))).applyInPandas(level, kind)
    rows = rows.groupBy("host").applyInPandas(level, kind)
    return freeze(rows.mapInPandas(place, "host string, place string, wrapper string"), "wrappers")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of every page."""
    host_col, place_col = free(pages, "_host"), free(pages, "_place")
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), "://([^/?#]*)", 1)), F.lit(""))
    hosted = pages.withColumn(host_col, host)
    places = host_places(hosted, host_col, html_col).select(F.col("host").alias(host_col), F.col("place").alias(place_col))

    def texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict = {}
        for htmls, spots in batches:
            yield pd.Series([main_text(h, known.setdefault(p, json.loads(p)) if p else None) if h else "" for h, p in zip(htmls, spots)], dtype=object)

    udf = F.pandas_udf(texts, "string")
    both = hosted.join(places, host_col, "left")
    return both.select(*others(pages, out), udf(F.col(html_col), F.col(place_col)).alias(out))
