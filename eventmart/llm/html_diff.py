"""Main text of web pages by differencing each page with its nearest page.

1. Each page's HTML is read into text lines, one per block, in page order. Scripts, styles, comments and markup leave no
   line. A line knows whether it stands in the page's declared article (`article`, `main`) and whether an element around
   it is declared to be something else: navigation, header, footer, aside, form, or a class, id or role of that kind.
2. Pages are ordered by host and URL path; each is paired with the page before it on its host, or the one after for the first.
3. The two pages' lines are aligned by their longest common subsequence, and a page loses the lines it shares with its pair.
   What is declared as article is the page's own even when the pair repeats it (mirrors, copies, stock paragraphs). A page
   whose article or main part holds at least half of its words is made of that part's lines; a smaller one (a card, a quoted
   item) hides nothing: the page keeps it and its other lines, and differencing decides on those that nothing declares.

The order is a range partitioning of (host, path), so that a host of any size is spread over tasks; lines travel
compressed. At the edge of a range the pair is the next page instead of the one before.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.words import portions

# Element kinds of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    # A formula is text of its block.
    "math mfrac mi mn mo mover mrow mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas select".split())
# What an unclosed one of hides up to the page's end, as browsers do.
TO_THE_END = frozenset("script style".split())
# Blocks of running text: what their id says is made from the heading, not a declaration.
PLAIN = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption dl dt dd td th tr table tbody".split())
ASIDE = frozenset("nav header footer aside form button menu dialog head fieldset".split())
ARTICLE = frozenset("article main".split())
# What a head may hold: any other tag, or text, closes a head whose end tag is left out.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# A block end tag may be left out: these close an open one of their own kind.
SELF_CLOSING = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
# Words in class, id or role that declare an element to be something other than the article, whatever it holds ...
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr popup modal "
    "newsletter subscribe subscription signup login comment comments commentlist reply replies respond disqus discussion related "
    "recommended share sharing paywall".split()
)
# ... and those that a wrapper around the article, or a part of it, may carry as well (`with-sidebar`, `article-header`).
OUTER_WORDS = frozenset(
    "banner banners nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer colophon sidebar sidebars aside "
    "complementary widget widgets notice notices alert overlay social form search pagination pager toolbar contentinfo copyright "
    "legal disclaimer".split()
)
# What a part of the article may be called in spite of that.
_PART_WORDS = frozenset("header form legal copyright search".split())
# A quote opens a value only after an equals sign. Repeats are possessive: a tag is read once, whatever follows.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)"
_ATTRIBUTES = rf"(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+|=)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NOT = re.compile(r"(?:no|non|not|without)[-_]|.*[-_](?:free|off)\Z", re.I)
_HIDDEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
# A word for weighing lines; in scripts without spaces each letter counts.
_COUNTED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]|[^\\s\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]+")
_SPACE = re.compile(r"\s+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
LINES = "page_id long, url string, host string, path string, packed binary"
TEXT = "page_id long, url string, text string"
#: How a line's surroundings declare it: the article, the main part, neither.
IN_ARTICLE, IN_MAIN, ANYWHERE = 2, 1, 0


class _Open(NamedTuple):
    tag: str
    inside: int
    never: bool
    outer: bool


class _Element:
    """An element as read: its tag and attributes, the element around it, and whether it has its own end."""

    __slots__ = ("tag", "attributes", "parent", "closed", "end")

    def __init__(self, tag: str, attributes: str, parent: int):
        self.tag, self.attributes, self.parent, self.closed, self.end = tag, attributes, parent, False, 0


def _words(attributes: str, names: bool = True) -> set[str]:
    """Words of class and role, and of the id where `names`. What says that something is not there (`no-ads`) says nothing."""
    found = set()
    for m in _NAMED.finditer(attributes):
        if names or m[1].lower() != "id":
            for name in (m[2] or m[3] or m[4] or "").split():
                if not _NOT.match(name):
                    found |= {w.lower() for w in _WORD.findall(name)}
    return found


def _hidden(attributes: str) -> bool:
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", _QUOTED.sub("", attributes)) or _HIDDEN.search(attributes))


def _entered(tag: str, attributes: str, around: _Open, unclosed: bool = False) -> _Open:
    """What an element declares about its lines, given what is around it.

    An element without its end tag does not say where it ends: it declares nothing to be something else.
    """
    # Headings and sections of an article have ids made of their words.
    made_up = tag in PLAIN or bool(around.inside) and tag == "section"
    words = _words(attributes, names=not made_up) if attributes else set()
    inside, never, outer = around.inside, around.never, around.outer
    unclosed = unclosed and tag not in ARTICLE
    if tag == "article":
        inside, outer = IN_ARTICLE, False  # whatever a wrapper is called, this is an article
    elif tag == "main" or "role" in attributes and "main" in words:
        inside, outer = max(inside, IN_MAIN), False
    if unclosed:
        return _Open(tag, inside, never, outer)
    # A header inside the article holds its title; one outside is the site's.
    never = never or tag in ASIDE and not (tag == "header" and around.inside) or _hidden(attributes)
    if tag not in ("html", "body"):
        never = never or bool(words & NEVER_WORDS)
        if tag not in ARTICLE:
            outer = outer or bool(words & (OUTER_WORDS - _PART_WORDS if inside else OUTER_WORDS))
    return _Open(tag, inside, never, outer)


def _partners(page: str, tag: str) -> dict[int, int]:
    """Start of each element of an inline tag, and where its own end tag ends; elements without one are left out."""
    found, open_ = {}, []
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^<>]*>", page, re.I):
        if not m[1]:
            open_.append(m.start())
        elif open_:
            found[open_.pop()] = m.end()
    return found


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, how its surroundings declare it, declared to be something else) of each block with text, in page order.

    A block ends at each tag that is no inline one. Character references are decoded, white space becomes one space. Tags
    left open end with the page and hide nothing; end tags without a start are passed over; a `<` that begins no tag is text.
    """
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    elements: list[_Element] = [_Element("", "", 0)]
    stack = [0]
    # After the last `>` there is no tag; what has no end tag from here on has none later.
    until = page.rfind(">") + 1
    endless: set[str] = set()
    partners: dict[str, dict[int, int]] = {}

    def end_block() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                lines.append((text, stack[-1]))

    def leave(depth: int, closed: bool) -> None:
        for n in stack[depth:]:
            elements[n].end = len(elements)
        elements[stack[depth]].closed = closed
        del stack[depth:]

    at = 0
    while True:
        found = _TOKEN.search(page, at, until) if at < until else None
        piece = page[at : found.start() if found else len(page)]
        if elements[stack[-1]].tag == "head" and piece.strip():
            leave(len(stack) - 1, True)
        parts.append(piece)
        if not found:
            break
        at = found.end()
        tag, closing, attributes = (found[2] or "").lower(), bool(found[1]), found[3] or ""
        if not tag:
            if found[0].startswith("<![CDATA["):
                parts.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        if not closing and tag not in HEAD and elements[stack[-1]].tag == "head":
            end_block()
            leave(len(stack) - 1, True)
        if tag == "br":
            parts.append(" ")
            continue
        if tag in INLINE:
            # An inline element that is declared to be something else, as `<span class="ad">`, leaves its block as it is.
            if not closing and tag not in VOID and attributes and (_words(attributes) & NEVER_WORDS or _hidden(attributes)):
                if tag not in partners:
                    partners[tag] = _partners(page, tag)
                at = max(at, partners[tag].get(found.start(), at))
            continue
        end_block()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if elements[stack[depth]].tag == tag:
                    leave(depth, True)
                    break
                if tag in SELF_CLOSING and elements[stack[depth]].tag in ARTICLE | ASIDE | {"div", "section", "table"}:
                    break
        elif tag in RAW:
            if not attributes.rstrip().endswith("/"):
                close = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if close:
                    at = close.end()
                else:
                    endless.add(tag)
                    at = len(page) if tag in TO_THE_END else at
        elif tag not in VOID:
            if tag in SELF_CLOSING and elements[stack[-1]].tag == tag:
                leave(len(stack) - 1, True)
            elements.append(_Element(tag, attributes, stack[-1]))
            stack.append(len(elements) - 1)
    end_block()
    if len(stack) > 1:
        leave(1, False)
    states = _states(elements, frozenset())
    # Of two nested elements of one kind with one end tag, the outer or the inner one is left open. Where the first reading
    # leaves no line, or none of an article, the inner one is taken to be it.
    kept = [states[n] for _, n in lines if not (states[n].never or states[n].outer)]
    if not any(k.inside for k in kept) and (not kept or any(states[n].inside for _, n in lines)):
        doubtful = _doubtful(elements)
        if doubtful:
            states = _states(elements, doubtful)
    return [(text, states[n].inside, states[n].never or states[n].outer) for text, n in lines]


def _states(elements: list[_Element], doubtful: frozenset[int]) -> list[_Open]:
    """What each element declares about its lines, those left open or in doubt declaring nothing to be something else."""
    states = [_Open("", ANYWHERE, False, False)]
    for n, e in enumerate(elements[1:], 1):
        unclosed = n in doubtful or not e.closed and e.tag not in SELF_CLOSING
        states.append(_entered(e.tag, e.attributes, states[e.parent], unclosed))
    return states


def _doubtful(elements: list[_Element]) -> frozenset[int]:
    """Elements inside an element of the same kind that is left open."""
    until: dict[str, int] = {}
    found = set()
    for n, e in enumerate(elements[1:], 1):
        if n < until.get(e.tag, 0):
            found.add(n)
        if not e.closed:
            until[e.tag] = max(until.get(e.tag, 0), e.end)
    return frozenset(found)


def shared_lines(one: list[str], other: list[str]) -> set[int]:
    """Positions in `one` of a longest common subsequence with `other`, in memory linear in the lines (Hirschberg)."""
    found: set[int] = set()

    def lengths(a: list[str], b: list[str]) -> list[int]:
        row = [0] * (len(b) + 1)
        for x in a:
            diagonal = 0
            for j, y in enumerate(b, 1):
                above = row[j]
                row[j] = diagonal + 1 if x == y else max(above, row[j - 1])
                diagonal = above
        return row

    work = [(0, len(one), 0, len(other))]
    while work:
        i, k, j, m = work.pop()
        while i < k and j < m and one[i] == other[j]:
            found.add(i)
            i, j = i + 1, j + 1
        while i < k and j < m and one[k - 1] == other[m - 1]:
            found.add(k - 1)
            k, m = k - 1, m - 1
        if i >= k or j >= m:
            continue
        if k - i == 1:
            if one[i] in other[j:m]:
                found.add(i)
            continue
        half = (i + k) // 2
        head = lengths(one[i:half], other[j:m])
        tail = lengths(one[half:k][::-1], other[j:m][::-1])
        cut = max(range(m - j + 1), key=lambda c: head[c] + tail[m - j - c])
        work += [(i, half, j, j + cut), (half, k, j + cut, m)]
    return found


def _declared(kept: list[tuple[str, int]]) -> int:
    """The deepest declaration that holds at least half of the words of the one around it, from the whole page inwards."""
    words = [0, 0, 0]
    for text, inside in kept:
        n = len(_COUNTED.findall(text))
        for level in range(inside + 1):
            words[level] += n
    declared = ANYWHERE
    for level in (IN_MAIN, IN_ARTICLE):
        if words[level] and 2 * words[level] >= words[declared]:
            declared = level
    return declared


def main_text(lines: list, pair: list | None) -> str:
    """The page's text: the lines of the article or main part that holds most of it, else the declared lines and those of
    the others that the nearest page does not share."""
    kept = [(text, inside) for text, inside, other in lines if not other]
    declared = _declared(kept)
    own = [(text, inside) for text, inside in kept if inside >= declared]
    if declared == ANYWHERE and pair:
        # Only lines that the pair has at all can be shared.
        theirs = [text for text, _, _ in pair]
        has = set(theirs)
        places = [i for i, (text, inside) in enumerate(own) if inside == ANYWHERE and text in has]
        common = {own[i][0] for i in places}
        gone = shared_lines([own[i][0] for i in places], [text for text in theirs if text in common])
        drop = {places[g] for g in gone}
        # A mirror of the pair has no lines of its own to tell by.
        if any(i not in drop and (inside == ANYWHERE or text not in has) for i, (text, inside) in enumerate(own)):
            own = [line for i, line in enumerate(own) if i not in drop]
    return "\n\n".join(text for text, _ in own)


def read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, "html"):
        packed = [zlib.compress(json.dumps(lines_of(page or ""), ensure_ascii=False).encode("utf-8", "replace"), 1) for page in batch.column("html").to_pylist()]
        columns = [batch.column(c) for c in ("page_id", "url", "host", "path")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=["page_id", "url", "host", "path", "packed"])


def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order of host and path: each with the one before it, the first of a host with the one after."""

    def unpacked(blob):
        return json.loads(zlib.decompress(blob))

    waiting, last, host = None, None, None
    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "packed")))
        for page_id, url, on, blob in rows:
            lines = unpacked(blob)
            if on != host:
                if waiting:
                    out.append((*waiting[:2], main_text(waiting[2], None)))
                waiting, host = (page_id, url, lines), on
            else:
                if waiting:
                    out.append((*waiting[:2], main_text(waiting[2], lines)))
                    waiting = None
                out.append((page_id, url, main_text(lines, last)))
            last = lines
        yield _texts(out)
    if waiting:
        yield _texts([(*waiting[:2], main_text(waiting[2], None))])


def _texts(rows: list) -> pa.RecordBatch:
    ids, urls, texts = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
    )


def host_and_path(url: Column) -> tuple[Column, Column]:
    return (
        F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))),
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page: blocks of the main text joined by two line feeds, empty if there is none.

    A null html counts as empty; null urls share the empty host; null ids and repeated rows are passed on as they are. A
    page alone on its host, or in its range of the order, keeps all lines that nothing declares to be something else.
    Other columns are ignored; an empty frame gives none.
    """
    host, path = host_and_path(F.col("url"))
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html")
    )
    return (
        source.mapInArrow(read_lines, LINES)
        .repartitionByRange("host", "path", "page_id")
        .sortWithinPartitions("host", "path", "page_id", "url")
        .select("page_id", "url", "host", "packed")
        .mapInArrow(difference, TEXT)
    )
