"""Main text of web pages by nearest-URL page differencing.

Pages of a host are put in order of their URL path; each is paired with the neighbour whose path
shares the longest beginning. The text lines of the two are aligned by longest common subsequence and
lines that both have, being template, are deleted.

Differencing alone cannot give right results on pages where the template is filled with text of its own (adverts, footers) or
where two neighbours carry the same article, so markup decides what it can first: elements that are never main text
(menus, footers, forms, scripts, and boxes whose whole class, id or role is known boilerplate) are passed over, and lines inside an
article or main element are kept even if a neighbour has them. Differencing decides the rest.
"""

from __future__ import annotations

import bisect
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import CELL, GUARD, extended, in_order

_NAME = re.compile(r"</?([A-Za-z][^\s/><]*)")
_PLAIN = re.compile(r"[^<>\"']*")
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
#: Whole class names ('_' read as '-') and roles of boilerplate; ids leave out words that may name a section of a text.
_CLASSES = frozenset(
    "ad ads ad-box ad-slot ad-unit ad-container ad-wrapper ad-banner advert adverts advertisement advertisements advertising adsense adsbygoogle banner banner-ad sponsor sponsors sponsored sponsored-content sponsored-links promo promos "
    "cookie cookies cookie-bar cookie-banner cookie-notice cookie-consent cookie-popup consent consent-banner gdpr sidebar side-bar sidebar-left sidebar-right left-sidebar right-sidebar menu main-menu nav navbar nav-bar nav-menu main-nav site-nav navigation breadcrumb breadcrumbs "
    "footer site-footer page-footer comment comments comment-list comment-section comment-form comments-area comments-list comments-section disqus disqus-thread replies respond share share-bar share-buttons share-links sharing social social-buttons social-icons social-links social-media social-share "
    "related related-articles related-content related-links related-posts related-stories recommended recommendations newsletter newsletter-signup subscribe signup popup modal overlay widget pagination pager toolbar tag-cloud search-box search-form searchbox "
    "notice notices notification notifications alert alerts alert-box info-box disclaimer commentlist comment-respond paywall login-form contact-form".split()
)
_IDS = _CLASSES - frozenset("ad ads advertising advertisement advert adverts banner sponsor sponsors promo cookie cookies consent gdpr menu navigation comment share sharing social related recommended recommendations newsletter subscribe signup popup modal overlay widget pagination pager toolbar replies respond notice notices notification notifications alert alerts disclaimer".split())
_ROLES = frozenset("navigation banner complementary contentinfo search form menu menubar toolbar dialog alert alertdialog status".split())
_COMMENTS = frozenset("comment comments comment-list comment-section comments-area comments-list comments-section commentlist comment-respond disqus disqus-thread replies".split())
#: Last words of hyphenated class names that mark comments or adverts unless the first word tells a state; classes that make even inline elements adverts.
_COMMENT_PARTS = frozenset("comments commentlist".split())
_ADVERT_PARTS = frozenset("advert adverts advertisement advertisements".split())
_STATES = frozenset("no not has have with without is are show hide enable disable can".split())
_ADVERTS = frozenset("ad ads advert adverts advertisement advertisements adsbygoogle adsense sponsored".split())
_TOP = frozenset("header site-header masthead topbar top-bar".split())
_SPACE = re.compile(r"\s+")

_SKIP = frozenset("script style noscript template head nav footer aside form label fieldset legend optgroup option button select textarea iframe svg canvas dialog menu object audio video map datalist".split())
_RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noscript"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_MAIN = frozenset(("article", "main"))
#: Elements that no class name makes boilerplate.
_WHOLE = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark picture q s samp small span strike strong sub sup time tt u var".split())
_KNOWN = _SKIP | _RAW | _VOID | _BLOCK | _MAIN | _INLINE


_NONE = (False, frozenset(), frozenset(), "")


def _marks(attributes: str) -> tuple[bool, frozenset, frozenset, str]:
    """Whether an element is hidden, its class names, ids and role; values count only for their own attribute."""
    hidden, classes, ids, role = _NONE
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            hidden = True
        elif name == "class":
            classes = frozenset(value.lower().replace("_", "-").split())
        elif name == "id":
            ids = frozenset(value.lower().replace("_", "-").split())
        elif name == "role":
            role = value.strip().lower()
    return hidden, classes, ids, role


_END = {name: re.compile(f"</{name}\\s*>", re.I) for name in _RAW}


def _tag_end(page: str, at: int) -> tuple[int, bool]:
    """Where the attributes of a tag end that begin at ``at``, and whether by '>'. A '<' outside quotes breaks a tag off.

    Three states (outside, in either quotes) that each quote permutes: of the tags that begin at different '<' at most three are under way at any place, so a page is read in time
    that grows with its length, whatever is left open.
    """
    while True:
        at = _PLAIN.match(page, at).end()
        if at == len(page):
            return -1, False
        if page[at] in "<>":
            return at, page[at] == ">"
        at = page.find(page[at], at + 1) + 1
        if not at:
            return -1, False


def _tags(page: str) -> tuple[list[tuple], dict[int, int]]:
    """All tags as (start, end, name, closing, attributes), comments with an empty name and raw elements as one tag, and the place of the tag that closes each opened one.

    A known element whose tag another '<' breaks off ends there; anything else that looks like a tag but has no end is text. An open comment goes to the end of the page.
    """
    tags: list[tuple] = []
    opened: dict[str, list[int]] = {}
    closed: dict[int, int] = {}
    last = page.rfind(">")
    at = page.find("<")
    while at >= 0:
        start = at
        mark = next((m for m in (("<!--", "-->"), ("<![CDATA[", "]]>")) if page.startswith(m[0], start)), None)
        if mark:
            end = page.find(mark[1], start + len(mark[0]))
            at = len(page) if end < 0 else end + len(mark[1])
            tags.append((start, at, "", False, ""))
        elif start < last and page[start + 1] in "!?":
            at = page.find(">", start) + 1
            tags.append((start, at, "", False, ""))
        elif (m := _NAME.match(page, start)) is not None:
            end, whole = _tag_end(page, m.end())
            name, closing, attributes = m[1].lower(), page[start + 1] == "/", page[m.end() : end]
            if end < 0 or not whole and name not in _KNOWN:
                at = page.find("<", start + 1)
                continue
            at = end + whole
            alone = attributes.endswith("/")
            if closing:
                if own := opened.get(name):
                    closed[own.pop()] = len(tags)
            elif name in _RAW and not alone:
                end = _END[name].search(page, at)
                at, name = (end.end() if end else len(page)), ""
            elif name not in _VOID and not alone:
                opened.setdefault(name, []).append(len(tags))
            tags.append((start, at, name, closing, attributes))
        else:
            at = start + 1
        at = page.find("<", at)
    return tags, closed


def _skipped(name: str, attributes: str, depth_main: int) -> tuple[bool, bool]:
    """Whether an element is never main text, and whether it is surely so even if it holds the page's only article."""
    hidden, classes, ids, role = _marks(attributes) if attributes else _NONE
    names = classes | ids
    if name in _INLINE:
        return hidden or bool(names & _ADVERTS), False
    if name not in _WHOLE and (names or role):
        parts = {p[-1] for n in classes if "-" in n and (p := n.split("-"))[0] not in _STATES}
        if names & _COMMENTS or parts & _COMMENT_PARTS:
            return True, True
        if classes & _CLASSES or ids & _IDS or role in _ROLES or name != "article" and parts & _ADVERT_PARTS or not depth_main and names & _TOP:
            return True, False
    return name in _SKIP or name == "header" and not depth_main or hidden, False


def lines_of(page: str) -> list[tuple[str, bool]]:
    """Text blocks in page order and whether each lies in an article or main element.

    Boilerplate elements go up to the tag that closes them, whatever they hold; one that is never closed, or that holds every article and main element of the
    page, ends where the first of these begins, else at the end of the body or of the article around it. An inline element that goes does not end a block.
    """
    out: list[tuple[str, bool]] = []
    text: list[str] = []
    depth_main, around = 0, []
    tags, closed = _tags(page)
    mains = [k for k, t in enumerate(tags) if t[2] in _MAIN and not t[3]]
    bodies = [k for k, t in enumerate(tags) if t[2] == "body" and t[3]]

    def flush() -> None:
        if text:
            line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if line:
                out.append((line, depth_main > 0))

    at, k = 0, 0
    while k < len(tags):
        start, end, name, closing, attributes = tags[k]
        if start > at:
            text.append(page[at:start])
        at, k = end, k + 1
        if not name:
            continue
        if name in _BLOCK:
            flush()
        if closing:
            if name in _MAIN and depth_main:
                depth_main -= 1
                around.pop()
            continue
        if name in _VOID or attributes.endswith("/") and name not in _MAIN:
            continue
        skip, surely = _skipped(name, attributes, depth_main)
        if skip:
            own, to = k - 1, closed.get(k - 1)
            later = bisect.bisect_right(mains, own)
            holds = to is not None and not surely and later < len(mains) and mains[later] < to
            others = bool(mains) and (mains[0] < own or to is not None and mains[-1] > to)
            if name == "article" and not surely and to is not None and not depth_main and not others:
                # the page's only article, whatever it is called
                depth_main += 1
                around.append(to)
                continue
            if to is None or holds and name != "article" and not depth_main and not others:
                # never closed, or the page has no other article
                last = around[-1] if around else None
                j = bisect.bisect_right(bodies, own)
                to = last if last is not None else mains[later] if later < len(mains) and name != "article" and not surely else bodies[j] if j < len(bodies) else len(tags)
                k = to
                at = tags[k][0] if k < len(tags) else len(page)
            else:
                k, at = to + 1, tags[to][1]
            continue
        if name in _MAIN:
            depth_main += 1
            around.append(closed.get(k - 1))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def _row(a: list[str], place: dict[str, int], full: int) -> int:
    """The last row of the alignment of ``a``: a zero bit for each line of the other side that lengthens the common subsequence."""
    row = full
    for line in a:
        u = row & place.get(line, 0)
        row = (row + u | row - u) & full
    return row


def _places(b: list[str]) -> dict[str, int]:
    place: dict[str, int] = {}
    for j, line in enumerate(b):
        place[line] = place.get(line, 0) | 1 << j
    return place


def _lengths(row: int, n: int) -> np.ndarray:
    """Length of the common subsequence with the first 0, 1, .. n lines."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes((n + 7) // 8, "little"), np.uint8), count=n, bitorder="little")
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def common_lines(a: list[str], b: list[str], most: int = 1 << 24) -> list[bool]:
    """For each line of ``a`` whether a longest common subsequence with ``b`` has it.

    Bit-parallel rows and a walk back over them; beyond ``most`` cells ``a`` is halved where the two halves' lengths add up to most, so that memory stays bounded for pages of any length.
    """
    known = set(b)
    rest = [i for i, line in enumerate(a) if line in known]
    shared = [False] * len(a)

    def walk(i: int, j: int, k: int, m: int) -> None:
        """Mark the lines rest[i:j] of ``a`` that are common with b[k:m]."""
        if i == j or k == m:
            return
        if (j - i) * (m - k) > most and j - i > 1:
            mid, n = (i + j) // 2, m - k
            first = _lengths(_row([a[r] for r in rest[i:mid]], _places(b[k:m]), (1 << n) - 1), n)
            second = _lengths(_row([a[r] for r in reversed(rest[mid:j])], _places(b[k:m][::-1]), (1 << n) - 1), n)
            at = k + int((first + second[::-1]).argmax())
            walk(i, mid, k, at)
            walk(mid, j, at, m)
            return
        place, full = _places(b[k:m]), (1 << m - k) - 1
        row, rows = full, [full]
        for r in rest[i:j]:
            u = row & place.get(a[r], 0)
            row = (row + u | row - u) & full
            rows.append(row)
        x, y = j - i, m - k
        while x and y:
            bit = 1 << y - 1
            if rows[x] & bit:
                y -= 1
            elif not rows[x - 1] & bit:
                x -= 1
            else:
                shared[rest[i + x - 1]] = True
                x, y = x - 1, y - 1

    walk(0, len(rest), 0, len(b))
    return shared


def main_text(lines: list[tuple[str, bool]], neighbour: list[tuple[str, bool]] | None) -> tuple[str, int, int]:
    """Blocks joined by a newline, without the lines outside articles that the neighbour shares; how many lines differencing judged, and how many it deleted.

    Without a neighbour nothing is judged and every line stays.
    """
    free = [line for line, kept in lines if not kept] if neighbour is not None else []
    if not free:
        return "\n".join(line for line, _ in lines), 0, 0
    common = common_lines(free, [line for line, kept in neighbour or () if not kept])
    shared = iter(common)
    return "\n".join(line for line, kept in lines if kept or not next(shared)), len(free), sum(common)


def host(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def _shared_path(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text (main text), n_chars, n_judged (lines that differencing judged) and n_deleted for each page.

    Null pages are empty; a page without host has no neighbour; of two neighbours with as long a common path the one after counts; an empty table gives no rows.

    One shuffle: pages in ranges of (host, path, key), so a host of any size spreads over many tasks; each task
    also gets the rows before and after its range.
    """
    rows = pages.select(F.col(key), F.col(url), F.coalesce(F.col(page), F.lit("")).alias(page), host(url).alias("_host"), path(url).alias("_path"))
    rows = rows.withColumn("_order", F.concat_ws("\u0001", "_host", "_path", F.coalesce(F.col(key).cast("string"), F.lit(""))))
    dealt = in_order(rows, "_order", [F.col(url), F.col(page)]).select(key, url, page, "_host", "_path", CELL, GUARD)

    def run(batches):
        for (k, u, lines, h, p), before, after in _neighbours(batches):
            near = None
            options = [(_shared_path(p, o[4]), o[2]) for o in (after, before) if h and o is not None and o[3] == h]
            if options:
                near = max(options, key=lambda o: o[0])[1]
            text, judged, deleted = main_text(lines, near)
            yield k, u, text, len(text), judged, deleted

    def batched(batches):
        kind, rows_ = [None, None], []

        def seen():
            for b in batches:
                kind[:] = [b.schema.field(0).type, b.schema.field(1).type]
                yield b

        def made(rows_):
            k, u, t, *n = zip(*rows_)
            return pa.RecordBatch.from_arrays([pa.array(k, kind[0]), pa.array(u, kind[1]), pa.array(t, pa.string()), *(pa.array(x, pa.int64()) for x in n)], [key, url, "text", "n_chars", "n_judged", "n_deleted"])

        for row in run(seen()):
            rows_.append(row)
            if len(rows_) >= 1000:
                yield made(rows_)
                rows_ = []
        if rows_:
            yield made(rows_)

    return dealt.mapInArrow(batched, extended(pages.select(key, url), text="string", n_chars="long", n_judged="long", n_deleted="long"))


def _neighbours(batches):
    """(row, row before, row after) for each own row of each range, in order."""
    before = row = None
    cell, done = None, False
    for b in batches:
        for k, u, p, h, w, c, g in zip(*(col for col in b.columns)):
            c, g = c.as_py(), g.as_py()
            if c != cell:
                if row is not None:
                    yield row, before, None
                cell, before, row, done = c, None, None, False
            if done:
                continue
            new = (k.as_py(), u.as_py(), lines_of(p.as_py()), h.as_py(), w.as_py())
            if row is not None:
                yield row, before, new
                before, row = row, None
            if g == -1:
                before = new
            elif g == 0:
                row = new
            else:
                done = True
    if row is not None:
        yield row, before, None
