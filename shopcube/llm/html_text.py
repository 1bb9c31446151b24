"""Operator 4: main text of web pages by equivalence classes of template tokens.

A page is a row of tokens: its tags, each with the path of elements that it
stands in, and its text blocks.  Over the pages of a host, every token has an
occurrence vector (how often it is on each page).  Tokens with the same
vector are an equivalence class; large and frequent classes are the host's
template: the classes of tokens that stand once on nearly every page nest
around the others.  What lies between template tokens are slots.  The
innermost template element that holds nearly all text outside menus and the
like is where the search for the article starts: the slot is the article or
main element around it, or else the outermost element around it that adds no
text of the template, and it reaches to the headline.  Text that is itself a
template token is left out, unless it is most of the text in the slot on most
pages of the host: those are copies of one article, whatever else changes.

Vectors are never gathered: a commutative 64-bit sum over (page, count)
stands for each of them, so learning is one aggregation by (host, token) and
a host of any size is no hot spot.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.components import _stored, discard

FREQUENT = 0.9           # a template token is on this share of a host's pages
PAGES = 5                # and a host has a template from so many pages on
LARGE = 3                # tokens of a class
HOLDS = 0.85             # share of the text that the article's element holds

TAG_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
INSIDE_TAG = re.compile(r"""(?:[^"'>]+|"[^"]*"|'[^']*')*""")
COMMENT_END = re.compile(r"--!?>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
NAMED = {"class", "id", "role", "hidden", "aria-hidden", "style"}
PART = re.compile(r"[a-z]+")

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
LEFT_OUT = {"nav", "menu", "header", "footer", "aside", "form", "script", "style", "noscript", "template", "title",
            "head", "select", "textarea", "iframe", "svg", "canvas", "object", "dialog", "noframes", "noembed",
            "xmp", "audio", "video", "datalist"}
MARKED = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "banner",
          "promo", "promotion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
          "header", "masthead", "cookie", "cookies", "consent", "notice", "notices", "alert", "popup", "modal", "overlay",
          "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related",
          "recommended", "recommendations", "comment", "comments", "disqus", "replies", "reply", "respond", "widget",
          "toolbar", "pagination", "pager", "search", "complementary", "contentinfo", "gdpr", "paywall"}
#: Parts of a name that may stand beside one of MARKED: main-menu, post-comments, ad_box_top.
BESIDE = {"site", "page", "main", "global", "primary", "secondary", "top", "bottom", "left", "right", "center", "inner",
          "outer", "mobile", "desktop", "sticky", "fixed", "floating", "list", "item", "items", "link", "links", "area", "bar",
          "box", "block", "container", "wrapper", "wrap", "section", "panel", "pane", "slot", "unit", "zone", "col", "column",
          "row", "group", "button", "buttons", "icon", "icons", "form", "thread", "message", "dialog", "policy",
          "post", "posts", "entry", "entries", "article", "articles", "story", "stories", "news", "user", "google", "toggle",
          "wp", "js", "email", "mail", "facebook", "twitter", "recent", "popular", "latest", "categories", "archive", "tag",
          "tags", "meta", "author", "this", "previous", "prev", "next", "widgets", "legal", "copyright", "info", "logo", "cols",
          "columns", "law", "image", "img"}
AFTER = {"content", "body", "text", "title", "heading", "inside", "holder"}         # footer-content, not content-footer
REMARKS = {"comment", "comments", "disqus", "replies", "reply", "respond"}
HOLDERS = {"div", "ul", "ol", "dl", "table"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTENT = {"html", "body", "main", "article"}
BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "tbody",
          "thead", "tfoot", "caption", "blockquote", "pre", "section", "article", "main", "figure", "figcaption", "hr",
          "address", "header", "footer", "nav", "aside", "form", "details", "summary", "fieldset", "body", "html", "hgroup",
          "center", "dialog", "menu", "search"}
SPACED = {"br", "td", "th", "option", "img", "input"}
SILENT = {"script", "style", "noscript", "template", "title", "head"}
INLINE_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", url or "")
    return m[1].lower() if m else ""


@lru_cache(100_000)
def marks_of(name: str) -> frozenset[str]:
    """The parts of a class, id or role that name a menu, advert or the like; none when other parts say something else."""
    parts = PART.findall(name)
    marked = {p for p in parts if p in MARKED}
    for k, p in enumerate(parts):
        if not (p in MARKED or p in BESIDE or len(p) == 1 or p in AFTER and not MARKED.isdisjoint(parts[:k])):
            return frozenset()
    if marked == {"header"} and not {"post", "entry", "article", "story"}.isdisjoint(parts):
        return frozenset()                                 # an article's own header
    return frozenset(marked)


def named_attributes(attributes: str) -> dict[str, str]:
    """The attributes of NAMED, their values as written; the first of a name counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        if key in NAMED:
            found.setdefault(key, m[2] or "")
    return found


def hidden(name: str, attributes: dict[str, str]) -> bool:
    if not attributes or name in CONTENT and name != "article":
        return False
    return ("hidden" in attributes or attributes.get("aria-hidden", "").strip("\"'").lower() == "true"
            or "style" in attributes and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes["style"].lower())))


def marked(name: str, attributes: dict[str, str], in_article: bool) -> frozenset[str]:
    """The parts of a class, id or role that say that an element is no part of an article."""
    if not attributes or name in CONTENT and name != "article":
        return frozenset()
    for key in ("class", "id", "role"):
        for word in attributes.get(key, "").strip("\"'").lower().split():
            marks = marks_of(word)
            if not marks or in_article and marks == {"header"}:
                continue
            # an id of a heading, or of a section or text within an article, is an anchor
            if key == "id" and (name in HEADINGS or in_article and name not in HOLDERS
                                and (name != "section" or marks.isdisjoint(REMARKS))):
                continue
            return marks
    return frozenset()


def markup(html: str) -> Iterator[tuple[str, int, int, str, str]]:
    """(kind, start, end, name, attributes) of tags and comments in page order; kind is "open", "close" or "skip".

    One pass, whatever is left open: a tag that never ends is text up to the
    place where that shows, and nothing before it is read again.
    """
    at, n = 0, len(html)
    while (lt := html.find("<", at)) >= 0:
        at = lt + 1
        if html.startswith("<!--", lt):
            m = COMMENT_END.search(html, min(lt + 2, n))            # <!--> is a whole comment
            at = m.end() if m else n
            yield "skip", lt, at, "", ""
            continue
        m = TAG_NAME.match(html, lt)
        if m:
            end = INSIDE_TAG.match(html, m.end()).end()
            if end < n and html[end] == ">":
                at = end + 1
                yield ("close" if html[lt + 1] == "/" else "open"), lt, at, m[1].lower(), html[m.end():end]
            else:
                at = end + 1                                        # an open quote, or the end of the page
        elif html[at:at + 1] in ("!", "?", "/"):
            gt = html.find(">", at)
            if gt < 0:
                return
            at = gt + 1
            yield "skip", lt, at, "", ""


NO = -1


class Page:
    """One page: ``tags`` are [path id, name, words in it, left out, parent's path id] in page order, ``texts`` are
    (element, text) of the blocks outside menus and the like.  An element is a place in ``up`` (the element around
    it) and ``path`` (its path id); 0 is the page."""

    def __init__(self, html: str):
        self.wrappers: set[int] = set()
        while True:
            self.tags: list[list] = []
            self.texts: list[tuple[int, str]] = []
            self.up, self.path = [0], [0]
            found = self._blocks(html)
            if found <= self.wrappers:
                break
            self.wrappers |= found

    def _blocks(self, html: str) -> set[int]:
        """Read the page; path ids of elements that are left out by name alone and hold most of its text and its headline."""
        # name, element, left out (by its own name alone: that path id; else NO), inside an article
        stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        where: dict[str, list[int]] = {}                                   # places in the stack of each name
        blocks: list[int] = [0]                                            # and of the elements that are blocks
        tag_of, own_words = [-1], [0]                                      # of each element
        lost: dict[int, int] = {}                                          # words left out by a name alone
        headed: set[int] = set()
        out, held = [], 0                                                  # words and element of the open block
        at, n, past = 0, len(html), 0

        def flush() -> None:
            if out:
                text = " ".join("".join(out).split())
                out.clear()
                if text:
                    own_words[held] += text.count(" ") + 1
                    self.texts.append((held, text))

        def close(k: int) -> None:
            if blocks[-1] >= k:
                flush()
            for x in stack[k:]:
                where[x[0]].pop()
            del stack[k:]
            while blocks[-1] >= k:
                blocks.pop()

        def last(*names: str) -> int:
            return max((where[x][-1] for x in names if where.get(x)), default=0)

        def write(raw: str) -> None:
            nonlocal held
            top = stack[-1]
            if top[2] or not raw:
                if top[2] > 0:
                    lost[top[2]] = lost.get(top[2], 0) + len(raw.split())
                return
            if not out:
                if raw.isspace():
                    return
                held = top[1]
            out.append(unescape(raw) if "&" in raw else raw)

        for kind, start, end, name, attributes in markup(html):
            if start < past:                               # inside a script or the like
                continue
            write(html[at:start])
            at = end
            if kind == "skip":
                continue
            if kind == "close":
                k = last(name)
                if k and (name in ("article", "main", "body", "html") or k >= last("article", "main", "body", "table")):
                    close(k)
                if name == "p":
                    flush()
                continue
            if name in VOID:
                if name in SPACED and out:
                    out.append(" ")
                elif name == "hr":
                    flush()
                continue
            if name in BLOCKS:
                flush()
                if stack[blocks[-1]][0] == "p":            # a new block ends an open paragraph
                    close(blocks[-1])
            ends = INLINE_END.get(name)
            if ends:
                k = last(*ends)
                if k and k > last("ul", "ol", "table", "dl", "select", "menu", "article", "main"):
                    close(k)
            if name in ("article", "main"):                # a menu that was never closed ends here
                k = min((where[x][0] for x in ("nav", "header", "head", "menu") if where.get(x)), default=0)
                if k:
                    close(k)
            if name in SPACED and out:
                out.append(" ")
            parent = stack[-1]
            around = self.path[parent[1]]
            named = named_attributes(attributes) if attributes else {}
            path = xxhash.xxh3_64_intdigest(f"{name}|{''.join(k + v for k, v in named.items())}", around)
            if parent[2] == NO or name in LEFT_OUT and not (name == "header" and parent[3]) or hidden(name, named):
                gone = NO
            else:
                marks = frozenset() if path in self.wrappers else marked(name, named, parent[3])
                gone = parent[2] if not marks else NO if parent[2] or not marks.isdisjoint(REMARKS) else path
                if gone and gone == parent[2] and name in ("h1", "article", "main"):
                    headed.add(gone)
            if gone and not parent[2] and out and name not in BLOCKS and name not in SILENT:
                out.append(" ")
            self.tags.append([path, name, 0, gone, around])
            if attributes.endswith("/") and name in ("svg", "path"):
                continue
            if name in RAW:
                m = _raw_end(name).search(html, at)
                gt = html.find(">", m.end()) if m else -1
                if not gone:
                    write(html[at:m.start() if gt >= 0 else n])
                at = past = gt + 1 if gt >= 0 else n
                continue
            self.up.append(parent[1])
            self.path.append(path)
            tag_of.append(len(self.tags) - 1)
            own_words.append(0)
            where.setdefault(name, []).append(len(stack))
            if name in BLOCKS:
                blocks.append(len(stack))
            stack.append((name, len(self.up) - 1, gone, parent[3] or name in ("article", "main")))
        write(html[at:])
        flush()
        for x in range(len(self.up) - 1, 0, -1):           # elements come after those around them
            self.tags[tag_of[x]][2] += own_words[x]
            own_words[self.up[x]] += own_words[x]
        if not headed or any(t[1] == "article" and not t[3] and t[2] for t in self.tags):
            return set()
        words = sum(lost.values()) + sum(text.count(" ") + 1 for _, text in self.texts)
        return {x for x in headed if 2 * lost.get(x, 0) > words}

    def text_token(self, element: int, text: str) -> int:
        return xxhash.xxh3_64_intdigest(text, self.path[element])

    def within(self, region: set[int] | None) -> list[bool]:
        """For each element, whether it or one around it is in the region."""
        held = [region is None or self.path[0] in region]
        for x in range(1, len(self.up)):
            held.append(held[self.up[x]] or self.path[x] in region)
        return held

    def main(self, chosen: int | None, template: set[int]) -> str:
        """The text in the slot ``chosen`` (a path id), or else in the page's own article or main element."""
        held = self.within(self.region(chosen))
        return "\n\n".join(text for x, text in self.texts
                           if held[x] and (not template or self.text_token(x, text) not in template))

    def shared(self, chosen: int | None, template: set[int]) -> tuple[int, int]:
        """Words of the template's texts in the slot, and all words in it."""
        held, common, every = self.within(self.region(chosen)), 0, 0
        for x, text in self.texts:
            if held[x]:
                words = text.count(" ") + 1
                every += words
                common += words if self.text_token(x, text) in template else 0
        return common, every

    def region(self, chosen: int | None) -> set[int] | None:
        """The path ids of the elements that hold the article; None is the whole page."""
        own: set[int] = set()
        for name in ("article", "main"):
            own = {t[0] for t in self.tags if t[1] == name and not t[3] and t[2]}
            if own:
                break
        if chosen is None or not any(t[0] == chosen for t in self.tags):
            return self.with_headline(own) if own else None
        held = self.within({chosen})
        inside = {x for x, _ in self.texts if held[x]}
        # a slot within the page's own article, or one that is empty here, gives way to that article
        around, seen = set(), set()
        for x in inside:
            while x and x not in seen:
                seen.add(x)
                if not held[self.up[x]] or not held[x]:
                    around |= {self.path[self.up[x]]} & own
                x = self.up[x]
        return self.with_headline(around or (own if own and not inside else {chosen}))

    def with_headline(self, region: set[int]) -> set[int]:
        """A headline beside an article that has no heading of its own belongs to it."""
        heads = {t[0] for t in self.tags if t[1] == "h1" and not t[3] and t[2]}
        if len(heads) != 1 or not heads.isdisjoint(region):
            return region
        held = self.within(region)
        of_path = {self.path[x]: held[x] for x in range(1, len(self.up))}
        if any(t[1] in ("h1", "h2") and not t[3] and t[2] and of_path.get(t[0]) for t in self.tags):
            return region
        return region | heads


@lru_cache(32)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b", re.I)


TAG, TEXT, WHOLE, ARTICLE, MAIN, HEADLINE = range(6)
KINDS = {"article": ARTICLE, "main": MAIN, "h1": HEADLINE}


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def token_vectors(pages: DataFrame) -> DataFrame:
    """(host, token, kind, pages, total, vector, words, place, parent) over the pages of ``host``, ``key``, ``html``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple[str, int], list] = {}
            for host, key, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                page, own = Page(html), {}
                for place, (path, name, words, gone, parent) in enumerate(page.tags):
                    if not gone:
                        t = own.setdefault(path, [KINDS.get(name, TAG), 0, 0, place, parent])
                        t[1] += 1
                        t[2] += words
                for x, text in page.texts:
                    t = own.setdefault(page.text_token(x, text), [TEXT, 0, 0, 0, page.path[x]])
                    t[1] += 1
                    t[2] += text.count(" ") + 1
                own[0] = [WHOLE, 1, sum(t.count(" ") + 1 for _, t in page.texts), 0, 0]
                for token, (kind, count, words, place, parent) in own.items():
                    t = seen.setdefault((host, token), [kind, 0, 0, 0, 0, 0, parent])
                    t[1] += 1
                    t[2] += count
                    t[3] ^= xxhash.xxh3_64_intdigest(f"{key}/{count}")
                    t[4] += words
                    t[5] += place
            cols = list(zip(*seen.values())) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in seen], pa.string()), pa.array([_signed(t) for _, t in seen], pa.int64()),
                 pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array([_signed(v) for v in cols[3]], pa.int64()), pa.array(cols[4], pa.int64()),
                 pa.array(cols[5], pa.int64()), pa.array([_signed(p) for p in cols[6]], pa.int64())],
                names=["host", "token", "kind", "pages", "total", "vector", "words", "place", "parent"])

    each = pages.mapInArrow(run, "host string, token long, kind int, pages long, total long, vector long, "
                                 "words long, place long, parent long")
    return each.groupBy("host", "token").agg(
        F.max("kind").alias("kind"), F.sum("pages").alias("pages"), F.sum("total").alias("total"),
        F.bit_xor("vector").alias("vector"), F.sum("words").alias("words"), F.sum("place").alias("place"),
        F.max("parent").alias("parent"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, texts): the path id of the article's slot, and the text tokens of the template.

    Only tokens on nearly all pages of a host are kept, so a host's template
    is no larger than a page.
    """
    tokens = _stored(token_vectors(pages.where("host <> ''")), "page-tokens")
    hosts = (tokens.where(F.col("kind") == WHOLE).groupBy("host")
             .agg(F.sum("pages").alias("n"), F.sum("words").alias("all")))
    hosts = _stored(hosts.where(F.col("n") >= PAGES), "page-hosts")
    often = tokens.where(F.col("kind") != WHOLE).join(hosts, "host").where(F.col("pages") >= FREQUENT * F.col("n"))
    # classes: tokens of one host with the same vector
    often = often.withColumn("size", F.count("*").over(Window.partitionBy("host", "vector")))
    # an element of a large class, once on each page, that holds the text
    root = ((F.col("kind") != TEXT) & (F.col("total") == F.col("pages")) & (F.col("size") >= LARGE)
            & (F.col("words") >= HOLDS * F.col("all")))
    each = often.select("host", F.struct(                                               # of the size of a page
        "token", "parent", "kind", (F.col("total") == F.col("pages")).alias("once"), "words",
        F.when(root, F.col("place") / F.col("pages")).alias("depth")).alias("t"))
    main = each.groupBy("host").agg(F.collect_list("t").alias("tokens")).mapInArrow(_slots, "host string, main long, alike long")
    texts = (often.where(F.col("kind") == TEXT)
             .groupBy("host").agg(F.collect_list("token").alias("texts")))      # of the size of a page
    found = _stored(hosts.select("host").join(main, "host", "left").join(texts, "host", "left"), "page-slots")
    same = copies(pages.select("host", "html").join(found.where("texts IS NOT NULL"), "host"))
    learned = _stored(found.join(same.withColumn("same", F.lit(True)), "host", "left").select(
        "host", F.when(F.col("same"), F.col("alike")).otherwise(F.col("main")).alias("main"),
        F.when(F.col("same").isNull(), F.col("texts")).alias("texts")), "page-templates")
    discard(tokens, hosts, found)
    return learned


def copies(pages: DataFrame) -> DataFrame:
    """Hosts on most of whose pages (``host``, ``html``, ``main``, ``texts``) most words of the slot are template texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict[str, list[int]] = {}
            for host, html, main, texts in zip(*(b.column(i).to_pylist() for i in range(4))):
                common, every = Page(html).shared(*_learned(main, texts))
                if every:
                    t = counts.setdefault(host, [0, 0])
                    t[0] += 1
                    t[1] += 2 * common > every
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                 pa.array([c[1] for c in counts.values()], pa.int64())], names=["host", "n", "mostly"])

    each = pages.select("host", "html", "main", "texts").mapInArrow(run, "host string, n long, mostly long")
    return each.groupBy("host").agg(F.sum("n").alias("n"), F.sum("mostly").alias("mostly")).where("2 * mostly > n").select("host")


def _learned(main: int | None, texts: list[int] | None) -> tuple[int | None, set[int]]:
    mask = (1 << 64) - 1
    return None if main is None else main & mask, {t & mask for t in texts or ()}


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tokens = b.column(1).to_pylist()
        got = [pa.array([slot(t, alike) for t in tokens], pa.int64()) for alike in (False, True)]
        yield pa.RecordBatch.from_arrays([b.column(0), *got], names=["host", "main", "alike"])


def slot(tokens: list[dict], alike: bool) -> int | None:
    """The path id of the article's slot among a host's template tokens.

    The innermost root holds nearly all text, not all of it: a headline or a
    lead may stand beside it.  Where the pages are copies (``alike``), the
    article is what they share, and other text is not.
    """
    tags = {t["token"]: t for t in tokens if t["kind"] != TEXT}

    def around(token: int) -> list[int]:                 # the element and those around it, outwards
        found = []
        while token in tags:
            found.append(token)
            token = tags[token]["parent"]
        return found

    roots = [t for t in tags.values() if t["depth"] is not None]
    if not roots:
        return None
    texts = dict.fromkeys(tags, 0)                       # words of template texts in an element
    for t in tokens:
        if t["kind"] == TEXT:
            for x in around(t["parent"]):
                texts[x] += t["words"]

    def adds(outer: int, inner: int) -> bool:
        shared = texts[outer] - texts[inner]
        return 2 * shared >= tags[outer]["words"] - tags[inner]["words"] if alike else not shared

    outwards = around(max(roots, key=lambda t: (t["depth"], t["token"]))["token"])
    at = 0
    for kind in (ARTICLE, MAIN):
        named = [k for k, x in enumerate(outwards) if tags[x]["kind"] == kind]
        if named:
            at = named[-1]
            break
    else:
        while at + 1 < len(outwards) and adds(outwards[at + 1], outwards[at]):
            at += 1
    for t in tags.values():                              # a headline is text of its own on every page
        if t["kind"] == HEADLINE and t["once"] and t["words"] and (alike or not texts[t["token"]]):
            holds = set(around(t["token"]))
            at = max(at, next((k for k, x in enumerate(outwards) if x in holds), at))
    return outwards[at]


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: key, url, text, n_chars.

    A null or empty page has the text "" of 0 characters.  Pages without a
    host, or of a host with few pages, are cut by their own elements alone.
    Repeated rows give repeated results; an empty table gives an empty
    result; pages of any length are read whole.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`").cast("string"),
                                               r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), host.alias("host"),
                        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    known = templates(rows.select("host", F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"), "html"))
    joined = rows.join(known, "host", "left").select("key", "url", "html", "main", "texts")
    out = T.StructType([T.StructField(key, joined.schema["key"].dataType), T.StructField("url", joined.schema["url"].dataType),
                        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for html, main, texts in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                got.append(Page(html).main(*_learned(main, texts)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()),
                                              pa.array([len(t) for t in got], pa.int64())], names=out.names)

    return joined.mapInArrow(run, out)
