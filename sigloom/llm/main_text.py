"""Main text of web pages by consensus paths of their hosts.

1. Every page is cut into tags and text. Each container has a generalised path: the tags from the body down, each with its first
   class, digits replaced. Text inside menus, headers, footers, sidebars, adverts, forms, comments and the like
   counts for no container. Where a class or id only looks like such a part (related-work), its text outside <article> and <main>
   doesn't count either, but is kept if the container around it wins. A container's score is the text in and below it, less twice that of links, weighted by its share of the
   page: the innermost container with nearly all of the text wins, an article before others.
2. Spark adds up the scores by host and path (with partial sums, so one host with a third of all pages is no burden) and
   keeps each host's best path: a few bytes a host.
3. Pages are joined with their host's path (those of a very large host are spread) and read again: the main text is what the
   containers with that path hold, and in a page whose own best container is another one (the article goes on beside the
   host's, or the layout is its own) also that one's blocks that are no more than half links. A page
   that has none of the host's path, or less than half of its own best container's text there, is taken by its own best path, with the
   host's path's blocks that are no more than half links.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: attributes go on to the next angle bracket; a few quoted values of bounded length may hold some, so a tag without an end costs no second look at the page
_PLAIN = r"(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+"
_QUOTED = r"(?:\"[^\"]{0,2000}\"|'[^']{0,2000}')"
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_PLAIN}(?:{_QUOTED}{_PLAIN}){{0,8}}+)>|<[!?][^<>]*+>", re.DOTALL)
ATTRIBUTE = re.compile(r"(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: elements whose content is no text
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "select", "title", "video", "audio"}
#: where such an element ends, in any case of ASCII letters
SHUT = {name: re.compile(f"</{name}", re.IGNORECASE | re.ASCII) for name in RAW}
#: elements that never hold main text
APART = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "label", "input", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
INLINE |= {"math", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mstyle", "mpadded", "mphantom", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mtable", "mtr", "mtd", "menclose", "mfenced", "semantics", "annotation", "annotation-xml"}
#: elements that an opening tag of the key closes first
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "blockquote", "html"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: words of class, id or role that make a part outside <article> and <main> count for no container; inside the winning container its text is kept
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|header|masthead|topbar|footer|foot|sidebar|side|widget\w*|related|recommend\w*"
    r"|comments?|commentlist|replies|reply|disqus|discussion|respond|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|search|pagination|pager"
    r"|copyright|disclaimer|toolbar|tags?|skip|contentinfo|complementary|navigation|dialog)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: roles, and classes or whole ids with a word of the first kind and none but of both kinds, that are never main text. Slugs of headings (related-work, side-effects) aren't
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar", "toolbar"}
BOILERPLATE = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo|promos|promotions?|banners?|notices?|alerts?|nav\w*|menus?|menubar|breadcrumbs?|masthead|topbar|footer|sidebars?|widgets?|related|recommended|recommendations?"
    r"|comments?|commentlist|replies|disqus|respond|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|pagination|pager|copyright|toolbar|tags|skip|skiplinks?"
)
NEUTRAL = re.compile(r"\d*|posts?|pages?|site|main|entry|articles?|stories|blog|lists?|items?|box(?:es)?|bar|buttons?|btns?|icons?|links?|wrap|wrapper|container|inner|outer|area|section|block|slot|unit|top|bottom|left|right|header|side|media|form|follow|notice|reply|us|this|text|meta|primary|secondary|global|mobile|desktop|info|warning|danger|success|error")
#: whole ids of readers' comments, also inside <article> and <main>
COMMENTS = {"comments", "comment-list", "commentlist", "comments-section", "comments-area", "disqus_thread", "respond"}
#: a path longer than this goes on from its hash
LONG_PATH = 240
#: a tag that the page's end cuts off
BROKEN = re.compile(r"<[/a-zA-Z!].*\Z", re.DOTALL)
#: a class like has-sidebar speaks of the layout, not of the part
LAYOUT = re.compile(r"\S*(?:\b|[_-])(?:has|with|no|without)[_-]\S*", re.IGNORECASE)
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
#: pages from which on a host's are spread, and over how many keys
LARGE_HOST = 10_000
SPREAD = 4096
SITE = {"header", "site-header", "page-header", "foot"}
WORDS = re.compile(r"[_-]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def boilerplate(token: str) -> bool:
    """Whether a class, or a whole id, names a part that is never main text."""
    words = WORDS.split(token.lower())
    return any(BOILERPLATE.fullmatch(w) for w in words) and all(BOILERPLATE.fullmatch(w) or NEUTRAL.fullmatch(w) for w in words)


class Page:
    """A page's blocks of text, each with the containers around it, and the containers' paths."""

    def __init__(self, source: str):
        self.paths: list[str] = [""]
        self.parents: list[int] = [-1]
        self.depths: list[int] = [0]
        self.blocks: list[tuple[int, str, int, int]] = []  # container, text, characters of links, container around a doubtful mark or -1
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool, int]] = []  # tag, container, apart, doubt
        container, apart, doubt, links = 0, False, -1, 0
        words: list[str] = []
        linked = 0
        opened: Counter[str] = Counter()  # names on the stack

        def end_block():
            nonlocal words, linked
            if words:
                text = SPACE.sub(" ", entities.unescape("".join(words))).strip()
                if text:
                    self.blocks.append((container, text, linked, doubt))
                words, linked = [], 0

        def close(k: int):
            nonlocal container, apart, doubt, links
            _, container_, apart_, doubt_ = stack[k]
            if any(t[0] not in INLINE for t in stack[k:]):
                end_block()
            links -= sum(t[0] == "a" for t in stack[k:])
            opened.subtract(t[0] for t in stack[k:])
            del stack[k:]
            container, apart, doubt = container_, apart_, doubt_

        at = 0
        for found in TAG.finditer(source):
            if found.start() < at:
                continue
            if found.start() > at and not apart:
                text = source[at : found.start()]
                words.append(text)
                if links > 0:
                    linked += len(text)
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                if name == "br" or name in VOID:
                    continue
                if opened[name] > 0:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
                elif name == "p":
                    end_block()
                continue
            if name in RAW:
                shut = SHUT[name].search(source, at)
                if not shut:
                    at = len(source)
                    break
                at = source.find(">", shut.end()) + 1 or len(source)
                continue
            if name in VOID:
                if name == "br":
                    words.append(" ")
                elif name == "hr":
                    end_block()
                continue
            if found[3].rstrip().endswith("/") and name not in INLINE and name not in CONTAINERS and name != "p":
                continue
            if name not in INLINE:
                # a paragraph ends before the next block, and what is open in it goes with it
                if opened["p"] > 0:
                    k = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p" or stack[i][0] in CONTAINERS)
                    if stack[k][0] == "p":
                        close(k)
                for other in CLOSES.get(name, ()):
                    if opened[other] <= 0:
                        continue
                    k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == other or stack[i][0] in ("ul", "ol", "dl", "table", "tbody")), None)
                    if k is not None and stack[k][0] == other:
                        close(k)
                end_block()
            stack.append((name, container, apart, doubt))
            opened[name] += 1
            if name == "a":
                links += 1
            if name not in INLINE:
                marks = found[3]
                named = dict((a.lower(), b or c or d) for a, b, c, d in ATTRIBUTE.findall(marks)) if marks.strip() else {}
                within = opened["article"] > 0 or opened["main"] > 0
                whole = name in ("body", "html", "article", "main")
                known = LAYOUT.sub(" ", named.get("class", ""))
                marked = not whole and (any(boilerplate(c) for c in known.split()) or any(c in ROLES for c in named.get("role", "").lower().split()))
                if not within and not whole and name != "section" and name not in HEADINGS:
                    own = named.get("id", "").strip()
                    marked = marked or boilerplate(own) or own.lower() in SITE
                marked = marked or "site-header" in known.split() or (name in ("div", "section", "ol", "ul") and named.get("id", "").strip().lower() in COMMENTS)
                if name in APART or (name == "header" and not within) or "hidden" in named or named.get("aria-hidden") == "true" or marked:
                    apart = True
                elif not within and not whole and doubt < 0 and MARKS.search(" ".join([known, LAYOUT.sub(" ", named.get("id", "")), named.get("role", "")])):
                    doubt = container
                elif name in CONTAINERS:
                    first = DIGITS.sub("#", (named.get("class", "").split() or [""])[0].lower())
                    above = self.paths[container]
                    above = above if len(above) <= LONG_PATH else "#" + hashlib.md5(above.encode(), usedforsecurity=False).hexdigest()
                    self.paths.append(f"{above}/{name}{'.' + first[:LONG_PATH] if first else ''}")
                    self.parents.append(container)
                    self.depths.append(self.depths[container] + 1)
                    container = len(self.paths) - 1
        if at < len(source) and not apart:
            words.append(BROKEN.sub("", source[at:]))
        end_block()

    def scores(self) -> dict[str, float]:
        """Each path's score: text without links in and below its containers, weighted by how little they leave out and how deep they lie."""
        own = [0.0] * len(self.paths)
        for container, text, linked, doubt in self.blocks:
            if doubt >= 0:
                continue
            own[container] += len(text) - 2 * min(linked, len(text))
        total = own[:]
        for k in range(len(total) - 1, 0, -1):
            total[self.parents[k]] += total[k]
        whole = max(total[0], 1.0)
        out: dict[str, float] = {}
        for k, path in enumerate(self.paths):
            if total[k] > 0:
                share = min(1.0, total[k] / whole)
                # of containers with the same text the innermost wins; one that lacks a tenth of the text loses to its parent
                depth = self.depths[k]
                kind = 0.25 if path.rpartition("/")[2].split(".")[0] in ("article", "main") else 0.0
                out[path] = max(out.get(path, 0.0), whole * (share**4 + 0.002 * depth + kind * share))
        return out

    def _inside(self, path: str) -> list[bool]:
        """Which blocks lie in containers of this path."""
        inside = [False] * len(self.paths)
        for k, own in enumerate(self.paths):
            inside[k] = own == path or (self.parents[k] >= 0 and inside[self.parents[k]])
        return [inside[container] and (doubt < 0 or inside[doubt]) for container, _, _, doubt in self.blocks]

    def text(self, path: str, own: str | None = None) -> str:
        """The blocks inside containers of this path, an empty line between them; with `own`, also those in containers of that
        path that are no more than half links and not under a doubtful mark."""
        kept = self._inside(path)
        if own is not None:
            more = self._inside(own)
            kept = [k or (m and b[3] < 0 and 2 * b[2] <= len(b[1])) for k, m, b in zip(kept, more, self.blocks, strict=True)]
        return "\n\n".join(b[1] for b, k in zip(self.blocks, kept, strict=True) if k)

    def best(self) -> str:
        return min(self.scores().items(), key=lambda x: (-x[1], x[0]), default=("", 0.0))[0]


def extract(pages: DataFrame, large_host: int = LARGE_HOST) -> DataFrame:
    """One row for each row of pages (page_id, url, html): page_id, url, host, path (the one used), text (blocks joined by two line breaks).

    Character references are decoded, white space inside a block becomes one blank. Null and empty pages have an empty text and an
    empty path. Pages with a null or odd url form hosts of their own by what is there (null: one host). Rows that repeat are read
    each; other columns are ignored. Hosts with `large_host` pages or more are broadcast with their path (a row for so many pages at most).
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), host.alias("host"), F.col("html"))

    def vote(batches):
        for batch in batches:
            sums: dict[tuple[str, str], int] = {}
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if source:
                    page = Page(source)
                    scores, top = page.scores(), page.best()
                    for path, score in scores.items():
                        # a page counts the same whatever its length, and its best path twice
                        sums[name, path] = sums.get((name, path), 0) + round(1000 * score / scores[top]) + 1000 * (path == top)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums]), pa.array([k[1] for k in sums]), pa.array(list(sums.values()), pa.int64())], names=["host", "path", "votes"])

    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    won = votes.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("won"))

    def read(batches):
        for batch in batches:
            texts, paths = [], []
            for source, path in zip(batch.column("html").to_pylist(), batch.column("won").to_pylist(), strict=True):
                text, used = "", ""
                if source:
                    page = Page(source)
                    used = path if path is not None else page.best()
                    own = page.best()
                    if own == used:
                        text = page.text(used)
                    elif 2 * len(page.text(used)) < len(page.text(own)):
                        text, used = page.text(own, used), own
                    else:
                        text = page.text(used, own)
                texts.append(text)
                paths.append(used)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "host", "path", "text"])

    schema = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("host", StringType()), StructField("path", StringType()), StructField("text", StringType())])
    # pages of a host with very many go by a key of their own, so that they spread; their path comes with the list of such hosts
    large = rows.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") >= large_host).select("host")
    large = won.join(large, "host").withColumnRenamed("won", "known")
    dealt = rows.join(F.broadcast(large), "host", "left")
    apart = F.concat_ws("/", "host", F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("string"))
    dealt = dealt.withColumn("dealt", F.when(F.col("known").isNotNull(), apart).otherwise(F.col("host")))
    dealt = dealt.join(won.withColumnRenamed("host", "dealt"), "dealt", "left").withColumn("won", F.coalesce("known", "won"))
    return dealt.select("page_id", "url", "host", "html", "won").mapInArrow(read, schema)
