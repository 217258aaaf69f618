"""Main text of web pages, from container paths that the pages of a host agree on.

1. Each page is cut into blocks of text. A block's path lists the tags and classes
   of the elements around it, generalised: digits in a class are replaced, so that
   ``post-17`` and ``post-18`` are one path. Parts that are never main text (menus,
   headers, footers, sidebars, notices, adverts, forms, scripts, drawings, comments
   of readers) are recognised by tag, role, class and id and left out. A class, id or
   role is taken word by word, ``commentList`` and ``comment-list`` alike: it names such
   a part when all its words do or usually stand beside such words, or when it begins or
   ends with a word that has no other use (``reader-comments``, ``dfp-ad``).
   ``legal-history`` names none. Headings and paragraphs of an article are left out
   only by the latter, and a header whose name says that it is the article's stays.
2. A block's length, less what is inside links, counts for its container and half for
   the next one around it. Lists, tables, quotes, figures and sections are content, not
   containers. What a container got goes to the article around it, and on to ancestors
   of which it holds nearly all, apart from headings and text that stand beside it.
   A page proposes all its containers, with their shares.
3. Spark adds the proposals up by host and path; the path with the highest sum wins.
   A page gives each path at most one vote in all, so long pages do not outvote.
4. Each page is read again: its text is that of its containers with the host's
   winning path, and empty where those hold no text. A page that opens no element of
   that path uses its own best container.

Inside a block white space becomes one blank; ``br`` is white space. Character
references are decoded. Blocks are joined in page order by two line feeds. Elements are
told apart down to ``MAX_DEPTH``, which is as deep as browsers nest; what is deeper
belongs to the one there. Long paths are shortened by a hash of their first part.

Defined cases: null, empty and text-free pages give an empty text. Text outside
any element is a page's own container. Unclosed and misnested tags close as
browsers do in the plain cases. A null or unreadable url belongs to a host of its
own name, the empty one. Of paths with equal votes the first by name wins. Repeated
rows each give their result. Pages may be of any length and depth; one task reads a
page whole. An empty table gives an empty result. Columns of the input stay; ``main_text`` is replaced.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm import common

# Element kinds, and words in a class, id or role that mark what is not main text.
RAW = ("script", "style", "template", "textarea", "noscript", "iframe")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center caption dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CONTENT = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup li blockquote pre dt dd td th tr tbody thead tfoot caption table ul ol dl figcaption "
    "figure section details summary".split()
)
LEFT_OUT_TAGS = frozenset(
    "head title nav aside footer form button select option dialog menu audio video svg".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay menu nav navbar navigation "
    "breadcrumb breadcrumbs toc sidebar aside widget widgets related recommended recommendations share sharing social "
    "comment comments respond replies disqus newsletter subscribe subscription signup login search footer masthead "
    "topbar toolbar pagination pager skip legal copyright complementary contentinfo".split()
)
HEADER_WORDS = frozenset("header masthead".split())
#: Words that make a known compound with those above, as in ``share-buttons``; any other keeps the element.
BESIDE_WORDS = frozenset(
    "area bar block blocks box boxes btn button buttons card cards center column container fixed global google group "
    "holder icon icons inner inline item items large left link links list lists main md menu mobile module mw outer "
    "page panel post posts primary right row secondary section site slot small sticky story stories tertiary tools "
    "top bottom unit wp wrap wrapper x form entry article articles text".split()
)
COMPOUNDS = frozenset("skip-to-content skip-to-main skip-to-main-content".split())
#: Words that, first or last in a name, leave no doubt; others do so last, or with certain words beside them.
FIRST_OR_LAST = frozenset("comment comments commentlist commenters disqus sponsored advert advertisement adsbygoogle adsense".split())
LAST = frozenset("ad ads advertising".split())
BESIDE_THEM = {
    "cookie": frozenset("policy law settings preferences info message choices".split()),
    "cookies": frozenset("policy law settings preferences info message choices".split()),
    "social": frozenset("media network networks follow profiles channels".split()),
    "related": frozenset("content news reading topics pages products videos coverage".split()),
    "share": frozenset("this on via it us page".split()),
}
#: Words that are written as one with those above.
JOINED = re.compile(
    r"(comments?|ads?|cookies?|social|share|related)"
    r"(list|thread|threads|section|area|box|boxes|slot|unit|banner|bar|notice|consent|buttons?|links?|icons?|media|posts?|articles?|wrap|wrapper|container)"
)
ARTICLE_WORDS = frozenset("article post entry story title headline content".split())
#: Tags that end an svg or math element left open, as in browsers, and tags inside them that hold plain markup.
BREAKOUT = BLOCK | frozenset("b big br code em embed head i img meta nobr ruby s small span strike strong sub sup tt u".split())
FOREIGN = frozenset("svg math".split())
PLAIN_INSIDE = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
CLOSED_BY = {
    "p": BLOCK - {"body", "html"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option"}),
}
SCOPES = frozenset("html body table ul ol dl article section main div aside nav header footer form".split())

ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(
    rf"<!--(?:.*?-->|.*)|<(?P<raw>{'|'.join(RAW)})\b{ATTRIBUTES}(?:/>|>(?:.*?</(?P=raw)\s*>|.*))"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>{ATTRIBUTES})>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*+\Z",
    re.DOTALL | re.IGNORECASE,
)
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[^\W\d_]+")
#: Where small and capital letters meet, as in ``commentList``.
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SLUGGED = frozenset("p h1 h2 h3 h4 h5 h6 hgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: A container goes up to an ancestor in which others hold no more than this part of the text.
OTHERS = 0.1
#: Elements nested deeper share the path of the one at this depth.
MAX_DEPTH = 512
LONG_PATH = 400
MIN_LENGTH = 20


class _Element:
    __slots__ = ("tag", "parent", "depth", "inside", "left_out", "path", "holder", "block", "container", "foreign")

    def __init__(self, tag: str, attributes: str, parent: _Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.inside = bool(parent and (parent.inside or parent.tag in ("article", "main")))
        marks = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in MARKS.finditer(attributes)} if attributes else {}
        classes = marks.get("class", "").split()
        # The element whose path this is, itself unless nested too deep.
        self.holder: _Element = parent.holder if parent and self.depth > MAX_DEPTH else self
        if self.holder is self:
            name = ".".join([tag, *sorted(re.sub(r"\d+", "#", c.lower()) for c in classes)])
            self.path = f"{_short(parent.path)}>{name}" if parent else name
        else:
            self.path = self.holder.path
        self.left_out = bool(parent and parent.left_out) or self._marked(marks, classes)
        inner = parent.foreign if parent and tag not in PLAIN_INSIDE else None
        self.foreign: _Element | None = inner or (self if tag in FOREIGN else None)
        self.block: _Element = parent.block if parent and tag not in BLOCK else self
        self.container: _Element = parent.container if parent and (tag in CONTENT or tag not in BLOCK) else self.holder

    def _marked(self, marks: dict, classes: list[str]) -> bool:
        if self.tag in ("html", "body", "main", "article"):
            return False
        if self.tag in LEFT_OUT_TAGS:
            return True
        tokens = [*classes, *marks.get("role", "").split()]
        if self.tag == "header" and not self.inside and not any(_is_articles_own(t) for t in tokens):
            return True
        if self.inside and self.tag in SLUGGED:
            return any(_leaves_no_doubt(_words(token)) for token in tokens)  # their other classes are of style
        # Ids of headings and paragraphs are made from the article's text. Other ids inside an article
        # often are those of its parts: they count as whole names only.
        ids = [] if self.tag in SLUGGED else marks.get("id", "").split()
        return any(_names_left_out(token, self.inside) for token in [*tokens, *ids]) or any(
            _leaves_no_doubt(_words(token)) for token in (tokens if self.inside else [*tokens, *ids])
        )


def _short(path: str) -> str:
    """A path that may go on growing: its first part is told by a hash where it is long."""
    return path if len(path) <= LONG_PATH else "#" + hashlib.blake2b(path.encode(), digest_size=16).hexdigest()


def _words(token: str) -> list[str]:
    found = []
    for word in WORD.findall(CAMEL.sub(" ", token).lower()):
        joined = JOINED.fullmatch(word)
        found += joined.groups() if joined else [word]
    return found


def _is_articles_own(token: str) -> bool:
    """Whether the name of a header says that it is the article's."""
    words = set(_words(token))
    return bool(words & HEADER_WORDS and words & ARTICLE_WORDS)


def _leaves_no_doubt(words: list[str]) -> bool:
    if not words:
        return False
    if words[0] in FIRST_OR_LAST or words[-1] in FIRST_OR_LAST or words[-1] in LAST:
        return True
    beside = BESIDE_THEM.get(words[0], frozenset())
    known = beside | LEFT_OUT_WORDS | BESIDE_WORDS
    return words[0] in BESIDE_THEM and len(words) > 1 and all(w in known for w in words[1:])


def _names_left_out(token: str, inside: bool) -> bool:
    """Whether all of a class, id or role names what is never main text."""
    if token.lower() in COMPOUNDS:
        return True
    words = set(_words(token))
    named = words & (LEFT_OUT_WORDS if inside or _is_articles_own(token) else LEFT_OUT_WORDS | HEADER_WORDS)
    return bool(named) and words <= named | BESIDE_WORDS


class Page:
    """Blocks of a page, each (innermost block element, text, letters inside links)."""

    def __init__(self, source: str):
        self.blocks: list[tuple[_Element, str, int]] = []
        self.opened: set[str] = set()
        self.at = self.root = _Element("page", "", None)
        # Open elements by tag, innermost last, and the open scopes: end tags are matched at any depth.
        self.stack: dict[str, list[_Element]] = defaultdict(list)
        self.scopes = [self.root]
        self.pieces: list[str] = []
        self.linked, self.links = 0, 0
        done = 0
        for match in TOKEN.finditer(source):
            if match.start() > done:
                self._text(source[done : match.start()])
            done = match.end()
            tag = match["tag"] or match["tag2"]
            if tag:
                tag = tag.lower()
                if match["close"] or match["close2"]:
                    self._close(tag)
                else:
                    self._open(tag, match["attributes"] or match["attributes2"] or "")
        if done < len(source):
            self._text(source[done:])
        self._end_block()

    def _text(self, text: str) -> None:
        if not self.at.left_out:
            self.pieces.append(text)
            if self.links:
                self.linked += len(text.strip())

    def _end_block(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                self.blocks.append((self.at.block, text, min(self.linked, len(text))))
            self.pieces = []
        self.linked = 0

    def _open(self, tag: str, attributes: str) -> None:
        if self.at.foreign is not None and tag in BREAKOUT:
            self._leave(self.at.foreign)
        if tag == "br":
            self._text(" ")
            return
        if tag in BLOCK:
            self._end_block()
            closed = [self.stack[t][-1] for t, by in CLOSED_BY.items() if tag in by and self.stack[t]]
            nearest = max(closed, key=lambda element: element.depth, default=None)
            if nearest is not None and nearest.depth > self.scopes[-1].depth:
                self._leave(nearest)
        if tag in VOID:
            return
        if tag == "a":
            self.links = 1
        if not attributes.endswith("/") or tag in BLOCK:
            self.at = _Element(tag, attributes, self.at)
            self.stack[tag].append(self.at)
            if tag in SCOPES:
                self.scopes.append(self.at)
            if not self.at.left_out:
                self.opened.add(self.at.path)

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_block()
        if tag == "a":
            self.links = 0
        if self.stack[tag] and (tag in SCOPES or self.stack[tag][-1].depth > self.scopes[-1].depth):
            self._leave(self.stack[tag][-1])

    def _leave(self, element: _Element) -> None:
        """Close an open element and all that is open inside it."""
        while self.at.depth >= element.depth and self.at.parent is not None:
            self.stack[self.at.tag].pop()
            if self.at.tag in SCOPES:
                self.scopes.pop()
            self.at = self.at.parent

    def shares(self) -> dict[str, float]:
        """Each container path's part of all that the page's blocks count."""
        score: dict[_Element, float] = defaultdict(float)
        direct: dict[_Element, list[int]] = defaultdict(lambda: [0, 0])
        for block, text, linked in self.blocks:
            plain, inner = len(text) - linked, block.container
            direct[inner][block.tag in HEADINGS] += plain
            if plain < MIN_LENGTH or 2 * linked > len(text):
                continue
            score[inner] += plain
            if inner.parent is not None:
                score[inner.parent.container] += plain / 2
        # By path: text that stands in the container itself, and all text and all headings inside it.
        own: dict[str, int] = defaultdict(int)
        held: dict[str, int] = defaultdict(int)
        heads: dict[str, int] = defaultdict(int)
        sums: dict[int, dict[_Element, list[int]]] = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for inner, (text_, headings) in direct.items():
            own[inner.path] += text_
            sums[inner.depth][inner][0] += text_ + headings
            sums[inner.depth][inner][1] += headings
        for depth in range(max(sums, default=0), -1, -1):
            for element, (all_, headings) in sums[depth].items():
                held[element.path] += all_
                heads[element.path] += headings
                if element.parent is not None:
                    up = sums[depth - 1][element.parent]
                    up[0] += all_
                    up[1] += headings
        total = sum(score.values())
        shares: dict[str, float] = defaultdict(float)
        whole: dict[str, str] = {}
        for element, points in score.items():
            if element.path not in whole:
                whole[element.path] = _whole(element, own, held, heads)
            shares[whole[element.path]] += points / total
        return dict(shares)

    def text_of(self, path: str) -> str:
        known: dict[_Element, bool] = {}

        def within(element: _Element) -> bool:
            chain = []
            at: _Element | None = element.holder
            while at is not None and at not in known and at.path != path:
                chain.append(at)
                at = at.parent
            answer = at is not None and known.get(at, True)
            known.update(dict.fromkeys(chain, answer))
            return answer

        return "\n\n".join(text for block, text, _ in self.blocks if within(block))


def _whole(element: _Element, own: dict[str, int], held: dict[str, int], heads: dict[str, int]) -> str:
    """Path of the container to which an element's text belongs, with what stands beside it."""
    around = {}
    at: _Element | None = element
    while at is not None:
        around.setdefault(at.tag, at)
        at = at.parent
    at = chosen = around.get("article") or around.get("main") or element
    others = 0
    while at.parent is not None:
        up = at.parent
        joined = own[up.path] + heads[up.path] - heads[at.path]
        others += held[up.path] - held[at.path] - joined
        if others > OTHERS * held[up.path]:
            break
        if joined or (others and up.tag not in ("html", "body", "page")):
            chosen = up
        at = up
    return chosen.path


def main_text(source: str, winner: str | None) -> str:
    page = Page(source)
    # An element of the winning path may be there without text: then the page has none.
    if winner and (winner in page.opened or winner == page.root.path):
        return page.text_of(winner)
    shares = page.shares()
    if shares:
        return page.text_of(min(shares, key=lambda path: (-shares[path], path)))
    return "\n\n".join(text for _, text, _ in page.blocks)


def host(url: Column) -> Column:
    """The host in lower case, without user, port and a leading ``www.``; empty where there is none."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(found, r"^www\.", "")


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the container path with the most votes of each host's pages."""

    @F.arrow_udf("array<struct<path:string,share:double>>")
    def propose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("share", pa.float64())]))
        for sources in batches:
            rows = []
            for source in sources:
                shares = Page(source.as_py() or "").shares()
                rows.append([{"path": p, "share": s} for p, s in shares.items()])
            yield pa.array(rows, kind)

    votes = pages.select(host(F.col(url_col)).alias("host"), F.explode(propose(F.col(html_col))).alias("vote"))
    sums = votes.groupBy("host", "vote.path").agg(F.sum(F.round("vote.share", 6).cast("decimal(20,6)")).alias("share"))
    # Of equal sums the path that comes first by name wins.
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("share"), F.col("path"))).alias("path"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The rows with ``main_text``."""

    @F.arrow_udf("string")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sources, winners in batches:
            rows = [main_text(s.as_py() or "", w.as_py()) for s, w in zip(sources, winners)]
            yield pa.array(rows, pa.string())

    common.ship(pages.sparkSession)
    pages = pages.drop("main_text")
    winners = common.stored(winning_paths(pages, url_col, html_col), "winning-paths")
    winners = winners.select(F.col("host").alias("__host"), F.col("path").alias("__path"))
    joined = pages.withColumn("__host", host(F.col(url_col))).join(winners, "__host", "left")
    return joined.select(*pages.columns, read(F.col(html_col), F.col("__path")).alias("main_text"))
