"""Main text of web pages by consensus of each host on where it stands.

1. Every page scores its containers (body, main, article, section, div and table cells): the text
   in them, less three times its links, without boilerplate. It votes for its outermost article
   or main, or without one for its deepest container with SHARE of its text, named by the path of
   tags and classes, digits taken out.
2. Spark sums the votes of each host and path, and keeps a host's leading paths (at most PATHS,
   none with less than LEAST_VOTES of the leader's).
3. Every page is extracted again, from the first of its host's paths that holds half of the
   page's text, or else from its own container. What stands around a container other than an
   article or main is text too, unless it is mostly links.

Boilerplate are scripts, styles, forms, navigation, headers outside articles, footers, asides, what
is hidden or has such a role, and elements whose class or id names a menu, sidebar, notice, advert,
form or reader comments. The noun of a name decides: its last word that is not a mere part or
frame (``siteFooter``, ``comment-list``, but not ``search-result`` or ``has-sidebar``). An element that
holds an article, a main or a first heading is no boilerplate by its name; but what is named for
comments is, with the articles in it. How much text an element holds plays no part, so a page of
nothing but a notice has no text.
Votes are summed before they are shuffled. Pages of one host are dealt over SALTS join keys, so
that a host with a third of all pages is many small groups. The work on a page grows with its
length, however its tags are nested or left open: places are numbers in a tree of paths.

Defined results: a null or empty page, and one without text, has the empty text; a null or odd
url belongs to the host of no name; repeated rows are extracted each; unclosed tags and comments
are closed where a browser would, at the end at the latest; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from tidegrid.llm.shipping import ship
from tidegrid.session import materialize

SHARE = 0.6
HOLDS = 0.5
PATHS = 5
LEAST_VOTES = 0.1
SALTS = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_CLASS = re.compile(r"""(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ID = re.compile(r"""(?:^|\s)id\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ROLE = re.compile(r"""(?:^|\s)role\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_STYLE = re.compile(r"""(?:^|\s)style\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VALUE = re.compile(r""""[^"]*"|'[^']*'""")
_RAW = {"script", "style", "title", "textarea", "xmp", "noscript", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
           "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
           "time", "tt", "u", "var", "wbr"}
_CONTAINERS = {"body", "main", "article", "section", "div", "td", "center"}
_SKIPPED = {"nav", "footer", "aside", "form", "button", "select", "svg", "head", "template", "dialog", "menu",
            "object", "canvas", "audio", "video", "map"}
# Roles of boilerplate; words for it, for what may frame it, and for what says that
# it is absent or elsewhere.
_ROLES = {"navigation", "contentinfo", "complementary", "banner", "search", "dialog", "alertdialog", "form", "menu",
          "menubar", "toolbar"}
_COMMENT_WORDS = {"comment", "comments", "commentlist", "commentform", "disqus", "replies", "respond"}
_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
          "consent", "cookie", "cookies", "footer", "form", "gdpr", "header", "login", "menu", "modal", "nav", "navbar",
          "navigation", "newsletter", "notice", "notices", "pagination", "pager", "popup", "promo", "promotion",
          "related", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
          "toolbar", "topbar"}
_FRAMES = {"area", "bar", "block", "body", "bottom", "box", "buttons", "container", "content", "div", "group", "holder",
           "inner", "item", "items", "left", "link", "links", "list", "message", "outer", "panel", "region", "right",
           "section", "slot", "text", "thread", "top", "unit", "wrap", "wrapper"}
_ABSENT = {"no", "non", "not", "has", "have", "with", "without", "hide", "hides"}
_HOLDERS = {"html", "body", "article", "main", "h1"}

# A start tag ends an open element of these, unless one of the others was opened since.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
         "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}

_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@functools.lru_cache(maxsize=4096)
def named_for(name: str) -> str:
    """What a class or id names: "comments", "header", other "boilerplate", or nothing ("")."""
    words = [w.lower() for w in _WORD.findall(name)]
    while words and words[-1] in _FRAMES and not (words[-1] == "bar" and len(words) == 1):
        words.pop()
    if not words or any(w in _ABSENT for w in words[:-1]):
        return ""
    noun = words[-1]
    if noun in _COMMENT_WORDS:
        return "comments"
    return "header" if noun == "header" else "boilerplate" if noun in _WORDS else ""


@dataclass
class Block:
    """A run of text without block tags inside, and the place of its container in the tree of paths."""

    page: Page
    place: int
    text: str
    weight: int

    @property
    def containers(self) -> list[str]:
        """The paths of the containers it stands in, outermost first."""
        found, at = [], self.place
        while at:
            found.append(self.page.path(at))
            at = self.page.up[at]
        return found[::-1]


class Page(list):
    """The text blocks of a page in order, and its tree of container paths, in which equal paths are one.

    Place 0 is the page itself. A path's place is greater than that of the path above it.
    """

    def __init__(self) -> None:
        super().__init__()
        self.up, self.steps, self.depth, self.top = [0], [""], [0], [0]
        self._places: dict[tuple[int, str], int] = {}

    def below(self, place: int, step: str) -> int:
        found = self._places.get((place, step))
        if found is None:
            found = self._places[place, step] = len(self.up)
            self.up.append(place)
            self.steps.append(step)
            self.depth.append(self.depth[place] + 1)
            whole = step.split(".", 1)[0] in ("article", "main")
            self.top.append(self.top[place] or (found if whole else 0))  # the outermost article or main
        return found

    def path(self, place: int) -> str:
        steps = []
        while place:
            steps.append(self.steps[place])
            place = self.up[place]
        return "".join(f"/{s}" for s in reversed(steps))

    def place(self, path: str) -> int:
        """The place of a path, 0 if the page has no such path."""
        at = 0
        for step in path.split("/")[1:]:
            at = self._places.get((at, step), -1)
            if at < 0:
                return 0
        return at

    def inherited(self, value, root):
        """For every place ``value(place, that of the path above)``; ``root`` for the page."""
        found = [root]
        for place in range(1, len(self.up)):
            found.append(value(place, found[self.up[place]]))
        return found

    def weights(self) -> list[int]:
        """Text weight under every path; text outside containers counts to the page."""
        found = [0] * len(self.up)
        for block in self:
            found[block.place] += block.weight
        for place in range(len(found) - 1, 0, -1):
            found[self.up[place]] += found[place]
        return found


def _attribute(pattern: re.Pattern, attributes: str) -> str:
    found = pattern.search(attributes)
    return html.unescape(next(g for g in found.groups() if g is not None)) if found else ""


def _step(tag: str, classes: str) -> str:
    names = sorted({re.sub(r"\d+", "", c).replace("/", "") for c in classes.lower().split()} - {""})
    return ".".join([tag, *names])


class _Parser:
    """Open elements as parallel stacks, and for each tag the places where it is open."""

    def __init__(self) -> None:
        self.page = Page()
        self.tags, self.places, self.skipped, self.inside, self.named = [""], [0], [False], [False], [-1]
        self.open: dict[str, list[int]] = defaultdict(list)
        self.parts: list[str] = []
        self.links = self.blocks_open = 0
        # Elements named for boilerplate: the one around each, and whether it holds an article.
        self.around: list[int] = []
        self.exempt: list[bool] = []
        self.of_block: list[int] = []

    def add(self, text: str) -> None:
        if text and not self.skipped[-1]:
            text = html.unescape(text)
            self.parts.append(text)
            if self.open["a"]:
                self.links += len(text.strip())

    def close_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text and not self.skipped[-1]:
                self.page.append(Block(self.page, self.places[-1], text, max(0, len(text) - 3 * self.links)))
                self.of_block.append(self.named[-1])
            self.parts.clear()
        self.links = 0

    def pop_to(self, at: int) -> None:
        """Close all elements from a place in the stack on."""
        if any(tag not in _INLINE for tag in self.tags[at:]):
            self.close_block()
        for tag in self.tags[at:]:
            self.open[tag].pop()
        for stack in (self.tags, self.places, self.skipped, self.inside, self.named):
            del stack[at:]

    def end(self, tag: str) -> None:
        if self.open[tag]:
            self.pop_to(self.open[tag][-1])
        elif tag == "p":
            self.close_block()

    def start(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE:
            self.close_block()
            if self.open["p"] and tag not in _VOID - {"hr"}:
                self.pop_to(self.open["p"][-1])
            if tag in _ENDS:
                closed, kept_in = (max((self.open[t][-1] for t in tags if self.open[t]), default=0)
                                   for tags in _ENDS[tag])
                if closed > kept_in:
                    self.pop_to(closed)
        if tag in _VOID or attributes.rstrip().endswith("/") and tag in ("path", "use"):
            return
        classes, inside, named = _attribute(_CLASS, attributes), self.inside[-1], self.named[-1]
        role = _attribute(_ROLE, attributes).lower() if "role" in attributes.lower() else ""
        top = tag == "header" or role == "banner"
        skipped = (self.skipped[-1] or tag in _SKIPPED or role in _ROLES and not top or top and not inside
                   or bool(_HIDDEN.search(attributes) and _HIDDEN.search(_VALUE.sub("", attributes)))
                   or bool(_UNSEEN.search(_attribute(_STYLE, attributes))))
        kinds = {named_for(n) for n in (*classes.split(), _attribute(_ID, attributes))}
        if "comments" in kinds and tag not in _HOLDERS - {"article"}:
            skipped = True
        elif "boilerplate" in kinds or "header" in kinds and not inside:
            if tag not in _HOLDERS and not (tag == "header" and inside):
                self.around.append(named)
                self.exempt.append(False)
                named = len(self.around) - 1
        if tag in ("article", "main", "h1") and not skipped:
            at = named
            while at >= 0 and not self.exempt[at]:
                self.exempt[at] = True
                at = self.around[at]
        place = self.places[-1]
        if tag in _CONTAINERS:
            place = self.page.below(place, _step(tag, classes))
        self.open[tag].append(len(self.tags))
        self.tags.append(tag)
        self.places.append(place)
        self.skipped.append(skipped)
        self.inside.append(inside or tag in ("article", "main"))
        self.named.append(named)

    def finished(self) -> Page:
        """The page without the blocks in elements that are boilerplate by their name."""
        self.close_block()
        drops: list[bool] = []
        for around, exempt in zip(self.around, self.exempt):
            drops.append(not exempt or around >= 0 and drops[around])
        self.page[:] = [b for b, named in zip(self.page, self.of_block) if named < 0 or not drops[named]]
        return self.page


def blocks(page: str) -> Page:
    """The text blocks of a page that are not boilerplate, in page order."""
    parser = _Parser()
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            parser.add(page[at:])
            break
        parser.add(page[at:found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            parser.end(tag)
        elif tag in _RAW:
            over = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = over.end() if over else end
        else:
            parser.start(tag, found[3] or found[6] or "")
    return parser.finished()


def own_path(found: Page) -> tuple[str, float]:
    """Where the page's text stands, and its share there; "" for the page.

    The outermost article or main if those hold HOLDS of the text, else the deepest container
    with SHARE of it.
    """
    place, share = _own_place(found, found.weights())
    return found.path(place), share


def _own_place(found: Page, weights: list[int]) -> tuple[int, float]:
    total = weights[0]
    tops = [(weights[p], -p) for p in range(1, len(weights)) if found.top[p] == p]
    if total and sum(w for w, _ in tops) >= HOLDS * total:
        weight, place = max(tops)
        return -place, weight / total
    fitting = [(found.depth[p], weights[p], -p) for p in range(1, len(weights)) if total and weights[p] >= SHARE * total]
    if not fitting:
        return 0, 1.0
    _, weight, place = max(fitting)
    return -place, weight / total


def _is_text(found: list[Block]) -> bool:
    """Whether blocks are text in the main, not links."""
    return 2 * sum(b.weight for b in found) >= sum(len(b.text) for b in found)


def extract(found: Page, paths: list[str]) -> str:
    """The text at the first path that holds enough of it, or else at the page's own, and around it.

    The body as a host's path says nothing. An article or main is taken whole, with other articles
    that are not links. From any other container the way goes up: what stands beside it in an outer
    one is taken if it is text, and else, as in the body, without its lists of links.
    """
    weights = found.weights()

    def is_page(place: int) -> bool:
        return found.steps[place].split(".", 1)[0] in ("", "body")

    chosen = next((p for p in map(found.place, paths)
                   if not is_page(p) and weights[0] and weights[p] >= HOLDS * weights[0]), 0)
    place = chosen or _own_place(found, weights)[0]
    if not place:
        return " ".join(b.text for b in found)
    groups: dict[object, list[Block]] = defaultdict(list)
    if found.top[place]:
        place = found.top[place]
        kept = {id(b) for b in found if found.top[b.place] == place}
        for b in found:
            if found.top[b.place] not in (0, place):
                groups[found.top[b.place]].append(b)
        kept.update(id(b) for group in groups.values() if _is_text(group) for b in group)
        return " ".join(b.text for b in found if id(b) in kept)
    way = set()
    at = place
    while at:
        way.add(at)
        at = found.up[at]
    # For every place: where its branch leaves the way up, and the branch; all below the container is in it.
    below = found.inherited(lambda p, above: above or p == place, False)
    joins = found.inherited(lambda p, above: p if p in way else above, 0)
    branch = found.inherited(lambda p, above: above or (0 if p in way else p), 0)
    kept = {id(b) for b in found if below[b.place]}
    beside: dict[int, list[Block]] = defaultdict(list)
    for b in found:
        if not below[b.place]:
            beside[joins[b.place]].append(b)
    for outer, own in beside.items():
        if not is_page(outer) and _is_text(own):
            kept.update(id(b) for b in own)
            continue
        groups.clear()
        for b in own:
            groups[id(b) if b.place == outer else -branch[b.place]].append(b)
        kept.update(id(b) for group in groups.values() if _is_text(group) for b in group)
    return " ".join(b.text for b in found if id(b) in kept)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1),
                              F.lit("")))


def _voter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.float64())])
    for batch in batches:
        votes: Counter = Counter()
        for name, page in zip(batch.column("host").to_pylist(), batch.column("html")):
            found = blocks(page.as_py() or "")
            path, share = own_path(found)
            if path:  # a page without such a container has no vote
                votes[name, path] += share
        yield pa.RecordBatch.from_pylist(
            [{"host": h, "path": p, "votes": v} for (h, p), v in sorted(votes.items())], schema)


def consensus(df: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, paths): the leading container paths of each host, best first."""
    ship(df.sparkSession)
    source = df.select(host(F.col(url)).alias("host"), F.col(page).alias("html"))
    votes = (source.mapInArrow(_voter, "host string, path string, votes double")
             .groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes")))
    ranked = votes.withColumn("place", F.row_number().over(
        Window.partitionBy("host").orderBy(F.desc("votes"), "path")))
    leader = F.max("votes").over(Window.partitionBy("host"))
    leading = ranked.withColumn("leader", leader).where(
        (F.col("place") <= PATHS) & (F.col("votes") >= LEAST_VOTES * F.col("leader")))
    return leading.groupBy("host").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias("paths"))


def main_text(df: DataFrame, id_column: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(id, url, text) for every row of ``df``."""
    winners = materialize(consensus(df, url, page), "html-paths")
    source = df.select(
        F.col(id_column).alias("id"), F.col(url).alias("url"), F.col(page).cast("string").alias("html"),
        host(F.col(url)).alias("host"), F.pmod(F.xxhash64(id_column, url), F.lit(SALTS)).alias("salt"))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = winners.select("host", "paths", F.explode(salts).alias("salt"))
    joined = source.join(salted, ["host", "salt"], "left").select("id", "url", "html", "paths")
    result = StructType([joined.schema["id"], StructField("url", joined.schema["url"].dataType),
                         StructField("text", StringType())])
    schema = to_arrow_schema(result)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(blocks(p.as_py() or ""), paths or [])
                     for p, paths in zip(batch.column("html"), batch.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], schema=schema)
    return joined.mapInArrow(run, result)
