"""Main text of web pages: containers are scored, hosts agree on a path, and pages are read again by it."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import pieces, small, written

#: Attributes of a tag: a quote opens a value after = alone, and the value ends at the next such quote, however far.
ATTRIBUTES = r"(?>[^>=]++|=\s*+(?>\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+"
#: A comment, a raw-text element, a tag, or another declaration. Groups: raw element, close, name, attributes.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|noscript|template|textarea|iframe|svg)\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
OPENING = re.compile(r"</?[a-zA-Z][^\s/>]*")
STOP = re.compile(r">|=\s*+([\"'])")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Attributes that are looked at.
KINDS = re.compile(r"class|id|role", re.IGNORECASE)

CONTAINERS = frozenset("body main article section div td center blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
    "legend li menu nav ol p pre summary table tbody tfoot th thead tr ul head title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head title nav footer aside form button select menu dialog label option fieldset object canvas audio video".split())
#: An opening tag ends an open one of these kinds, up to the nearest of the others.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner banners breadcrumb breadcrumbs comment comments consent cookie "
    "cookies contentinfo disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination paywall popup promo promoted related replies reply respond search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Words that say where or how large such a part is; a name made of these and at least one mark is marked.
PLAIN = frozenset(
    "site top bottom left right main global box wrapper wrap container inner outer list section area block item items bar button "
    "buttons link links posts articles stories content post article entry user reader unit slot"
    .split()
)
#: A header of one of these belongs to the article.
HEADED = frozenset("post article entry section content block item list".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
#: Share of a page's kept text that its main container must hold.
SHARE = 0.6
#: Share of an ancestor's text from which containers beside the main one count as more of the article.
BESIDE = 0.1


def unending(html: str) -> Callable[[int], bool]:
    """Tells whether the tag whose attributes begin at a place never ends. Linear in the page, however many such tags."""
    stops = list(STOP.finditer(html))
    starts = [m.start() for m in stops]
    ends = [False] * (len(stops) + 1)
    following: dict[str, int] = {}  # the first quote after the stop, from the last stop backwards
    edge = len(html)
    for k in range(len(stops) - 1, -1, -1):
        after = stops[k].end()
        for quote in "\"'":
            at = html.find(quote, after, edge)
            if at >= 0:
                following[quote] = at
        edge = after
        quote = stops[k].group(1)
        ends[k] = quote is None or (quote in following and ends[bisect_left(starts, following[quote] + 1)])
    return lambda at: not ends[bisect_left(starts, at)]


def tokens(html: str) -> Iterator[re.Match]:
    """Comments, raw-text elements, tags and declarations in order; what never ends is text."""
    never: Callable[[int], bool] | None = None
    last = html.rfind(">")
    at = html.find("<")
    while at >= 0:
        token = None
        opening = OPENING.match(html, at)
        if at < last or html.startswith("<!--", at):
            if not (never and opening and never(opening.end())):
                token = TOKEN.match(html, at)
                if token is None and opening and never is None:
                    never = unending(html)
        if token:
            yield token
        at = html.find("<", token.end() if token else at + 1)


def marked(name: str, inside: bool) -> bool:
    """Whether a class, id or role as a whole names a part that is not the article; ``inside`` an article no header is."""
    words = {w.lower() for w in SPLIT.split(name) if w}
    marks = words & MARKS
    if "header" in marks and (inside or words & HEADED):
        marks = marks - {"header"}
    return bool(marks) and words <= MARKS | PLAIN


class Page:
    """Blocks of a page in order, as (text, node), and its nodes: parent, tag, generalised name, characters below.

    Linear in the page: what a tag inherits is kept with it when it opens, and where the nearest open tag of a name
    stands is known without a look at the others.
    """

    def __init__(self, html: str):
        self.parent, self.tag, self.name = [-1], ["html"], ["html"]
        self.blocks: list[tuple[str, int]] = []
        self._container = [0]  # the smallest container around each node, itself included
        self._paths: dict[tuple[int, str], int] = {(-1, "html"): 0}  # (path of the parent, name) to path
        self._path = [0]
        self._read(html)
        self.below = [0] * len(self.parent)
        self.own = [False] * len(self.parent)  # whether text stands in no smaller container
        for text, node in self.blocks:
            self.own[self._container[node]] = True
            self.below[node] += len(text)
        for node in range(len(self.parent) - 1, 0, -1):  # parents come before their children
            self.below[self.parent[node]] += self.below[node]

    def _read(self, html: str) -> None:
        # Of each open tag: node, name, left out, in an article, node of the nearest block, place of that block, blocks so far.
        stack: list[tuple[int, str, bool, bool, int, int, int]] = [(0, "html", False, False, 0, 0, 1)]
        places: dict[str, list[int]] = {"html": [0]}  # of the open tags of a name
        held: list[str] = []
        at = 0

        def flush() -> None:
            if held:
                text = " ".join(unescape("".join(held)).split())
                held.clear()
                if text:
                    self.blocks.append((text, stack[-1][4]))

        def close_from(place: int) -> None:
            while len(stack) > place:
                places[stack.pop()[1]].pop()

        def nearest(names: Iterable[str]) -> int:
            return max((places[n][-1] for n in names if places.get(n)), default=-1)

        def end_implied(name: str) -> None:
            ends, bound = IMPLIED.get(name, (None, None))
            while True:
                if ends is None:
                    place = stack[-1][5]
                    if stack[place][1] != "p":
                        return
                    close_from(place)
                    continue
                paragraph, end = nearest(("p",)), nearest(ends)
                place = max(paragraph, end)
                if place <= max(0, nearest(bound)):
                    return
                close_from(place)
                if place == end:
                    return

        for token in tokens(html):
            if token.start() > at and not stack[-1][2]:
                held.append(html[at: token.start()])
            at = token.end()
            close, name, attributes = token.group(2), token.group(3), token.group(4)
            if name is None:
                continue
            name = name.lower()
            if close:
                if name != "html" and places.get(name):
                    place = places[name][-1]
                    if stack[-1][6] > stack[place - 1][6]:
                        flush()
                    close_from(place)
                continue
            if name == "br":
                held.append(" ")
            if name in BLOCKS:
                flush()
                end_implied(name)
            if name in VOID or name == "html":
                continue
            up, _, out, inside, block, block_place, blocks = stack[-1]
            names, classes = self._names(attributes)
            out = out or self._left_out(name, names, classes, inside)
            node = len(self.parent)
            self.parent.append(up)
            self.tag.append(name)
            self.name.append(".".join([name, *sorted({re.sub(r"\d+", "#", c).replace("/", "|") for c in classes})]))
            self._container.append(node if name in CONTAINERS else self._container[up])
            self._path.append(self._paths.setdefault((self._path[up], self.name[-1]), len(self._paths)))
            places.setdefault(name, []).append(len(stack))
            if name in BLOCKS:
                block, block_place, blocks = node, len(stack), blocks + 1
            stack.append((node, name, out, inside or name in ("article", "main"), block, block_place, blocks))
        if at < len(html) and not stack[-1][2]:
            held.append(html[at:])
        flush()

    @staticmethod
    def _left_out(tag: str, names: list[str], classes: list[str], inside: bool) -> bool:
        """By its tag, or by what it is called; in an article headings and paragraphs are not, and inline parts by a class alone."""
        if tag in LEFT_OUT:
            return tag != "label" or not inside
        if tag == "header" and not inside:
            return True
        if tag in ("html", "body", "article", "main") or (inside and tag in HEADINGS):
            return False
        if inside and tag not in BLOCKS:
            return any(c in MARKS for c in classes)
        return any(marked(n, inside) for n in names) or any(marked(c, inside) for c in classes)

    @staticmethod
    def _names(attributes: str) -> tuple[list[str], list[str]]:
        """Id and roles, and classes, of a tag."""
        if not KINDS.search(attributes):
            return [], []
        names: list[str] = []
        classes: list[str] = []
        for kind, *values in ATTRIBUTE.findall(attributes):
            value, kind = "".join(values), kind.lower()
            if kind == "class":
                classes += value.split()
            elif kind == "role":
                names += value.split()
            elif kind == "id":
                names.append(value)
        return names, classes

    def path(self, node: int) -> str:
        names = []
        while node >= 0:
            names.append(self.name[node])
            node = self.parent[node]
        return "/".join(reversed(names))

    def main(self) -> int:
        """The outermost article around the deepest container with SHARE of the text, or else that container or what it is part of.

        It is part of an ancestor in which headings, paragraphs or other text stand beside it without a container
        of their own, or containers with BESIDE of the text; 0 if there is no such container.
        """
        need = SHARE * self.below[0]
        best = 0
        for node, tag in enumerate(self.tag):
            if tag in CONTAINERS and self.below[node] >= need and need > 0:
                best = node  # nodes stand in page order, so a later one lies deeper
        up, found = best, best
        while up >= 0:
            if self.tag[up] in ("article", "main"):
                found = up
            up = self.parent[up]
        if self.tag[found] in ("article", "main"):
            return found
        up = self.parent[found]
        while up >= 0:
            if self.tag[up] in CONTAINERS or up == 0:
                beside = self.below[up] - self.below[found]
                if self.own[up] or beside >= BESIDE * self.below[up]:
                    found = up
                elif beside:
                    break
            up = self.parent[up]
        return found

    def under(self, roots: set[int]) -> list[bool]:
        """For each node whether it is one of ``roots`` or stands below one."""
        out: list[bool] = []
        for node, up in enumerate(self.parent):
            out.append(node in roots or (up >= 0 and out[up]))
        return out

    def text(self, roots: set[int]) -> str:
        under = self.under(roots)
        return "\n".join(t for t, n in self.blocks if under[n])

    def at(self, path: str) -> set[int]:
        """The nodes at a path that have text below them."""
        wanted, known = -1, True
        for name in path.split("/"):
            wanted = self._paths.get((wanted, name), -2)
            if wanted < 0:
                known = False
                break
        return {n for n, p in enumerate(self._path) if p == wanted and self.below[n]} if known else set()

    def reading(self, path: str | None) -> tuple[str, str]:
        """Path and text of the article: at the host's ``path`` where it holds the page's own main container, or else
        SHARE of the text of a page that has no such container; at the own container else."""
        own = self.main()
        roots = self.at(path) if path else set()
        if roots and (self.under(roots)[own] or (own == 0 and self._chars(roots) >= SHARE * self.below[0])):
            return path, self.text(roots)
        return self.path(own), self.text({own})

    def _chars(self, roots: set[int]) -> int:
        under = self.under(roots)
        return sum(len(t) for t, n in self.blocks if under[n])


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def host_votes(pages: DataFrame, html: str, host: str) -> DataFrame:
    """(host, path, votes, chars): how many pages of a host have their main container at a path."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes: Counter = Counter()
        chars: Counter = Counter()
        for batch in pieces(batches, html):
            for of, value in zip(batch.column(host).to_pylist(), batch.column(html).to_pylist()):
                page = Page(value or "")
                node = page.main()
                if node or page.below[0]:
                    votes[of, page.path(node)] += 1
                    chars[of, page.path(node)] += page.below[node]
            if len(votes) > 100_000:
                yield rows(votes, chars)
                votes.clear()
                chars.clear()
        if votes:
            yield rows(votes, chars)

    def rows(votes: Counter, chars: Counter) -> pa.RecordBatch:
        keys = list(votes)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([votes[k] for k in keys], pa.int64()), pa.array([chars[k] for k in keys], pa.int64())],
            ["host", "path", "votes", "chars"],
        )

    found = pages.filter(F.col(host) != "").select(host, html).mapInArrow(vote, "host string, path string, votes long, chars long")
    return found.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("chars").alias("chars"))


def main_text(pages: DataFrame, html: str = "html", url: str = "url", carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per row of ``pages``: ``carry``, ``url``, path, text.

    ``text`` holds the blocks at the host's winning path, joined by line feeds, where that holds the page's own main
    container (or, on a page without one, SHARE of its text); else those of the own container, so no page loses its
    article to its host. Tags lose digits in their class names, so that numbered layouts of a host agree. Pages whose
    url has no host neither vote nor follow a vote. Null or empty pages and pages of boilerplate alone have an empty text.
    Rows that repeat are read each; deep and long pages take time in proportion; an empty table gives no rows.
    """
    pages = pages.select(*dict.fromkeys((*carry, url)), F.col(html).alias("_html"), host_of(F.col(url)).alias("_host"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("chars"), "path")
    votes = host_votes(pages, "_html", "_host")
    winners = written(votes.withColumn("n", F.row_number().over(order)).filter("n = 1").select("host", "path"), "host-paths")
    names = list(dict.fromkeys((*carry, url)))
    schema = T.StructType([*[pages.schema[c] for c in names], *[T.StructField(c, T.StringType()) for c in ("path", "text")]])

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_html"):
            read = [Page(h or "").reading(p) for h, p in zip(batch.column("_html").to_pylist(), batch.column("_path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *[pa.array([r[i] for r in read], pa.string()) for i in range(2)]], schema.names
            )

    known = winners.select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    known = small(known, weight=F.length("_host") + F.length("_path"))
    return pages.join(known, "_host", "left").select(*names, "_html", "_path").mapInArrow(extract, schema)
