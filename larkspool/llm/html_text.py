"""Main text of web pages by consensus paths of their hosts.

Each page's containers are scored by their text against their links and the words of their names; a container's path is
made of generalised tags and classes (digits as 0, no ids) and known by a 64-bit hash chained to its parent's.  Spark adds
up the scores for each host and path; the path with the most votes wins, and pages are extracted again with their host's
winning path.  A page in which it is missing, or is empty, uses its own best container.

Names alone drop nothing.  An element whose name says that it is no main text is left out if others hold the page's text:
an element called a notice or a form stays if it holds half of the page's text and that is not in links, one called
comments or a menu stays only if there is no other text at all.  Elements that are asides by their tag always go.

Pages are parsed in one pass and in time linear in their length, however deep or broken they are.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import table, written

#: Winning paths (one for each host, 16 bytes) up to this many go to every task; more are joined by shuffling the pages.
BROADCAST_HOSTS = 2_000_000
_OPEN = re.compile(r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_BROKEN = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)>")
_CLOSE = re.compile(r"</([a-zA-Z][^\s/>]*)[^>]*>")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is no text of the page, those that hold no content, and those that start a new block.
RAW = frozenset("script style noscript template textarea iframe svg math canvas object select option title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never main text.  A form or an article's header is judged like an element of that name.
ASIDE = frozenset("nav header footer aside menu button dialog".split())
#: The last word of a class, id or role that says the same, with or without other evidence (see above); words that only say
#: what shape an element has are passed over, so "share-buttons" is "share" and "market-share-report" is "report".
STRONG_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentary consent cookie cookies disqus footer login masthead menu modal nav navbar navigation newsletter "
    "pagination pager popup promo promos promotion related share sharing sidebar signup skip social sponsor sponsored sponsors subscribe toolbar complementary contentinfo".split()
)
WEAK_NAMES = frozenset("form header legal notice search side tag tags widget widgets".split())
SHAPES = frozenset("list box wrap wrapper container block section area inner outer bar button buttons link links item items group panel row column col".split())
#: Elements that may hold the main text, and names that speak for it.
CONTAINER = frozenset("article main section div body td blockquote form".split())
MAIN_NAME = re.compile(r"article|content|entry|main|post|story|text|body", re.I)
#: Ended by the start of one like themselves (or of the others named), as far as the nearest of ``FENCE``.
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
FENCE = frozenset("table ul ol dl div article section main body".split())
_ENDS = {tag: tuple(k for k, by in CLOSES.items() if tag in by) for tag in BLOCK}
#: What an outer container gets of the text that stands in an inner one.
DEPTH = 0.8
_MASK = (1 << 64) - 1


class Node:
    __slots__ = ("tag", "path", "parent", "gone", "named", "main", "header", "article", "own", "plain", "linked", "worth", "inside")

    def __init__(self, tag: str, path: int, parent: Node | None):
        self.tag, self.path, self.parent = tag, path, parent
        self.gone = parent is not None and parent.gone  # an aside by its tag, hidden, or in one
        self.named = 0  # 1: weak, 2: strong
        self.main = False
        self.header = parent is not None and parent.header  # in the header of an article
        self.article = parent is not None and parent.article or tag == "article"
        self.own = self.plain = self.linked = 0
        self.worth = 0.0
        self.inside = False


def _kept(f):
    """Remembers what ``f`` says of short strings, which recur from page to page; long ones are worked out each time."""
    short = lru_cache(maxsize=16384)(f)
    return lambda text: short(text) if len(text) <= 200 else f(text)


@_kept
def _step(step: str) -> int:
    return int.from_bytes(hashlib.blake2b(step.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


@_kept
def _names(names: str) -> tuple[int, bool]:
    """How much class, id and role say against the element (0, 1 or 2), and whether one says that it is main text."""
    against = 0
    for name in names.split():
        words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)]
        while len(words) > 1 and words[-1] in SHAPES:
            words.pop()
        if words:
            against = max(against, 2 if words[-1] in STRONG_NAMES else 1 if words[-1] in WEAK_NAMES else 0)
    return against, bool(MAIN_NAME.search(names))


@_kept
def _attributes(text: str) -> tuple[str, str, bool]:
    """Class, id and role; the generalised classes; and whether the element is hidden."""
    values = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(text)}
    names = " ".join(values.get(k, "") for k in ("class", "id", "role"))
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    return names, ".".join(sorted(re.sub(r"\d+", "0", values.get("class", "")).split())[:3]), hidden


def parse(page: str) -> tuple[list[tuple[str, Node]], list[Node]]:
    """Blocks of visible text in page order with the element each is in, and all elements, parents before children."""
    root = Node("html", 0, None)
    nodes, stack = [root], [root]
    places: dict[str, list[int]] = {}  # where in the stack each tag is open
    fences = [0]
    links = 0
    blocks: list[tuple[str, Node]] = []
    held: list[str] = []
    opening, last = _OPEN, page.rfind(">")

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                blocks.append((text, stack[-1]))

    def pop() -> None:
        nonlocal links
        node = stack[-1]
        if node.tag in BLOCK:
            flush()
        stack.pop()
        places[node.tag].pop()
        if node.tag == "a":
            links -= 1
        if node.tag in FENCE:
            fences.pop()

    def say(text: str) -> None:
        at = stack[-1]
        if not at.gone:
            text = entities.unescape(text)
            held.append(text)
            n = len(text.strip())
            if links:
                at.linked += n
            else:
                at.plain += n

    place, n = 0, len(page)
    while place < n:
        begin = page.find("<", place)
        if begin < 0 or begin > last:
            say(page[place:])
            break
        if begin > place:
            say(page[place:begin])
        place = begin
        after = page[begin + 1 : begin + 2]
        if after == "!" or after == "?":
            if page.startswith("<!--", begin):
                end, size = page.find("-->", begin + 4), 3
            elif page.startswith("<![CDATA[", begin):
                end, size = page.find("]]>", begin), 3
            else:
                end, size = page.find(">", begin), 1
            place = n if end < 0 else end + size
            continue
        if after == "/":
            found = _CLOSE.match(page, begin)
            if not found:
                say("<")
                place = begin + 1
                continue
            place, tag = found.end(), found[1].lower()
            if tag in BLOCK:
                flush()
            if tag != "br" and places.get(tag):
                for _ in range(len(stack) - places[tag][-1]):
                    pop()
            continue
        found = opening.match(page, begin)
        if not found and opening is _OPEN and after.isascii() and after.isalpha():
            opening = _BROKEN  # a quote that is never closed: from here on tags end at the next ">"
            found = opening.match(page, begin)
        if not found:
            say("<")
            place = begin + 1
            continue
        place, tag = found.end(), found[1].lower()
        if tag in RAW:
            if not found[2].endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, place)
                place = close.end() if close else n
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK:
            flush()
            # a paragraph or the like does not go on over the start of a block that ends it
            ended = max((places[k][-1] for k in _ENDS[tag] if places.get(k)), default=0)
            if ended > fences[-1]:
                for _ in range(len(stack) - ended):
                    pop()
        if tag in VOID or found[2].endswith("/"):
            continue
        at = stack[-1]
        names, own, hidden = _attributes(found[2]) if found[2].strip() else ("", "", False)
        path = ((at.path * 0x9E3779B97F4A7C15 + _step(tag + "." + own if own else tag)) & _MASK) if tag in BLOCK else at.path
        node = Node(tag, path, at)
        if tag == "header" and at.article:
            node.header = True
        else:
            node.gone = node.gone or tag in ASIDE or hidden
        if names and tag not in ("body", "html", "article", "main"):
            node.named, node.main = _names(names)
        elif names:
            node.main = _names(names)[1]
        if tag == "form":
            node.named = max(node.named, 1)
        if node.header and tag in HEADING:
            node.header = False
        places.setdefault(tag, []).append(len(stack))
        if tag in FENCE:
            fences.append(len(stack))
        if tag == "a":
            links += 1
        stack.append(node)
        nodes.append(node)
    flush()
    return blocks, nodes


def judge(blocks: list[tuple[str, Node]], nodes: list[Node]) -> list[tuple[str, Node]]:
    """The blocks that may be main text; marks the others' elements as gone and adds up what containers hold."""
    for node in nodes:
        if node.header:
            node.plain = node.linked = 0
    own = [(node.plain, node.linked) for node in nodes]
    for node in reversed(nodes):
        if node.parent is not None and not node.gone:
            node.parent.plain += node.plain
            node.parent.linked += node.linked
    page, links = nodes[0].plain, nodes[0].linked
    for node in nodes[1:]:
        if node.parent.gone:
            node.gone = True
        elif node.named and not node.gone:
            rest = page + links - node.plain - node.linked
            stays = rest == 0 if node.named == 2 else 2 * node.plain >= page and node.plain > node.linked
            node.gone = not stays
    for node, (plain, linked) in zip(nodes, own, strict=True):
        node.plain, node.linked = plain, linked
    return [(text, node) for text, node in blocks if not node.gone and not node.header]


def scored(shown: list[tuple[str, Node]], nodes: list[Node]) -> dict[int, float]:
    """Score of each container's path: its text less what is in links, spread over levels, for and against its names."""
    for text, node in shown:
        node.worth += len(text)
    out: dict[int, float] = {}
    for node in reversed(nodes):
        worth = node.worth
        if node.tag in CONTAINER and not node.gone and worth > 0:
            score = worth * (2.0 if node.tag in ("article", "main") else 1.5 if node.main else 1.0) * (0.5 if node.named else 1.0)
            out[node.path] = max(out.get(node.path, 0.0), score)
            worth *= DEPTH  # what stands deeper is worth less to the outer containers
        if node.parent is not None and node.tag != "a":
            node.parent.worth += worth
    return out


def main_text(page: str | None, winner: int | None) -> str:
    """Blocks inside the winning path (else the page's best container, else all of the page), joined by line breaks."""
    blocks, nodes = parse(page or "")
    shown = judge(blocks, nodes)

    def inside(path: int) -> list[str]:
        for node in nodes:
            node.inside = (node.parent is not None and node.parent.inside) or (node.path == path and node.tag in CONTAINER)
        return [text for text, node in shown if node.inside]

    if winner is not None and (got := inside(winner)):
        return "\n".join(got)
    scores = scored(shown, nodes)
    if scores:
        return "\n".join(inside(max(scores, key=lambda k: (scores[k], k))))
    return "\n".join(text for text, _ in shown)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without its port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def host_votes(pages: DataFrame) -> DataFrame:
    """host and path of the container that the host's pages vote for together; ties fall to the greater path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "html"):
                votes: dict[tuple[str, int], float] = {}
                for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    blocks, nodes = parse(page or "")
                    scores = scored(judge(blocks, nodes), nodes)
                    most = max(scores.values(), default=0.0)
                    for path, score in scores.items():  # a page has one vote whatever its length
                        votes[host, path] = votes.get((host, path), 0.0) + round(score / most, 6)
                if votes:
                    keys = list(votes)
                    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), K.signed(np.array([k[1] for k in keys], dtype=np.uint64)), pa.array(list(votes.values()), pa.float64())], ["host", "path", "votes"])

    votes = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(run, "host string, path long, votes double")
    total = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 3).alias("votes"))
    best = total.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages(page_id, url, html).

    Null and empty pages, and pages without visible text, have an empty text; long pages are read whole, in time linear in
    their length.  Rows without a host vote as one host.  Every row, repeated ones too, gives one row; other columns are not
    looked at.
    """
    winners = written(host_votes(pages), "html_winners")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    hashed = F.xxhash64("host")
    sent = None
    if winners.count() <= BROADCAST_HOSTS:
        rows = rows.select("page_id", "url", "html", hashed.alias("path"))
        known = winners.groupBy(hashed.alias("host")).agg(F.max("path").alias("path")).orderBy("host").toArrow()
        sent = pages.sparkSession.sparkContext.broadcast((known.column("host").to_numpy(), known.column("path").to_numpy()))
    else:
        rows = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "html"):
                paths = part.column(3).to_pylist()
                if sent is not None:
                    hosts, winning = sent.value
                    at = np.minimum(np.searchsorted(hosts, paths), len(hosts) - 1) if len(hosts) else np.zeros(0, dtype=int)
                    paths = [int(winning[i]) if hosts[i] == h else None for i, h in zip(at, paths, strict=True)] if len(hosts) else [None] * len(paths)
                texts = [main_text(page, None if path is None else path & _MASK) for page, path in zip(part.column(2).to_pylist(), paths, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
