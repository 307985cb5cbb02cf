"""Main text of web pages by wrapper induction.

Pages are parsed to trees of block elements, in which a run of like siblings (paragraphs, list items) is one repeated
node. Each host has a seed page; every page of the host is aligned with it by simple tree matching, the heaviest
sub-forest that keeps order and labels. All blocks of text take part, whatever their elements are called: the node that a
block matches is its slot, and where the seed has no such node the labels below the nearest matched one are, so layouts
that the seed lacks have slots too. A text that most pages with the slot repeat is template, the rest is content.

Only then are element names and classes looked at, for what varies and still is no article by its own account
(navigation, forms, adverts, comments and the like); where elements say that they're the article, the content outside
them goes too. Hosts with too few pages for a wrapper have these rules alone.

All pages are aligned and counted; counts are summed per host before and after the shuffle. Hosts are dealt out in parts
of a bounded number of pages, so no task holds a large host. No step looks at a depth or a length only, and all but the
alignment of lists of like children are linear in a page's length.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Share of a slot's pages with one text that makes it template; pages that it takes, and how many of them must differ.
CONSTANT, LEAST_PAGES, LEAST_DIFFERENT = 0.6, 4, 3
#: Share of a host's pages that must have the slot.
LEAST_SLOT = 0.1
#: Pages of a host that go together, at least; hosts with more are dealt out in parts (of up to MOST_LARGE such hosts).
PART_PAGES, MOST_LARGE = 256, 10_000
#: Seeds that a worker keeps parsed.
SEEDS = 64

# Element names by what they are.
DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg math button select option textarea input label object canvas audio video dialog menu title".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"), "tbody": ("thead tbody tr td th", "table"), "thead": ("tbody tr td th", "table"), "tfoot": ("tbody thead tr td th", "table")}
MAIN_TAGS = frozenset(("article", "main"))
NO_ARTICLE = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar|footer|site-?header|masthead|cookies?|consent|notices?|alerts?|popup|modal|newsletter|subscri\w+|sign-?up|login|share|sharing|social|related|recommend\w*|comments?|respond|discussion|replies|disqus|widget\w*|toolbar|pagination|pager|hidden|skip|copyright|legal|disclaimer|search\w*)(?:$|[\s_-])")
MAIN = re.compile(r"(?i)(?:^|[\s_-])(?:article(?:-?body|-?content)?|post-?(?:body|content)|entry-?content|main-?content|story(?:-?body)?)(?:$|[\s_-])")

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+|[^<>]*+)>", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
GAPS = re.compile(r"\s+")


@dataclass(slots=True, eq=False)
class Node:
    """A block element, or a run of like ones. out and main: whether it, or an element around it, says that it's no part
    of an article, or that it's the article."""

    label: str
    tag: str
    parent: Node | None
    number: int
    dropped: bool = False
    out: bool = False
    main: bool = False
    children: list[Node] = field(default_factory=list)
    shape: int = 0
    size: int = 1


@dataclass(slots=True, eq=False)
class Block:
    text: str
    node: Node


@dataclass(slots=True, eq=False)
class Page:
    nodes: list[Node]  # parents before their children
    blocks: list[Block]


class Open:
    """The open elements, with the places of each name, so that no step walks through all of them."""

    def __init__(self, root: Node):
        self.stack: list[tuple[str, Node]] = [("", root)]  # inline ones stand for the block element they are in
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]

    def push(self, tag: str, node: Node) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, node))

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def first_above(self, tags: tuple[str, ...], stops: tuple[str, ...]) -> int:
        """The outermost of `tags` above the last of `stops`, 0 if there is none."""
        stop = max(map(self.last, stops))
        found = []
        for places in filter(None, map(self.places.get, tags)):
            k = bisect_right(places, stop)
            found += places[k : k + 1]
        return min(found, default=0)

    def pop_to(self, k: int) -> None:
        for tag, _ in self.stack[k:]:
            self.places[tag].pop()
        del self.stack[k:]
        while self.blocks[-1] >= k:
            self.blocks.pop()


def parse(page: str) -> Page:
    """The tree of block elements, runs of like siblings merged, and its blocks of text in page order."""
    root = Node("", "", None, 0)
    nodes, blocks = [root], []
    opened = Open(root)
    held: list[str] = []
    at = 0

    def flush() -> None:
        if held:
            text = GAPS.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                blocks.append(Block(text, opened.stack[-1][1]))

    def close(k: int) -> None:
        if opened.blocks[-1] >= k:
            flush()
        opened.pop_to(k)

    while m := MARKUP.search(page, at):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            k = opened.last(tag)
            if k and not (tag in INLINE and opened.blocks[-1] > k):
                close(k)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in CLOSES_P and (k := opened.last("p")):
            close(k)
        if tag in CLOSED_BY:
            ends, stops = (tuple(x.split()) for x in CLOSED_BY[tag])
            if k := opened.first_above(ends, stops):
                close(k)
        if tag in INLINE:
            opened.push(tag, opened.stack[-1][1])
            continue
        flush()
        if tag == "hr":
            continue
        named = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(m[3])} if "=" in m[3] else {}
        look = " ".join(filter(None, (named.get("class"), named.get("id"))))
        role = named.get("role", "").lower()
        hidden = bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", m[3])) or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
        main = tag in MAIN_TAGS or role == "main" or named.get("itemprop") == "articleBody" or bool(look and MAIN.search(look))
        parent, label = opened.stack[-1][1], f"{tag}.{named.get('class', '')}"
        dropped = tag in DROPPED or (tag == "header" and not parent.main) or hidden or role in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog") or bool(look and not (tag in ("html", "body") or tag in MAIN_TAGS) and NO_ARTICLE.search(look))
        if parent.children and parent.children[-1].label == label and parent.children[-1].dropped == dropped and not main:
            node = parent.children[-1]  # one of a run
        else:
            node = Node(label, tag, parent, len(nodes), dropped, dropped or parent.out, main or parent.main)
            parent.children.append(node)
            nodes.append(node)
        opened.push(tag, node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page)
        if m[3].endswith("/") and tag in ("svg", "math"):
            close(len(opened.stack) - 1)
    if len(page) > at:
        held.append(page[at:])
    close(1)
    flush()
    for node in reversed(nodes):
        node.shape = hash((node.label, *[c.shape for c in node.children]))
        node.size = 1 + sum([c.size for c in node.children])
    return Page(nodes, blocks)


def heaviest(a: Node, b: Node, weight) -> tuple[int, list[tuple[Node, Node]]]:
    """The heaviest order-keeping pairs of like children, and their weight."""
    places: dict[str, list[int]] = {}
    for j, d in enumerate(b.children):
        places.setdefault(d.label, []).append(j)
    none = (0, None)
    best = [none] * (len(b.children) + 1)  # a Fenwick tree of the heaviest chains that end before a place

    def before(j: int) -> tuple:
        found = none
        while j:
            if best[j][0] > found[0]:
                found = best[j]
            j &= j - 1
        return found

    for i, c in enumerate(a.children):
        grown = []
        for j in places.get(c.label, ()):
            last = before(j)
            grown.append((j, (last[0] + weight(c, b.children[j]), (last, i, j))))
        for j, chain in grown:
            j += 1
            while j < len(best):
                if chain[0] > best[j][0]:
                    best[j] = chain
                j += j & -j
    top = before(len(b.children))
    total = top[0]
    pairs = []
    while top[1]:
        top, i, j = top[1]
        pairs.append((a.children[i], b.children[j]))
    return total, pairs


def match(seed: Node, page: Node) -> dict[int, int]:
    """Simple tree matching: the seed's node for each matched node of the page, by their numbers."""
    sizes: dict[tuple[int, int], int] = {}

    def weight(x: Node, y: Node) -> int:
        return x.size if x.shape == y.shape else sizes[x.number, y.number]

    todo = [(seed, page, False)]
    while todo:  # children before parents, without recursion
        x, y, ready = todo.pop()
        if x.shape == y.shape or (x.number, y.number) in sizes:
            continue
        if ready:
            sizes[x.number, y.number] = 1 + heaviest(x, y, weight)[0]
            continue
        todo.append((x, y, True))
        of: dict[str, list[Node]] = {}
        for d in y.children:
            of.setdefault(d.label, []).append(d)
        todo += [(c, d, False) for c in x.children for d in of.get(c.label, ())]
    twin = {}
    walk = [(seed, page)]
    while walk:
        x, y = walk.pop()
        twin[y.number] = x.number
        walk += zip(x.children, y.children) if x.shape == y.shape else heaviest(x, y, weight)[1]
    return twin


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


_label_number = lru_cache(maxsize=100_000)(_number)


def slots(seed: Page, page: Page) -> list[tuple[int, int]]:
    """Slot and text of each block, as numbers that mean the same on all pages of the host."""
    twin = match(seed.nodes[0], page.nodes[0])
    of = []
    for node in page.nodes:
        k = twin.get(node.number)
        of.append(k + 1 if k is not None else ((of[node.parent.number] * 0x9E3779B97F4A7C15 + _label_number(node.label)) & ((1 << 62) - 1)) + (1 << 62))
    return [(of[b.node.number], _number(b.text) or 1) for b in page.blocks]


def article(page: Page, template: list[bool] | None = None) -> list[bool]:
    """Which blocks are the article's: what isn't template and isn't out, of that what elements mark if any do."""
    content = [not b.node.out for b in page.blocks]
    if any(yes and b.node.main for yes, b in zip(content, page.blocks)):
        content = [yes and b.node.main for yes, b in zip(content, page.blocks)]
    return [yes and not gone for yes, gone in zip(content, template)] if template else content


def with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    rows = pages.select(pages[f"`{id_col}`"].alias("page_id"), pages[f"`{url_col}`"].alias("url"), F.coalesce(pages[f"`{html_col}`"], F.lit("")).alias("html"))
    return rows.withColumn("host", F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))))


class Seeds:
    """The parsed seeds of the hosts that a task is at."""

    def __init__(self) -> None:
        self.parsed: dict[str, Page] = {}

    def slots(self, host: str, seed: str, page: Page) -> list[tuple[int, int]]:
        if host not in self.parsed:
            if len(self.parsed) >= SEEDS:
                self.parsed.clear()
            self.parsed[host] = parse(seed)
        return slots(self.parsed[host], page)


def count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, slot and text: pages, and a sketch of which pages. Text 0 stands for the slot itself, slot 0 for the host."""
    seeds = Seeds()
    for batch in batches:
        found: dict[tuple[str, int, int], list[int]] = {}
        for host, html_text, seed in zip(*[batch.column(k).to_pylist() for k in (0, 4, 5)]):
            if seed is None:
                continue
            keys = set(seeds.slots(host, seed, page := parse(html_text)))
            bit = 1 << (_number("\n".join([b.text for b in page.blocks])) & 63)
            for slot, text in keys | {(s, 0) for s, _ in keys} | {(0, 0)}:
                known = found.setdefault((host, slot, text), [0, 0])
                known[0] += 1
                known[1] |= bit
        columns = list(zip(*[(*k, n, bits - (bits >> 63 << 64)) for k, (n, bits) in found.items()])) or [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["host", "slot", "text", "n", "bits"])


def wrappers(counts: DataFrame) -> DataFrame:
    """Per host with a template: its (slot, text) pairs, at most ten or so times the blocks of a page. By windows instead of
    joins with itself, since what counts the slots is to run once."""
    counts = counts.groupBy("host", "slot", "text").agg(F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))
    some = counts.where(f"text = 0 or n >= {LEAST_PAGES} and bit_count(bits) >= {LEAST_DIFFERENT}")
    of_slot = Window.partitionBy("host", "slot")
    pages, differ = (F.max(F.when(F.col("text") == 0, c)).over(of_slot) for c in (F.col("n"), F.bit_count("bits")))
    constant = some.withColumns({"pages": pages, "differ": differ}).where(f"slot = 0 or text != 0 and n >= {CONSTANT} * pages and 2 * bit_count(bits) >= differ")
    by_host = constant.groupBy("host").agg(F.max(F.when(F.col("slot") == 0, F.col("n"))).alias("total"), F.collect_list(F.when(F.col("slot") != 0, F.struct("slot", "text", "pages"))).alias("pairs"))
    template = F.filter("pairs", lambda p: p["pages"] >= LEAST_SLOT * F.col("total"))
    return by_host.select("host", F.transform(template, lambda p: F.struct(p["slot"].alias("slot"), p["text"].alias("text"))).alias("template")).where(F.size("template") > 0)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: page_id, url, text (blocks joined by one line feed), n_chars, n_template (blocks of the template).

    Null and empty html have an empty text. Pages without a url, or with one that has no host, share the empty host.
    Repeated rows are kept; of pages that share the least id of a host the one with the least hash is the seed; pages with
    the same texts count as one where differing pages are asked for; an empty table gives none; other columns are ignored.
    """
    rows = with_host(pages, id_col, url_col, html_col)
    kind = rows.schema["page_id"].dataType.simpleString()
    counts = rows.groupBy("host").agg(F.count("*").alias("n"))
    part = max(PART_PAGES, (counts.agg(F.sum("n")).first()[0] or 0) // MOST_LARGE)
    large = counts.where(F.col("n") > part).select("host", F.ceil(F.col("n") / part).cast("int").alias("parts"))  # at most MOST_LARGE
    spread = lambda df, salt: df.join(F.broadcast(large), "host", "left").withColumn("salt", salt).drop("parts")
    dealt = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("page_id", "url"), F.col("parts"))).cast("int")
    each = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    seeds = rows.where("html != ''").groupBy("host").agg(F.min_by("html", F.struct(F.col("page_id").isNull(), "page_id", F.xxhash64("html"))).alias("seed"))
    joined = spread(rows, dealt).join(spread(seeds, each), ["host", "salt"], "left")

    # the same columns in the same order for both passes, so that the second takes up the first's shuffle
    given = joined.select("host", "salt", "page_id", "url", "html", "seed")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, pairs = Seeds(), {}
        for batch in batches:
            texts, taken = [], []
            for host, html_text, seed, template in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(6)):
                page, gone = parse(html_text), None
                if seed is not None and template.is_valid:
                    if host not in pairs:
                        pairs.clear()
                        pairs[host] = {(p["slot"], p["text"]) for p in template.as_py()}
                    gone = [key in pairs[host] for key in seeds.slots(host, seed, page)]
                texts.append("\n".join([b.text for b, yes in zip(page.blocks, article(page, gone)) if yes]))
                taken.append(sum(gone or ()))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(taken, pa.int32())], names=["page_id", "url", "text", "n_chars", "n_template"])

    wrapper = wrappers(given.mapInArrow(count_slots, "host string, slot long, text long, n long, bits long"))
    found = given.join(spread(wrapper, each), ["host", "salt"], "left").select("host", "salt", "page_id", "url", "html", "seed", "template")
    return found.mapInArrow(finish, f"page_id {kind}, url string, text string, n_chars long, n_template int")
