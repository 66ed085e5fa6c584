"""Main text of web pages by wrapper induction.

1. The first page of a host gives the host's skeleton: its tree of block elements, runs of equal
   siblings taken as one node.
2. Every page is aligned with its host's skeleton by simple tree matching. What stands at a node
   is counted over all pages of the host, copies of a page once. Texts that nearly all pages with
   that node have there are template; texts that vary are content.
3. Content is what remains without template texts and without elements that hold no article by
   their kind (``nav``, ``footer``, ``form``, ...). Class names are evidence only: never against the
   page, its article or what is around it, and a word of several meanings not against an element
   that holds most of the page's varying text.

Pages move only if the templates of all hosts are too many to be sent to every task.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import Scratch
from broadsheet.session import broadcast_if_small

#: A text is template if this share of the host's different pages with text at a node have it there,
#: if they are this share of all its different pages, and this many.
CONSTANT_SHARE = 0.8
HOST_SHARE = 0.3
CONSTANT_PAGES = 3
#: An element of doubtful name with more of the page's varying text than this is content.
DOUBTFUL_SHARE = 0.5
#: Elements nested deeper are taken as children of their ancestor at this depth.
DEPTH = 100
#: Of an element with more runs of children, those of one tag are aligned as one.
WIDE = 1000

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.DOTALL,
)
_UNFINISHED = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z]+")
_RAW = frozenset("script style textarea title xmp iframe noscript noembed template svg math".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html head body article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " blockquote pre figure figcaption main nav header footer aside form fieldset address details summary hr"
    " center menu dialog hgroup search button select option label".split()
)
#: Elements that hold no article text.
_NOT_CONTENT = frozenset(
    "head nav footer aside form button select option label fieldset menu dialog search".split()
)
#: Of these, the ones that may also stand around a whole article.
_AROUND = frozenset("form fieldset label dialog".split())
#: Words in class, id or role that say the same.
_NOT_CONTENT_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored sponsors sidebar sidenav"
    " aside nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr"
    " popup newsletter subscribe subscription comment comments commentlist disqus"
    " replies respond sharing pagination pager complementary contentinfo disclaimer".split()
)
#: Words that say so of small elements only.
_DOUBTFUL_NAMES = frozenset(
    "promo promotion banner notice notices modal overlay signup login reply share social related recommended"
    " recommendations widget widgets toolbar alert".split()
)
#: A name that begins with one of these tells what a page has, not what an element is.
_STATES = frozenset("no not non has have with without is can show hide enable disable".split())
#: Names and last words of names that speak for content.
_CONTENT_NAMES = frozenset("article content post entry story text body main page".split())
#: Last words of names that tell nothing.
_PLAIN_WORDS = frozenset(
    "list box block container wrapper wrap section area item items unit slot inner outer left right top bottom bar"
    " link links form row column title group".split()
)
_CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_SCOPES = frozenset("html body ul ol dl table div article section main nav header footer aside form".split())


@dataclass(eq=False)
class Node:
    symbol: str
    tag: str
    kept: bool
    #: What its name says against it: 0 nothing, 1 something doubtful, 2 that it is not the article.
    against: int = 0
    #: Whether an article or main element is around it.
    inside: bool = False
    #: Article and main elements begun before it, and when it ended.
    before: int = 0
    after: int = 0
    children: list = field(default_factory=list)
    #: (place in the page, text) of the blocks of text directly in this element.
    blocks: list = field(default_factory=list)


def _names(attributes: str) -> list[str]:
    if not attributes.strip():
        return []
    return " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)).lower().split()


@lru_cache(maxsize=20_000)
def _says(name: str) -> int:
    """What a name says against an element, as in :class:`Node`; names that speak for it give -1."""
    words = [w for w in _SPLIT.split(name) if w]
    if not words or words[0] in _STATES:
        return 0
    if len(words) == 1 and words[0] in _CONTENT_NAMES:
        return -1
    if _NOT_CONTENT_NAMES.isdisjoint(words) and _DOUBTFUL_NAMES.isdisjoint(words):
        return 0
    while len(words) > 1 and words[-1] in _PLAIN_WORDS:
        words.pop()
    telling = not _NOT_CONTENT_NAMES.isdisjoint(words)
    return 2 if telling and words[-1] in _NOT_CONTENT_NAMES | _DOUBTFUL_NAMES else 1


def _against(names: list[str]) -> int:
    said = [_says(n) for n in names]
    most = max([0, *said])
    return min(most, 1) if -1 in said else most


def parse(page: str) -> Node:
    """Tree of the block elements of a page; inline elements are part of the block around them.

    Elements are closed as browsers do: a block ends an open paragraph, a list item the one before.
    What is cut off at the end of the page is closed there; an unfinished tag is dropped.
    """
    root = Node("", "", True)
    stack, buffer, place, at = [root], [], 0, 0
    # Of the elements that are open: how many of each tag, and that cannot hold an article.
    is_open, hidden, mains, nodes = Counter(), 0, 0, []

    def flush() -> None:
        nonlocal place
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            stack[-1].blocks.append((place, text))
            place += 1

    def close(keep: int) -> None:
        nonlocal hidden
        for node in stack[keep:]:
            is_open[node.tag] -= 1
            hidden -= not node.kept and node.tag not in _AROUND
            node.after = mains
        del stack[keep:]

    size = len(page)
    while at < size:
        match = _TAG.search(page, at)
        if match is None:
            rest = page[at:]
            cut = _UNFINISHED.search(rest)
            buffer.append(rest[: cut.start()] if cut else rest)
            break
        if match.start() > at:
            buffer.append(page[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), match[1] or match[4], match[3] or match[6] or ""
        if closing:
            if is_open[tag]:
                flush()
                last = len(stack) - 1
                while stack[last].tag != tag:
                    last -= 1
                close(last)
            continue
        if tag in _RAW:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, at)
                closed = page.find(">", end.start()) if end else -1
                at = closed + 1 if closed >= 0 else size
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        names = _names(attributes)
        against = _against(names)
        if tag not in _BLOCK and tag not in _NOT_CONTENT and (against < 2 or tag in _VOID):
            continue
        flush()
        if tag in _BLOCK:
            for keep in _ended_by(stack, is_open, tag):
                close(keep)
        if tag in _VOID:
            continue
        inside = is_open["article"] + is_open["main"] > 0
        words = {w for n in names for w in _SPLIT.split(n) if w}
        kept = tag not in _NOT_CONTENT and (tag != "header" or inside)
        node = Node(".".join([tag, *sorted(words)]), tag, kept, against, inside, mains)
        if tag in ("html", "body", "main", "article"):
            node.against = 0
        mains += not hidden and (tag == "main" or (tag == "article" and against < 2))
        if len(stack) < DEPTH:
            stack[-1].children.append(node)
        else:
            above = stack[-1]
            if len(stack) > DEPTH:  # ``above`` is a sibling of the node, so what holds of it is handed on
                node.kept, node.against = node.kept and above.kept, max(node.against, above.against)
            stack[DEPTH - 1].children.append(node)
        nodes.append(node)
        stack.append(node)
        is_open[tag] += 1
        hidden += not node.kept and tag not in _AROUND
    flush()
    close(1)
    root.after = mains
    for node in nodes:
        if mains and node.after - node.before == mains:  # all articles are in it
            node.against, node.kept = 0, node.kept or node.tag in _AROUND
    return root


def _ended_by(stack: list[Node], is_open: Counter, tag: str) -> Iterator[int]:
    """Sizes to which the stack of open elements is cut before an element with this tag begins."""
    if tag != "option" and is_open["p"]:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                yield i
                break
            if stack[i].tag in _SCOPES:
                break
    closes = _CLOSES.get(tag, frozenset())
    if not any(is_open[t] for t in closes):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in _SCOPES and stack[i].tag not in closes:
            break
        if stack[i].tag in closes:
            yield i
            if tag != "tr":
                break


@dataclass(eq=False)
class Run:
    """A node of a collapsed tree: a run of siblings with one symbol."""

    symbol: str
    children: list
    members: list

    def __post_init__(self) -> None:
        self.shape = hash((self.symbol, *[c.shape for c in self.children]))
        self.size = 1 + sum(c.size for c in self.children)


def collapse(nodes: list[Node], symbol: str = "") -> Run:
    groups = []
    for child in (c for n in nodes for c in n.children):
        if not groups or groups[-1][0].symbol != child.symbol:
            groups.append([])
        groups[-1].append(child)
    if len(groups) <= WIDE:
        return Run(symbol, [collapse(g, g[0].symbol) for g in groups], nodes)
    by_tag: dict[str, list] = {}
    for group in groups:
        by_tag.setdefault(group[0].tag, []).extend(group)
    return Run(symbol, [collapse(g, tag) for tag, g in by_tag.items()], nodes)


def skeleton_of(page: str) -> str:
    def plain(run: Run) -> list:
        return [run.symbol, [plain(c) for c in run.children]]

    return json.dumps(plain(collapse([parse(page)])))


@lru_cache(maxsize=512)
def _skeleton(data: str) -> Run:
    def build(part: list) -> Run:
        return Run(part[0], [build(c) for c in part[1]], [])

    return build(json.loads(data))


def match_trees(a: Run, b: Run) -> tuple[int, list[tuple[Run, Run]]]:
    """Simple tree matching: the most node pairs, with equal symbols, that keep order and ancestry."""
    out, open_, known = [], [(a, b)] if a.symbol == b.symbol else [], {}
    while open_:
        x, y = open_.pop()
        out.append((x, y))
        open_ += _child_pairs(x, y, known)
    return len(out), out


def _matched(a: Run, b: Run, known: dict) -> int:
    """Node pairs of the best match; ``known`` holds those of trees of the same shapes."""
    if a.symbol != b.symbol:
        return 0
    if a.shape == b.shape:
        return a.size
    if not a.children or not b.children:
        return 1
    key = a.shape, b.shape
    if key not in known:
        known[key] = 1 + int(_table(a, b, known)[-1, -1])
    return known[key]


def _table(a: Run, b: Run, known: dict) -> np.ndarray:
    """Node pairs of the best match of the first i children of one and the first j of the other."""
    shapes = {y.shape: y for y in b.children}
    index = {shape: i for i, shape in enumerate(shapes)}
    which = np.array([index[y.shape] for y in b.children])
    gains: dict[int, np.ndarray] = {}
    table = np.zeros((len(a.children) + 1, len(b.children) + 1), np.int32)
    for i, x in enumerate(a.children, 1):
        if x.shape not in gains:
            gains[x.shape] = np.array([_matched(x, y, known) for y in shapes.values()], np.int32)[which]
        row = np.maximum(table[i - 1, 1:], table[i - 1, :-1] + gains[x.shape])
        np.maximum.accumulate(row, out=table[i, 1:])
    return table


def _child_pairs(a: Run, b: Run, known: dict) -> list[tuple[Run, Run]]:
    if a.shape == b.shape:
        return list(zip(a.children, b.children))
    if not a.children or not b.children:
        return []
    table, out = _table(a, b, known), []
    i, j = len(a.children), len(b.children)
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            out.append((a.children[i - 1], b.children[j - 1]))
            i, j = i - 1, j - 1
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _paths(run: Run, path: int, out: dict[int, int]) -> None:
    out[id(run)] = path
    for child in run.children:
        _paths(child, _hash(f"{path}/{child.symbol}"), out)


@dataclass(frozen=True)
class Block:
    """A block of text, with the key of its node."""

    place: int
    text: str
    key: int
    #: The outermost element around it whose name speaks against it (None: there is none), how much, and
    #: whether an article or main element is around that one.
    named: int | None = None
    against: int = 0
    inside: bool = False


@dataclass(frozen=True)
class Page:
    """Blocks in page order, without those of elements that hold no article by their kind."""

    blocks: list[Block]
    has_article: bool

    def same(self) -> int:
        """A number that copies share: of the texts no name speaks against, or of all if there are none."""
        texts = [b.text for b in self.blocks if b.named is None] or [b.text for b in self.blocks]
        return _hash("\n".join(texts))


def placed(page: str, skeleton: str | None) -> Page:
    """The blocks of a page, aligned with the skeleton of its host.

    Nodes that match the skeleton have its node's key, others that of their own path.
    """
    root = parse(page)
    tree = collapse([root])
    keys: dict[int, int] = {}
    _paths(tree, 1, keys)
    if skeleton is not None:
        model, theirs = _skeleton(skeleton), {}
        _paths(model, 0, theirs)
        for mine, other in match_trees(tree, model)[1]:
            keys[id(mine)] = theirs[id(other)]
    out = []

    def collect(run: Run, above: dict[int, tuple]) -> None:
        mine = {}
        for node in run.members:
            here, *named = above.get(id(node), (True, None, 0, False))
            here = here and node.kept
            if named[0] is None and node.against:
                named = [id(node), node.against, node.inside]
            if here:
                out.extend(Block(place, text, keys[id(run)], *named) for place, text in node.blocks)
            mine.update((id(c), (here, *named)) for c in node.children)
        for child in run.children:
            collect(child, mine)

    collect(tree, {})
    return Page(sorted(out, key=lambda b: b.place), root.after > 0)


def main_text(page: Page, constant: set[tuple[int, int]]) -> str:
    """Blocks that are not template, joined by line ends, without those of elements with telling names.

    Of a doubtful name are dropped: elements outside the article of a page that has one, and
    those with at most DOUBTFUL_SHARE of the varying text.
    """
    varying = [b for b in page.blocks if (b.key, _hash(b.text)) not in constant]
    total, sizes = 0, Counter()
    for block in varying:
        if block.against < 2:
            total += len(block.text)
            sizes[block.named] += len(block.text)

    def stays(block: Block) -> bool:
        if block.against != 1:
            return not block.against
        outside = page.has_article and not block.inside
        return not outside and sizes[block.named] > DOUBTFUL_SHARE * total

    return "\n".join(b.text for b in varying if stays(b))


def _skeletons(pages: DataFrame) -> DataFrame:
    """(host, skeleton): of the page with the smallest id."""

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, tuple] = {}
        for batch in batches:
            for host, order, page in zip(*(batch[c].to_pylist() for c in ("host", "order", "html"))):
                if host is not None and (host not in best or (order, page) < best[host]):
                    best[host] = (order, page)
        for host, (order, page) in best.items():
            columns = [pa.array([host]), pa.array([order], pa.int64()), pa.array([skeleton_of(page)])]
            yield pa.record_batch(columns, names=["host", "order", "skeleton"])

    found = pages.select("host", "order", "html").mapInArrow(first, "host string, order long, skeleton string")
    return found.groupBy("host").agg(F.min_by("skeleton", F.struct("order", "skeleton")).alias("skeleton"))


_COUNTED = "host string, key long, text_hash long, same long"


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page, one per node with text (both without text_hash), one per text at a node."""
    for batch in batches:
        rows = []
        for host, page, skeleton in zip(*(batch[c].to_pylist() for c in ("host", "html", "skeleton"))):
            found = placed(page, skeleton)
            if host is None or not found.blocks:
                continue
            same = found.same()
            texts = {(b.key, _hash(b.text)) for b in found.blocks}
            nodes = {(key, None) for key, _ in texts}
            rows += [(host, key, text, same) for key, text in [(None, None), *nodes, *texts]]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["host", "key", "text_hash", "same"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def induce(pages: DataFrame) -> DataFrame:
    """(host, skeleton, constants): the template of every host; constants are 16 bytes each.

    Pages of a host with the same texts count as one.
    """
    scratch = Scratch(pages.sparkSession, "wrapper")
    skeletons = scratch.write(_skeletons(pages))
    located = pages.join(broadcast_if_small(skeletons), "host").select("host", "html", "skeleton")
    seen = located.mapInArrow(_count, _COUNTED)
    counts = seen.groupBy("host", "key", "text_hash").agg(F.count_distinct("same").alias("n"))
    counts = scratch.write(counts.filter(F.col("n") >= CONSTANT_PAGES))
    n_pages = counts.filter("key IS NULL").select("host", F.col("n").alias("n_pages"))
    n_node = counts.filter("key IS NOT NULL AND text_hash IS NULL").select("host", "key", F.col("n").alias("n_node"))
    often = counts.filter("text_hash IS NOT NULL").join(n_node, ["host", "key"]).join(n_pages, "host")
    often = often.filter(
        (F.col("n") >= CONSTANT_SHARE * F.col("n_node")) & (F.col("n") >= HOST_SHARE * F.col("n_pages"))
    )
    constants = often.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("key", "text_hash"))).alias("constants")
    )
    return scratch.write(skeletons.join(constants, "host", "left"))


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set] = {}
    for batch in batches:
        texts = []
        columns = (batch[c] for c in ("host", "html", "skeleton", "constants"))
        for host, page, skeleton, constants in zip(*columns):
            host = host.as_py()
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = {(c["key"], c["text_hash"]) for c in constants.as_py() or ()}
            texts.append(main_text(placed(page.as_py(), skeleton.as_py()), known[host]))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.record_batch(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), sizes],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of each row, from the whole page.

    Null and empty pages have an empty text, and so have pages of template texts only. Pages whose
    url is null or has no host get no template: only element names and classes decide. So it is for
    hosts of fewer than CONSTANT_PAGES different pages. Very long, deep and wide pages are taken whole.
    Rows that repeat an id are pages of their own. Other columns are not read; an empty table
    gives no rows.
    """
    host = F.lower(F.regexp_extract(url_column, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        F.coalesce(html_column, F.lit("")).alias("html"),
        F.when(F.length(host) > 0, host).alias("host"),
        F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)).alias("order"),
    )
    templates = broadcast_if_small(induce(rows))
    found = rows.join(templates, "host", "left").select("page_id", "url", "host", "html", "skeleton", "constants")
    return found.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
