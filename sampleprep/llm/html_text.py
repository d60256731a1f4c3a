"""Main text of HTML pages by wrapper induction.

Each page becomes a tree in which a node's children of the same kind (element and classes) are one node, so lists and runs of
paragraphs do not blow it up and no two siblings are alike. A host's wrapper is the tree of the nodes that its pages
share, with siblings in their mean order; it is counted by Spark: the distinct pages with each node, and with each text in it.
A page is aligned with its host's wrapper by simple tree matching. As siblings differ in kind, the best matching of two lists of
subtrees is their heaviest increasing subsequence, so an alignment takes n log n steps, by loops, at any depth.

What the wrapper tells: a text is template if at least _SHARE of the distinct pages with its node have it; outside an article
or main element, a node as a whole is template if half of its other texts return on other pages (rotating menus, notices, adverts).
A host of few pages shows too little of that, so the share of returning texts of the same node on all hosts is weighed in, and the
nodes that hosts share make a common wrapper, for what a host's own doesn't have. Everything else is a slot, and slots are content. Rules that
stand beside the wrappers: blocks are set aside by element (nav, footer, aside, form, header outside an article and
others), by role, if hidden, and by class or id. If a page has an article or main element, what is in it counts,
and beside it the block of one parent that has more text than all that.

Identical pages of a host count once, so a page copied many times does not turn into template; where
all content of a page would be template, it is kept.

Size: a wrapper has nodes of at least _LEAST distinct pages and of _NODE_SHARE of its host's, so it has at most 1 / _NODE_SHARE times
the nodes of a mean page, whatever the number of pages; nothing is cut by order or by task. Wrappers are joined to their pages by
broadcast only if their measured size is below broadcast_bytes, else by a shuffle on the host.

Defined cases: null or empty html gives the empty text; a null url counts as an empty host; broken
markup is read as it comes (unclosed elements end with their block, stray end tags are ignored); an
unended comment, script or style hides the rest; repeated rows are each extracted; markup of any depth and lists of any length are
read whole; other columns of the input, whatever their names, are left out.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleprep.llm.common import checkpointed
from sampleprep.llm.url_filter import host_and_path
from sampleprep.session import map_arrow

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)|[^>=]|=)*)(?:>|\Z)|([^<]+|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
#: Elements without content or end tag.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose raw content is skipped to their end tag.
_RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that a new one of the same group ends.
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LINES = frozenset("p h1 h2 h3 h4 h5 h6".split())
_SCOPE = frozenset("ul ol menu dl table tbody thead tfoot article section div body td".split())
_ASIDE = frozenset("nav menu footer aside form button select dialog head script style noscript label fieldset input".split())
#: Names of blocks beside the text, for what no wrapper can tell (adverts, what readers write, hosts of few pages): a class or id must be made of
#: such words and of words that name a block, so that "side-effects" or "share-price" is none.
_ASIDE_WORD = (
    "ads?|adverts?|advertisements?|advertising|banner|sponsor|sponsored|promo|promoted|promotion|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|nav|navbar|navigation|menu|topbar"
    "|breadcrumbs?|masthead|footer|sidebar|widget|related|recommended|share|sharing|social|newsletter|subscribe|signup|login|comments?|commentlist|disqus|replies|reply|pagination|pager|skip|toolbar|copyright"
)
_BLOCK_WORD = "area|articles|bar|block|body|box|buttons?|column|container|content|form|icons|inner|items?|label|left|links?|list|main|media|message|module|page|panel|posts|readers?|right|secondary|section|site|slot|stories|thread|top|bottom|unit|user|wrap|wrapper"
_ASIDE_NAME = re.compile(rf"(?:(?:{_BLOCK_WORD}|{_ASIDE_WORD}|\d+)[_-])*(?:{_ASIDE_WORD})(?:[_-](?:{_BLOCK_WORD}|\d+))*", re.IGNORECASE)
#: Text beside articles counts from this many characters on.
_STORY = 100
_ASIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: A text is template in a node that at least _LEAST pages have, if at least _SHARE of them have the text.
_SHARE, _LEAST = 0.4, 4
#: A node is template as a whole if _RETURNS of its texts, but for template ones, are on at least _AGAIN pages each; what is known of the node
#: from all hosts weighs as _PRIOR texts, and where nothing is, at least _MANY pages must have the node.
_MANY, _RETURNS, _AGAIN, _PRIOR = 8, 0.5, 2, 400
#: Share of a host's pages that a node of the wrapper is on at least.
_NODE_SHARE = 0.01
#: Rows that a task sums up before it passes them on.
_HELD = 200_000


class Node:
    """kind (element and classes), path (a hash of the kinds from the root), place in the page's list of nodes, parent, children by kind."""

    __slots__ = ("kind", "path", "place", "parent", "children")

    def __init__(self, kind: str, parent: Node | None, place: int) -> None:
        from xxhash import xxh64_intdigest

        self.kind, self.parent, self.place, self.children = kind, parent, place, {}
        self.path = xxh64_intdigest(kind.encode("utf-8", "replace"), parent.path if parent else 0)


def parse(page: str) -> tuple[list[Node], list[tuple[str, Node, bool, bool]]]:
    """The nodes of the page's tree, parents first, and its blocks in order: text, node, whether it is set aside, whether it is in an article."""
    root = Node("#", None, 0)
    nodes = [root]
    stack: list[tuple[str, Node, bool, bool]] = [("#", root, False, False)]
    # places in the stack: of each element, of blocks, and of scopes, headings and paragraphs
    opened: defaultdict[str, list[int]] = defaultdict(list)
    open_blocks: list[int] = []
    open_lines: list[int] = []
    blocks: list[tuple[str, Node, bool, bool]] = []
    parts: list[str] = []

    def last(names: frozenset[str] | set[str]) -> int:
        """The place of the innermost open element of these, or 0."""
        return max((opened[n][-1] for n in names if opened[n]), default=0)

    def push(name: str, node: Node, aside: bool, article: bool) -> None:
        opened[name].append(len(stack))
        if name in _BLOCK:
            open_blocks.append(len(stack))
        if name in _LINES or name in _SCOPE:
            open_lines.append(len(stack))
        stack.append((name, node, aside, article))

    def end_block() -> None:
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                _, node, aside, article = stack[-1]
                blocks.append((text, node, aside, article))

    def cut(upto: int) -> None:
        for entry in stack[upto:]:
            opened[entry[0]].pop()
        del stack[upto:]
        for places in (open_blocks, open_lines):
            while places and places[-1] >= upto:
                places.pop()

    def close(upto: int) -> None:
        end_block()
        cut(upto)

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.match(page, at)
        at = token.end()
        if token[4] is not None:
            parts.append(token[4])
            continue
        if token[2] is None:
            continue
        name = token[2].lower()
        block = name in _BLOCK
        if token[1]:
            found = opened[name][-1] if opened[name] else 0
            if found and (block or not open_blocks or open_blocks[-1] < found):
                if block:
                    close(found)
                else:
                    cut(found)
            elif block:
                end_block()
            continue
        if name == "br":
            parts.append(" ")
            continue
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(token[3])} if token[3] else {}
        if name in _RAW:
            ended = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            if not token[3].endswith("/"):
                at = ended.end() if ended else size
            continue
        if name in _VOID:
            if block:
                end_block()
            continue
        if not block:
            # inline elements only carry whether they are set aside
            if attributes and _set_aside(name, attributes, stack[-1][3]) or name in _ASIDE:
                end_block()
                push(name, _child(nodes, stack[-1][1], name, attributes), True, stack[-1][3])
            else:
                push(name, *stack[-1][1:])
            continue
        end_block()
        if open_lines and stack[open_lines[-1]][0] not in _SCOPE:
            close(open_lines[-1])
        if name in _ENDED_BY:
            ended = last(_ENDED_BY[name])
            if ended > last(_SCOPE - {"td", "th"}):
                close(ended)
        _, parent, aside, article = stack[-1]
        while stack[-1][0] not in _BLOCK and len(stack) > 1:
            cut(len(stack) - 1)
            _, parent, aside, article = stack[-1]
        article_here = article or name in ("article", "main") or attributes.get("role", "").lower() in ("main", "article")
        push(name, _child(nodes, parent, name, attributes), aside or _set_aside(name, attributes, article), article_here)
    end_block()
    return nodes, blocks


def _set_aside(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in _ASIDE or name == "header" and not in_article or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in _ASIDE_ROLE:
        return True
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    return name not in ("html", "body", "main") and any(_ASIDE_NAME.fullmatch(n) for n in named)


def _child(nodes: list[Node], parent: Node, name: str, attributes: dict[str, str]) -> Node:
    """The child of this kind, a new one if there is none."""
    classes = attributes.get("class") or ""
    kind = f"{name}.{'.'.join(sorted(classes.split()))}" if classes else name
    found = parent.children.get(kind)
    if found is None:
        found = parent.children[kind] = Node(kind, parent, len(nodes))
        nodes.append(found)
    return found


def _hash(text: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text.encode("utf-8", "replace"))


def heaviest_increasing(orders: list[float], weights: list[int]) -> list[int]:
    """The places of the increasing subsequence of orders that weighs most: the best matching of two lists of subtrees of different kinds."""
    if all(x < y for x, y in zip(orders, orders[1:], strict=False)):
        return list(range(len(orders)))
    ranks = {x: k + 1 for k, x in enumerate(sorted(set(orders)))}
    # a Fenwick tree of the heaviest sequence that ends at or below each rank
    best: list[tuple[int, int]] = [(0, -1)] * (len(ranks) + 1)
    before: list[int] = []
    for place, (order, weight) in enumerate(zip(orders, weights, strict=True)):
        at, found = ranks[order] - 1, (0, -1)
        while at:
            found = max(found, best[at], key=lambda x: x[0])
            at &= at - 1
        before.append(found[1])
        made, at = (found[0] + weight, place), ranks[order]
        while at < len(best):
            if made[0] > best[at][0]:
                best[at] = made
            at += at & -at
    at, found = len(ranks), (0, -1)
    while at:
        found = max(found, best[at], key=lambda x: x[0])
        at &= at - 1
    chosen, place = [], found[1]
    while place >= 0:
        chosen.append(place)
        place = before[place]
    return chosen[::-1]


def align(nodes: list[Node], wrapper: dict[int, tuple]) -> set[int]:
    """The places of the page's nodes that simple tree matching gives a node of the wrapper (path: order and more)."""
    weight, taken = [1] * len(nodes), [()] * len(nodes)
    for node in reversed(nodes):
        some = [c for c in node.children.values() if c.path in wrapper]
        if some:
            kept = heaviest_increasing([wrapper[c.path][0] for c in some], [weight[c.place] for c in some])
            taken[node.place] = [some[k].place for k in kept]
            weight[node.place] += sum(weight[p] for p in taken[node.place])
    found = {0} if nodes[0].path in wrapper else set()
    for node in nodes:
        if node.place in found:
            found.update(taken[node.place])
    return found


def is_template(told: tuple, text: str, in_article: bool) -> bool:
    """told: order, whether the node is template as a whole, its template texts."""
    return told[1] and not in_article or _hash(text) in told[2]


def main_text(page: str | None, wrapper: dict[int, tuple] | None, hints: bool = True, common: dict[int, tuple] | None = None) -> str:
    """The slots of a page under its host's wrapper, and under the common one where that has no node. hints False leaves out the rules beside them."""
    nodes, blocks = parse(page or "")
    told: dict[int, tuple] = {}
    for made in (common, wrapper):
        told |= {p: made[nodes[p].path] for p in align(nodes, made)} if made else {}
    open_blocks = [b for b in blocks if not (hints and b[2])]
    slots = [b for b in open_blocks if b[1].place not in told or not is_template(told[b[1].place], b[0], b[3])] or open_blocks
    if hints and any(b[3] for b in slots):
        slots = _articles(slots)
    return "\n".join(b[0] for b in slots)


def _articles(slots: list[tuple[str, Node, bool, bool]]) -> list[tuple[str, Node, bool, bool]]:
    """What is in articles; and the largest block beside them (texts of one parent), if it has more text than they have."""
    inside = sum(len(b[0]) for b in slots if b[3])
    beside: Counter = Counter()
    for text, node, _, article in slots:
        if not article:
            beside[(node.parent or node).place] += len(text)
    story = max(beside, key=lambda p: (beside[p], -p), default=None)
    if story is not None and beside[story] <= max(inside, _STORY):
        story = None
    return [b for b in slots if b[3] or (b[1].parent or b[1]).place == story]


def read_wrapper(made: str) -> dict[int, tuple]:
    """path: order among its siblings, whether it is template as a whole, its template texts."""
    return {x["node"] % 2**64: (x["order"], x["whole"], frozenset(t % 2**64 for t in x["texts"])) for x in json.loads(made)}


_COUNTED = "host string, node long, text long, pages double, orders double, told double"


def count_nodes(pages: DataFrame) -> DataFrame:
    """host, node, text (null for the node itself), pages (distinct ones with it), orders and told (sums of the node's order and of its different texts) of pages (host, html)."""
    keyed = pages.select("host", "html", F.xxhash64("html").alias("page"))
    copies = checkpointed(keyed.groupBy("host", "page").count().where("count > 1").select(F.col("host").alias("h"), F.col("page").alias("p"), F.col("count").alias("copies")))
    same = (F.col("host") == F.col("h")) & (F.col("page") == F.col("p"))
    keyed = keyed.join(F.broadcast(copies) if copies.count() <= 500_000 else copies, same, "left").select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int | None], list[float]] = {}

        def made() -> pa.RecordBatch:
            host, node, text = ([k[i] for k in sums] for i in range(3))
            values = np.array(list(sums.values()), float).reshape(-1, 3)
            texts = pa.array(np.array([t or 0 for t in text], np.uint64).view(np.int64), mask=np.array([t is None for t in text], bool))
            columns = [pa.array(host, pa.string()), pa.array(np.array(node, np.uint64).view(np.int64)), texts, *(pa.array(values[:, k]) for k in range(3))]
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, ["host", "node", "text", "pages", "orders", "told"])

        def add(key: tuple, *values: float) -> None:
            held = sums.setdefault(key, [0.0, 0.0, 0.0])
            for k, v in enumerate(values):
                held[k] += v

        for batch in batches:
            for host, page, copies in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                host, page, share = host.as_py(), page.as_py(), 1 / copies.as_py()
                if not page:
                    continue
                nodes, blocks = parse(page)
                texts = {(node.path, _hash(text)) for text, node, _, _ in blocks}
                told = Counter(path for path, _ in texts)
                add((host, nodes[0].path, None), share, 0.0, share * told[nodes[0].path])
                for node in nodes:
                    for k, child in enumerate(node.children.values()):
                        add((host, child.path, None), share, share * (k + 0.5) / len(node.children), share * told[child.path])
                for path, text in texts:
                    add((host, path, text), share)
                if len(sums) >= _HELD:
                    yield made()
        yield made()

    parts = map_arrow(keyed, run, _COUNTED)
    return parts.groupBy("host", "node", "text").agg(*[F.sum(c).alias(c) for c in ("pages", "orders", "told")])


def induce(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON) of all hosts of pages (host, html), from all pages; with a null host the common one, of nodes that hosts share."""
    some = 1e-6  # sums of shares of copies are whole numbers but for rounding
    counts = checkpointed(count_nodes(pages).where(f"text is null or pages > {_AGAIN - 1 + some}"))
    nodes = counts.where("text is null")
    hosts = nodes.groupBy("host").agg(F.max("pages").alias("all_pages"))
    nodes = nodes.join(hosts, "host").where(F.col("pages") > F.greatest(F.lit(_LEAST), F.col("all_pages") * _NODE_SHARE) - some)
    nodes = nodes.select("host", "node", F.col("pages").alias("node_pages"), F.round(F.col("orders") / F.col("pages"), 6).alias("order"), F.col("told").alias("node_told"))
    texts = counts.where("text is not null").join(nodes, ["host", "node"])
    constant = F.col("pages") > _SHARE * F.col("node_pages") - some
    always, back = (F.coalesce(F.sum(F.when(c, F.col("pages"))), F.lit(0.0)) for c in (constant, ~constant))
    texts = texts.groupBy("host", "node").agg(always.alias("always"), back.alias("back"), F.collect_list(F.when(constant, F.col("text"))).alias("texts"))
    # of the texts that are not template by themselves, the share that returns
    varying = F.coalesce(F.col("node_told") - F.col("always"), F.lit(0.0))
    told = checkpointed(
        nodes.join(texts, ["host", "node"], "left").select(
            "host", "node", "order", "node_pages", F.coalesce("back", F.lit(0.0)).alias("back"), varying.alias("varying"), F.coalesce("texts", F.array().cast("array<bigint>")).alias("texts")
        )
    )
    shared = told.groupBy("node").agg(F.count("*").alias("hosts"), F.round(F.avg("order"), 6).alias("order"), F.sum("back").alias("back"), F.sum("varying").alias("varying"))
    least = F.greatest(F.lit(_LEAST), told.agg(F.count_distinct("host") * _NODE_SHARE).scalar())
    shared = checkpointed(shared.where(F.col("hosts") >= least))
    # a host of few pages says little of what varies: the share on all hosts counts as much as _PRIOR of its texts
    rates = shared.where(F.col("varying") > some).select(F.col("node").alias("n"), (F.col("back") / F.col("varying")).alias("rate"))
    told = told.join(rates, F.col("node") == F.col("n"), "left")
    alone = (F.col("node_pages") > _MANY - some) & (F.col("back") > _RETURNS * F.col("varying") - some)
    pooled = F.col("back") + _PRIOR * F.col("rate") > _RETURNS * (F.col("varying") + _PRIOR) - some
    whole = (F.col("varying") > some) & F.when(F.col("rate").isNull(), alone).otherwise(pooled)
    own = told.withColumn("whole", whole).groupBy("host").agg(F.to_json(F.collect_list(F.struct("node", "order", "whole", "texts"))).alias("wrapper"))
    always_back = (F.col("varying") > some) & (F.col("back") > _RETURNS * F.col("varying") - some)
    common = F.struct("node", "order", always_back.alias("whole"), F.array().cast("array<bigint>").alias("texts"))
    return own.unionByName(shared.agg(F.to_json(F.collect_list(common)).alias("wrapper")).select(F.lit(None).cast("string").alias("host"), "wrapper"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_bytes: int = 8 << 20, hints: bool = True) -> DataFrame:
    """page_id, url and text of each row. hints False leaves out the rules that stand beside the wrappers."""
    host, _ = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    wrappers = checkpointed(induce(rows.select("host", "html")))
    common = read_wrapper(wrappers.where("host is null").first().wrapper)
    own = wrappers.where("host is not null")
    bytes_ = own.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host")), F.lit(0))).first()[0]
    few = bytes_ <= broadcast_bytes
    # few wrappers go to each worker once, by host; else a page's wrapper comes with its row
    shared = pages.sparkSession.sparkContext.broadcast((common, {r.host: r.wrapper for r in own.collect()} if few else {}))
    told = rows.withColumn("wrapper", F.lit(None).cast("string")) if few else rows.join(own, "host", "left").select("page_id", "url", "html", "host", "wrapper")
    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, by_host = shared.value
        known: dict[str, dict[int, tuple]] = {}
        for batch in batches:
            texts = []
            for page, host, made in zip(*(batch.column(c) for c in ("html", "host", "wrapper")), strict=True):
                host, made = host.as_py(), made.as_py()
                made = by_host.get(host) if made is None else made
                if made is not None and host not in known:
                    if len(known) >= 64:
                        known.clear()
                    known[host] = read_wrapper(made)
                texts.append(main_text(page.as_py(), known.get(host), hints, common))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_arrow(told, run, schema)
