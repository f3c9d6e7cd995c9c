"""Main text of pages by wrapper induction.

Pages of a host that have one layout share a wrapper. Every page's tree is aligned with
that of a reference page of its layout by simple tree matching; over all different pages of
the layout it is counted how often an aligned text is the reference's, and how often a
text without a counterpart is on other pages as well. Texts that stay the same are
template, texts that vary are content - but for parts whose tag, role or class says that
they are not the article, unless such a part holds most of what varies on its page.
"""

from __future__ import annotations

import html as entities
import math
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.arrow import pieces
from caseloom.operators.scaling import Staging, join_checked

# HTML elements by the part they play here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span"
    " strike strong sub sup time tt u var".split()
)
NOT_TEXT = frozenset(
    "head title script style noscript template nav footer aside form button select textarea input iframe svg"
    " canvas object video audio dialog menu".split()
)
ARTICLE = frozenset(("article", "main"))
CLOSES_ITSELF = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
# Words of class, id and role that name other things than the article.
NOT_ARTICLE = frozenset(
    "ad ads advert advertisement advertisements sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar complementary widget footer contentinfo masthead cookie cookies consent gdpr"
    " notice popup modal overlay newsletter subscribe subscription share sharing social related recommended"
    " comment comments disqus replies respond form login signup search pagination pager toolbar skip".split()
)

# What follows a tag's name up to its end: only after an equals sign do quotes hold a value
_REST = r"(?:=[ \t\n\r\f]*+(?:\"[^\"]*+\"?|'[^']*+'?)|=|[^>=]++)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:(?<![a-zA-Z0-9=])/)?{_REST})(?:>|\Z)"
    r"|([^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_MOST_PAIRS = 40_000
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(eq=False)
class Node:
    """An element, or with tag ``#text`` a run of text.

    ``out`` tells a part that is not text at all, ``named`` one whose name or place says
    that it is not the article. ``key`` and ``weight`` stand for the whole subtree: its
    contents, and the weight of its alignment with an equal one.
    """

    tag: str
    label: str = ""
    out: bool = False
    text: str = ""
    children: list[Node] = field(default_factory=list)
    article: bool = False
    number: int = -1
    named: bool = False
    key: int = 0
    weight: float = 0.0


def _element(tag: str, raw: str, in_article: bool) -> Node:
    header = tag == "header" and not in_article
    if not raw or raw.isspace():
        return Node(tag, tag, tag in NOT_TEXT, named=header)
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(raw)}
    names = " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()
    named = tag not in ("html", "body") and tag not in ARTICLE and not NOT_ARTICLE.isdisjoint(
        re.split(r"[^a-z0-9]+", names)
    )
    hidden = "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))
    return Node(tag, f"{tag}.{found.get('class', '')}", tag in NOT_TEXT or hidden, named=named or header)


def settle_keys(root: Node) -> None:
    """Keys and weights of all subtrees, children first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(node.children)
    for node in reversed(order):
        if node.tag == "#text":
            node.key, node.weight = hash(("#text", node.text)), 1.5
        else:
            node.key = hash((node.label, *(c.key for c in node.children)))
            node.weight = 1.0 + sum(c.weight for c in node.children)


def parse(page: str) -> Node:
    """The tree of block elements and texts; tolerant of what is left open or cut off."""
    root = Node("#root", "#root")
    stack, buffer = [root], []
    depth = 0  # of open article elements

    def settle() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                stack[-1].children.append(Node("#text", "#text", text=text))

    def close(to: int) -> None:
        nonlocal depth
        settle()
        while len(stack) > to:
            node = stack.pop()
            if node.tag in ARTICLE:
                depth -= 1
            stack[-1].article |= node.article

    for m in _TOKEN.finditer(page):
        raw, slash, tag, rest, text = m.groups()
        if text is not None:
            buffer.append(text)
        elif tag is not None:
            tag = tag.lower()
            if tag in INLINE:
                continue
            if tag == "br":
                buffer.append(" ")
                continue
            if slash:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                continue
            if tag in VOID:
                if tag == "hr":
                    settle()
                continue
            # a paragraph ends where another block begins, an item where the next begins
            ends = CLOSES_ITSELF.get(tag, ())
            if stack[-1].tag == "p" or (ends and stack[-1].tag in ends):
                close(len(stack) - 1)
                while ends and stack[-1].tag in ends:
                    close(len(stack) - 1)
            settle()
            node = _element(tag, rest, depth > 0)
            if tag in ARTICLE:
                depth += 1
                node.article = True
            stack[-1].children.append(node)
            if not rest.rstrip().endswith("/"):
                stack.append(node)
            elif tag in ARTICLE:
                depth -= 1
    close(1)
    settle_keys(root)
    return root


def texts(root: Node, varies: Callable[[Node], bool] = lambda n: True, names: bool = True) -> list[Node]:
    """Texts in page order, without parts that are out or named for something else.

    A named part that holds the article, or more than half of the text that ``varies``,
    is not out; what is named inside it is asked for itself. Where articles hold most of
    the text it is theirs alone. Without ``names`` neither names nor articles count.
    """
    found: list[tuple[Node, tuple[int, ...], bool]] = []
    todo: list[tuple[Node, tuple[int, ...], bool]] = [(root, (), False)]
    article: dict[int, bool] = {}
    while todo:
        node, inside, within = todo.pop()
        if node.tag == "#text":
            found.append((node, inside, within))
        elif not node.out:
            if names and node.named:
                inside = (*inside, id(node))
                article[id(node)] = node.article
            within = within or node.tag in ARTICLE
            todo.extend((c, inside, within) for c in reversed(node.children))
    if not names:
        return [n for n, _, _ in found]
    sizes: dict[int, int] = {}
    total = 0
    for node, inside, _ in found:
        size = len(node.text) if varies(node) else 0
        total += size
        for part in inside:
            sizes[part] = sizes.get(part, 0) + size
    stays = {part for part, size in sizes.items() if article[part] or 2 * size > total}
    left = [(n, within) for n, inside, within in found if stays.issuperset(inside)]
    whole = sum(len(n.text) for n, _ in left)
    inner = sum(len(n.text) for n, within in left if within)
    if 2 * inner >= whole and inner:
        return [n for n, within in left if within]
    return [n for n, _ in left]


def number(root: Node) -> int:
    """Number a reference's texts in order."""
    count, todo = 0, [root]
    while todo:
        node = todo.pop()
        if node.tag == "#text":
            node.number = count
            count += 1
        todo.extend(reversed(node.children))
    return count


def _pair_all(a: Node, b: Node, found: dict[Node, Node]) -> None:
    """Texts of equal trees by each other."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if x.tag == "#text":
            found[y] = x
        else:
            todo.extend(zip(x.children, y.children))


def _shape(root: Node, known: dict[tuple, int]) -> tuple[int, set[str]]:
    """A number for the tree without its texts, and the texts."""
    order, todo, words = [], [root], set()
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(node.children)
        if node.tag == "#text":
            words.add(node.text)
    done: dict[int, int] = {}
    for node in reversed(order):
        done[id(node)] = known.setdefault((node.label, *(done[id(c)] for c in node.children)), len(known))
    return done[id(root)], words


def _align_many(x: list[Node], y: list[Node], found: dict[Node, Node]) -> float:
    """The same alignment of very many siblings, in little memory.

    Trees without a text in common are worth what their shapes are, so that is worked out
    once for every two shapes; only pairs that share a text are aligned one by one. Of the
    table of sums some rows are kept, and those between them made again on the way back.
    """
    known: dict[tuple, int] = {}
    ours, theirs = [_shape(n, known) for n in x], [_shape(n, known) for n in y]
    shapes, first, kind = np.unique([s for s, _ in theirs], return_index=True, return_inverse=True)
    labels = [y[j].label for j in first]
    holders: dict[str, list[int]] = {}
    for j, (_, words) in enumerate(theirs):
        for word in words:
            holders.setdefault(word, []).append(j)
    apart: dict[int, np.ndarray] = {}  # by shape: the weight with every shape of ``y``
    pairs: dict[tuple[int, int], float] = {}

    def weights(i: int) -> np.ndarray:
        shape, words = ours[i]
        shared = {j for word in words for j in holders.get(word, ()) if y[j].label == x[i].label}
        row = apart.setdefault(shape, np.array([0.0 if n != x[i].label else np.nan for n in labels]))
        for k in np.flatnonzero(np.isnan(row)).tolist():
            j = next((j for j in np.flatnonzero(kind == k).tolist() if j not in shared), None)
            if j is not None:
                row[k] = align(x[i], y[j], {})
        out = row[kind]
        for j in shared:
            if (i, j) not in pairs:
                if len(pairs) >= 200_000:
                    pairs.clear()
                pairs[i, j] = align(x[i], y[j], {})
            out[j] = pairs[i, j]
        return out

    def following(above: np.ndarray, i: int) -> np.ndarray:
        row = np.zeros(len(y) + 1)
        row[1:] = np.maximum.accumulate(np.maximum(above[1:], above[:-1] + weights(i)))
        return row

    step = math.isqrt(len(x)) + 1
    row, kept = np.zeros(len(y) + 1), []
    for i in range(len(x)):
        if i % step == 0:
            kept.append(row)
        row = following(row, i)
    whole, j = float(row[-1]), len(y)
    for block in range(len(kept) - 1, -1, -1):
        begin, end = block * step, min((block + 1) * step, len(x))
        best = [kept[block]]
        for i in range(begin, end):
            best.append(following(best[-1], i))
        i = end - begin
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                align(x[begin + i], y[j], found)
    return whole


def align(a: Node, b: Node, found: dict[Node, Node]) -> float:
    """Simple tree matching: the size of the largest alignment of two trees whose
    roots agree, with equal texts counting more; ``found`` gets texts of ``b`` by ``a``.

    Equal subtrees are aligned as they are, so are chains of only children without
    recursion. More than ``_MOST_PAIRS`` pairs of siblings left after that are aligned
    alike, by shapes instead of one by one; time grows with the pairs, memory does not.
    """
    above = 0.0
    while True:
        if a.label != b.label:
            return above
        if a.key == b.key:
            _pair_all(a, b, found)
            return above + a.weight
        if a.tag == "#text":
            found[b] = a
            return above + 1.0
        above += 1.0
        x, y = a.children, b.children
        if len(x) == 1 and len(y) == 1:
            a, b = x[0], y[0]
            continue
        break
    low, x_end, y_end = 0, len(x), len(y)
    while low < x_end and low < y_end and x[low].key == y[low].key:
        _pair_all(x[low], y[low], found)
        above += x[low].weight
        low += 1
    while x_end > low and y_end > low and x[x_end - 1].key == y[y_end - 1].key:
        x_end, y_end = x_end - 1, y_end - 1
        _pair_all(x[x_end], y[y_end], found)
        above += x[x_end].weight
    x, y = x[low:x_end], y[low:y_end]
    if not x or not y:
        return above
    if len(x) * len(y) > _MOST_PAIRS:
        return above + _align_many(x, y, found)
    inner: dict[tuple[int, int], dict[Node, Node]] = {}
    weight = np.zeros((len(x), len(y)))
    places: dict[str, list[int]] = {}
    for j, node in enumerate(y):
        places.setdefault(node.label, []).append(j)
    for i, node in enumerate(x):
        for j in places.get(node.label, ()):
            pair: dict[Node, Node] = {}
            weight[i, j] = align(node, y[j], pair)
            if pair:
                inner[i, j] = pair
    best = np.zeros((len(x) + 1, len(y) + 1))
    for i in range(len(x)):
        best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + weight[i]))
    i, j = len(x), len(y)
    while i and j:
        if best[i, j] == best[i - 1, j]:
            i -= 1
        elif best[i, j] == best[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.update(inner.get((i, j), {}))
    return above + float(best[-1, -1])


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Induction:
    """A text is template if at least ``percent`` of the different pages of its layout that
    have a counterpart, ``pages`` of them or more, have the same text there, the
    reference left out. A layout of fewer pages goes with the rest of its host. Without
    ``names`` only alignment decides."""

    pages: int = 6
    percent: int = 90
    names: bool = True
    broadcast_bytes: int = 32 << 20


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


# Elements whose sequence tells layouts apart; what repeats inside them does not
_LAYOUT = "<(body|header|nav|main|article|section|aside|footer|form|table|div|ul|ol)[\\s/>]"


def layout_of(html: Column) -> Column:
    """A hash of the sequence of a page's structural elements, repeats counted once."""
    tags = F.regexp_extract_all(F.lower(html), F.lit(_LAYOUT), F.lit(1))
    apart = F.transform(
        F.array(tags), lambda all_: F.filter(all_, lambda t, i: (i == 0) | (t != F.get(all_, i - 1)))
    )[0]
    return F.xxhash64(F.array_join(apart, " "))


_BLOCK = "array<struct<ref:bigint,same:boolean,text:string>>"
_ALIGNED = f"page_id bigint, url string, grp string, page bigint, own boolean, blocks {_BLOCK}"


def aligned(pages: DataFrame, names: bool = True) -> DataFrame:
    """``pages (page_id, url, grp, page, html, reference)`` to ``(page_id, url, grp, page, own, blocks)``.

    A block's ``ref`` is the number of its counterpart in the reference; without one, a
    negative hash of its text. ``own`` pages are the reference's copies.
    """
    kind = pa.list_(pa.struct([("ref", pa.int64()), ("same", pa.bool_()), ("text", pa.string())]))

    def blocks_of(page: str, reference: Node) -> list[dict]:
        tree = parse(page)
        pairs: dict[Node, Node] = {}
        align(reference, tree, pairs)

        def same(n: Node) -> bool:
            return n in pairs and pairs[n].text == n.text

        # on a page that is its reference nothing varies: then all of it counts
        every = all(same(n) for n in texts(tree, names=False))
        out, seen = [], set()
        for n in texts(tree, (lambda n: True) if every else (lambda n: not same(n)), names):
            ref = pairs[n].number if n in pairs else -1 - (xxhash.xxh64_intdigest(n.text, 3) >> 2)
            out.append({"ref": ref, "same": same(n) if ref >= 0 else ref not in seen, "text": n.text})
            seen.add(ref)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # plain recursion, as deep as pages are
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))
        known: dict[str, Node] = {}
        for batch in batches:
            for piece in pieces(batch, "html", 1_000_000):
                rows, own = [], []
                for page, reference in zip(
                    piece.column("html").to_pylist(), piece.column("reference").to_pylist(), strict=True
                ):
                    if reference not in known:
                        if len(known) >= 256:
                            known.clear()
                        known[reference] = parse(reference)
                        number(known[reference])
                    own.append(page == reference)
                    rows.append(blocks_of(page, known[reference]))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in ("page_id", "url", "grp", "page")), pa.array(own), pa.array(rows, kind)],
                    names=["page_id", "url", "grp", "page", "own", "blocks"],
                )

    return pages.select("page_id", "url", "grp", "page", "html", "reference").mapInArrow(run, _ALIGNED)


def _with_references(ready: DataFrame, staging: Staging, induction: Induction) -> DataFrame:
    """``ready`` with ``grp``, a host and layout, and the page ``reference`` for it."""
    first = F.struct(F.length("html") == 0, F.col("page_id").isNull(), "page_id", "html")
    layouts = staging.table(
        ready.groupBy("host", "layout").agg(
            F.min(first).alias("first"), F.approx_count_distinct("page").alias("n")
        ),
        "layouts",
    )
    hosts = layouts.groupBy("host").agg(F.min("first").alias("host_first"))
    chosen = staging.table(
        layouts.join(hosts, "host").select(
            "host",
            "layout",
            F.when(F.col("n") > induction.pages, F.concat_ws(" ", "host", "layout")).otherwise(F.col("host")).alias("grp"),
            F.when(F.col("n") > induction.pages, F.col("first.html")).otherwise(F.col("host_first.html")).alias("reference"),
        ),
        "references",
    )
    size = chosen.agg(F.sum(F.octet_length("reference") + 2 * F.octet_length("host"))).first()[0] or 0
    return ready.join(F.broadcast(chosen) if size <= induction.broadcast_bytes else chosen, ["host", "layout"])


def _template(blocks: DataFrame, staging: Staging, induction: Induction) -> DataFrame:
    """``(grp, template)``: the counterparts and hashes of texts that stay the same.

    Pages are counted once however many copies of them there are; of a page only
    numbers are shuffled.
    """
    marks = F.transform("blocks", lambda b: F.struct(b["ref"].alias("ref"), b["same"].alias("same")))
    pages = blocks.filter(~F.col("own")).groupBy("grp", "page").agg(F.first(marks).alias("marks"))
    # every page has one mark more, which counts the pages
    all_ = F.array(F.struct(F.lit(None).cast("bigint").alias("ref"), F.lit(True).alias("same")))
    counted = (
        pages.select("grp", F.inline(F.concat(all_, "marks")))
        .groupBy("grp", "ref")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("same").alias("same"))
    )
    asked = F.when(F.col("ref") >= 0, F.col("n")).otherwise(F.col("pages"))
    # what varies, nearly all of what a large host has, goes before groups come together
    often = 100 * F.col("same") >= induction.percent * induction.pages
    repeated = staging.table(counted.filter(F.col("ref").isNull() | often), "repeated")
    whole = repeated.filter("ref IS NULL").select("grp", F.col("n").alias("pages"))
    return (
        join_checked(repeated.filter("ref IS NOT NULL"), whole, ["grp"])
        .filter((asked >= induction.pages) & (100 * F.col("same") >= induction.percent * asked))
        .groupBy("grp")
        .agg(F.collect_list("ref").alias("template"))
    )


def main_text(pages: DataFrame, staging: Staging, induction: Induction = Induction()) -> DataFrame:
    """``(page_id, url, text, n_chars, n_template)`` for every row of ``pages (page_id, url, html)``.

    Blocks end where a block element begins or ends; white space in them is one
    space, and a line break of the page counts as white space. Null and empty pages
    have empty text. Pages without a host, or a null url, are one host. A layout's
    reference is its page with the smallest id that is not empty, ties by html; a rare
    layout has that of its host. Copies of a page count once, those of the reference not
    at all. Hosts with few pages have no template, and lose only parts that are named for
    what they are. Trees may be as deep, and have as many siblings, as they like. Every row
    is judged for itself, so repeated rows agree; no other columns of ``pages`` are read.
    An empty table gives an empty one.
    """
    ready = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host_of(F.col("url").cast("string")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns({"layout": layout_of(F.col("html")), "page": F.xxhash64("html")})
    blocks = staging.table(
        aligned(_with_references(ready, staging, induction), induction.names), "blocks"
    )
    template = staging.table(_template(blocks, staging, induction), "template")
    held = template.agg(F.sum(8 * F.size("template") + F.octet_length("grp"))).first()[0] or 0
    side = F.broadcast(template) if held <= induction.broadcast_bytes else template
    none = F.array().cast("array<bigint>")
    content = F.filter(
        "blocks", lambda b: ~F.array_contains(F.coalesce(F.col("template"), none), b["ref"])
    )
    return (
        blocks.join(side, "grp", "left")
        .select("page_id", "url", content.alias("content"), F.size("blocks").alias("n_blocks"))
        .select(
            "page_id",
            "url",
            F.array_join("content.text", "\n").alias("text"),
            (F.col("n_blocks") - F.size("content")).alias("n_template"),
        )
        .select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_template")
    )


def op6_wrapper(spark, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages, Staging(spark))


QUERIES = {"op6_wrapper": op6_wrapper}
ORACLE: dict[str, str] = {}
