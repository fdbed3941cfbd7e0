"""Main text of web pages by wrapper induction over the pages of a host.

Every page becomes a DOM tree. Its skeleton keeps the structure only: neighbouring blocks of
text are one leaf, neighbouring elements with the same label one node. The skeletons of a host
are merged into one tree, and its pages are aligned with that, by simple tree matching; a block
that most pages with its leaf have there is template, what varies is a slot, and the slot with
most text is where the host has its articles. This holds inside <article> and <main> too, which
only weigh in the choice of the slot. Elements that say by tag, role, class or id what they are
(navigation, forms, sidebar, comments ...) are not content unless the slot is inside.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import picked, settings, staged

# Elements without an end tag, and elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
# Elements that end a block of text; of these, the ones that hold text only.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption td th caption summary address".split())
HOLDERS = frozenset(
    "html head body article main section div ul ol dl table thead tbody tfoot tr figure details header footer "
    "nav aside form fieldset center hr hgroup search dialog menu noscript template".split()
)
# Elements a start tag ends, up to the element that holds them.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
# Elements whose text is never shown or never prose; elements, roles and words of
# class or id that are not the article, unless the slot lies inside; of the words those that are
# also found on parts of an article, which count only for blocks without a long paragraph.
HIDDEN_TAGS = frozenset("head script style noscript template select textarea iframe svg math object title canvas audio video map".split())
ASIDE_TAGS = frozenset("nav footer aside form button dialog menu fieldset search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu submenu breadcrumb breadcrumbs sidebar widget widgets cookie cookies consent gdpr "
    "popup modal overlay newsletter subscribe subscription signup signin login comment comments commentlist "
    "disqus respond reply replies footer masthead share sharing recommended recommendations "
    "pagination pager toolbar skip search searchbox".split()
)
OPEN_WORDS = frozenset("discussion notice notices alert legal related tags social copyright disclaimer".split())
PARAGRAPH = 200
TOP_WORDS = frozenset("header topbar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|([^<]+)|</?[a-zA-Z][^>]*\Z|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
# Elements nested deeper than this belong to the one at this depth.
DEEPEST = 150
# Children compared with children: beyond this many pairs they are aligned in linear memory.
MOST_PAIRS = 40_000
# A block is template if it is on this share of the pages that have its leaf, and on at least
# so many different pages.
SAME, PAGES = 0.6, 4
# In the choice of the slot, text in neither, in a <main> and in an <article> counts so often,
# and text below an element that names itself otherwise this much less.
MARKS, NAMED = (1.0, 1.5, 2.0), 0.1
# On a host of fewer pages than this, blocks outside the slot are template if two pages share them.
SMALL_HOST, TWO = 8, 2
# What an element calls itself: nothing, not the article, perhaps not the article.
NOTHING, ASIDE, OPEN = 0, 1, 2
# Trees of so many tasks are merged at a time, and so many shapes are held before they are merged.
FAN_IN, HELD = 64, 1000


class Node:
    __slots__ = ("tag", "label", "children", "texts", "aside", "content", "mute", "named", "says")

    def __init__(self, tag: str, label: str, aside: bool, content: int, named: int = NOTHING, says: bool = False):
        self.tag, self.label, self.aside, self.content, self.named, self.says = tag, label, aside, content, named, says
        self.children: list[Node] = []
        self.texts: list[str] = []
        self.mute = False


def _start(tag: str, attributes: str, parent: Node) -> Node:
    """An element; aside: it or one around it is never shown; content: 2 in an article, 1 in main.

    named: it says by its tag, role or an aside word that it is not the article; says: that it is
    the article or main.
    """
    label, aside, content, named, says = tag, parent.aside or tag in HIDDEN_TAGS, parent.content, int(tag in ASIDE_TAGS), tag in ("article", "main")
    names: set[str] = set()
    if attributes and not attributes.isspace():
        found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
        names = set(re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower()))
        if names:
            label += "." + ".".join(sorted(names))
        if tag not in ("html", "body", "article", "main"):
            said = found.get("role", "").lower() in ASIDE_ROLES or found.get("aria-hidden", "").lower() == "true"
            named = named or (ASIDE if said or names & ASIDE_WORDS else OPEN if names & OPEN_WORDS else NOTHING)
            aside = aside or "display:none" in found.get("style", "").replace(" ", "").lower()
            aside = aside or bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))
        if found.get("role", "").lower() in ("main", "article"):
            content, says = max(content, 1), True
    if tag == "article":
        content = 2
    elif tag == "main":
        content = max(content, 1)
    if not content and tag not in ("html", "body"):
        named = ASIDE if tag == "header" or names & TOP_WORDS else named
    return Node(tag, label, aside, content, named, says)


def parse(page: str | None) -> Node:
    """The tree of a page; texts of a node are its blocks, white space folded, references decoded."""
    root = Node("#page", "#page", False, 0)
    stack, buffer, deeper = [root], [], Counter()

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                holder = next(n for n in reversed(stack) if n.tag in FLOW or n.tag in HOLDERS or n is root)
                leaf = Node("#text", "#text", stack[-1].aside, stack[-1].content)
                leaf.texts.append(text)
                holder.children.append(leaf)

    def close(upto: int) -> None:
        if any(n.tag in FLOW or n.tag in HOLDERS for n in stack[upto:]):
            flush()
        del stack[upto:]

    page = page or ""
    at, low = 0, None
    while m := TOKEN.match(page, at):
        at = m.end()
        text = m[7]
        if text is not None:
            if not stack[-1].mute:
                buffer.append(entities.unescape(text) if "&" in text else text)
            continue
        tag = m[2] or m[5]
        if not tag:
            if m[0] == "<":
                buffer.append("<")
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag == "br":
                buffer.append(" ")
                continue
            if deeper[tag]:
                deeper[tag] -= 1
                flush()
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("td", "th", "table", "body", "article", "main") and tag not in HOLDERS:
                    break
            continue
        block = tag in FLOW or tag in HOLDERS
        if block:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in HOLDERS or stack[i].tag in FLOW:
                    break
        if tag in ENDS:
            ended, held = ENDS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in held:
                    break
                if stack[i].tag in ended:
                    close(i)
                    if tag != "tr" or stack[-1].tag in held:
                        break
        if block:
            flush()
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                buffer.append(" " if tag != "wbr" else "")
            continue
        node = _start(tag, m[3] or m[6] or "", stack[-1])
        if tag in RAW:
            if low is None:
                low = page.lower()
                if len(low) != len(page):
                    low = re.sub("[A-Z]", lambda c: c[0].lower(), page)
            end = low.find("</" + tag, at)
            if end < 0:
                break
            at = page.find(">", end) + 1 or len(page)
            continue
        if len(stack) > DEEPEST:
            deeper[tag] += 1
            continue
        around = stack[-1]
        if around.tag not in FLOW and around.tag not in HOLDERS:  # an inline element is no node of its own
            node.named, node.says = node.named or (NOTHING if node.says else around.named), node.says or around.says and not node.named
        if block:
            _holder(stack).children.append(node)
        else:  # text of an element inside a block that is never content is left out of the block
            node.mute = around.mute or bool(node.named) or node.aside and not around.aside
        stack.append(node)
    close(1)
    flush()
    return root


def _holder(stack: list[Node]) -> Node:
    return next((n for n in reversed(stack) if n.tag in FLOW or n.tag in HOLDERS), stack[0])


class Part:
    """A node of the skeleton: a label, parts below it, and for leaves the blocks of text."""

    __slots__ = ("label", "parts", "blocks", "aside", "named", "says")

    def __init__(self, label: str, aside: bool, named: int = NOTHING, says: bool = False):
        self.label, self.aside, self.named, self.says = label, aside, named, says
        self.parts: list[Part] = []
        self.blocks: list[tuple[str, bool, int]] = []


def _leaf_blocks(node: Node, inner: bool = False) -> list[tuple[str, bool, int]] | None:
    """The blocks of a node that has text only, else None; inner: below an aside word inside the leaf."""
    if node.tag == "#text":
        return [(t, node.aside or inner, node.content) for t in node.texts]
    if node.tag in HOLDERS or node.tag not in FLOW and node.children:
        return None
    found = []
    for child in node.children:
        below = _leaf_blocks(child, inner or bool(child.named))
        if below is None:
            return None
        found += below
    return found


def skeleton(node: Node) -> Part:
    part = Part(node.label, node.aside, node.named, node.says)
    for child in node.children:
        blocks = _leaf_blocks(child)
        if blocks is not None:
            label = "#text-" if child.aside else "#text~" if child.named else "#text"
            if not blocks:
                continue
            if not part.parts or part.parts[-1].label != label:
                part.parts.append(Part(label, child.aside, child.named))
            part.parts[-1].blocks += blocks
            continue
        below = skeleton(child)
        if part.parts and part.parts[-1].label == below.label:
            _fold(part.parts[-1], below)
        else:
            part.parts.append(below)
    return part


def _fold(into: Part, more: Part) -> None:
    """Put the parts of a repeated element after those of the first, repeats folded again."""
    for part in more.parts:
        if into.parts and into.parts[-1].label == part.label:
            into.parts[-1].blocks += part.blocks
            _fold(into.parts[-1], part)
        else:
            into.parts.append(part)


def shape(part: Part | Shape) -> list:
    return [part.label, [shape(p) for p in part.parts]]


class Shape:
    """A reference skeleton; nodes are numbered in document order."""

    __slots__ = ("label", "parts", "number", "last")

    def __init__(self, data: list, count: list[int]):
        self.number = count[0]
        count[0] += 1
        self.label = data[0]
        self.parts = [Shape(d, count) for d in data[1]]
        self.last = count[0]


def tree_matching(part: Part, known: Shape) -> tuple[int, list]:
    """Simple tree matching: the most nodes two trees with equal roots share in order, and the pairs.

    Pairs are given as a nested list to be read by `pairs`.
    """
    if part.label != known.label:
        return 0, []
    a, b = part.parts, known.parts
    if not a or not b:
        return 1, [(part, known)]
    if len(a) * len(b) > MOST_PAIRS:
        return _wide(part, known)
    size = [[(0, None)] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            best = max(size[i - 1][j], size[i][j - 1], key=lambda c: c[0])
            if x.label == y.label:
                n, below = tree_matching(x, y)
                if size[i - 1][j - 1][0] + n > best[0]:
                    best = (size[i - 1][j - 1][0] + n, (size[i - 1][j - 1][1], below))
            size[i][j] = best
    total, found = size[-1][-1]
    return total + 1, [(part, known), found]


def _wide(part: Part, known: Shape) -> tuple[int, list]:
    """The same for very many children: divide and conquer over rows (Hirschberg), in linear memory."""
    a, b = part.parts, known.parts
    kinds: dict[str, int] = {}
    first: dict[int, Part | Shape] = {}

    def kind(x: Part | Shape) -> int:
        k = kinds.setdefault(json.dumps(shape(x)), len(kinds))
        first.setdefault(k, x)
        return k

    left, (columns, right) = [kind(x) for x in a], np.unique([kind(y) for y in b], return_inverse=True)

    @lru_cache(1024)
    def gains(k: int) -> np.ndarray:
        return np.array([tree_matching(first[k], first[c])[0] for c in columns], np.int64)

    def sums(rows: Iterable[int], cols: np.ndarray) -> np.ndarray:
        """The best totals of these rows with each number of first columns."""
        best = np.zeros(len(cols) + 1, np.int64)
        for i in rows:
            best[1:] = np.maximum(best[1:], best[:-1] + gains(left[i])[cols])
            np.maximum.accumulate(best, out=best)
        return best

    total, found, todo = 1, [(part, known)], [(0, len(a), 0, len(b))]
    while todo:
        low, high, start, end = todo.pop()
        if low == high or start == end:
            continue
        cols = right[start:end]
        if high - low == 1:
            at = int(np.argmax(gains(left[low])[cols]))
            n, below = tree_matching(a[low], b[start + at])
            total, found = total + n, [below, found]
            continue
        middle = (low + high) // 2
        cut = start + int(np.argmax(sums(range(low, middle), cols) + sums(range(high - 1, middle - 1, -1), cols[::-1])[::-1]))
        todo += [(low, middle, start, cut), (middle, high, cut, end)]
    return total, found


def pairs(found) -> Iterator[tuple[Part, Shape]]:
    todo = [found]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple) and len(x) == 2 and isinstance(x[0], (Part, Shape)):
            yield x
        elif x:
            todo.extend(x)


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def counted_shape(part: Part | Shape, pages: int) -> list:
    """A shape that says of each node how many pages have it."""
    return [part.label, [counted_shape(p, pages) for p in part.parts], pages]


def merged(trees: Iterable[list]) -> list:
    """One tree of counted shapes with equal roots: nodes that align are one, the others stand beside them."""
    all_ = iter(trees)
    whole = next(all_)
    for more in all_:
        into, other = Shape(whole, [0]), Shape(more, [0])
        of: dict[int, list] = {}

        def note(known: Shape, data: list, of=of) -> None:
            of[id(known)] = data
            for k, d in zip(known.parts, data[1], strict=True):
                note(k, d)

        note(into, whole)
        same = {id(b): of[id(a)] for a, b in pairs(tree_matching(into, other)[1])}

        def add(data: list, known: Shape, new: list, same=same) -> None:
            data[2] += new[2]
            parts, at = [], 0
            for k, d in zip(known.parts, new[1], strict=True):
                partner = same.get(id(k))
                if partner is None:
                    parts.append(d)
                    continue
                while data[1][at] is not partner:
                    parts.append(data[1][at])
                    at += 1
                add(partner, k, d)
                parts.append(partner)
                at += 1
            data[1] = parts + data[1][at:]

        add(whole, other, more)
    return whole


def pruned(tree: list) -> list:
    """The shape of a merged tree without nodes of so few pages that nothing in them can be template."""
    least = PAGES if tree[2] >= SMALL_HOST else min(tree[2], TWO)

    def cut(node: list) -> list:
        return [node[0], [cut(t) for t in node[1] if t[2] >= least]]

    return cut(tree)


@lru_cache(64)
def _known(reference: str) -> Shape:
    return Shape(json.loads(reference), [0])


def _leaves(tree: Part) -> list[tuple[Part, frozenset[int]]]:
    """The leaves in page order, and the elements around each that are named otherwise, up to an article or main; OPEN ones negative."""
    found: list[tuple[Part, frozenset[int]]] = []

    def walk(part: Part, named: frozenset[int]) -> None:
        if part.says:
            named = frozenset()
        if part.named:
            named = named | {id(part) if part.named == ASIDE else -id(part)}
        if part.blocks:
            found.append((part, named))
        for p in part.parts:
            walk(p, named)

    walk(tree, frozenset())
    return found


def _kind(part: Part, named: frozenset[int]) -> int:
    """0, 1, 2: in no marked element, a main, an article; three more below an aside word."""
    return max(b[2] for b in part.blocks) + (3 if named else 0)


def weight(kind: int) -> float:
    return MARKS[kind % 3] * (NAMED if kind > 2 else 1)


def observations(page: str | None, reference: str) -> list[tuple[int, int | None, int, int, int]]:
    """(node, hash of a block, code points, hash of the page's text, kind) of each block of an aligned leaf.

    With no hash for the leaf as a whole. Blocks that are never content are not listed.
    """
    tree = skeleton(parse(page))
    number = {id(p): k.number for p, k in pairs(tree_matching(tree, _known(reference))[1])}
    leaves = [(p, named, [t for t, aside, _ in p.blocks if not aside]) for p, named in _leaves(tree)]
    whole = _digest("\n".join(t for _, _, said in leaves for t in said))
    seen: list[tuple[int, int | None, int, int, int]] = []
    for p, named, said in leaves:
        if said and id(p) in number:
            node, kind = number[id(p)], _kind(p, named)
            seen.append((node, None, sum(map(len, said)), whole, kind))
            seen += [(node, _digest(t), len(t) * n, whole, kind) for t, n in Counter(said).items()]
    return seen


def _content(tree: Part, template: set[tuple[int, int]], slot: int, reference: str, shared: set[tuple[int, int]] = frozenset()) -> list[str]:
    """The blocks of the article, in page order: all that vary where the slot is.

    shared: blocks of few pages, which are template outside the slot. An element with an open word is
    one with an aside word unless it holds a long paragraph that varies.
    """
    number = {id(p): k.number for p, k in pairs(tree_matching(tree, _known(reference))[1])}
    fixed = {n for n, _ in template | shared}
    open_: list[tuple[Part, frozenset[int], list[str]]] = []
    marked: list[tuple[int, str]] = []
    prose: set[int] = set()
    for p, named in _leaves(tree):
        n = number.get(id(p))
        said = [(t, content) for t, aside, content in p.blocks if not aside]
        marked += [(content, t) for t, content in said if content and not named]
        varying = [t for t, _ in said if n not in fixed or (n, _digest(t)) not in template and (n == slot or (n, _digest(t)) not in shared)]
        if varying:
            open_.append((p, named, varying))
            if max(map(len, varying)) >= PARAGRAPH:
                prose |= {x for x in named if x < 0}
    open_ = [(p, named - prose, varying) for p, named, varying in open_]
    if not open_ or marked and all(named for _, named, _ in open_):  # copies of one article: what most pages share is the article
        return [t for content, t in marked if content == max(marked)[0]]
    best = next(((p, named) for p, named, _ in open_ if number.get(id(p)) == slot), None)
    if best is None:
        size: Counter = Counter()
        for p, named, said in open_:
            size[_kind(p, named)] += weight(_kind(p, named)) * sum(map(len, said))
        kind = max(size, key=lambda k: (size[k], -k))
        best = max(((p, named, s) for p, named, s in open_ if _kind(p, named) == kind), key=lambda x: sum(map(len, x[2])))[:2]
    level, around = _kind(*best) % 3, best[1]
    return [t for p, named, said in open_ if named <= around and _kind(p, named) % 3 >= level for t in said]


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty for a null or odd address."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row for each page: id, url, text and n_chars (code points).

    The text is that of the article: blocks in page order, joined by one line feed; white space
    inside a block is one space and character references are decoded. The skeletons of all pages
    of a host are merged into one tree, first within tasks, and every page is aligned with it, so
    each layout of a host has its nodes. A block is template if most pages that have its leaf
    have it, also in an element that says it is the article; all others where the slot is are
    the text. A page with template only, all of it in such an element, keeps that. Pages
    meet the tree and then the wrapper of their host, some kilobytes each, in two
    joins of tables, in which Spark may split a host with very many pages; what they say about
    the leaves is counted with partial sums. A null, empty or unreadable
    page has an empty text; pages without a host are one host; repeated rows are pages of their
    own; other columns are ignored; an empty table gives no rows.
    """
    rows = picked(pages, *dict.fromkeys([id, url, html])).select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"),
        host_of(F.col(f"`{url}`").cast("string")).alias("host"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def fold(host: str) -> None:
            """Merge what is held of a host, in an order that does not depend on that of the rows."""
            trees = [counted_shape(Shape(json.loads(k), [0]), n) if n else json.loads(k) for k, n in sorted(found[host].items())]
            found[host] = Counter({json.dumps(merged(trees)): 0})

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                held = found.setdefault(host, Counter())
                held[json.dumps(shape(skeleton(parse(page))))] += 1
                if len(held) > HELD:
                    fold(host)
        for host in found:
            fold(host)
        task = TaskContext.get().partitionId()
        made = [next(iter(held)) for held in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([task] * len(found), pa.int64()), pa.array(made, pa.string())], ["host", "task", "tree"])

    def joined(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                trees = [merged(map(json.loads, t)) for t in batch.column("trees").to_pylist()]
                made = [json.dumps(pruned(t) if last else t) for t in trees]
                yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(made, pa.string())], ["host", "shape" if last else "tree"])

        return run

    def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for host, page, known in zip(*[batch.column(c).to_pylist() for c in ("host", "html", "shape")], strict=True):
                seen.update((host, *o) for o in observations(page, known))
            columns = list(zip(*seen, strict=True)) or [()] * 6
            kinds = (pa.string(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "node", "said", "chars", "page", "kind"]
            )

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, known, template, slot in zip(*[batch.column(c).to_pylist() for c in ("html", "shape", "template", "slot")], strict=True):
                fixed, shared = ({(t["node"], t["said"]) for t in template or () if t["few"] == few} for few in (False, True))
                out.append("\n".join(_content(skeleton(parse(page)), fixed, slot if slot is not None else -1, known, shared)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, pa.string())], ["id", "url", "text"])

    with settings(pages.sparkSession):
        trees = rows.select("host", "html").mapInArrow(shapes, "host string, task long, tree string")
        some = trees.groupBy("host", F.expr(f"task div {FAN_IN}").alias("some")).agg(F.sort_array(F.collect_list("tree")).alias("trees"))
        trees = some.select("host", "trees").mapInArrow(joined(False), "host string, tree string")
        all_ = trees.groupBy("host").agg(F.sort_array(F.collect_list("tree")).alias("trees"))
        references = staged(all_.mapInArrow(joined(True), "host string, shape string"), "references")
        seen = rows.select("host", "html").join(references, "host").select("host", "html", "shape").mapInArrow(
            observed, "host string, node long, said long, chars long, page long, kind long"
        )
        counted = seen.distinct().groupBy("host", "node", "said").agg(
            F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.max("kind").alias("kind")
        )
        counted = staged(counted.filter(F.col("said").isNull() | (F.col("pages") >= TWO)), "counted")
        leaves = counted.filter("said IS NULL").select("host", "node", F.col("pages").alias("of"), F.col("chars").alias("all"), "kind")
        fixed = counted.filter("said IS NOT NULL").drop("kind").join(leaves.select("host", "node", "of"), ["host", "node"])
        enough = (F.col("pages") >= PAGES) | (F.col("of") < SMALL_HOST)
        fixed = fixed.filter((F.col("pages") >= SAME * F.col("of")) & enough).withColumn("few", F.col("pages") < PAGES)
        less = fixed.filter("NOT few").groupBy("host", "node").agg(F.sum("chars").alias("less"))
        left = leaves.join(less, ["host", "node"], "left").withColumn("chars", F.col("all") - F.coalesce("less", F.lit(0))).filter("chars > 0")
        best = left.groupBy("host", "kind").agg(F.sum("chars").alias("chars"), F.max_by("node", F.struct("chars", -F.col("node"))).alias("slot"))
        weights = F.array(*[F.lit(weight(k)) for k in range(6)])
        best = best.groupBy("host").agg(F.max_by("slot", F.struct(F.col("chars") * F.get(weights, F.col("kind").cast("int")), -F.col("kind"))).alias("slot"))
        template = fixed.groupBy("host").agg(F.collect_list(F.struct("node", "said", "few")).alias("template"))
        wrappers = staged(references.join(template, "host", "left").join(best, "host", "left"), "wrappers")
    done = rows.join(wrappers, "host").select("id", "url", "html", "shape", "template", "slot").mapInArrow(
        texts, f"id {kind}, url string, text string"
    )
    return done.select(F.col("id").alias(id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
