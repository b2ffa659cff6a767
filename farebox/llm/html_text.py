"""Operator 11: main text of web pages by minimum cuts.

A page's markup becomes *blocks*: stretches of text that no start or end of a block element
interrupts.  A classifier gives every block a cost for being called content and one for
being called boilerplate; they are the capacities to the two terminals of a graph.  Blocks
that follow each other, and blocks below one element of the document tree (through a node
for that element, which is joined to the one above), are linked by smoothness capacities.
The minimum cut, found by max-flow, is the labelling with the least cost; blocks on the
source's side are the main text.

The classifier has two parts.  What the enclosing elements say of themselves (tags, roles,
words of classes and ids) gives a fixed cost.  The form of a block (its tag, number of words,
share of linked words, punctuation) gives a naive Bayes log ratio, learned from the blocks
whose elements say what they are, on a sample of about ``SAMPLE_PAGES`` pages (a documented
bound on what is learned from, never on what is extracted).

Pages are independent: Spark deals them and nothing is shuffled but the bounded counts of
forms.

Defined results: a null or empty page, and one without content, gives an empty text; repeated
rows each get theirs; columns other than those asked for are not read; white space is what
Unicode calls so; ``br`` is white space; an unclosed comment, script or tag ends the page;
an empty table gives an empty table.  Very long pages take time in proportion to their
length for reading; the cut's time follows the blocks left undecided by their own cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import text_or_empty

#: About so many pages are learned from.
SAMPLE_PAGES = 2000

#: Capacities, in hundredths of a natural logarithm's unit.
SAID, ELSEWHERE, FORM = 600, 200, 300
NEXT_BLOCK, SAME_ELEMENT, ABOVE = 80, 60, 30

# HTML's elements by their part in a page.
METADATA = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "title", "head", "iframe", "object", "canvas", "audio", "video"}
RAW = {"script", "style", "title", "textarea", "iframe", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
select summary table tbody td textarea tfoot th thead tr ul""".split()) | SKIPPED
LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "pre", "blockquote", "figcaption", "caption"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
          "option": {"option"}}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "select", "textarea", "fieldset", "search"}
CONTENT_ROLES = {"article", "main"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog",
                     "menu", "menubar", "toolbar", "note"}
CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story"}
BOILERPLATE_WORDS = set("""ad ads adsense advert adverts advertisement advertising alert aside author banner bio breadcrumb
breadcrumbs byline comment comments consent contentinfo cookie cookies copyright dialog discussion disqus feedback foot footer form
gdpr header legal login masthead menu meta modal nav navbar navigation newsletter notice notices notification overlay pager
pagination popup privacy promo promotion recommended related replies reply respond search share sharing sidebar signup skip
skyscraper social sponsor sponsored sponsors subscribe subscription tags toolbar topbar widget widgets""".split())
#: Log ratios of forms that hold before anything is learned, in the same hundredths.
PRIOR = {"words=1": -100, "words=2": -50, "words=5": 50, "words=6": 100, "words=7": 100, "words=8": 100, "words=9": 100,
         "links=0": 50, "links=2": -100, "links=3": -150, "links=4": -200, "end=stop": 50, "end=none": -50, "tag=p": 50, "tag=h1": 100}
NEGATED = {"has", "no", "with", "without"}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block:
    """A stretch of text: its words, the words inside links, the tag it stands in, what its
    elements say (1 content, -1 boilerplate, 0 nothing) and the element it stands below."""

    __slots__ = ("text", "linked", "tag", "said", "below")

    def __init__(self, text: str, linked: int, tag: str, said: int, below: int):
        self.text, self.linked, self.tag, self.said, self.below = text, linked, tag, said, below


def says(tag: str, attributes: str, inherited: int) -> int:
    """What an element says of what is in it, given what the elements around it say.
    Boilerplate holds no content; content may hold boilerplate."""
    if inherited < 0:
        return -1
    if tag in BOILERPLATE_TAGS or tag == "header" and not inherited:
        return -1
    good = tag in CONTENT_TAGS
    if attributes and tag not in ("html", "body"):
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id"):
                for token in value.split():
                    parts = [x.lower() for x in NAME_PART.findall(token)]
                    if NEGATED & set(parts):
                        continue
                    if not good and BOILERPLATE_WORDS & set(parts) and not (inherited and parts[-1] in ("header", "meta", "tags") and len(parts) > 1):
                        return -1
                    good = good or bool(CONTENT_WORDS & set(parts))
            elif name == "role":
                if value.lower() in BOILERPLATE_ROLES:
                    return -1
                good = good or value.lower() in CONTENT_ROLES
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                return -1
    return 1 if good or inherited else 0


def read_blocks(page: str) -> tuple[list[Block], list[int]]:
    """The page's blocks in order, and for each element the one above it (-1: none)."""
    above = [-1]
    stack = [("", 0, 0, False)]  # tag, what it says, its number, skipped
    open_tags: dict[str, int] = {}
    blocks: list[Block] = []
    parts: list[str] = []
    linked, in_link, at, size = 0, False, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, said, number, _ = stack[-1]
                below = stack[-2][2] if tag in LEAF else number
                blocks.append(Block(text, min(linked, len(text.split())), tag, said, below))
            parts.clear()
        linked = 0

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    def said(text: str) -> None:
        nonlocal linked
        if text and not stack[-1][3]:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked += len(text.split())

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            said(page[at:])
            break
        said(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if m is None:
            if page.find(">", lt) < 0 and (page[lt + 1:lt + 2].isalpha() or page.startswith("</", lt)):
                break  # the page ends within a tag
            said("<")
            at = lt + 1
            continue
        at = m.end()
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if stack[-1][0] == "head" and tag not in METADATA:
            pop()  # the head ends with the first tag that can't stand in it
        if closing:
            if tag == "a":
                in_link = False
            elif tag == "br":
                said(" ")
            elif tag in BLOCK:
                if tag not in SKIPPED:
                    flush()
                    in_link = False
                if open_tags.get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            continue
        if tag == "a":
            in_link = True
        elif tag == "br":
            said(" ")
        elif tag in BLOCK:
            if tag not in SKIPPED:  # those stand within a block without ending it
                flush()
                if stack[-1][0] == "p":
                    pop()
                while stack[-1][0] in CLOSES.get(tag, ()):
                    pop()
            if tag in VOID or attributes.endswith("/") and tag in ("svg", "math"):
                continue
            state = says(tag, attributes, stack[-1][1])
            above.append(stack[-1][2])
            stack.append((tag, state, len(above) - 1, stack[-1][3] or tag in SKIPPED))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
                if end is None:
                    break
                if not stack[-1][3]:
                    said(page[at:end.start()])
                at = end.start()
    flush()
    return blocks, above


def form(block: Block) -> list[str]:
    """Features of a block's own form, from small fixed sets."""
    words = block.text.split()
    n = len(words)
    ends = block.text[-1]
    return [f"tag={block.tag if block.tag in LEAF else 'other'}", f"words={min(n.bit_length(), 9)}",
            f"links={4 * block.linked // max(n, 1)}", f"end={'stop' if ends in '.!?…' else 'colon' if ends in ':,;' else 'none'}",
            f"commas={min(block.text.count(','), 3)}"]


def costs(blocks: list[Block], model: dict[str, int]) -> list[int]:
    """Positive: the cost of calling a block boilerplate; negative: of calling it content."""
    told = any(b.said > 0 for b in blocks)
    out = []
    for b in blocks:
        shape = sum(PRIOR.get(f, 0) + model.get(f, 0) for f in form(b))
        out.append(max(-FORM, min(FORM, shape)) + (SAID * b.said if b.said else -ELSEWHERE if told else 0))
    return out


def links(blocks: list[Block], above: list[int]) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of nodes and smoothness edges: blocks first, then elements that hold some."""
    n = len(blocks)
    edges = [(i, i + 1, NEXT_BLOCK if blocks[i].below == blocks[i + 1].below else NEXT_BLOCK // 4) for i in range(n - 1)]
    node: dict[int, int] = {}
    for i, b in enumerate(blocks):
        edges.append((i, node.setdefault(b.below, n + len(node)), SAME_ELEMENT))
    seen: dict[int, int] = {}
    for element, at in list(node.items()):
        # the nearest element above that holds blocks itself; paths are walked once
        walk, up = [], above[element]
        while up >= 0 and up not in node and up not in seen:
            walk.append(up)
            up = above[up]
        top = up if up in node else seen.get(up, -1)
        seen.update(dict.fromkeys(walk, top))
        if top >= 0:
            edges.append((at, node[top], ABOVE))
    return n + len(node), edges


def min_cut(cost: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling with the least sum of the costs of nodes labelled against their sign
    and the capacities of edges between different labels; ties go to False.

    A node whose own cost exceeds all its links is decided by it, and its links become costs
    of its neighbours; max-flow (Dinic) settles what remains.
    """
    n = len(cost)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0) + c
            near[b][a] = near[b].get(a, 0) + c
    cost, load = list(cost), [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    ready = deque(range(n))
    while ready:
        v = ready.popleft()
        if label[v] is None and abs(cost[v]) > load[v] or not near[v] and label[v] is None:
            label[v] = cost[v] > 0
            for u, c in near[v].items():
                cost[u] += c if label[v] else -c
                load[u] -= c
                del near[u][v]
                ready.append(u)
    left = [v for v in range(n) if label[v] is None]
    if left:
        for v in _source_side(left, cost, near):
            label[v] = True
    return [bool(x) for x in label]


def _source_side(left: list[int], cost: list[int], near: list[dict[int, int]]) -> list[int]:
    """Nodes that the source reaches after a maximal flow: positive costs are capacities
    from the source, negative ones to the sink."""
    source, sink = -1, -2
    rest: dict[int, dict[int, int]] = {v: dict(near[v]) for v in left} | {source: {}, sink: {}}
    for v in left:
        if cost[v] > 0:
            rest[source][v], rest[v][source] = cost[v], 0
        elif cost[v] < 0:
            rest[v][sink], rest[sink][v] = -cost[v], 0

    def levels() -> dict[int, int]:
        level, queue = {source: 0}, deque([source])
        while queue:
            v = queue.popleft()
            for u, c in rest[v].items():
                if c > 0 and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        return level

    while sink in (level := levels()):
        todo = {v: list(rest[v]) for v in level}
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                flow = min(rest[a][b] for a, b in zip(path, path[1:]))
                cut = len(path)
                for i, (a, b) in enumerate(zip(path, path[1:])):
                    rest[a][b] -= flow
                    rest[b][a] += flow
                    if not rest[a][b]:
                        cut = min(cut, i + 1)
                del path[cut:]
                continue
            while todo[v]:
                u = todo[v][-1]
                if rest[v][u] > 0 and level.get(u, 0) == level[v] + 1:
                    path.append(u)
                    break
                todo[v].pop()
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()
    return [v for v in level if v >= 0]


def main_text(page: str, model: dict[str, int]) -> tuple[str, int]:
    """The page's main text and how many of its blocks were left out."""
    blocks, above = read_blocks(page)
    if not blocks:
        return "", 0
    n, edges = links(blocks, above)
    label = min_cut(costs(blocks, model) + [0] * (n - len(blocks)), edges)
    kept = [b.text for b, x in zip(blocks, label) if x]
    return "\n".join(kept), len(blocks) - len(kept)


def train(pages: DataFrame, column: str = "html") -> dict[str, int]:
    """Log ratios of forms between blocks that are said to be content and boilerplate."""
    few = pages.select(text_or_empty(column).alias("html"))
    n = pages.count()
    if n > SAMPLE_PAGES:
        few = few.filter(F.pmod(F.xxhash64("html"), F.lit(n)) < SAMPLE_PAGES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}
        for b in batches:
            for page in b.column("html"):
                for block in read_blocks(page.as_py())[0]:
                    if block.said:
                        for f in form(block):
                            seen[f, block.said] = seen.get((f, block.said), 0) + 1
        rows = [(f, s, c) for (f, s), c in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["form", "said", "n"])

    counts = few.mapInArrow(count, "form string, said int, n bigint").groupBy("form", "said").agg(F.sum("n").alias("n")).collect()
    total = {s: 1 + sum(r.n for r in counts if r.said == s) // 5 for s in (1, -1)}
    by_form: dict[str, dict[int, int]] = {}
    for r in counts:
        by_form.setdefault(r.form, {})[r.said] = r.n
    return {f: round(100 * math.log((c.get(1, 0) + 1) * (total[-1] + 1) / ((c.get(-1, 0) + 1) * (total[1] + 1))))
            for f, c in by_form.items()}


def extract(pages: DataFrame, model: dict[str, int], column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns with ``text`` and ``n_dropped``, the blocks left out."""
    out = pages.select(*keep, text_or_empty(column).alias("_html"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                few = b.slice(at, 256)
                found = [main_text(x.as_py(), model) for x in few.column("_html")]
                yield pa.RecordBatch.from_arrays([*few.columns[:-1], pa.array([x[0] for x in found], pa.string()),
                                                  pa.array([x[1] for x in found], pa.int64())],
                                                 names=[*few.schema.names[:-1], "text", "n_dropped"])

    return out.mapInArrow(work, ", ".join([*fields, "text string", "n_dropped bigint"]))
