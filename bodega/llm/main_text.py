"""Main text of web pages by a tree-structured graphical model over the DOM.

Each block of a page is content or not. What a block looks like gives its own potential; parent and
child are tied by pair potentials. Sum-product messages, up the tree and down again, give every
block's marginal. Potentials are learned from pages that label themselves: those that mark their
article, and their menus, footers, forms and so on, by elements or class names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm.common import column_of, map_rows, small_batches

TRAIN_PAGES = 2000  # pages, about, that the potentials are learned from

# Element names of HTML: fixed values.
BLOCKS = frozenset(
    "html body div p article section main header footer nav aside form fieldset ul ol li dl dt dd table thead tbody tfoot "
    "tr td th caption h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary hr center dialog menu "
    "hgroup search".split())
HIDDEN = frozenset("script style head title template noscript svg math iframe object select textarea button option "
                   "canvas audio video datalist".split())
RAW = frozenset("script style textarea title iframe noscript template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What a start tag ends if it is open, up to the nearest element that holds it.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table article section main div body html nav aside header footer form td th blockquote".split())
# Elements and words of class names that tell content or the rest: fixed values.
BAD_TAGS = frozenset("nav footer aside form menu header dialog search".split())
GOOD_TAGS = frozenset("article main".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs footer header "
    "masthead sidebar side aside widget comment comments reply replies disqus notice notices cookie cookies consent alert popup "
    "modal newsletter subscribe signup login search share sharing social related recommended pagination pager tags copyright "
    "legal toolbar".split())
GOOD_WORDS = frozenset("article content main post entry story body text".split())

_NAME_END = re.compile(r"[\s/>]")
_TAG_END = re.compile("[>\"']")
_FAR = re.compile(r"&#0*+[0-9]{8,};?")  # beyond all characters
_ZEROS = re.compile(r"&#0++(?=[1-9])")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile("[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    tag: str
    parent: int
    names: frozenset[str]
    runs: list[tuple[int, str]] = field(default_factory=list)  # (place in the page, own text)
    own: int = 0      # characters of its own text
    linked: int = 0   # of those, characters in links
    links: int = 0
    below: int = 0    # characters of text in it and in what it holds
    below_linked: int = 0


def name_words(attributes: str) -> frozenset[str]:
    found = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
    return frozenset(w.lower() for w in _WORDS.findall(found))


class Tags:
    """Tags and comments of a page from left to right, in time linear in its length.

    A tag ends at the first ``>`` outside quotes. Where there is none, ``<`` is text. Places from which
    no such ``>`` is found are kept, so that no stretch of the page is searched in vain again and again.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.name_end = -1  # first end of a name at or after the last name's beginning
        self.open: bytearray | None = None  # 1 where a tag that goes on there, outside quotes, has no end

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(begin, end, slash, name, attributes) of the first at or after a place; comments have no name."""
        html = self.html
        while (at := html.find("<", at)) >= 0:
            mark = html[at + 1:at + 2]
            if mark == "!" and html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(html), "", "", ""
            if at < self.last:
                if mark == "!" or mark == "?":
                    return at, html.find(">", at) + 1, "", "", ""
                begin = at + 2 if mark == "/" else at + 1
                first = html[begin]
                if first.isascii() and first.isalpha():
                    if self.name_end < begin:
                        self.name_end = _NAME_END.search(html, begin).start()
                    end = self._end(self.name_end)
                    if end >= 0:
                        return at, end + 1, html[at + 1:begin], html[begin:self.name_end].lower(), html[self.name_end:end]
            at += 1
        return None

    def _end(self, at: int) -> int:
        html, passed = self.html, []
        while at <= self.last and not (self.open and self.open[at]):
            found = _TAG_END.search(html, at).start()
            if html[found] == ">":
                return found
            passed.append((at, found + 1))
            at = html.find(html[found], found + 1) + 1
            if not at:
                break
        if passed and self.open is None:
            self.open = bytearray(len(html))
        for begin, end in passed:
            self.open[begin:end] = b"\x01" * (end - begin)
        return -1


def characters(text: str) -> str:
    """The text with character references decoded, however many digits they have."""
    if "&" not in text:
        return text
    try:
        return unescape(text)
    except ValueError:  # more digits than Python makes a number of
        return unescape(_ZEROS.sub("&#", _FAR.sub("\ufffd", text)))


def parse(html: str | None) -> list[Block]:
    """Blocks of a page, parents before children; inline elements belong to the block around them.

    Open elements are closed where HTML closes them: paragraphs by any block, list items and cells by
    their like, everything by the end of what holds it. Stray end tags are passed over. The work is
    linear in the page's length, whatever its tags.
    """
    html = html or ""
    blocks = [Block("html", -1, frozenset())]
    # Open blocks: element, number, and place in the stack of the nearest scope (cells apart).
    stack: list[tuple[str, int, int]] = [("html", 0, 0)]
    places: dict[str, list[int]] = defaultdict(list)  # of an element's open blocks in the stack
    endless: set[str] = set()  # elements without an end tag further on
    tags = Tags(html)
    links = 0
    at, place = 0, 0

    def put(text: str) -> None:
        nonlocal place
        if not text:
            return
        block = blocks[stack[-1][1]]
        text = characters(text)
        block.runs.append((place, text))
        place += 1
        n = len("".join(text.split()))
        block.own += n
        block.linked += n if links else 0

    def close(upto: int) -> None:
        nonlocal place
        for tag, _, _ in stack[upto:]:
            places[tag].pop()
        del stack[upto:]
        place += 1

    while found := tags.after(at):
        begin, end, slash, tag, attributes = found
        put(html[at:begin])
        at = end
        if not tag:
            continue
        if slash:
            if tag == "a":
                links = 0
            elif places.get(tag):
                close(places[tag][-1])
            continue
        if tag in RAW or tag in HIDDEN and tag != "head":  # what it holds is passed over
            over = None if tag in endless else re.compile(f"</{tag}\\s*+>", re.I).search(html, at)
            if over:
                at = over.end()
            elif tag in RAW:
                at = len(html)
            else:
                endless.add(tag)
            continue
        if tag == "a":
            links = 1
            blocks[stack[-1][1]].links += 1
        elif tag == "br":
            put(" ")
        if tag not in BLOCKS or tag in ("html", "body"):
            continue
        if stack[-1][0] == "p":  # any block ends an open paragraph, so it can only be the last
            close(len(stack) - 1)
        scope = stack[-1][2]
        ended = [places[like][i] for like in ENDS.get(tag, ()) if (i := bisect_right(places[like], scope)) < len(places[like])]
        if ended:
            close(min(ended))
        if tag[0] == "h" and tag[1:].isdigit() and stack[-1][0][0] == "h" and stack[-1][0][1:].isdigit():
            close(len(stack) - 1)
        blocks.append(Block(tag, stack[-1][1], name_words(attributes)))
        place += 1
        if tag not in VOID:
            places[tag].append(len(stack))
            stack.append((tag, len(blocks) - 1, len(stack) if tag in SCOPES and tag not in ("td", "th") else stack[-1][2]))
        if tag in GOOD_TAGS or tag in BAD_TAGS:
            links = 0
    put(html[at:])
    for block in reversed(blocks):
        block.below += block.own
        block.below_linked += block.linked
        if block.parent >= 0:
            blocks[block.parent].below += block.below
            blocks[block.parent].below_linked += block.below_linked
    return blocks


def side(block: Block) -> int:
    """1 where the element or its names say content, -1 where they say something else, else 0."""
    if block.tag in BAD_TAGS or block.names & BAD_WORDS:
        return -1
    return int(block.tag in GOOD_TAGS or bool(block.names & GOOD_WORDS))


def edge(blocks: list[Block], i: int) -> int:
    """Kind of the tie between block ``i`` and its parent: the block's own side, -2 for a block without
    one in a parent that says it is something else."""
    own = side(blocks[i])
    return own if own or side(blocks[blocks[i].parent]) >= 0 else -2


def observations(blocks: list[Block]) -> list[tuple[str, ...]]:
    """What the potentials see of each block."""
    out = []
    total = max(blocks[0].below, 1)
    for block in blocks:
        dense = block.below_linked / max(block.below, 1)
        linked = 0 if not block.below_linked else 1 if dense < 0.3 else 2
        out.append((
            f"tag {block.tag} {linked}", f"side {side(block)}", f"size {min(block.below.bit_length(), 10)}", f"links {linked}",
            f"share {min(int(4 * block.below / total), 3)}"))
    return out


def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article: inside it 1, elsewhere 0, menus and so on inside it 0.

    None for pages without such a mark.
    """
    if not any(b.tag in GOOD_TAGS for b in blocks):
        return None
    labels = []
    for block in blocks:
        above = labels[block.parent] if block.parent >= 0 else 0
        labels.append(0 if side(block) < 0 and block.tag != "header" else 1 if block.tag in GOOD_TAGS else above)
    return labels


@dataclass
class Potentials:
    """Log odds of content by observation, and log potentials of (parent, child) labels by kind of edge."""
    unary: dict[str, float]
    pair: dict[tuple[int, int, int], float]
    prior: float = 0.0

    @classmethod
    def learn(cls, counts: dict[str, float]) -> Potentials:
        """From counts named ``observation|label`` and ``pair edge parent child``; smoothed.

        Elements and names that tell their side count as seen ten times each, so that sides which
        the labelled pages lack are known too.
        """
        counts = Counter(counts)
        for linked in (0, 1, 2):
            for word in BAD_TAGS:
                counts[f"tag {word} {linked}|0"] += 10
            for word in GOOD_TAGS:
                counts[f"tag {word} {linked}|1"] += 10
        counts["side -1|0"] += 100
        counts["side 1|1"] += 100
        total = [sum(n for k, n in counts.items() if k.startswith("tag ") and k.endswith(f"|{y}")) for y in (0, 1)]
        names = {k[:-2] for k in counts if k[-2] == "|"}
        total = [max(n, 1.0) for n in total]
        unary = {k: math.log((counts[f"{k}|1"] + 0.5) / (total[1] + 1)) - math.log((counts[f"{k}|0"] + 0.5) / (total[0] + 1)) for k in names}
        pair = {}
        for s in (-2, -1, 0, 1):
            for parent in (0, 1):
                likely = 1 if s > 0 else 0 if s else parent  # what the edge says, counted as seen before
                n = [counts[f"pair {s} {parent} {child}"] + (500 if child == likely else 1) for child in (0, 1)]
                for child in (0, 1):
                    pair[s, parent, child] = math.log(n[child] / sum(n))
        return cls(unary, pair)

    def marginals(self, blocks: list[Block]) -> list[float]:
        """Probability of content of each block, by messages up the tree and down again."""
        n = len(blocks)
        seen, edges = observations(blocks), [edge(blocks, i) if i else 0 for i in range(n)]
        # log potentials of the two labels; observations are counted at half weight, for they overlap
        own = [[0.0, 0.5 * sum(self.unary.get(o, 0.0) for o in row)] for row in seen]
        up, gathered = [[0.0, 0.0] for _ in range(n)], [list(x) for x in own]
        for i in range(n - 1, 0, -1):
            g, s = gathered[i], edges[i]
            up[i] = [_add(g[0] + self.pair[s, y, 0], g[1] + self.pair[s, y, 1]) for y in (0, 1)]
            parent = gathered[blocks[i].parent]
            parent[0] += up[i][0]
            parent[1] += up[i][1]
        down = [[0.0, 0.0] for _ in range(n)]
        out = []
        for i in range(n):
            if i:
                parent, s = blocks[i].parent, edges[i]
                rest = [gathered[parent][y] + down[parent][y] - up[i][y] for y in (0, 1)]
                top = max(rest)
                down[i] = [_add(rest[0] - top + self.pair[s, 0, y], rest[1] - top + self.pair[s, 1, y]) for y in (0, 1)]
            odds = gathered[i][1] + down[i][1] - gathered[i][0] - down[i][0]
            out.append(1 / (1 + math.exp(-max(min(odds, 500), -500))))
        return out


def _add(a: float, b: float) -> float:
    """Logarithm of the sum of two exponentials."""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def page_counts(html: str | None) -> Counter:
    """Counts of one page for ``Potentials.learn``; none where it does not label itself."""
    blocks = parse(html)
    labels = own_labels(blocks)
    counts: Counter = Counter()
    if labels:
        for i, (block, y, seen) in enumerate(zip(blocks, labels, observations(blocks))):
            counts.update(f"{o}|{y}" for o in seen)
            if i:
                counts[f"pair {edge(blocks, i)} {labels[block.parent]} {y}"] += 1
    return counts


def render(blocks: list[Block], keep: list[float]) -> str:
    """Text of the blocks with a marginal of a half or more, in page order, a line a block.

    Text of a block before and after a block inside it makes two lines.
    """
    runs = sorted((place, i, text) for i, block in enumerate(blocks) if keep[i] >= 0.5 for place, text in block.runs)
    lines: list[str] = []
    piece: list[str] = []
    last = None
    for place, i, text in runs:
        if last is not None and (i != last[1] or place != last[0] + 1):
            lines.append(" ".join("".join(piece).split()))
            piece = []
        piece.append(text)
        last = place, i
    lines.append(" ".join("".join(piece).split()))
    return "\n".join(x for x in lines if x)


def extract(html: str | None, potentials: Potentials) -> str:
    blocks = parse(html)
    return render(blocks, potentials.marginals(blocks))


def train(pages: DataFrame, key: str = "page_id", html: str = "html") -> Potentials:
    """Potentials from about ``TRAIN_PAGES`` pages, chosen by a hash of the key.

    Pages are counted where they lie; Spark sums the counts by name. Where no page labels itself, the
    elements and names that tell their side decide alone.
    """
    total = pages.count()
    hashed = F.pmod(F.xxhash64(column_of(pages, key).cast("string"), F.lit("train")), F.lit(1 << 30))
    sample = pages.where(hashed < int(min(1.0, TRAIN_PAGES / max(total, 1)) * (1 << 30)))
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(page_counts(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["name", "n"])

    rows = sample.select(column_of(pages, html)).mapInArrow(run, "name string, n bigint")
    return Potentials.learn({r["name"]: r["n"] for r in rows.groupBy("name").agg(F.sum("n").alias("n")).collect()})


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row.

    A null or empty page, and one without content, has an empty text. Repeated rows are extracted one
    by one; other columns are not looked at; an empty table gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, key, html))  # a few hundred numbers
    rows = pages.select(column_of(pages, key).alias("page_id"), column_of(pages, url).alias("url"), column_of(pages, html).alias("html"))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [extract(h, shared.value) for h in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]

    kind = T.StructType(rows.schema.fields[:2]).simpleString()[7:-1].replace(":", " ")
    return map_rows(rows, run, f"{kind}, text string, n_chars bigint")
