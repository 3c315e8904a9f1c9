"""Main text of web pages by site style trees.

The pages of a host are merged: elements on the same path of tags and classes are one node of the host's tree. A node's
presentation importance is the entropy of its child sequences over the pages, its content importance that of the texts
below it; both are divided by the largest possible entropy. The text that stands in an element itself is a leaf below it.
What looks and reads the same on page after page has low importance. A branch is noise, and removed from each page, if
its node and all nodes below it have low importance. Sections whose markup says what they are (menus, footers, adverts,
forms) have no importance; paragraphs and headings of an article keep theirs.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settle
from .common import by_value

GAMMA = 0.9
LOW = 0.3
SEEN = 8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset("head script style template noscript svg math iframe object canvas audio video select option button textarea title datalist".split())
NO_TEXT = frozenset("nav header footer aside form menu dialog".split()) | SILENT
MAIN = frozenset("article main".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
BLOCKS = PROSE | NO_TEXT | MAIN | frozenset(
    "html body div section ul ol dl table thead tbody tfoot tr caption figure address fieldset details summary hr center".split()
)
#: An opening tag of the key closes an open one of the set, unless an element of the other set stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebars?|menus?|nav\w*|breadcrumbs?|footer|header|masthead|cookies?|consent|gdpr|"
    r"notice|alert|popup|modal|newsletter|subscri\w+|share|sharing|social|related|recommend\w*|comments?|replies|respond|disqus|login|signup|"
    r"search|widget|pager|pagination|toolbar|copyright|skip)(?:$|[\s_-])", re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][^\s=/>"']*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
MARKS = re.compile("[>\"']")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``("text", text, "")``, ``("open", name, attributes)`` and ``("close", name, "")`` of a page, in time linear in it.

    A quote that is never closed does not hide the rest of the page: its tag ends at the next bracket.
    """
    at, size = 0, len(page)
    missing = set()

    def find(what: str, start: int) -> int:
        """Place of a mark, or -1; a mark once missing is not looked for again."""
        if what in missing:
            return -1
        found = page.find(what, start)
        if found < 0:
            missing.add(what)
        return found

    while at < size:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            end = find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        mark = page[start + 1:start + 2]
        closing = mark == "/"
        m = NAME.match(page, start + 1 + closing)
        if m is None:
            if mark in ("!", "?", "/"):
                end = find(">", start)
                at = size if end < 0 else end + 1
            else:
                yield "text", "<", ""
                at = start + 1
            continue
        end = m.end()
        while end < size and page[end] != ">":
            if page[end] in "\"'":
                shut = find(page[end], end + 1)
                end = end + 1 if shut < 0 else shut + 1
            else:
                step = MARKS.search(page, end)
                end = size if step is None else step.start()
        name = m[0].lower()
        yield ("close" if closing else "open"), name, page[m.end():end]
        at = end + 1
        if not closing and name in RAW:
            shut = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at) if f"</{name}" not in missing else None
            if shut is None:
                missing.add(f"</{name}")
            stop = size if shut is None else shut.start()
            if stop > at:
                yield "raw", page[at:stop], ""
            at = stop


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def number(*parts) -> int:
    """Signed 64-bit hash."""
    joined = "\x00".join(map(str, parts)).encode("utf-8", "replace")
    return int.from_bytes(blake2b(joined, digest_size=8).digest(), "little", signed=True)


class Element:
    __slots__ = ("name", "node", "out", "main", "at", "children", "block")

    def __init__(self, name: str, node: int, out: bool, main: bool, at: int):
        self.name, self.node, self.out, self.main, self.at = name, node, out, main, at
        self.children: list[str] = []
        self.block = name in BLOCKS


class Page:
    """A parsed page: its ``places`` (elements below the body, and the texts in them), ``blocks`` of text, child sequences.

    A place comes after the one it lies in, so what holds for branches is found in one run over them, at any depth.
    """

    def __init__(self, source: str | None):
        self.places: list[tuple[int, int]] = []  # node, place around it or -1
        self.blocks: list[tuple[str, bool, bool, int, float]] = []  # text, in an article, prose, place or -1, link share
        self.styles: list[tuple[int, int, int]] = []  # place, hash of child sequence, children
        root = Element("#page", 0, False, False, -1)
        stack, opened = [root], {}
        text: list[str] = []
        linked = plain = 0

        def flush() -> None:
            nonlocal linked, plain
            if text:
                joined = " ".join(html.unescape("".join(text)).split())
                if joined:
                    near = next(e for e in reversed(stack) if e.block or e is root)
                    at = -1
                    if near.at >= 0:
                        at = len(self.places)
                        self.places.append((number(near.node, "#text"), near.at))
                    self.blocks.append((joined, near.main, near.name in PROSE, at, linked / max(1, linked + plain)))
                text.clear()
            linked = plain = 0

        def pop() -> None:
            gone = stack.pop()
            opened[gone.name].pop()
            if gone.block and not gone.out and gone.at >= 0:
                self.styles.append((gone.at, number(*gone.children), len(gone.children)))

        for kind, value, rest in tokens(source or ""):
            top = stack[-1]
            if kind == "text":
                if not top.out:
                    text.append(value)
                    if opened.get("a"):
                        linked += len(value)
                    else:
                        plain += len(value)
            elif kind == "open":
                block = value in BLOCKS
                if block or value == "br":
                    if value == "br":
                        if not top.out:
                            text.append("\n")
                    else:
                        flush()
                if block and value not in ("html", "body") and opened.get("p"):
                    self._close_to(stack, opened, {"p"}, {"table", "button", "article", "main", "section", "div", "td"} - {value}, pop)
                if value in CLOSES:
                    self._close_to(stack, opened, *CLOSES[value], pop)
                top = stack[-1]
                if value in ("html", "body") and opened.get(value):
                    continue
                if value in VOID:
                    if top.block:
                        top.children.append(value)
                    continue
                found = attributes(rest) if rest else {}
                names = f"{found.get('class', '')} {found.get('id', '')}".strip()
                out = top.out or value in NO_TEXT
                if not out and names and value not in MAIN and value not in ("html", "body", "p") and not re.fullmatch("h[1-6]", value):
                    out = NAMED.search(names) is not None
                elif not out and names and value == "article":
                    out = re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|ads?|advert\w*|sponsor\w*|related)(?:$|[\s_-])", names, re.I) is not None
                if not out and found:
                    out = found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
                shown = f"{value}.{found.get('class', '')}"
                if value in ("html", "body"):
                    new = Element(value, number(value), out, False, -1)
                elif value in BLOCKS:
                    node, at = number(top.node, shown), top.at
                    if not out:
                        at = len(self.places)
                        self.places.append((node, top.at))
                    new = Element(value, node, out, top.main or value in MAIN or found.get("role", "").lower() == "main", at)
                else:
                    new = Element(value, top.node, out, top.main, top.at)
                if top.block:
                    top.children.append(shown)
                opened.setdefault(value, []).append(len(stack))
                stack.append(new)
            elif kind == "close":
                if value in BLOCKS:
                    flush()
                if opened.get(value):
                    while stack[-1].name != value:
                        pop()
                    pop()
        flush()
        while len(stack) > 1:
            pop()

    @staticmethod
    def _close_to(stack, opened, wanted, fence, pop) -> None:
        """Close the innermost open element of ``wanted``, however deep, unless one of ``fence`` lies at or above it on the stack."""
        at = max((opened[w][-1] for w in wanted if opened.get(w)), default=0)
        if at and all(not opened.get(f) or opened[f][-1] < at for f in fence):
            while len(stack) > at:
                pop()

    def main_text(self, noise: frozenset[int] | set[int] = frozenset()) -> str:
        """The kept blocks, one a line. ``noise`` are the nodes whose branches are noise on the page's host."""
        has_main = any(main for _, main, _, _, _ in self.blocks)
        gone: list[bool] = []
        if noise:
            for node, around in self.places:
                gone.append(node in noise or around >= 0 and gone[around])
        out = []
        for text, main, prose, at, links in self.blocks:
            if has_main and not main:
                continue
            if judged(main, prose) and (links > 0.5 and not main or noise and at >= 0 and gone[at]):
                continue
            out.append(text)
        return "\n".join(out)


def judged(main: bool, prose: bool) -> bool:
    """Whether importance decides on a block: all but an article's paragraphs, headings and list items."""
    return not (main and prose)


def host_of(url: Column) -> Column:
    """Host of an address, lower-cased, without user and port; an empty text for a null or odd address."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


NODES = T.ArrayType(T.StructType([
    T.StructField("node", T.LongType()), T.StructField("around", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("value", T.LongType()), T.StructField("n", T.LongType()), T.StructField("children", T.LongType()),
    T.StructField("texts", T.LongType()), T.StructField("judged", T.BooleanType()),
]))
WORD = (1 << 64) - 1


@by_value(NODES)
def nodes_of(source):
    """A row per node and child sequence (kind ``s``), and per node and whole of the texts below it (kind ``c``).

    ``n`` is how often the page has it, ``texts`` the number of texts in these places, ``judged`` whether importance
    decides on any of them. The hash of a place's texts is the sum of theirs, so the rows are linear in the page.
    """
    page = Page(source)
    has_main = any(main for _, main, _, _, _ in page.blocks)
    size = len(page.places)
    sums, texts, asked = [0] * size, [0] * size, [False] * size
    for text, main, prose, at, _ in page.blocks:
        if at >= 0 and (main or not has_main):
            sums[at], texts[at], asked[at] = number(text) & WORD, 1, judged(main, prose)
    for at in range(size - 1, -1, -1):
        around = page.places[at][1]
        if around >= 0:
            sums[around] = sums[around] + sums[at] & WORD
            texts[around] += texts[at]
            asked[around] = asked[around] or asked[at]
    found: dict[tuple[int, int, str, int], list] = {}

    def add(at: int, kind: str, value: int, children: int, held: int, decides: bool) -> None:
        node, around = page.places[at]
        row = found.setdefault((node, page.places[around][0] if around >= 0 else 0, kind, value), [0, 0, 0, False])
        row[0] += 1
        row[1] += children
        row[2] += held
        row[3] = row[3] or decides

    for at, value, n in page.styles:
        add(at, "s", value, n, 0, False)
    for at in range(size):
        if texts[at]:
            add(at, "c", sums[at] - (sums[at] >> 63 << 64), 0, texts[at], asked[at])
    return [(*key, *row) for key, row in found.items()]


@by_value(T.ArrayType(T.LongType()))
def above(rows):
    """Nodes of a page's tree that have a node of no low importance below them. ``rows`` has ``node, around, low``."""
    around = {r["node"]: r["around"] for r in rows}
    out = set()
    for r in rows:
        if not r["low"]:
            at = r["around"]
            while at and at not in out:
                out.add(at)
                at = around.get(at, 0)
    return list(out)


def importance(rows: DataFrame) -> DataFrame:
    """``(host, node, n_texts, importance)`` of a host's merged nodes.

    ``rows`` has ``host, node, kind, value, children``, and with ``n`` and ``texts`` stands for ``n`` such rows of so many
    texts. Equal values are counted first, per host and node, then the counts are summed to entropies: no host's pages
    meet in one task. With l children on average, importance is (1 - gamma^l) times the presentation's entropy plus
    gamma^l times the content's.
    """
    n = F.col("n") if "n" in rows.columns else F.lit(1)
    texts = F.col("texts") if "texts" in rows.columns else F.when(F.col("kind") == "c", 1)
    counted = rows.groupBy("host", "node", "kind", "value").agg(F.sum(n).alias("n"), F.sum("children").alias("children"), F.sum(texts).alias("texts"))
    total = counted.groupBy("host", "node").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"n_{k}") for k in "sc"],
        *[F.sum(F.when(F.col("kind") == k, F.col("n") * F.log("n"))).alias(f"l_{k}") for k in "sc"],
        F.sum("children").alias("children"), F.sum("texts").alias("texts"),
    )

    def entropy(k: str) -> Column:
        n = F.col(f"n_{k}")
        return F.when(n > 1, (F.log(n) - F.col(f"l_{k}") / n) / F.log(n))

    weight = F.pow(F.lit(GAMMA), F.coalesce(F.col("children") / F.col("n_s"), F.lit(0.0)))
    style, content = F.coalesce(entropy("s"), F.lit(1.0)), F.coalesce(entropy("c"), F.lit(1.0))
    value = F.when(F.col("n_s").isNull(), content).otherwise((1 - weight) * style + weight * content)
    return total.select("host", "node", F.coalesce("texts", F.lit(0)).alias("n_texts"), value.alias("importance"))


def main_texts(pages: DataFrame, low: float = LOW, seen: int = SEEN, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    A branch is removed where its node has an importance below ``low``, so have all nodes with text below it, and the host
    shows at least ``seen`` texts in it; a host with fewer pages keeps what its markup does not name. A null or empty page
    gives an empty text, a null address a host of its own. Rows repeated in the table each come back with the same text;
    equal pages of a host count as one. An empty table gives an empty result. Other columns are not read.
    """
    mark = F.xxhash64(F.coalesce(F.col(f"`{page}`"), F.lit("")), host_of(F.col(f"`{url}`")))
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("html"), mark.alias("mark"))
    parsed = rows.select(host_of(F.col("url")).alias("host"), "mark", F.explode(nodes_of("html")).alias("x")).select("host", "mark", "x.*")
    # Equal pages have the same mark and the same rows.
    seen_nodes = settle(parsed.distinct(), "page-nodes")
    weak = settle(importance(seen_nodes).where(F.col("importance") < low).select("host", "node", "n_texts", F.lit(True).alias("low")), "low-nodes")
    placed = seen_nodes.where("kind = 'c'").groupBy("host", "mark", "node", "around").agg(F.max("judged").alias("judged"))
    told = settle(placed.join(weak, ["host", "node"], "left").withColumn("low", F.coalesce("low", F.lit(False))), "page-low-nodes")
    # What stands in a list is part of one page, so no group outgrows a page.
    trees = told.groupBy("host", "mark").agg(F.collect_list(F.struct("node", "around", "low")).alias("tree"))
    mixed = settle(trees.select("host", F.explode(above("tree")).alias("node")).distinct(), "mixed-nodes")
    noise = told.where(F.col("judged") & F.col("low") & (F.col("n_texts") >= seen)).join(mixed, ["host", "node"], "left_anti")
    told = settle(noise.groupBy("mark").agg(F.sort_array(F.collect_list("node")).alias("low")), "page-noise-nodes")

    @by_value(T.StringType())
    def cleaned(source, low):
        return Page(source).main_text(frozenset(low or ()))

    out = rows.join(told, "mark", "left").withColumn("text", cleaned("html", "low"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
