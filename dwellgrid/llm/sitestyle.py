"""Main text of web pages by a site style tree.

**Tree.** Each page is parsed into elements and text blocks. Pages of one host are merged: elements with
the same path of tags and class names are one node (below ``DEPTH`` levels an element counts as its
ancestor there). A node's presentation importance is the entropy of its child layouts over the
pages, to the base of the number of pages; its content importance is one minus the mean entropy of
the text blocks below it, where a block that n of m pages share has entropy ``log n / log m``. Its
composite importance is the mean of the two.

**Removal**, on hosts with at least ``LEAST_PAGES`` pages of a node:

1. a branch that looks the same *and* says the same everywhere: both importances below ``THRESHOLD``;
2. a branch beside a more important one: its composite importance is below ``RELATIVE`` times that of a sibling that
   stands on at least half as many pages with at least twice the text. Menus, adverts and footers whose
   words change from page to page go by this rule, since their layout does not change while the
   layout of articles does. Inside ``article`` and ``main`` it isn't used: parts of one text are no rivals.

On all hosts a branch goes whose tag, role or class names say what it is (menu, advert, comments, ...), which
is all there is on hosts with few pages and for comments, which vary as much as articles; such a
branch is no sibling for rule 2. Paragraphs, headings and other leaves are never judged one by
one, so sentences that articles share stay. Where a page has articles (else ``main``), text outside
them goes too.

**Scale.** A page sends each of its node features once, under a 64-bit hash of its host; counts are combined map-side,
so a host with a third of all pages is a few partial rows per task. Only unimportant nodes come
back. Up to ``BROADCAST_NODES`` of them, counted first, are broadcast; beyond that they meet the pages' nodes by an
equi-join on (host, node), grouped per page address. The text is extracted in a second pass.

Null html is an empty page and gives an empty text; null or malformed addresses form the host ''.
Repeated rows give repeated rows and empty tables empty tables. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.llm.urlfilter import host_and_path
from dwellgrid.sources.storage import written

DEPTH = 16
LEAST_PAGES = 5
THRESHOLD = 0.3
RELATIVE = 0.75
BROADCAST_NODES = 200_000

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption".split())
GONE = frozenset(
    "head script style textarea title noscript iframe template xmp svg math canvas object audio video "
    "nav footer aside form button select input menu dialog fieldset search header".split()
)
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies disqus footer gdpr header masthead menu menus nav navbar "
    "navigation newsletter notice notices pagination pager popup promo promoted promotion related "
    "reply replies respond share sharing sidebar sidebars signup social sponsor sponsored subscribe "
    "toolbar widget widgets modal overlay toc discussion".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
CLOSES_P = BLOCK - frozenset("body html head option optgroup caption td th tr tbody thead tfoot".split())
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
NAME = re.compile(r"[A-Za-z][a-z]*|[0-9]+")


@dataclass
class Node:
    tag: str
    parent: int
    path: int
    depth: int
    noise: bool
    container: bool
    children: list[str] = field(default_factory=list)


def _hash(x: tuple) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(repr(x).encode("utf-8", "replace")) - 2**63


def _names(attributes: str) -> tuple[str, list[str], str]:
    """The presentation key (classes and id without digits), their words, and the role."""
    key, words, role = [], [], ""
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            role = value.strip().lower()
        else:
            key.append(re.sub(r"[0-9]+", "", value))
            words += [w.lower() for w in NAME.findall(value)]
    return " ".join(key), words, role


class Page:
    """Elements and text blocks of one page, in page order."""

    def __init__(self, source: str) -> None:
        self.nodes = [Node("#root", -1, 0, 0, False, True)]
        self.blocks: list[tuple[int, str]] = []
        self._stack = [0]
        self._open: Counter = Counter()
        self._buffer: list[str] = []
        self._parse(source)
        self._flush()

    def _flush(self) -> None:
        if self._buffer:
            text = " ".join(entities.unescape("".join(self._buffer)).split())
            if text:
                self.blocks.append((self._block(), text))
            self._buffer = []

    def _block(self) -> int:
        i = self._stack[-1]
        while not (self.nodes[i].container or self.nodes[i].tag in BLOCK):
            i = self.nodes[i].parent
        return i

    def _pop(self) -> None:
        i = self._stack.pop()
        self._open[self.nodes[i].tag] -= 1

    def _push(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
        if tag in CLOSES_P and self._open["p"]:
            self._close("p")
        if tag in SIBLINGS:
            ends, stops = SIBLINGS[tag]
            for i in range(len(self._stack) - 1, 0, -1):
                t = self.nodes[self._stack[i]].tag
                if t in stops:
                    break
                if t in ends:
                    while len(self._stack) > i:
                        self._pop()
                    if tag != "tr":
                        break
                elif t in BLOCK and t not in ("p", "tbody", "thead", "tfoot"):
                    break
        up = self.nodes[self._stack[-1]]
        key, words, role = _names(attributes) if attributes else ("", [], "")
        depth = up.depth + 1
        path = _hash((up.path, tag, key)) if depth <= DEPTH else up.path
        noise = tag in GONE or role in ROLES or not NOISE.isdisjoint(words)
        if tag in ("html", "body", "article", "main"):
            noise = False
        # A header inside an article holds its title.
        if tag == "header" and self._open["article"] and NOISE.isdisjoint(set(words) - {"header"}):
            noise = False
        container = tag in BLOCK and tag not in LEAF
        if depth <= DEPTH:
            up.children.append(tag + "." + key)
        self.nodes.append(Node(tag, self._stack[-1], path, depth, noise, container))
        if tag not in VOID:
            self._stack.append(len(self.nodes) - 1)
            self._open[tag] += 1

    def _close(self, tag: str) -> None:
        if not self._open[tag]:
            return
        if tag in BLOCK:
            self._flush()
        else:
            # An inline end tag doesn't close blocks.
            for i in reversed(self._stack):
                t = self.nodes[i].tag
                if t == tag:
                    break
                if t in BLOCK:
                    return
        while self.nodes[self._stack[-1]].tag != tag:
            self._pop()
        self._pop()

    def _parse(self, s: str) -> None:
        at, n = 0, len(s)
        no_quote = False
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._buffer.append(s[at:lt])
            if lt >= n:
                break
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            if s.startswith(("<!", "<?"), lt):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            m = None if no_quote else TAG.match(s, lt)
            if m is None:
                m = LOOSE.match(s, lt)
                # An attribute quote is never closed from here on: don't look for it again.
                no_quote = no_quote or m is not None
            if m is None:
                if s.startswith("</", lt) or s[lt + 1 : lt + 2].isalpha():
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                else:
                    self._buffer.append("<")
                    at = lt + 1
                continue
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                if tag == "br":
                    self._buffer.append(" ")
                else:
                    self._close(tag)
                continue
            if tag == "br":
                self._buffer.append(" ")
                continue
            self._push(tag, m[3])
            if tag in RAW:
                end = re.compile(f"</{tag}", re.IGNORECASE).search(s, at)
                at = n if end is None else s.find(">", end.end()) + 1 or n
                self._flush() if tag in BLOCK else None
                self._pop()

    def features(self) -> Iterator[tuple[int, int | None, bool, int, int, int]]:
        """(path, parent path, whether names say noise, kind, feature, characters) of every node of the page, each
        feature once: kind 0 is layout, 1 is text. The parent is null where siblings are not compared."""
        layout: dict[int, list[str]] = {}
        text: dict[int, set[int]] = {}
        size: Counter = Counter()
        about: dict[int, tuple[int | None, bool]] = {}
        apart = [False] * len(self.nodes)  # the core or a part of it
        for i, x in enumerate(self.nodes[1:], start=1):
            apart[i] = apart[x.parent] or x.tag in ("article", "main")
            if x.container:
                layout.setdefault(x.path, []).append("/".join(x.children))
                up = self.nodes[x.parent]
                lone = apart[x.parent] or x.tag in ("html", "head", "body") or x.path == up.path
                about.setdefault(x.path, (None if lone else up.path, x.noise))
        for i, block in self.blocks:
            h, n = _hash((block,)), len(block)
            while i > 0:
                if self.nodes[i].container:
                    text.setdefault(self.nodes[i].path, set()).add(h)
                    size[self.nodes[i].path] += n
                i = self.nodes[i].parent
        for path, parts in layout.items():
            yield path, *about[path], 0, _hash(tuple(parts)), size[path]
            for h in text.get(path, ()):
                yield path, *about[path], 1, h, 0

    def text(self, unimportant: frozenset[int]) -> str:
        """Blocks outside removed branches, and inside the articles or main part if there are any."""
        n = len(self.nodes)
        gone, inside = [False] * n, {"article": [False] * n, "main": [False] * n}
        for i in range(1, n):
            x = self.nodes[i]
            gone[i] = gone[x.parent] or x.noise
            for tag, flags in inside.items():
                flags[i] = flags[x.parent] or x.tag == tag
            core = x.tag in ("html", "body", "article", "main")
            if x.container and not core and x.path in unimportant:
                gone[i] = True
        kept = [(i, t) for i, t in self.blocks if not gone[i]]
        for tag in ("article", "main"):
            within = [t for i, t in kept if inside[tag][i]]
            if any(not gone[i] and x.tag == tag for i, x in enumerate(self.nodes)):
                return "\n".join(within)
        return "\n".join(t for _, t in kept)


FEATURES = "site long, path long, up long, noise boolean, kind int, feature long, chars long"


def style_tree(pages: DataFrame) -> DataFrame:
    """(site, path, pages, presentation, content, importance, best) of every node of every site.

    ``pages`` has site and html; ``best`` is the importance of the sibling that rule 2 compares with, if any.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                rows = [
                    (site, *f)
                    for site, h in zip(part["site"], part["html"])
                    if isinstance(h, str)
                    for f in Page(h).features()
                ]
                found = pd.DataFrame(rows, columns=["site", "path", "up", "noise", "kind", "feature", "chars"])
                yield found.astype({"up": "Int64"})

    # What a path has besides features is the same in all its layouts.
    counted = (
        pages.select("site", "html")
        .mapInPandas(emit, FEATURES)
        .groupBy("site", "path", "kind", "feature")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("chars").alias("chars"),
            F.max("up").alias("up"),
            F.max("noise").alias("noise"),
        )
    )
    # Layouts of a node are one per page, so their counts sum to its pages.
    nodes = counted.groupBy("site", "path").agg(
        F.max("up").alias("up"),
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("layout"),
        F.avg(F.when(F.col("kind") == 1, F.log("n"))).alias("shared"),
        F.sum("chars").alias("chars"),
        F.max("noise").alias("noise"),
    )
    base = F.log(F.greatest(F.col("pages"), F.lit(2)))
    scored = nodes.select(
        "site",
        "path",
        "up",
        "pages",
        "chars",
        "noise",
        ((F.log("pages") - F.col("layout") / F.col("pages")) / base).alias("presentation"),
        (1 - F.coalesce(F.col("shared"), base) / base).alias("content"),
    ).withColumn("importance", (F.col("presentation") + F.col("content")) / 2)
    rivals = scored.filter("up IS NOT NULL AND NOT noise").select(
        "site",
        "up",
        F.col("pages").alias("r_pages"),
        F.col("chars").alias("r_chars"),
        F.col("importance").alias("r_importance"),
    )
    # The most important sibling with text enough; one row per parent, so no pairs of siblings are made.
    top = rivals.groupBy("site", "up").agg(
        F.max_by(F.struct("r_pages", "r_chars", "r_importance"), F.struct("r_chars", "r_importance")).alias("r")
    )
    stands = (F.col("r.r_pages") * 2 >= F.col("pages")) & (F.col("r.r_chars") >= 2 * F.col("chars"))
    return (
        scored.join(top, ["site", "up"], "left")
        .withColumn("best", F.when(stands, F.col("r.r_importance")))
        .select("site", "path", "pages", "presentation", "content", "importance", "best")
    )


def weak_nodes(tree: DataFrame) -> DataFrame:
    """(site, path) of the nodes that the tree removes."""
    same = F.greatest("presentation", "content") < THRESHOLD
    beside = F.coalesce(F.col("importance") < RELATIVE * F.col("best"), F.lit(False))
    return tree.filter((F.col("pages") >= LEAST_PAGES) & (same | beside)).select("site", "path")


PRESENT = "site long, address string, path long"


def _paths_by_address(named: DataFrame, weak: DataFrame) -> DataFrame:
    """(address, unimportant): the nodes to remove on the pages of each address."""

    def paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (site, address, p)
                for site, address, h in zip(batch["site"], batch["address"], batch["html"])
                if isinstance(h, str)
                for p in {x.path for x in Page(h).nodes if x.container and x.tag not in ("html", "body")}
            ]
            yield pd.DataFrame(rows, columns=["site", "address", "path"])

    return (
        named.join(weak.select("site").distinct(), "site", "left_semi")
        .select("site", "address", "html")
        .mapInPandas(paths, PRESENT)
        .join(weak, ["site", "path"])
        .groupBy("address")
        .agg(F.collect_set("path").alias("unimportant"))
    )


def _text(html: object, unimportant: frozenset[int]) -> str:
    return Page(html).text(unimportant) if isinstance(html, str) else ""


def extract(pages: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host, _ = host_and_path(F.col("url"))
    named = pages.select(
        "page_id",
        "url",
        "html",
        F.xxhash64(host).alias("site"),
        F.coalesce("url", F.lit("")).alias("address"),
    )
    weak = written(weak_nodes(style_tree(named)), "weak-nodes")
    if weak.count() <= broadcast_nodes:
        found: dict[int, set[int]] = {}
        for site, path in zip(*(c.to_pylist() for c in weak.select("site", "path").toArrow().columns)):
            found.setdefault(site, set()).add(path)
        known = pages.sparkSession.sparkContext.broadcast({k: frozenset(v) for k, v in found.items()})

        @F.pandas_udf("string")
        def text(html: pd.Series, site: pd.Series) -> pd.Series:
            of = known.value.get
            return pd.Series([_text(h, of(k, frozenset())) for h, k in zip(html, site)], dtype=object)

        rows = named.select("page_id", "url", text("html", "site").alias("text"))
    else:

        @F.pandas_udf("string")
        def text_of(html: pd.Series, unimportant: pd.Series) -> pd.Series:
            return pd.Series(
                [_text(h, frozenset(() if u is None else u.tolist())) for h, u in zip(html, unimportant)],
                dtype=object,
            )

        rows = named.join(_paths_by_address(named, weak), "address", "left").select(
            "page_id", "url", text_of("html", "unimportant").alias("text")
        )
    return rows.withColumn("n_chars", F.length("text").cast("long"))
