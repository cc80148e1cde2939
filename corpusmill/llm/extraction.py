"""Main text of web pages by wrapper induction: DOM trees of one host are aligned."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.lookup import attach, counted_table
from ..session import materialize
from .tables import bounded_batches

# Pages of a host that the others are aligned with, and how many of them must agree.
SAMPLES = 4
# Elements nested deeper than this are flattened; their texts stay.
DEPTH = 200
KNOWN = 100_000

# Fixed values of HTML: elements without an end tag, those whose text is no text of the page,
# those that begin a block, and what an open element is closed by.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(
    "head script style noscript template iframe object svg math canvas audio video select option datalist "
    "textarea button input form title".split()
)
APART = frozenset("nav header footer aside menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"},
}
ENDS_P = frozenset(BLOCKS - {"br", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "summary"})
SCOPES = frozenset("table ul ol dl article section main div body nav aside header footer".split())
# Words in classes, ids and roles that name something beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising banner billboard breadcrumb breadcrumbs comment comments "
    "commentlist complementary contentinfo consent cookie cookies copyright disclaimer disqus footer form gdpr header "
    "legal login masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promoted promotion related recommended reply replies search share sharing sidebar sidenav signup skip "
    "social sponsor sponsored subscribe tags teaser toolbar topbar widget widgets alert respond discussion".split()
)
# What even an element that is marked as main or article is beside the article with.
NEVER = frozenset(
    "ad ads advert adverts advertisement comment comments promo promoted recommended related reply replies "
    "sponsored teaser widget".split()
)
MAIN_ROLES = frozenset({"main", "article"})
PAGE = frozenset({"#page", "html", "body"})
_WORD = re.compile(r"[A-Za-z]+")


class Node:
    """An element, or a text if `tag` is empty."""

    __slots__ = ("tag", "names", "text", "children", "hidden", "_said", "_runs", "_form", "_size")

    def __init__(self, tag: str, names: frozenset[str] = frozenset(), text: str = "", hidden: bool = False) -> None:
        self.tag, self.names, self.text, self.hidden = tag, names, text, hidden
        self.children: list[Node] = []
        self._said = self._runs = self._form = self._size = None

    @property
    def shape(self) -> tuple[str, frozenset[str]]:
        return self.tag, self.names

    @property
    def said(self) -> str:
        """All text inside, white space as single spaces."""
        if self._said is None:
            inner = [c.said for c in self.children] if self.tag else self.text.split()
            self._said = " ".join(filter(None, inner))
        return self._said

    @property
    def size(self) -> int:
        """Forms in the subtree, each run counted once."""
        if self._size is None:
            self._size = 1 + sum([run[0].size for run in self.runs])
        return self._size

    @property
    def runs(self) -> list[list[Node]]:
        """The children, those in a row with equal forms (list items, paragraphs) together."""
        if self._runs is None:
            self._runs = []
            for child in self.children:
                if self._runs and self._runs[-1][0].form == child.form:
                    self._runs[-1].append(child)
                else:
                    self._runs.append([child])
        return self._runs

    @property
    def form(self) -> int:
        """Stands for the structure of the subtree, whatever its texts and however long its runs."""
        if self._form is None:
            inner = tuple([run[0].form for run in self.runs]) if self.children else ()
            self._form = hash((self.tag, self.names, inner))
        return self._form


class _Builder(HTMLParser):
    """Builds the tree of a page as browsers do in the cases that matter for its text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#page")
        self.open = [self.root]
        self.deeper: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P and any(n.tag == "p" for n in self.open):
            self._close("p", SCOPES - {"div"})
        if tag in CLOSES:
            while self.open[-1].tag in CLOSES[tag]:
                self.open.pop()
        node = Node(tag)
        if attrs:
            own = dict(attrs)
            said = " ".join([own.get(k) or "" for k in ("class", "id", "role", "aria-label")])
            node.names = frozenset([w.lower() for w in _WORD.findall(said)])
            style = (own.get("style") or "").replace(" ", "").lower()
            node.hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in style
        self.open[-1].children.append(node)
        if tag in VOID:
            return
        if len(self.open) < DEPTH:
            self.open.append(node)
        else:
            self.deeper.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.deeper:
            while self.deeper.pop() != tag:
                pass
        elif tag not in VOID:
            self._close(tag, frozenset())

    def _close(self, tag: str, scopes: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in scopes:
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(Node("", text=data))


def parse(page: str) -> Node:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def tree_matching(one: Node, two: Node, pairs: list[tuple[Node, Node]] | None = None) -> int:
    """Forms in a largest order-preserving matching of two trees (simple tree matching).

    Matched nodes have matched parents and equal tags and names; texts match texts whatever they
    say. Children in a row with one form count once, as a run, whose members match in order. With
    `pairs`, the matched nodes are added to it.
    """
    if one.shape != two.shape:
        return 0
    if pairs is not None:
        _walk(one, two, pairs)
    return _gain(one, two)


# Matchings of forms met before, by both forms.
_GAINS: dict[tuple[int, int], int] = {}


def _gain(one: Node, two: Node) -> int:
    if one.shape != two.shape:
        return 0
    if one.form == two.form:
        return one.size
    key = one.form, two.form
    found = _GAINS.get(key)
    if found is None:
        found = 1 + _table(one.runs, two.runs)[-1][-1]
        if len(_GAINS) >= KNOWN:
            _GAINS.clear()
        _GAINS[key] = found
    return found


def _table(a: list[list[Node]], b: list[list[Node]]) -> list[list[int]]:
    """Largest matchings of all beginnings of two sequences of runs."""
    best = [[0] * (len(b) + 1)]
    for x in a:
        above, row = best[-1], [0]
        for j, y in enumerate(b):
            row.append(max(above[j + 1], row[-1], above[j] + _gain(x[0], y[0])))
        best.append(row)
    return best


def _walk(one: Node, two: Node, pairs: list[tuple[Node, Node]]) -> None:
    pairs.append((one, two))
    a, b = one.runs, two.runs
    if one.form == two.form:
        matched = list(zip(a, b))
    else:
        best, matched = _table(a, b), []
        i, j = len(a), len(b)
        while i and j:
            gain = _gain(a[i - 1][0], b[j - 1][0])
            if gain and best[i][j] == best[i - 1][j - 1] + gain:
                matched.append((a[i - 1], b[j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    for x, y in matched:
        for own, other in zip(x, y):
            if own.tag:
                _walk(own, other, pairs)


def constant_nodes(page: Node, samples: list[Node]) -> set[int]:
    """Ids of elements that stand with the same words in most of the pages they are aligned with.

    A page that says nearly all the same is a copy, from which nothing can be told, nor can it about
    a marked article from one that says nearly all the same there. In an article two pages must agree.
    """
    votes: dict[int, int] = {}
    used = 0
    roots = marked_roots(page)
    article = {id(n) for root in roots for n in _elements(root)}
    for sample in samples:
        pairs: list[tuple[Node, Node]] = []
        tree_matching(page, sample, pairs)
        same = [own for own, other in pairs if own.tag not in PAGE and own.said and own.said == other.said]
        inner = {id(c) for own in same for c in own.children}
        if sum(len(own.said) for own in same if id(own) not in inner) > 0.9 * len(page.said):
            continue
        used += 1
        shared = [own for own in same if id(own) in article]
        inner = {id(c) for own in shared for c in own.children}
        told = not shared or sum(len(own.said) for own in shared if id(own) not in inner) <= 0.9 * sum(len(root.said) for root in roots)
        for own in same:
            if told or id(own) not in article:
                votes[id(own)] = votes.get(id(own), 0) + 1
    return {node for node, n in votes.items() if 2 * n > used and (n > 1 or node not in article)}


def _beside(node: Node) -> bool:
    """Whether an element is named as something beside the article."""
    if node.hidden or node.tag in SILENT or node.tag in APART:
        return True
    if node.tag in ("body", "html"):
        return False
    return bool(node.names & (NEVER if node.tag in MAIN_ROLES or node.names & MAIN_ROLES else BESIDE))


def marked_roots(node: Node) -> list[Node]:
    """The outermost elements that are marked as main or article, in page order."""
    out: list[Node] = []
    for child in node.children:
        if child.tag and not _beside(child):
            out += [child] if child.tag in MAIN_ROLES or child.names & MAIN_ROLES else marked_roots(child)
    return out


def _elements(node: Node) -> Iterator[Node]:
    """The elements inside a node."""
    for child in node.children:
        if child.tag:
            yield child
            yield from _elements(child)


def main_text(page: Node, template: set[int]) -> str:
    """The text of the article's blocks, joined by spaces.

    The article is what the page marks as such (all of a main element, also around the articles
    in it), else the page; either way without template and what is named as beside it.
    """
    roots = marked_roots(page)
    if roots and (said := _blocks(roots, True, template)):
        return said
    return _blocks([page], False, template)


def _blocks(roots: list[Node], marked: bool, template: set[int]) -> str:
    blocks: list[list[str]] = []

    def walk(node: Node) -> None:
        for child in node.children:
            if not child.tag:
                blocks[-1].append(child.text)
                continue
            # the header of a marked article holds its heading, unless it is named as something else
            heading = marked and child.tag == "header" and not child.names & BESIDE and not child.hidden
            if child.tag in BLOCKS:
                blocks.append([])
            if id(child) not in template and (heading or not _beside(child)):
                walk(child)
                if child.tag in BLOCKS:
                    blocks.append([])

    for root in roots:
        blocks.append([])
        walk(root)
    return " ".join(filter(None, (" ".join("".join(block).split()) for block in blocks)))


def said_key(node: Node) -> int:
    """A hash of an element's tag and words, the same in every process."""
    return int.from_bytes(blake2b(f"{node.tag} {node.said}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def article_keys(page: Node) -> set[int]:
    """Keys of the elements in the marked article that say something."""
    return {said_key(n) for root in marked_roots(page) for n in _elements(root) if n.said}


def extract(page: str | None, samples: list[Node], usual: Collection[int] | None = None) -> str:
    """The main text of a page, given the trees of other pages of its host (any number, also none).

    `usual` has the keys of what the marked articles of most pages of the host say; nothing else
    in an article is template then. None: the samples alone decide.
    """
    if not page:
        return ""
    tree = parse(page)
    template = constant_nodes(tree, samples)
    if template and usual is not None:
        inside = [n for root in marked_roots(tree) for n in _elements(root) if id(n) in template]
        template -= {id(n) for n in inside if said_key(n) not in usual}
    return main_text(tree, template)


def host(url: Column) -> Column:
    """Host of a URL in lower case; '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def main_texts(pages: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, from the whole html.

    Each host gives its `samples` pages of smallest hash, chosen by partial aggregates, so a hot
    host is not gathered anywhere. Every page is aligned with those by simple tree matching:
    elements that say the same in most of them are template, slots that vary are content. In a
    marked article the marked articles of most of all pages of the host must say it, too. Of what
    is left the article is kept, without what its tags or names mark as something beside it.
    Null and empty pages have no text; pages without a host are aligned with none. One row per
    row of `pages`.
    """
    bounded_batches(pages.sparkSession)
    own = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host(F.col("url")).alias("host"))
    # the limit works in every task before the shuffle, so a hot host sends a few pages a task
    order = Window.partitionBy("host").orderBy("place", "html")
    first = own.where("host <> '' and html is not null").select(
        "host", F.xxhash64("page_id", "url").alias("place"), "html"
    ).withColumn("n", F.row_number().over(order)).where(F.col("n") <= samples)
    chosen = materialize(first.groupBy("host").agg(F.collect_list("html").alias("samples")))

    usual, fits = counted_table(_usual(own, chosen))
    chosen = attach(chosen, usual, ["host"], fits, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trees, keys = None, [], frozenset()
        for batch in batches:
            texts = []
            for name, page, others, most in zip(*(batch.column(c) for c in ("host", "html", "samples", "usual"))):
                if name.as_py() != at:  # a host's pages follow each other: its samples are parsed once
                    at, trees, keys = name.as_py(), [(s, parse(s)) for s in others.as_py() or []], frozenset(most.as_py() or [])
                page = page.as_py()
                texts.append(extract(page, [tree for s, tree in trees if s != page], keys))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"],
            )

    schema = StructType([*own.select("page_id", "url").schema.fields, StructField("text", StringType()),
                         StructField("n_chars", LongType())])
    return own.join(chosen, "host", "left").select("page_id", "url", "html", "host", "samples", "usual").mapInArrow(run, schema)


def _usual(own: DataFrame, chosen: DataFrame) -> DataFrame:
    """(host, usual): keys of what the marked articles of most of all pages of a host say.

    Only what two of the chosen pages say can be template, so only pages of hosts with such keys are read.
    """

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found = [], []
            for name, samples in zip(batch.column("host"), batch.column("samples")):
                pages = Counter(key for s in set(samples.as_py()) for key in article_keys(parse(s)))
                if keys := [key for key, n in pages.items() if n > 1]:
                    hosts.append(name.as_py())
                    found.append(keys)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.list_(pa.int64()))], ["host", "keys"])

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found = [], []
            for name, page, keys in zip(*(batch.column(c) for c in ("host", "html", "keys"))):
                tree = parse(page.as_py())
                if marked_roots(tree):
                    hosts.append(name.as_py())
                    found.append(list(article_keys(tree).intersection(keys.as_py())))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.list_(pa.int64()))], ["host", "keys"])

    keyed = "host string, keys array<bigint>"
    keys, fits = counted_table(chosen.mapInArrow(repeated, keyed))
    pages = attach(own.where("host <> '' and html is not null").select("host", "html"), keys, ["host"], fits).mapInArrow(said, keyed)
    # a row without a key counts the page
    counts = materialize(
        pages.select("host", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), "keys")).alias("key"))
        .groupBy("host", "key").agg(F.count("*").alias("n"))
    )
    every = counts.where("key is null").select("host", F.col("n").alias("pages"))
    most = counts.where("key is not null").join(every, "host").where(F.col("n") * 2 > F.col("pages"))
    return most.groupBy("host").agg(F.collect_list("key").alias("usual"))
