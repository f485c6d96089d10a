"""Main text of web pages by consensus host paths.

1. Every page is parsed into blocks of text; each container (article, div, section, ...) is scored by the
   text of its blocks, without links and without menus, notices, forms and the like. The best container
   casts the page's vote for its path: the generalised tags and classes from the body down. A container whose
   class or id only mentions such a part (has-sidebar), or a form, counts as one unless it holds most of the text.
2. Votes are summed per host and path. Paths with at least SHARE of a host's votes win; there are at
   most 1 / SHARE of them, however large the host is.
3. Pages are read again: the most voted winning path that the page has gives its text. A page without
   any of them (another template) falls back on its own best container, then on its whole body.

Winners are read from a written table, so Spark knows their size: it broadcasts them below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by host, splitting hot hosts.

Edge cases: a NULL or empty html gives the empty text; a page without a host votes with the other such
pages; broken markup (unclosed or stray tags, cut pages) is read to the end; repeated rows give
repeated results; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from saleslake.llm.common import written
from saleslake.llm.superkmers import Rows, columns

#: Share of a host's votes that a winning path has at least.
SHARE = 0.1
#: Parts of an article have at least PART of the text of the largest, and all parts NEARLY_ALL of that around them.
PART, NEARLY_ALL = 0.3, 0.8
#: Containers so far above a text that less than this part of it counts are not scored by it.
LEAST_PART = 1e-12

#: Tags whose content is never read (fixed values).
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "object", "canvas")
#: Tags that are no part of an article.
OUTSIDE = frozenset("head title nav footer aside form menu dialog button select".split())
#: Words of a class or id that name something that is no part of an article.
OUTSIDE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright discussion disqus footer form gdpr legal login "
    "menu modal nav navbar navigation newsletter notice notices notification pagination pager popup "
    "promo promoted promotion recommended recommendations related replies reply respond responses search share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget "
    "widgets".split()
)
#: Those of readers' texts; such a container is never taken for a wrapper of the article.
READERS = frozenset("comment comments discussion disqus replies reply respond responses".split())
#: Words beside those of readers' texts that only say that a page has or had some (comments-open).
STATES = frozenset("open closed on off enabled disabled allowed with without has no".split())
#: Words that mark any tag, also a paragraph or a span, as an advert or notice.
NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "newsletter".split()
)
#: Words of a class or id of a page header; inside an article a header belongs to it.
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Tags that make a path; other tags only end blocks or stand inside them.
STRUCTURE = frozenset(
    "body div section article main header table tbody tr td th ul ol dl figure details fieldset "
    "blockquote center".split()
) | OUTSIDE
CONTAINERS = frozenset("body div section article main td center".split())
#: Tags inside a line of text; every other tag ends the block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
#: Tags without an end, and those that end where the next one of their kind begins.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = frozenset("p li dt dd option".split())
ARTICLE_WORDS = frozenset("article content entry main post story text".split())

#: Inside a tag; a quote begins a value only after an equals sign.
_REST = r"(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/>])" + _REST + r"(?<=/)>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>" + _REST + r")>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"(?<![\w-])(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CUT = re.compile(r"<[/!?A-Za-z][^>]*\Z")
_NUMBER = re.compile(r"\d+")


#: SOFT: may be a wrapper of the whole page (has-sidebar, form); HARD: named as a part outside and nothing else;
#: TAG: a tag of such a part, whose text is never the article (an aside is, where a page has nothing else).
SOFT, HARD, TAG = 1, 2, 3


class Container:
    """An open or closed element: its place in the page, where its blocks begin and end, its score.

    mark: what its tag, class or id says (nothing, SOFT, HARD or TAG); weight: the highest mark of it and those
    around it; outside: whether it or one around it is no part of an article. key: same for elements of one path.
    """

    __slots__ = (
        "tag", "label", "key", "parent", "first", "end", "score", "total", "outside", "bonus", "mark", "weight",
        "article", "inner",
    )

    def __init__(self, tag: str, label: str, key: int, parent: Container | None, first: int) -> None:
        self.tag, self.label, self.key, self.parent, self.first, self.end = tag, label, key, parent, first, -1
        self.score, self.total, self.outside, self.bonus, self.mark, self.weight = 0.0, 0.0, False, 1.0, 0, 0
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        self.inner = 0

    def path(self) -> str:
        """Generalised tags and classes from the body down."""
        labels, node = [], self
        while node.parent is not None:
            labels.append(node.label)
            node = node.parent
        return "".join("/" + label for label in reversed(labels))


def _said(rest: str) -> tuple[str, set[str], bool, bool, bool]:
    """What the class and id of a tag say: generalised label, words, and whether a token names nothing but parts
    outside, readers' texts, or an advert or notice."""
    label, words = "", set()
    only = readers = notice = False
    for name, *values in _NAMES.findall(rest):
        tokens = next((v for v in values if v), "").split()
        for token in tokens:
            said = {w.lower() for w in _WORD.findall(token)}
            outside = bool(said) and said <= OUTSIDE_WORDS
            only |= outside
            notice |= outside and not said.isdisjoint(NOTICES)
            readers |= not said.isdisjoint(READERS) and said.isdisjoint(STATES)
            words |= said
        mark = "." if name.lower() == "class" else "#"
        label += "".join(mark + v for v in sorted({_NUMBER.sub("#", v) for v in tokens}))
    return label, words, only, readers, notice


class Page:
    """Blocks of text of a page in page order, and its containers."""

    def __init__(self, html: str) -> None:
        self.texts: list[str] = []
        self.owners: list[Container] = []
        self.links: list[int] = []
        self.containers: list[Container] = []
        self.nodes: list[Container] = []
        self.keys: dict[tuple[int, str], int] = {}
        self._parse(html)
        self._judge()

    def _open(self, tag: str, rest: str, top: Container) -> Container:
        label, words, only, readers, notice = _said(rest)
        label = tag + label
        key = self.keys.setdefault((top.key, label), len(self.keys) + 1)
        node = Container(tag, label, key, top, len(self.texts))
        header = tag == "header" or not words.isdisjoint(HEADER_WORDS)
        if tag in OUTSIDE:
            node.mark = SOFT if tag == "form" else HARD if tag == "aside" else TAG
        elif tag not in STRUCTURE:
            node.mark = HARD if notice else 0
        elif tag == "article":
            # a class of an article tells more often what it is about; readers' texts are articles as well
            node.mark = HARD if readers else SOFT if only else 0
        elif tag not in ("body", "main") and not words.isdisjoint(OUTSIDE_WORDS):
            node.mark = HARD if only or readers else SOFT
        elif tag not in ("body", "main") and header and not top.article:
            node.mark = TAG if tag == "header" else SOFT
        self.nodes.append(node)
        if tag in ("article", "main") or not words.isdisjoint(ARTICLE_WORDS):
            node.bonus = 1.5
        if tag in CONTAINERS:
            self.containers.append(node)
        return node

    def _parse(self, html: str) -> None:
        root = top = Container("body", "", 0, None, 0)
        self.containers.append(root)
        held: list[str] = []
        linked = 0
        link = False
        at = 0
        opened: dict[str, list[Container]] = {}  # by tag, the innermost last
        pre = 0

        def settle():
            nonlocal linked
            text = " ".join("".join(held).split()) if held else ""
            if text:
                self.texts.append(text)
                self.owners.append(top)
                self.links.append(linked)
            held.clear()
            linked = 0

        def say(raw: str):
            nonlocal linked
            text = unescape(raw) if "&" in raw else raw
            held.append(text)
            if link:
                linked += len(text.strip())

        for m in _TOKEN.finditer(html):
            if m.start() > at:
                say(html[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "a":
                link = not m["close"]
            elif tag == "pre":
                pre = max(0, pre + (-1 if m["close"] else 1))
            inside = opened.get(tag)
            if tag not in STRUCTURE:
                # Kept open only if its class names an advert or notice; code has classes of its own kind.
                marked = False
                if m["close"]:
                    if inside and inside[-1].inner:
                        inside[-1].inner -= 1
                    else:
                        marked = bool(inside)
                elif not m["rest"].endswith("/") and tag not in VOID and not pre:
                    marked = "=" in m["rest"] and _said(m["rest"])[4]
                    if inside and tag not in CLOSES_ITSELF and not marked:
                        inside[-1].inner += 1
                if tag in INLINE and not marked:
                    continue
                settle()
                link = link and tag in ("br", "p")
                if not m["close"] and inside and tag in CLOSES_ITSELF:
                    top = self._close(inside[-1], top, opened)
                if marked:
                    if m["close"]:
                        top = self._close(inside[-1], top, opened)
                    else:
                        top = self._open(tag, m["rest"], top)
                        opened.setdefault(tag, []).append(top)
                continue
            settle()
            link = False
            if not m["close"] and top.tag == "p":
                top = self._close(top, top, opened)  # a paragraph ends where such a tag begins
            if tag == "body":
                # The root is the body; what was open before it (the head) ends.
                while top is not root:
                    top = self._close(top, top, opened)
            elif not m["close"]:
                if not m["rest"].endswith("/"):
                    top = self._open(tag, m["rest"], top)
                    opened.setdefault(tag, []).append(top)
            elif inside:
                top = self._close(inside[-1], top, opened)
        tail = html[at:]
        cut = tail.rfind("<")
        if cut >= 0 and _CUT.match(tail, cut):
            tail = tail[:cut]  # a tag that the end of the page cuts
        say(tail)
        settle()
        while top is not None:
            top.end = len(self.texts)
            top = top.parent

    def _close(self, node: Container, top: Container, opened: dict[str, list[Container]]) -> Container:
        """Close an open element and all in it; returns what is open then."""
        while True:
            closed, top = top, top.parent
            closed.end = len(self.texts)
            opened[closed.tag].pop()
            if closed is node:
                return top

    def _plain(self, k: int) -> float:
        return max(0.0, len(self.texts[k]) - 2.0 * self.links[k])

    def _judge(self) -> None:
        """A SOFT container with most of the text of articles (of the page, if it has none) is a wrapper."""
        if not any(node.mark for node in self.nodes):
            return
        for node in self.nodes:  # those around come first
            node.weight = max(node.mark, node.parent.weight)
        root = self.containers[0]
        plain, of_articles = {root: 0.0}, {root: 0.0}
        for k, owner in enumerate(self.owners):
            if owner.weight < HARD:
                plain[owner] = plain.get(owner, 0.0) + self._plain(k)
                if owner.article:
                    of_articles[owner] = of_articles.get(owner, 0.0) + self._plain(k)
        for sums in (plain, of_articles):
            for node in reversed(self.nodes):
                if node in sums:
                    sums[node.parent] = sums.get(node.parent, 0.0) + sums[node]
        share = of_articles if of_articles[root] else plain
        for node in self.nodes:
            wrapper = node.mark == SOFT and share.get(node, 0.0) > share[root] / 2
            node.outside = node.parent.outside or bool(node.mark and not wrapper)

    def score(self) -> Container | None:
        """The best container: own text without links counts whole, that of inner elements less.

        Where containers of one tag beside it have nearly as much, and together they have nearly all
        text of the one around them, the article is in parts and that one is taken.
        """
        for k, owner in enumerate(self.owners):
            if owner.outside:
                continue
            value = self._plain(k)
            owner.total += value
            node, part = owner, 1.0
            while node is not None and part > LEAST_PART:
                if node.tag in CONTAINERS:
                    node.score += value * part
                    part /= 2
                node = node.parent
        for node in reversed(self.nodes):
            node.parent.total += node.total
        best = None
        for node in self.containers:
            value = node.score * node.bonus
            if value > 0 and (best is None or value > best.score * best.bonus):
                best = node
        if best is None or best.parent is None:
            return best
        around = best.parent
        parts = [
            n for n in self.containers
            if n.parent is around and n.tag == best.tag and not n.outside and n.total >= PART * best.total
        ]
        whole = len(parts) > 1 and around.tag in CONTAINERS
        return around if whole and sum(n.total for n in parts) >= NEARLY_ALL * around.total else best

    def text_of(self, nodes: list[Container]) -> str:
        """The blocks in any of the containers, in page order, each once."""
        out, done = [], 0
        for node in sorted(nodes, key=lambda n: n.first):
            for k in range(max(done, node.first), node.end):
                if not self.owners[k].outside:
                    out.append(self.texts[k])
            done = max(done, node.end)
        return " ".join(out)

    def at_path(self, path: str) -> list[Container]:
        """The containers of a path; it is built once for all that share it, and only where its end fits."""
        same: dict[int, bool] = {}
        for node in self.containers:
            if node.key not in same:
                same[node.key] = path.endswith(node.label) and node.path() == path
        return [node for node in self.containers if same[node.key]]

    def main_text(self, winners: list[str]) -> str:
        for path in winners:
            found = self.text_of(self.at_path(path))
            if found:
                return found
        best = self.score()
        found = self.text_of([best]) if best else self.text_of(self.containers[:1])
        # A page that has nothing else gives its parts outside, those that may be wrappers first, but no menus.
        for least in (HARD, TAG):
            if not found:
                found = " ".join(t for t, n in zip(self.texts, self.owners, strict=True) if n.weight < least)
        return found


def host(url: Column) -> Column:
    """The host of a URL in lower case; the empty string if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def _vote(batches):
    for batch in batches:
        hosts, paths = [], []
        for name, html in zip(*columns(batch, "host", "html"), strict=True):
            best = Page(html or "").score()
            if best is not None:
                hosts.append(name)
                paths.append(best.path())
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], ["host", "path"])


_TEXT_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
)


def _extract(batches):
    out = Rows(_TEXT_SCHEMA)
    for batch in batches:
        names = ("page_id", "url", "html", "winners")
        for page_id, url, html, winners in zip(*columns(batch, *names), strict=True):
            text = Page(html or "").main_text(winners or [])
            if out.add((page_id, url, text, len(text)), 4 * len(text)):
                yield out.batch()
    yield out.batch()


def host_paths(pages: DataFrame) -> DataFrame:
    """host, winners: the winning paths of each host, most votes first."""
    votes = (
        pages.select(host(F.col("url")).alias("host"), "html")
        .mapInArrow(_vote, "host string, path string")
        .groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    votes = written(votes, "html-votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    return (
        votes.join(totals, "host")
        .where(F.col("votes") >= F.col("total") * SHARE)
        .groupBy("host")
        .agg(F.transform(ranked, lambda x: x["path"]).alias("winners"))
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    winners = written(host_paths(pages), "html-winners").withColumnRenamed("host", "_host")
    return (
        pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
        .join(winners, host(F.col("url")) == F.col("_host"), "left")
        .select("page_id", "url", "html", "winners")
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
    )
