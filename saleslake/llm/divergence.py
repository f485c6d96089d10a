"""Source divergence audit: how far the sources of a language differ in their terms, by hash-consed segment trees.

Terms are runs of letters A-Z (lower-cased) and of any characters beyond ASCII. A language keeps the terms
that at least LEAST of its documents have; their ids are (block, place), blocks by hash, places by frequency, so
that rare terms lie together. Per block, every group (language, source) gets a segment tree over the
counts of its terms: a node is known by its two children, so equal subtrees, of any groups, are one node
(a run of terms that a group lacks is one node a level). Two trees are compared from their roots down: the
pairs of nodes that meet are kept with the number of times they meet, so that each distinct pair is followed once
and each distinct pair of counts is priced once. The prices of the blocks add up.

Distribution: tasks count terms and emit sums, which are added by (language, source, term). A block holds
some BLOCK terms of at most two tiles of TILE groups each, whatever the number of terms, groups and documents.
Pairs of groups are the result itself; no pair of documents or terms is made.

Edge cases: NULL text, lang and source are ''; equal rows are documents of their own and ids play no part;
a group without terms has count 0 for every kept term; a language without kept terms has the value 0 for each
pair and no term rows; a language with one source has no pairs; extra columns are ignored; an empty table
gives no rows. Prices are whole numbers in 64 bits (at most about 4e18), rates are formed in unbounded ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from saleslake.llm.common import written

#: A kept term is in so many documents of the language.
LEAST = 3
#: Term rows of a group.
TOP = 200
SCALE = 1_000_000_000
#: Terms of a block, about, and groups of a tile.
BLOCK, TILE = 4096, 64
#: Distinct terms that a task holds before it emits their sums; bytes of a text that are cut at a time.
HELD, SLICE = 400_000, 1 << 20

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    spaced, at = text.translate(_LETTERS), 0
    while at < len(spaced):
        end = spaced.find(b" ", at + SLICE)
        end = len(spaced) if end < 0 else end
        yield spaced[at:end].split()
        at = end


class _Sums:
    """Occurrences and documents of the terms of each group, as far as a task has read."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        if (lang, source) not in self.groups:
            self.held += 1
        n, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before, seen = len(n), set()
        for found in terms_of(text):
            n.update(found)
            new = set(found) - seen if seen else set(found)
            docs.update(new)
            seen |= new
        self.held += len(n) - before

    def batch(self) -> pa.RecordBatch:
        """What is held; a row without term says that the group occurs."""
        columns = [[], [], [], [], []]
        for (lang, source), (n, docs) in self.groups.items():
            size = len(n) + 1
            for column, values in zip(
                columns, ([lang] * size, [source] * size, [None, *n], [0, *n.values()], [0, *map(docs.__getitem__, n)]), strict=True
            ):
                column += values
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        self.__init__()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["lang", "source", "term", "n", "docs"]
        )


def _count(batches):
    sums = _Sums()
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(*columns, strict=True):
            sums.add(lang, source, text)
            if sums.held >= HELD:
                yield sums.batch()
    yield sums.batch()


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); a NULL term for each group."""
    texts = docs.select(
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    found = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    sums = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return written(sums, "divergence-counts")


def _kept(found: DataFrame) -> DataFrame:
    """The kept terms of each group, with the language's total; ``first`` is true once per kept term."""
    same = Window.partitionBy("lang", "term")
    totals = found.where("term IS NOT NULL").withColumns(
        {
            "in_docs": F.sum("docs").over(same),
            "total": F.sum("n").over(same),
            "first": F.col("source") == F.min("source").over(same),
        }
    )
    kept = totals.where(F.col("in_docs") >= LEAST).select("lang", "source", "term", "n", "total", "first")
    return written(kept, "divergence-kept")


def _groups(found: DataFrame, kept: DataFrame, size: int, tile: int) -> DataFrame:
    """lang, source, its number g in the language, tiles, blocks, and the divisors of its and the language's rates."""
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("n_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    groups = found.where("term IS NULL").select("lang", "source")
    v = F.coalesce("v", F.lit(0))
    in_lang = Window.partitionBy("lang")
    return written(
        groups.join(langs, "lang", "left")
        .join(sums, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(in_lang.orderBy("source")) - 1).alias("g"),
            F.ceil(F.count(F.lit(1)).over(in_lang) / tile).cast("long").alias("tiles"),
            F.greatest(F.lit(1), F.ceil(v / size)).cast("long").alias("blocks"),
            (F.coalesce("n_group", F.lit(0)) + v).alias("d"),
            (F.coalesce("n_lang", F.lit(0)) + v).alias("d_lang"),
        ),
        "divergence-groups",
    )


def _dealt(groups: DataFrame, kept: DataFrame, tile: int) -> DataFrame:
    """Counts and groups, once for each block and pair of tiles that needs them; groups have no term."""
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    shared = ["lang", "block", "g", "source", "term", "n", "total", "d", "d_lang", "size", "tiles"]
    of_groups = groups.select("lang", "source", "g", "tiles", "blocks")
    placed = kept.join(of_groups, ["lang", "source"]).select("*", block)
    sizes = placed.where("first").groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
    no = F.lit(None).cast("long")
    cells = placed.select(*(F.col(c) if c in placed.columns else no.alias(c) for c in shared))
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    members = every.join(sizes, ["lang", "block"], "left").select(
        *(F.col(c) if c not in ("term", "n", "total") else F.lit(None).cast("string" if c == "term" else "long").alias(c) for c in shared)
    )
    mine = F.floor(F.col("g") / tile).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    return (
        cells.unionByName(members)
        .withColumns({"mine": mine, "other": other})
        .withColumns({"ti": F.least("mine", "other"), "tj": F.greatest("mine", "other")})
        .drop("mine", "other", "tiles")
    )


class Trees:
    """Segment trees of equal width over the rows of ``table``, their nodes shared."""

    def __init__(self, table: np.ndarray) -> None:
        self.leaves, nodes = np.unique(table, return_inverse=True)
        nodes = nodes.reshape(table.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # children of the nodes, from the leaves up
        below = len(self.leaves)
        while nodes.shape[1] > 1:
            pairs, inverse = np.unique(nodes[:, ::2] * below + nodes[:, 1::2], return_inverse=True)
            nodes = inverse.reshape(len(table), -1)
            self.levels.append((pairs // below, pairs % below))
            below = len(pairs)
        self.roots = nodes[:, 0]

    def meetings(self, one: int, others: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place in ``others``, leaf of ``one``, leaf of the other, times): the distinct pairs of leaves at one place."""
        which = np.arange(len(others))
        a, b, times = np.full(len(others), self.roots[one]), self.roots[others], np.ones(len(others), np.int64)
        for k in range(len(self.levels), 0, -1):
            (left, right), below = self.levels[k - 1], len(self.levels[k - 2][0]) if k > 1 else len(self.leaves)
            met = np.concatenate(
                [(which * below + left[a]) * below + left[b], (which * below + right[a]) * below + right[b]]
            )
            met, inverse = np.unique(met, return_inverse=True)
            times = np.bincount(inverse, np.tile(times, 2), len(met)).astype(np.int64)
            which, a, b = met // below // below, met // below % below, met % below
        return which, a, b, times


def rates(values: np.ndarray, divisor: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / divisor) of counts; places without a term (-1) have the rate 1 in all groups."""
    return np.array([1 + SCALE * (c + 1) // divisor if c >= 0 else 1 for c in values.tolist()], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _compare(table: pa.Table, tile: int) -> pa.Table:
    """Prices of a block: for each pair of its groups, and its dearest terms for each group."""
    lang, ti, tj = (table.column(c)[0].as_py() for c in ("lang", "ti", "tj"))
    is_group = np.array(table.column("term").is_null())
    members = table.filter(pa.array(is_group)).to_pylist()
    members.sort(key=lambda m: m["g"])
    row = {m["g"]: k for k, m in enumerate(members)}
    cells = table.filter(pa.array(~is_group))
    encoded = cells.column("term").combine_chunks().dictionary_encode()
    terms = encoded.dictionary.to_pylist()
    number = encoded.indices.to_numpy()
    n, total = (cells.column(c).to_numpy() for c in ("n", "total"))
    totals = np.zeros(len(terms), np.int64)
    totals[number] = total
    spelled = np.empty(len(terms), np.int64)  # code points and UTF-8 have one order
    spelled[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    order = np.lexsort((spelled, -totals))
    place = np.empty(len(terms), np.int64)
    place[order] = np.arange(len(terms))
    size = members[0]["size"] or 0
    width = 1 << max(0, size - 1).bit_length()
    held = np.zeros((len(members), width), np.int64)
    held[:, size:] = -1
    held[[row[g] for g in cells.column("g").to_pylist()], place[number]] = n
    trees = Trees(held)
    rate = [rates(trees.leaves, m["d"]) if m["d"] else np.ones(len(trees.leaves), np.int64) for m in members]
    first = [k for k, m in enumerate(members) if m["g"] // tile == ti]
    second = [k for k, m in enumerate(members) if m["g"] // tile == tj]
    found = []
    for one in first:
        others = np.array([k for k in second if k > one], np.int64)
        if not len(others):
            continue
        which, a, b, times = trees.meetings(one, others)
        p = rate[one][a]
        q = np.empty_like(p)
        for w, k in enumerate(others):
            q[which == w] = rate[k][b[which == w]]
        there, back = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64)
        np.add.at(there, which, price(p, q) * times)
        np.add.at(back, which, price(q, p) * times)
        mine = members[one]["source"]
        for k, x, y in zip(others, there.tolist(), back.tolist(), strict=True):
            other = members[k]["source"]
            found += [("pair", mine, other, x), ("pair", other, mine, y)]
    if ti == tj and terms:
        values, inverse = np.unique(totals[order], return_inverse=True)
        q = rates(values, members[0]["d_lang"])[inverse]
        for k in first:
            own = held[k, : len(terms)]
            p = rate[k][np.searchsorted(trees.leaves, own)]
            dear = np.flatnonzero((own > 0) & (p > q))
            worth = price(p[dear], q[dear])
            best = np.lexsort((spelled[order[dear]], -worth))[:TOP]
            source = members[k]["source"]
            found += [("term", source, terms[order[dear[b]]], int(worth[b])) for b in best]
    columns = list(zip(*found, strict=True)) or [()] * 4
    arrays = [pa.array([lang] * len(found), pa.string())]
    arrays += [pa.array(c, pa.int64() if k == 3 else pa.string()) for k, c in enumerate(columns)]
    return pa.Table.from_arrays(arrays, ["lang", "part", "source", "item", "value"])


def audit(docs: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank; see the contract."""
    found = counts(docs)
    kept = _kept(found)
    dealt = _dealt(_groups(found, kept, block, tile), kept, tile)
    prices = dealt.groupBy("lang", "block", "ti", "tj").applyInArrow(
        lambda table: _compare(table, tile), "lang string, part string, source string, item string, value long"
    )
    prices = written(prices, "divergence-prices")
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = prices.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = prices.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOP)
    both = [pairs.withColumn("rank", F.row_number().over(ranked)), terms]
    return reduce(DataFrame.unionByName, both).select("lang", "source", "part", "item", "value", "rank")
