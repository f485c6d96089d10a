"""SimHash near-dedup: 64-bit fingerprints linked within a Hamming distance by binary tries.

Fingerprints of whole texts need no shuffle. Equal ones are one node. A pair within MAX_BITS = 3 bits
agrees in one of four 16-bit blocks, so four tries, each with another block on top, are cut below
level 16: a pair of near fingerprints lies in one subtree of one of them. In a subtree pairs of nodes
are traversed together from (root, root): both split by the next bit, crossed children cost one bit,
and a pair over the budget goes. Pairs of few leaves are settled by counting bits.

A subtree of more than SUBTREE fingerprints (near copies of one text) is cut at random into parts of
half that size; every two parts are traversed as a pair of tries in a task of their own. Tasks
return the links of a subtree as a star, never all pairs, and the stars become components.

Edge cases: a NULL or empty text has fingerprint zero and is linked like any other; texts of one or
two words have one shingle; equal and repeated rows share a component; component_id is the least
non-null doc_id of the component (NULL if there is none); extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.common import boxed, identity, with_row_identity, written
from saleslake.llm.components import components
from saleslake.llm.superkmers import columns, groups

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of one subtree that a task traverses.
SUBTREE = 2_048
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 16


def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle of the words of a text, A-Z lower-cased; repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, seed)]
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :])]


def bit_counts(hashes: np.ndarray, starts: list[int]) -> np.ndarray:
    """How many hashes have each bit, for the runs of ``hashes`` from ``starts``; bit 0 first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.uint32)


def pack_bits(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The fingerprint: bits set in over half of the hashes."""
    bits = (2 * counts.astype(np.int64) > totals[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprint_batches(size: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints = np.zeros(len(texts), np.uint64)
            held, starts, rows, n = [], [], [], 0

            def settle():
                counts = bit_counts(np.array(held, np.uint64), starts)
                totals = np.diff([*starts, len(held)])
                prints[rows] = pack_bits(counts, totals)

            for row, text in enumerate(texts):
                hashes = shingle_hashes(text, size)
                if not hashes:
                    continue
                if len(hashes) > _BLOCK:  # a long text is counted block by block
                    counts = sum(
                        bit_counts(np.array(hashes[a : a + _BLOCK], np.uint64), [0]).astype(np.int64)
                        for a in range(0, len(hashes), _BLOCK)
                    )
                    prints[row] = pack_bits(counts, np.array([len(hashes)]))[0]
                    continue
                starts.append(n)
                rows.append(row)
                held += hashes
                n += len(hashes)
                if n > _BLOCK:
                    settle()
                    held, starts, rows, n = [], [], [], 0
            if rows:
                settle()
            arrays = [batch.column("doc_id"), batch.column("rid"), batch.column("th"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "rid", "th", "fp"])

    return run


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, rid, th, fp: the fingerprint as a signed long."""
    return with_row_identity(df).mapInArrow(
        _fingerprint_batches(shingle), "doc_id long, rid long, th long, fp long"
    )


def traverse(values: np.ndarray, roots, max_bits: int, depth: int):
    """Pairs (i, j) of sorted ``values`` within ``max_bits``, for each pair of root ranges.

    roots: arrays lo_a, hi_a, lo_b, hi_b; a trie is a range of values that agree above ``depth``
    bits; equal ranges are traversed with themselves.
    """
    la, ha, lb, hb = (np.asarray(x, np.int64) for x in roots)
    cost = np.zeros(len(la), np.int8)
    found_i, found_j = [], []
    for level in range(depth, 65):
        # Few leaves: settle by counting the bits of each pair.
        few = (ha - la) * (hb - lb) <= 16
        if level == 64:
            few[:] = True
        if few.any():
            a, b, size_b = la[few], lb[few], (hb - lb)[few]
            size = (ha - la)[few] * size_b
            which = np.repeat(np.arange(len(a)), size)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            i, j = a[which] + place // size_b[which], b[which] + place % size_b[which]
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= max_bits)
            found_i.append(i[near])
            found_j.append(j[near])
            la, ha, lb, hb, cost = (x[~few] for x in (la, ha, lb, hb, cost))
        if not len(la):
            break
        ones = np.zeros(len(values) + 1, np.int64)
        np.cumsum((values >> np.uint64(63 - level)) & np.uint64(1), out=ones[1:], dtype=np.int64)
        ma, mb = ha - (ones[ha] - ones[la]), hb - (ones[hb] - ones[lb])
        self_pair = la == lb
        parts = [
            (la, ma, lb, mb, cost, None),
            (ma, ha, mb, hb, cost, None),
            (la, ma, mb, hb, cost + 1, None),
            (ma, ha, lb, mb, cost + 1, ~self_pair),  # of a trie with itself the mirror image
        ]
        kept = []
        for a0, a1, b0, b1, c, only in parts:
            ok = (a1 > a0) & (b1 > b0) & (c <= max_bits)
            if only is not None:
                ok &= only
            kept.append([x[ok] for x in (a0, a1, b0, b1, c)])
        la, ha, lb, hb, cost = (np.concatenate(x) for x in zip(*kept, strict=True))
    empty = [np.empty(0, np.int64)]
    return np.concatenate(found_i or empty), np.concatenate(found_j or empty)


def least_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least position linked to each of ``n`` positions by the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == label).all():
            break
        label = new
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def _stars(max_bits: int, depth: int):
    """Edges (u, v) of subtrees: rows key, side, value (rotated), fp sorted by key, side and value."""

    def settle(side, value, fp, starts):
        ends = np.append(starts[1:], len(value))
        split = starts + np.add.reduceat(side == 0, starts)  # side 1 follows side 0
        whole = split == ends
        roots = (starts, split, np.where(whole, starts, split), ends)
        i, j = traverse(value, roots, max_bits, depth)
        root = least_linked(len(value), i, j)
        linked = np.flatnonzero(root != np.arange(len(value)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], ["u", "v"])

    def run(batches):
        for table in groups(batches, "key", 1 << 18):
            key, side, value, fp = (table.column(c).to_numpy() for c in ("key", "side", "value", "fp"))
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            yield settle(side, value.view(np.uint64), fp, starts)

    return run


def _edges(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Stars over the fingerprints (fp) that link every pair within ``max_bits``."""
    blocks = max_bits + 1
    width = 64 // blocks
    rotated = F.array(
        *(
            F.struct(
                F.lit(b).alias("b"),
                F.shiftleft("fp", b * width)
                .bitwiseOR(F.shiftrightunsigned("fp", 64 - b * width) if b else F.lit(0).cast("long"))
                .alias("value"),
            )
            for b in range(blocks)
        )
    )
    tries = nodes.select("fp", F.explode(rotated).alias("t")).select(
        "fp",
        F.col("t.value").alias("value"),
        F.shiftrightunsigned(F.col("t.value"), 64 - width).alias("block"),
        F.col("t.b").alias("b"),
    )
    subtree = tries.withColumn("key", F.shiftleft(F.col("b").cast("long"), width).bitwiseOR(F.col("block")))
    large = subtree.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SUBTREE)
    large = large.select("key", F.ceil(F.col("n") / (SUBTREE // 2)).cast("int").alias("parts"))
    dealt = subtree.join(large, "key", "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # Part p meets every part q; the pair (p, q) with p < q is one task, p on side 0 and q on side 1.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda q: F.struct(
            F.least(part, q).alias("p"), F.greatest(part, q).alias("q"), (part > q).cast("int").alias("side")
        ),
    )
    alone = F.array(F.struct(F.lit(-1).alias("p"), F.lit(-1).alias("q"), F.lit(0).alias("side")))
    dealt = dealt.withColumn("pair", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(pairs)))
    keyed = dealt.select(
        F.when(F.col("pair.p") < 0, F.col("key"))
        .otherwise(F.xxhash64("key", "pair.p", "pair.q"))
        .alias("key"),
        F.col("pair.side").alias("side"),
        F.col("value"),
        "fp",
        F.col("value").bitwiseXOR(F.lit(-(2**63))).alias("order"),
    )
    placed = keyed.repartition("key").sortWithinPartitions("key", "side", "order").drop("order")
    return placed.mapInArrow(_stars(max_bits, width), "u long, v long")


def linked(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, rid, th, fp, root (the component's least fingerprint), component_id."""
    prints = written(fingerprints(df, shingle), "simhash-fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(_edges(nodes.select("fp"), max_bits), "simhash-components")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(of_print, "fp")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return linked(df, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the least doc_id of each component (NULL is greatest), with its own columns."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "rid", "th")).alias("first")
    rows = linked(df, shingle, max_bits).groupBy("root").agg(first)
    chosen = written(rows.select("first.rid", "first.th"), "simhash-kept")
    return (
        boxed(df, *identity())
        .join(chosen, ["rid", "th"], "left_semi")
        .dropDuplicates(["rid", "th"])
        .select("_row.*")
    )
