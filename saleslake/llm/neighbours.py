"""Approximate nearest neighbours by multi-index hashing.

A rotation is learned on at most SAMPLE vectors (principal axes, then iterative quantisation); the signs
of the rotated vector, and of a second random rotation of it, are its code of BITS bits per rotation.
Codes are cut into bytes, and each byte position is indexed. Codes within Hamming radius r of a query
agree with it, by the pigeonhole principle, within floor(r / bytes) bits in one of the first r mod bytes + 1
byte positions or within one bit less in another; probing those lists gives every code within r. These
are reranked by the cosine of the original vectors. r is learned as well: the radius that holds QUANTILE of the
sample's true neighbours. Where it holds fewer than ``k + 1`` rows of a block, the radius grows.

Every vector is indexed. Equal vectors are one entry with their k + 1 smallest ids: more of them can never be
among k neighbours that break ties by id. The index is dealt in blocks of BLOCK vectors and the queries in
blocks of QUERIES; each pair of blocks is one bounded task.

Edge cases: vectors that are NULL, empty, zero or hold a NULL or non-finite component, and rows without
vec_id, take no part; repeated rows count once; vectors of another length than the query's are no
candidates; fewer than k candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from saleslake.llm.common import written

K = 5
SAMPLE = 4_096
QUANTILE = 0.98
BLOCK = 8_192
QUERIES = 2_048
SEED = 7

_POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8))
#: Byte masks by number of bits: masks[:until[b]] have at most b bits.
_MASKS = np.argsort(_POPCOUNT, kind="stable").astype(np.uint8)
_UNTIL = np.cumsum(np.bincount(_POPCOUNT))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))[0]


def learn(sample: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Rotations, side by side: a learned one, and a random one of the same axes."""
    x = unit(sample)
    dim = x.shape[1]
    axes = np.linalg.eigh(x.T @ x)[1]
    projected = x @ axes
    turn = rotation(dim)
    for _ in range(rounds):  # the nearest rotation to the signs, then the signs again
        u, _, v = np.linalg.svd(np.sign(projected @ turn).T @ projected)
        turn = (u @ v).T
    first = axes @ turn
    return np.hstack([first, first @ rotation(dim, SEED + 1)])


def encode(vectors: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """One row of code bytes per vector."""
    return np.packbits(unit(vectors) @ turns > 0, axis=1)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _POPCOUNT[codes ^ code].sum(axis=1, dtype=np.int64)


def learn_radius(sample: np.ndarray, turns: np.ndarray, k: int = K, probes: int = 256) -> int:
    """The radius that holds QUANTILE of the k true neighbours of the first rows of the sample."""
    x, codes = unit(sample), encode(sample, turns)
    seen = []
    for q in range(min(probes, len(x))):
        score = x @ x[q]
        score[q] = -np.inf
        near = np.argsort(-score)[: min(k, len(x) - 1)]
        seen.append(distances(codes[near], codes[q]))
    seen = np.concatenate(seen) if seen else np.array([])
    return int(np.ceil(np.quantile(seen, QUANTILE))) if len(seen) else 8 * codes.shape[1]


class MultiIndex:
    """For each byte position, the rows of each byte value."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.rows = [np.argsort(column, kind="stable") for column in codes.T]
        self.ends = [np.cumsum(np.bincount(column, minlength=256)) for column in codes.T]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is at most ``radius`` bits away."""
        parts = self.codes.shape[1]
        whole, more = divmod(radius, parts)
        seen = np.zeros(len(self.codes), bool)
        for j in range(parts):
            bits = min(whole if j <= more else whole - 1, 8)
            if bits < 0:
                continue
            ends = self.ends[j]
            for value in code[j] ^ _MASKS[: _UNTIL[bits]]:
                begin = ends[value - 1] if value else 0
                if begin < ends[value]:
                    seen[self.rows[j][begin : ends[value]]] = True
        found = np.flatnonzero(seen)
        return found[distances(self.codes[found], code) <= radius]

    def at_least(self, code: np.ndarray, radius: int, n: int) -> np.ndarray:
        """The rows within ``radius``, or within the first larger one tried that has ``n`` rows."""
        most = 8 * self.codes.shape[1]
        n = min(n, len(self.codes))
        while True:
            found = self.within(code, radius)
            if len(found) >= n or radius >= most:
                return found
            radius = min(most, radius + max(4, radius // 4))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


_HITS = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(model, k: int):
    """Best k + 1 rows of an index block for each query of a query block."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return _HITS.empty_table()
        dim = index.column("dim")[0].as_py()
        turns, radius = model.get(dim, (None, 0))
        if turns is None:  # a length that the sample doesn't have
            turns = np.hstack([rotation(dim), rotation(dim, SEED + 1)])
        x, q = _matrix(index.column("embedding"), dim), _matrix(queries.column("embedding"), dim)
        ids = index.column("ids").to_pylist()
        size = np.sqrt((x * x).sum(axis=1))
        table = MultiIndex(encode(x, turns))
        rows = []
        for name, vector, code in zip(queries.column("query").to_pylist(), q, encode(q, turns), strict=True):
            found = table.at_least(code, radius, k + 1)
            score = (x[found] * vector).sum(axis=1) / (size[found] * np.sqrt((vector * vector).sum()))
            if len(found) > k + 1:  # ties with the last place stay
                least = -np.partition(-score, k)[k]
                found, score = found[score >= least], score[score >= least]
            hits = sorted((-s, i) for f, s in zip(found, score.tolist(), strict=True) for i in ids[f])
            rows += [(name, i, -s) for s, i in hits[: k + 1]]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _HITS, strict=True)], schema=_HITS)

    return run


def usable(df: DataFrame) -> DataFrame:
    """vec_id, embedding, dim, h (a hash of the vector) of the distinct rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(e, lambda x: x != 0)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull()).where(finite & some)
    rows = rows.select("vec_id", "embedding", F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("h"))
    return rows.distinct()


def search(df: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row that is_query selects."""
    rows = written(usable(df), "neighbours-rows")
    place = Window.partitionBy("h", "embedding").orderBy("vec_id")
    index = (
        rows.withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= k + 1)
        .groupBy("h", "embedding", "dim")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    index = written(index, "neighbours-index")
    asked = rows.where(is_query)
    queries = written(asked.groupBy("h", "embedding", "dim").agg(F.min("vec_id").alias("query")), "neighbours-queries")

    model = {}
    sample = index.orderBy("h").limit(SAMPLE).select("dim", "embedding").collect()
    for dim in {r["dim"] for r in sample}:
        vectors = np.array([r["embedding"] for r in sample if r["dim"] == dim], np.float64)
        turns = learn(vectors)
        model[dim] = (turns, learn_radius(vectors, turns, k))

    blocks = max(1, -(-index.count() // BLOCK))
    askers = max(1, -(-queries.count() // QUERIES))
    left = index.withColumn("b", F.pmod("h", F.lit(blocks))).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(askers - 1)))
    )
    right = queries.withColumn("c", F.pmod("h", F.lit(askers))).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    cell = ("b", "c", "dim")
    left = left.select(F.col("b").cast("long"), F.col("c").cast("long"), "dim", "embedding", "ids")
    right = right.select(F.col("b").cast("long"), F.col("c").cast("long"), "dim", "embedding", "query")
    hits = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInArrow(_search(model, k), "query long, vec_id long, score double")
    )
    # k + 1 hits of each block at most; the best k + 1 of all blocks, without the query's own row.
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k + 1)
    best = written(hits.groupBy("query").agg(best.alias("best")), "neighbours-best")
    names = asked.join(queries.select("h", "embedding", "query"), ["h", "embedding"])
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        names.select(F.col("vec_id").alias("query_id"), "query")
        .join(best, "query")
        .select("query_id", F.posexplode(others).alias("rank", "hit"))
        .select(
            "query_id",
            (F.col("rank") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            (-F.col("hit.s")).alias("score"),
        )
    )
