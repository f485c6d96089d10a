"""Repeated windows of a corpus, found through super-k-mers.

A text is a sequence of units (words or bytes); a window is ``k`` consecutive units of one text. The
minimiser of a window is the leftmost of its ``m``-unit pieces whose hash is least. Consecutive
windows with the same minimiser occurrence form a super-k-mer. Equal windows have equal minimisers,
so they meet in the bucket of that hash, and two windows of one super-k-mer are never equal.

1. Every text gives its super-k-mers as (hash, text, start, windows), about 32 bytes for some
   ``(k - m) / 2`` windows. Hashes seen once (or in one document) are dropped: a sum per hash.
2. Only texts with a shared hash go on, and only their shared super-k-mers are packed as strings.
3. Buckets of at most HOT super-k-mers travel as packed strings to the task of their hash, where an
   exact method given by the caller compares the windows.
4. A bucket above HOT (a passage in a third of all documents) is cut: equal strings are summed where
   they arise, and the windows of the different ones are dealt by a 128-bit hash of the window, so
   that only equal windows meet, as sums. No cap, nothing is dropped.
5. What is found comes back to its text as (start, number of windows).

Each stage that is read twice is written to the shared folder; no executor holds state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.common import with_row_identity, written

#: Super-k-mers of one hash that one task compares; more are cut by the hash of their windows.
HOT = 4_096
#: Units handled at a time; longer texts are handled in overlapping pieces of this many windows.
PIECE = 1 << 18
_LOW = np.uint64((1 << 22) - 1)

_random = np.random.default_rng(20_240_601)
_BYTE_A, _BYTE_B = (_random.integers(0, 2**64, 256, dtype=np.uint64) for _ in range(2))
_BASE_A, _BASE_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least ``n``."""
    found = _powers.get(int(base))
    if found is None or len(found[0]) < n:
        n = max(n, 1 << 16)
        tables = []
        for b in (int(base), pow(int(base), -1, 2**64)):
            table = np.empty(n, np.uint64)
            table[0] = 1
            done = 1
            while done < n:  # the first part times b**done gives the next part
                more = min(done, n - done)
                table[done : done + more] = table[:more] * np.uint64(pow(b, done, 2**64))
                done += more
            tables.append(table)
        found = _powers[int(base)] = (tables[0], tables[1])
    return found


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base=_BASE_A) -> np.ndarray:
    """A 64-bit polynomial hash of each span of ``values``."""
    power, inverse = _power(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a byte array."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_values(data: np.ndarray, base_table: np.ndarray = _BYTE_A, base=_BASE_A):
    starts, ends = word_spans(data)
    return spans_hash(base_table[data], starts, ends, base)


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """For each start, the index of the leftmost least of ``w`` values (by their high 42 bits)."""
    n = len(values)
    tagged = (values & ~_LOW) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.uint64(2**64 - 1))
    padded[:n] = tagged
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    last = n - w + 1
    return (np.minimum(behind[:last], ahead[w - 1 : w - 1 + last]) & _LOW).astype(np.int64)


def super_kmers(pieces: np.ndarray, windows: np.ndarray, k: int, m: int):
    """Runs of consecutive allowed windows with one minimiser: start, number, hash.

    pieces: the hash of the m units from each position; windows: where a window may start.
    """
    if not len(windows):
        none = np.empty(0, np.int64)
        return none, none, none
    at = sliding_argmin(pieces, k - m + 1)[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(windows)))
    return windows[first], size, pieces[at[first]].view(np.int64)


@dataclass(frozen=True)
class Units:
    """What a text is cut into."""

    words: bool
    k: int
    m: int

    def values(self, data: np.ndarray, second: bool = False) -> np.ndarray:
        table, base = (_BYTE_B, _BASE_B) if second else (_BYTE_A, _BASE_A)
        return word_values(data, table, base) if self.words else table[data]

    def pieces(self, values: np.ndarray) -> np.ndarray:
        """The hash of the m units from each position; the last ones reach beyond the end."""
        start = np.arange(len(values))
        return spans_hash(values, start, np.minimum(start + self.m, len(values)), _BASE_B)

    def count(self, text: bytes) -> int:
        return len(text.split()) if self.words else len(text)

    def pack(self, text, start: int, n: int) -> bytes:
        """The units of ``n`` windows from ``start``; text is bytes, or the list of its words."""
        cut = text[start : start + n + self.k - 1]
        return b" ".join(cut) if self.words else bytes(cut)


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def _scan(units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Super-k-mers of whole texts; short texts are handled together, long ones in pieces."""
    k, m = units.k, units.m

    def of_values(values: np.ndarray, ends: np.ndarray):
        """values of texts laid end to end; ends: where each text ends."""
        if len(values) < k:
            return super_kmers(values, np.empty(0, np.int64), k, m)
        allowed = np.ones(len(values), bool)
        for j in ends:  # windows that would cross the end of a text
            allowed[max(0, j - k + 1) : j] = False
        starts = np.flatnonzero(allowed[: len(values) - k + 1])
        return super_kmers(units.pieces(values), starts, k, m)

    def together(texts: list[bytes], rows: list[tuple[int, int]]):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        values = units.values(data)
        sizes = np.array([units.count(t) + (not units.words) for t in texts])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        if not units.words:  # the joining byte belongs to no window
            ends = ends - 1
            blocked = np.concatenate([ends, ends + 1])
        else:
            blocked = ends
        start, n, key = of_values(values, blocked)
        owner = np.searchsorted(begins, start, side="right") - 1
        # empty texts share their begin with the next text, which is the one found on the right
        rid, th = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        yield key, rid[owner], th[owner], start - begins[owner], n

    def alone(text: bytes, row: tuple[int, int]):
        values = units.values(np.frombuffer(text, np.uint8))
        for a in range(0, max(1, len(values) - k + 1), PIECE):
            start, n, key = of_values(values[a : a + PIECE + k - 1], np.empty(0, np.int64))
            yield key, np.full(len(key), row[0]), np.full(len(key), row[1]), start + a, n

    def found(batches):
        texts, rows, size = [], [], 0
        for batch in batches:
            for rid, th, text in zip(*columns(batch, "rid", "th", "text"), strict=True):
                if len(text) > PIECE:
                    yield from alone(text, (rid, th))
                    continue
                texts.append(text)
                rows.append((rid, th))
                size += len(text) + 1
                if size > PIECE:
                    yield from together(texts, rows)
                    texts, rows, size = [], [], 0
        if texts:
            yield from together(texts, rows)

    def run(batches):
        for key, rid, th, start, n in found(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key, rid, th, start, n.astype(np.int32))],
                ["key", "rid", "th", "start", "n"],
            )

    return run


EMITTED = (
    "kind int, doc_id long, rid long, th long, start long, n int, key long, packed binary, "
    "starts array<long>, n_units long, kept_sha256 string"
)
DONE, STRING, HOT_STRING, TEXT = range(4)


class Rows:
    """Collects rows and gives them as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 4 << 20) -> None:
        self.schema, self.most, self.rows, self.size = schema, most, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.size += size + 64
        return self.size >= self.most

    def batch(self) -> pa.RecordBatch:
        data = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        self.rows, self.size = [], 0
        arrays = [pa.array(c, f.type) for c, f in zip(data, self.schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


_EMITTED = pa.schema(
    [("kind", pa.int32()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("th", pa.int64()),
     ("start", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("packed", pa.binary()),
     ("starts", pa.list_(pa.int64())), ("n_units", pa.int64()), ("kept_sha256", pa.string())]
)


def _emit(units: Units):
    def run(batches):
        out = Rows(_EMITTED)
        for batch in batches:
            names = ("doc_id", "rid", "th", "text", "shared")
            for doc_id, rid, th, text, shared in zip(*columns(batch, *names), strict=True):
                if not shared:
                    whole = b" ".join(text.split()) if units.words else text
                    sha = hashlib.sha256(whole).hexdigest()
                    row = (DONE, doc_id, rid, th, *[None] * 5, units.count(text), sha)
                    if out.add(row, 64):
                        yield out.batch()
                    continue
                cut = text.split() if units.words else text
                if out.add((TEXT, doc_id, rid, th, *[None] * 3, text, *[None] * 3), len(text)):
                    yield out.batch()
                hot: dict[bytes, list[int]] = {}
                for s in shared:
                    packed = units.pack(cut, s["start"], s["n"])
                    if s["hot"]:
                        hot.setdefault(packed, []).append(s["start"])
                        continue
                    row = (STRING, doc_id, rid, th, s["start"], s["n"], s["key"], packed, *[None] * 3)
                    if out.add(row, len(packed)):
                        yield out.batch()
                for packed, starts in hot.items():  # one row, however often the text repeats it
                    row = (HOT_STRING, doc_id, rid, th, *[None] * 3, packed, starts, None, None)
                    if out.add(row, len(packed) + 8 * len(starts)):
                        yield out.batch()
        yield out.batch()

    return run


def _window_hashes(units: Units):
    """The 128-bit hashes of the windows of each packed string."""
    names = ["a", "b", "pa", "pb", "offset", "copies", "first"]

    def run(batches):
        for batch in batches:
            packed = batch.column("packed").to_pylist()
            ids = [hashlib.blake2b(p, digest_size=16).digest() for p in packed]
            copies, first = batch.column("copies").to_pylist(), batch.column("first").to_pylist()
            parts: list[list] = [[] for _ in names]
            size = 0
            for p, i, c, f in zip(packed, ids, copies, first, strict=True):
                data = np.frombuffer(p, np.uint8)
                hashes = []
                for second in (False, True):
                    values = units.values(data, second)
                    start = np.arange(len(values) - units.k + 1)
                    base = _BASE_B if second else _BASE_A
                    hashes.append(spans_hash(values, start, start + units.k, base).view(np.int64))
                n = len(start)
                pid = np.frombuffer(i, np.int64)
                row = (*hashes, np.full(n, pid[0]), np.full(n, pid[1]), start.astype(np.int32),
                       np.full(n, c, np.int64), np.full(n, NO_DOC if f is None else f, np.int64))
                for part, x in zip(parts, row, strict=True):
                    part.append(x)
                size += n
                if size > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in parts], names)
                    parts, size = [[] for _ in names], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in parts], names)

    return run


NO_DOC = 2**63 - 1


def _string_ids(batches):
    """The 128-bit hash of each packed string."""
    for batch in batches:
        ids = [hashlib.blake2b(p, digest_size=16).digest() for p in batch.column("packed").to_pylist()]
        pair = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
        arrays = [batch.column(c) for c in ("doc_id", "rid", "th", "starts")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair[:, 0]), pa.array(pair[:, 1]), *arrays],
            ["pa", "pb", "doc_id", "rid", "th", "starts"],
        )


_RUNS = pa.list_(pa.struct([("offset", pa.int32()), ("n", pa.int32()), ("lowest", pa.int64())]))


def _merge(batches):
    """Sorted windows of a string as runs with the same lowest document."""
    for batch in batches:
        merged = []
        for windows in batch.column("windows").to_pylist():
            runs: list[dict] = []
            for w in windows:
                end = runs and runs[-1]["offset"] + runs[-1]["n"]
                if runs and end == w["offset"] and runs[-1]["lowest"] == w["lowest"]:
                    runs[-1]["n"] += 1
                else:
                    runs.append({"offset": w["offset"], "n": 1, "lowest": w["lowest"]})
            merged.append(runs)
        yield pa.RecordBatch.from_arrays(
            [batch.column("pa"), batch.column("pb"), pa.array(merged, _RUNS)], ["pa", "pb", "runs"]
        )


FOUND = "rid long, th long, start long, n int"
_FOUND = pa.schema([("rid", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])


def found_batch(rid, th, start, n) -> pa.RecordBatch:
    arrays = [pa.array(x, f.type) for x, f in zip((rid, th, start, n), _FOUND, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_FOUND)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of true values."""
    change = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    start = np.flatnonzero(change == 1)
    return start, np.flatnonzero(change == -1) - start


def groups(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by ``key``, of about ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut)
            held, size = rest.combine_chunks().to_batches(), rest.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _sorted_by_key(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key")


@dataclass(frozen=True)
class Repeats:
    """``done``: texts without any shared hash. ``texts``: the others, with the windows found."""

    done: DataFrame
    texts: DataFrame


def repeated_windows(df: DataFrame, units: Units, compare, earlier: bool, purpose: str) -> Repeats:
    """Windows that occur elsewhere (earlier: that start in a document with a smaller doc_id).

    compare: a function for mapInArrow over super-k-mers sorted by ``key`` (rid, th, doc_id, start,
    n, packed) to FOUND rows. With ``earlier``, rows without doc_id neither give nor lose windows.
    """
    docs = with_row_identity(df)
    seen = docs.where("doc_id IS NOT NULL") if earlier else docs
    light = written(
        seen.select("rid", "th", "text").mapInArrow(
            _scan(units), "key long, rid long, th long, start long, n int"
        ),
        f"{purpose}-superkmers",
    )
    count = F.count(F.lit(1)).alias("copies")
    if earlier:
        several = light.groupBy("key").agg(count, F.min("rid").alias("lo"), F.max("rid").alias("hi"))
        several = several.where("lo < hi")
    else:
        several = light.groupBy("key").agg(count).where("copies > 1")
    # Written, its size is known: it is broadcast if small, else both sides of the join are shuffled and
    # Spark can split a hash that very many super-k-mers have.
    several = written(several.select("key", (F.col("copies") > HOT).alias("hot")), f"{purpose}-shared")
    shared = (
        light.join(several, "key")
        .groupBy("rid", "th")
        .agg(F.collect_set(F.struct("start", "n", "key", "hot")).alias("shared"))
    )
    emitted = (
        docs.join(shared, ["rid", "th"], "left")
        .select("doc_id", "rid", "th", "text", "shared")
        .mapInArrow(_emit(units), EMITTED)
    )
    emitted = written(emitted, f"{purpose}-emitted", "kind")

    strings = emitted.where(F.col("kind") == STRING).select(
        "key", "doc_id", "rid", "th", "start", "n", "packed"
    )
    found = _sorted_by_key(strings).mapInArrow(compare, FOUND)
    found = found.select("rid", "th", F.array(F.struct("start", "n")).alias("found"))
    found = found.unionByName(_hot_windows(emitted, units, earlier, purpose))
    of_text = found.groupBy("rid", "th").agg(F.flatten(F.collect_list("found")).alias("found"))
    texts = emitted.where(F.col("kind") == TEXT).select(
        "doc_id", "rid", "th", F.col("packed").alias("text")
    )
    done = emitted.where(F.col("kind") == DONE).select("doc_id", "n_units", "kept_sha256")
    return Repeats(done, texts.join(of_text, ["rid", "th"], "left"))


def _hot_windows(emitted: DataFrame, units: Units, earlier: bool, purpose: str) -> DataFrame:
    """rid, th, found (start and number of windows) of the buckets above HOT."""
    hot = emitted.where(F.col("kind") == HOT_STRING)
    distinct = hot.groupBy("packed").agg(
        F.sum(F.size("starts")).alias("copies"), F.min("doc_id").alias("first")
    )
    windows = written(
        distinct.mapInArrow(
            _window_hashes(units),
            "a long, b long, pa long, pb long, offset int, copies long, first long",
        ),
        f"{purpose}-hot-windows",
    )
    sums = windows.groupBy("a", "b").agg(
        F.sum("copies").alias("total"), F.min("first").alias("lowest")
    )
    lowest = F.col("lowest") if earlier else F.lit(0).cast("long")
    sums = written(
        sums.where("total > 1").select("a", "b", lowest.alias("lowest")), f"{purpose}-hot-shared"
    )
    same = (
        windows.join(sums, ["a", "b"])
        .groupBy("pa", "pb")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "lowest"))).alias("windows"))
        .mapInArrow(_merge, "pa long, pb long, runs array<struct<offset:int,n:int,lowest:long>>")
    )
    rows = hot.select("doc_id", "rid", "th", "starts", "packed").mapInArrow(
        _string_ids, "pa long, pb long, doc_id long, rid long, th long, starts array<long>"
    )
    runs = F.col("runs")
    if earlier:
        runs = F.filter(runs, lambda r: r["lowest"] < F.col("doc_id"))
    each = F.transform(
        "starts",
        lambda s: F.transform(
            "kept", lambda r: F.struct((s + r["offset"]).alias("start"), r["n"].alias("n"))
        ),
    )
    joined = rows.join(same, ["pa", "pb"]).withColumn("kept", runs).where(F.size("kept") > 0)
    return joined.select("rid", "th", F.flatten(each).alias("found"))


def covered(found: list[dict] | None, n_units: int, k: int) -> np.ndarray:
    """Which units lie in a found window."""
    edge = np.zeros(n_units + 1, np.int32)
    for f in found or ():
        edge[f["start"]] += 1
        edge[f["start"] + f["n"] - 1 + k] -= 1
    return np.cumsum(edge[:-1]) > 0
