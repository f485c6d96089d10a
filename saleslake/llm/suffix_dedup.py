"""Suffix-array dedup: repeated strings of MIN_BYTES bytes, by a bounded Burrows-Wheeler search.

Every byte is removed that lies in a string of MIN_BYTES bytes that starts anywhere else, in the same
document or another; strings are judged on the input. One suffix array of the whole corpus would not
be distributed, so the text is dealt by minimisers (``superkmers``): strings that can be equal meet in
a bucket. Super-k-mers that are equal as a whole need no search, nor do stretches without a window whose
64-bit hash occurs twice (equal windows have equal hashes, so nothing is lost). For the rest, a suffix array sorted by MIN_BYTES bytes gives the Burrows-Wheeler transform; breadth-first backward
extension of its intervals sets common prefix lengths by increasing value and stops at MIN_BYTES:
neighbours not separated by then share that many bytes.

Edge cases: a NULL text is empty; short texts keep all bytes; repeated rows remove each other;
matches never cross documents and may cut through a character; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.superkmers import (
    Rows, Units, columns, covered, found_batch, groups, repeated_windows, runs_of,
    spans_hash,
)

MIN_BYTES = 400
#: Bytes of the minimiser.
PIECE = 48


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``text`` sorted by at least their first ``depth`` bytes (prefix doubling).

    Only positions that still tie are sorted again.
    """
    n = len(text)
    head = np.zeros(n, np.uint64)
    wide = np.concatenate([text, text[:8]]) if n >= 8 else np.resize(text, n + 8)
    for j in range(8):
        head = (head << np.uint64(8)) | wide[j : j + n]
    order = np.argsort(head, kind="stable")
    new = np.ones(n, bool)
    new[1:] = head[order][1:] != head[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while h < depth:
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        key = rank[tied] * n + rank[(tied + h) % n]
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        group = key // n
        at = np.arange(len(tied))
        first = np.ones(len(tied), bool)
        first[1:] = group[1:] != group[:-1]
        split = np.ones(len(tied), bool)
        split[1:] = key[1:] != key[:-1]
        begin = np.maximum.accumulate(np.where(first, at, 0))
        own = np.maximum.accumulate(np.where(split, at, 0))
        rank[tied] = group + (own - begin)
        h *= 2
    return np.argsort(rank, kind="stable")


def separated(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place of the suffix array, whether it shares less than ``depth`` bytes with the one before.

    Intervals of strings of length l, which grow to the left by one byte a round. An interval whose
    right end is not yet a border makes it one: the common prefix there is l. Only such an interval
    is extended further; each place is set once, so all rounds together touch few intervals.
    """
    n = len(text)
    before = text[(order - 1) % n]
    # Where the rotation that starts one byte earlier stands.
    follow = np.empty(n, np.int64)
    follow[np.argsort(before, kind="stable")] = np.arange(n)
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(depth):
        if not len(low):
            break
        size = high - low
        many = np.repeat(np.arange(len(low)), size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[many]
        key = many * 256 + before[place]
        by = np.argsort(key, kind="stable")
        new = np.ones(len(by), bool)
        new[1:] = key[by][1:] != key[by][:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(by)) - 1
        low, high = follow[place[by[first]]], follow[place[by[last]]] + 1
        fresh = ~border[high]
        low, high = low[fresh], high[fresh]
        border[high] = True
        keep = np.unique(high, return_index=True)[1]
        low, high = low[keep], high[keep]
    return border[:n]


def repeated_starts(strings: list[bytes], copies: list[int], depth: int) -> list[np.ndarray]:
    """For each string and each start of ``depth`` bytes in it: does that occur twice in all?"""
    lengths = np.array([len(s) for s in strings])
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    begin = np.cumsum(lengths + 1) - lengths - 1
    order = suffix_array(text, depth)
    group = np.cumsum(separated(text, order, depth)) - 1
    weight = np.zeros(len(text), np.int64)
    for b, length, c in zip(begin, lengths, copies, strict=True):
        weight[b : b + length - depth + 1] = c
    total = np.bincount(group, weights=weight[order])
    twice = np.empty(len(text), bool)
    twice[order] = total[group] > 1
    return [twice[b : b + length - depth + 1] for b, length in zip(begin, lengths, strict=True)]


def _hashed_twice(search: list[tuple[bytes, list]], units: Units) -> list[np.ndarray]:
    """For each string and each window of it: does the hash of the window occur twice among all?"""
    if not search:
        return []
    sizes = np.array([len(p) for p, _ in search])
    number = sizes - units.k + 1
    begin = np.cumsum(sizes) - sizes
    start = np.arange(number.sum()) + np.repeat(begin - (np.cumsum(number) - number), number)
    values = units.values(np.frombuffer(b"".join([p for p, _ in search]), np.uint8))
    hashes = spans_hash(values, start, start + units.k)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.split(twice, np.cumsum(number)[:-1])


def _compare(units: Units):
    """FOUND rows of super-k-mers sorted by key."""
    names = ("key", "rid", "th", "start", "n", "packed")

    def run(batches):
        for table in groups(batches, "key", 2 << 20):
            buckets: dict[int, dict[bytes, list[tuple]]] = {}
            for key, rid, th, start, n, packed in zip(
                *(table.column(c).to_pylist() for c in names), strict=True
            ):
                rows = buckets.setdefault(key, {}).setdefault(packed, [])
                rows.append((rid, th, start, n))
            out = ([], [], [], [])

            def add(rows, spans):
                for rid, th, start, _ in rows:
                    for at, length in spans:
                        for part, x in zip(out, (rid, th, start + at, length), strict=True):
                            part.append(x)

            search: list[tuple[bytes, list[tuple]]] = []
            for strings in buckets.values():
                for rows in strings.values():
                    if len(rows) > 1:  # equal as a whole
                        add(rows, [(0, rows[0][3])])
                if len(strings) > 1:  # the windows of one string differ from each other
                    search.extend(strings.items())
            # Only stretches whose window hashes occur twice here can hold equal windows.
            cut: dict[bytes, list[tuple]] = {}
            for (packed, rows), flags in zip(search, _hashed_twice(search, units), strict=True):
                for at, n in zip(*(x.tolist() for x in runs_of(flags)), strict=True):
                    part = packed[at : at + n + units.k - 1]
                    cut.setdefault(part, []).extend((rid, th, s + at, n) for rid, th, s, _ in rows)
            if cut:
                copies = [len(rows) for rows in cut.values()]
                twice = repeated_starts(list(cut), copies, units.k)
                for rows, flags in zip(cut.values(), twice, strict=True):
                    start, length = runs_of(flags)
                    add(rows, list(zip(start.tolist(), length.tolist(), strict=True)))
            yield found_batch(*out)

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_RESULT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
     ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _cut(k: int):
    def run(batches):
        out = Rows(_RESULT_SCHEMA)
        for batch in batches:
            for doc_id, text, found in zip(*columns(batch, "doc_id", "text", "found"), strict=True):
                gone = covered(found, len(text), k)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                sha = hashlib.sha256(kept).hexdigest()
                row = (doc_id, len(text), int(gone.sum()), len(runs_of(gone)[0]), sha)
                if out.add(row, 64):
                    yield out.batch()
        yield out.batch()

    return run


def dedup(df: DataFrame, min_bytes: int = MIN_BYTES, piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes)."""
    units = Units(words=False, k=min_bytes, m=piece)
    found = repeated_windows(df, units, _compare(units), earlier=False, purpose="suffixes")
    zero = F.lit(0).cast("long")
    done = found.done.select(
        "doc_id", F.col("n_units").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        "kept_sha256",
    )
    return done.unionByName(found.texts.mapInArrow(_cut(min_bytes), _RESULT))
