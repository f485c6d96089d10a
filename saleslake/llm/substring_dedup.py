"""Substring dedup: repeated 50-word passages, found by super-k-mer partitioning.

Every word is removed that lies in a window of WINDOW words whose word sequence also starts in a
document with a smaller doc_id; windows are judged on the input. Consecutive windows with the same
minimiser travel as one packed string to the bucket of that minimiser (``superkmers``); there the
windows are sorted, and equal neighbours give the smallest document exactly.

Edge cases: a NULL, empty or short text keeps all its words; rows that share a doc_id don't remove
each other's words; a row without doc_id neither loses words nor makes others lose them; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.common import boxed, identity
from saleslake.llm.superkmers import (
    Rows, Units, columns, covered, found_batch, groups, repeated_windows, runs_of,
)

WINDOW = 50
#: Words of the minimiser.
PIECE = 8


def _compare(units: Units):
    """FOUND rows of super-k-mers sorted by key: windows that a smaller document has too."""
    k = units.k

    def smallest(strings: dict[bytes, int]) -> dict[bytes, np.ndarray]:
        """For each window of each string the smallest document that has it."""
        windows = []
        for which, (packed, doc) in enumerate(strings.items()):
            gaps = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
            begin = [0, *(gaps + 1).tolist()]
            end = [*gaps.tolist(), len(packed)]
            for i in range(len(begin) - k + 1):
                windows.append((packed[begin[i] : end[i + k - 1]], doc, which, i))
        windows.sort()
        least: dict[tuple[int, int], int] = {}
        before, lowest = None, 0
        for text, doc, which, i in windows:
            if text != before:  # the first of equal windows has the smallest document
                before, lowest = text, doc
            least[which, i] = lowest
        out = {}
        for which, packed in enumerate(strings):
            n = packed.count(b" ") + 2 - k
            out[packed] = np.fromiter((least[which, i] for i in range(n)), np.int64, n)
        return out

    def run(batches):
        for table in groups(batches, "key", 4 << 20):
            out = ([], [], [], [])
            rows = zip(
                *(table.column(c).to_pylist() for c in ("key", "doc_id", "rid", "th", "start", "n", "packed")),
                strict=True,
            )
            bucket: list[tuple] = []

            def flush():
                strings: dict[bytes, int] = {}
                for _, doc, _, _, _, _, packed in bucket:
                    strings[packed] = min(doc, strings.get(packed, doc))
                lowest = smallest(strings) if len(strings) > 1 else None
                for _, doc, rid, th, start, n, packed in bucket:
                    if lowest is None:
                        spans = [(0, n)] if strings[packed] < doc else []
                    else:
                        spans = zip(*runs_of(lowest[packed] < doc), strict=True)
                    for at, length in spans:
                        for part, x in zip(out, (rid, th, start + int(at), int(length)), strict=True):
                            part.append(x)

            for row in rows:
                if bucket and bucket[0][0] != row[0]:
                    flush()
                    bucket.clear()
                bucket.append(row)
            flush()
            yield found_batch(*out)

    return run


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_RESULT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
)
_CHANGED = "rid long, th long, n_removed long, kept_text string"
_CHANGED_SCHEMA = pa.schema(
    [("rid", pa.int64()), ("th", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
)


def _cut(k: int, with_text: bool):
    def run(batches):
        out = Rows(_CHANGED_SCHEMA if with_text else _RESULT_SCHEMA)
        for batch in batches:
            names = ("doc_id", "rid", "th", "text", "found")
            for doc_id, rid, th, text, found in zip(*columns(batch, *names), strict=True):
                words = text.split()
                gone = covered(found, len(words), k)
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
                removed = int(gone.sum())
                if with_text:
                    row = (rid, th, removed, kept.decode())
                else:
                    row = (doc_id, len(words), removed, hashlib.sha256(kept).hexdigest())
                if out.add(row, len(kept) if with_text else 64):
                    yield out.batch()
        yield out.batch()

    return run


def dedup(df: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space)."""
    units = Units(words=True, k=window, m=piece)
    found = repeated_windows(df, units, _compare(units), earlier=True, purpose="substrings")
    done = found.done.selectExpr("doc_id", "n_units AS n_words", "0L AS n_removed", "kept_sha256")
    cut = found.texts.mapInArrow(_cut(window, False), _RESULT)
    return done.unionByName(cut)


def cut(df: DataFrame, window: int = WINDOW, piece: int = PIECE, text: str = "text") -> DataFrame:
    """``df`` without the repeated words, with its own columns.

    A text that loses words becomes its kept words, joined by one space; ``n_chars``, if there, follows. Other texts
    stay as they are.
    """
    units = Units(words=True, k=window, m=piece)
    found = repeated_windows(df, units, _compare(units), earlier=True, purpose="substrings")
    changed = found.texts.where("found IS NOT NULL").mapInArrow(_cut(window, True), _CHANGED)
    changed = changed.where("n_removed > 0").dropDuplicates(["rid", "th"])
    joined = boxed(df, *identity()).join(changed, ["rid", "th"], "left")
    new = F.coalesce("kept_text", f"_row.{text}")
    values = {text: new}
    if "n_chars" in df.columns:
        length = F.char_length("kept_text").cast(df.schema["n_chars"].dataType)
        values["n_chars"] = F.coalesce(length, "_row.n_chars")
    return joined.select(*(values.get(c, F.col(f"_row.`{c}`")).alias(c) for c in df.columns))
