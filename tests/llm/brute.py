"""Plain versions of the operators, for small tables. Rows are (doc_id, text, source)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import public_tokenizers
import xxhash
import zstandard
from tokenizers import Tokenizer

from saleslake.llm.quality_rules import STOP_WORDS

_TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def bpe(text):
    ids = _TOKENIZER.encode(text or "", add_special_tokens=False).ids
    decoded = _TOKENIZER.decode(ids, skip_special_tokens=False)
    return len(ids), sha(" ".join(map(str, ids))), sha(decoded)


def quality(text):
    w, n = words(text), len(words(text))
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k in range(n - 2) for d in range(3) if windows[tuple(w[k : k + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if words(x)]
    chars, symbols = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or ""))
    dup, stop = len(lines) - len(set(lines)), sum(x in set(STOP_WORDS) for x in w)
    failed = n < 50 or 2 * len(covered) > n
    kept = not failed and 5 * n <= 2 * chars <= 24 * n and 10 * symbols <= n
    kept = kept and 25 * stop >= n and 2 * dup <= len(lines)
    return n, chars, symbols, dup, len(covered), failed, kept


def substrings(rows, k):
    """(n_words, n_removed, kept_sha256, kept words) by row."""
    least = {}
    for doc_id, text, _ in rows:
        w = words(text)
        for j in range(len(w) - k + 1) if doc_id is not None else ():
            window = tuple(w[j : j + k])
            least[window] = min(doc_id, least.get(window, doc_id))
    out = []
    for doc_id, text, _ in rows:
        w, gone = words(text), set()
        for j in range(len(w) - k + 1) if doc_id is not None else ():
            if least[tuple(w[j : j + k])] < doc_id:
                gone.update(range(j, j + k))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((doc_id, len(w), len(gone), sha(" ".join(kept)), kept))
    return out


def suffixes(rows, k):
    seen = Counter()
    for _, text, _ in rows:
        b = (text or "").encode()
        seen.update(b[j : j + k] for j in range(len(b) - k + 1))
    out = []
    for doc_id, text, _ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - k + 1):
            if seen[b[j : j + k]] > 1:
                gone[j : j + k] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])[: len(b)]).sum()) if b else 0
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((doc_id, len(b), int(gone.sum()), spans, sha(kept)))
    return out


def fingerprint(text, size=3):
    w = words(lower(text))
    shingles = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, bits=3):
    """(doc_id, fingerprint, component_id, component) by row; the component is a number."""
    prints = [fingerprint(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [
        (doc_id, f"{prints[i]:016x}", least.get(find(i)), find(i)) for i, (doc_id, _, _) in enumerate(rows)
    ]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def base_scores(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        if not held_out(doc_id):
            counts.update([*words(lower(text)), ""])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text, _ in rows:
        tokens = [*words(lower(text)), ""]
        score = sum(log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((doc_id, held_out(doc_id), len(tokens), sum(t in counts for t in tokens), n, score))
    return out


def targets(sizes):
    """Targets by source: shares by weight, cut at three times the size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] >= 3 * sizes[s]}
        if not over:
            return target | {s: rate * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def mix(rows):
    """(doc_id, size, source_size, target, repeats) by row."""
    sizes, cells = Counter(), defaultdict(Counter)
    code = [int(hashlib.md5(f"{'' if d is None else d}\n{t or ''}".encode()).hexdigest()[:9], 16) for d, t, _ in rows]
    for h, (_, text, source) in zip(code, rows, strict=True):
        sizes[source] += len(words(text))
        cells[source][h] += len(words(text))
    target = targets(sizes)
    once = defaultdict(set)
    for source, cell in cells.items():
        rest = target[source] - target[source] // sizes[source] * sizes[source] if sizes[source] else 0
        for h in sorted(cell):
            if cell[h] <= rest or 2 * rest >= cell[h]:
                once[source].add(h)
            if cell[h] > rest:
                break
            rest -= cell[h]
    out = []
    for h, (doc_id, text, source) in zip(code, rows, strict=True):
        full = int(target[source] // sizes[source]) if sizes[source] else 0
        out.append((doc_id, len(words(text)), sizes[source], target[source], full + (h in once[source])))
    return out


def edits(a, b):
    """Insertions, deletions and replacements between two lists."""
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def licenses_in(words, templates, share, level, margin):
    """(license, begin, end, differences) by every template on every stretch of a short text, most bytes saved first."""
    found = []
    for name, text in templates:
        template = text.split()
        most = int(share * len(template))
        same = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=2 * len(text), dict_size=len(text), write_content_size=False
        )
        known = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        for begin in range(len(words)):
            near = []
            for size in range(len(template) - most, len(template) + most + 1):
                if begin + size <= len(words):
                    near.append((edits(template, words[begin : begin + size]), begin + size))
            different, end = min(near, default=(most + 1, 0))
            if different > most:
                continue
            block = " ".join(words[max(0, begin - most) : begin + len(template) + most]).encode()
            alone = len(zstandard.ZstdCompressor(compression_params=same).compress(block))
            given = len(zstandard.ZstdCompressor(compression_params=same, dict_data=known).compress(block))
            found.append((given - alone, -len(template), name, different, begin, end))
    found.sort(key=lambda x: (x[3], x[4]))
    nearest = []  # of the stretches of one template that meet, the nearest stands for all
    for hit in found:
        if all(hit[2] != other[2] or hit[5] <= other[4] or other[5] <= hit[4] for other in nearest):
            nearest.append(hit)
    kept = []
    for first in sorted(nearest):
        free = [x for x in nearest if all(x[5] <= a or b <= x[4] for _, a, b, _ in kept)]
        if first in free:
            close = [x for x in free if 0 <= x[0] - first[0] <= margin and x[4] < first[5] and first[4] < x[5]]
            _, _, name, different, begin, end = min(close, key=lambda x: (x[3], x[1], x[0]))
            kept.append((name, begin, end, different))
    return sorted(kept, key=lambda x: x[1])
