"""Source divergence and filter interaction against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from saleslake.llm import divergence, filter_audit
from tests.llm.conftest import CLASHING, SCHEMA

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def key(row):
    return tuple((x is None, x) for x in row)


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return TERM.findall(lower)


def plain_divergence(rows):
    """rows: (doc_id, text, lang, source)."""
    docs = [(lang or "", source or "", terms(text)) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for _, _, found in mine for t in set(found))
        kept = [t for t, n in in_docs.items() if n >= 3]
        v = len(kept)

        def rate(some):
            counts = Counter(t for found in some for t in found)
            n = sum(counts[t] for t in kept)
            return counts, {t: 1 + 10**9 * (counts[t] + 1) // (n + v) for t in kept}

        _, q = rate([d[2] for d in mine])
        groups = {s: rate([d[2] for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for s, (counts, p) in groups.items():
            pairs = [(o, sum((p[t] - g[t]) ** 2 // g[t] for t in kept)) for o, (_, g) in groups.items() if o != s]
            dear = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", dear, 200)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def divergence_rows(spark, rows, **options):
    from pyspark.sql import functions as F

    data = [(d, t, lang, s, None) for d, t, lang, s in rows]
    df = spark.createDataFrame(data, SCHEMA).select("*", *(F.lit(7).alias(c) for c in CLASHING.split()))
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


def _groups(seed, langs=3, sources=6, docs=90):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdeéßЖ") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = []
    for k in range(docs):
        some = [rng.choice(names) for _ in range(rng.randint(0, 60))]
        some = [w.upper() if rng.random() < 0.1 else w for w in some]
        text = "".join(w + rng.choice(" .,\n9_\x7f@[{") for w in some)
        rows.append((k, text, f"l{rng.randrange(langs)}", f"s{min(rng.randrange(sources), rng.randrange(sources))}"))
    rows += [
        (None, None, None, None), (1, "", "l0", "empty"), (1, "", "l0", None), (1, None, "alone", "x"),
        (7, "same text here", None, "s1"), (7, "same text here", None, "s1"), (8, "Same TEXT", "", "s2"), (9, "ÉÉ same", "", ""),
        (10, "x " * 30_000, "l1", "s0"), (11, "x y x", "l1", "s5"), (12, "x", "l1", "s1"),
    ]
    return rows


@pytest.mark.parametrize(("block", "tile"), [(4096, 64), (16, 3), (5, 1)])
def test_divergence(spark, block, tile):
    rows = _groups(block)
    assert divergence_rows(spark, rows, block=block, tile=tile) == plain_divergence(rows)


def test_a_task_emits_its_sums_in_parts(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "SLICE", 100)
    rows = [(d, t or "", lang or "", s or "") for d, t, lang, s in _groups(2)]
    columns = zip(*((lang, s, t.encode()) for _, t, lang, s in rows), strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "source", "text"])
    n, docs = Counter(), Counter()
    batches = list(divergence._count(iter([batch])))
    for row in (r for b in batches for r in b.to_pylist()):
        n[row["lang"], row["source"], row["term"]] += row["n"]
        docs[row["lang"], row["source"], row["term"]] += row["docs"]
    assert len(batches) > 9
    assert +n == Counter((lang, s, t) for _, text, lang, s in rows for t in terms(text))
    assert +docs == Counter((lang, s, t) for _, text, lang, s in rows for t in set(terms(text)))


def test_divergence_of_nothing(spark):
    assert divergence_rows(spark, []) == []
    rows = [(1, "no term twice", "a", "x"), (2, None, "a", "y")]
    assert divergence_rows(spark, rows) == [("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1)]


def test_equal_subtrees_are_one_node():
    table = np.zeros((3, 8), np.int64)
    table[1, 5] = table[2, 5] = 4
    trees = divergence.Trees(table)
    assert [len(left) for left, _ in trees.levels] == [2, 2, 2]
    assert trees.roots[1] == trees.roots[2] != trees.roots[0]
    which, a, b, times = trees.meetings(0, np.array([1, 2]))
    assert dict(zip(zip(which, trees.leaves[a], trees.leaves[b]), times)) == {
        (0, 0, 0): 7, (0, 0, 4): 1, (1, 0, 0): 7, (1, 0, 4): 1,
    }


def test_rates_are_exact_beyond_64_bits():
    counts, divisor = np.array([10**13, 3 * 10**12 + 1, 0, -1]), 10**13 + 12345
    assert divergence.rates(counts, divisor).tolist() == [
        1 + 10**9 * (c + 1) // divisor if c >= 0 else 1 for c in counts.tolist()
    ]


def plain_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    good = {d for d, quality, _ in labels if d is not None and quality == 1}
    toxic = {d for d, _, bad in labels if d is not None and bad == 1}
    judged = []
    for d, text, source in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": d is not None and d > least[text],
        }
        judged.append((source or "", {f for f in "ABCDE" if fails[f]}, d in good, d in toxic))
    out, shares = {}, defaultdict(int)
    for order in map("".join, permutations("ABCDE")):
        for part in {p for p, *_ in judged}:
            left = [x for x in judged if x[0] == part]
            mine = left
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                fail = sum(f in x[1] for x in mine)
                sole = sum(x[1] == {f} for x in mine)
                shares[part, f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), fail - len(gone), sole, sum(x[2] for x in gone), sum(x[3] for x in gone),
                ]
    return sorted((*k, *v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def audit_rows(spark, table, rows, labels):
    schema = "doc_id long, quality int, toxic int, n int, rid string"
    frame = spark.createDataFrame([(*x, 1, "z") for x in labels], schema)
    return sorted(tuple(r) for r in filter_audit.audit(table(rows), frame).collect())


def test_filter_audit(spark, table, messy):
    rng = random.Random(3)
    rows = [*messy, (None, "a text without id", "s1"), (900, "a text without id", "s1"), (901, "a text without id", "s2")]
    rows += [(500 + k, "w " * 250 + f"u{k}", rng.choice(["s1", None])) for k in range(20)]
    rows += [(600 + k, " ".join(f"v{j}" for j in range(210 + k % 2)), "s1") for k in range(9)]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in rows]
    labels += [(105, 1, 1), (105, 1, 1), (None, 1, 1), (123_456, 1, 1)]
    assert audit_rows(spark, table, rows, labels) == plain_audit(rows, labels)
    assert audit_rows(spark, table, [], labels) == []


def test_shapley_values_share_all_removals(spark, table, messy):
    found = filter_audit.audit(table(messy), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    removed = Counter()
    for r in found:
        if r.filter_order == "ABCDE":
            removed[r.part] += r.removed
    shares = Counter()
    for part, _, share in {(r.part, r.filter_order[r.step - 1], r.shapley) for r in found}:
        shares[part] += share
    assert shares == {p: n * math.factorial(5) for p, n in removed.items()}
