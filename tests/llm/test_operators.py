"""Each operator against its plain version: NULLs, empty and long texts, ties, repeats, clashing names."""

import math
from importlib import resources

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from saleslake.llm import (
    attention, bpe, html, license_wordings, licenses, lm, mixing, neighbours, quality_rules, simhash, substring_dedup,
    suffix_dedup, superkmers,
)
from tests.llm import brute

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def key(row):
    return tuple((x is None, x) for x in row)


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=key)


def test_license_scan(table):
    notice, mit = "Licensed under CC BY-NC 4.0.", "Released under the MIT License."
    rows = [
        (1, f"before {notice} after\n{mit}", "a"),
        (2, "license to copy and permission to warrant", "a"),
        (3, None, "a"),
        (3, "", "a"),
        (4, licenses.TEMPLATES[3][1].upper().replace(" ", "\n"), "a"),
        (5, "This work is licensed under the GNU General Public License, version 4.", "a"),
        (6, f"{notice} " * 60, "a"),
        (6, notice, "a"),
        (None, "x " * 50_000 + mit, "a"),
    ]
    found = rows_of(licenses.scan(table(rows)), "doc_id", "license")
    expected = [(1, "CC-BY-NC-4.0"), (1, "MIT"), (4, "MIT"), (None, "MIT")]
    assert found == sorted(expected + [(6, "CC-BY-NC-4.0")] * 61, key=key)
    assert licenses.scan(table([])).count() == 0


def test_alignment_counts_differences():
    template = "a b c d".split()
    assert licenses.align(template, "x a b c d y".split())[:3] == (0, 1, 5)
    assert licenses.align(template, "x a q c d y".split())[0] == 1
    assert licenses.align("version 3".split(), "version 2".split())[3]


@pytest.mark.parametrize("size", [1_000, 5_000, 20_000])
def test_a_notice_in_a_long_legal_text_is_found(table, size):
    rng = np.random.default_rng(size)
    stock = [f"w{k}" for k in rng.integers(0, 4_000, size)]
    stock[::65] = ["license"] * len(stock[::65])  # signal words all along
    notices = [text for name, text in licenses.TEMPLATES if name in ("GPL-2.0-or-later", "ISC", "CC-BY-NC-4.0")]
    rows = [(k, " ".join([*stock[: size // 2], text, *stock[size // 2 :]]), "a") for k, text in enumerate(notices)]
    found = licenses.scan(table(rows)).collect()
    assert {(r.doc_id, r.n_different, r.n_words) for r in found} == {
        (k, 0, len(licenses.normal_words(text))) for k, text in enumerate(notices)
    }
    assert all(r.gain > 0.9 for r in found)


def test_a_stretch_with_a_telling_difference_hides_no_other(table):
    text = dict(reversed(licenses.TEMPLATES))
    gpl2, gpl3 = text["GPL-2.0-or-later"], text["GPL-3.0-or-later"]
    gpl3 = gpl3.replace("redistribute it", "share it").replace("published by", "issued by")
    rows = [(1, f"{gpl2} license {gpl3}", "a"), (2, f"{gpl3} {gpl2} {gpl3}", "a")]
    found = rows_of(licenses.scan(table(rows)), "doc_id", "occurrence", "license", "n_different")
    two, three = ("GPL-2.0-or-later", 0), ("GPL-3.0-or-later", 2)
    assert found == [(1, 1, *two), (1, 2, *three), (2, 1, *three), (2, 2, *two), (2, 3, *three)]
    near = "a b version 3 q r a x b version 2 q r".split()
    different, _, end, told = licenses.align("a b version 2 q r".split(), near)
    assert (different, end, told) == (1, 13, False)


def test_common_wordings_of_licenses():
    scanner = licenses.Scanner()

    def names(text):
        return [hit[0] for hit in scanner.scan(text)]

    assert min(len(t.words) for t in scanner.templates) >= licenses.HEAD
    for text, expected in (
        ("Licensed under MIT License", ["MIT"]),
        ("It is licensed under MIT.", ["MIT"]),
        ("He studied under MIT professors", []),
        ("under the terms of the GNU LGPL v3 or later", ["LGPL-3.0-or-later"]),
        ("released under GPLv2+; see", ["GPL-2.0-or-later"]),
        ("released under GPLv2; see", ["GPL-2.0-only"]),
        ("licensed under CC BY-SA 3.0", ["CC-BY-SA-3.0"]),
        ("under the Artistic License 2.0", ["Artistic-2.0"]),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0 WITH LLVM-exception) AND GPL-2.0+\nor not",
         ["MIT", "Apache-2.0", "GPL-2.0-or-later"]),
        ("SPDX-License-Identifier: EUPL-1.2.", ["EUPL-1.2"]),
    ):
        assert names(text) == expected, text
    agpl = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    )
    lesser = agpl.replace("program", "library").replace("Affero", "Lesser").replace("version 3", "version 2.1")
    assert names(f"x {agpl} y {lesser}") == ["AGPL-3.0-or-later", "LGPL-2.1-or-later"]


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0"])
def test_full_license_texts(name):
    file = resources.files("saleslake.llm") / "license_texts" / f"{name}.txt"
    words = file.read_text(encoding="utf-8").split()
    words[200::40] = ["changed"] * len(words[200::40])
    found = licenses._scanner(licenses.TEMPLATES).scan(" ".join(["before"] * 300 + words + ["after"] * 300))
    best = max(found, key=lambda hit: hit[4] - hit[3])
    assert best[0] == license_wordings._TEXTS[name] and best[2] > 0 and best[4] - best[3] > 0.9 * len(words)


def test_the_size_reduction_picks_the_winner(monkeypatch):
    first = [f"word{chr(97 + k)}" for k in range(20)]
    second = ["other" if k in (4, 14) else word for k, word in enumerate(first)]
    templates = (("First", " ".join(first)), ("Second", " ".join(second)))
    assert [hit[0] for hit in licenses.Scanner(templates).scan("x " + " ".join(first))] == ["First"]
    assert [hit[0] for hit in licenses.Scanner(templates).scan(" ".join(second) + " x")] == ["Second"]
    saved = licenses.Template.saved
    monkeypatch.setattr(licenses.Template, "saved", lambda self, words: -10 * saved(self, words))
    # both are confirmed word by word; the rank alone decides
    assert [hit[:1] + hit[2:3] for hit in licenses.Scanner(templates).scan(" ".join(first))] == [("Second", 2)]


def test_license_scan_equals_every_template_on_every_stretch():
    rng = np.random.default_rng(7)
    stock = [chr(97 + k // 26) + chr(97 + k % 26) + "x" for k in range(300)]
    base = [stock[k] for k in rng.integers(0, 300, 34)]
    variant = [*base[:9], "changed", *base[10:24], "also", *base[25:]]
    texts = [base[:24], base, variant, [stock[k] for k in rng.integers(0, 300, 12)], ["three", "plain", "words"]]
    templates = tuple((f"L{k}", " ".join(words)) for k, words in enumerate(texts))
    scanner = licenses.Scanner(templates)
    for _ in range(60):
        words: list[str] = []
        for k in rng.integers(0, len(texts), 3):
            words += [stock[x] for x in rng.integers(0, 300, rng.integers(0, 6))]
            copy = list(texts[k])
            for _ in range(rng.integers(0, 5)):
                at = rng.integers(0, len(copy))
                copy[at : at + rng.integers(0, 2)] = ["edit"] * rng.integers(0, 2)
            words += copy
        found = [(hit[0], hit[3], hit[4], hit[2]) for hit in scanner.scan(" ".join(words))]
        wanted = brute.licenses_in(words, templates, licenses.MAX_DIFFERENT, licenses.LEVEL, licenses.CLOSE)
        assert [(name, different) for name, _, _, different in found] == [(name, different) for name, _, _, different in wanted]
        assert all(a < end and begin < b for (_, a, b, _), (_, begin, end, _) in zip(found, wanted, strict=True))


def test_a_text_of_many_licenses_is_scanned_block_by_block(monkeypatch):
    gpl = resources.files("saleslake.llm") / "license_texts" / "GPL-3.txt"
    words = licenses.normal_words(gpl.read_text(encoding="utf-8"))
    words[100::25] = ["changed"] * len(words[100::25])
    aligned = []
    align = licenses.align
    monkeypatch.setattr(licenses, "align", lambda *a: aligned.append(1) or align(*a))
    found = licenses.Scanner().scan(" ".join((words + ["between"] * 50) * 5))
    assert [hit[0] for hit in found] == ["GPL-3.0-only"] * 5
    assert len(aligned) < 100


def test_bpe_equals_the_library(table, messy):
    long = [(200, "a" * 9_000, "x"), (201, "<|endoftext|>'re " * 900 + "!" * 5_000, "x"), (200, "a" * 9_000, "x")]
    rows = messy + long
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    expected = sorted(((d, *brute.bpe(t)) for d, t, _ in rows), key=key)
    for piece in (300, bpe.PIECE):
        assert rows_of(bpe.round_trip(table(rows), TOKENIZER, piece), *names) == expected
    assert bpe.round_trip(table([]), TOKENIZER).count() == 0


@pytest.fixture(scope="module")
def own():
    with open(TOKENIZER, encoding="utf-8") as f:
        return bpe.Codec(f.read())


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet="aabthein", min_size=2, max_size=90), most=st.integers(1, 9))
def test_tree_concatenation(own, text, most):
    parts = [own.encode_word(p) for p in bpe.halves(text, most)]
    assert own.join(parts) == own.encode_word(text)


def test_neighbours_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    vectors = (centres[rng.integers(0, 40, 900)] + rng.normal(0, 0.4, (900, 16))).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    data += [(1000 + i, vectors[0].tolist()) for i in range(60)]  # copies of a query
    data += [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (None, vectors[1].tolist()),
             (2150, [1.0, None] * 8), (2200, []), (5, vectors[5].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("h", F.lit(1))
    out = neighbours.search(df, F.col("vec_id") % 50 == 0).collect()
    good = {i: np.array(v, np.float64) for i, v in data if i is not None and i < 2000}
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    hits = wanted = 0
    for q in [i for i in ids.tolist() if i % 50 == 0]:
        score = np.round(x @ x[np.searchsorted(ids, q)], 12)
        best = [i for i in ids[np.lexsort((ids, -score))].tolist() if i != q][:5]
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(a.score >= b.score - 1e-12 for a, b in zip(mine, mine[1:], strict=False))
        hits, wanted = hits + len({r.vec_id for r in mine} & set(best)), wanted + 5
    assert {r.query_id for r in out} == {i for i in ids.tolist() if i % 50 == 0}
    assert hits >= 0.9 * wanted
    assert [r.vec_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == 0] == list(range(1000, 1005))
    few = neighbours.search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert neighbours.search(df.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0


def test_multi_index_finds_every_code_within_the_radius():
    codes = np.random.default_rng(1).integers(0, 256, (500, 8), dtype=np.uint8)
    codes[100:200] = codes[:100] ^ 1
    index = superkmers and neighbours.MultiIndex(codes)
    for radius in (0, 3, 9, 20, 26, 64):
        for q in range(5):
            exact = np.flatnonzero(neighbours.distances(codes, codes[q]) <= radius)
            assert index.within(codes[q], radius).tolist() == exact.tolist()


def test_quality_rules(table, messy):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    expected = sorted(((d, *brute.quality(t)) for d, t, _ in messy), key=key)
    assert rows_of(quality_rules.verdict(table(messy)), *names) == expected
    kept = quality_rules.kept(table(messy))
    assert kept.columns == table(messy).columns
    assert rows_of(kept, "doc_id", "text") == sorted(
        ((d, t) for d, t, _ in messy if brute.quality(t)[-1]), key=key
    )
    assert quality_rules.verdict(table([])).count() == 0


@pytest.mark.parametrize("hot", [superkmers.HOT, 1])
def test_substring_dedup(table, messy, monkeypatch, hot):
    monkeypatch.setattr(superkmers, "HOT", hot)
    plain = brute.substrings(messy, 50)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows_of(substring_dedup.dedup(table(messy)), *names) == sorted((r[:4] for r in plain), key=key)
    if hot > 1:
        cut = substring_dedup.cut(table(messy))
        expected = [(r[0], " ".join(r[4]) if r[2] else t) for r, (_, t, _) in zip(plain, messy, strict=True)]
        assert cut.columns == table(messy).columns
        assert rows_of(cut, "doc_id", "text") == sorted(expected, key=key)
    assert substring_dedup.dedup(table([])).count() == 0


@pytest.mark.parametrize("hot", [superkmers.HOT, 1])
def test_suffix_dedup(table, messy, monkeypatch, hot):
    monkeypatch.setattr(superkmers, "HOT", hot)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    found = rows_of(suffix_dedup.dedup(table(messy)), *names)
    assert found == sorted(brute.suffixes(messy, 400), key=key)
    assert suffix_dedup.dedup(table([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=6, max_size=60).map(str.encode), min_size=1, max_size=6))
def test_interval_expansion(strings):
    strings = list(dict.fromkeys(strings))
    seen = [s[i : i + 6] for s in strings for i in range(len(s) - 5)]
    flags = suffix_dedup.repeated_starts(strings, [1] * len(strings), 6)
    expected = [[seen.count(s[i : i + 6]) > 1 for i in range(len(s) - 5)] for s in strings]
    assert [f.tolist() for f in flags] == expected


PAGE = """<html><head><title>T</title><style>x</style></head><body><header><h1>Site</h1></header>
<div id=cookie-notice>We use cookies</div><nav><a href=x>menu</a></nav><div class="page">
<div class="sidebar">side</div><div class="post-body{n}"><h1>Title &amp; more {n}</h1>
<p>Hello <b>wor</b>ld, this is the &lt;text&gt;.<p>Second para with <a href="y">a link</a><br>after break
<form>f</form><div class="ad-box">buy</div><script>var t="</p>"</script></div>
<div class="comments"><p>A reader's comment that is much longer than the article itself, really, it is.</p>
</div></div><footer>f</footer>"""
MAIN = "Title & more {n} Hello world, this is the <text>. Second para with a link after break"


def test_html_text(spark):
    data = [(n, f"https://News.example.com/{n}", PAGE.replace("{n}", str(n))) for n in range(6)]
    data += [
        (10, "https://news.example.com/x", None),
        (11, None, ""),
        (12, "https://news.example.com/other", "<body><main><p>Another   template</p></main><aside>no</aside>"),
        (12, "https://news.example.com/other", "<body><main><p>Another   template</p></main><aside>no</aside>"),
        (13, "nothing", "no markup at all &eacute; <"),
        (14, "http://big.org/", "<article>" + "<p>long text here</p>" * 20_000),
        (None, "http://big.org/", "<div><!-- never closed"),
    ]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit(1))
    out = {r.page_id: r for r in html.main_text(df.withColumn("winners", F.lit(2))).collect()}
    for n in range(6):
        assert out[n].text == MAIN.replace("{n}", str(n))
    assert out[10].text == out[11].text == out[None].text == ""
    assert out[12].text == "Another template" and out[13].text == "no markup at all é <"
    assert out[14].n_chars == len("long text here ") * 20_000 - 1
    assert html.main_text(df).count() == len(data) and html.main_text(df.limit(0)).count() == 0


BODY = "<p>A paragraph that is the article of this page, with some words.</p>"
SAID = "A paragraph that is the article of this page, with some words."


@pytest.mark.parametrize(
    "wrapper",
    ["content-sidebar-wrap", "has-sidebar", "no-sidebar", "ad-free", "elementor-widget-container", "search-result-page",
     "form-wrapper", "social-science"],
)
def test_html_wrappers_hide_no_article(wrapper):
    around = f"<nav>menu</nav><div class='{wrapper}'>%s<div class=sidebar>side</div><div class=ads>buy</div></div>"
    for inner in (f"<article>{BODY}</article>", f"<main>{BODY}</main>", f"<div class=text>{BODY}</div>"):
        found = html.Page(around % inner).main_text([])
        assert found == SAID, found
    comments = f"<div id=comments><article class=comment>{'A long comment. ' * 40}</article></div>"
    assert html.Page((around % f"<article>{BODY}</article>") + comments).main_text([]).startswith("A paragraph")


def test_html_forms_svg_and_custom_elements():
    for page in (
        f"<body><form action=x><div id=main>{BODY}</div></form></body>",
        f"<body><svg viewBox='0 0 1 1'/><div>{BODY}</div></body>",
        f"<body><svg/><div>{BODY}</div><svg><text>no</text></svg></body>",
        f"<body><object-viewer>{BODY}</object-viewer></body>",
        f"<body><template-x></template-x><div>{BODY}</div></body>",
        f"<head><title>T</title></head><body><aside>{BODY}</aside></body>",
    ):
        assert html.Page(page).main_text([]) == SAID, page


@pytest.mark.parametrize("subtree", [simhash.SUBTREE, 2])
def test_simhash(table, messy, monkeypatch, subtree):
    monkeypatch.setattr(simhash, "SUBTREE", subtree)
    plain = brute.linked(messy)
    found = rows_of(simhash.near_duplicates(table(messy)), "doc_id", "fingerprint", "component_id")
    assert found == sorted((r[:3] for r in plain), key=key)
    kept = simhash.one_of_each(table(messy))
    assert kept.columns == table(messy).columns
    groups = {}
    for row in plain:
        groups.setdefault(row[3], []).append(row[0])
    first = [min(g, key=lambda d: (d is None, d or 0)) for g in groups.values()]
    assert sorted(rows_of(kept, "doc_id")) == sorted((d,) for d in first) or any(d is None for d in first)
    assert kept.count() == len(groups)
    assert simhash.near_duplicates(table([])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.lists(st.integers(0, 63), max_size=30))
def test_trie_traversal_finds_every_pair(seeds, flips):
    values = set(seeds)
    for k, bit in enumerate(flips):
        values.add(sorted(values)[k % len(values)] ^ (1 << bit))
    v = np.array(sorted(values), np.uint64)
    i, j = simhash.traverse(v, ([0], [len(v)], [0], [len(v)]), 3, 0)
    expected = {(a, b) for a in range(len(v)) for b in range(a) if int(v[a] ^ v[b]).bit_count() <= 3}
    assert {(max(p), min(p)) for p in zip(i.tolist(), j.tolist(), strict=True)} == expected


def test_lm_scores(table, messy):
    out = lm.scores(table(messy), RANKS, public_tokenizers.PATTERN)
    found = rows_of(out, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    expected = sorted(brute.base_scores(messy), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(found, expected, strict=True))
    scores = {r.doc_id: r.score for r in out.collect()}
    assert all(math.isfinite(s) and s < 0 for s in scores.values())
    assert math.isclose(scores[105], scores[106], rel_tol=1e-6)  # equal texts
    assert lm.scores(table([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_lm_learns_from_all_training_documents(table):
    words = "time people way water day house man world school state year family city room night word book".split()
    rows = [(i, " ".join(words[k] for k in _chain(120, i)), "a") for i in range(350)]
    out = lm.scores(table(rows).coalesce(2), RANKS, public_tokenizers.PATTERN).where("held_out").collect()
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)  # held-out bits a word


def test_rare_ids_depend_on_the_context():
    counts = np.array([500] * 16 + [1] * 84)
    vocab = attention.vocabulary(counts, 4)
    p = attention.initial(vocab)
    text = np.array([1, 40, 2, 70] * 400)  # 40 and 70 are no frequent ids, what precedes tells them apart
    optimiser, lengths = attention.Adam(p, 0.01), np.array([len(text)])
    owner, first = attention.windows(lengths)
    for a in list(range(0, len(owner), 16)) * 30:
        shapes = attention.cut(vocab.slot[text], vocab.begin, lengths, owner[a : a + 16], first[a : a + 16])
        optimiser.step(attention.gradients(p, *shapes)[1])
    scorer = attention.Scorer(p, vocab)

    def log10(*ids):
        return scorer.log10(np.array(ids), np.array([len(ids)]))[0]

    assert log10(1, 40) > log10(1, 70) + 1 and log10(1, 40, 2, 70) > log10(1, 40, 2, 40) + 1
    each = [log10(1, i) for i in range(100)]
    assert math.isclose((10 ** (np.array(each) - log10(1))).sum(), 1, rel_tol=1e-4)


def test_a_training_step_takes_no_softmax_per_class_or_group(monkeypatch):
    counts = np.array([500] * 16 + [1] * 84)
    vocab = attention.vocabulary(counts, 4)
    p = {k: a.astype(np.float32) for k, a in attention.initial(vocab).items()}
    rng = np.random.default_rng(3)
    for name in ("class_w", "slot_w", "group_w", "inner_w"):
        p[name] += rng.normal(0, 0.3, p[name].shape).astype(np.float32)
    h, targets = rng.normal(0, 1, (300, attention.WIDTH)).astype(np.float32), vocab.slot[rng.integers(0, 100, 300)]
    calls, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda *a, **k: calls.append(1) or exp(*a, **k))
    found, g, back = attention.log_probabilities(p, h, targets, gradient=True)
    assert len(calls) == 8  # two each for classes, their slots, groups and their slots, however many parts these have
    assert np.allclose(found, attention.log_probabilities(p, h, targets), rtol=1e-5)
    each = len(p["slot_b"]) // 4
    for k in range(0, 300, 7):  # a row by itself, in double precision
        x, t = h[k].astype(float), int(targets[k])
        kind = min(t // each, 4)
        parts = [(p["class_w"], p["class_b"], kind)]
        if kind < 4:
            own = slice(kind * each, (kind + 1) * each)
            parts.append((p["slot_w"][own], p["slot_b"][own], t - kind * each))
        else:
            group, place = divmod(t - len(p["slot_b"]), p["inner_b"].shape[1])
            parts += [(p["group_w"], p["group_b"], group), (p["inner_w"][group], p["inner_b"][group], place)]
        z = [(w.astype(float) @ x + b, at) for w, b, at in parts]
        assert math.isclose(sum(y[at] - np.logaddexp.reduce(y) for y, at in z), found[k], rel_tol=1e-4)
        dh = sum(exp(y - np.logaddexp.reduce(y)) @ w - w[at] for (y, at), (w, _, _) in zip(z, parts, strict=True))
        assert np.allclose(dh / 300, back[k], rtol=1e-3, atol=1e-6)
    loss = lambda: -attention.log_probabilities(p, h, targets).mean()
    for name in ("class_w", "class_b", "slot_w", "slot_b", "group_w", "group_b", "inner_w", "inner_b"):
        rows, d = g[name] if isinstance(g[name], tuple) else (np.arange(len(p[name])), g[name])
        for at in zip(*np.unravel_index(np.argsort(-np.abs(d), axis=None)[[0, 3, 9 % d.size]], d.shape), strict=True):
            place, old = (rows[at[0]], *at[1:]), p[name][(rows[at[0]], *at[1:])]
            p[name][place] = old + 0.05
            up = loss()
            p[name][place] = old - 0.05
            down = loss()
            p[name][place] = old
            assert math.isclose((up - down) / 0.1, d[at], rel_tol=0.02, abs_tol=1e-6), (name, at)


def _chain(n, seed):
    rng = np.random.default_rng(seed)
    ids = [0]
    for _ in range(n):
        ids.append((ids[-1] * 3 + int(rng.integers(0, 2))) % 17)
    return np.array(ids)


def test_attention_learns_and_is_a_distribution():
    train, test = _chain(4_000, 1), _chain(600, 2)
    vocab = attention.vocabulary(np.bincount(train, minlength=40), 4)
    p = attention.initial(vocab)
    before = attention.Scorer(p, vocab).log10(test, np.array([len(test)]))[0]
    optimiser, lengths = attention.Adam(p, 0.01), np.array([len(train)])
    owner, first = attention.windows(lengths)
    for a in list(range(0, len(owner), 16)) * 6:
        shapes = attention.cut(vocab.slot[train], vocab.begin, lengths, owner[a : a + 16], first[a : a + 16])
        optimiser.step(attention.gradients(p, *shapes)[1])
    scorer = attention.Scorer(p, vocab)
    after = scorer.log10(test, np.array([len(test)]))[0]
    assert after > 0.7 * before  # held-out text; the chain has one bit a step
    # The probabilities of every next id add up to one.
    ends = [np.append(test[:20], i) for i in range(40)]
    each = scorer.log10(np.concatenate(ends), np.full(40, 21))
    assert math.isclose((10 ** (each - scorer.log10(test[:20], np.array([20]))[0])).sum(), 1, rel_tol=1e-4)
    # Each place is scored once, wherever the windows lie: causal, so a longer text adds only its end.
    one = attention.log_probabilities
    inputs = attention.cut(vocab.slot[test], vocab.begin, np.array([len(test)]), *attention.windows(np.array([len(test)])))
    h, _ = attention.hidden(p, inputs[0], inputs[1])
    plain = one(p, h[inputs[3]], inputs[2][inputs[3]]).sum() + vocab.rest_log[test].sum()
    assert math.isclose(plain / math.log(10), after, rel_tol=1e-4)


def test_mixing(table, messy):
    out = mixing.mix(table(messy))
    found = rows_of(out, "doc_id", "size", "source_size", "target", "repeats")
    expected = sorted(brute.mix(messy), key=key)
    assert [(*a[:3], a[4]) for a in found] == [(*b[:3], b[4]) for b in expected]
    assert all(math.isclose(a[3], b[3], rel_tol=1e-9) for a, b in zip(found, expected, strict=True))
    assert max(r[4] for r in found) <= 3
    mixed = mixing.mixed(table(messy))
    assert mixed.columns == table(messy).columns
    assert mixed.count() == sum(r[4] for r in found)
    assert mixing.mix(table([])).count() == 0


def test_mixing_tells_rows_without_an_id_apart(table):
    rows = [(None, f"no id {k} " + "w " * (k % 50), "b") for k in range(400)]
    rows += [(7, f"one id {k} " + "w " * (k % 50), "c") for k in range(400)] + [(k, "a b c", "a") for k in range(3_000)]
    found = mixing.mix(table(rows)).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= 53 for r in found.collect())  # the longest document


def test_components_of_a_path(spark):
    from saleslake.llm.components import components

    n = 200
    order = np.random.default_rng(0).permutation(n).tolist()
    edges = [*zip(order, order[1:], strict=False), (500, 501), (502, 501), (600, 600)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {k: 0 for k in range(1, n)} | {501: 500, 502: 500}
