"""SentencePiece encoding against the library: random, odd and long texts, ids that no text has, refused models."""

import hashlib
import random

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from saleslake.llm import sentence_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
DATA = open(PATH, "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = sentence_pieces.Codec(DATA)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  ", "▁", "▁▁ a", "<s>hello</s><unk><0x0A>", "\x00a\x00", "a" * 1000, "ab" * 700,
    " " * 100, "\n\n\t x  y   z    w     ", "日本語テキスト 🙂🙂 é", "�﻿", "\r\n", "a.b,c!?d ...e", "x" * 70 + " " + "é" * 70,
]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(text):
    ids = LIBRARY.encode(text or "")
    return len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids))


def _texts(n, seed=1):
    rng, pieces = random.Random(seed), list(OWN.scores)

    def some(alphabet, most):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(1, most)))

    kinds = [
        lambda: some(pieces, 30).replace("▁", " "),
        lambda: some(" aebtin▁\n.", 60),
        lambda: some(" ▁", 90),
        lambda: some("theinoas ", 80),
        lambda: some([chr(c) for c in (*range(0x300), 0x4E00, 0x1F600, 0xFFFD, 0x10FFFF)], 20),
    ]
    return [rng.choice(kinds)() for _ in range(n)]


def test_texts_are_encoded_as_by_the_library():
    texts = ODD + _texts(3000)
    assert [OWN.encode(t) for t in texts] == LIBRARY.encode(texts)
    assert list(sentence_pieces._digests(OWN, pa.array(texts, pa.string()))) == [expected(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    ids = OWN.encode(text)
    assert ids == LIBRARY.encode(text)
    assert OWN.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 260), max_size=9))
def test_any_ids_are_decoded(ids):
    assert OWN.decode(ids) == LIBRARY.decode(ids)


def test_compatible_is_merging_again():
    rng = random.Random(2)
    for _ in range(3000):
        left, right = rng.randrange(len(OWN.texts)), rng.randrange(len(OWN.texts))
        parts = list(OWN.texts[left] + OWN.texts[right])
        while True:
            found = [(-OWN.scores[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in OWN.scores]
            if not found:
                break
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert OWN.compatible(left, right) == (parts == [OWN.texts[left], OWN.texts[right]])


def test_many_segments_at_once_equal_one_by_one():
    segments = sorted({s for t in _texts(800, 7) for s in OWN.segments.findall("▁" + t.replace(" ", "▁")) if s[0] in OWN.number})
    short = [s for s in segments if len(s) <= sentence_pieces.LONGEST]
    assert list(OWN.split_many(short)) == [OWN.split(s) for s in short]


def test_long_unsplit_text():
    rng = random.Random(4)
    text = "".join(rng.choice("theinoas") for _ in range(200_000))
    assert OWN.encode(text) == LIBRARY.encode(text)


def test_round_trip(table, messy, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "PART", 1000)
    rows = [*messy, *((1000 + k, t, "odd") for k, t in enumerate(ODD))]
    found = sentence_pieces.round_trip(table(rows), PATH).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(((d, *expected(t)) for d, t, _ in rows), key=key)
    assert sentence_pieces.round_trip(table([]), PATH).count() == 0
    for r in sentence_pieces.encode(table(rows[:20]), PATH).collect():
        assert r.decoded == LIBRARY.decode(r.ids)


@pytest.mark.parametrize(
    ("old", "new"),
    [(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01"), (b"\x98\x02\x01", b"\x98\x02\x00"), (b"\x18\x01 \x002\x00", b"\x18\x01 \x012\x00")],
    ids=["unigram", "no byte fallback", "removes spaces"],
)
def test_other_models_are_refused(old, new):
    assert DATA.count(old) == 1
    with pytest.raises(ValueError, match="can't be used"):
        sentence_pieces.Model(DATA.replace(old, new))


def test_a_model_without_dummy_prefix():
    old = b"\x18\x01 \x002\x00"
    data = DATA.replace(old, b"\x18\x00 \x002\x00")
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    own = sentence_pieces.Codec(data)
    for text, found in zip(ODD, sentence_pieces._digests(own, pa.array(ODD, pa.string())), strict=True):
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert found == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
