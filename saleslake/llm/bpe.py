"""BPE encoding and decoding with the vocabulary of a public tokenizer, by tree concatenation.

White space is never part of a token here, so a text is encoded run by run; frequent runs come from a
bounded table. Texts above PIECE characters are halved until no piece is longer, the pieces are encoded in
parallel tasks, and a text's pieces meet again in order. Halves are cut at white space where there is
some; that needs no work at the join. A pre-token longer than a piece (unsplit text) is cut anywhere:
its halves are concatenated in a tree, and around each join a window is encoded again, which grows until
it begins with tokens of the left side and ends with tokens of the right side. Adjacent tokens then
are all as in an encoding of the whole, which makes the concatenation the encoding of the whole.

Edge cases: a NULL or empty text has no tokens and decodes to the empty text; strings of special tokens
in a text are special tokens, as in the library; repeated rows give repeated results; extra columns
are ignored; an empty table gives an empty result. The tokenizer must have a BPE model and no decoder
(decoding joins tokens by a space); its added tokens must match raw text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.common import NO_ID
from saleslake.llm.superkmers import Rows, columns

#: Characters of a piece.
PIECE = 1 << 14
#: Runs whose tokens a worker remembers.
REMEMBERED = 200_000
#: Tokens on each side of a join that are encoded again first, and that have to agree.
WINDOW, AGREE = 8, 2
#: White space as the pre-tokenizer's pattern sees it.
_BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"[^{_BLANK}]+")
_SPACE = re.compile(f"[{_BLANK}]")
#: Separators that str.split() cuts at, but the pattern doesn't.
_ODD = re.compile("[\x1c-\x1f]")
#: Letters that lower-casing and composing treat alike everywhere, then points.
_SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+)([.,;:?!]*)").fullmatch
#: The visible characters that byte-level vocabularies use for bytes: the others follow from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class Codec:
    """The tokenizer of a worker and the tokens of frequent runs."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        if self.tokenizer.decoder is not None or any(t.normalized for t in added.values()):
            raise ValueError("the tokenizer needs no decoder and added tokens that match raw text")
        self.special = {t.content: i for i, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.suffix = self.model.end_of_word_suffix or ""
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self._names = {i: name for name, i in names.items()}
        self._ids: dict[str, str] = {}
        self._tokens: dict[str, str] = {}
        self._array: dict[str, bytes] = {}
        self._words: dict[str, list[int]] = {}
        self.end = max(self._names) + 1
        self._numbers = {i: str(i) for i in self._names}
        # Simple words need no normaliser if that is the usual one: lower case, byte-level letters.
        probe = "Abc \u00c0\u00ff\u0141 ab.,"
        self._is_plain = [
            x for w in ("abc", "\u00e0\u00ff\u0142", "ab") for x in self._word(w)
        ] + self._encode_runs([".,"])[0] == self.tokenizer.encode(probe, add_special_tokens=False).ids

    def _encode_runs(self, runs: list[str]) -> list[list[int]]:
        """The ids of each run: all are encoded as one text and told apart by their offsets."""
        ends = np.cumsum([len(r) + 1 for r in runs])
        found = self.tokenizer.encode(" ".join(runs), add_special_tokens=False)
        start = np.array([a for a, _ in found.offsets], np.int64)
        cuts = np.searchsorted(start, ends).tolist()
        ids = found.ids
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def _word(self, word: str) -> list[int]:
        """The ids of a lower-case word of simple letters: normalised already, one pre-token."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return [t.id for t in self.model.tokenize(word)]

    def _learn(self, runs: list[str], known: dict) -> None:
        """Remember what ``runs`` become. A word and the points after it are pre-tokens of their own."""
        unknown = set(runs).difference(known)
        if not unknown:
            return
        if len(known) + len(unknown) > REMEMBERED:
            for table in (self._ids, self._tokens, self._array):
                table.clear()
            unknown = set(runs)
        words, rest, encode = self._words, [], self._word
        for run in unknown:
            simple = _SIMPLE(run) if self._is_plain else None
            if simple is None:
                rest.append(run)
                continue
            word, tail = simple.groups()
            word = word.lower()
            ids = words.get(word)
            if ids is None:
                if len(words) > REMEMBERED:
                    words.clear()
                ids = words[word] = encode(word)
            if tail:
                more = words.get(tail)
                if more is None:
                    more = words[tail] = self._encode_runs([tail])[0]
                ids = ids + more
            self._keep(run, ids, known)
        if rest:
            for run, ids in zip(rest, self._encode_runs(rest), strict=True):
                self._keep(run, ids, known)

    def _keep(self, run: str, ids: list[int], known: dict) -> None:
        if known is self._array:
            self._array[run] = np.array(ids, np.int32).tobytes()
        else:
            self._ids[run] = " ".join([self._numbers[i] for i in ids])
            self._tokens[run] = " ".join([self._names[i] for i in ids])

    def runs(self, text: str) -> list[str]:
        return _RUN.findall(text) if _ODD.search(text) else text.split()

    def encode_text(self, text: str) -> tuple[str, str]:
        """Ids, and tokens, each joined by one space."""
        runs = self.runs(text)
        self._learn(runs, self._ids)
        ids = " ".join(filter(None, map(self._ids.__getitem__, runs)))
        return ids, " ".join(filter(None, map(self._tokens.__getitem__, runs)))

    def encode_texts(self, texts: list[str]) -> list[tuple[str, str]]:
        """encode_text of each text; what is unknown in a group of texts is encoded together."""
        out = []
        for a in range(0, len(texts), 64):
            group = texts[a : a + 64]
            self._learn([r for t in group for r in self.runs(t)], self._ids)
            out += map(self.encode_text, group)
        return out

    def encode_array(self, text: str) -> np.ndarray:
        """Ids as an array of int32."""
        runs = self.runs(text)
        self._learn(runs, self._array)
        return np.frombuffer(b"".join(map(self._array.__getitem__, runs)), np.int32)

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self._names.__getitem__, ids))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes of int32."""
        runs = [w.decode() for w in words]
        self._learn(runs, self._array)
        return list(map(self._array.__getitem__, runs))

    def pre_tokens(self, run: str) -> Iterator[tuple[str, int | None]]:
        """The pre-tokens of a run without white space, as the model gets them, or special ids."""
        for part in self._special.split(run) if self.special else [run]:
            if part in self.special:
                yield part, self.special[part]
            elif part:
                if self.tokenizer.normalizer:
                    part = self.tokenizer.normalizer.normalize_str(part)
                for text, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    yield text, None

    def encode_word(self, text: str) -> list[int]:
        """The model's merges on one pre-token."""
        return [t.id for t in self.model.tokenize(text)]

    def surface(self, token: int) -> str:
        """The characters that a token stands for."""
        return self._names[token].removesuffix(self.suffix)

    def concatenate(self, left: list[int], right: list[int]) -> list[int]:
        """encode_word(a + b) from left = encode_word(a) and right = encode_word(b)."""
        size = WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            ahead, behind = left[a:], right[:b]
            shapes = [*map(self.surface, ahead)], [*map(self.surface, behind)]
            middle = self.encode_word("".join(shapes[0]) + "".join(shapes[1]))
            if a == 0 and b == len(right):
                return middle
            starts_alike = a == 0 or (
                len(ahead) > AGREE and middle[:AGREE] == ahead[:AGREE]
            )
            if starts_alike:
                place, at = {}, 0
                for i, token in enumerate(middle):
                    place[at] = i
                    at += len(self.surface(token))
                if b == len(right):
                    return left[:a] + middle
                at = sum(map(len, shapes[0]))
                for j in range(b - AGREE):  # the last tokens of the window saw a false end
                    i = place.get(at)
                    if i is not None and middle[i : i + AGREE] == behind[j : j + AGREE]:
                        return left[:a] + middle[: i + AGREE] + right[j + AGREE :]
                    at += len(shapes[1][j])
            size *= 2

    def join(self, parts: list[list[int]]) -> list[int]:
        """The tokens of a pre-token from those of its consecutive pieces, as a tree."""
        while len(parts) > 1:
            pairs = zip(parts[::2], parts[1::2], strict=False)
            odd = parts[-1:] if len(parts) % 2 else []
            parts = [self.concatenate(a, b) for a, b in pairs] + odd
        return parts[0]


_codecs: dict[str, Codec] = {}


def codec(definition: str) -> Codec:
    """The worker's codec; it stays for the worker's next tasks."""
    if definition not in _codecs:
        _codecs.clear()
        _codecs[definition] = Codec(definition)
    return _codecs[definition]


def halves(text: str, most: int) -> list[str]:
    """``text`` cut in halves until none has more than ``most`` characters."""
    out, todo = [], [text]
    while todo:
        part = todo.pop()
        if len(part) <= most:
            out.append(part)
        else:
            todo += [part[len(part) // 2 :], part[: len(part) // 2]]
    return out


def at_blanks(text: str, most: int) -> list[str]:
    """``text`` halved at white space; a part without any may stay longer than ``most``."""
    out, todo = [], [text]
    while todo:
        part = todo.pop()
        cut = None
        if len(part) > most:
            middle = len(part) // 2
            after = _SPACE.search(part, middle)
            cut = after.start() if after else None
            if cut is None or cut > middle + most // 2:
                before = next((i for i in range(middle, 0, -1) if _SPACE.match(part, i)), None)
                if before is not None and (cut is None or middle - before < cut - middle):
                    cut = before
        if not cut:
            out.append(part)
        else:
            todo += [part[cut:], part[:cut]]
    return out


TEXT, WORD, WORD_END, SPECIAL = range(4)
_PIECES = "doc_id long, rid long, th long, seq int, kind int, text string"
_PIECE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("rid", pa.int64()), ("th", pa.int64()), ("seq", pa.int32()),
     ("kind", pa.int32()), ("text", pa.string())]
)


def pieces(codec: Codec, text: str, most: int) -> Iterator[tuple[int, str]]:
    """(kind, text) of the pieces of a long text."""
    for part in at_blanks(text, most):
        if len(part) <= most:
            yield TEXT, part
            continue
        for run in _RUN.findall(part):
            for word, special in codec.pre_tokens(run):
                if special is not None:
                    yield SPECIAL, word
                    continue
                *first, last = halves(word, most)
                for piece in first:
                    yield WORD, piece
                yield WORD_END, last


def _cut(definition, most: int):
    def run(batches):
        own = codec(definition.value)
        out = Rows(_PIECE_SCHEMA)
        for batch in batches:
            for doc_id, rid, th, text in zip(*columns(batch, "doc_id", "rid", "th", "text"), strict=True):
                for seq, (kind, piece) in enumerate(pieces(own, text, most)):
                    if out.add((doc_id, rid, th, seq, kind, piece), 2 * len(piece)):
                        yield out.batch()
        yield out.batch()

    return run


_ENCODED = "doc_id long, rid long, th long, seq int, kind int, ids string, tokens string"
_ENCODED_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("rid", pa.int64()), ("th", pa.int64()), ("seq", pa.int32()),
     ("kind", pa.int32()), ("ids", pa.string()), ("tokens", pa.string())]
)


def _encode_pieces(definition):
    def run(batches):
        own = codec(definition.value)
        out = Rows(_ENCODED_SCHEMA)
        for batch in batches:
            names = ("doc_id", "rid", "th", "seq", "kind", "text")
            for *key, kind, text in zip(*columns(batch, *names), strict=True):
                if kind == TEXT:
                    ids, tokens = own.encode_text(text)
                elif kind == SPECIAL:
                    ids, tokens = str(own.special[text]), text
                else:
                    ids, tokens = " ".join(map(str, own.encode_word(text))), None
                if out.add((*key, kind, ids, tokens), len(ids) + len(tokens or "")):
                    yield out.batch()
        yield out.batch()

    return run


_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_RESULT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
     ("decoded_sha256", pa.string())]
)


def count(ids: str) -> int:
    return ids.count(" ") + 1 if ids else 0


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Digests:
    """Digests of the ids and tokens of a text that come piece by piece."""

    def __init__(self) -> None:
        self.n, self.ids, self.tokens = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: str, tokens: str) -> None:
        if ids:
            blank = " " if self.n else ""
            self.ids.update((blank + ids).encode())
            self.tokens.update((blank + tokens).encode())
            self.n += count(ids)


def _join_pieces(definition):
    """Results from pieces sorted by text and seq; equal rows bring equal pieces, read once."""

    def run(batches):
        own = codec(definition.value)
        out = Rows(_RESULT_SCHEMA)
        text = held = None
        copies, last, word = 0, -1, []
        for batch in batches:
            names = ("doc_id", "rid", "th", "seq", "kind", "ids", "tokens")
            for doc_id, rid, th, seq, kind, ids, tokens in zip(*columns(batch, *names), strict=True):
                if (rid, th) != text:
                    for _ in range(copies):
                        out.add((held[0], held[1].n, held[1].ids.hexdigest(), held[1].tokens.hexdigest()), 200)
                    text, held, copies, last, word = (rid, th), (doc_id, _Digests()), 0, -1, []
                copies += seq == 0
                if seq == last:
                    continue
                last = seq
                if kind in (TEXT, SPECIAL):
                    held[1].add(ids, tokens)
                    continue
                word.append(list(map(int, ids.split())))
                if kind == WORD_END:
                    whole = own.join(word)
                    held[1].add(" ".join(map(str, whole)), own.decode(whole))
                    word = []
            if out.rows:
                yield out.batch()
        for _ in range(copies):
            out.add((held[0], held[1].n, held[1].ids.hexdigest(), held[1].tokens.hexdigest()), 200)
        yield out.batch()

    return run


def _encode_short(definition):
    def run(batches):
        own = codec(definition.value)
        for batch in batches:
            doc_ids, texts = columns(batch, "doc_id", "text")
            both = own.encode_texts(texts)
            rows = [(d, count(i), digest(i), digest(t)) for d, (i, t) in zip(doc_ids, both, strict=True)]
            out = Rows(_RESULT_SCHEMA)
            out.rows = rows
            yield out.batch()

    return run


def round_trip(df: DataFrame, path: str, piece: int = PIECE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of whole texts; path: a tokenizer file."""
    definition = df.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    text = F.coalesce("text", F.lit(""))
    docs = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("rid"),
        F.xxhash64(text).alias("th"),
        text.alias("text"),
    )
    short = docs.where(F.char_length("text") <= piece).select("doc_id", "text")
    long = docs.where(F.char_length("text") > piece)
    encoded = (
        long.mapInArrow(_cut(definition, piece), _PIECES)
        .repartition("rid", "th", "seq")
        .mapInArrow(_encode_pieces(definition), _ENCODED)
        .repartition("rid", "th")
        .sortWithinPartitions("rid", "th", "seq")
    )
    joined = encoded.mapInArrow(_join_pieces(definition), _RESULT)
    return short.mapInArrow(_encode_short(definition), _RESULT).unionByName(joined)


def encode(df: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded of whole texts, each encoded in one task."""
    definition = df.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))

    def run(batches):
        own = codec(definition.value)
        for batch in batches:
            doc_ids, texts = columns(batch, "doc_id", "text")
            both = [own.encode_text(t or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array([list(map(int, i.split())) for i, _ in both], pa.list_(pa.int32())),
                    pa.array([t for _, t in both], pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
