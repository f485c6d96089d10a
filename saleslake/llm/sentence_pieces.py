"""SentencePiece encoding and decoding with a merge-type (BPE) model, exactly as the library, by backtracking.

Merging by score ends in the only sequence of pieces in which every two neighbours are compatible, that
is, merging the characters of the two again gives the same two. (Merges inside two pieces don't depend
on what stands around them, so a first merge across a border would also come about in the two alone.)
So no text is merged: an Aho-Corasick automaton gives the longest piece that starts at each position, the
encoder takes it if it is compatible with the piece before, else the next shorter one, and steps
back when none is left; a bit field marks the positions from which no encoding goes on, so that each
fails once at most and time stays linear in the text.

A text is encoded segment by segment: no piece reaches over a space mark that follows something else, nor
over a character that no piece has. Frequent segments come from a bounded table, and a segment that a part
of a batch repeats is looked up once. Characters without a piece become bytes.

Edge cases: a NULL or empty text has no ids and decodes to the empty text; the names of control pieces
in a text are plain text, as in the library; repeated rows give repeated results; extra columns are
ignored; an empty table gives an empty result. A task holds a few megabytes of texts at a time, or one longer
text. Models that normalize characters, without byte fallback, with pieces over several words, or with
user-defined or unused pieces are refused with a ValueError.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: The mark that stands for a space in pieces.
MARK = "▁"
#: Segments whose ids a worker remembers, the longest of them, and remembered pairs of pieces.
REMEMBERED, LONGEST, PAIRS = 500_000, 64, 1 << 22
#: Fewer new segments than these are split one by one.
FEW = 64
#: Bytes of texts that are handled at a time.
PART = 16 << 20
#: Fixed values of the public model format: kinds of pieces, and the merge type.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, data[at : at + size]
        at += size


class Model:
    """What a model file says: pieces (text, score, kind) by id, and the settings that matter here."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number in (2, 3):
                (trainer if number == 2 else normalizer).update(_fields(value))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.unknown_surface = trainer.get(44, b" \xe2\x81\x87 ")
        faults = {
            "its type is not BPE": trainer.get(3, 1) != MERGE_TYPE,
            "it has no byte fallback": not trainer.get(35, 0),
            "it puts the space mark behind words": trainer.get(24, 0),
            "it normalizes characters": normalizer.get(2, b""),
            "it removes spaces": normalizer.get(4, 1),
            "it doesn't escape spaces": not normalizer.get(5, 1),
            "it has pieces over several words": any(MARK in p.lstrip(MARK) for p, _, _ in self.pieces),
            "it has user-defined or unused pieces": {k for _, _, k in self.pieces}
            - {NORMAL, UNKNOWN, CONTROL, BYTE},
        }
        for fault, found in faults.items():
            if found:
                raise ValueError(f"This model can't be used: {fault}.")


def _bytewise(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("saleslake-bytewise", _bytewise)


class Codec:
    """The model of a worker and the ids of frequent segments."""

    def __init__(self, data: bytes, remembered: int = REMEMBERED) -> None:
        model = Model(data)
        self.dummy_prefix, self.remembered = model.dummy_prefix, remembered
        self.scores = {p: score for p, score, kind in model.pieces if kind == NORMAL}
        in_bytes = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.of_byte = [in_bytes[b] for b in range(256)]
        self.written = list(map(str, range(len(model.pieces))))
        self.bytes_of = [_surface(model, *p) for p in model.pieces]
        self.marked = {k for k, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL and p[0] == MARK}
        self.silent = {k for k, (_, _, kind) in enumerate(model.pieces) if kind == CONTROL}
        # What a position can take: pieces that merging really gives, and single characters.
        characters = set().union(*self.scores)
        ids = {c: tuple(self.of_byte[b] for b in c.encode()) for c in characters}
        histories = {c: [] for c in characters}
        for k, (p, _, kind) in enumerate(model.pieces):
            if kind == NORMAL and (history := self.history(p)) is not None:
                ids[p], histories[p] = (k,), history
        self.texts = sorted(ids)
        number = {p: k for k, p in enumerate(self.texts)}
        self.ids = [ids[p] for p in self.texts]
        self.histories = [histories[p] for p in self.texts]
        self.sizes = list(map(len, self.texts))
        self.shorter = [
            next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in number), -1) for p in self.texts
        ]
        self.automaton = ahocorasick.Automaton()
        for p, k in number.items():
            self.automaton.add_word(p, k)
        self.automaton.make_automaton()
        self.segments = _segments(characters, self.scores)
        self.number = number
        self.apart = next(chr(c) for c in range(len(characters) + 1) if chr(c) not in characters)
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.held = np.full(PAIRS, -1, np.int64)  # remembered pairs of split_many, by hash
        self.fits = np.zeros(PAIRS, bool)
        self.arrays = [np.array(x, np.int64) for x in (self.sizes, self.shorter)]
        self.spoken = pa.array(self.bytes_of, pa.large_binary()), pa.array(self.written, pa.large_string())

    def history(self, piece: str) -> list[tuple[float, str, str]] | None:
        """Merging a piece's characters by score, the leftmost of equal ones first: the score of each merge
        with the first and the last part before it. None if it doesn't end in the piece itself."""
        parts, scores, found = list(piece), self.scores, []
        while len(parts) > 1:
            best, at = None, 0
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return None
            found.append((best, parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both again gives the two: their merges are repeated in the order
        of their scores, until one over the border would come first, or none is left."""
        a, b, scores = self.histories[left], self.histories[right], self.scores
        i = j = 0
        while i < len(a) or j < len(b):
            last = a[i][2] if i < len(a) else self.texts[left]
            first = b[j][1] if j < len(b) else self.texts[right]
            over = scores.get(last + first)
            mine = a[i][0] if i < len(a) else None
            other = b[j][0] if j < len(b) else None
            if over is not None and (mine is None or over > mine) and (other is None or over >= other):
                return False
            if other is None or (mine is not None and mine >= other):
                i += 1
            else:
                j += 1
        return self.texts[left] + self.texts[right] not in scores

    def split(self, segment: str) -> list[int]:
        """The pieces (numbers in ``texts``) of a segment whose characters the model all knows."""
        n, sizes, shorter, pairs = len(segment), self.sizes, self.shorter, self.pairs
        longest = [-1] * n
        for end, piece in self.automaton.iter(segment):  # by increasing end, so the longest comes last
            longest[end + 1 - sizes[piece]] = piece
        failed = bytearray((n >> 3) + 1)  # a bit per position
        taken, at, piece, last, tried = [], 0, longest[0], -1, False
        while at < n:
            while piece >= 0:
                end = at + sizes[piece]
                if not (tried and failed[end >> 3] >> (end & 7) & 1):
                    if last < 0:
                        break
                    pair = last << 32 | piece
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= PAIRS >> 3:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at, last = end, piece
                piece = longest[at] if at < n else -1
            else:  # nothing goes on from here: the piece before has to be a shorter one
                tried = True
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= sizes[piece]
                last = taken[-1] if taken else -1
        return taken

    def compatible_pairs(self, pairs: np.ndarray) -> np.ndarray:
        """``compatible`` of many pairs, each left << 32 | right."""
        slots = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(PAIRS)
        new = np.flatnonzero(self.held[slots] != pairs)
        if not len(new):
            return self.fits[slots]
        found = self.fits[slots]
        missing, which = np.unique(pairs[new], return_inverse=True)
        known = np.array([self.compatible(p >> 32, p & 0xFFFFFFFF) for p in missing.tolist()])
        found[new] = known[which]
        self.held[slots[new]], self.fits[slots[new]] = pairs[new], found[new]
        return found

    def split_many(self, segments: list[str]) -> Iterator[list[int]]:
        """``split`` of many short segments that step forth and back together."""
        sizes, shorter = self.arrays
        lengths = np.array([len(x) for x in segments], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        matches = self.automaton.iter(self.apart.join(segments))
        matches = np.fromiter(chain.from_iterable(matches), np.int64).reshape(-1, 2)
        longest = np.full(int(lengths.sum()) + len(segments) + 1, -1, np.int64)
        longest[matches[:, 0] + 1 - sizes[matches[:, 1]]] = matches[:, 1]  # the last one, so the longest, stays
        failed, taken = np.zeros(len(longest), bool), np.full(len(longest), -1, np.int64)
        depth, at, ends = np.zeros(len(segments), np.int64), starts.copy(), starts + lengths
        piece, going = longest[at], np.arange(len(segments))
        while len(going):
            mine, place = piece[going], at[going]
            back, forth = going[mine < 0], going[mine >= 0]
            if len(back):
                failed[place[mine < 0]] = True
                depth[back] -= 1
                piece[back] = taken[starts[back] + depth[back]]
                at[back] -= sizes[piece[back]]
            place, mine = place[mine >= 0], mine[mine >= 0]
            end = place + sizes[mine]
            fits = ~failed[end]
            inner = np.flatnonzero(fits & (depth[forth] > 0))
            before = taken[starts[forth[inner]] + depth[forth[inner]] - 1]
            fits[inner] = self.compatible_pairs(before << 32 | mine[inner])
            piece[forth[~fits]] = shorter[mine[~fits]]
            on, end = forth[fits], end[fits]
            taken[starts[on] + depth[on]] = mine[fits]
            depth[on] += 1
            at[on], piece[on] = end, longest[end]
            going = going[at[going] < ends[going]]
        found = taken.tolist()
        return (found[a : a + n] for a, n in zip(starts.tolist(), depth.tolist(), strict=True))

    def ids_of(self, pieces: list[int]) -> tuple[int, ...]:
        return tuple([k for p in pieces for k in self.ids[p]])

    def learn(self, segments: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of segments that aren't remembered, of which the first are remembered then."""
        found, short = {}, []
        few = len(segments) < FEW
        for segment in segments:
            if segment[0] not in self.scores and segment not in self.number:
                found[segment] = tuple(self.of_byte[b] for b in segment.encode())
            elif len(segment) > LONGEST or few:
                found[segment] = self.ids_of(self.split(segment))
            else:
                short.append(segment)
        found |= zip(short, map(self.ids_of, self.split_many(short)), strict=True)
        room = self.remembered - len(self.known)
        self.known |= islice(((x, ids) for x, ids in found.items() if len(x) <= LONGEST), max(0, room))
        return found

    def of_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of words, each of them marks and what follows them up to the next mark."""
        found = list(map(self.known.get, words))
        rest = [k for k, ids in enumerate(found) if ids is None]
        cut = [self.segments.findall(words[k]) for k in rest]
        new = self.learn({x for some in cut for x in some if x not in self.known})
        for k, some in zip(rest, cut, strict=True):
            ids = [new[x] if x in new else self.known[x] for x in some]
            found[k] = ids[0] if len(ids) == 1 else tuple(chain.from_iterable(ids))
        return found

    def encode(self, text: str) -> list[int]:
        marked = text.replace(" ", MARK)
        if text and self.dummy_prefix:
            marked = MARK + marked
        return list(chain.from_iterable(self.of_words([marked]) if marked else ()))

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; bytes that are no UTF-8 become U+FFFD, one for each."""
        spoken, found = [], []
        for k in [*ids, None]:
            if k is None or k in self.silent:  # bytes don't meet over a control piece
                found.append(self.surface(spoken).decode("utf-8", "saleslake-bytewise"))
                spoken = []
            else:
                spoken.append(k)
        text = "".join(found)
        head = next((k for k in ids if k not in self.silent), None)
        return text[1:] if self.dummy_prefix and head in self.marked else text

    def surface(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _segments(characters: set[str], pieces: Iterable[str]) -> re.Pattern:
    """Cuts marked text where no piece of the model can reach over.

    That is around characters that no piece has, before a mark, and behind the letters that no piece has
    before anything but such letters.
    """
    behind: dict[str, set[str]] = {}
    for p in pieces:
        for x, y in zip(p, p[1:], strict=False):
            behind.setdefault(x, set()).add(y)
    letters = {c for c in characters if c.isalpha()}
    while odd := {c for c in letters if not behind.get(c, set()) <= letters}:
        letters -= odd
    inner = [_any(letters), _any(characters - letters - {MARK})]
    return re.compile(f"{MARK}+{inner[1]}*{inner[0]}*|{inner[1]}+{inner[0]}*|{inner[0]}+|[\\s\\S]")


def _any(characters: set[str]) -> str:
    return f"[{re.escape(''.join(sorted(characters)))}]" if characters else r"[^\s\S]"


def _surface(model: Model, piece: str, _: float, kind: int) -> bytes:
    if kind == BYTE:
        return bytes([int(piece[3:5], 16)])
    if kind == UNKNOWN:
        return model.unknown_surface
    return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()


_codecs: dict[bytes, Codec] = {}


def codec(data: bytes) -> Codec:
    """The worker's codec; it stays for the worker's next tasks."""
    if data not in _codecs:
        _codecs.clear()
        _codecs[data] = Codec(data)
    return _codecs[data]


def _words(texts: pa.Array, dummy_prefix: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut before each mark that follows something else.

    Returns the distinct words with their marks, the words of the texts end to end, as numbers, and where
    each text ends.
    """
    cut = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
    encoded = cut.values.dictionary_encode()
    ends = cut.offsets.to_numpy()[1:].astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    numbers = encoded.indices.to_numpy().astype(np.int64)
    words = encoded.dictionary.to_pylist()
    empty = words.index("") if "" in words else -1
    words = [MARK + w for w in words]
    here = np.ones(len(numbers), bool)
    known: dict[str, int] = {}

    def put(at: int, word: str) -> None:
        here[at] = bool(word)
        numbers[at] = known.setdefault(word, len(words))
        if numbers[at] == len(words):
            words.append(word)

    if not dummy_prefix:  # the first word of a text has no mark of its own
        for at in starts[ends > starts]:
            put(at, words[numbers[at]][1:])
    silent = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    here[starts[silent]] = False
    marks = np.flatnonzero((numbers == empty) & here)
    if len(marks):  # spaces in a row, and at the end: they go with the word behind them
        last = np.zeros(len(numbers), bool)
        last[ends[ends > starts] - 1] = True
        run = ""
        for k, at in enumerate(marks):
            run += MARK
            if last[at]:
                put(at, run)
                run = ""
                continue
            here[at] = False
            if k + 1 == len(marks) or marks[k + 1] != at + 1:
                put(at + 1, run + words[numbers[at + 1]])
                run = ""
    before = np.concatenate([[0], np.cumsum(here)])
    return words, numbers[here], before[ends]


def _digests(own: Codec, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
    """(number of ids, digest of the ids, digest of the decoded text) of whole texts."""
    words, numbers, ends = _words(texts, own.dummy_prefix)
    ids = own.of_words(words)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int64))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]))
    no, comma = pa.scalar(b"", pa.large_binary()), pa.scalar(",", pa.large_string())
    spoken, written = (x.take(flat) for x in own.spoken)
    decoded = pc.binary_join(pa.LargeListArray.from_arrays(offsets, spoken), no).take(pa.array(numbers))
    in_digits = pc.binary_join(pa.LargeListArray.from_arrays(offsets, written), comma).take(pa.array(numbers))
    upto = np.concatenate([[0], np.cumsum(sizes[numbers])])
    cuts = np.concatenate([[0], ends])
    offsets = pa.array(cuts, pa.int64())
    in_digits = pc.binary_join(pa.LargeListArray.from_arrays(offsets, in_digits), comma)
    decoded = pc.binary_join(pa.LargeListArray.from_arrays(offsets, decoded), no)
    for k in range(len(texts)):
        first = ids[numbers[cuts[k]]] if cuts[k] < cuts[k + 1] else ()
        skip = int(own.dummy_prefix and bool(first) and first[0] in own.marked)
        text = memoryview(decoded[k].as_buffer())[skip:]
        written = in_digits[k].as_buffer()
        n = int(upto[cuts[k + 1]] - upto[cuts[k]])
        yield n, hashlib.sha256(written).hexdigest(), hashlib.sha256(text).hexdigest()


def _documents(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of whole texts; path: a model file."""
    data = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        own = codec(data.value)
        for doc_ids, texts in chain.from_iterable(map(_parts, batches)):
            found = list(zip(*_digests(own, texts), strict=True)) or [()] * 3
            kinds = (pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([doc_ids, *arrays], names)

    return _documents(df).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(df: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded of whole texts."""
    data = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches):
        own = codec(data.value)
        for doc_ids, texts in chain.from_iterable(map(_parts, batches)):
            ids = [own.encode(t) for t in texts.to_pylist()]
            decoded = pa.array([own.decode(k) for k in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(ids, pa.list_(pa.int32())), decoded], ["doc_id", "ids", "decoded"]
            )

    return _documents(df).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of a batch in parts of about PART bytes, a longer text alone."""
    doc_ids, texts = batch.column("doc_id"), batch.column("text")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        size = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, size + PART, "right")))
        yield doc_ids.slice(begin, end - begin), pa.concat_arrays([texts.slice(begin, end - begin)])
        begin = end
