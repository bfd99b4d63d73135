"""SentencePiece (BPE) encoding by backtracking, and decoding.

A text's encoding is the one sequence of pieces in which every adjacent pair is
what merging the pair's own characters gives. So instead of running the merges
over a text, `Encoder` goes through it once: the trie of an Aho-Corasick automaton
gives the longest piece that matches at a position, shorter ones are tried while
it does not fit the piece before, and a position from which no piece leads on is marked in a bit field and never tried
again. Whether two pieces may stand side by side is found by merging their
characters anew, once per pair.

Texts are cut where no piece of the vocabulary reaches across, and each
different part is encoded once per worker (in a cache of bounded size), so the
work per text is a scan for its parts.

Workers import this module by name, so it has to be installed on the executors
or sent along (`--py-files`).

Defined results: null and empty texts have no ids and decode to the empty text;
characters that the vocabulary lacks become their UTF-8 bytes' pieces; a text of
any length is encoded whole. Each row is a result of its own, so repeated rows
give repeated results, and other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "▁"
# Entries of a worker's caches; beyond that they start anew.
CACHE_ENTRIES = 150_000


@dataclass(frozen=True)
class Vocabulary:
    """What encoding needs of a model: pieces with scores, and the ids that stand for bytes."""

    ids: dict[str, int]
    scores: dict[str, float]
    surfaces: tuple[str, ...]
    byte_ids: tuple[int, ...]
    dummy_prefix: bool
    unknown: str
    digest: str


def load_vocabulary(path: str) -> Vocabulary:
    """Read a BPE model with byte fallback and no normalisation; other kinds raise."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        raw = file.read()
    model.ParseFromString(raw)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    if trainer.model_type != trainer.BPE or not trainer.byte_fallback:
        raise ValueError("needs a BPE model with byte fallback")
    if normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces or not normalizer.escape_whitespaces:
        raise ValueError("needs a model without normalisation of texts")
    kinds = model.SentencePiece
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
    surfaces = [trainer.unk_surface if p.type == kinds.UNKNOWN else "" if p.type == kinds.CONTROL else p.piece for p in model.pieces]
    return Vocabulary(
        ids,
        {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL},
        tuple(s.replace(SPACE, " ") for s in surfaces),
        tuple(byte_ids[b] for b in range(256)),
        normalizer.add_dummy_prefix,
        trainer.unk_surface.replace(SPACE, " "),
        hashlib.sha256(raw).hexdigest(),
    )


NEVER = float("-inf")
# Up to so many characters, looking through all pairs is quicker than keeping them in order.
SHORT = 40


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The merges themselves: the best-scored adjacent pair first, the left one of equals."""
    return _merged_short(text, scores) if len(text) <= SHORT else _merged_long(text, scores)


def _merged_short(text: str, scores: dict[str, float]) -> list[str]:
    parts = list(text)
    pairs = [scores.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while pairs and (best := max(pairs)) > NEVER:
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = scores.get(parts[i - 1] + parts[i], NEVER)
        if i < len(pairs):
            pairs[i] = scores.get(parts[i] + parts[i + 1], NEVER)
    return parts


def _merged_long(text: str, scores: dict[str, float]) -> list[str]:
    parts: list[str | None] = list(text)
    before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
    agenda = []
    for i in range(len(parts) - 1):
        score = scores.get(text[i : i + 2])
        if score is not None:
            agenda.append((-score, i, i + 1, text[i : i + 2]))
    heapify(agenda)
    while agenda:
        _, left, right, both = heappop(agenda)
        if parts[left] is None or parts[right] is None or parts[left] + parts[right] != both:
            continue
        parts[left], parts[right] = both, None
        after[left] = after[right]
        if after[right] < len(parts):
            before[after[right]] = left
        for a, b in ((before[left], left), (left, after[left])):
            if a >= 0 and b < len(parts):
                joined = parts[a] + parts[b]
                score = scores.get(joined)
                if score is not None:
                    heappush(agenda, (-score, a, b, joined))
    return [p for p in parts if p is not None]


class Bounded(dict):
    """A dictionary that computes what it lacks; when full, only what is used again is kept."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        # Pieces of equal score: which is merged first then depends on the whole part.
        often = Counter(vocabulary.scores.values())
        tied = [p for p, s in vocabulary.scores.items() if often[s] > 1 and len(p) > 1]
        self.tied = re.compile("|".join(map(re.escape, sorted(tied, key=len)))) if tied else None
        self.widest = max(map(len, vocabulary.ids))
        self.automaton = ahocorasick.Automaton()
        for piece in vocabulary.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.fits = Bounded(lambda pair: merged(pair[0] + pair[1], vocabulary.scores) == [*pair])
        self.reached = Bounded(lambda piece: merged(piece, vocabulary.scores) == [piece])
        # By what the automaton reads of a text, of which there is far less than of texts.
        self.first = Bounded(self.longest)
        self.shorter = Bounded(lambda piece: self.longest(piece[:-1]))
        self.packed = Bounded(lambda part: np.array(self.ids(self.part(part)), "<i4").tobytes())
        self.cut = re.compile(self._cuts())
        self.words = Bounded(lambda word: b"".join(map(self.packed.__getitem__, self.cut.findall(word))))
        # Words begin with the space before them, and a line break is no part of any piece.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in vocabulary.ids)

    def _cuts(self) -> str:
        """A pattern for parts that no piece crosses, as far as this vocabulary allows."""
        pieces, s = self.v.ids, SPACE
        if any(re.search(f"[^{s}]{s}", p) for p in pieces):
            return r"(?s).+"
        alone = "" if any("\n" in p for p in pieces) else r"\n"
        # Characters that follow a letter in no piece, such as a comma.
        letters = {p[i + 1] for p in pieces for i in range(len(p) - 1) if p[i].isalpha()}
        ends = "".join(sorted({c for p in pieces for c in p if c.isascii() and c.isprintable() and not c.isalpha()} - letters))
        cuts = [alone, rf"{s}*[^{s}{alone}{re.escape(ends)}]*[^\W\d_](?=[{re.escape(ends)}])"] if ends else [alone]
        return "|".join([c for c in cuts if c] + [rf"{s}*[^{s}{alone}]+", rf"{s}+"])

    def longest(self, text: str) -> str:
        """The longest piece that `text` begins with; a lone character if none does."""
        for n in range(self.automaton.longest_prefix(text), 1, -1):
            piece = text[:n]
            if piece in self.v.ids and self.reached[piece]:
                return piece
        return text[0]

    def part(self, text: str) -> list[str]:
        """The pieces of one part, by backtracking."""
        if self.tied is not None and self.tied.search(text):
            return merged(text, self.v.scores)
        first, shorter, fits = self.first, self.shorter, self.fits
        end, at, failed = len(text), 0, 0
        chosen: list[str] = []
        widest, read = self.widest, self.automaton.longest_prefix
        ahead = text[:widest]
        piece = first[ahead[: read(ahead) or 1]]
        last = None
        while True:
            after = at + len(piece)
            if (last is None or fits[last, piece]) and not (failed and failed >> after & 1):
                chosen.append(piece)
                if after == end:
                    return chosen
                at, last = after, piece
                ahead = text[at : at + widest]
                piece = first[ahead[: read(ahead) or 1]]
            else:
                while len(piece) == 1:  # nothing shorter: no piece leads on from here
                    failed |= 1 << at
                    piece = chosen.pop()
                    at -= len(piece)
                    last = chosen[-1] if chosen else None
                piece = shorter[piece]

    def ids(self, pieces: Iterable[str]) -> list[int]:
        found = []
        for piece in pieces:
            known = self.v.ids.get(piece)
            if known is None:
                found += [self.v.byte_ids[b] for b in piece.encode()]
            else:
                found.append(known)
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed as little-endian int32."""
        if not text:
            return b""
        whole = (SPACE if self.v.dummy_prefix else "") + text.replace(" ", SPACE)
        if self.by_word and SPACE * 2 not in whole:
            words = whole.replace(SPACE, " " + SPACE).replace("\n", " \n ").split(" ")
            return b"".join(map(self.words.__getitem__, words))
        return b"".join(map(self.packed.__getitem__, self.cut.findall(whole)))


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.bytes = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        # Bytes of longer characters take part as lone surrogates until they are joined.
        self.surface = list(vocabulary.surfaces)
        for i, b in self.bytes.items():
            self.surface[i] = chr(b if b < 128 else 0xDC00 + b)
        self.unknown = vocabulary.unknown
        self.runs = re.compile("[\udc80-\udcff]+")

    def decode(self, ids: list[int]) -> str:
        text = "".join(map(self.surface.__getitem__, ids))
        if text[:1] == " " and self.v.dummy_prefix:
            first = next(i for i in ids if self.surface[i])
            if first not in self.bytes and self.surface[first] != self.unknown:
                text = text[1:]
        try:
            text.encode()
        except UnicodeEncodeError:
            text = self.runs.sub(lambda run: self._characters(bytes(ord(c) - 0xDC00 for c in run[0])), text)
        return text

    @staticmethod
    def _characters(raw: bytes) -> str:
        """Bytes to characters; each byte that is part of none becomes U+FFFD."""
        found, at = [], 0
        while at < len(raw):
            try:
                found.append(raw[at:].decode())
                break
            except UnicodeDecodeError as error:
                found.append(raw[at : at + error.start].decode() + "�")
                at += error.start + 1
        return "".join(found)


_MADE: dict = {}


def _shared(kind, vocabulary: Vocabulary):
    """One encoder or decoder for all tasks of a worker process, so that later tasks find its caches filled."""
    key = kind, vocabulary.digest
    if key not in _MADE:
        _MADE[key] = kind(vocabulary)
    return _MADE[key]


def _id_lists(packed: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a text, `array<int>`, as the sentencepiece library gives them; never null."""

    @F.arrow_udf("array<int>")
    def ids_of(column: pa.Array) -> pa.Array:
        encoder = _shared(Encoder, vocabulary)
        return _id_lists([encoder.encode(t.as_py()) if t.is_valid else b"" for t in column])

    return ids_of(text)


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of `array<int>` ids; empty for null."""

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        decoder = _shared(Decoder, vocabulary)
        return pa.array([decoder.decode(v.values.to_pylist()) if v.is_valid else "" for v in column], pa.string())

    return text_of(ids)


def round_trip(text: Column, vocabulary: Vocabulary) -> Column:
    """`struct<ids array<int>, text string>`: a text's ids and what they decode to, in one pass over the workers.

    Asked for one after the other, Spark would encode twice: once for the ids and once within the decoding.
    """

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def there_and_back(column: pa.Array) -> pa.Array:
        encoder, decoder = _shared(Encoder, vocabulary), _shared(Decoder, vocabulary)
        packed = [encoder.encode(t.as_py()) if t.is_valid else b"" for t in column]
        texts = pa.array([decoder.decode(np.frombuffer(p, "<i4").tolist()) for p in packed], pa.string())
        return pa.StructArray.from_arrays([_id_lists(packed), texts], ["ids", "text"])

    return there_and_back(text)
