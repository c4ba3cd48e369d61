"""SentencePiece encoding and decoding by unigram Viterbi over a double-array trie.

A text is cut before the white space of each word; no piece crosses such a place, so
the best path of the text is made of the best paths of its words. The distinct words
of a batch go through the trie and the Viterbi steps side by side, as arrays.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections import defaultdict
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keybrook.llm.components import in_parts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the public model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"
# An unknown character costs so much more than the worst piece.
UNKNOWN_PENALTY = 10.0

# No text from Arrow holds a lone surrogate.
_BARE = "\ud800"

_GROUP_CHARS = 500_000
_MOST_WORDS = 300_000


def fields(data: bytes):
    """(number, value) of each field of a serialised message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield key >> 3, value


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    kinds: list[int]
    dummy_prefix: bool


def read_vocabulary(data: bytes) -> Vocabulary:
    """The pieces of a serialised model with their log scores.

    A BPE model states merge ranks in place of scores. Its pieces then get the log
    scores of Zipf's law over these ranks, less the logarithm of the harmonic sum.
    Normalisation other than the white-space marker is not supported.
    """
    pieces, scores, kinds = [], [], []
    model, prefix = UNIGRAM, True
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            pieces.append(piece[1].decode())
            scores.append(piece.get(2, 0.0))
            kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            model = dict(fields(value)).get(3, UNIGRAM)
        elif number == 3:
            rules = dict(fields(value))
            prefix = bool(rules.get(3, 1))
            if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                raise ValueError("the model's normalisation is not supported")
    scores = np.array(scores, np.float32)
    if model == BPE:
        ranks = np.arange(1, len(scores) + 1, dtype=np.float64)
        order = np.argsort(-scores, kind="stable")
        by_rank = -np.log(ranks) - np.log((1 / ranks).sum())
        scores = np.empty_like(scores)
        scores[order] = by_rank.astype(np.float32)
    return Vocabulary(pieces, scores, kinds, prefix)


class DoubleArrayTrie:
    """Strings as paths in two arrays: the child of ``s`` by ``c`` is ``t = base[s] + c``
    if ``check[t] == s``. Characters have dense codes from 1; 0 leads nowhere."""

    def __init__(self, strings: dict[str, int]):
        alphabet = sorted({char for string in strings for char in string})
        self.codes = np.zeros(0x110000, np.int32)
        self.codes[[ord(char) for char in alphabet]] = np.arange(1, len(alphabet) + 1)
        code_of = {char: code + 1 for code, char in enumerate(alphabet)}
        root: dict = {}
        for string, value in strings.items():
            node = root
            for char in string:
                node = node.setdefault(code_of[char], {})
            node[0] = value
        self._width = len(alphabet) + 1
        size = 4 * self._width
        base, check, value = [0] * size, [-1] * size, [-1] * size
        free = 1
        waiting = [(0, root)]
        check[0] = 0
        for state, node in waiting:
            children = sorted(code for code in node if code)
            value[state] = node.get(0, -1)
            if not children:
                continue
            while check[free] >= 0:
                free += 1
            at = max(free, children[0])
            while True:
                start = at - children[0]
                while start + self._width >= len(base):
                    for array, fill in ((base, 0), (check, -1), (value, -1)):
                        array.extend([fill] * len(array))
                if check[at] < 0 and all(check[start + code] < 0 for code in children):
                    break
                at += 1
            base[state] = start
            for code in children:
                check[start + code] = state
                waiting.append((start + code, node[code]))
        self.base = np.array(base, np.int32)
        self.check = np.array(check, np.int32)
        self.value = np.array(value, np.int32)

    def matches(self, codes: np.ndarray, room: np.ndarray):
        """All (start, length, value) of strings in ``codes``; ``room`` is how many
        characters each start may use."""
        starts = np.flatnonzero(room > 0)
        states = np.zeros(len(starts), np.int32)
        found, length = [], 0
        while len(starts):
            letters = codes[starts + length]
            targets = self.base[states] + letters
            good = (letters > 0) & (self.check[targets] == states)
            starts, states = starts[good], targets[good]
            length += 1
            values = self.value[states]
            ends = values >= 0
            found.append((starts[ends], np.full(ends.sum(), length, np.int32), values[ends]))
            more = room[starts] > length
            starts, states = starts[more], states[more]
        return [np.concatenate(column) for column in zip(*found)] if found else None


class PieceModel:
    """Encoder and decoder of one vocabulary. It is sent to tasks as it is.

    The tasks that a Python process runs one after another share what it has learnt of
    the model's words.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.name = uuid.uuid4().hex
        kinds = vocabulary.kinds
        usable = {
            piece: n for n, piece in enumerate(vocabulary.pieces)
            if kinds[n] in (NORMAL, USER_DEFINED)
        }
        self.trie = DoubleArrayTrie(usable)
        self.unknown = kinds.index(UNKNOWN)
        self.byte_ids = {
            int(piece[3:5], 16): n
            for n, piece in enumerate(vocabulary.pieces) if kinds[n] == BYTE
        }
        normal = vocabulary.scores[list(usable.values())]
        self.unknown_score = np.float32(normal.min() - np.float32(UNKNOWN_PENALTY))
        # Cutting before each word is right only if no piece goes on into the next one.
        self.cuts_at_words = not any(
            re.search(f"[^{MARK}]{MARK}", piece) for piece in usable
        )
        self.surface = [self._surface(n) for n in range(len(kinds))]
        self._forget()

    def _surface(self, n: int) -> bytes:
        kind, piece = self.vocabulary.kinds[n], self.vocabulary.pieces[n]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()

    def __reduce__(self):
        own = dict(self.__dict__)
        for name in ("places", "ids", "firsts"):
            own.pop(name)
        return _received, (self.name, own)

    def _forget(self) -> None:
        self.places = defaultdict(count().__next__)
        self.ids = np.zeros(0, np.int32)
        self.firsts = np.zeros(1, np.int64)

    def words(self, text: str) -> list[str]:
        """A text in parts that are encoded by themselves.

        A part that starts with a space is given without it, any other with ``_BARE``
        before it.
        """
        text = " " + text if self.vocabulary.dummy_prefix else text
        if not self.cuts_at_words:
            return [_BARE + text]
        if text[0] == " " and text[-1] != " " and "  " not in text:
            return text[1:].split(" ")
        parts = re.findall(" *[^ ]+| +", text)
        return [part[1:] if part[0] == " " else _BARE + part for part in parts]

    def best_paths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and where each word's ids start."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.trie.codes[points]
        room = np.repeat(ends, sizes) - np.arange(len(points))
        offsets = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
        starts, lengths, pieces = self.trie.matches(codes, room)
        scores = self.vocabulary.scores[pieces]
        alone = np.zeros(len(points), bool)
        alone[starts[lengths == 1]] = True
        lost = np.flatnonzero(~alone)
        starts = np.concatenate((starts, lost))
        lengths = np.concatenate((lengths, np.ones(len(lost), np.int32)))
        pieces = np.concatenate((pieces, np.full(len(lost), self.unknown, np.int32)))
        scores = np.concatenate((scores, np.full(len(lost), self.unknown_score, np.float32)))

        # Node p of a word lies before its character p; a word of n characters has n + 1.
        nodes = starts + np.repeat(np.arange(len(words)), sizes)[starts]
        order = np.argsort(offsets[starts], kind="stable")
        nodes, lengths, pieces, scores = (x[order] for x in (nodes, lengths, pieces, scores))
        steps = np.searchsorted(offsets[starts][order], np.arange(sizes.max() + 1))
        best = np.full(len(points) + len(words), -np.inf, np.float32)
        best[ends - sizes + np.arange(len(words))] = 0
        came = np.zeros(len(best), np.int64)
        by = np.zeros(len(best), np.int32)
        for low, high in zip(steps[:-1], steps[1:]):
            source = nodes[low:high]
            target = source + lengths[low:high]
            total = best[source] + scores[low:high]
            better = total > best[target]
            target = target[better]
            best[target] = total[better]
            came[target] = source[better]
            by[target] = pieces[low:high][better]

        first = ends - sizes + np.arange(len(words))
        at = ends + np.arange(len(words))
        word = np.arange(len(words))
        path_words, path_nodes = [], []
        while len(at):
            path_words.append(word)
            path_nodes.append(at)
            at = came[at]
            on = at > first[word]
            at, word = at[on], word[on]
        nodes = np.sort(np.concatenate(path_nodes))
        per_word = np.bincount(np.concatenate(path_words), minlength=len(words))
        ids = by[nodes]
        firsts = np.concatenate(([0], np.cumsum(per_word)))
        if not self.byte_ids or not (ids == self.unknown).any():
            return ids, firsts
        return self._with_bytes(ids, firsts, nodes, points)

    def _with_bytes(self, ids, firsts, nodes, points):
        """Unknown characters replaced by the pieces of their UTF-8 bytes."""
        word = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        unknown = np.flatnonzero(ids == self.unknown)
        chars = points[nodes[unknown] - word[unknown] - 1]
        encoded = [chr(char).encode("utf-8", "surrogatepass") for char in chars]
        times = np.ones(len(ids), np.int64)
        times[unknown] = [len(one) for one in encoded]
        spread = np.repeat(ids, times)
        spread[np.repeat(ids == self.unknown, times)] = [
            self.byte_ids[byte] for one in encoded for byte in one
        ]
        return spread, np.concatenate(([0], np.cumsum(times)))[firsts]

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text: none for an empty one, null for null."""
        found: list[np.ndarray | None] = []
        group: list[str | None] = []
        chars = 0
        for text in texts:
            group.append(text)
            chars += len(text or "")
            if chars >= _GROUP_CHARS:
                found += self._encode_group(group)
                group, chars = [], 0
        return found + self._encode_group(group)

    def _encode_group(self, texts: list[str | None]) -> list[np.ndarray | None]:
        if len(self.places) > _MOST_WORDS:
            self._forget()
        known = len(self.places)
        sizes, places = [], []
        for text in texts:
            words = self.words(text) if text else []
            places.append(np.fromiter(map(self.places.__getitem__, words), np.int64, len(words)))
        if len(self.places) > known:
            fresh = [
                (part[1:] if part.startswith(_BARE) else " " + part).replace(" ", MARK)
                for part in islice(self.places, known, None)
            ]
            ids, firsts = self.best_paths(fresh)
            self.firsts = np.concatenate((self.firsts, firsts[1:] + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids))
        all_places = np.concatenate(places) if places else np.zeros(0, np.int64)
        lengths = np.diff(self.firsts)[all_places]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        shift = np.repeat(self.firsts[all_places] - ends[:-1], lengths)
        ids = self.ids[shift + np.arange(len(shift))]
        until = ends[np.cumsum([len(one) for one in places], dtype=np.int64)] if places else []
        cut = np.split(ids, until)
        return [None if text is None else own for text, own in zip(texts, cut)]

    def decode(self, ids: list[np.ndarray | None]) -> list[str | None]:
        """The texts of lists of ids. Bytes that are not UTF-8 become U+FFFD."""
        texts: list[str | None] = []
        for own in ids:
            if own is None:
                texts.append(None)
                continue
            data = b"".join(map(self.surface.__getitem__, own.tolist()))
            text = data.decode("utf-8", "replace")
            if self.vocabulary.dummy_prefix and text.startswith(" "):
                text = text[1:]
            texts.append(text)
        return texts


_last_received: list[PieceModel] = []


def _received(name: str, state: dict) -> PieceModel:
    """The model that this process has already, if it got it last; or a new one."""
    if not _last_received or _last_received[0].name != name:
        model = PieceModel.__new__(PieceModel)
        model.__dict__.update(state)
        model._forget()
        _last_received[:] = [model]
    return _last_received[0]


def load_model(path: str = MODEL) -> PieceModel:
    """Read a model file on the driver. Its size does not depend on the documents."""
    with open(path, "rb") as file:
        return PieceModel(read_vocabulary(file.read()))


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if own is None else len(own) for own in ids], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.concatenate([own for own in ids if own is not None] or [np.zeros(0, np.int32)])
    null = pa.array([own is None for own in ids], pa.bool_())
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values, pa.int32()), mask=null if null.true_count else None
    )


def encoder(model: PieceModel):
    """A function from a text column to an array of ids."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return in_parts(texts, lambda part: _lists(model.encode(part.to_pylist())))

    return encode


def decoder(model: PieceModel):
    """A function from a column of ids to a text column."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return in_parts(ids, joined)

    def joined(ids: pa.Array) -> pa.Array:
        own = [None if one is None else np.array(one, np.int32) for one in ids.to_pylist()]
        return pa.array(model.decode(own), pa.string())

    return decode


def encoder_with_check(model: PieceModel):
    """A function from a text column to a struct of ``ids`` and ``round_trip``, which tells
    whether decoding the ids gives the text again."""

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def encode(texts: pa.Array) -> pa.Array:
        return in_parts(texts, checked)

    def checked(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        ids = model.encode(texts)
        same = [a == b for a, b in zip(texts, model.decode(ids))]
        return pa.StructArray.from_arrays(
            [_lists(ids), pa.array(same, pa.bool_())], ["ids", "round_trip"]
        )

    return encode


def encode_documents(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``round_trip`` of each document.

    A null text has null ids and null ``n_tokens``; an empty one has no ids. Texts that
    hold the marker U+2581 itself decode to a space there, so their ``round_trip`` is
    false. Rows are encoded one by one, whatever repeats; a null ``doc_id`` is carried
    along. Other columns are ignored; an empty table gives an empty result.
    """
    encode = encoder_with_check(load_model(model))
    return documents.select("doc_id", encode("text").alias("made")).select(
        "doc_id",
        F.when(F.col("made.ids").isNotNull(), F.size("made.ids").cast("bigint")).alias("n_tokens"),
        "made.ids",
        "made.round_trip",
    )
