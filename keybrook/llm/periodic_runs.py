"""Runs of repeated words, by longest common extensions from suffix trees.

A run is a stretch of words that repeats itself with some period, as far as it goes to both
sides. Every run has a Lyndon root: a word of one period that is smaller than its own
suffixes, in one of the two orders of letters, and so ends where the next smaller (or next
greater) suffix begins. That makes two candidates for each place of a text, and each is
extended to both sides by longest common extensions: of the text, and of its reversal.
An extension is the depth of a lowest common ancestor in a suffix tree, which is a
minimum over a stretch of its Euler tour, found in constant time.

Trees are built word by word, so a text is first looked through for what they need not
hold: all words of a run of exponent ``e`` occur ``e`` times in it, and all pairs of
neighbours ``e - 1`` times. A stretch of words that cannot lie in a run is one letter of
its own in the trees. No run is lost or shortened by that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keybrook.llm.common import let, word_list
from keybrook.llm.components import parts

LEAST_LENGTH = 6
LEAST_EXPONENT = 4

_BLOCK = 16
_RUN = "struct<start: bigint, length: bigint, period: bigint>"


def suffix_tree(letters: list[int]) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Ukkonen's tree of ``letters``, whose last one must occur nowhere else.

    Returns the children of each node by their first letter, the length of the edge to
    each node, and the suffix of each node, which is -1 but for leaves. Node 0 is the root.
    """
    n = len(letters)
    children: list[dict[int, int]] = [{}]
    starts, ends, links, suffixes = [0], [0], [0], [-1]
    node = edge = length = pending = made = 0
    for at, letter in enumerate(letters):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = at
            below = children[node]
            child = below.get(letters[edge])
            if child is None:
                below[letters[edge]] = len(starts)
                children.append({})
                starts.append(at)
                ends.append(n)
                links.append(0)
                suffixes.append(made)
                made += 1
                if unlinked:
                    links[unlinked] = node
                    unlinked = 0
            else:
                begin = starts[child]
                size = ends[child] - begin
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                if letters[begin + length] == letter:
                    length += 1
                    if unlinked:
                        links[unlinked] = node
                    break
                split, leaf = len(starts), len(starts) + 1
                below[letters[edge]] = split
                children += ({letters[begin + length]: child, letter: leaf}, {})
                starts += (begin, at)
                ends += (begin + length, n)
                links += (0, 0)
                suffixes += (-1, made)
                made += 1
                starts[child] = begin + length
                if unlinked:
                    links[unlinked] = split
                unlinked = split
            pending -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                edge = at - pending + 1
    sizes = [end - start for start, end in zip(starts, ends)]
    return children, sizes, suffixes


class CommonExtensions:
    """How far the suffixes of a text agree, for any two, in constant time each.

    ``order`` ranks the suffixes; ``between`` compares arrays of them. The Euler tour is cut
    into blocks of 16. A minimum over whole blocks comes from a table of
    minima over powers of two of them, and the rest from minima up to and from each place.
    """

    def __init__(self, letters: np.ndarray):
        self.size = len(letters)
        # -1, the smallest letter, ends the text and occurs nowhere else.
        children, sizes, suffixes = suffix_tree([*letters.tolist(), -1])
        tour: list[int] = []
        first = [0] * (self.size + 1)
        order: list[int] = []
        waiting = [(0, 0, iter(sorted(children[0].items())))]
        tour.append(0)
        while waiting:
            node, depth, rest = waiting[-1]
            for _, child in rest:
                deeper = depth + sizes[child]
                suffix = suffixes[child]
                if suffix >= 0:
                    first[suffix] = len(tour)
                    order.append(suffix)
                    tour += (deeper, depth)
                else:
                    tour.append(deeper)
                    waiting.append((child, deeper, iter(sorted(children[child].items()))))
                    break
            else:
                waiting.pop()
                if waiting:
                    tour.append(waiting[-1][1])
        self.rank = np.empty(self.size + 1, np.int64)
        self.rank[order] = np.arange(self.size + 1)
        self.first = np.array(first)
        width = -(-len(tour) // _BLOCK) + 1
        self.tour = np.full(width * _BLOCK, np.iinfo(np.int32).max, np.int32)
        self.tour[: len(tour)] = tour
        blocks = self.tour.reshape(width, _BLOCK)
        self.until = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        self.since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.powers = [blocks.min(axis=1)]
        step = 1
        while 2 * step <= width:
            last = self.powers[-1]
            self.powers.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The lengths of the longest common prefixes of suffixes ``a`` and ``b``, all unlike."""
        low, high = self.first[a], self.first[b]
        low, high = np.minimum(low, high), np.maximum(low, high)
        left, right = low // _BLOCK, high // _BLOCK
        found = np.minimum(self.since[low], self.until[high])
        same = np.flatnonzero(left == right)
        if len(same):
            places = low[same, None] + np.arange(_BLOCK)
            inside = places <= high[same, None]
            values = self.tour[np.minimum(places, len(self.tour) - 1)]
            found[same] = np.where(inside, values, np.iinfo(np.int32).max).min(axis=1)
        apart = right - left - 1
        for power, minima in enumerate(self.powers):
            these = np.flatnonzero((apart >> power == 1) & (apart > 0))
            if len(these):
                begin, end = left[these] + 1, right[these] - (1 << power)
                inner = np.minimum(minima[begin], minima[end])
                found[these] = np.minimum(found[these], inner)
        return found.astype(np.int64)


def _next_below(values: list[int]) -> list[int]:
    """For each place the next one with a smaller value, or the length."""
    found = [len(values)] * len(values)
    open_places: list[int] = []
    for place, value in enumerate(values):
        while open_places and values[open_places[-1]] > value:
            found[open_places.pop()] = place
        open_places.append(place)
    return found


def runs_of_letters(
    letters: np.ndarray, least_length: int, least_exponent: int
) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the runs of numbers of 0 or more, by start and period.

    ``least_exponent`` must be 2 or more.
    """
    n = len(letters)
    ahead, back = CommonExtensions(letters), CommonExtensions(letters[::-1])
    ranks = ahead.rank[:n].tolist()
    begin = np.concatenate([np.arange(n)] * 2)
    end = np.concatenate([_next_below(ranks), _next_below([-rank for rank in ranks])])
    inside = end < n
    begin, end = begin[inside], end[inside]
    period = end - begin
    start = begin - back.between(n - begin, n - end)
    stop = end + ahead.between(begin, end)
    length = stop - start
    long = (length >= least_exponent * period) & (length >= least_length)
    # What one root gives with a multiple of the period, another gives with the period.
    found: dict[tuple[int, int], int] = {}
    for low, size, own in zip(start[long].tolist(), length[long].tolist(), period[long].tolist()):
        found[low, size] = min(own, found.get((low, size), own))
    return sorted(
        ((low, size, own) for (low, size), own in found.items()), key=lambda run: (run[0], run[2])
    )


def _often(keys: np.ndarray, least: int) -> np.ndarray:
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[place] >= least


def stretches(
    words: np.ndarray, owner: np.ndarray, least_length: int, least_exponent: int
) -> Iterator[tuple[int, int]]:
    """Where runs can lie: (low, high) over the words of several texts, one after another.

    A run lies in one stretch, and the words around a stretch extend no run of it.
    """
    at = np.arange(len(words))
    piece = owner.astype(np.int64)
    width = int(words.max(initial=0)) + 1
    while len(at):
        before = len(at)
        pair = words[at[:-1]] * width + words[at[1:]]
        next_to = (at[1:] == at[:-1] + 1) & (piece[1:] == piece[:-1])
        # Numbers of the pairs, small enough to stand beside that of a piece.
        _, pair = np.unique(pair, return_inverse=True)
        joined = next_to & _often(
            np.where(next_to, piece[:-1] * (len(at) + 1) + pair + 1, -1 - np.arange(before - 1)),
            least_exponent - 1,
        )
        piece = np.concatenate(([0], np.cumsum(~joined)))
        sizes = np.bincount(piece)
        keep = sizes[piece] >= least_length
        keep &= _often(piece * width + words[at], least_exponent)
        at, piece = at[keep], piece[keep]
        if len(at) == before:
            cuts = np.flatnonzero(~joined) + 1
            lows = np.concatenate(([0], cuts))
            highs = np.concatenate((cuts, [before]))
            yield from zip(at[lows].tolist(), (at[highs - 1] + 1).tolist())
            return


def runs_of_texts(
    texts: list[list[bytes]], least_length: int, least_exponent: int
) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    numbers: dict[bytes, int] = {}
    words = np.array(
        [numbers.setdefault(word, len(numbers)) for text in texts for word in text], np.int64
    )
    sizes = np.array([len(text) for text in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    of_text: dict[int, list[tuple[int, int]]] = {}
    owner = np.repeat(np.arange(len(texts)), sizes)
    for low, high in stretches(words, owner, least_length, least_exponent):
        of_text.setdefault(int(owner[low]), []).append((low, high))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, places in of_text.items():
        letters, at = [], []
        for number, (low, high) in enumerate(places):
            letters += [words[low:high], [len(numbers) + number]]
            at += [np.arange(low, high) - begins[text], [-1]]
        letters, at = np.concatenate(letters), np.concatenate(at)
        found[text] = [
            (int(at[low]), size, period)
            for low, size, period in runs_of_letters(letters, least_length, least_exponent)
        ]
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if runs:
        cover = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            cover[start + period] += 1
            cover[start + length] -= 1
        dropped = np.cumsum(cover[:-1]) > 0
        words = [word for word, gone in zip(words, dropped.tolist()) if not gone]
    return b" ".join(words)


def collapse_runs(
    documents: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """``doc_id``, the ``runs`` of its words, and its text ``collapsed`` to one period of each.

    Runs have ``start`` (a word number from 0), ``length`` and ``period`` in words, and come by
    start, then period. A word goes if any run has it after its first period.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. A text is
    worked on whole, by one task, in memory in proportion to its words that may lie in runs.
    Each row stands for itself, so repeated rows give repeated rows; a null ``doc_id`` stays null.
    Other columns are ignored, and an empty table gives an empty result.
    """

    def find(batches):
        for batch in parts(batches):
            texts = [(text or b"").split() for text in batch.column("text").to_pylist()]
            runs = runs_of_texts(texts, least_length, least_exponent)
            kept = [collapsed(words, own) for words, own in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(runs), pa.array(kept, pa.binary())],
                ["doc_id", "runs", "collapsed"],
            )

    found = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(find, f"doc_id bigint, runs array<{_RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def _lists(runs: list[list[tuple[int, int, int]]]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(own) for own in runs]))).astype(np.int32)
    flat = np.array([run for own in runs for run in own], np.int64).reshape(-1, 3)
    columns = [pa.array(np.ascontiguousarray(flat[:, n])) for n in range(3)]
    records = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(offsets), records)


def planted(doc_id: Column, text: Column) -> Column:
    """The text in which a tenth of the documents, chosen by hash, repeat some of their words.

    With ``h`` the CRC-32 of the decimal ``doc_id`` and ``g = h / 10``, documents with ``h % 10 = 0``
    have their words from number ``a = g % n`` on replaced by repetitions of the first
    ``1 + (n - a) / (3 + g % 8)`` of these.
    """
    hashed = F.crc32(doc_id.cast("string"))

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        group = F.floor(hashed / 10)
        return let(
            F.struct(
                words.alias("words"),
                F.pmod(group, n).alias("a"),
                F.pmod(group, F.lit(8)).alias("rest"),
            ),
            lambda x: _repeated(x["words"], x["a"], n, x["rest"]),
        )

    def _repeated(words: Column, a: Column, n: Column, rest: Column) -> Column:
        period = F.lit(1) + F.floor((n - a) / (rest + 3))
        later = F.transform(
            F.sequence(a, n - 1), lambda i: F.get(words, (a + F.pmod(i - a, period)).cast("int"))
        )
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), later), " ")

    changed = let(
        word_list(text), lambda words: F.when(F.size(words) > 0, repeat(words)).otherwise(text)
    )
    return F.when(F.pmod(hashed, F.lit(10)) == 0, changed).otherwise(text)


def run_digests(documents: DataFrame) -> DataFrame:
    """The runs of all documents after ``planted``, counted and digested.

    ``doc_id``, ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` of the run with
    the greatest exponent (ties: smallest start, then period), null without runs;
    ``runs_sha256`` of all runs and ``collapsed_sha256`` of the words left.
    """
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        planted(F.col("doc_id").cast("bigint"), F.col("text")).alias("text"),
    )
    # Runs come by start and period, so the first of equals stays.
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat(
        F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    found = collapse_runs(texts).withColumn("_best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col("_best")[name].alias(name) for name in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period"))
        .cast("bigint")
        .alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
