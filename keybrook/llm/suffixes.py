"""Removal of byte strings that occur more than once, by sorting suffixes.

All suffixes of a corpus are too many to sort, and almost all of them are unlike any
other. So in each window of ``LENGTH`` bytes the smallest hash of a shorter string in it is its
anchor, chosen by the window's content alone: equal windows have equal anchors. Windows
next to each other mostly share theirs and make a run. Equal runs are counted, and one stands
for all. Only runs whose anchor occurs in unlike ones too have their suffixes sorted, all that
share an anchor together: by a multikey quicksort to a shallow depth, and by blind tries where
the prefixes are still equal. Suffixes that are equal to the depth of a window are what is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from keybrook.llm.common import MOST_BROADCAST_ROWS, forget, look_up, written
from keybrook.llm.components import parts, whole_groups
from keybrook.llm.packed import packed_texts, unpacked
from keybrook.llm.word_hashes import prefix_sums, span_hashes

LENGTH = 200
ANCHOR = 100
SHALLOW_WORDS = 3
# Different runs with the same anchor, up to which they are sorted together. More are split by
# what stands around the anchor, and sorted likewise.
MOST_RUNS = 10_000

_PIECES = 4

_PART = 1 << 18
_PLACE_BITS = 21


def runs_of(data: bytes, length: int = LENGTH, anchor: int = ANCHOR):
    """Anchor hash, first window, number of windows of each run of a text.

    The anchor of a window is the smallest string hash in it, of equal ones the last.
    A long text is worked on in parts of a quarter of a million windows.
    """
    found = []
    for begin in range(0, len(data) - length + 1, _PART):
        part = np.frombuffer(data[begin : begin + _PART + length - 1], np.uint8)
        at = np.arange(len(part) - anchor + 1)
        hashes = span_hashes(prefix_sums(part), at, at + anchor)
        place_mask = np.uint64((1 << _PLACE_BITS) - 1)
        keys = (hashes & ~place_mask) | (place_mask - at.astype(np.uint64))
        least = _window_minima(keys, length - anchor + 1)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        sizes = np.diff(first, append=len(least))
        chosen = (place_mask - (least[first] & place_mask)).astype(np.int64)
        found.append((hashes[chosen], begin + first, sizes))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    return tuple(np.concatenate(column) for column in zip(*found))


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row: of the end of a block and the start of the next."""
    count = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, width)
    until = np.minimum.accumulate(padded, axis=1).reshape(-1)
    since = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(since[:count], until[width - 1 : width - 1 + count])


class BlindTrie:
    """Strings of one length in a trie that branches on one byte at a time.

    A node knows only where its strings differ. A string is led to a leaf by those
    bytes alone, compared with that leaf once, and inserted where the comparison ended.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.size = len(strings[0])
        self.root: list | None = None
        for number in range(len(strings)):
            self._insert(number)

    def _insert(self, number: int) -> None:
        string = self.strings[number]
        if self.root is None:
            self.root = [self.size, [number]]
            return
        node = self.root
        while node[0] < self.size:
            child = node[1].get(string[node[0]])
            node = child or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        if other == string:
            node[1].append(number)
            return
        different = int.from_bytes(string) ^ int.from_bytes(other)
        depth = self.size - (different.bit_length() + 7) // 8
        node = self.root
        while node[0] < depth:
            node = node[1][string[node[0]]]
        leaf = [self.size, [number]]
        if node[0] == depth:
            node[1][string[depth]] = leaf
            return
        node[0], node[1] = depth, {string[depth]: leaf, other[depth]: [node[0], node[1]]}

    def leaves(self) -> list[list[int]]:
        """The numbers of equal strings together, in the order of the strings."""
        found, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            if node[0] == self.size:
                found.append(node[1])
            else:
                waiting += [node[1][byte] for byte in sorted(node[1], reverse=True)]
        return found


def deep_shallow_sort(
    data: bytes, starts: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``starts`` by ``length`` bytes, and which equal the one
    before them in that order.

    Shallow: suffixes are parted by eight bytes at a time, those that are still together
    by the next eight. Deep: what shares all of these goes into blind tries; two suffixes
    need none, as they branch but once.
    """
    padded = np.frombuffer(data + bytes(8 * SHALLOW_WORDS), np.uint8)
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    active = np.arange(len(starts))
    view = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for word in range(min(SHALLOW_WORDS, length // 8)):
        at = starts[order[active]] + 8 * word
        key = np.ascontiguousarray(view[at]).view(">u8").reshape(-1).astype(np.uint64)
        turn = np.lexsort((key, group[active]))
        order[active] = order[active][turn]
        key, old = key[turn], group[active]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (old[1:] != old[:-1])))
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        sizes = np.bincount(group, minlength=len(starts))
        active = np.flatnonzero(sizes[group] > 1)
        if not len(active):
            break
    equal = np.zeros(len(starts), bool)
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(cuts, append=len(starts))
    _sort_pairs(padded, starts, length, order, equal, cuts[sizes == 2])
    for low, size in zip(cuts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = order[low : low + size].copy()
        trie = BlindTrie([data[at : at + length] for at in starts[own].tolist()])
        at = low
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = own[leaf]
            equal[at + 1 : at + len(leaf)] = True
            at += len(leaf)
    return order, equal


def _sort_pairs(padded, starts, length, order, equal, firsts) -> None:
    """Put groups of two in order in place, some thousand at a time."""
    view = np.lib.stride_tricks.sliding_window_view(padded, length)
    for low in range(0, len(firsts), 8_192):
        at = firsts[low : low + 8_192]
        one, two = view[starts[order[at]]], view[starts[order[at + 1]]]
        differ = one != two
        place = differ.argmax(axis=1)
        row = np.arange(len(at))
        equal[at + 1] = ~differ[row, place]
        turned = at[one[row, place] > two[row, place]]
        order[turned], order[turned + 1] = order[turned + 1], order[turned].copy()


def _repeated_windows(
    contents: list[bytes], groups: np.ndarray, copies: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that occur twice: the row of ``contents``, and their first and last place in it.

    Only windows of the same one of ``groups`` can be equal. ``copies`` says how often each row
    occurs. Equal contents are sorted once.
    """
    numbers: dict[bytes, int] = {}
    of_run = np.array([numbers.setdefault(content, len(numbers)) for content in contents])
    distinct = list(numbers)
    times = np.bincount(of_run, copies, minlength=len(distinct))
    sizes = np.array([len(content) for content in distinct])
    windows = sizes - length + 1
    flags = np.repeat(times > 1, windows)
    # A run that is alone in its group, but for its copies, meets no other.
    _, place = np.unique(groups, return_inverse=True)
    place_of = np.zeros(len(distinct), np.int64)
    place_of[of_run] = place
    sorted_too = np.bincount(place_of)[place_of] > 1
    owner = np.repeat(np.arange(len(distinct)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    taken = np.flatnonzero(sorted_too[owner])
    if len(taken):
        starts = (np.cumsum(sizes) - sizes)[owner[taken]] + offset[taken]
        order, equal = deep_shallow_sort(b"".join(distinct), starts, length)
        again = equal.copy()
        again[:-1] |= equal[1:]
        flags[taken[order[again]]] = True
    begins = np.cumsum(windows) - windows
    padded = np.zeros(len(flags) + len(distinct), np.int8)
    padded[np.arange(len(flags)) + owner] = flags
    edges = np.diff(padded, prepend=np.int8(0))
    lows, highs = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    places = begins + np.arange(len(distinct))
    run = np.searchsorted(places, lows, "right") - 1
    first, last = lows - places[run], highs - 1 - places[run]
    # The ranges of a run's content hold for each run that has it.
    low, high = np.searchsorted(run, of_run), np.searchsorted(run, of_run, "right")
    rows = np.repeat(np.arange(len(of_run)), high - low)
    ranges = np.arange(len(rows)) - np.repeat(np.cumsum(high - low) - high, high - low)
    return rows, first[ranges], last[ranges]


def _of_runs(table: pa.Table, length: int) -> pa.RecordBatch:
    copies = table["copies"].to_numpy()
    rows, first, last = _repeated_windows(
        table["content"].to_pylist(), table["anchor"].to_numpy(), copies, length
    )
    # Runs with copies are known to be repeated as a whole, and were sorted for the others.
    single = copies[rows] == 1
    rows, first, last = rows[single], first[single], last[single]
    at = table["at"].to_numpy()[rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(table["text_key"].to_numpy()[rows]), pa.array(at + first), pa.array(at + last)],
        ["text_key", "first", "last"],
    )


def context_pieces(
    content: bytes, length: int, anchor: int
) -> list[tuple[bytes, int, bytes]]:
    """A run in pieces (``context``, ``at``, ``content``), by what stands around its anchor.

    A window has ``length - anchor`` bytes beside its anchor. Windows with about as many
    of them to the right are a piece; all have some bytes on either side in common, and
    the anchor: the context. Equal windows have equal contexts.
    """
    beside = length - anchor
    width = beside // _PIECES + 1
    part = np.frombuffer(content[:length], np.uint8)
    at = np.arange(beside + 1)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    hashes = span_hashes(prefix_sums(part), at, at + anchor)
    place = int(((hashes & ~mask) | (mask - at.astype(np.uint64))).argmin())
    found = []
    for number in range(_PIECES):
        # The first window with so many bytes to the right of the anchor.
        right = number * width
        low = max(right + place - beside, 0)
        high = min(right + width - 1 + place - beside, len(content) - length)
        if low > high:
            continue
        left = max(beside - (right + width - 1), 0)
        context = bytes([number]) + content[place - left : place + anchor + right]
        found.append((context, low, content[low : high + length]))
    return found


def _hot_ranges(contents: DataFrame, length: int, anchor: int) -> DataFrame:
    """Ranges of repeated windows in runs without copies, for anchors with very many runs.

    Runs are split by context, so what meets in a task agrees in far more than the anchor, and
    equal pieces are counted and sorted as one.
    """

    def split(batches):
        for batch in parts(batches):
            rows = []
            for key, copies, at, content in zip(*[
                batch.column(name).to_pylist() for name in ("text_key", "copies", "at", "content")
            ]):
                rows += [
                    (key, copies, xxhash.xxh64_intdigest(context) - (1 << 63),
                     xxhash.xxh3_128_digest(piece), at + low, piece)
                    for context, low, piece in context_pieces(content, length, anchor)
                ]
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                ["text_key", "copies", "context", "piece", "at", "content"],
            )

    def sort(batches):
        for table, _ in whole_groups(batches, ["context"]):
            rows, first, last = _repeated_windows(
                table["content"].to_pylist(), table["context"].to_numpy(),
                table["copies"].to_numpy(), length,
            )
            yield pa.RecordBatch.from_arrays(
                [table["context"].take(pa.array(rows)).combine_chunks(),
                 table["piece"].take(pa.array(rows)).combine_chunks(),
                 pa.array(first), pa.array(last)],
                ["context", "piece", "low", "high"],
            )

    pieces = written(
        contents.select("text_key", "copies", "at", "content").mapInArrow(
            split,
            "text_key bigint, copies bigint, context bigint, piece binary, at bigint, "
            "content binary",
        ),
        "suffix-pieces",
    )
    distinct = pieces.groupBy("context", "piece").agg(
        F.any_value("content").alias("content"), F.sum("copies").alias("copies")
    )
    ranges = written(
        distinct.repartition("context").sortWithinPartitions("context").mapInArrow(
            sort, "context bigint, piece binary, low bigint, high bigint"
        ),
        "suffix-piece-ranges",
    )
    places = pieces.where("copies = 1").select("text_key", "context", "piece", "at")
    return look_up(places, ranges, ["context", "piece"], F.col("text_key")).select(
        "text_key",
        (F.col("at") + F.col("low")).alias("first"),
        (F.col("at") + F.col("high")).alias("last"),
    )


_RUN = ["anchor", "run", "windows"]


def _met(rows: DataFrame, table: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """Join with a written table of one row a key, which is broadcast if it is small.

    The table is not repeated for salts: it has about as many keys as there are runs, and few of
    them are hot. Those are left to adaptive execution.
    """
    small = table.count() <= MOST_BROADCAST_ROWS
    return rows.join(F.broadcast(table) if small else table, key, how)


def repeated_runs(places: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the places of runs, those whose run has another place, and the runs to be sorted.

    The first are ranges (``text_key``, ``first``, ``last``): all windows of a run that occurs
    twice are repeated. The second are different runs that share an ``anchor``: each once, at one
    of its places, with the number of its ``copies`` and of the different ``runs`` of its anchor.
    The third has these anchors. Runs are told apart by their anchor, their length and a hash of
    64 bits. What occurs in very many places costs a row per task here.
    """
    of_runs = written(
        places.groupBy(*_RUN).agg(
            F.count(F.lit(1)).alias("copies"),
            F.min_by("at", "text_key").alias("at"),
            F.min("text_key").alias("text_key"),
        ),
        "suffix-distinct-runs",
    )
    shared = written(
        of_runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1"),
        "suffix-anchors",
    )
    to_sort = _met(of_runs, shared, "anchor", "inner")
    copied = of_runs.where("copies > 1").select(*_RUN)
    whole = _met(places, copied, _RUN, "left_semi").select(
        "text_key",
        F.col("at").alias("first"),
        (F.col("at") + F.col("windows") - 1).alias("last"),
    )
    return whole, to_sort, shared


def repeated_ranges(documents: DataFrame, length: int, anchor: int, most_runs: int) -> DataFrame:
    """``ranges`` (arrays of ``first``, ``last``) of the starts of windows that occur in another
    place of the distinct texts, by ``text_key``."""

    def find(batches):
        for batch in parts(batches):
            keys, anchors, firsts, sizes, runs = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                data = text.encode("utf-8", "surrogatepass")
                found = runs_of(data, length, anchor)
                keys.append(np.full(len(found[0]), xxhash.xxh64_intdigest(data, 42), np.uint64))
                for column, part in zip((anchors, firsts, sizes), found):
                    column.append(part)
                runs += [
                    xxhash.xxh3_64_intdigest(data[low:high])
                    for low, high in zip(
                        found[1].tolist(), (found[1] + found[2] + length - 1).tolist()
                    )
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.concatenate(anchors).view(np.int64)),
                    pa.array(np.concatenate(firsts)),
                    pa.array(np.concatenate(sizes).astype(np.int32)),
                    pa.array(np.array(runs, np.uint64).view(np.int64)),
                ],
                ["text_key", "anchor", "at", "windows", "run"],
            )

    long_enough = documents.where(F.octet_length("text") >= length)
    runs = written(
        long_enough.select("text").mapInArrow(
            find, "text_key bigint, anchor bigint, at bigint, windows int, run bigint"
        ),
        "suffix-runs",
    )
    often = written(
        runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
        "suffix-often",
    )
    # Copies of a text are one text here.
    of_texts = written(
        _met(runs, often, "anchor", "left_semi").dropDuplicates(["text_key", "at"]),
        "suffix-candidates",
    )
    forget(runs)
    whole, to_sort, anchors = repeated_runs(of_texts)
    per_text = to_sort.groupBy("text_key").agg(
        F.collect_list(F.struct("anchor", "at", "windows", "runs", "copies")).alias("wanted")
    )
    first_copy = long_enough.groupBy(F.xxhash64("text").alias("text_key")).agg(
        F.min("doc_id").alias("copy")
    )
    wanted = per_text.join(first_copy, "text_key")
    kind = wanted.schema["wanted"].dataType

    def cut(batches):
        for batch in parts(batches):
            rows = []
            for key, packed, runs in zip(*[
                batch.column(name).to_pylist() for name in ("text_key", "packed", "wanted")
            ]):
                data = unpacked(packed)
                for run in runs:
                    at = run["at"]
                    rows.append((key, run["anchor"], run["runs"], run["copies"], at,
                                 data[at : at + run["windows"] + length - 1]))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, one) for column, one in zip(columns, kinds)],
                ["text_key", "anchor", "runs", "copies", "at", "content"],
            )

    assert kind.elementType.names == ["anchor", "at", "windows", "runs", "copies"]
    texts = packed_texts(long_enough).join(
        wanted.withColumnRenamed("text_key", "_key"),
        (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("copy")),
    )
    cut_schema = (
        "text_key bigint, anchor bigint, runs bigint, copies bigint, at bigint, content binary"
    )
    contents = texts.select("text_key", "packed", "wanted").mapInArrow(cut, cut_schema)
    is_hot = anchors.where(F.col("runs") > most_runs).limit(1).count() > 0
    if is_hot:
        contents = written(contents, "suffix-contents")

    def sort(batches):
        for table, _ in whole_groups(batches, ["anchor"]):
            yield _of_runs(table, length)

    ranges = whole.unionByName(
        contents.where(F.col("runs") <= most_runs)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(sort, "text_key bigint, first bigint, last bigint")
    )
    if is_hot:
        hot = contents.where(F.col("runs") > most_runs)
        ranges = ranges.unionByName(_hot_ranges(hot, length, anchor))
    return ranges.groupBy("text_key").agg(
        F.collect_list(F.struct("first", "last")).alias("ranges")
    )


def merged_spans(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The bytes that windows with these starts cover, as maximal runs."""
    spans: list[list[int]] = []
    for first, last in sorted(ranges):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last + length)
        else:
            spans.append([first, last + length])
    return [(low, high) for low, high in spans]


def without_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for low, high in spans:
        kept.append(data[at:low])
        at = high
    return b"".join([*kept, data[at:]])


def remove_repeats(
    documents: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    most_runs: int = MOST_RUNS,
) -> DataFrame:
    """Each document without the bytes of strings that occur elsewhere too.

    Returns ``doc_id``, ``n_bytes``, ``spans`` (removed, as ``low`` and ``high``), ``kept_bytes``.
    A string of ``length`` bytes is removed wherever it occurs if it starts in two places,
    be they in one document. Texts that are equal as a whole are removed as a whole
    if they are long enough. Null counts as empty; shorter texts lose nothing. Repeated
    rows are copies of each other, whatever their ``doc_id``, which may be null. Other
    columns are ignored; an empty table gives an empty result. Texts are told apart by a
    hash of 64 bits.
    """
    ranges = repeated_ranges(documents, length, anchor, most_runs)
    per_text = ranges.withColumnRenamed("text_key", "_key")
    copies = (
        documents.where(F.octet_length("text") >= length)
        .groupBy(F.xxhash64("text").alias("_key"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    found = written(per_text.join(copies, "_key", "full"), "suffix-ranges")

    def cut(batches):
        for batch in parts(batches):
            sizes, spans, kept = [], [], []
            for packed, ranges, copies in zip(*[
                batch.column(name).to_pylist() for name in ("packed", "ranges", "copies")
            ]):
                data = unpacked(packed)
                if copies:
                    own = [(0, len(data))]
                else:
                    own = merged_spans([(x["first"], x["last"]) for x in ranges or []], length)
                sizes.append(len(data))
                spans.append([{"low": low, "high": high} for low, high in own])
                kept.append(without_spans(data, own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("low", pa.int64()),
                                                        ("high", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "spans", "kept_bytes"],
            )

    texts = packed_texts(documents)
    return (
        texts.join(found, texts["text_key"] == found["_key"], "left")
        .select("doc_id", "packed", "ranges", "copies")
        .mapInArrow(
            cut,
            "doc_id bigint, n_bytes bigint, spans array<struct<low: bigint, high: bigint>>, "
            "kept_bytes binary",
        )
    )


def repeat_counts(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    removed = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, span: n + span["high"] - span["low"]
    )
    return remove_repeats(documents).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )
