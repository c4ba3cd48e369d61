"""Near-duplicate groups from bottom-k sketches.

One hash function gives each document the set of the hashes of its word shingles; the
smallest of them are its sketch. Inverted lists of retained values bring together
documents that may be similar; in each list the sketch of the union of two sets estimates
their similarity and filters; what passes makes up small clusters, in which the
similarity of full sets decides: first that of each class and one other, then, in clusters
that this leaves in parts, that of all that lie in different parts.

The sketch of a union is what both sketches hold up to the smaller of their largest
values: up to there nothing of either set is missing. The part of it that is in both
sketches estimates the similarity, and is the similarity itself if both sketches hold
their whole sets.

Two documents above the threshold share most of their sketches. So lists are kept by
two values that follow each other in a sketch, which is far rarer than one value; a list that
is still too long is split by the value after these. (At a similarity of 0.85 and 32
values, two documents miss each other in all lists of three with a chance of about 1 in a
million.) A cluster may hold more than it must, so nothing is lost by a list that is
taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from keybrook.llm.common import written
from keybrook.llm.components import components, parts, whole_groups
from keybrook.llm.packed import chosen_texts, unpacked
from keybrook.llm.word_hashes import LOWER, shingle_set, word_hashes

SHINGLE_WORDS = 3
PERCENT = 85
SKETCH = 32
# An estimate below this comes from sets far below the threshold: of 32 values or more in
# the union's sketch, with a similarity of 0.8 less than 40% are shared about once in a million.
LEAST_ESTIMATE = 0.4
LONGEST_LIST = 10_000
BLOCK = 1_024

_SETS = "doc_id bigint, n_shingles bigint, set_id binary, sketch array<bigint>"


def _sets(texts: list[bytes], shingle_words: int) -> list[np.ndarray]:
    lower = [text.translate(LOWER) for text in texts]
    return [shingle_set(words, shingle_words) for words in word_hashes(lower)]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(own) for own in values]))).astype(np.int32)
    flat = np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def sketches_of(documents: DataFrame, shingle_words: int, sketch: int) -> DataFrame:
    """Of each document the size and a 128-bit digest of its set, and its sketch.

    The order of a sketch is that of its values as unsigned numbers.
    """

    def measure(batches):
        for batch in parts(batches):
            texts = [
                (text or "").encode("utf-8", "surrogatepass")
                for text in batch.column("text").to_pylist()
            ]
            sets = _sets(texts, shingle_words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(own.tobytes()) for own in sets], pa.binary()),
                    _lists([own[:sketch] for own in sets]),
                ],
                ["doc_id", "n_shingles", "set_id", "sketch"],
            )

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        measure, _SETS
    )


def _keyed(rows: DataFrame, length: int) -> DataFrame:
    """Add the ``list`` of ``length`` values that starts at ``at``; none where the sketch ends."""
    parts = [F.get("sketch", F.col("at") + step) for step in range(length)]
    return rows.where(F.col("at") + length <= F.size("sketch")).withColumn(
        "list", F.xxhash64(*parts)
    )


def candidate_links(classes: DataFrame, longest_list: int) -> DataFrame:
    """Links (``a``, ``b``) that join all classes which may be similar.

    In each list, classes whose union's sketch says that they are similar enough are
    linked along a forest, so a list never gives more links than it has members.
    """
    places = F.explode(F.sequence(F.lit(0), F.greatest(F.size("sketch") - 2, F.lit(0))))
    pending = _keyed(classes.select("node", places.alias("at"), "sketch"), 2).drop("sketch")
    found = []
    for length in (2, 3):
        sizes = written(
            pending.groupBy("list").agg(F.count(F.lit(1)).alias("members"),
                                        F.min("node").alias("least")).where("members > 1"),
            "sketch-lists",
        )
        short = pending.join(sizes.where(F.col("members") <= longest_list), "list")
        found.append(short.select("list", "node"))
        long = sizes.where(F.col("members") > longest_list)
        if not long.limit(1).count():
            long = None
            break
        rest = pending.join(long, "list")
        if length == 2:
            pending = _keyed(
                rest.select("node", "at").join(classes.select("node", "sketch"), "node"), 3
            ).drop("sketch")
    members = found[0] if len(found) == 1 else found[0].union(found[1])
    full = members.join(classes.select("node", "n_shingles", "sketch"), "node")

    def link(batches):
        for table, cuts in whole_groups(batches, ["list"]):
            yield _list_links(table, cuts)

    links = (
        # By node, so that lists with the same members give the same links.
        full.repartition("list").sortWithinPartitions("list", "node")
        .mapInArrow(link, "a bigint, b bigint")
    )
    if long is not None:
        links = links.union(rest.select(F.col("least").alias("a"), F.col("node").alias("b")))
    return links.where("a <> b").distinct()


def _elements(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a column of lists, and where each list begins and ends in them."""
    lists = pa.concat_arrays(table[name].chunks)
    return lists.values.to_numpy(), lists.offsets.to_numpy()


def _list_links(table: pa.Table, cuts: list[int]) -> pa.RecordBatch:
    nodes = table["node"].to_numpy()
    values, offsets = _elements(table, "sketch")
    values = values.view(np.uint64)
    kept = np.diff(offsets)
    # Up to its end a sketch holds all of its set.
    ends = np.full(len(nodes), np.iinfo(np.uint64).max)
    cut_off = table["n_shingles"].to_numpy() > kept
    ends[cut_off] = values[offsets[1:][cut_off] - 1]
    roots = np.arange(len(nodes))
    for low, high in zip(cuts[:-1], cuts[1:]):

        def up_to(rows, others):
            """How many values of each sketch of ``rows`` lie up to the ends of ``others``."""
            found = np.empty((len(rows), len(others)), np.float32)
            for place, row in enumerate((low + rows).tolist()):
                sketch = values[offsets[row] : offsets[row + 1]]
                found[place] = np.searchsorted(sketch, ends[low + others], "right")
            return found

        def enough(shared, i, j):
            union = up_to(i, j) + up_to(j, i).T - shared
            return (shared > 0) & (shared >= LEAST_ESTIMATE * union)

        own = values[offsets[low] : offsets[high]]
        if high - low == 2:
            first, second = own[: kept[low]], own[kept[low] :]
            shared = len(np.intersect1d(first, second, assume_unique=True))
            union = (
                np.searchsorted(first, ends[low + 1], "right")
                + np.searchsorted(second, ends[low], "right")
                - shared
            )
            if shared and shared >= LEAST_ESTIMATE * union:
                roots[low + 1] = low
        else:
            owner = np.repeat(np.arange(high - low), kept[low:high])
            roots[low:high] = low + linked_roots(owner, own, high - low, enough)
    return pa.RecordBatch.from_pydict({"a": nodes[roots], "b": nodes})


def linked_roots(owner, values, count: int, enough, first: int | None = None) -> np.ndarray:
    """For each of ``count`` sets the smallest number of a set that it is linked with.

    ``owner`` and ``values`` are the elements of all sets. The sizes of intersections
    of a block of sets with another come from a product of matrices over the elements
    they share; ``enough(shared, i, j)`` decides. ``first`` limits the pairs to those
    of one set below it and one set from it on.
    """
    parent = np.arange(count)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, column = owner[common], column[common]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    column = np.cumsum(np.diff(column, prepend=column[:1]) > 0)
    width = int(column[-1]) + 1 if len(column) else 0

    def side(numbers, part, begin, size):
        inside = (owner[part] >= numbers[0]) & (owner[part] <= numbers[-1])
        matrix = np.zeros((len(numbers), size), np.float32)
        matrix[owner[part][inside] - numbers[0], column[part][inside] - begin] = 1
        return matrix

    middle = count if first is None else first
    for low in range(0 if first is None else first, count, BLOCK):
        i = np.arange(low, min(low + BLOCK, count))
        for other in range(0, low + 1 if first is None else middle, BLOCK):
            j = np.arange(other, min(other + BLOCK, middle))
            shared = np.zeros((len(i), len(j)), np.float32)
            for begin in range(0, width, BLOCK):
                part = slice(*np.searchsorted(column, (begin, begin + BLOCK)))
                size = min(BLOCK, width - begin)
                shared += side(i, part, begin, size) @ side(j, part, begin, size).T
            linked = enough(shared, i, j)
            labels = np.fromiter(map(root, j.tolist()), np.int64, len(j))
            for row in np.flatnonzero(linked.any(axis=1)).tolist():
                near = np.unique(labels[linked[row]]).tolist()
                joined = {root(x) for x in (*near, int(i[row]))}
                least = min(joined)
                for x in joined:
                    parent[x] = least
                if len(near) > 1 or near[0] != least:
                    labels[linked[row]] = least
    return np.fromiter(map(root, range(count)), np.int64, count)


def _sets_in_cells(wanted: DataFrame, texts: DataFrame, shingle_words: int) -> DataFrame:
    """One row per cell that a node is ``wanted`` in: the fields of the cell, ``node``, and the
    ``elements`` of its full set."""

    def measure(batches):
        for batch in parts(batches):
            data = [unpacked(packed) for packed in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("cells"), _lists(_sets(data, shingle_words))],
                ["node", "cells", "elements"],
            )

    kind = wanted.schema["cells"].dataType.simpleString()
    # The hint makes large and small inputs take the same way.
    sets = texts.join(wanted.hint("merge"), "node").select("node", "packed", "cells").mapInArrow(
        measure, f"node bigint, cells {kind}, elements array<bigint>"
    )
    return sets.select("node", F.explode("cells").alias("cell"), "elements").select(
        "cell.*", "node", "elements"
    )


def confirmed_links(
    links: DataFrame, texts: DataFrame, shingle_words: int, percent: int
) -> DataFrame:
    """Of the candidate links, one of each class, those that full sets confirm.

    Each class is compared with the smallest one that it may be like. Those that are
    compared with the same one come to it by ``BLOCK``.
    """
    least = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("hub"))
    hubs = least.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = least.join(hubs, "hub").select(
        "node", "hub", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.lit(1).alias("later"),
    )
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    of_hubs = hubs.select(
        F.col("hub").alias("node"), "hub", all_blocks.alias("block"), F.lit(0).alias("later")
    )
    wanted = own.union(of_hubs).groupBy("node").agg(
        F.collect_list(F.struct("hub", "block", "later")).alias("cells")
    )

    def compare(batches):
        for table, cuts in whole_groups(batches, ["hub", "block"]):
            for low, high in zip(cuts[:-1], cuts[1:]):
                yield _like_the_first(table.slice(low, high - low), percent)

    return (
        _sets_in_cells(wanted, texts, shingle_words)
        .repartition("hub", "block")
        .sortWithinPartitions("hub", "block", "later")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _like_the_first(table: pa.Table, percent: int) -> pa.RecordBatch:
    """Links of the rows with those that are not ``later``, which are of one document."""
    values, offsets = _elements(table, "elements")
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values = values[offsets[0] : offsets[-1]]
    later = table["later"].to_numpy().astype(bool)
    linked = np.zeros(len(sizes), bool)
    for hub in np.flatnonzero(~later).tolist():
        inside = np.isin(values, values[owner == hub])
        shared = np.bincount(owner[inside], minlength=len(sizes))
        linked |= 100 * shared >= percent * (sizes + sizes[hub] - shared)
    linked &= later
    return pa.RecordBatch.from_pydict({
        "a": table["hub"].to_numpy()[linked], "b": table["node"].to_numpy()[linked]
    })


def exact_links(
    clusters: DataFrame, texts: DataFrame, shingle_words: int, percent: int
) -> DataFrame:
    """Links (``a``, ``b``) between similar documents of a cluster, along a forest.

    ``clusters`` have ``component``, ``node`` and ``part``: nodes of one part are linked already. A
    cluster of up to ``BLOCK`` documents is worked on by one task. A larger one is cut into
    blocks, those of its largest part and those of all others, and each pair of blocks is a
    task of its own, save pairs inside the largest part, where nothing is left to find.
    """
    sizes = clusters.groupBy("component", "part").agg(F.count(F.lit(1)).alias("size"))
    shapes = sizes.groupBy("component").agg(
        F.sum("size").alias("all"), F.max(F.struct("size", "part")).alias("main")
    )
    few = F.col("all") <= BLOCK
    main = F.when(few, 0).otherwise(F.ceil(F.col("main.size") / BLOCK)).cast("int")
    rest = F.when(few, 1).otherwise(F.ceil((F.col("all") - F.col("main.size")) / BLOCK)).cast("int")
    dealt = clusters.join(
        shapes.select("component", F.col("main.part").alias("main_part"),
                      main.alias("main"), rest.alias("rest")),
        "component",
    )
    hashed = F.xxhash64("node")
    in_main = (F.col("main") > 0) & (F.col("part") == F.col("main_part"))
    block = F.when(in_main, F.col("rest") + F.pmod(hashed, F.col("main"))).otherwise(
        F.pmod(hashed, F.greatest("rest", F.lit(1)))
    ).cast("int")
    others = F.when(in_main, F.col("rest")).otherwise(F.col("rest") + F.col("main"))
    cells = F.transform(
        F.sequence(F.lit(0), others - 1),
        lambda other: F.struct(
            F.col("component"),
            F.least("block", other).alias("low"),
            F.greatest("block", other).alias("high"),
            F.col("block"),
        ),
    )
    wanted = dealt.withColumn("block", block).select("node", cells.alias("cells"))

    def link(batches):
        for table, cuts in whole_groups(batches, keys):
            for low, high in zip(cuts[:-1], cuts[1:]):
                yield _cell_links(table.slice(low, high - low), percent)

    keys = ["component", "low", "high"]
    return (
        _sets_in_cells(wanted, texts, shingle_words)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "block", "node")
        .mapInArrow(link, "a bigint, b bigint")
        .where("a <> b")
    )


def _cell_links(table: pa.Table, percent: int) -> pa.RecordBatch:
    nodes = table["node"].to_numpy()
    values, offsets = _elements(table, "elements")
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(nodes)), sizes)

    def enough(shared, i, j):
        total = sizes[i][:, None] + sizes[j][None, :]
        return (shared > 0) & (100 * shared >= percent * (total - shared))

    first = None
    if table["low"][0].as_py() != table["high"][0].as_py():
        first = int(np.searchsorted(table["block"].to_numpy(), table["high"][0].as_py()))
    own = values[offsets[0] : offsets[-1]]
    roots = linked_roots(owner, own, len(nodes), enough, first)
    return pa.RecordBatch.from_pydict({"a": nodes[roots], "b": nodes})


def near_duplicate_groups(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    sketch: int = SKETCH,
    longest_list: int = LONGEST_LIST,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each document.

    Documents with equal sets are one class, which takes part once. The component of a
    document is the smallest ``doc_id`` that links lead to. Null and empty texts, and those
    of white space, have no shingles and are linked with nothing, not even each other.
    Rows with the same ``doc_id`` are one document, and linked. A row without a ``doc_id`` cannot be
    named: its component is that of the documents with the same set, or null, and it
    is kept if it has none. Other columns are ignored; an empty table gives no rows.
    """
    measured = written(sketches_of(documents, shingle_words, sketch), "sketches")
    classes = written(
        measured.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("first"))
        .select("set_id", F.col("first.doc_id").alias("node"), "first.n_shingles", "first.sketch"),
        "sketch-classes",
    )
    links = written(candidate_links(classes, longest_list), "candidate-links")
    clusters = components(links)
    texts = written(chosen_texts(documents, clusters), "cluster-texts")
    confirmed = written(confirmed_links(links, texts, shingle_words, percent), "confirmed-links")
    in_parts = clusters.join(
        components(confirmed).withColumnRenamed("component", "part"), "node", "left"
    ).withColumn("part", F.coalesce("part", "node"))
    parted = written(in_parts, "parts")
    # A cluster of one part is settled.
    is_open = F.min("part") < F.max("part")
    apart = parted.groupBy("component").agg(is_open.alias("open")).where("open")
    rest = exact_links(
        written(parted.join(apart.select("component"), "component"), "open-clusters"),
        texts, shingle_words, percent,
    )
    # Where several sets have the same smallest document, that links them.
    linked = components(confirmed.union(rest))
    named = written(
        classes.select("set_id", "node")
        .join(linked, "node", "left")
        .select("set_id", F.coalesce("component", "node").alias("component_id")),
        "near-components",
    )
    found = measured.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    component = F.coalesce(own, F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept",
        F.col("component_id").isNull()
        | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)),
    )


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1),
      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS origin FROM words
  UNION
  SELECT b, origin FROM reached JOIN steps ON a = node),
components AS (SELECT node, min(origin) AS component_id FROM reached GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM words LEFT JOIN sizes USING (doc_id) JOIN components ON node = doc_id
"""
