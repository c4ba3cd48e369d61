"""Languages, pieces, packing, suffixes, near-duplicates and line chunks against plain code."""

from __future__ import annotations

import hashlib
import pathlib
import pickle
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import samples
import xxhash

from keybrook.llm import (
    language,
    line_chunks,
    packing,
    pieces,
    sketches,
    suffixes,
    word_hashes,
)
from keybrook.llm.components import components


def test_ngram_counts_by_hand():
    text = "Ab, ab\n\nC1"
    words = ["ab", "ab", "c"]
    padded = "_" + "_".join(words) + "_"
    expected = Counter(char for char in padded if char != "_")
    expected.update(padded[n : n + 2] for n in range(len(padded) - 1))
    expected.update(
        padded[n : n + 3] for n in range(len(padded) - 2) if padded[n + 1] != "_"
    )

    def key(ngram):
        value = 0
        for char in ngram:
            value = (value << 21) | (1 if char == "_" else ord(char))
        return value

    keys, counts = language.ngram_counts(text)
    assert dict(zip(keys.tolist(), counts.tolist())) == {key(g): n for g, n in expected.items()}


def test_distance_by_hand():
    a, b, c, d = 1 << 43, 2 << 43, 3 << 43, 4 << 43
    own = language.Profiles.of({"x": [a, b, c], "y": [c, a, d]}, 3)
    assert own.languages == ("x", "y")
    assert own.ranks.tolist() == [[0, 1], [1, 3], [2, 0], [3, 2]]


def plain_ngrams(text):
    """Counts of the 1- to 3-grams of the letters of a text, words parted by one mark."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = "_" + "_".join(words) + "_"
    found = Counter(c for c in padded if c != "_")
    found.update(padded[n : n + 2] for n in range(len(padded) - 1))
    found.update(padded[n : n + 3] for n in range(len(padded) - 2) if padded[n + 1] != "_")
    return found


def test_out_of_place_distance_equals_plain_code():
    def key(ngram):
        value = 0
        for char in ngram:
            value = (value << 21) | (1 if char == "_" else ord(char))
        return value

    size = 40
    pick = random.Random(8)

    def ordered(text):
        counts = plain_ngrams(text)
        return sorted(counts, key=lambda g: (-counts[g], key(g)))[:size]

    learned = {name: ordered(samples.prose(n, 300, language=name))
               for n, name in enumerate(["en", "de"])}
    # A third language with the profile of the first: of equal distances the first name counts.
    learned["zz"] = learned["en"]
    profiles = language.Profiles.of(
        {name: [key(g) for g in own] for name, own in learned.items()}, size
    )
    for n in range(60):
        text = samples.prose(100 + n, pick.randint(1, 80), language=pick.choice(["en", "de"]))
        own = ordered(text)
        distances = {
            name: sum(abs(profile.index(g) - rank) if g in profile else size
                      for rank, g in enumerate(own))
            for name, profile in learned.items()
        }
        name = min(sorted(distances), key=distances.get)
        assert profiles.best(text) == (name, 1 - distances[name] / (len(own) * size))
    assert profiles.best("ıxq")[0] == "de"  # nothing in common with any: the first name
    assert profiles.best("12 !") == profiles.best(None) == ("und", 0.0)


def test_languages_of_held_out_documents(spark):
    rows = [
        (n, samples.prose(n, 60, language=name), name)
        for n, name in enumerate(["en", "de"] * 60)
    ] + [(500, "123 !!", "en"), (501, None, "de"), (502, "", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {row.doc_id: row for row in language.predict_languages(frame).collect()}
    assert all(got[n].lang_pred == name for n, _, name in rows if n < 500)
    assert any(row.held_out for row in got.values())
    for n in (500, 501, 502):
        assert (got[n].lang_pred, got[n].score) == ("und", 0.0)
    assert all(0 <= row.score <= 1 for row in got.values())


# ---- pieces ----


@pytest.fixture(scope="module")
def model():
    return pieces.load_model()


def plain_path(model, text):
    """The best path of the whole text, one character after the other."""
    scores = {
        piece: (n, model.vocabulary.scores[n])
        for n, piece in enumerate(model.vocabulary.pieces)
        if model.vocabulary.kinds[n] == pieces.NORMAL
    }
    text = (" " + text).replace(" ", pieces.MARK)
    best = [(0.0, 0, None)] + [(-1e30, 0, None)] * len(text)
    for start in range(len(text)):
        options = [
            (text[start:end], *scores[text[start:end]])
            for end in range(start + 1, min(start + 20, len(text)) + 1)
            if text[start:end] in scores
        ]
        if not any(len(piece) == 1 for piece, _, _ in options):
            options.append((text[start], model.unknown, model.unknown_score))
        for piece, number, score in options:
            end = start + len(piece)
            if best[start][0] + score > best[end][0] + 1e-9:
                best[end] = (best[start][0] + score, start, number)
    return best[-1][0]


def path_score(model, ids, unknown):
    kinds, total, at = model.vocabulary.kinds, 0.0, 0
    for number in ids:
        if kinds[number] == pieces.BYTE:
            continue
        total += float(model.vocabulary.scores[number])
    return total + unknown * float(model.unknown_score)


def test_paths_are_the_best(model):
    texts = [samples.prose(n, 30) for n in range(5)] + ["naïve  two  spaces ", " x", "日本 語🎉", "a\nb"]
    for text, ids in zip(texts, model.encode(texts)):
        covered = "".join(
            piece for n, piece in enumerate(model.vocabulary.pieces)
            if model.vocabulary.kinds[n] == pieces.NORMAL and len(piece) == 1
        )
        unknown = sum(char not in covered for char in (" " + text).replace(" ", pieces.MARK))
        assert path_score(model, ids.tolist(), unknown) == pytest.approx(
            plain_path(model, text), abs=1e-3
        )


def as_unigram(model) -> bytes:
    """The model file with our scores, declared a unigram model."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, value):
        if isinstance(value, bytes):
            return varint(number << 3 | 2) + varint(len(value)) + value
        if isinstance(value, float):
            return varint(number << 3 | 5) + struct.pack("<f", value)
        return varint(number << 3) + varint(value)

    with open(pieces.MODEL, "rb") as file:
        data = file.read()
    out, n = b"", 0
    for number, value in pieces.fields(data):
        if number == 1:
            piece = dict(pieces.fields(value)) | {2: float(model.vocabulary.scores[n])}
            value, n = b"".join(field(k, v) for k, v in sorted(piece.items())), n + 1
        elif number == 2:
            value = b"".join(
                field(k, pieces.UNIGRAM if k == 3 else v) for k, v in pieces.fields(value)
            )
        out += field(number, value)
    return out


def test_ids_equal_the_library(model):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(
        model_proto=as_unigram(model)
    )
    # Word by word: the library adds up scores over a whole text in 32 bits, so far into a
    # text its choice between equally good paths is one of rounding.
    texts = [
        word for n in range(10) for name in ("en", "de")
        for word in samples.prose(n, 100, language=name).split()
    ]
    texts += ["", " ", "  a  b ", "x", "\n\n", "日本語 テキスト🎉", "trail  ", " lead", "\0 \0a"]
    for text, ids in zip(texts, model.encode(texts)):
        assert ids.tolist() == library.encode(text), text[:50]


def test_round_trip(model, rows):
    texts = [row.text for row in rows]
    assert model.decode(model.encode(texts)) == texts
    assert model.encode([None, ""])[0] is None and len(model.encode([""])[0]) == 0


def test_words_are_forgotten_without_harm(model, monkeypatch):
    texts = [samples.prose(n, 50) for n in range(20)]
    expected = [ids.tolist() for ids in model.encode(texts)]
    monkeypatch.setattr(pieces, "_MOST_WORDS", 30)
    monkeypatch.setattr(pieces, "_GROUP_CHARS", 100)
    assert [ids.tolist() for ids in model.encode(texts)] == expected


def test_tasks_of_a_process_share_the_words_they_learnt(model):
    sent = pickle.dumps(model)
    first, second = pickle.loads(sent), pickle.loads(sent)
    first.encode(["some words to learn"])
    assert second.places and second.encode(["some words"])[0].tolist() == (
        model.encode(["some words"])[0].tolist()
    )


# ---- packing ----


def test_best_fit_decreasing_equals_a_plain_search():
    pick = random.Random(3)
    for _ in range(100):
        length = pick.randint(3, 40)
        sizes = np.array([pick.randint(1, length) for _ in range(pick.randint(1, 50))])
        room, filled, order = [], [], []
        for piece in np.argsort(-sizes, kind="stable").tolist():
            fits = [n for n in range(len(room)) if room[n] >= sizes[piece]]
            if fits:
                least = min(room[n] for n in fits)
                row = [n for n in order if room[n] == least][-1]
                order.remove(row)
            else:
                row = len(room)
                room.append(length)
                filled.append([])
            room[row] -= sizes[piece]
            filled[row].append(piece)
            order.append(row)
        assert packing.best_fit_decreasing(sizes, length) == filled


def test_packing_loses_nothing(documents, rows, model, tmp_path):
    length = 256
    got = packing.pack_documents(documents, row_length=length, block_tokens=5_000).collect()
    found = defaultdict(list)
    for row in got:
        assert len(row.ids) == len(row.positions) == length
        assert row.segment_ends[0] == 0 and row.segment_ends[-1] == row.n_tokens
        assert set(row.ids[row.n_tokens :]) <= {packing.PAD_ID}
        for key, start, low, high in zip(
            row.doc_ids, row.doc_starts, row.segment_ends, row.segment_ends[1:]
        ):
            assert row.positions[low:high] == list(range(high - low))
            found[key].append((start, row.ids[low:high]))
    expected = defaultdict(list)
    for row, ids in zip(rows, model.encode([row.text for row in rows])):
        if ids is not None and len(ids):
            whole = [*ids.tolist(), packing.END_ID]
            expected[row.doc_id] += [
                (start, whole[start : start + length]) for start in range(0, len(whole), length)
            ]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    assert len({row.pack_id for row in got}) == len(got)

    packing.write_packed(documents, str(tmp_path / "packed"), row_length=length)
    stored = documents.sparkSession.read.parquet(str(tmp_path / "packed")).collect()
    assert all(len(row.ids) == 4 * length for row in stored)
    total = sum(len(part) for own in expected.values() for _, part in own)
    assert sum(row.n_tokens for row in stored) == total


# ---- suffixes ----


def test_deep_shallow_sort_equals_sorting():
    pick = random.Random(5)
    data = bytes(pick.choices(b"ab", k=800)) + b"abcabd" * 100 + bytes(pick.choices(b"a\0\xff", k=600))
    starts = np.arange(len(data) - 60)
    order, equal = suffixes.deep_shallow_sort(data, starts, 60)
    strings = [data[at : at + 60] for at in starts[order].tolist()]
    assert strings == sorted(strings) and sorted(order.tolist()) == list(range(len(starts)))
    assert equal.tolist() == [False, *(a == b for a, b in zip(strings, strings[1:]))]


def test_ranges_of_hot_runs_are_not_spread_into_rows(documents, plan_of):
    ranges = suffixes.repeated_ranges(documents, 60, 30, 1)
    assert "Generate" not in plan_of(ranges)


def test_ranges_of_hot_runs_need_no_join_by_run(documents, plan_of):
    plan = plan_of(suffixes.repeated_ranges(documents, 60, 30, 1))
    joins = re.findall(r"Join \[(\w+)#\d+L?(?:, (\w+)#\d+L?)?", plan)
    assert joins and not [keys for keys in joins if keys[0] == "run"]


def test_runs_that_were_filtered_leave_the_disk(documents, monkeypatch):
    made = []
    monkeypatch.setattr(
        suffixes, "written", lambda *of, write=suffixes.written: made.append(write(*of)) or made[-1]
    )
    suffixes.repeated_ranges(documents, 60, 30, 1)
    folders = [frame.inputFiles()[0].removeprefix("file://").rpartition("/")[0] for frame in made]
    left = [pathlib.Path(folder).exists() for folder in folders]
    assert left.count(False) == 1 and not left[0]


def test_equal_runs_are_counted_and_sorted_once(spark):
    # Anchor 1: one run at three places and another; anchor 2: one run twice; anchor 3: two runs.
    places = spark.createDataFrame(
        [(7, 1, 0, 5, 10), (8, 1, 3, 5, 10), (8, 1, 50, 5, 10), (9, 1, 4, 5, 11),
         (7, 2, 9, 2, 20), (9, 2, 9, 2, 20), (8, 3, 90, 4, 30), (9, 3, 91, 3, 31)],
        "text_key bigint, anchor bigint, at bigint, windows int, run bigint",
    )
    whole, to_sort, anchors = suffixes.repeated_runs(places)
    assert Counter(map(tuple, whole.collect())) == Counter(
        [(7, 0, 4), (8, 3, 7), (8, 50, 54), (7, 9, 10), (9, 9, 10)]
    )
    columns = ("anchor", "run", "windows", "copies", "runs", "text_key", "at")
    assert Counter(map(tuple, to_sort.select(*columns).collect())) == Counter(
        [(1, 10, 5, 3, 2, 7, 0), (1, 11, 5, 1, 2, 9, 4),
         (3, 30, 4, 1, 2, 8, 90), (3, 31, 3, 1, 2, 9, 91)]
    )
    assert Counter(map(tuple, anchors.collect())) == Counter([(1, 2), (3, 2)])


@pytest.mark.parametrize("most_runs", [100_000, 1])
def test_repeats(documents, rows, most_runs):
    length = 60
    data = [(row.text or "").encode() for row in rows]
    seen = Counter(d[n : n + length] for d in data for n in range(len(d) - length + 1))
    expected = Counter()
    for row, own in zip(rows, data):
        covered = np.zeros(len(own), bool)
        for n in range(len(own) - length + 1):
            if seen[own[n : n + length]] > 1:
                covered[n : n + length] = True
        kept = np.frombuffer(own, np.uint8)[~covered].tobytes()
        spans = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
        expected[row.doc_id, len(own), int(covered.sum()), spans, kept] += 1
    got = suffixes.remove_repeats(documents, length, 30, most_runs).collect()
    assert expected == Counter(
        (row.doc_id, row.n_bytes, sum(s.high - s.low for s in row.spans), len(row.spans),
         bytes(row.kept_bytes))
        for row in got
    )


def test_runs_of_a_long_text_are_cut_without_loss(monkeypatch):
    pick = random.Random(8)
    data = bytes(pick.choices(b"abcdefgh ", k=5_000))
    monkeypatch.setattr(suffixes, "_PART", 700)
    _, first, sizes = suffixes.runs_of(data, 100, 40)
    assert first[0] == 0 and (first[1:] == first[:-1] + sizes[:-1]).all()
    assert sizes.sum() == len(data) - 99


# ---- near-duplicates ----


@pytest.mark.parametrize("size, percent, longest_list", [(3, 85, 10_000), (5, 80, 10_000), (3, 85, 1)])
def test_near_duplicates(spark, documents, rows, size, percent, longest_list):
    base = samples.prose(999, 150).split(" ")
    pick = random.Random(4)
    edited = []
    for n in range(60):
        words = list(base)
        for _ in range(pick.randint(1, 9)):
            words[pick.randrange(len(words))] = f"edit{pick.randrange(1000)}"
        edited.append((1000 + n, " ".join(words), None, None, None))
    both = documents.union(spark.createDataFrame(edited, samples.SCHEMA))
    sets = {
        row[0]: samples.shingles(row[1], size)
        for row in [*rows, *edited] if row[0] is not None
    }
    groups = samples.group_of(sets, percent)
    got = sketches.near_duplicate_groups(both, size, percent, longest_list=longest_list).collect()
    for row in got:
        if row.doc_id is not None:
            assert row.n_shingles == len(sets[row.doc_id])
            assert row.component_id == groups[row.doc_id], row
            assert row.kept == (row.doc_id == row.component_id)
    assert len(got) == len(rows) + len(edited)
    assert max(Counter(groups.values()).values()) > 5


def test_links_of_a_list_follow_the_sketch_of_the_union(monkeypatch):
    monkeypatch.setattr(sketches, "BLOCK", 3)
    pick = random.Random(8)
    pool = [pick.getrandbits(64) for _ in range(90)]
    for count in [2] * 40 + [3, 8, 15] * 5:
        sets = [sorted(pick.sample(pool, pick.randint(2, 70))) for _ in range(count)]
        kept = [own[: sketches.SKETCH] for own in sets]
        parent = list(range(count))
        for a in range(count):
            for b in range(a):
                whole = [len(sets[n]) == len(kept[n]) for n in (a, b)]
                end = min(
                    [2**64] + [kept[n][-1] for n, all_of_it in zip((a, b), whole) if not all_of_it]
                )
                union = {x for n in (a, b) for x in sets[n] if x <= end}
                both = {x for x in sets[a] if x <= end and x in sets[b]}
                if both and len(both) >= sketches.LEAST_ESTIMATE * len(union):
                    low, high = sorted((parent[a], parent[b]))
                    parent = [low if x == high else x for x in parent]
        table = pa.table({
            "node": pa.array(range(count), pa.int64()),
            "n_shingles": pa.array([len(own) for own in sets], pa.int64()),
            "sketch": pa.array(
                [np.array(own, np.uint64).view(np.int64) for own in kept], pa.list_(pa.int64())
            ),
        })
        links = sketches._list_links(table, [0, count])
        assert links["a"].to_pylist() == parent


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    base = samples.prose(31, 80)
    rows = [(n, f"{base} tail{n}") for n in range(40)]
    monkeypatch.setattr(sketches, "BLOCK", 7)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sketches.near_duplicate_groups(frame).collect()
    assert {row.component_id for row in got} == {0} and len(got) == 40


def test_long_words_and_every_white_space():
    long = "q" * 2_500_000
    many = "\x0b".join(str(n) for n in range(200_000))
    mixed = f"a {long}\x0cb c\r{long} tail {long}x"
    for text, size in ((long, 1), (many, 199_998), (mixed, len(samples.shingles(mixed, 3)))):
        [hashes] = word_hashes.word_hashes([text.encode()])
        assert len(word_hashes.shingle_set(hashes, 3)) == size
    # A word has one hash, however long and wherever it stands.
    for size in (word_hashes._PART - 1, word_hashes._PART, word_hashes._PART + 1, 1_600_000):
        word = b"z" * size
        alone, between = word_hashes.word_hashes([word, b"k " + word + b"\tk"])
        assert len(alone) == 1 and len(between) == 3 and alone[0] == between[1]


@pytest.mark.parametrize("block", [3, 1024])
def test_parts_of_a_cluster_are_compared_across(spark, monkeypatch, block):
    """Chains, in which the smallest candidate is not always similar enough."""
    monkeypatch.setattr(sketches, "BLOCK", block)
    words = [f"w{n}" for n in range(400)]
    # Every fourth step is too wide for a link.
    starts = np.cumsum([0, *[12 if n % 4 == 0 else 4 for n in range(1, 40)]]).tolist()
    rows = [(n, " ".join(words[at : at + 120])) for n, at in enumerate(starts)]
    rows += [(100 + n, " ".join(words[:118] + [f"x{n}", f"y{n}"])) for n in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {n: samples.shingles(text, 3) for n, text in rows}
    got = {r.doc_id: r.component_id for r in sketches.near_duplicate_groups(frame).collect()}
    assert got == samples.group_of(sets, 85)
    assert len(set(got.values())) > 1


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    pick = random.Random(seed)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(130)]
    links += [(400 + n, 401 + n) for n in range(60)] + [(500, 500)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    parent = {n: n for link in links for n in link}

    def root(n):
        return n if parent[n] == n else root(parent[n])

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    expected = {n: root(n) for a, b in links if a != b for n in (a, b)}
    assert dict(map(tuple, components(frame).collect())) == expected


# ---- line chunks ----


def plain_chunk_sizes(lines):
    """Where the hash of the last two lines is a multiple of four, and after 256 lines."""
    mask, sizes, size = (1 << 64) - 1, [], 0
    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
    for n, own in enumerate(hashes):
        before = hashes[n - 1] if n else 0
        rolling = ((before << 1 | before >> 63) & mask) ^ own
        size += 1
        if ((rolling * 0x9E3779B97F4A7C15 & mask) >> 40) % 4 == 0 or size == 256:
            sizes.append(size)
            size = 0
    return sizes + ([size] if size else [])


def test_line_chunks(documents, rows):
    def order(row):
        return (row.doc_id is None, row.doc_id or 0)

    seen, kept, first = set(), {}, {}
    for row in sorted(rows, key=order):
        if (row.doc_id, row.text) in kept:
            continue
        out, at, removed, n_lines = [], 0, 0, 0
        lines = (row.text or "").encode().split(b"\n")
        for size in plain_chunk_sizes(lines) if row.text else []:
            chunk = b"\n".join(lines[at : at + size])
            if size > 1 and chunk.strip() and chunk in seen:
                removed += 1
                n_lines += size
            else:
                out += lines[at : at + size]
                if size > 1:
                    seen.add(chunk)
            at += size
        total = 0 if row.text is None else len(lines)
        kept[row.doc_id, row.text] = (total, removed, n_lines, b"\n".join(out))
    got = line_chunks.chunk_dedup(documents).collect()
    expected = Counter()
    for row in rows:
        *counts, left = kept[row.doc_id, row.text]
        expected[row.doc_id, *counts, hashlib.sha256(left).hexdigest()] += 1
    assert Counter(
        (r.doc_id, r.n_lines, r.n_removed_chunks, r.n_removed_lines, r.kept_sha256) for r in got
    ) == expected
    assert sum(r.n_removed_chunks for r in got) > 3


def test_boundaries_do_not_shift():
    lines = [f"line {n}".encode() for n in range(200)]
    ends = set(np.cumsum(line_chunks.chunk_sizes(lines)).tolist())
    moved = set((np.cumsum(line_chunks.chunk_sizes([b"new", *lines])) - 1).tolist())
    assert {end for end in ends if end > 3} == {end for end in moved if end > 3}
