"""Runs, collocations and nearest vectors against plain code."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import samples

from keybrook.llm import collocations, multi_index, periodic_runs

# ---- runs ----


def plain_runs(words, least_length=6, least_exponent=4):
    """(start, length, smallest period), by trying every period."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            stop = at
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            length = stop - at + period
            if length >= max(least_length, least_exponent * period):
                found.setdefault((at, length), period)
            at = stop + 1
    return sorted(((low, n, q) for (low, n), q in found.items()), key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_equal_trying_every_period(letters):
    pick = random.Random(letters)
    texts = []
    for _ in range(300):
        words = [b"%d" % pick.randint(0, letters) for _ in range(pick.randint(0, 70))]
        if len(words) > 8 and pick.random() < 0.5:
            at, period = pick.randrange(len(words)), pick.randint(1, 7)
            block = words[at : at + period]
            words[at:] = [block[n % len(block)] for n in range(len(words) - at)]
        texts.append(words)
    for limits in ((6, 4), (2, 2), (9, 3)):
        assert periodic_runs.runs_of_texts(texts, *limits) == [
            plain_runs(words, *limits) for words in texts
        ]


def test_common_extensions_equal_comparing():
    pick = random.Random(3)
    letters = np.array([pick.randint(0, 2) for _ in range(400)])
    extensions = periodic_runs.CommonExtensions(letters)
    a = np.array([pick.randrange(400) for _ in range(2000)])
    b = np.array([pick.randrange(400) for _ in range(2000)])
    a, b = a[a != b], b[a != b]
    text = letters.tolist()

    def common(i, j):
        size = 0
        while max(i, j) + size < 400 and text[i + size] == text[j + size]:
            size += 1
        return size

    assert extensions.between(a, b).tolist() == [common(i, j) for i, j in zip(a, b)]


def plain_digests(doc_id, text):
    words = samples.words_of(text)
    n = len(words)
    if doc_id is not None:
        hashed = zlib.crc32(str(doc_id).encode())
        group = hashed // 10
        if hashed % 10 == 0 and n:
            a = group % n
            period = 1 + (n - a) // (3 + group % 8)
            words = [words[i if i < a else a + (i - a) % period] for i in range(n)]
    runs = plain_runs(words)
    dropped = {at for low, size, q in runs for at in range(low + q, low + size)}
    kept = " ".join(word for at, word in enumerate(words) if at not in dropped)
    lines = "".join(f"{low},{size},{q}\n" for low, size, q in runs)
    top = (None,) * 4
    if runs:
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]))
        top = (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *top, *[
        hashlib.sha256(value.encode()).hexdigest() for value in (lines, kept)
    ])


def test_run_digests(spark):
    rows = [(n, samples.prose(n, 30 + 3 * n)) for n in range(150)]
    rows += [(1000 + n, "a b c " * 9 + "d " * 20) for n in range(30)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (None, "x " * 9), (None, None)]
    rows += [(2003, "é 日本 " * 8 + "z" * 100_000), rows[3], rows[3]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = periodic_runs.run_digests(frame).collect()
    assert Counter(map(tuple, got)) == Counter(plain_digests(*row) for row in rows)
    assert sum(row.n_runs > 0 for row in got) > 40


# ---- collocations ----


def plain_collocations(rows, top=2000, least=10):
    counts = defaultdict(Counter)
    totals = Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = (text or "").translate(samples.LOWER)
        for mark in ",;:!?\n\x0b\x0c\r":
            text = text.replace(mark, ".")
        for piece in text.split("."):
            words = [word for word in piece.replace("\t", " ").split(" ") if word]
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for at in range(len(words) - size + 1):
                    counts[lang][tuple(words[at : at + size])] += 1
    found = []
    for lang, grams in counts.items():
        kept = []
        for gram, a in grams.items():
            if len(gram) < 2 or a < least:
                continue
            cuts = [(grams[gram[:k]], grams[gram[k:]]) for k in range(1, len(gram))]
            scored = [(10**6 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts)]
            score, _, l, r = min(scored)
            longer = [n for other, n in grams.items() if n >= least and len(other) == 3
                      and gram in (other[:2], other[1:])] if len(gram) == 2 else []
            if not any(100 * n >= 50 * a for n in longer):
                kept.append((-score, -a, " ".join(gram).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


@pytest.mark.parametrize("top, few", [(3, 10**6), (20, 10**6), (20, 0), (2000, 10**6)])
def test_collocations_equal_counting_everything(spark, monkeypatch, top, few):
    # With and without opened pairs that are too many to be sent to all texts.
    monkeypatch.setattr(collocations, "MOST_KNOWN", few)
    pick = random.Random(5)
    words = [f"{letter}{n}" for letter in "AbÉ" for n in range(12)]
    fixed = [pick.choices(words, k=pick.randint(2, 4)) for _ in range(30)]

    def text():
        made = []
        for _ in range(pick.randint(1, 60)):
            made += pick.choice(fixed) if pick.random() < 0.4 else [pick.choice(words)]
            if pick.random() < 0.1:
                made[-1] += pick.choice([".", ", ", "\n", "!?", "\t", " \x0b"])
        return " ".join(made)

    rows = [(text(), pick.choice(["en", "en", "de", None])) for _ in range(300)]
    rows += [(None, "en"), ("", "fr"), ("...", "fr"), ("one", "fr"), rows[0], rows[0]]
    rows += [("x y " * 30_000, "de")]
    frame = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)],
                                  "doc_id bigint, text string, lang string")
    got = collocations.collocations(frame, top)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, top)


# ---- nearest vectors ----


def plain_nearest(rows, count=20):
    usable = [(key, vector) for key, vector in rows if key is not None and vector and all(
        x is not None and math.isfinite(x) for x in vector) and any(vector)]
    found = {}
    for key, query in usable:
        if key % 20 == 0:
            near = sorted(
                (-math.fsum(x * y for x, y in zip(query, vector)), other)
                for other, vector in usable if other != key
            )
            found[key] = [(other, -minus) for minus, other in near[:count]]
    return found


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def answers(frame):
    found = defaultdict(list)
    for row in frame.orderBy("query_id", "rank").collect():
        assert row.rank == len(found[row.query_id]) + 1
        found[row.query_id].append((row.vec_id, row.score))
    return dict(found)


def test_nearest_of_few_vectors_with_all_odd_cases(spark):
    pick = random.Random(2)
    rows = [(n, [pick.choice([-2.0, -1.0, 0.0, 1.0, 2.0]) for _ in range(6)]) for n in range(150)]
    rows += [(n, [1.0] * 6) for n in range(200, 300)]
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [None, 1.0]), (304, [math.nan] * 6),
             (305, [math.inf] * 6), (None, [1.0] * 6), (320, [1.0, 2.0]), (201, [1.0] * 6)]
    got = answers(multi_index.nearest_vectors(vectors_frame(spark, rows)))
    expected = plain_nearest(list({repr(row): row for row in rows}.values()))
    assert got.keys() == expected.keys()
    # Codes may miss some of the neighbours, but not many, and what is found is exact.
    found = {key: dict(own) for key, own in got.items()}
    same = sum(len(own.keys() & dict(expected[key]).keys()) for key, own in found.items())
    assert same >= 0.9 * sum(map(len, expected.values()))
    vectors = {key: vector for key, vector in rows}
    for key, own in got.items():
        assert own == sorted(own, key=lambda one: (-one[1], one[0])) and key not in dict(own)
        for other, score in own:
            assert score == math.fsum(x * y for x, y in zip(vectors[key], vectors[other]))


@pytest.mark.parametrize("kind", ["even", "clusters", "norms"])
def test_recall(spark, kind, monkeypatch):
    # Less than all rows are learned from, and several blocks are searched.
    monkeypatch.setattr(multi_index, "SAMPLE", 700)
    monkeypatch.setattr(multi_index, "BLOCK_QUERIES", 70)
    random_ = np.random.default_rng(7)
    vectors = random_.standard_normal((3000, 32))
    if kind == "clusters":
        vectors = vectors * 0.1 + random_.standard_normal((100, 32))[np.arange(3000) % 100]
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if kind == "norms":
        vectors *= random_.uniform(0.2, 3, 3000)[:, None]
    rows = [(n, vector.tolist()) for n, vector in enumerate(vectors)]
    got = answers(multi_index.nearest_vectors(vectors_frame(spark, rows)))
    products = vectors[::20] @ vectors.T
    hits = 0
    for n, own in enumerate(products):
        own[20 * n] = -np.inf
        hits += len(set(np.argsort(-own)[:20].tolist()) & {key for key, _ in got[20 * n]})
    assert hits >= 0.9 * 20 * len(products)


def test_probing_finds_every_code_within_a_radius():
    random_ = np.random.default_rng(4)
    centre = random_.integers(0, 256, (1, 32), np.uint8)
    flips = np.packbits(random_.random((5000, 256)) < random_.uniform(0, 0.3, (5000, 1)), axis=1)
    codes = np.concatenate((centre ^ flips, random_.integers(0, 256, (500, 32), np.uint8)))
    block = multi_index.Block(codes, np.ones((5500, 1), np.float32), np.arange(5500))
    bits = np.unpackbits(codes ^ centre, axis=1).sum(axis=1)
    for radius in (0, 1, 5, 15, 16, 30, 33, 47, 90, 255, 256):
        assert block.within(centre[0], radius).tolist() == np.flatnonzero(bits <= radius).tolist()
