"""Language identification by rank-order profiles.

The most frequent n-grams of a text, in order of frequency, are compared with those of
each language: the distance is the sum over the text's n-grams of how far they are
out of place in the language's list.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keybrook.llm.components import in_parts, parts

UNKNOWN = "und"
PROFILE_SIZE = 400
# About so many labelled rows of each language are enough to fit its profile.
FIT_ROWS = 2_000
LONGEST_N = 3
PART_CHARS = 1 << 20

# An n-gram is a number: 21 bits for each character, 1 for the edge of a word.
_BITS = 21
_EDGE = 1


@cache
def _letters() -> np.ndarray:
    """The code point of each letter, and ``_EDGE`` for all other characters."""
    codes = np.arange(0x110000, dtype=np.int64)
    is_letter = np.fromiter((chr(code).isalpha() for code in codes), bool, len(codes))
    return np.where(is_letter, codes, _EDGE)


def _part_ngrams(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate(([_EDGE], _letters()[codes], [_EDGE]))
    letter = codes != _EDGE
    # Of a run of other characters one edge is left.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    codes = codes[keep]
    letter = codes != _EDGE
    pairs = (codes[:-1] << _BITS) | codes[1:]
    triples = (pairs[:-1] << _BITS) | codes[2:]
    return np.concatenate((codes[letter], pairs, triples[letter[1:-1]]))


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of one to three characters, and how often each occurs.

    Words are padded by an edge on both sides. A text is counted in parts of a million
    characters, so a very long one needs no more memory than its own n-grams.
    """
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(text), PART_CHARS):
        ngrams = np.sort(_part_ngrams(text[start : start + PART_CHARS]))
        first = np.flatnonzero(np.diff(ngrams, prepend=-1))
        times = np.diff(first, append=len(ngrams))
        if not len(keys):
            keys, counts = ngrams[first], times
        else:
            keys, place = np.unique(np.concatenate((keys, ngrams[first])), return_inverse=True)
            counts = np.bincount(place, np.concatenate((counts, times))).astype(np.int64)
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent keys, most frequent first; ties by key."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        enough = counts >= least
        keys, counts = keys[enough], counts[enough]
    return keys[np.argsort(-counts, kind="stable")[:size]]


@dataclass(frozen=True)
class Profiles:
    """For each language the rank of each n-gram; ``size`` where it has none."""

    languages: tuple[str, ...]
    keys: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, ordered: dict[str, list[int]], size: int) -> Profiles:
        languages = tuple(sorted(ordered))
        keys = np.unique(np.array([k for one in ordered.values() for k in one], np.int64))
        ranks = np.full((len(keys), len(languages)), size, np.int32)
        for column, language in enumerate(languages):
            places = np.searchsorted(keys, np.array(ordered[language], np.int64))
            ranks[places, column] = np.arange(len(places))
        return cls(languages, keys, ranks, size)

    def best(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 minus its distance over the largest possible.

        Ties go to the language whose name comes first. ``und`` and 0 for null, for a
        text without a letter, and if there is no profile.
        """
        if not text or not self.languages:
            return UNKNOWN, 0.0
        keys, counts = ngram_counts(text)
        if not len(keys) or keys[0] > 1 << _BITS:
            return UNKNOWN, 0.0
        own = ranked(keys, counts, self.size)
        place = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        known = self.keys[place] == own
        distance = np.abs(self.ranks[place[known]] - np.flatnonzero(known)[:, None])
        # An n-gram that a language lacks is out of place by ``size``, known or not.
        distance[self.ranks[place[known]] == self.size] = self.size
        sums = distance.sum(axis=0) + (len(own) - known.sum()) * self.size
        at = int(sums.argmin())
        return self.languages[at], 1.0 - float(sums[at]) / (len(own) * self.size)


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, which the profiles never see."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def fit_profiles(
    labelled: DataFrame, size: int = PROFILE_SIZE, fit_rows: int = FIT_ROWS
) -> Profiles:
    """Profiles from the rows of ``labelled`` (``doc_id``, ``text``, ``lang``).

    Of each language about ``fit_rows`` rows are read, chosen by a hash of ``doc_id``; this
    bounds the fit. N-grams are counted in each task and summed by a shuffle; what
    reaches the driver is ``size`` n-grams per language. Rows whose text or language is
    null are left out.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "doc_id", "text", "lang"
    )
    shares = rows.groupBy("lang").agg((F.lit(float(fit_rows)) / F.count(F.lit(1))).alias("share"))
    point = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # One row per language.
    chosen = rows.join(F.broadcast(shares), "lang").where(point < F.col("share"))

    def count(batches):
        for batch in parts(batches):
            texts: dict[str, list[str]] = {}
            for language, text in zip(*[batch.column(n).to_pylist() for n in ("lang", "text")]):
                texts.setdefault(language, []).append(text)
            for language, own in texts.items():
                keys, counts = ngram_counts("\n".join(own))
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([language] * len(keys), pa.string()),
                     "ngram": pa.array(keys, pa.int64()), "n": pa.array(counts, pa.int64())}
                )

    counted = (
        chosen.select("lang", "text")
        .mapInArrow(count, "lang string, ngram bigint, n bigint")
        .groupBy("lang", "ngram")
        .agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    top = counted.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= size)
    ordered: dict[str, list[int]] = {}
    for row in sorted(top.collect(), key=lambda row: (row["lang"], row["rank"])):
        ordered.setdefault(row["lang"], []).append(row["ngram"])
    return Profiles.of(ordered, size)


def language_of(profiles: Profiles):
    """A function from a text column to a struct of ``lang_pred`` and ``score``."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        return in_parts(texts, nearest)

    def nearest(texts: pa.Array) -> pa.Array:
        found = [profiles.best(text) for text in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()),
             pa.array([x[1] for x in found], pa.float64())],
            ["lang_pred", "score"],
        )

    return predict


def predict_languages(documents: DataFrame, **parameters) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of each document.

    Profiles are fitted on the documents that are not held out. A null or empty text,
    or one without a letter, gets ``und`` and score 0. Repeated rows are predicted
    alike, and a null ``doc_id`` is not held out. Other columns play no part; an empty
    table gives an empty result.
    """
    out = held_out(F.col("doc_id"))
    predict = language_of(fit_profiles(documents.where(~out), **parameters))
    return documents.select(
        "doc_id", out.alias("held_out"), predict("text").alias("found")
    ).select("doc_id", "held_out", "found.*")
