"""Collocations of each language, by best-first growth of phrases under score bounds.

A phrase is grown word by word from its prefix. With ``f`` the number of occurrences, a longer
phrase of a prefix ``P`` of two words cannot score more than ``f(P)`` against its first word: cut
after that word, its left part is as frequent as the word, its right part at least as
frequent as the phrase, and the phrase at most as frequent as ``P``. So the counts of
prefixes bound what can grow from them:

    score <= 1000000 a a / (l r) <= 1000000 a / l <= 1000000 f(P) / f(first word of P)

All prefixes of one word have the same bound, and those of enough occurrences are grown
first, together. From then on the frontier of each language is opened from the highest
bound down, four times as many prefixes at first as the result has rows, then four times as
many, and so on. Only phrases with an opened prefix are counted, and those that hold a pair whose
score is above the level reached, since these decide whether that pair is dropped. A level
is settled when all that can score so much is counted; a language is done when enough
survivors lie at or above its level. Languages that are not done go on alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from keybrook.llm.common import look_up, written
from keybrook.llm.components import parts

TOP = 2_000
LEAST_COUNT = 10
# A phrase is dropped for a longer one that holds it and has this share of its occurrences.
ABSORB_PERCENT = 50

# What ends a piece of text. Between words are space and tab.
PIECE_END = b".,;:!?\n\x0b\x0c\r"

_COUNT = "decimal(15,0)"
# Stands for the end of a piece; no word holds it.
_END = b"."
_TO_END = bytes.maketrans(PIECE_END, _END * len(PIECE_END))
# So many words, or pairs, are sent to all tasks; the rows are counted first. More are
# not, and what they would leave out is dropped after it is counted.
MOST_KNOWN = 500_000
_SPACE = pa.scalar(b" ", pa.large_binary())
_PART_BYTES = 8 << 20


def texts_of(documents: DataFrame) -> DataFrame:
    """``lang`` and the bytes of ``text``, of texts that have any."""
    return documents.where(F.col("text") != "").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("binary").alias("text"),
    )


@dataclass(frozen=True)
class Known:
    """What is known of one language where its texts are read, to count no more than is needed.

    Phrases hold only these ``words``, if any are given. Phrases of three words begin with one of
    the pairs ``begins``, or end with one of the pairs ``ends``: two arrays of words each.
    """

    words: pa.Array | None = None
    begins: tuple[pa.Array, pa.Array] | None = None
    ends: tuple[pa.Array, pa.Array] | None = None


def phrase_counts(
    texts: DataFrame, length: int, known: dict[str, Known] | None = None
) -> DataFrame:
    """``lang``, ``phrase`` and ``count`` of phrases of ``length`` words, summed over some texts each.

    A worker counts the texts of a few MiB at a time, as arrays of word numbers, so it never
    holds more phrases than these have. ``known`` limits what is counted, by language.
    """

    def count(batches):
        for batch in parts(batches, rows=10_000, most_bytes=_PART_BYTES):
            of_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(*[batch.column(n).to_pylist() for n in ("lang", "text")]):
                of_lang.setdefault(lang, []).append(text)
            for lang, own in of_lang.items():
                if known is None or lang in known:
                    yield _counted(lang, own, length, known[lang] if known else Known())

    return texts.select("lang", "text").mapInArrow(
        count, "lang string, phrase binary, count bigint"
    ).withColumn("phrase", F.col("phrase").cast("string"))


def _counted(lang: str, texts: list[bytes], length: int, known: Known) -> pa.RecordBatch:
    ids, words = _numbered(_END.join(texts), known.words)
    size = len(words)
    inside = ids >= 0
    places = np.flatnonzero(inside)
    for step in range(1, length):
        places = places[places + step < len(ids)]
        places = places[inside[places + step]]
    if known.begins is not None:
        first = _is_one_of(known.begins, words, ids[places] * size + ids[places + 1])
        last = _is_one_of(known.ends, words, ids[places + 1] * size + ids[places + 2])
        places = places[first | last]
    # Of each place the number of its phrase, made of that of its prefix and its next word.
    numbers, phrases = ids[places], words
    for step in range(1, length):
        keys = numbers * size + ids[places + step]
        if step < length - 1:
            pairs, numbers = np.unique(keys, return_inverse=True)
        else:
            pairs, counts = np.unique(keys, return_counts=True)
        phrases = pc.binary_join_element_wise(
            phrases.take(pa.array(pairs // size)), words.take(pa.array(pairs % size)), _SPACE
        )
    if length == 1:
        counts = np.bincount(numbers, minlength=size)
        phrases, counts = phrases.filter(pa.array(counts > 0)), counts[counts > 0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang], pa.string()).take(pa.array(np.zeros(len(counts), np.int32))),
            phrases.cast(pa.binary()),
            pa.array(counts),
        ],
        ["lang", "phrase", "count"],
    )


def _is_one_of(pairs: tuple[pa.Array, pa.Array], words: pa.Array, keys: np.ndarray) -> np.ndarray:
    """Which of the numbered pairs are among ``pairs``."""
    sides = [pc.index_in(side, value_set=words) for side in pairs]
    here = pc.and_(pc.is_valid(sides[0]), pc.is_valid(sides[1]))
    left, right = (side.filter(here).to_numpy().astype(np.int64) for side in sides)
    wanted = np.sort(left * len(words) + right)
    if not len(wanted):
        return np.zeros(len(keys), bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


def _numbered(text: bytes, kept: pa.Array | None = None) -> tuple[np.ndarray, pa.Array]:
    """The words of a text as numbers, -1 between its pieces, and the word of each number.

    Words that are not ``kept``, if that is given, are numbered -1 too.
    """
    marked = text.lower().translate(_TO_END).replace(_END, b" . ").strip(b" \t")
    offsets = np.array([0, len(marked)], np.int64)
    # The bytes are split at white space only, so they need not be valid text.
    whole = pa.Array.from_buffers(
        pa.large_string(), 1, [None, pa.py_buffer(offsets), pa.py_buffer(marked)]
    )
    found = pc.ascii_split_whitespace(whole).values.dictionary_encode()
    ids = found.indices.to_numpy().astype(np.int64)
    words = found.dictionary.view(pa.large_binary())
    out = pc.is_in(words, value_set=pa.array([_END, b""], pa.large_binary()))
    if kept is not None:
        out = pc.or_(out, pc.invert(pc.is_in(words, value_set=kept)))
    ids[out.to_numpy(zero_copy_only=False)[ids]] = -1
    return ids, words


def counted(rows: DataFrame) -> DataFrame:
    """One row per phrase; each task adds up its own rows before the shuffle."""
    return rows.groupBy("lang", "phrase").agg(F.sum("count").alias("count"))


def _first(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _last(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def score_of(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 a a / (l r))``, exact for counts of up to 15 digits."""
    a, left, right = (value.cast(_COUNT) for value in (a, left, right))
    # Decimals of 38 digits hold both products; what is left of the division is taken off.
    top = a * a * F.lit(1_000_000).cast("decimal(7,0)")
    bottom = left * right
    return ((top - top % bottom) / bottom).cast("bigint")


def _with_count(rows: DataFrame, grams: DataFrame, phrase: Column, name: str) -> DataFrame:
    table = grams.select("lang", F.col("phrase").alias("_gram"), F.col("count").alias(name))
    return look_up(
        rows.withColumn("_gram", phrase), table, ["lang", "_gram"], F.col("phrase")
    ).drop("_gram")


def scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates of two words with ``a``, ``l``, ``r``, ``score``, and the ``bound`` of what grows
    from them."""
    phrase = F.col("phrase")
    both = _with_count(pairs.withColumnRenamed("count", "a"), words, _first(phrase, 1), "l")
    both = _with_count(both, words, _last(phrase, 1), "r")
    return both.select(
        "lang", "phrase", "a", "l", "r",
        score_of(F.col("a"), F.col("l"), F.col("r")).alias("score"),
        score_of(F.col("a"), F.col("a"), F.col("l")).alias("bound"),
    )


def scored_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates of three words with ``a``, and ``l``, ``r``, ``score`` of their lowest cut."""
    phrase = F.col("phrase")
    rows = triples.withColumnRenamed("count", "a")
    for name, grams, part in (
        ("l1", words, _first(phrase, 1)),
        ("r1", pairs, _last(phrase, 2)),
        ("l2", pairs, _first(phrase, 2)),
        ("r2", words, _last(phrase, 1)),
    ):
        rows = _with_count(rows, grams, part, name)
    cuts = [
        F.struct(
            score_of(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"),
            F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"),
            F.col(f"r{k}").alias("r"),
        )
        for k in (1, 2)
    ]
    return rows.withColumn("_cut", F.least(*cuts)).select(
        "lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score"
    )


def levels(pairs: DataFrame, opened: int) -> DataFrame:
    """The ``level`` of each language: the bound of its ``opened``-th pair, 0 if it has fewer.

    Pairs are counted by bound first, so a language has 1,000,001 rows to add up at most.
    """
    from_high = Window.partitionBy("lang").orderBy(F.desc("bound")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = F.max(F.when(F.col("_pairs") >= opened, F.col("bound")))
    return (
        pairs.groupBy("lang", "bound").agg(F.count(F.lit(1)).alias("_pairs"))
        .withColumn("_pairs", F.sum("_pairs").over(from_high))
        .groupBy("lang").agg(F.coalesce(reached, F.lit(0).cast("bigint")).alias("level"))
    )


def grown(
    texts: DataFrame, pairs: DataFrame, level: DataFrame, least_count: int
) -> DataFrame:
    """Counts of the phrases of three words that ``level`` asks for.

    These are all whose first two words are an opened prefix, and all with a pair of a score
    at or above the level.
    """
    open_pairs = written(
        look_up(pairs, level, "lang", F.col("phrase"))
        .where(F.col("bound") >= F.col("level"))
        .select(
            "lang", F.col("phrase").alias("_pair"), (F.col("score") >= F.col("level")).alias("_top")
        ),
        "open-pairs",
    )
    own = look_up(texts, level.select("lang"), "lang", F.col("text"))
    if open_pairs.count() <= MOST_KNOWN:
        # Few enough to be known wherever texts are read: only what is wanted is counted.
        found = counted(phrase_counts(own, 3, _known_pairs(open_pairs)))
        return found.where(F.col("count") >= least_count)
    rows = phrase_counts(own, 3)
    sides = F.array(
        F.struct(_first(F.col("phrase"), 2).alias("_pair"), F.lit(True).alias("_begins")),
        F.struct(_last(F.col("phrase"), 2).alias("_pair"), F.lit(False).alias("_begins")),
    )
    # An opened pair has its own score below its bound: the rows that begin with opened pairs
    # have all that begin with a top pair.
    met = look_up(
        rows.select("lang", "phrase", "count", F.inline(sides)), open_pairs, ["lang", "_pair"],
        F.col("phrase"),
    ).where(F.col("_begins") | F.col("_top"))
    # A phrase that is met from both sides has the same count from each.
    return (
        met.groupBy("lang", "phrase", "_begins").agg(F.sum("count").alias("count"))
        .where(F.col("count") >= least_count)
        .groupBy("lang", "phrase").agg(F.max("count").alias("count"))
    )


def _arrays(pairs: list[str]) -> tuple[pa.Array, pa.Array]:
    sides = zip(*[pair.encode().split(b" ") for pair in pairs]) if pairs else ([], [])
    return tuple(pa.array(side, pa.large_binary()) for side in sides)


def _known_pairs(open_pairs: DataFrame) -> dict[str, Known]:
    """The opened pairs of each language, and those with a score at or above the level."""
    found: dict[str, tuple[list[str], list[str]]] = {}
    for lang, pair, top in open_pairs.select("lang", "_pair", "_top").collect():
        opened = found.setdefault(lang, ([], []))
        opened[0].append(pair)
        if top:
            opened[1].append(pair)
    return {
        lang: Known(begins=_arrays(opened[0]), ends=_arrays(opened[1]))
        for lang, opened in found.items()
    }


def _known_words(words: DataFrame) -> dict[str, Known] | None:
    """The frequent words of each language, if they are few enough to be known everywhere."""
    if words.count() > MOST_KNOWN:
        return None
    found: dict[str, list[bytes]] = {}
    for lang, word in words.select("lang", "phrase").collect():
        found.setdefault(lang, []).append(word.encode())
    return {
        lang: Known(words=pa.array(own, pa.large_binary())) for lang, own in found.items()
    }


def survivors(
    pairs: DataFrame, triples: DataFrame, level: DataFrame, absorb_percent: int
) -> DataFrame:
    """All candidates at or above the level of their language that no longer one absorbs."""
    phrase = F.col("phrase")
    # Of all phrases that hold a pair the most frequent one decides.
    holders = triples.select("lang", "a", F.explode(
        F.array_distinct(F.array(_first(phrase, 2), _last(phrase, 2)))).alias("_pair"))
    longest = holders.groupBy("lang", F.col("_pair").alias("phrase")).agg(F.max("a").alias("_a"))
    high = look_up(pairs, level, "lang", phrase).where(F.col("score") >= F.col("level"))
    absorbed = F.coalesce(F.col("_a") * 100 >= F.col("a") * absorb_percent, F.lit(False))
    kept = high.join(longest, ["lang", "phrase"], "left").where(~absorbed)
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    long = look_up(triples, level, "lang", phrase).where(F.col("score") >= F.col("level"))
    return kept.select(*columns).union(long.select(*columns))


def collocations(
    documents: DataFrame,
    top: int = TOP,
    least_count: int = LEAST_COUNT,
    absorb_percent: int = ABSORB_PERCENT,
) -> DataFrame:
    """The ``top`` phrases of two or three words of each language, by score.

    Returns ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``: with
    ``a`` the occurrences of the phrase, ``l`` and ``r`` those of the parts of its lowest cut,
    and ``n`` all words of the language. A phrase lies in one piece of text between marks or
    line ends. Equal scores go by ``a``, then by the bytes of the phrase.

    Null and empty texts have no words; a null ``lang`` is ``und``. Texts are used whole, however
    long. Repeated rows count as often as they occur, whatever their ``doc_id``. Other columns
    are ignored, and an empty table gives an empty result.
    """
    texts = texts_of(documents)
    all_words = written(counted(phrase_counts(texts, 1)), "words")
    totals = written(all_words.groupBy("lang").agg(F.sum("count").alias("n")), "word-totals")
    often = F.col("count") >= least_count
    words = written(all_words.where(often), "often-words")
    # No phrase is more frequent than its words.
    pair_counts = written(
        counted(phrase_counts(texts, 2, _known_words(words))).where(often), "often-pairs"
    )
    pairs = written(scored_pairs(pair_counts, words), "scored-pairs")

    found = None
    waiting = pairs
    opened = 4 * top
    while True:
        level = written(levels(waiting, opened), "levels")
        if not level.limit(1).count():
            break
        triples = written(
            scored_triples(grown(texts, pairs, level, least_count), pair_counts, words),
            "scored-triples",
        )
        settled = written(survivors(pairs, triples, level, absorb_percent), "survivors")
        counts = settled.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        is_done = (F.col("level") == 0) | (F.col("found") >= top)
        judged = written(
            level.join(counts, "lang", "left").select(
                "lang", F.coalesce(is_done, F.lit(False)).alias("_done")
            ),
            "settled",
        )
        part = look_up(settled, judged.where("_done").select("lang"), "lang", F.col("phrase"))
        found = part if found is None else found.union(part)
        rest = judged.where("not _done").select("lang")
        if not rest.limit(1).count():
            break
        waiting = look_up(waiting, rest, "lang", F.col("phrase"))
        opened *= 4
    if found is None:
        found = pairs.select("lang", "phrase", "a", "l", "r", "score").limit(0)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return look_up(ranked, totals, "lang", F.col("phrase")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]+')) AS piece
  FROM documents),
listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
ones AS (
  SELECT lang, p, count(*) AS c FROM (SELECT lang, unnest(w) AS p FROM listed) GROUP BY ALL),
twos AS (
  SELECT lang, p, split_part(p, ' ', 1) AS w1, split_part(p, ' ', 2) AS w2, count(*) AS c
  FROM (SELECT lang, unnest(list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1])) AS p FROM listed) GROUP BY ALL HAVING count(*) >= 10),
threes AS (
  SELECT lang, p, split_part(p, ' ', 1) AS w1, split_part(p, ' ', 3) AS w3,
    w1 || ' ' || split_part(p, ' ', 2) AS head, split_part(p, ' ', 2) || ' ' || w3 AS tail,
    count(*) AS c
  FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS p FROM listed)
  GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM ones GROUP BY lang),
cuts AS (
  SELECT t.lang, t.p, t.c AS a, 1 AS k, l.c AS l, r.c AS r
  FROM twos t JOIN ones l ON l.lang = t.lang AND l.p = t.w1
    JOIN ones r ON r.lang = t.lang AND r.p = t.w2
  UNION ALL
  SELECT t.lang, t.p, t.c, 1, l.c, r.c
  FROM threes t JOIN ones l ON l.lang = t.lang AND l.p = t.w1
    JOIN twos r ON r.lang = t.lang AND r.p = t.tail
  UNION ALL
  SELECT t.lang, t.p, t.c, 2, l.c, r.c
  FROM threes t JOIN twos l ON l.lang = t.lang AND l.p = t.head
    JOIN ones r ON r.lang = t.lang AND r.p = t.w3),
scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
  QUALIFY row_number() OVER (
    PARTITION BY lang, p ORDER BY 1000000::HUGEINT * a * a // (l::HUGEINT * r), k) = 1),
longer AS (
  SELECT lang, p, max(c) AS most FROM (
    SELECT lang, head AS p, c FROM threes UNION ALL SELECT lang, tail, c FROM threes)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer g ON s.lang = g.lang AND s.p = g.p
  WHERE g.most IS NULL OR 100 * g.most < 50 * s.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank
  FROM kept)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN n USING (lang)
WHERE rank <= 2000
"""
