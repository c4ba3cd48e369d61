"""Small tables with the cases every operator has to stand."""

from __future__ import annotations

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside.
CLASHING = [
    "digest", "keep_id", "kept", "host", "line", "point", "size", "taken", "cell", "rank",
    "component", "node", "list", "sketch", "text_key", "anchor", "ranges", "removed", "at",
    "_id", "_key", "_salt", "_found", "_times", "made", "packed", "wanted", "text_hash",
]


def prose(seed: int, words: int, line: int = 12, language: str = "en") -> str:
    pick = random.Random(f"{language}{seed}")
    syllables = {
        "en": ["the", "ing", "wh", "er", "sh", "and", "ou", "th"],
        "de": ["ung", "sch", "ein", "ü", "ß", "der", "cht", "en"],
    }[language]
    made = ["".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(made[at : at + line]) for at in range(0, words, line))


def documents(spark):
    """Copies, near copies, shared passages and lines, empties, nulls and repeated rows."""
    shared = prose(1000, 60)
    texts = [prose(n, 40 + 7 * n, language="de" if n % 3 == 0 else "en") for n in range(24)]
    texts += [texts[3], texts[3].upper(), texts[4] + " more", "lead " + texts[5]]
    texts += [f"{prose(50 + n, 30)}\n{shared}\n{prose(80 + n, 30)}" for n in range(5)]
    texts += ["all the same line\n" * 3 + prose(200 + n, 12) for n in range(9)]
    texts += [f"{prose(300, 24, line=24)}\n{prose(310 + n, 3)}" for n in range(9)]
    texts += ["", None, " \n\t ", "\n\n", "x", "ab " * 400, "1234 !!! 5678", "é" * 300]
    texts += [prose(7, 20_000), "z" * 100_000, "日本語 テキスト 🎉 \0 end"]
    rows = [
        (n, text, [None, "en", "de"][n % 3 if n % 7 else 1], [None, "a", "b", "a"][n % 4], 1)
        for n, text in enumerate(texts)
    ]
    rows += [(None, texts[2], "en", "a", None), (None, None, None, None, None), rows[6], rows[6]]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashing_columns(frame):
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit("other").alias(name) for name in CLASHING])


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, size: int) -> frozenset:
    words = words_of((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[n : n + size]) for n in range(max(len(words) - size + 1, 1)))


def group_of(sets: dict, percent: int) -> dict:
    """The smallest id that links of enough similarity lead to, by comparing all pairs."""
    parent = {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {key: root(key) for key in keys}
