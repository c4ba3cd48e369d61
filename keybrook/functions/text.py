"""Text to words, and literal rewriting of text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Fixed value: a run of characters that belong to no word, by Unicode classes.
NON_WORD = r"(?U)\W+"
# The same, as the classes are written for Arrow.
_NON_WORD_RE2 = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+"


def words(text: Column) -> Column:
    """The lower-case words of a text, as an array in text order.

    A text that starts with a separator yields a leading empty word, as does
    the empty text. Trailing empty words are cut, so a text of separators only
    yields no word. Null stays null.

    The one-element ``transform`` names the split result, so that the regular
    expression runs once per text and not once per branch. Where two steps are
    possible, ``split_text`` in a projection and ``without_trailing_empty``
    after it are faster.
    """
    return F.element_at(F.transform(F.array(split_text(text)), without_trailing_empty), 1)


def split_text(text: Column) -> Column:
    """The lower-case parts of a text between separators, empty parts included."""
    return F.split(F.lower(text), NON_WORD, -1)


def without_trailing_empty(parts: Column) -> Column:
    """Cut trailing empty parts; the single part of an undivided text stays.

    There is at most one at each end, because ``NON_WORD`` matches whole runs.
    """
    only_separators = F.array(F.lit(""), F.lit(""))
    return (
        F.when(F.size(parts) == 1, parts)
        .when(parts == only_separators, F.array().cast("array<string>"))
        .when(
            F.element_at(parts, -1) == "",
            F.slice(parts, F.lit(1), F.size(parts) - 1),
        )
        .otherwise(parts)
    )


def words_of_batch(texts: pa.Array) -> pa.Array:
    """``words`` over an Arrow array, for functions of the user that work on batches."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), _NON_WORD_RE2)
    flat, sizes = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(
        zero_copy_only=False
    )
    ends = np.cumsum(sizes)
    begins = ends - sizes
    empty = np.append(pc.equal(flat, "").to_numpy(zero_copy_only=False), False)
    # An undivided text stays; a trailing empty word goes; two empty words are separators only.
    last_empty = (sizes > 1) & empty[np.maximum(ends - 1, 0)]
    nothing = (sizes == 2) & last_empty & empty[begins]
    left = np.where(nothing, 0, sizes - last_empty)
    kept = np.arange(len(flat)) - np.repeat(begins, sizes) < np.repeat(left, sizes)
    offsets = np.concatenate(([0], np.cumsum(left))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(kept)))


def replace_literal(text: Column, search: str, replacement: str) -> Column:
    """All occurrences of ``search``, taken literally and case-sensitively."""
    return F.replace(text, F.lit(search), F.lit(replacement))
