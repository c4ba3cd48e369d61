"""Seeded values: the same seed, field and id always give the same value.

They are columns over a hash of ``seed:field:id``, so a table of any size is
generated in parallel and a lost partition is generated again unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, functions as F

_CHARS_PER_HASH = 22


def _hash(seed: int, field: str, record_id: Column, part: int = 0) -> Column:
    return F.md5(
        F.concat_ws(":", F.lit(seed), F.lit(field), record_id.cast("string"), F.lit(part))
    )


def seeded_text(seed: int, field: str, record_id: Column, length: int) -> Column:
    """Letters and digits, ``length`` of them."""
    parts = [
        F.substring(F.base64(F.unhex(_hash(seed, field, record_id, part))), 1, _CHARS_PER_HASH)
        for part in range(ceil(length / _CHARS_PER_HASH))
    ]
    return F.substring(F.translate(F.concat(*parts), "+/", "Zz"), 1, length)


def seeded_long(seed: int, field: str, record_id: Column) -> Column:
    """Any 64-bit number."""
    return F.conv(F.substring(_hash(seed, field, record_id), 1, 16), 16, -10).cast("bigint")


def seeded_below(seed: int, field: str, record_id: Column, bound: int) -> Column:
    """A number in ``[0, bound)``."""
    number = F.conv(F.substring(_hash(seed, field, record_id), 1, 15), 16, 10)
    return number.cast("bigint") % F.lit(bound).cast("bigint")


def seeded_choice(seed: int, field: str, record_id: Column, options: Sequence[str]) -> Column:
    """One of ``options``."""
    index = seeded_below(seed, field, record_id, len(options)) + 1
    return F.element_at(F.array(*[F.lit(option) for option in options]), index.cast("int"))
