"""Checks of records against their declared contract.

A writer of typed records refuses one that breaks its schema. Here each record
is told what it breaks, and accepted and rejected records are split.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

from keybrook.schemas import SYMBOLS


def missing_fields(contract: T.StructType, inside: str = "") -> Column:
    """The names of required fields that are null, as an array.

    Fields of a nested record have dotted names. A nested record that is itself
    missing is named once, without its fields. ``inside`` names the column that holds the
    record, where its fields are no columns.
    """
    return _names(
        (name, parent_present & value.isNull())
        for name, value, field, parent_present in _fields(contract, inside)
        if not field.nullable
    )


def unknown_symbols(contract: T.StructType, inside: str = "") -> Column:
    """The names of enumeration fields that hold a value outside their symbols."""
    return _names(
        (name, value.isNotNull() & ~value.isin(field.metadata[SYMBOLS]))
        for name, value, field, _ in _fields(contract, inside)
        if SYMBOLS in field.metadata
    )


def keeps_contract(contract: T.StructType, inside: str = "") -> Column:
    """Whether a record breaks nothing of its contract."""
    return (F.size(missing_fields(contract, inside)) == 0) & (
        F.size(unknown_symbols(contract, inside)) == 0
    )


def check_records(records: DataFrame, contract: T.StructType) -> DataFrame:
    """Add the columns ``missing``, ``unknown`` and ``accepted``, in one pass."""
    return (
        records.withColumns(
            {"missing": missing_fields(contract), "unknown": unknown_symbols(contract)}
        )
        .withColumn("accepted", (F.size("missing") == 0) & (F.size("unknown") == 0))
    )


def accepted(records: DataFrame, contract: T.StructType) -> DataFrame:
    return check_records(records, contract).where("accepted").select(*records.columns)


def rejected(records: DataFrame, contract: T.StructType) -> DataFrame:
    """The records that break the contract, with what they break."""
    return check_records(records, contract).where("not accepted").drop("accepted")


def _names(broken: Iterator[tuple[str, Column]]) -> Column:
    found = [F.when(is_broken, F.lit(name)) for name, is_broken in broken]
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))


def _fields(
    contract: T.StructType, inside: str, parent: str = "", present: Column | None = None
) -> Iterator[tuple[str, Column, T.StructField, Column]]:
    present = F.lit(True) if present is None else present
    for field in contract:
        name = parent + field.name
        value = F.col(f"{inside}.{name}" if inside else name)
        yield name, value, field, present
        if isinstance(field.dataType, T.StructType):
            yield from _fields(field.dataType, inside, f"{name}.", present & value.isNotNull())
