"""Between typed columns and the bytes of a topic.

A codec is named by ``"long"``, ``"string"``, ``"bytes"`` or by a record's
``StructType``. Records travel as JSON text, read back with their declared
schema.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

Codec = str | T.StructType


def encode_long(number: Column) -> Column:
    """Eight big-endian bytes in two's complement."""
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def decode_long(data: Column) -> Column:
    """The number in eight big-endian bytes; other lengths are an error."""
    return (
        F.when(data.isNull(), F.lit(None).cast("bigint"))
        .when(F.octet_length(data) == 8, F.conv(F.hex(data), 16, -10).cast("bigint"))
        .otherwise(F.raise_error("a long needs 8 bytes").cast("bigint"))
    )


def encode_string(text: Column) -> Column:
    return text.cast("binary")


def decode_string(data: Column) -> Column:
    """UTF-8 text; malformed bytes become the replacement character."""
    return F.make_valid_utf8(data.cast("string"))


def encode(value: Column, codec: Codec) -> Column:
    if isinstance(codec, T.StructType):
        return F.to_json(value).cast("binary")
    return {"long": encode_long, "string": encode_string, "bytes": _as_is}[codec](value)


def decode(data: Column, codec: Codec) -> Column:
    """The typed value; null for null. What cannot be decoded is an error."""
    if isinstance(codec, T.StructType):
        shown = F.substring(decode_string(data), 1, 200)
        failure = F.raise_error(F.concat(F.lit("malformed record: "), shown)).cast(codec)
        return F.when(is_malformed(data, codec), failure).otherwise(_record(data, codec))
    return {"long": decode_long, "string": decode_string, "bytes": _as_is}[codec](data)


def decode_or_null(data: Column, codec: Codec) -> Column:
    """The typed value; null for null and for what cannot be decoded."""
    if isinstance(codec, T.StructType):
        return F.when(~is_malformed(data, codec), _record(data, codec))
    return decode(F.when(~is_malformed(data, codec), data), codec)


def is_malformed(data: Column, codec: Codec) -> Column:
    """Whether there are bytes that the codec cannot decode. Never null."""
    if isinstance(codec, T.StructType):
        parsed = _parsed(data, codec)
        text = F.trim(data.cast("string"))
        return data.isNotNull() & (
            parsed.isNull() | parsed[_CORRUPT].isNotNull() | ~text.startswith("{")
        )
    if codec == "long":
        return data.isNotNull() & (F.octet_length(data) != 8)
    return F.lit(False)


_CORRUPT = "_corrupt"


def _parsed(data: Column, codec: T.StructType) -> Column:
    """The record, and its text where that is malformed: parsed once for both."""
    with_text = T.StructType([*codec.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(data.cast("string"), with_text, {"columnNameOfCorruptRecord": _CORRUPT})


def _record(data: Column, codec: T.StructType) -> Column:
    parsed = _parsed(data, codec)
    fields = F.struct(*[parsed[field.name].alias(field.name) for field in codec])
    return F.when(data.isNotNull(), fields)


def _as_is(data: Column) -> Column:
    return data
