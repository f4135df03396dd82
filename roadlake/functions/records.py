"""Events to and from the JSON text of a message value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from roadlake.schema import EVENT_COLS, EVENT_SCHEMA

_CORRUPT = "_corrupt_record"


def encode_events(df: DataFrame, columns: list[str] = EVENT_COLS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` holding ``columns`` of each row as a JSON object, nulls written out."""
    return df.select(*keep, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def decode_events(
    df: DataFrame, schema: StructType = EVENT_SCHEMA, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Fields of ``schema`` from JSON in ``value`` (text or UTF-8 bytes).

    Adds ``decode_error``: null for a good record, else why the record cannot be used. A record is
    one JSON object and nothing else. Fields that ``schema`` lacks are left out; ``unknown_fields`` names them.
    The columns in ``keep`` and the raw ``value`` are passed through.
    """
    text = F.col(value).cast("string")
    body = F.btrim(text, F.lit(" \t\r\n"))
    parsed = F.from_json(
        text, StructType([*schema.fields]).add(_CORRUPT, "string"), {"columnNameOfCorruptRecord": _CORRUPT}
    )
    # The parser stops at the end of the first object and takes arrays of objects. Between brackets, text
    # after the first object makes a list of more than one element or none at all.
    listed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    one_object = body.startswith("{") & (F.coalesce(listed, F.lit(0)) == 1)
    error = (
        F.when(F.col(value).isNull(), "null_value")
        .when(~F.is_valid_utf8(text), "invalid_utf8")
        .when(~one_object | F.col(_CORRUPT).isNotNull(), "malformed_json")
    )
    # ``inline`` makes the fields a generator's output. A filter on them then stays above it,
    # where a plain projection would be parsed once more for every filter pushed below.
    opened = df.select(*keep, value, F.inline(F.array(parsed)))
    return opened.select(*keep, value, *schema.names, error.alias("decode_error"))


def unknown_fields(value: str = "value", schema: StructType = EVENT_SCHEMA) -> Column:
    """Names of a JSON object's fields that ``schema`` does not have; null where there is no object."""
    return F.array_except(F.json_object_keys(F.col(value).cast("string")), F.array(*[F.lit(n) for n in schema.names]))
