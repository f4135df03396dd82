"""Fields of a message beyond the schema: kept as they came, typed when they are known.

They travel in one VARIANT column, so a producer that adds a field neither breaks the layout nor loses the field.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from roadlake.schema import EVENT_SCHEMA

EXTRAS = "extras"


def extras(value: str = "value", schema: StructType = EVENT_SCHEMA) -> Column:
    """The fields of a JSON object that ``schema`` does not have, as a VARIANT object; null where there are none or no object.

    Of a field that an object has twice the last one counts, as elsewhere.
    """
    text = F.col(value).cast("string")
    # The parser lists a field as often as the object has it.
    unknown = F.filter(F.map_entries(F.from_json(text, "map<string,variant>")), lambda f: ~f["key"].isin(list(schema.names)))
    names = F.array_distinct(F.transform(unknown, lambda f: f["key"]))
    last = F.transform(names, lambda name: F.element_at(F.filter(unknown, lambda f: f["key"] == name), -1)["value"])
    return F.when(F.size(unknown) > 0, F.to_variant_object(F.map_from_arrays(names, last)))


def with_extras(df: DataFrame, value: str = "value", schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Add ``extras``; see :func:`extras`."""
    return df.withColumn(EXTRAS, extras(value, schema))


def extras_schema(df: DataFrame) -> str:
    """Names and types that the extra fields of a frame have, as one type; fields of unlike types are VARIANT."""
    found = df.agg(F.schema_of_variant_agg(EXTRAS).alias("found")).first().found
    return "OBJECT<>" if found in (None, "VOID") else found


def promoted(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Extra fields as columns of their own: ``fields`` has their types. What does not fit its type is null, and stays in ``extras``."""
    return df.withColumns({name: F.try_variant_get(EXTRAS, _path(name), kind) for name, kind in fields.items()})


def _path(name: str) -> str:
    """A field's path; the syntax has two kinds of quotes and no escape."""
    quote = "'" if "'" not in name else '"'
    if quote in name:
        raise ValueError(f"a field with both kinds of quotes cannot be named: {name}")
    return f"$[{quote}{name}{quote}]"
