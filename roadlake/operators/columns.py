"""Column-set operators: checks, renames, projection onto a target, union by name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, StructType


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame itself, or ValueError naming every column it lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; others are left alone."""
    return df.withColumnsRenamed(names)


def unfit_columns(df: DataFrame, schema: StructType) -> Column:
    """Names of the columns whose value does not fit its type in ``schema``: set, but null or another number after the cast."""
    have = {f.name: f.dataType for f in df.schema.fields}
    unfit = []
    for field in schema.fields:
        if field.name in have and have[field.name] != field.dataType:
            value, cast = F.col(field.name), F.col(field.name).try_cast(field.dataType)
            lost = value.isNotNull() & cast.isNull()
            if isinstance(field.dataType, IntegralType):  # a fraction is cut off by the cast
                lost = lost | F.coalesce(cast.cast("double") != value.try_cast("double"), F.lit(False))
            unfit.append(F.when(lost, F.lit(field.name)))
    return F.array_compact(F.array(*unfit)) if unfit else F.expr("cast(array() as array<string>)")


def split_unfit(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that ``conform`` changes no value of, the others with ``unfit``, the columns at fault)."""
    flagged = df.withColumn("unfit", unfit_columns(df, schema))
    return flagged.where(F.size("unfit") == 0).drop("unfit"), flagged.where(F.size("unfit") > 0)


def conform(df: DataFrame, schema: StructType, required: Iterable[str] = (), unfit: str = "null") -> DataFrame:
    """Exactly the columns of ``schema``, by name, cast to its types.

    Columns the frame lacks are null unless ``required`` names them. Columns unknown to the
    schema are refused, because loading would silently lose them. A value that does not fit its type becomes
    null, or with ``unfit="raise"`` fails the query; ``split_unfit`` sets such rows aside beforehand.
    """
    if unfit == "raise":
        names = unfit_columns(df, schema)
        bad = F.raise_error(F.concat(F.lit("values that do not fit: "), F.array_join(names, ", ")))
        df = df.where(F.when(F.size(names) > 0, bad.cast("boolean")).otherwise(F.lit(True)))
    require_columns(df, required)
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the target: {', '.join(unknown)}")
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in have:
            column = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType:
            column = F.col(field.name)
        else:
            column = F.col(field.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames; a column one frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
