"""Splits of one frame into usable rows and rows set aside with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadlake.functions.contract import violations
from roadlake.operators.dedupe import split_on_null
from roadlake.schema import EVENT_COLS, KEY_COLS


def with_violations(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add ``reasons``: the contract rules each row breaks (empty when it breaks none)."""
    return df.withColumn("reasons", violations(rules))


def split_quality(df: DataFrame, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they came, rejected rows with ``reasons``)."""
    flagged = with_violations(df, rules)
    broken = F.size("reasons") > 0
    return flagged.where(~broken).drop("reasons"), flagged.where(broken)


def split_decoded(
    df: DataFrame, value: str = "value", fields: list[str] = EVENT_COLS
) -> tuple[DataFrame, DataFrame]:
    """Output of ``decode_events`` as (decoded fields, raw value with ``reason``)."""
    good = df.where(F.col("decode_error").isNull()).drop(value, "decode_error")
    kept = [c for c in df.columns if c not in fields and c != "decode_error"]
    bad = df.where(F.col("decode_error").isNotNull()).select(*kept, F.col("decode_error").alias("reason"))
    return good, bad


def split_keyed(df: DataFrame, keys: list[str] = KEY_COLS) -> tuple[DataFrame, DataFrame]:
    """(rows that can be merged, rows whose key has a null and could only pile up)."""
    return split_on_null(df, keys)
