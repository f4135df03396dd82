"""Upsert into a table whose format has MERGE of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from roadlake.functions.event_time import add_date_parts
from roadlake.operators.columns import conform
from roadlake.operators.dedupe import dedupe_latest
from roadlake.schema import KEY_COLS, TARGET_SCHEMA


def merge_table(
    source: DataFrame, table: str, keys: Sequence[str] = KEY_COLS, latest_by: Sequence[str] = ("timestamp",), schema: StructType = TARGET_SCHEMA
) -> None:
    """Merge the latest source row of each key into ``table``, in one transaction of the table's format.

    Replaces rows with an equal key and adds the rest; rows with a null in the key match nothing. Plain Parquet tables have
    no MERGE and are refused by Spark; ``upsert`` serves those.
    """
    rows = dedupe_latest(add_date_parts(conform(source, schema, keys, "raise")).select(*schema.names), keys, latest_by)
    name = table.rpartition(".")[2]
    same = F.expr(" AND ".join(f"source.`{k}` = {name}.`{k}`" for k in keys))
    rows.alias("source").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()
