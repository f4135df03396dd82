"""A table's declared key, kept in the catalog and checked where a load has written."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadlake.operators.dedupe import complete, fixed_width_first
from roadlake.operators.time_range import on_days
from roadlake.schema import KEY_COLS, PARTITION_COLS, TARGET_SCHEMA

_KEY = "roadlake.key"


def declare(
    spark: SparkSession, table: str, path: str, keys: Sequence[str] = KEY_COLS, schema: StructType = TARGET_SCHEMA
) -> None:
    """Register the Parquet tree at ``path`` with its partitions and its key; folders that are there are taken up.

    Declaring it again takes up folders that have come since, and is refused with another key.
    """
    missing = [k for k in keys if k not in schema.names]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if spark.catalog.tableExists(table):
        if declared(spark, table) != list(keys):
            raise ValueError(f"{table} has the key {', '.join(declared(spark, table))}")
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(PARTITION_COLS)}) "
            f"LOCATION '{path}' TBLPROPERTIES ('{_KEY}' = '{','.join(keys)}')"
        )
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def declared(spark: SparkSession, table: str) -> list[str]:
    """The key of a table; ValueError where none was declared."""
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _KEY not in properties:
        raise ValueError(f"{table} has no declared key")
    return properties[_KEY].split(",")


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with their number. A null equals nothing, so rows with one in the key repeat none."""
    counted = rows.where(complete(keys)).groupBy(*fixed_width_first(rows, keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1").select(*keys, "n_rows")


def check_key(spark: SparkSession, table: str, first_day: date | None = None, last_day: date | None = None, shown: int = 5) -> None:
    """ValueError that names some of the keys that occur more than once among the days given.

    The key holds the event time, from which the day follows, so equal keys meet within a day: a load need only
    have the days checked that it has touched.
    """
    keys = declared(spark, table)
    rows = on_days(spark.table(table), first_day, last_day)
    found = repeated_keys(rows, keys).orderBy(F.desc("n_rows"), *keys).limit(shown).collect()
    if found:
        listed = "; ".join(", ".join(str(r[k]) for k in keys) + f" ({r.n_rows} rows)" for r in found)
        raise ValueError(f"{table}: keys that are not unique: {listed}")
