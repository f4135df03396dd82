"""Fields beyond the schema."""

import pytest
from pyspark.sql import functions as F

from roadlake.functions.drift import extras_schema, promoted, with_extras

VALUES = [
    '{"vehicle_id":"a","x":1,"y":{"b":[1,2]},"z":null}', '{"x":"t"}', '{"vehicle_id":1}', None, "bad", "[1]", '{"x":1.5,"x":2}',
    """{"it's":true}""", '{"a.b":5}', "", '{"long":"' + "v" * 20_000 + '"}', '{"ünï":"é漢"}',
]
EXTRAS = [
    '{"x":1,"y":{"b":[1,2]},"z":null}', '{"x":"t"}', None, None, None, None, '{"x":2}', """{"it's":true}""", '{"a.b":5}', None,
    '{"long":"' + "v" * 20_000 + '"}', '{"ünï":"é漢"}',
]


@pytest.fixture
def kept(spark, folder):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "id int, value string")
    with_extras(frame).write.parquet(folder)
    return spark.read.parquet(folder)


def test_extra_fields_come_back_as_they_were(kept):
    got = {r.id: r.e for r in kept.select("id", F.to_json("extras").alias("e")).collect()}
    assert got == dict(enumerate(EXTRAS))


def test_types_are_found_and_fields_promoted(kept):
    some = kept.where("id < 9")
    assert extras_schema(some) == "OBJECT<`a.b`: BIGINT, `it's`: BOOLEAN, x: VARIANT, y: OBJECT<b: ARRAY<BIGINT>>, z: VOID>"
    rows = {r.id: r for r in promoted(some, {"x": "int", "it's": "boolean", "a.b": "bigint", "absent": "string"}).collect()}
    assert [rows[i].x for i in (0, 1, 6)] == [1, None, 2]
    assert rows[7]["it's"] is True and rows[8]["a.b"] == 5 and {r.absent for r in rows.values()} == {None}
    assert extras_schema(kept.limit(0)) == extras_schema(kept.where("id = 3")) == "OBJECT<>"
    with pytest.raises(ValueError, match="both kinds of quotes"):
        promoted(kept, {"a'\"": "int"})


def test_bytes_are_read_like_text(spark):
    frame = spark.createDataFrame([('{"x":1}',)], "value string").select(F.encode("value", "UTF-8").alias("value"))
    assert with_extras(frame).select(F.to_json("extras").alias("e")).first().e == '{"x":1}'
