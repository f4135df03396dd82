"""What the physical plans of the registered queries must not contain."""

import re

import pytest

from roadlake.plans.registry import QUERIES
from test_upsert import explain

SF_DIR = "/root/testdata/sf0.001"
#: Queries that write and read back: what runs inside them is looked at while they run.
READ_BACK = re.compile(r"q(07|08|09|10|16|17|18|25|26|28|29|3[1234578]|4[0-35-8]|5[0-4])_")
#: Per-row Python, and joins of everything with everything. The latter's nested loops are fine where one side is a row or two.
UNWANTED = re.compile("EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not READ_BACK.match(n)))
def test_no_python_rows_and_no_pairing_of_everything(spark, name):
    plan = explain(QUERIES[name](spark, SF_DIR))
    assert not re.search("EvalPython|InPandas|InArrow|Cartesian|NestedLoop|SinglePartition", plan)


@pytest.mark.parametrize("name, exchanges", [
    ("q01_decode_json", 0), ("q02_enrich_event_time", 0), ("q03_speed_fine", 0), ("q04_overspeed_alerts", 0),
    ("q13_coerce_event_time", 0), ("q14_null_normalise", 0), ("q15_dedupe_latest", 1),
    ("q19_quality_split", 0), ("q20_encode_decode", 0), ("q22_conform_to_target", 0),
])
def test_shuffles(spark, name, exchanges):
    assert explain(QUERIES[name](spark, SF_DIR)).count("Exchange") == exchanges


class Plans:
    """Receives the plan of every execution of a session."""

    def __init__(self):
        self.seen = []

    def onSuccess(self, name, execution, duration):
        self.seen.append(execution.executedPlan().toString())

    def onFailure(self, name, execution, error):
        pass

    class Java:
        implements = ["org.apache.spark.sql.util.QueryExecutionListener"]


@pytest.fixture(scope="module")
def plans(spark):
    from pyspark.java_gateway import ensure_callback_server_started

    ensure_callback_server_started(spark.sparkContext._gateway)
    listener = Plans()
    manager = spark._jsparkSession.listenerManager()
    manager.register(listener)
    yield listener.seen
    manager.unregister(listener)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if READ_BACK.match(n)))
def test_no_python_rows_inside_storage_queries(spark, plans, name):
    """Every bounded execution on the way, writes included."""
    plans.clear()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert len(plans) >= 2 and any("InsertIntoHadoopFsRelationCommand" in p or "WriteFiles" in p for p in plans)
    assert not [p for p in plans if UNWANTED.search(p)]
