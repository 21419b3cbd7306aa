import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as contract  # noqa: E402
from apronflow.plans import lake, marts, readings, serving, sinks, tracks  # noqa: E402
from oracle import connect, differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
MODULES = (readings, marts, lake, serving, tracks, sinks)
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(k for k in SQL if not k.startswith("stream_")))
def test_equals_sql(spark, con, name):
    extra, missing = differences(QUERIES[name](spark, FOLDER), con, SQL[name].strip())
    assert not extra and not missing, (list(extra.items())[:3], list(missing.items())[:3])


@pytest.mark.parametrize("name", ["stream_sample", "stream_dedupe", "stream_latest", "stream_changes", "stream_retractions"])
def test_streams_equal_sql(spark, con, name):
    extra, missing = differences(QUERIES[name](spark, FOLDER), con, SQL[name])
    assert not extra and not missing


def test_stream_and_batch_detect_alike(spark):
    key = lambda r: (r.event_id, r.event_type, r.airport, r.event_ts)
    stream, batch = ({key(r) for r in QUERIES[q](spark, FOLDER).collect()} for q in ("stream_events", "detect_events"))
    assert stream and stream == batch


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", ["p7_found", "p7_kept", "ontime_silver", "metar_silver", "gold_day_delay", "latest_position", "positions"])
def test_one_row_per_key_is_aggregated_by_hash(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
