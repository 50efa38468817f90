"""Plan properties: pushdown, pruning, partition pruning, broadcast joins,
no cartesian products."""

from eventlake.operators import percentiles
from eventlake.plans.batch_queries import events, raw_lake
from eventlake.sources.files import scan_events
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_counts_without_expand_and_prunes_columns(spark):
    res = percentiles.percentile_report(events(spark, SF001), min_events=5, sort=False)
    plan = _plan(res)
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Expand" not in plan
    # the events once, for the distinct counts; the quantiles and moments come from their written table
    assert plan.count("events.parquet") == 1
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]
    # every shuffle is fed by a partial aggregate or is of a group table
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in "".join(lines[i + 1:i + 3]) or "parquet" in "".join(lines[i + 1:i + 4])


def test_filters_pushed_to_parquet(spark):
    res = percentiles.percentile_report(events(spark, SF001), min_events=5, sort=False)
    plan = _plan(res)
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(value), IsNotNull(event_type), GreaterThan(value,0.0)" in plan


def test_day_scan_prunes_partitions(spark):
    lake = raw_lake(spark, SF001)
    df = scan_events(spark, lake, day="2024-01-15")
    plan = _plan(df)
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "isnotnull(year" in plan and "(day#" in plan
    assert df.count() > 0
    assert df.columns == ["device_type", "device_id", "timestamp", "event_duration"]


def test_result_sorted_by_group(spark):
    res = percentiles.percentile_report(events(spark, SF001), min_events=5)
    keys = [(r.device_type, r.event_date) for r in res.collect()]
    assert keys == sorted(keys) and len(keys) > 0


def test_json_payload_parsed_once(spark):
    """Filters on parsed fields must not multiply the JSON parse: the
    optimizer would otherwise split ``data.field`` into one from_json per
    field reference."""
    from eventlake.plans.event_queries import records
    from eventlake.streaming.stream_job import quality_stream, quarantine_stream

    for df in (quarantine_stream(records(spark, SF001)), quality_stream(records(spark, SF001))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # one parse of the payload; the rest belongs to the test-table adapter (props)
        assert plan.count("from_json") <= 4
