"""Property tests: Spark operators against brute-force Python on generated
rows (one DataFrame per example, few examples: each costs a Spark job)."""

import datetime as dt
import math
import statistics
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventlake.functions.numeric import round_half_up
from eventlake.operators import percentiles, quality
from tests.fixtures import event, events_df

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

durations = st.one_of(st.none(), st.just(math.nan), st.floats(-5, 4000, allow_nan=False),
                      st.sampled_from([0.0, 0.05, 0.1, 3600.0, 3600.01]))
batteries = st.one_of(st.none(), st.integers(-5, 110))
signals = st.one_of(st.none(), st.integers(-130, -20))
values = st.one_of(st.none(), st.just(math.nan), st.floats(-100, 100, allow_nan=False))


def brute_reasons(d, v, b, s, strict):
    out = []
    if d is None:
        out.append("missing_event_duration")
    if v is None:
        out.append("missing_value")
    if d is not None:
        lo_ok = (d >= 0.1) if strict else (d > 0)
        if math.isnan(d) or not (lo_ok and d <= 3600):
            out.append("duration_out_of_range")
    if v is not None and math.isnan(v):
        out.append("value_nan")
    if b is not None and not (0 <= b <= 100):
        out.append("battery_out_of_range")
    if s is not None and not (-120 <= s <= -30):
        out.append("signal_out_of_range")
    return out


@SETTINGS
@given(st.lists(st.tuples(durations, values, batteries, signals), min_size=1, max_size=40), st.booleans())
def test_rules_match_brute_force(spark, recs, strict):
    rows = [event(duration=d, value=v, battery=b, signal=s, offset=i) for i, (d, v, b, s) in enumerate(recs)]
    got = {r.offset: r.reject_reasons
           for r in quality.apply_rules(events_df(spark, rows), mode="strict" if strict else "lenient").collect()}
    for i, (d, v, b, s) in enumerate(recs):
        assert got[i] == brute_reasons(d, v, b, s, strict)


@SETTINGS
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=50))
def test_round_half_up_matches_decimal(spark, ints):
    # values with at most 4 decimals: exact decimal ties included
    vals = [i / 10000 for i in ints]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select("x", round_half_up("x", 3).alias("r"))
    for r in df.collect():
        expected = float(Decimal(repr(r.x)).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))
        assert r.r == expected


def brute_report(evs, min_events):
    groups = {}
    for d, t, dev in evs:
        if d is None or not (0 < d <= 3600):
            continue
        groups.setdefault((t.date(),), []).append((d, t, dev))
    out = {}
    for key, rows in groups.items():
        ds = [r[0] for r in rows]
        m = statistics.fmean(ds)
        sd = statistics.stdev(ds) if len(ds) > 1 else None
        kept = [r for r in rows if sd is None or not (r[0] < m - 3 * sd or r[0] > m + 3 * sd)]
        if len({(r[2], r[1]) for r in kept}) >= min_events:
            out[key[0]] = (len(kept), len({r[2] for r in kept}))
    return out


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(0.01, 50)), st.integers(0, 3 * 86400 - 1),
                          st.integers(0, 4)), min_size=1, max_size=60),
       st.integers(1, 12), st.lists(st.integers(0, 59), max_size=10))
def test_percentile_report_counts_match_brute_force(spark, recs, min_events, dup_idx):
    base = dt.datetime(2025, 1, 1)
    evs = [(d, base + dt.timedelta(seconds=s), f"door_sensor_{k}") for d, s, k in recs]
    evs += [evs[i] for i in dup_idx if i < len(evs)]  # redelivered copies
    rows = [event(duration=d, device_type="door_sensor", device_id=dev, timestamp=t, offset=i)
            for i, (d, t, dev) in enumerate(evs)]
    res = percentiles.percentile_report(events_df(spark, rows), min_events=min_events, sort=False).collect()
    got = {r.event_date: (r.total_events, r.unique_devices) for r in res}
    assert got == brute_report(evs, min_events)
