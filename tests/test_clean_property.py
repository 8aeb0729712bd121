"""Cleaning stage against a plain-Python brute force on random inputs."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.plans import clean

SCHEMA = ("transaction_id string, customer_id string, product_id string, quantity bigint, "
          "unit_price double, transaction_date timestamp_ntz, region string")
DAY = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

row = st.tuples(
    st.sampled_from(["T1", "T2", "T3", None]),
    st.sampled_from(["C1", "C2", None]),
    st.sampled_from(["P1", "P2"]),
    st.integers(0, 3),
    st.sampled_from([10.0, 2.5, 0.0, -0.0, -1.0, float("nan")]),
    st.builds(lambda d, h: dt.datetime(2024, 2, 27) + dt.timedelta(days=d, hours=h),
              st.integers(0, 3), st.integers(0, 23)),
    st.sampled_from(["N", "S"]),
)


def order_key(r):
    tid, cid, pid, q, p, ts, reg = r
    return (ts, pid, (cid is None, cid or ""), q, (math.isnan(p), 0.0 if math.isnan(p) else p), reg)


def _z(t):
    """-0.0 and 0.0 sort alike in Spark; make them one value for comparing."""
    return tuple(v + 0.0 if isinstance(v, float) else v for v in t)


def brute(rows):
    first = {}
    for r in sorted(rows, key=order_key):
        first.setdefault(r[0], r)  # None is one key
    out = []
    for tid, cid, pid, q, p, ts, reg in first.values():
        if math.isnan(p) or p < 0:
            continue
        out.append((tid, cid if cid is not None else "UNKNOWN", pid, q, p, ts, reg, q * p,
                    ts.date(), ts.hour, DAY[ts.weekday()]))
    return sorted((_z(t) for t in out), key=repr)


def brute_metrics(rows):
    first = {}
    for r in sorted(rows, key=order_key):
        first.setdefault(r[0], r)
    kept = brute(rows)
    return (len(rows), len(kept), len(rows) - len(first),
            sum(1 for r in first.values() if r[1] is None), len(first) - len(kept))


def test_cleaning_matches_brute_force(spark):
    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=0, max_size=25))
    def check(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        got = sorted((_z(tuple(r)) for r in clean.cleaned_sales(df).collect()), key=repr)
        assert got == brute(rows)
        m = clean.cleaning_metrics(df).first()
        assert (m.initial_rows, m.final_rows, m.duplicates_removed, m.missing_values_filled,
                m.invalid_prices_removed) == brute_metrics(rows)

    check()
