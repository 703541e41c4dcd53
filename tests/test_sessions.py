"""Session summaries against a direct walk over each user's events."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shopframe.operators import features, survey
from shopframe.plans.sessions import as_sessions, session_summaries, session_values, slot_of

GAP = 12 * 3600 * 1_000_000


def walk(rows, gap=dt.timedelta(hours=12)):
    out, last = {}, {}
    for u, t, kind, k in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        if u not in last or t - last[u][0] > gap:
            last[u] = (t, t)
        else:
            last[u] = (t, last[u][1])
        out.setdefault((u, last[u][1]), []).append((t, kind, k))
    return out


def events(seed):
    r = random.Random(seed)
    rows = []
    for u in [0, 1, 2, None]:
        t = dt.datetime(1969, 12, 30) if u else dt.datetime(2024, 1, 1)
        for _ in range(3000 if u == 0 else 200):  # user 0 has nearly all events
            t += r.choice([dt.timedelta(0), dt.timedelta(minutes=3), dt.timedelta(hours=5), dt.timedelta(hours=12), dt.timedelta(hours=12, microseconds=1), dt.timedelta(hours=40)])
            rows.append((u, t, r.choice(["view", "buy"]), r.randint(0, 9)))
    rows += [(1, None, "view", 3), (9, dt.datetime(2024, 1, 1), "buy", None)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_summaries(spark, seed):
    rows = events(seed)
    ev = spark.createDataFrame(rows, "uid long, ts timestamp_ntz, kind string, k long").repartition(5)
    s = session_summaries(ev, "uid", "ts", GAP, sums={"views": F.when(F.col("kind") == "view", 1).otherwise(0)}, mins={"low": F.col("k")}, maxes={"high": F.col("k")})
    got = {(r.uid, r.session_start): (r.session_end, r.n_events, r.views, r.low, r.high) for r in s.collect()}
    want = {}
    for key, ev_ in walk(rows).items():
        ks = [k for _, _, k in ev_ if k is not None]
        want[key] = (max(t for t, _, _ in ev_), len(ev_), sum(kind == "view" for _, kind, _ in ev_), min(ks, default=None), max(ks, default=None))
    assert got == want
    v = session_values(ev, "uid", "ts", GAP, F.col("k"), F.col("kind") == "view")
    assert sorted(map(tuple, v.collect()), key=repr) == sorted({(*key, k) for key, ev_ in walk(rows).items() for _, kind, k in ev_ if kind == "view"}, key=repr)


def test_slots_before_1970(spark):
    t = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23),), (dt.datetime(1970, 1, 1),), (dt.datetime(1970, 1, 1, 12),)], "ts timestamp_ntz")
    assert [r[0] for r in t.select(slot_of("ts", GAP)).collect()] == [-1, 0, 1]


def test_one_exchange_of_the_events(spark):
    ev = spark.createDataFrame(events(1), "uid long, ts timestamp_ntz, kind string, k long")
    plan = session_summaries(ev, "uid", "ts", GAP)._jdf.queryExecution().sparkPlan().toString()
    # before any exchange the events are reduced by a partial aggregate
    assert "partial_min(ts" in plan


def test_events_with_sessions_give_the_same_features(spark):
    s = "user_id long, session_id string, sequence_number int, event_type string, uri string, traffic_source string, created_at timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, "1-a", 1, "product", "/product/5", "Search", t), (1, "1-a", 2, "cart", "/cart", "Search", t),
                                (1, "1-b", 1, "purchase", "/purchase", "Email", t + dt.timedelta(days=3)), (None, "0-a", 1, "product", "/product/7", "Email", t)], s)
    got = {r.session_id: (r.session_depth, r.has_purchase, r.has_cart, r.products_viewed) for r in features.session_stats(ev).collect()}
    assert got == {"1-a": (2, 0, 1, 1), "1-b": (1, 1, 0, 0)}
    first = features.first_session_features(ev).collect()
    assert [tuple(r) for r in first] == [(1, 2, 1, 1, 0, "Search")]
    assert [(r.product_id, r.is_cancelled) for r in survey.anonymous_sessions(ev).collect()] == [(7, 0)]
    assert as_sessions(as_sessions(ev)).count() == 3
