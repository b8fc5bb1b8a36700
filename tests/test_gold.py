"""Gold aggregates on the F4 fixture, values derived by hand."""

import datetime as dt

import pytest

from tributary.operators import gold as G

D = dt.datetime(2024, 1, 1)


def t(h, m, s):
    return D.replace(hour=h, minute=m, second=s)


# window edges (12:00:00 and 12:01:00 exactly), a time that is NULL, ties
ROWS = [("g1", "amy", t(12, 0, 0), "page_view", "k1", "x", None),
        ("g2", "amy", t(12, 0, 0), "add_to_cart", "k1", "x", 8.5),
        ("g3", "amy", t(12, 0, 59), "purchase", "k1", "x", 8.5),
        ("g4", "bob", t(12, 0, 7), "page_view", "k2", "y", None),
        ("g5", "bob", t(12, 0, 8), "search", None, "y", None),
        ("g6", "cat", t(12, 1, 0), "page_view", "k1", "z", None),
        ("g7", "cat", t(12, 4, 59), "add_to_cart", "k1", "z", 3.25),
        ("g8", "dan", None, "page_view", "k1", "w", 99.0)]
SCHEMA = ("event_id string, user_id string, event_timestamp timestamp, event_type string, "
          "product_id string, session_id string, cart_value double")


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_events_per_minute(silver, mode):
    out = {(r.window_start.minute, r.event_type): (r.event_count, r.unique_users, r.unique_sessions)
           for r in G.events_per_minute(silver, distinct=mode).collect()}
    assert out == {(0, "page_view"): (2, 2, 2), (0, "add_to_cart"): (1, 1, 1),
                   (0, "purchase"): (1, 1, 1), (0, "search"): (1, 1, 1),
                   (1, "page_view"): (1, 1, 1), (4, "add_to_cart"): (1, 1, 1)}


def test_conversion_rate(silver):
    r = G.conversion_rate(silver, distinct="exact").collect()
    assert len(r) == 1
    r = r[0]
    assert (r.window_start, r.window_end) == (t(12, 0, 0), t(12, 5, 0))
    assert (r.total_events, r.purchases, r.add_to_carts, r.sessions) == (7, 1, 2, 3)
    assert r.conversion_rate == pytest.approx(1 / 3) and r.cart_to_purchase_rate == 0.5


def test_conversion_rate_zero_purchases(spark):
    df = spark.createDataFrame([ROWS[0], ROWS[3]], SCHEMA)
    r = G.conversion_rate(df).first()
    assert r.purchases == 0 and r.conversion_rate == 0.0 and r.cart_to_purchase_rate == 0.0


@pytest.mark.parametrize("method", ["expand", "panes"])
def test_popular_products(silver, method):
    rows = G.popular_products(silver, method=method).collect()
    p1 = [r for r in rows if r.product_id == "k1"]
    p2 = [r for r in rows if r.product_id == "k2"]
    assert len(p1) == 12 and len(p2) == 12
    assert min(r.window_start for r in p1) == t(11, 5, 0)
    assert max(r.window_start for r in p1) == t(12, 0, 0)
    for r in p1:
        assert (r.total_interactions, r.views, r.cart_adds, r.purchases) == (5, 2, 2, 1)
        assert r.total_revenue == pytest.approx(20.25)
    for r in p2:
        assert (r.total_interactions, r.views, r.cart_adds, r.purchases) == (1, 1, 0, 0)
        assert r.total_revenue is None


def test_active_users_hourly(silver):
    r = G.active_users_hourly(silver, distinct="exact").collect()
    assert len(r) == 1
    r = r[0]
    assert (r.hour_start, r.hour_end) == (t(12, 0, 0), t(13, 0, 0))
    assert (r.active_users, r.total_sessions, r.total_events) == (3, 3, 7)
    assert r.avg_cart_value == pytest.approx(20.25 / 3)


def test_exact_refused_on_stream(spark):
    stream = spark.readStream.format("rate").load().selectExpr(
        "timestamp AS event_timestamp", "'x' AS event_type", "'u' AS user_id",
        "'s' AS session_id")
    with pytest.raises(ValueError):
        G.events_per_minute(stream, distinct="exact")
