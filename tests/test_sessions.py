import random
from datetime import datetime, timedelta

import pytest

from documents import session, shop, transaction
from souk.functions.sessionize import session_slices, tag_events
from souk.operators import keyed, products, sessions


def test_device_average_counts_a_session_once_per_transaction(spark, rows):
    s = shop(
        spark,
        sessions=[session(1, "u", seconds=60), session(2, "u", seconds=120)],
        transactions=[transaction(1, "u", [], session="s1"), transaction(2, "u", [], "refunded", session="s1")],
    )
    assert rows(sessions.device_conversion(s.sessions, s.transactions)) == [("mobile", 2, 2, 1.3, 100.0, 1.5)]
    assert rows(sessions.device_totals(s.sessions, s.transactions)) == [("mobile", 2, 1, 50.0)]


def test_referrers(spark, rows):
    s = shop(
        spark,
        sessions=[session(1, "u"), session(2, "u", referrer="facebook"), session(3, "u", referrer=None)],
        transactions=[
            transaction(1, "u", [("p", 1, 10.0)], session="s1"),
            transaction(2, "u", [("p", 1, 20.0)], session="s1"),
            transaction(3, "u", [("p", 1, 30.0)], "refunded", session="s2"),
            transaction(4, "u", [("p", 1, 30.0)], session=None),
        ],
    )
    got = sessions.referrer_revenue(s.sessions, s.transactions).collect()
    assert tuple(got[0]) == ("direct", 1, 2, 30.0, 15.0)
    assert {tuple(r) for r in got[1:]} == {("facebook", 1, 0, None, None), (None, 1, 0, None, None)}
    top = rows(sessions.referrer_top(s.sessions, s.transactions))
    assert top == [("direct", 1, 1, 100.0, 30.0), ("facebook", 1, 0, 0.0, 0.0), ("unknown", 1, 0, 0.0, 0.0)]


def test_funnel(spark, rows):
    s = shop(
        spark,
        sessions=[
            session(1, "u"),
            session(2, "u", viewed=["p"]),
            session(3, "u", viewed=["p"], cart={"p": (1, 1.0)}),
            session(4, "u", viewed=["p"], cart={"p": (1, 1.0)}, status="converted"),
        ],
        transactions=[transaction(1, "u", [])],
    )
    assert rows(sessions.session_funnel(s.sessions, s.transactions)) == [
        (1, "All Sessions", 4, 100.0, None),
        (2, "Viewed Product", 3, 75.0, 25.0),
        (3, "Added to Cart", 2, 50.0, 33.33),
        (4, "Converted", 1, 25.0, 50.0),
        (5, "Completed Order", 1, 25.0, 0.0),
    ]
    empty = sessions.session_funnel(s.sessions.limit(0), s.transactions.limit(0)).collect()
    assert [r.pct_of_first for r in empty] == [None] * 5


def test_lookups(spark, rows):
    s = shop(
        spark,
        sessions=[session(1, "u"), session(2, "u")],
        transactions=[
            transaction(1, "u", [("p", 1, 1.0)], session="s1", ts="2025-01-02T00:00:00"),
            transaction(2, "u", [("p", 1, 2.0)], "refunded", session="s1", ts="2025-01-03T00:00:00"),
            transaction(3, "u", [("p", 1, 3.0)], "refunded", session="s2"),
            transaction(4, "u", [("p", 1, 4.0)], session=""),
        ],
    )
    assert rows(sessions.session_last_total(s.transactions)) == [("s1", 2.0), ("s2", 3.0)]
    assert rows(sessions.converted_sessions(s.sessions, s.transactions)) == [("s1", "u")]


def test_product_funnel_keeps_viewed_products_only(spark, rows):
    detail = "product_detail"
    s = shop(
        spark,
        sessions=[
            session(1, "u", views=[(detail, "p1"), (detail, "p1"), (detail, None), ("cart", "p3")]),
            session(2, "u", views=[(detail, "p2")], cart={"p1": (3, 1.0), "p9": (1, 1.0)}),
        ],
        transactions=[transaction(1, "u", [("p1", 1, 1.0)]), transaction(2, "u", [("p1", 9, 1.0)], "processing")],
    )
    got = products.product_funnel(s.page_views, s.cart_quantities, s.lines)
    assert rows(got) == [("p1", 2, 3, 1, 150.0, 50.0), ("p2", 1, 0, 0, 0.0, 0.0)]


def test_product_performance(spark):
    detail = "product_detail"
    s = shop(
        spark,
        sessions=[
            session(1, "u1", views=[(detail, "p1")] * 3 + [(detail, "p2")]),
            session(2, "u2", views=[(detail, "p1")], cart={"p1": (2, 1.0)}),
        ],
        transactions=[transaction(1, "u", [("p1", 1, 7.0), ("p3", 2, 1.0)])],
    )
    got = {r.product_id: r for r in products.product_performance(s.page_views, s.cart, s.lines).collect()}
    p1 = got["p1"]
    assert (p1.row_key, p1.view_count, p1.unique_users, p1.avg_duration_sec) == ("p1#2025-02-01", 4, 2, 30.0)
    assert (p1.units_sold, p1.revenue, p1.cart_adds, p1.conversion_rate) == (1, 7.0, 2, 0.25)
    assert got["p2"].conversion_rate == 0.0
    assert (got["p3"].view_count, got["p3"].conversion_rate) == (0, None)


@pytest.mark.parametrize(("views", "units", "pct"), [(48, 4, 8.3), (62, 6, 9.7), (71, 9, 12.7)])
def test_conversion_arithmetic(spark, views, units, pct):
    s = shop(
        spark,
        sessions=[session(1, "u", views=[("product_detail", "p")] * views)],
        transactions=[transaction(1, "u", [("p", units, 1.0)])],
    )
    row = products.product_performance(s.page_views, s.cart, s.lines).first()
    assert round(row.conversion_rate * 100, 1) == pct


# --- keyed table ------------------------------------------------------------------


def test_prefix_reads_newest_first(spark):
    s = shop(
        spark,
        sessions=[
            session(1, "user_1", start="2025-03-02T00:00:00", status="converted", viewed=["p1", "p2"]),
            session(2, "user_1", start="2025-03-01T00:00:00"),
            session(3, "user_10", start="2025-03-03T00:00:00", status="converted"),
            session(4, "user_1", start="2025-03-04T00:00:00"),
        ],
    )
    table = keyed.session_keyed_table(s.session_cells)
    assert [r.session_id for r in keyed.user_sessions(table, "user_1").collect()] == ["s4", "s1", "s2"]
    assert [r.session_id for r in keyed.user_sessions(table, "user_1", 1).collect()] == ["s4"]
    assert [tuple(r) for r in keyed.user_converted_sessions(table, "user_1").collect()] == [
        ("s1", "2025-03-02T00:00:00", "p1,p2")
    ]
    assert len(table.columns) == 15
    assert {len(r.row_key.split("#")[1]) for r in table.collect()} == {19}
    recent = keyed.recent_sessions_per_user(s.sessions, 2).collect()
    assert {(r.user_id, r.position, r.session_id) for r in recent} == {
        ("user_1", 1, "s4"),
        ("user_1", 2, "s1"),
        ("user_10", 1, "s3"),
    }
    assert keyed.busiest_user(s.sessions).first().user_id == "user_1"


def test_last_write_wins(spark, rows):
    s = shop(spark, sessions=[session(1, "u"), session(2, "u", status="converted")])
    assert rows(keyed.session_keyed_table(s.session_cells).select("sess_session_id")) == [("s2",)]


def test_versions(spark, rows):
    cells = [("u#1", "s1", v, v, 0) for v in range(1, 6)] + [("u#2", "s2", 1, 7, 3), ("u#2", "s3", 1, 8, 4)]
    df = spark.createDataFrame(cells, "row_key string, session_id string, written long, page_view_count long, cart_size long")
    got = keyed.keep_last_versions(df).select("row_key", "version", "session_id", "page_view_count")
    assert rows(got) == [
        ("u#1", 1, "s1", 5), ("u#1", 2, "s1", 4), ("u#1", 3, "s1", 3), ("u#2", 1, "s3", 8), ("u#2", 2, "s2", 7),
    ]


# --- session boundaries --------------------------------------------------------------


def brute_force(events, gap):
    tagged, last = {}, {}
    for event_id, ts, user in sorted(events, key=lambda e: (e[2], e[1], e[0])):
        previous = last.get(user)
        first = event_id if previous is None or ts - previous[0] > gap else previous[1]
        last[user] = (ts, first)
        tagged[event_id] = first
    return tagged


@pytest.mark.parametrize("seed", range(4))
def test_sessions_match_brute_force(spark, seed):
    rng = random.Random(seed)
    start, gap = datetime(2024, 1, 1), timedelta(hours=6)
    # One user holds a third of the events; some times repeat and some gaps are exact.
    events = []
    for i in range(600):
        hours = rng.choice([rng.uniform(0, 400), rng.randrange(0, 400, 6)])
        events.append((i, start + timedelta(hours=hours), 0 if i % 3 == 0 else rng.randrange(1, 40)))
    rng.shuffle(events)
    df = spark.createDataFrame(events, "event_id long, ts timestamp, user_id long")
    got = {r.event_id: r.first_event_id for r in tag_events(df, 6 * 3600).collect()}
    assert got == brute_force(events, gap)
    slices = session_slices(df, 6 * 3600).collect()
    assert sum(r.event_count for r in slices) == 600
    assert len({(r.user_id, r.first_event_id) for r in slices}) == len(set(got.values()))
