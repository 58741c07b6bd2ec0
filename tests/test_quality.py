import random
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest

from documents import shop, transaction, user
from souk.operators import quality

RAW = (
    "transaction_id string, user_id string, timestamp string, status string, "
    "subtotal decimal(18,2), discount decimal(18,2), total decimal(18,2)"
)


def raw(spark, *rows):
    def amount(x):
        return None if x is None else Decimal(str(x))

    return spark.createDataFrame([(*r[:4], *map(amount, r[4:])) for r in rows], RAW)


def test_transactions_without_key_fields_or_with_negative_total_are_dropped(spark, rows):
    df = raw(
        spark,
        ("a", "u", "2025-01-01", "shipped", 1, 0, None),
        ("b", None, "2025-01-01", "shipped", 1, 0, 1),
        ("c", "u", "2025-01-01", "shipped", 1, 0, -1),
        ("d", "u", "2025-01-01", "shipped", 1, 0, 0),
        ("e", None, "2025-01-01", "shipped", 1, 0, -1),
    )
    assert [r.transaction_id for r in quality.clean_transactions(df).collect()] == ["d"]
    assert rows(quality.transaction_report(df)) == [("kept", 1), ("missing_key_field", 3), ("negative_total", 1)]


def test_transaction_defaults(spark):
    df = raw(
        spark,
        ("a", "u", "2025-01-01T10:11:12", " Completed\n", 200, 25, 175),
        ("b", "u", "bad", None, 0, 5, 1),
        ("c", "u", None, "X", None, 5, 1),
        ("d", "u", "2025-1-1", "\tPaid ", 3, None, 3),
    )
    got = {r.transaction_id: (r.status, r.ts, r.discount_pct) for r in quality.clean_transactions(df).collect()}
    fallback = datetime(2026, 3, 7)
    assert got == {
        "a": ("completed", datetime(2025, 1, 1, 10, 11, 12), 12.5),
        "b": ("unknown", fallback, 0.0),
        "c": ("x", fallback, 0.0),
        "d": ("paid", fallback, 0.0),
    }


def test_session_rules(spark):
    df = spark.createDataFrame(
        [
            ("gone0", 0, "x", "converted", 5),
            ("gone1", None, "x", "converted", 5),
            ("a", 1, None, None, None),
            ("b", 1, "", " X", 0),
            ("c", 1, "direct", "CONVERTED", 14400),
            ("d", 1, "direct", "converted", 14401),
            ("e", 1, "direct", "converted", -5),
        ],
        "session_id string, page_view_count long, referrer string, conversion_status string, duration_seconds long",
    )
    got = {r[0]: tuple(r[2:]) for r in quality.clean_sessions(df).collect()}
    assert got == {
        "a": ("unknown", "browsing", 1),
        "b": ("unknown", " x", 1),
        "c": ("direct", "converted", 14400),
        "d": ("direct", "converted", 14400),
        "e": ("direct", "converted", 1),
    }
    assert {r.reason: r.row_count for r in quality.session_report(df).collect()} == {"kept": 5, "no_page_views": 2}


def test_unique_keys(spark, rows):
    df = spark.createDataFrame([("u1",), ("u2",), ("u1",)], "user_id string")
    assert rows(quality.duplicates(df, "users", "user_id")) == [("users", "u1", 2)]
    with pytest.raises(ValueError, match="u1"):
        quality.require_unique(df, "users", "user_id")
    assert quality.require_unique(df.distinct(), "users", "user_id").count() == 2


def test_relations(spark, rows):
    s = shop(
        spark,
        users=[user("u1"), user("u2"), user("u2")],
        transactions=[
            transaction(1, "u1", []),
            transaction(2, "u9", []),
            transaction(3, "u9", []),
            transaction(4, None, []),
        ],
    )
    got = quality.relation_faults("r", s.users, "user_id", s.transactions, "user_id")
    assert rows(got) == [("r", 2, 1, 1)]
    nothing = quality.relation_faults("r", s.users.limit(0), "user_id", s.transactions.limit(0), "user_id")
    assert rows(nothing) == [("r", 0, 0, 0)]


def test_relations_of_several_tables_against_plain_counts(spark, rows):
    r = random.Random(5)
    keys = {
        ("users", "id"): [None, None, *(r.choice("abcdef") for _ in range(12))],
        ("orders", "user"): [r.choice(["a", "b", "x", "y", None]) for _ in range(40)],
        ("visits", "user"): ["a"] * 30 + ["z"] * 5,
        ("visits", "id"): list(range(35)),
        ("orders", "visit"): [r.choice([1, 2, 3, 99, None]) for _ in range(40)],
    }
    visits = list(zip(keys["visits", "user"], keys["visits", "id"], strict=True))
    orders = list(zip(keys["orders", "user"], keys["orders", "visit"], strict=True))
    tables = {
        "users": spark.createDataFrame([(k,) for k in keys["users", "id"]], "id string"),
        "orders": spark.createDataFrame(orders, "user string, visit int"),
        "visits": spark.createDataFrame(visits, "user string, id long"),
        "none": spark.createDataFrame([], "id long"),
    }
    keys["none", "id"] = []
    wanted = [
        ("users", "id", "orders", "user"), ("users", "id", "visits", "user"), ("visits", "id", "orders", "visit"), ("none", "id", "visits", "id"),
        ("orders", "visit", "users", "id"),  # a number and a text
    ]
    relations = [quality.Relation(f"{p}-{c}", p, pk, c, ck) for p, pk, c, ck in wanted]
    plain = []
    for p, pk, c, ck in wanted:
        parents = Counter(None if k is None else str(k) for k in keys[p, pk])
        orphans = [k for k in keys[c, ck] if k is not None and str(k) not in parents]
        plain.append((f"{p}-{c}", len(orphans), len(set(orphans)), sum(n > 1 for n in parents.values())))
    got = quality.reference_faults(tables, relations)
    assert sorted(rows(got)) == sorted(plain)


def test_a_table_is_read_once_for_all_its_relations(spark, tmp_path):
    for name, schema in (("users", "id string"), ("orders", "user string, visit string"), ("visits", "user string, id string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("users", "orders", "visits")}
    relations = [
        quality.Relation("a", "users", "id", "orders", "user"),
        quality.Relation("b", "users", "id", "visits", "user"),
        quality.Relation("c", "visits", "id", "orders", "visit"),
    ]
    plan = quality.reference_faults(tables, relations)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_row_counts(spark, rows):
    df = spark.range(3)
    assert rows(quality.row_counts(a=df, b=df.limit(0))) == [("a", 3), ("b", 0)]
