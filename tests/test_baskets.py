import random
from collections import Counter
from itertools import combinations

import pytest

from documents import session, shop, transaction
from souk.operators import baskets


def counts(rows):
    by_basket = {}
    for basket, item in rows:
        by_basket.setdefault(basket, set()).add(item)
    return Counter(pair for items in by_basket.values() for pair in combinations(sorted(items), 2))


def best(found, n):
    return sorted(((a, b, c) for (a, b), c in found.items()), key=lambda r: (-r[2], r[0], r[1]))[:n]


def partners(found, n):
    sides = {}
    for (a, b), c in found.items():
        sides.setdefault(a, []).append((-c, b))
        sides.setdefault(b, []).append((-c, a))
    return {(x, i, y, -c) for x, ps in sides.items() for i, (c, y) in enumerate(sorted(ps)[:n], 1)}


def generate(seed, giants):
    """Ordinary baskets with popular items, and giants that hold a large part of all items."""
    rng = random.Random(seed)
    items = [f"i{k:03d}" for k in range(60)]
    weights = [1 / (k + 1) ** 0.7 for k in range(60)]
    rows = {(f"b{b}", i) for b in range(40) for i in rng.choices(items, weights, k=rng.randrange(1, 9))}
    for g in range(giants):
        rows |= {(f"g{g}", i) for i in rng.sample(items, 45)}
        # Items that only giants hold, with ids before and after the others.
        rows |= {(f"g{g}", f"{prefix}{k:03d}") for prefix in "az" for k in rng.sample(range(20), 12)}
    return sorted(rows)


@pytest.mark.parametrize(
    ("giants", "giant_size", "block"),
    [(0, 2_000, 500), (1, 20, 500), (5, 20, 500), (7, 20, 5), (3, 2_000, 4), (7, 3, 2), (40, 20, 500), (70, 20, 9)],
)
def test_pairs_match_brute_force(spark, giants, giant_size, block):
    data = generate(giants * 31 + giant_size + block, giants)
    df = spark.createDataFrame(data, "basket string, item string")
    found = counts(data)
    got = [tuple(r) for r in baskets.top_pairs(df, 10, giant_size, block).collect()]
    assert got == best(found, 10)
    each = {tuple(r) for r in baskets.best_partners(df, 3, giant_size, block).collect()}
    assert each == partners(found, 3)


@pytest.mark.parametrize("n", [1, 5_000])
def test_more_pairs_than_exist(spark, n):
    data = generate(5, 2)
    df = spark.createDataFrame(data, "basket string, item string")
    assert [tuple(r) for r in baskets.top_pairs(df, n, 20, 10).collect()] == best(counts(data), n)


def test_no_baskets(spark):
    df = spark.createDataFrame([], "basket string, item string")
    assert baskets.top_pairs(df).count() == 0
    assert baskets.best_partners(df).count() == 0


def test_baskets_are_distinct_products_of_completed_orders(spark, rows):
    s = shop(
        spark,
        transactions=[
            transaction(1, "u", [("b", 1, 1.0), ("a", 1, 1.0)]),
            transaction(2, "u", [("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.0)]),
            transaction(3, "u", [("c", 1, 1.0)], "shipped"),
        ],
        sessions=[session(1, "u", viewed=["x", "y", "x"]), session(2, "v", viewed=["y", "x"]), session(3, "v", viewed=["x"])],
    )
    assert rows(baskets.top_pairs(baskets.purchase_baskets(s.lines))) == [("a", "b", 1)]
    assert rows(baskets.top_pairs(baskets.view_baskets(s.viewed))) == [("x", "y", 2)]
