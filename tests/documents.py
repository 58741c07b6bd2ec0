"""Small hand-made documents in the nested input form."""

from souk import schemas
from souk.sources.shop import Shop, from_documents


def user(user_id, registered="2025-01-10T00:00:00", city="Gasabo", state="Kigali"):
    return (user_id, (city, state, "RW"), registered, "2025-03-01T00:00:00", None)


def product(product_id, name, category="cat_1", subcategory="sub_1", price=10.0):
    return (product_id, name, category, subcategory, price, 5, True, [], "2024-12-01T00:00:00")


def transaction(
    number, user_id, items, status="completed", ts="2025-02-01T10:00:00", session=None, discount=0.0, method="cash"
):
    lines = [(p, q, price, round(q * price, 2)) for p, q, price in items]
    subtotal = round(sum((line[3] for line in lines), 0.0), 2)
    return (
        f"t{number}",
        session,
        user_id,
        ts,
        lines,
        subtotal,
        discount,
        round(subtotal - discount, 2),
        method,
        status,
    )


def session(
    number,
    user_id,
    start="2025-02-01T09:00:00",
    end="2025-02-01T09:10:00",
    seconds=600,
    viewed=(),
    views=(("home", None),),
    cart=None,
    status="browsing",
    referrer="direct",
    device="mobile",
):
    pages = [(start, kind, product_id, None, 30) for kind, product_id in views]
    return (
        f"s{number}",
        user_id,
        start,
        end,
        seconds,
        ("Gasabo", "Kigali", "RW", "10.0.0.1"),
        (device, "Android", "Chrome"),
        list(viewed),
        pages,
        cart or {},
        status,
        referrer,
    )


CATEGORIES = [
    ("cat_1", "Fresh Produce", [("sub_1", "Fruits", 0.2), ("sub_2", "Herbs", 0.3)]),
    ("cat_2", "Coffee & Tea", [("sub_3", "Green Tea", 0.25)]),
]


def shop(spark, users=(), products=(), sessions=(), transactions=(), categories=CATEGORIES) -> Shop:
    def frame(rows, entity):
        return spark.createDataFrame(list(rows), schemas.ENTITIES[entity])

    return from_documents(
        frame(users, "users"),
        frame(categories, "categories"),
        frame(products, "products"),
        frame(sessions, "sessions"),
        frame(transactions, "transactions"),
    )
