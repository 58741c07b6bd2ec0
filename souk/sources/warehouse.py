"""The shop's flat tables over a folder of order and event tables in Parquet.

Orders and their lines become transactions, parts become products, customers
become users, and the event log is cut into sessions. Every table is derived by
Spark from the whole input tables; a table that a report does not use is not built.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.functions.columns import ISO, session_key
from souk.functions.sessionize import session_slices, tag_events
from souk.schemas import BROWSERS, DEVICE_TYPES, PAYMENT_METHODS, REFERRERS
from souk.session import dealt, tasks_for

SESSION_GAP_SECONDS = 6 * 3600
#: Lines that a task joins with their orders, and sums by them.
LINES_OF_TASK = 500_000
OPERATING_SYSTEMS = ("iOS", "Android", "Windows", "Linux")
# The event that stands for a page type.
EVENT_OF_PAGE = {
    "product_detail": "view",
    "category_listing": "click",
    "checkout": "purchase",
    "home": "signup",
    "search": "error",
}


def key(prefix: str, number: str, width: int) -> str:
    """SQL for a text id such as ``user_000000042``."""
    return f"concat('{prefix}_', lpad(string({number}), {width}, '0'))"


def pick(values: tuple[str, ...], position: str) -> str:
    """SQL for the value at a 0-based position of a short fixed list."""
    listed = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({listed}), int({position}) + 1)"


def iso(ts: str) -> str:
    pattern = ISO.replace("'", "\\'")
    return f"date_format({ts}, '{pattern}')"


# SQL for the columns of orders, products and session products.
PAYMENT_METHOD = pick(PAYMENT_METHODS, "int(substring(o_orderpriority, 1, 1)) - 1")
ORDER_COLUMNS = (
    f"{key('txn', 'o_orderkey', 12)} AS transaction_id",
    f"{key('user', 'o_custkey', 9)} AS user_id",
    f"{iso('timestamp(o_orderdate)')} AS timestamp",
    "timestamp(o_orderdate) AS ts",
    f"{PAYMENT_METHOD} AS payment_method",
    """CASE WHEN o_orderkey % 7 = 0 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'completed'
            WHEN o_orderstatus = 'O' THEN 'shipped' WHEN o_orderstatus = 'P' THEN 'processing' END AS status""",
)
CATEGORY_ID = "concat('cat_', p_type) AS category_id"
SUBCATEGORY_ID = "concat_ws('_', 'sub', p_type, p_brand) AS subcategory_id"
SESSION_ID = f"{key('sess', 'first_event_id', 10)} AS session_id"
PRODUCT_ID = f"{key('prod', 'product', 9)} AS product_id"


#: What a session's events are counted by.
VISIT_MEASURES = {
    "purchases": "event_type = 'purchase'",
    "clicks": "event_type = 'click'",
    "product_views": "event_type = 'view' AND product IS NOT NULL",
    "cart_events": "event_type IN ('click', 'purchase') AND product IS NOT NULL",
}


def counted() -> list[Column]:
    return [F.expr(f"count_if({test}) AS {name}") for name, test in VISIT_MEASURES.items()]


class Warehouse:
    """Attributes as in :class:`souk.sources.shop.Shop`, each built on first use.

    Page views are given per page type by :meth:`pages`.
    """

    def __init__(self, spark: SparkSession, folder: str, user: int | None = None):
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder
        self.user = user
        self.schemas: dict[str, StructType] = {}

    def of_user(self, user_id: str) -> "Warehouse":
        """The same tables with the events of one user; the scan of the event log is filtered by its number."""
        return Warehouse(self.spark, self.folder, int(user_id.rpartition("_")[2]))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self.schemas:
            self.schemas[name] = self.spark.read.parquet(self.path(name)).schema
        return self.spark.read.schema(self.schemas[name]).parquet(self.path(name))

    # --- users and products -------------------------------------------------

    @cached_property
    def districts(self) -> DataFrame:
        """City to province. Nations and regions are fixed lists of 25 and 5 rows."""
        nation, region = self.table("nation"), F.broadcast(self.table("region"))
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").selectExpr(
            "n_nationkey", "n_name AS city", "r_name AS province"
        )

    @cached_property
    def users(self) -> DataFrame:
        registered = (
            "timestamp'1994-10-01 00:00:00' + make_dt_interval(int(c_custkey % 92), int(c_custkey % 24))"
        )
        active = f"{registered} + make_dt_interval(int(30 + c_custkey % 61))"
        return (
            self.table("customer")
            .join(F.broadcast(self.districts), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .selectExpr(
                f"{key('user', 'c_custkey', 9)} AS user_id",
                "city",
                "province AS state",
                "'RW' AS country",
                f"{iso(registered)} AS registration_date",
                f"{iso(active)} AS last_active",
                f"{registered} AS registered_at",
            )
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self.table("part").selectExpr(CATEGORY_ID, "concat(p_type, ' goods') AS category_name").distinct()

    @cached_property
    def subcategories(self) -> DataFrame:
        return (
            self.table("part")
            .selectExpr(
                CATEGORY_ID,
                SUBCATEGORY_ID,
                "p_brand AS subcategory_name",
                "double(int(regexp_extract(p_brand, '([0-9]+)$', 1)) % 36 + 10) / 100 AS profit_margin",
            )
            .distinct()
        )

    @cached_property
    def products(self) -> DataFrame:
        created = "timestamp'1994-01-01 00:00:00' + make_dt_interval(int(p_partkey % 270))"
        return self.table("part").selectExpr(
            f"{key('prod', 'p_partkey', 9)} AS product_id",
            "p_name AS name",
            CATEGORY_ID,
            SUBCATEGORY_ID,
            "CAST(p_retailprice AS DECIMAL(12,2)) AS base_price",
            "p_partkey % 50 AS current_stock",
            "p_partkey % 50 > 0 AS is_active",
            f"{iso(created)} AS creation_date",
        )

    # --- transactions -------------------------------------------------------
    # Joins and sums run on the raw narrow columns; ids and labels are built after them.

    @cached_property
    def transactions(self) -> DataFrame:
        # Whole cents and whole percents: exact, and summed as plain longs.
        sums = (
            self.table("lineitem")
            .selectExpr("l_orderkey", "bigint(rint(l_extendedprice * 100)) AS cents", "bigint(rint(l_discount * 100)) AS pct")
            .groupBy("l_orderkey")
            .agg(F.sum("cents").alias("cents"), F.expr("sum(cents * pct) AS units"), F.count("*").alias("lines"))
        )
        joined = self.table("orders").join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        amounts = joined.selectExpr(
            "*",
            "CAST(CAST(coalesce(cents, 0) AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(20,4)) AS subtotal",
            "CAST(CAST(coalesce(units, 0) AS DECIMAL(18,0)) * 0.0001BD AS DECIMAL(20,4)) AS discount",
        )
        return amounts.selectExpr(
            "o_orderkey",
            f"{key('sess', 'o_orderkey div 2', 10)} AS session_id",
            *ORDER_COLUMNS,
            "subtotal",
            "discount",
            "CAST(subtotal - discount AS DECIMAL(20,4)) AS total",
            "coalesce(lines, 0) AS item_count",
        )

    @cached_property
    def lines(self) -> DataFrame:
        # Cents per unit, rounded half up in whole numbers.
        cents, units = "bigint(rint(l_extendedprice * 100))", "bigint(l_quantity)"
        unit_cents = f"(2 * {cents} + {units}) div nullif(2 * {units}, 0)"
        # counted in the footers of the files
        tasks = tasks_for(self.spark, self.table("lineitem").count(), LINES_OF_TASK)
        orders = dealt(self.table("orders"), tasks, "o_orderkey")
        return (
            dealt(self.table("lineitem"), tasks, "l_orderkey")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .selectExpr(
                "o_orderkey",
                *ORDER_COLUMNS,
                "bigint(l_linenumber) AS line_number",
                f"{key('prod', 'l_partkey', 9)} AS product_id",
                "bigint(l_quantity) AS quantity",
                f"CAST(CAST({unit_cents} AS DECIMAL(12,0)) * 0.01BD AS DECIMAL(12,2)) AS unit_price",
                f"CAST(CAST({cents} AS DECIMAL(12,0)) * 0.01BD AS DECIMAL(12,2)) AS subtotal",
            )
        )

    @cached_property
    def raw_transactions(self) -> DataFrame:
        """Transactions with the faults that cleaning has to handle."""
        return self.transactions.selectExpr(
            "transaction_id",
            "CASE WHEN o_orderkey % 101 <> 0 THEN user_id END AS user_id",
            "CASE WHEN o_orderkey % 83 = 0 THEN 'not-a-date' ELSE timestamp END AS timestamp",
            """CASE WHEN o_orderkey % 103 = 0 THEN NULL
                    WHEN o_orderkey % 5 = 0 THEN concat('  ', upper(status), ' ') ELSE status END AS status""",
            "subtotal",
            "discount",
            """CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    WHEN o_orderkey % 89 = 0 THEN -total ELSE total END AS total""",
        )

    # --- sessions -----------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        """The event log with numeric users; the product is set for the kinds that have one."""
        events = self.table("events")
        if self.user is not None:
            events = events.where(F.col("user_id") == self.user)
        return events.selectExpr(
            "event_id",
            "timestamp(ts) AS ts",
            "user_id",
            "event_type",
            "value",
            "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN get_json_object(props, '$.k') END AS product",
        )

    def pages(self, page_type: str) -> DataFrame:
        """The page views of one type; the type becomes a filter of the scan."""
        return self.events.where(F.col("event_type") == EVENT_OF_PAGE[page_type]).selectExpr(
            f"{key('user', 'user_id', 9)} AS user_id",
            "ts",
            f"'{page_type}' AS page_type",
            PRODUCT_ID,
            "floor(value) AS view_duration",
        )

    @cached_property
    def _visits(self) -> DataFrame:
        """One row per session of the event log, with its raw measures."""
        slices = session_slices(self.events, SESSION_GAP_SECONDS, *counted())
        return self._visit_rows(slices)

    def _visit_rows(self, parts: DataFrame, *cells: Column) -> DataFrame:
        """Sessions from the parts that their events are counted in; ``cells`` are further aggregates."""
        visits = parts.groupBy("user_id", "first_event_id").agg(
            F.min("started_at").alias("started_at"),
            F.max("last_ts").alias("ended_at"),
            F.sum("event_count").alias("page_view_count"),
            *[F.sum(name).alias(name) for name in VISIT_MEASURES],
            *cells,
        )
        more = visits.columns[5 + len(VISIT_MEASURES) :]
        return visits.selectExpr(
            "first_event_id",
            SESSION_ID,
            f"{key('user', 'user_id', 9)} AS user_id",
            "started_at",
            "ended_at",
            "(unix_micros(ended_at) - unix_micros(started_at)) div 1000000 AS duration_seconds",
            f"{pick(DEVICE_TYPES, 'user_id % 3')} AS device_type",
            f"{pick(OPERATING_SYSTEMS, 'user_id % 4')} AS os",
            f"{pick(BROWSERS, 'user_id % 4')} AS browser",
            f"{pick(REFERRERS, 'first_event_id % 7')} AS referrer",
            "CASE WHEN purchases > 0 THEN 'converted' WHEN clicks > 0 THEN 'abandoned' ELSE 'browsing' END"
            " AS conversion_status",
            "page_view_count",
            "product_views > 0 AS has_viewed_product",
            "cart_events > 0 AS has_cart",
            *more,
        )

    @cached_property
    def sessions(self) -> DataFrame:
        return self._visits.selectExpr(
            "* EXCEPT (first_event_id)", f"{iso('started_at')} AS start_time", f"{iso('ended_at')} AS end_time"
        )

    @cached_property
    def _product_events(self) -> DataFrame:
        return tag_events(self.events, SESSION_GAP_SECONDS).where("product IS NOT NULL")

    @cached_property
    def viewed(self) -> DataFrame:
        return self._product_events.where("event_type = 'view'").selectExpr(SESSION_ID, PRODUCT_ID)

    @cached_property
    def cart_adds(self) -> DataFrame:
        """Cart quantities per product over all sessions; sessions need not be told apart for them."""
        return (
            self.events.where("event_type IN ('click', 'purchase') AND product IS NOT NULL")
            .where("user_id IS NOT NULL AND ts IS NOT NULL")
            .groupBy("product")
            .agg(F.count("*").alias("quantity"))
            .selectExpr(PRODUCT_ID, "quantity")
        )

    @cached_property
    def cart_days(self) -> DataFrame:
        """Cart quantities per product and day on which the session began."""
        return (
            self._product_events.where("event_type IN ('click', 'purchase')")
            .groupBy("product", F.to_date("started_at").alias("day"))
            .agg(F.count("*").alias("quantity"))
            .selectExpr(PRODUCT_ID, "timestamp(day) AS started_at", "quantity")
        )

    @cached_property
    def cart(self) -> DataFrame:
        price = self.products.selectExpr("product_id", "base_price AS price")
        owner = self._visits.select("first_event_id", "session_id", "user_id", "started_at", "ended_at", "conversion_status")
        return (
            self._product_events.where("event_type IN ('click', 'purchase')")
            .groupBy("first_event_id", "product")
            .agg(F.count("*").alias("quantity"))
            .join(owner, "first_event_id")
            .selectExpr("* EXCEPT (first_event_id, product)", PRODUCT_ID)
            .join(price, "product_id", "left")
        )

    @cached_property
    def session_cells(self) -> DataFrame:
        """Sessions with the cells that list or count products, and the user's place."""
        # Per product first: a cell holds each product once, however often it was viewed.
        per_product = (
            tag_events(self.events, SESSION_GAP_SECONDS)
            .groupBy("user_id", "first_event_id", "product")
            .agg(
                F.min("started_at").alias("started_at"),
                F.max("ts").alias("last_ts"),
                F.count("*").alias("event_count"),
                *counted(),
            )
            .selectExpr("*", PRODUCT_ID)
        )
        sessions = self._visit_rows(
            per_product,
            F.expr("concat_ws(',', array_sort(collect_list(product_id) FILTER (WHERE product_views > 0))) AS viewed_products"),
            F.expr("count_if(cart_events > 0) AS cart_size"),
        ).selectExpr("* EXCEPT (first_event_id)", f"{iso('started_at')} AS start_time", f"{iso('ended_at')} AS end_time")
        places = self.users.select("user_id", "city", "state")
        return sessions.join(places, "user_id", "left")

    @cached_property
    def cell_versions(self) -> DataFrame:
        """The statistics cells as written again and again while a session goes on: up to five versions of a row key."""
        return self.session_cells.select(
            session_key(F.col("user_id"), F.col("started_at")).alias("row_key"),
            "session_id",
            F.explode(F.expr("sequence(1L, 1 + page_view_count % 5)")).alias("written"),
            "page_view_count",
            "cart_size",
        ).selectExpr(
            "row_key",
            "session_id",
            "written",
            "page_view_count * written div (1 + page_view_count % 5) AS page_view_count",
            "cart_size * written div (1 + page_view_count % 5) AS cart_size",
        )

    @cached_property
    def raw_sessions(self) -> DataFrame:
        """Sessions with the faults that cleaning has to handle."""
        return self._visits.selectExpr(
            "session_id",
            "user_id",
            """CASE WHEN first_event_id % 11 = 0 THEN 0
                    WHEN first_event_id % 13 = 0 THEN NULL ELSE page_view_count END AS page_view_count""",
            """CASE WHEN first_event_id % 17 = 0 THEN NULL
                    WHEN first_event_id % 19 = 0 THEN '' ELSE referrer END AS referrer""",
            """CASE WHEN first_event_id % 29 = 0 THEN NULL
                    WHEN first_event_id % 23 = 0 THEN upper(conversion_status)
                    ELSE conversion_status END AS conversion_status""",
            "CASE WHEN first_event_id % 31 <> 0 THEN duration_seconds END AS duration_seconds",
        )
