"""The nightly batch: load, clean, analyze and export the nested documents."""

from dataclasses import fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from souk.operators import baskets, customers, flatten, keyed, products, quality, revenue, sessions
from souk.schemas import ENTITIES
from souk.sinks import tables
from souk.sources.json_files import MALFORMED, read_entity_records
from souk.sources.shop import Shop, flat_categories, flat_subcategories, from_documents

UNIQUE_KEYS = {"users": ("user_id",), "products": ("product_id",)}


def load_tables(spark: SparkSession, json_folder: str, table_folder: str) -> None:
    """Replace the stored tables by the JSON files; products get their category names.

    Records that do not have the schema are left out, and their texts stored in ``malformed``. The table ``load_report`` counts the records
    and the malformed ones of each entity, in the pass that writes it; a second pass fetches the texts only where there are any.
    """
    records = {entity: read_entity_records(spark, json_folder, entity) for entity in ENTITIES}
    well_formed = F.col(MALFORMED).isNull()
    categories = records["categories"].where(well_formed).drop(MALFORMED)
    counts = []
    for entity, df in records.items():
        seen = Observation(f"load {entity}")
        df = df.observe(seen, F.count("*").alias("records"), F.count(MALFORMED).alias("malformed"))
        df = df.where(well_formed).drop(MALFORMED)
        if entity == "products":
            df = flatten.enrich_products(df, flat_categories(categories), flat_subcategories(categories))
        tables.replace_table(df, table_folder, entity, UNIQUE_KEYS.get(entity, ()))
        counts.append((entity, seen.get["records"], seen.get["malformed"]))
        if seen.get["malformed"]:
            malformed = records[entity].where(~well_formed).select(MALFORMED)
        else:
            malformed = spark.createDataFrame([], f"{MALFORMED} STRING")
        tables.replace_table(malformed, f"{table_folder}/malformed", entity)
    report = spark.createDataFrame(counts, "entity STRING, records BIGINT, malformed BIGINT")
    tables.replace_table(report, table_folder, "load_report")


def clean_shop(spark: SparkSession, table_folder: str) -> Shop:
    """The flat tables over cleaned transactions and sessions, written once and read back for all analyses and exports.

    The rows kept and the rows rejected by reason are stored as the tables ``transaction_report`` and ``session_report``.
    """
    stored = {entity: spark.read.parquet(f"{table_folder}/{entity}") for entity in ENTITIES}
    visits = stored["sessions"].withColumn("page_view_count", F.size("page_views"))
    tables.replace_table(quality.transaction_report(stored["transactions"]), table_folder, "transaction_report")
    tables.replace_table(quality.session_report(visits), table_folder, "session_report")
    stored["sessions"] = quality.clean_sessions(visits).drop("page_view_count")
    stored["transactions"] = quality.clean_transactions(stored["transactions"])
    flat = from_documents(**stored)

    def written(name: str) -> DataFrame:
        table = getattr(flat, name)
        return spark.read.schema(table.schema).parquet(tables.replace_table(table, f"{table_folder}/clean", name))

    return Shop(**{f.name: written(f.name) for f in fields(Shop)})


def analyze(shop: Shop, out: str) -> None:
    """The analyses, each written as a table of its own."""
    estimates = customers.clv(shop.users, shop.transactions, shop.sessions)
    detailed = flatten.with_category(shop.products.drop("category_name"), shop.categories)
    results = {
        "copurchase_pairs": baskets.top_pairs(baskets.purchase_baskets(shop.lines)),
        "also_bought": baskets.best_partners(baskets.purchase_baskets(shop.lines)),
        "coview_pairs": baskets.top_pairs(baskets.view_baskets(shop.viewed)),
        "cohort_spend": customers.cohort_spend(shop.users, shop.transactions),
        "clv": customers.clv_ranked(estimates),
        "purchase_summary": customers.purchase_summary(shop.transactions),
        "user_segments": customers.user_segments(shop.users, shop.transactions),
        "product_revenue": revenue.product_revenue(shop.lines),
        "monthly_revenue": revenue.monthly_revenue(shop.transactions),
        "category_revenue": revenue.category_revenue(shop.lines, detailed),
        "device_conversion": sessions.device_conversion(shop.sessions, shop.transactions),
        "referrer_revenue": sessions.referrer_revenue(shop.sessions, shop.transactions),
        "session_funnel": sessions.session_funnel(shop.sessions, shop.transactions),
        "product_funnel": products.product_funnel(shop.page_views, shop.cart_quantities, shop.lines),
        "product_performance": products.product_performance(shop.page_views, shop.cart, shop.lines),
    }
    for name, df in results.items():
        tables.replace_table(df, out, name)
    tables.write_keyed(keyed.session_keyed_table(shop.session_cells), f"{out}/user_sessions")


def export(shop: Shop, summary_folder: str, out: str) -> dict[str, int]:
    """The star schema as CSV; gives back the rows of each file."""
    summary = shop.users.sparkSession.read.parquet(f"{summary_folder}/purchase_summary")
    users = shop.users.drop("total_orders", "total_spent", "avg_order")
    items = shop.products.drop("category_name", "subcategory_name")
    files = {
        "users": flatten.export_users(users, summary),
        "products": flatten.export_products(items, shop.categories, shop.subcategories),
        "transactions": flatten.export_transactions(shop.transactions),
        "transaction_items": flatten.export_transaction_items(shop.lines, items),
        "sessions": flatten.export_sessions(shop.session_cells),
        "categories": flatten.export_categories(shop.categories, shop.subcategories),
    }
    return {name: tables.write_csv(df, f"{out}/{name}") for name, df in files.items()}


def run(spark: SparkSession, json_folder: str, work_folder: str) -> dict[str, int]:
    load_tables(spark, json_folder, f"{work_folder}/tables")
    shop = clean_shop(spark, f"{work_folder}/tables")
    analyze(shop, f"{work_folder}/results")
    return export(shop, f"{work_folder}/results", f"{work_folder}/exports")
