"""Input schemas (DDL) of the nested entities, and the fixed vocabularies of the shop."""

USERS = """
    user_id STRING,
    geo_data STRUCT<city: STRING, state: STRING, country: STRING>,
    registration_date STRING,
    last_active STRING,
    purchase_summary STRUCT<total_orders: BIGINT, total_spent: DOUBLE, avg_order: DOUBLE, last_purchase: STRING>
"""

CATEGORIES = """
    category_id STRING,
    name STRING,
    subcategories ARRAY<STRUCT<subcategory_id: STRING, name: STRING, profit_margin: DOUBLE>>
"""

PRODUCTS = """
    product_id STRING,
    name STRING,
    category_id STRING,
    subcategory_id STRING,
    base_price DOUBLE,
    current_stock INT,
    is_active BOOLEAN,
    price_history ARRAY<STRUCT<price: DOUBLE, date: STRING>>,
    creation_date STRING
"""

# A cart is keyed by product id, so it is a map; inferring a struct would give
# one field per product.
SESSIONS = """
    session_id STRING,
    user_id STRING,
    start_time STRING,
    end_time STRING,
    duration_seconds INT,
    geo_data STRUCT<city: STRING, state: STRING, country: STRING, ip_address: STRING>,
    device_profile STRUCT<type: STRING, os: STRING, browser: STRING>,
    viewed_products ARRAY<STRING>,
    page_views ARRAY<STRUCT<timestamp: STRING, page_type: STRING, product_id: STRING,
                            category_id: STRING, view_duration: INT>>,
    cart_contents MAP<STRING, STRUCT<quantity: INT, price: DOUBLE>>,
    conversion_status STRING,
    referrer STRING
"""

TRANSACTIONS = """
    transaction_id STRING,
    session_id STRING,
    user_id STRING,
    timestamp STRING,
    items ARRAY<STRUCT<product_id: STRING, quantity: INT, unit_price: DOUBLE, subtotal: DOUBLE>>,
    subtotal DOUBLE,
    discount DOUBLE,
    total DOUBLE,
    payment_method STRING,
    status STRING
"""

ENTITIES = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "sessions": SESSIONS,
    "transactions": TRANSACTIONS,
}

# The vocabularies that reports and filters depend on.
PAID_STATUSES = ("completed", "shipped")
TRANSACTION_STATUSES = ("completed", "shipped", "processing", "refunded")
CONVERSION_STATUSES = ("converted", "abandoned", "browsing")
PAGE_TYPES = ("home", "category_listing", "product_detail", "cart", "checkout", "search")
PAYMENT_METHODS = ("mtn_momo", "airtel_money", "bank_transfer", "cash", "visa_card")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
BROWSERS = ("Chrome", "Safari", "Firefox", "Edge")
REFERRERS = ("whatsapp", "facebook", "google_search", "direct", "instagram", "sms_campaign", "word_of_mouth")

# The province each district belongs to.
PROVINCE_DISTRICTS = {
    "Kigali": ("Nyarugenge", "Gasabo", "Kicukiro"),
    "Northern": ("Musanze", "Burera", "Gakenke", "Gicumbi", "Rulindo"),
    "Southern": ("Huye", "Gisagara", "Muhanga", "Kamonyi", "Nyanza", "Nyaruguru", "Ruhango", "Nyamagabe"),
    "Eastern": ("Rwamagana", "Bugesera", "Gatsibo", "Kayonza", "Kirehe", "Ngoma", "Nyagatare"),
    "Western": ("Rubavu", "Karongi", "Ngororero", "Nyabihu", "Nyamasheke", "Rusizi", "Rutsiro"),
}
