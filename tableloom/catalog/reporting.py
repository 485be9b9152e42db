"""The e-commerce reports over the given tables, and the generated tables."""

from pyspark.sql import functions as F

from ..plans import reports as r
from ..plans.runs import run_steps
from ..sources import synthetic as s
from ..sources.readers import Workspace
from .registry import query, table

_SHOP = """
    WITH customers AS (
        SELECT c_custkey AS customer_id, '  ' || c_name || ' ' AS first_name,
               c_mktsegment AS last_name,
               CASE WHEN c_custkey % 11 = 0 THEN NULL
                    ELSE 'user' || c_custkey || '@example.com' END AS email,
               'City ' || c_nationkey AS city, 'State ' || c_nationkey AS state,
               (18 + c_custkey % 63)::INTEGER AS age, c_mktsegment AS customer_tier
        FROM customer),
    customers_clean AS (
        SELECT customer_id, lower(trim(first_name)) AS first_name,
               lower(trim(last_name)) AS last_name, email, lower(trim(city)) AS city,
               lower(trim(state)) AS state, age, customer_tier
        FROM customers WHERE email IS NOT NULL),
    products AS (
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size % 5 + 1.0::DOUBLE END AS rating,
               CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS stock_quantity
        FROM part),
    orders_raw AS (
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS customer_id,
               strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderstatus AS order_status,
               o_orderpriority AS payment_method, o_totalprice AS total_amount,
               o_totalprice / 100 AS shipping_cost
        FROM orders),
    orders_clean AS (SELECT * FROM orders_raw WHERE customer_id IS NOT NULL),
    items AS (
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
               l_extendedprice AS line_total
        FROM lineitem),
    full_data AS (
        SELECT * FROM orders_clean JOIN customers_clean USING (customer_id)
        JOIN (SELECT * FROM items JOIN products USING (product_id)) USING (order_id))
"""


def _customers(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(key % 11 != 0, F.concat(F.lit("user"), key, F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("City "), "c_nationkey").alias("city"),
        F.concat(F.lit("State "), "c_nationkey").alias("state"),
        (key % 63 + 18).cast("int").alias("age"),
        F.col("c_mktsegment").alias("customer_tier"),
    )


def _products(spark, sf_dir):
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(key % 6 != 0, F.col("p_size") % 5 + F.lit(1.0)).alias("rating"),
        F.when(key % 4 != 0, F.col("p_size")).alias("stock_quantity"),
    )


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").alias("total_amount"),
        (F.col("o_totalprice") / 100).alias("shipping_cost"),
    )


def _items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("line_total"),
    )


def _shop(spark, sf_dir):
    return (
        r.orders_clean(_orders(spark, sf_dir)),
        r.customers_clean(_customers(spark, sf_dir)),
        _items(spark, sf_dir),
        _products(spark, sf_dir),
    )


def _day(df, column="order_date"):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


@query("customers_clean", _SHOP + "SELECT * FROM customers_clean")
def customers_clean(spark, sf_dir):
    return r.customers_clean(_customers(spark, sf_dir))


@query(
    "products_clean",
    _SHOP
    + """SELECT product_id, product_name, category, coalesce(rating, 0.0) AS rating,
                coalesce(stock_quantity, 0) AS stock_quantity FROM products""",
)
def products_clean(spark, sf_dir):
    return r.products_clean(_products(spark, sf_dir))


@query("orders_clean", _SHOP + "SELECT * FROM orders_clean")
def orders_clean(spark, sf_dir):
    return _day(r.orders_clean(_orders(spark, sf_dir)))


@query(
    "customer_summary",
    _SHOP
    + """SELECT customer_tier, state, round(avg(age), 6) AS age_avg,
                count(customer_id) AS customer_id_count
         FROM customers_clean GROUP BY customer_tier, state""",
)
def customer_summary(spark, sf_dir):
    summary = r.customer_summary(r.customers_clean(_customers(spark, sf_dir)))
    return summary.withColumn("age_avg", F.round("age_avg", 6))


@query(
    "order_summary",
    _SHOP
    + """SELECT order_status, payment_method, round(sum(total_amount), 2) AS total_amount_sum,
                count(order_id) AS order_id_count, round(avg(shipping_cost), 5) AS shipping_cost_avg
         FROM orders_clean GROUP BY order_status, payment_method""",
)
def order_summary(spark, sf_dir):
    summary = r.order_summary(r.orders_clean(_orders(spark, sf_dir)))
    return summary.withColumns(
        {
            "total_amount_sum": F.round("total_amount_sum", 2),
            "shipping_cost_avg": F.round("shipping_cost_avg", 5),
        }
    )


@query(
    "customer_orders",
    _SHOP + "SELECT * FROM orders_clean JOIN customers_clean USING (customer_id)",
)
def customer_orders(spark, sf_dir):
    orders, customers, _, _ = _shop(spark, sf_dir)
    return _day(r.customer_orders(orders, customers))


@query(
    "order_item_products", _SHOP + "SELECT * FROM items JOIN products USING (product_id)"
)
def order_item_products(spark, sf_dir):
    _, _, items, products = _shop(spark, sf_dir)
    return r.order_item_products(items, products)


@query("full_order_data", _SHOP + "SELECT * FROM full_data")
def full_order_data(spark, sf_dir):
    return _day(r.full_order_data(*_shop(spark, sf_dir)))


_SALES = """round(sum(line_total), 2) AS line_total_sum, sum(quantity) AS quantity_sum,
            count(order_id) AS order_id_count"""


def _cents(df):
    return df.withColumn("line_total_sum", F.round("line_total_sum", 2))


@query(
    "customer_revenue",
    _SHOP
    + f"""SELECT customer_id, first_name, last_name, customer_tier, {_SALES}
          FROM full_data GROUP BY ALL""",
)
def customer_revenue(spark, sf_dir):
    return _cents(r.customer_revenue(*_shop(spark, sf_dir)))


@query(
    "product_performance",
    _SHOP + f"SELECT product_id, product_name, category, {_SALES} FROM full_data GROUP BY ALL",
)
def product_performance(spark, sf_dir):
    return _cents(r.product_performance(*_shop(spark, sf_dir)))


@query(
    "sales_trend", _SHOP + f"SELECT order_date, {_SALES} FROM full_data GROUP BY ALL"
)
def sales_trend(spark, sf_dir):
    return _cents(_day(r.sales_trend(*_shop(spark, sf_dir))))


@query(
    "monthly_sales",
    _SHOP
    + f"""SELECT substr(order_date, 1, 7) || '-01' AS order_date_month, {_SALES}
          FROM full_data GROUP BY ALL""",
)
def monthly_sales(spark, sf_dir):
    monthly = r.monthly_sales(r.sales_trend(*_shop(spark, sf_dir)))
    return _cents(_day(monthly, "order_date_month"))


def _ranked_sql(direction):
    return (
        _SHOP
        + f"""SELECT *, rank() OVER (ORDER BY line_total_sum {direction})::INTEGER AS revenue_rank,
                 dense_rank() OVER (ORDER BY line_total_sum {direction})::INTEGER
                     AS revenue_dense_rank
              FROM (SELECT customer_id, first_name, last_name, customer_tier, {_SALES}
                    FROM full_data GROUP BY ALL)"""
    )


@query("customer_revenue_ranked", _ranked_sql("DESC"))
def customer_revenue_ranked(spark, sf_dir):
    # Cents before ranking: the order in which doubles were added must not rank.
    return r.customer_revenue_ranked(_cents(r.customer_revenue(*_shop(spark, sf_dir))))


@query("customer_revenue_ranked_ascending", _ranked_sql("ASC"))
def customer_revenue_ranked_ascending(spark, sf_dir):
    revenue = _cents(r.customer_revenue(*_shop(spark, sf_dir)))
    return r.customer_revenue_ranked(revenue, descending=False)


@query(
    "demo_steps",
    _SHOP
    + """SELECT customer_tier, state, round(avg(age), 6) AS age_avg,
                count(customer_id) AS customer_id_count
         FROM customers WHERE email IS NOT NULL GROUP BY customer_tier, state""",
)
def demo_steps(spark, sf_dir):
    workspace = Workspace(spark)
    workspace.add("customers", _customers(spark, sf_dir))
    result = run_steps(workspace, r.DEMO_STEPS).result
    return result.withColumn("age_avg", F.round("age_avg", 6))


# --- generated tables -------------------------------------------------------------
# Each given key makes one generated row, so the size follows the given tables.


def _numbers(spark, sf_dir, name, key):
    return table(spark, sf_dir, name).select(F.col(key).alias("n"))


def _days_as_text(df):
    dates = [c for c, t in df.dtypes if t == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def _pick(values, factor, offset, n="n"):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[({n} * {factor} + {offset}) % {len(values)} + 1]"


def _before(days):
    return f"(DATE '{s.LAST_DAY}' - ({days})::INTEGER)"


def _customers_sql():
    return f"""
    SELECT printf('CUST_%06d', n + 1) AS customer_id, 'First' || (n * 7 + 3) % 500 AS first_name,
        'Last' || (n * 13 + 5) % 900 AS last_name, 'user' || (n + 1) || '@example.com' AS email,
        printf('+1-555-%07d', (n * 7919 + 17) % 10000000) AS phone,
        'City' || (n * 31 + 1) % 200 AS city, 'State' || (n * 17 + 2) % 50 AS state,
        printf('%05d', (n * 101 + 501) % 100000) AS zip_code,
        ((n * 29 + 7) % 63 + 18)::INTEGER AS age, {_pick(s.GENDERS, 11, 1)} AS gender,
        {_before('(n * 37 + 11) % 730')}::VARCHAR AS registration_date,
        {_pick(s.TIERS, 5, 2)} AS customer_tier, (n * 41 + 13) % 100 < 80 AS is_active
    FROM (SELECT c_custkey AS n FROM customer)"""


_PRODUCTS_SQL = f"""
    SELECT printf('PROD_%06d', n + 1) AS product_id, 'Product ' || (n + 1) AS product_name,
        {_pick(s.CATEGORIES, 3, 1)} AS category,
        {_pick(s.CATEGORIES, 3, 1)} || '_Sub_' || ((n * 7 + 2) % 5 + 1) AS subcategory,
        'Brand' || (n * 19 + 3) % 120 AS brand, round(cents / 100, 2) AS price,
        round(floor(cents * ((n * 23 + 5) % 21 + 60) / 100) / 100, 2) AS cost,
        round(((n * 43 + 9) % 4991 + 10) / 100, 2) AS weight,
        ((n * 3 + 1) % 46 + 5) || 'x' || ((n * 5 + 2) % 46 + 5) || 'x' || ((n * 7 + 3) % 46 + 5)
            AS dimensions,
        {_pick(s.MATERIALS, 5, 4)} AS material,
        ((n * 47 + 6) % 1001)::INTEGER AS stock_quantity,
        ((n * 53 + 8) % 91 + 10)::INTEGER AS reorder_level,
        printf('SUPP_%03d', (n * 59 + 10) % 100 + 1) AS supplier_id,
        {_before('(n * 61 + 12) % 1095')}::VARCHAR AS launch_date,
        round(((n * 67 + 14) % 41 + 10) / 10, 1) AS rating,
        (n * 71 + 15) % 10 < 1 AS is_discontinued
    FROM (SELECT p_partkey AS n, (p_partkey * 7919 + 311) % 99001 + 1000 AS cents FROM part)"""

_ORDERED = _before("(n * 17 + 4) % 365")
_ORDERS_SQL = f"""
    SELECT printf('ORD_%08d', n + 1) AS order_id,
        printf('CUST_%06d', (n * 7919 + 5) % (SELECT count(*) FROM customer) + 1) AS customer_id,
        {_ORDERED}::VARCHAR AS order_date,
        ({_ORDERED} + ((n * 19 + 6) % 7 + 1)::INTEGER)::VARCHAR AS shipping_date,
        ({_ORDERED} + ((n * 19 + 6) % 7 + 1 + (n * 23 + 8) % 14 + 1)::INTEGER)::VARCHAR AS delivery_date,
        CASE WHEN (n * 37 + 11) % 100 < 10 THEN 'Pending' WHEN (n * 37 + 11) % 100 < 30 THEN 'Shipped'
             WHEN (n * 37 + 11) % 100 < 90 THEN 'Delivered' ELSE 'Cancelled' END AS order_status,
        {_pick(s.PAYMENT_METHODS, 7, 1)} AS payment_method,
        {_pick(s.SHIPPING_METHODS, 11, 2)} AS shipping_method,
        round(((n * 29 + 3) % 4501 + 500) / 100, 2) AS shipping_cost, 0.0::DOUBLE AS tax_amount,
        round((n * 31 + 9) % 10001 / 100, 2) AS discount_amount,
        0.0::DOUBLE AS total_amount, 'USD' AS currency,
        {_pick(s.SALES_CHANNELS, 13, 3)} AS sales_channel
    FROM (SELECT o_orderkey AS n FROM orders)"""

_ITEMS_SQL = f"""
    SELECT printf('ORD_%08d_ITEM_%02d', n + 1, j + 1) AS order_item_id,
        printf('ORD_%08d', n + 1) AS order_id, product_id,
        ((n + j) % 3 + 1)::INTEGER AS quantity, price AS unit_price,
        round(price * ((n + j) % 3 + 1), 2) AS line_total,
        round((n * 31 + j * 7) % 2001 / 100, 2) AS discount_percent, 8.5::DOUBLE AS tax_percent
    FROM (SELECT n, j, printf('PROD_%06d', (n * 13 + j) % parts + 1) AS product_id
          FROM (SELECT o_orderkey AS n, unnest(range((o_orderkey * 7 + 2) % 5 + 1)) AS j
                FROM orders), (SELECT count(*) AS parts FROM part))
    JOIN ({_PRODUCTS_SQL}) USING (product_id)"""


def _synthetic_items(spark, sf_dir):
    parts = _numbers(spark, sf_dir, "part", "p_partkey")
    return s.order_items(
        _numbers(spark, sf_dir, "orders", "o_orderkey"), s.products(parts), parts.count()
    )


def _synthetic_orders(spark, sf_dir):
    people = table(spark, sf_dir, "customer").count()
    return s.orders(_numbers(spark, sf_dir, "orders", "o_orderkey"), people)


@query("synth_customers", _customers_sql())
def synth_customers(spark, sf_dir):
    return _days_as_text(s.customers(_numbers(spark, sf_dir, "customer", "c_custkey")))


@query("synth_products", _PRODUCTS_SQL)
def synth_products(spark, sf_dir):
    return _days_as_text(s.products(_numbers(spark, sf_dir, "part", "p_partkey")))


@query("synth_orders", _ORDERS_SQL)
def synth_orders(spark, sf_dir):
    return _days_as_text(_synthetic_orders(spark, sf_dir))


@query("synth_order_items", _ITEMS_SQL)
def synth_order_items(spark, sf_dir):
    return _synthetic_items(spark, sf_dir)


@query(
    "synth_order_totals",
    f"""SELECT order_id, round(sum(line_total), 2) AS total_amount FROM ({_ITEMS_SQL})
        GROUP BY order_id""",
)
def synth_order_totals(spark, sf_dir):
    totals = s.with_totals(_synthetic_orders(spark, sf_dir), _synthetic_items(spark, sf_dir))
    return totals.select("order_id", "total_amount")


@query(
    "synth_inventory",
    f"""
    SELECT printf('INV_%08d', n + 1) AS inventory_id, product_id,
        {_before('(n * 17 + 5) % 183')}::VARCHAR AS transaction_date,
        {_pick(s.MOVEMENTS, 3, 1)} AS transaction_type,
        ((n * 37 + 9) % 301 - 100)::INTEGER AS quantity_change, cost AS unit_cost,
        {_pick(s.LOCATIONS, 7, 2)} AS location,
        'BATCH_' || ((n * 101 + 7) % 9000 + 1000) AS batch_number,
        CASE WHEN (n * 43 + 4) % 10 < 3
             THEN (DATE '{s.LAST_DAY}' + ((n * 47 + 6) % 730)::INTEGER)::VARCHAR END AS expiry_date,
        supplier_id
    FROM (SELECT printf('PROD_%06d', part + 1) AS product_id, part * 20 + j AS n
          FROM (SELECT p_partkey AS part,
                       unnest(range((p_partkey * 11 + 3) % 16 + 5)) AS j FROM part))
    JOIN ({_PRODUCTS_SQL}) USING (product_id)""",
)
def synth_inventory(spark, sf_dir):
    numbers = _numbers(spark, sf_dir, "part", "p_partkey")
    return _days_as_text(s.inventory(numbers, s.products(numbers)))
