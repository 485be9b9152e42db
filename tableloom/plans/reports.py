"""The e-commerce reports: clean, summarise, join, rank.

The tables use the generated columns: customers (customer_id, first_name,
last_name, email, city, state, age, customer_tier), products (product_id,
product_name, category, rating, stock_quantity), orders (order_id, customer_id,
order_date, order_status, payment_method, total_amount, shipping_cost) and
order_items (order_id, product_id, quantity, line_total).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import store
from ..operators.aggregates import group_by, group_by_time
from ..operators.cleaning import fill_nulls, remove_nulls, standardize_text
from ..operators.joins import join_tables
from ..operators.windows import window_functions

SALES = ("line_total_sum", "quantity_sum", "order_id_count")


def customers_clean(customers: DataFrame) -> DataFrame:
    kept = remove_nulls(customers, ["email", "customer_id"])
    return standardize_text(
        kept, ["first_name", "last_name", "city", "state"], ["lower", "trim"]
    )


def products_clean(products: DataFrame) -> DataFrame:
    return fill_nulls(products, {"rating": 0.0, "stock_quantity": 0})


def orders_clean(orders: DataFrame) -> DataFrame:
    return remove_nulls(orders, ["order_id", "customer_id"])


def customer_summary(customers: DataFrame) -> DataFrame:
    return group_by(
        customers, ["customer_tier", "state"], {"age": "avg", "customer_id": "count"}
    )


def order_summary(orders: DataFrame) -> DataFrame:
    return group_by(
        orders,
        ["order_status", "payment_method"],
        {"total_amount": "sum", "order_id": "count", "shipping_cost": "avg"},
    )


def customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return join_tables(orders, customers, ["customer_id"])


def order_item_products(items: DataFrame, products: DataFrame) -> DataFrame:
    return join_tables(items, products, ["product_id"])


def full_order_data(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    return join_tables(
        customer_orders(orders, customers),
        order_item_products(items, products),
        ["order_id"],
    )


def _sales(df: DataFrame, *keys: str) -> DataFrame:
    """First aggregation of item rows."""
    return df.groupBy(*keys).agg(
        F.sum("line_total").alias("line_total_sum"),
        F.sum("quantity").alias("quantity_sum"),
        F.count(F.lit(1)).alias("order_id_count"),
    )


def _more_sales(df: DataFrame, *keys: str) -> DataFrame:
    """Sums of partial sums."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SALES])


def _sales_per_order(items: DataFrame, products: DataFrame) -> DataFrame:
    sold = items.select("order_id", "product_id", "line_total", "quantity").join(
        products.select("product_id"), "product_id"
    )
    return _sales(sold, "order_id")


def customer_revenue(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """Revenue, quantity and item rows per customer.

    Items are summed per order and orders per customer before the next table
    is joined: the joins carry one row per key, and a customer with very many
    orders is reduced map-side. Sums of an inner join do not depend on when the
    rows are added up, so the result is that of joining everything first.
    """
    per_order = _sales_per_order(items, products)
    per_customer = _more_sales(
        orders.select("order_id", "customer_id").join(per_order, "order_id"),
        "customer_id",
    )
    named = customers.select("customer_id", "first_name", "last_name", "customer_tier")
    return _more_sales(
        named.join(per_customer, "customer_id"),
        "customer_id", "first_name", "last_name", "customer_tier",
    )


def product_performance(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """Revenue, quantity and item rows per product."""
    placed = orders.select("order_id", "customer_id").join(
        customers.select("customer_id"), "customer_id"
    )
    sold = items.select("order_id", "product_id", "line_total", "quantity").join(
        placed.select("order_id"), "order_id"
    )
    per_product = _sales(sold, "product_id")
    named = products.select("product_id", "product_name", "category")
    return _more_sales(
        named.join(per_product, "product_id"), "product_id", "product_name", "category"
    )


def sales_trend(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """Revenue, quantity and item rows per order date."""
    placed = orders.select("order_id", "customer_id", "order_date").join(
        customers.select("customer_id"), "customer_id"
    )
    dated = placed.join(_sales_per_order(items, products), "order_id")
    return _more_sales(dated, "order_date")


def monthly_sales(trend: DataFrame) -> DataFrame:
    """The daily trend rolled up to months."""
    rolled = group_by_time(trend, "order_date", "month", {c: "sum" for c in SALES})
    return rolled.withColumnsRenamed({f"{c}_sum": c for c in SALES})


def customer_revenue_ranked(revenue: DataFrame, descending: bool = True) -> DataFrame:
    """Customers ranked by revenue over the whole table.

    The revenue table, one row per customer, is written first: ranking counts
    its rows before it orders them, and the joins below should run once.
    """
    order = ("line_total_sum", "desc" if descending else "asc")
    return window_functions(
        store(revenue, "customer-revenue"),
        None,
        [order],
        {"revenue_rank": "rank", "revenue_dense_rank": "dense_rank"},
    )


# The demonstration run.
DEMO_STEPS = [
    {
        "dataset": "customers",
        "transform_key": "remove_nulls",
        "parameters": {"columns": ["email"], "how": "any"},
        "output": "customers_reachable",
    },
    {
        "dataset": "customers_reachable",
        "transform_key": "standardize_text",
        "parameters": {"columns": ["first_name", "last_name"], "operations": ["lower", "trim"]},
        "output": "customers_tidy",
    },
    {
        "dataset": "customers_tidy",
        "transform_key": "group_by",
        "parameters": {
            "group_by_columns": ["customer_tier", "state"],
            "aggregations": {"age": "avg", "customer_id": "count"},
        },
    },
]
"""Three steps over customers: drop rows without e-mail, tidy names, summarise."""
