"""Synthetic e-commerce tables, derived from row numbers by arithmetic.

Every table starts from a frame with a column ``n`` (0, 1, 2, ...), such as
``row_numbers(spark, rows)``, and each value is a function of ``n`` alone: any
number of rows, on any number of tasks, and the same values on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default sizes and the categories of the generated tables.
CUSTOMER_ROWS = 10_000
PRODUCT_ROWS = 1_000
ORDER_ROWS = 50_000
GENDERS = ["M", "F", "Other"]
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
CATEGORIES = [
    "Electronics", "Clothing", "Books", "Home & Garden",
    "Sports", "Toys", "Beauty", "Automotive",
]
MATERIALS = ["Plastic", "Metal", "Wood", "Glass", "Fabric", "Leather"]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "PayPal", "Bank Transfer"]
SHIPPING_METHODS = ["Standard", "Express", "Overnight"]
SALES_CHANNELS = ["Online", "Store", "Phone", "Mobile App"]
MOVEMENTS = ["Purchase", "Sale", "Adjustment", "Return"]
LOCATIONS = ["Warehouse A", "Warehouse B", "Store 1", "Store 2"]
LAST_DAY = "2024-01-01"
TAX_PERCENT = 8.5


def row_numbers(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(rows).withColumnRenamed("id", "n")


def _draw(factor: int, offset: int, size: int, n: Column | None = None) -> Column:
    """A number in 0..size-1 that varies with ``n``."""
    n = F.col("n") if n is None else n
    return F.pmod(n * factor + offset, F.lit(size).cast("bigint"))


def _pick(values: Sequence[str], factor: int, offset: int) -> Column:
    place = _draw(factor, offset, len(values)) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), place.cast("int"))


def _key(prefix: str, digits: int, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.format_string(f"%0{digits}d", number))


def _days_before(days: Column) -> Column:
    return F.date_sub(F.lit(LAST_DAY).cast("date"), days.cast("int"))


def customers(numbers: DataFrame) -> DataFrame:
    n = F.col("n")
    return numbers.select(
        _key("CUST_", 6, n + 1).alias("customer_id"),
        F.concat(F.lit("First"), _draw(7, 3, 500)).alias("first_name"),
        F.concat(F.lit("Last"), _draw(13, 5, 900)).alias("last_name"),
        F.concat(F.lit("user"), n + 1, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.format_string("%07d", _draw(7919, 17, 10_000_000))).alias("phone"),
        F.concat(F.lit("City"), _draw(31, 1, 200)).alias("city"),
        F.concat(F.lit("State"), _draw(17, 2, 50)).alias("state"),
        F.format_string("%05d", _draw(101, 501, 100_000)).alias("zip_code"),
        (_draw(29, 7, 63) + 18).cast("int").alias("age"),
        _pick(GENDERS, 11, 1).alias("gender"),
        _days_before(_draw(37, 11, 730)).alias("registration_date"),
        _pick(TIERS, 5, 2).alias("customer_tier"),
        (_draw(41, 13, 100) < 80).alias("is_active"),
    )


def products(numbers: DataFrame) -> DataFrame:
    n = F.col("n")
    category = _pick(CATEGORIES, 3, 1)
    cents = _draw(7919, 311, 99_001) + 1000
    price = F.round(cents / 100, 2)
    # Cost is 60 to 80 percent of the price, in whole cents.
    cost = F.round(F.floor(cents * (_draw(23, 5, 21) + 60) / 100) / 100, 2)
    return numbers.select(
        _key("PROD_", 6, n + 1).alias("product_id"),
        F.concat(F.lit("Product "), n + 1).alias("product_name"),
        category.alias("category"),
        F.concat(category, F.lit("_Sub_"), _draw(7, 2, 5) + 1).alias("subcategory"),
        F.concat(F.lit("Brand"), _draw(19, 3, 120)).alias("brand"),
        price.alias("price"),
        cost.alias("cost"),
        F.round((_draw(43, 9, 4991) + 10) / 100, 2).alias("weight"),
        F.concat_ws(
            "x", _draw(3, 1, 46) + 5, _draw(5, 2, 46) + 5, _draw(7, 3, 46) + 5
        ).alias("dimensions"),
        _pick(MATERIALS, 5, 4).alias("material"),
        _draw(47, 6, 1001).cast("int").alias("stock_quantity"),
        (_draw(53, 8, 91) + 10).cast("int").alias("reorder_level"),
        _key("SUPP_", 3, _draw(59, 10, 100) + 1).alias("supplier_id"),
        _days_before(_draw(61, 12, 1095)).alias("launch_date"),
        F.round((_draw(67, 14, 41) + 10) / 10, 1).alias("rating"),
        (_draw(71, 15, 10) < 1).alias("is_discontinued"),
    )


def orders(numbers: DataFrame, customer_rows: int = CUSTOMER_ROWS) -> DataFrame:
    n = F.col("n")
    status = _draw(37, 11, 100)
    ordered = _days_before(_draw(17, 4, 365))
    shipped = F.date_add(ordered, (_draw(19, 6, 7) + 1).cast("int"))
    return numbers.select(
        _key("ORD_", 8, n + 1).alias("order_id"),
        _key("CUST_", 6, _draw(7919, 5, customer_rows) + 1).alias("customer_id"),
        ordered.alias("order_date"),
        shipped.alias("shipping_date"),
        F.date_add(shipped, (_draw(23, 8, 14) + 1).cast("int")).alias("delivery_date"),
        F.when(status < 10, "Pending")
        .when(status < 30, "Shipped")
        .when(status < 90, "Delivered")
        .otherwise("Cancelled")
        .alias("order_status"),
        _pick(PAYMENT_METHODS, 7, 1).alias("payment_method"),
        _pick(SHIPPING_METHODS, 11, 2).alias("shipping_method"),
        F.round((_draw(29, 3, 4501) + 500) / 100, 2).alias("shipping_cost"),
        F.lit(0.0).alias("tax_amount"),
        F.round(_draw(31, 9, 10_001) / 100, 2).alias("discount_amount"),
        F.lit(0.0).alias("total_amount"),
        F.lit("USD").alias("currency"),
        _pick(SALES_CHANNELS, 13, 3).alias("sales_channel"),
    )


def order_items(
    numbers: DataFrame, products_table: DataFrame, product_rows: int = PRODUCT_ROWS
) -> DataFrame:
    """One to five different products per order; prices come from the products."""
    n, j = F.col("n"), F.col("j")
    lines = F.least(_draw(7, 2, 5) + 1, F.lit(product_rows).cast("bigint"))
    items = numbers.select("n", F.explode(F.sequence(F.lit(0).cast("bigint"), lines - 1)).alias("j"))
    order_id = _key("ORD_", 8, n + 1)
    drawn = items.select(
        F.concat(order_id, F.lit("_ITEM_"), F.format_string("%02d", j + 1)).alias("order_item_id"),
        order_id.alias("order_id"),
        _key("PROD_", 6, F.pmod(n * 13 + j, F.lit(product_rows).cast("bigint")) + 1).alias("product_id"),
        (F.pmod(n + j, F.lit(3).cast("bigint")) + 1).cast("int").alias("quantity"),
        F.round(F.pmod(n * 31 + j * 7, F.lit(2001).cast("bigint")) / 100, 2).alias("discount_percent"),
    )
    prices = products_table.select("product_id", F.col("price").alias("unit_price"))
    return drawn.join(prices, "product_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        F.round(F.col("unit_price") * F.col("quantity"), 2).alias("line_total"),
        "discount_percent",
        F.lit(TAX_PERCENT).alias("tax_percent"),
    )


def with_totals(orders_table: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with ``total_amount`` rolled up from their items."""
    totals = items.groupBy("order_id").agg(
        F.round(F.sum("line_total"), 2).alias("__total")
    )
    return (
        orders_table.join(totals, "order_id", "left")
        .withColumn("total_amount", F.coalesce("__total", "total_amount"))
        .select(*orders_table.columns)
    )


def inventory(numbers: DataFrame, products_table: DataFrame) -> DataFrame:
    """Five to twenty movements per product; about 30 % carry an expiry date."""
    n, j = F.col("n"), F.col("j")
    moves = numbers.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), _draw(11, 3, 16) + 4)).alias("j"), "n"
    )
    # A second number per movement; 20 movements per product at the most.
    moves = moves.select("j", F.col("n").alias("product"), (n * 20 + j).alias("n"))
    drawn = moves.select(
        _key("INV_", 8, n + 1).alias("inventory_id"),
        _key("PROD_", 6, F.col("product") + 1).alias("product_id"),
        _days_before(_draw(17, 5, 183)).alias("transaction_date"),
        _pick(MOVEMENTS, 3, 1).alias("transaction_type"),
        (_draw(37, 9, 301) - 100).cast("int").alias("quantity_change"),
        _pick(LOCATIONS, 7, 2).alias("location"),
        F.concat(F.lit("BATCH_"), _draw(101, 7, 9000) + 1000).alias("batch_number"),
        F.when(
            _draw(43, 4, 10) < 3,
            F.date_add(F.lit(LAST_DAY).cast("date"), _draw(47, 6, 730).cast("int")),
        ).alias("expiry_date"),
    )
    details = products_table.select(
        "product_id", F.col("cost").alias("unit_cost"), "supplier_id"
    )
    return drawn.join(details, "product_id").select(
        "inventory_id", "product_id", "transaction_date", "transaction_type",
        "quantity_change", "unit_cost", "location", "batch_number",
        "expiry_date", "supplier_id",
    )
